"""The digest index over several batches, and mixing through several levels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import exact_dedup, mixing
from rollcall.llm.common import Conflict, Manifest, new_path, ship


def test_batches(spark):
    """A text belongs to the batch that brought it first, whatever ids come later; the index keeps its number of buckets."""
    ship(spark)
    path, of = new_path(spark, "d"), "doc_id long, text string, digest string"
    one = spark.createDataFrame([(1, "a b", "x"), (2, "ab", None), (3, None, "x"), (None, "ab  ", "x")], of)
    two = spark.createDataFrame([(1, "a  b", "x"), (1, "c", "x"), (7, "c", "x"), (8, "", "x")], of)

    def run(docs, batch):
        index = exact_dedup.DigestIndex(spark, path, buckets=3, max_runs=1)
        return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_batch(docs, index, batch).collect()), key=str)

    first, second = run(one, "one"), run(two, "two")
    assert first == sorted([(1, None, 3, False), (2, None, 3, False), (3, 3, 1, True), (None, None, 3, True)], key=str)
    assert second == sorted([(1, None, 1, False), (1, 1, 2, True), (7, 1, 2, False), (8, 3, 1, False)], key=str)
    assert run(one, "three") == sorted([(1, None, 3, False), (2, None, 3, False), (3, 3, 1, False), (None, None, 3, False)], key=str)
    assert run(one, "one") == first and run(two, "two") == second  # after their runs were merged, too
    index = exact_dedup.DigestIndex(spark, path, buckets=50)
    assert index.buckets == 3 and index.rows().count() == 3
    assert exact_dedup.dedup_batch(one.where("false"), index, "none").count() == 0


def test_failed_and_simultaneous_batches(spark, monkeypatch):
    """What failed before its run was published counts for nothing; of two at once the second is refused and may try again."""
    ship(spark)
    path = new_path(spark, "d")
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    kept = lambda batch: {r.doc_id for r in exact_dedup.dedup_batch(docs, exact_dedup.DigestIndex(spark, path, buckets=2), batch).collect() if r.kept}
    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept("lost")
    assert kept("one") == {1, 3} == kept("one") and kept("two") == set()
    a, b = (exact_dedup.DigestIndex(spark, path) for _ in range(2))
    rows = exact_dedup.groups_of(exact_dedup.digests(spark.createDataFrame([(9, "new")], "doc_id long, text string")))
    a.append(a.unseen(rows), "a")
    with pytest.raises(Conflict):
        b.append(b.unseen(rows), "b")
    exact_dedup.add_batch(rows, b, "b")
    assert [r.batch for r in b.rows().where("keep_id = 9").collect()] == ["a"]


def test_words_come_near_targets(spark):
    """Sources with one document of most of their words, and a very long text."""
    ship(spark)
    rng = random.Random(3)
    rows = [(i, "w " * int(min(rng.lognormvariate(4, 1.5), 5_000)), f"s{i % 12}") for i in range(1200)] + [(5000 + k, "w " * 3000, f"s{k}") for k in range(12)] + [(9999, "w " * 1_500_000, "long")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 0.02 * r.target for r in got if r.source != "long")
    assert [r.t % 1_500_000 for r in got if r.source == "long"] == [0]


def test_mix_through_levels(spark):
    """Groups of four rows, two by two: copies are floor or ceiling of what is expected, and words come near the targets."""
    ship(spark)
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([0, 1, 5, 20, 60]), rng.choice(["a", "b", "c", None]), 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(docs, group_rows=4, fan_in=2).collect()
    assert len(got) == 300 and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs, group_rows=4, fan_in=2).collect()))
    taken = {}
    for r in got:
        rate = r.target / r.source_size
        assert math.floor(rate) <= r.copies <= math.ceil(rate) and r.taken == r.copies * r.size
        total, _, most = taken.get(r.source, (0, 0, 0))
        taken[r.source] = total + r.taken, r.target, max(most, r.size)
    assert all(abs(total - target) <= most for total, target, most in taken.values())


def test_pivot_in_pairs():
    """Each meeting keeps the sum of words, and one document at most is left open."""
    import numpy as np

    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 50):
        size, p = rng.integers(1, 90, n).astype(float), rng.random(n)
        out = mixing.pivot(size, p, rng.random(n))
        assert abs((out * size).sum() - (p * size).sum()) < 1e-6 and ((out > 0) & (out < 1)).sum() <= 1
