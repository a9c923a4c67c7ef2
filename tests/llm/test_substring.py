"""Passage removal against brute force: repeated ids, batches, compaction, long and empty texts."""

import hashlib
import random

import pytest

from rollcall.llm import substring_dedup
from rollcall.llm.common import new_path, ship


def plain(rows, window, before=()):
    """(id, words, removed, hash) of each row; ``before`` are rows of earlier batches."""
    words = [((t or "").split(" ") if t else []) for _, t in rows]
    first = {}
    for d, t in [*rows, *before]:
        w = t.split(" ") if t else []
        for i in range(len(w) - window + 1) if d is not None else ():
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def table(seed, n=60, ids=40):
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}w{i}" for i in range(rng.randrange(10, 90))) for k in range(8)]
    rows = []
    for _ in range(n):
        parts = [" ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 30))) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randrange(0, 6))]
        rows.append((None if rng.random() < 0.05 else rng.randrange(ids), " ".join(p for p in parts if p) or None))
    return rows + rows[:5] + [(ids + 1, "long " * 20_000 + passages[0])]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")


@pytest.mark.parametrize("keep_text", [True, False])
def test_repeated_ids(spark, keep_text):
    ship(spark)
    x, y = (" ".join(f"{c}{i}" for i in range(80)) for c in "xy")
    rows = [(1, y), (2, x), (5, "pre " + x), (5, y), *table(1)]
    out = substring_dedup.remove_repeats(frame(spark, rows), substring_dedup.FingerprintIndex(spark, new_path(spark, "f")), "b", keep_text=keep_text)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()), key=str)
    assert got == plain(rows, 50)


def test_batches_and_compaction(spark):
    """Each batch is judged against itself and all before, through runs that are merged on the way."""
    ship(spark)
    path, before = new_path(spark, "f"), []
    for k in range(4):
        rows = table(k, n=40)
        index = substring_dedup.FingerprintIndex(spark, path, max_runs=2, buckets=3)
        out = substring_dedup.remove_repeats(frame(spark, rows), index, f"b{k}", frame(spark, before) if before else None, window=20)
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()), key=str)
        assert got == plain(rows, 20, before)
        before += rows
    assert substring_dedup.FingerprintIndex(spark, path, buckets=99).buckets == 3 and len(index.runs()) <= 2


def test_runs_again_and_missing_history(spark, monkeypatch):
    """A batch that fails before or after its run is published, or is run twice, gives the same rows; lost texts are refused."""
    ship(spark)
    path, one, two = new_path(spark, "f"), table(1, n=30), table(2, n=30)
    index = substring_dedup.FingerprintIndex(spark, path, buckets=3)
    call = lambda rows, batch, before=None: sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(frame(spark, rows), substring_dedup.FingerprintIndex(spark, path), batch, before).collect()), key=str)
    call(one, "one")
    with pytest.raises(ValueError, match="earlier batches"):
        call(two, "two")
    with monkeypatch.context() as m:
        m.setattr(substring_dedup.FingerprintIndex, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            call(two, "two", frame(spark, one))
    want = plain(two, 50, one)
    assert call(two, "two", frame(spark, one)) == want == call(two, "two", frame(spark, one))
    index.refresh()
    assert len(index.runs()) == 2
