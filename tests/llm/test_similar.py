"""Near dedup of the pipeline against brute force over sets of five-word shingles."""

import random

import corpus_pipeline as P
import numpy as np
import pytest
from rollcall.llm import near_dedup
from rollcall.llm.common import ship


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def table():
    """40 texts, each with a copy that has three words of 300 replaced (about 0.9), and one that has twelve (about 0.67)."""
    rng = random.Random(4)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((3 * i, " ".join(words)))
        for k, changes in ((1, 3), (2, 12)):
            other = list(words)
            for c in range(changes):
                other[int((c + 0.5) * 300 / changes)] = f"new{i}x{k}x{c}"
            rows.append((3 * i + k, " ".join(other)))
    return rows


def test_near_copies_go(spark, table):
    docs = spark.createDataFrame(table, "doc_id long, text string")
    got = {r.doc_id for r in P.near(spark, docs, "").collect()}
    assert all(jaccard(table[3 * i][1], table[3 * i + 1][1]) >= 0.8 > jaccard(table[3 * i][1], table[3 * i + 2][1]) for i in range(40))
    assert {i for i, _ in table if i % 3 != 1} <= got  # what is less similar stays, whatever the fingerprints say
    assert sum(3 * i + 1 not in got for i in range(40)) >= 38


def test_groups_agree(spark, table, monkeypatch):
    """Dealing variants to groups by leading bits finds the same."""
    ship(spark)
    docs = spark.createDataFrame(table, "doc_id long, text string")
    whole = {tuple(r) for r in near_dedup.similar(docs).collect()}
    monkeypatch.setattr(near_dedup, "GROUP", 60)
    assert {tuple(r) for r in near_dedup.similar(docs).collect()} == whole


def test_crowded_variants_lose_no_link(spark, monkeypatch):
    """A text with 50 near copies, some of them alike only through others: crowds, in one task or in blocks, find what all pairs find."""
    ship(spark)
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(50):
        other = list(words)
        for c in range(1 + i % 7):
            other[(i * 37 + c * 43) % 300] = f"x{i}y{c}"
        rows.append((i, " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "FEW", 1000)
    whole = {tuple(r) for r in near_dedup.similar(docs).collect()}
    for few, crowd in ((3, 8192), (2, 16)):
        monkeypatch.setattr(near_dedup, "FEW", few)
        monkeypatch.setattr(near_dedup, "CROWD", crowd)
        assert {tuple(r) for r in near_dedup.similar(docs).collect()} == whole
    assert 1 < len({r[2] for r in whole}) < 50


def test_counts_never_exclude_similar_sets():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        n = int(rng.integers(1, 2000))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.25], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        can = near_dedup.can_be_similar(near_dedup.cells(a)[None], near_dedup.cells(b)[None], np.array([len(a)]), np.array([len(b)]), 0.8)[0]
        assert can or both < 0.8 * (len(a) + len(b) - both)


def test_all_pairs_of_the_table(spark):
    """The smallest test table: the components of all pairs of documents, compared by their sets."""
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, shingles(r.text or "") if (r.text or "").split() else set()) for r in docs.collect()]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if (a == b) or (a and b and 5 * len(a & b) >= 4 * len(a | b)):
                root[max(top(i), top(j))] = min(top(i), top(j))
    want = {}
    for i, _ in rows:
        want.setdefault(top(i), set()).add(i)
    got = {}
    for r in near_dedup.similar(docs).collect():
        got.setdefault(r.root, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
