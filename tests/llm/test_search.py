"""Top-k against brute force on awkward tables, and fingerprints of long and odd texts."""

import math
import random

import pytest
import xxhash

from rollcall.llm import near_dedup, vector_topk
from rollcall.llm.common import ship


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(vectors, queries, k):
    out = []
    for q, x in queries:
        if q is None or not usable(x):
            continue
        scored = []
        for c, y in vectors:
            if c is not None and usable(y) and c != q:
                scored.append((-sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(x, y, strict=False)), c))
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard", "tile", "k"), [(7, 3, 4), (1000, 1000, 200)])
def test_top_k(spark, monkeypatch, shard, tile, k):
    """Null and non-finite vectors, vectors of other lengths and of none, ties, repeated rows and ids, fewer than k."""
    ship(spark)
    monkeypatch.setattr(vector_topk, "FAN_IN", 2)
    rng = random.Random(shard)
    rows = [(i % 50, [rng.choice([-1.5, 0.0, 0.25, 1.0]) for _ in range(rng.choice([4, 4, 4, 2, 0, 6]))], 1.0) for i in range(80)]
    rows += [rows[0], rows[1], (90, None, 1.0), (91, [1.0, None], 1.0), (92, [float("nan")], 1.0), (93, [float("inf"), 0.0], 1.0), (None, [1.0], 1.0)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = vector_topk.top_k(v, v.where("vec_id % 5 = 0"), k=k, shard=shard, tile=tile).collect()
    pairs = [(i, x) for i, x, _ in rows]
    assert sorted(map(tuple, got)) == plain(pairs, [(i, x) for i, x in pairs if i is not None and i % 5 == 0], k)
    assert vector_topk.top_k(v.where("false"), v, k=3).count() == vector_topk.top_k(v, v.where("false"), k=3).count() == 0


def test_fingerprints_of_odd_texts(spark):
    """Long, empty, blank, short and repeated texts, null ids and clashing names."""
    ship(spark)
    texts = [None, "", " \t", "One", "one two", "A b C d", "x y " * 60_000, "ÄÖ ß İ"]
    docs = spark.createDataFrame([(None if i % 4 == 3 else i, t, 7) for i, t in enumerate(texts + texts[:2])], "doc_id long, text string, fp int")
    want = []
    for t in texts + texts[:2]:
        words = (t or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    got = sorted(r.fp & (1 << 64) - 1 for r in near_dedup.near_duplicates(docs).collect())
    assert got == sorted(want)
