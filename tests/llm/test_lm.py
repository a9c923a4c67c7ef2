"""The n-gram scorer against plain Python, and its levels against plain arrays."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import elias_fano, lm_scoring

ROWS = [
    (1, "the cat sat on the mat the cat sat", "x"), (2, "The dog sat on the mat", "x"), (3, None, "x"), (4, "", "x"), (5, " \t\n ", "x"),
    (6, "the cat sat on the mat the cat sat", "y"), (7, "unheard words only", "x"), (8, "the the the the", "x"), (9, "größe ÉCLAIR größe", "x"),
    (9, "größe ÉCLAIR größe", "x"), (None, "the cat", "x"), (10, "long " * 30_000 + "cat", "x"), (11, "A b a B", "x"),
]


def lowered(text):
    return (text or "").encode().lower().split()


def plain(rows, mu):
    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for i, (d, _) in enumerate(rows)}
    tokens = {i: [*lowered(t), None] for i, (_, t) in enumerate(rows)}
    train = [tokens[i] for i in tokens if not held[i]]
    c = Counter(w for t in train for w in t)
    total, kinds = sum(c.values()), len(c)
    pairs, uni = Counter(), lambda w: (c[w] + 0.5) / (total + 0.5 * (kinds + 1))
    for t in train:
        pairs.update(zip([None, *t], t, strict=False))
    out = []
    for i, t in tokens.items():
        base = sum(math.log10(uni(w)) for w in t)
        score = sum(math.log10((pairs[v, w] + mu * uni(w)) / (c[v] + mu)) for v, w in zip([None, *t], t, strict=False))
        out.append((rows[i][0], held[i], len(t), sum(c[w] > 0 for w in t), total, base, score))
    return out


def test_scores_are_those_of_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 40)
    monkeypatch.setattr(lm_scoring, "WORD_SHARD", 10)
    monkeypatch.setattr(lm_scoring, "PAIR_SHARD", 10_000)
    monkeypatch.setattr(lm_scoring, "HOT_CONTEXT", 5)  # frequent contexts are split over shards
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, block string").repartition(3)
    got, model = lm_scoring.score(docs, ~lm_scoring.held_out())
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(plain([r[:2] for r in ROWS], lm_scoring.MU), key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-6 * g[2])
        assert g[6] == pytest.approx(w[6], abs=g[2] / elias_fano.STEPS)
    assert model.count() > 1


def test_without_rows_or_training_rows(spark):
    docs = spark.createDataFrame(ROWS[:4], "doc_id long, text string, block string")
    assert lm_scoring.score(docs.where("false"), ~lm_scoring.held_out())[0].count() == 0
    rows = lm_scoring.score(docs, lm_scoring.held_out().isNull())[0].collect()
    assert len(rows) == 4 and all(r["n_known"] == r["train_tokens"] == r["score"] == r["base_score"] == 0 for r in rows)  # one unknown word of probability 1


@pytest.mark.parametrize(("n", "most"), [(0, 9), (1, 1), (1, 1 << 50), (500, 3), (5000, 1 << 20), (20_000, 1 << 40)])
def test_successor_search_in_compact_form(n, most):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, most, n).astype(np.uint64))
    level = elias_fano.EliasFano.encode(values)
    asked = np.concatenate([values, rng.integers(0, most + 9, 3000).astype(np.uint64), np.array([0, most, 2**63], np.uint64)])
    assert (level.next_geq(asked) == np.searchsorted(values, asked)).all()
    assert (level.get(np.arange(n)) == values).all()


def test_trie_finds_what_it_holds_and_nothing_else():
    rng = np.random.default_rng(5)
    keys = np.unique((rng.zipf(1.4, 30_000).astype(np.uint64) % np.uint64(900)) << np.uint64(32) | rng.zipf(1.3, 30_000).astype(np.uint64) % np.uint64(1 << 31))
    low, logs = np.uint64(0xFFFFFFFF), -rng.random(len(keys)) * 9
    trie = elias_fano.Trie.mapped(elias_fano.Trie.build(keys >> np.uint64(32), keys & low, logs).to_bytes())
    asked = np.concatenate([keys, keys + np.uint64(1), keys ^ np.uint64(1 << 40)])
    codes, there = trie.lookup(asked >> np.uint64(32), asked & low), np.isin(asked, keys)
    assert ((codes != elias_fano.ABSENT) == there).all()
    assert np.abs(elias_fano.dequantise(codes[: len(keys)]) - logs).max() <= 0.5 / elias_fano.STEPS + 1e-9
