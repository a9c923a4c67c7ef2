"""The classifier's perplexities against interpolated modified Kneser-Ney by the formula, and its verdicts."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import quality
from rollcall.llm.common import ship

OF = "doc_id long, text string, lang string, block string, at int"


def plain_model(texts, order=4):
    """p(character | three before) of a dictionary implementation."""
    counts = {order: Counter(tuple(("\0" * (order - 1) + t)[i : i + order]) for t in texts for i in range(len(t)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, c in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0
        discounts[n] = [0.0, *(min(max(k - (k + 1) * y * b / a if a else 0.5, 0.05), k - 0.05) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))]
    contexts = {n: {} for n in counts}
    for n, c in counts.items():
        for g, v in c.items():
            total, freed = contexts[n].get(g[:-1], (0, 0.0))
            contexts[n][g[:-1]] = total + v, freed + discounts[n][min(v, 3)]

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        n = len(g)
        if g[:-1] not in contexts[n]:
            return p(g[1:])
        total, freed = contexts[n][g[:-1]]
        return (max(counts[n][g] - discounts[n][min(counts[n][g], 3)], 0) + freed * p(g[1:])) / total

    return p


def texts_of(rng, n, size=120):
    words = ["".join(rng.choice(["ka", "lo", "mi", "ta", "ren", "\u00e9\u00e8", "\U0001f600"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    return [" ".join(rng.choice(words) for _ in range(size)) for _ in range(n)]


@pytest.mark.parametrize("dense", [1 << 24, 0])
def test_perplexity_is_that_of_the_formula(spark, monkeypatch, dense):
    ship(spark)
    monkeypatch.setattr(quality, "SHARE", 1.0)
    monkeypatch.setattr(quality, "BLOCK_CHARS", 900)
    monkeypatch.setattr(quality, "DENSE", dense)
    good = texts_of(random.Random(1), 25)
    other = [None, "", "x", "ka", "\U0001f600 unseen \u4e00\u4e01", "ka lo " * 3000, "a\0b"]
    rows = [(i, t, "en", "x", i) for i, t in enumerate([*good, *other, good[0]])] + [(None, good[1], None, None, None)]
    docs = spark.createDataFrame(rows, OF).repartition(3)
    out = quality.classify(docs, spark.createDataFrame([(i,) for i in range(25)], "doc_id long")).collect()
    p, want = plain_model(good), {}
    for i, t, *_ in rows:
        t = t or ""
        padded = "\0" * 3 + t
        logs = sum(math.log(p(tuple(padded[k : k + 4]))) for k in range(len(t)))
        want[i] = len(t), math.exp(-logs / max(len(t), 1))
    assert len(out) == len(rows)
    for r in out:
        n, perplexity = want[r.doc_id]
        assert r.n_symbols == n and r.perplexity == pytest.approx(perplexity, rel=quality.STEP)


def test_noise_in_a_large_alphabet_goes(spark):
    """Chinese and English text is told from noise in the same characters."""
    ship(spark)
    rng = random.Random(2)
    words = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2)) for _ in range(400)]
    chinese = ["".join(rng.choice(words) for _ in range(200)) for _ in range(80)]
    english = texts_of(rng, 80)
    noise = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400)) for _ in range(20)]
    rows = [(i, t, "zh", "", 0) for i, t in enumerate(chinese)] + [(100 + i, t, "en", "", 0) for i, t in enumerate(english)] + [(200 + i, t, "zh", "", 0) for i, t in enumerate(noise)]
    trusted = spark.createDataFrame([(i,) for i in (*range(70), *range(100, 170))], "doc_id long")
    got = {r.doc_id: r.accepted for r in quality.classify(spark.createDataFrame(rows, OF), trusted).collect()}
    assert not any(got[200 + i] for i in range(20))
    assert sum(got[i] for i in range(80)) >= 78 and sum(got[100 + i] for i in range(80)) >= 78


def test_tables_without_rows_or_labels(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "some text", "en", "", 0), (1, None, None, "", 0)], OF)
    none = spark.createDataFrame([], "doc_id long")
    assert [r.accepted for r in quality.classify(docs, none, toxic_ids=none).collect()] == [True, True]
    assert quality.classify(docs.where("false"), none).count() == quality.accepted_documents(docs.where("false"), none).count() == 0
    assert sorted(map(str, quality.accepted_documents(docs, none).collect())) == sorted(map(str, docs.collect()))


def test_numbers_name_ngrams():
    rng = np.random.default_rng(4)
    symbols, starts = quality.code_points(["".join(map(chr, rng.integers(97, 103, n))) for n in (0, 1, 50, 3, 200)])
    number, at = quality.numbered(symbols)
    grams = {tuple(symbols[i - 3 : i + 1]) for i in range(3, len(symbols))}
    assert len(at) == len(grams) and {tuple(g) for g in quality.grams_at(symbols, at).T} == grams
    assert all((symbols[i : i + 4] == symbols[at[n] - 3 : at[n] + 1]).all() for i, n in enumerate(number))
    assert quality.in_texts(symbols, starts).sum() == 254
