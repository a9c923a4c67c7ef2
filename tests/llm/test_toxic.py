"""Toxic words in otherwise good text."""

import random

import numpy as np
from rollcall.llm import quality
from rollcall.llm.common import ship


def test_toxic_words(spark):
    """Documents that no label names go if they hold a word of toxic ones; good ones stay."""
    ship(spark)
    rng = random.Random(8)
    words = ["".join(rng.choice(["ka", "lo", "mi", "ta", "ren", "so"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]

    def text(extra):
        out = [rng.choice(words) for _ in range(250)]
        for _ in range(3 if extra else 0):
            out.insert(rng.randrange(250), rng.choice(["xyzzyx", "quuxqu"]))
        return " ".join(out)

    rows = [(i, text(i % 3 == 0), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, quality.trusted_labels(labels), toxic_ids=quality.toxic_labels(labels)).collect()
    got = {r.doc_id: r.accepted for r in out}
    assert not any(got[i] for i in range(240, 300) if i % 3 == 0)
    assert sum(got[i] for i in range(300) if i % 3) >= 195


def test_worst_passages():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 4, 16, 17, 200, 0, 1, 40])
    starts, values = np.cumsum(lengths + 3) - lengths, rng.integers(-9, 9, int((lengths + 3).sum())).astype(np.int16)
    got = quality.worst_passages(values, starts, lengths)
    for s, n, g in zip(starts, lengths, got, strict=True):
        assert g == (values[s : s + n].sum() if n <= 16 else max(values[s + i : s + i + 16].sum() for i in range(n - 15)))


def test_threshold(spark):
    """What is far beyond the trusted documents goes; they stay."""
    ship(spark)
    rng = random.Random(9)
    words = ["".join(rng.choice(["ka", "lo", "mi", "ta", "ren", "so"]) for _ in range(3)) for _ in range(300)]
    noise = ["".join(rng.choice("aeiklmnorst") for _ in range(6)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(noise if rng.random() < max(0, i - 100) / 200 else words) for _ in range(250)), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in quality.classify(docs, spark.createDataFrame([(i,) for i in range(100)], "doc_id long")).collect()}
    assert all(out[i].accepted for i in range(100)) and not any(out[i].accepted for i in range(130, 200))
