import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from rollcall.llm import periodic
from rollcall.llm.common import ship
from rollcall.llm.recompression import Grammar


def plain_runs(w):
    """Every maximal stretch of every period, of which the smallest one counts."""
    n, out = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                out.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted(((s, k, p) for (s, k), p in out.items()), key=lambda r: (r[0], r[2]))


def made(rng, n, letters):
    """Sequences with runs of several periods, nested and side by side."""
    out = []
    while len(out) < n:
        unit = rng.integers(0, letters, rng.integers(1, 8)).tolist()
        if rng.random() < 0.3:
            unit = unit * int(rng.integers(4, 7)) + [int(rng.integers(0, letters))]
        out += unit * int(rng.integers(1, 9))
    return np.array(out[:n])


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_extensions_and_runs(letters):
    rng = np.random.default_rng(letters)
    for n in [*range(1, 40), 200, 500]:
        w = made(rng, n, letters)
        assert periodic.find_runs(w) == plain_runs(w.tolist())
        g = Grammar(w)
        for _ in range(20):
            i, j = sorted(rng.integers(0, n, 2).tolist())
            if i < j:
                k = 0
                while j + k < n and w[i + k] == w[j + k]:
                    k += 1
                b = 0
                while i - b > 0 and w[i - b - 1] == w[j - b - 1]:
                    b += 1
                assert (g.extend(i, j), g.extend(i, j, back=True)) == (k, b)


def plain(doc_id, text):
    words = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, k, p in runs for i in range(s + p, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, int(Fraction(1000 * best[1], best[2])))
    digest = lambda s: sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, digest("".join(f"{s},{k},{p}\n" for s, k, p in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_equals_plain_version(spark, tmp_path):
    """All of a small table, and nulls, empty and repeated rows, a null id and clashing columns."""
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(1, None), (2, ""), (2, ""), (None, "ha " * 50), (3, "\t \n"), (4, "é é é é é é ü ü ü ü ü"), (30, "a b " * 9)]
    out = str(tmp_path)
    spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, starts string").write.parquet(f"{out}/documents.parquet")
    got = sorted((tuple(r) for r in periodic.op11_periodic(spark, out).collect()), key=str)
    assert got == sorted((plain(*r) for r in rows), key=str)


def test_spans_and_long_texts(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "x " + "ab cd " * 200_000 + "y"), (2, "one two three")], "doc_id long, text string")
    a, b = periodic.periodic_runs(df).orderBy("doc_id").collect()
    assert (a.starts, a.lengths, a.periods, a.collapsed) == ([1], [400_000], [2], "x ab cd y")
    assert (b.starts, b.collapsed, b.exponent_milli) == ([], "one two three", None)
    assert periodic.periodic_runs(df.where("false")).count() == 0
