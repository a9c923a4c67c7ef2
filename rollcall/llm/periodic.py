"""Runs of repeated words: harmonic-grid candidates, extended exactly by a grammar's longest common extensions.

A run of period p and at least four periods repeats itself over three of them, so for some multiple g of p the words
[g, g + 2p) equal those p further on. All such (g, p) are a harmonic series, n ln n in number. They are
looked at in ranges of periods from P to 2P, where no period is a multiple of another: what lies in a run that is
already known has only multiples of its period left and is passed over; of the others a few words are
compared, and what agrees is extended both ways by the grammar (:mod:`recompression`). A text without candidates needs
no grammar.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import schema, sliced, utf8
from rollcall.llm.recompression import Grammar

#: The least number of words and of periods of a run; the grid of candidates follows from four periods.
LENGTH, POWER = 6, 4
#: Grid points looked at together.
GRID = 1 << 20

FOUND = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "starts array<long>, lengths array<long>, periods array<long>, collapsed string"
)


def grid(w: np.ndarray, low: int, high: int, far: np.ndarray):
    """Candidates (g, p) with low <= p < high, by p and g, in arrays of bounded size."""
    n = len(w)
    periods = np.arange(low, high)
    counts = n // periods - 2  # g + 3p <= n
    at = 0
    while at < len(periods):
        end = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), GRID, "right")) + at)
        c = counts[at:end]
        p = np.repeat(periods[at:end], c)
        g = (np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)) * p
        for a, b in ((0, 0), (1, 0), (1, -1), (2, -1)):  # offset in periods, and in words; each equals the word one period on
            i = g + a * p + b
            same = w[i] == w[i + p]
            g, p = g[same], p[same]
        unknown = far[g] < g + 3 * p
        yield g[unknown], p[unknown]
        at = end


def find_runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start and period."""
    n, found, grammar = len(w), [], None
    far = np.zeros(n, np.int64)  # how far the known runs that start here or before reach
    low = 1
    while low <= n // POWER:
        fresh = len(found)
        for gs, ps in grid(w, low, min(2 * low, n // POWER + 1), far):
            period = end = 0
            for g, p in zip(gs.tolist(), ps.tolist(), strict=True):
                if p == period and g + 3 * p <= end:
                    continue  # inside the run just found
                grammar = grammar or Grammar(w)
                ahead = grammar.extend(g, g + p)
                if ahead < 2 * p:
                    continue  # the compared words agreed, but not all of [g, g + 2p)
                start, stop = g - grammar.extend(g, g + p, back=True), g + p + ahead
                if stop - start >= max(LENGTH, POWER * p):
                    found.append((start, stop - start, p))
                    period, end = p, stop
        if len(found) > fresh:
            for start, length, _ in found[fresh:]:
                far[start] = max(far[start], start + length)
            far = np.maximum.accumulate(far)
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """Which original word stands at each place: for a tenth of ids, the words from some place on repeat."""
    place = np.arange(n)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        place[a:] = a + (place[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return place


def examine(doc_id: int | None, body: bytes, plant: bool, emit: bool) -> tuple:
    words = body.split()
    number: dict[bytes, int] = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    place = planted(doc_id, len(words)) if plant else np.arange(len(words))
    w = w[place]
    runs = find_runs(w)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    text = b" ".join([words[i] for i in place[keep].tolist()])
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    columns = [[r[k] for r in runs] for k in range(3)] if emit else [None] * 3
    return (doc_id, len(words), len(runs), *top, sha256(listed.encode()).hexdigest(), sha256(text).hexdigest(), *columns, text.decode() if emit else None)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, emit: bool = True) -> DataFrame:
    """The runs of each whole text, the greatest one, and the text with each run cut to its first period.

    A run is a stretch of consecutive words with smallest period q, at least ``LENGTH`` words and ``POWER`` periods long, that
    no neighbouring word extends. ``starts, lengths, periods`` list them by start, then period; ``start, length, period,
    exponent_milli`` is the one of greatest length/period (ties: smallest start, then period; null without runs);
    ``collapsed`` has the words that stay, joined by one space. ``emit`` false leaves lists and text null and keeps their
    hashes. ``plant`` makes the end of a tenth of the texts periodic first, to measure recall. Null and empty texts have no words and
    no runs. Rows may share an id or have none; each row is examined where it lies, nothing is shuffled. An empty table
    gives an empty result; other columns are ignored.
    """
    of = schema(FOUND)
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 3 + [pa.string()]

    def run(batches):
        for batch in sliced(batches, 100):
            rows = [examine(i.as_py(), b.as_py(), plant, emit) for i, b in zip(*batch.columns, strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], of.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("body")).mapInArrow(run, of)


def op11_periodic(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs, plant=True, emit=False)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
