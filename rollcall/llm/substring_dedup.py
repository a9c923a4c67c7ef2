"""Removing repeated passages with a log-structured fingerprint index.

A window is 50 consecutive words. Of the 8-word hashes inside a window the smallest one is its
fingerprint, so equal windows have equal fingerprints, and neighbouring windows mostly share one
(winnowing): a document has about one fingerprint for 20 words. The index keeps which documents have a
fingerprint, in immutable runs that are bucketed and sorted by it. A new batch appends its run, and its
fingerprints are merge-joined with each older run; only documents with a fingerprint that another
document has as well go on. For these, the windows themselves are compared by a 128-bit hash of all their
words, which is the verification: a fingerprint only proposes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import Manifest, bucketed, materialize, mix64, new_path, open_buckets, schema, sliced, text_hash, utf8

WINDOW, GRAM = 50, 8
#: Two odd multipliers; the second hash goes over other word hashes, so both must collide at once.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

PROFILE = "doc_id bigint, key bigint, n_words bigint, body_sha256 string, fingerprints array<bigint>"
CANDIDATES = "h bigint, check bigint, doc_id bigint"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def _word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def rolling(w: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values, by doubling: O(n log width)."""
    n = len(w) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power = np.zeros(n, np.uint64), 0, w
    span, factor = 1, base
    factors = {1: base}
    while done < width:
        if width - done >= 0 and (width & span):
            out = out * factors[span] + power[done : done + n]
            done += span
        if done < width:
            power = power[: len(power) - span] * factor + power[span:]
            span *= 2
            factor = np.uint64(int(factor) ** 2 % 2**64)
            factors[span] = factor
    return out


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    n = len(v) - width + 1
    m, span = v, 1
    while span * 2 <= width:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[width - span : width - span + n])


def window_fingerprints(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Fingerprint of each window of a text's word hashes."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    grams = mix64(rolling(hashes, min(gram, window), BASES[0])) >> np.uint64(1)
    return sliding_min(grams, window - min(gram, window) + 1).view(np.int64)


def window_hashes(words: list[bytes], hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each whole window."""
    return (mix64(rolling(hashes, window, BASES[0])).view(np.int64), mix64(rolling(_word_hashes(words, 1), window, BASES[1])).view(np.int64))


def _profile(window: int):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        of = to_arrow_schema(schema(PROFILE))
        for batch in sliced(batches):
            rows = []
            for doc, body, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = body.as_py().split()
                marks = np.unique(window_fingerprints(_word_hashes(words, 0), window)) if doc is not None else []
                rows.append({"doc_id": doc, "key": key, "n_words": len(words), "body_sha256": hashlib.sha256(b" ".join(words)).hexdigest(), "fingerprints": marks})
            yield pa.RecordBatch.from_pylist(rows, of)

    return run


class FingerprintIndex:
    """Immutable runs of ``fp, doc_id``, bucketed and sorted by ``fp``; the number of buckets is stored with the index.

    The manifest lists the live runs, so a reader sees either the old or the new set. ``compact`` merges all runs
    to one; older files are left for readers that still use them.
    """

    RUN = "fp bigint, doc_id bigint"

    def __init__(self, spark: SparkSession, path: str, max_runs: int = 8, buckets: int | None = None):
        self.spark, self.path, self.max_runs = spark, path, max_runs
        self.manifest = Manifest(spark, path)
        self.buckets = self.manifest.read()[1].get("buckets") or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.refresh()

    def refresh(self) -> None:
        """Look at the newest published state."""
        self.version, state = self.manifest.read()
        self.state = {"runs": [], "buckets": self.buckets} | state

    def runs(self, but: str | None = None) -> list[str]:
        """Paths of the live runs, but that of a batch."""
        return [run["path"] for run in self.state["runs"] if but is None or run["batch"] != but]

    def _publish(self, runs: list[dict]) -> None:
        self.state = self.state | {"runs": runs}
        self.version = self.manifest.publish(self.state, self.version)

    def _open(self, run: str) -> DataFrame:
        return open_buckets(self.spark, run, self.RUN, "fp", self.buckets)

    def append(self, marks: DataFrame, batch: str) -> DataFrame:
        """Add a batch's ``fp, doc_id`` rows as its run, which is returned; compacts the others first when there are too many.

        A run counts from its publication, so what failed before has left nothing; a batch that is there already is found by its name.
        """
        self.refresh()
        for run in self.state["runs"]:
            if run["batch"] == batch:
                return self._open(run["path"])
        if len(self.runs()) >= self.max_runs:
            self.compact()
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        bucketed(marks.select("fp", "doc_id").repartition(self.buckets, "fp"), "fp", run, self.buckets)
        self._publish([*self.state["runs"], {"path": run, "batch": batch}])
        return self._open(run)

    def older(self, fps: DataFrame, batch: str) -> DataFrame | None:
        """Rows of the other batches' runs that have one of the fingerprints: a merge join with each run, which isn't moved."""
        out = None
        for run in self.runs(but=batch):
            rows = self._open(run).join(fps.hint("merge"), "fp", "left_semi")
            out = rows if out is None else out.unionByName(rows)
        return out

    def compact(self) -> None:
        """One run of all; buckets stay what they were, so each is merged on its own."""
        if len(self.runs()) > 1:
            merged = self.spark.read.schema(self.RUN).parquet(*self.runs()).repartition(self.buckets, "fp")
            run = f"{self.path}/run-{uuid.uuid4().hex}"
            bucketed(merged, "fp", run, self.buckets)
            self._publish([{"path": run, "batch": None}])


def _candidates(window: int):
    """Windows whose fingerprint another document has: hashes of each, once for each document."""

    def run(batches):
        for batch in sliced(batches):
            for doc, body, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                words = body.as_py().split()
                hashes = _word_hashes(words, 0)
                at = np.isin(window_fingerprints(hashes, window), np.array(marks.as_py(), np.int64))
                h, check = window_hashes(words, hashes, window)
                both = np.unique(np.stack([h[at], check[at]]), axis=1) if at.any() else np.zeros((2, 0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(np.full(both.shape[1], doc, np.int64))], ["h", "check", "doc_id"])

    return run


def _remove(window: int):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        of = to_arrow_schema(schema(RESULT + ", kept string"))
        for batch in sliced(batches):
            rows = []
            for doc, body, h, check in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = body.as_py().split()
                gone = np.zeros(len(words), bool)
                if h.as_py() and len(words) >= window:
                    a, b = window_hashes(words, _word_hashes(words, 0), window)
                    pairs = set(zip(h.as_py(), check.as_py(), strict=True))
                    hit = np.isin(a, np.array(h.as_py(), np.int64))
                    starts = [i for i in np.flatnonzero(hit) if (int(a[i]), int(b[i])) in pairs]
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, starts, 1)
                    np.add.at(step, np.array(starts, np.int64) + window, -1)
                    gone = np.cumsum(step[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                rows.append({"doc_id": doc.as_py(), "n_words": len(words), "n_removed": int(gone.sum()), "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode()})
            yield pa.RecordBatch.from_pylist(rows, of)

    return run


def remove_repeats(
    docs: DataFrame, index: FingerprintIndex, batch: str, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = True
) -> DataFrame:
    """Remove the words of passages that also start in a document with a smaller id.

    ``docs`` is the new batch, named ``batch``; its fingerprints are appended to ``index``, once, however often it is run. ``history``
    holds the texts of the batches before (same columns), of which only those that the index names are compared, word for
    word by their windows; without it a batch that follows others is refused. Returns
    ``doc_id, n_words, n_removed, kept_sha256`` for each row of the batch, and ``kept`` (the words that
    stay, joined by a space) if asked. Windows are judged on the input. Null texts have no words. Rows
    with a null id neither lose words nor take them from others. Rows that share an id aren't earlier
    than each other. Texts below ``window`` words stay whole. An empty table gives an empty result.
    Other columns are ignored.
    """
    index.refresh()
    if history is None and index.runs(but=batch):
        raise ValueError("the index holds earlier batches: their texts are needed to compare windows")
    keyed = lambda df: df.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("body"), text_hash(text_col).alias("key"))
    rows, row = keyed(docs), ["doc_id", "key"]
    profile = materialize(rows.mapInArrow(_profile(window), schema(PROFILE)), "profile")
    # Of documents with the same words only the first is compared further: the others lose all that it has.
    # Written first, so that the join has plain sides and Spark can split a large group of copies.
    first = materialize(profile.where("doc_id is not null").groupBy("body_sha256").agg(F.min("doc_id").alias("first_id")), "first")
    profile = materialize(profile.join(first, "body_sha256", "left"), "profile")
    copy = F.col("first_id").isNotNull() & (F.col("first_id") < F.col("doc_id")) & (F.col("n_words") >= window)
    leads = profile.where(~F.coalesce(copy, F.lit(False)))
    marks = leads.select(*row, F.explode("fingerprints").alias("fp"))
    own = index.append(marks, batch)
    span = [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")]
    spans, old = own.groupBy("fp").agg(*span), index.older(own.select("fp"), batch)
    if old is not None:
        old = materialize(old, "older")
        spans = spans.unionByName(old.groupBy("fp").agg(*span)).groupBy("fp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    shared = materialize(spans.where("lo < hi").select("fp"), "shared")
    marked = materialize(marks.join(shared, "fp").groupBy(*row).agg(F.collect_set("fp").alias("marks")), "marked")
    texts = materialize(rows.join(marked, row).select("doc_id", "body", "marks"), "texts")
    compared = texts
    if old is not None:
        known = old.join(shared, "fp", "left_semi").groupBy("doc_id").agg(F.collect_set("fp").alias("marks"))
        compared = texts.unionByName(keyed(history).join(known, "doc_id").select("doc_id", "body", "marks"))
    windows = materialize(compared.mapInArrow(_candidates(window), schema(CANDIDATES)), "windows")
    owners = windows.groupBy("h", "check").agg(*span).where("lo < hi")
    hits = windows.join(materialize(owners, "owners"), ["h", "check"]).where("doc_id > lo")
    hits = hits.groupBy("doc_id").agg(F.collect_list(F.struct("h", "check")).alias("hits"))
    done = texts.join(hits, "doc_id", "left").select("doc_id", "body", "hits.h", "hits.check")
    done = done.mapInArrow(_remove(window), schema(RESULT + ", kept string"))
    same = profile.join(marked.select(*row), row, "left_anti") if not keep_text else None
    nothing = hashlib.sha256(b"").hexdigest()
    if keep_text:
        rest = rows.join(marked.select(*row), row, "left_anti").select("doc_id", "body").mapInArrow(_whole(window), schema(RESULT + ", kept string"))
        gone = profile.where(copy).select("doc_id", "body_sha256", "n_words").distinct()
        out = done.unionByName(rest)
        out = out.join(gone.select("doc_id", F.col("body_sha256").alias("kept_sha256"), F.lit(True).alias("gone")), ["doc_id", "kept_sha256"], "left")
        return out.select(
            "doc_id", "n_words", F.when(F.col("gone"), F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
            F.when(F.col("gone"), F.lit(nothing)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
            F.when(F.col("gone"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        )
    same = same.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.col("body_sha256")).alias("kept_sha256"),
    )
    return done.drop("kept").unionByName(same)


def _whole(window: int):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        of = to_arrow_schema(schema(RESULT + ", kept string"))
        for batch in sliced(batches):
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = body.as_py().split()
                kept = b" ".join(words)
                rows.append({"doc_id": doc, "n_words": len(words), "n_removed": 0, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode()})
            yield pa.RecordBatch.from_pylist(rows, of)

    return run


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = FingerprintIndex(spark, new_path(spark, "fingerprint-index"))
    return remove_repeats(docs, index, "documents", keep_text=False)


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
g AS (SELECT doc_id, a, len(a) AS n, unnest(range(1, len(a) - 48)) AS i FROM w WHERE len(a) >= 50),
k AS (SELECT doc_id, i, array_to_string(a[i:i + 49], ' ') AS s FROM g),
o AS (SELECT s, min(doc_id) AS lo FROM k GROUP BY s HAVING min(doc_id) < max(doc_id)),
h AS (SELECT k.doc_id, k.i FROM k JOIN o USING (s) WHERE k.doc_id > o.lo),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM h),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(a) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN a ELSE list_filter(a, lambda x, j: NOT list_contains(ps, j)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""
