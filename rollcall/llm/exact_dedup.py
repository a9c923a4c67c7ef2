"""Exact dedup with a persistent digest index, bucketed and sorted by digest.

The index is a list of runs, one for each batch: Parquet tables in buckets of the digest, sorted inside them. A
batch is reduced to one row per digest (partial aggregation before its shuffle, so large groups of copies cost little),
sort-merge anti-joined with the runs, and what is new becomes its run. A run counts from the moment that the manifest
names it, so a batch that failed halfway has left nothing behind; a batch that is run again finds its own run by
its name and gives the same answer. ``compact`` merges the runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import ASCII_SPACE, Manifest, bucketed, materialize, new_path, open_buckets, schema


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the text without ASCII white space, in lower-case hex; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.translate(F.coalesce(c, F.lit("")), ASCII_SPACE, "").cast("binary"), 256)


class DigestIndex:
    """Digests seen so far: ``digest, keep_id, n_codepoints, batch`` (the batch it came with).

    The manifest beside the data holds the number of buckets, which stays what it was when the index
    was started, and the live runs with the batches that brought them.
    """

    SCHEMA = "digest string, keep_id bigint, n_codepoints bigint, batch string"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, max_runs: int = 16):
        """Open the index at ``path``, or start an empty one with ``buckets`` (the session's shuffle partitions by default)."""
        self.spark, self.path, self.max_runs = spark, path, max_runs
        self.manifest = Manifest(spark, path)
        self.buckets = self.manifest.read()[1].get("buckets") or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.refresh()

    def refresh(self) -> None:
        """Look at the newest published state."""
        self.version, state = self.manifest.read()
        self.state = {"runs": [], "buckets": self.buckets} | state

    def runs(self) -> list[str]:
        return [run["path"] for run in self.state["runs"]]

    def has(self, batch: str) -> bool:
        """Whether a run of this batch is published (and not merged yet)."""
        return any(run["batch"] == batch for run in self.state["runs"])

    def rows(self) -> DataFrame:
        """All rows, by path: a plain scan, so that a join's sides are shuffled and a large group can be split."""
        of = schema(self.SCHEMA)
        return self.spark.read.schema(of).parquet(*self.runs()) if self.runs() else self.spark.createDataFrame([], of)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (with ``digest``) that no run has: a sort-merge anti-join with each one's buckets."""
        for run in self.runs():
            known = open_buckets(self.spark, run, self.SCHEMA, "digest", self.buckets)
            batch = batch.join(known.select("digest").hint("merge"), "digest", "left_anti")
        return batch

    def _write(self, rows: DataFrame) -> str:
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        bucketed(rows.select(*(c.split()[0] for c in self.SCHEMA.split(", "))), "digest", run, self.buckets)
        return run

    def append(self, groups: DataFrame, batch: str) -> None:
        """Publish new digests as the run of ``batch``; ``groups`` has one row per digest. Compacts after ``max_runs``.

        Raises :class:`Conflict` if another batch was published since this index was opened: refresh, and run the batch again.
        """
        run = {"path": self._write(groups.withColumn("batch", F.lit(batch))), "batch": batch}
        self.state = self.state | {"runs": [*self.state["runs"], run]}
        self.version = self.manifest.publish(self.state, self.version)
        if len(self.state["runs"]) > self.max_runs:
            self.compact()

    def compact(self) -> None:
        """One run of all, with one file a bucket; readers of the runs before keep them."""
        run = {"path": self._write(self.rows().repartition(self.buckets, "digest")), "batch": None}
        self.state = self.state | {"runs": [run]}
        self.version = self.manifest.publish(self.state, self.version)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, n_codepoints`` per row."""
    return docs.select(
        F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_codepoints"),
    )


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest: most code points, then the smallest id (null last) is kept."""
    best = F.min(F.struct(-F.col("n_codepoints"), F.col("doc_id").isNull(), "doc_id"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.col1")).alias("n_codepoints"), "group_size"
    )


def add_batch(groups: DataFrame, index: DigestIndex, batch: str) -> None:
    """Append what a batch brings, unless its run is there already."""
    index.refresh()
    if not index.has(batch):
        index.append(index.unseen(groups), batch)


def new_texts(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append a batch to the index; the rows that stay, as ``digest, keep_id, n_codepoints``: one per text that is new to it."""
    add_batch(groups_of(digests(docs, id_col, text_col)), index, batch)
    return index.rows().where(F.col("batch") == batch).drop("batch")


def dedup_batch(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deduplicate a batch against the index and itself, and append what is new.

    ``batch`` names the batch: run again under its name, after a failure or a success, it gives the same rows and adds
    nothing. Returns one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, n_codepoints,
    own_length`` (code points of the group's longest text, and of the row's own). ``group_size``
    counts the equal texts of this batch. A text that an earlier batch brought belongs to that
    batch's row: ``kept`` is false for all of this batch's rows, whatever their ids, and ``keep_id`` is
    the earlier one. Within the batch, of equal texts the row with the most code points, then the
    smallest id stays. Null text counts as empty. If several rows share the winner's id and text, all
    of them have ``kept`` true (they cannot be told apart); null ids order last. Empty tables give
    empty results; other columns are ignored.
    """
    rows = materialize(digests(docs, id_col, text_col), "digests")
    groups = materialize(groups_of(rows), "digest-groups")
    add_batch(groups, index, batch)
    known = index.rows().join(groups.select("digest", "group_size"), "digest")
    joined = rows.withColumnRenamed("n_codepoints", "own_length").join(materialize(known, "digests-known"), "digest")
    kept = (F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("own_length") == F.col("n_codepoints"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"), "n_codepoints", "own_length")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = DigestIndex(spark, new_path(spark, "digest-index"))
    return dedup_batch(docs, index, "documents").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
d AS (SELECT doc_id, length(x) AS n, sha256(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS h FROM t)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""
