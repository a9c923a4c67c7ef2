"""A corpus pipeline: quality filter, exact dedup, near dedup, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm import bpe, exact_dedup, mixing, near_dedup, quality
from rollcall.llm.common import materialize, new_path, ship, text_hash


def _keyed(docs: DataFrame, **keys) -> DataFrame:
    """Rows of ``docs`` as one column, ``doc``, beside key columns that are never null: so no names clash."""
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("doc"), *(c.alias(k) for k, c in keys.items()))


def _key(c: str) -> Column:
    """A column as text that is never null; null and a text that looks like it stay apart."""
    return F.coalesce(F.concat(F.lit("k"), F.col(c).cast("string")), F.lit(""))


def _taken(keyed: DataFrame, stays: DataFrame, keys: list[str]) -> DataFrame:
    """Documents as often as ``stays`` says: per key, ``copies`` lists how often each of the rows with the key is taken.

    The texts are shuffled once, by a key that differs between copies of a text, so that a large group of
    copies is dealt out; the plan is the same at every size.
    """
    joined = keyed.join(stays.hint("merge"), keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    times = F.coalesce(F.get("copies", nth - 1), F.lit(0))
    rows = joined.withColumn("times", times).where("times > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("doc.*")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Equal rows share a verdict and all stay or go.

    Null and empty texts are accepted. Null ids and repeated ids are judged by their own texts. No text is shuffled.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted_documents(docs, quality.trusted_labels(labels), quality.toxic_labels(labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one of the smallest id (null last)."""
    ship(spark)
    index = exact_dedup.DigestIndex(spark, new_path(spark, "digest-index"))
    best = exact_dedup.new_texts(docs, index, "documents").withColumnRenamed("keep_id", "doc_id")
    keys = {"id": _key("doc_id"), "digest": exact_dedup.text_digest("text"), "length": F.length(F.coalesce("text", F.lit(""))).cast("long")}
    best = best.select(_key("doc_id").alias("id"), "digest", F.col("n_codepoints").alias("length"), F.array(F.lit(1)).alias("copies"))
    return _taken(_keyed(docs, **keys), best, list(keys))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word Jaccard 0.8 or more): the one of the smallest id (null last)."""
    ship(spark)
    found = near_dedup.similar(docs)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    best = materialize(found.groupBy("root").agg(best.alias("best")), "best").select("best.doc_id", "best.text_hash")
    best = best.select(_key("doc_id").alias("id"), "text_hash", F.array(F.lit(1)).alias("copies"))
    return _taken(_keyed(docs, id=_key("doc_id"), text_hash=text_hash("text")), best, ["id", "text_hash"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands as often as the mix takes it; rows that share id, source and text take turns."""
    ship(spark)
    keys = ["id", "from", "text_hash"]
    copies = mixing.mix(docs).select(_key("doc_id").alias("id"), _key("source").alias("from"), "text_hash", "copies")
    stays = copies.groupBy(*keys).agg(F.reverse(F.sort_array(F.collect_list("copies"))).alias("copies")).where("copies[0] > 0")
    return _taken(_keyed(docs, **{"id": _key("doc_id"), "from": _key("source"), "text_hash": text_hash("text")}), stays, keys)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and hashes of ids and decoded bytes."""
    import public_tokenizers

    ship(spark)
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, vocabulary, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact),
    ("simhash near dedup", near),
    ("mix to target weights", mix),
    ("byte-level bpe", tokenise),
]

#: SQL can't express the model, the fingerprints and the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
