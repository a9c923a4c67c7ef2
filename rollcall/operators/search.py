"""Text search in dimensions by trigram postings, and facts found by the keys that it gives.

A text of three letters or more is looked up by its trigrams: a row that holds the text has all of them, so the postings of
a few trigrams leave few rows to be looked at. Shorter texts are looked for in the dimension itself. Facts are joined with the keys that
were found; their names are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = 3


def grams(text: Column) -> Column:
    """Distinct trigrams of a text in lower case; none of one that is shorter."""
    low = F.lower(text)
    ends = F.sequence(F.lit(1), F.length(low) - (N - 1))
    return F.when(F.length(low) >= N, F.array_distinct(F.transform(ends, lambda i: F.substr(low, i, F.lit(N))))).otherwise(F.array().cast("array<string>"))


def postings(dim: DataFrame, key: str, *fields: str) -> DataFrame:
    """``gram, field, key`` of the dimension's texts, sorted by trigram over the files; a trigram that most texts have may fill several.

    The dimension is dealt out first: its file is often a single split, and a row becomes many.
    """
    texts = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields))
    rows = dim.repartition(key).select(F.col(key).alias("key"), F.inline(texts)).select(F.explode(grams(F.col("text"))).alias("gram"), "field", "key")
    return rows.repartitionByRange("gram", "field", "key").sortWithinPartitions("gram", "field", "key")


def find(index: DataFrame, dim: DataFrame, key: str, text: str, *fields: str) -> DataFrame:
    """Keys of the dimension's rows of which a field holds the text, case ignored."""
    low = text.lower()
    holds = F.lit(False)
    for f in fields:
        holds = holds | F.coalesce(F.contains(F.lower(F.col(f).cast("string")), F.lit(low)), F.lit(False))
    rows = dim
    if len(low) >= N:
        wanted = sorted({low[i : i + N] for i in range(len(low) - N + 1)})
        hits = index.where(F.col("gram").isin(wanted) & F.col("field").isin(list(fields))).groupBy("field", "key").agg(F.count("*").alias("n"))
        rows = dim.join(hits.where(F.col("n") == len(wanted)).select(F.col("key").alias(key)).distinct(), key, "left_semi")
    return rows.where(holds).select(key).distinct()


def facts_of(fact: DataFrame, employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Facts of any of the employees (``pegawai_key``) or of any of the departments (``departemen_key, departemen_id``)."""
    e = employees.select("pegawai_key", F.lit(True).alias("_e"))
    d = departments.select(F.col("departemen_key").alias("_key"), F.col("departemen_id").alias("_id"), F.lit(True).alias("_d")).distinct()
    unit = (F.col("departemen_key") == F.col("_key")) & F.col("departemen_id").eqNullSafe(F.col("_id"))
    both = fact.join(e, "pegawai_key", "left").join(d, unit, "left")
    return both.where("_e or _d").select(*fact.columns)


def search_facts(t, text: str) -> DataFrame:
    """Facts whose employee's or department's name or number holds the text. ``t`` has fact, people, both dimensions and their postings."""
    employees = find(t.grams_pegawai, t.dim_pegawai, "key", text, "name", "source_id").withColumnRenamed("key", "pegawai_key")
    named = find(t.grams_departemen, t.dim_departemen, "key", text, "name").withColumnRenamed("key", "departemen_key")
    units = t.people.select("departemen_key", "departemen_id").distinct()
    numbered = units.where(F.contains(F.col("departemen_id").cast("string"), F.lit(text)))
    return facts_of(t.fact, employees, units.join(named, "departemen_key", "left_semi").unionByName(numbered))
