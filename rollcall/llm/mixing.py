"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; every document of it the same expected number of
copies, target / source size. The whole part is certain; the fractional part is rounded by the
pivotal method: two sides with fractional expectations meet, word mass moves between them in a
random direction until one expectation is 0 or 1, and the other one goes on. Directions are drawn
so that every expectation is kept (a martingale); what moves is words, so a source's taken words
equal its target except for its last, single unresolved document. The meetings form a reduction
tree: documents are dealt to bounded groups within their source, each group leaves one unresolved
document at most, and these meet again one level higher until one group per source is left. Documents
meet in pairs, from the largest to the smallest, so that large ones are settled while there are words to settle them with.
Where a large one stays open all the same, the group's meetings are drawn again, some times, and the draw that leaves the least open
counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import WORD, materialize, text_hash

WEIGHTS = (1.0, 2.0, 3.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Sources by code point, null last, get ``weights`` in turn and share the total by them. A target
    stops at ``cap`` times its source's size and the excess is shared again by weight: that fixed
    point is min(cap * size, level * weight). Sorted by cap * size / weight, the capped sources are
    a prefix, so running sums give the level. Input to the windows is one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (k + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * float(cap))
    per = per.withColumn("ratio", F.col("most") / F.col("weight"))
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    # What all would take if the level were this source's ratio: those before it stop at their caps.
    per = (
        per.withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("weight_after", F.sum("weight").over(whole) - F.sum("weight").over(upto))
        .withColumn("most_upto", F.sum("most").over(upto))
        .withColumn("capped", F.col("most_upto") + F.col("ratio") * F.col("weight_after") <= F.col("total"))
    )
    per = per.withColumn("left", F.col("total") - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(whole))
    per = per.withColumn("open_weight", F.sum(F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("weight"))).over(whole))
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("left") * F.col("weight") / F.col("open_weight"))
    return per.select("source", "source_size", "weight", F.least(target, F.col("most")).alias("target"))


def _uniform(seed: int, row: np.ndarray, level: int) -> np.ndarray:
    from rollcall.llm.common import mix64

    x = mix64(mix64(row.view(np.uint64) + np.uint64(seed)) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64))
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivot(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Resolve all of ``p`` but one at most: results in {0, 1}, the unresolved one in (0, 1).

    Sizes are positive. Sum of p * size stays; every p keeps its expectation.
    """
    p = p.astype(float).copy()
    eps = 1e-12
    at = -1
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = round(p[i])
            continue
        if at < 0:
            at = i
            continue
        a, b = size[at], size[i]
        up = min((1 - p[at]) * a, p[i] * b)  # words that can move to ``at``
        down = min(p[at] * a, (1 - p[i]) * b)  # words that can move from it
        moved = up if u[i] * (up + down) < down else -down
        full_at = abs(moved - (1 - p[at]) * a) <= eps * a if moved > 0 else abs(-moved - p[at] * a) <= eps * a
        p[at] += moved / a
        p[i] -= moved / b
        if full_at:
            p[at] = round(p[at])
            at = i
            if p[at] <= eps or p[at] >= 1 - eps:
                p[at] = round(p[at])
                at = -1
        else:
            p[i] = round(p[i])
    return p


#: Draws of a group's meetings, and the share of its words that may stay open without another draw.
DRAWS, OPEN = 32, 0.001


def settle(size: np.ndarray, p: np.ndarray, row: np.ndarray, seed: int, level: int) -> np.ndarray:
    """:func:`pivot` over one group, sizes descending: the first draw that leaves little open, else the one that leaves least."""
    best, least = p, np.inf
    for draw in range(DRAWS):
        out = pivot(size, p, _uniform(seed + 7919 * draw, row, level))
        left = (np.minimum(out, 1 - out) * size).sum()
        if left < least:
            best, least = out, left
        if least <= OPEN * size.sum():
            break
    return best


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    cap: float = 3.0,
    seed: int = 17,
    group_rows: int = 4096,
    fan_in: int = 256,
) -> DataFrame:
    """Decide how many copies of each document the mix takes.

    Returns one row per input row: ``doc_id, source, size, source_size, target, copies, taken, text_hash``.
    A document's copies are at most ``ceil(cap)``. Null texts have no words; null sources are one
    source; null ids are allowed. Documents without words take floor or ceil of their expectation,
    at random. Equal rows are drawn apart only by order, which does not change the result. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    n_words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    sizes = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words.alias("size"), text_hash(text_col).alias("text_hash")), "sizes"
    )
    targets = source_targets(sizes, weights, cap).withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    counts = sizes.groupBy("source").agg(F.count("*").alias("n"))
    targets = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).drop(counts["source"])
    targets = targets.withColumn("groups", F.ceil(F.col("n") / group_rows).cast("long"))
    most = targets.agg(F.max("groups")).first()[0]
    draw = F.xxhash64("doc_id", "source", "size", "text_hash", F.lit(seed))
    rows = sizes.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.join(targets.drop("source"), "key").select(
        "doc_id", "source", "size", "source_size", "target", draw.alias("row"), F.floor(rate).alias("whole"),
        (rate - F.floor(rate)).alias("p"), (F.pmod(F.xxhash64(draw), F.col("groups"))).alias("g"), "key", "text_hash",
    )
    done = rows.sparkSession.createDataFrame([], rows.schema)
    level = 0
    while True:
        rows = materialize(_round_level(rows, level, seed), f"mix{level}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done = done.unionByName(rows.where(~open_))
        if (most or 0) <= 1:
            break
        most = math.ceil(most / fan_in)
        rows = rows.where(open_).withColumn("g", F.floor(F.col("g") / fan_in))
        level += 1
    last = rows.where(open_).withColumn("p", F.when(_unit(F.col("row"), seed) < F.col("p"), 1.0).otherwise(0.0))
    copies = (F.col("whole") + F.col("p")).cast("long")
    return done.unionByName(last).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "text_hash",
    )


def _unit(c: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(seed), F.lit("last")), F.lit(1 << 30)) / float(1 << 30)


def _round_level(rows: DataFrame, level: int, seed: int) -> DataFrame:
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "row"], ascending=[False, True], kind="mergesort").reset_index(drop=True)
        size, p = pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(np.float64)
        row = pdf["row"].to_numpy(np.int64)
        u = _uniform(seed, row, level)
        with_words = size > 0
        p = p.copy()
        p[~with_words] = (u[~with_words] < p[~with_words]).astype(float)
        p[with_words] = settle(size[with_words], p[with_words], row[with_words], seed, level)
        pdf["p"] = p
        return pdf

    # One column names the group: rows dealt by source for a join must be dealt anew.
    dealt = rows.withColumn("dealt", F.concat_ws("#", F.col("g").cast("string"), "key"))
    return dealt.groupBy("dealt").applyInPandas(lambda pdf: meet(pdf.drop(columns="dealt")), rows.schema)


def op1_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
