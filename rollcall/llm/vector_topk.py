"""Exact top-k search: tiled matrix products, partial selection and tree merging.

Candidates are packed into shards and queries into tiles, each a matrix of bounded size. Every tile
meets every shard once, as a row of its own; the product's best k of each query are selected inside
the task, and the lists of a tile are merged in a tree of bounded fan-in. Work and rows are those of
the stated product (queries x candidates), in blocks; no row for a single pair is made.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize, schema

SHARD, TILE, FAN_IN = 16_384, 2_048, 16

PACKED = "part long, ids binary, vectors binary, width int"
LISTS = "tile long, part long, ids binary, found binary, scores binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one part to one row, by id. Shorter vectors are filled up with zeros."""
    pdf = pdf.sort_values("vec_id", kind="mergesort")
    width = int(pdf["x"].map(len).max())
    m = np.zeros((len(pdf), width))
    for i, v in enumerate(pdf["x"]):
        m[i, : len(v)] = v
    return pd.DataFrame([(int(pdf["part"].iloc[0]), pdf["vec_id"].to_numpy(np.int64).tobytes(), m.tobytes(), width)], columns=["part", "ids", "vectors", "width"])


def _matrix(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.float64).reshape(len(i), width) if width else np.zeros((len(i), 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first, ties to the smaller id; columns are in the order of ids."""
    n = scores.shape[1]
    if n > k:
        # All above the k-th score, then those equal to it with the smallest ids, which come first.
        kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
        above = scores > kth
        equal = scores == kth
        need = k - above.sum(axis=1, keepdims=True)
        take = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= need))
        cols = np.nonzero(take)[1].reshape(-1, k)
    else:
        cols = np.broadcast_to(np.arange(n), (len(scores), n))
    s = np.take_along_axis(scores, cols, axis=1)
    order = np.lexsort((cols, -s), axis=1)
    cols = np.take_along_axis(cols, order, axis=1)
    return (ids[cols] if ids.ndim == 1 else np.take_along_axis(ids, cols, axis=1)), np.take_along_axis(s, order, axis=1)


GONE = np.int64(-(2**62))


def _search(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.itertuples():
                qi, q = _matrix(r.q_ids, r.q_vectors, r.q_width)
                ci, c = _matrix(r.ids, r.vectors, r.width)
                w = min(q.shape[1], c.shape[1])
                found, scores = [], []
                for a in range(0, len(qi), 128):  # the product is made in slices of bounded size
                    s = (q[a : a + 128, :w] @ c[:, :w].T).astype(np.int64)
                    s[qi[a : a + 128, None] == ci[None, :]] = GONE
                    f, t = best(s, ci, k)
                    found.append(f)
                    scores.append(t)
                f, t = np.concatenate(found), np.concatenate(scores)
                yield pd.DataFrame([(r.tile, r.part, r.q_ids, f.tobytes(), t.tobytes())], columns=["tile", "part", "ids", "found", "scores"])

    return run


def _merge(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["ids"].iloc[0]
        n = len(ids) // 8
        found = np.concatenate([np.frombuffer(x, np.int64).reshape(n, -1) for x in pdf["found"]], axis=1)
        scores = np.concatenate([np.frombuffer(x, np.int64).reshape(n, -1) for x in pdf["scores"]], axis=1)
        by_id = np.argsort(found, axis=1, kind="stable")
        f, s = best(np.take_along_axis(scores, by_id, axis=1), np.take_along_axis(found, by_id, axis=1), k)
        return pd.DataFrame([(int(pdf["tile"].iloc[0]), int(pdf["part"].iloc[0]), ids, f.tobytes(), s.tobytes())], columns=["tile", "part", "ids", "found", "scores"])

    return run


def _unpack(batches):
    for batch in batches:
        for r in batch.itertuples():
            ids = np.frombuffer(r.ids, np.int64)
            found = np.frombuffer(r.found, np.int64).reshape(len(ids), -1)
            scores = np.frombuffer(r.scores, np.int64).reshape(len(ids), -1)
            rank = np.broadcast_to(np.arange(1, found.shape[1] + 1, dtype=np.int32), found.shape)
            real = scores != GONE
            yield pd.DataFrame({"query_id": np.broadcast_to(ids[:, None], found.shape)[real], "rank": rank[real], "vec_id": found[real], "score": scores[real]})


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, shard: int = SHARD, tile: int = TILE
) -> DataFrame:
    """Each query's ``k`` best vectors by the inner product of floor(scale * x): ``query_id, rank, vec_id, score``.

    ``vectors`` and ``queries`` have the same two columns. Scores are exact while they stay below
    2^53. Ties go to the smaller id; fewer candidates give fewer rows. A candidate with the query's
    own id is never returned; of rows that repeat an id each one is a candidate. Vectors that are
    null or hold a null or non-finite component, and rows without id, take no part; of vectors of
    different lengths the shorter one counts as filled up with zeros. Empty tables give empty
    results. Other columns are ignored.
    """
    def clean(df: DataFrame) -> DataFrame:
        x = F.transform(F.col(vector_col), lambda v: F.floor(v.cast("double") * scale).cast("double"))
        good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(
            F.col(vector_col), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
        )
        return df.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))

    def parts(df: DataFrame, size: int, tag: str) -> tuple[DataFrame, int]:
        n = max(1, math.ceil(df.count() / size))
        dealt = df.withColumn("part", F.pmod(F.xxhash64(F.struct("vec_id", "x")), F.lit(n)))
        return materialize(dealt.groupBy("part").applyInPandas(_pack, schema(PACKED)), tag), n

    shards, n_shards = parts(clean(vectors), shard, "shards")
    tiles, _ = parts(clean(queries), tile, "tiles")
    # Each tile goes to every shard; joined on the shard, so that neither side is broadcast.
    sent = tiles.select(
        F.col("part").alias("tile"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("width").alias("q_width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("part"),
    )
    met = sent.join(shards.hint("shuffle_hash"), "part").repartition(max(1, 2 * n_shards), "part", "tile")
    lists = materialize(met.mapInPandas(_search(k), schema(LISTS)), "lists")
    while n_shards > 1:
        n_shards = math.ceil(n_shards / FAN_IN)
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN))
        lists = lists.groupBy("tile", "part").applyInPandas(_merge(k), schema(LISTS))
        if n_shards > 1:
            lists = materialize(lists, "lists")
    return lists.mapInPandas(_unpack, schema(RESULT))


def op7_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
