"""Merkle manifest of a dataset: a postorder append log written by aligned builders.

A tree has a fan-out of three: at each level, every three consecutive nodes (the last run: fewer, even
one) become their hash, until one is left. Builders are aligned: each takes a block of ``3**LEVELS``
consecutive leaves, so every node below the block's root is its own, and writes the nodes in the order
in which they are completed. Where a node stands in such a log follows from its last leaf ``e`` alone:
the subtrees finished before it hold ``e + e//3 + e//9 + ...`` nodes, and below it ``level`` more end at
the same leaf. So siblings are read from the log by computed positions, without an index and without
rebuilding anything. The block roots are the leaves of the next band of blocks, and so on; each band is
3**LEVELS times smaller. The documents of a source form a tree, and the roots of the sources another.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import materialize, schema

FAN_OUT, LEVELS = 3, 5
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "tree string, block long, blocks long, size int, height int, root string, log binary, ids array<long>, shown binary"
PATHS = "tree string, block long, path binary, subroot string, root string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    """SHA-256 of a document's fields; ``text`` stands in for the text."""
    parts = [field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered_text() -> Column:
    """What a tampered copy shows: every text without line ends where 2 divides the id's CRC-32."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))


def digest(run: list[bytes]) -> bytes:
    """The hash of consecutive nodes, concatenated as hexadecimal text."""
    return sha256("".join(x.hex() for x in run).encode()).digest()


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN_OUT), h + 1
    return h


def position(level: int, index: int, size: int, height: int) -> int:
    """Where node ``index`` of ``level`` stands in the log of a block of ``size`` leaves."""
    last = min((index + 1) * FAN_OUT**level, size) - 1
    return level + sum(last // FAN_OUT**j for j in range(height + 1))


def postorder(leaves: list[bytes], height: int) -> bytes:
    """All nodes over the leaves in the order of completion; with one child a node still is a hash of it."""
    levels = [leaves]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest(below[i : i + FAN_OUT]) for i in range(0, len(below), FAN_OUT)])
    out = []
    for e in range(len(leaves)):
        for level, nodes in enumerate(levels):
            if level and (e + 1) % FAN_OUT**level and e + 1 < len(leaves):
                break
            out.append(nodes[e // FAN_OUT**level])
    return b"".join(out)


def path_of(log: bytes, rank: int, size: int, height: int) -> bytes:
    """Per level: the node's place in its run, the number of siblings, and the siblings, left to right."""
    out, count = [], size
    for level in range(height):
        start = rank - rank % FAN_OUT
        others = [i for i in range(start, min(start + FAN_OUT, count)) if i != rank]
        out.append(bytes((rank - start, len(others))))
        out.extend(log[32 * p : 32 * p + 32] for p in (position(level, i, size, height) for i in others))
        rank, count = rank // FAN_OUT, -(-count // FAN_OUT)
    return b"".join(out)


def steps(path: bytes):
    """A path's levels: place in the run and siblings."""
    at = 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        yield place, [path[at + 2 + 32 * k : at + 34 + 32 * k] for k in range(n)]
        at += 2 + 32 * n


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for place, others in steps(path):
        leaf = digest([*others[:place], leaf, *others[place:]])
    return leaf


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """An aligned block of a tree's nodes to its segment of the log."""
    pdf = pdf.sort_values("rank")
    n, size = int(pdf["n"].iloc[0]), len(pdf)
    height = LEVELS if n > FAN_OUT**LEVELS else height_of(n)
    log = postorder([bytes.fromhex(x) for x in pdf["node"]], height)
    ids = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
    shown = b"".join(bytes.fromhex(x) for x in pdf["shown"] if x)
    row = (pdf["tree"].iloc[0], int(pdf["block"].iloc[0]), -(-n // FAN_OUT**LEVELS), size, height, log[-32:].hex(), log, ids, shown)
    return pd.DataFrame([row], columns=["tree", "block", "blocks", "size", "height", "root", "log", "ids", "shown"])


def _descend(batches):
    """Segments with the paths of their roots to the paths of the nodes that they were built on."""
    for batch in batches:
        for r in batch.itertuples():
            first = r.block * FAN_OUT**LEVELS
            paths = [path_of(r.log, i, r.size, r.height) + r.path for i in range(r.size)]
            yield pd.DataFrame({"tree": r.tree, "block": range(first, first + r.size), "path": paths, "subroot": r.subroot, "top": r.top}).rename(columns={"top": "root"})


def _prove(batches):
    """Leaf segments with the paths of their roots to one row a document."""
    for batch in batches:
        for r in batch.itertuples():
            rows = []
            for i, doc_id in enumerate(r.ids):
                path = path_of(r.log, i, r.size, r.height) + r.path
                at = 32 * position(0, i, r.size, r.height)
                siblings = "".join(x.hex() for _, others in steps(path) for x in others)
                folded = fold(r.shown[32 * i : 32 * i + 32], path).hex()
                rows.append((doc_id, r.log[at : at + 32].hex(), r.subroot, r.top, sha256(siblings.encode()).hexdigest(), folded, folded == r.top))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PROOFS.split(", ")])
            yield out.astype({"doc_id": "Int64"})


def ranked(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``rank`` within ``tree`` and the tree's ``n``.

    Rows are sorted by ranges, so a tree of a third of all rows lies in many partitions; ranks follow from
    the counts of trees in partitions, of which there are no more than partitions and trees together.
    """
    sort = ["tree", *order]
    rows = rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("at", F.monotonically_increasing_id())
    rows = materialize(rows, tag).withColumn("part", F.shiftright("at", 33))
    runs = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    tree = Window.partitionBy("tree")
    before = F.sum("c").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("c").over(tree).alias("n"))
    return rows.join(runs, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def bands(nodes: DataFrame, tag: str) -> list[DataFrame]:
    """The log of each band over ``tree, rank, n, node`` (and ``doc_id, shown``), the last one with one segment a tree."""
    out = []
    while True:
        block = F.floor(F.col("rank") / FAN_OUT**LEVELS).alias("block")
        mine = nodes.select("tree", block, "rank", "n", "node", "doc_id", "shown")
        out.append(materialize(mine.groupBy("tree", "block").applyInPandas(_build, schema(SEGMENT)), tag))
        if not out[-1].where("blocks > 1").limit(1).count():
            return out
        none = {"doc_id": F.lit(None).cast("long"), "shown": F.lit(None).cast("string")}
        nodes = out[-1].select("tree", F.col("block").alias("rank"), F.col("blocks").alias("n"), F.col("root").alias("node")).withColumns(none)


def descend(log: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of the first band's segments from those of the last band's: ``tree, block, path, subroot, root``."""
    for band in reversed(log[1:]):
        met = band.join(above.withColumnRenamed("root", "top"), ["tree", "block"])
        above = met.mapInPandas(_descend, schema(PATHS))
    return above


class MerkleLog:
    """The written log of a dataset: ``sources`` (bands of all sources' trees) and ``dataset`` (bands over their roots)."""

    def __init__(self, docs: DataFrame):
        """Build the log of ``docs``, which has ``doc_id, source, lang, n_chars, text``; other columns are ignored."""
        tree = F.coalesce(F.concat(F.lit("k"), F.col("source")), F.lit(""))  # null comes first
        leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("node"), leaf_hash(tampered_text()).alias("shown"))
        leaves = materialize(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
        self.sources = bands(ranked(leaves, ["doc_id", "node", "row"], "merkle-ranked"), "merkle-log")
        none = (F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("shown"))
        roots = self.sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"), *none)
        self.roots = materialize(ranked(roots, ["name"], "merkle-roots"), "merkle-roots")
        self.dataset = bands(self.roots, "merkle-dataset")

    def source_paths(self) -> DataFrame:
        """Each source's path to the dataset's root, in the form of the paths of its one last segment."""
        top = self.dataset[-1].select("tree", "block", F.lit(b"").alias("path"), F.lit("").alias("subroot"), "root")
        met = self.dataset[0].join(descend(self.dataset, top).withColumnRenamed("root", "top"), ["tree", "block"])
        paths = met.mapInPandas(_descend, schema(PATHS)).select(F.col("block").alias("rank"), "path", "root")
        named = self.roots.select("rank", F.col("name").alias("tree"), F.col("node").alias("subroot"))
        return named.join(paths, "rank").select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")

    def proofs(self) -> DataFrame:
        """One row a document: its leaf, roots, the hash of its proof, and what its shown copy folds to."""
        above = descend(self.sources, self.source_paths()).withColumnRenamed("root", "top")
        return self.sources[0].join(above, ["tree", "block"]).mapInPandas(_prove, schema(PROOFS))


def manifest(docs: DataFrame) -> DataFrame:
    """Every document's ``leaf, subroot, root, proof_sha256, folded_root, verified`` beside its ``doc_id``.

    ``folded_root`` is what the leaf of the copy that is shown (:func:`tampered_text`) and the original's
    siblings give; ``verified`` says that this is the root. Documents of a source are in the order of their ids,
    null first; of rows that share an id the one with the smaller leaf comes first, and equal rows follow each
    other. Any field may be null. Texts of any length are hashed whole. An empty table gives an empty result;
    columns beyond the five fields are ignored, whatever their names.
    """
    return MerkleLog(docs).proofs()


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql(levels: int = 16) -> str:
    """Levels one by one; ``levels`` suffice for 3**levels documents of a source."""
    field = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    step = "list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    odd = f"list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}) & 1"  # the last complement turns the lowest bit
    ctes = [
        f"""l0 AS MATERIALIZED (SELECT doc_id, source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, shown FROM (
            SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN ({odd}) = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS shown FROM documents))""",
        "a0 AS MATERIALIZED (SELECT tree, i, leaf AS h FROM l0)",
        "p0 AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, tree, i, leaf, shown AS folded, '' AS proof FROM l0)",
    ]

    def climb(nodes: str, rows: str, k: int) -> None:
        """One level: runs of three become their hash while a tree has several nodes."""
        ctes.append(f"n{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})")
        ctes.append(
            f"""p{k + 1} AS MATERIALIZED (SELECT p.r, any_value(p.doc_id) AS doc_id, p.tree, any_value(CASE WHEN s.n > 1 THEN p.i // 3 ELSE p.i END) AS i, any_value(p.leaf) AS leaf,
                CASE WHEN any_value(s.n) > 1 THEN sha256(string_agg(CASE WHEN s.i = p.i THEN p.folded ELSE s.h END, '' ORDER BY s.i)) ELSE any_value(p.folded) END AS folded,
                any_value(p.proof) || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> p.i), '') AS proof
                FROM {rows} p JOIN n{k} s ON s.tree IS NOT DISTINCT FROM p.tree AND s.i // 3 = p.i // 3 GROUP BY p.r, p.tree)"""
        )
        ctes.append(f"a{k + 1} AS MATERIALIZED (SELECT tree, i // 3 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM n{k} GROUP BY tree, i // 3)")

    for k in range(levels):
        climb(f"a{k}", f"p{k}", k)
    ctes.append(f"roots AS MATERIALIZED (SELECT tree AS source, h AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i FROM a{levels})")
    ctes.append(f"a{levels + 1} AS MATERIALIZED (SELECT 0 AS tree, i, subroot AS h FROM roots)")
    ctes.append(
        f"""p{levels + 1} AS MATERIALIZED (SELECT p.r, doc_id, 0 AS tree, s.i, {{'leaf': leaf, 'subroot': subroot}} AS leaf, folded, proof
            FROM p{levels} p JOIN roots s ON s.source IS NOT DISTINCT FROM p.tree)"""
    )
    for k in range(levels + 1, 2 * levels + 1):
        climb(f"a{k}", f"p{k}", k)
    end = 2 * levels + 1
    return f"""WITH {", ".join(ctes)} SELECT doc_id, leaf.leaf AS leaf, leaf.subroot AS subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
        FROM p{end} CROSS JOIN a{end}"""


OP13_SQL = _sql()
