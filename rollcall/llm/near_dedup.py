"""SimHash near-dedup by meet-in-the-middle ball hashing, and connected components.

Two fingerprints at distance 2 or less have a fingerprint between them that is at distance 1 or
less from both. So every distinct fingerprint emits itself and its 64 one-bit variants, and those
that meet in a variant are linked. A variant is met by 65 distinct fingerprints at most, whatever
the size of the table, and any two of them are within distance 2; linking each to the smallest one
keeps every component. Copies share their fingerprint and meet only once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import discard, materialize, mix64, schema, sliced, text_hash, utf8

SEED, BITS = 42, 64


def fingerprint(body: bytes, width: int = 3) -> int:
    """SimHash of a text's word shingles, A-Z lowered: bit b is set if over half the hashes have it set."""
    words = body.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(width)), strict=True)) if len(words) >= width else (b" ".join(words),)
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fp = np.fromiter((fingerprint(b.as_py(), width) for b in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint's 64 bits as a signed long) for each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("body"), text_hash(text_col).alias("text_hash"))
    return rows.mapInArrow(_fingerprints(width), schema("doc_id long, text_hash long, fp long"))


def ball_links(fps: DataFrame) -> DataFrame:
    """Links ``a > b`` that join the distinct values of ``fp`` within distance 2 to the same components."""
    ball = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)))
    # Few small files hold the fingerprints: dealt out before each becomes 65 rows.
    dealt = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    met = dealt.select("fp", F.explode(ball).alias("variant")).groupBy("variant").agg(F.collect_list("fp").alias("members"))
    met = met.where(F.size("members") > 1).select("members", F.array_min("members").alias("b"))
    links = met.select(F.explode("members").alias("a"), "b").where("a <> b").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: ``node, root`` (the smallest node) for every node with a link.

    Alternates large-star and small-star (every node's larger, then smaller-or-equal, neighbours move
    to its smallest neighbour) until nothing moves; each round is a table in the shared folder. A
    node's minimum is aggregated before its shuffle, and a node with very many links is one side of
    a shuffled join, whose partitions Spark can split. Only one count a round reaches the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: neighbours above u link to u's minimum.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: u and its lower neighbours link to the lowest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        before, edges = edges, materialize(small.where("u <> v").distinct(), "links")
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(stars.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for each row.

    ``component_id`` is the smallest id reachable over fingerprints 2 bits apart or less, ``root`` a
    fingerprint that names the component.

    Null and blank texts have fingerprint 0 and are linked like any other. Null ids get the id of
    their component, null if it holds no other. Equal rows share a component. An empty table gives
    an empty result. Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = materialize(components(ball_links(classes.select("fp"))), "roots")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


#: Of :func:`similar`: independent fingerprints a text, bits of each, and bits of the whole sketch.
FINGERPRINTS, SHORT = 16, 28
SKETCH = FINGERPRINTS * SHORT
#: Bits that the 36 bits beside a fingerprint may differ in for two texts to be a candidate of it. At similarity 0.8 a bit differs with
#: probability 0.15, so a fingerprint that a similar pair shares is passed over in about one of 10^6 cases.
FAR_BESIDE = 15
#: Cells that a set's hashes are counted in, to tell pairs that can't be similar.
CELLS = 128
#: Fingerprints in a group, about; classes that meet in a variant and are paired there; classes of a crowd in a task.
GROUP, FEW, CROWD = 1 << 17, 8, 8192


def shingle_set(body: bytes, width: int) -> np.ndarray:
    """Distinct hashes of a text's word shingles, sorted, A-Z lowered; a shorter text is one shingle."""
    words = body.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)), np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SimHash of ``SKETCH`` independent bits, as 64-bit words: each bit is set if over half the shingles have it set."""
    ones = np.zeros(SKETCH, np.int64)
    salts = np.arange(1, SKETCH // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(hashes), 255):  # so that a byte holds a count
        words = mix64(hashes[i : i + 255, None] + salts)
        ones += np.add.reduce(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def cells(hashes: np.ndarray) -> np.ndarray:
    """How many of a set's hashes fall in each cell, 255 at most."""
    return np.minimum(np.bincount((hashes >> np.uint64(57)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8)


def can_be_similar(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float) -> np.ndarray:
    """False only for pairs below the similarity: two sets differ in at least as many elements as their counts by cell do.

    Sets of Jaccard similarity s or more differ in at most (1 - s) / (1 + s) of their sizes' sum.
    """
    differ = np.abs(a.astype(np.int64) - b.astype(np.int64)).sum(axis=1)
    return np.maximum(differ, np.abs(na - nb)) * (1 + similarity) <= (1 - similarity) * (na + nb) + 1e-6


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingle_set(b.as_py(), width) for b in batch.column(1)]
            cls = np.fromiter((xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets), np.uint64, len(sets)).view(np.int64)
            sketches = pa.array([sketch(s).tobytes() for s in sets], pa.binary())
            counts = pa.array([cells(s).tobytes() for s in sets], pa.binary())
            columns = [batch.column(0), batch.column(2), pa.array(cls), sketches, counts, pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "cls", "sketch", "cells", "size"])

    return run


def _windows(sketches: pa.Array) -> np.ndarray:
    """For each fingerprint (row) the 64 bits of each sketch that begin with it; the sketch is a ring."""
    bits = np.unpackbits(np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, SKETCH // 8), axis=1, bitorder="little")
    bits = np.concatenate([bits, bits[:, :64]], axis=1)
    return np.stack([np.packbits(bits[:, t * SHORT : t * SHORT + 64], axis=1, bitorder="little").view(np.uint64).ravel() for t in range(FINGERPRINTS)])


def _emit(high: int):
    """Each fingerprint goes to the group of its ``high`` leading bits, and to those one bit from it; one row for each group of a batch."""
    flips = np.array([0, *(1 << b for b in range(high))], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for t, w in enumerate(_windows(batch.column(1)) if len(ids) else ()):
                lead = ((w & np.uint64((1 << SHORT) - 1)) >> np.uint64(SHORT - high)).astype(np.int64)
                g = ((lead[:, None] ^ flips) + (t << SHORT)).ravel()
                order = np.argsort(g, kind="stable")
                cuts = np.append(np.flatnonzero(np.diff(g[order], prepend=-1)), len(g))
                member = order // (high + 1)
                parts = [(int(g[order[i]]), w[member[i:j]].tobytes(), ids[member[i:j]].tobytes()) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*parts, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["g", "ws", "ids"])

    return run


def _meet(high: int, few: int):
    """Pairs of a group that meet in a variant; where over ``few`` meet, edges that join them to one crowd instead.

    What is of one crowd makes no pairs here: all of a crowd is compared later.
    Those that are in the group by a flip of a leading bit have no other flip left. Two fingerprints may meet
    in several groups; one of these, told by their leading bits alone, makes the pair.
    """
    low = SHORT - high

    def run(table: pa.Table) -> pa.Table:
        w, ids = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("ws", np.uint64), ("ids", np.int64)))
        lead = table.column("g")[0].as_py() & ((1 << high) - 1)
        own = (w & np.uint64((1 << SHORT) - 1)).astype(np.int64)
        lead_of, rest = own >> low, own & ((1 << low) - 1)
        home = np.flatnonzero(lead_of == lead)
        variant = np.concatenate([rest, *(rest[home] ^ (1 << b) for b in range(low))])
        row = np.concatenate([np.arange(len(w)), *([home] * low)])
        by = np.argsort(variant, kind="stable")
        variant, row = variant[by], row[by]
        starts = np.flatnonzero(np.diff(variant, prepend=-1))
        size = np.diff(starts, append=len(variant))
        crowded = np.repeat(size > few, size)
        label = _labels(variant[crowded], row[crowded], len(w))
        joined = np.flatnonzero(label < np.arange(len(w)))
        found = [np.stack([ids[label[joined]], ids[joined]], axis=1)]
        crowds = len(joined)
        variant, row = variant[~crowded], row[~crowded]
        at = np.arange(len(variant))
        for d in range(1, few):
            at = at[at + d < len(variant)]
            at = at[variant[at] == variant[at + d]]
            i, j = row[at], row[at + d]
            x, y = lead_of[i], lead_of[j]
            bit = (x ^ y) & -(x ^ y)
            here = np.where(bit == (x ^ y), np.minimum(x, y), np.minimum(x ^ bit, y ^ bit)) == lead
            close = here & (label[i] != label[j]) & (np.bitwise_count((w[i] ^ w[j]) >> np.uint64(SHORT)) <= FAR_BESIDE)
            found.append(np.unique(np.sort(np.stack([ids[i[close]], ids[j[close]]], axis=1), axis=1), axis=0))
        pairs = np.unique(np.concatenate(found[1:]), axis=0) if few > 1 else found[0][:0]
        both = np.concatenate([found[0], pairs])
        return pa.table({"a": both[:, 0], "b": both[:, 1], "crowd": np.arange(len(both)) < crowds})

    return run


def _labels(variant: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row the smallest one that it is joined to by shared variants; ``variant`` is sorted."""
    label = np.arange(n)
    if len(variant):
        starts = np.flatnonzero(np.diff(variant, prepend=-1))
        size = np.diff(starts, append=len(variant))
        while True:
            least = np.repeat(np.minimum.reduceat(label[row], starts), size)
            now = label.copy()
            np.minimum.at(now, row, least)
            now = np.minimum(now, now[now])
            if (now == label).all():
                break
            label = now
    return label


def _crowd_links(similarity: float):
    """Links that join what is similar in a crowd's sets: every pair is compared, but only what joins two components is returned."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("cls").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        tokens, where = np.unique(np.concatenate(sets), return_inverse=True) if len(sets) else (np.zeros(0), np.zeros(0, np.int64))
        of = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(where, kind="stable")
        members, upto = of[order], np.cumsum(np.bincount(where, minlength=len(tokens)))
        begin = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
        parts = np.split(where, np.cumsum(size)[:-1]) if len(sets) else []
        component, links = np.arange(len(sets)), []
        for i, mine in enumerate(parts):
            if len(links) == len(sets) - 1:
                break  # all are one component
            shared = mine[upto[mine] - begin[mine] > 1]
            both = np.bincount(np.concatenate([members[begin[k] : upto[k]] for k in shared]), minlength=len(sets)) if len(shared) else np.zeros(len(sets), np.int64)
            near = np.flatnonzero((both >= similarity * (size[i] + size - both)) & (both > 0))
            for j in near[component[near] != component[i]]:
                if component[j] != component[i]:
                    links.append((ids[i], ids[j]))
                    component[component == component[j]] = component[i]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _possible(similarity: float):
    """The pairs whose sets can be similar, by their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 10_000):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CELLS) for c in ("cells_a", "cells_b"))
            keep = can_be_similar(a, b, batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy(), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for body in batch.column(0):
                s = shingle_set(body.as_py(), width)
                cls = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array([s.tobytes()], pa.binary())], ["cls", "hashes"])

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, text_hash, root`` for each row; ``root`` names the component of texts linked by verified similarity.

    Texts are linked if the Jaccard similarity of their sets of word shingles is ``similarity`` or more, which
    is computed from the sets for every candidate. Texts of equal sets are one class. Candidates have one of
    ``FINGERPRINTS`` independent fingerprints within distance 2, found by ball hashing as in :func:`ball_links`:
    a variant's flipped bit among the leading ones is emitted, one among the others is made in the group.
    Classes that meet with over ``FEW`` - 1 others in a variant are not paired there. What such variants join is a
    crowd, whose sets are compared with each other inside tasks that return only what joins two components: so a
    large group of near copies makes few rows. Of the candidates none is lost: those that aren't compared by their sets can't be similar
    (:func:`can_be_similar`). Pairs that share no fingerprint within distance 2 are not candidates: the README has the measured recall.

    Null and blank texts are one class. Equal rows share a component. Other columns are ignored.
    """
    text = [F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("body"), text_hash(text_col).alias("text_hash")]
    rows = docs.select(*text).mapInArrow(_sketches(width), schema("doc_id long, text_hash long, cls long, sketch binary, cells binary, size long"))
    rows = materialize(rows, "sketches")
    # All rows of a class have the same set, so the same sketch and counts.
    classes = rows.groupBy("cls").agg(*(F.first(c).alias(c) for c in ("sketch", "cells", "size")), F.min("text_hash").alias("text_hash"))
    classes = materialize(classes, "classes")
    texts = docs.select(*text)
    met = _candidates(classes, FEW)
    pairs, crowds = met.where("not crowd").select("a", "b"), met.where("crowd").select("a", "b")
    more = None
    if crowds.head(1):
        roots = materialize(components(crowds), "crowds")
        more = _crowds(roots, classes, texts, width, similarity)
        # What is of one crowd has been compared.
        for side in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"of_{side}")), side, "left")
        pairs = pairs.where("of_a is null or of_b is null or of_a <> of_b").select("a", "b")
    links = _verified(pairs, classes, texts, width, similarity)
    links = links if more is None else links.unionByName(more)
    roots = materialize(components(links), "roots")
    return rows.join(roots, rows["cls"] == roots["node"], "left").select("doc_id", "text_hash", F.coalesce("root", "cls").alias("root"))


def _candidates(classes: DataFrame, few: int) -> DataFrame:
    """Pairs ``a < b`` that have a fingerprint within distance 2, and the edges of crowds (``crowd``); see :func:`_meet`."""
    n, high = classes.count(), 0
    while n * (high + 1) > GROUP << high and high < SHORT - 1:
        high += 1
    emitted = classes.select("cls", "sketch").mapInArrow(_emit(high), schema("g long, ws binary, ids binary"))
    met = emitted.groupBy("g").applyInArrow(_meet(high, few), schema("a long, b long, crowd boolean")).distinct()
    return materialize(met, "candidates")


def _shingle_sets(wanted: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``cls, hashes`` of some classes: one text of each is read again."""
    wanted = materialize(classes.join(wanted, "cls", "left_semi").select("text_hash").distinct(), "wanted")
    read = texts.join(wanted, "text_hash", "left_semi").select("body")
    sets = read.mapInArrow(_sets(width), schema("cls long, hashes binary")).groupBy("cls").agg(F.first("hashes").alias("hashes"))
    return materialize(sets, "sets")


def _verified(met: DataFrame, classes: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The candidates whose sets of shingles are similar."""
    for side in ("a", "b"):
        met = met.join(classes.select(F.col("cls").alias(side), F.col("cells").alias(f"cells_{side}"), F.col("size").alias(f"size_{side}")), side)
    pairs = materialize(met.mapInArrow(_possible(similarity), schema("a long, b long")), "pairs")
    sets = _shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), classes, texts, width)
    for side, one in (("a", "ha"), ("b", "hb")):
        pairs = pairs.join(sets.select(F.col("cls").alias(side), F.col("hashes").alias(one)), side)
    return materialize(pairs.select("a", "b", "ha", "hb").mapInArrow(_verify(similarity), schema("a long, b long")), "verified")


def _crowds(crowds: DataFrame, classes: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links within crowds (``node, root``): their sets are compared in tasks of two blocks of ``CROWD`` / 2 classes at most."""
    sizes = materialize(crowds.groupBy("root").agg(F.ceil(F.count("*") * 2 / CROWD).cast("long").alias("blocks")), "crowd-sizes")
    sets = _shingle_sets(crowds.select(F.col("node").alias("cls")), classes, texts, width)
    rows = sets.join(crowds.withColumnRenamed("node", "cls"), "cls").join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    # A crowd of one or two blocks is one task; of more, each two blocks meet in one.
    other = F.explode(F.when(F.col("blocks") <= 2, F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("other", other).where("other <> block or blocks <= 2")
    key = F.concat_ws("/", "root", F.when(F.col("other") < 0, "").otherwise(F.concat_ws("+", F.least("block", "other"), F.greatest("block", "other"))))
    met = rows.select(key.alias("key"), "cls", "hashes").groupBy("key").applyInArrow(_crowd_links(similarity), schema("a long, b long"))
    return materialize(met, "crowd-links")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
