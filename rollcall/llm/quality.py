"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over characters, all of them: nothing is folded into an unknown symbol but what no trusted
text has. It is estimated by joins of count tables and stays in tables, dealt to shards; no node holds it
whole. Documents are put in blocks, written once. A block asks each shard for its distinct n-grams
with one compressed array, and gets their probabilities back in the same order; the shards join
the blocks' n-grams with the counts of the n-grams, their suffixes and their contexts. A shard is named
by the n-gram's third character and a part of its second one, which the counts of the last two
characters are copied for: so a frequent character doesn't meet in one task.

A document's perplexity is compared with quantiles of the perplexities of trusted documents of its
language that the model was not fitted on. A few bad words hardly move it, so counts of text labelled
as toxic make a second model in the same tables, and the passage that this model finds most likelier
than the first is compared with the worst passages of trusted documents in the same way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import bucketed, materialize, mix64, pack, schema, unpack

ORDER = 4
#: Trusted and toxic documents the models are fitted on, at most (in expectation) of each, and the share of them at most.
SAMPLE, SHARE = 20_000, 0.8
#: A document is rejected beyond the median of its language plus ``REACH`` times the median's distance to this
#: quantile, in logarithms, and ``WORST_REACH`` times for worst passages. Tails themselves are told by too few documents.
QUANTILE, REACH, WORST_REACH, LEAST_TRUSTED = 0.95, 4.0, 3.0, 20
#: Symbols of average trusted text that every document is judged together with: a few symbols prove little.
PRIOR = 64
#: Symbols in a passage.
PASSAGE = 16
#: Characters in a block, about; parts of a third character's n-grams; n-grams of a shard that blocks ask for, about.
BLOCK_CHARS, PARTS, SHARD = 3_000_000, 16, 1_000_000
#: Steps of logarithms: 16 bits reach 32 below, and 32 to both sides.
STEP, RATIO_STEP = 1 / 2048, 1 / 1024
#: Numbers of n-grams within a block are looked up in tables of this size at most, else sorted.
DENSE = 1 << 24

BLOCKS = "block long, n_chars long, payload binary"
ASKS = "shard int, block long, hi binary, lo binary"
ANSWERS = "block long, shard int, good binary, ratio binary"
SCORES = "block long, at int, doc_id bigint, lang string, n_symbols bigint, log_p double, worst double"
GRAMS = "c1 int, c2 int, c3 int, c4 int, g bigint, b bigint"


# ---------------------------------------------------------------------------- n-grams of texts


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters, each text after three zeros, and where each text's own characters begin."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    out = np.zeros(int(lengths.sum()) + (ORDER - 1) * len(parts), np.uint32)
    for at, p in zip(starts, parts, strict=True):
        out[at : at + len(p)] = p
    return out, starts


def numbered(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position from the fourth on the number of the n-gram that ends there, and a position of each number."""
    point = np.zeros(int(symbols.max(initial=0)) + 1, bool)
    point[symbols] = True
    chars = (np.cumsum(point) - 1)[symbols]
    n, now, size = int(chars.max(initial=0)) + 1, chars, int(chars.max(initial=0)) + 1
    for _ in range(ORDER - 1):
        code = now[:-1].astype(np.int64) * n + chars[len(chars) - len(now) + 1 :]
        if size * n <= DENSE:
            seen = np.zeros(size * n, bool)
            seen[code] = True
            now = (np.cumsum(seen, dtype=np.int32) - 1)[code]
        else:
            now = np.unique(code, return_inverse=True)[1]
        size = int(now.max(initial=-1)) + 1
    at = np.zeros(size, np.int64)
    at[now] = np.arange(len(now)) + ORDER - 1
    return now, at


def grams_at(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The characters of the n-grams that end at these positions, a row for each place."""
    return np.stack([symbols[at - k] for k in range(ORDER - 1, -1, -1)]).astype(np.int64)


def in_texts(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which positions from the fourth on are texts' own characters, not zeros before them."""
    own = np.ones(len(symbols), bool)
    own[(starts[:, None] - np.arange(1, ORDER)).ravel()] = False
    return own[ORDER - 1 :]


def _counted(batches):
    """Arrow batches of (text, toxic) to counts of n-grams in trusted and in toxic texts."""
    for batch in batches:
        for bad in (False, True):
            texts = [t for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x == bad]
            for part in _portions(texts):
                symbols, starts = code_points(part)
                number, at = numbered(symbols)
                n = np.bincount(number[in_texts(symbols, starts)], minlength=len(at))
                some = np.flatnonzero(n)
                c, n = grams_at(symbols, at[some]), n[some].astype(np.int64)
                columns = [*c.astype(np.int32), *((np.zeros_like(n), n) if bad else (n, np.zeros_like(n)))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["c1", "c2", "c3", "c4", "g", "b"])


def _portions(texts: list[str]):
    """Texts put together up to ``BLOCK_CHARS`` characters; a longer one is on its own."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= BLOCK_CHARS:
            yield held
            held, n = [], 0
    if held:
        yield held


# ---------------------------------------------------------------------------- estimates


def _discounts(counts: DataFrame, of: str) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2, and 3 or more, from the counts of counts."""
    n = counts.agg(*(F.coalesce(F.sum((F.col(of) == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4))).first()
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    d = [k - (k + 1) * y * b / a if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d, strict=True))


def estimate(grams: DataFrame) -> DataFrame:
    """The model's tables as one: ``kind, c1..c4, pg, pb``, from counts of n-grams in trusted (g) and toxic (b) text.

    Kind n from 1 to 4 are n-grams, right-aligned in c1..c4, with their discounted probabilities; kind
    10 + n are contexts of n-grams, in the places that they have in an n-gram, with the mass that goes to
    the shorter context. Counts of the highest order are occurrences; those below are numbers of distinct
    left neighbours.
    """
    out, counts, names = [], grams, [f"c{i}" for i in range(1, ORDER + 1)]
    for n in range(ORDER, 0, -1):
        counts = materialize(counts, f"grams{n}")
        own, context = names[ORDER - n :], names[ORDER - n : -1]
        freed = {}
        for m in ("g", "b"):
            d1, d2, d3 = _discounts(counts, m)
            c = F.col(m)
            freed[m] = F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        sums = counts.groupBy(*context).agg(*(a for m in freed for a in (F.sum(m).alias(f"t{m}"), F.sum(freed[m]).alias(f"f{m}"))))
        p = [F.when(F.col(m) > 0, (F.col(m) - freed[m]) / F.col(f"t{m}")).otherwise(0.0).alias(f"p{m}") for m in freed]
        rest = [F.when(F.col(f"t{m}") > 0, F.col(f"f{m}") / F.col(f"t{m}")).otherwise(1.0).alias(f"p{m}") for m in freed]
        place = lambda have: [F.col(c) if c in have else F.lit(0).alias(c) for c in names]
        joined = counts.join(sums, context) if context else counts.crossJoin(F.broadcast(sums))  # one row
        out += [joined.select(F.lit(n).alias("kind"), *place(own), *p), sums.select(F.lit(10 + n).alias("kind"), *place(context), *rest)]
        if n > 1:
            counts = counts.groupBy(*own[1:]).agg(F.count_if(F.col("g") > 0).alias("g"), F.count_if(F.col("b") > 0).alias("b"))
    tables = out[0]
    for t in out[1:]:
        tables = tables.unionByName(t)
    return tables


def _shard(c3, c2, shards: int):
    """The shard of an n-gram, the same for numbers, arrays and columns."""
    return (c3 * 31 + (c2 % PARTS) * 7919) % shards


def dealt(tables: DataFrame, shards: int) -> DataFrame:
    """The model's rows with the shards that need them: ``shard, kind, hi, lo, pg, pb``.

    What is told by the third character alone is copied for each of its parts; probabilities of single
    characters, which are few, for every shard.
    """
    own = tables.where("kind in (3, 4, 13, 14)").withColumn("shard", _shard(F.col("c3"), F.col("c2"), shards))
    parts = tables.where("kind in (2, 12)").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    parts = parts.withColumn("shard", _shard(F.col("c3"), F.col("part"), shards)).drop("part")
    single = tables.where("kind in (1, 11)").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    key = lambda a, b: F.shiftleft(F.col(a).cast("long"), 21) + F.col(b)
    rows = own.unionByName(parts).unionByName(single)
    return rows.select(F.col("shard").cast("int").alias("shard"), "kind", key("c1", "c2").alias("hi"), key("c3", "c4").alias("lo"), "pg", "pb")


class Tables:
    """A shard's rows in a task: probabilities and masses by kind and n-gram."""

    def __init__(self, rows: pd.DataFrame):
        self.of, self.known = {}, 0
        for kind, t in rows.groupby("kind"):
            key = self.key(t["hi"].to_numpy(np.int64), t["lo"].to_numpy(np.int64))
            order = np.argsort(key)
            self.of[int(kind)] = key[order], t["pg"].to_numpy()[order], t["pb"].to_numpy()[order]
        self.symbols = len(self.of[1][0]) if 1 in self.of else 0

    @staticmethod
    def key(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return mix64(mix64(hi.astype(np.uint64) + np.uint64(1)) ^ lo.astype(np.uint64))

    def find(self, kind: int, hi: np.ndarray, lo: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.of:
            return (np.full(len(hi), missing),) * 2
        keys, pg, pb = self.of[kind]
        want = self.key(hi, lo)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[at] == want
        return np.where(hit, pg[at], missing), np.where(hit, pb[at], missing)

    def logs(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of the interpolated probabilities of n-grams by both models.

        The shortest model gives each symbol that it has, and one more for all others, the same share.
        """
        low21, none = np.int64((1 << 21) - 1), np.zeros_like(hi)
        c2, c3, c4 = hi & low21, lo >> 21, lo & low21
        steps = ((1, none, c4, 11, none, none), (2, none, lo, 12, none, c3 << 21), (3, c2, lo, 13, c2, c3 << 21), (4, hi, lo, 14, hi, c3 << 21))
        good = bad = np.full(len(hi), 1.0 / (self.symbols + 1))
        for kind, a, b, context, x, y in steps:
            (pg, pb), (rg, rb) = self.find(kind, a, b, 0.0), self.find(context, x, y, 1.0)
            good, bad = pg + rg * good, pb + rb * bad
        return np.log(good), np.log(bad)


# ---------------------------------------------------------------------------- blocks of documents


def _to_blocks(batches):
    """Rows, the last column of which is the text, as blocks: compressed Arrow streams of about ``BLOCK_CHARS`` characters."""
    block, held, n = TaskContext.get().partitionId() << 32, [], 0

    def row():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([n]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "n_chars", "payload"])

    for batch in batches:
        lengths = np.array([len(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.int64)
        begin = 0
        while begin < batch.num_rows:
            upto = begin + int(np.searchsorted(np.cumsum(lengths[begin:]), BLOCK_CHARS - n)) + 1
            held.append(batch.slice(begin, upto - begin))
            n += int(lengths[begin:upto].sum())
            begin = min(upto, batch.num_rows)
            if n >= BLOCK_CHARS:
                yield row()
                block, held, n = block + 1, [], 0
    if held:
        yield row()


def _rows(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


class _Block:
    """A block's n-grams: number at each position, and the order in which shards are asked for them."""

    def __init__(self, table: pa.Table, shards: int):
        self.symbols, self.starts = code_points(table.column(table.num_columns - 1).to_pylist())
        self.number, at = numbered(self.symbols)
        c = grams_at(self.symbols, at)
        hi, lo = c[0] << 21 | c[1], c[2] << 21 | c[3]
        shard = _shard(c[2], c[1], shards)
        self.order = np.lexsort((lo, hi, shard))
        self.shard, self.hi, self.lo = shard[self.order], hi[self.order], lo[self.order]


def _ask(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(_rows(row["payload"]), shards)
                if not len(b.shard):
                    continue
                cuts = np.append(np.flatnonzero(np.diff(b.shard, prepend=-1)), len(b.shard))
                parts = [(int(b.shard[i]), row["block"], pack(np.diff(b.hi[i:j], prepend=0)), pack(b.lo[i:j])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [pa.array(list(x), k) for x, k in zip(zip(*parts, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "hi", "lo"])

    return run


def _answer(asks: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    tables, rows = Tables(model), []
    for a in asks.itertuples():
        good, bad = tables.logs(np.cumsum(unpack(a.hi, np.int64)), unpack(a.lo, np.int64))
        levels = np.rint(-good / STEP).clip(0, 65535).astype(np.uint16)
        ratio = np.rint((bad - good) / RATIO_STEP).clip(-32767, 32767).astype(np.int16)
        rows.append((a.block, a.shard, pack(levels), pack(ratio)))
    return pd.DataFrame(rows, columns=["block", "shard", "good", "ratio"])


def worst_passages(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int = PASSAGE) -> np.ndarray:
    """For each text, at ``starts`` in ``values``, the largest sum of ``width`` values in a row; of all where there are fewer."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    out = sums[starts + lengths] - sums[starts]
    long = np.flatnonzero(lengths > width)
    if len(long):
        windows = np.append(sums[width:] - sums[:-width], np.iinfo(np.int64).min)
        edges = np.stack([starts[long], starts[long] + lengths[long] - width + 1], axis=1).ravel()
        out[long] = np.maximum.reduceat(windows, edges)[::2]
    return out


def _score(shards: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers, out = answers.sort_values("shard"), []
        for row in blocks.itertuples():
            table = _rows(row.payload)
            b = _Block(table, shards)
            levels, ratio = np.zeros(len(b.order), np.uint16), np.zeros(len(b.order), np.int16)
            if len(b.order):
                levels[b.order] = np.concatenate([unpack(x, np.uint16) for x in answers["good"]])
                ratio[b.order] = np.concatenate([unpack(x, np.int16) for x in answers["ratio"]])
            skipped = ORDER - 1  # numbers begin at the fourth position
            begin = b.starts - skipped
            lengths = np.diff(np.append(b.starts, len(b.symbols) + skipped)) - skipped
            sums = np.concatenate([[0], np.cumsum(levels[b.number], dtype=np.int64)])
            below = sums[begin + lengths] - sums[begin]
            worst = worst_passages(ratio[b.number], begin, lengths) * RATIO_STEP
            out.append(pd.DataFrame({
                "block": row.block, "at": np.arange(len(lengths), dtype=np.int32), "doc_id": pd.array(table.column("own_id").to_pylist(), "Int64"), "lang": table.column("own_lang").to_pandas(),
                "n_symbols": lengths, "log_p": -STEP * below, "worst": worst,
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[f.split()[0] for f in SCORES.split(", ")])

    return run


# ---------------------------------------------------------------------------- the classifier


def _language(lang: Column) -> Column:
    """The language as a key that is never null."""
    return F.coalesce(F.concat(F.lit("l"), lang), F.lit(""))


class _Judged:
    """Documents in blocks with their scores and thresholds."""

    def __init__(
        self, docs: DataFrame, trusted_ids: DataFrame, toxic_ids: DataFrame | None, id_col: str, text_col: str, lang_col: str, sample: int, quantile: float, reach: float, worst_reach: float, prior: int, payload: bool,
    ):
        spark = docs.sparkSession
        own = [F.col(id_col).cast("long").alias("own_id"), F.col(lang_col).alias("own_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("own_text")]
        ids = lambda df: df.select(F.col(id_col).cast("long").alias("label_id")).where("label_id is not null").distinct()
        good, bad = ids(trusted_ids), None if toxic_ids is None else ids(toxic_ids)
        texts = docs.select(own[0], own[2])
        fits = []
        for labelled, toxic in ((good, False), (bad, True)):
            if labelled is None:
                continue
            n = labelled.count()
            share = min(sample / n, SHARE) if n else 0
            drawn = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < share * (1 << 20)
            # Bounded by ``sample``, in expectation: their ids can be broadcast.
            wanted = materialize(labelled.where(drawn), "fitted")
            fits.append(texts.join(F.broadcast(wanted), F.col("own_id") == F.col("label_id"), "left_semi").select("own_text", F.lit(toxic).alias("toxic")))
            if not toxic:
                self.held = labelled.select("label_id", (~drawn).alias("held"))
        fit = fits[0] if len(fits) == 1 else fits[0].unionByName(fits[1])
        grams = fit.mapInArrow(_counted, schema(GRAMS)).groupBy("c1", "c2", "c3", "c4").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
        tables = materialize(estimate(grams), "model")

        carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)] if payload else []
        rows = docs.select(*carried, *own)
        self.fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)] if payload else []
        self.blocks = bucketed(rows.mapInArrow(_to_blocks, schema(BLOCKS)), "block")
        shards = (self.blocks.agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0] // 8) // SHARD + int(spark.conf.get("spark.sql.shuffle.partitions"))
        asks = self.blocks.mapInArrow(_ask(shards), schema(ASKS))
        answers = asks.groupBy("shard").cogroup(dealt(tables, shards).groupBy("shard")).applyInPandas(_answer, schema(ANSWERS))
        scored = self.blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(shards), schema(SCORES))
        self.scored = materialize(scored, "perplexity")
        self._thresholds(quantile, reach, worst_reach, prior, bad is not None)

    def _thresholds(self, quantile: float, reach: float, worst_reach: float, prior: int, toxic: bool) -> None:
        trusted = self.scored.join(self.held, F.col("doc_id") == F.col("label_id")).where("n_symbols > 0")
        usual = trusted.agg(F.coalesce(F.sum("log_p") / F.sum("n_symbols"), F.lit(0.0))).first()[0]
        n = F.greatest(F.col("n_symbols") + prior, F.lit(1))
        self.judged = -(F.col("log_p") + prior * usual) / n  # the logarithm of the perplexity that is judged
        mean = trusted.select(_language(F.col("lang")).alias("key"), "held", self.judged.alias("j"), F.when(F.lit(toxic), F.col("worst")).alias("w"))

        def limits(of: Column | None) -> list[Column]:
            out = []
            for c, far in (("j", reach), ("w", worst_reach)):
                x = F.col(c) if of is None else F.when(of, F.col(c))
                q = F.percentile_approx(x, F.array(F.lit(0.5), F.lit(quantile)), F.lit(10_000))
                out.append(q[0] + far * (q[1] - q[0]))
            return out

        held, every = limits(F.col("held")), limits(None)
        enough = F.count_if("held") >= LEAST_TRUSTED
        by_lang = mean.groupBy("key").agg(*(F.when(enough, h).otherwise(e).alias(c) for h, e, c in zip(held, every, ("own", "own_worst"), strict=True)), F.count("*").alias("n"))
        # A row for each language: written first, so that its size is known when it is joined.
        by_lang = materialize(by_lang, "thresholds").where(F.col("n") >= LEAST_TRUSTED).drop("n")
        overall = mean.agg(*(F.when(enough, h).otherwise(e).alias(c) for h, e, c in zip(held, every, ("overall", "overall_worst"), strict=True)))
        rows = self.scored.withColumn("key", _language(F.col("lang"))).join(by_lang, "key", "left").crossJoin(F.broadcast(overall))
        rows = rows.withColumns({"threshold": F.coalesce("own", "overall"), "worst_threshold": F.coalesce("own_worst", "overall_worst")})
        likely, clean = (F.coalesce(x, F.lit(True)) for x in (self.judged <= F.col("threshold"), F.col("worst") <= F.col("worst_threshold")))
        self.rows = rows.withColumn("accepted", likely & clean | (F.col("n_symbols") == 0))


def classify(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, quantile: float = QUANTILE, reach: float = REACH, worst_reach: float = WORST_REACH, prior: int = PRIOR, toxic_ids: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, lang, n_symbols, perplexity, judged, threshold, accepted, worst, worst_threshold`` for each row.

    ``judged`` is the perplexity of the document together with ``prior`` symbols of average trusted
    text; it is what thresholds are taken from and compared with.

    ``toxic_ids`` holds ``id_col`` of toxic documents. With it, ``worst`` is how much likelier (in logarithms) the
    model of a sample of them finds the document's worst passage, and a document over ``worst_threshold`` is
    rejected, too. Without it both are null.

    ``trusted_ids`` holds ``id_col`` of trusted documents. The model is fitted on a part of them, drawn by a
    hash of the id, of ``sample`` documents in expectation and at most 80 %; thresholds come from the others
    of a language, or from all of it where they are under 20. A language (null is one) with under 20
    trusted documents takes the threshold of all. An empty or null text has perplexity 1 and is accepted.
    Without trusted documents all is accepted. Rows that repeat an id are scored each. Equal texts of a
    language have equal verdicts. An empty table gives an empty result. Other columns are ignored,
    whatever their names.
    """
    j = _Judged(docs, trusted_ids, toxic_ids, id_col, text_col, lang_col, sample, quantile, reach, worst_reach, prior, payload=False)
    perplexity = F.exp(-F.col("log_p") / F.greatest("n_symbols", F.lit(1)))
    worst = F.col("worst") if toxic_ids is not None else F.lit(None).cast("double")
    return j.rows.select(
        "doc_id", "lang", "n_symbols", perplexity.alias("perplexity"), F.exp(j.judged).alias("judged"), F.exp("threshold").alias("threshold"), "accepted", worst.alias("worst"), "worst_threshold"
    )


def _kept(names: list[str], of: T.StructType):
    def run(blocks: pa.Table, verdicts: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(of)
        if not blocks.num_rows:
            return want.empty_table()
        keep = np.zeros(0, np.int64) if not verdicts.num_rows else np.sort(np.asarray(verdicts.column("ats")[0].as_py(), np.int64))
        return _rows(blocks.column("payload")[0].as_py()).select(names).take(pa.array(keep)).cast(want)

    return run


def accepted_documents(
    docs: DataFrame, trusted_ids: DataFrame, toxic_ids: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, quantile: float = QUANTILE, reach: float = REACH, worst_reach: float = WORST_REACH, prior: int = PRIOR,
) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` accepts, with all their columns.

    Verdicts go to the blocks that hold the rows, by place: no text is shuffled for the decision, and rows
    need no key. Nulls, empty texts, repeated rows and empty tables are treated as there.
    """
    j = _Judged(docs, trusted_ids, toxic_ids, id_col, text_col, lang_col, sample, quantile, reach, worst_reach, prior, payload=True)
    names, of = [f.name for f in j.fields], T.StructType(j.fields)
    verdicts = j.rows.where("accepted").groupBy("block").agg(F.collect_list("at").alias("ats"))  # a block's rows, not more
    out = j.blocks.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(_kept(names, of), of)
    return out.toDF(*docs.columns)


def trusted_labels(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as good and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id")


def toxic_labels(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as toxic."""
    return labels.where(F.col("toxic") == 1).select("doc_id")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, trusted_labels(labels), toxic_ids=toxic_labels(labels))
