"""Byte-level byte-pair encoding: pre-tokens, merges, token counts, encoding and decoding.

``count_tokens`` counts without making identifiers: a pre-token has as many tokens as bytes, less its
merges. ``encode`` makes the identifiers, by overlapping chunks; those of texts longer than ``CHUNK`` characters are dealt to tasks. Chunks are pre-tokenised on their own, their boundaries are stitched where
pre-tokens of both end alike, and then the pieces between are encoded, in parallel again. Both keep
the pre-tokens that a worker has met.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize, schema, sliced, utf8

#: Characters of a chunk and of its overlap, of texts that are dealt to tasks and of those that are encoded in one.
CHUNK, OVERLAP = 65_536, 2_048
NEAR_CHUNK, NEAR_OVERLAP = 4_096, 128
#: Pre-tokens whose tokens are kept; when there are more, all are forgotten.
CACHE = 1_000_000
#: The same for lists of ids, which are larger and may stay in memory beside other operators' work.
IDS_CACHE = 100_000
#: Bytes up to which pre-tokens are merged side by side, and how many at once.
WIDE, SIDE = 64, 10_000
#: Bits of the table of pairs, and a rank that no pair has.
SLOTS, NONE = 20, np.int64(1 << 40)


class Merges:
    """Merge ranks by pairs of symbol numbers: 0..255 are bytes, 256 + r is what merge r makes."""

    def __init__(self, pairs: list[tuple[bytes, bytes]]):
        number = {bytes([b]): b for b in range(256)}
        self.rank: dict[int, int] = {}
        for r, (a, b) in enumerate(pairs):
            self.rank.setdefault(number[a] << 32 | number[b], r)
            number.setdefault(a + b, 256 + r)
        # A merge whose result has been made before keeps the first number of that result.
        self.made = [number[a + b] for a, b in pairs]
        self.byte = list(range(256))
        self.known: dict[str, int] = {}
        self.table: tuple[np.ndarray, ...] | None = None

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int]) -> Merges:
        """Merges of a rank file: two tokens merge if together they are a token, which has its rank as number."""
        self = cls([])
        self.rank = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.made = list(range(max(ranks.values(), default=-1) + 1))
        self.byte = [ranks.get(bytes([b]), -1) for b in range(256)]
        return self

    def merge(self, symbol: list[int]) -> tuple[int, list[int]]:
        """Merge in place; how many symbols are left, and where the next one stands after each.

        The symbols are a doubly linked list; a heap holds pairs as rank and position in one number.
        The lowest rank, leftmost first, is popped until none is left. An entry is out of date when
        the pair at its position has another rank by now.
        """
        n, rank = len(symbol), self.rank
        now = [rank.get(a << 32 | b, -1) for a, b in zip(symbol, symbol[1:])]  # noqa: B905
        now.append(-1)
        heap = [r << 32 | i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push, left = heapq.heappop, heapq.heappush, n
        while heap:
            top = pop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if now[i] != r:
                continue
            j = after[i]
            k = after[j]
            symbol[i] = s = self.made[r]
            after[i] = k
            now[j] = -1
            left -= 1
            if k < n:
                before[k] = i
                now[i] = r = rank.get(s << 32 | symbol[k], -1)
                if r >= 0:
                    push(heap, r << 32 | i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                now[h] = r = rank.get(symbol[h] << 32 | s, -1)
                if r >= 0:
                    push(heap, r << 32 | h)
        return left, after

    def count(self, piece: bytes) -> int:
        """Tokens of a pre-token: its bytes minus its merges."""
        return self.merge(list(piece))[0] if len(piece) > 1 else len(piece)

    def ids(self, piece: bytes) -> list[int]:
        """Numbers of a pre-token's tokens."""
        symbol = [self.byte[b] for b in piece]
        after = self.merge(symbol)[1]
        out, i = [], 0
        while i < len(symbol):
            out.append(symbol[i])
            i = after[i]
        return out


    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NONE`` where they don't merge: a table of slots, and a sorted list of what found its slot taken."""
        if self.table is None:
            keys, ranks = (np.fromiter(x, np.int64, len(self.rank)) for x in (self.rank.keys(), self.rank.values()))
            slots = np.full(1 << SLOTS, -1, np.int64)
            at = self._slot(keys)
            slots[at] = np.arange(len(keys))  # of several the last one has it
            rest = np.flatnonzero(slots[at] != np.arange(len(keys)))
            rest = rest[np.argsort(keys[rest])]
            self.table = np.append(keys, -1)[slots], np.append(ranks, NONE)[slots], np.append(keys[rest], -1), np.append(ranks[rest], NONE)
        keys, ranks, more, more_ranks = self.table
        pair = a << 32 | b
        at = self._slot(pair)
        held = keys[at]
        out = np.where(held == pair, ranks[at], NONE)
        other = np.flatnonzero((held != pair) & (held >= 0))
        k = np.searchsorted(more[:-1], pair[other])
        out[other] = np.where(more[k] == pair[other], more_ranks[k], NONE)
        return out

    @staticmethod
    def _slot(pair: np.ndarray) -> np.ndarray:
        return ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).view(np.int64)

    def many(self, pieces: list[bytes]) -> list[list[int]]:
        """:meth:`ids` of many pre-tokens: those of about the same length are merged side by side, a pair of each at a time."""
        out: list[list[int]] = [[]] * len(pieces)
        by: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by.setdefault(max(8, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in by.items():
            if width > WIDE or len(rows) < 4:
                for i in rows:
                    out[i] = self.ids(pieces[i])
                continue
            for at in range(0, len(rows), SIDE):
                part = rows[at : at + SIDE]
                for i, ids in zip(part, self._side_by_side([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _side_by_side(self, pieces: list[bytes], width: int) -> list[list[int]]:
        made, look = np.array(self.made, np.int64), self.look
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        symbol = np.array(self.byte, np.int64)[raw]
        place = np.arange(width)
        alive = place < size[:, None]
        after = np.broadcast_to(place + 1, raw.shape).copy()  # ``size`` or more: the end
        before = np.broadcast_to(place - 1, raw.shape).copy()
        rank = np.full(raw.shape, NONE)
        two = alive[:, 1:]
        rank[:, :-1][two] = look(symbol[:, :-1][two], symbol[:, 1:][two])
        row = np.arange(len(pieces))
        while len(row):
            i = rank[row].argmin(axis=1)  # the first one of the lowest rank
            r = rank[row, i]
            go = r < NONE
            row, i, r = row[go], i[go], r[go]
            j = after[row, i]
            k = after[row, j]
            h = before[row, i]
            symbol[row, i] = made[r]
            alive[row, j] = False
            rank[row, j] = NONE
            after[row, i] = k
            inside = k < size[row]
            x, y, z = row[inside], i[inside], k[inside]
            before[x, z] = y
            rank[row, i] = NONE
            rank[x, y] = look(symbol[x, y], symbol[x, z])
            inside = h >= 0
            x, y, z = row[inside], h[inside], i[inside]
            rank[x, y] = look(symbol[x, y], symbol[x, z])
        flat, ends = symbol[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905


@lru_cache(maxsize=4)
def rank_file(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def json_file(path: str) -> tuple[Merges, tuple[str, ...]]:
    """Merges and special strings of a byte-level tokenizer file.

    A file of this kind shows each byte as one printable character: a byte that is a printable,
    non-blank character of Latin-1 stands for itself, the others for the characters from 256 on, in order.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
    merges = Merges([tuple(bytes(byte_of[c] for c in side) for side in pair) for pair in pairs])
    return merges, tuple(t["content"] for t in spec["added_tokens"])


# ---------------------------------------------------------------------------- token counts


def _counter(path: str, pattern: str):
    def run(batches):
        merges, special = json_file(path)  # stays in the worker, with the pre-tokens it has met
        known = merges.known
        find = regex.compile(pattern).findall
        parts = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        for batch in sliced(batches):
            counts = []
            for body in batch.column("body"):
                text = body.as_py().decode()
                texts = parts.split(text) if parts else [text]
                total = len(texts) - 1  # the special strings between them
                for t in texts:
                    pieces = find(t)
                    for p in {*pieces}.difference(known):
                        known[p] = merges.count(p.encode())
                    total += sum(map(known.__getitem__, pieces))
                counts.append(total)
                if len(known) > CACHE:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row.

    ``vocabulary`` is the path of a tokenizer JSON that executors can read. Its special strings
    count as one token wherever they occur. Null text is empty: no bytes, no tokens. A text is never
    cut. Ids may be null or repeat; an empty table gives an empty result; other columns are ignored.
    """
    body = utf8(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("body"), F.octet_length(body).cast("long").alias("n_bytes"))
    of = schema("doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.mapInArrow(_counter(vocabulary, pattern), of).withColumn("over_limit", F.col("n_tokens") > limit)


# ---------------------------------------------------------------------------- encoding and decoding


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The worker's codec."""
    return Codec(path, pattern)


class Codec:
    """Encoder and decoder of one vocabulary inside a task, with the pre-tokens it has met."""

    def __init__(self, path: str, pattern: str):
        ranks = rank_file(path)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, list[int]] = {}
        self.whole, self.merges = ranks, Merges.of_ranks(ranks)
        self.tokens = {i: b for b, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}

    def learn(self, texts: list[list[str]]) -> None:
        """Encode all pre-tokens of some texts that aren't known yet."""
        if len(self.known) > IDS_CACHE:
            self.known.clear()
        new = list(set().union(*texts).difference(self.known))
        bodies = [p.encode() for p in new]
        whole = [self.whole.get(b) for b in bodies]
        rest = iter(self.merges.many([b for b, w in zip(bodies, whole, strict=True) if w is None]))
        self.known.update((p, next(rest) if w is None else [w]) for p, w in zip(new, whole, strict=True))

    def ids(self, pieces: list[str], learn: bool = True) -> list[int]:
        """Identifiers of the pre-tokens, one after the other; ``learn`` false if they are known."""
        if learn:
            self.learn([pieces])
        return list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        """Number, hash of the ids and hash of the decoded bytes."""
        joined = ",".join(map(self.names.__getitem__, ids))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()

    def cut(self, text: str) -> tuple[list[str], list[int]]:
        """Pre-tokens and where each ends."""
        pieces = self.pattern.findall(text)
        ends = list(accumulate(map(len, pieces)))
        if not pieces or ends[-1] == len(text):
            return pieces, ends
        found = [(m[0], m.end()) for m in self.pattern.finditer(text)]  # a pattern that passes over characters
        return [p for p, _ in found], [e for _, e in found]

    def boundaries(self, text: str) -> list[int]:
        return self.cut(text)[1]

    def pieces(self, text: str, chunk: int = NEAR_CHUNK, overlap: int = NEAR_OVERLAP) -> list[str]:
        """Pre-tokens of a text, by chunks that are stitched; of the whole at once where chunks never meet."""
        if len(text) <= chunk:
            return self.pattern.findall(text)
        found = [self.cut(text[start : start + chunk + overlap]) for start in range(0, len(text), chunk)]
        cuts = stitch([(k * chunk, [k * chunk + e for e in ends]) for k, (_, ends) in enumerate(found)])
        if cuts is None:
            return self.pattern.findall(text)
        out = []
        for k, ((a, b), (pieces, ends)) in enumerate(zip(cuts, found, strict=True)):
            out += pieces[bisect_right(ends, a - k * chunk) : bisect_right(ends, b - k * chunk)]
        return out


def stitch(chunks: list[tuple[int, list[int]]]) -> list[tuple[int, int]] | None:
    """From where to where each chunk's pre-tokens count, in characters of the text, or None if two chunks never meet.

    A chunk is (its start, ends of its pre-tokens), in characters of the text, in order; each starts before
    its predecessor ends. Pre-tokens of the first chunk are right except for the last two, which
    what comes next could change. From the first boundary that a right pre-token of one chunk shares
    with the next chunk, both go on alike.
    """
    out, at = [], 0
    for k, (_, ends) in enumerate(chunks):
        if k == len(chunks) - 1:
            upto = max([at, *ends[-1:]])
        else:
            start, following = chunks[k + 1]
            right = ends[: max(0, len(ends) - 2)]
            right = right[bisect_left(right, max(at, start + 1)) :]
            both = sorted(set(right).intersection(following[: bisect_right(following, right[-1])] if right else ()))
            if not len(both):
                return None
            upto = both[0]
        out.append((at, upto))
        at = upto
    return out


ENCODED = "doc_id bigint, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
CHUNKS = "row string, doc_id bigint, chunk int, start int, piece string"
ENDS = "row string, chunk int, start int, ends array<int>"
PIECES = "row string, chunk int, begin int, end int"
PARTS = "row string, doc_id bigint, chunk int, ids array<int>, piece string"


def _encode(path: str, pattern: str, emit_ids: bool):
    def run(batches):
        c = codec(path, pattern)
        for batch in sliced(batches, 200):
            texts = [c.pieces(body.as_py().decode()) for body in batch.column("body")]
            c.learn(texts)
            rows = []
            for pieces in texts:
                ids = c.ids(pieces, learn=False)
                rows.append((ids if emit_ids else None, *c.digest(ids)))
            yield _encoded(batch.column("doc_id"), rows)
        c.known = {}  # the worker goes on to other operators' tasks

    return run


def _encoded(doc_ids, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])


def _cut(chunk: int, overlap: int):
    """Long texts to overlapping chunks, cut in one pass; rows are told apart by partition and place, as ids may repeat."""

    def run(batches):
        n = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text, n = text.as_py(), n + 1
                for k, start in enumerate(range(0, len(text), chunk)):
                    columns = ([f"{TaskContext.get().partitionId()}-{n}"], [doc], [k], [start], [text[start : start + chunk + overlap]])
                    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "doc_id", "chunk", "start", "piece"])

    return run


def _boundaries(path: str, pattern: str):
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            ends = [[s + e for e in c.boundaries(t)] for s, t in zip(batch.column("start").to_pylist(), batch.column("piece").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("row", "chunk", "start")), pa.array(ends, pa.list_(pa.int32()))], ["row", "chunk", "start", "ends"])

    return run


def _stitched(pdf: pd.DataFrame) -> pd.DataFrame:
    """A text's boundaries to the piece of each chunk that is to be encoded; all -1 where chunks never meet."""
    pdf = pdf.sort_values("chunk")
    pieces = stitch([(r.start, list(r.ends)) for r in pdf.itertuples()]) or [(-1, -1)] * len(pdf)
    return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "begin": [a for a, _ in pieces], "end": [b for _, b in pieces]})


def _encode_pieces(path: str, pattern: str):
    """A chunk's piece to ids. A chunk of a text whose chunks never meet keeps its own part of the text instead."""

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            rows = batch.to_pylist()
            ids, pieces = [], []
            for r in rows:
                inside = r["piece"][r["begin"] - r["start"] : r["end"] - r["start"]] if r["begin"] >= 0 else None
                ids.append(c.ids(c.pattern.findall(inside)) if inside is not None else None)
                pieces.append(r["piece"] if inside is None else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("row", "doc_id", "chunk")), pa.array(ids, pa.list_(pa.int32())), pa.array(pieces, pa.string())], ["row", "doc_id", "chunk", "ids", "piece"])

    return run


def _joined(path: str, pattern: str, emit_ids: bool, chunk: int):
    """A text's pieces to its result; a text whose chunks never meet is put together and encoded as one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c, pdf = codec(path, pattern), pdf.sort_values("chunk")
        if pdf["piece"].notna().any():
            last = len(pdf) - 1
            ids = c.ids(c.pattern.findall("".join(p if k == last else p[:chunk] for k, p in enumerate(pdf["piece"]))))
        else:
            ids = [int(i) for part in pdf["ids"] for i in part]
        return pd.DataFrame([(pdf["doc_id"].iloc[0], ids if emit_ids else None, *c.digest(ids))], columns=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})

    return run


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, emit_ids: bool = True
) -> DataFrame:
    """Encode every whole text and decode it again: ``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``.

    ``vocabulary`` is the path of a rank file that executors can read. ``emit_ids`` false leaves
    ``ids`` null. Texts over ``chunk`` characters are cut into chunks of that size that reach
    ``overlap`` characters into the next one; each chunk is a row of its own, written once, as it is read for its
    boundaries and for its piece. Null text is empty and has no ids. Ids may be null or repeat. An empty
    table gives an empty result; other columns are ignored.
    """
    of = schema(ENCODED)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # Short texts stay where they are.
    short = rows.where(F.length("t") <= chunk).select("doc_id", utf8("t").alias("body"))
    short = short.mapInArrow(_encode(vocabulary, pattern, emit_ids), of)
    long = rows.where(F.length("t") > chunk).mapInArrow(_cut(chunk, overlap), schema(CHUNKS))
    long = materialize(long.repartition("row", "chunk"), "chunks")
    pieces = long.mapInArrow(_boundaries(vocabulary, pattern), schema(ENDS)).groupBy("row").applyInPandas(_stitched, schema(PIECES))
    parts = long.join(pieces, ["row", "chunk"]).mapInArrow(_encode_pieces(vocabulary, pattern), schema(PARTS))
    return short.unionByName(parts.groupBy("row").applyInPandas(_joined(vocabulary, pattern, emit_ids, chunk), of))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, emit_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
