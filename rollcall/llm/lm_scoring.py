"""Scoring texts with an n-gram model held in Elias-Fano tries.

The model is a bigram model with Dirichlet smoothing over add-half unigrams:
p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU), which sums to one over the vocabulary and the one
unknown word. It is trained on all training texts and sharded; nothing of it is held whole anywhere.

Texts are turned into blocks of about ``BLOCK_TOKENS`` tokens, written once. A block asks for what
it needs with one compressed array for each shard, and gets arrays back:

1. Words. Shards by the word's hash count the training tokens and number the words, frequent first.
2. Pairs. Shards by context (contexts that are frequent are split by follower) merge the training
   counts, build their trie, and answer each block's pairs out of the memory-mapped trie.
3. Blocks combine the answers to sums for each text.

A block names each word and pair once, however often it occurs, so no key is hot.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import bucketed, materialize, mix64, pack, schema, unpack, utf8
from rollcall.llm.elias_fano import ABSENT, Trie, dequantise

BLOCK_TOKENS, WORD_SHARD, PAIR_SHARD, HOT_CONTEXT = 2_000_000, 1_000_000, 2_000_000, 100_000
#: Chosen by :func:`leave_one_out` on training texts alone.
MU = 200.0
UNKNOWN = np.uint32(2**32 - 1)
#: Local and global stand-in for a text's end, which is also the context of its first word.
END_HASH = np.uint64(0)

BLOCKS = schema("block long, ids array<bigint>, train array<boolean>, lengths binary, tokens binary, words binary, counts binary, n_tokens long, n_words long")
WORD_ASKS = schema("shard int, block long, words binary, counts binary")
ANSWERS = schema("block long, kind int, shard int, ids binary, counts binary, n long")
PAIR_ASKS = schema("shard int, block long, pairs binary, counts binary, context_counts binary, follower_counts binary")
SCORES = schema("doc_id bigint, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _arrow(rows: list[dict], of) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, to_arrow_schema(of))


def _to_blocks(batches):
    """Arrow batches of (doc_id, train, body) to blocks of local word numbers; 0 is the end."""
    block = TaskContext.get().partitionId() << 32

    def empty():
        numbers = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[None]
        return numbers, [], [], []

    def block_row():
        words = np.fromiter((xxhash.xxh64_intdigest(w) | 1 for w in numbers if w is not None), np.uint64, len(numbers) - 1)
        lengths = np.fromiter(map(len, tokens), np.uint32, len(tokens))
        flat = np.concatenate(tokens)
        counts = np.bincount(flat[np.repeat(np.array(train), lengths)], minlength=len(numbers)).astype(np.uint32)
        return _arrow([{
            "block": block, "ids": ids, "train": train, "lengths": pack(lengths), "tokens": pack(flat),
            "words": pack(np.append(END_HASH, words)), "counts": pack(counts), "n_tokens": len(flat), "n_words": len(numbers),
        }], BLOCKS)

    numbers, ids, train, tokens = empty()
    n = 0
    for batch in batches:
        for doc, use, body in zip(*(batch.column(i) for i in range(3)), strict=True):
            words = body.as_py().lower().split()
            tokens.append(np.fromiter(chain(map(numbers.__getitem__, words), (0,)), np.uint32, len(words) + 1))
            ids.append(doc.as_py())
            train.append(use.as_py())
            n += len(words) + 1
            if n >= BLOCK_TOKENS:
                yield block_row()
                numbers, ids, train, tokens = empty()
                block, n = block + 1, 0
    if ids:
        yield block_row()


def _dealt(shards: np.ndarray, keys: np.ndarray):
    """The order in which a block lists keys (by shard, then key), and (shard, from, to) of each shard."""
    order = np.lexsort((keys, shards))
    s = shards[order]
    cuts = np.flatnonzero(np.diff(s)) + 1
    return order, [(int(s[a]), a, b) for a, b in zip(np.append(0, cuts), np.append(cuts, len(s)), strict=True)] if len(s) else []


def _ask_words(n_shards: int):
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = unpack(row["words"], np.uint64), unpack(row["counts"], np.uint32)
                order, parts = _dealt((mix64(words) % np.uint64(n_shards)).astype(np.int64), words)
                words, counts = words[order], counts[order]
                yield _arrow([{"shard": s, "block": row["block"], "words": pack(words[a:b]), "counts": pack(counts[a:b])} for s, a, b in parts], WORD_ASKS)

    return ask


def _answer_words(n_shards: int):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        asked = [unpack(x, np.uint64) for x in pdf["words"]]
        counts = np.concatenate([unpack(x, np.uint32) for x in pdf["counts"]])
        words, where = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(words)).astype(np.int64)
        rank = np.empty(len(words), np.int64)
        rank[np.lexsort((words, -total))] = np.arange(len(words))
        ids = np.where(total > 0, rank * n_shards + shard, int(UNKNOWN))
        if (ids > int(UNKNOWN)).any():
            raise OverflowError("more than 2^32 words; raise the width of word numbers")
        ends = np.cumsum([len(a) for a in asked])[:-1]
        rows = [(b, 0, shard, pack(i.astype(np.uint32)), pack(c), 0) for b, i, c in zip(pdf["block"], np.split(ids[where], ends), np.split(total[where], ends), strict=True)]
        rows.append((None, int((total > 0).sum()), shard, None, None, int(total.sum())))  # the shard's vocabulary and tokens
        return pd.DataFrame(rows, columns=ANSWERS.names)

    return answer


def _global(block: dict, answers: pd.DataFrame, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and training counts of a block's words, by local number."""
    words = unpack(block["words"], np.uint64)
    order, _ = _dealt((mix64(words) % np.uint64(n_shards)).astype(np.int64), words)
    a = answers[answers["kind"] == 0].sort_values("shard")
    ids, counts = np.empty(len(words), np.uint32), np.empty(len(words), np.int64)
    ids[order] = np.concatenate([unpack(x, np.uint32) for x in a["ids"]])
    counts[order] = np.concatenate([unpack(x, np.int64) for x in a["counts"]])
    return ids, counts


def _pairs(block: dict, ids: np.ndarray, counts: np.ndarray, n_shards: int) -> dict:
    """The block's distinct known pairs in asking order, and where each token's pair is in it (-1: not known)."""
    tokens = unpack(block["tokens"], np.uint32)
    before = np.concatenate([tokens[-1:] * 0, tokens[:-1]])
    known = (ids[tokens] != UNKNOWN) & (ids[before] != UNKNOWN)
    keys = (ids[before][known].astype(np.uint64) << np.uint64(32)) | ids[tokens][known].astype(np.uint64)
    pairs, first, where = np.unique(keys, return_index=True, return_inverse=True)
    at = np.flatnonzero(known)[first]
    context_counts, follower_counts = counts[before[at]], counts[tokens[at]]
    # A frequent context is split by follower, so that no shard holds all of it.
    ways = (context_counts // HOT_CONTEXT + 1).astype(np.uint64)
    part = (pairs & np.uint64(0xFFFFFFFF)) % ways
    shards = (mix64((pairs >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + part) % np.uint64(n_shards)).astype(np.int64)
    order, parts = _dealt(shards, pairs)
    place = np.empty(len(pairs), np.int64)
    place[order] = np.arange(len(pairs))
    of_token = np.full(len(tokens), -1, np.int64)
    of_token[known] = place[where]
    return {"tokens": tokens, "before": before, "of_token": of_token, "pairs": pairs[order], "parts": parts,
            "context_counts": context_counts[order], "follower_counts": follower_counts[order]}


def _ask_pairs(word_shards: int, n_shards: int):
    def ask(left: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for block in left.to_dict("records"):
            x = _pairs(block, *_global(block, answers, word_shards), n_shards)
            train = np.repeat(np.array(block["train"], bool), unpack(block["lengths"], np.uint32)) & (x["of_token"] >= 0)
            counts = np.bincount(x["of_token"][train], minlength=len(x["pairs"])).astype(np.uint32)
            for s, a, b in x["parts"]:
                rows.append((s, block["block"], pack(x["pairs"][a:b]), pack(counts[a:b]), pack(x["context_counts"][a:b]), pack(x["follower_counts"][a:b])))
        return pd.DataFrame(rows, columns=PAIR_ASKS.names)

    return ask


def _answer_pairs(tokens: int, words: int, mu: float):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        asked = [unpack(x, np.uint64) for x in pdf["pairs"]]
        flat = np.concatenate(asked)
        counts = np.concatenate([unpack(x, np.uint32) for x in pdf["counts"]])
        pairs, first, where = np.unique(flat, return_index=True, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(pairs))
        context = np.concatenate([unpack(x, np.int64) for x in pdf["context_counts"]])[first]
        follower = np.concatenate([unpack(x, np.int64) for x in pdf["follower_counts"]])[first]
        seen = total > 0
        p = (total + mu * unigram(follower, tokens, words)) / (context + mu)
        low = np.uint64(0xFFFFFFFF)
        blob = Trie.build(pairs[seen] >> np.uint64(32), pairs[seen] & low, np.log10(p[seen])).to_bytes()
        # Each pair is looked up once, in the mapped levels as they are, whatever number of blocks ask for it.
        codes = Trie.mapped(blob).lookup(pairs >> np.uint64(32), pairs & low)[where]
        ends = np.cumsum([len(a) for a in asked])[:-1]
        rows = [(b, 1, shard, pack(c), None, 0) for b, c in zip(pdf["block"], np.split(codes, ends), strict=True)]
        rows.append((None, 1, shard, blob, None, int(seen.sum())))  # the shard of the model itself
        return pd.DataFrame(rows, columns=ANSWERS.names)

    return answer


def unigram(count: np.ndarray, tokens: int, words: int) -> np.ndarray:
    return (count + 0.5) / (tokens + 0.5 * (words + 1))


def _score(word_shards: int, pair_shards: int, tokens: int, words: int, mu: float):
    def score(left: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in left.to_dict("records"):
            ids, counts = _global(block, answers, word_shards)
            x = _pairs(block, ids, counts, pair_shards)
            a = answers[answers["kind"] == 1].sort_values("shard")
            codes = np.concatenate([np.zeros(0, np.uint16), *(unpack(b, np.uint16) for b in a["ids"])])
            p = unigram(counts, tokens, words)
            base = np.log10(p)[x["tokens"]]
            # Not in the trie: what is left of the context's mass goes by unigram.
            logs = np.log10(mu) + base - np.log10(counts[x["before"]] + mu)
            asked = np.flatnonzero(x["of_token"] >= 0)
            code = codes[x["of_token"][asked]]
            logs[asked[code != ABSENT]] = dequantise(code[code != ABSENT])
            lengths = unpack(block["lengths"], np.uint32).astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(block["ids"]), "Int64"), "held_out": ~np.array(block["train"], bool), "n_tokens": lengths,
                "n_known": np.add.reduceat((counts > 0)[x["tokens"]].astype(np.int64), starts), "train_tokens": tokens,
                "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(logs, starts),
            }))
        return pd.concat(out)

    return score


def leave_one_out(pair_counts: np.ndarray, context_counts: np.ndarray, follower_p: np.ndarray, mu: float) -> float:
    """Log-likelihood of the training pairs, each occurrence scored without itself: what ``MU`` is chosen by.

    Arrays have one entry for each distinct pair: its count, its context's count and its follower's
    unigram probability.
    """
    p = (pair_counts - 1 + mu * follower_p) / (context_counts - 1 + mu)
    return float((pair_counts * np.log(p)).sum())


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", mu: float = MU) -> tuple[DataFrame, DataFrame]:
    """Train on the rows where ``train`` holds and score every row.

    Returns the scores (``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one
    row per input row) and the model (``shard, n, trie``: each shard's serialised trie). Null texts
    are empty texts: one end token. ``train`` null counts as false. Null ids stay null; equal rows
    score alike; an empty table gives empty results; without training rows every token is unknown.
    Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(train, F.lit(False)), utf8(text_col))
    blocks = bucketed(rows.mapInArrow(_to_blocks, BLOCKS), "block")
    size = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    pair_shards, word_shards = size[0] // PAIR_SHARD + 1, size[1] // WORD_SHARD + 1
    asks = blocks.select("block", "words", "counts").mapInArrow(_ask_words(word_shards), WORD_ASKS)
    words = materialize(asks.groupBy("shard").applyInPandas(_answer_words(word_shards), ANSWERS), "words")  # small: distinct words only
    total = words.where("block is null").agg(F.coalesce(F.sum("kind"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    vocabulary, tokens = int(total[0]), int(total[1])
    to_block = words.where("block is not null").groupBy("block")
    asks = blocks.groupBy("block").cogroup(to_block).applyInPandas(_ask_pairs(word_shards, pair_shards), PAIR_ASKS)
    pairs = materialize(asks.groupBy("shard").applyInPandas(_answer_pairs(tokens, vocabulary, mu), ANSWERS), "pairs")
    answers = words.unionByName(pairs).where("block is not null")
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(word_shards, pair_shards, tokens, vocabulary, mu), SCORES)
    return out, pairs.where("block is null").select("shard", "n", F.col("ids").alias("trie"))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, ~held_out())[0]
