"""Encoding in chunks and own merges against the public library."""

import random

import public_tokenizers
import pytest
import tiktoken

from rollcall.llm import bpe
from rollcall.llm.common import ship

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_file(PATH), special_tokens={})


def test_merges_of_ranks(library):
    rng, c = random.Random(3), bpe.codec(PATH, public_tokenizers.PATTERN)
    for _ in range(3000):
        text = "".join(rng.choice("abcdeth inouersé ßçñ日本\U0001f600.,1\n'") for _ in range(rng.randrange(0, 40)))
        ids = c.ids(c.pattern.findall(text))
        assert ids == library.encode_ordinary(text) and c.decode(ids) == text.encode()


@pytest.mark.parametrize(("chunk", "overlap"), [(50, 20), (64, 64), (30, 3)])
def test_long_texts(spark, library, chunk, overlap):
    """Chunks whose boundaries meet, and those that never do: one long word, and overlaps shorter than a pre-token."""
    ship(spark)
    rng = random.Random(chunk)
    texts = [" ".join(rng.choice(["it's", "1234567", "wörd", "  ", "\n\n", "longerwordhere", "日本語"]) for _ in range(200)) for _ in range(6)]
    texts += ["x" * 500, " " * 400, "a " * 300 + "y" * 300, None, "", "short", texts[0]]
    rows = [(i if i % 3 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    got = sorted((str(r.doc_id), list(r.ids)) for r in bpe.encode(docs, PATH, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap).collect())
    assert got == sorted((str(d), library.encode_ordinary(t or "")) for d, t, _ in rows)
    assert bpe.encode(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_counts_of_awkward_rows(spark):
    """No rows, and columns that clash with the operator's own."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "a b", "x", 5), (None, None, None, None), (1, "word " * 40_000, "x", 5)], "doc_id long, text string, body string, n_bytes int")
    got = {(r.doc_id, r.n_bytes, r.over_limit) for r in bpe.count_tokens(docs, path, public_tokenizers.PATTERN).collect()}
    assert got == {(1, 3, False), (None, 0, False), (1, 200_000, True)}
    assert bpe.count_tokens(docs.where("false"), path, public_tokenizers.PATTERN).count() == 0


def test_chunks_of_real_size(library):
    """Texts of many chunks at the sizes that are used: words, long runs of blanks and signs, one long word, and no blanks at all."""
    rng, c = random.Random(8), bpe.codec(PATH, public_tokenizers.PATTERN)
    made = ["".join(rng.choice(["it's", "12345678", " wörd", "   ", "\n\n", " longerwordhere", "日本語", "!?", " "]) for _ in range(k)) for k in (900, 3_000, 20_000)]
    made += ["x" * 20_000, " " * 20_000 + "end", "ab " * 3_000 + " " * 300 + "cd" * 3_000, "日本" * 5_000, "a" * 4_096, "a b" * 1_366]
    for text in made:
        assert c.pieces(text) == c.pattern.findall(text)
        assert c.ids(c.pieces(text)) == library.encode_ordinary(text)
    assert all(c.merges.ids(w.encode()) == library.encode_ordinary(w) for w in ("abc" * 15, "abc" * 17, "é" * 24, "é" * 25) if w.encode() not in c.whole)


def test_special_strings_inside_texts(spark):
    ship(spark)
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    texts = [f"a{s}b {s}{s} x {s[:-1]} {s[1:]}" for s in special] + ["".join(special) * 3, " ".join(special)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in bpe.count_tokens(rows, path, public_tokenizers.PATTERN).collect()}
    assert got == {i: len(own.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
