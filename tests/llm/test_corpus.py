import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from rollcall.llm import bpe, exact_dedup, html_extract, mixing, near_dedup, substring_dedup, vector_topk
from rollcall.llm.common import new_path, ship
from rollcall.llm.elias_fano import EliasFano, Trie

DOCS = [(1, "a b c " * 30, "x"), (2, "a b c " * 30, "x"), (3, None, None), (4, "", "y"), (5, "it's  <|endoftext|> ok\n\n 12", "y"), (5, "q w e r t", "x")]
OF = "doc_id long, text string, source string"


@pytest.fixture
def docs(spark):
    ship(spark)
    return spark.createDataFrame(DOCS, OF)


def test_elias_fano_and_trie():
    rng = np.random.default_rng(1)
    v = np.sort(rng.integers(0, 10**9, 1000).astype(np.uint64))
    assert (EliasFano(EliasFano.encode(v).words).get(np.arange(1000)) == v).all()
    pairs = np.unique(rng.integers(0, 50, (400, 2)), axis=0).astype(np.uint64)
    trie = Trie.mapped(Trie.build(pairs[:, 0], pairs[:, 1], np.full(len(pairs), -2.0)).to_bytes())
    known = {tuple(p) for p in pairs.tolist()}
    a, b = (x.ravel().astype(np.uint64) for x in np.meshgrid(np.arange(55), np.arange(55)))
    assert [(int(x), int(y)) in known for x, y in zip(a, b, strict=True)] == (trie.lookup(a, b) > 0).tolist()


def test_pivot_keeps_words():
    size, q = np.random.default_rng(2).integers(1, 90, 300).astype(float), 0.37
    p = mixing.settle(size, np.full(300, q), np.arange(300), 3, 0)
    assert abs((p * size).sum() - q * size.sum()) < 1e-6 and ((p > 0) & (p < 1)).sum() <= 1


def test_mix_and_dedup(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(DOCS) and all(r.taken <= 3 * r.size for r in rows)
    index = exact_dedup.DigestIndex(spark, new_path(spark, "t"))
    kept = {(r.doc_id, r.kept, r.group_size) for r in exact_dedup.dedup_batch(docs, index, "one").collect()}
    assert kept == {(1, True, 2), (2, False, 2), (3, True, 2), (4, False, 2), (5, True, 1)}
    again = exact_dedup.dedup_batch(docs, index, "two").collect()
    assert len(again) == len(DOCS) and not any(r.kept for r in again)


def test_empty(spark, docs):
    none = docs.where("false")
    assert mixing.mix(none).count() == near_dedup.near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeats(none, substring_dedup.FingerprintIndex(spark, new_path(spark, "f")), "b").count() == 0


def test_near(docs):
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3)} <= got


def test_tokens(docs):
    json_path, ranks_path = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
    t = Tokenizer.from_file(json_path)
    want = sorted(len(t.encode(x or "", add_special_tokens=False).ids) for _, x, _ in DOCS)
    assert sorted(r.n_tokens for r in bpe.count_tokens(docs, json_path, public_tokenizers.PATTERN).collect()) == want
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_file(ranks_path), special_tokens={})
    got = sorted(r.ids for r in bpe.encode(docs, ranks_path, public_tokenizers.PATTERN, chunk=40, overlap=12).collect())
    assert got == sorted(e.encode_ordinary(x or "") for _, x, _ in DOCS)


def test_repeats(spark):
    ship(spark)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "head " + " ".join(words) + " tail"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(docs, substring_dedup.FingerprintIndex(spark, new_path(spark, "f")), "b").collect()}
    assert out[2].kept == "head tail" and out[1].n_removed == 0
    assert out[3].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_top_k(spark):
    ship(spark)
    rows = [(i, [float(i % 5), 1.0]) for i in range(30)] + [(30, None), (31, [float("nan"), 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vector_topk.top_k(v, v.where("vec_id = 4"), k=3, shard=7).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [9, 14, 19]


def test_html():
    page = "<html><body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p>One <b>two<br><p>three</article><footer>F</footer>"
    assert html_extract.extract([page, "", page]) == ["T & U\n\nOne two\n\nthree", "", "T & U\n\nOne two\n\nthree"]
