"""Each stage of the pipeline against a plain version, on rows with nulls, repeats and clashing names."""

import hashlib
import itertools
import re
from collections import Counter

import corpus_pipeline as P
import public_tokenizers
import pytest
import tiktoken
import xxhash
from rollcall.llm import bpe

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 97}x{i % 13}" for i in range(400))
ROWS = [
    (1, "a b c d e f g", "en", "x", 7, 0),
    (2, "a b  c d e f g", "en", "x", 8, 0),  # equal to 1, longer: stays instead of it
    (3, "a b c d e f g", None, None, 7, 0),
    (4, None, "de", "y", None, 1),
    (5, "", "de", "y", 0, 1),
    (5, "p q r s t", "de", "y", 9, 1),  # an id that stands twice
    (None, "p q r s t", "de", "y", 9, 1),
    (None, "m n o", "de", None, 5, 2),
    (7, "u v w", "fr", "z", 5, 2),
    (7, "u v w", "fr", "z", 5, 2),  # a row that stands twice
    (8, LONG, "fr", "z", len(LONG), 2),
    (9, LONG + " tail", "fr", "z", len(LONG) + 5, 2),
    (10, LONG.upper(), "fr", "y", len(LONG), 2),
]
OF = "doc_id long, text string, lang string, source string, n_chars long, size int"


@pytest.fixture
def docs(spark):
    """``size`` is an extra column that clashes with one of an operator."""
    return spark.createDataFrame(ROWS, OF)


def rows(df):
    return Counter(map(tuple, df.collect()))


def last(i):
    return (i is None, i or 0)


def plain_exact(table):
    best = {}
    for r in table:
        key = re.sub(r"[\x20\x09-\x0d]", "", r[1] or "")
        rank = (-len(r[1] or ""), last(r[0]))
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    return Counter(r for _, r in best.values())


def plain_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_near(table):
    fp = [plain_fingerprint(r[1]) for r in table]
    group = list(range(len(table)))
    for i, j in itertools.combinations(range(len(table)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= 2 and group[i] != group[j]:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    return {min((last(table[i][0]) for i in range(len(table)) if group[i] == g)) for g in set(group)}, len(set(group))


def test_exact(spark, docs):
    assert rows(P.exact(spark, docs, "")) == plain_exact(ROWS)


def test_near(spark, docs):
    got = P.near(spark, docs, "").collect()
    winners, n = plain_near(ROWS)
    assert len(got) == n and {last(r.doc_id) for r in got} == winners
    assert all(tuple(r) in ROWS for r in got) and list(got[0].asDict()) == docs.columns


def test_mix(spark, docs):
    got = rows(P.mix(spark, docs, ""))
    held = Counter(ROWS)
    assert set(got) <= set(held) and all(n <= 3 * held[r] for r, n in got.items())
    # By code point x, y, z, null weigh 1, 2, 3, 1; words taken come near the targets that follow.
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    weight, target, left = {"x": 1, "y": 2, "z": 3, None: 1}, {}, sum(sizes.values())
    while True:
        open_ = [s for s in weight if s not in target]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
    taken = Counter()
    for r, n in got.items():
        taken[r[3]] += n * len(WORDS.findall(r[1] or ""))
    for s in weight:
        largest = max(len(WORDS.findall(r[1] or "")) for r in ROWS if r[3] == s)
        assert abs(taken[s] - target[s]) <= largest


def test_tokenise(spark, docs):
    ranks = bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [e.encode_ordinary(r[1] or "") for r in ROWS]
    want = Counter((r[0], len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r, i in zip(ROWS, ids, strict=True))
    assert rows(P.tokenise(spark, docs, "").drop("ids")) == want


def test_quality(spark, docs, tmp_path):
    """Noise goes and trusted text stays, whatever its id; all is kept where nothing is trusted."""
    good = [(100 + i, " ".join(f"the cat sat on mat {j % 7}" for j in range(i, i + 20)), "en", "x", 0, 0) for i in range(40)]
    noise = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(3000))
    table = [*good, (7, noise, "en", "x", 0, 0), (None, noise, None, None, 0, 0), (7, good[0][1], "en", "x", 0, 0), (None, None, None, None, None, None)]
    spark.createDataFrame([(r[0], 1, 0) for r in good], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = rows(P.quality_filter(spark, spark.createDataFrame(table, OF), str(tmp_path)))
    assert got == Counter(r for r in table if r[1] != noise)
    none = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert rows(P.quality_filter(spark, docs, str(none))) == Counter(ROWS)


def test_empty_table_is_classified(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = P.quality_filter(spark, docs.where("false"), str(tmp_path))
    assert got.count() == 0 and got.columns == docs.columns


def test_run(spark):
    """The whole pipeline on the smallest table: the stages one after the other, each on what the one before kept, and what the last one says of it."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, held = docs.columns, rows(docs)
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        now = rows(docs)
        assert docs.columns == columns and set(now) <= set(held), name
        assert name == "mix to target weights" or now <= held
        held = now
    want = Counter((r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in held.elements())
    got = rows(P.run(spark, sf).select("doc_id", "decoded_sha256"))
    assert got == want and sum(got.values()) > 50


@pytest.mark.parametrize("stage", [P.exact, P.near, P.mix, P.tokenise])
def test_empty(spark, docs, stage):
    assert stage(spark, docs.where("false"), "").count() == 0
