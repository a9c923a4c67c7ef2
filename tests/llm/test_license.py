import duckdb
import numpy as np
import pytest

from rollcall.llm import license_scan as L
from rollcall.llm.common import ship


def spell(template, rng):
    """A text that a template accepts: some optional regions, any words where it is replaceable."""
    out, skip = [], []
    for token in L.re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template):
        if token == "[":
            skip.append(rng.random() < 0.5)
        elif token == "]":
            skip.pop()
        elif any(skip):
            continue
        elif token[0] == "{":
            low, high = map(int, token[1:-1].split("-"))
            out += ["Any"] * int(rng.integers(low, high + 1))
        else:
            out.append(str(rng.choice(token.split("|"))).upper())
    return out


def rows():
    rng = np.random.default_rng(12)
    texts = [None, "", "Released under the MIT License.", "under the MIT, license", "CC-BY-NC cc by\nnc cc by n c", "Apache License, Version 2.0", "ÄPACHE license version 2", "under under the mit license" * 2]
    for _, t in L.TEMPLATES:
        words = spell(t, rng)
        texts.append("so: " + ", ".join(words) + " end")
        cut = int(rng.integers(0, len(words)))
        texts.append(" ".join(words[:cut] + words[cut + 1 :]))  # a mandatory or free word is gone
        texts.append(" ".join(words[:cut] + ["extra"] + words[cut:]))
    return [(i, t) for i, t in enumerate([*texts, texts[2], "w " * 1_200_000 + "under the mit license"])] + [(None, "x cc by nc"), (3, "again cc by nc")]


def test_scan_equals_regular_expressions(spark, tmp_path):
    ship(spark)
    spark.createDataFrame([(*r, 1, "x") for r in rows()], "doc_id long, text string, labels int, n_words string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op12_licenses(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(L.OP12_SQL)
    assert got.columns == want.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_every_template_is_accepted_and_its_wording_is_mandatory():
    m, rng = L.Machine(L.TEMPLATES), np.random.default_rng(5)
    for t, (_, text) in enumerate(L.TEMPLATES):
        for _ in range(10):
            words = spell(text, rng)
            assert any(k == t and end == len(words) - 1 for k, end in m.scan(" ".join(words).encode())[1])
    plain = dict(L.TEMPLATES)["unlicense"].split()
    for cut in range(len(plain)):
        assert not L.Machine([("u", " ".join(plain))]).scan(" ".join(plain[:cut] + plain[cut + 1 :]).encode())[1]


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_pieces_and_forgotten_states_change_nothing(monkeypatch, piece):
    body = " ".join("so " + " ".join(spell(t, np.random.default_rng(9))) for _, t in L.TEMPLATES).encode()
    want = L.Machine(L.TEMPLATES).scan(body)
    monkeypatch.setattr(L, "PIECE", piece)
    monkeypatch.setattr(L, "STATES", 2)
    assert L.Machine(L.TEMPLATES).scan(body) == want


def test_spans_and_empty(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "a licensed under the mit license b")], "doc_id long, text string")
    row = L.scan_licenses(df).first()
    assert (row.n_base, row.first_word, row.ends, row.found) == (1, 2, [5], ["mit"])
    assert L.scan_licenses(df.where("false")).count() == 0
