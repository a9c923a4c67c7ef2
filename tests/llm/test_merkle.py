import zlib
from hashlib import sha256

import pytest

from rollcall.llm import merkle
from rollcall.llm.common import ship

OF = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*(enc(v) for v in (*r[:4], text)))


def tree(leaves):
    """All levels of a tree, bottom up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def proof(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i - i % 3
        out.append((i - a, [x for k, x in enumerate(nodes[a : a + 3], a) if k != i]))
        i //= 3
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for docs in by.values():
        docs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r, r[4]) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, r in enumerate(by[s]):
            path = proof(trees[s], i) + proof(top, at)
            odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
            f = leaf(r, r[4] if odd or r[4] is None else r[4].replace("\n", ""))
            for place, others in path:
                f = h(*others[:place], f, *others[place:])
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], h(*(x for _, o in path for x in o)), f, f == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", range(1, 90))
def test_positions_are_those_of_the_log(size):
    leaves = [sha256(bytes([i])).digest() for i in range(size)]
    height = merkle.height_of(size)
    log, levels = merkle.postorder(leaves, height), tree([x.hex() for x in leaves])
    assert len(log) == 32 * sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for i, node in enumerate(nodes):
            p = merkle.position(level, i, size, height)
            assert log[32 * p : 32 * p + 32].hex() == node
    assert all(merkle.fold(leaves[i], merkle.path_of(log, i, size, height)).hex() == levels[-1][0] for i in range(size))


def test_manifest_equals_plain_trees(spark, monkeypatch):
    """Two bands and more, a hot source, many sources, nulls in every field, equal rows, a long text, clashing columns."""
    ship(spark)
    rows = [(i, "hot", "en", i, f"a\n{i}") for i in range(700)] + [(i, f"s{i:03d}", None, None, f"é\n\n{i}") for i in range(300)]
    rows += [(None, None, None, None, None), (None, None, "x", 1, "\n"), (5, "hot", "en", 5, "a\n5"), (5, "hot", "en", 5, "other"), (7, "", "en", 0, ""), (8, "Ünï", "de", 3, "long \n" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], OF)
    assert got(merkle.manifest(df)) == plain(rows)


def test_empty_and_single(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "a", "en", 1, "x", 1, "t")], OF)
    assert merkle.manifest(df.where("false")).count() == 0
    row = merkle.manifest(df).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == h()
