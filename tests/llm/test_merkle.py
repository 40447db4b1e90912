import hashlib
import zlib

import duckdb
import pytest

from tessellate.llm import merkle as mk
from tessellate.llm import queries

from ..compare import multiset
from .helpers import DOCS, SF


def sha(*hexes):
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def climb(nodes):
    """Root of a list of hex digests, and the (side, sibling) of each on its way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            ways[i].append(("L", nodes[p - 1]) if p % 2 else ("R", nodes[p + 1]) if p + 1 < len(nodes) else ("-", ""))
        nodes = [sha(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], ways


def digest(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    """Result rows of (doc_id, text, lang, source, n_chars) rows, by definition."""
    langs = {}
    for doc_id, text, lang, source, n in rows:
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
        leaf = digest((doc_id, source, lang, n, text))
        langs.setdefault(lang, []).append((doc_id, leaf, digest((doc_id, source, lang, n + 1, text)) if changed else leaf))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        langs[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {name: climb([leaf for _, leaf, _ in langs[name]]) for name in names}
    root, ways = climb([trees[n][0] for n in names]) if names else (None, [])
    out = []
    for name, top in zip(names, ways):
        subroot, own = trees[name]
        for (doc_id, leaf, start), way in zip(langs[name], own):
            node = start
            for side, x in way + top:
                node = sha(x, node) if side == "L" else sha(node, x)
            out.append((doc_id, leaf, subroot, root, sha(*(x for _, x in way + top)), node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(df, rows):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("levels", [1, 3])
def test_blocks_of_blocks(spark, levels):
    rows = [(i * 3 % 101, f"text {i}", ("en", "en", "de", "zz")[i % 4] if i != 5 else "fr", "s", i) for i in range(101)]
    same(mk.tampered_rows(spark.createDataFrame(rows, DOCS), levels), rows)


def test_edge_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (7, "a", "en", None, None),
            (7, "a", "en", None, None), (7, "b", "en", None, 1), (-4, "é漢𝄞\n", "Ω", "s", -1), (9, "x" * 300_000, None, "s", 2**63 - 1),
            *((i, "copy", "en", "hot", 4) for i in [3] * 20), *((i, "t", "en", "s", 1) for i in range(40))]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS place", "'x' AS tree", "2 AS row", "3 AS root")
    same(mk.tampered_rows(docs, 2), rows)
    same(mk.tampered_rows(docs.where("text = 'b'"), 2), rows[5:6])
    assert mk.tampered_rows(docs.limit(0)).collect() == []


def test_query_matches_its_oracle_and_tampering_shows(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rows = queries.QUERIES["op12_merkle"](spark, SF).collect()
    cur = con.execute(queries.ORACLE["op12_merkle"])
    names = [d[0] for d in cur.description]
    assert multiset(rows, COLUMNS, sorted(names)) == multiset(cur.fetchall(), names, sorted(names))
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
    assert not all(r.verified for r in rows)


def test_witnesses_grow_with_the_append():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(11)]
    tree = mk.Witnesses(4)
    for i, leaf in enumerate(leaves, 1):
        tree.append(leaf)
        assert [at for at, _, _ in tree.open] == [b for b in range(4, -1, -1) if i >> b & 1]
        for at, first, root in tree.open:
            for j in range(first, min(first + (1 << at), i)):
                sides, siblings = tree.witness(j)
                assert len(sides) == at and mk.fold(leaves[j], sides, siblings) == root
    before = [tree.witness(j) for j in range(8)]
    height, root = tree.close()
    want, ways = climb([x.hex() for x in leaves])
    assert (height, root.hex()) == (4, want)
    for j, leaf in enumerate(leaves):
        sides, siblings = tree.witness(j, height)
        assert sides.decode() == "".join(s for s, _ in ways[j]) and siblings.hex() == "".join(x for _, x in ways[j])
        assert mk.fold(leaf, sides, siblings) == root != mk.fold(leaves[j - 1], sides, siblings)
    assert all(tree.witness(j)[1].startswith(b) for j, (_, b) in enumerate(before))
    full = mk.Witnesses(1)
    full.append(b"a")
    assert full.close() == (0, b"a") and full.witness(0) == (b"", b"")
    full.append(b"b")
    with pytest.raises(ValueError):
        full.append(b"c")
