"""Merkle dataset manifest: a hash tree over all rows, with a witness for each row."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellate.operators.split import global_position

from .common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CHECKED = 1_024  # rows folded at a time
LEVELS = 12  # of a block: 4,096 leaves, or roots of blocks, in a task at a time

# Where the sibling of a node on the way to the root stands.
LEFT, RIGHT, NONE = b"LR-"
SIZE = 32  # bytes of a digest


def h(*digests: bytes) -> bytes:
    """Digest of a node from its children's, which are hashed as hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


class Witnesses:
    """An append-only tree of 2 ** ``levels`` leaves at most, and its leaves' witnesses.

    Open subtrees stand on a stack, of falling heights, as in a binary counter.
    A leaf opens a subtree of its own with an empty witness; when a subtree
    gets a sibling of its height, both close into their parent, and the
    witnesses of all leaves below are extended by the other's root. ``close``
    ends the append: nodes without a sibling are hashed alone.
    """

    def __init__(self, levels: int = LEVELS):
        self.levels, self.n = levels, 0
        self.open: list[tuple[int, int, bytes]] = []  # height, first leaf, root
        self.siblings = np.zeros((16, levels, SIZE), np.uint8)
        self.sides = np.full((16, levels), NONE, np.uint8)

    def append(self, leaf: bytes) -> None:
        if self.n == 1 << self.levels:
            raise ValueError("the tree is full")
        if self.n == len(self.siblings):
            self.siblings = np.concatenate([self.siblings, np.zeros_like(self.siblings)])
            self.sides = np.concatenate([self.sides, np.full_like(self.sides, NONE)])
        self.open.append((0, self.n, leaf))
        self.n += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _join(self) -> None:
        (height, first, left), (_, mid, right) = self.open[-2:]
        for low, high, side, root in ((first, mid, RIGHT, right), (mid, self.n, LEFT, left)):
            self.siblings[low:high, height] = np.frombuffer(root, np.uint8)
            self.sides[low:high, height] = side
        self.open[-2:] = [(height + 1, first, h(left, right))]

    def close(self, height: int | None = None) -> tuple[int, bytes]:
        """Height and root of the whole. The last subtree is raised until it meets its
        left neighbour; with ``height``, the root is raised to that one."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, first, root = self.open[-1]
            if len(self.open) > 1 and at == self.open[-2][0]:
                self._join()
            else:
                self.open[-1] = (at + 1, first, h(root))
        return self.open[0][0], self.open[0][2]

    def witness(self, i: int, height: int | None = None) -> tuple[bytes, bytes]:
        """Sides, and siblings in their order, of leaf ``i`` up to ``height`` (null: what it
        has so far, up to the root of its open subtree)."""
        if height is None:
            height = next(at for at, first, _ in reversed(self.open) if first <= i)
        sides = self.sides[i, :height]
        return sides.tobytes(), self.siblings[i, :height][sides != NONE].tobytes()


def fold(leaf: bytes, sides: bytes, siblings: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    at, node = 0, leaf
    for side in sides:
        if side == NONE:
            node = h(node)
            continue
        sibling = siblings[at:at + SIZE]
        at += SIZE
        node = h(sibling, node) if side == LEFT else h(node, sibling)
    return node


def leaf(*values: Column) -> Column:
    """Digest of a row: of each value the count of its bytes, a colon and the value, or
    a dash for null."""
    def part(v):
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(v) for v in values]), 256))


def _grow(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, place, row, root, sides, siblings``: a row for each of ``nodes(tree, place,
    n, row, root)`` with its witness within its block of 2 ** ``levels``
    consecutive places, and one for each block with its number as place, its
    root, and null sides. A tree's only block ends where one node remains;
    blocks with others all reach the same height."""

    def run(key, rows):
        rows = rows.sort_by("place")
        alone = rows.column("n")[0].as_py() <= 1 << levels
        tree = Witnesses(levels)
        for root in rows.column("root").to_pylist():
            tree.append(root)
        height, root = tree.close(None if alone else levels)
        sides, siblings = zip(*(tree.witness(i, height) for i in range(tree.n)))
        each = pa.table([rows.column("tree"), rows.column("place"), rows.column("row"), rows.column("root"),
                         pa.array(sides, pa.binary()), pa.array(siblings, pa.binary())],
                        ["tree", "place", "row", "root", "sides", "siblings"])
        whole = pa.table([[key[0].as_py()], [key[1].as_py()], pa.nulls(1, each.schema.field("row").type), [root],
                          pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], schema=each.schema)
        return pa.concat_tables([each, whole])

    row = nodes.schema["row"].dataType.simpleString()
    blocked = nodes.select("tree", "place", "n", "row", "root", F.shiftright("place", levels).alias("block"))
    return stored(blocked.groupBy("tree", "block").applyInArrow(
        run, f"tree long, place long, row {row}, root binary, sides binary, siblings binary"), "witnesses")


def witnesses(leaves: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``tree, row, leaf, sides, siblings`` of every row of ``leaves(tree, place, n, row,
    root)``, and ``tree, root`` of every tree.

    ``place`` counts the leaves of a tree from 0, ``n`` is their number, ``row`` a
    struct that is carried along. The leaves of blocks are appended in
    parallel; the roots of a tree's blocks are appended to a tree of their
    own, by blocks again, and what extends their witnesses extends those of all
    leaves below. No task has more than a block, however large a tree is.
    """
    steps, tops, nodes = [], [], leaves
    while True:
        grown = _grow(nodes, levels)
        steps.append(grown.where(F.col("sides").isNotNull()))
        blocks = grown.where(F.col("sides").isNull()).select("tree", "place", "row", "root")
        counts = blocks.groupBy(F.col("tree").alias("t")).agg(F.count("*").alias("n"))
        counted = stored(blocks.join(counts, F.col("tree") == F.col("t")).drop("t"), "block-roots")
        tops.append(counted.where("n = 1").select("tree", "root"))
        nodes = counted.where("n > 1")
        if nodes.isEmpty():
            break
    above = None
    for grown in reversed(steps):
        own = grown.select("tree", "place", "row", F.col("root").alias("leaf"), "sides", "siblings")
        if above is not None:
            own = own.join(above, (F.col("tree") == F.col("above_tree")) & (F.shiftright("place", levels) == F.col("above_place")),
                           "left").select("tree", "place", "row", "leaf", *(
                               F.concat(c, F.coalesce(f"above_{c}", F.lit(b""))).alias(c) for c in ("sides", "siblings")))
        above = own.select(*(F.col(c).alias(f"above_{c}") for c in ("tree", "place", "sides", "siblings")))
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.union(more)
    return own.drop("place"), roots


def numbered(rows: DataFrame, group: str, order: list[str], levels: int = LEVELS) -> DataFrame:
    """``rows`` with ``tree`` (a number for each value of ``group``, ascending, nulls first),
    ``place`` (from 0, in ``order``) and ``n`` (rows of the group)."""
    placed = stored(global_position(rows, [F.col(c).asc_nulls_first() for c in (group, *order)], "pos"), "leaves")
    groups = placed.groupBy(F.col(group).alias("g")).agg(F.min("pos").alias("tree"), F.count("*").alias("n"))
    return placed.join(groups, F.col(group).eqNullSafe(F.col("g"))).select(
        *rows.columns, "tree", (F.col("pos") - F.col("tree")).alias("place"), "n")


def manifest(docs: DataFrame, start: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, start, subroot, root, sides, siblings`` of every row of ``docs(doc_id,
    source, lang, n_chars, text)``: its place in the hash tree over all rows, as
    binary digests, and its witness up to ``root``. ``start`` is any other digest
    of the row to be carried along (null: the leaf).

    Leaves are the digests of FIELDS. Those of a lang form a tree, by doc_id
    (nulls first; rows with the same id by digest, so that repeated rows are
    leaves of their own whose order does not matter); the roots of these
    trees, by lang (null first), form the tree of ``root``.

    Null and empty values, and texts of any length, have digests of their own;
    an empty table gives no rows; other columns are not read. A lang may hold
    any share of the rows: its leaves are sorted by ranges and hashed by blocks.
    """
    # the text is read once; rows are numbered for the order of equal ones, which may be any, but must not change
    hashed = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf(*map(F.col, FIELDS)).alias("leaf"), (F.lit(None).cast("binary") if start is None else start).alias("start"),
        F.monotonically_increasing_id().alias("number")), "leaf-digests")
    placed = numbered(hashed, "lang", ["doc_id", "leaf", "number"])
    rows, subroots = witnesses(placed.select("tree", "place", "n", F.struct("doc_id", "start").alias("row"),
                                             F.col("leaf").alias("root")), levels)
    # trees are numbered in the order of lang
    tops = numbered(stored(subroots.select(F.lit(0).alias("all"), F.col("tree").alias("lang_tree"), "root"), "subroots"),
                    "all", ["lang_tree"]).select("tree", "place", "n", F.struct("lang_tree").alias("row"), "root")
    top_rows, top = witnesses(tops, levels)
    root = top.select("root").first()
    last = top_rows.select(F.col("row.lang_tree").alias("lang_tree"), F.col("leaf").alias("subroot"),
                           F.col("sides").alias("top_sides"), F.col("siblings").alias("top_siblings"))
    return rows.join(last, F.col("tree") == F.col("lang_tree")).select(
        "row.doc_id", "leaf", F.coalesce("row.start", "leaf").alias("start"), "subroot",
        F.lit(root["root"] if root else None).cast("binary").alias("root"),
        F.concat("sides", "top_sides").alias("sides"), F.concat("siblings", "top_siblings").alias("siblings"))


def verify(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, leaf, start, subroot, root, sides, siblings)`` with hex digests, a digest
    of the witness, ``folded_root`` that ``start`` and the witness lead to, and
    whether it is ``root``."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHECKED):
                ids, *binary, sides, siblings = batch.slice(at, CHECKED).columns
                leaves, starts, subroots, roots = (c.to_pylist() for c in binary)
                siblings = siblings.to_pylist()
                folded = [fold(*x) for x in zip(starts, sides.to_pylist(), siblings)]
                proofs = [hashlib.sha256(s.hex().encode()).hexdigest() for s in siblings]
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([d.hex() for d in c], pa.string()) for c in (leaves, subroots, roots)),
                     pa.array(proofs, pa.string()), pa.array([d.hex() for d in folded], pa.string()),
                     pa.array([f == r for f, r in zip(folded, roots)], pa.bool_())],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select("doc_id", "leaf", "start", "subroot", "root", "sides", "siblings").mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered_rows(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs``, checked with every row's own leaf, or with that of the row
    and one more in n_chars where 7 divides the crc32 of its id (nulls stay)."""
    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    more = [F.col("n_chars").cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    return verify(manifest(docs, F.when(changed, leaf(*more)), levels))


def _crc32_sql(text: str) -> str:
    """DuckDB expression of a string's unsigned crc32 (ASCII); needs ``crc`` of CRC_SQL in FROM."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda a, b: xor(a >> 8, crc.t[CAST(xor(a & 255, b) AS INTEGER) + 1])), 4294967295)")


# The table of the checksum: eight steps of the polynomial for each byte.
CRC_SQL = """crc_steps(n, k, c) AS (
  SELECT CAST(n AS BIGINT), 0, CAST(n AS BIGINT) FROM range(256) r(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM crc_steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE k = 8)"""


def _levels_sql(name: str, group: str, depth: int) -> str:
    """CTEs ``<name>0`` ... of a tree's levels from ``<name>0(group, p, x, n)``: the nodes of a
    level, or those of a finished tree again."""
    out = []
    for k in range(depth):
        out.append(f"""{name}{k + 1} AS (
  SELECT {group}, p // 2 AS p, sha256(string_agg(x, '' ORDER BY p)) AS x, (any_value(n) + 1) // 2 AS n
  FROM {name}{k} WHERE n > 1 GROUP BY {group}, p // 2
  UNION ALL SELECT {group}, p, x, n FROM {name}{k} WHERE n = 1)""")
    return ",\n".join(out)


def _steps_sql(name: str, group: str, depth: int) -> str:
    """Every leaf's way up, as (key, level, step): the side and hex digest of its sibling."""
    parts = [f"""SELECT l.key, {k} AS level, CASE WHEN s.x IS NULL THEN '-' WHEN s.p < c.p THEN 'L' || s.x ELSE 'R' || s.x END AS step
  FROM {name}_leaves l JOIN {name}{k} c ON c.{group} IS NOT DISTINCT FROM l.{group} AND c.p = l.p >> {k} AND c.n > 1
  LEFT JOIN {name}{k} s ON s.{group} IS NOT DISTINCT FROM c.{group} AND s.p = xor(c.p, 1)""" for k in range(depth)]
    return " UNION ALL ".join(parts)


def _manifest_sql(depth: int = 24, top_depth: int = 8) -> str:
    def field(c, value):
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def digest(changed: bool):
        values = {c: f"CAST({c} AS VARCHAR)" for c in FIELDS}
        if changed:
            values["n_chars"] = "CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)"
        return "sha256(" + " || ".join(field(c, v) for c, v in values.items()) + ")"

    return f"""
WITH RECURSIVE {CRC_SQL},
hashed AS (SELECT doc_id, lang, {digest(False)} AS leaf,
  CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {digest(True)} ELSE {digest(False)} END AS start
  FROM documents, crc),
d_leaves AS (
  SELECT *, row_number() OVER () AS key, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    count(*) OVER (PARTITION BY lang) AS n FROM hashed),
d0 AS (SELECT lang, p, leaf AS x, n FROM d_leaves),
{_levels_sql("d", "lang", depth)},
t_leaves AS (
  SELECT 0 AS g, lang AS key, x AS leaf, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM d{depth}),
t0 AS (SELECT g, p, leaf AS x, n FROM t_leaves),
{_levels_sql("t", "g", top_depth)},
d_ways AS (SELECT key, list(step ORDER BY level) AS steps FROM ({_steps_sql("d", "lang", depth)}) GROUP BY key),
t_ways AS (SELECT key, list(step ORDER BY level) AS steps FROM ({_steps_sql("t", "g", top_depth)}) GROUP BY key),
whole AS (
  SELECT l.*, t.leaf AS subroot, (SELECT x FROM t{top_depth}) AS root,
    list_concat(coalesce(w.steps, []), coalesce(v.steps, [])) AS steps
  FROM d_leaves l JOIN t_leaves t ON t.key IS NOT DISTINCT FROM l.lang
  LEFT JOIN d_ways w ON w.key = l.key LEFT JOIN t_ways v ON v.key IS NOT DISTINCT FROM l.lang),
folded AS (
  SELECT *, list_reduce(list_prepend(start, steps), lambda a, s: sha256(
      CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
"""


MANIFEST_SQL = _manifest_sql()
