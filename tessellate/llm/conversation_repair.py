"""Conversation structure repair: the cheapest edits that make the roles alternate."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellate.operators.split import global_position

from .common import per_worker, stored

WHITE = " \t\n\x0b\x0c\r"
BLOCK = 14  # bits: rows of 16,384 consecutive positions are read together
MEMO = 100_000  # searches that a process remembers
PIECE = 64  # rows that one search covers; longer conversations are composed of pieces

# Costs of the edits; their initials are the audit.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# What has been put out so far ends in nothing, s, u or a: states 0 to 3.
ENDS = "^sua"
ACCEPTED = frozenset({0, 3})
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))  # of an edit in a state: role, next state
LEGAL = {"^s", "^u", "^$", "su", "ua", "au", "a$"}
REACHED = ({0, 1, 2, 3}, {1, 2, 3}, {2, 3}, {2, 3})


def _bounds(rows: str, final: bool):
    """What the rows from each place on cost at least, in each state.

    Blank and repeated rows are deleted and other truncated ones cost their
    one; besides, of the neighbours left (with the state before and, if
    ``final``, the end behind) an edit mends two unfit pairs at most, and costs
    two at least beyond what the row was counted with.
    """
    n = len(rows)
    must, unfit, head = [0] * (n + 1), [0] * (n + 1), [""] * n + ["$" if final else ""]
    for i in range(n - 1, -1, -1):
        c = rows[i]
        if c == "F":
            must[i], unfit[i], head[i] = must[i + 1] + DELETE, unfit[i + 1], head[i + 1]
        else:
            x, after = c.lower(), head[i + 1]
            must[i] = must[i + 1] + (TRUNCATED if c != x else 0)
            unfit[i] = unfit[i + 1] + (after != "" and x + after not in LEGAL)
            head[i] = x
    return [[m + 2 * ((u + (h != "" and e + h not in LEGAL) + 1) // 2) for e in ENDS]
            for m, u, h in zip(must, unfit, head)]


def search(rows: str, entry: int = 0, goals: frozenset = ACCEPTED, final: bool = True) -> tuple[int, str] | None:
    """Least (cost, audit) that leads from state ``entry`` over all rows to one of ``goals``.

    ``rows`` has a letter for each: F if it must go, else the initial of its
    role (x for other roles), upper case if truncated. Depth first on an
    explicit stack, the child with the least bound first. A prefix is dropped
    if its cost and the bound of the rest exceed the incumbent's, or equal it
    with a later audit, or if the node's table holds a better prefix: costs and
    audits of the rest are the same for both, and of two audits of equal cost
    at one node neither begins the other.
    """
    n, bounds = len(rows), _bounds(rows, final)
    best: tuple[int, str] | None = None
    table = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if table[i, q] != (cost, audit):
            continue
        if best is not None:
            least = cost + bounds[i][q]
            if least > best[0] or (least == best[0] and audit > best[1][:len(audit)]):
                continue
        if i == n and q in goals:
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        wanted = WANTED[q][1]
        children = [(i, wanted, cost + INSERT, audit + "I")]
        if i < n:
            children.append((i + 1, q, cost + DELETE, audit + "D"))
            c = rows[i]
            if c != "F":
                x = c.lower()
                over = TRUNCATED if c != x else 0
                children.append((i + 1, wanted, cost + REROLE + over, audit + "R"))
                if (q, x) in STEP:
                    children.append((i + 1, STEP[q, x], cost + KEEP + over, audit + "K"))
        fresh = []
        for child in children:
            at, own = child[:2], child[2:]
            if REACHED[at[1]].isdisjoint(goals) or (at in table and table[at] <= own):
                continue
            table[at] = own
            fresh.append(child)
        fresh.sort(key=lambda x: (x[2] + bounds[x[0]][x[1]], x[3]), reverse=True)
        stack += fresh
    return best


def found(rows: str, entry: int = 0, goals: frozenset = ACCEPTED, final: bool = True) -> tuple[int, str] | None:
    """``search``, remembered by the Python process: most conversations look like others."""
    memo = per_worker().setdefault("repairs", {})
    key = (rows, entry, goals, final)
    if key not in memo:
        if len(memo) >= MEMO:
            memo.clear()
        memo[key] = search(*key)
    return memo[key]


def through(rows: str, entries) -> dict[tuple[int, int], tuple[int, str]]:
    """Least (cost, audit) from each of the states ``entries`` to each state, over pieces."""
    ways = {(e, e): (0, "") for e in entries}
    for at in range(0, len(rows), PIECE):
        piece = rows[at:at + PIECE]
        ways = join(ways, {(q, goal): way for q in {q for _, q in ways} for goal in REACHED[q]
                           if (way := found(piece, q, frozenset({goal}), False))})
    return ways


def join(before: dict, after: dict) -> dict:
    """The least of the ways that go on from where others end."""
    out: dict = {}
    for (entry, q), (cost, audit) in before.items():
        for (start, goal), (more, rest) in after.items():
            if start == q:
                way = (cost + more, audit + rest)
                if (entry, goal) not in out or way < out[entry, goal]:
                    out[entry, goal] = way
    return out


STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LONG = 2 ** 63 - 1


def _gaps(low, high, distinct) -> int:
    return min(high - low + 1 - distinct, LONG) if distinct else 0


def _part(kinds, initials, turns) -> dict:
    """What a run of a conversation's rows adds to its numbers."""
    known = [t for t in turns if t is not None]  # ascending
    return {"blank": kinds.count("B"), "duplicate": kinds.count("D"), "truncated": kinds.count("T"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "low": known[0] if known else None, "high": known[-1] if known else None,
            "distinct": sum(a != b for a, b in zip(known, known[1:])) + bool(known),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None}


PART = ("blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long, "
        "first string, last string")
SLICE = "conv_id long, pos long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
RUN = f"{SLICE}, whole boolean, part struct<{PART.replace(' long', ':long').replace(' string', ':string')}>, ways array<struct<entry:int,goal:int,cost:long,audit:string>>"


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def _runs(rows: DataFrame) -> DataFrame:
    """The runs of conversations in blocks of consecutive positions. A run between others
    is a whole conversation, and is repaired; at a block's ends it has the ways
    through it instead."""
    schema = _arrow(RUN)

    def run(key, table):
        table = table.sort_by("pos")
        convs, places, turns, initials, kinds = (table.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "initial", "kind"))
        out, n, start = [], len(convs), 0
        while start < n:
            end = start + 1
            while end < n and convs[end] == convs[start]:
                end += 1
            real = [i for i in range(start, end) if kinds[i] is not None]  # others only name the conversation
            codes = "".join("F" if kinds[i] in "BD" else initials[i].upper() if kinds[i] == "T" else initials[i]
                            for i in real)
            part = _part([kinds[i] for i in real], [initials[i] for i in real], [turns[i] for i in real])
            row = {"conv_id": convs[start], "pos": places[start], "whole": start > 0 and end < n, "part": part}
            if row["whole"]:
                if len(codes) <= PIECE:
                    cost, audit = found(codes)
                else:
                    cost, audit = min(way for (_, q), way in through(codes, [0]).items() if q in ACCEPTED)
                row |= {"audit": audit, "cost": cost, "gaps": _gaps(part["low"], part["high"], part["distinct"]),
                        **{c: part[c] for c in STATS[1:5]}}
            else:
                ways = through(codes, [0] if start > 0 else range(4))
                row["ways"] = [{"entry": e, "goal": q, "cost": c, "audit": a} for (e, q), (c, a) in ways.items()]
            out.append(row)
            start = end
        return pa.Table.from_pylist(out, schema)

    return rows.groupBy(F.shiftright("pos", BLOCK).alias("block")).applyInArrow(run, RUN)


def _composed(runs: DataFrame) -> DataFrame:
    """Slices of the audit for the runs of conversations that reach over blocks."""
    schema = _arrow(SLICE)

    def run(key, table):
        rows = table.sort_by("pos").to_pylist()
        ways, at = {(0, 0): (0, "")}, []
        total = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "distinct": 0, "low": None, "high": None, "last": None}
        for row in rows:
            part = row["part"]
            for c in ("blank", "duplicate", "truncated", "illegal", "distinct"):
                total[c] += part[c]
            if part["first"] is not None:
                if total["last"] is not None:
                    total["illegal"] += total["last"] + part["first"] not in ("su", "ua", "au")
                total["last"] = part["last"]
            if part["low"] is not None:
                total["distinct"] -= total["high"] == part["low"]
                total["low"], total["high"] = part["low"] if total["low"] is None else total["low"], part["high"]
            ways = join(ways, {(w["entry"], w["goal"]): (w["cost"], w["audit"]) for w in row["ways"]})
        cost, audit = min(way for (_, q), way in ways.items() if q in ACCEPTED)
        first = {"conv_id": rows[0]["conv_id"], "pos": rows[0]["pos"], "audit": audit, "cost": cost,
                 "gaps": _gaps(total["low"], total["high"], total["distinct"]), **{c: total[c] for c in STATS[1:5]}}
        return pa.Table.from_pylist([first], schema)

    return runs.groupBy("conv_id").applyInArrow(run, SLICE)


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _applied(audits: DataFrame, turns: DataFrame) -> DataFrame:
    """The audits applied to the texts, which go by in order; only a running hash of the
    repaired conversation is held. ``repaired_sha256`` is that of its turns as
    ``role:text``, joined by newlines."""
    schema = _arrow(RESULT)
    records = audits.withColumn("kind", F.lit(0)).unionByName(
        turns.select("conv_id", "pos", "role", "text", F.lit(1).alias("kind")), allowMissingColumns=True)

    class Repair:
        def __init__(self, row):
            self.row, self.left, self.state = row, row["audit"], 0
            self.at, self.hash, self.some = 0, hashlib.sha256(), False

        def put(self, role, text):
            self.hash.update(f"\n{role}:".encode() if self.some else f"{role}:".encode())
            self.hash.update(text.encode())
            self.some = True

        def wanted(self):
            role, self.state = WANTED[self.state]
            return role

        def inserts(self):
            while self.at < len(self.left) and self.left[self.at] == "I":
                self.put(self.wanted(), "")
                self.at += 1

        def turn(self, role, text):
            self.inserts()
            edit = self.left[self.at]
            self.at += 1
            if edit == "R":
                self.put(self.wanted(), text)
            elif edit == "K":
                self.state = STEP[self.state, role[0]]
                self.put(role, text)

        def result(self):
            self.inserts()
            return {**self.row, "repaired_sha256": self.hash.hexdigest()}

    def run(batches):
        now = None
        for batch in batches:
            out = []
            kinds, roles, texts = (batch.column(c).to_pylist() for c in ("kind", "role", "text"))
            heads = iter(batch.select(["conv_id", *STATS, "audit"]).filter(pa.compute.equal(batch.column("kind"), 0)).to_pylist())
            for kind, role, text in zip(kinds, roles, texts):
                if kind == 0:
                    if now is not None:
                        out.append(now.result())
                    now = Repair(next(heads))
                elif role is not None:
                    now.turn(role, text)
            yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    # an audit has the place of its conversation's first row, and stands before it
    return records.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", "kind").mapInArrow(run, RESULT)


def faults(text: Column) -> tuple[Column, Column]:
    """Whether a text has nothing but white space, and whether its last other character
    ends no sentence."""
    end = F.rtrim(text, F.lit(WHITE))
    return end == "", ~F.substring(end, -1, 1).isin(".", "!", "?")


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of every conversation of ``turns(conv_id, turn, role, text)``,
    and of every further one of ``ids(conv_id)``, which has no rows.

    Rows stand in the order of turn (nulls first), role and text. A row is
    blank, or repeats role and text of an earlier one, or is truncated; the
    cheapest edits (Keep, Rerole, Delete, Insert) give roles with the initials
    ``(s?(ua)+)?``; ``audit`` holds their initials, the least of equally cheap ones.

    Null role and text are one space; a null conv_id is a conversation of its
    own; repeated rows are duplicates; empty texts are blank; no rows give
    zeros, an empty audit and the hash of nothing; empty tables give no rows;
    other columns are not read. Rows are sorted by ranges and searched by
    blocks, so that a conversation of any share of the rows is spread over
    tasks; only its ways through blocks and, for the hash, its texts one by
    one pass through a task of its own.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    conv = F.col("conv_id").cast("long").alias("conv_id")
    rows = turns.select(conv, F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    if ids is not None:
        none = F.lit(None)
        rows = rows.union(ids.select(conv).distinct().select(
            "conv_id", none.cast("long"), none.cast("string"), none.cast("string")))
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "number")]
    blank, truncated = faults(F.col("text"))
    kind = F.when(F.col("role").isNull(), F.lit(None)).when(blank, "B").when(truncated, "T").otherwise("-")
    initial = F.substring("role", 1, 1)
    placed = stored(global_position(rows.withColumn("kind", kind).withColumn(
        "digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))), order).drop("number"), "turns")
    narrow = placed.select("conv_id", "pos", "turn", "kind", "digest",
                           F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"))
    again = (narrow.where("kind IS NOT NULL").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d"))
             .agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1"))
    flagged = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv_id", "pos", "turn", "initial",
        F.when((F.col("kind") != "B") & (F.col("pos") > F.col("first")), "D").otherwise(F.col("kind")).alias("kind"))
    runs = stored(_runs(flagged), "runs")
    names = [c.split()[0] for c in SLICE.split(", ")]
    audits = runs.where("whole").select(*names).union(_composed(runs.where("NOT whole")).select(*names))
    return _applied(audits, placed)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` damaged by crc32 of ``conv_id:turn``: of 20, number 0 is dropped,
    1 loses its text, 2 its sentence ends, 3 is there twice, 4 gets the role
    user. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    which = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(which == 1, "").when(which == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return turns.where(which != 0).select(
        "conv_id", "turn", F.when(which == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
        F.explode(F.when(which == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


_WAY = "STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])"


def _edit_sql(state: str, letter: str, cost: str, line: str | None = None, where: str = "true") -> str:
    added = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return (f"CASE WHEN {state} IS NULL OR NOT ({where}) THEN NULL ELSE "
            f"CAST({{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {added}}} AS {_WAY}) END")


def _inserted_sql(source: str, columns: str) -> str:
    """The states of ``source(s0, s1, s2, s3)`` after any inserts."""
    user = ", ".join(_edit_sql(s, "I", str(INSERT), "'user:'") for s in ("s0", "s1", "s3"))
    return f"""SELECT {columns}, s0, s1, s2, least(s3, {_edit_sql("s2", "I", str(INSERT), "'assistant:'")}) AS s3
    FROM (SELECT {columns}, s0, s1, least(s2, {user}) AS s2, s3 FROM ({source}))"""


def _repair_sql() -> str:
    from .merkle import CRC_SQL, _crc32_sql

    over = f"CASE kind WHEN 'T' THEN {TRUNCATED} ELSE 0 END"
    gone = {s: _edit_sql(s, "D", str(DELETE)) for s in ("s0", "s1", "s2", "s3")}
    kept = lambda s, x: _edit_sql(s, "K", over, "role || ':' || text", f"kind IN ('T', '-') AND initial = '{x}'")
    turned = lambda s, r: _edit_sql(s, "R", f"{REROLE} + {over}", f"'{r}:' || text", "kind IN ('T', '-')")
    to_user = ", ".join(f"{kept(s, 'u')}, {turned(s, 'user')}" for s in ("s0", "s1", "s3"))
    columns = "conv_id, i, role, text, kind, initial"
    source = """SELECT w.conv_id, r.i, r.role, r.text, r.kind, r.initial, s0, s1, s2, s3
      FROM ways w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1"""
    return f"""
WITH RECURSIVE {CRC_SQL},
spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
drawn AS (SELECT spaced.*, {_crc32_sql("place")} % 20 AS which FROM spaced, crc),
rows AS (
  SELECT conv_id, turn, CASE WHEN which = 4 THEN 'user' ELSE role END AS role,
    CASE which WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(2) copies(k) WHERE which <> 0 AND (k = 0 OR which = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, role[1] AS initial FROM rows),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'B'
      WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'D'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'T' ELSE '-' END AS kind,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE kind = 'B') AS blank, count(*) FILTER (WHERE kind = 'D') AS duplicate,
    count(*) FILTER (WHERE kind = 'T') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id),
ways AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 't': []}} AS {_WAY}) AS s0,
    CAST(NULL AS {_WAY}) AS s1, CAST(NULL AS {_WAY}) AS s2, CAST(NULL AS {_WAY}) AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, i, {gone["s0"]}, least({gone["s1"]}, {kept("s0", "s")}), least({gone["s2"]}, {to_user}),
    least({gone["s3"]}, {kept("s2", "a")}, {turned("s2", "assistant")})
  FROM ({_inserted_sql(source, columns)})),
ends AS (
  SELECT conv_id, least(s0, s3) AS best FROM ({_inserted_sql(
      "SELECT w.* FROM ways w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.i = coalesce(c.n, 0)",
      "conv_id, i")}))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost,
  best.a AS audit, sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


REPAIR_SQL = _repair_sql()
