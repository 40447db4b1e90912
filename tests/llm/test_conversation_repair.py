import hashlib
import heapq
import random
import zlib

import duckdb
import pytest

from tessellate.llm import conversation_repair as cr
from tessellate.llm import queries

from ..compare import multiset
from .helpers import SF

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """Least (cost, audit, roles put out) by uniform-cost search over whole prefixes."""
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(codes) and last in ("", "a"):
            return cost, audit, out
        if (i, last) in done:
            continue
        done.add((i, last))
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, new, (*out, (new, None))))
        if i < len(codes):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if codes[i] != "F":
                x, over = codes[i].lower(), codes[i].isupper()
                heapq.heappush(heap, (cost + 2 + over, audit + "R", i + 1, new, (*out, (new, i))))
                if x in nexts[last]:
                    heapq.heappush(heap, (cost + over, audit + "K", i + 1, x, (*out, (None, i))))


def brute(rows):
    """Result tuples by conv_id of (conv_id, turn, role, text) rows, by definition."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, count = set(), "", {"B": 0, "D": 0, "T": 0, "-": 0}
        for _, role, text in turns:
            end = text.rstrip(WHITE)
            fault = "B" if not end else "D" if (role, text) in seen else "T" if end[-1] not in ".!?" else "-"
            seen.add((role, text))
            count[fault] += 1
            x = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "F" if fault in "BD" else x.upper() if fault == "T" else x
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, put = cheapest(codes)
        name = {"u": "user", "a": "assistant"}
        lines = [f"{name[x] if x else turns[i][1]}:{'' if i is None else turns[i][2]}" for x, i in put]
        out[conv] = (conv, gaps, count["B"], count["D"], count["T"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def same(df, rows):
    got = sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())
    assert got == sorted(map(str, brute(rows).values()))


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "well", "", " \n", None, "Done. ", f"{turn}?", f"{turn}.", "é…"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    return rows


def test_search_against_uniform_cost():
    rng = random.Random(5)
    for n in range(12):
        for _ in range(80):
            codes = "".join(rng.choice("FsuaxSUAXuaua") for _ in range(n))
            assert cr.search(codes) == cheapest(codes)[:2]
    for codes in ("u" * 64, "s" * 64, "X" * 64, "FsuaxSUAX" * 7, "sausXFuuaaS" * 20):
        assert cr.search(codes) == cheapest(codes)[:2]
    for _ in range(20):
        codes = "".join(rng.choice("FsuaxSUAX") for _ in range(300))
        assert min(w for (_, q), w in cr.through(codes, [0]).items() if q in cr.ACCEPTED) == cheapest(codes)[:2]


@pytest.mark.parametrize("block, longest", [(3, 12), (14, 150)])
def test_conversations_over_blocks_and_pieces(spark, monkeypatch, block, longest):
    monkeypatch.setattr(cr, "BLOCK", block)
    rows = random_rows(block, 30, longest)
    same(cr.repair(spark.createDataFrame(rows, TURNS)), rows)


def test_edge_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 0, "user", ""), (2, 0, "assistant", "."),
            (3, 5, "system", "Be brief."), (4, 1, "user", "same."), (4, 1, "user", "same."), (4, 1, "user", "same."),
            (5, None, "user", "A."), (5, None, "assistant", "B."), (-6, -2**63, "user", "x" * 300_000),
            (-6, 0, "assistant", "é?\x0b"), (7, 3, "ubuntu", "kept by its initial."), (7, 9, "a", "as well!"),
            *((8, i, "user", "hot.") for i in range(300))]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS pos", "'x' AS kind", "'y' AS audit", "2 AS number")
    ids = spark.createDataFrame([(3,), (99,), (99,), (None,)], "conv_id long")
    got = {r.conv_id: r for r in cr.repair(turns, ids).collect()}
    want = brute(rows)
    for conv, row in want.items():
        assert tuple(got[conv][c] for c in COLUMNS) == row
    none = hashlib.sha256(b"").hexdigest()
    assert tuple(got[99]) == (99, 0, 0, 0, 0, 0, 0, "", none) and len(got) == len(want) + 1
    assert cr.repair(turns.limit(0)).collect() == []


def test_query_matches_brute_force_and_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    df = queries.QUERIES["op11_conversation_repair"](spark, SF)
    cur = con.execute(queries.ORACLE["op11_conversation_repair"])
    names = [d[0] for d in cur.description]
    got = df.collect()
    assert multiset(got, df.columns, sorted(names)) == multiset(cur.fetchall(), names, sorted(names))
    rows, ids = [], set()
    for conv, turn, role, text in con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall():
        ids.add(conv)
        which = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if which == 1:
            text = ""
        elif which == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif which == 4:
            role = "user"
        rows += [(conv, turn, role, text)] * (0 if which == 0 else 2 if which == 3 else 1)
    want = brute(rows)
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == sorted(
        want.get(i, (i, 0, 0, 0, 0, 0, 0, "", none)) for i in ids)
