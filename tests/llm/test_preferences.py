import duckdb
import pytest

from tessellate.llm import preferences as pf
from tessellate.llm import queries

from ..compare import multiset
from .helpers import SF

TURNS = "conv_id long, turn long, role string, text string"


def test_query_matches_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    df = queries.QUERIES["op8_preferences"](spark, SF)
    cur = con.execute(queries.ORACLE["op8_preferences"])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert multiset(df.collect(), df.columns, sorted(names)) == multiset(cur.fetchall(), names, sorted(names))


def test_shared_turns_are_rendered_once(spark):
    rows = [(0, 0, "system", "Be brief."), (0, 1, "user", "Hi"), (0, 2, "assistant", "Hello!"),
            (1, 5, "system", "Be brief."), (1, 6, "user", "Hi"), (1, 7, "assistant", "Go <|away"), (1, 8, "user", "Oh"),
            (4, 0, "user", "é"), (4, 1, "assistant", "same"), (5, 0, "user", "é"), (5, 1, "assistant", "same"),
            (9, 0, "assistant", "alone")]
    turns = spark.createDataFrame(rows, TURNS)
    got = {r.pair_id: r for r in pf.format_preferences(turns, pf.neighbours(turns)).collect()}
    r = got[0]
    assert r.n_common == 2 and r.prompt == "<|system|>\nBe brief.<|end|>\n<|user|>\nHi<|end|>\n"
    assert r.chosen == "<|assistant|>\nHello!<|end|>\n" and r.chosen_mask == "0:14,1:14"
    assert r.rejected == "<|assistant|>\nGo < |away<|end|>\n<|user|>\nOh<|end|>\n" and r.rejected_mask == "0:14,1:18,0:19"
    assert (got[4].n_common, got[4].chosen, got[4].rejected, got[4].chosen_mask) == (2, "", "", "")
    assert (got[8].n_common, got[8].prompt, got[8].chosen) == (0, "", "") and got[8].rejected_mask == "0:14,1:13"
    for x in got.values():
        for text, mask in ((x.chosen, x.chosen_mask), (x.rejected, x.rejected_mask)):
            assert sum(int(m.split(":")[1]) for m in mask.split(",") if m) == len(text)


def test_edge_rows_match_the_oracle(spark):
    rows = [(None, 0, "user", "lost"), (2, None, None, None), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, None, "", ""),
            (3, 1, "user", "a"), (-1, 0, "assistant", "x"), (-2, 0, "assistant", "x"), (6, 0, "user", "long " * 50_000)]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS pair_id", "'x' AS a", "'y' AS turns")
    df = pf.format_preferences(turns, pf.neighbours(turns))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(pf.NEIGHBOURS_SQL)
    names = [d[0] for d in cur.description]
    assert multiset(df.collect(), df.columns, sorted(names)) == multiset(cur.fetchall(), names, sorted(names))
    assert pf.format_preferences(turns, pf.neighbours(turns.limit(0))).count() == 0
    pairs = spark.createDataFrame([(1, 2, None), (1, 2, None), (2, 77, 3)], "pair_id long, chosen_id long, rejected_id long")
    got = sorted((r.pair_id, r.n_common, r.rejected) for r in pf.format_preferences(turns, pairs).collect())
    assert [g[:2] for g in got] == [(1, 0), (1, 0), (2, 0)] and got[0][2] == ""
