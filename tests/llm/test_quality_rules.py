import re
from collections import Counter

import duckdb

from tessellate.llm import quality_rules as qr
from tessellate.llm import queries

from ..compare import multiset
from .helpers import SF, documents


def slow(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


PROSE = "The cat sat on the mat and it looked at the dog in the yard with great care. "
EDGES = [
    (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "one two three four"), (5, "a b c d e"),
    (6, "a b c d e f a b c d e"), (7, "x x x x x x x x x x x x"), (7, "x x x x x x x x x x x x"), (None, PROSE),
    (8, "same line here\nsame line here\n\n \nsame line here \nother"), (9, "A|B # C $ D % & <e>  f"),
    (10, "é 𝄞 ß　漢字 x\x1fy"), (11, "word " * 60_000), (12, "\n".join(f"line {i % 7} of it" for i in range(30_000))),
    (13, " ".join(f"w{i}" for i in range(20_000))), (14, "a b c d e " + "a b c d e f g h i j k l m n"),
]


def test_metrics_by_definition(spark):
    docs = documents(spark, EDGES).selectExpr("*", "1 AS n_words", "'x' AS hashes", "true AS kept")
    got = qr.judge(docs).collect()
    want = sorted((str(i), *slow(t)) for i, t in EDGES)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and not r.broken)


def test_query_matches_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = queries.QUERIES["op13_quality_rules"](spark, SF)
    cur = con.execute(queries.ORACLE["op13_quality_rules"])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert multiset(df.collect(), df.columns, sorted(names)) == multiset(cur.fetchall(), names, sorted(names))


CASES = [
    (PROSE + "It was not here.", []),
    (PROSE.upper(), ["capitals"]),
    (" ".join(w + "$" * (i % 2) for i, w in enumerate(PROSE.split())), ["symbols"]),
    (" ".join(str(1000 + 37 * i) for i in range(40)), ["letters"]),
    (" ".join(str(1000 + 37 * i) for i in range(20)), []),  # too short to tell
    (" ".join(f"averyveryverylongword{i}" for i in range(20)), ["word length"]),
    ("\n".join(f"- item {i} of the list" for i in range(12)), ["bullets"]),
    ("\n".join(f"line {i} of the text..." for i in range(12)), ["unfinished lines"]),
    ("yes\n".join(f"this is line number {w}\nyes\n" for w in ("one", "two", "three", "four")), ["repeated lines"]),
    (" ".join(f"kraq{i % 50}x lom{i}" for i in range(60)), ["stop words"]),
]


def test_each_rule(spark):
    got = qr.judge(documents(spark, [(i, text) for i, (text, _) in enumerate(CASES)])).collect()
    for row in got:
        broken = CASES[row.doc_id][1]
        assert row.broken == broken and row.kept == (not broken)


def test_rules_by_language_and_own_tables(spark):
    text = " ".join(f"kraq{i % 50}x lom{i}" for i in range(60))
    docs = documents(spark, [(1, text, "en"), (2, text, "xx"), (3, text, None)])
    assert {r.doc_id: r.kept for r in qr.judge(docs).collect()} == {1: False, 2: True, 3: True}
    assert all(r.kept and r.broken == [] for r in qr.judge(docs, ()).collect())
    own = (qr.Rule("digits", "n_letters", "word_chars", 99), qr.Rule("none", "n_symbols", "n_dup_lines", 1))
    assert all(r.broken == ["digits"] for r in qr.judge(docs, own).collect())
    assert qr.judge(docs.limit(0)).count() == 0


def test_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = qr.judge(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) == len(good)
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_a_filter_on_the_verdict_computes_nothing_again(spark):
    docs = documents(spark, EDGES)
    kept = qr.judge(docs).where("kept")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == qr.judge(docs)._jdf.queryExecution().executedPlan().toString().count("regexp_replace")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in qr.judge(docs).collect() if r.kept}


def test_no_python_and_no_shuffle(spark):
    plan = qr.judge(documents(spark, EDGES[:3]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
