"""Quality rules: a table of thresholds compiled into one projection.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r"  # and the space
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?()\"'"  # taken off around words before they are compared with stop words
WINDOW = 5  # words of a repeated window
MIN_WORDS = 10
MOST_REPEATED = 20  # percent of the words

# Frequent function words by language.
STOP_WORDS = {
    "de": "auf das dem den der des die ein eine einer es ich im in ist mit nicht sich sie und von zu zum zur",
    "en": "a an and are as at be by for from in is it of on or that the this to was with",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
    "fr": "au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une",
}


class Rule(NamedTuple):
    """``part`` of ``whole`` in percent must lie between ``least`` and ``most`` (null: no
    bound). Both name metrics; it holds for texts of ``lang`` (null: all) with at
    least ``words`` words and a ``whole`` above zero."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    lang: str | None = None
    words: int = 0


RULES = (
    Rule("word length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("capitals", "n_capitals", "n_letters", None, 30),
    Rule("letters", "n_letters", "word_chars", 60, None, None, 30),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 40),
    Rule("bullets", "n_bullets", "n_lines", None, 90, None, 30),
    Rule("unfinished lines", "n_ellipses", "n_lines", None, 30, None, 30),
    *(Rule("stop words", "n_stop_words", "n_words", 3, None, lang, 50) for lang in STOP_WORDS),
)


def _matched_out(text: str, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _split_words(text: Column, blanks: str) -> Column:
    return F.array_remove(F.split(F.translate(text, blanks, " " * len(blanks)), " "), "")


def _count(array: str, holds) -> Column:
    return F.size(F.filter(array, holds)).cast("long")


def metrics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang`` and the metrics of every row's text, as longs, in one projection.

    Windows of WINDOW words are compared by a 64-bit hash of their words'
    hashes: sorted with their places, equal neighbours are repeats. The
    projection needs no shuffle and a task no more than a text's words.
    """
    stops = sorted({stop for words in STOP_WORDS.values() for stop in words.split()})
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        "*", F.transform(_split_words(F.col("text"), BLANKS), lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " " + BLANKS, "")) > 0).alias("lines"),
        _split_words(F.lower("text"), BLANKS + MARKS).alias("bare"))
    n = F.size("hashes")
    hashed = split.withColumn("windows", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
        *[F.get("hashes", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    # few texts repeat a window, so only theirs are sorted
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    placed = hashed.withColumn("placed", F.when(some, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))).otherwise(none))
    same = lambda x, i: F.when(i >= 0, F.coalesce(F.get("placed", i)["h"] == x["h"], F.lit(False))).otherwise(F.lit(False))
    repeats = placed.withColumn("places", F.sort_array(F.transform(
        F.filter("placed", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"])))
    # a window reaches over its words, or to the next repeated window if that begins earlier
    reach = F.transform("places", lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("places", i + 1), x + WINDOW) - x))
    found = F.struct(
        n.cast("long").alias("n_words"), _word_chars().alias("word_chars"),
        _matched_out("text", f"[{SYMBOLS}]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _matched_out("text", r"\p{Lu}+").alias("n_capitals"), _matched_out("text", r"\p{L}+").alias("n_letters"),
        _count("lines", lambda x: F.ltrim(x).rlike("^[-*•]")).alias("n_bullets"),
        _count("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")).alias("n_ellipses"),
        _count("bare", lambda w: w.isin(*stops)).alias("n_stop_words"))
    # a filter on the result is not pushed below this, where it would compute the metrics again
    return repeats.select("doc_id", "lang", F.inline_outer(F.array(found)))


def _word_chars() -> Column:
    return F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long")


def _breaks(rule: Rule) -> Column:
    share, whole = 100 * F.col(rule.part), F.col(rule.whole)
    out = F.lit(False)
    if rule.least is not None:
        out = out | (share < rule.least * whole)
    if rule.most is not None:
        out = out | (share > rule.most * whole)
    applies = (whole > 0) & (F.col("n_words") >= rule.words)
    if rule.lang is not None:
        applies = applies & F.col("lang").eqNullSafe(rule.lang)
    return applies & out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, the metrics, ``base_failed``, ``broken`` (names of the broken rules in
    the table's order) and ``kept`` of every row of ``docs(doc_id, text, lang)``.

    A text fails the base if it has fewer than MIN_WORDS words or more than
    MOST_REPEATED percent of them lie in repeated windows; it is kept if it
    passes the base and breaks no rule. The table becomes one projection, a
    condition for each row, in whole numbers.

    Null and empty texts have no words and fail the base; a null or unknown
    lang has only the rules for all; null ids and repeated rows are judged like
    others; an empty table gives no rows; other columns are not read.
    """
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    named = [F.when(_breaks(r), F.lit(r.name)) for r in rules]
    broken = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    judged = metrics(docs).withColumn("base_failed", base).withColumn("broken", broken)
    return judged.select("*", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept")).drop("lang")


def _sql_breaks(rule: Rule) -> str:
    bounds = [f"100 * {rule.part} < {rule.least} * {rule.whole}"] * (rule.least is not None)
    bounds += [f"100 * {rule.part} > {rule.most} * {rule.whole}"] * (rule.most is not None)
    lang = f" AND lang IS NOT DISTINCT FROM '{rule.lang}'" if rule.lang else ""
    return f"({rule.whole} > 0 AND n_words >= {rule.words}{lang} AND ({' OR '.join(bounds) or 'false'}))"


def _sql(rules: Sequence[Rule] = RULES) -> str:
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    in_list = ", ".join(f"'{w}'" for w in stops)
    ok = " OR ".join(_sql_breaks(r) for r in rules)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
windows AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
by_line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (WHERE regexp_matches(ltrim(line, ' '), '^[-*•]')) AS n_bullets,
    count(*) FILTER (WHERE regexp_matches(line, '(\\.\\.\\.|…) *$')) AS n_ellipses
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
stops AS (
  SELECT r, count(*) AS n_stop_words
  FROM (SELECT r, unnest(regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D.,;:!?()"'']+')) AS b FROM d)
  WHERE b IN ({in_list}) GROUP BY r),
m AS (
  SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    CAST(length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(text) - length(regexp_replace(text, '\\p{{L}}', '', 'g')) AS BIGINT) AS n_letters,
    coalesce(n_bullets, 0) AS n_bullets, coalesce(n_ellipses, 0) AS n_ellipses, coalesce(n_stop_words, 0) AS n_stop_words
  FROM d JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN by_line USING (r) LEFT JOIN stops USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({ok}) AS kept FROM b
"""


RULES_SQL = _sql()
