"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 5  # tokens of a template window
MIN_LITERALS = 3  # of them that are not placeholders; windows with fewer must match with their values
MIN_COVERAGE = 0.4  # of an item's windows
MIN_RUN = 13  # words that match without a gap, however long the item
FILTER_BITS = 1 << 23  # of the pre-filter that is sent to the tasks: 1 MB, whatever the benchmark's size

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n…]")
LITERAL, CAPITAL, NUMBER, BREAK = 0, 1, 2, 3
# Unit words that are replaced after a number.
UNITS = frozenset("""
mm cm m km ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres
kilometer kilometers mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes
ml cl l litre litres liter liters gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours
day days week weeks month months year years hz khz mhz ghz w kw v ohm ohms j kj cal kcal bit bits byte bytes kb mb gb tb
usd eur gbp dollar dollars euro euros cent cents percent degree degrees kmh mph
""".split())


class Words:
    """Class and hash of each distinct token, remembered up to a bound."""

    def __init__(self, most: int = 500_000):
        self.most = most
        self._start()

    def _start(self) -> None:
        self.index: dict[str, int] = {}
        self.kind = np.zeros(1 << 16, np.uint8)
        self.unit = np.zeros(1 << 16, bool)
        self.hash = np.zeros(1 << 16, np.uint64)

    def _learn(self, tokens: list[str]) -> None:
        if len(self.index) > self.most:
            self._start()
        for t in dict.fromkeys(tokens):
            if t in self.index:
                continue
            at = len(self.index)
            if at == len(self.kind):
                self.kind, self.unit, self.hash = (np.concatenate([x, np.zeros_like(x)])
                                                   for x in (self.kind, self.unit, self.hash))
            self.index[t] = at
            if t[0].isdigit():
                self.kind[at] = NUMBER
            elif not t[0].isalpha():
                self.kind[at] = BREAK
            else:
                self.kind[at] = CAPITAL if t[0].isupper() and t[1:].islower() else LITERAL
            self.unit[at] = t.lower() in UNITS
            self.hash[at] = xxhash.xxh64_intdigest(t.lower())

    def parse(self, text: str) -> "Parsed":
        """The words of a text.

        A name is a capitalised word that does not begin a sentence; a unit is
        a unit word right after a number. Other words are literal, in lower
        case.
        """
        tokens = TOKEN.findall(text)
        try:
            at = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            self._learn(tokens)
            at = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        kind = self.kind[at]
        slot = np.zeros(len(at), np.uint8)
        if len(at):
            after = kind[:-1]  # what stands before each token but the first
            slot[1:][(kind[1:] == CAPITAL) & (after != BREAK)] = 2
            slot[1:][self.unit[at[1:]] & (after == NUMBER)] = 3
            slot[kind == NUMBER] = 1
        where = np.flatnonzero(kind != BREAK)
        slot, plain = slot[where], self.hash[at[where]]
        return Parsed(tokens, where, np.where(slot > 0, PLACEHOLDER[slot], plain), plain, slot)


PLACEHOLDER = np.array([0] + [xxhash.xxh64_intdigest(f"<{x}>") for x in ("number", "name", "unit")], np.uint64)


class Parsed(NamedTuple):
    """Words of a text: all ``tokens``, ``where`` of them the words are, the words' hashes
    with placeholders for numbers, names and units, those of the words
    themselves, and which are placeholders (1 number, 2 name, 3 unit)."""

    tokens: list[str]
    where: np.ndarray
    hashes: np.ndarray
    plain: np.ndarray
    slot: np.ndarray

    def word(self, i: int) -> str:
        return self.tokens[self.where[i]]


def _rolled(hashes: np.ndarray, k: int, n: int) -> np.ndarray:
    value = np.full(n, k, np.uint64)
    for j in range(k):
        value = (value * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[j:j + n]
        value ^= value >> np.uint64(31)
    return value


def windows(text: Parsed, k: int = WINDOW, literals: int = MIN_LITERALS):
    """Places, hashes and kinds of the windows of ``k`` words. One with fewer than ``literals``
    literal words is hashed with its values in place of placeholders, so that
    only exact copies match (kind true); in texts shorter than WINDOW it is left out."""
    n = len(text.hashes) - k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    value = _rolled(text.hashes, k, n)
    filled = np.append(0, np.cumsum(text.slot > 0))
    few = k - (filled[k:] - filled[:-k]) < literals
    if not few.any():
        return np.arange(n), value, few
    if k < WINDOW:
        keep = np.flatnonzero(~few)
        return keep, value[keep], few[keep]
    value[few] = _rolled(text.plain, k, n)[few]
    return np.arange(n), value, few


ROWS = "doc long, pos int, hash long, len int, n_windows int, slots array<string>"


def _rows(doc, text: Parsed, pos, values, exact, k, n_windows):
    """Window rows of one text; ``slots`` are 'place:kind:value' of the placeholders,
    ``len`` is below zero for windows that match exactly."""
    slot = text.slot
    where = np.flatnonzero(slot)
    first = np.searchsorted(where, pos)
    last = np.searchsorted(where, pos + k)
    slots = [[f"{i - p}:{slot[i]}:{text.word(i).lower()}" for i in where[a:b].tolist()]
             for p, a, b in zip(pos.tolist(), first.tolist(), last.tolist())]
    n = len(pos)
    return pa.RecordBatch.from_pydict({
        "doc": pa.array([doc] * n, pa.int64()), "pos": pa.array(pos, pa.int32()), "hash": pa.array(values.view(np.int64)),
        "len": pa.array(np.where(exact, -k, k), pa.int32()), "n_windows": pa.array([n_windows] * n, pa.int32()),
        "slots": pa.array(slots, pa.list_(pa.string()))})


def item_windows(items: DataFrame) -> DataFrame:
    """All template windows of ``items(item, text)``; an item shorter than a window is
    one window of its own length."""

    def run(batches):
        known = Words()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parsed = known.parse(text)
                k = min(WINDOW, len(parsed.slot))
                if k:
                    pos, values, exact = windows(parsed, k)
                    if len(pos):
                        yield _rows(item, parsed, pos, values, exact, k, len(pos))

    return items.mapInArrow(run, ROWS)


def document_windows(docs: DataFrame, item_rows: DataFrame) -> DataFrame:
    """Template windows of ``docs(doc_id, text)`` that may be among the items'.

    A bit map of the items' hashes, of a fixed size, goes to all tasks and
    drops windows that match nothing before any shuffle; what it lets through
    by chance falls out in the join.
    """
    bit = F.pmod(F.col("hash"), F.lit(FILTER_BITS))
    marked = item_rows.select(F.floor(bit / 64).alias("word"), (bit % 64).cast("int").alias("bit")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 64, "<i8")
    for r in marked.toLocalIterator():
        bitmap[r["word"]] = r["bits"]
    lengths = sorted(r["len"] for r in item_rows.select(F.abs("len").alias("len")).distinct().collect())
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        known, allowed = Words(), np.unpackbits(sent.value.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                parsed = known.parse(text)
                for k in lengths:
                    pos, values, exact = windows(parsed, k)
                    hit = allowed[values & np.uint64(FILTER_BITS - 1)]
                    if hit.any():
                        yield _rows(doc, parsed, pos[hit], values[hit], exact[hit], k, 0)

    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, ROWS)


def _consistent(slots: str):
    """Whether each value has one replacement, and each replacement one value."""
    was = F.array_distinct(F.transform(slots, lambda s: s["was"]))
    now = F.array_distinct(F.transform(slots, lambda s: s["now"]))
    return (F.size(was) == F.size(slots)) & (F.size(now) == F.size(slots))


def _longest_run(places: str):
    """The longest run of consecutive numbers among distinct ones."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a, x):
        run = F.when(x == a["last"] + 1, a["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["most"], run).alias("most"))

    return F.aggregate(F.sort_array(places), start, step, lambda a: a["most"])


def contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE,
                 min_run: int = MIN_RUN) -> DataFrame:
    """Pairs of a document and a benchmark item whose template it holds.

    Numbers, names and units become typed placeholders, so a question that
    was given other numbers or names has the windows of the original. Windows
    are hash-joined. Matches of one document and item with the same shift are
    an alignment; it counts if its slots are consistent: each original value
    is replaced by one value throughout and different values by different
    ones. Alignments of a pair count together if their slots are consistent
    with each other, else the one with the most windows does. A pair is
    reported if these windows are ``min_coverage`` of the item's, or if one
    alignment has ``min_run`` words without a gap.

    Returns doc_id, item_id, n_matched, n_windows, coverage, n_slots,
    n_changed (slots with another value). Items with the same text count as
    the one with the least id. Null and empty texts, and items of fewer than
    WINDOW words without enough literal ones, match nothing; rows without doc_id are
    reported under a null id and repeated rows once; empty tables give no
    rows; other columns are not read.
    """
    items = (benchmark.where(F.col("text").isNotNull()).groupBy(F.col("text").cast("string").alias("text"))
             .agg(F.min(F.col("item_id").cast("long")).alias("item")).select("item", "text"))
    item_rows = stored(item_windows(items), "item-windows")
    right = item_rows.select(F.col("doc").alias("item"), F.col("pos").alias("item_pos"), F.col("hash").alias("item_hash"),
                             F.col("len").alias("item_len"), "n_windows", F.col("slots").alias("item_slots"))
    left = document_windows(docs, item_rows).drop("n_windows")
    value = lambda a, b: F.struct(F.substring_index(a, ":", -2).alias("was"), F.substring_index(b, ":", -2).alias("now"))
    met = left.join(right, (F.col("hash") == F.col("item_hash")) & (F.col("len") == F.col("item_len"))).select(
        "doc", "item", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos", "n_windows",
        # kind and value in the item, and in the document
        F.when(F.col("len") < 0, F.transform("item_slots", lambda a: value(a, a)))
        .otherwise(F.zip_with("item_slots", "slots", value)).alias("slots"))
    aligned = met.groupBy("doc", "item", "shift").agg(
        F.collect_set("item_pos").alias("places"), F.first("n_windows").alias("n_windows"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    good = aligned.where(_consistent("slots")).select(
        "doc", "item", "n_windows", F.struct(F.size("places").alias("n"), (-F.col("shift")).alias("before"), "places", "slots").alias("one"),
        _longest_run("places").alias("run"))
    pairs = good.groupBy("doc", "item").agg(F.first("n_windows").alias("n_windows"), F.max("run").alias("run"),
                                            F.collect_list("one").alias("all"))
    together = pairs.select("*", F.array_distinct(F.flatten(F.transform("all", lambda x: x["slots"]))).alias("union"))
    most = F.array_max(F.transform("all", lambda x: F.struct(x["n"], x["before"], F.sort_array(x["places"]).alias("places"), x["slots"])))
    counted = together.withColumn("most", most).select(
        "doc", "item", "n_windows", "run",
        F.when(_consistent("union"), F.col("union")).otherwise(F.col("most.slots")).alias("slots"),
        F.when(_consistent("union"), F.size(F.array_distinct(F.flatten(F.transform("all", lambda x: x["places"])))))
        .otherwise(F.size("most.places")).alias("n_matched"))
    pairs = counted.withColumn("n_slots", F.size("slots")).withColumn(
        "n_changed", F.size(F.filter("slots", lambda s: s["was"] != s["now"])))
    enough = (F.col("n_matched") >= min_coverage * F.col("n_windows")) | (F.col("run") >= min_run - WINDOW + 1)
    return pairs.where(enough).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_matched", "n_windows",
        (F.col("n_matched") / F.col("n_windows")).alias("coverage"), "n_slots", "n_changed")
