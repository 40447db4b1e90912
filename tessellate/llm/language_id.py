"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUNS = re.compile(r"[^\W\d_]+")  # words, and numerals that are no digits (such as ² or Ⅷ) among their letters
NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No"))
LETTERS = re.compile(f"[^\\W\\d_{NUMERALS}]+")
GRAMS = (4, 3, 2, 1)  # lengths tried for an unseen word, longest first
TRAIN_DOCS = 2_000  # labelled documents of each language that the fit reads, about
TOP_WORDS = 50_000  # entries of each language in a fitted model, by their frequency in it
TOP_GRAMS = 50_000
REMEMBERED = 500_000


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, top_words: int = TOP_WORDS, top_grams: int = TOP_GRAMS):
    """A model ``(languages, words, grams)`` from rows ``(doc_id, text, lang)``;
    words and grams map to the log frequencies in each language.

    Of each language about ``train_docs`` documents are read, those whose hash
    is below the share this needs; whole texts, counted in Spark with partial
    sums. The model keeps the most frequent ``top_words`` words and
    ``top_grams`` n-grams of each language by itself, so a small language keeps
    as many as a large one, and the size is bounded whatever the corpus. Rows without text or lang are not used; None if none is left.
    """
    labelled = labelled.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        (F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), 11) / F.lit(2.0 ** 53)).alias("u"))
    per = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return None
    share = F.element_at(F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(min(1.0, train_docs / n)))]),
                         F.col("lang"))
    sample = labelled.where((F.col("u") < share) & F.col("text").isNotNull()).select("lang", "text")

    def count(batches):
        counts: dict = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = counts.setdefault(lang, {})
                for w in words_of(text):
                    mine[w] = mine.get(w, 0) + 1
        for lang, mine in counts.items():
            for words in _slices(list(mine), 50_000):
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(words), "word": words,
                                                  "n": pa.array([mine[w] for w in words], pa.int64())})

    counted = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = None
    for k in GRAMS:
        at = F.explode(F.expr(f"sequence(1, greatest(1, length(word) + 3 - {k}))"))
        one = (counted.withColumn("at", at).select("lang", F.substring(padded, F.col("at"), k).alias("gram"), "n")
               .where(F.length("gram") == k))
        grams = one if grams is None else grams.union(one)
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    languages = sorted(per)

    def table(frame: DataFrame, name: str, top: int) -> dict:
        """``name`` to its counts by language, of those that are among the ``top`` most
        frequent of any language (ties by name)."""
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), name))
        wide = frame.withColumn("place", place).groupBy(name).agg(F.min("place").alias("place"), F.map_from_entries(
            F.collect_list(F.struct("lang", "n"))).alias("by"))
        return {r[name]: [r["by"].get(x, 0) for x in languages] for r in wide.where(F.col("place") <= top).orderBy(name).collect()}

    def logs(counts: dict, group) -> dict:
        """Log frequencies with half a count added, in each group of entries by itself."""
        totals: dict = {}
        for k, v in counts.items():
            t = totals.setdefault(group(k), [np.zeros(len(languages)), 0])
            t[0] += v
            t[1] += 1
        return {k: np.log((np.array(v) + 0.5) / (totals[group(k)][0] + 0.5 * (totals[group(k)][1] + 1)))
                for k, v in counts.items()}

    return languages, logs(table(counted, "word", top_words), lambda w: 0), logs(table(grams, "gram", top_grams), len)


def _slices(items: list, n: int):
    return (items[i:i + n] for i in range(0, len(items), n))


def word_score(word: str, words: dict, grams: dict, n_languages: int) -> np.ndarray:
    """Log frequencies of a word: its own if the model knows it; else the mean of
    those of its longest n-grams that the model knows; else zero for all."""
    if word in words:
        return words[word]
    padded = f" {word} "
    for k in GRAMS:
        known = [grams[g] for g in (padded[i:i + k] for i in range(len(padded) - k + 1)) if g in grams]
        if known:
            return np.mean(known, axis=0)
    return np.zeros(n_languages)


class Scorer:
    """Sums of word scores; the rows of unseen words are remembered up to a bound. A run
    with numerals has the sum of the words between them."""

    def __init__(self, model):
        self.languages, self.words, self.grams = model
        self._start()

    def _start(self) -> None:
        n = len(self.languages)
        self.index = {w: i for i, w in enumerate(self.words)}
        self.rows = np.concatenate([np.array(list(self.words.values())).reshape(-1, n), np.zeros((1 << 16, n))])
        self.letters = np.ones(len(self.rows), bool)

    def _learn(self, found: list[str]) -> None:
        if len(self.index) > len(self.words) + REMEMBERED:
            self._start()
        for w in dict.fromkeys(found):
            if w not in self.index:
                at = len(self.index)
                if at == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.letters = np.concatenate([self.letters, np.ones_like(self.letters)])
                parts = [w] if w.isalpha() else words_of(w)
                self.rows[at] = sum(word_score(p, self.words, self.grams, len(self.languages)) for p in parts)
                self.letters[at] = bool(parts)
                self.index[w] = at

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the likelihood, all languages
        being equally likely before; the first by name of equals."""
        found = RUNS.findall(text.lower()) if text else []
        index = self.index
        try:
            at = [index[w] for w in found]
        except KeyError:
            self._learn(found)
            at = [self.index[w] for w in found]
        if not self.letters[at].any():
            return "und", 0.0
        total = self.rows[at].sum(axis=0)
        best = int(np.argmax(total))
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs(doc_id, text)``.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text if there is no model; rows without doc_id and repeated rows are
    scored like any other; an empty table gives no rows; other columns are not
    read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sizes fit() keeps

    def run(batches):
        scorer = Scorer(sent.value) if sent.value else None
        for batch in batches:
            out = [scorer.predict(t) if scorer else ("und", 0.0) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, lang_pred string, score double")
