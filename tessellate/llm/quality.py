"""Quality classifier: an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellate.session import scratch_path

from .common import partitions, salted_join, stored

ORDER = 5  # characters of the longest n-gram
START = "\x02"  # stands before a text
BLOCK = 1 << 25  # characters of the documents whose n-grams are looked up together
QUANTILE = 0.99  # of the trusted documents' log perplexities, by language
HELD_OUT = 10  # one of so many trusted texts is scored by a model of the others
SLACK = 0.15  # log perplexity added to the in-sample quantile of a language without held-out texts
SHRINK = 60  # characters by which a short text's mean is drawn to the trusted one
SLICE = 1 << 19  # characters at once
HELD = 1 << 20  # n-grams of lists that are merged together
LEVEL = 7  # of the compression of texts
MOST_BUCKETS = 100_000  # that Spark allows a table


def _mix(value: np.ndarray, chars: np.ndarray) -> np.ndarray:
    value = (value ^ chars) * np.uint64(0x9E3779B97F4A7C15)
    return value ^ (value >> np.uint64(32))


def hash_rows(chars: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams given as rows of code points."""
    value = np.zeros(len(chars), np.uint64)
    for j in range(chars.shape[1]):
        value = _mix(value, chars[:, j].astype(np.uint64))
    return value


def windows_of(texts: list[str], order: int = ORDER):
    """The n-grams that end at each character of the texts: number of the n-gram for
    each character in order, hashes and code points of the distinct n-grams, and lengths of the texts."""
    pad = START * (order - 1)
    chars = np.frombuffer("".join([pad + t for t in texts]).encode("utf-32-le"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    # places where an n-gram starts: as many as a text has characters, from its padding on
    starts = np.arange(lengths.sum()) + np.repeat(np.arange(len(texts)) * (order - 1), lengths)
    n = max(len(chars) - order + 1, 0)
    value = np.zeros(n, np.uint64)
    for j in range(order):
        value = _mix(value, chars[j:j + n].astype(np.uint64))
    codes, distinct = pd.factorize(value[starts])
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = starts[::-1]
    return codes, distinct, chars[first[:, None] + np.arange(order)], lengths


def strings_of(chars: np.ndarray) -> list[str]:
    """N-grams given as rows of code points as strings."""
    order, joined = chars.shape[1], np.ascontiguousarray(chars, "<u4").tobytes().decode("utf-32-le")
    return [joined[i:i + order] for i in range(0, len(joined), order)]


def grams_of(texts: list[str], order: int = ORDER):
    """As ``windows_of``, the distinct n-grams as strings and without hashes."""
    codes, _, chars, lengths = windows_of(texts, order)
    return codes, strings_of(chars), lengths


def _slices(texts: list[str], most: int = SLICE):
    """Index ranges of the texts with about ``most`` characters each."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, c``: how often each n-gram occurs in ``texts(text)``; tasks add up
    before the shuffle."""

    def run(batches):
        for batch in batches:
            all_texts = [t for t in batch.column(0).to_pylist() if t]
            for a, b in _slices(all_texts):
                codes, distinct, _ = grams_of(all_texts[a:b], order)
                yield pa.RecordBatch.from_pydict({"gram": distinct, "c": np.bincount(codes, minlength=len(distinct))})

    return texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "gram string, c long").groupBy(
        "gram").agg(F.sum("c").alias("c"))


def discounts(tables: list[DataFrame], models: tuple[str, ...] = ("",)) -> list[dict[str, dict[str, float]]]:
    """For each table and each of ``models`` the three discounts of modified Kneser-Ney, from the
    counts of counts, and ``n``, the n-grams of the model; all tables in one query.
    Where the counts are too few to tell, half of the largest possible discounts."""
    rows = reduce(DataFrame.unionByName, [t.select(F.lit(k).alias("length"), *[f"c{m}" for m in models]) for k, t in enumerate(tables)])
    few = [F.count_if(F.col(f"c{m}") == k).alias(f"n{k}{m}") for m in models for k in (1, 2, 3, 4)]
    some = [F.count_if(F.col(f"c{m}") > 0).alias(f"n{m}") for m in models]
    found = {r["length"]: r for r in rows.groupBy("length").agg(*few, *some).collect()}
    clip = lambda d, most: min(max(d, 0.05), most - 0.05)

    def of(n, m):
        n1, n2, n3, n4 = (n[f"n{k}{m}"] if n else 0 for k in (1, 2, 3, 4))
        at = {"n": n[f"n{m}"] if n else 0}
        if not (n1 and n2 and n3):
            return at | {"d1": 0.5, "d2": 1.0, "d3": 1.5}
        y = n1 / (n1 + 2 * n2)
        return at | {"d1": clip(1 - 2 * y * n2 / n1, 1), "d2": clip(2 - 3 * y * n3 / n2, 2), "d3": clip(3 - 4 * y * n4 / n3, 3)}

    return [{m: of(found.get(k), m) for m in models} for k in range(len(tables))]


def kneser_neys(counts: DataFrame, models: tuple[str, ...], order: int = ORDER):
    """The models of several corpora whose counts stand side by side: ``counts`` has a column
    ``c<model>`` for each of ``models``, 0 where the n-gram does not occur. As ``kneser_ney``,
    with columns ``c<model>, p<model>`` and ``rest<model>``, null where a model has no such n-gram
    or context, and a dict of what is left for unseen characters. One set of queries makes all
    models, however many they are: the driver plans, runs and keeps each only once."""
    each = lambda f: [f(m) for m in models]
    tables = [counts.select("gram", *each(lambda m: f"c{m}"))]
    for _ in range(order - 1):
        tables.append(tables[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(
            *each(lambda m: F.count_if(F.col(f"c{m}") > 0).alias(f"c{m}"))))
    tables = [stored(t, "grams") for t in reversed(tables)]  # by length, from 1
    out: list[DataFrame] = []
    contexts: list[DataFrame] = []
    unseen: dict[str, float] = {}
    for k, (t, d) in enumerate(zip(tables, discounts(tables, models)), 1):
        c = {m: F.col(f"c{m}") for m in models}
        cut = {m: F.when(c[m] == 0, 0.0).when(c[m] == 1, d[m]["d1"]).when(c[m] == 2, d[m]["d2"]).otherwise(d[m]["d3"]) for m in models}
        context = F.expr(f"substring(gram, 1, {k - 1})")
        of = stored(t.groupBy(context.alias("ctx")).agg(*each(lambda m: F.sum(c[m]).alias(f"total{m}")),
                                                        *each(lambda m: F.sum(cut[m]).alias(f"mass{m}"))), "contexts")
        joined = t.join(of, context == F.col("ctx"))
        if k == 1:
            left = of.first()
            for m in models:
                share = left[f"mass{m}"] / left[f"total{m}"] if left and left[f"total{m}"] else 1.0
                unseen[m] = share / (d[m]["n"] + 1)
            joined = joined.withColumns({f"low{m}": F.lit(1.0 / (d[m]["n"] + 1)) for m in models})  # one more for all unseen characters
        else:
            low = out[-1].select(F.col("gram").alias("s"), *each(lambda m: F.col(f"p{m}").alias(f"low{m}")))
            joined = joined.drop("ctx").join(low, F.expr("substring(gram, 2)") == F.col("s"))
        probs = joined.select("gram", *c.values(), *each(lambda m: F.when(
            c[m] > 0, (c[m] - cut[m] + F.col(f"mass{m}") * F.col(f"low{m}")) / F.col(f"total{m}")).alias(f"p{m}")))
        out.append(stored(probs, "probabilities"))
        contexts.append(of.select(F.col("ctx").alias("gram"), *each(lambda m: F.col(f"total{m}").alias(f"c{m}")), *each(
            lambda m: F.when(F.col(f"total{m}") > 0, F.col(f"mass{m}") / F.col(f"total{m}")).alias(f"rest{m}"))))
    return out, contexts, unseen


def kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[list[DataFrame], list[DataFrame], float]:
    """Tables ``gram, c, p`` of lengths 1 to ``order``, tables ``gram, c, rest`` of their
    contexts, and the probability left for a character that never occurs.

    The longest n-grams have their counts, shorter ones the number of
    characters they follow (Kneser-Ney). ``p`` is the interpolated
    probability of the last character after the others; ``rest`` the weight
    a context leaves to the one without its first character. Each step is a join on the n-gram, the context or the suffix,
    shuffled on it.
    """
    tables, contexts, unseen = kneser_neys(counts, ("",), order)
    return tables, contexts, unseen[""]


def resolve(grams: DataFrame, tables: list[DataFrame], contexts: list[DataFrame], unseen: dict[str, float]) -> DataFrame:
    """``gram, x<model>`` for each model of ``unseen``: the log probability of distinct n-grams
    of the length of the last of ``tables``, by hash joins with the models' tables. Those that a
    model does not have take the weight their context leaves and the log probability of the n-gram
    without its first character, which are looked up likewise."""
    k, models = len(tables), list(unseen)
    x = {m: F.col(f"x{m}") for m in models}
    known = tables[-1].select(F.col("gram").alias("g"), *[F.log(f"p{m}").alias(f"x{m}") for m in models])
    looked = grams.join(known, F.col("gram") == F.col("g"), "left").select("gram", *x.values())
    if k == 1:
        return looked.select("gram", *[F.coalesce(x[m], F.lit(math.log(unseen[m]))).alias(f"x{m}") for m in models])
    looked = stored(looked, "looked-up")
    lacks = reduce(Column.__or__, [x[m].isNull() for m in models])
    missed = looked.where(lacks).select("gram", *x.values(), F.expr(f"substring(gram, 1, {k - 1})").alias("context"),
                                        F.expr("substring(gram, 2)").alias("suffix"))
    shorter = resolve(missed.select(F.col("suffix").alias("gram")).distinct(), tables[:-1], contexts[:-1], unseen).select(
        F.col("gram").alias("s"), *[x[m].alias(f"low{m}") for m in models])
    left = contexts[-1].select(F.col("gram").alias("ctx"), *[F.log(f"rest{m}").alias(f"w{m}") for m in models])
    backed = (missed.join(left, F.col("context") == F.col("ctx"), "left").join(shorter, F.col("suffix") == F.col("s"))
              .select("gram", *[F.coalesce(x[m], F.coalesce(F.col(f"w{m}"), F.lit(0.0)) + F.col(f"low{m}")).alias(f"x{m}") for m in models]))
    return looked.where(~lacks).union(backed)


def _squeeze(values: np.ndarray) -> bytes:
    """Rows of numbers, compressed byte by byte of a row: the high bytes are much alike."""
    rows = np.ascontiguousarray(values)
    planes = rows.view(np.uint8).reshape(len(rows), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _expand(data: bytes, n: int, dtype: str, width: int) -> np.ndarray:
    size = width * np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype)


def _merged(hashes: list[np.ndarray], chars: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct n-grams of several lists with their counts added up."""
    codes, distinct = pd.factorize(np.concatenate(hashes))
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    added = np.zeros((len(distinct), counts[0].shape[1]), np.int64)
    np.add.at(added, codes, np.concatenate(counts))
    return [distinct], [np.concatenate(chars)[first]], [added]


def packed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``block, doc_ids, piece``: the rows of ``docs(doc_id, lang, held, text)`` in
    compressed pieces of about SLICE characters, and blocks of pieces of about
    ``block`` characters. A block never spans tasks, and the rows are written in buckets
    of blocks, so that no text is shuffled, here or by the joins on ``block``. Small input
    partitions are put together first, since each block asks for its own n-grams."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    most = max(math.ceil(chars / block), spark.sparkContext.defaultParallelism)

    def run(batches):
        at, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _slices(texts, min(SLICE, block)):
                rows = batch.slice(a, b - a)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(
                        compression=pa.Codec("zstd", compression_level=LEVEL))) as out:
                    out.write_batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "doc_ids", "piece"])
                size += sum(map(len, texts[a:b]))
                if size >= block:
                    at, size = at + 1, 0

    rows = docs.select("doc_id", "lang", "held", "text").coalesce(most).mapInArrow(
        run, "block long, doc_ids array<long>, piece binary")
    # only tables have buckets: this one is named until its files are known
    path = scratch_path(spark, "pieces")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows.write.format("parquet").option("path", path).option("compression", "none").bucketBy(
        min(max(most, partitions(spark)), MOST_BUCKETS), "block").saveAsTable(name)
    pieces = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return pieces


def _unpacked(pieces: pa.Table):
    for piece in pieces.column("piece"):
        yield pa.ipc.open_stream(piece.as_buffer()).read_all()


def block_grams(pieces: DataFrame, good: DataFrame, order: int = ORDER) -> DataFrame:
    """``block, shard, n, grams, counts``: the distinct n-grams of each block of
    ``packed``, in a row for each shard of their hashes, and how often they occur in the
    texts of ``good.good_id`` that are not held out, and in those that are."""
    shards = partitions(pieces.sparkSession)
    trusted = (pieces.select(F.col("block").alias("of_block"), F.explode("doc_ids").alias("doc_id")).distinct()
               .join(good, F.col("doc_id") == F.col("good_id"), "left_semi"))

    def run(key, rows, trusted):
        ids = pd.Index(trusted.column("doc_id").to_numpy())
        hashes, grams, counts, size = [], [], [], 0
        for piece in _unpacked(rows):
            known = pc.fill_null(piece.column("doc_id"), 0).to_numpy()
            present = pc.is_valid(piece.column("doc_id")).to_numpy()
            use = ids.get_indexer(known) >= 0 if len(ids) else np.zeros(len(known), bool)
            # 0: not trusted, 1: trusted, 2: trusted and held out
            kind = (use & present) * (1 + piece.column("held").to_numpy().astype(np.int64))
            codes, distinct, chars, lengths = windows_of(piece.column("text").to_pylist(), order)
            of = np.repeat(kind, lengths)
            hashes.append(distinct)
            grams.append(chars)
            counts.append(np.stack([np.bincount(codes[of == k], minlength=len(distinct)) for k in (1, 2)], axis=1))
            size += len(distinct)
            if size > HELD:
                hashes, grams, counts = _merged(hashes, grams, counts)
                size = 0
        hashes, grams, counts = (x[0] for x in _merged(hashes, grams, counts))
        shard = ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
        by = np.lexsort([*(grams[:, j] for j in reversed(range(order))), shard])  # neighbours compress well
        grams, counts = grams[by], counts[by]
        present, starts = np.unique(shard[by], return_index=True)
        ends = np.append(starts[1:], len(by))
        return pa.table({"block": pa.array([key[0].as_py()] * len(present), pa.int64()), "shard": pa.array(present, pa.int32()),
                         "n": pa.array(ends - starts, pa.int64()),
                         "grams": pa.array([_squeeze(grams[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                         "counts": pa.array([_squeeze(counts[a:b]) for a, b in zip(starts, ends)], pa.binary())})

    return pieces.select("block", "piece").groupBy("block").cogroup(trusted.groupBy("of_block")).applyInArrow(
        run, "block long, shard int, n long, grams binary, counts binary")


def gram_counts(asked: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, others, rest``: the distinct n-grams of all rows of ``block_grams`` and the sums of their counts."""

    def run(rows):
        hashes, grams, counts, size = [], [], [], 0
        for n, g, c in zip(*(rows.column(k).to_pylist() for k in ("n", "grams", "counts"))):
            chars = _expand(g, n, "<u4", order)
            hashes.append(hash_rows(chars))
            grams.append(chars)
            counts.append(_expand(c, n, "<i8", 2))
            size += n
            if size > HELD:
                hashes, grams, counts = _merged(hashes, grams, counts)
                size = 0
        _, grams, counts = (x[0] for x in _merged(hashes, grams, counts))
        return pa.table({"gram": pa.array(strings_of(grams), pa.string()), "others": counts[:, 0], "rest": counts[:, 1]})

    return asked.groupBy("shard").applyInArrow(run, "gram string, others long, rest long")


def read_off(pieces: DataFrame, asked: DataFrame, logs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, lang, held, n, nll, nll_others`` of every text of ``pieces``: its
    characters and the sums of their negative log probabilities ``x`` and ``y`` in
    ``logs(gram, x, y)`` (by ``y`` for trusted texts that are held out, else NaN). The logs meet the blocks' n-grams shard by shard and go back
    to the blocks as arrays."""
    shards = partitions(pieces.sparkSession)

    def with_shard(batches):
        for batch in batches:
            text = "".join(batch.column(0).to_pylist()).encode("utf-32-le")
            hashes = hash_rows(np.frombuffer(text, "<u4").reshape(-1, order))
            shard = ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(hashes.view(np.int64)), batch.column(1), batch.column(2)],
                                             ["shard", "hash", "x", "y"])

    def look_up(rows, found):
        hashes = found.column("hash").to_numpy().view(np.uint64)
        by = np.argsort(hashes)
        hashes, x, y = hashes[by], found.column("x").to_numpy()[by], found.column("y").to_numpy()[by]
        out = []
        for n, g, c in zip(*(rows.column(k).to_pylist() for k in ("n", "grams", "counts"))):
            at = np.searchsorted(hashes, hash_rows(_expand(g, n, "<u4", order)))
            # only texts that are held out ask for y
            out.append(_squeeze(np.stack([x[at], np.where(_expand(c, n, "<i8", 2)[:, 1] > 0, y[at], np.nan)], axis=1)))
        return pa.table({"block": rows.column("block"), "n": rows.column("n"), "grams": rows.column("grams"),
                         "logs": pa.array(out, pa.binary())})

    def run(rows, looked):
        hashes, logs = [np.empty(0, np.uint64)], [np.empty((2, 0))]
        for n, g, v in zip(*(looked.column(k).to_pylist() for k in ("n", "grams", "logs"))):
            hashes.append(hash_rows(_expand(g, n, "<u4", order)))
            logs.append(_expand(v, n, "<f8", 2).T)
        hashes, logs = np.concatenate(hashes), np.concatenate(logs, axis=1)
        by = np.argsort(hashes)
        hashes, logs = hashes[by], logs[:, by]
        out = []
        for piece in _unpacked(rows):
            codes, distinct, _, lengths = windows_of(piece.column("text").to_pylist(), order)
            at, of = np.searchsorted(hashes, distinct), np.repeat(np.arange(len(lengths)), lengths)
            nll = [-np.bincount(of, weights=log[at][codes], minlength=len(lengths)).astype(float) for log in logs]
            out.append(pa.table([piece.column("doc_id"), piece.column("lang"), piece.column("held"), pa.array(lengths), *map(pa.array, nll)],
                                ["doc_id", "lang", "held", "n", "nll", "nll_others"]))
        return pa.concat_tables(out)

    spread = logs.select("gram", "x", "y").mapInArrow(with_shard, "shard int, hash long, x double, y double")
    looked = asked.groupBy("shard").cogroup(spread.groupBy("shard")).applyInArrow(
        look_up, "block long, n long, grams binary, logs binary")
    return pieces.select("block", "piece").groupBy("block").cogroup(looked.groupBy("block")).applyInArrow(
        run, "doc_id long, lang string, held boolean, n long, nll double, nll_others double")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       (F.pmod(F.xxhash64(text), F.lit(HELD_OUT)) == 0).alias("held"), F.coalesce(text, F.lit("")).alias("text"))


def score(docs: DataFrame, tables: list[DataFrame], contexts: list[DataFrame], unseen: float, block: int = BLOCK) -> DataFrame:
    """``doc_id, lang, n, nll`` of every row: its characters and the sum of their negative
    log probabilities by the tables of ``kneser_ney``, however large they are.
    Null texts have no characters.

    Documents fall into blocks of about ``block`` characters. The distinct
    n-grams of a block are joined with the resolved ones of the corpus, and
    come back to its texts. A frequent n-gram is asked for by each block, not by
    each document, so no join key is hotter than the number of blocks.
    """
    order = len(tables)
    pieces = packed(_texts(docs), block)
    none = docs.sparkSession.createDataFrame([], "good_id long")
    asked = stored(block_grams(pieces, none, order), "block-grams")
    logs = resolve(gram_counts(asked, order).select("gram"), tables, contexts, {"": unseen})
    return read_off(pieces, asked, logs.withColumn("y", F.col("x")), order).select("doc_id", "lang", "n", "nll")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, accepted`` of every row of
    ``docs(doc_id, text, lang)``, by ``labels(doc_id, quality, toxic)``.

    Documents labelled quality 1 and not toxic are trusted. A model of all
    their text scores every document; a document is rejected if its log
    perplexity is above the ``quantile`` of its language's trusted documents.
    Since a model knows its own texts too well, the quantile is that of one
    in HELD_OUT trusted texts (copies together) under a model of the others,
    or that of all under the whole model if it is greater. A language with
    none held out has the latter and SLACK. A text's mean is taken with SHRINK characters of the
    language's trusted mean, since a few characters tell little.

    Null and empty texts are accepted with perplexity 1; a null lang is a
    language of its own; a language without trusted documents has the
    threshold of all of them together; without any, all is accepted (null
    threshold); rows without doc_id are scored but never trusted; repeated
    rows are counted and returned as often as they occur; empty tables give
    no rows; other columns are not read.
    """
    good = stored(labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select(
        F.col("doc_id").cast("long").alias("good_id")).distinct(), "trusted")
    # one pass over the packed texts counts the trusted n-grams, held out or not, and lists all
    pieces = packed(_texts(docs))
    asked = stored(block_grams(pieces, good), "block-grams")
    counts = stored(gram_counts(asked), "grams")
    # the model of all trusted texts and that of those not held out, side by side
    models = kneser_neys(counts.where("others + rest > 0").select(
        "gram", (F.col("others") + F.col("rest")).alias("c_all"), F.col("others").alias("c_part")), ("_all", "_part"))
    logs = resolve(counts.select("gram"), *models).select("gram", F.col("x_all").alias("x"), F.col("x_part").alias("y"))
    scored = stored(read_off(pieces, asked, logs), "perplexities")
    unseen = scored.where("held AND n > 0").join(good, F.col("doc_id") == F.col("good_id"), "left_semi").select(
        "doc_id", "lang", "n", F.col("nll_others").alias("nll"))
    scored = scored.select("doc_id", "lang", "n", "nll")
    of_trusted = scored.join(good, F.col("doc_id") == F.col("good_id"), "left_semi").where("n > 0")
    means = stored(_by_language(of_trusted, F.sum("nll") / F.sum("n"), "mean", scored), "means")
    lang = F.coalesce("lang", F.lit(""))
    drawn = (F.col("nll") + SHRINK * F.col("mean")) / (F.col("n") + SHRINK)
    value = F.when(F.col("n") > 0, F.coalesce(drawn, F.col("nll") / F.col("n"))).otherwise(F.lit(0.0))
    valued, of_unseen = (salted_join(x.withColumn("key", lang), means, "key", "of_lang").select(
        "doc_id", "lang", "n", value.alias("value")) for x in (scored, unseen))
    valued = stored(valued, "valued")
    again = valued.join(good, F.col("doc_id") == F.col("good_id"), "left_semi").where("n > 0")
    cut = F.percentile_approx("value", quantile, 10_000)
    strict = of_unseen.groupBy(lang.alias("held_lang")).agg(cut.alias("held_limit"))
    limits = stored(_by_language(again, cut, "limit", scored).join(strict, F.col("of_lang") == F.col("held_lang"), "left").select(
        "of_lang", F.greatest("limit", F.coalesce("held_limit", F.col("limit") + SLACK)).alias("limit")), "limits")
    return salted_join(valued.withColumn("key", lang), limits, "key", "of_lang").select(
        "doc_id", "lang", F.exp("value").alias("perplexity"), F.exp("limit").alias("threshold"),
        F.coalesce(F.col("value") <= F.col("limit"), F.lit(True)).alias("accepted"))


def _by_language(rows: DataFrame, value, name: str, all_rows: DataFrame) -> DataFrame:
    """``of_lang`` and an aggregate of the language's rows, or of all rows where it has none."""
    lang = F.coalesce("lang", F.lit(""))
    whole = rows.agg(value.cast("double").alias("whole")).first()["whole"]
    each = rows.groupBy(lang.alias("own_lang")).agg(value.alias("each"))
    present = all_rows.select(lang.alias("of_lang")).distinct()
    return present.join(each, F.col("of_lang") == F.col("own_lang"), "left").select(
        "of_lang", F.coalesce("each", F.lit(whole).cast("double")).alias(name))
