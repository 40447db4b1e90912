"""Token ids as fixed-width bit-packed blocks: write in document order, read back.

File format: a folder of Parquet files whose rows are blocks. A block holds
whole documents, each id in the least number of bits that the vocabulary
needs, least significant bit first and without gaps between ids:

=============== ============= ====================================================
column          type          meaning
=============== ============= ====================================================
shard_id        long          doc_id of the first document of the block's shard
shard_tie       long          tie-break of shards that begin with the same doc_id
block           int           number of the block within its shard
width           int           bits of an id
first           long          ids of the shard before the block
n_ids           long          ids in the block
doc_ids         array<long>   its documents, in order
n_tokens        array<long>   ids of each of them
payload         binary        ceil(n_ids * width / 8) bytes
=============== ============= ====================================================

Shards cover ascending ranges of doc_id, so (shard_id, shard_tie, block) is the
order of the whole; ``first`` after the sums of the shards before is a block's offset.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, per_worker

SCHEMA = ("shard_id long, shard_tie long, block int, width int, first long, n_ids long, "
          "doc_ids array<bigint>, n_tokens array<bigint>, payload binary")
KEPT = 300_000  # distinct words, and runs of them, in each of the two generations a worker remembers
_SEPARATORS = re.compile("[\x1c-\x1f]")


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, least significant bit first (whole bytes: little-endian)."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from number ``start`` on, without touching what stands before."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", n, start * width // 8).astype(np.uint32)
    first = start * width
    raw = np.frombuffer(payload, np.uint8, offset=first // 8, count=-(-(first % 8 + n * width) // 8))
    bits = np.unpackbits(raw, bitorder="little")[first % 8:first % 8 + n * width].reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


def _class(kind: str) -> str:
    """The characters of a general category, or of those that begin with it, as ranges
    for a pattern's set."""
    spans, begin = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c)).startswith(kind)
        if inside and begin is None:
            begin = c
        elif not inside and begin is not None:
            spans.append((begin, c - 1))
            begin = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


# Fixed value: white space of Unicode, as the tokenizer's patterns understand it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Memo:
    """A bounded memory: once ``most`` entries are new, those before them are
    forgotten, save the ones that were asked for meanwhile."""

    def __init__(self, make, most: int = KEPT):
        self.make, self.most = make, most
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[key] = value
        return value


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level models write bytes as: printable Latin-1
    characters stand for themselves, the others for 256 and on."""
    plain = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    return {b: 256 + i for i, b in enumerate(sorted({*range(256)} - plain))}


class UnknownCharacter(ValueError):
    """A character that Python's tables have no category for."""


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file.

    Where the file lower-cases, composes (NFC) and then keeps the matches of a
    pattern as words, a text's ids are those of its words, and the library's
    model gets each word alone, and the more frequent ones once. No word has white space in it, so the
    ids of each distinct run between white space are remembered as well. Any
    other file, and any text whose composed lower-case form is not stable, that
    holds a separator which only Python takes for white space, the name of one
    of the file's special tokens, or a character that Python's tables don't
    have yet, goes through the library whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.letters = _byte_letters()
        self.words = Memo(self._word)
        self.runs = Memo(self._run)
        self.pattern = None
        with open(tokenizer_file, encoding="utf-8") as f:
            made = json.load(f)
        names = {x["content"] for x in made["added_tokens"]}
        self.special = [n for n in {*names, *(n.lower() for n in names)} if n]
        kinds = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"]
                and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"]
                and not steps[1]["add_prefix_space"] and made["post_processor"] is None):
            source = steps[0]["pattern"]["Regex"].replace("[\\p{L}]", "\\p{L}").replace("[\\p{N}]", "\\p{N}")
            inner = re.sub(r"\[\^\\s\\p\{L\}\\p\{N\}\]", lambda _: "\0", source)
            if "\\s" not in inner:
                letters, numbers = _class("L"), _class("N")
                inner = inner.replace("\\p{L}", f"[{letters}]").replace("\\p{N}", f"[{numbers}]")
                self.unknown = re.compile(f"[{_class('Cn')}]")
                self.pattern = re.compile(inner.replace("\0", f"[^{SPACE}{letters}{numbers}]"))

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.pattern is None:
            return self._whole(text)
        composed = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if not unicodedata.is_normalized("NFC", composed) or _SEPARATORS.search(composed):
            return self._whole(text)
        for name in self.special:
            if name in composed or name in text:
                return self._whole(text)
        runs = composed.split()
        ids = list(map(self.runs.new.get, runs))
        if None in ids:
            try:
                ids = [self.runs(r) if x is None else x for r, x in zip(runs, ids)]
            except UnknownCharacter:
                return self._whole(text)
        return b"".join(ids)

    def _run(self, run: str) -> bytes:
        # what is printable has a category
        if not run.isprintable() and self.unknown.search(run):
            raise UnknownCharacter(run)
        words = self.pattern.findall(run)
        if len(words) == 1 and words[0] == run:
            return self._word(run)  # remembered as a run
        return b"".join([self.words(w) for w in words])

    def _word(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.library.model.tokenize(spelt)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encoder(tokenizer_file: str) -> WordEncoder:
    kept, key = per_worker(), f"words {tokenizer_file}"
    if key not in kept:
        kept[key] = WordEncoder(tokenizer_file)
    return kept[key]


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, block_ids: int = 1 << 16) -> None:
    """Encode ``docs(doc_id, text)`` and write blocks in ascending doc_id order.

    Every document ends with ``end_id``. Tasks take ascending ranges of
    (doc_id, text hash), sort them and write one shard each; a block is closed
    once it has ``block_ids`` ids, so a task holds a block and one document.

    Null and empty texts are the end id alone; rows without doc_id come first;
    repeated rows are written as often as they occur; an empty table gives no
    blocks; other columns are not read.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        made = json.load(f)
    top = max([end_id, *made["model"]["vocab"].values(), *(x["id"] for x in made["added_tokens"])])
    width = max(1, int(top).bit_length())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc, block, shard = encoder(tokenizer_file), 0, None
        doc_ids, lengths, parts, size, first = [], [], [], 0, 0

        def close():
            ids = np.frombuffer(b"".join(parts), "<u4")
            return pa.RecordBatch.from_pydict({
                "shard_id": pa.array([shard[0]], pa.int64()), "shard_tie": pa.array([shard[1]], pa.int64()),
                "block": pa.array([block], pa.int32()), "width": pa.array([width], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "n_tokens": pa.array([lengths], pa.list_(pa.int64())),
                "payload": pa.array([pack(ids, width)], pa.binary())})

        for batch in batches:
            for doc_id, tie, text in zip(*(c.to_pylist() for c in batch.columns)):
                shard = shard or (doc_id, tie)
                ids = enc.ids(text or "") + end
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                size += lengths[-1]
                if size >= block_ids:
                    yield close()
                    first, block = first + size, block + 1
                    doc_ids, lengths, parts, size = [], [], [], 0
        if parts:
            yield close()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
                 F.col("text").cast("string").alias("text"))
     .repartitionByRange(partitions(docs.sparkSession), "doc_id", "tie")
     .sortWithinPartitions("doc_id", "tie", "text")
     .mapInArrow(run, SCHEMA).write.parquet(path))


def _placed(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``base``, the ids of all shards before."""
    before = W.orderBy(F.col("shard_id").asc_nulls_first(), F.col("shard_tie").asc_nulls_first())
    shards = blocks.groupBy("shard_id", "shard_tie").agg(F.sum("n_ids").alias("n")).select(
        F.col("shard_id").alias("s_id"), F.col("shard_tie").alias("s_tie"),
        (F.sum("n").over(before.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    return blocks.join(F.broadcast(shards), F.col("shard_id").eqNullSafe(F.col("s_id"))
                        & F.col("shard_tie").eqNullSafe(F.col("s_tie")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` for every document of the files at ``path``:
    ``start`` counts the ids of all documents before it, ``ids`` is binary
    (little-endian unsigned 32-bit integers).

    Where a shard starts follows from the sums of one row for each shard. There
    are no more shards than the writer had partitions, so these rows go to
    every task and the blocks stay where they are read.
    """
    found = _placed(spark.read.schema(SCHEMA).parquet(path))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("doc_ids", "n_tokens", "at", "width", "n_ids", "payload")}
                n = np.array(row["n_tokens"], np.int64)
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"]).astype("<u4")
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["at"] + ends - n, pa.int64()),
                     pa.array(n, pa.int64()),
                     pa.array([ids[e - k:e].tobytes() for e, k in zip(ends.tolist(), n.tolist())], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return found.select("doc_ids", "n_tokens", (F.col("base") + F.col("first")).alias("at"), "width", "n_ids",
                        "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_at(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """The ``n`` ids from number ``start`` of the whole on (fewer at its end), whichever
    documents they belong to. Of the blocks, only those that hold some of them
    are read, and only these ids unpacked; they come to the driver."""
    found = _placed(spark.read.schema(SCHEMA).parquet(path))
    at = F.col("base") + F.col("first")
    rows = found.where((at < start + n) & (at + F.col("n_ids") > start)).select(
        at.alias("at"), "n_ids", "width", "payload").orderBy("at").collect()
    parts = [unpack(r.payload, r.width, max(start - r["at"], 0), min(start + n, r["at"] + r.n_ids) - max(start, r["at"])) for r in rows]
    return np.concatenate([np.empty(0, np.uint32), *parts])
