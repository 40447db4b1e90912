"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_array, partitions, range_bounds, range_of

SUBTABLES = 3  # a digest goes to one cell of each
CELLS = 24  # of a published fingerprint
PARAGRAPH = 200  # characters over which a paragraph is taken sentence by sentence
_SENTENCES = re.compile(r"(?<=[.!?]) ")
_MUL = np.uint64(0xFF51AFD7ED558CCD)


def paragraph_digests(text: str, longest: int = PARAGRAPH) -> np.ndarray:
    """64-bit digests of the paragraphs: lines, of which those over ``longest``
    characters count sentence by sentence; empty ones don't count. The k-th
    occurrence of a paragraph has a digest of its own."""
    parts: list[str] = []
    for line in text.split("\n"):
        if len(line) > longest:
            parts += _SENTENCES.split(line)
        else:
            parts.append(line)
    parts = [p for p in parts if p]
    if len(set(parts)) == len(parts):
        return np.array([xxhash.xxh64_intdigest(p) for p in parts], np.uint64)
    seen: dict[str, int] = {}
    out = []
    for p in parts:
        k = seen.get(p, 0)
        seen[p] = k + 1
        out.append(xxhash.xxh64_intdigest(p, k))
    return np.array(out, np.uint64)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64)
    x = (x ^ (x >> np.uint64(33))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _check(digests: np.ndarray) -> np.ndarray:
    return (_mix(digests, 101) >> np.uint64(32)).astype(np.uint32)


def _cells(digests: np.ndarray, m: int) -> np.ndarray:
    """The cell in each subtable; the hashes differ from size to size."""
    sub = np.uint64(m // SUBTABLES)
    return np.stack([(_mix(digests, m * 8 + j) % sub).astype(np.int64) + j * int(sub) for j in range(SUBTABLES)])


class Sketches:
    """Sketches of ``m`` cells for many documents at once: arrays (document, cell)
    of the number of digests, their XOR and the XOR of their checks."""

    def __init__(self, n: int, m: int):
        self.m = m
        self.count = np.zeros((n, m), np.int32)
        self.key = np.zeros((n, m), np.uint64)
        self.check = np.zeros((n, m), np.uint32)

    def add(self, rows: np.ndarray, digests: np.ndarray, sign) -> None:
        checks = _check(digests)
        for cell in _cells(digests, self.m):
            at = (rows, cell)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, digests)
            np.bitwise_xor.at(self.check, at, checks)

    @classmethod
    def of(cls, docs: list[np.ndarray], m: int) -> "Sketches":
        out = cls(len(docs), m)
        rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        if len(rows):
            out.add(rows, np.concatenate(docs), np.int32(1))
        return out

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(len(self.count), self.m)
        out.count = self.count - other.count
        out.key = self.key ^ other.key
        out.check = self.check ^ other.check
        return out

    def text(self, i: int) -> str:
        """The cells of one document as text: the published fingerprint."""
        raw = self.count[i].astype("<i4").tobytes() + self.key[i].astype("<u8").tobytes() + \
            self.check[i].astype("<u4").tobytes()
        return base64.b64encode(raw).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties difference sketches: takes the digest of each cell that holds just
        one out of its other cells, until no such cell is left. Returns the
        documents, digests and signs (+1: first version only) found, and which
        documents were emptied."""
        rows, digests, signs = [], [], []
        while True:
            r, c = np.nonzero(np.abs(self.count) == 1)
            key, sign = self.key[r, c], self.count[r, c]
            pure = self.check[r, c] == _check(key)
            r, key, sign = r[pure], key[pure], sign[pure]
            if not len(r):
                break
            order = np.lexsort((key, r))
            r, key, sign = r[order], key[order], sign[order]
            new = np.append(True, (r[1:] != r[:-1]) | (key[1:] != key[:-1]))
            r, key, sign = r[new], key[new], sign[new]
            self.add(r, key, -sign)
            rows.append(r)
            digests.append(key)
            signs.append(sign)
        done = ~(self.count.any(axis=1) | self.key.any(axis=1) | self.check.any(axis=1))
        cat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        return cat(rows, np.int64), cat(digests, np.uint64), cat(signs, np.int32), done


def differing(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[tuple[set, set]]:
    """For each pair of versions the digests only the first and only the second has,
    recovered from the difference of their sketches. Pairs whose sketches
    can't be emptied are tried again with twice the cells."""
    out: list[tuple[set, set]] = [(set(), set()) for _ in a]
    left = np.arange(len(a))
    m = cells
    while len(left):
        again = []
        step = max(1, (1 << 21) // m)  # documents at once, for bounded arrays
        for at in range(0, len(left), step):
            some = left[at:at + step]
            rows, digests, signs, done = Sketches.of([a[i] for i in some], m).minus(
                Sketches.of([b[i] for i in some], m)).peel()
            for r, d, s in zip(rows.tolist(), digests.tolist(), signs.tolist()):
                if done[r]:
                    out[some[r]][0 if s > 0 else 1].add(d)
            again.append(some[~done])
        left = np.concatenate(again)
        m *= 2
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """Shared paragraphs over all paragraphs of either, from the recovered
    difference; 1 if neither has any."""
    lost = np.array([len(x) + len(y) for x, y in differing(a, b, cells)], float)
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], float)
    return np.divide(total - lost, total + lost, out=np.ones(len(a)), where=total > 0)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_edits(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Fingerprints of every row of ``docs(doc_id, text)`` and of its edited text.

    The next document is the one with the next smaller doc_id; the smallest is
    followed by the largest. Rows go to tasks by ascending ranges of doc_id,
    whose bounds are literals; the last row of each range is sent to the next
    one as well, so each text is moved once. A task holds about a million
    characters and the row before them.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_paragraphs. Null texts are empty, empty texts
    have an empty sketch; rows with equal doc_id follow each other by text;
    rows without doc_id come below all others; a single row follows itself;
    an empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = partitions(docs.sparkSession)
    bounds = range_bounds(docs, "doc_id", n)
    # one row for each range: its last doc_id, and the range that follows it
    ranged = docs.withColumn("part", range_of(F.col("doc_id"), bounds))
    last = {r["part"]: r["last"] for r in ranged.groupBy("part").agg(F.max("doc_id").alias("last")).collect()}
    present = sorted(last)
    after = dict(zip(present, present[1:] + present[:1]))
    size = max(present, default=0) + 1
    ends = long_array([last.get(p) for p in range(size)])
    nexts = long_array([after.get(p, 0) for p in range(size)])
    at_end = F.col("doc_id").eqNullSafe(F.element_at(ends, F.col("part") + 1))
    own = F.struct(F.col("part"), F.lit(True).alias("own"))
    halo = F.struct(F.element_at(nexts, F.col("part") + 1).cast("int").alias("part"), F.lit(False).alias("own"))
    placed = ranged.select("doc_id", "text", F.explode(F.when(at_end, F.array(own, halo)).otherwise(F.array(own))).alias("to"))

    def results(rows, following, following_digests):
        """Rows of (doc_id, text), ascending, after the row that precedes them."""
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        digests = [paragraph_digests(t) for t in texts]
        nexts_text = [following, *texts[:-1]]
        nexts_digests = [following_digests, *digests[:-1]]
        changed = [edited(t, f) for t, f in zip(texts, nexts_text)]
        changed_digests = [paragraph_digests(t) for t in changed]
        base, edit = Sketches.of(digests, cells), Sketches.of(changed_digests, cells)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [base.text(i) for i in range(len(ids))],
            "edited_fingerprint": [edit.text(i) for i in range(len(ids))],
            "near_edited": likeness(digests, changed_digests, cells), "near_next": likeness(digests, nexts_digests, cells),
            "n_paragraphs": pa.array([len(d) for d in digests], pa.int64())}), texts[-1], digests[-1]

    def run(batches):
        part = following = following_digests = None
        rows, chars = [], 0
        for batch in batches:
            for p, is_own, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (p != part or not is_own or chars >= 1 << 20 or len(rows) >= 512):
                    done, following, following_digests = results(rows, following, following_digests)
                    yield done
                    rows, chars = [], 0
                part = p
                if not is_own:
                    following, following_digests = text, paragraph_digests(text)
                else:
                    rows.append((doc_id, text))
                    chars += len(text)
        if rows:
            yield results(rows, following, following_digests)[0]

    return (placed.select("to.part", "to.own", "doc_id", "text").repartition(n, "part")
            .sortWithinPartitions("part", "own", F.col("doc_id").asc_nulls_first(), "text")
            .mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                             "edited_fingerprint string, near_edited double, near_next double, n_paragraphs long"))
