"""Byte-level BPE encoding and decoding with overlapping chunks for long texts."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker


def encoding(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once for each Python worker."""
    loaded, key = per_worker(), f"ranks {ranks_file} {pattern}"
    if key not in loaded:
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
        loaded[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return loaded[key]


def chunk_starts(n: int, chunk: int) -> list[int]:
    return list(range(0, max(n, 1), chunk))


def boundaries(text: str, pattern) -> np.ndarray:
    """End offsets of the pattern's matches (they cover the text without gaps)."""
    return np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int64)


def stitch(chunks: list[str], ends: list[np.ndarray], starts: list[int], pattern, margin: int = 8) -> list[str]:
    """Pieces of the whole text, cut only where a pre-token of the whole text
    ends and the character before the cut is no white space.

    ``chunks[i]`` begins at ``starts[i]`` and reaches into the next one. A
    match depends only on the text from its start on, so once two chunks have a
    boundary at the same place of their overlap they agree from there on.
    Boundaries within ``margin`` of a chunk's end may be due to the cut and
    don't count. Where an overlap holds no such place (a longer run of letters
    or spaces) the chunks are joined and matched again, each time after the
    joined text has doubled, until a later chunk is met.
    """
    pieces: list[str] = []
    base, text, own = 0, chunks[0], ends[0]  # what follows the last cut, with its boundaries
    matched = len(text)
    for chunk, found, begin in zip(chunks[1:], ends[1:], starts[1:]):
        cut = None
        if own is not None:
            mine, theirs = own + base, found + begin
            settled = mine[(mine > begin) & (mine < base + len(text) - margin)]
            cut = next((c for c in np.intersect1d(settled, theirs).tolist() if not text[c - base - 1].isspace()), None)
        if cut is not None:
            pieces.append(text[:cut - base])
            base, text, own = cut, chunk[cut - begin:], theirs[theirs > cut] - cut
            matched = len(text)
        else:
            text += chunk[base + len(text) - begin:]
            own = None
            if len(text) >= 2 * matched:
                own, matched = boundaries(text, pattern), len(text)
    pieces.append(text)
    return [p for p in pieces if p]


def encode(docs: DataFrame, ranks_file: str, pattern: str, chunk: int = 1 << 15, overlap: int = 1 << 9,
           decoded: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` for every row of ``docs(doc_id, text)``; with ``decoded``
    also ``bytes``, what the ids decode to, by the worker that holds the ranks
    already (piece by piece for long texts).

    Texts of up to ``chunk`` characters are encoded where they are read. A
    longer text is cut into chunks that overlap; tasks pre-tokenise the chunks
    of one document in parallel, ``stitch`` turns them into pieces that end
    where pre-tokens of the whole text end, tasks encode the pieces, and the
    ids are joined in order. What a task holds of such a document is its text
    or its ids.

    Null and empty texts give an empty array; rows without doc_id are encoded
    like any other; repeated rows give repeated rows, an empty table none;
    other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids_type = pa.list_(pa.int32())
    shape = "ids array<int>, bytes binary" if decoded else "ids array<int>"

    def coded(batch, kept: list[str]) -> pa.RecordBatch:
        """The kept columns of a batch with the ids (and bytes) of its texts."""
        enc = encoding(ranks_file, pattern)
        ids = [enc.encode_ordinary(t) for t in batch.column("text").to_pylist()]
        columns = [*(batch.column(c) for c in kept), pa.array(ids, ids_type)]
        if decoded:
            columns.append(pa.array([enc.decode_bytes(x) for x in ids], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, [*kept, "ids", "bytes"][:len(columns)])

    def direct(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield coded(batch.slice(at, 256), ["doc_id"])

    def cut(batches):
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                digest = hashlib.sha256(text.encode()).digest()
                starts = chunk_starts(len(text), chunk)
                for i in range(0, len(starts), 64):
                    some = starts[i:i + 64]
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array([doc_id] * len(some), pa.int64()),
                         "digest": pa.array([digest] * len(some), pa.binary()), "start": pa.array(some, pa.int64()),
                         "text": [text[s:s + chunk + overlap] for s in some]})

    def pretokenise(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            ends = [boundaries(t, compiled).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())],
                                             [*batch.schema.names, "ends"])

    def join_chunks(tab: pa.Table) -> pa.Table:
        starts = tab.column("start").to_pylist()
        copies = starts.count(0)  # of a repeated row
        place = {s: i for i, s in enumerate(starts)}
        order = sorted(place)
        texts = tab.column("text").take([place[s] for s in order]).to_pylist()
        raw = tab.column("ends").take([place[s] for s in order]).to_pylist()
        pieces = stitch(texts, [np.frombuffer(r, np.int32).astype(np.int64) for r in raw], order,
                        regex.compile(pattern))
        n = len(pieces)
        return pa.table({"doc_id": pa.array([tab.column("doc_id")[0].as_py()] * n, pa.int64()),
                         "digest": pa.array([tab.column("digest")[0].as_py()] * n, pa.binary()),
                         "piece": pa.array(range(n), pa.int32()), "copies": pa.array([copies] * n, pa.int32()),
                         "text": pieces})

    def encode_pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                yield coded(batch.slice(at, 32), ["doc_id", "digest", "piece", "copies"])

    def join_ids(tab: pa.Table) -> pa.Table:
        tab = tab.combine_chunks().sort_by("piece")
        ids = tab.column("ids").combine_chunks().flatten()
        copies = tab.column("copies")[0].as_py()
        out = {"doc_id": pa.array([tab.column("doc_id")[0].as_py()] * copies, pa.int64()),
               "ids": pa.concat_arrays([pa.array([ids.to_numpy()], ids_type)] * copies)}
        if decoded:
            out["bytes"] = pa.array([b"".join(tab.column("bytes").to_pylist())] * copies, pa.binary())
        return pa.table(out)

    long = F.length("text") > chunk
    chunks = docs.where(long).mapInArrow(cut, "doc_id long, digest binary, start long, text string")
    marked = chunks.repartition("digest", "start").mapInArrow(
        pretokenise, "doc_id long, digest binary, start long, text string, ends binary")
    pieces = marked.groupBy("doc_id", "digest").applyInArrow(
        join_chunks, "doc_id long, digest binary, piece int, copies int, text string")
    parts = pieces.repartition("digest", "piece").mapInArrow(
        encode_pieces, f"doc_id long, digest binary, piece int, copies int, {shape}")
    whole = parts.groupBy("doc_id", "digest").applyInArrow(join_ids, f"doc_id long, {shape}")
    return docs.where(~long).mapInArrow(direct, f"doc_id long, {shape}").union(whole)


def decode(encoded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes``: the raw bytes of the ids, one after the other, for ids
    that come from elsewhere. Null ids give empty bytes."""

    def run(batches):
        enc = encoding(ranks_file, pattern)
        for batch in batches:
            out = [enc.decode_bytes(x) if x else b"" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
