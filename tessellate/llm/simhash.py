"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored
from .graph import components

BITS = 64
ENTRY_BYTES = 10  # a variant and the number of the flip that led to it


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles: bit b is 1 if over half the hashes have it."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, ASCII space splits
    if not words:
        return 0
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash64(b" ".join(words), 42)
    votes = np.zeros(BITS, dtype=np.int64)
    n = len(words) - shingle + 1
    step = 1 << 16
    for at in range(0, n, step):
        part = words[at:at + step + shingle - 1]
        if shingle == 3:
            hashes = [hash64(b"%b %b %b" % w, 42) for w in zip(part, part[1:], part[2:])]
        else:
            hashes = [hash64(b" ".join(part[i:i + shingle]), 42) for i in range(len(part) - shingle + 1)]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row of ``docs``."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, fp long")


def flips(radius: int) -> tuple[np.ndarray, int]:
    """Bit masks to apply to a fingerprint, and how many of them every
    fingerprint applies.

    Two fingerprints at an even distance of at most ``radius`` meet at a value
    that is half way from both, so all flips of up to ``radius // 2`` bits do.
    At an odd distance they differ in the parity of their bits and one of them
    has to go a bit further: those of even parity do, by the masks after the
    returned number. For radius 3, two of three differing bits lie in the
    same half of the word, so only flips of two bits within a half are needed.
    """
    near = radius // 2
    masks = [sum(1 << b for b in bits) for k in range(near + 1) for bits in combinations(range(BITS), k)]
    n_near = len(masks)
    if radius % 2:
        for bits in combinations(range(BITS), near + 1):
            if radius != 3 or (bits[0] < BITS // 2) == (bits[1] < BITS // 2):
                masks.append(sum(1 << b for b in bits))
    if len(masks) > 1 << 16:
        raise ValueError(f"radius {radius} gives {len(masks)} variants for each fingerprint")
    return np.array(masks, dtype=np.uint64), n_near


def _odd(fp: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(fp) & 1).astype(bool)


def links(fps: DataFrame, radius: int = 3, bucket_bytes: int = 16 << 20) -> DataFrame:
    """``(a, b)`` links between the distinct values of ``fps.fp`` whose connected
    components are those of all pairs within ``radius`` bits.

    Every fingerprint emits its variants, packed into one row for each bucket
    of variant values and batch; a bucket is sized to ``bucket_bytes`` whatever
    the input. Within a bucket, sorting brings together the fingerprints that
    meet at a value. They are linked in a star, so the links grow with the
    fingerprints that meet and not with their pairs: those at most
    ``radius // 2`` away are within the radius of each other; those one bit
    further are linked to one of odd parity, from which they are within the
    radius. Each link's distance is verified.
    """
    masks, n_near = flips(radius)
    n = fps.count()
    per = (n_near + len(masks)) / 2 * ENTRY_BYTES
    buckets = max(partitions(fps.sparkSession), int(n * per / bucket_bytes) + 1)

    def emit(batches):
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(all_fps), 2048):
                fp = all_fps[at:at + 2048]
                further = fp[~_odd(fp)]
                variants = np.concatenate([(fp[:, None] ^ masks[:n_near]).ravel(),
                                           (further[:, None] ^ masks[n_near:]).ravel()])
                flip = np.concatenate([np.tile(np.arange(n_near, dtype=np.uint16), len(fp)),
                                       np.tile(np.arange(n_near, len(masks)).astype(np.uint16), len(further))])
                mixed = (variants ^ (variants >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                present, starts = np.unique(bucket[order], return_index=True)
                ends = np.append(starts[1:], len(order))
                variants, flip = variants[order], flip[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(present), pa.array([variants[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                     pa.array([flip[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                    ["bucket", "variants", "flips"])

    def meet(tab: pa.Table) -> pa.Table:
        variant = np.frombuffer(b"".join(tab.column("variants").to_pylist()), dtype=np.uint64)
        flip = np.frombuffer(b"".join(tab.column("flips").to_pylist()), dtype=np.uint16)
        order = np.argsort(variant, kind="stable")
        variant, flip = variant[order], flip[order]
        first = np.append(True, variant[1:] != variant[:-1])
        alone = first & np.append(first[1:], True)
        variant, flip = variant[~alone], flip[~alone]
        edges = np.empty((0, 2), dtype=np.uint64)
        if len(variant):
            start = np.flatnonzero(np.append(True, variant[1:] != variant[:-1]))
            run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(variant))))
            fp = variant ^ masks[flip]
            near = flip < n_near
            most = np.uint64(2 ** 64 - 1)
            odd = near & _odd(fp)
            centre = np.minimum.reduceat(np.where(near, fp, most), start)
            anchor = np.minimum.reduceat(np.where(odd, fp, most), start)
            to = np.where(near, centre[run], anchor[run])
            # where no fingerprint of odd parity came near, there is nothing to link those further away to
            ok = (near | np.logical_or.reduceat(odd, start)[run]) & (to != fp) & (np.bitwise_count(to ^ fp) <= radius)
            edges = np.unique(np.stack([np.minimum(fp[ok], to[ok]), np.maximum(fp[ok], to[ok])], axis=1), axis=0)
        return pa.table({"a": edges[:, 0].astype(np.uint64).view(np.int64) if len(edges) else np.empty(0, np.int64),
                         "b": np.ascontiguousarray(edges[:, 1]).view(np.int64) if len(edges) else np.empty(0, np.int64)})

    # a fingerprint makes kilobytes, so few of them fill a task
    spread = fps.select(F.col("fp").cast("long")).repartition(buckets // 4 + 1, "fp")
    packed = spread.mapInArrow(emit, "bucket int, variants binary, flips binary")
    return (packed.repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(meet, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the least
    doc_id of all documents that are reached over links of at most ``radius``
    differing bits. Equal fingerprints are one node, so a group of any number
    of copies costs no more than one document.

    Null and blank texts have fingerprint zero and are linked like any other;
    a row without doc_id gets its group's id (null if none of the group has
    one). Repeated rows give repeated rows, an empty table none; other columns
    are not read.
    """
    fps = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius), "a", "b")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("node_fp"), "component_id")
    return fps.join(named, F.col("fp") == F.col("node_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
