import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tessellate.llm import simhash

from .helpers import SF, documents


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64(" ".join(words[i:i + k]).encode(), seed=42).intdigest() for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def slow_components(fps, radius):
    """Least index reachable from each, over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_definition():
    for text in ["", None, " \n", "one", "One two", "a b c", "Éa É b c d\x0be f", "x " * 70, "a b c " * 5000]:
        assert simhash.fingerprint(text) == slow_fingerprint(text), text


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_give_the_components_of_all_pairs(spark, radius):
    rnd = random.Random(radius)
    full = 2 ** 64 - 1
    fps = {0, 1, 7, 15, full ^ 0b11, full ^ 0b1100}  # the last two are four bits apart, each two from all ones
    if radius % 2:
        fps |= {full ^ 0b111000000, full ^ 0b111 << 40}
    else:
        fps.add(full)
    for _ in range(30):
        base = rnd.getrandbits(64)
        for _ in range(8):
            for _ in range(rnd.randrange(3)):
                base ^= 1 << rnd.randrange(64)
            fps.add(base)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.array(x, np.uint64).view(np.int64)),) for x in fps], "fp long")
    found = simhash.links(df, radius, bucket_bytes=1 << 14).collect()
    place = {x: i for i, x in enumerate(fps)}
    unsigned = lambda v: v % 2 ** 64
    for r in found:
        assert bin(unsigned(r.a) ^ unsigned(r.b)).count("1") <= radius
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        a, b = sorted((find(place[unsigned(r.a)]), find(place[unsigned(r.b)])))
        root[b] = a
    assert [find(i) for i in range(len(fps))] == slow_components(fps, radius)


def test_near_duplicates_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    rows = sorted((r.doc_id, r.text) for r in rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (f"{fps[i]:016x}", rows[r][0]) for i, r in enumerate(slow_components(fps, 3))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_edge_rows(spark):
    docs = documents(spark, [(5, None), (3, ""), (9, " "), (4, "Same text of some words"),
                             (2, "same TEXT of some words"), (2, "same TEXT of some words"),
                             (None, "same text of some words"), (7, "quite another text of words " * 3000)])
    docs = docs.withColumnRenamed("source", "fp").withColumnRenamed("lang", "component_id")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()),
                 key=lambda x: (x[0] is None, x))
    assert got == [(2, 2), (2, 2), (3, 3), (4, 2), (5, 3), (7, 7), (9, 3), (None, 2)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
