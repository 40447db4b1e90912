import hashlib
import random

import numpy as np

from tessellate.llm import fingerprints as fp

from .helpers import SF, documents


def multiset(text):
    """Paragraphs with their occurrence numbers, from the definition."""
    seen, out = {}, set()
    for line in text.split("\n"):
        for p in (fp._SENTENCES.split(line) if len(line) > fp.PARAGRAPH else [line]):
            if p:
                seen[p] = seen.get(p, 0) + 1
                out.add((p, seen[p]))
    return out


def test_digests_tell_paragraphs_and_repeats_apart():
    assert len(fp.paragraph_digests("a\nb\na\n\n")) == 3
    assert len(set(fp.paragraph_digests("a\na\na").tolist())) == 3
    assert set(fp.paragraph_digests("b\na").tolist()) < set(fp.paragraph_digests("a\nb\na").tolist())
    assert len(fp.paragraph_digests("")) == 0


def test_peeling_recovers_the_difference_with_retries():
    rnd = random.Random(0)
    a, b = [], []
    for n in [0, 1, 3, 10, 40, 400, 5000]:
        base = [rnd.getrandbits(64) for _ in range(n)]
        a.append(np.array(base[: n // 2 + 1] + [rnd.getrandbits(64) for _ in range(n // 3)], np.uint64))
        b.append(np.array(base[n // 4:], np.uint64))
    for x, y, (only_x, only_y) in zip(a, b, fp.differing(a, b)):
        assert only_x == set(x.tolist()) - set(y.tolist())
        assert only_y == set(y.tolist()) - set(x.tolist())


def expected(rows):
    """By doc_id: hash of the edited text, likeness to it and to the next document."""
    order = sorted(((-10 ** 18 if i is None else i, t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        jac = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), jac(multiset(text), multiset(new)),
                  jac(multiset(text), multiset(following)))
    return out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        n, sha, edited, following = want[-10 ** 18 if r.doc_id is None else r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha), r.doc_id
        assert abs(r.near_edited - edited) < 1e-12 and abs(r.near_next - following) < 1e-12


def test_edits_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = fp.fingerprint_edits(docs).collect()
    check(got, expected(rows))
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_edge_rows(spark):
    rows = [(4, "é" * 9), (1, None), (7, ""), (2, "one\ntwo\ntwo\nthree"), (30, "long line of words. " * 4000),
            (None, "no id"), (-3, "one\ntwo")]
    docs = documents(spark, rows).withColumnRenamed("lang", "part").withColumnRenamed("source", "own")
    check(fp.fingerprint_edits(docs).collect(), expected(rows))
    one = documents(spark, [(5, "alone\nhere")])
    r = fp.fingerprint_edits(one).collect()[0]
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    assert fp.fingerprint_edits(one.limit(0)).count() == 0
    twice = documents(spark, [(5, "same"), (5, "same"), (6, "other")])
    assert sorted(r.doc_id for r in fp.fingerprint_edits(twice).collect()) == [5, 5, 6]
