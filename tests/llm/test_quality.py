import math
from collections import Counter, defaultdict

import pytest

from tessellate.llm import quality, queries

from .helpers import SF, documents


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney probability, from nested counts and recursion."""
    counts = {order: Counter()}
    for t in texts:
        padded = quality.START * (order - 1) + t
        for i in range(len(t)):
            counts[order][padded[i:i + order]] += 1
    for k in range(order - 1, 0, -1):
        before = defaultdict(set)
        for g in counts[k + 1]:
            before[g[1:]].add(g[0])
        counts[k] = Counter({g: len(x) for g, x in before.items()})

    def discount(k, c):
        n = Counter(counts[k].values())
        n1, n2, n3, n4 = (n[i] for i in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return [0.5, 1.0, 1.5][min(c, 3) - 1]
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3][min(c, 3) - 1]
        return min(max(d, 0.05), min(c, 3) - 0.05)

    sums = {k: defaultdict(list) for k in counts}
    for k in counts:
        for g, c in counts[k].items():
            sums[k][g[:-1]].append(c)

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        below = sums[k].get(gram[:-1])
        if not below:
            return p(gram[1:])
        c = counts[k].get(gram, 0)
        own = c - discount(k, c) if c else 0
        return (own + sum(discount(k, x) for x in below) * p(gram[1:])) / sum(below)

    return p


def fit(trusted, order=quality.ORDER):
    """The library's model, gathered: log probabilities, log weights of contexts, and the log of what is never seen."""
    tables, contexts, unseen = quality.kneser_ney(quality.count_grams(trusted, order), order)
    model = {"grams": {}, "rests": {}, "order": order, "unseen": math.log(unseen)}
    for name, frames, value in (("grams", tables, "p"), ("rests", contexts, "rest")):
        for t in frames:
            model[name].update((r[0], math.log(r[1])) for r in t.select("gram", value).collect())
    return model


def log_probability(gram, model):
    total = 0.0
    while gram:
        if gram in model["grams"]:
            return total + model["grams"][gram]
        total += model["rests"].get(gram[:-1], 0.0) if len(gram) > 1 else 0.0
        gram = gram[1:]
    return total + model["unseen"]


def plain_scores(docs, model):
    """``(doc_id, lang, n, nll)`` of collected documents, character by character."""
    pad = quality.START * (model["order"] - 1)
    out = []
    for r in docs.collect():
        padded = pad + (r.text or "")
        nll = -math.fsum(log_probability(padded[i:i + model["order"]], model) for i in range(len(r.text or "")))
        out.append((r.doc_id, r.lang, len(r.text or ""), nll))
    return out


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "", "thé çà", "on on on"]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_model_equals_recursive_definition(spark, order):
    model = fit(spark.createDataFrame([(t,) for t in [*TEXTS, None]], "text string"), order)
    p = brute_model(TEXTS, order)
    for text in ["the cat", "xyz", "a log on a mat", "thé"]:
        padded = quality.START * (order - 1) + text
        for i in range(len(text)):
            g = padded[i:i + order]
            assert math.isclose(log_probability(g, model), math.log(p(g)), rel_tol=1e-9), g


def test_probabilities_of_a_context_add_up(spark):
    model = fit(spark.createDataFrame([(t,) for t in TEXTS], "text string"), 3)
    letters = {g for g in model["grams"] if len(g) == 1}
    for context in ["th", "at", "on", "zz"]:
        total = sum(math.exp(log_probability(context + c, model)) for c in letters)
        total += math.exp(log_probability(context + "\x07", model))
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_query_keeps_good_and_rejects_bad_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == docs
    good = [got[r.doc_id].accepted for r in labels if r.quality == 1 and not r.toxic]
    bad = [got[r.doc_id].accepted for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.3
    assert all((r.perplexity <= r.threshold) == r.accepted for r in got.values())


def test_edge_rows(spark):
    rows = [(1, "good words of a text and more of them", "en"), (2, None, "en"), (3, "", None), (4, "#§%&" * 50, "xx"),
            (None, "good words of a text", "en"), (1, "good words of a text and more of them", "en"), (6, "good words " * 3000, None)]
    docs = documents(spark, rows).withColumnRenamed("source", "nll").withColumnRenamed("n_chars", "threshold")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 0), (6, 1, None), (None, 1, 0), (99, 1, 0)],
                                   "doc_id long, quality long, toxic long")
    got = sorted((r.doc_id or 0, r.accepted) for r in quality.classify(docs, labels).collect())
    assert got == [(0, True), (1, True), (1, True), (2, True), (3, True), (4, False), (6, True)]
    none = quality.classify(docs, labels.limit(0)).collect()
    assert len(none) == 7 and all(r.accepted and r.threshold is None for r in none)
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_rare_grams_of_large_corpora_count(spark):
    import random

    draw = random.Random(5)
    # more distinct n-grams than 100,000, almost all of them once
    texts = ["".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(30_000)) for _ in range(4)]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(9, texts[0][:500] + "x" + texts[1][:500])])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality long, toxic long")
    model = fit(docs.where("doc_id < 9").select("text"))
    assert sum(len(g) == quality.ORDER for g in model["grams"]) > 100_000
    nll = {r[0]: r[3] for r in plain_scores(docs, model)}
    mean = sum(nll[i] for i in range(4)) / 120_000
    want = (nll[9] + quality.SHRINK * mean) / (1001 + quality.SHRINK)
    seen = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert math.isclose(math.log(seen[9].perplexity), want, rel_tol=1e-9)


def test_joined_scores_equal_those_of_the_gathered_model(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(90, "the cat " * 500), (91, None), (None, "xyz 𝔘 log"), (1, TEXTS[1])])
    trusted = docs.where("doc_id < 5").select("text")
    model = fit(trusted, 3)
    tables = quality.kneser_ney(quality.count_grams(trusted, 3), 3)
    plain = lambda rows: sorted((r[0] or -1, r[1], r[2], round(r[3], 8) + 0.0) for r in rows)
    want = plain(plain_scores(docs, model))
    for block in (10, 1 << 20):
        assert plain(quality.score(docs, *tables, block=block).collect()) == want


def test_threshold_is_the_quantile_of_held_out_documents(spark):
    import random

    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(3, 8))) for _ in range(300)]
    prose = lambda: " ".join(draw.choice(words) for _ in range(60))
    mixed = lambda: prose()[:310] + " " + "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40))
    rows = ([(i, prose()) for i in range(400)] + [(i, prose()) for i in range(400, 600)] + [(i, mixed()) for i in range(600, 700)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality long, toxic long")
    got = {r.doc_id: r.accepted for r in quality.classify(documents(spark, rows), labels).collect()}
    clean = sum(got[i] for i in range(400, 600)) / 200
    junk = sum(got[i] for i in range(600, 700)) / 100
    assert clean >= 0.95 and junk <= 0.05, (clean, junk)


def test_a_task_holds_small_pieces_and_merges_short_lists(spark, monkeypatch):
    docs = documents(spark, [(i, TEXTS[i % 3] * 15_000, "en") for i in range(8)])  # 200,000 to 330,000 characters each
    pieces = quality.packed(quality._texts(docs).coalesce(1))
    assert all(sum(map(len, t.column("text").to_pylist())) < 1 << 20 for t in quality._unpacked(pieces.toArrow()))
    none = spark.createDataFrame([], "good_id long")
    listed = lambda: sorted((r.gram, r.others, r.rest) for r in quality.gram_counts(quality.block_grams(pieces, none)).collect())
    want = listed()
    monkeypatch.setattr(quality, "HELD", 10)
    assert listed() == want and len(want) > 30


def test_models_side_by_side_equal_models_of_their_own(spark):
    names = ("_all", "_part", "_none")
    whole, part = (Counter({r.gram: r.c for r in quality.count_grams(spark.createDataFrame([(t,) for t in texts], "text string"), 3).collect()})
                   for texts in (TEXTS, TEXTS[1:3]))
    rows = [(g, whole[g], part[g], 0) for g in whole]
    tables, contexts, unseen = quality.kneser_neys(spark.createDataFrame(rows, "gram string, c_all long, c_part long, c_none long"), names, 3)
    asked = spark.createDataFrame([(g,) for g in ["the", "cat", "dog", "xyz", "aa ", "t\u00e9x", " \u00e7\u00e0"]], "gram string")
    got = {r.gram: r for r in quality.resolve(asked, tables, contexts, unseen).collect()}
    assert len(got) == 7
    for name, texts in zip(names, (TEXTS, TEXTS[1:3], [])):
        model = fit(spark.createDataFrame([(t,) for t in texts], "text string"), 3)
        assert math.isclose(math.log(unseen[name]), model["unseen"], rel_tol=1e-12, abs_tol=1e-12)
        for table, values in (("p", "grams"), ("rest", "rests")):
            have = {r[0]: math.log(r[1]) for t in (tables if table == "p" else contexts)
                    for r in t.select("gram", table + name).where(f"{table}{name} is not null").collect()}
            assert have == pytest.approx(model[values], rel=1e-9, abs=1e-12)
        for g, r in got.items():
            assert math.isclose(r[f"x{name}"], log_probability(g, model), rel_tol=1e-9, abs_tol=1e-12), (name, g)


def test_both_models_come_from_one_set_of_queries(spark, monkeypatch):
    """What the driver plans, starts and keeps: the two models once made it exceed its memory."""
    made, keep = Counter(), quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name: made.update([name]) or keep(df, name))
    docs = documents(spark, [(i, t, "en") for i, t in enumerate(TEXTS)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality long, toxic long")
    rows = quality.classify(docs, labels)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == len(TEXTS)
    assert made["contexts"] == made["probabilities"] == quality.ORDER and made["looked-up"] == quality.ORDER - 1, made
    assert plan.count("Exchange") <= 6, plan
