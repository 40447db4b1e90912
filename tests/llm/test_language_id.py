import zlib

import numpy as np

from tessellate.llm import language_id as li
from tessellate.llm import queries

from .helpers import SF, documents


def test_held_out_accuracy_and_split(spark):
    true = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op3_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id][0] for r in held) / len(held) > 0.97


def test_words_first_then_shorter_grams():
    words = {"the": np.array([-1.0, -5.0])}
    grams = {" der"[:4]: np.array([-9.0, -2.0]), "er": np.array([-4.0, -3.0]), "x": np.array([-1.0, -2.0])}
    score = lambda w: li.word_score(w, words, grams, 2).tolist()
    assert score("the") == [-1.0, -5.0]  # known: its own frequencies
    assert score("derb") == [-9.0, -2.0]  # longest known n-gram only
    assert score("mer") == [-4.0, -3.0]
    assert score("xx") == [-1.0, -2.0]
    assert score("qq") == [0.0, 0.0]


def test_predictions_equal_a_plain_sum(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    model = li.fit(docs, top_words=300, top_grams=500)
    languages, words, grams = model
    assert 300 <= len(words) <= 300 * len(languages) and 500 <= len(grams) <= 500 * len(languages)
    for r in li.predict(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        total = sum((li.word_score(w, words, grams, len(languages)) for w in li.words_of(r.text)), np.zeros(len(languages)))
        assert r.lang_pred == languages[int(np.argmax(total))]
        assert abs(r.score - 1 / np.exp(total - total.max()).sum()) < 1e-9


def test_numerals_are_no_letters():
    words = {"the": np.array([-1.0, -5.0]), "der": np.array([-6.0, -1.0])}
    scorer = li.Scorer((["en", "de"], words, {}))
    assert li.words_of("the²der Ⅷ ½the") == ["the", "der", "the"]
    for text in ("the²der", "the der", "½the Ⅷ der②"):
        assert scorer.predict(text) == scorer.predict("der the")
    assert [scorer.predict(t)[0] for t in ("² ½", "Ⅷ", "12 _", "", None)] == ["und"] * 5
    assert scorer.predict("qq")[0] == "en"  # a letter, but nothing known


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "12 34 ! ² ½ Ⅷ ① ٣ _", "de"),
            (None, "the cat", "en"), (6, "die Katze " * 9000, None), (2, "der Hund und die Katze", "de")]
    docs = documents(spark, rows).withColumnRenamed("source", "lang_pred").withColumnRenamed("n_chars", "score")
    model = li.fit(docs)
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in li.predict(docs, model).collect()))
    assert got == [(0, "en"), (1, "en"), (2, "de"), (2, "de"), (3, "und"), (4, "und"), (6, "de")]
    assert li.fit(docs.limit(0)) is None
    assert [r.lang_pred for r in li.predict(docs.limit(1), None).collect()] == ["und"]
    assert li.predict(docs.limit(0), model).count() == 0
