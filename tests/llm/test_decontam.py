import itertools
import re

import pytest

from tessellate.llm import decontam, queries

from .helpers import SF, documents

QUESTION = "A farmer has 12 cows and sells 5 of them to Anna for 300 dollars each. How much does Anna pay the farmer?"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def plain_template(text):
    """(word, class) with the rules spelt out one token at a time."""
    out, before = [], "break"
    for t in re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n…]", text):
        kind = "number" if t[0].isdigit() else "word" if t[0].isalpha() else "break"
        if kind == "number":
            out.append(("<number>", t))
        elif kind == "word" and before == "number" and t.lower() in decontam.UNITS:
            out.append(("<unit>", t))
        elif kind == "word" and before != "break" and t[0].isupper() and t[1:].islower():
            out.append(("<name>", t))
        elif kind == "word":
            out.append((t.lower(), None))
        before = kind
    return out


def consistent(slots):
    return len({s[:2] for s in slots}) == len(slots) == len({(s[0], s[2]) for s in slots})


def brute(docs, bench):
    """Pairs by comparing all windows of all texts."""
    def wins(text, k):
        t, out = plain_template(text or ""), []
        for i in range(len(t) - k + 1):
            w = t[i:i + k]
            if sum(v is None for _, v in w) >= decontam.MIN_LITERALS:
                out.append((i, tuple(x for x, _ in w), w))
            elif k == decontam.WINDOW:
                out.append((i, ("exactly", *((x if v is None else v).lower() for x, v in w)), w))
        return out

    found = {}
    for item, text in bench:
        k = min(decontam.WINDOW, len(plain_template(text)))
        own = wins(text, k) if k else []
        table = {}
        for i, key, w in own:
            table.setdefault(key, []).append((i, w))
        for doc, dtext in docs:
            by_shift = {}
            for p, key, w in wins(dtext, k) if own else []:
                for i, v in table.get(key, []):
                    places, slots = by_shift.setdefault(p - i, (set(), set()))
                    places.add(i)
                    slots.update((x, a.lower(), b.lower()) for (x, a), (_, b) in zip(v, w) if a is not None)
            good = {s: x for s, x in by_shift.items() if consistent(x[1])}
            if not good:
                continue
            n = len(set().union(*(p for p, _ in good.values())))
            if not consistent(set().union(*(s for _, s in good.values()))):
                n = max(len(p) for p, _ in good.values())
            run = max(len(list(g)) for p, _ in good.values()
                      for _, g in itertools.groupby(enumerate(sorted(p)), lambda x: x[1] - x[0]))
            if n >= decontam.MIN_COVERAGE * len(own) or run >= decontam.MIN_RUN - decontam.WINDOW + 1:
                found[doc, item] = (n, len(own))
    return found


def test_template_of_numbers_names_and_units(spark):
    text = decontam.Words().parse("Tom ran 3 km with Eve. He won 1,000.50 in Rome")
    words, slot = [text.word(i) for i in range(len(text.slot))], text.slot
    assert words == ["Tom", "ran", "3", "km", "with", "Eve", "He", "won", "1,000.50", "in", "Rome"]
    assert slot.tolist() == [0, 0, 1, 3, 0, 2, 0, 0, 1, 0, 2]


@pytest.mark.parametrize("text,caught", [
    (QUESTION, True),
    ("Before it. " + QUESTION.lower() + " After it.", False),  # no name without a capital: half of the windows
    ("Before it. " + QUESTION.replace("12 cows", "12 big cows") + " After it.", True),  # by its longest run
    (QUESTION.replace("12", "40").replace("5 of", "9 of").replace("300", "125"), True),
    (QUESTION.replace("Anna", "Bob"), True),
    (QUESTION.replace("to Anna", "to Bob").replace("does Anna", "does Carl"), False),  # one name, two values
    ("The farmer has cows and sells some of them. He is paid by the month for milk.", False),
])
def test_parameters_may_change_but_consistently(spark, text, caught):
    got = decontam.contaminated(documents(spark, [(1, "Nothing of the sort here."), (2, text)]),
                                items(spark, [(10, QUESTION)]), min_coverage=0.95).collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(2, 10)] if caught else [])


def test_copies_full_of_slots_scattered_pieces_and_two_values(spark):
    sums, names = "Compute 37 * 45 + 12 and 19 * 22", "Alice Brown met Carol Davis and Erin Fox near Lake Como"
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(54)]
    scattered = " filler of other words ".join(" ".join(words[i:i + 5]) for i in range(49, 0, -6))
    half = "the train from <A> leaves at noon and comes to the old town late"
    twice = half.replace("<A>", "Rome") + ". And so " + half.replace("<A>", "Rome")
    docs = [(1, f"Now: {sums}."), (2, f"They say {names} today."), (3, "Compute 38 * 45 + 12 and 19 * 22"), (4, scattered),
            (5, half.replace("<A>", "Bonn") + " then other things. And so " + half.replace("<A>", "Kiel"))]
    bench = [(10, sums), (11, names), (12, " ".join(words)), (13, twice)]
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows)
           for r in decontam.contaminated(documents(spark, docs), items(spark, bench)).collect()}
    assert got == brute(docs, bench)
    assert got[1, 10] == (3, 3) and (2, 11) in got and (3, 10) not in got and not any(d == 4 for d, _ in got)
    assert got[5, 13][0] < got[5, 13][1]  # one name cannot be two: only one half counts


def test_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows)
           for r in queries.QUERIES["op1_decontamination"](spark, SF).collect()}
    assert got == brute(docs, bench) and got


def test_edge_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, QUESTION), (4, QUESTION), (4, QUESTION),
                             (5, "word " * 20_000 + QUESTION), (6, "to be or")])
    docs = docs.withColumnRenamed("lang", "item_id").withColumnRenamed("source", "hash")
    bench = items(spark, [(10, QUESTION), (11, QUESTION), (12, None), (13, ""), (14, "1 2 3"), (15, "to be or")])
    got = sorted(((r.doc_id or 0, r.item_id, r.coverage) for r in decontam.contaminated(docs, bench).collect()))
    assert got == [(0, 10, 1.0), (4, 10, 1.0), (5, 10, 1.0), (6, 15, 1.0)]
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), bench).count() == 0
