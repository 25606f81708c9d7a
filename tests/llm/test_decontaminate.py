import random

import pytest
from pyspark.sql import functions as F

from propgraph.llm.decontaminate import _among, _bitmap, annotated, leaks, without_leaks

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
QUESTION = "yesterday, Tom bought 3 apples and 12 km of rope while Tom sold 3 pears to his sister Anna before dinner"


def found(docs, items, **options):
    return sorted((r.doc_id, r.item_id, round(r.coverage, 2), r.verbatim) for r in leaks(docs, items, **options).collect())


def test_tokens(rows):
    frame = rows([("We met Tom, Bob and X5 on 1,234.50 km. Then 7kg of #1 Éclair; Été!",)], "t string")
    row = annotated(frame, "t", "tokens", "words").first()
    assert " ".join(row.tokens) == "we met #ptom #pbob and #px5 on #n1,234.50 #ukm then #n7 #ukg of #n1 éclair #pété"
    assert " ".join(row.words) == "we met #p #p and #p on #n #u then #n #u of #n éclair #p"


def test_parameters_may_change_but_consistently(rows):
    other = QUESTION.replace("Tom", "Bob").replace("3", "8").replace("12", "40").replace("Anna", "Eva")
    mixed = other.replace("Bob sold", "Eva sold")  # one name for two
    split = other.replace("sold 8", "sold 9")  # two numbers for one
    docs = rows([(1, f"Some words here. {QUESTION} and so on"), (2, f"x y {other}."), (3, mixed), (4, split), (5, "no question at all " * 9),
                 (6, QUESTION.upper()), (7, " ".join(QUESTION.split()[:7]))], DOCS)
    got = found(docs, rows([(10, QUESTION)], ITEMS))
    assert [(d, i, v) for d, i, _, v in got] == [(1, 10, True), (2, 10, False), (6, 10, True)]


def test_shifted_copies_are_added_up(rows):
    item = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(39)).split()
    shifted = " ".join(item[:13] + ["one"] + item[13:26] + ["two"] + item[26:] + ["end"])
    cut = " ".join(item[:13] + item[14:26] + item[28:])
    swapped = " ".join(item[26:] + item[13:26] + item[:13])
    far = " ".join(item[:13] + ["gap"] * 200 + item[13:26])
    got = found(rows([(1, f"so {shifted}"), (2, cut), (3, swapped), (4, far)], DOCS), rows([(1, " ".join(item))], ITEMS))
    assert got == [(1, 1, 1.0, True), (2, 1, 0.92, True)]


def test_names_of_several_words(rows):
    longer = QUESTION.replace("Tom", "Mary Ann").replace("Anna", "Eva Maria Lind")
    mixed = longer.replace("Mary Ann sold", "Eva Maria Lind sold")
    assert found(rows([(1, longer), (2, mixed)], DOCS), rows([(1, QUESTION)], ITEMS)) == [(1, 1, 1.0, False)]


def test_names_at_the_start_of_sentences(rows):
    items = rows([(1, "Tom has 3 apples. How many are left"), (2, "When Tom came, the others asked Tom about nothing")], ITEMS)
    docs = rows([(1, "Well. Bob has 5 apples. How many are left?"), (2, "Mary Ann has 5 apples.\nHow many are left?"), (3, "He says Bob has 5 apples. Why many are left?"),
                 (4, "When Bob came, the others asked Bob about nothing")], DOCS)
    assert [(d, i) for d, i, _, _ in found(docs, items)] == [(1, 1), (2, 1), (4, 2)]


def test_slots_hold_over_shifts(rows):
    half = "then Tom said that there are 4 of these in the old"
    item = f"{half} house while Tom kept only 4 for the poor man who never came"
    good = f"{half.replace('Tom', 'Bob').replace('4', '6')} big house while Bob kept only 6 for the poor man who never came"
    bad = good.replace("Bob kept only 6", "Max kept only 7")
    got = [(d, c >= 0.9) for d, _, c, _ in found(rows([(1, good), (2, bad)], DOCS), rows([(1, item)], ITEMS), cover=0.9)]
    assert got == [(1, True)]


def test_windows_of_placeholders_match_by_value(rows):
    long = "Add the numbers 12 7 31 44 58 6 71 83 95 1002 and then give 5 6 7 8 9 10 11 as the sum"
    docs = rows([(1, "Q: What is 12 + 7 * 3?"), (2, "Q: What is 12 + 7 * 4?"), (3, f"so. {long}, he said"), (4, "What is it")], DOCS)
    assert found(docs, rows([(1, "What is 12 + 7 * 3"), (2, long)], ITEMS)) == [(1, 1, 1.0, True), (3, 2, 1.0, True)]


def test_against_brute_force(rows):
    r = random.Random(4)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    items = [(k, " ".join(r.choices(words, k=r.randint(3, 40)))) for k in range(40)]
    docs = []
    for k in range(200):
        own = r.choices(words, k=r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            part = r.choice(items)[1].split()
            a = r.randrange(len(part))
            part = part[a : a + r.randint(1, 40)] if r.random() < 0.6 else part
            if r.random() < 0.3:
                part[r.randrange(len(part))] = "other"
            at = r.randrange(len(own) + 1)
            own[at:at] = part
        docs.append((k, " ".join(own)))

    def brute(window=8, cover=0.5):
        for d, text in docs:
            own = text.split()
            for i, item in items:
                part = item.split()
                w = min(window, len(part))
                best = 0
                for shift in range(-len(part), len(own) + 1):
                    equal = [0 <= shift + p < len(own) and own[shift + p] == part[p] for p in range(len(part))]
                    held = {q for p in range(len(part) - w + 1) if all(equal[p : p + w]) for q in range(p, p + w)}
                    best = max(best, len(held))
                if best and best >= cover * len(part):
                    yield d, i, round(best / len(part), 2), True

    wanted = sorted(brute())
    assert len(wanted) > 50
    assert found(rows(docs, DOCS), rows(items, ITEMS)) == wanted


@pytest.mark.parametrize("known", [2, 0])
def test_size_of_the_benchmark_changes_nothing(rows, monkeypatch, known):
    """Words looked up by a join say what the constant says, also at the start of sentences."""
    find = "Now find the number of apples that Tom has, if he bought 3 of them. Find also the pears"
    items = rows([(1, QUESTION), (2, find), (3, "Tom has 3 apples. How many are left"), (4, "When Tom came, the others asked Tom about nothing"), (None, None)], ITEMS)
    docs = rows([
        (1, f"a {QUESTION} b"), (2, "c d"), (3, f"So. {find.replace('Now find', 'Find').replace('. Find', '. find')}"), (3, f"Well. {find}"), (None, find.replace("Now", "Bob").replace("Tom", "Eva")),
        (4, "Well. Bob has 5 apples. How many are left?"), (5, "Mary Ann has 5 apples.\nHow many are left?"), (6, "When Bob came, the others asked Bob about nothing"),
        (6, "When Bob came, the others asked Bob about nothing"), (7, "Find the Number. Of Apples. That Tom. Has, if he bought 3 of them"), (8, None)], DOCS)
    wanted = sorted(map(str, leaks(docs, items).collect()))
    monkeypatch.setattr("propgraph.llm.decontaminate.KNOWN", known)
    assert sorted(map(str, leaks(docs, items).collect())) == wanted and len(wanted) >= 6


def test_words_sought_are_a_constant(rows):
    """The words sought are a constant of fixed size, folded once."""
    docs = rows([(1, QUESTION)], DOCS)
    maybe = _bitmap(rows([(k * 7919,) for k in range(1000)], "h long"))
    frame = docs.select(F.transform(F.array(F.xxhash64("doc_id")), maybe).alias("k"))
    assert "from_json" not in frame._jdf.queryExecution().optimizedPlan().toString()
    found = rows([(k,) for k in range(-3000, 3000)], "h long")
    assert found.join(rows([(k,) for k in range(-50, 50)], "h long"), "h").filter(~_bitmap(rows([(k,) for k in range(-50, 50)], "h long"))(F.col("h"))).count() == 0
    assert found.filter(_bitmap(rows([(k,) for k in range(-50, 50)], "h long"))(F.col("h"))).count() == 100
    assert sorted(r.h for r in found.filter(_among(list(range(-50, 50)))(F.col("h"))).collect()) == list(range(-50, 50))


def test_filter_keeps_clean_rows_as_they_are(rows):
    docs = rows([(1, QUESTION, "a"), (1, "clean", "b"), (1, "clean", "b"), (None, QUESTION, "c"), (None, None, "d"), (2, "", "e"), (3, "x " * 50_000 + QUESTION, "f")],
                "doc_id long, text string, item_id string")
    items = rows([(1, QUESTION), (1, QUESTION), (None, QUESTION), (2, None), (3, ""), (4, "?!")], ITEMS)
    out = without_leaks(docs, items)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "", r.item_id) for r in out.collect()) == [(0, "", "d"), (1, "clean", "b"), (1, "clean", "b"), (2, "", "e")]


def test_empty_tables(rows):
    docs, items = rows([(1, QUESTION)], DOCS), rows([(1, QUESTION)], ITEMS)
    assert without_leaks(docs, rows([], ITEMS)).count() == 1
    assert leaks(rows([], DOCS), items).count() == 0
