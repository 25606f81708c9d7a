import random
import zlib

from propgraph.llm.toxicity import _Words, fit, judge, score, train

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def corpus(n=400, seed=3):
    r = random.Random(seed)
    plain = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(n):
        sentences = [" ".join(r.choices(plain, k=8)) for _ in range(r.randint(1, 8))]
        toxic = r.random() < 0.25
        if toxic:
            at = r.randrange(len(sentences))
            sentences[at] += r.choice([" idiot", " scumbag", f" lowei{r.choice('abcdef')}"]) + " moron"
        docs.append((k, ". ".join(sentences) + "."))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(rows):
    docs, labels = corpus()
    weights = train(rows(docs, DOCS), rows(labels, LABELS))
    out = {r.doc_id: r for r in score(rows(docs, DOCS), weights).collect()}
    held = [(out[k].tox_score >= 0.7, y == 1) for k, y in labels if zlib.crc32(str(k).encode()) % 3 == 1]
    assert len(held) > 100
    assert sum(a != b for a, b in held) <= 0.03 * len(held)


def test_offending_sentences_are_located(rows):
    docs, labels = corpus()
    weights = fit([t for _, t in docs], [y for _, y in labels])
    text = "word1 word2 word3. Ünd you moron idiot! word4 word5"
    got = score(rows([(1, text)], DOCS), weights).first().tox_sentences
    assert [text[x.start : x.end] for x in got] == [" Ünd you moron idiot"]


def test_score_is_the_noisy_or_of_sentences():
    weights = {"bad": 4.0, "": -3.0}
    words, stems = _Words(weights), _Words({})
    one = judge("bad", words, stems, -3.0)[0]
    plain = judge("fine", words, stems, -3.0)[0]
    both = judge("bad. fine\nbad", words, stems, -3.0)[0]
    assert abs(both - (1 - (1 - one) ** 2 * (1 - plain))) < 1e-12


def test_labels_of_held_out_documents_are_not_learned(rows):
    docs, labels = corpus()
    flipped = [(k, 1 - y) if zlib.crc32(str(k).encode()) % 3 == 1 else (k, y) for k, y in labels]
    assert train(rows(docs, DOCS), rows(labels, LABELS)) == train(rows(docs, DOCS), rows(flipped, LABELS))


def test_edges(rows):
    weights = {"bad": 9.0, "": -3.0}
    docs = rows([(1, None, 1.0), (None, "", 2.0), (3, "...", 3.0), (3, "bad", 4.0), (3, "bad", 4.0), (4, "bad " * 100_000, 5.0)],
                "doc_id long, text string, tox_score double")
    out = score(docs, weights)
    assert out.columns == ["doc_id", "text", "tox_score", "tox_sentences"]
    assert sorted((r.doc_id or 0, round(r.tox_score, 3)) for r in out.collect()) == [(0, 0.0), (1, 0.0), (3, 0.0), (3, 0.998), (3, 0.998), (4, 0.998)]
    assert score(rows([], DOCS), weights).count() == 0


def test_nothing_to_learn(rows):
    docs = rows([(1, "a b"), (2, "c")], DOCS)
    for labels in ([], [(1, 0), (2, 0)], [(None, 1), (1, None), (9, 1)]):
        weights = train(docs, rows(labels, LABELS))
        assert [r.tox_score for r in score(docs, weights).collect()] == [0.0, 0.0]
