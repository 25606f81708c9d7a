import math
import random
from collections import defaultdict

import pytest

from propgraph.llm.mixing import CAP, WEIGHTS, mix

SCHEMA = "doc_id long, source string, text string"


def targets(sizes):
    """Shares by weight, those above the cap cut, the excess shared anew until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: WEIGHTS[k % len(WEIGHTS)] for k, n in enumerate(names)}
    full: dict = {}
    while True:
        rest = sum(sizes.values()) - sum(full.values())
        over = sum(w for n, w in weight.items() if n not in full)
        share = {n: rest * w / over for n, w in weight.items() if n not in full}
        above = {n: CAP * sizes[n] for n, t in share.items() if t > CAP * sizes[n]}
        if not above:
            return {**full, **share}
        full |= above


def corpus(seed=2):
    r = random.Random(seed)
    docs = []
    for name, n in (("big", 900), ("é", 120), ("b", 60), ("Z", 40), ("tiny", 6), (None, 80)):
        docs += [(len(docs) + k, name, " ".join(["w"] * int(r.lognormvariate(4, 1)))) for k in range(n)]
    return docs


def test_sources_come_near_their_targets(rows):
    docs = corpus()
    out = mix(rows(docs, SCHEMA)).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(docs)))
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert r.size == len(r.text.split()) and r.taken == r.copies * r.size and 0 <= r.copies <= CAP
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    wanted = targets(size)
    assert {n: pytest.approx(t) for n, t in target.items()} == wanted
    assert {r.source: r.source_size for r in out} == size
    for name, words in taken.items():
        assert abs(words - target[name]) <= 0.01 * target[name] + 20


def test_rates_are_tilted_exponentially(rows):
    """Mean copies by size follow min(cap, exp(l * size)) with one l a source."""
    docs = [(k, "a" if k % 4 else "b", " ".join(["w"] * (10 + k % 90))) for k in range(8000)]
    out = [r for r in mix(rows(docs, SCHEMA)).collect()]
    for name in "ab":
        mean = defaultdict(list)
        for r in out:
            if r.source == name:
                mean[r.size // 20].append((r.size, r.copies))
        logs = [(sum(s for s, _ in x) / len(x), math.log(sum(c for _, c in x) / len(x))) for x in mean.values() if sum(c for _, c in x) < CAP * len(x) * 0.9]
        slopes = [y / x for x, y in logs if x > 30]
        assert max(slopes) - min(slopes) < 0.15 * abs(sum(slopes) / len(slopes)) + 1e-3


def test_reruns_agree(rows):
    docs = corpus(3)
    runs = [sorted((r.doc_id, r.copies) for r in mix(rows(docs, SCHEMA, p)).collect()) for p in (1, 5)]
    assert runs[0] == runs[1]


def test_columns_of_any_name_pass(rows):
    docs = corpus(4)[:200]
    plain = {r.doc_id: r.copies for r in mix(rows(docs, SCHEMA)).collect()}
    more = rows([(*d, 0.5, 2, 3, "h", 1, 7) for d in docs], f"{SCHEMA}, lam double, mean int, bins int, __host string, __size int, __sid int")
    out = mix(more)
    assert out.columns == [*more.columns, "size", "source_size", "target", "taken", "copies"]
    got = out.collect()
    assert {(r.lam, r.mean, r.bins, r["__host"], r["__size"], r["__sid"]) for r in got} == {(0.5, 2, 3, "h", 1, 7)}
    assert sum(r.taken for r in got) == pytest.approx(sum(r.size for r in got), rel=0.02) and len(plain) == len(got)


def test_repeated_ids_of_other_texts_are_mixed_alike_each_time(rows):
    docs = [(1, "a", f"w{k} x") for k in range(60)] + [(2, "b", "y " * 30)] * 3
    runs = [sorted((r.text, r.copies) for r in mix(rows(docs, SCHEMA, p)).collect()) for p in (1, 7)]
    assert runs[0] == runs[1]


def test_multipliers_that_are_not_found_are_an_error(rows, monkeypatch):
    monkeypatch.setattr("propgraph.llm.mixing.STEPS", 1)
    with pytest.raises(RuntimeError, match="don't meet their targets"):
        mix(rows(corpus(), SCHEMA))


def test_many_sources(rows):
    """More sources than one task should see: places in the order of names are those of a sort."""
    docs = [(k, f"s{k % 700}", "w " * (1 + k % 13)) for k in range(2800)]
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(t.split())
    assert {r.source: pytest.approx(r.target) for r in mix(rows(docs, SCHEMA)).collect()} == targets(sizes)


def test_edges(rows):
    docs = rows([(1, "a", None, 5), (2, "a", "", 5), (None, None, "x y", 5), (3, "b", " \x0b\u00a0z ", 5), (3, "b", " \x0b\u00a0z ", 5)],
                "doc_id long, source string, text string, Size int")
    out = mix(docs)
    assert out.columns == ["doc_id", "source", "text", "size", "source_size", "target", "taken", "copies"]
    got = sorted((r.doc_id or 0, r.size, r.source_size) for r in out.collect())
    assert got == [(0, 2, 2), (1, 0, 0), (2, 0, 0), (3, 1, 2), (3, 1, 2)]
    assert mix(rows([], SCHEMA)).count() == 0
    assert [r.taken for r in mix(rows([(1, "a", ""), (2, None, None)], SCHEMA)).collect()] == [0, 0]
