import random

import numpy as np
import pytest

from propgraph.llm.url_filter import RULES, DigestArray, url_filter

PAGES, RULE = "page_id long, url string", "rule string, verdict string"


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, rest = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    best = None
    for rule, verdict in rules:
        own, at = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + at):
            best = max(best or (-1,), (len(rule), len(own), rule, verdict))
    return host, path, *(best[2:] if best else (None, default))


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.EXAMPLE.ORG/es/x?y#z", "https://example.org", "https://example.org?/es/", "x://y://example.com/de/",
    "http://example.org/en/1", "http://example.org/en/12/3", "http://example.org/en/2", "http://notexample.org/es/", "http://ÄX.Com/de/ü",
    "http://a.com/fr/#f", "http://com/de/", "http://a..com/de/", "http://.org/", "http://a.org:80/", "http://a.com/fr/" + "p" * 100_000,
]


@pytest.mark.parametrize("array_rules", [10, 0])
def test_verdicts(rows, array_rules):
    r = random.Random(1)
    urls = URLS + [f"http://{r.choice(['a.', 'b.a.', ''])}{r.choice(['x.org', 'example.org', 'y.com', 'net'])}/{r.choice(['es/', 'en/1', 'en/3', 'de/', 'fr/', ''])}{k}"
                   for k in range(300)]
    out = url_filter(rows(list(enumerate(urls)), PAGES), rows(RULES, RULE), array_rules=array_rules).collect()
    assert {r.page_id: tuple(r)[2:] for r in out} == {k: brute(u, RULES) for k, u in enumerate(urls)}


@pytest.mark.parametrize("array_rules", [100, 0])
def test_rules_clean_ties_and_other_columns(rows, array_rules):
    rules = rows([("A.com/x", "allow"), ("a.com/x", "block"), ("com/a/xy", "allow"), (None, "block"), ("/p", "block"), ("b.com", "block"), ("a.com/z", None),
                  ("a.com/z", "maybe")], RULE)
    pages = rows([(1, "http://a.com/xyz", "h"), (1, "http://a.com/xyz", "h"), (2, "http://a.com/a/xyz", "h"), (3, "http://b.com/", "h"), (4, "http://a.com/z", "h")],
                 "page_id long, url string, Host string")
    out = url_filter(pages, rules, default="block", array_rules=array_rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert sorted((r.page_id, r.rule, r.verdict) for r in out.collect() if r.rule) == [(1, "a.com/x", "block"), (1, "a.com/x", "block"), (2, "com/a/xy", "allow")]
    assert sorted((r.page_id, r.verdict) for r in out.collect() if not r.rule) == [(3, "block"), (4, "block")]


@pytest.mark.parametrize("array_rules", [100, 0])
def test_empty_tables(rows, array_rules):
    assert url_filter(rows([], PAGES), rows(RULES, RULE), array_rules=array_rules).count() == 0
    assert [r.verdict for r in url_filter(rows([(1, "http://a.org/")], PAGES), rows([], RULE), array_rules=array_rules).collect()] == ["allow"]


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr("propgraph.llm.url_filter.xxhash.xxh64_intdigest", lambda x: len(x) % 2)
    DigestArray.write([("a.b/", "block"), ("a.c/", "allow"), ("b.cc/", "block"), ("c.dd/", "allow")], str(tmp_path / "x"))
    array = DigestArray(str(tmp_path / "x"))
    keys = [b"a.c/", b"a.b/", b"a.d/", b"c.dd/", b"b.cc/", b"x.yy/", b""]
    assert [array.string(k).decode() if k >= 0 else None for k in array.probe(keys)] == ["a.c/", "a.b/", None, "c.dd/", "b.cc/", None, None]
    assert (np.diff(array.digests.astype(np.int64)) >= 0).all()
