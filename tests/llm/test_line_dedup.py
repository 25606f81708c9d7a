from collections import Counter

from propgraph.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, source string, text string"


def brute(docs, ratio, least):
    pages = {(h, t) for _, h, t in docs if t is not None}
    total = Counter(h for h, _ in pages)
    held = Counter((h, line) for h, t in pages for line in {x.strip(" \t\r") for x in t.split("\n")} if line)
    gone = {k for k, n in held.items() if n >= least and n > ratio * total[k[0]]}
    out = []
    for i, h, t in docs:
        if t is not None:
            left = "\n".join(x for x in t.split("\n") if (h, x.strip(" \t\r")) not in gone)
            t = left if left.split() else t
        out.append((i, t))
    return out


def test_lines_go_by_their_share_of_the_host(rows):
    docs = [(k, "a" if k % 3 else "b", f"Menu \n\nown line {k}\n" + ("half\n" if k % 2 else "") + f"group {k // 10}\r") for k in range(90)]
    docs += [(100 + k, "a", "copied page\nwhole") for k in range(50)]  # one page, however often
    docs += [(200, None, "Menu\nx"), (201, "c", None), (202, "c", ""), (203, "a", "Menu\n  "), (204, "a", "Menu\nhalf")]
    for ratio, least in ((0.1, 5), (0.6, 2), (0.04, 1)):
        got = [(r.doc_id, r.text) for r in line_dedup(rows(docs, SCHEMA), ratio=ratio, least=least).collect()]
        assert sorted(got) == sorted(brute(docs, ratio, least))


def test_no_document_is_emptied_and_other_columns_pass(rows):
    docs = rows([(k, "a", "only this", k, "x") for k in range(8)] + [(9, "a", "only this\nand this", 9, "y")],
                "doc_id long, source string, text string, keys int, l string")
    out = line_dedup(docs, ratio=0.1, least=2)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text, r.keys) for r in out.collect()} == {*((k, "only this", k) for k in range(8)), (9, "and this", 9)}


def test_pages_of_boilerplate_only_are_flagged(rows):
    docs = rows([(k, "a", "menu\nhome" if k < 4 else f"menu\nown {k}", 1, 2) for k in range(9)] + [(9, "a", None, 1, 2), (10, "a", "", 1, 2)],
                "doc_id long, source string, text string, Boiler int, __keys int")
    out = line_dedup(docs, flag="boiler")
    assert out.columns == ["doc_id", "source", "text", "__keys", "boiler"]
    assert {r.doc_id: (r.text, r.boiler) for r in out.collect()} == {
        **{k: ("home", False) for k in range(4)},
        **{k: (f"own {k}", False) for k in range(4, 9)}, 9: (None, False), 10: ("", False)}
    alike = rows([(k, "a", f"menu\nhome\n{' ' * k}") for k in range(6)], SCHEMA)
    assert [r.boiler for r in line_dedup(alike, flag="boiler").collect()] == [True] * 6


def test_empty_table(rows):
    assert line_dedup(rows([], SCHEMA)).count() == 0
