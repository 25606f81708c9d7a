import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propgraph.llm.chat import digests, escape, format_chats, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<", "|", "\\", ">", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|nl|>", "\n", "<\\|", "assistant", "é😀", "$1", ""]


def check(rows, data):
    """Formatted conversations read back are what was formatted; digests and masks agree."""
    chats = format_chats(rows(data, SCHEMA)).cache()
    wanted = {}
    for conv, turn, role, text in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(conv, []).append((role or "", text or ""))
    read = {r.conv_id: [(run.role, t) for run in r.runs for t in run.parts] for r in chats.select("conv_id", read_back(F.col("formatted")).alias("runs")).collect()}
    assert read == wanted
    out = {r.conv_id: r for r in digests(chats).collect()}
    for r in chats.collect():
        own = wanted[r.conv_id]
        turns, loss = "".join(f"{a}\n{b}\n" for a, b in own), "".join(b for a, b in own if a == "assistant")
        d = out[r.conv_id]
        assert (d.n_turns, d.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d.formatted_chars == len(r.formatted) == sum(m.chars for m in r.loss_mask)
        at, masked = 0, []
        for m in r.loss_mask:
            assert len(r.formatted[at : at + m.chars].encode()) == m.bytes
            masked += [r.formatted[at : at + m.chars]] if m.learned else []
            at += m.chars
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in masked] == [b for a, b in own if a == "assistant"]
        assert r.formatted.count("<|im_start|>") == 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:]))


@settings(max_examples=8, deadline=None)
@given(st.data())
def test_round_trip(spark, data):
    text = st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=6).map("".join))
    rows = data.draw(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 4)),
                                        st.one_of(st.sampled_from(["user", "assistant", "system"]), text), text), min_size=1, max_size=30))
    check(lambda d, s: spark.createDataFrame(d, s).repartition(2), rows)


def test_adjacent_turns_of_a_role_share_a_block(rows):
    data = [(1, 2, "assistant", "b"), (1, 1, "assistant", "a"), (1, 0, "user", "q"), (1, 3, "user", "")]
    out = format_chats(rows(data, SCHEMA)).first()
    assert out.formatted == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_sep|>b<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    check(rows, data)


def test_long_conversations_and_repeated_rows(rows):
    check(rows, [(1, k // 2, "user" if k % 6 < 3 else "assistant", f"turn {k} " * 50) for k in range(3000)] + [(2, 0, "user", "same")] * 3 + [(3, 0, "user", "x" * 1_000_000)])


def test_escapes_leave_no_control_string(rows):
    texts = ["".join(PIECES[k % len(PIECES)] for k in (a, b, c)) for a in range(14) for b in range(14) for c in range(14)]
    out = rows([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u and "<|" not in r.e for r in out)


def test_empty_table(rows):
    assert digests(format_chats(rows([], SCHEMA))).count() == 0


def test_digests_are_read_through_the_mask(rows):
    """A mask that is off by a character, or learns another role, gives other digests; it is in the plan."""
    chats = format_chats(rows([(1, 0, "user", "quéstion"), (1, 1, "assistant", "<|answer"), (1, 2, "user", "x"), (1, 3, "assistant", "more")], SCHEMA))
    right = digests(chats).first()
    assert (right.loss_chars, right.loss_sha256) == (12, hashlib.sha256(b"<|answermore").hexdigest())
    swapped = F.transform("loss_mask", lambda m: m.withField("learned", ~m["learned"]))
    first = F.concat(F.array(F.get("loss_mask", 0).withField("bytes", F.get("loss_mask", 0)["bytes"] + 1)), F.slice("loss_mask", 2, 99))
    for broken in (swapped, first, F.slice("loss_mask", 2, 99)):
        assert digests(chats.withColumn("loss_mask", broken)).first().loss_sha256 != right.loss_sha256
    assert "learned" in digests(chats)._jdf.queryExecution().optimizedPlan().toString()
