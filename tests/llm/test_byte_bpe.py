import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from propgraph.llm import byte_bpe
from propgraph.llm.byte_bpe import Encoder, Vocabulary, decode, encode, op11_byte_bpe, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return Vocabulary(ranks)


def plain(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(3)
    signs = "aàbc ABé'stl 12٣4\n\t\r 　日本語한국 \U0001f600!?<|endoftext|>‍́"
    out = ["", " ", "a", "It's we'll\n\n  x", "<|endoftext|>", "a" * 5000, "ab" * 3000, " " * 4000, "ACGT" * 900, "日本語" * 700, "\x00\x01\x1c\x1d x"]
    out += ["".join(r.choice(signs) for _ in range(r.randrange(1, 300))) for _ in range(300)]
    out += ["".join(r.choice("acgt") for _ in range(n)) for n in (255, 256, 257, 4000)]
    out += ["".join(r.choice("eiaonrtsh") for _ in range(n)) for n in (64, 65, 300, 3000)]
    return out


def test_as_the_library_encodes(ranks, vocabulary):
    library, own = plain(ranks), texts()
    got = Encoder(vocabulary, public_tokenizers.PATTERN).encode(own)
    assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in own]
    assert [vocabulary.decoded(x.astype(np.int64)) for x in got] == [t.encode() for t in own]


@pytest.mark.parametrize("name, value", [("CHUNK", 40), ("CELLS", 64), ("WIDEST", 3), ("KNOWN", 5)])
def test_sizes_change_nothing(ranks, vocabulary, monkeypatch, name, value):
    monkeypatch.setattr(byte_bpe, name, value)
    library, own = plain(ranks), texts()
    got = Encoder(vocabulary, public_tokenizers.PATTERN).encode(own)
    assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in own]


def by_hand(ranks, piece):
    """One merge at a time: the leftmost pair of least rank."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if not found:
            return [ranks[p] for p in parts]
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_ranks_that_fall_after_a_merge():
    """Merges may make a pair of lower rank than their own: nothing may be merged ahead of it."""
    r = random.Random(9)
    for _ in range(60):
        tokens = {bytes([r.choice(b"abc") for _ in range(r.randrange(2, 6))]) for _ in range(40)}
        order = list(tokens)
        r.shuffle(order)
        ranks = {t: k for k, t in enumerate(order)} | {bytes([b]): len(order) + b for b in range(256)}
        own = Vocabulary(ranks)
        pieces = [bytes(r.choice(b"abc") for _ in range(r.randrange(1, 60))) for _ in range(30)]
        flat, lengths = own.encoded(pieces)
        assert [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])] == [by_hand(ranks, p) for p in pieces]
        for p in pieces:
            if p not in ranks:
                assert own.merged_long(own.byte_ids[np.frombuffer(p, np.uint8)]).tolist() == by_hand(ranks, p)


def test_frames(rows, ranks):
    library = plain(ranks)
    data = [(1, None, "x"), (2, "", "y"), (3, "Hello world", "z"), (3, "Hello world", "z"), (None, "b " * 50_000, None)]
    docs = rows(data, "doc_id long, text string, Token_Ids string")
    out = encode(docs, PATH)
    assert out.columns == ["doc_id", "text", "n_tokens", "token_ids"]
    for r in decode(out, PATH).collect():
        wanted = library.encode_ordinary(r.text or "")
        assert (r.n_tokens, np.frombuffer(r.token_ids, "<u4").tolist(), bytes(r.decoded)) == (len(wanted), wanted, (r.text or "").encode())
    assert out.count() == 5
    assert decode(rows([(1, None)], "doc_id long, token_ids binary"), PATH).collect()[0].decoded is None
    assert encode(rows([], "doc_id long, text string"), PATH).count() == 0


def test_bytes_that_are_no_text(spark, ranks):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    out = encode(docs, PATH, keep_text=False).collect()[0]
    assert np.frombuffer(out.token_ids, "<u4").tolist() == plain(ranks).encode_ordinary("a�b")


def test_unknown_ids_and_ranks(vocabulary, tmp_path):
    with pytest.raises(ValueError, match="no token of the vocabulary"):
        vocabulary.decoded(np.array([50256]))
    (tmp_path / "ranks").write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError, match="no token for the bytes"):
        read_ranks(str(tmp_path / "ranks"))


def test_query_over_the_whole_table(spark, ranks):
    folder = "/root/testdata/sf0.001"
    library = plain(ranks)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = op11_byte_bpe(spark, folder).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert tuple(r) == (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
