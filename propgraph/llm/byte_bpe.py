"""Byte-level BPE over whole texts: padded numpy matrices whose rows each merge one pair a round."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import table, with_fields

#: Characters of texts encoded at once; a longer text is cut where a match surely ends.
CHUNK = 1 << 20
#: Cells of a matrix.
CELLS = 1 << 18
#: Bytes up to which a piece is a row of a matrix; a longer one is a row of its own.
WIDEST = 256
#: Pieces, and their tokens, that a task remembers before it starts anew.
KNOWN, KNOWN_TOKENS = 200_000, 4_000_000

_NONE = np.int32(2**31 - 1)
_EMPTY = np.int64(-2)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_CUT = regex.compile(r"\S(?=\s)")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, file)))}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{path}: no token for the bytes {missing}")
    return ranks


def gathered(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The slices flat[bounds[i] : bounds[i + 1]] of each i in which, one after the other."""
    lengths = bounds[which + 1] - bounds[which]
    ends = np.cumsum(lengths)
    return flat[np.repeat(bounds[which] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Vocabulary:
    """A vocabulary as arrays: bytes of each token, and an open-addressed hash table of mergeable pairs.

    A pair of tokens has the rank of the token that their bytes make together, whichever way that
    token was learned. Token ids are ranks.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.whole = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        lengths = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, rank in ranks.items():
            lengths[rank + 1] = len(token)
        self.bounds = np.cumsum(lengths)
        by_rank = sorted(ranks, key=ranks.get)
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, _EMPTY, np.int64)
        self.ranks = np.zeros(1 << self.bits, np.int32)
        keys, rank = left << 32 | right, rank.astype(np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == _EMPTY
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], rank[put]
            keys, rank, slots = keys[~put], rank[~put], slots[~put]
            slots = np.where(self.keys[slots] == _EMPTY, slots, (slots + 1) & (len(self.keys) - 1))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, _NONE where they don't merge; -1 stands for no token."""
        keys = left.astype(np.int64).ravel() << 32 | right.astype(np.int64).ravel()
        out = np.full(len(keys), _NONE, np.int32)
        todo, slots = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            found = self.keys[slots]
            hit = found == keys
            out[todo[hit]] = self.ranks[slots[hit]]
            on = ~hit & (found != _EMPTY)
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)

    def merged(self, ids: np.ndarray) -> np.ndarray:
        """Rows of token ids, padded with -1: in each round every row merges its leftmost pair of minimum rank.

        Each round shortens each row that is left by one, so the matrix loses a column; rows without a
        pair that merges leave it.
        """
        out = np.full(ids.shape, -1, np.int32)
        rows = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, ranks, at, best = (x[~done] for x in (rows, ids, ranks, at, best))
                if not len(rows):
                    break
            row, width = np.arange(len(rows)), ids.shape[1]
            kept = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            ids = np.take_along_axis(ids, kept, 1)
            ids[row, at] = best
            ranks = np.take_along_axis(ranks, kept[:, : width - 2], 1)
            has = np.flatnonzero(at < width - 2)
            ranks[has, at[has]] = self.pair_ranks(ids[has, at[has]], ids[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.pair_ranks(ids[has, at[has] - 1], ids[has, at[has]])
        return out

    def merged_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: a round does as many of its next merges as are sure to follow each other.

        These are the places of the minimum rank from left to right, up to the first after whose merge a
        pair of lower rank stands beside it: that pair would come next. Rounds are then as many as
        different tokens are made, not as many as merges.
        """
        ranks = np.append(self.pair_ranks(ids[:-1], ids[1:]), _NONE)
        while (best := ranks.min()) != _NONE:
            hits = np.flatnonzero(ranks == best)
            fresh = np.append(True, np.diff(hits) > 1)  # of hits side by side, each second one falls to the one before
            run = np.flatnonzero(fresh)
            hits = hits[(np.arange(len(hits)) - run[np.cumsum(fresh) - 1]) % 2 == 0]
            made = np.full(len(hits), best, np.int32)
            before = np.where(hits > 0, ids[hits - 1], -1)
            before[1:][np.diff(hits) == 2] = best
            after = np.append(ids, [-1, -1])[hits + 2]
            low = np.flatnonzero(np.minimum(self.pair_ranks(before, made), self.pair_ranks(made, after)) < best)
            if len(low):
                hits = hits[: low[0] + 1]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            ids[hits] = best
            ids, ranks = ids[keep], ranks[keep]
            hits -= np.arange(len(hits))
            wide = np.append(ids, -1).astype(np.int32)
            ranks[hits] = self.pair_ranks(wide[hits], wide[hits + 1])
            hits = hits[hits > 0] - 1
            ranks[hits] = self.pair_ranks(ids[hits], ids[hits + 1])
        return ids

    def encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces, one after the other, and how many each has."""
        found: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.whole.get(piece)
            if rank is not None:  # a piece that is a token is that token, also if merges would not lead there
                found[i] = np.array([rank], np.int32)
            elif len(piece) > WIDEST:
                found[i] = self.merged_long(self.byte_ids[np.frombuffer(piece, np.uint8)])
            else:
                buckets.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            for a in range(0, len(members), rows := max(1, CELLS // width)):
                own = members[a : a + rows]
                lengths = np.array([len(pieces[i]) for i in own])
                ids = np.full((len(own), width), -1, np.int32)
                ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in own), np.uint8)]
                ids = self.merged(ids)
                full = ids >= 0
                for i, tokens in zip(own, np.split(ids[full], np.cumsum(full.sum(1))[:-1]), strict=True):
                    found[i] = tokens
        return np.concatenate(found) if found else np.empty(0, np.int32), np.array([len(x) for x in found], np.int64)

    def decoded(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.max() >= len(self.bounds) - 1 or (self.bounds[ids + 1] == self.bounds[ids]).any()):
            raise ValueError("an id is no token of the vocabulary")
        return b"".join(gathered(self.bytes, self.bounds, ids[a : a + CHUNK]).tobytes() for a in range(0, len(ids), CHUNK))


class _Pieces(dict):
    """A number for each piece, in the order in which they were met first."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Texts to token ids; each distinct piece is encoded once and remembered for a while."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.pieces, self.flat, self.bounds = _Pieces(), np.empty(0, np.int32), np.zeros(1, np.int64)

    def _tokens(self, numbers: np.ndarray) -> np.ndarray:
        known = len(self.bounds) - 1
        if len(self.pieces) > known:
            fresh = [p.encode() for p in list(self.pieces)[known:]]
            flat, lengths = self.vocabulary.encoded(fresh)
            self.flat = np.concatenate([self.flat, flat])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
        return gathered(self.flat, self.bounds, numbers)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text. Texts of a chunk are looked up together, a longer one in parts."""
        out, waiting, ends, chars = [], array("q"), [], 0

        def flush() -> None:
            tokens = self._tokens(np.frombuffer(waiting, np.int64))
            sizes = np.cumsum(np.append(0, np.diff(self.bounds)[np.frombuffer(waiting, np.int64)]))
            out.extend(np.split(tokens, sizes[ends[:-1]]) if ends else [])
            if len(self.pieces) > KNOWN or len(self.flat) > KNOWN_TOKENS:
                self._forget()

        for text in texts:
            if len(text) > CHUNK:
                if ends:
                    flush()
                    waiting, ends, chars = array("q"), [], 0
                out.append(self._encode_long(text))
                continue
            waiting.extend(map(self.pieces.__getitem__, self.pattern.findall(text)))
            ends.append(len(waiting))
            chars += len(text)
            if chars > CHUNK:
                flush()
                waiting, ends, chars = array("q"), [], 0
        if ends:
            flush()
        return out

    def _encode_long(self, text: str) -> np.ndarray:
        """A match ends wherever white space follows something else, so such a place parts a text."""
        parts, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, min(at + CHUNK, len(text)))
            to = cut.end() if cut else len(text)
            numbers = np.fromiter(map(self.pieces.__getitem__, self.pattern.findall(text, at, to)), np.int64)
            parts.append(self._tokens(numbers))
            if len(self.pieces) > KNOWN or len(self.flat) > KNOWN_TOKENS:
                self._forget()
            at = to
        return np.concatenate(parts)


def _binaries(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def _encode_task(shared, pattern: str, column: str, keep: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            texts, at = batch.column(column), 0
            while at < len(batch):
                part, chars = [], 0
                while at + len(part) < len(batch) and (not part or chars < CHUNK):
                    text = texts[at + len(part)]
                    part.append((text.as_buffer().to_pybytes() if text.is_valid else b"").decode("utf-8", "replace"))
                    chars += len(part[-1])
                ids = encoder.encode(part)
                rows = batch.slice(at, len(part)).select(keep)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([len(x) for x in ids], pa.int64()), _binaries([x.astype("<u4").tobytes() for x in ids])],
                    names=[*keep, "n_tokens", "token_ids"])
                at += len(part)

    return task


def _without(frame: DataFrame, *names: str) -> list[str]:
    return [c for c in frame.columns if c.lower() not in names]


def _shared(frame: DataFrame, ranks_path: str):
    """The vocabulary for all tasks: a rank file and its pairs, a few tens of MB however many rows there are."""
    return frame.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path)))


def encode(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, column: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with n_tokens (long) and token_ids (binary: little-endian unsigned 32-bit ids of the whole text).

    Each match of pattern is encoded by itself with the ranks of a rank file on the driver, without special
    tokens: their strings are text like any other. Null and empty texts have no tokens; bytes that aren't
    UTF-8 are read as U+FFFD. Rows stay as they are, repeated ones too; columns that are called n_tokens
    or token_ids, in any case, are replaced. A text must fit in a task, with four bytes a token.
    """
    keep = [c for c in _without(docs, "n_tokens", "token_ids") if keep_text or c != column]
    rows = docs.select(*[F.col(f"`{c}`") for c in _without(docs, "n_tokens", "token_ids")])
    schema = with_fields(rows.select(*[f"`{c}`" for c in keep]).schema, "n_tokens long, token_ids binary")
    return rows.mapInArrow(_encode_task(_shared(docs, ranks_path), pattern, column, keep), schema)


def decode(frame: DataFrame, ranks_path: str) -> DataFrame:
    """frame with `decoded` (binary): the bytes of token_ids, in order; null where these are null.

    An id that the vocabulary lacks is an error. A column called decoded, in any case, is replaced.
    """
    rows = frame.select(*[F.col(f"`{c}`") for c in _without(frame, "decoded")])
    shared = _shared(frame, ranks_path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, at = batch.column("token_ids"), 0
            while at < len(batch):
                part, size = [], 0
                while at + len(part) < len(batch) and (not part or size < 4 * CHUNK):
                    own = packed[at + len(part)].as_py()
                    part.append(None if own is None else shared.value.decoded(np.frombuffer(own, "<u4").astype(np.int64)))
                    size += len(own or b"")
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(part)).columns, _binaries(part)], names=[*batch.schema.names, "decoded"])
                at += len(part)

    return rows.mapInArrow(task, with_fields(rows.schema, "decoded binary"))


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens, as digests of their ids and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, keep_text=False)
    ids = ids.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), "token_ids")
    return decode(ids, ranks).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
