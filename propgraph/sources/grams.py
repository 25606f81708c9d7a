"""Postings of batches of texts, made in tasks: of each gram, the ids of the elements that have it.

A few MB of texts at a time: the characters become numbers, a gram and its element one number, and these are sorted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors needn't have the library

#: Bytes of texts handled at a time (one text at least): bounds a task's memory, some 40 bytes each.
PIECE_BYTES = 4 << 20


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows one after the other that are of one type and bucket, up to PIECE_BYTES of texts."""
    _, texts, kinds, buckets = batch.columns
    codes, numbers = kinds.dictionary_encode().indices.to_numpy(zero_copy_only=False), buckets.to_numpy(zero_copy_only=False)
    other = np.flatnonzero((codes[1:] != codes[:-1]) | (numbers[1:] != numbers[:-1])) + 1
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    for end in (*other.tolist(), len(batch)):
        while at < end:
            most = np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE_BYTES, "right")
            upto = min(end, max(at + 1, int(most)))
            yield batch.slice(at, upto - at)
            at = upto


def _postings(rows: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """Each gram of the rows' texts once, in order, with the ids of the rows that have it."""
    ids, texts, kinds, buckets = rows.columns
    read = [text.decode("utf-8", "replace") for text in texts.to_pylist()]
    chars = np.frombuffer("".join(read).encode("utf-32-le"), np.uint32)
    if len(chars) < width:
        return
    met = np.zeros(int(chars.max()) + 1, bool)
    met[chars] = True
    letters = np.flatnonzero(met)
    base, shift = len(letters), (len(rows) - 1).bit_length()
    if (base**width).bit_length() + shift > 63 and len(rows) > 1:  # a number of 64 bits doesn't hold a gram and a row
        half = len(rows) // 2
        yield from _postings(rows.slice(0, half), width)
        yield from _postings(rows.slice(half), width)
        return
    codes = (np.cumsum(met) - 1)[chars]
    owner = np.repeat(np.arange(len(rows)), [len(text) for text in read])
    last = len(chars) - width + 1
    key = codes[:last].copy()
    for k in range(1, width):
        key *= base
        key += codes[k : last + k]
    key <<= shift
    key |= owner[:last]
    key = key[owner[:last] == owner[width - 1 :]]
    del codes, owner
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    grams, owners = key >> shift, key & ((1 << shift) - 1)
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(key) else key
    if not len(starts):
        return
    grams = grams[starts]
    spelled = np.empty((len(grams), width), np.uint32)
    for k in reversed(range(width)):
        grams, digit = np.divmod(grams, base)
        spelled[:, k] = letters[digit]
    text = spelled.astype("<u4").tobytes().decode("utf-32-le")
    names = pa.array([text[i : i + width] for i in range(0, len(text), width)], ids.type)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(key)], pa.int32()), ids.take(pa.array(owners)))
    yield pa.RecordBatch.from_arrays([names, lists, pa.repeat(kinds[0], len(names)), pa.repeat(buckets[0], len(names))], names=["gram", "ids", "kind", "bucket"])


def postings_task(width: int, names: list[str]):
    """For mapInArrow: rows of id, text in bytes, type, bucket become rows of the named four, gram, ids, type, bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                for found in _postings(piece, width):
                    yield found.rename_columns(names)

    return task
