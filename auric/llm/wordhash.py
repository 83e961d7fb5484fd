"""Words of many texts as arrays: found and hashed without a Python loop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 18       # text handled at a time, unless one text is longer: its arrays stay in the cache
_BASE = np.uint64(0xD1342543DE82EF95)   # odd
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)     # masks of the first k bytes
LONG = 256                  # bytes of a word that is hashed on its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, stop) for each pair, eight at a time."""
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    length = stop - start
    h = mix(length.astype(np.uint64) * _BASE ^ (eight[start] & _FIRST[np.minimum(length, 8)]))
    more, done = np.flatnonzero((length > 8) & (length <= LONG)), 8
    while len(more):
        left = length[more] - done
        h[more] = mix(h[more] * _BASE ^ (eight[start[more] + done] & _FIRST[np.minimum(left, 8)]))
        more, done = more[left > 8], done + 8
    for i in np.flatnonzero(length > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:stop[i]].tobytes())
    return h


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in pieces of a bounded amount of text."""
    size = np.diff(_offsets(batch[column])) if batch.num_rows else np.zeros(0, np.int64)
    piece = np.cumsum(size) // SLICE_BYTES
    starts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1]))) if len(size) else []
    for a, b in zip(starts, [*starts[1:], len(size)]):
        yield batch.slice(a, b - a)


def words(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, line, hash) of every word in order: the row of its text, the number
    of line feeds before it in the text, and a 64-bit hash of its bytes."""
    offsets = _offsets(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    solid = (data != 32) & (data - np.uint8(9) > 4)      # not a space, nor one of 9 to 13
    first, last = solid.copy(), solid.copy()
    np.greater(solid[1:], solid[:-1], out=first[1:])
    np.greater(solid[:-1], solid[1:], out=last[:-1])
    begins, ends = offsets[offsets < n], offsets[offsets > 0] - 1      # of texts
    first[begins], last[ends] = solid[begins], solid[ends]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    # texts and line feeds are looked up among the words: there are fewer of them
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, offsets)))
    feeds = np.flatnonzero(data == 10)
    passed = np.repeat(np.arange(len(feeds) + 1), np.diff(np.searchsorted(start, feeds), prepend=0, append=len(start)))
    line = passed - np.searchsorted(feeds, offsets[:-1])[row]
    return row, line, _hashes(data, start, stop)
