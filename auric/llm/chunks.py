"""Texts as numbered chunks: what the operators that tokenise work on.

A chunk is what lies between two places where neither tokeniser joins what is
left of the place with what is right of it: single spaces between two
characters that are not white space. The space belongs to the chunk on its
right. Texts repeat most of their chunks, so a block of texts is a short list
of different chunks and a number for each occurrence, and only the list is
tokenised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20       # text of a block, unless one text is longer
SLICE_BYTES = 1 << 20       # text of a row of numbers


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Rows in tables of about ``limit`` bytes of text, in their order."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit - size, side="right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= limit or start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
        del batch                       # not beside the next one
    if held:
        yield pa.Table.from_batches(held)


def numbered(texts: pa.Array, lead: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``numbered_array`` with the chunks as strings."""
    chunks, numbers, per_text = numbered_array(texts, lead)
    return chunks.to_pylist(), numbers, per_text


def numbered_array(texts: pa.Array, lead: bool) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """(chunks, numbers, per_text): the different chunks of the texts, the
    number of each chunk occurrence in order, and how many each text has.

    With ``lead`` a space is put before every text; a null or empty text has no
    chunk then. Without it, a text's first chunk has no space before it.
    """
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = pc.split_pattern(texts, " ")
    flat = parts.flatten().dictionary_encode()
    words = flat.dictionary
    at = flat.indices.to_numpy(zero_copy_only=False)
    per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    open_ = empty | _space_at(words, 0)
    first = np.zeros(len(at), bool)
    first[np.cumsum(per_text) - per_text] = True
    cut = ~open_[at]                                # the chunk may start here
    cut[1:] &= ~empty[at[:-1]]
    cut |= first
    if not cut.all():
        starts = np.flatnonzero(cut)
        joined = pc.binary_join(pa.LargeListArray.from_arrays(
            pa.array(np.append(starts, len(at)), pa.int64()), pc.take(words, pa.array(at))
            .cast(pa.large_string())), pa.scalar(" ", pa.large_string()))
        flat = joined.dictionary_encode()
        words, at = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False)
        per_text = np.add.reduceat(cut.astype(np.int64), np.cumsum(per_text) - per_text)
        first = first[starts]
    del parts, flat
    filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    words = words.cast(pa.large_string())
    chunks = _spaced(words)
    if not lead:
        heads, head_at = np.unique(at[first], return_inverse=True)
        chunks = pa.concat_arrays([chunks, words.take(pa.array(heads))])
        at = at.copy()
        at[first] = len(words) + head_at
    order, numbers = _used(len(chunks), at[np.repeat(filled, per_text)])
    return chunks.take(pa.array(order)), numbers, np.where(filled, per_text, 0)


def whole(texts: pa.Array, lead: bool = True) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``numbered`` with each text one chunk: where nothing is known about
    places at which tokenisers part."""
    texts = pc.fill_null(texts, "").dictionary_encode()
    words, at = texts.dictionary.to_pylist(), texts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = np.fromiter((bool(w) for w in words), bool, len(words))[at]
    order, numbers = _used(len(words), at[filled])
    return [" " + words[i] if lead else words[i] for i in order.tolist()], numbers, filled.astype(np.int64)


def _space_at(words: pa.Array, place: int) -> np.ndarray:
    """Whether the character at ``place`` of each word is white space."""
    return pc.utf8_is_space(pc.utf8_slice_codeunits(words, place, place + 1)).to_numpy(zero_copy_only=False)


def _spaced(words: pa.LargeStringArray) -> pa.LargeStringArray:
    """Each word with a space before it."""
    space = pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(space, words, pa.scalar("", pa.large_string()))


def unspaced_start(chunks: pa.Array) -> np.ndarray:
    """Chunks of a space and then a character that is not white space."""
    spaced = pc.starts_with(chunks, " ").to_numpy(zero_copy_only=False)
    return spaced & (pc.binary_length(chunks).to_numpy(zero_copy_only=False) > 1) & ~_space_at(chunks, 1)


def joined(chunks: pa.LargeStringArray) -> tuple[str, np.ndarray]:
    """(text, ends): the chunks one after another, and where each ends in bytes."""
    _, offsets, data = chunks.buffers()
    ends = np.frombuffer(offsets, np.int64)[chunks.offset:chunks.offset + len(chunks) + 1] if len(chunks) else np.zeros(1, np.int64)
    text = str(memoryview(data)[int(ends[0]):int(ends[-1])], "utf-8") if ends[-1] > ends[0] else ""
    return text, ends[1:] - ends[0]


def _used(n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, numbers): which of ``n`` chunks occur, the frequent ones first,
    and the occurrences' numbers in that order."""
    often = np.bincount(at, minlength=n)
    order = np.argsort(-often, kind="stable")[:int((often > 0).sum())]
    new = np.zeros(n, np.int64)
    new[order] = np.arange(len(order))
    return order, new[at]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each (start, length), one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on by byte planes, compressed."""
    width = 4 if not len(numbers) or int(numbers.max()) < 1 << 32 else 8
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return bytes([width]) + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    width, size = blob[0], int.from_bytes(blob[1:9], "little")
    planes = np.frombuffer(pa.decompress(blob[9:], decompressed_size=size, codec="zstd"), np.uint8) if size \
        else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def strings(blob: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [blob[a:b] for a, b in zip([0, *ends], ends)]


def row_slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES`` of text each."""
    at = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))).tolist() if len(sizes) else []
    yield from zip(starts, [*starts[1:], len(sizes)])
