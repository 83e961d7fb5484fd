"""Packing documents into sequences: first-fit decreasing by tournament tree.

Documents are tokenised where they are read and cut into pieces of at most one
sequence. Whole-sequence pieces stand alone; the rest of each document is an
item. Pieces are dealt out by a seeded hash of their document; in that order a
fixed number of them is a group, and each group packs its items on its own: in
order of falling length, an item goes to the first open sequence with room,
found by descending a tournament tree of the sequences' remaining room. Only
piece descriptions are shuffled, not tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm import chunks
from auric.llm.bpe import tokenizer_path as public_path
from auric.llm.bytebpe import ByteBpe, mergeable
from auric.llm.common import tidy
from auric.llm.wordhash import mix

LENGTH = 1024
GROUP = 1024            # pieces packed together
SEED = 7
END = 0
TOKENIZER = "byte_bpe_50k.json"
BLOCK_BYTES = 1 << 20   # text tokenised at a time, unless one text is longer

PIECES = "dealt long, doc_id long, doc_tokens long, start long, length long, ids_crc32 long"
def token_ids(tokenizer: ByteBpe, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, per_text): the texts' ids one after another, each text's followed
    by the end id. Every different chunk of the texts is tokenised once."""
    # A special token with a space in it could lie over a place between chunks.
    cut = chunks.whole if any(" " in s for s in tokenizer.special) else chunks.numbered_array
    found, numbers, per_text = cut(texts, lead=False)
    ids, lengths = tokenizer(found)
    flat, lengths = np.append(ids, END).astype("<u4"), np.append(lengths, 1)
    ends = np.cumsum(per_text)
    numbers = np.insert(numbers, ends, len(found))
    starts = np.cumsum(lengths) - lengths
    per_text = np.diff(np.concatenate(([0], np.cumsum(lengths[numbers])))[
        np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))])
    return flat[chunks.ranges(starts[numbers], lengths[numbers])], per_text


def _pieces(length: int, path: str, fast: bool, seed: int, with_ids: bool):
    """mapInArrow function: (doc_id, key, text) to pieces. ``key`` is a hash of
    doc_id and text; rows with one key are dealt anew every ``GROUP`` rows, so
    that many copies do not lie together."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = ByteBpe.load(path, fast, plain=False)
        here = mix(np.array([TaskContext.get().partitionId() + (seed << 32)], np.uint64))[0]
        seen = np.zeros(1 << 20, np.int64)
        for table in chunks.blocks(batches, limit=BLOCK_BYTES):
            key = table["key"].to_numpy().astype(np.int64).view(np.uint64)
            slot = (key & np.uint64(len(seen) - 1)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            nth = np.empty(len(slot), np.int64)
            kinds, first, many = np.unique(slot[order], return_index=True, return_counts=True)
            nth[order] = np.arange(len(slot)) - np.repeat(first, many)
            nth += seen[slot]
            seen[kinds] += many
            dealt = mix(mix(key ^ here) + (nth // GROUP).astype(np.uint64)).view(np.int64)
            ids, per_text = token_ids(tokenizer, table["text"].combine_chunks())
            data = memoryview(ids).cast("B")
            n = -(-per_text // length)
            row = np.repeat(np.arange(len(n)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * length
            size = np.minimum(length, per_text[row] - start)
            at = (np.cumsum(per_text) - per_text)[row] + start
            parts = [data[4 * a:4 * b] for a, b in zip(at.tolist(), (at + size).tolist())]
            columns = [pa.array(dealt[row]), table["doc_id"].combine_chunks().take(pa.array(row)),
                       *map(pa.array, (per_text[row], start, size)), pa.array(list(map(zlib.crc32, parts)), pa.int64())]
            names = [f.split()[0] for f in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array([bytes(x) for x in parts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return cut


class Tournament:
    """Remaining room of sequences in a tree of maxima: ``first(need)`` is the
    first sequence with that much room, in logarithmic time."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.tree = [room] * (2 * self.leaves)

    def first(self, need: int) -> int:
        at, tree = 1, self.tree
        while at < self.leaves:
            at = 2 * at if tree[2 * at] >= need else 2 * at + 1
        return at - self.leaves

    def fill(self, leaf: int, amount: int) -> None:
        tree, at = self.tree, leaf + self.leaves
        tree[at] -= amount
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each item. Ties in length keep the given order."""
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = Tournament(max(1, len(lengths)), room)
    for i in order.tolist():
        need = int(lengths[i])
        leaf = tree.first(need)
        where[i], offset[i] = leaf, room - tree.tree[leaf + tree.leaves]
        tree.fill(leaf, need)
    return where, offset


def _packed(length: int, group: int):
    """mapInArrow function over pieces in the order in which they were dealt:
    every ``group`` of them is packed on its own."""
    def pack(rows: pa.Table, first: int) -> tuple[pa.Table, int]:
        rows = rows.drop(["dealt"])
        sizes = rows["length"].to_numpy()
        full = sizes == length
        where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        where[~full], offset[~full] = first_fit_decreasing(sizes[~full], length)
        opened = int(where[~full].max()) + 1 if (~full).any() else 0
        where[full] = opened + np.arange(int(full.sum()))
        return (rows.append_column("sequence_id", pa.array(where + first)).append_column("offset", pa.array(offset)),
                first + opened + int(full.sum()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        following = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= group:
                out, following = pack(rows.slice(0, group), following)
                yield from out.combine_chunks().to_batches()
                rows = rows.slice(group)
            held = rows.to_batches()
        if sum(b.num_rows for b in held):
            yield from pack(pa.Table.from_batches(held), following)[0].combine_chunks().to_batches()
    return each


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         tokenizer_path: str | None = None, seed: int = SEED, group: int = GROUP,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, doc_tokens (with the end id), start, length,
    ids_crc32, sequence_id, offset; with ``with_ids`` also the ids as bytes.

    A text's ids come from the tokeniser file, then the id 0. Null text is
    empty: one piece that holds the id 0. Texts of any length are cut every
    ``length`` ids. Rows that repeat a doc_id are packed as documents of their
    own, and very many of them in many groups. An empty table gives no rows;
    other columns are dropped.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), text.alias("text"))
    schema = PIECES + ", ids binary" * with_ids
    out = schema.removeprefix("dealt long, ") + ", sequence_id long, offset long"
    path = tokenizer_path or public_path(TOKENIZER)
    return (rows.mapInArrow(tidy(_pieces(length, path, mergeable(path), seed, with_ids)), schema)
                .repartition("dealt").sortWithinPartitions("dealt", "doc_id", "start", "ids_crc32")
                .mapInArrow(tidy(_packed(length, group)), out))
