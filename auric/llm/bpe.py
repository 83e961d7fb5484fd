"""Byte-level BPE encoding and decoding by replaying the merges over the corpus.

The texts are cut into words by the vocabulary's pattern. Every different word
of the corpus goes to one bucket, once for each block of texts that holds it,
and a bucket replays the merges over all its words at once: an inverted index
leads from a pair of neighbouring tokens to the places where it stands, the
pairs are applied in the order of their ranks, and only the neighbours of a
merged place are indexed anew. The ids then return to the blocks.

The numbered texts are written once, bucketed by block, so that they are never
shuffled; only the different words of a block and their ids are.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm import chunks
from auric.llm.common import saved_by, shuffle_partitions

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
REPLAY_BYTES = 1 << 19      # bytes of words in one replay
REMEMBERED = 300_000        # pairs whose merge a process remembers
_LOADED: dict = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Ranks of a byte-level vocabulary, and the merges of pairs of tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.spelled = {b: a for a, b in self.ranks.items()}
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        self._merged: dict[int, int] = {}

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def merged(self, a: int, b: int) -> int:
        """The token that a pair merges to; -1 if there is none."""
        found = self._merged.get(a << 32 | b)
        if found is None:
            if len(self._merged) > REMEMBERED:
                self._merged.clear()
            found = self._merged[a << 32 | b] = self.ranks.get(self.spelled[a] + self.spelled[b], -1)
        return found

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, per_word) of different words. A word that is a token is that
        token, whatever its merges give."""
        known = [self.ranks.get(w, -1) for w in words]
        at, out, lengths = 0, [], np.ones(len(words), np.int64)
        rest = [i for i, k in enumerate(known) if k < 0]
        tokens: dict[int, np.ndarray] = {}
        while at < len(rest):
            stop, size = at, 0
            while stop < len(rest) and (stop == at or size + len(words[rest[stop]]) <= REPLAY_BYTES):
                size += len(words[rest[stop]])
                stop += 1
            ids, per_word = replay(self, [words[i] for i in rest[at:stop]])
            lengths[rest[at:stop]] = per_word
            out.append(ids)
            at = stop
        ends = np.cumsum(lengths)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        direct = np.array(known, np.int64) >= 0
        starts = ends - lengths
        flat[starts[direct]] = np.array(known, np.int64)[direct]
        if out:
            flat[chunks.ranges(starts[~direct], lengths[~direct])] = np.concatenate(out)
        return flat, lengths


def replay(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, per_word) of non-empty words after all merges.

    Within a word the lowest rank goes first and the leftmost place of equal
    ranks. A merge that brings a lower rank beside it in the same word holds
    the word's later places of this rank back until that one is done.
    """
    data = b"".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    token = list(map(vocabulary.of_byte.__getitem__, data))
    n = len(token)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    for end in ends.tolist():
        right[end - 1] = -1
        if end < n:
            left[end] = -1
    word_ends = ends.tolist()
    index = _first_pairs(vocabulary, data, ends)
    order = list(index)
    heapify(order)
    merged = vocabulary.merged
    while order:
        rank = heappop(order)
        held_to = -1
        for i in sorted(index.pop(rank)):
            if i < held_to:
                index.setdefault(rank, []).append(i)
                continue
            j = right[i]
            if token[i] < 0 or j < 0 or merged(token[i], token[j]) != rank:
                continue                    # a neighbour has changed since
            token[i], token[j] = rank, -1
            after, before = right[j], left[i]
            right[i] = after
            lower = False
            if after >= 0:
                left[after] = i
                new = merged(rank, token[after])
                if new >= 0:
                    if new not in index:
                        index[new] = []
                        heappush(order, new)
                    index[new].append(i)
                    lower = new < rank
            if before >= 0:
                new = merged(token[before], rank)
                if new >= 0:
                    if new not in index:
                        index[new] = []
                        heappush(order, new)
                    index[new].append(before)
                    lower |= new < rank
            if lower:
                held_to = word_ends[bisect.bisect_right(word_ends, i)]
        if rank in index:
            heappush(order, rank)
    ids = np.array(token, np.int64)
    alive = ids >= 0
    return ids[alive], np.add.reduceat(alive.astype(np.int64), ends - lengths)


def _first_pairs(vocabulary: Vocabulary, data: bytes, ends: np.ndarray) -> dict[int, list[int]]:
    """The index of the words' bytes: token of a pair to its places."""
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    pair = raw[:-1] * 256 + raw[1:]
    within = np.ones(len(pair), bool)
    within[ends[:-1] - 1] = False
    places = np.flatnonzero(within)
    kinds, kind = np.unique(pair[places], return_inverse=True)
    of = vocabulary.of_byte
    ranks = np.array([vocabulary.merged(of[k >> 8], of[k & 255]) for k in kinds.tolist()], np.int64)[kind] \
        if len(kinds) else kind
    places, ranks = places[ranks >= 0], ranks[ranks >= 0]
    by_rank = np.argsort(ranks, kind="stable")
    found, starts = np.unique(ranks[by_rank], return_index=True)
    groups = np.split(places[by_rank], starts[1:])
    return {r: g.tolist() for r, g in zip(found.tolist(), groups)}


# One row is a slice of a block's numbered texts (ids, counts, numbers) or the
# block's words of one bucket (numbers, counts, words).
NUMBERED = ("block long, bucket int, slice int, ids array<long>, counts binary, numbers binary, "
            "words binary")


def _numbered(pattern: str, buckets: int):
    """mapInArrow function: (doc_id, text) to rows of ``NUMBERED``."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from pyspark import TaskContext

        find = regex.compile(pattern).findall
        first = TaskContext.get().partitionId() << 32
        for n, table in enumerate(chunks.blocks(batches)):
            texts = table["text"].combine_chunks()
            different, at, per_text = chunks.numbered(texts, lead=False)
            of_word: dict[str, int] = {}
            cut = [[of_word.setdefault(w, len(of_word)) for w in find(c)] for c in different]
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            flat = np.fromiter((w for c in cut for w in c), np.int64, int(lengths.sum()))
            starts = np.cumsum(lengths) - lengths
            numbers = flat[chunks.ranges(starts[at], lengths[at])]
            often = np.argsort(-np.bincount(numbers, minlength=len(of_word)), kind="stable")
            new = np.empty(len(often), np.int64)
            new[often] = np.arange(len(often))
            numbers = new[numbers]
            per_chunk = np.concatenate(([0], np.cumsum(lengths[at])))
            counts = np.diff(per_chunk[np.concatenate(([0], np.cumsum(per_text)))])
            words = [w.encode() for w in of_word]
            words = [words[i] for i in often.tolist()]
            yield _rows(first + n, table["doc_id"], counts, numbers, words, buckets)
    return number


def _rows(block: int, doc_ids, counts, numbers, words: list[bytes], buckets: int) -> pa.RecordBatch:
    rows = []
    ends = np.concatenate(([0], np.cumsum(counts)))
    for k, (a, b) in enumerate(chunks.row_slices(counts * 8)):
        rows.append((block, -1, k, doc_ids[a:b].to_pylist(), chunks.packed(counts[a:b]),
                     chunks.packed(numbers[ends[a]:ends[b]]), None))
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    by_bucket = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[by_bucket], return_index=True)
    for b, own in zip(found.tolist(), np.split(by_bucket, starts[1:])):
        held = [words[i] for i in own.tolist()]
        rows.append((block, b, None, None, chunks.packed(np.fromiter(map(len, held), np.int64, len(held))),
                     chunks.packed(np.diff(own, prepend=0)), chunks.squeezed(b"".join(held))))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
    names = [f.split()[0] for f in NUMBERED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _encode_bucket(path: str):
    """applyInArrow function over a bucket: its words' ids, for each block."""
    def encode(rows: pa.Table) -> pa.Table:
        vocabulary = Vocabulary.load(path)
        place: dict[bytes, int] = {}
        held = []
        for counts, words in zip(rows["counts"], rows["words"]):
            own = chunks.strings(chunks.unsqueezed(words.as_py()), chunks.unpacked(counts.as_py()))
            held.append(np.fromiter((place.setdefault(w, len(place)) for w in own), np.int64, len(own)))
        flat, lengths = vocabulary.encode_words(list(place))
        starts = np.cumsum(lengths) - lengths
        counts = [chunks.packed(lengths[own]) for own in held]
        ids = [chunks.packed(flat[chunks.ranges(starts[own], lengths[own])]) for own in held]
        return pa.table({"block": rows["block"], "numbers": rows["numbers"],
                         "counts": pa.array(counts, pa.binary()), "words": pa.array(ids, pa.binary())})
    return encode


def _assembled(path: str, spell: bool):
    """cogroup function over a block: the ids of each of its texts."""
    def assemble(texts: pa.Table, answers: pa.Table) -> pa.Table:
        numbers = [np.cumsum(chunks.unpacked(x.as_py())) for x in answers["numbers"]]
        none = np.zeros(0, np.int64)
        where = np.concatenate([none, *numbers])
        counts = np.concatenate([none, *(chunks.unpacked(x.as_py()) for x in answers["counts"])])
        flat = np.concatenate([none, *(chunks.unpacked(x.as_py()) for x in answers["words"])]).astype("<u4")
        lengths, starts = np.empty(len(where), np.int64), np.empty(len(where), np.int64)
        lengths[where], starts[where] = counts, np.cumsum(counts) - counts
        out = []
        for ids, per_text, occurring in zip(texts["ids"], texts["counts"], texts["numbers"]):
            words = chunks.unpacked(occurring.as_py())
            tokens = flat[chunks.ranges(starts[words], lengths[words])].tobytes()
            ends = np.concatenate(([0], np.cumsum(lengths[words])))[
                np.concatenate(([0], np.cumsum(chunks.unpacked(per_text.as_py()))))].tolist()
            found = [tokens[4 * a:4 * b] for a, b in zip(ends, ends[1:])]
            columns = [ids.values.cast(pa.int64()), pa.array(found, pa.binary())]
            if spell:
                columns.append(pa.array(_spelled(path, found), pa.binary()))
            out.append(pa.table(columns, ["doc_id", "ids", "decoded"][:len(columns)]))
        return pa.concat_tables(out)
    return assemble


def _spelled(path: str, all_ids: list[bytes | None]) -> list[bytes]:
    """The bytes of each text's ids."""
    spelled = Vocabulary.load(path).spelled
    return [b"".join(map(spelled.__getitem__, np.frombuffer(ids or b"", "<u4").tolist())) for ids in all_ids]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): a row for each document, its ids as little-endian unsigned
    32-bit bytes. With ``decoded`` the task that has the ids decodes them as
    ``decode`` does.

    Null and empty texts have no ids. Rows that repeat a doc_id, also a null
    one, are documents of their own; equal rows give equal rows. An empty table
    gives no rows; other columns are dropped. Texts of any length are taken
    whole; one text is the least that a task holds.
    """
    import public_tokenizers

    spark, path = docs.sparkSession, path or tokenizer_path(TOKENIZER)
    buckets = shuffle_partitions(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = saved_by(source.mapInArrow(_numbered(pattern or public_tokenizers.PATTERN, buckets), NUMBERED),
                    "bpe", "block", buckets)
    answers = (rows.filter("bucket >= 0").select("block", "bucket", "numbers", "counts", "words")
                   .groupBy("bucket").applyInArrow(_encode_bucket(path),
                                                   "block long, numbers binary, counts binary, words binary"))
    texts = rows.filter("bucket < 0").select("block", "ids", "counts", "numbers")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _assembled(path, decoded), "doc_id long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that its ids spell. Null ids
    spell nothing. A column named ``decoded`` is replaced."""
    path = path or tokenizer_path(TOKENIZER)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "decoded"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(_spelled(path, batch[ids_col].to_pylist()), pa.binary())],
                [*kept, "decoded"])
    plain = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(spell, schema + ", decoded binary")
