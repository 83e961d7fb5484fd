"""Cross-tokeniser alignment: which tokens of two tokenisers overlap.

Two passes over the documents. The first aligns them and gathers, for each
block of texts, its different linked pairs of ids and in how many of the
block's documents each is linked. The different pairs of the corpus are dealt
to buckets by their first id, so a bucket is bounded by the vocabularies, and
hashed there onto 0 .. n - 1 by a minimal perfect hash. Each part of the blocks
adds its counts into a dense vector that the hash indexes, and the vectors are
summed in a tree. The second pass aligns the documents again and looks the
counts of its pairs up; a looked-up pair is compared with the key stored at its
index.

Alignment is done once for each different chunk of a block: chunks end where
both tokenisers have a token end. Documents of a block are written once as
chunk numbers beside the chunks' tokens, bucketed by block, and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm import chunks
from auric.llm.bpe import tokenizer_path
from auric.llm.bytebpe import ByteBpe, _joined, mergeable
from auric.llm.common import saved, saved_by, shuffle_partitions
from auric.llm.mphf import MinimalHash

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20     # text of a block
BUCKETS = 512               # a bucket has at most the pairs of a 512th of the first ids
SALTS = 16                  # parts of the blocks, each with a vector of its own
FAN_IN = 4
BATCH = 50_000              # chunks tokenised in one call
_LOADED: dict = {}


class Pair:
    """Two tokenisers and the bytes of their tokens. ``fast``: see ``ByteBpe``."""

    def __init__(self, first: str, second: str, fast: bool):
        import sentencepiece

        self.a = ByteBpe.load(first, fast, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        # Without a piece that goes on after a space, no merge crosses one.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_bytes, self.b_bytes = _flat(self.a.spelled), _flat(b_bytes)
        self.a_names = pa.array(map(str, range(len(self.a.spelled))), pa.large_string())
        self.b_names = pa.array(map(str, range(len(b_bytes))), pa.large_string())

    @classmethod
    def load(cls, first: str, second: str, fast: bool) -> "Pair":
        if (first, second) not in _LOADED:
            _LOADED[first, second] = cls(first, second, fast)
        return _LOADED[first, second]

    def numbered(self, texts: pa.Array):
        return chunks.numbered(texts, lead=True) if self.cuts else chunks.whole(texts)

    def tokens(self, found: list[str]) -> tuple:
        """(a_ids, a_counts, b_ids, b_counts) of chunks, which begin with a space."""
        b = []
        for i in range(0, len(found), BATCH):
            b += self.b.encode([c[1:] for c in found[i:i + BATCH]], num_threads=1)
        return self.a(found) + _joined(b)


def _flat(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(lengths) - lengths, lengths


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values, empty runs included."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.concatenate(([0], np.cumsum(counts)))
    return total[ends[1:]] - total[ends[:-1]]


def _spells(ids, counts, spelled, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes of each chunk's tokens are the chunk's own."""
    blob, starts, lengths = spelled
    same = _sums(lengths[ids], counts) == sizes
    kept = ids[np.repeat(same, counts)]
    text = text[np.repeat(same, sizes)]
    wrong = blob[chunks.ranges(starts[kept], lengths[kept])] != text
    same[same] = _sums(wrong, sizes[same]) == 0
    return same


class Aligned:
    """The chunks of a block, both ways of tokens, and their links.

    ``ok`` chunks are spelled by both; only they have tokens here. ``link_a``
    and ``link_b`` are the ids of the overlapping pairs in order, ``links`` how
    many each chunk has; ``cut`` marks the last link of each group.
    """

    def __init__(self, pair: Pair, sizes: np.ndarray, ok: np.ndarray, a, n_a, b, n_b):
        self.sizes, self.ok, self.a, self.n_a, self.b, self.n_b = sizes, ok, a, n_a, b, n_b
        self.a_ends, self.b_ends = np.cumsum(pair.a_bytes[2][a]), np.cumsum(pair.b_bytes[2][b])
        ends = np.union1d(self.a_ends, self.b_ends)
        at_a, at_b = np.searchsorted(self.a_ends, ends), np.searchsorted(self.b_ends, ends)
        self.link_a, self.link_b = a[at_a], b[at_b]
        self.cut = (self.a_ends[at_a] == ends) & (self.b_ends[at_b] == ends) if len(ends) else np.zeros(0, bool)
        stops = np.cumsum(np.where(ok, sizes, 0))
        self.links = np.diff(np.searchsorted(ends, stops, side="right"), prepend=0)
        self.groups = _sums(self.cut, self.links)
        self.keys = (self.link_a << 32) | self.link_b
        self._group_ends = ends[self.cut]

    @classmethod
    def of(cls, pair: Pair, found: list[str]) -> "Aligned":
        encoded = [c.encode() for c in found]
        text = np.frombuffer(b"".join(encoded), np.uint8)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        a, n_a, b, n_b = pair.tokens(found)
        ok = _spells(a, n_a, pair.a_bytes, text, sizes) & _spells(b, n_b, pair.b_bytes, text, sizes)
        return cls(pair, sizes, ok, a[np.repeat(ok, n_a)], np.where(ok, n_a, 0), b[np.repeat(ok, n_b)], np.where(ok, n_b, 0))

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return (chunks.packed(self.sizes * 2 + self.ok), chunks.packed(np.concatenate((self.n_a, self.a))),
                chunks.packed(np.concatenate((self.n_b, self.b))))

    @classmethod
    def unpacked(cls, pair: Pair, sizes: bytes, a: bytes, b: bytes) -> "Aligned":
        sizes, a, b = map(chunks.unpacked, (sizes, a, b))
        n = len(sizes)
        return cls(pair, sizes >> 1, sizes & 1 > 0, a[n:], a[:n], b[n:], b[:n])

    def spelled_groups(self, pair: Pair) -> pa.Array:
        """``a1,a2|b1;a3|b2`` of each chunk."""
        def side(names, ids, token_ends):
            stops = np.searchsorted(token_ends, self._group_ends, side="right")
            return pc.binary_join(_lists(stops, names.take(pa.array(ids))), pa.scalar(",", pa.large_string()))
        groups = pc.binary_join_element_wise(
            side(pair.a_names, self.a, self.a_ends), side(pair.b_names, self.b, self.b_ends),
            pa.scalar("|", pa.large_string()))
        return pc.binary_join(_lists(np.cumsum(self.groups), groups), pa.scalar(";", pa.large_string()))


def _lists(stops: np.ndarray, values: pa.Array) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], stops)), pa.int64()), values)


def _whole(ok: np.ndarray, numbers: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Texts that have chunks, all of them spelled by both tokenisers."""
    return (per_text > 0) & (_sums(~ok[numbers], per_text) == 0)


# One row is a slice of a block's documents as chunk numbers (ids, counts,
# numbers), the block's chunks (counts: sizes, numbers and words: tokens both
# ways), or its linked pairs of one bucket (numbers: first ids, words: second
# ids, counts: documents).
NUMBERED = "block long, bucket int, slice int, ids array<long>, counts binary, numbers binary, words binary"
DOCS, CHUNKS = -1, -2


def _first_pass(paths: tuple[str, str, bool]):
    """mapInArrow function: (doc_id, text) to rows of ``NUMBERED``."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = Pair.load(*paths)
        first = TaskContext.get().partitionId() << 32
        for n, table in enumerate(chunks.blocks(batches, limit=BLOCK_BYTES)):
            texts = table["text"].combine_chunks()
            found, numbers, per_text = pair.numbered(texts)
            block = Aligned.of(pair, found)
            whole = _whole(block.ok, numbers, per_text)
            kinds, kind = np.unique(block.keys, return_inverse=True)
            starts = np.cumsum(block.links) - block.links
            ends = np.concatenate(([0], np.cumsum(per_text)))
            documents = np.zeros(len(kinds), np.int64)
            rows = []
            for k, (a, b) in enumerate(chunks.row_slices(per_text * 8)):
                at = numbers[ends[a]:ends[b]]
                rows.append((first + n, DOCS, k, table["doc_id"][a:b].to_pylist(),
                             chunks.packed(per_text[a:b]), chunks.packed(at), None))
                of_doc = np.repeat(np.arange(b - a), per_text[a:b])[np.repeat(whole[a:b], per_text[a:b])]
                at = at[np.repeat(whole[a:b], per_text[a:b])]
                once = np.unique(of_doc * max(1, len(found)) + at)
                of_doc, at = once // max(1, len(found)), once % max(1, len(found))
                linked = kind[chunks.ranges(starts[at], block.links[at])]
                once = np.unique(np.repeat(of_doc, block.links[at]) * max(1, len(kinds)) + linked)
                documents += np.bincount(once % max(1, len(kinds)), minlength=len(kinds))
            rows.append((first + n, CHUNKS, None, None, *block.packed()))
            linked = documents > 0
            kinds, documents = kinds[linked], documents[linked]
            bucket = (kinds >> 32) % BUCKETS
            by_bucket = np.argsort(bucket, kind="stable")
            own, cuts = np.unique(bucket[by_bucket], return_index=True)
            for b, held in zip(own.tolist(), np.split(by_bucket, cuts[1:])):
                rows.append((first + n, b, None, None, chunks.packed(documents[held]),
                             chunks.packed(kinds[held] >> 32), chunks.packed(kinds[held] & 0xFFFFFFFF)))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            names = [f.split()[0] for f in NUMBERED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return align


def _row_keys(numbers, words) -> np.ndarray:
    return (chunks.unpacked(numbers) << 32) | chunks.unpacked(words)


def _different(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pairs of a bucket's part."""
    keys, new, size = np.zeros(0, np.int64), [], 0
    for batch in batches:
        for numbers, words in zip(batch["numbers"], batch["words"]):
            new.append(_row_keys(numbers.as_py(), words.as_py()))
            size += len(new[-1])
            if size > max(1 << 18, len(keys)):
                keys, new, size = np.unique(np.concatenate([keys, *new])), [], 0
    keys = np.unique(np.concatenate([keys, *new]))
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([keys.tobytes()], pa.binary())],
                                     ["bucket", "keys"])


def _hashed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The minimal perfect hash of a bucket's pairs, and the pairs by index."""
    keys = np.zeros(0, np.int64)
    for batch in batches:
        for part in batch["keys"]:
            keys = np.union1d(keys, np.frombuffer(part.as_py(), np.int64))
    hashed = MinimalHash.build(keys)
    by_index = np.empty(len(keys), np.int64)
    by_index[hashed(keys)] = keys
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([hashed.to_bytes()], pa.binary()),
         pa.array([by_index.tobytes()], pa.binary())], ["bucket", "mph", "keys"])


def _index(hashed: MinimalHash, by_index: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = hashed(keys)
    if (at < 0).any() or (by_index[at] != keys).any():
        raise ValueError("a pair is not in its bucket's hash")
    return at


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, part and kind: the bucket's hash, then counts of
    blocks, which are added into one dense vector for each (bucket, part)."""
    def row(at, vector):
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([vector.tobytes()], pa.binary())],
            ["bucket", "salt", "vector"])
    current = vector = hashed = by_index = None
    for batch in batches:
        for r in batch.to_pylist():
            if (r["bucket"], r["salt"]) != current:
                if current is not None:
                    yield row(current, vector)
                current = r["bucket"], r["salt"]
            if r["mph"] is not None:
                hashed, by_index = MinimalHash.from_bytes(r["mph"]), np.frombuffer(r["keys"], np.int64)
                vector = np.zeros(hashed.size, np.int64)
            else:
                vector[_index(hashed, by_index, _row_keys(r["numbers"], r["words"]))] += chunks.unpacked(r["counts"])
    if current is not None:
        yield row(current, vector)


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch["vector"]:
            vector = np.frombuffer(part.as_py(), np.int64)
            total = vector if total is None else total + vector
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
         pa.array([total.tobytes()], pa.binary())], ["bucket", "salt", "vector"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, part and kind: the bucket's counts, then pairs of
    blocks; for each block its pairs' counts and whether they are the highest
    of their first id."""
    hashed = by_index = counts = best = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["mph"] is not None:
                hashed, by_index = MinimalHash.from_bytes(r["mph"]), np.frombuffer(r["keys"], np.int64)
                counts = np.frombuffer(r["counts"], np.int64)
                _, first = np.unique(by_index >> 32, return_inverse=True)
                highest = np.zeros(len(by_index), np.int64)
                np.maximum.at(highest, first, counts)
                best = counts == highest[first]
            else:
                at = _index(hashed, by_index, _row_keys(r["numbers"], r["words"]))
                out.append((r["block"], r["numbers"], r["words"], chunks.packed(counts[at]),
                            np.packbits(best[at]).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.binary()] * 4))],
                ["block", "numbers", "words", "counts", "best"])


OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups string")


def _second_pass(paths: tuple[str, str, bool]):
    """cogroup function over a block: its documents and the answers to it."""
    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        pair = Pair.load(*paths)
        own = rows.filter(pc.equal(rows["bucket"], CHUNKS))
        block = Aligned.unpacked(pair, *(own[c][0].as_py() for c in ("counts", "numbers", "words")))
        keys, counts, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for numbers, words, n, marks in zip(*(answers[c] for c in ("numbers", "words", "counts", "best"))):
            keys.append(_row_keys(numbers.as_py(), words.as_py()))
            counts.append(chunks.unpacked(n.as_py()))
            best.append(np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), count=len(keys[-1])).astype(bool))
        keys, counts, best = map(np.concatenate, (keys, counts, best))
        order = np.argsort(keys)
        keys, counts, best = keys[order], counts[order], best[order]
        # Pairs that only chunks of documents without tokens hold have no answer.
        at = np.minimum(np.searchsorted(keys, block.keys), max(0, len(keys) - 1))
        known = keys[at] == block.keys if len(keys) else np.zeros(len(block.keys), bool)
        link_count = np.zeros(len(known), np.int64)
        link_best = np.zeros(len(known), bool)
        link_count[known], link_best[known] = counts[at[known]], best[at[known]]
        per_chunk = (block.n_a, block.n_b, block.groups, block.links, _sums(link_best, block.links),
                     _sums(link_count, block.links))
        spelled = block.spelled_groups(pair)
        out = []
        docs = rows.filter(pc.equal(rows["bucket"], DOCS))
        for ids, per_text, numbers in zip(docs["ids"], docs["counts"], docs["numbers"]):
            per_text, numbers = chunks.unpacked(per_text.as_py()), chunks.unpacked(numbers.as_py())
            whole = _whole(block.ok, numbers, per_text)
            numbers = numbers[np.repeat(whole, per_text)]
            per_text = np.where(whole, per_text, 0)
            groups = pc.binary_join(_lists(np.cumsum(per_text), spelled.take(pa.array(numbers))),
                                    pa.scalar(";", pa.large_string()))
            out.append(pa.table([ids.values.cast(pa.int64()),
                                 *(pa.array(_sums(values[numbers], per_text)) for values in per_chunk),
                                 groups.cast(pa.string())], [f.split()[0] for f in OUT.split(", ")]))
        return pa.concat_tables(out)
    return finish


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str | None = None,
          second: str | None = None) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups (``a1,a2|b1;a3|b2``, ids of both tokenisers in order).

    A link is a pair of overlapping tokens; a pair's count is the number of
    documents of the table that hold it linked, and n_best counts the links
    whose count is the highest of their first id. A text that is null or empty,
    or that either tokeniser does not spell byte by byte, has no tokens: zeros
    and empty groups. Rows that repeat a doc_id, also a null one, are documents
    of their own and count as such. An empty table gives no rows; other columns
    are dropped. Texts are taken whole.
    """
    spark = docs.sparkSession
    paths = first or tokenizer_path(FIRST), second or tokenizer_path(SECOND)
    paths = *paths, mergeable(paths[0])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = saved_by(source.mapInArrow(_first_pass(paths), NUMBERED), "align", "block", shuffle_partitions(spark))
    counted = rows.filter("bucket >= 0").select(
        "bucket", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"), "block", "numbers", "words",
        "counts", F.lit(None).cast("binary").alias("mph"), F.lit(None).cast("binary").alias("keys"))
    hashes = saved(counted.groupBy("bucket", "salt").applyInArrow(_different, "bucket int, keys binary")
                          .groupBy("bucket").applyInArrow(_hashed, "bucket int, mph binary, keys binary"), "align-hash")
    vectors = _by_part(hashes.withColumn("counts", F.lit(None).cast("binary")), counted) \
        .mapInArrow(_vectors, "bucket int, salt int, vector binary")
    parts = SALTS
    while parts > 1:
        parts = -(-parts // FAN_IN)
        vectors = vectors.withColumn("salt", F.floor(F.col("salt") / FAN_IN).cast("int")) \
            .groupBy("bucket", "salt").applyInArrow(_summed, "bucket int, salt int, vector binary")
    counts = saved(hashes.join(vectors.select("bucket", F.col("vector").alias("counts")), "bucket"), "align-counts")
    answers = _by_part(counts, counted).mapInArrow(
        _answers, "block long, numbers binary, words binary, counts binary, best binary")
    mine = rows.filter("bucket < 0").select("block", "bucket", "ids", "counts", "numbers", "words")
    return mine.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_second_pass(paths), OUT)


def _by_part(hashes: DataFrame, counted: DataFrame) -> DataFrame:
    """Blocks' rows after their bucket's hash, in each part of the blocks."""
    columns = ["bucket", "salt", "block", "numbers", "words", "counts", "mph", "keys"]
    copies = hashes.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(-1).cast("long").alias("block"),
        F.lit(None).cast("binary").alias("numbers"), F.lit(None).cast("binary").alias("words"), "counts", "mph", "keys")
    # The hash comes first: its block is -1, and partition numbers start at 0.
    return copies.select(columns).unionByName(counted.select(columns)) \
        .repartition(shuffle_partitions(counted.sparkSession), "bucket", "salt") \
        .sortWithinPartitions("bucket", "salt", "block")
