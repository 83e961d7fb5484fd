"""SimHash near-duplicates by a Gray-order hierarchical index.

1. A 64-bit fingerprint per document (majority of the bits of its shingles'
   hashes); documents with equal fingerprints become one class.
2. Classes are dealt to cells so that every pair with at most ``distance``
   differing bits meets in one: with the bits cut into ``distance + k``
   blocks, at least k blocks of such a pair are equal, so a class goes to one
   bucket for each choice of k blocks. k grows with the number of classes, so
   that buckets stay small. A bucket that is still large is cut into chunks,
   and each pair of chunks is a cell.
3. In a cell the fingerprints are sorted by Gray rank, which brings those with
   common bits together. Neighbouring ones form the leaves' parents, those the
   next level, and so on; every node keeps the bits that all below it share,
   less those its parent has. A search adds up the differences to these
   masked patterns from the root down and drops a whole group as soon as they
   exceed ``distance``.
4. A cell gives a spanning forest of its links, never all pairs; connected
   components join the forests.

All choices are exact: no pair of at most ``distance`` bits is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.common import components, saved, shuffle_partitions, tidy

SHINGLE = 4
SEED = 42
DISTANCE = 4
FANOUT = 8
CHUNK = 1024            # classes of one bucket that one task compares
BUCKET_TARGET = 2048    # expected classes in a bucket that decides the number of blocks
SLICE = 1 << 21         # candidate pairs held at a time


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of a text's word shingles, repeats included; A-Z are
    lower-cased. Fewer words than a shingle: the whole sequence; none: 0."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(line[a:b], seed) for a, b in zip(starts, stops)]), np.uint8)
    ones = np.zeros(64, np.int64)
    for at in range(0, 8 * n, 8 << 16):
        ones += np.unpackbits(hashes[at:at + (8 << 16)].reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(x.as_py() or b"", shingle, seed) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["th"], pa.array(np.array(got, np.uint64).view(np.int64))], ["doc_id", "th", "fp"])
    return each


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, th, fp): a hash of the text, and the fingerprint as the long with
    the same bits."""
    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_hash(text).alias("th"),
                        text.cast("binary").alias("text"))
                .mapInArrow(tidy(_fingerprints(shingle, seed)), "doc_id long, th long, fp long"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each value in the order of the reflected Gray code."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def block_masks(classes: int, distance: int) -> list[int]:
    """Masks of the bits that a bucket shares, one for each choice of blocks."""
    same = 1
    while same < distance and classes >> (64 * same // (distance + same)) > BUCKET_TARGET:
        same += 1
    edges = np.linspace(0, 64, distance + same + 1).round().astype(int)
    blocks = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(blocks, same)]


def _levels(fp: np.ndarray, cell: np.ndarray) -> list[dict]:
    """The index, leaves first: per node the bits it adds (mask, pattern), its
    first child and the place after its last leaf. The top has a node a cell."""
    change = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    place = np.arange(len(fp)) - np.repeat(change, np.diff(np.append(change, len(fp))))
    every, some, last = fp, fp, np.arange(1, len(fp) + 1)
    levels, tree = [{"every": every, "some": some, "last": last}], cell
    while True:
        starts = np.flatnonzero((place % FANOUT == 0) | np.concatenate(([True], tree[1:] != tree[:-1])))
        every = np.bitwise_and.reduceat(every, starts)
        some = np.bitwise_or.reduceat(some, starts)
        ends = np.append(starts[1:], len(last))
        last = last[ends - 1]
        levels.append({"every": every, "some": some, "last": last, "from": starts, "to": ends})
        tree, place = tree[starts], place[starts] // FANOUT
        if len(np.unique(tree)) == len(tree):
            break
    above = np.zeros(len(every), np.uint64)
    for level, up in zip(levels[::-1], [None, *levels[:0:-1]]):
        if up is not None:
            above = np.repeat(up["shared"], up["to"] - up["from"])
        level["shared"] = ~(level["every"] ^ level["some"])
        level["mask"] = level["shared"] & ~above
    return levels


def near_pairs(fp: np.ndarray, cell: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of one cell with at most ``distance`` differing
    bits, in slices. Rows are in order of cell, then Gray rank."""
    levels = _levels(fp, cell)
    roots = np.cumsum(np.concatenate(([0], cell[1:] != cell[:-1])))
    ends = levels[-1]["last"][roots]
    work = np.cumsum(ends - np.arange(len(fp)))
    at = 0
    while at < len(fp):
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + SLICE)))
        query = np.arange(at, to)
        node, apart = roots[at:to], np.zeros(to - at, np.uint8)
        for up, down in zip(levels[:0:-1], levels[-2::-1]):
            many = up["to"][node] - up["from"][node]
            first = np.repeat(up["from"][node] - (np.cumsum(many) - many), many)
            query, apart = np.repeat(query, many), np.repeat(apart, many)
            node = first + np.arange(len(first))
            later = down["last"][node] > query + 1          # only rows after the query
            query, apart, node = query[later], apart[later], node[later]
            apart = apart + np.bitwise_count((fp[query] ^ down["every"][node]) & down["mask"][node])
            close = apart <= distance
            query, apart, node = query[close], apart[close], node[close]
        yield query, node
        at = to


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest row that each of ``n`` rows is linked to by ``pairs``."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            a, b = root[a], root[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, nearer := root[root]):
                root = nearer
    return root


def whole_cells(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.Table]:
    """Rows sorted by ``cell``, regathered so that no cell is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        rows = pa.Table.from_batches(held)
        cell = rows["cell"].to_numpy()
        cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if (cell != cell[-1]).any() else 0
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _search(distance: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_cells(batches):
            fp = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
            cell = rows["cell"].to_numpy()
            order = np.lexsort((gray_rank(fp), cell))
            fp, cell = fp[order], cell[order]
            root = forest(len(fp), near_pairs(fp, cell, distance))
            linked = np.flatnonzero(root != np.arange(len(fp)))
            signed = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[linked]), pa.array(signed[root[linked]])], ["a", "b"])
    return each


def links(classes: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints of ``classes``
    (column fp) that differ in at most ``distance`` bits."""
    n = classes.count()
    masks = block_masks(n, distance)
    # A bucket is its mask's number and the shared bits, as one hash; a collision
    # of two only makes a cell larger.
    dealt = classes.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(masks)])).alias("bucket"))
    sizes = saved(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-buckets")
    rows = dealt.join(sizes, "bucket")
    chunks = F.ceil(F.col("n") / chunk)
    own = F.pmod(F.xxhash64("fp", F.lit(1)), chunks)
    cells = (rows.withColumn("chunks", chunks).withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
                 .select("fp", F.when(F.col("chunks") == 1, F.col("bucket")).otherwise(F.xxhash64(
                     "bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("cell")))
    parts = shuffle_partitions(classes.sparkSession)
    return (cells.repartition(parts, "cell").sortWithinPartitions("cell")
                 .mapInArrow(tidy(_search(distance)), "a long, b long"))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _members(fps: DataFrame, distance: int) -> DataFrame:
    """(fp, first, component): each different fingerprint with its smallest
    doc_id and its component's smallest fingerprint."""
    classes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    found = components(saved(links(classes, distance), "simhash-links")).withColumnRenamed("node", "fp")
    return saved(classes.join(found, "fp", "left")
                        .withColumn("component", F.coalesce("component", "fp")), "simhash-members")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, **options) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id
    reachable by links of at most ``distance`` bits, itself included).

    Null text counts as empty; texts without a word have fingerprint 0 and are
    linked like any other. Repeated rows get a row each. Documents whose id is
    null count as nothing in the minimum. An empty table gives no rows; other
    columns are dropped.
    """
    fps = saved(fingerprints(docs, **options), "simhash-fingerprints")
    member = _members(fps, distance)
    smallest = saved(member.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-smallest")
    by_class = saved(member.join(smallest, "component").select("fp", "component_id"), "simhash-components")
    return fps.join(by_class, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE, **options) -> DataFrame:
    """``docs`` (all columns) with one row of each group of near duplicates:
    the one with the smallest doc_id, then the smallest text hash; a null doc_id
    comes last.

    Rows are told apart by doc_id and text, so rows that share a doc_id, or
    have none, stay or go each by its own text; of rows that repeat both, one
    stays. Null text counts as empty; texts without a word are copies of each
    other. An empty table gives no rows.
    """
    fps = saved(fingerprints(docs, **options), "simhash-fingerprints")
    placed = saved(fps.join(_members(fps, distance).select("fp", "component"), "fp")
                      .select("doc_id", "th", "component"), "simhash-placed")
    first = placed.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    judged = saved(placed.join(first, "component").groupBy("doc_id", "th")
                         .agg(F.max(own).alias("stays"), F.count(F.lit(1)).alias("rows"))
                         .filter("not stays or rows > 1"), "simhash-judged")
    gone, repeated = (judged.filter(which).select(F.col("doc_id").alias("of_id"), F.col("th").alias("of_text"))
                      for which in ("not stays", "stays"))
    # The row travels as one value: its columns cannot clash with those here.
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    doc_id, th = F.col("row.doc_id").cast("long"), _text_hash(F.col("row.text").cast("string"))
    same = F.col("of_id").eqNullSafe(doc_id) & (F.col("of_text") == th)
    left = rows.join(gone, same, "left_anti")
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    if repeated.isEmpty():
        return left.select(*columns)
    one = left.join(repeated, same, "left_semi").groupBy(doc_id.alias("of_id"), th.alias("of_text")) \
        .agg(F.min("row").alias("row"))
    return left.join(repeated, same, "left_anti").select(*columns).unionByName(one.select(*columns))
