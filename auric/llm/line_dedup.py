"""Line dedup by an exact set-similarity join.

A line is the set of its words. A line is removed if an earlier line (by
doc_id, then place in the text) has a Jaccard similarity of at least 4/5 with
it; the earliest of each group of like lines stays.

1. Words are counted in a table of fixed size (hashed slots); a word's rarity
   is its slot's count. Any order of words gives right results, rare ones
   first give short lists, so colliding slots cost time at most.
2. Equal sets become one, at their earliest line.
3. Each set posts its prefix: its rarest words, so many that two like sets
   must share one. In a word's list, the length filter bounds the sizes, the
   positional filter the overlap still possible, and a 128-bit parity sketch
   the difference. A later set is paired with its earliest candidate only.
4. Pairs are verified on the full word sets. A set whose earliest candidate
   fails, and which has more, is paired with all of them in a second round.

Very long lists are cut into chunks, and each pair of chunks is compared on
its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.chunks import packed, unpacked
from auric.llm.common import saved, shuffle_partitions, tidy
from auric.llm.wordhash import mix, slices, words

NUM, DEN = 4, 5             # Jaccard threshold
SLOTS = 1 << 18             # fixed size of the tables of counts
FILTER_BITS = 1 << 23       # fixed size of the table that picks lines to verify
CHUNK = 8192                # rows of one list that one task compares
SLICE = 1 << 18             # pairs held at a time
PART = 100_000              # rows of lists that one task holds, on average
NO_ID = -(1 << 63)          # stands for a null doc_id, first in order
WHOLE = -1                  # stands for the place of a whole text
KEY = ["doc", "th", "at"]   # of a line: doc_id, hash of the text, place in the text


class Lines:
    """Word sets of the lines of some texts, flat: ``hashes`` of the distinct
    words, by set; within a set by ``level`` (rarity) and hash. For each set its
    row, its place in the text, its size and its first word."""

    def __init__(self, texts: pa.Array, levels: np.ndarray | None = None, use=None):
        row, line, h = words(texts)
        if use is not None and len(h):                  # only some lines
            keep = use(row, line)
            row, line, h = row[keep], line[keep], h[keep]
        of = np.cumsum(np.concatenate(([0], (row[1:] != row[:-1]) | (line[1:] != line[:-1])))) if len(h) else row
        level = levels[_slot(h)].astype(np.uint64) if levels is not None else np.zeros(len(h), np.uint64)
        if len(h) and of[-1] < 1 << 20:
            # one sort by set, level and the hash's upper bits; equal words are neighbours
            order = np.argsort((of.astype(np.uint64) << np.uint64(44)) | (level << np.uint64(36)) | (h >> np.uint64(28)),
                               kind="stable")
            h, tied = h[order], order
            if (((h[1:] >> np.uint64(28)) == (h[:-1] >> np.uint64(28))) & (h[1:] != h[:-1]) & (of[order][1:] == of[order][:-1])).any():
                tied = np.lexsort((h[np.argsort(order)], level, of))    # upper bits met by different words
                h = h[np.argsort(order)][tied]
            of, row, line = of[tied], row[tied], line[tied]
        else:
            order = np.lexsort((h, level, of))
            h, of, row, line = h[order], of[order], row[order], line[order]
        new = np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool)
        self.hashes, self.line = h[new], of[new]
        row, line = row[new], line[new]
        self.start = np.flatnonzero(np.concatenate(([True], self.line[1:] != self.line[:-1]))) if len(h) else self.line
        self.size = np.diff(np.append(self.start, len(self.hashes)))
        self.row, self.place = row[self.start], line[self.start]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) & np.uint64(SLOTS - 1)).astype(np.int64)


def _log_counts(rows: DataFrame) -> np.ndarray:
    """Table of counts by slot from each task's table (task, counts), as
    rounded-up logarithms. Its size is fixed (SLOTS bytes), whatever the corpus;
    the tasks' tables are summed in a tree."""
    for width in (64, 1):
        rows = rows.withColumn("task", F.col("task") % width).groupBy("task").applyInArrow(_added, COUNTS)
    got = rows.toArrow()["counts"].to_pylist()
    counts = unpacked(got[0]) if got else np.zeros(SLOTS, np.int64)
    return np.minimum(255, np.ceil(6 * np.log2(1 + counts.astype(float)))).astype(np.uint8)


COUNTS = "task int, counts binary"


def _counts_of(task: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([packed(counts)], pa.binary())],
                                      ["task", "counts"])


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for counts in batch["counts"]:
            total += unpacked(counts.as_py())
    yield _counts_of(key[0].as_py(), total)


def _most(level: np.ndarray) -> np.ndarray:
    """Upper bound of the count behind a logarithm."""
    return np.ceil(2.0 ** (level / 6.0)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    count = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for part in slices(batch):
            count += np.bincount(_slot(words(part["text"])[2]), minlength=SLOTS)
    yield _counts_of(TaskContext.get().partitionId(), count)


def _prefix_length(size: np.ndarray) -> np.ndarray:
    """Two sets at the threshold share a word among their first so many."""
    return size + (-size * NUM // DEN) + 1


def _places(part: pa.RecordBatch, row: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, th, at) of lines of a batch."""
    return part["doc"].to_numpy()[row], part["th"].to_numpy()[row], line


def _sets(rarity: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = Lines(part["text"], rarity)
                if not len(x.size):
                    continue
                take = np.arange(len(x.hashes)) - np.repeat(x.start, x.size) < np.repeat(_prefix_length(x.size), x.size)
                keys = np.add.reduceat(x.hashes, x.start)
                bit = np.uint64(1) << (x.hashes & np.uint64(63))
                half = x.hashes & np.uint64(64) > 0         # with it, one of 128 bits
                sketch, sketch2 = (np.bitwise_xor.reduceat(np.where(half == which, bit, np.uint64(0)), x.start)
                                   for which in (False, True))
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(_prefix_length(x.size))).astype(np.int32)),
                    pa.array((x.hashes[take] >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(sketch.view(np.int64)), pa.array(sketch2.view(np.int64)),
                     *map(pa.array, _places(part, x.row, x.place)), pa.array(x.size), prefix], SET_COLUMNS)
    return each


SET_COLUMNS = ["key", "sketch", "sketch2", *KEY, "size", "prefix"]
SETS = ", ".join(f"{c} long" for c in SET_COLUMNS[:-1]) + ", prefix array<int>"


def _count_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    count = np.zeros(SLOTS, np.int64)
    for batch in batches:
        prefix = batch["prefix"].flatten().to_numpy().view(np.uint32).astype(np.uint64)
        count += np.bincount(_slot(prefix), minlength=SLOTS)
    yield _counts_of(TaskContext.get().partitionId(), count)


def _planes(column: np.ndarray) -> bytes:
    """A column of 64-bit values by byte: the bytes that are mostly zero lie
    together and all but vanish when a shuffle compresses them."""
    return column.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _column(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).reshape(-1)


POSTINGS = ("cell", *KEY, "size", "pos", "sketch", "sketch2", "probe")


def _postings(lists: np.ndarray, chunk: int, parts: int, wanted: np.ndarray | None):
    """Sets to rows of lists: a row for each prefix word, or for each pair of
    chunks that it takes part in where the list may be long. Rows travel in
    columns, one block for each part that lists are dealt to. ``wanted``: only
    words in this table."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = np.diff(batch["prefix"].offsets.to_numpy())
            prefix = batch["prefix"].flatten().to_numpy().view(np.uint32).astype(np.uint64)
            row = np.repeat(np.arange(batch.num_rows), many)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            if wanted is not None:
                use = _in_table(wanted, _word_bit(prefix))
                prefix, row, pos = prefix[use], row[use], pos[use]
            chunks = np.maximum(1, -(-_most(lists[_slot(prefix)]) // chunk))
            own = (mix(batch["key"].to_numpy().view(np.uint64))[row] % chunks.astype(np.uint64)).astype(np.int64)
            again = np.repeat(np.arange(len(row)), chunks)
            other = np.arange(len(again)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
            row, pos, own, prefix = row[again], pos[again], own[again], prefix[again]
            pair = (np.minimum(own, other) << 32) | np.maximum(own, other)
            cell = np.where(chunks[again] == 1, prefix.astype(np.int64),
                            mix(prefix ^ mix(pair.astype(np.uint64) + np.uint64(1))).view(np.int64))
            part = (mix(cell.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            part, row = part[order], row[order]
            columns = [cell[order], *(batch[c].to_numpy()[row] for c in (*KEY, "size")), pos[order],
                       *(batch[c].to_numpy()[row] for c in ("sketch", "sketch2")), batch["probe"].to_numpy(zero_copy_only=False)[row]]
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else part
            ends = np.append(starts[1:], len(part)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts]), *[pa.array([_planes(c[a:b]) for a, b in zip(starts, ends)], pa.binary())
                                           for c in columns]], ["part", *POSTINGS])
    return each


KEY2 = [f"{c}2" for c in KEY]
PAIRS = ", ".join(f"{c} long" for c in [*KEY, *KEY2]) + ", more boolean"


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The blocks of each part put together, without the rows that are alone in
    their cell; blocks are sorted by part."""
    held: list[dict] = []
    now = None
    for batch in batches:
        for i, part in enumerate(batch["part"].to_pylist()):
            if held and part != now:
                yield _met(held)
                held = []
            now = part
            held.append({c: batch[c][i].as_py() for c in POSTINGS})
    if held:
        yield _met(held)


def _met(blocks: list[dict]) -> dict[str, np.ndarray]:
    """Rows of cells with two rows or more. Most cells have one; the other
    columns are put together for the rows that are left."""
    cells = [_column(b["cell"]) for b in blocks]
    cell = np.concatenate(cells)
    order = np.argsort(cell)
    ordered = cell[order]
    same = ordered[1:] == ordered[:-1]
    met = np.zeros(len(cell), bool)
    met[order[1:][same]] = met[order[:-1][same]] = True
    marks = np.split(met, np.cumsum([len(c) for c in cells])[:-1])
    return {"cell": cell[met]} | {
        c: np.concatenate([_column(b[c])[m] for b, m in zip(blocks, marks)]) for c in POSTINGS if c != "cell"}


def _pairs(everything: bool):
    """Rows of whole lists to candidate pairs (later, earlier): the earliest
    one of each later set, or everything for the sets that probe."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_parts(batches):
            order = np.lexsort((part["size"], part["cell"]))
            cell, doc, th, at, size, pos, *sketches, probe = (part[c][order] for c in POSTINGS)
            sketches, probe = [x.view(np.uint64) for x in sketches], probe > 0
            n = len(cell)
            rank = np.empty(n, np.int64)
            by_age = np.lexsort((at, th, doc))
            rank[by_age] = np.arange(n)
            dense = np.cumsum(np.concatenate(([0], cell[1:] != cell[:-1])))
            # length filter: rows after i of its list with a size up to size * DEN / NUM
            stop = np.searchsorted((dense << 32) + size, (dense << 32) + size * DEN // NUM, side="right")
            many = stop - np.arange(n) - 1
            work = np.cumsum(many)
            best, count = np.full(n, n, np.int64), np.zeros(n, np.int64)
            later, earlier = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            a = 0
            while a < n:
                b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + SLICE)))
                i = np.repeat(np.arange(a, b), many[a:b])
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
                both = size[i] + size[j]
                overlap = -(-NUM * both // (NUM + DEN))             # least overlap that reaches the threshold
                left = np.minimum(size[i] - pos[i], size[j] - pos[j])    # overlap from here on
                ok = left >= overlap
                i, j, both, overlap = i[ok], j[ok], both[ok], overlap[ok]
                ok = sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int64) for x in sketches) <= both - 2 * overlap
                i, j = i[ok], j[ok]
                x = np.where(rank[i] > rank[j], i, j)
                y = i + j - x
                x, y = x[probe[x]], y[probe[x]]
                if everything:
                    later.append(x)
                    earlier.append(y)
                else:
                    np.minimum.at(best, x, rank[y])
                    count += np.bincount(x, minlength=n)
                a = b
            if everything:
                x, y = np.concatenate(later), np.concatenate(earlier)
            else:
                x = np.flatnonzero(count)
                y = by_age[best[x]]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c[of]) for of in (x, y) for c in (doc, th, at)], pa.array(count[x] > 1)],
                [*KEY, *KEY2, "more"])
    return each


def _bit(doc: np.ndarray, th: np.ndarray, at: np.ndarray) -> np.ndarray:
    text = mix(doc.view(np.uint64) ^ mix(th.view(np.uint64)))
    return (mix(text ^ mix(at.view(np.uint64))) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _word_bit(prefix: np.ndarray) -> np.ndarray:
    return (mix(prefix + np.uint64(7)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _in_table(table: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0


def _word_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prefix = batch["prefix"].flatten().to_numpy().view(np.uint32).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(_word_bit(prefix)))], ["bit"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines (doc, th, at), and of their texts (doc, th, WHOLE)."""
    for batch in batches:
        doc, th, at = (batch[c].to_numpy() for c in KEY)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(
            [_bit(doc, th, at), _bit(doc, th, np.full(len(at), WHOLE))])))], ["bit"])


def _byte(rows: pa.Table) -> pa.Table:
    bits = np.zeros(1 << 16, np.uint8)
    bits[rows["bit"].to_numpy() & 0xFFFF] = 1
    return pa.table({"block": [int(rows["bit"][0].as_py()) >> 16], "bits": [np.packbits(bits).tobytes()]})


def _bit_table(rows: DataFrame, bits_of) -> np.ndarray:
    """Fixed-size table (FILTER_BITS / 8 bytes) of what to read again. What
    shares a bit with a wanted thing is read needlessly, no more."""
    bits = rows.mapInArrow(bits_of, "bit long").distinct().withColumn("block", F.shiftright("bit", 16))
    table = np.zeros((FILTER_BITS >> 16, 1 << 13), np.uint8)
    for r in bits.groupBy("block").applyInArrow(_byte, "block long, bits binary").collect():
        table[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return table.reshape(-1)


def _word_sets(wanted: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, th = part["doc"].to_numpy(), part["th"].to_numpy()
                part = part.filter(pa.array(_in_table(wanted, _bit(doc, th, np.full(len(doc), WHOLE)))))

                def use(row, line):
                    return _in_table(wanted, _bit(*_places(part, row, line)))
                x = Lines(part["text"], use=use)
                sets = pa.ListArray.from_arrays(pa.array(np.append(x.start, len(x.hashes)).astype(np.int32)),
                                                pa.array(x.hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*map(pa.array, _places(part, x.row, x.place)), sets], [*KEY, "words"])
    return each


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The later lines (doc, th, at) of the pairs that reach the threshold."""
    ends = pairs.select(*KEY).union(pairs.select(*KEY2))
    sets = saved(texts.mapInArrow(tidy(_word_sets(_bit_table(ends, _bits))), "doc long, th long, at long, words array<long>"),
                 "lines-words")
    second = sets.toDF(*KEY2, "words2")
    common = F.size(F.array_intersect("words", "words2"))
    return (pairs.join(sets, KEY).join(second, KEY2)
                 .filter((NUM + DEN) * common >= NUM * (F.size("words") + F.size("words2")))
                 .select(*KEY).distinct())


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text): th, a hash of the text, tells rows that repeat a doc_id
    with another text apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc, th, at) of the lines that stay: doc is the doc_id (NO_ID for
    null), th the text's hash, at the line's place."""
    spark, texts = docs.sparkSession, _texts(docs, id_col, text_col)
    rarity = _log_counts(texts.mapInArrow(tidy(_count_words), COUNTS))
    earliest = Window.partitionBy("key", "sketch").orderBy(*KEY)
    sets = saved(texts.mapInArrow(tidy(_sets(rarity)), SETS).withColumn("nth", F.row_number().over(earliest))
                      .filter("nth = 1").drop("nth"), "lines-sets")
    lists = _log_counts(sets.select("prefix").mapInArrow(tidy(_count_prefix), COUNTS))

    total = sets.agg(F.sum(F.size("prefix"))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-total // PART))

    def candidates(rows: DataFrame, everything: bool, wanted: np.ndarray | None = None) -> DataFrame:
        return (rows.mapInArrow(tidy(_postings(lists, chunk, parts, wanted)),
                                "part long, " + ", ".join(f"{c} binary" for c in POSTINGS))
                    .repartition(parts, "part").sortWithinPartitions("part")
                    .mapInArrow(tidy(_pairs(everything)), PAIRS))

    first = saved(candidates(sets.select(*SET_COLUMNS, F.lit(True).alias("probe")), False)
                  .groupBy(*KEY, *KEY2).agg(F.max("more").alias("more")), "lines-pairs")
    gone = saved(_verified(texts, first), "lines-gone")
    # sets with a candidate in some list that was not tried
    left = saved(first.groupBy(*KEY).agg(F.max("more").alias("more")).filter("more").select(*KEY)
                      .join(gone, KEY, "left_anti").withColumn("probe", F.lit(True)), "lines-left")
    if not left.isEmpty():
        marked = sets.select(*SET_COLUMNS).join(left, KEY, "left") \
                     .withColumn("probe", F.coalesce("probe", F.lit(False)))
        words_of = _bit_table(sets.join(left, KEY).select("prefix"), _word_bits)
        rest = saved(candidates(marked, True, words_of).drop("more").distinct()
                     .join(first.drop("more"), [*KEY, *KEY2], "left_anti"), "lines-rest")
        gone = gone.unionByName(saved(_verified(texts, rest), "lines-gone-too"))
    return sets.select(*KEY).join(gone, KEY, "left_anti")


def _by_text(kept: DataFrame) -> DataFrame:
    """Per text (doc, th) the sorted places of the lines that stay."""
    return kept.groupBy("doc", "th").agg(F.sort_array(F.collect_list("at")).alias("places"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_lines (lines with a word), n_removed,
    kept_lines (places of those that stay, from 0, in order).

    Null text counts as empty. Lines without a word are never removed and not
    counted. Rows that repeat a doc_id with another text are texts of their
    own; rows that repeat both are one text, kept once per row. An empty table
    gives no rows; other columns are dropped.
    """
    kept = _by_text(kept_lines(docs, id_col, text_col, chunk))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # A match begins at the first character of a line that is no space and takes the rest of the line.
    counted = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D][^\n]*")).cast("long")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                    F.xxhash64(text).alias("th"), counted.alias("n_lines"))
    places = F.coalesce("places", F.array().cast("array<long>"))
    return d.join(kept, ["doc", "th"], "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size(places)).alias("n_removed"),
        places.alias("kept_lines"))


def _rebuilt(text: pd.Series, places: pd.Series) -> pd.Series:
    """Texts of the lines at ``places`` and of the lines without a word."""
    def one(t, at):
        if at is None or t is None:
            return t
        stay = set(at.tolist())
        return "\n".join(line for i, line in enumerate(t.split("\n")) if i in stay or not line.encode().split())
    return pd.Series([one(t, at) for t, at in zip(text, places)], dtype=object)


def without_repeats(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``docs`` (all columns) with the removed lines taken out of the text;
    documents that lose their last line with a word are left out. ``n_chars``,
    if there, counts the new text."""
    kept = _by_text(kept_lines(docs, chunk=chunk))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    d = rows.select("row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                    F.xxhash64(text).alias("th")).join(kept, ["doc", "th"], "left")
    out = (d.filter(F.col("places").isNotNull() | ~text.rlike(r"[^\x20\x09-\x0D]"))
            .select("row", F.pandas_udf(_rebuilt, "string")("row.text", "places").alias("new")))
    given = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("new")}
    if "n_chars" in given:
        given["n_chars"] = F.coalesce(F.length("new"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"])
    return out.select(*(value.alias(c) for c, value in given.items()))
