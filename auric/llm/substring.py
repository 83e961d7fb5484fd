"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

A window is ``window`` consecutive words. Every word covered by a window whose
word sequence also starts anywhere else is removed.

The whole corpus is the reference, cut into blocks so that a text meets every
place it can match: the lowest-hashed ``seed`` words in a window name its
block, and equal windows have equal seeds. Consecutive windows with one seed
form a segment. So only descriptions of segments travel (about one for twelve
words), and most segments, whose seed occurs once, are dropped at once.

1. Segments of equal content are counted. A segment that occurs twice or more
   is a duplicate span wherever it occurs; copies never meet in a task.
2. A segment that occurs once, but whose block holds others, is parsed: at a
   window, look the window up in the block's index, and if it occurs elsewhere
   follow that reference as far as it goes. The factor (its windows and the
   words they cover) is a duplicate span. At its end, the window across the
   factor's boundary is looked up anew, so no window is lost between factors.
3. A block with very many different segments is dealt anew: its windows are
   named by all their seeds together, which cuts its segments into shorter ones
   in finer blocks, and these go through steps 1 and 2. Equal windows have equal
   seeds, so they still meet, and a finer block holds little else.

Words, seeds, windows and segments are compared by 64-bit hashes; a match
needs two independent ones (seed, and window or segment) to agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.common import saved, shuffle_partitions
from auric.llm.simhash import whole_cells

WINDOW = 35
SEED = 12
BLOCK = 1024        # different segments beyond which a block is dealt anew

_BASE = 0x9E3779B97F4A7C15              # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]), 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of runs of a text's words."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        digest = xxhash.xxh64_intdigest
        each = np.fromiter((digest(w) for w in words), np.uint64, self.n)
        up, self.down = _powers(self.n + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each * up[:self.n], dtype=np.uint64)))

    def runs(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the words [start, stop) for each pair."""
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start]
                    + (stop - start).astype(np.uint64))

    def grams(self, length: int) -> np.ndarray:
        start = np.arange(max(0, self.n - length + 1))
        return self.runs(start, start + length)


def segments(h: Hashed, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """(seed hash, segment hash, first window, number of windows) of each run
    of consecutive windows whose lowest seed is the same one."""
    count = h.n - window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = h.grams(seed)
    span = window - seed + 1
    lowest = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(grams[a:a + (1 << 16) + span - 1], span).argmin(axis=1) + a
        for a in range(0, count, 1 << 16)]) + (np.arange(count) % (1 << 16))
    first = np.flatnonzero(np.concatenate(([True], lowest[1:] != lowest[:-1])))
    many = np.diff(np.append(first, count))
    body = h.runs(first, first + many + window - 1)
    return grams[lowest[first]].view(np.int64), body.view(np.int64), first, many


def _segments(window: int, seed: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segments(Hashed((x.as_py() or b"").split()), window, seed) for x in batch["text"]]
            row = np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found])
            columns = [np.concatenate([f[c] for f in found]).astype(np.int64) for c in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row)), batch["th"].take(pa.array(row)), *map(pa.array, columns)],
                ["doc_id", "th", "seed", "body", "first", "many"])
    return each


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(doc_id, th, words hashed, requested segments) of each row that has any.
    Rows that repeat doc_id and text are asked once."""
    seen = set()
    for batch in batches:
        out = []
        for i, asked in enumerate(batch["wanted"].to_pylist()):
            row = batch["doc_id"][i].as_py(), batch["th"][i].as_py()
            if asked and row not in seen:
                seen.add(row)
                out.append((*row, Hashed(batch["text"][i].as_py().split()), asked))
        yield out


def finer_segments(h: Hashed, window: int, seed: int, first: int, many: int) -> tuple[np.ndarray, ...]:
    """(name hash, segment hash, first window, number of windows) of the runs of
    the windows first, first + 1, ... that have the same seeds."""
    span = window - seed + 1
    grams = h.grams(seed)
    names = []
    for a in range(first, first + many, 1 << 12):
        b = min(first + many, a + (1 << 12))
        name = np.zeros(b - a, np.uint64)
        for column in np.sort(np.lib.stride_tricks.sliding_window_view(grams[a:b + span - 1], span), axis=1).T:
            name = _mix(name * np.uint64(_BASE) + column)
        names.append(name)
    name = np.concatenate(names)
    at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    each = np.diff(np.append(at, many))
    return name[at].view(np.int64), h.runs(first + at, first + at + each + window - 1).view(np.int64), first + at, each


def _windows(window: int, seed: int):
    """Requested segments of a document with the hashes of their windows: whole
    ones with no ``body``, those of dense blocks cut into finer ones. Rows that
    repeat doc_id and text are asked once."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            out: list[tuple] = []
            for i, asked in enumerate(batch["wanted"].to_pylist()):
                row = batch["doc_id"][i].as_py(), batch["th"][i].as_py()
                if row in seen:
                    continue
                seen.add(row)
                h = Hashed(batch["text"][i].as_py().split())
                grams = h.grams(window).view(np.int64)
                for s in asked:
                    if s["dense"]:
                        found = finer_segments(h, window, seed, s["first"], s["many"])
                        out += [(*row, cell, body, s["n"], first, grams[first:first + many])
                                for cell, body, first, many in zip(*(f.tolist() for f in found))]
                    else:
                        out.append((*row, s["seed"], None, s["n"], s["first"], grams[s["first"]:s["first"] + s["many"]]))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[c] for r in out], pa.int64()) for c in range(6)],
                 pa.array([r[6] for r in out], pa.list_(pa.int64()))],
                ["doc_id", "th", "cell", "body", "n", "first", "windows"])
    return each


def parse(bodies: list[list[int]], wanted: list[bool]) -> list[list[tuple[int, int]]]:
    """Factors of each wanted body as (first window, number of windows), by
    greedy parsing against the block that all ``bodies`` make."""
    index: dict[int, list[tuple[int, int]]] = {}
    for b, body in enumerate(bodies):
        for at, window in enumerate(body):
            index.setdefault(window, []).append((b, at))
    out: list[list[tuple[int, int]]] = []
    for b, body in enumerate(bodies):
        factors: list[tuple[int, int]] = []
        at = 0
        while wanted[b] and at < len(body):
            places = index[body[at]]
            if len(places) < 2:
                at += 1
                continue
            ref, r = places[0] if places[0] != (b, at) else places[1]
            length = 1
            while (at + length < len(body) and r + length < len(bodies[ref])
                   and bodies[ref][r + length] == body[at + length]):
                length += 1
            factors.append((at, length))
            at += length
        out.append(factors)
    return out


SPANS = "doc_id long, th long, first long, many long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_cells(batches):
        cell = rows["cell"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        doc_id, th = rows["doc_id"].to_pylist(), rows["th"].to_pylist()
        first, n, windows = rows["first"].to_pylist(), rows["n"].to_pylist(), rows["windows"].to_pylist()
        out: list[tuple] = []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(cell)).tolist()):
            found = parse(windows[a:b], [n[i] == 1 for i in range(a, b)])
            out += [(doc_id[i], th[i], first[i] + at, many)
                    for i, factors in zip(range(a, b), found) for at, many in factors]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)],
                                         ["doc_id", "th", "first", "many"])


def _same_row(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def _by_row(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """One row per document with an array of its own entries."""
    return rows.groupBy("doc_id", "th").agg(F.collect_list(F.struct(*fields)).alias(name))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, text): th, a hash of the text, tells rows that repeat a
    doc_id with another text apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"),
                       text.cast("binary").alias("text"))


def _with(texts: DataFrame, lists: DataFrame, name: str, how: str = "left") -> DataFrame:
    """Every text with its list, or null; with ``inner`` only those that have one."""
    return (texts.alias("t").join(lists.alias("s"), _same_row("t", "s"), how)
                 .select("t.doc_id", "t.th", "t.text", F.col(f"s.{name}")))


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Spans of windows (doc_id, th, first, many) that occur elsewhere too:
    the words [first, first + many + window - 1) of a row are duplicates. Rows
    that repeat doc_id and text have their spans once."""
    texts = _texts(docs, id_col, text_col)
    every = saved(texts.mapInArrow(_segments(window, seed),
                                   "doc_id long, th long, seed long, body long, first long, many long"), "rlz-segments")
    again = saved(every.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("seed"), "rlz-seeds")
    shared = saved(every.join(again, "seed"), "rlz-shared")
    bodies = saved(shared.groupBy("seed", "body").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "first", "many")).alias("at")), "rlz-bodies")
    whole = shared.join(bodies.filter("n > 1").select("seed", "body"), ["seed", "body"]) \
        .select("doc_id", "th", "first", "many")
    # blocks with different segments, at least one of which occurs only once
    blocks = (bodies.groupBy("seed").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least"))
                    .filter("d > 1 and least = 1").select("seed", (F.col("d") > block).alias("dense")))
    asked = bodies.join(blocks, "seed").select("seed", "n", "dense", "at.*")
    pieces = saved(_with(texts, _by_row(asked, "wanted", "seed", "n", "dense", "first", "many"), "wanted", "inner")
                   .mapInArrow(_windows(window, seed), "doc_id long, th long, cell long, body long, n long, first long, "
                                                       "windows array<long>"), "rlz-windows")
    # the same two steps over the finer segments of dense blocks
    finer = pieces.filter("body is not null")
    kinds = saved(finer.groupBy("cell", "body").agg(
        F.sum("n").alias("n"), F.first(F.struct("doc_id", "th", "first", "windows")).alias("at")), "rlz-finer")
    finer_whole = finer.join(kinds.filter("n > 1").select("cell", "body"), ["cell", "body"]) \
        .select("doc_id", "th", "first", F.size("windows").cast("long").alias("many"))
    mixed = kinds.groupBy("cell").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least")) \
        .filter("d > 1 and least = 1").select("cell")
    rows = pieces.filter("body is null").select("doc_id", "th", "cell", "n", "first", "windows").unionByName(
        kinds.join(mixed, "cell").select("at.doc_id", "at.th", "cell", "n", "at.first", "at.windows"))
    factors = rows.repartition(shuffle_partitions(docs.sparkSession), "cell").sortWithinPartitions("cell") \
        .mapInArrow(_parse, SPANS)
    return whole.unionByName(finer_whole).unionByName(factors).distinct()


def _remove(window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, spans in zip(batch["text"], batch["spans"].to_pylist()):
                words = text.as_py().split()
                edge = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    edge[s["first"]] += 1
                    edge[s["first"] + s["many"] + window - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                left = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rows.append((len(words), int(gone.sum()), hashlib.sha256(left).hexdigest(), left))
            n_words, n_removed, digest, left = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(left, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return each


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and kept,
    the words left joined by one space.

    Windows are judged on the input. Null text has no words; texts shorter than
    a window lose nothing. Repeated rows are documents of their own and so
    duplicates of each other; rows may share a doc_id. An empty table gives no
    rows; other columns are dropped.
    """
    spans = duplicate_spans(docs, id_col, text_col, window, seed, block)
    lists = _by_row(spans, "spans", "first", "many")
    return (_with(_texts(docs, id_col, text_col), lists, "spans")
            .mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
            .withColumn("kept", F.col("kept").cast("string")))
