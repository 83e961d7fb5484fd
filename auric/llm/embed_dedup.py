"""Embedding near-duplicates by product quantisation over inverted lists.

1. Equal vectors of one label become one class with a weight.
2. A coarse quantiser (k-means, fitted on a bounded sample) deals unit vectors
   to inverted lists; the residual to the list's centre is coded by subspace
   codebooks. Every vector is indexed.
3. A vector probes its own list and each list whose border it is near: if two
   vectors are at most r apart, the one on the far side of a border lies
   within r of it, so probing every list with a border within r loses nothing.
   ``margin`` scales that distance; below 1 it gives up pairs that lie almost
   perpendicular to a border, for fewer probes.
4. In a list, distances are looked up in tables (query against codes). A
   candidate stays if its distance less its own coding error can be within r,
   which by the triangle inequality loses nothing. Candidates are decided by
   the exact cosine in double precision.
5. Pairs are not written out: a task counts links and keeps a spanning forest.

Large lists are cut into chunks of members and of queries, and every pair of
chunks is compared on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.common import components, saved, shuffle_partitions
from auric.llm.simhash import forest, whole_cells

COSINE = 0.98
MARGIN = 0.6
SAMPLE = 16384          # vectors that the index is fitted on
MAX_LISTS = 4096        # so the centres sent to the tasks stay within a few MB
SUBSPACES, CODES = 8, 16
MEMBERS, QUERIES = 512, 2048    # rows of one list that one comparison holds
PROBED = 256            # vectors probed at a time: so many rows of all lists are held
ROUNDS = 8


@dataclass(frozen=True)
class Index:
    centres: np.ndarray     # (lists, dim)
    books: np.ndarray       # (subspaces, codes, dim / subspaces), zero-padded
    radius: float           # largest distance of unit vectors that link
    reach: float            # distance to a border up to which a list is probed

    def split(self, x: np.ndarray) -> np.ndarray:
        """(subspaces, rows, width), padded with zeros."""
        s, width = len(self.books), self.books.shape[2]
        padded = np.zeros((len(x), s * width))
        padded[:, :x.shape[1]] = x
        return padded.reshape(len(x), s, width).transpose(1, 0, 2)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to the centres."""
        return np.maximum((x * x).sum(1)[:, None] - 2 * x @ self.centres.T + (self.centres ** 2).sum(1), 0)

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subspace codes of the residuals and each vector's coding error."""
        parts = self.split(x - self.centres[home])
        codes = np.empty((len(x), len(self.books)), np.uint8)
        wrong = np.zeros(len(x))
        for s, (part, book) in enumerate(zip(parts, self.books)):
            d = ((part[:, None, :] - book[None]) ** 2).sum(2)
            codes[:, s] = d.argmin(1)
            wrong += d.min(1)
        return codes, np.sqrt(wrong)

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Own list, and the lists from it upwards that are probed; a pair is
        compared where the one with the lower list probes the other's."""
        d = self.distances(x)
        home = d.argmin(1)
        own = d[np.arange(len(x)), home]
        centre = self.centres[home]
        between = np.sqrt(np.maximum((centre ** 2).sum(1)[:, None] - 2 * centre @ self.centres.T
                                     + (self.centres ** 2).sum(1), 1e-18))
        near = (d - own[:, None]) / (2 * between) <= self.reach
        near[np.arange(len(x)), home] = True
        near &= np.arange(len(self.centres))[None] >= home[:, None]
        return home, [np.flatnonzero(row) for row in near]

    def table_distances(self, queries: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to coded members of one list, by table lookup."""
        total = np.zeros((len(queries), len(codes)))
        for s, (part, book) in enumerate(zip(self.split(queries - self.centres[centre]), self.books)):
            table = ((part[:, None, :] - book[None]) ** 2).sum(2)
            total += table[:, codes[:, s]]
        return np.sqrt(total)


def kmeans(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centres of ``x``, started from seeded rows."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def fit_index(sample: np.ndarray, lists: int, cosine: float = COSINE, margin: float = MARGIN) -> Index:
    """Index from a sample of unit vectors."""
    radius = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    centres = kmeans(sample, max(1, min(lists, len(sample))))
    width = -(-sample.shape[1] // SUBSPACES)
    blank = Index(centres, np.zeros((SUBSPACES, 1, width)), radius, radius * margin)
    rest = sample - centres[blank.distances(sample).argmin(1)]
    codes = min(CODES, len(sample))
    books = np.stack([kmeans(np.ascontiguousarray(part), codes, s) for s, part in enumerate(blank.split(rest))])
    return Index(centres, books, radius, radius * margin)


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors, filled up with zeros to ``dim``. They are scaled by their
    largest component first, so that no square leaves the range of doubles."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.zeros((len(size), dim))
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    x[np.repeat(np.arange(len(size)), size), at] = column.flatten().to_numpy(zero_copy_only=False)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _encode(index: Index, dim: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PROBED):
                rows = batch.slice(at, PROBED)
                x = _unit(rows["vec"], dim)
                home, probes = index.probes(x)
                codes, wrong = index.encode(x, home)
                yield pa.RecordBatch.from_arrays(
                    [rows["label"], rows["id"], rows["weight"], rows["vec"], pa.array(home.astype(np.int32)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(wrong),
                     pa.array([p.astype(np.int32) for p in probes], pa.list_(pa.int32()))],
                    ["label", "id", "weight", "vec", "list", "codes", "error", "probes"])
    return each


def _compare(index: Index, dim: int, cosine: float):
    def one(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query = rows["query"].to_numpy()
        m, q = rows.filter(pa.array(~query)), rows.filter(pa.array(query))
        none = np.zeros(0, np.int64)
        if m.num_rows == 0 or q.num_rows == 0:
            return none, none, none
        centre = int(m["list"][0].as_py())
        mv, qv = _unit(m["vec"].combine_chunks(), dim), _unit(q["vec"].combine_chunks(), dim)
        mid, qid = m["id"].to_numpy(), q["id"].to_numpy()
        codes = np.frombuffer(b"".join(m["codes"].to_pylist()), np.uint8).reshape(-1, SUBSPACES)
        near = index.table_distances(qv, centre, codes) - m["error"].to_numpy()[None] <= index.radius
        # in its own list a pair is met from both sides; it counts from the smaller id
        near &= (q["home"].to_numpy() != centre)[:, None] | (qid[:, None] < mid[None])
        i, j = np.nonzero(near)
        exact = np.concatenate([np.einsum("ij,ij->i", qv[i[a:a + 65536]], mv[j[a:a + 65536]])
                                for a in range(0, max(1, len(i)), 65536)]) >= cosine
        i, j = i[exact], j[exact]
        ids, place = np.unique(np.concatenate([qid, mid]), return_inverse=True)
        a, b = place[:len(qid)][i], place[len(qid):][j]
        count = np.zeros(len(ids), np.int64)
        np.add.at(count, a, m["weight"].to_numpy()[j])
        np.add.at(count, b, q["weight"].to_numpy()[i])
        root = forest(len(ids), iter([(a, b)]))
        some = np.flatnonzero(count)
        return ids[some], count[some], ids[root[some]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_cells(batches, 1 << 12):
            cell = rows["cell"].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            found = [one(rows.slice(a, b - a)) for a, b in zip(starts, np.append(starts[1:], len(cell)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[c] for f in found])) for c in range(3)], ["id", "n", "root"])
    return each


def _chunked(rows: DataFrame, sizes: DataFrame, own: str, other: str, own_size: int, other_size: int) -> DataFrame:
    """``rows`` of one side with its chunk, once for each chunk of the other side."""
    mine = F.pmod(F.xxhash64("id", F.lit(2)), F.ceil(F.col(own) / own_size))
    theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(other) / other_size) - 1))
    return rows.join(sizes, ["label", "list"]).withColumn("mine", mine).withColumn("theirs", theirs)


def _links(classes: DataFrame, width: int, cosine: float, margin: float, sample: int, max_lists: int) -> DataFrame:
    """(id, n, root): links of classes (label, vec, id, weight) whose vectors
    have at most ``width`` components, by task."""
    n = classes.count()
    fit_on = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    index = fit_index(_unit(fit_on, width), min(max_lists, round(n ** 0.5)), cosine, margin)
    kinds = dict(classes.dtypes)
    coded = saved(classes.mapInArrow(
        _encode(index, width), f"label {kinds['label']}, id long, weight long, vec {kinds['vec']}, list int, "
                               "codes binary, error double, probes array<int>"), "embed-coded")
    members = coded.select("label", "list", "id", "weight", "vec", "codes", "error", F.col("list").alias("home"),
                           F.lit(False).alias("query"))
    queries = coded.select("label", F.explode("probes").alias("list"), "id", "weight", "vec",
                           F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"),
                           F.col("list").alias("home"), F.lit(True).alias("query"))
    sizes = saved(members.groupBy("label", "list").agg(F.count(F.lit(1)).alias("n_members")).join(
        queries.groupBy("label", "list").agg(F.count(F.lit(1)).alias("n_queries")), ["label", "list"]), "embed-sizes")
    cell = lambda a, b: F.xxhash64("label", "list", a, b).alias("cell")
    keep = ["list", "home", "id", "weight", "vec", "codes", "error", "query"]
    rows = (_chunked(members, sizes, "n_members", "n_queries", MEMBERS, QUERIES).select(cell("mine", "theirs"), *keep)
            .unionByName(_chunked(queries, sizes, "n_queries", "n_members", QUERIES, MEMBERS)
                         .select(cell("theirs", "mine"), *keep)))
    parts = shuffle_partitions(classes.sparkSession)
    return saved(rows.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(
        _compare(index, width, cosine), "id long, n long, root long"), "embed-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, margin: float = MARGIN,
                    sample: int = SAMPLE, max_lists: int = MAX_LISTS) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable, itself included), kept (it is its
    own component's smallest).

    Vectors of equal, non-null label and equal length link at a cosine of at
    least ``cosine``, in double precision; components are read as doubles unless
    the column has floats. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, and so do rows without a vec_id.
    Repeated rows count as vectors of their own that link with each other. An
    empty table gives no rows; other columns are dropped.

    Lengths up to each power of two have an index of their own.
    """
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"),
                           F.col("embedding").cast(kind).alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(
        finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    # Vectors of one label and length are compared; the length is part of the label here.
    v = given.select("vec_id", F.struct("label", F.size("vec").alias("length")).alias("label"), "vec",
                     usable.alias("usable"))
    classes = saved(v.filter("usable").groupBy("label", "vec").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("power", F.ceil(F.log2(F.col("label.length"))).cast("int")), "embed-classes")
    widths = classes.groupBy("power").agg(F.max("label.length").alias("width")).collect()     # at most 32 rows
    found = None
    for row in sorted(widths):
        links = _links(classes.filter(F.col("power") == row["power"]).drop("power"), row["width"], cosine, margin,
                       sample, max_lists)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.col("vec_id").isNotNull().alias("kept"))
    count = found.groupBy("id").agg(F.sum("n").alias("n"))
    reach = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    by_class = (classes.select("label", "vec", "id", "weight").join(count, "id", "left").join(reach, "id", "left")
                .select(F.col("label").alias("l"), F.col("vec").alias("x"),
                        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                        F.coalesce("component", "id").alias("component_id")))
    by_class = saved(by_class, "embed-classes-found")
    linked = v.filter("usable").join(by_class, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("x"))) \
        .select("vec_id", "n_links", "component_id")
    alone = v.filter(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
