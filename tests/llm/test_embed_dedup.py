import numpy as np
import pytest
from conftest import rows_of

from auric.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, kind=np.float32):
    unit = {}
    for k, (i, e, label) in enumerate(rows):
        if i is not None and label is not None and e and None not in e:
            x = np.array(e, kind).astype(np.float64)
            if np.isfinite(x).all() and (x != 0).any():
                x /= np.abs(x).max()
                unit[k] = x / np.linalg.norm(x)
    near = {k: {j for j in unit if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k])
                and unit[j] @ unit[k] >= 0.98 - 1e-12} for k in unit}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = near.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids) if i is not None else None
        out.append((i, len(near.get(k, ())), c, i is not None and i == c))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        base = rng.normal(size=16)
        for k in range(1 + (i % 10 == 0) * 12):
            x = (base + rng.normal(size=16) * 0.12 * (k > 0)).astype(np.float32)
            rows.append((len(rows) * 3, [float(v) for v in x], int(rng.integers(0, 3))))
    rows += [(5001, rows[0][1], rows[0][2]), (5002, rows[0][1], rows[0][2]), (5003, rows[0][1], None), (None, rows[0][1], rows[0][2]),
             (5004, None, 1), (5005, [], 1), (5006, [0.0] * 16, 1), (5007, [float("nan")] + [1.0] * 15, 1),
             (5008, [float("inf")] + [1.0] * 15, 1), (5009, [None] + [1.0] * 15, 1), (5010, [1.0] * 8, 1),
             (5011, [v * 3 for v in rows[0][1]], rows[0][2])]
    return rows


def test_matches_brute_force(spark, vectors):
    frame = spark.createDataFrame(vectors, SCHEMA)
    assert rows_of(E.near_duplicates(frame, margin=1.0)) == brute_force(vectors)


def test_lengths_and_doubles_link_on_their_own(spark):
    rng = np.random.default_rng(5)
    rows = []
    for dim in (1, 3, 7, 8, 9, 16):
        for scale in (1.0, 1e200, 1e-60, 1e-300):
            base = rng.normal(size=dim)
            rows += [(len(rows) + k, [float(v) for v in base * scale * (1 + k)], dim % 2) for k in range(3)]
    rows.append((900, [1e308, 1e308, 1e308], 1))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert rows_of(E.near_duplicates(frame, margin=1.0)) == brute_force(rows, np.float64)
    assert sum(r.n_links for r in E.near_duplicates(frame).collect()) >= 48


def test_probes_hold_no_row_of_all_lists_by_components():
    import tracemalloc

    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4096, 64))
    index = E.Index(centres, np.zeros((8, 1, 8)), .2, .12)
    x = rng.normal(size=(E.PROBED, 64))
    tracemalloc.start()
    index.probes(x / np.linalg.norm(x, axis=1)[:, None])
    assert tracemalloc.get_traced_memory()[1] < 200 << 20


def test_recall_at_the_default_margin(spark, vectors):
    frame = spark.createDataFrame(vectors, SCHEMA)
    got = E.near_duplicates(frame).agg({"n_links": "sum"}).first()[0]
    want = E.near_duplicates(frame, margin=1.0).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * want <= got <= want


def test_small_chunks_change_nothing(spark, vectors, monkeypatch):
    monkeypatch.setattr(E, "MEMBERS", 7)
    monkeypatch.setattr(E, "QUERIES", 11)
    assert rows_of(E.near_duplicates(spark.createDataFrame(vectors, SCHEMA), margin=1.0)) == brute_force(vectors)


def test_table_distances_are_those_to_the_coded_vectors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 20))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = E.fit_index(x, 5)
    home, _ = index.probes(x)
    for c in range(len(index.centres)):
        m = home == c
        if m.any():
            codes, wrong = index.encode(x[m], home[m])
            d = index.table_distances(x, c, codes)
            true = np.linalg.norm(x[:, None] - x[m][None], axis=2)
            assert (np.abs(d - true) <= wrong[None] + 1e-9).all()      # the triangle inequality of the filter


def test_empty_table_and_extra_columns(spark, vectors):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(vectors, SCHEMA)
    assert E.near_duplicates(frame.limit(0)).collect() == []
    assert E.near_duplicates(frame.filter("embedding is null")).collect()[0].n_links == 0
    extra = frame.select("*", *[F.lit(1).alias(n) for n in ("id", "vec", "n", "weight", "list", "usable", "kept", "x")])
    assert rows_of(E.near_duplicates(extra)) == rows_of(E.near_duplicates(frame))
