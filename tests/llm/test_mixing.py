import itertools

import numpy as np
from conftest import make_docs, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from auric.llm import mixing as M


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight; what is above a cap is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, left = {}, dict(sizes)
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if share[s] > cap * sizes[s]]
        if not above:
            return fixed | share
        for s in above:
            fixed[s] = cap * sizes[s]
            del left[s]


def check(docs):
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    for s, whole in sizes.items():
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == whole for r in own)
        assert sum(r.taken for r in own) <= want[s] + 1e-6
        assert want[s] - sum(r.taken for r in own) < max(r.size for r in own) + 1
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in own)
    return rows


def test_targets_and_takes(corpus):
    rows = check(corpus)
    assert {r.doc_id: r.size for r in rows}[1] == 0
    assert rows_of(M.mix(corpus)) == rows_of(M.mix(corpus.repartition(3)))


def test_capped_source_passes_its_excess_on(spark):
    docs = make_docs(spark, [(0, "a b", "a"), *[(i, "w " * (5 + i % 7), "b") for i in range(1, 80)],
                             *[(i, "w " * (5 + i % 11), "c") for i in range(100, 180)], (500, "x", None)])
    rows = check(docs)
    assert {r.taken for r in rows if r.source == "a"} == {6}


def test_very_many_documents_of_one_size(spark):
    docs = make_docs(spark, [(i, "a b c", "a") for i in range(5000)] + [(9000 + i, "z", "b") for i in range(50)])
    rows = check(docs)
    assert sum(r.taken for r in rows if r.source == "b") == 150


def test_one_id_at_half_of_a_source(spark):
    """Null and repeated ids, equal rows among them, still reach the target."""
    rows = [(7 if i % 2 else None, f"w{i % 3} " * 10, "a") for i in range(3000)]
    rows += [(None, None, "a")] * 5 + [(i, "u v " * (1 + i % 9), "b") for i in range(900)] + [(9, "x y z", "c")] * 700
    docs = make_docs(spark, rows)
    found = check(docs)
    assert rows_of(M.mix(docs)) == rows_of(M.mix(docs.repartition(5)))
    got = M.mixed(docs)
    for source in "abc":
        want = sum(r.taken for r in found if r.source == source)
        assert got.filter(F.col("source") == source).select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] == want


def test_only_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "LOT_PART", 64)
    docs = make_docs(spark, [(1, "a b c", "s")] * 1000 + [(2, "d", "t")] * 1000)
    check(docs)
    assert M.mixed(docs).count() == sum(r.repeats for r in M.mix(docs).collect())


def test_mixed_rows_follow_the_plan(corpus):
    taken = {}
    for r in M.mix(corpus).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    got = M.mixed(corpus)
    assert got.columns == corpus.columns
    words = {}
    for r in got.collect():
        words[r.source] = words.get(r.source, 0) + len((r.text or "").encode().split())
    assert words == {source: n for source, n in taken.items() if n}


def test_empty_table_and_clashing_columns(corpus, clashing, empty):
    assert M.mix(empty).collect() == [] and M.mixed(empty).collect() == []
    assert rows_of(M.mix(clashing)) == rows_of(M.mix(corpus))
    assert M.mixed(clashing).columns == clashing.columns


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=4), st.data())
def test_fit_budget_is_the_best_subset_sum(counts, data):
    sizes = np.array(sorted(counts))
    n = np.array([counts[s] for s in sizes])
    total = int((sizes * n).sum())
    budget = data.draw(st.integers(0, total - 1))
    take = M.fit_budget(sizes, n, budget)
    assert (take >= 0).all() and (take <= n).all() and (take * sizes).sum() <= budget
    best = max(sum(t * s for t, s in zip(x, sizes)) for x in itertools.product(*[range(b + 1) for b in n])
               if sum(t * s for t, s in zip(x, sizes)) <= budget)
    assert (take * sizes).sum() == best


def test_fit_budget_above_the_exact_part():
    sizes, n = np.array([3, 700, 40000, 90000]), np.array([4, 50, 9, 7])
    total = int((sizes * n).sum())
    for budget in (total // 3, total // 2, total - 1):
        take = M.fit_budget(sizes, n, budget)
        assert 0 <= budget - (take * sizes).sum() < 700 and (take <= n).all()
