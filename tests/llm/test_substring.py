import hashlib
from collections import Counter

import numpy as np
from conftest import make_docs, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auric.llm import substring as R


def brute_force(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = {i + k for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for k in range(window)}
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(map(str, out))


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_matches_brute_force(corpus, clashing):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    want = brute_force(rows, 35)
    assert any(eval(r)[2] for r in want)
    assert rows_of(R.substring_dedup(corpus), *COLUMNS) == want
    assert rows_of(R.substring_dedup(clashing, block=1), *COLUMNS) == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab ", max_size=60), min_size=1, max_size=8))
def test_matches_brute_force_on_repetitive_texts(spark, texts):
    rows = list(enumerate(texts))
    for block in (1024, 2):
        got = R.substring_dedup(make_docs(spark, rows), window=5, seed=2, block=block)
        assert rows_of(got, *COLUMNS) == brute_force(rows, 5)


def test_segments_partition_the_windows():
    rng = np.random.default_rng(0)
    words = [str(x).encode() for x in rng.integers(0, 50, 2000)]
    h = R.Hashed(words)
    _, _, first, many = R.segments(h, 35, 12)
    assert first[0] == 0 and (first[1:] == (first + many)[:-1]).all() and first[-1] + many[-1] == 2000 - 34
    grams = h.grams(3)
    assert grams[0] == R.Hashed(words[:3]).grams(3)[0] and len(set(grams.tolist())) == len({tuple(words[i:i + 3]) for i in range(1998)})


def test_parse_follows_references_and_checks_boundaries():
    bodies = [[1, 2, 3, 9, 4], [1, 2, 3], [4, 5], [5, 6]]
    assert R.parse(bodies, [True] * 4) == [[(0, 3), (4, 1)], [(0, 3)], [(0, 1), (1, 1)], [(0, 1)]]


def test_empty_table(empty):
    assert R.substring_dedup(empty).collect() == []


def test_copies_of_one_row_have_one_row_s_spans(spark, corpus):
    """1,000 equal rows: the span list is as long as that of two."""
    text = " ".join(f"w{i % 90}x{i}" for i in range(300))
    spans = lambda n: R.duplicate_spans(make_docs(spark, [(1, text)] * n + [(2, "a b c")]))
    two = rows_of(spans(2))
    assert two and rows_of(spans(1000)) == two
    got = R.substring_dedup(make_docs(spark, [(1, text)] * 1000))
    assert got.count() == 1000 and got.filter("n_removed = 300").count() == 1000


def test_dense_blocks_are_dealt_anew(spark):
    """One seed phrase in several hundred contexts, with some windows shared by
    two of them: every size of block gives the brute-force result."""
    rng = np.random.default_rng(3)
    phrase = "one two three four five six seven eight".split()
    rows = []
    for i in range(120):
        before, after = ([f"v{x}" for x in rng.integers(0, 60, 9)] for _ in range(2))
        rows.append((i, " ".join([*before, *phrase, *after])))
    for i in range(0, 120, 10):
        words = rows[i][1].split()
        rows.append((500 + i, " ".join([*words[2:-3], "end"])))
    want = brute_force(rows, 14)
    assert sum(eval(r)[2] > 0 for r in want) >= 24
    for block in (1024, 16, 2):
        got = R.substring_dedup(make_docs(spark, rows), window=14, seed=3, block=block)
        assert rows_of(got, *COLUMNS) == want, block


def test_finer_segments_partition_the_windows():
    rng = np.random.default_rng(1)
    h = R.Hashed([str(x).encode() for x in rng.integers(0, 20, 400)])
    name, body, first, many = R.finer_segments(h, 35, 12, 10, 200)
    assert first[0] == 10 and (first[1:] == (first + many)[:-1]).all() and first[-1] + many[-1] == 210
    # windows with equal words have equal names, wherever they stand
    words = [str(x).encode() for x in range(40)]
    a = R.finer_segments(R.Hashed(words), 35, 12, 0, 6)
    b = R.finer_segments(R.Hashed([b"x", *words, b"y"]), 35, 12, 1, 6)
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
