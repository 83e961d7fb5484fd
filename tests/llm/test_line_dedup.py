import math

from conftest import make_docs, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auric.llm import line_dedup as L


def kept(rows):
    """All earlier lines, one by one."""
    order = sorted({(r[0] if r[0] is not None else -math.inf, r[1] or "") for r in rows},
                   key=lambda r: r[0])
    seen, out = [], {}
    for doc_id, text in order:
        places, n = [], 0
        for k, line in enumerate(text.split("\n")):
            words = frozenset(line.encode().split())
            if not words:
                continue
            n += 1
            if not any(9 * len(words & s) >= 4 * (len(words) + len(s)) for s in seen):
                places.append(k)
            seen.append(words)
        out[doc_id, text] = (n, n - len(places), places)
    return sorted(str((r[0], *out[r[0] if r[0] is not None else -math.inf, r[1] or ""])) for r in rows)


def test_matches_brute_force(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect() if r.doc_id != 11]    # one text per id
    docs = corpus.filter("doc_id is null or doc_id <> 11")
    assert rows_of(L.line_dedup(docs)) == kept(rows)
    assert rows_of(L.line_dedup(docs, chunk=3)) == kept(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abcdefghij"), min_size=0, max_size=9), min_size=1, max_size=40))
def test_matches_brute_force_on_tight_vocabularies(spark, lines):
    rows = [(i, "\n".join(" ".join(x) for x in lines[i:i + 4])) for i in range(0, len(lines), 4)]
    assert rows_of(L.line_dedup(make_docs(spark, rows), chunk=2)) == kept(rows)


def test_near_copies_later_lines_go(spark):
    words = [f"w{i}" for i in range(20)]
    texts = [" ".join(words), " ".join(["x", *words[1:]]), " ".join(words[::-1]) + "\n\nnew line here", "a\nb\n a "]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_lines) for r in L.line_dedup(make_docs(spark, list(enumerate(texts)))).collect()}
    assert got == {0: (1, 0, [0]), 1: (1, 1, []), 2: (2, 1, [2]), 3: (3, 1, [0, 1])}


def test_texts_without_repeats_empty_and_clashing(spark, corpus, clashing, empty):
    assert L.line_dedup(empty).collect() == [] and L.without_repeats(empty).collect() == []
    assert rows_of(L.line_dedup(clashing)) == rows_of(L.line_dedup(corpus))
    docs = make_docs(spark, [(1, "a b\n\nc d\na b"), (2, "c d"), (3, None), (4, "c d\ne f")])
    left = L.without_repeats(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()} == {1: ("a b\n\nc d", 8), 3: (None, 0), 4: ("e f", 3)}
