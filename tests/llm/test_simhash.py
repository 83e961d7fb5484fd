import numpy as np
import xxhash
from conftest import make_docs, rows_of

from auric.llm import simhash as H


def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """Smallest doc_id reachable, by all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    near = [{j for j, b in enumerate(fps) if (a ^ b).bit_count() <= 4} for a in fps]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out.append(min((rows[j][0] for j in seen if rows[j][0] is not None), default=None))
    return sorted(str((r[0], f"{f:016x}", c)) for r, f, c in zip(rows, fps, out))


def digest(df):
    from pyspark.sql import functions as F

    return rows_of(df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"))


def test_matches_all_pairs(corpus):
    want = components([(r.doc_id, r.text) for r in corpus.collect()])
    assert digest(H.near_duplicates(corpus)) == want


def test_small_chunks_and_more_blocks_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(30):
            b ^= sum(1 << int(x) for x in rng.choice(64, rng.integers(1, 5), replace=False))
            fps.add(b)
    fps = sorted(fps)
    frame = spark.createDataFrame([(H._signed(x),) for x in fps], "fp long")
    array = np.array(fps, np.uint64)
    want = H.forest(len(fps), iter([np.nonzero(np.bitwise_count(array[:, None] ^ array[None]) <= 4)]))
    for chunk in (1024, 16):
        links = H.links(frame, chunk=chunk).collect()
        place = {H._signed(x): i for i, x in enumerate(fps)}
        a, b = np.array([(place[r.a], place[r.b]) for r in links]).T
        assert (np.bitwise_count(array[a] ^ array[b]) <= 64).all()
        assert (H.forest(len(fps), iter([(a, b)])) == want).all()


def test_index_finds_exactly_the_near_pairs():
    rng = np.random.default_rng(4)
    for same in (False, True):
        fp = rng.integers(0, 1 << 63, 600, dtype=np.uint64) & np.uint64(0xFFF if same else (1 << 63) - 1)
        fp = np.unique(fp)
        cell = rng.integers(0, 5, len(fp))
        order = np.lexsort((H.gray_rank(fp), cell))
        fp, cell = fp[order], cell[order]
        got = {(int(i), int(j)) for a, b in H.near_pairs(fp, cell, 4) for i, j in zip(a, b)}
        near = (np.bitwise_count(fp[:, None] ^ fp[None]) <= 4) & (cell[:, None] == cell[None])
        assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def test_block_masks_keep_every_near_pair():
    for classes in (10, 10**6, 10**8, 10**11):
        masks = H.block_masks(classes, 4)
        rng = np.random.default_rng(0)
        for _ in range(200):
            flip = sum(1 << int(x) for x in rng.choice(64, 4, replace=False))
            assert any(flip & m == 0 for m in masks)


def test_one_of_each_empty_and_clashing(spark, corpus, clashing, empty):
    assert H.near_duplicates(empty).collect() == [] and H.one_of_each(empty).collect() == []
    assert digest(H.near_duplicates(clashing)) == digest(H.near_duplicates(corpus))
    assert rows_of(H.one_of_each(clashing), *corpus.columns) == rows_of(H.one_of_each(corpus))
    assert H.one_of_each(clashing).columns == clashing.columns


def groups_of(rows):
    """Rows (doc_id, text) by component, comparing every pair of fingerprints."""
    fp = [fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = {}
    for g, row in zip(group, rows):
        out.setdefault(g, []).append(row)
    return list(out.values())


def test_one_row_of_each_group_stays(spark, corpus):
    extra = [(None, "no id at all " * 5), (None, "no id at all " * 5), (12, "same id, but a text of its own, quite another one"),
             (None, None), (900, "  ")]
    docs = corpus.unionByName(make_docs(spark, extra)).repartition(4)
    groups = groups_of([(r.doc_id, r.text) for r in docs.collect()])
    assert len(groups) < docs.count() - 10
    left = [(r.doc_id, r.text) for r in H.one_of_each(docs).collect()]
    assert len(left) == len(groups)
    for group in groups:
        kept = [row for row in left if row in group]
        ids = [d for d, _ in group if d is not None]
        assert len(kept) == 1 and kept[0][0] == (min(ids) if ids else None)


def test_copies_and_blank_texts(spark):
    docs = make_docs(spark, [(5, "a b c d e f"), (3, "A B C D E F"), (9, "  "), (8, None), (7, "other words here now")])
    got = {r.doc_id: r.component_id for r in H.near_duplicates(docs).collect()}
    assert (got[5], got[3], got[9], got[8], got[7]) == (3, 3, 8, 8, 7)
