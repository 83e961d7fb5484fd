import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from conftest import make_docs, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auric.llm import align
from auric.llm.mphf import MinimalHash
from auric.llm.queries import QUERIES

ALPHABET = [*"aabbcdeéßñ日本語 \n\t.,'1239  \xa0\x1c\x85 ", "the", "  ", " a", " x", "'s", "<|endoftext|>", "▁",
            "ing", "</s>", "<0x41>", "\x00", "🙂"]


@pytest.fixture(scope="module")
def plain():
    """Brute force: both tokenisers on whole texts, links by comparing ranges."""
    a = Tokenizer.from_file(public_tokenizers.path(align.FIRST))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.SECOND))
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spelt = {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in printable)}
    spelt |= {chr(x): x for x in printable}

    def one(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(spelt[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return None
        ranges = []
        for ids, spelled in ((ids_a, bytes_a), (ids_b, bytes_b)):
            ends = np.cumsum([len(x) for x in spelled]).tolist()
            ranges.append([(i, e - len(x), e) for i, x, e in zip(ids, spelled, ends)])
        links, j = [], 0
        for i, start, end in ranges[0]:
            while ranges[1][j][2] <= start:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][1] < end:
                links.append((i, ranges[1][k][0]))
                k += 1
        groups, left, right = [], list(ranges[0]), list(ranges[1])
        for cut in sorted({r[2] for r in ranges[0]} & {r[2] for r in ranges[1]}):
            sides = []
            for side in (left, right):
                n = sum(r[2] <= cut for r in side[:400])
                while n < len(side) and side[n][2] <= cut:
                    n += 1
                sides.append(",".join(str(r[0]) for r in side[:n]))
                del side[:n]
            groups.append("|".join(sides))
        return len(ids_a), len(ids_b), links, groups

    def all_of(rows):
        done = [(i, one(t)) for i, t in rows]
        count = Counter(p for _, d in done if d for p in set(d[2]))
        best = Counter()
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for i, d in done:
            if d is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
            else:
                n_a, n_b, links, groups = d
                out.append((i, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                            sum(count[p] for p in links), ";".join(groups)))
        return out
    return all_of


def test_hash_is_minimal_and_survives_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.unique(rng.integers(0, 1 << 50, n))
        hashed = MinimalHash.from_bytes(MinimalHash.build(keys).to_bytes())
        assert hashed.size == len(keys) and sorted(hashed(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 1 << 50, 1000), keys)
        assert ((hashed(others) >= -1) & (hashed(others) < max(1, len(keys)))).all()


def test_a_foreign_pair_is_an_error():
    hashed = MinimalHash.build(np.array([5, 9]))
    keys = np.empty(2, np.int64)
    keys[hashed(np.array([5, 9]))] = [5, 9]
    with pytest.raises(ValueError):
        align._index(hashed, keys, np.array([5, 7]))


def test_align_like_brute_force(spark, corpus, plain):
    rng = random.Random(6)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    docs = corpus.filter("doc_id is null or doc_id <> 300").unionByName(make_docs(
        spark, [(1000 + i, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "a b")])).repartition(5)
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    found = [tuple(r) for r in align.align(docs).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r[1] == 0 for r in want) > 20


def test_blocks_and_uncut_texts_give_the_same(spark, corpus, plain):
    pair = align.Pair.load(public_tokenizers.path(align.FIRST), public_tokenizers.path(align.SECOND), True)
    assert pair.cuts
    import pyarrow as pa
    found, at, per_text = align.chunks.whole(pa.array(["a b", None, "", "a b", " c"]))
    assert [found[i] for i in at] == [" a b", " a b", "  c"] and per_text.tolist() == [1, 0, 0, 1, 1]


def test_empty_and_clashing(spark, empty, corpus, clashing):
    assert align.align(empty).count() == 0
    more = clashing.withColumn("block", F.lit(1)).withColumn("bucket", F.lit("x"))
    assert rows_of(align.align(more)) == rows_of(align.align(corpus))


def test_only_texts_without_tokens(spark):
    found = sorted(tuple(r) for r in align.align(make_docs(spark, [(1, None), (2, ""), (3, "▁")])).collect())
    assert found == [(1, *[0] * 6, ""), (2, *[0] * 6, ""), (3, *[0] * 6, "")]


def test_query_returns_the_digests(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "")
            for r in plain([(r.doc_id, r.text) for r in docs])]
    assert sorted(tuple(r) for r in QUERIES["op13_alignment"](spark, sf).collect()) == sorted(want)
