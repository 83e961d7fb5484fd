import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import make_docs, rows_of
from pyspark.sql import functions as F

from auric.llm import bpe, chunks
from auric.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.TOKENIZER)
ALPHABET = [*"aabbcdeéßñ日本語 \n\t.,'1239  \xa0\x1c\x85 ", "the", "  ", " a", " x", "'s", "<|endoftext|>", "▁", "ing"]


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_replay_gives_the_library_s_ids(plain):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü'") for _ in range(rng.randint(1, 400))).encode()
             for _ in range(500)]
    ids, per_word = bpe.Vocabulary.load(PATH).encode_words(words)
    ends = np.cumsum(per_word)
    for word, a, b in zip(words, ends - per_word, ends):
        assert ids[a:b].tolist() == plain._encode_single_piece(word)


class Toy(bpe.Vocabulary):
    """Ranks made to bring a lower rank after a higher merge."""

    def __init__(self, more):
        self.ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate(more)}
        self.spelled = {b: a for a, b in self.ranks.items()}
        self.of_byte = list(range(256))
        self._merged = {}


def one_at_a_time(vocabulary, word):
    if word in vocabulary.ranks:
        return [vocabulary.ranks[word]]
    tokens = [vocabulary.ranks[bytes([b])] for b in word]
    while True:
        pairs = [(vocabulary.merged(a, b), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))]
        pairs = [p for p in pairs if p[0] >= 0]
        if not pairs:
            return tokens
        rank, i = min(pairs)
        tokens[i:i + 2] = [rank]


def test_lower_ranks_that_appear_late_go_first():
    rng = random.Random(3)
    for _ in range(300):
        more = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(12)})
        rng.shuffle(more)
        toy = Toy(more)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14))) for _ in range(20)]
        ids, per_word = toy.encode_words(words)
        ends = np.cumsum(per_word)
        for word, a, b in zip(words, ends - per_word, ends):
            assert ids[a:b].tolist() == one_at_a_time(toy, word), (more, word)


def test_chunks_spell_the_texts():
    texts = noise(4, 3000, 50) + ["", None, " ", "  a", "a "]
    for lead in (False, True):
        found, at, per_text = chunks.numbered(pa.array(texts), lead)
        ends = np.concatenate(([0], np.cumsum(per_text)))
        for i, text in enumerate(texts):
            want = (" " + text if lead else text) if text else ""
            assert "".join(found[k] for k in at[ends[i]:ends[i + 1]]) == want
    numbers = np.array([0, 1, 255, 256, 70000, 2**32 - 1])
    assert chunks.unpacked(chunks.packed(numbers)).tolist() == numbers.tolist()
    assert len(chunks.unpacked(chunks.packed(numbers[:0]))) == 0


def test_encode_and_decode_like_the_library(spark, corpus, plain):
    texts = noise(5, 2000, 80)
    docs = corpus.unionByName(make_docs(spark, [(1000 + i, t) for i, t in enumerate(texts)])).repartition(5)
    out = bpe.decode(bpe.encode(docs)).collect()
    found = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in out)
    want = sorted((str(r.doc_id), np.array(plain.encode_ordinary(r.text or ""), "<u4").tobytes(),
                   (r.text or "").encode()) for r in docs.collect())
    assert found == want
    assert rows_of(bpe.encode(docs, decoded=True)) == rows_of(bpe.decode(bpe.encode(docs)))


def test_small_blocks_give_the_same(spark, corpus, monkeypatch):
    rows = pa.RecordBatch.from_pylist([{"text": t} for t in ["a" * 50, None, "b" * 500, "", "c"] * 5])
    parts = list(chunks.blocks(iter([rows, rows.slice(0, 0), rows]), limit=64))
    assert [x for p in parts for x in p["text"].to_pylist()] == rows["text"].to_pylist() * 2
    assert len(parts) > 5


def test_empty_and_clashing(spark, empty, clashing, corpus):
    assert bpe.decode(bpe.encode(empty)).count() == 0
    more = clashing.withColumn("block", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(2))
    assert rows_of(bpe.encode(more)) == rows_of(bpe.encode(corpus))


def test_query_returns_the_digests(spark, plain):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op12_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = plain.encode_ordinary(r.text or "")
        assert found[r.doc_id].n_tokens == len(ids)
        assert found[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
