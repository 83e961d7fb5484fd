import zlib

import numpy as np
import public_tokenizers
from conftest import make_docs, rows_of
from tokenizers import Tokenizer

from auric.llm import packing as K
from auric.llm.bytebpe import ByteBpe, mergeable


def ids_of(text):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return whole.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = [None, "", " ", "two  spaces", " lead", "trail ", "tab\there\n\nnew", "it's we're I'll 's", "ünï çödé ñ 日本 😀",
         "a <|endoftext|> b", "x" * 5000, "word " * 4000, "1234 12,5 ½ ²  nb  em \x1c sep", "a\r\nb \n c"]


def test_round_trip_of_every_document(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id")]
    pieces = K.pack(make_docs(spark, rows), with_ids=True).collect()
    for doc_id, text in dict(rows).items():
        own = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start)
        if doc_id == 3:
            own = own[:1] if len({p.start for p in own}) == 1 else own
        ids = ids_of(text)
        assert all(p.doc_tokens == len(ids) for p in own)
        assert b"".join(bytes(p.ids) for p in own) == np.array(ids, "<u4").tobytes()
        assert all(p.ids_crc32 == zlib.crc32(bytes(p.ids)) and 4 * p.length == len(p.ids) for p in own)
    assert len([p for p in pieces if p.doc_id == 3]) == 2


def test_sequences_are_gapless_and_full(corpus):
    by = {}
    for p in K.pack(corpus).collect():
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= K.LENGTH
    used = sum(length for pieces in by.values() for _, length in pieces)
    assert used / (len(by) * K.LENGTH) > 0.9


def test_first_fit_decreasing_is_that_of_a_plain_scan():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300):
        sizes = rng.integers(1, 1024, n)
        where, offset = K.first_fit_decreasing(sizes, 1024)
        bins = []
        for i in np.argsort(-sizes, kind="stable"):
            b = next((k for k, u in enumerate(bins) if u + sizes[i] <= 1024), len(bins))
            if b == len(bins):
                bins.append(0)
            assert (where[i], offset[i]) == (b, bins[b])
            bins[b] += sizes[i]


def test_groups_empty_table_and_clashing_columns(corpus, clashing, empty):
    assert K.pack(empty).collect() == []
    assert rows_of(K.pack(clashing)) == rows_of(K.pack(corpus))
    assert rows_of(K.pack(corpus, group=8), "doc_id", "start", "ids_crc32") == rows_of(
        K.pack(corpus), "doc_id", "start", "ids_crc32")


def test_copies_and_null_ids_lie_in_many_groups(spark):
    docs = make_docs(spark, [(None, "the same words again")] * 3000 + [(7, f"text {i}") for i in range(500)]).repartition(4)
    pieces = K.pack(docs).collect()
    assert len(pieces) == 3500 and sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in by.values():
        assert sum(length for _, length in own) <= K.LENGTH and sorted(own)[0][0] == 0
    assert len(by) < 40


def test_ids_of_odd_texts_are_the_whole_tokenisers(spark):
    import random
    rng = random.Random(8)
    alphabet = [*"aab é日 \n\t.,'19  \xa0\x1c", "the", "  ", " a", "'s", "<|endoftext|>", "\r\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    import pyarrow as pa
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert mergeable(path)
    whole = Tokenizer.from_file(path)
    for plain in (False, True):
        whole.encode_special_tokens = plain
        for fast in (True, False):
            flat, per_text = K.token_ids(ByteBpe(path, fast, plain), pa.array(texts))
            ends = np.cumsum(per_text)
            for text, a, b in zip(texts, ends - per_text, ends):
                assert flat[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids + [0], text


def test_a_file_whose_merges_do_not_follow_its_ids_is_not_taken_over(tmp_path):
    import json
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    with open(tmp_path / "reversed.json", "w") as f:
        json.dump(spec, f)
    assert not mergeable(str(tmp_path / "reversed.json"))


def test_a_task_holds_little_beside_its_rows(monkeypatch):
    import random
    import re

    import pyarrow as pa
    import pyspark

    def in_mb(what):
        with open("/proc/self/status") as f:
            return int(re.search(rf"{what}:\s+(\d+)", f.read())[1]) / 1024

    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(200_000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(5000)]
    batch = pa.record_batch([pa.array(range(5000)), pa.array(range(5000)), pa.array(texts)], ["doc_id", "key", "text"])
    assert batch.nbytes > 15 << 20
    path = public_tokenizers.path(K.TOKENIZER)
    ByteBpe.load(path, True, plain=False)
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda c: type("Task", (), {"partitionId": lambda s: 0})()))
    sizes, cut = [], K.token_ids
    monkeypatch.setattr(K, "token_ids", lambda t, x: sizes.append(x.nbytes) or cut(t, x))
    task = K._pieces(K.LENGTH, path, True, K.SEED, False)
    for _ in range(2):                  # the first loads what is loaded once
        K.tidy(lambda b: iter([list(task(b))[0].num_rows]))(iter([batch.slice(0, 50)])).__next__()
    with open("/proc/self/clear_refs", "w") as f:
        f.write("5")                    # the peak starts anew
    before = in_mb("VmRSS")
    assert sum(len(set(out["doc_id"].to_pylist())) for out in task(iter([batch]))) == 5000
    assert max(sizes) < 2 << 20
    assert in_mb("VmHWM") - before < 120


def test_tasks_of_both_steps_give_their_memory_back(corpus, monkeypatch):
    tidied, tidy = [], K.tidy
    monkeypatch.setattr(K, "tidy", lambda task: tidied.append(task.__qualname__.split(".")[0]) or tidy(task))
    assert K.pack(corpus).count() >= corpus.count()
    assert tidied == ["_pieces", "_packed"]


def test_chunks_as_an_array_are_those_of_a_plain_scan():
    import random

    import pyarrow as pa

    from auric.llm import chunks

    rng = random.Random(3)
    alphabet = [*"ab 日 \n\t\xa0\x1c\x85\u3000\u200b", "  ", " a", "'s"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + [None, ""]
    for lead in (False, True):
        found, at, per_text = chunks.numbered_array(pa.array(texts), lead)
        got, ends = found.take(pa.array(at)).to_pylist(), np.cumsum(per_text)
        for text, a, b in zip(texts, ends - per_text, ends):
            text = " " * (lead and bool(text)) + (text or "")
            cuts = [i for i in range(1, len(text) - 1) if text[i] == " " != text[i - 1] and not text[i + 1].isspace()]
            want = [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])] if text else []
            assert got[a:b] == want, text
    some = pa.array(["zz", " a", "", " ", "  ", " \x1c", "日", " 日", "a "], pa.large_string()).slice(1)
    assert chunks.unspaced_start(some).tolist() == [
        len(c) > 1 and c[0] == " " and not c[1].isspace() for c in some.to_pylist()]
    text, ends = chunks.joined(some)
    assert text == "".join(some.to_pylist()) and ends.tolist() == np.cumsum([len(c.encode()) for c in some.to_pylist()]).tolist()
    assert chunks.joined(some[:0])[0] == "" and not len(chunks.joined(some[:0])[1])
