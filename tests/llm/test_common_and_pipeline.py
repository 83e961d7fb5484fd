import importlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from conftest import make_docs, rows_of
from pyspark.sql import functions as F
from test_line_dedup import kept
from test_mixing import targets
from test_simhash import groups_of
from tokenizers import Tokenizer

from auric.llm import common as C
from auric.llm import line_dedup, mixing, packing, quality_rules, simhash

pipeline = importlib.import_module("corpus_pipeline")


def test_components_match_a_plain_search(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5000 + i) for i in range(300)] + [(-7, -9), (3, 3)]
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_are_those_of_ascii_white_space(spark):
    texts = [None, "", " a", "a b\tc\nd\x0be\x0cf\rg", "a b   c", " \n "]
    docs = make_docs(spark, list(enumerate(texts)))
    got = {r.doc_id: (r.w, r.n) for r in docs.select("doc_id", C.words(F.col("text")).alias("w"), C.n_words(F.col("text")).alias("n")).collect()}
    for i, t in enumerate(texts):
        want = [w.decode() for w in (t or "").encode().split()]
        assert got[i] == (want, len(want))


def test_pipeline_stages_against_plain_ones(spark, tmp_path):
    """Each stage of the pipeline holds its own input against the operator's
    verdicts, and the packed tokens are those of what the mix left."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "mixing", "packing"]
    inputs = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, inputs[-1], "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{k}")
        inputs.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(x.columns == docs.columns for x in inputs[:-1])
    assert rows_of(inputs[1], "doc_id") == rows_of(quality_rules.quality_rules(docs).filter("kept"), "doc_id")
    kept = {r.doc_id: r.kept_lines for r in line_dedup.line_dedup(inputs[1]).collect()}
    before = {r.doc_id: r.text for r in inputs[1].collect()}
    want = {}
    for i, text in before.items():
        stay = [x for k, x in enumerate(text.split("\n")) if k in set(kept[i]) or not x.encode().split()]
        if kept[i]:
            want[i] = "\n".join(stay)
    assert {r.doc_id: r.text for r in inputs[2].collect()} == want
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(inputs[2]).collect()}
    assert sorted(r.doc_id for r in inputs[3].collect()) == sorted(i for i, c in near.items() if i == c)
    taken, words = Counter(), Counter()
    for r in mixing.mix(inputs[3]).collect():
        taken[r.source] += r.taken
    for r in inputs[4].collect():
        words[r.source] += len(r.text.encode().split())
    assert +words == +taken
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert rows_of(inputs[5], *columns) == rows_of(packing.pack(inputs[4]), *columns)
    assert sum(r.length for r in inputs[5].collect()) == sum(
        r.doc_tokens for r in inputs[5].filter("start = 0").collect())


def measured(text):
    """The measurements that the quality rules read, one by one."""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    stripped = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}),
        "n_letter_words": sum(bool(regex.search(r"\p{L}", w)) for w in words),
        "n_letters": len(regex.findall(r"\p{L}", text)), "n_upper": len(regex.findall(r"\p{Lu}", text)),
        "n_exclamations": text.count("!"), "n_bullet_lines": sum(x[0] in "-*•" for x in stripped),
        "n_ellipsis_lines": sum(x.endswith(("...", "…")) for x in stripped)}


def plain_until_mixing(rows):
    """{doc_id: (text, source)} after quality rules, line dedup and SimHash
    near-dedup, each over all rows, all earlier lines or all pairs."""
    accepted = [r for r in rows if not any(
        eval(condition, {}, measured(r.text or "")) for _, condition in quality_rules.RULES)]
    found = {x[0]: x[3] for x in map(eval, kept([(r.doc_id, r.text) for r in accepted]))}
    texts = {}
    for r in accepted:
        if found[r.doc_id]:
            texts[r.doc_id] = "\n".join(x for k, x in enumerate(r.text.split("\n"))
                                        if k in found[r.doc_id] or not x.encode().split())
    stay = {min(d for d, _ in group) for group in groups_of(sorted(texts.items()))}
    source = {r.doc_id: r.source for r in accepted}
    return {d: (texts[d], source[d]) for d in stay}, len(accepted), len(texts)


def prose_documents(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows, shared = [], " ".join(rng.choice(vocabulary) for _ in range(14))
    for i in range(70):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(6, 20))) for _ in range(rng.randint(2, 9))]
        if i % 6 == 0:
            lines.insert(rng.randint(0, len(lines)), shared)
        rows.append((i, "\n".join(lines), f"s{i % 4}" if i % 4 else None))
    for i in range(0, 40, 4):
        # The same words on other lines: no line is like an earlier one, the SimHash is.
        words = rows[i][1].split()
        rows.append((200 + i, "\n".join(" ".join(words[k:k + 4]) for k in range(0, len(words), 4)), "s1"))
    rows += [(300, rows[3][1], "s2"), (301, "!! " * 30, "s1"), (302, None, "s1"), (303, "few words only", "s3"),
             (304, "\n".join(" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(300)), "s2")]
    return make_docs(spark, rows)


def test_run_against_a_plain_version_of_every_stage(spark, tmp_path):
    prose_documents(spark).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want, accepted, lined = plain_until_mixing(docs.collect())
    assert accepted < docs.count() and len(want) < lined - 5            # each stage has work here
    pieces = pipeline.run(spark, str(tmp_path)).collect()
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert set(starts) <= set(want)
    size = {d: len(t.encode().split()) for d, (t, _) in want.items()}
    by_source = {}
    for d, (_, source) in want.items():
        by_source.setdefault(source, []).append(d)
    share = targets({s: sum(size[d] for d in own) for s, own in by_source.items()})
    for source, own in by_source.items():
        taken = sum(size[d] * starts[d] for d in own)
        assert taken <= share[source] + 1e-6 and share[source] - taken < max(size[d] for d in own) + 1
        assert max(starts[d] for d in own) - min(starts[d] for d in own) <= 1 and max(starts[d] for d in own) <= 3
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d, copies in starts.items():
        ids = np.array(whole.encode(want[d][0], add_special_tokens=False).ids + [0], "<u4")
        cut = [(k, len(ids[k:k + 1024]), zlib.crc32(ids[k:k + 1024].tobytes())) for k in range(0, len(ids), 1024)]
        own = [p for p in pieces if p.doc_id == d]
        assert Counter((p.start, p.length, p.ids_crc32) for p in own) == {c: copies for c in cut}
        assert all(p.doc_tokens == len(ids) for p in own)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_run_deletes_its_own_tables_and_no_others(spark, tmp_path):
    import os

    prose_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    query = simhash.near_duplicates(docs)                   # opened before, read after
    mine = C.saved(docs, "mine")
    folder = C.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = pipeline.run(spark, str(tmp_path))
    assert out.count() > 0
    new = set(os.listdir(folder)) - before
    assert len(new) == 1 and next(iter(new)).startswith("pipeline-")
    assert query.count() == docs.count() == mine.count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("auric_pipeline")]


def test_scratch_deletes_what_was_written_in_it(spark):
    import os

    rows = spark.range(10)
    outside = C.saved(rows, "outside")
    with C.Scratch(spark) as outer:
        first = C.saved(rows, "first")
        with C.Scratch(spark) as inner:
            C.saved_by(rows, "second", "id", 3)
        inner.delete()
        assert first.count() == 10
    names = lambda: [n.split("-")[0] for n in os.listdir(C.shared_dir(spark).removeprefix("file:"))]
    assert "first" in names() and "second" not in names()
    outer.delete()
    assert "first" not in names() and outside.count() == 10


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_pipeline_of_nothing(spark, tmp_path, rows):
    docs = make_docs(spark, rows or [(1, "x")])
    docs = docs if rows else docs.limit(0)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.collect() == []
