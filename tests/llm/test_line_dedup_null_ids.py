from collections import defaultdict

from conftest import make_docs
from pyspark.sql import functions as F

from auric.llm import line_dedup as L

LOW = 0x7FFFFF      # the bits that once told texts of one id apart


def texts_with_equal_low_bits(spark, want=6):
    """Texts, alike in no line, whose hashes agree in their lower 23 bits."""
    many = spark.range(30000).select(F.concat_ws(
        "\n", *[F.concat_ws(" ", *[F.concat(F.lit(f"{c}{k}n"), "id") for k in range(6)]) for c in "ab"]).alias("text"))
    groups = defaultdict(list)
    for r in many.select("text", F.xxhash64("text").alias("th")).toLocalIterator():
        groups[r.th & LOW].append(r.text)
    return [t for g in groups.values() if len(g) > 1 for t in g][:want]


def test_texts_without_an_id_are_told_apart_by_their_whole_hash(spark):
    texts = texts_with_equal_low_bits(spark)
    assert len(texts) >= 4
    repeat = texts[0].split("\n")[1]
    for doc_id in (None, 7):
        docs = make_docs(spark, [(doc_id, t) for t in texts] + [(9, "of its own\n" + repeat)])
        got = sorted((r.n_lines, r.n_removed, r.kept_lines) for r in L.line_dedup(docs).collect())
        assert got == sorted([(2, 0, [0, 1])] * len(texts) + [(2, 1, [0])])
        left = sorted(r.text for r in L.without_repeats(docs).collect())
        assert left == sorted([*texts, "of its own"])
