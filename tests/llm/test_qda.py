import math
import zlib

import numpy as np
from conftest import make_docs, rows_of

from auric.llm import qda as Q


def labelled(spark, sf="/root/testdata/sf0.1"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    rows = Q.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = (rows[rows.quality == k].score.to_numpy() for k in (1, 0))
    assert (good[:, None] > bad[None]).mean() > 0.99
    assert ((rows.score >= 0.7).astype(int) == rows.quality).mean() > 0.97
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.7)).all()


def test_held_out_labels_are_never_learned_from(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, "/root/testdata/sf0.01")
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows_of(Q.classify(docs, labels)) == rows_of(Q.classify(docs.repartition(5), other))


def test_score_is_the_difference_of_gaussian_densities():
    rng = np.random.default_rng(0)
    mean, cov = rng.normal(size=(2, 3)), np.array([np.diag([1.0, 2, 3]), np.eye(3) + 0.4])
    factor = np.linalg.cholesky(cov)
    model = Q.Model(mean, np.linalg.inv(factor), -np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(1), 1.0)
    x = rng.normal(size=(20, 3))
    density = [-0.5 * np.log(np.linalg.det(c)) - 0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)
               for m, c in zip(mean, cov)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_edge_cases(spark, corpus, clashing, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 60)] + [(10, None, 0), (None, 1, 0), (12, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    got = Q.classify(corpus, labels)
    assert got.count() == corpus.count() and got.filter("score is null or held_out is null").count() == 0
    assert rows_of(Q.classify(clashing, labels)) == rows_of(got)
    assert Q.classify(empty, labels).collect() == []
    assert {r.score for r in Q.classify(corpus, labels.limit(0)).collect()} == {0.5}
    assert Q.classify(make_docs(spark, [(2, None)]), labels).first().score == 0.5


def plain_statistics(text):
    """The statistics by their definitions, byte by byte."""
    words = text.split()
    if not words:
        return [0.0] * 12
    n = len(words)
    lower = sum(97 <= b < 123 or b >= 128 for b in text)
    upper, digits = sum(65 <= b < 91 for b in text), sum(48 <= b < 58 for b in text)
    symbols, marks = sum(b in b"#*$%&|<>" for b in text), sum(b in b"!?" for b in text)
    visible = max(1, lower + upper + digits + symbols + marks)
    sizes = [len(w) for w in words]
    mean = sum(sizes) / n
    lines = [x.strip() for x in text.split(b"\n") if x.strip()]
    return [math.log(1 + n), math.log(mean), math.sqrt(sum((s - mean) ** 2 for s in sizes) / n) / mean,
            math.log(1 + 10 * min(3, symbols / n)), math.log(1 + 10 * min(3, marks / n)),
            (lower + upper) / visible, upper / visible, digits / visible,
            math.log(1 + len(set(words))) / math.log(1 + n), (len(lines) - len(set(lines))) / (len(lines) + 4),
            math.log(1 + n / max(1, len(lines))), max(words.count(w) for w in set(words)) / n if n >= 20 else 0.05]


def test_statistics_and_fit_are_those_of_plain_numpy(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.01")
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    plain = {r.doc_id: np.rint(np.array(plain_statistics((r.text or "").encode())) * Q.GRID) / Q.GRID for r in docs.collect()}
    found = {r.doc_id: np.array(r[1:]) / Q.GRID for r in Q.document_statistics(docs).collect()}
    assert set(found) == set(plain)
    assert max(np.abs(found[i] - plain[i]).max() for i in plain) <= 2 / Q.GRID
    x = [np.array([plain[i] for i, k in sorted(known.items()) if k == label and i in plain]) for label in (0, 1)]
    n = [len(c) for c in x]
    mean = [c.mean(axis=0) for c in x]
    cov = [np.cov(c.T, bias=True) for c in x]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    every = np.array([plain[i] for i in sorted(plain)])
    density = []
    for k in (0, 1):
        c = ((1 - Q.SHRINK_POOLED) * cov[k] + Q.SHRINK_POOLED * pooled) / np.outer(scale, scale)
        c = (1 - Q.SHRINK_SPHERE) * c + Q.SHRINK_SPHERE * (np.trace(c) / 12 + 1e-6) * np.eye(12)
        z = (every - mean[k]) / scale
        density.append(math.log(n[k] / sum(n)) - 0.5 * np.linalg.slogdet(c)[1]
                       - 0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(c), z))
    odds = np.clip((density[1] - density[0]) / Q.TEMPERATURE, -50, 50)
    want = dict(zip(sorted(plain), 1 / (1 + np.exp(-odds))))
    scored = Q.classify(docs, labels).collect()
    assert len(scored) == len(want) and max(abs(r.score - want[r.doc_id]) for r in scored) < 5e-3
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
