import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    """Small corpus with null and empty texts, copies, near copies, a shared
    passage, repeated lines, a very long text and a repeated row."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), prose(12)
    rows = [(None, "null id " + prose(20), "s1"), (1, None, "s1"), (2, "", None), (3, " \t\n\x0b\x0c\r ", "s2"),
            (4, "one", "s2"), (5, "one two three", "s2")]
    for i in range(10, 60):
        lines = [prose(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), line)
        rows.append((i, "\n".join(lines), f"s{i % 4}"))
    for i, r in enumerate(rows[10:20]):
        rows.append((100 + i, r[1], "s0"))                                  # copies
        words = r[1].split(" ")
        words[len(words) // 2] = "Ünïcode"
        rows.append((200 + i, " ".join(words), "s3"))                        # near copies
    rows.append((300, "\n".join(prose(30) for _ in range(400)), "s1"))       # long
    rows.append((301, "x " * 3000, "s1"))                                    # one word again and again
    rows += [(10, rows[6][1], "s2"), (11, "same id, other text " + prose(50), "s2")]  # repeated id
    return make_docs(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return make_docs(spark, [(1, "x")]).limit(0)


@pytest.fixture(scope="session")
def clashing(corpus):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("n_words", "size", "key", "fp", "found", "base", "t", "kept", "draw", "grp", "cell", "label", "score",
             "doc", "at", "th", "_doc", "_th", "_places", "places", "row", "spans", "wanted", "count", "place", "component", "window", "id")
    return corpus.select("*", *[F.lit(1).alias(n) for n in names])


def rows_of(df, *columns):
    """Rows as sorted tuples of text, so that nulls and lists compare."""
    return sorted(str(tuple(r)) for r in df.select(*columns or df.columns).collect())
