"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``fail_bits`` integer (bit i set: rule i fails). Policies are named
versions: a mask of the rules that reject. Applying a policy, or asking what
a policy without one rule would keep, then needs only bitwise operations on
the ledger and never reads a text again.

All of it is DataFrame expressions on one row: no shuffle, no Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Rules in bit order: (name, SQL condition on the measurements under which it
# fails). Whole-number arithmetic, so that every engine agrees.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("few_letter_words", "2 * n_letter_words < n_words"),
    ("upper_case", "n_letters >= 20 and 10 * n_upper > 4 * n_letters"),
    ("exclamations", "2 * n_exclamations > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("bullet_lines", "n_lines >= 4 and 10 * n_bullet_lines > 9 * n_lines"),
    ("ellipsis_lines", "n_lines >= 4 and 10 * n_ellipsis_lines > 3 * n_lines"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version: which rules reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in set(self.rules) | set(BASE))


POLICIES = (
    Policy("base", BASE),
    Policy("v1", tuple(name for name, _ in RULES if name not in ("bullet_lines", "ellipsis_lines"))),
    Policy("v2", tuple(name for name, _ in RULES)),
)
CURRENT = "v2"


def _repeat_words(w: Column) -> Column:
    """Number of words inside 5-word windows that occur twice or more.

    Windows are compared by 64-bit hashes of their words. Documents without a
    repeated window (a distinct count tells) skip the sort.
    """
    hashes = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(ordered, lambda s: F.filter(
            F.transform(s, lambda x, k: F.when(
                (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull()))
        # each window covers up to the next repeated one, the last all of its words
        return let(F.sort_array(repeated), lambda at: F.aggregate(
            F.transform(at, lambda x, k: F.least(
                F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, x: a + x))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h))
               .otherwise(F.lit(0))).cast("long")


def _count(condition: Column) -> Column:
    return F.size(condition).cast("long")


def _only(text: Column, others: str) -> Column:
    """Number of code points left when runs of ``others`` are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row of measurements per document, in one pass over the text.

    Null text counts as empty. Other columns are dropped unless in ``keep``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("_t"),
                    words(F.col(text_col)).alias("_w"), lines.alias("_l"))
    t, w, ln = F.col("_t"), F.col("_w"), F.col("_l")
    return d.select(
        "doc_id", *keep,
        _count(w).alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        _only(t, f"[^{SYMBOLS}]+").alias("n_symbols"),
        _count(ln).alias("n_lines"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        _count(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_letter_words"),
        _only(t, r"[^\p{L}]+").alias("n_letters"),
        _only(t, r"[^\p{Lu}]+").alias("n_upper"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
        _count(F.filter(ln, lambda x: F.btrim(x, F.lit(SPACES)).rlike(r"^[-*•]"))).alias("n_bullet_lines"),
        _count(F.filter(ln, lambda x: F.btrim(x, F.lit(SPACES)).rlike(r"(\.\.\.|…)$"))).alias("n_ellipsis_lines"))


def ledger(measures: DataFrame) -> DataFrame:
    """The measurements with ``fail_bits``: every rule evaluated once."""
    bits = None
    for name, condition in RULES:
        bit = F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measures.withColumn("fail_bits", bits)


def kept_by(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def policy(version: str) -> Policy:
    return next(p for p in POLICIES if p.version == version)


def quality_rules(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """Ledger rows with ``base_failed`` and the verdict ``kept`` of a policy.

    Null text is an empty text (0 words, so it fails few_words). Repeated rows
    get a row each; a null doc_id stays null. An empty table gives no rows.
    """
    base = policy("base")
    return (ledger(measure(docs))
            .withColumn("base_failed", ~kept_by(base))
            .withColumn("kept", kept_by(policy(version))))


def accepted(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """``docs`` (all columns) that the policy keeps."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    return (ledger(measure(whole, keep=("_row",))).filter(kept_by(policy(version)))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))


def ablations(ledger_rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: documents that fail the rule,
    and documents that only this rule rejects (a policy without it keeps them).

    The ledger is first reduced to one count per bit pattern, so the rest
    works on at most as many rows as there are patterns.
    """
    patterns = ledger_rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    masks = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
                               F.lit(BIT[name]).cast("long").alias("bit"),
                               F.lit(p.mask).cast("long").alias("mask"))
                      for p in policies for name, _ in RULES if BIT[name] & p.mask])
    x = patterns.select("fail_bits", "n", F.explode(masks).alias("p"))
    failed = F.col("fail_bits").bitwiseAND(F.col("p.bit")) != 0
    only = F.col("fail_bits").bitwiseAND(F.col("p.mask")) == F.col("p.bit")
    return (x.groupBy("p.version", "p.rule")
             .agg(F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
                  F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only")))
