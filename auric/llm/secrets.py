"""Secret scan: fixed patterns plus sliding-window entropy, on whole texts.

Three fixed kinds (assign, access, hex) are regular-expression matches. The
entropy kinds look at candidate strings, the runs of a character class, and
slide a window over each. The Shannon entropy of a window is kept by
incremental counts: one character enters, one leaves, and the sum of
``c * log2(c)`` changes by two table lookups. Windows over the threshold are
merged into spans. An allow list suppresses candidates that only look random,
and the windows that touch a known harmless part of one; a window that lies in
a fixed match is suppressed as known.

All of it is DataFrame expressions on one row: no shuffle, no Python worker.
Sums are whole numbers (``c * log2(c)`` scaled by 2**20), so every engine and
every order of evaluation agrees on which windows pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.common import let

# Fixed patterns: kind, pattern, group whose length counts, least length.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
BASE = (("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))

SCALE = 1 << 20


@dataclass(frozen=True)
class EntropyClass:
    """A character class whose runs are candidates."""

    kind: str
    alphabet: str
    pattern: str            # a run of the class
    window: int             # characters in the sliding window
    bits: float             # least Shannon entropy of a window, in bits

    def table(self) -> list[int]:
        """``c * log2(c)`` for each count c, scaled to a whole number."""
        return [0] + [round(c * math.log2(c) * SCALE) for c in range(1, self.window + 2)]

    def most(self) -> int:
        """Largest sum of ``c * log2(c)`` that still reaches ``bits``:
        H = log2(W) - sum / W."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * SCALE)


DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    EntropyClass("entropy_base64", UPPER + UPPER.lower() + DIGITS + "+/=_-",
                 r"[A-Za-z0-9+/=_-]{20,}", 20, 3.7),
    EntropyClass("entropy_upper_hex", DIGITS + "ABCDEF", r"[0-9A-F]{16,}", 16, 3.0),
)

# Candidates that are no secrets as a whole.
ALLOW = (
    r"^[A-Za-z]?[a-z]*$",                                          # one word
    r"^[A-Z]+$",                                                   # one word in capitals
    r"^([A-Za-z][a-z]*|[A-Z]+)([-_/=+]+([A-Za-z][a-z]*|[A-Z]+))+[-_/=+]*$",  # joined words, paths
    r"^[0-9+/=_-]+$",                                              # numbers, dates, rules
)
# Parts of candidates that are none: identifiers, documentation values. Windows
# that touch one are suppressed, the rest of the candidate is not.
ALLOW_PARTS = (r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
               r"|EXAMPLE|example|abcdefghij|ABCDEFGHIJ|0123456789")


def _prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Sums of all earlier elements, for each element. Two levels, so that a
    text with very many matches costs no square of their number."""
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda x, y: x + y)

    def of(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / block).cast("int")),
                             lambda b: total(F.slice(a, b * block + 1, block)))
        starts = let(blocks, lambda s: F.aggregate(
            s, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))
        return let(starts, lambda st: F.transform(a, lambda x, i: (
            F.get(st, F.floor(i / block).cast("int"))
            + total(F.slice(a, i - i % block + 1, i % block)))))

    return let(lengths, of)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, hit, part),
    positions in code points, ``part`` the text of ``group``."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,part:string>>")

    def located(hits: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        # gap_0 hit_0 gap_1 hit_1 ...: a hit starts after all gaps so far and all hits before
        return let(F.arrays_zip(hits.alias("hit"), parts.alias("part"), between.alias("gap"),
                                _prefix_sums(between).alias("gaps"),
                                _prefix_sums(F.transform(hits, lambda h: F.length(h).cast("long"))).alias("before")),
                   lambda z: F.transform(F.slice(z, 1, F.size(hits)), lambda m: F.struct(
                       (m["gaps"] + m["gap"] + m["before"]).alias("start"),
                       (m["gaps"] + m["gap"] + m["before"] + F.length(m["hit"])).alias("end"),
                       m["hit"].alias("hit"), m["part"].alias("part"))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda hits: F.when(F.size(hits) == 0, empty).otherwise(located(hits)))


def entropy_spans(candidate: Column, start: Column, cls: EntropyClass, muted: Column) -> Column:
    """Merged spans of the windows of ``candidate`` whose entropy reaches the
    threshold, shifted by ``start``. One pass with incremental counts. ``muted``:
    array of (low, high), first characters of windows that do not count."""
    none = F.lit(-1).cast("long")
    table = F.array(*[F.lit(x).cast("long") for x in cls.table()])
    codes = F.transform(F.split(candidate, "", -1), lambda ch: F.instr(F.lit(cls.alphabet), ch) - 1)
    span = lambda a, b: F.array(F.struct((start + a).alias("start"), (start + b).alias("end")))
    w = cls.window

    def scan(code: Column, tab: Column, quiet: Column) -> Column:
        first = F.struct(
            F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("sum"), none.alias("open"), none.alias("close"),
            F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

        def step(acc: Column, i: Column) -> Column:
            enter, leave = F.get(code, i), F.when(i >= w, F.get(code, i - w))
            c_in, c_out = F.get(acc["counts"], enter), F.get(acc["counts"], leave)
            up = F.get(tab, c_in + 1) - F.get(tab, c_in)
            down = F.get(tab, c_out - 1) - F.get(tab, c_out)   # null while the window fills
            zero = F.lit(0).cast("long")
            total = acc["sum"] + F.when(leave == enter, zero).otherwise(up + F.coalesce(down, zero))
            counts = F.transform(acc["counts"], lambda c, j: (
                c + F.when(j == enter, 1).otherwise(0) - F.when(j == leave, 1).otherwise(0)))

            def settle(s: Column) -> Column:
                at, to = (i - w + 1).cast("long"), (i + 1).cast("long")
                passes = (i >= w - 1) & (s <= cls.most()) & ~F.exists(
                    quiet, lambda q: (q["low"] <= at) & (at <= q["high"]))
                joins = passes & (acc["open"] >= 0) & (at <= acc["close"])
                return F.struct(
                    counts.alias("counts"), s.alias("sum"),
                    F.when(passes & ~joins, at).otherwise(acc["open"]).alias("open"),
                    F.when(passes, to).otherwise(acc["close"]).alias("close"),
                    F.when(passes & ~joins & (acc["open"] >= 0),
                           F.concat(acc["spans"], span(acc["open"], acc["close"])))
                     .otherwise(acc["spans"]).alias("spans"))

            return let(total, settle)

        return F.aggregate(
            F.sequence(F.lit(0), F.size(code) - 1), first, step,
            lambda acc: F.when(acc["open"] >= 0, F.concat(acc["spans"], span(acc["open"], acc["close"])))
                         .otherwise(acc["spans"]))

    return let(codes, lambda code: let(table, lambda tab: let(muted, lambda quiet: scan(code, tab, quiet))))


def _allowed(candidate: Column, allow: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for pattern in allow:
        hit = hit | candidate.rlike(pattern)
    return hit


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                classes: tuple[EntropyClass, ...] = CLASSES,
                allow: tuple[str, ...] = ALLOW, allow_parts: str = ALLOW_PARTS) -> DataFrame:
    """One row per document: (doc_id, found), found being an array of
    (start, kind_no, kind, end) in order of start, then kind.

    Fixed kinds always stay. Entropy spans are added: windows over the
    threshold, but those of a candidate on the allow list, those that touch one
    of its ``allow_parts``, and those that lie wholly in a fixed match; what is
    left of a candidate still counts. Null text counts as empty. Repeated rows get a row each; an empty table gives no rows; other
    columns are dropped.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    t = F.col("text")
    kinds = []
    for no, (kind, pattern, group, least) in enumerate(BASE):
        m = matches(t, pattern if group else _long(pattern, least), group)
        kinds.append(F.transform(F.filter(m, _at_least(least)), _as_span(no, kind)))
    d = d.withColumn("base", F.array_sort(F.concat(*kinds)))
    added = []
    for no, cls in enumerate(classes, len(BASE)):
        candidates = F.filter(matches(t, cls.pattern), lambda x: ~_allowed(x["hit"], allow))
        found = let(F.col("base"), lambda base: F.flatten(F.transform(candidates, _spans_by(cls, base, allow_parts))))
        added.append(F.transform(found, _as_span(no, cls.kind)))
    return d.select("doc_id", "base", F.array_sort(F.concat(F.col("base"), *added)).alias("found"))


def _at_least(least: int):
    return lambda x: F.length(x["part"]) >= least


def _as_span(no: int, kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("kind_no"),
                              F.lit(kind).alias("kind"), x["end"].alias("end"))


def _spans_by(cls: EntropyClass, base: Column, allow_parts: str):
    def found(x: Column) -> Column:
        low_high = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
        inside = F.transform(
            F.filter(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
            lambda b: low_high(b["start"] - x["start"], b["end"] - x["start"] - cls.window))
        touching = F.transform(matches(x["hit"], allow_parts),
                               lambda m: low_high(m["start"] - (cls.window - 1), m["end"] - 1))
        return entropy_spans(x["hit"], x["start"], cls, F.concat(inside, touching))
    return found


def _long(pattern: str, least: int) -> str:
    """A run pattern that only matches runs of at least ``least`` characters;
    for these patterns the same matches as filtering afterwards."""
    fixed = {"AKIA[A-Z0-9]+": 4, "[0-9a-f]+": 0}[pattern]
    return f"{pattern[:-1]}{{{least - fixed},}}"


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(scan: DataFrame) -> DataFrame:
    """The scan as counts per fixed kind, a hash of the fixed spans, all spans."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return scan.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"))
