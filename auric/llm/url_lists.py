"""URL filters by a temporal list join.

List entries are dated events (added, removed). They become validity
intervals, and an as-of join evaluates every capture against the entries that
were active when it was fetched: an equality join on lookup keys of the URL
(its host, parent domains, and path prefixes) with the interval as condition.
The most specific active entry decides.

All of it is DataFrame operations. The captures carry only id, URL and time;
a host or parent domain that very many captures share is a join key that
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("domain", "host", "prefix")    # from the least specific to the most


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if the URL has none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)


def path_of(url: Column) -> Column:
    """Path from its first slash, without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def lookup_keys(url: Column) -> Column:
    """Array of (kind, pattern): every entry that can match a URL."""
    labels = F.split(host_of(url), r"\.", -1)
    segments = F.filter(F.split(path_of(url), "/", -1), lambda s: s != "")
    key = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    domains = F.transform(labels, lambda x, i: key("domain", F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(segments)), lambda n: key(
        "prefix", F.concat_ws("/", host_of(url), F.array_join(F.slice(segments, 1, n), "/"))))
    return F.when(host_of(url) == "", F.array().cast("array<struct<kind:string,pattern:string>>")).otherwise(
        F.concat(domains, F.array(key("host", host_of(url))), prefixes))


def validity(events: DataFrame) -> DataFrame:
    """Intervals (list, kind, pattern, action, valid_from, valid_to) from dated
    events (list, kind, pattern, action, op, at): an entry holds from its
    addition up to its next event, valid_to excluded, null if there is none. On
    one day a removal comes after an addition. Rows without a date, pattern or
    known kind are left out; repeated events change nothing.
    """
    e = (events.filter(F.col("at").isNotNull() & F.col("pattern").isNotNull() & F.col("kind").isin(*KINDS)
                       & F.col("op").isin("add", "remove"))
               .select("list", "kind", F.lower("pattern").alias("pattern"), "action", "op", "at").distinct())
    order = Window.partitionBy("list", "kind", "pattern").orderBy("at", "op", "action")
    return (e.withColumn("valid_to", F.lead("at").over(order)).filter(F.col("op") == "add")
             .select("list", "kind", "pattern", "action", F.col("at").alias("valid_from"), "valid_to")
             .filter(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))


def url_filter(captures: DataFrame, events: DataFrame, id_col: str = "page_id",
               time_col: str = "fetched_at") -> DataFrame:
    """One row per capture: page_id, url, fetched_at, n_active (entries that
    matched and were active), kind, pattern, list of the one that decides, and
    kept.

    The longest pattern of the most specific kind decides; of equal ones a
    block beats an allow, then the first list by name. Captures without an
    active entry, a URL or a time are kept. Repeated rows get a row each. Empty
    captures give no rows, empty lists keep everything. Other columns are
    dropped.
    """
    c = captures.select(F.col(id_col).alias("page_id"), "url", F.col(time_col).alias("fetched_at"))
    keyed = (c.filter(F.col("url").isNotNull() & F.col("fetched_at").isNotNull()).distinct()
              .select("page_id", "url", "fetched_at", F.explode(lookup_keys(F.col("url"))).alias("k"))
              .select("page_id", "url", "fetched_at", "k.kind", F.lower("k.pattern").alias("pattern")))
    active = keyed.join(validity(events), ["kind", "pattern"]).filter(
        (F.col("valid_from") <= F.col("fetched_at"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    blocks = (F.col("action") == "block").cast("int")
    best = F.min(F.struct((-rank).alias("r"), (-F.length("pattern")).alias("l"), (-blocks).alias("b"),
                          "list", "kind", "pattern"))
    verdict = (active.groupBy("page_id", "url", "fetched_at")
                     .agg(F.count(F.lit(1)).alias("n_active"), best.alias("e"))
                     .select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched_at").alias("f"),
                             "n_active", "e.kind", "e.pattern", "e.list", (F.col("e.b") == 0).alias("kept")))
    return (c.join(verdict, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u"))
                   & (F.col("fetched_at") == F.col("f")), "left")
             .select("page_id", "url", "fetched_at", F.coalesce("n_active", F.lit(0)).alias("n_active"),
                     "kind", "pattern", "list", F.coalesce("kept", F.lit(True)).alias("kept")))


# --- captures and list events derived from the page table ------------------------

FIRST_DAY = "2024-01-01"


def _day(days: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), days.cast("int"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """The page table has no fetch time: one is derived from the page's id."""
    return pages.select("page_id", "url", _day(F.pmod(F.col("page_id") * 37, F.lit(365))).alias("fetched_at"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """List events over the pages' own sites and sections, so the lists grow
    with the table: dated by the first page seen. Some sites are blocked, some
    of these unblocked 60 days later; some sections are allowed, some blocked."""
    p = pages.filter(host_of(F.col("url")) != "").select("page_id", host_of(F.col("url")).alias("host"),
                                                         path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.", -1)
    site = F.when(F.size(labels) > 3, F.array_join(F.slice(labels, 2, F.size(labels)), ".")).otherwise(F.col("host"))
    section = F.concat_ws("/", "host", F.lower(F.regexp_extract("path", "^/([^/]+)", 1)))

    def events(pattern: Column, kind: str, name: str, step: int, action: Column, op: str, wait: int, chosen) -> DataFrame:
        first = p.select(pattern.alias("pattern"), "page_id").groupBy("pattern").agg(F.min("page_id").alias("id"))
        return first.filter(chosen(F.col("id"))).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", action.alias("action"), F.lit(op).alias("op"),
            _day(F.pmod(F.col("id") * step, F.lit(300)) + wait).alias("at"))

    return (events(site, "domain", "sites", 11, F.lit("block"), "add", 0, lambda i: i % 3 == 0)
            .unionByName(events(site, "domain", "sites", 11, F.lit("block"), "remove", 60, lambda i: i % 6 == 0))
            .unionByName(events(section, "prefix", "sections", 7, F.when(F.col("id") % 8 == 0, "allow").otherwise("block"),
                                "add", 0, lambda i: i % 4 == 0)))
