import datetime as dt

from conftest import rows_of

from auric.llm import url_lists as U

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
EVENTS = "list string, kind string, pattern string, action string, op string, at date"
CAPTURES = "page_id long, url string, fetched_at date"


def run(spark, captures, events):
    return {r.page_id: (r.n_active, r.pattern, r.kept) for r in U.url_filter(
        spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(events, EVENTS)).collect()}


def test_entries_hold_from_addition_to_the_next_event(spark):
    events = [("a", "domain", "bad.org", "block", "add", D(10)), ("a", "domain", "bad.org", "block", "remove", D(20)),
              ("a", "domain", "bad.org", "block", "add", D(30))]
    days = {1: 9, 2: 10, 3: 19, 4: 20, 5: 29, 6: 30, 7: 300}
    got = run(spark, [(i, "http://x.bad.org/p", D(n)) for i, n in days.items()], events)
    assert {i: not v[2] for i, v in got.items()} == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True, 7: True}


def test_most_specific_entry_decides(spark):
    events = [("a", "domain", "site.org", "block", "add", D(0)), ("b", "prefix", "www.site.org/ok", "allow", "add", D(0)),
              ("c", "prefix", "www.site.org/ok/not", "block", "add", D(0)), ("d", "host", "good.site.org", "allow", "add", D(0)),
              ("e", "host", "tie.net", "allow", "add", D(0)), ("f", "host", "tie.net", "block", "add", D(0))]
    urls = ["https://www.site.org/", "https://www.site.org/ok/page?x=/ok/not", "HTTPS://U:p@WWW.SITE.ORG:80/ok/not/this#f",
            "http://good.site.org/a", "http://www.site.org/okay", "http://tie.net", "http://notsite.org/", "site.org/x"]
    got = run(spark, [(i, u, D(5)) for i, u in enumerate(urls)], events)
    assert [got[i][2] for i in range(8)] == [False, True, False, True, False, False, True, True]
    assert got[2][:2] == (3, "www.site.org/ok/not")


def test_edge_cases(spark):
    events = [("a", "domain", "bad.org", "block", "add", D(0)), ("a", "domain", "bad.org", "block", "add", D(0)),
              ("a", "domain", None, "block", "add", D(0)), ("a", "domain", "x.org", "block", "add", None),
              ("a", "odd", "y.org", "block", "add", D(0)), ("a", "domain", "z.org", "block", "add", D(1)),
              ("a", "domain", "z.org", "block", "remove", D(1))]
    captures = [(1, "http://bad.org", D(1)), (1, "http://bad.org", D(1)), (2, None, D(1)), (3, "http://bad.org", None),
                (None, "http://bad.org", D(1)), (4, "", D(1)), (5, "http://z.org", D(1)), (6, "http://bad.org/" + "a/" * 400, D(1))]
    frame = spark.createDataFrame(captures, CAPTURES)
    lists = spark.createDataFrame(events, EVENTS)
    rows = U.url_filter(frame, lists).collect()
    assert len(rows) == len(captures)
    assert sorted(str(r.page_id) for r in rows if not r.kept) == ["1", "1", "6", "None"]
    assert {r.n_active for r in rows if not r.kept} == {1}
    assert U.url_filter(frame.limit(0), lists).collect() == []
    assert all(r.kept for r in U.url_filter(frame, lists.limit(0)).collect())
    from pyspark.sql import functions as F
    extra = frame.select("*", *[F.lit(1).alias(n) for n in ("kind", "pattern", "list", "k", "kept", "n_active")])
    assert rows_of(U.url_filter(extra, lists)) == rows_of(U.url_filter(frame, lists))


def test_lists_of_the_page_table_block_and_keep(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = U.url_filter(U.dated_captures(pages), U.dated_lists(pages)).collect()
    assert len(rows) == pages.count()
    assert {r.kept for r in rows} == {True, False} and max(r.n_active for r in rows) > 1
