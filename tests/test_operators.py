import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tessera.operators import candidates as C
from tessera.operators import entities as E
from tessera.operators import intervals as V
from tessera.operators import relational as O


def test_first_and_last_do_not_depend_on_partitions(spark):
    rows = [(i % 7, random.Random(i).randint(0, 50), i) for i in range(500)]
    seen = set()
    for n in (1, 2, 8):
        df = spark.createDataFrame(rows, "k int, o int, v int").repartition(n)
        seen.add(str(sorted(map(tuple, O.keep_first(df, ["k"], ["o", "v"]).collect()))))
        seen.add("agg" + str(sorted(map(tuple, df.groupBy("k").agg(O.first_by("v", "o", "v"), O.last_by("v", "o", "v")).collect()))))
    assert len(seen) == 2


def test_aggregates(spark):
    df = spark.createDataFrame([(1, "b", True), (1, "a", None), (1, "b", False), (2, None, None)], "k int, s string, f boolean")
    got = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(O.text_set("s"), O.any_true("f"), O.n_distinct("s"), O.n_distinct("s", True)).collect()}
    assert got == {1: ("a|b", True, 2, 2), 2: ("", False, 0, 1)}


def test_keep_first_null_keys_and_empty(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 3)], "k int, v int")
    assert sorted(map(tuple, O.keep_first(df, ["k"], ["v"]).collect()), key=str) == [(1, 3), (None, 1)]
    assert O.keep_first(df.where("false"), ["k"], ["v"]).count() == 0


def test_union_split_fill(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(2, 5)], "k int, n int")
    assert sorted(map(tuple, O.union_all([a, b], True).collect())) == [(1, "x", None), (2, None, 5)]
    kept, gone = O.split_by(O.union_all([a, b], True), F.col("n") > 3)
    assert kept.count() == 1 and gone.count() == 1
    own = spark.createDataFrame([(1, ""), (2, None), (3, "z")], "k int, s string")
    assert sorted(map(tuple, O.filled_from(own, a, "k", ["s"]).collect())) == [(1, "x"), (2, ""), (3, "z")]


def test_sampling(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    got = O.stratified_sample(df, ["g"], 5, ["id"])
    assert sorted(r["n"] for r in got.groupBy("g").agg(F.count("*").alias("n")).collect()) == [5, 5, 5]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, O.stratified_sample(df.repartition(7), ["g"], 5, ["id"]).collect()))
    assert O.exploded_text(spark.createDataFrame([("a| |b ",)], "s string"), "s").count() == 2


def brute_stock(rows, as_of):
    out, first = {}, min((c for c, *_ in rows), default=None)
    y, m = first.year, first.month
    while date(y, m, 1) <= as_of:
        d = date(y, m, 1)
        for c, t, kind, tags in rows:
            if c <= d and (t is None or t > d):
                for cell in [("kind", kind or V.UNKNOWN), ("vintage_year", str(c.year)), *(("tags", x.strip()) for x in (tags or "").split("|") if x.strip())]:
                    out[d.isoformat(), *cell] = out.get((d.isoformat(), *cell), 0) + 1
        y, m = y + m // 12, m % 12 + 1
    return out


def test_active_stock_cases(spark):
    rows = [
        (date(2001, 1, 1), None, "a", "x|y"), (date(2001, 1, 15), date(2001, 3, 1), "a", " x |"), (date(2001, 2, 1), date(2001, 3, 2), "b", None),
        (date(2001, 2, 3), date(2001, 2, 20), "", "y"), (date(2002, 1, 1), None, None, "y"), (date(2009, 1, 1), None, "late", "z"),
    ]
    df = spark.createDataFrame([(str(c), str(t) if t else "", k, g) for c, t, k, g in rows] + [("", "", "q", "q"), ("2001-1-1", "", "q", "q")], "creation_date string, termination_date string, kind string, tags string")
    got = V.stock_by_date(df, F.to_date(F.lit("2002-03-15")), ["kind"], ["tags"]).collect()
    assert {tuple(r)[:3]: r["count"] for r in got} == brute_stock(rows, date(2002, 3, 15))
    assert {r["group_value"]: r["rank"] for r in got if r["dimension"] == "vintage_year"} == {"2001": 2001, "2002": 2002}
    assert {r["group_value"]: r["rank"] for r in got if r["dimension"] == "kind"}["a"] == 1
    assert V.stock_by_date(df.where("false"), F.to_date(F.lit("2002-03-15")), ["kind"]).count() == 0


def test_status_rules(spark):
    d = "2010-06-15"
    cases = [
        ("2010-06-16", "", "", "Ongoing", None), ("", "", "", "Ongoing", None), ("2010-06-15", "", "", "Ongoing", "Ongoing"), ("2009-01-01", "2010-06-14", "", "x", "Terminated"), ("2009-01-01", "2010-06-15", "", "x", "Terminated"),
        ("2009-01-01", "2010-06-16", "", "Terminated", "Ongoing"), ("2009-01-01", "", "2010-01-01", "Terminated", "Unknown"), ("2009-01-01", "", "2010-06-14", "Unknown", "Unknown"), ("2009-01-01", "", "2010-06-15", "Unknown", "Ongoing"), ("2009-01-01", "", "", "Unknown", "Unknown"),
    ]
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, creation_date string, termination_date string, last_event_date string, status string")
    got = {r["i"]: r["as_of_status"] for r in V.status_as_of(df, F.to_date(F.lit(d))).collect()}
    assert got == {i: c[4] for i, c in enumerate(cases) if c[4]}


HITS = "adsh string, primary_doc string, ciks array<string>, form string, file_type string, display_names array<string>, file_date string, snippet string"


def test_candidate_union(spark):
    a = spark.createDataFrame([("1", "d1", ["5"], "8-K", "EX-10.1", ["A"], "2001-01-02", None), ("1", None, ["5"], "8-K", None, ["A"], "2001-01-02", None)], HITS)
    b = spark.createDataFrame([("1", "d1", ["5"], "10-K", "EX-10.1", ["B"], "2001-01-01", None), ("1", "d2", ["6"], "8-K", "EX-101", [], "2001-01-03", "s")], HITS)
    got = {(r["adsh"], r["primary_doc"]): r for r in C.candidate_union({"p2": a, "p1": b}).collect()}
    assert set(got) == {("1", "d1"), ("1", None), ("1", "d2")}
    assert got["1", "d1"]["form"] == "8-K" and got["1", "d1"]["phrase_variants_matched"] == "p1|p2"
    kept, dropped = C.of_type(C.candidate_union({"p2": a, "p1": b}))
    assert kept.count() == 1 and {r["file_type"] for r in dropped.collect()} == {None, "EX-101"}
    rows = C.manifest(C.candidate_union({"p2": a, "p1": b})).collect()
    assert all(v is not None for r in rows for v in r) and {r["cik"] for r in rows} == {"0000000005", "0000000006"}


def test_net_new_and_append(spark):
    a, b = spark.createDataFrame([("1", "x"), ("1", None), ("2", "y")], "adsh string, primary_doc string"), spark.createDataFrame([("1", "x"), ("3", None)], "adsh string, primary_doc string")
    assert sorted(map(str, map(tuple, C.net_new(a, [b]).collect()))) == ["('1', None)", "('2', 'y')"]
    two = C.appended(a.withColumn("file_date", F.lit("d")), b.withColumn("file_date", F.lit("d")))
    assert two.count() == 4


def test_master_list_threshold(spark):
    schema = "adsh string, primary_doc string, ciks array<string>, form string, display_names array<string>, file_date string"
    token = spark.createDataFrame([(f"t{i}", "d", ["1"], "10-K", ["A"], "2001") for i in range(3)] + [(f"u{i}", "d", ["2"], "424B3", ["B"], "2001") for i in range(2)] + [("u0", "e", ["2"], "10-K", ["B"], "2001"), ("w", "d", ["12345678901"], None, ["C"], "2001"), ("w2", "d", [], "10-K", [], "2001")], schema)
    phrase = spark.createDataFrame([("p", "d", ["3", "1"], None, ["C"], "2002")], schema)
    prior = spark.createDataFrame([("0000000003",)], "cik string")
    got = {r["cik"]: r for r in E.master_list(E.entity_rows(phrase, "phrase"), E.entity_rows(token, "token"), prior).collect()}
    assert set(got) == {"0000000001", "0000000003"}
    one, three = got["0000000001"], got["0000000003"]
    assert (one["total_hits"], one["forms_touched"], one["display_name"], one["in_phrase_query"], one["in_token_query"], one["in_deferred_csv"]) == (4, "10-K", "C", True, True, False)
    assert (three["in_token_query"], three["in_deferred_csv"], three["forms_touched"]) == (False, True, "")


@pytest.mark.parametrize(("docs", "want"), [([("10-K", "body.htm")], "body-only"), ([("S-1", "ex10-1.htm")], "exhibit-only"), ([("10-K", "b"), ("8-K", "x/dex10.htm")], "both"), ([("S-1", "b")], None)])
def test_signal_class(spark, docs, want):
    df = spark.createDataFrame([(f"a{i}", d, ["1"], f, ["N"], "2001") for i, (f, d) in enumerate(docs)], "adsh string, primary_doc string, ciks array<string>, form string, display_names array<string>, file_date string")
    got = [r["signal_class"] for r in E.refined_master(df, spark.createDataFrame([], "cik string")).collect()]
    assert got == ([want] if want else [])
