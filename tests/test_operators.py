"""Operators against brute force on small frames, hot keys included."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverledger.operators import active, asof, lookup, merge, ordering, quality, upsert, windows

D, T = dt.date, dt.datetime


def test_asof_matches_brute_force(spark):
    """Two thirds of the payments share one currency and a third share one day."""
    rng = random.Random(7)
    rates = [(c, T(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 200)), Decimal(rng.randrange(1, 99))) for c in (2, 3) for _ in range(40)]
    pays = [(i, 2 if i % 3 else 3, T(2024, 3, 5, 12) if i % 3 == 1 else T(2023, 12, 20) + dt.timedelta(hours=rng.randrange(24 * 300)))
            for i in range(600)] + [(9999, 7, T(2024, 5, 5)), (10000, None, T(2024, 5, 5)), (10001, 2, None)]
    best = {}
    for c, t, r in rates:
        best[c, t] = max(r, best.get((c, t), r))

    def expect(c, t):
        known = [(d, r) for (cc, d), r in best.items() if cc == c and t is not None and d <= t]
        return max(known)[1] if known else None

    rdf = spark.createDataFrame(rates, "val_type int, kurs_date timestamp_ntz, kurs decimal(15,6)")
    pdf = spark.createDataFrame(pays, "id int, cur int, t timestamp_ntz")
    got = asof.with_rate(pdf, rdf, "cur", "t").collect()
    assert len(got) == len(pays)
    assert {r.id: r.rate for r in got} == {i: expect(c, t) for i, c, t in pays}


def test_asof_same_by_shuffle_and_broadcast(spark):
    rates = spark.range(400).select(
        (F.col("id") % 2 + 2).cast("int").alias("val_type"),
        F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") / 2).cast("int")).alias("kurs_date"),
        F.col("id").cast("decimal(15,6)").alias("kurs"),
    )
    rows = spark.range(3000).select(
        "id", (F.col("id") % 2 + 2).cast("int").alias("cur"), F.date_add(F.lit(D(2020, 1, 5)), (F.col("id") % 250).cast("int")).alias("t")
    )
    want = asof.with_rate(rows, rates, "cur", "t").agg(F.sum("rate"), F.count("*")).first()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert asof.with_rate(rows, rates, "cur", "t").agg(F.sum("rate"), F.count("*")).first() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_asof_without_rates(spark):
    rates = spark.createDataFrame([], "val_type int, kurs_date date, kurs decimal(15,6)")
    rows = spark.createDataFrame([(1, 2, D(2024, 1, 1))], "id int, cur int, t date")
    assert [tuple(r) for r in asof.with_rate(rows, rates, "cur", "t").collect()] == [(1, 2, D(2024, 1, 1), None)]


def month_ends(first, last):
    out, d = [], D(first.year, first.month, 1)
    while d <= last:
        nxt = D(d.year + (d.month == 12), d.month % 12 + 1, 1)
        out.append(nxt - dt.timedelta(days=1))
        d = nxt
    return out


def test_active_balance_matches_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        start = T(2019, 1, 31) + dt.timedelta(hours=rng.randrange(24 * 900))
        end = None if i % 5 == 0 else start + dt.timedelta(hours=rng.randrange(24 * 200))
        rows.append((("a" if i % 3 else "b"), start, end, None if i % 50 == 0 else Decimal(i)))
    edges = [
        ("e", T(2020, 1, 31), T(2020, 3, 31), Decimal(1)),  # end on a month end is not active there
        ("e", T(2020, 1, 31, 10), None, Decimal(10)),  # intraday start on the last day counts from February
        ("e", T(2020, 5, 2), T(2020, 5, 20), Decimal(100)),  # never open at a month end
        ("e", None, None, Decimal(1000)),
        ("e", T(2031, 1, 1), None, Decimal(10000)),  # after the calendar
        ("e", T(2010, 1, 1), T(2019, 1, 15), Decimal(100000)),  # over before the calendar
        ("e", T(2010, 1, 1), T(2019, 6, 15), Decimal(7)),  # started before the calendar
    ]
    rows += edges
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, amt decimal(22,4)")
    first_row = spark.createDataFrame([(T(2019, 1, 31, 5),)], "s timestamp_ntz")
    last = D(2021, 12, 31)
    got = active.active_balance(df, "s", "e", "amt", ["k"], active.first_month(first_row, "s"), last).collect()
    want = defaultdict(lambda: [Decimal(0), 0])
    for k, s, e, amt in rows:
        for m in month_ends(D(2019, 1, 1), last):
            midnight = T(m.year, m.month, m.day)
            if s is not None and s <= midnight and (e is None or e > midnight):
                want[k, m][0] += amt or 0
                want[k, m][1] += 1
    assert {(r.k, r.report_month): [r.amount, r.n_open] for r in got} == dict(want)
    assert len(got) == len(want)


def test_month_spine(spark):
    df = spark.createDataFrame([(T(2020, 11, 30, 23),), (T(2021, 5, 1),)], "s timestamp_ntz")
    assert sorted(r[0] for r in active.month_spine(df, "s", D(2021, 2, 28)).collect()) == [
        D(2020, 11, 30), D(2020, 12, 31), D(2021, 1, 31), D(2021, 2, 28)]
    assert active.month_spine(df, "s", D(2020, 1, 31)).count() == 0
    assert active.month_spine(df.filter("false"), "s", D(2021, 1, 31)).count() == 0


def test_merge_measures_null_keys(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 5)], "k string, v int")
    b = spark.createDataFrame([("y", 10), (None, 20), ("x", None)], "k string, v int")
    sources = [(a, {"p": F.col("v")}), (b, {"q": F.col("v")})]
    zero = sorted((tuple(r) for r in merge.merge_measures(sources, ["k"]).collect()), key=str)
    assert zero == sorted([("x", 3, 0), ("y", 0, 10), (None, 0, 0)], key=str)
    own = sorted((tuple(r) for r in merge.merge_measures(sources, ["k"], "separate").collect()), key=str)
    assert own == sorted([("x", 3, 0), ("y", 0, 10), (None, 5, 0), (None, 0, 20)], key=str)
    with pytest.raises(ValueError):
        merge.merge_measures(sources, ["k"], "other")


def test_merge_measures_is_one_shuffle(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frames = [(spark.range(10).withColumnRenamed("id", "k"), {f"m{i}": F.lit(1)}) for i in range(5)]
        plan = merge.merge_measures(frames, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_spine_and_categories(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    assert sorted(str(r.k) for r in merge.key_spine([a, a], ["k"]).collect()) == ["None", "x"]
    out = merge.expand_categories(a, {"one": F.col("v"), "two": F.col("v") * 2}, "c", "w").collect()
    assert sorted((r.v, r.c, r.w) for r in out) == [(1, "one", 1), (1, "two", 2), (2, "one", 2), (2, "two", 4)]


def test_change_from_previous_available_row(spark):
    df = spark.createDataFrame(
        [("A", D(2024, 1, 1), 5), ("A", D(2024, 3, 1), 7), ("A", D(2024, 4, 1), None), ("A", D(2024, 5, 1), 1)], "s string, m date, v int"
    )
    got = df.select("m", windows.change_from_previous("v", ["s"], "m").alias("c")).orderBy("m").collect()
    assert [r.c for r in got] == [5, 2, None, None]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), (None, 3, 5), ("z", 4, 0)], "k string, i int, v int")
    got = {r.i: (r.t, r.s) for r in windows.share_of_total(df, ["k"], "v", "t", "s").collect()}
    assert got == {1: (4, 75.0), 2: (4, 25.0), 3: (5, 100.0), 4: (0, 0.0)}


def test_latest_wins_with_a_hot_key(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"), (-F.col("id")).alias("w")
    )
    got = {r.k: (r.v, r.w) for r in upsert.latest_wins(rows, ["k"], ["v"]).collect()}
    want = {}
    for i in range(20000):
        want[0 if i % 3 == 0 else i % 50] = (i, -i)
    assert got == want


def test_upsert_prefers_incoming(spark):
    stored = spark.createDataFrame([(1, "old", 9), (2, "keep", 1)], "k int, v string, o int")
    incoming = spark.createDataFrame([(1, "first", 1), (1, "second", 2), (3, "new", 1)], "k int, v string, o int")
    got = {r.k: r.v for r in upsert.upsert(stored, incoming, ["k"], ["o"]).collect()}
    assert got == {1: "second", 2: "keep", 3: "new"}


def test_replace_slice(spark):
    stored = spark.createDataFrame([(D(2024, 1, 31), 1), (D(2024, 2, 29), 2), (D(2024, 2, 29), 3)], "d date, v int")
    incoming = spark.createDataFrame([(D(2024, 2, 29), 9)], "d date, v int")
    assert sorted(r.v for r in upsert.replace_slice(stored, incoming, ["d"]).collect()) == [1, 9]
    cleared = spark.createDataFrame([(D(2024, 1, 31),)], "d date")
    assert sorted(r.v for r in upsert.replace_slice(stored, incoming.filter("false"), ["d"], cleared).collect()) == [2, 3]


def test_lookup_never_multiplies(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "i int, k int")
    dim = spark.createDataFrame([(5, "a"), (5, "b"), (7, "c")], "id int, n string")
    got = {r.i: r.label for r in lookup.lookup_value(rows, F.col("k"), dim, "id", F.col("n"), "label").collect()}
    assert got == {1: "b", 2: None, 3: None}


def test_join_copies_match_the_joins(spark):
    rng = random.Random(5)
    rows = lambda n, a, b: [(rng.choice([0, 0, 0, *range(a)]), rng.choice([None, *range(b)])) for _ in range(n)]
    k = spark.createDataFrame([(r[0],) for r in rows(30, 8, 2)], "tb_id int")
    a = spark.createDataFrame(rows(40, 9, 10), "ins_id int, beneficiary int")
    p = spark.createDataFrame(rows(40, 9, 10), "tb_id int, tb_anketa int")
    ck = lookup.left_join_copies(k, "tb_id")
    ca = lookup.left_join_copies(a, "ins_id", "beneficiary", ck, "tb_id")
    cp = lookup.left_join_copies(p, "tb_id", "tb_anketa", ca, "ins_id")
    want = Counter(
        r[0] for r in p.join(a, p.tb_anketa == a.ins_id, "left").join(k, a.beneficiary == k.tb_id, "left").select(p.tb_id).collect()
    )
    assert {r.tb_id: r.copies for r in cp.collect()} == dict(want)


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, None)], "i int, s string")
    assert [tuple(r) for r in quality.unique_violations(df, "i").collect()] == [(1, 2)]
    assert quality.null_violations(df, "i").count() == 2
    assert {r.column_name: r.non_null for r in quality.profile(df, ["i", "s"]).collect()} == {"i": 2, "s": 2}
    summary = quality.load_summary(df.withColumn("f", F.lit("x")), ["i", "s"], "f").first()
    assert (summary.rows_read, summary.rows_skipped, summary.rows_inserted) == (4, 1, 3)
    got = {r.table_name: r.difference for r in quality.reconcile({"t": df, "u": df}, {"t": df.limit(1), "v": df}).collect()}
    assert got == {"t": 3, "u": 4, "v": -4}


def test_starter_models(spark):
    """A two-row literal table breaks its own not-null test; its filtered copy passes both."""
    first = spark.createDataFrame([(1,), (None,)], "id int")
    second = first.filter(F.col("id") == 1)
    assert quality.null_violations(first, "id").count() == 1 and quality.unique_violations(first, "id").count() == 0
    assert quality.null_violations(second, "id").count() == 0 and second.count() == 1


def test_report_order_of_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, None), (2, "c")], "n int, s string")
    assert [tuple(r) for r in ordering.report_order(df, [("n", "desc"), ("s", "asc")]).collect()] == [
        (None, "a"), (2, "c"), (2, None), (1, "b")]
    assert ordering.preview(df, [("n", "asc"), ("s", "asc")], 2).count() == 2


def test_rows_without_need_and_late_rows_spread(spark):
    """Rows that need no rate get none; those after the last rate get it, over many keys."""
    rates = spark.createDataFrame([(2, dt.datetime(2000, 1, 1), Decimal("12.3456789"))], "val_type int, kurs_date timestamp_ntz, kurs decimal(18,10)")
    rows = spark.range(2000).select(
        "id", (F.col("id") % 2 + 1).cast("int").alias("cur"), F.lit("2005-06-07 08:00:00").cast("timestamp_ntz").alias("at"))
    rated = asof.with_rate(rows, rates, "cur", "at", needed=F.col("cur") != 1)
    got = {r["cur"]: (r["n"], r["low"], r["high"]) for r in rated.groupBy("cur").agg(
        F.count("*").alias("n"), F.min("rate").alias("low"), F.max("rate").alias("high")).collect()}
    rate = Decimal("12.3456789000")
    assert got == {1: (1000, None, None), 2: (1000, rate, rate)}


def test_months_between_guards(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, DATE'2025-01-31', DATE'2025-03-01'), (2, DATE'2025-05-01', DATE'2025-04-30'), "
        "(3, DATE'2025-11-15', NULL), (4, NULL, NULL), (5, DATE'2026-02-01', NULL) t(i, a, b)"
    )
    got = df.select("i", F.explode(active.months_between(F.col("a"), F.col("b"), dt.date(2025, 12, 31))).alias("m"))
    assert sorted((r.i, r.m.month) for r in got.collect()) == [(1, 1), (1, 2), (1, 3), (3, 11), (3, 12)]


def test_share_of_summed(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, None, 0.0)], "i int, k string, v double")
    got = {r.i: (r.t, r.s) for r in windows.share_of_summed(df, ["k"], "v", "t", "s").collect()}
    assert got == {1: (4.0, 25.0), 2: (4.0, 75.0), 3: (0.0, 0.0)}
