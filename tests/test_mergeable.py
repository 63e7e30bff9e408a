"""Exact moments, bitmap distinct counts, range joins and date order: brute force, partitions, merging, odd rows."""
import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidystar.operators import date_order, distinct, moments, ranges, reports
from tidystar.operators.skew import join_hot


# --- A4, A5 ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def amounts(spark):
    rng = random.Random(2)
    values = [Decimal(rng.randint(-10 ** 10, 10 ** 10)) / 100 for _ in range(3000)] + [None] * 20
    return values, spark.createDataFrame(list(enumerate(values)), "id int, x decimal(10,2)")


def test_moments_have_the_same_bits_on_any_partitioning(amounts):
    values, df = amounts
    found = {tuple(moments.with_moments(moments.moment_states(df.repartition(n), [], "x")).first()) for n in (1, 7, 200)}
    assert len(found) == 1
    n, s1, s2, mean, deviation = found.pop()
    whole = [int(v * 100) for v in values if v is not None]
    assert (n, int(s1), int(s2)) == (len(whole), sum(whole), sum(v * v for v in whole))
    assert mean == pytest.approx(np.mean(whole) / 100, rel=1e-12)
    assert deviation == pytest.approx(np.std(whole, ddof=1) / 100, rel=1e-12)


def test_states_of_groups_merge_to_the_whole(amounts):
    _, df = amounts
    parts = moments.moment_states(df.withColumn("g", F.col("id") % 11), ["g"], "x")
    assert moments.merge_states(parts, []).first() == moments.moment_states(df, [], "x").first()


def test_moments_of_large_equal_and_few_values(spark):
    # doubles would lose the deviation of large values that lie close together
    near = spark.createDataFrame([(Decimal("99999990.00") + i,) for i in range(3)], "x decimal(10,2)")
    assert moments.with_moments(moments.moment_states(near, [], "x")).first()["deviation"] == 1.0
    one = spark.createDataFrame([("a", Decimal(5)), ("b", None)], "k string, x decimal(10,2)")
    rows = {r["k"]: r for r in moments.with_moments(moments.moment_states(one, ["k"], "x")).collect()}
    assert rows["a"]["mean"] == 5 and rows["a"]["deviation"] is None
    assert rows["b"]["n"] == 0 and rows["b"]["mean"] is None and rows["b"]["deviation"] is None
    none = moments.with_moments(moments.moment_states(one.limit(0), [], "x")).first()
    assert none["n"] == 0 and none["mean"] is None


def test_outliers_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(i, i % 9, (Decimal(rng.randint(1, 10 ** 5)) ** 2 / 10 ** 4).quantize(Decimal("0.01"))) for i in range(2000)]
    fact = spark.createDataFrame(rows, "order_id int, customer_id int, total_amount_usd decimal(10,2)")
    found = [reports.zscore_outliers(fact.repartition(n), 1.5).collect() for n in (1, 7, 60)]
    assert found[0] and found[0] == found[1] == found[2]


# --- A2 ------------------------------------------------------------------------------
def test_bitmap_counts_equal_sets(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(400)]), rng.randrange(4)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "who int, order_no int, month int")
    numbers = distinct.dense_key_map(df, "who", "order_no", per_bucket=100).cache()
    assert numbers.count() == numbers.select("number").distinct().count() == len({r[:2] for r in rows if r[1] is not None})
    months = distinct.distinct_states(df, numbers, "who", "order_no", ["month"])
    assert {r["month"]: r["n_keys"] for r in distinct.count_all(months, ["month"]).collect()} == {
        m: len({r[:2] for r in rows if r[2] == m and r[1] is not None}) for m in range(4)}
    halves = distinct.merge_states(months.withColumn("half", F.col("month") >= 2), ["half"])
    got = {(r["half"], r["who"]): r["n_keys"] for r in distinct.count_by_owner(halves, numbers, "who", ["half"]).collect()}
    assert got == {(h, w): len({r[1] for r in rows if (r[2] >= 2) == h and r[0] == w and r[1] is not None})
                   for h in (False, True) for w in (1, 2, 3, None)}


def test_bit_positions_are_those_of_sparks_bitmaps(spark):
    positions = [0, 1, 7, 8, 9, 4095, 32767]
    bits = spark.createDataFrame([(p,) for p in positions], "p bigint").agg(F.bitmap_construct_agg("p").alias("bits"))
    tried = spark.createDataFrame([(p,) for p in range(0, 32768, 1)], "p bigint").join(F.broadcast(bits))
    assert [r["p"] for r in tried.where(distinct.bit_is_set(F.col("bits"), F.col("p"))).orderBy("p").collect()] == positions


def test_distinct_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "who int, order_no int, month int")
    numbers = distinct.dense_key_map(df, "who", "order_no")
    assert distinct.count_all(distinct.distinct_states(df, numbers, "who", "order_no", ["month"]), ["month"]).count() == 0


# --- J5 ------------------------------------------------------------------------------
@pytest.mark.parametrize("how_many", [1000, 3])
def test_range_join_equals_all_pairs(spark, how_many):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 50, rng.randrange(-100, 400)])) for i in range(600)]
    spans = [(i, lo, lo + rng.randint(-3, 90)) for i in range(40) for lo in [rng.randrange(-120, 420)]] \
        + [(100, None, 5), (101, 5, None), (102, -1000, 1000), (102, -1000, 1000)]
    got = ranges.range_join(spark.createDataFrame(rows, "id int, v int"), spark.createDataFrame(spans, "s int, lo int, hi int"),
                            "v", "lo", "hi", ranges.number_bins(25), how_many)
    assert got.columns == ["id", "v", "s", "lo", "hi"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        (i, v, s, lo, hi) for i, v in rows for s, lo, hi in spans
        if None not in (v, lo, hi) and lo <= v <= hi)


def test_range_join_has_no_nested_loop_and_refuses_clashes(spark, capsys):
    day = datetime(2001, 1, 1)
    rows = spark.createDataFrame([(i, day + timedelta(days=i)) for i in range(50)], "id int, at timestamp_ntz")
    spans = spark.createDataFrame([(day, day + timedelta(days=9, hours=1))], "lo timestamp_ntz, hi timestamp_ntz")
    got = ranges.range_join(rows, spans, "at", "lo", "hi", ranges.day_bins(7))
    assert got.count() == 10
    got.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="both sides"):
        ranges.range_join(rows, spans.withColumnRenamed("lo", "ID"), "at", "ID", "hi", ranges.day_bins(7))


# --- C6, N4 --------------------------------------------------------------------------
def test_date_order_is_decided_per_source(spark):
    rows = [("us", "01/31/2001", datetime(2001, 1, 31)), ("us", "02/03/2001", datetime(2001, 2, 3)),
            ("eu", '"31-01-01"', datetime(2001, 1, 31)), ("eu", "02/03/2001 10:30", datetime(2001, 3, 2, 10, 30)),
            ("open", "02/03/2001", datetime(2001, 2, 3)), ("open", "2001-12-24", datetime(2001, 12, 24)),
            ("both", "31/01/2001", datetime(2001, 1, 31)), ("both", "01/31/2001", datetime(2001, 1, 31)),
            ("both", "02/03/2001", datetime(2001, 2, 3)), ("none", None, None), ("none", "", None), ("none", "40/40/2001", None),
            (None, "31/12/1999", datetime(1999, 12, 31)), (None, "01/02/1999", datetime(1999, 2, 1))]
    df = spark.createDataFrame([r[:2] for r in rows], "source string, text string")
    found = date_order.decide(date_order.evidence(df, "source", ["text"]))
    assert {r["source"]: r["date_order"] for r in found.collect()} == {
        "us": "month", "eu": "day", "open": "undecided", "both": "mixed", "none": "none", None: "day"}
    assert {r["source"] for r in date_order.report(found).collect()} == {"open", "both"}
    got = date_order.read_dates(df, found, "source", "text", "at")
    assert got.columns == ["source", "text", "at"]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(rows, key=key)


def test_evidence_merges(spark):
    parts = [spark.createDataFrame(r, "source string, a string, b string") for r in (
        [("f", "13/01/2001", "x"), ("g", "01/02/2001", None)], [("f", "01/02/2001", "01/13/2001")])]
    merged = date_order.merge_evidence(*(date_order.evidence(p, "source", ["a", "b"]) for p in parts))
    whole = date_order.evidence(parts[0].union(parts[1]), "source", ["a", "b"])
    assert sorted(merged.collect()) == sorted(whole.collect())


def test_join_hot_is_an_inner_join(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(k, 0) for k in range(2, 30)] + [(None, 1)], "k int, v int")
    by_key = rows.where("k < 25").groupBy("k").agg(F.count("*").alias("n"))
    for how_many in (2, 10, 10 ** 6):
        assert sorted(join_hot(rows, by_key, "k", "n", how_many).collect()) == sorted(rows.join(by_key, "k").collect())
