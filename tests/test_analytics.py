"""Range joins, prefix scans, counted sets, grouping sets, sketches, samples, lookups as of a time."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from weir.operators.grouping import cube_sets, grouping_sets, rollup_sets
from weir.operators.ranges import bin_widths, halvings, range_join
from weir.operators.sampling import sample_per
from weir.operators.scans import filled_forward, ranked, running, shifted
from weir.operators.sets import intersect, subtract
from weir.operators.sketches import (
    distinct_estimate,
    frequent_estimates,
    merged,
    quantile_estimates,
    read_store,
    update_sketches,
)
from weir.operators.versions import as_of_join, validity_intervals

# ---- range joins


def random_points(rng, n):
    return [(i, rng.choice(["a", "b", None]), rng.choice([None, rng.uniform(-50, 1500), float(rng.randrange(100))])) for i in range(n)]


def random_intervals(rng, n):
    out = []
    for i in range(n):
        low = rng.choice([None, rng.uniform(-50, 1400), float(rng.randrange(100))])
        length = rng.choice([0.0, 1.0, rng.uniform(0, 3), rng.uniform(0, 900), -1.0])
        out.append((i, rng.choice(["a", "b", None]), low, None if low is None else low + length))
    return out


def brute_range(points, intervals, keyed, how, closed):
    out = []
    for i, k, p in points:
        met = []
        for j, g, low, high in intervals:
            if None in (p, low, high) or (keyed and (k is None or k != g)):
                continue
            if low <= p and (p <= high if closed == "both" else p < high):
                met.append((i, j))
        out += met or ([(i, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("how, closed", [("inner", "both"), ("left", "both"), ("left", "left")])
def test_range_join_against_brute_force(spark, keyed, how, closed):
    rng = random.Random(7)
    points, intervals = random_points(rng, 120), random_intervals(rng, 80)
    p = spark.createDataFrame(points, "i int, k string, x double")
    i = spark.createDataFrame(intervals, f"j int, {'k' if keyed else 'g'} string, low double, high double")
    out = range_join(p, i, "x", "low", "high", ["k"] if keyed else [], how, closed)
    assert sorted(((r.i, r.j) for r in out.collect()), key=repr) == brute_range(points, intervals, keyed, how, closed)
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_range_join_of_times_days_and_wide_numbers(spark):
    start = datetime(2024, 1, 1)
    p = spark.createDataFrame([(i, start + timedelta(hours=i)) for i in range(50)], "i int, t timestamp")
    spans = spark.createDataFrame([(1, start, start + timedelta(hours=5)), (2, start + timedelta(hours=4), start + timedelta(days=400))], "j int, a timestamp, b timestamp")
    out = range_join(p, spans, "t", "a", "b")
    assert out.count() == 6 + 46
    days = spans.selectExpr("j", "date(a) as a", "date(b) as b")
    assert range_join(p.selectExpr("i", "date(t) as t"), days, "t", "a", "b").count() == 24 + 50
    wide = spark.createDataFrame([(0, 0.0), (1, 1e308), (2, -1e308), (3, float("nan"))], "i int, x double")
    ends = spark.createDataFrame([(0, float("-inf"), 0.0), (1, 0.0, float("inf")), (2, 5e-324, 1e-300)], "j int, low double, high double")
    got = sorted((r.i, r.j) for r in range_join(wide, ends, "x", "low", "high").collect())
    assert got == [(0, 0), (0, 1), (1, 1), (2, 0)]
    empty = ends.limit(0)
    assert range_join(wide, empty, "x", "low", "high").count() == 0
    assert range_join(wide, empty, "x", "low", "high", how="left").count() == 4
    assert range_join(wide.limit(0), ends, "x", "low", "high", how="left").count() == 0


def test_widths_follow_the_counts():
    assert bin_widths({3: 10_000}, 100, -40) == [3]
    # a handful of long intervals is cut into short bins rather than copying all points once more
    assert bin_widths({3: 10_000, 8: 5}, 1_000_000, -40) == [3]
    assert bin_widths({3: 10_000, 8: 900_000}, 1_000_000, -40) == [3, 8]
    assert bin_widths({-1000: 5, 4: 5}, 10, -3) == [-3, 4]
    assert bin_widths({0: 1, 30: 1}, 1_000_000_000, -10) == [0, 30]  # never more than some bins each


def test_dense_bins_are_halved_and_far_intervals_left_out(spark):
    assert [halvings(37, n, 2.0**41) for n in (0, 4000, 4096, 9000, 17_000, 10**9)] == [0, 0, 0, 1, 2, 3]
    assert halvings(-1000, 10**9, 100.0) == 0 and halvings(5, 10**9, 0.0) == 0
    points = spark.range(20_000).selectExpr("id as i", "1000 + id / 1000 as x")
    spans = [(j, 1000 + j * 0.37, 1000 + j * 0.37 + (j % 5)) for j in range(50)]
    far = [(100 + j, 5.0 * j, 5.0 * j + 4) for j in range(100)] + [(300, 0.0, 5000.0), (301, -1.0, 1000.0), (302, 1019.999, 9e9)]
    intervals = spark.createDataFrame(spans + far, "j int, low double, high double")
    out = range_join(points, intervals, "x", "low", "high")
    xs = [1000 + i / 1000 for i in range(20_000)]
    want = {j: n for j, a, b in spans + far if (n := sum(a <= x <= b for x in xs))}
    assert {r.j: r["count"] for r in out.groupBy("j").count().collect()} == want
    assert ">= 1000.0" in plan(out)  # intervals that end before the first point are left out


def test_a_hot_bin_is_split(spark, tmp_path, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__shuffle__partitions=8,
    )
    points = spark.range(0, 60_000, 1, 8).selectExpr("id as i", "if(id % 2 = 0, 500.5D, id / 10) as x")
    points.write.parquet(str(tmp_path / "points"))
    spans = spark.range(0, 6000, 1, 4).selectExpr("id as j", "double(id) as low", "id + 1D as high")
    out = range_join(spark.read.parquet(str(tmp_path / "points")), spans, "x", "low", "high")
    out.write.format("noop").mode("overwrite").save()
    counted = out.groupBy("j").count()
    assert counted.filter("j = 500").first()["count"] >= 30_000
    out.collect()
    assert "skew=true" in plan(out)


# ---- prefix scans


@pytest.fixture
def hot(spark):
    """Half of all rows have one key; others and a NULL key share the rest."""
    df = spark.range(0, 20_000, 1, 8).selectExpr(
        "id", "if(id % 2 = 0, 7, nullif(int(id % 40), 1)) as k", "int(id * 7919 % 1000) as o", "if(id % 11 = 0, null, id % 100) as v"
    )
    return df


def windowed(df, by, order, **columns):
    window = Window.partitionBy(*by).orderBy(*order)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", *[c.over(upto if name in ("total", "latest") else window).alias(name) for name, c in columns.items()])


@pytest.mark.parametrize("by", [["k"], []])
def test_scans_equal_windows(hot, by):
    order = ["o", "id"]
    want = windowed(hot, by, order, total=F.sum("v"), n=F.row_number())
    assert rows(running(hot, by, order, {"total": "v"}, "n", slices=7)) == rows(want)
    want = windowed(hot, by, order, before=F.lag("v"), later=F.lead("id", 3))
    assert rows(shifted(hot, by, order, {"before": ("v", -1), "later": ("id", 3)}, slices=7)) == rows(want)
    want = windowed(hot, by, order, latest=F.last("v", ignorenulls=True))
    assert rows(filled_forward(hot, by, order, {"latest": "v"}, slices=7)) == rows(want)
    want = windowed(hot, by, [F.desc("o")], place=F.rank(), dense=F.dense_rank())
    got = ranked(hot, by, {"o": "desc"}, "place", "dense", slices=7)
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("by", [["k"], []])
def test_a_hot_key_is_spread_over_tasks(spark, hot, by, settings):
    """No window of the plan sees more than a slice of the key with half of all rows."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=16)
    sizes = running(hot, by, ["o", "id"], {"total": "v"}, slices=16).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 20_000 / 4
    assert sum(r["count"] for r in sizes) == 20_000


def test_many_equal_orders_are_ranked_by_value(spark):
    df = spark.range(0, 5000).selectExpr("id", "if(id < 4000, 1, id) as o")
    got = ranked(df, [], {"o": "asc"}, slices=4).groupBy("rank").count().orderBy("rank").limit(2).collect()
    assert [tuple(r) for r in got] == [(1, 4000), (4001, 1)]
    with pytest.raises(ValueError, match="neither asc nor desc"):
        ranked(df, [], {"o": "up"})


def test_scans_of_empty_frames(spark, hot):
    none = hot.limit(0)
    assert running(none, ["k"], ["o"], {"t": "v"}, "n").count() == 0
    assert ranked(none, [], {"o": "asc"}).count() == 0
    assert shifted(none, ["k"], ["o"], {"b": ("v", -1)}).count() == 0


# ---- versions


def test_as_of_join_with_ties_gaps_and_nulls(spark):
    changes = spark.createDataFrame(
        [("a", 10, 1, "x"), ("a", 10, 2, "y"), ("a", 20, 3, None), ("b", 5, 4, "z"), (None, 1, 5, "n"), ("a", None, 6, "never")],
        "k string, since int, seq int, price string",
    )
    facts = spark.createDataFrame([(1, "a", 9), (2, "a", 10), (3, "a", 19), (4, "a", 20), (5, "b", 4), (6, "c", 9), (7, None, 9), (8, "a", None)], "id int, k string, at int")
    got = as_of_join(facts, changes, ["k"], "at", "since", ["seq"], slices=3)
    assert got.columns == ["id", "k", "at", "since", "seq", "price"]
    assert sorted((r.id, r.seq, r.price) for r in got.collect()) == [
        (1, None, None), (2, 2, "y"), (3, 2, "y"), (4, 3, None), (5, None, None), (6, None, None), (7, None, None), (8, None, None),
    ]
    with pytest.raises(ValueError, match="columns on both sides"):
        as_of_join(facts.withColumn("seq", F.lit(1)), changes, ["k"], "at", "since")


def test_validity_intervals(spark):
    changes = spark.createDataFrame([("a", 10, 1), ("a", 10, 2), ("a", 20, 3), ("b", 5, 4)], "k string, since int, seq int")
    got = validity_intervals(changes, ["k"], "since", ["seq"], slices=2)
    assert rows(got) == [("a", 10, 1, 10, 10), ("a", 10, 2, 10, 20), ("a", 20, 3, 20, None), ("b", 5, 4, 5, None)]


def test_versions_of_a_hot_key_are_spread(spark, settings):
    changes = spark.range(0, 6000, 1, 4).selectExpr("'hot' as k", "id * 2 as since", "id as price")
    facts = spark.range(0, 6000, 1, 4).selectExpr("id", "'hot' as k", "id * 2 + 1 as at")
    got = as_of_join(facts, changes, ["k"], "at", "since", slices=12)
    assert got.filter("price <> id").count() == 0
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=12)
    sizes = as_of_join(facts, changes, ["k"], "at", "since", slices=12).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 6000 / 3


# ---- sets


def test_multiset_operations(spark):
    left = [(1, "a")] * 5 + [(2, None)] * 3 + [(None, None)] * 2 + [(3, "c")]
    right = [(1, "a")] * 2 + [(2, None)] * 4 + [(None, None)] + [(4, "d")] * 2
    a, b = (spark.createDataFrame(data, "x int, y string") for data in (left, right))
    b = b.toDF("other", "names")
    count = lambda df: Counter(map(tuple, df.collect()))
    one, two = Counter(left), Counter(right)
    assert count(intersect(a, b, keep_all=True)) == one & two
    assert count(subtract(a, b, keep_all=True)) == one - two
    assert count(intersect(a, b)) == Counter(set(one) & set(two))
    assert count(subtract(a, b)) == Counter(set(one) - set(two))
    assert intersect(a, b).columns == ["x", "y"]
    assert subtract(a, b.limit(0), keep_all=True).count() == len(left)


def test_a_hot_row_is_counted_before_the_shuffle(spark):
    a = spark.range(0, 100_000, 1, 4).selectExpr("if(id % 10 < 9, 1, id) as x")
    b = spark.range(0, 35_000, 1, 4).selectExpr("1L as x")
    assert intersect(a, b, keep_all=True).count() == 35_000
    assert subtract(a, b, keep_all=True).count() == 65_000
    text = plan(intersect(a, b, keep_all=True))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


# ---- grouping sets


def test_cube_and_rollup(spark):
    assert cube_sets(["a", "b"]) == [("a", "b"), ("a",), ("b",), ()]
    assert rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]
    data = [("x", 1, 10.0), ("x", 2, None), ("y", 1, 4.0), (None, 1, 6.0)]
    df = spark.createDataFrame(data, "a string, b int, v double")
    measures = {"n": ("count", "1"), "nv": ("count", "v"), "s": ("sum", "v"), "m": ("avg", "v")}
    got = grouping_sets(df, cube_sets(["a", "b"]), measures)
    want = df.cube("a", "b").agg(F.grouping_id().alias("g"), F.count("*"), F.count("v"), F.sum("v"), F.avg("v"))
    assert rows(got) == rows(want)
    assert rows(grouping_sets(df, [[]], measures)) == [(0, 4, 3, 20.0, 20.0 / 3)]
    with pytest.raises(ValueError, match="does not add up"):
        grouping_sets(df, [["a"]], {"d": ("median", "v")})


def test_facts_are_grouped_before_they_are_expanded(spark, tmp_path):
    spark.range(0, 1000).selectExpr("id % 5 as a", "id % 7 as b", "id as v").write.parquet(str(tmp_path / "t"))
    text = plan(grouping_sets(spark.read.parquet(str(tmp_path / "t")), cube_sets(["a", "b"]), {"s": ("sum", "v")}))
    assert text.count("FileScan") == 1
    below = text[text.index("Expand") :]
    assert "HashAggregate" in below and "partial_sum(v" in below


# ---- sketches


SPECS = {"who": ("distinct", "id"), "how_much": ("quantiles", "v"), "what": ("frequent", "w")}


def test_an_update_reads_new_partitions_only(spark, tmp_path):
    df = spark.range(0, 40_000).selectExpr("id", "id % 1000 as v", "if(id % 4 = 0, 'rare', 'often') as w", "concat('d', id % 4) as day")
    store = str(tmp_path / "store")
    assert update_sketches(df.filter("day < 'd2'"), store, "day", SPECS) == ["d0", "d1"]
    first = {f: f.stat().st_mtime_ns for f in (tmp_path / "store").rglob("*.parquet")}
    assert update_sketches(df, store, "day", SPECS) == ["d2", "d3"]
    assert all(f.stat().st_mtime_ns == t for f, t in first.items())  # not written again
    assert update_sketches(df, store, "day", SPECS) == []
    assert update_sketches(df, store, "day", SPECS, refresh=["d1"]) == ["d1"]
    whole = merged(read_store(spark, store), SPECS)
    got = whole.select(distinct_estimate("who").alias("n"), quantile_estimates("how_much", [0.1, 0.5]).alias("q"), frequent_estimates("what", 1).alias("f"), "rows").first()
    assert got.rows == 40_000 and abs(got.n - 40_000) < 2_000
    assert abs(got.q[0] - 100) < 30 and abs(got.q[1] - 500) < 30
    assert [tuple(x) for x in got.f] == [("often", 30_000)]
    one = merged(read_store(spark, store).filter("day = 'd0'"), SPECS).select(frequent_estimates("what", 5).alias("f"), "rows").first()
    assert one.rows == 10_000 and [tuple(x) for x in one.f] == [("rare", 10_000)]
    with pytest.raises(ValueError, match="unknown sketches"):
        update_sketches(df, str(tmp_path / "other"), "day", {"x": ("mode", "v")})


# ---- samples


def test_samples_do_not_depend_on_the_partitioning(spark):
    df = spark.range(0, 9000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('s', id % 50)) as s")
    few = rows(sample_per(df.repartition(3), ["s"], 20, ["id"], seed=4))
    assert few == rows(sample_per(df.repartition(11, "id"), ["s"], 20, ["id"], seed=4))
    assert set(few) < set(rows(sample_per(df, ["s"], 30, ["id"], seed=4)))
    assert few != rows(sample_per(df, ["s"], 20, ["id"], seed=5))
    assert set(Counter(s for _, s in few).values()) == {20}
    assert sample_per(df, [], 100, ["id"]).count() == 100
    assert sample_per(df.filter("id < 5"), ["s"], 20, ["id"]).count() == 5
    with pytest.raises(ValueError):
        sample_per(df, ["s"], 0, ["id"])


def test_a_task_keeps_no_more_than_the_sample(spark):
    df = spark.range(0, 9000, 1, 4).selectExpr("id", "id % 2 as s")
    assert plan(sample_per(df, ["s"], 5, ["id"])).count("WindowGroupLimit") >= 2
