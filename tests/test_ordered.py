"""Neighbours, running totals and ranks over ranges against plain windows; ties, nulls and common prefixes in a third of the rows."""

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import differences, ordered, quality, reports
from tidemark.operators.assertions import aggregates, tables


def rows(spark):
    """A third of all rows in one group, a third tied, some null order values."""
    n = F.col("id")
    return spark.range(6000).select(
        n.alias("row"),
        F.when(n % 3 == 0, 0).otherwise(n % 97 + 1).alias("g"),
        F.when(n % 1111 == 5, None).otherwise(F.when(n % 2 == 0, n * n).otherwise(n % 40)).cast("bigint").alias("o"),
        (n * 7919 % 1000).alias("v"),
    )


def shaped(spark, kind):
    """Orders in which a third of the rows are tied, null, or alike in their first 40 characters."""
    df, third = rows(spark), F.col("row") % 3 == 0
    if kind == "ties":
        return df.withColumn("o", F.when(third, 17).otherwise(F.col("o")))
    if kind == "nulls":
        return df.withColumn("o", F.when(third, None).otherwise(F.col("o")))
    return df.withColumn("o", F.when(third, F.concat(F.lit("x" * 40), F.col("row").cast("string"))).otherwise(F.col("o").cast("string")))


def equal(got, want):
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("kind", ["ties", "nulls", "prefix"])
@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour_equals_window(spark, kind, group, direction):
    df = shaped(spark, kind)
    shift = F.lag if direction == "previous" else F.lead
    want = df.withColumn("x", shift("v").over(Window.partitionBy(*group).orderBy("o", "row")))
    assert equal(ordered.with_neighbour(df, group, ["o", "row"], "v", "x", direction), want)


@pytest.mark.parametrize("kind", ["ties", "nulls", "prefix"])
@pytest.mark.parametrize("group", [["g"], []])
def test_row_number_and_total_equal_windows(spark, kind, group):
    df = shaped(spark, kind)
    window = Window.partitionBy(*group).orderBy("o", "row")
    want = df.withColumn("x", F.row_number().over(window).cast("bigint"))
    assert equal(ordered.with_row_number(df, group, ["o", "row"], "x"), want)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert equal(ordered.with_running_total(df, group, ["o", "row"], F.col("v"), "x"), df.withColumn("x", F.sum("v").over(upto)))


def test_equal_rows_are_told_apart(spark):
    """A third of the rows are one row, copied; another third is a row for each group."""
    n = F.col("id")
    df = spark.range(3000).select(
        F.when(n % 3 == 0, 1).otherwise(n % 5).alias("g"), F.when(n % 3 == 0, 7).when(n % 3 == 1, None).otherwise(n % 50).alias("o"))
    window = Window.partitionBy("g").orderBy("o")
    for direction, shift in (("previous", F.lag), ("next", F.lead)):
        assert equal(ordered.with_neighbour(df, ["g"], ["o"], "o", "x", direction), df.withColumn("x", shift("o").over(window)))
    assert equal(ordered.with_row_number(df, ["g"], ["o"], "x"), df.withColumn("x", F.row_number().over(window).cast("bigint")))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(20,3)", "string", "boolean"])
def test_neighbour_order_types(spark, kind):
    base = rows(spark).filter("o is not null").withColumn("o", F.col("row") % 2500)
    if kind == "boolean":
        value = F.col("o") > 1000
    elif kind == "date":
        value = F.date_add(F.lit("2000-01-01").cast("date"), F.col("o").cast("int"))
    elif kind.startswith("timestamp"):
        value = F.timestamp_seconds(F.col("o") * 3601).cast(kind)
    else:
        value = F.col("o").cast(kind)
    df = base.withColumn("o", value)
    want = df.withColumn("x", F.lag("v").over(Window.partitionBy("g").orderBy("o", "row")))
    assert equal(ordered.with_neighbour(df, ["g"], ["o", "row"], "v", "x"), want)


def test_ranges_are_even_and_plans_have_no_job(spark):
    """Also for ties and prefixes no range holds much more than its share; building a plan runs no job."""
    tracker = spark.sparkContext.statusTracker()
    for kind in ("ties", "nulls", "prefix"):
        spark.sparkContext.setJobGroup(f"built-{kind}", "no job while the plan is built")
        df = shaped(spark, kind)
        made = [ordered.with_neighbour(df, [], ["o", "row"], "v", "x"), ordered.dense_rank_desc(df, "v", "x"), aggregates.exact_quantile(df, "v", 0.5, ["g"])]
        assert list(tracker.getJobIdsForGroup(f"built-{kind}")) == []
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for frame in made:
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
        sizes = ordered.ranged(ordered._counted(df), [], ["o"]).groupBy("_range").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[1] >= 12 and sizes[0] < 6000 / 16 * 3


def test_dense_rank_desc(spark):
    df = rows(spark).withColumn("m", F.when(F.col("row") % 50 != 0, F.col("v") * 13 - 5000))
    want = df.withColumn("x", F.dense_rank().over(Window.orderBy(F.col("m").desc())))
    assert equal(ordered.dense_rank_desc(df, "m", "x"), want)
    assert ordered.dense_rank_desc(df.limit(0), "m", "x").count() == 0


def test_assertions_equal_plain_windows(spark):
    df = rows(spark).filter("o is not null").withColumn("hi", F.col("o") + F.col("v"))
    window = Window.partitionBy("g").orderBy("lower_bound", "upper_bound")
    ranges = df.select("g", F.col("o").alias("lower_bound"), F.col("hi").alias("upper_bound")).withColumn("next_lower_bound", F.lead("lower_bound").over(window))
    low, high, after = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    assert equal(tables.mutually_exclusive_ranges(df, "o", "hi", ["g"]), ranges.filter(~((low < high) & (after.isNull() | (high <= after)))))
    values = df.groupBy("g", "o").agg(F.count("*").alias("n_rows")).withColumn("previous_value", F.lag("o").over(Window.partitionBy("g").orderBy("o")))
    broken = values.filter((F.col("n_rows") > 1) | (F.col("o") != F.col("previous_value") + 1)).select("g", "o", "previous_value", "n_rows")
    assert equal(tables.sequential_values(df, "o", group_by=["g"]), broken)
    lagged = df.select("g", F.col("o").alias("sort_column"), F.col("v").alias("value_field")).withColumn(
        "value_field_lag", F.lag("value_field").over(Window.partitionBy("g").orderBy("sort_column", "value_field")))
    got = tables.expect_column_values_to_be_increasing(df, "v", "o", group_by=["g"])
    assert equal(got, lagged.filter("value_field_lag is not null and not value_field > value_field_lag").select(*got.columns))


def test_exact_quantile_equals_builtin(spark):
    df = rows(spark)
    for q in (0.0, 0.1, 0.5, 0.77, 1.0):
        got = {r["g"]: r["expression"] for r in aggregates.exact_quantile(df, "v", q, ["g"]).collect()}
        want = {r["g"]: r["e"] for r in df.groupBy("g").agg(F.expr(f"percentile(v, {q}D)").alias("e")).collect()}
        assert got == pytest.approx(want)


def test_grouped_text_splits_a_hot_key(spark):
    """One key has a third of the rows, with ties, nulls and common prefixes; no task orders all of its texts."""
    n = F.col("id")
    df = spark.range(6000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 50 + 1).alias("g"),
        F.when(n % 7 == 0, None).when(n % 6 == 0, F.lit("tie")).otherwise(F.concat(F.lit("x" * 30), n.cast("string"))).alias("v"))
    df = df.unionByName(spark.sql("SELECT 99L AS g, cast(null AS string) AS v"))
    for distinct, collected in ((False, F.collect_list), (True, F.collect_set)):
        want = df.groupBy("g").agg(F.array_join(F.array_sort(collected("v")), "; ").alias("t"))
        assert equal(reports.grouped_text(df, ["g"], F.col("v"), "t", "; ", distinct), want)
    rows = df.filter("g = 0 and v is not null").groupBy("g", "v").count()
    assert ordered.ranged(rows.unionByName(df.filter("g <> 0").groupBy("g", "v").count()), ["g"], ["v"]).filter("g = 0").select("_range").distinct().count() > 4


def test_differences_by_digest(spark):
    a = spark.range(5000).select("id", (F.col("id") % 17).alias("v"), F.when(F.col("id") % 3 == 0, F.lit("t")).alias("t"))
    b = a.filter("id <> 11").withColumn("v", F.when(F.col("id") == 4000, 99).otherwise(F.col("v"))).unionByName(a.filter("id < 5"))
    got = differences.equality_by_digest(a, b)
    assert equal(got, tables.equality(a, b)) and got.count() == 3
    assert differences.equality_by_digest(a, a.repartition(7)).isEmpty()
    left, right = differences.differing(a, b, a.columns)
    assert {11, 4000} <= {r["id"] for r in left.collect()} and left.count() + right.count() < 100
    assert equal(differences.reconcile_by_digest(a, b.filter("id >= 5"), ["id"], "v"), quality.reconcile(a, b.filter("id >= 5"), ["id"], "v"))
    for empty in (a.limit(0), a):
        assert equal(differences.equality_by_digest(a.limit(0), empty), tables.equality(a.limit(0), empty))
