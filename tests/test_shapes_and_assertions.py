"""Small golden pairs for the reshaping helpers, the calendar and the assertions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D, numbers, urls
from tidemark.operators import calendar, relational
from tidemark.operators.assertions import aggregates as agg, core, tables as tab, values as val


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pivot(spark):
    df = spark.createDataFrame([(1, "o'clock"), (1, "day"), (1, "day"), (2, None), (3, "week")], "room int, slot string")
    got = relational.pivot(df, ["room"], "slot", ["day", "o'clock", "never"])
    assert got.columns == ["room", "day", "o'clock", "never"] and rows(got) == [(1, 2, 1, 0), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_unpivot(spark):
    df = spark.createDataFrame([(123, "2017", "active", True)], "id int, created string, status string, flag boolean")
    got = relational.unpivot(df, exclude=["id"], remove=["CREATED"], field_name="prop", value_name="val")
    assert rows(got) == [(123, "flag", "true"), (123, "status", "active")]


def test_union(spark):
    a = spark.createDataFrame([(1, "joe", 4)], "id int, name string, n int")
    b = spark.createDataFrame([(1, "red", 8)], "id int, color string, n int")
    both = relational.union_relations({"a": a, "b": b})
    assert both.columns == ["id", "name", "n", "_source_relation", "color"] and both.count() == 2
    assert relational.union_relations({"a": a, "b": b}, exclude=["Name"], source_column=None).columns == ["id", "n", "color"]
    assert relational.union_relations({"a": a, "b": b}, include=["id"], where="id > 1").count() == 0
    with pytest.raises(ValueError):
        relational.union_relations({"a": a}, include=["id"], exclude=["n"])


def test_star_series_values_nullcheck(spark):
    df = spark.createDataFrame([("a", "", 1), ("a", "b", 2)], "f1 string, f2 string, f3 int")
    assert df.select(*relational.star(df, ["F3"], "p_", "_s")).columns == ["p_f1_s", "p_f2_s"]
    assert [r[0] for r in relational.generate_series(spark, 4).orderBy("generated_number").collect()] == [1, 2, 3, 4]
    assert [tuple(r) for r in relational.column_values(df, "f1").collect()] == [("a", 2)]
    assert rows(relational.nullcheck_table(df)) == [("a", "b", 2), ("a", None, 1)]


@pytest.mark.parametrize("value,bucket", [(-1, 0), (0, 1), (9.99, 1), (10, 2), (99, 10), (100, 11), (500, 11)])
def test_width_bucket(spark, value, bucket):
    got = spark.range(1).select(numbers.width_bucket(F.lit(value), F.lit(0), F.lit(100), 10)).first()[0]
    assert got == bucket


def test_arithmetic_and_distance(spark):
    one = spark.createDataFrame([(1, None, 3)], "a int, b int, c int")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    got = one.select(numbers.safe_add(a, b, c), numbers.safe_subtract(a, b, c), numbers.safe_divide(a, b), numbers.safe_divide(a, a - 1)).first()
    assert tuple(got) == (4, -2, None, None)
    points = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    miles, km = spark.range(1).select(numbers.haversine(*points), numbers.haversine(*points, unit="km")).first()
    assert (round(miles), round(km)) == (267, 430)


def test_urls(spark):
    cases = {
        "www.example.com": ("www.example.com", ""), "http://a.com/x/y?z=1&w=2": ("a.com", "x/y"), "https://a.com?z=1": ("a.com", ""),
        "android-app://b.c/d": ("b.c", "d"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    for r in df.select("u", urls.url_host(F.col("u")).alias("h"), urls.url_path(F.col("u")).alias("p"), urls.url_parameter(F.col("u"), "z").alias("z")).collect():
        assert (r["h"], r["p"]) == cases[r["u"]] and r["z"] == ("1" if "z=1" in r["u"] else None)


def one_day(spark, day):
    return spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("date_day"))


def test_date_dimension_of_a_known_day(spark):
    row = calendar.date_dimension(one_day(spark, "2020-11-29")).first().asDict()
    day = dt.date
    assert row["day_of_week"] == 1 and row["day_of_week_iso"] == 7 and row["day_of_week_name"] == "Sunday"
    assert (row["week_start_date"], row["week_end_date"]) == (day(2020, 11, 29), day(2020, 12, 5))
    assert (row["iso_week_start_date"], row["iso_week_end_date"], row["iso_week_of_year"]) == (day(2020, 11, 23), day(2020, 11, 29), 48)
    assert (row["quarter_end_date"], row["year_end_date"], row["month_end_date"]) == (day(2020, 12, 31), day(2020, 12, 31), day(2020, 11, 30))
    assert row["prior_year_over_year_date_day"] == day(2019, 12, 1) and row["month_name_short"] == "Nov"
    assert len(row) == 36


def test_spine_keeps_month_ends(spark):
    bounds = spark.createDataFrame([("2020-01-31", "2020-05-31")], "s string, e string").select(*[F.col(c).cast("date").alias(c) for c in "se"])
    got = [str(r[0])[:10] for r in relational.date_spine(bounds, "month", "s", "e", "m", inclusive=True).select("m").orderBy("m").collect()]
    assert got == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30", "2020-05-31"]
    assert relational.date_spine(bounds, "day", "s", "e").count() == 121


def test_fiscal_year_with_53_weeks(spark):
    bounds = spark.createDataFrame([("2010-01-01", "2020-01-01")], "s string, e string").select(*[F.col(c).cast("date").alias(c) for c in "se"])
    periods = calendar.fiscal_periods(calendar.date_dimension(calendar.base_dates(bounds, "s", "e")), year_end_month=1)
    weeks = {r["fiscal_year_number"]: r["n"] for r in periods.groupBy("fiscal_year_number").agg(F.countDistinct("fiscal_week_of_year").alias("n")).collect()}
    assert weeks[2012] == 53 and weeks[2011] == 52
    late = periods.filter("fiscal_week_of_year = 53").first()
    assert (late["fiscal_period_number"], late["fiscal_quarter_number"], late["fiscal_period_of_quarter"]) == (12, 4, 3)


def test_boundaries(spark):
    start, end = D.as_of("2023-12-30 23:30:00"), D.as_of("2024-01-07 00:10:00")
    got = spark.range(1).select(*[D.boundaries_between(start, end, p) for p in D.PERIODS]).first()
    assert tuple(got) == (607200, 10120, 169, 8, 2, 1, 1, 1)
    with pytest.raises(ValueError):
        D.truncate(start, "fortnight")


def numbers_df(spark):
    return spark.createDataFrame([(1, 0, "a"), (2, 2, "b"), (3, 3, "A"), (4, None, None)], "idx int, n int, s string")


def test_value_assertions(spark):
    df = numbers_df(spark)
    idx = lambda out: [r["idx"] for r in out.orderBy("idx").collect()]
    assert idx(val.accepted_range(df, "n", 1, 2)) == [1, 3]
    assert idx(val.accepted_range(df, "n", min_value=2, inclusive=False)) == [1, 2]
    assert idx(val.expect_column_values_to_not_be_null(df, "s")) == [4]
    assert idx(val.expect_column_pair_values_to_be_equal(df, "idx", "n")) == [1]
    assert idx(val.expect_column_values_to_match_regex(df, "s", "a", flags="i")) == [2]
    assert idx(val.expect_column_values_to_match_regex(df, "s", "")) == []
    assert idx(val.expect_select_column_values_to_be_unique_within_record(df, ["idx", "n"])) == [2, 3, 4]
    assert idx(val.expect_select_column_values_to_be_unique_within_record(df, ["idx", "n"], core.ANY_MISSING)) == [2, 3]
    with pytest.raises(ValueError):
        val.expect_column_pair_values_to_be_in_set(df, "idx", "n", [(1, 2, 3)])
    with pytest.raises(ValueError):
        val.accepted_range(df, "n")


def test_table_assertions(spark):
    df = numbers_df(spark)
    assert rows(tab.expect_column_values_to_have_consistent_casing(df, "s", True)) == [("a", 2)]
    assert tab.equality(df, df).isEmpty() and tab.equality(df, df.filter("idx > 1")).count() == 1
    floats = spark.createDataFrame([(1, 1.2344)], "i int, f double"), spark.createDataFrame([(1, 1.2341)], "i int, f double")
    assert tab.equality(*floats, precision=3).isEmpty() and tab.equality(*floats, precision=4).count() == 2
    assert rows(tab.equal_rowcount(df, df.limit(1))) == [(4, 1, 3)]
    assert tab.fewer_rows_than(df.limit(1), df).isEmpty() and tab.fewer_rows_than(df, df).first()["row_count_delta"] == 1
    assert rows(tab.cardinality_equality(df, "n", df, "idx")) == [(0, 1, 0), (1, 0, 1), (4, 0, 1), (None, 1, 0)]
    assert tab.sequential_values(df, "idx").isEmpty() and rows(tab.sequential_values(df, "n")) == [(2, 0, 1)]
    assert agg.at_least_one(df, "n").isEmpty() and agg.at_least_one(df, "n", ["s"]).count() == 1
    assert rows(agg.not_null_proportion(df, "n", 0.9)) == [(0.75,)]
    assert agg.not_constant(df, "idx").isEmpty() and agg.not_constant(df.withColumn("k", F.lit(1)), "k").count() == 1
    assert rows(agg.most_common_value(df.union(df.limit(1)), "idx")) == [(1, 2)]
    assert agg.most_common_value(df, "idx", 9).isEmpty()


def test_ranges(spark):
    touching = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert tab.mutually_exclusive_ranges(touching, "lo", "hi", gaps="not_allowed").isEmpty()
    assert tab.mutually_exclusive_ranges(touching, "lo", "hi", gaps="required").count() == 2
    overlapping = spark.createDataFrame([(0, 3), (2, 5), (5, 5), (None, 7)], "lo int, hi int")
    assert tab.mutually_exclusive_ranges(overlapping, "lo", "hi").count() == 3
    with pytest.raises(ValueError):
        tab.mutually_exclusive_ranges(touching, "lo", "hi", gaps="maybe")


def test_two_table_aggregates(spark):
    df = numbers_df(spark)
    assert core.equal_expression(df, "sum(idx)").isEmpty()
    out = core.equal_expression(df, "sum(idx)", df.filter("idx < 4")).first()
    assert (out["expression_difference"], out["expression_difference_percent"]) == (4, 0.4)
    assert tab.expect_table_row_count_to_equal_other_table_times_factor(df.union(df), df, 2).isEmpty()
    assert agg.expect_multicolumn_sum_to_equal(df, ["idx"], 10).isEmpty()
    assert agg.expect_column_median_to_be_between(df, "idx", 2.5, 2.5).isEmpty()
    assert core.grouped_expression_is_true(df, "sum(idx)", "= 10", aggregate=True).isEmpty()
