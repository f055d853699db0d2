"""Queries: table assertions. Each returns failing rows; most are given a rule some rows break."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import as_of
from tidemark.operators.assertions import aggregates as agg, core, tables as tab, values as val
from tidemark.plans.registry import query
from tidemark.session import Tables


def add(name: str, sql: str, build) -> None:
    query(f"assert_{name}", sql)(build)


# --- single rows -----------------------------------------------------------------------------

ORDER = ["o_orderkey", "o_totalprice"]

add("accepted_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 450000",
    lambda t: val.accepted_range(t.orders, "o_totalprice", 5000, 450000).select(*ORDER))
add("accepted_range_exclusive", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity <= 1 OR l_quantity >= 50",
    lambda t: val.accepted_range(t.lineitem, "l_quantity", 1, 50, inclusive=False).select("l_orderkey", "l_quantity"))
add("expression_is_true", "SELECT l_orderkey, l_tax, l_discount FROM lineitem WHERE l_tax > l_discount",
    lambda t: val.expression_is_true(t.lineitem, "l_tax <= l_discount").select("l_orderkey", "l_tax", "l_discount"))
add("not_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'X')",
    lambda t: val.not_accepted_values(t.orders, "o_orderstatus", ["P", "X"]).select("o_orderkey", "o_orderstatus"))
add("not_empty_string", "SELECT p_partkey FROM part WHERE p_type = 'PROMO'",
    lambda t: val.not_empty_string(t.part.withColumn("s", F.when(F.col("p_type") == "PROMO", "  ").otherwise(F.col("p_type"))), "s").select("p_partkey"))
add("values_between", "SELECT event_id, value FROM events WHERE event_type = 'click' AND (value <= 1 OR value >= 200)",
    lambda t: val.expect_column_values_to_be_between(t.events, "value", 1, 200, "event_type = 'click'", strictly=True).select("event_id", "value"))
add("values_in_set", "SELECT c_mktsegment, count(*) AS n_records FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1",
    lambda t: val.expect_column_values_to_be_in_set(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"]))
add("values_not_in_set", "SELECT event_type, count(*) AS n_records FROM events WHERE event_type IN ('error', 'crash') GROUP BY 1",
    lambda t: val.expect_column_values_to_not_be_in_set(t.events, "event_type", ["error", "crash"]))
add("values_null", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'",
    lambda t: val.expect_column_values_to_be_null(t.orders.withColumn("x", F.when(F.col("o_orderstatus") == "P", 1)), "x").select("o_orderkey"))
add("values_not_null", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000",
    lambda t: val.expect_column_values_to_not_be_null(t.orders.withColumn("x", F.when(F.col("o_orderstatus") == "P", 1)), "x", "o_totalprice > 100000").select("o_orderkey"))
add("values_unique", "SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) > 1",
    lambda t: tab.expect_column_values_to_be_unique(t.orders, "o_custkey", "o_orderstatus = 'F'"))
add("pair_greater", "SELECT l_orderkey, l_tax, l_discount FROM lineitem WHERE l_discount <= l_tax",
    lambda t: val.expect_column_pair_values_a_to_be_greater_than_b(t.lineitem, "l_discount", "l_tax").select("l_orderkey", "l_tax", "l_discount"))
add("pair_equal", "SELECT l_orderkey, l_tax, l_discount FROM lineitem WHERE l_discount <> l_tax",
    lambda t: val.expect_column_pair_values_to_be_equal(t.lineitem, "l_discount", "l_tax").select("l_orderkey", "l_tax", "l_discount"))
add("pair_in_set", "SELECT l_returnflag, l_linestatus, l_orderkey FROM lineitem WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))",
    lambda t: val.expect_column_pair_values_to_be_in_set(t.lineitem, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")]).select("l_returnflag", "l_linestatus", "l_orderkey"))
add("unique_within_record", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_partkey = l_suppkey OR l_partkey = l_linenumber OR l_suppkey = l_linenumber",
    lambda t: val.expect_select_column_values_to_be_unique_within_record(t.lineitem, ["l_partkey", "l_suppkey", "l_linenumber"])
    .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
add("unique_within_record_any_missing", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_partkey = l_suppkey AND l_returnflag <> 'R'",
    lambda t: val.expect_select_column_values_to_be_unique_within_record(
        t.lineitem.withColumn("p", F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))), ["p", "l_suppkey"], core.ANY_MISSING).select("l_orderkey", "l_partkey", "l_suppkey"))
add("lengths_between", "SELECT p_partkey, p_name FROM part WHERE length(p_name) < 9 OR length(p_name) > 11",
    lambda t: val.expect_column_value_lengths_to_be_between(t.part, "p_name", 9, 11).select("p_partkey", "p_name"))
add("lengths_equal", "SELECT p_partkey, p_brand FROM part WHERE length(p_brand) <> 8",
    lambda t: val.expect_column_value_lengths_to_equal(t.part, "p_brand", 8).select("p_partkey", "p_brand"))
add("like", "SELECT p_partkey FROM part WHERE p_name NOT LIKE '%ring'",
    lambda t: val.expect_column_values_to_match_like_pattern(t.part, "p_name", "%ring").select("p_partkey"))
add("not_like", "SELECT p_partkey FROM part WHERE p_name LIKE '%ring'",
    lambda t: val.expect_column_values_to_not_match_like_pattern(t.part, "p_name", "%ring").select("p_partkey"))
add("like_list_any", "SELECT p_partkey FROM part WHERE NOT (p_name LIKE 'small%' OR p_name LIKE '%bolt')",
    lambda t: val.expect_column_values_to_match_like_pattern_list(t.part, "p_name", ["small%", "%bolt"]).select("p_partkey"))
add("like_list_all", "SELECT p_partkey FROM part WHERE NOT (p_name LIKE '%l%' AND p_name LIKE '%t')",
    lambda t: val.expect_column_values_to_match_like_pattern_list(t.part, "p_name", ["%l%", "%t"], match_on="all").select("p_partkey"))
add("not_like_list", "SELECT p_partkey FROM part WHERE NOT (p_name NOT LIKE 'small%' AND p_name NOT LIKE '%bolt')",
    lambda t: val.expect_column_values_to_not_match_like_pattern_list(t.part, "p_name", ["small%", "%bolt"], match_on="all").select("p_partkey"))
add("regex", r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+/[a-z]{2}/')",
    lambda t: val.expect_column_values_to_match_regex(t.pages, "url", "^https://[a-z.]+/[a-z]{2}/").select("page_id", "url"))
add("not_regex", r"SELECT page_id, url FROM pages WHERE regexp_matches(url, 'HTML|UTM_', 'i')",
    lambda t: val.expect_column_values_to_not_match_regex(t.pages, "url", "HTML|UTM_", flags="i").select("page_id", "url"))
add("regex_list", r"SELECT page_id, url FROM pages WHERE NOT (regexp_matches(url, '#top$') OR regexp_matches(url, '[0-9]+$'))",
    lambda t: val.expect_column_values_to_match_regex_list(t.pages, "url", ["#top$", "[0-9]+$"]).select("page_id", "url"))
add("not_regex_list", r"SELECT page_id, url FROM pages WHERE NOT (NOT regexp_matches(url, '#top$') AND NOT regexp_matches(url, '[0-9]+$'))",
    lambda t: val.expect_column_values_to_not_match_regex_list(t.pages, "url", ["#top$", "[0-9]+$"], match_on="all").select("page_id", "url"))
add("ignore_missing_rows", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'",
    lambda t: t.orders.select(
        F.when(F.col("o_orderstatus") == "O", 1).alias("a"), F.when(F.col("o_orderpriority") != "5-LOW", 1).alias("b")
    ).filter(core.keep_unless_missing(["a", "b"], core.ANY_MISSING)).agg(F.count(F.lit(1)).alias("n")))

# --- general forms ---------------------------------------------------------------------------

PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"

add("grouped_expression", f"SELECT o_custkey, CAST(sum({PRICE}) AS DOUBLE) AS expression FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING NOT sum({PRICE}) > 1000000",
    lambda t: core.grouped_expression_is_true(t.orders, f"sum({PRICE})", "> 1000000", ["o_custkey"], "o_orderstatus <> 'P'"))
add("expression_between", f"SELECT o_orderpriority, o_orderstatus, max(o_totalprice) AS expression FROM orders GROUP BY 1, 2 HAVING max(o_totalprice) > 499900 OR max(o_totalprice) < 400000",
    lambda t: core.expression_between(t.orders, F.max("o_totalprice"), 400000, 499900, ["o_orderpriority", "o_orderstatus"]))
add("equal_expression", f"""
SELECT o_custkey, a AS expression, b AS compare_expression, abs(coalesce(a, 0) - coalesce(b, 0)) AS expression_difference
FROM (SELECT o_custkey, count(*) AS a FROM orders GROUP BY 1) x FULL JOIN (SELECT o_custkey, count(*) AS b FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) y USING (o_custkey)
WHERE abs(coalesce(a, 0) - coalesce(b, 0)) > 7""",
    lambda t: core.equal_expression(t.orders, F.count(F.lit(1)), group_by=["o_custkey"], row_condition="1=1", compare_row_condition="o_orderstatus = 'F'", tolerance=7).drop("expression_difference_percent"))
add("equal_expression_percent", f"""
SELECT CAST(a AS DOUBLE) AS expression, CAST(b AS DOUBLE) AS compare_expression, round(abs(a - b) / a, 9) AS share FROM
 (SELECT CAST(sum({PRICE}) AS DOUBLE) AS a FROM orders), (SELECT CAST(sum({PRICE}) AS DOUBLE) AS b FROM orders WHERE o_orderstatus <> 'P') WHERE abs(a - b) / a > 0.1""",
    lambda t: core.equal_expression(t.orders, f"sum({PRICE})", row_condition="1=1", compare_row_condition="o_orderstatus <> 'P'", tolerance_percent=0.1)
    .select("expression", "compare_expression", F.round("expression_difference_percent", 9).alias("share")))

# --- aggregates and distributions ---------------------------------------------------------------

add("distinct_count_equal", "SELECT user_id, count(DISTINCT event_type) AS expression FROM events WHERE value > 60 GROUP BY 1 HAVING count(DISTINCT event_type) <> 5",
    lambda t: agg.expect_column_distinct_count_to_equal(t.events, "event_type", 5, ["user_id"], "value > 60"))
add("distinct_count_greater", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS expression FROM orders GROUP BY 1 HAVING NOT count(DISTINCT o_orderpriority) > 3",
    lambda t: agg.expect_column_distinct_count_to_be_greater_than(t.orders, "o_orderpriority", 3, ["o_custkey"]))
add("distinct_count_less", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS expression FROM orders GROUP BY 1 HAVING NOT count(DISTINCT o_orderpriority) < 5",
    lambda t: agg.expect_column_distinct_count_to_be_less_than(t.orders, "o_orderpriority", 5, ["o_custkey"]))
add("distinct_count_other_table", "SELECT a AS expression, b AS compare_expression FROM (SELECT count(DISTINCT o_custkey) AS a FROM orders), (SELECT count(DISTINCT c_nationkey) AS b FROM customer) WHERE a <> b",
    lambda t: agg.expect_column_distinct_count_to_equal_other_table(t.orders, "o_custkey", t.customer, "c_nationkey").select("expression", "compare_expression"))
add("distinct_values_in_set", "SELECT DISTINCT p_type AS value_field FROM part WHERE p_type NOT IN ('PROMO', 'LARGE')",
    lambda t: agg.expect_column_distinct_values_to_be_in_set(t.part, "p_type", ["PROMO", "LARGE"]))
add("distinct_values_contain_set", "SELECT v AS value_field FROM (VALUES ('PROMO'), ('TINY'), ('HUGE')) s(v) WHERE v NOT IN (SELECT p_type FROM part)",
    lambda t: agg.expect_column_distinct_values_to_contain_set(t.part, "p_type", ["PROMO", "TINY", "HUGE", "TINY"]))
add("distinct_values_equal_set", "SELECT DISTINCT p_type AS value_field FROM part WHERE p_type NOT IN ('PROMO', 'TINY') UNION ALL SELECT 'TINY'",
    lambda t: agg.expect_column_distinct_values_to_equal_set(t.part, "p_type", ["PROMO", "TINY"]))
for stat, fn, bounds in (("min", agg.expect_column_min_to_be_between, (0.02, 5)), ("max", agg.expect_column_max_to_be_between, (100, 300))):
    add(f"{stat}_between", f"SELECT user_id, {stat}(value) AS expression FROM events GROUP BY 1 HAVING {stat}(value) < {bounds[0]} OR {stat}(value) > {bounds[1]}",
        lambda t, fn=fn, bounds=bounds: fn(t.events, "value", *bounds, group_by=["user_id"]))
add("mean_between", "SELECT user_id, round(avg(value), 6) AS expression FROM events GROUP BY 1 HAVING NOT (avg(value) > 45 AND avg(value) < 55)",
    lambda t: agg.expect_column_mean_to_be_between(t.events, "value", 45, 55, ["user_id"], strictly=True).withColumn("expression", F.round("expression", 6)))
add("sum_between", f"SELECT o_custkey, CAST(sum({PRICE}) AS DOUBLE) AS expression FROM orders GROUP BY 1 HAVING sum({PRICE}) > 3000000",
    lambda t: agg.expect_column_sum_to_be_between(t.orders.withColumn("p", F.expr(PRICE)), "p", max_value=3000000, group_by=["o_custkey"]))
add("stdev_between", "SELECT user_id, round(stddev_samp(value), 6) AS expression FROM events GROUP BY 1 HAVING stddev_samp(value) < 45 OR stddev_samp(value) > 55",
    lambda t: agg.expect_column_stdev_to_be_between(t.events, "value", 45, 55, ["user_id"]).withColumn("expression", F.round("expression", 6)))
add("median_between", "SELECT user_id, round(quantile_cont(value, 0.5), 6) AS expression FROM events GROUP BY 1 HAVING quantile_cont(value, 0.5) NOT BETWEEN 30 AND 40",
    lambda t: agg.expect_column_median_to_be_between(t.events, "value", 30, 40, ["user_id"]).withColumn("expression", F.round("expression", 6)))
add("quantile_between", "SELECT round(quantile_cont(l_extendedprice, 0.9), 6) AS expression FROM lineitem WHERE l_linestatus = 'F' HAVING quantile_cont(l_extendedprice, 0.9) > 1000",
    lambda t: agg.expect_column_quantile_values_to_be_between(t.lineitem, "l_extendedprice", 0.9, max_value=1000, row_condition="l_linestatus = 'F'").withColumn("expression", F.round("expression", 6)))
add("most_common_value", "SELECT value_field FROM (SELECT p_brand AS value_field, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1 OFFSET 2) WHERE value_field NOT IN ('Brand#0')",
    lambda t: agg.expect_column_most_common_value_to_be_in_set(t.part, "p_brand", ["Brand#0"], top_n=3))
add("unique_value_count_between", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS expression FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey) < 1000000",
    lambda t: agg.expect_column_unique_value_count_to_be_between(t.orders, "o_custkey", 1000000, group_by=["o_orderstatus"]))
add("proportion_unique_between", "SELECT event_type, CAST(count(DISTINCT user_id) AS DOUBLE) / count(*) AS expression FROM events GROUP BY 1 HAVING CAST(count(DISTINCT user_id) AS DOUBLE) / count(*) < 0.9",
    lambda t: agg.expect_column_proportion_of_unique_values_to_be_between(t.events, "user_id", 0.9, 1, ["event_type"]))
add("within_n_stdevs", f"""
WITH g AS (SELECT o_custkey, CAST(sum({PRICE}) AS DOUBLE) AS p FROM orders GROUP BY 1), s AS (SELECT avg(p) AS a, stddev_samp(p) AS d FROM g)
SELECT o_custkey, p, round((p - a) / d, 6) AS p_sigma FROM g, s WHERE abs((p - a) / d) > 2""",
    lambda t: agg.expect_column_values_to_be_within_n_stdevs(t.orders.withColumn("p", F.expr(PRICE)), "p", ["o_custkey"], 2)
    .select("o_custkey", F.col("p").cast("double").alias("p"), F.round("p_sigma", 6).alias("p_sigma")))
add("within_n_moving_stdevs", """
WITH g AS (SELECT date_trunc('day', ts) AS d, event_type, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS m FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(m, 1) OVER (PARTITION BY event_type ORDER BY d) AS pm FROM g),
x AS (SELECT *, coalesce(ln(nullif(m, 0)), 0) - coalesce(ln(nullif(pm, 0)), 0) AS v FROM l),
r AS (SELECT *, avg(v) OVER w AS a, stddev_samp(v) OVER w AS s FROM x WINDOW w AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT CAST(d AS VARCHAR) AS period, event_type, round(v, 6) AS change, round((v - a) / s, 5) AS score FROM r
WHERE d >= TIMESTAMP '2024-01-17' AND d < TIMESTAMP '2024-01-31' AND NOT ((v - a) / s >= -1.2 AND (v - a) / s <= 1.2)""",
    lambda t: agg.expect_column_values_to_be_within_n_moving_stdevs(
        t.events.withColumn("value", F.col("value").cast("decimal(18,4)")), "value", "ts", as_of("2024-01-31 08:00:00"), ["event_type"], sigma_threshold=1.2)
    .select("period", "event_type", F.round("change", 6).alias("change"), F.round("score", 5).alias("score")))
add("not_constant", "SELECT p_size, CAST(1 AS INTEGER) AS n_distinct FROM part GROUP BY 1 HAVING count(DISTINCT CASE WHEN p_size > 40 THEN 'x' ELSE p_brand END) = 1",
    lambda t: agg.not_constant(t.part.withColumn("b", F.when(F.col("p_size") > 40, "x").otherwise(F.col("p_brand"))), "b", ["p_size"]))
add("not_null_proportion", "SELECT o_orderpriority, CAST(count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS DOUBLE) / count(*) AS not_null_proportion FROM orders GROUP BY 1 HAVING CAST(count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS DOUBLE) / count(*) < 0.95",
    lambda t: agg.not_null_proportion(t.orders.withColumn("x", F.when(F.col("o_orderstatus") != "P", 1)), "x", 0.95, group_by=["o_orderpriority"]))
add("at_least_one", "SELECT p_size, CAST(0 AS BIGINT) AS n_values FROM part GROUP BY 1 HAVING count(CASE WHEN p_size < 40 THEN 1 END) = 0",
    lambda t: agg.at_least_one(t.part.withColumn("x", F.when(F.col("p_size") < 40, 1)), "x", ["p_size"]))
add("at_least_one_table", "SELECT count(CASE WHEN p_size < 0 THEN 1 END) AS n_values FROM part HAVING count(CASE WHEN p_size < 0 THEN 1 END) = 0",
    lambda t: agg.at_least_one(t.part.withColumn("x", F.when(F.col("p_size") < 0, 1)), "x"))
add("multicolumn_sum", "SELECT l_returnflag, CAST(sum(l_linenumber) + sum(l_quantity::BIGINT) AS BIGINT) AS total, CAST(sum(l_partkey) AS BIGINT) AS expected FROM lineitem GROUP BY 1 HAVING sum(l_linenumber) + sum(l_quantity::BIGINT) <> sum(l_partkey)",
    lambda t: agg.expect_multicolumn_sum_to_equal(t.lineitem.withColumn("q", F.col("l_quantity").cast("bigint")), ["l_linenumber", "q"], "l_partkey", ["l_returnflag"]))

# --- tables, keys, order, recency ------------------------------------------------------------------

add("cardinality_equality", "SELECT value, coalesce(a, 0) AS n_left, coalesce(b, 0) AS n_right FROM (SELECT c_nationkey AS value, count(*) AS a FROM customer GROUP BY 1) x FULL JOIN (SELECT s_nationkey AS value, count(*) AS b FROM supplier GROUP BY 1) y USING (value) WHERE coalesce(a, 0) <> coalesce(b, 0)",
    lambda t: tab.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey"))
add("equal_rowcount", "SELECT k, coalesce(a, 0) AS count_a, coalesce(b, 0) AS count_b, abs(coalesce(a, 0) - coalesce(b, 0)) AS diff_count FROM (SELECT c_nationkey AS k, count(*) AS a FROM customer GROUP BY 1) x FULL JOIN (SELECT s_nationkey AS k, count(*) AS b FROM supplier GROUP BY 1) y USING (k) WHERE coalesce(a, 0) <> coalesce(b, 0)",
    lambda t: tab.equal_rowcount(t.customer.withColumnRenamed("c_nationkey", "k"), t.supplier.withColumnRenamed("s_nationkey", "k"), ["k"]))
add("fewer_rows_than", "SELECT a AS count_a, b AS count_b, CASE WHEN a > b THEN a - b ELSE 1 END AS row_count_delta FROM (SELECT count(*) AS a FROM orders), (SELECT count(*) AS b FROM customer) WHERE a >= b",
    lambda t: tab.fewer_rows_than(t.orders, t.customer))
add("equality", """
WITH a AS (SELECT o_orderkey, round(o_totalprice, 0) AS p FROM orders), b AS (SELECT o_orderkey, round(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END, 0) AS p FROM orders)
SELECT *, 'a_minus_b' AS which_diff FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'b_minus_a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    lambda t: tab.equality(
        t.orders.select("o_orderkey", F.col("o_totalprice").alias("p"), "o_orderdate"),
        t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")).alias("p"), "o_orderdate"),
        exclude_columns=["o_orderdate"], precision=0))
add("unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    lambda t: tab.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"]))
add("compound_unique", "SELECT user_id, kind, count(*) AS n_records FROM (SELECT user_id, nullif(event_type, 'error') AS kind FROM events) WHERE kind IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    lambda t: tab.expect_compound_columns_to_be_unique(t.events.withColumn("kind", F.nullif(F.col("event_type"), F.lit("error"))), ["user_id", "kind"], core.ANY_MISSING))
add("relationships", "SELECT o_custkey AS from_value, count(*) AS n_records FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1",
    lambda t: tab.relationships(t.orders, "o_custkey", t.customer.filter("c_acctbal > 0"), "c_custkey"))
add("relationships_where", "SELECT o_custkey AS from_value, count(*) AS n_records FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1",
    lambda t: tab.relationships_where(t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'F'", "c_mktsegment = 'BUILDING'"))

RANGES_SQL = """WITH r AS (SELECT o_custkey, o_orderdate AS lo, o_orderdate + INTERVAL 1 DAY * ((day(o_orderdate) - 1) * 3) AS hi FROM orders),
n AS (SELECT *, lead(lo) OVER w AS nx, lead(1) OVER w IS NULL AS is_last FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY lo, hi)) """


def order_ranges(t: Tables) -> DataFrame:
    days = (F.dayofmonth("o_orderdate") - 1) * 3
    return t.orders.select("o_custkey", F.col("o_orderdate").alias("lo"), F.timestamp_add("DAY", days, "o_orderdate").alias("hi"))


for rule, operator in (("allowed", "<="), ("not_allowed", "="), ("required", "<")):
    add(f"exclusive_ranges_{rule}", RANGES_SQL + f"""SELECT o_custkey, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound, CAST(nx AS VARCHAR) AS next_lower_bound
FROM n WHERE NOT (lo < hi AND (is_last OR hi {operator} nx))""",
        lambda t, rule=rule: tab.mutually_exclusive_ranges(order_ranges(t), "lo", "hi", ["o_custkey"], gaps=rule))
add("exclusive_ranges_zero_length", RANGES_SQL + """SELECT o_custkey, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound, CAST(nx AS VARCHAR) AS next_lower_bound
FROM n WHERE NOT (lo <= hi AND (is_last OR hi <= nx))""",
    lambda t: tab.mutually_exclusive_ranges(order_ranges(t), "lo", "hi", ["o_custkey"], zero_length_range_allowed=True))
add("sequential_values", """
WITH v AS (SELECT o_custkey, o_orderkey, count(*) AS n FROM orders GROUP BY 1, 2), l AS (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM v)
SELECT o_custkey, o_orderkey, p AS previous_value, n AS n_rows FROM l WHERE o_orderkey <> p + 1 AND p IS NOT NULL""",
    lambda t: tab.sequential_values(t.orders, "o_orderkey", group_by=["o_custkey"]))
add("sequential_hours", """
WITH v AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1), l AS (SELECT *, lag(h) OVER (ORDER BY h) AS p FROM v)
SELECT CAST(h AS VARCHAR) AS h, CAST(p AS VARCHAR) AS previous_value, n AS n_rows FROM l WHERE h <> p + INTERVAL 1 HOUR OR n > 1""",
    lambda t: tab.sequential_values(t.events.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")), "h", datepart="hour"))
add("increasing", """
SELECT user_id, CAST(sort_column AS VARCHAR) AS sort_column, value_field, value_field_lag FROM (
  SELECT user_id, ts AS sort_column, value AS value_field, lag(value) OVER (PARTITION BY user_id ORDER BY ts, value) AS value_field_lag FROM events WHERE event_type = 'click')
WHERE value_field_lag IS NOT NULL AND NOT value_field > value_field_lag""",
    lambda t: tab.expect_column_values_to_be_increasing(t.events, "value", "ts", group_by=["user_id"], row_condition="event_type = 'click'"))
add("increasing_by_step", """
SELECT sort_column, value_field, value_field_lag FROM (SELECT o_orderkey AS sort_column, o_orderkey AS value_field, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS value_field_lag FROM orders WHERE o_orderstatus <> 'P')
WHERE value_field_lag IS NOT NULL AND value_field - value_field_lag <> 1""",
    lambda t: tab.expect_column_values_to_be_increasing(t.orders, "o_orderkey", row_condition="o_orderstatus <> 'P'", step=1))
add("decreasing", """
SELECT o_custkey, CAST(sort_column AS VARCHAR) AS sort_column, value_field, value_field_lag FROM (
  SELECT o_custkey, o_orderdate AS sort_column, o_totalprice AS value_field, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_totalprice) AS value_field_lag FROM orders)
WHERE value_field_lag IS NOT NULL AND NOT value_field <= value_field_lag""",
    lambda t: tab.expect_column_values_to_be_decreasing(t.orders, "o_totalprice", "o_orderdate", strictly=False, group_by=["o_custkey"]))
add("consistent_casing", "SELECT lower(s) AS inconsistent_columns, count(DISTINCT s) AS set_count FROM (SELECT CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS s FROM part) GROUP BY 1 HAVING count(DISTINCT s) > 1",
    lambda t: tab.expect_column_values_to_have_consistent_casing(t.part.select(F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("s")), "s", True))
add("consistent_casing_counts", "SELECT count(DISTINCT s) AS set_count, count(DISTINCT lower(s)) AS set_count_case_insensitive FROM (SELECT CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS s FROM part) HAVING count(DISTINCT s) <> count(DISTINCT lower(s))",
    lambda t: tab.expect_column_values_to_have_consistent_casing(t.part.select(F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("s")), "s"))
add("data_every_day", """
WITH o AS (SELECT o_orderdate::DATE AS d FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
SELECT CAST(CAST(x AS TIMESTAMP) AS VARCHAR) AS date_day, true AS is_missing, CAST(0 AS INTEGER) AS row_cnt FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS x, max(d) AS e FROM o)
WHERE x < e AND x NOT IN (SELECT d FROM o)""",
    lambda t: tab.expect_row_values_to_have_data_for_every_n_datepart(t.orders, "o_orderdate", "day", row_condition="o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"))
add("data_every_third_hour", """
WITH e AS (SELECT date_trunc('hour', ts) AS h FROM events WHERE event_type = 'purchase' AND value > 60),
b AS (SELECT min(h)::DATE::TIMESTAMP AS s, max(h)::DATE::TIMESTAMP AS x FROM e),
c AS (SELECT h - INTERVAL 1 HOUR * (date_diff('hour', s, h) % 3) AS h FROM e, b)
SELECT CAST(g AS VARCHAR) AS date_hour, true AS is_missing, CAST(0 AS INTEGER) AS row_cnt FROM (SELECT unnest(generate_series(s, x, INTERVAL 3 HOUR)) AS g, x FROM b) WHERE g < x AND g NOT IN (SELECT h FROM c)""",
    lambda t: tab.expect_row_values_to_have_data_for_every_n_datepart(t.events, "ts", "hour", interval=3, row_condition="event_type = 'purchase' AND value > 60"))
add("recency", "SELECT o_custkey, CAST(max(o_orderdate) AS VARCHAR) AS most_recent, '2001-02-01 00:00:00' AS threshold FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2001-02-01'",
    lambda t: tab.recency(t.orders, "o_orderdate", "month", 6, as_of("2001-08-01"), group_by=["o_custkey"]))
add("recent_rows", "SELECT CAST(max(ts) AS VARCHAR) AS max_timestamp FROM events WHERE value > 300 AND ts <= TIMESTAMP '2024-01-25' HAVING max(ts) < TIMESTAMP '2024-01-24 23:00:00'",
    lambda t: tab.expect_row_values_to_have_recent_data(t.events, "ts", "hour", 1, as_of("2024-01-25"), "value > 300"))
add("recent_rows_grouped", "SELECT user_id, CAST(max(ts) AS VARCHAR) AS latest_timestamp FROM events WHERE ts <= TIMESTAMP '2024-01-25' GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-24 12:00:00'",
    lambda t: tab.expect_grouped_row_values_to_have_recent_data(t.events, ["user_id"], "ts", "hour", 12, as_of("2024-01-25")))
add("aggregation_equals_other_table", "SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference FROM (SELECT max(c_custkey) AS a FROM customer), (SELECT max(s_suppkey) AS b FROM supplier) WHERE abs(a - b) > 5",
    lambda t: tab.expect_table_aggregation_to_equal_other_table(t.customer, "max(c_custkey)", t.supplier, compare_expression="max(s_suppkey)", tolerance=5).drop("expression_difference_percent"))
add("row_count_between", "SELECT o_custkey, count(*) AS expression FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) NOT BETWEEN 2 AND 5",
    lambda t: tab.expect_table_row_count_to_be_between(t.orders, 2, 5, ["o_custkey"], "o_orderstatus = 'O'"))
add("row_count_equal", "SELECT n_regionkey, count(*) AS expression FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(*) <> 20",
    lambda t: tab.expect_table_row_count_to_equal(t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey")), 20, ["n_regionkey"]))
add("row_count_other_table", "SELECT a AS expression, b AS compare_expression FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM orders) WHERE a <> b",
    lambda t: tab.expect_table_row_count_to_equal_other_table(t.lineitem, t.orders).select("expression", "compare_expression"))
add("row_count_times_factor", "SELECT x.k AS l_linestatus, a AS expression, CAST(b * 4 AS BIGINT) AS compare_expression FROM (SELECT l_linestatus AS k, count(*) AS a FROM lineitem GROUP BY 1) x JOIN (SELECT o_orderstatus AS k, count(*) AS b FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) y ON x.k = y.k WHERE a <> b * 4",
    lambda t: tab.expect_table_row_count_to_equal_other_table_times_factor(
        t.lineitem, t.orders, 4, group_by=["l_linestatus"], compare_group_by=["o_orderstatus"], row_condition="1=1", compare_row_condition="o_orderstatus <> 'P'").select("l_linestatus", "expression", "compare_expression"))
