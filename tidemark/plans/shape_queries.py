"""Queries: reshaping helpers and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import dates as D, numbers, urls
from tidemark.operators import calendar, relational
from tidemark.plans.registry import query
from tidemark.session import Tables


@query("shape_pivot", """
SELECT l_shipdate::DATE::VARCHAR AS day, CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS DOUBLE) AS qty_A,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS DOUBLE) AS qty_N, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS DOUBLE) AS qty_R
FROM lineitem GROUP BY 1""")
def shape_pivot(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), "l_returnflag", "l_quantity")
    return relational.pivot(rows, ["day"], "l_returnflag", ["A", "N", "R"], then_value=F.col("l_quantity"), prefix="qty_")


@query("shape_pivot_distinct", """
SELECT o_orderstatus, count(DISTINCT CASE WHEN o_orderpriority > '1-URGENT' THEN o_custkey END) AS "c_1-URGENT",
  count(DISTINCT CASE WHEN o_orderpriority > '4-NOT SPECIFIED' THEN o_custkey END) AS "c_4-NOT SPECIFIED" FROM orders GROUP BY 1""")
def shape_pivot_distinct(t: Tables) -> DataFrame:
    return relational.pivot(
        t.orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED"], agg="count",
        then_value=F.col("o_custkey"), else_value=F.lit(None), cmp=">", prefix="c_", distinct=True,
    )


@query("shape_unpivot", """
SELECT c_custkey, 'c_name' AS attribute, c_name AS val FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer""")
def shape_unpivot(t: Tables) -> DataFrame:
    return relational.unpivot(t.customer, exclude=["c_custkey"], remove=["c_acctbal"], field_name="attribute", value_name="val")


@query("shape_union_relations", """
SELECT 'customer' AS _source_relation, c_name AS name, c_custkey AS key, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT 'supplier', s_name, s_suppkey, NULL, NULL FROM supplier UNION ALL SELECT 'part', p_name, p_partkey, NULL, p_brand FROM part""")
def shape_union_relations(t: Tables) -> DataFrame:
    return relational.union_relations(
        {
            "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), "c_acctbal"),
            "supplier": t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("key")),
            "part": t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand")),
        },
        exclude=["c_acctbal"], column_override={"key": "bigint"},
    )


@query("shape_star", "SELECT p_partkey AS x_p_partkey_y, p_brand AS x_brand_y, p_type AS x_p_type_y, p_size AS x_p_size_y FROM part")
def shape_star(t: Tables) -> DataFrame:
    return t.part.select(*relational.star(t.part, ["p_name", "p_retailprice"], "x_", "_y", {"p_brand": "brand"}))


@query("shape_date_spine", """
SELECT CAST(h AS VARCHAR) AS date_hour FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS h, max(ts) AS e FROM events) WHERE h < e""")
def shape_date_spine(t: Tables) -> DataFrame:
    bounds = t.events.agg(F.date_trunc("hour", F.min("ts")).alias("s"), F.max("ts").alias("e"))
    return relational.date_spine(bounds, "hour", "s", "e").select("date_hour")


@query("shape_date_spine_per_key", """
SELECT o_custkey, CAST(m AS VARCHAR) AS date_month FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY 1)""")
def shape_date_spine_per_key(t: Tables) -> DataFrame:
    """An inclusive month spine for every customer at once."""
    bounds = t.orders.groupBy("o_custkey").agg(
        F.trunc(F.min("o_orderdate"), "month").alias("s"), F.trunc(F.max("o_orderdate"), "month").alias("e")
    )
    return relational.date_spine(bounds, "month", "s", "e", inclusive=True).select("o_custkey", "date_month")


@query("shape_generate_series", "SELECT unnest(generate_series(1, (SELECT count(*) FROM orders))) AS generated_number")
def shape_generate_series(t: Tables) -> DataFrame:
    """As many numbers as there are orders."""
    return relational.generate_series(t.spark, t.orders.count())


@query("shape_column_values", "SELECT c_mktsegment AS value, count(*) AS n_rows FROM customer WHERE c_acctbal > 0 GROUP BY 1 ORDER BY n_rows DESC, value LIMIT 4")
def shape_column_values(t: Tables) -> DataFrame:
    return relational.column_values(t.customer, "c_mktsegment", where="c_acctbal > 0", max_records=4)


@query("shape_nullcheck", """
SELECT p_partkey, nullif(replace(p_type, 'PROMO', ''), '') AS p_type, nullif(replace(p_brand, 'Brand#1', ''), '') AS p_brand FROM part""")
def shape_nullcheck(t: Tables) -> DataFrame:
    rows = t.part.select(
        "p_partkey", F.replace("p_type", F.lit("PROMO"), F.lit("")).alias("p_type"),
        F.replace("p_brand", F.lit("Brand#1"), F.lit("")).alias("p_brand"),
    )
    return relational.nullcheck_table(rows)


@query("shape_width_bucket", """
SELECT CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 11 ELSE CAST(floor((o_totalprice - 50000) / 40000) AS BIGINT) + 1 END AS bucket,
  count(*) AS n FROM orders GROUP BY 1""")
def shape_width_bucket(t: Tables) -> DataFrame:
    bucket = numbers.width_bucket(F.col("o_totalprice"), F.lit(50000), F.lit(450000), 10)
    return t.orders.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("shape_haversine", """
WITH p AS (SELECT c_custkey, n_nationkey * 7.0::DOUBLE - 80 AS lat1, n_nationkey * 14.0::DOUBLE - 170 AS lon1, n_regionkey * 20.0::DOUBLE - 40 AS lat2,
  n_regionkey * 60.0::DOUBLE - 120 AS lon2 FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, round(2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))), 6) AS miles,
  round(2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) * 1.60934, 6) AS km FROM p""")
def shape_haversine(t: Tables) -> DataFrame:
    """Distance from each customer's nation to its region centre, on made-up coordinates."""
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lat1, lon1 = F.col("n_nationkey") * 7.0 - 80, F.col("n_nationkey") * 14.0 - 170
    lat2, lon2 = F.col("n_regionkey") * 20.0 - 40, F.col("n_regionkey") * 60.0 - 120
    return places.select(
        "c_custkey", F.round(numbers.haversine(lat1, lon1, lat2, lon2), 6).alias("miles"),
        F.round(numbers.haversine(lat1, lon1, lat2, lon2, "km"), 6).alias("km"),
    )


@query("shape_safe_arithmetic", """
SELECT p_partkey, coalesce(nullif(p_size, 10), 0) + coalesce(p_partkey, 0) AS added, coalesce(p_partkey, 0) - coalesce(nullif(p_size, 10), 0) AS subtracted,
  CAST(p_retailprice AS DOUBLE) / nullif(p_size - 10, 0) AS divided FROM part""")
def shape_safe_arithmetic(t: Tables) -> DataFrame:
    size = F.nullif(F.col("p_size"), F.lit(10))
    return t.part.select(
        "p_partkey", numbers.safe_add(size, F.col("p_partkey")).alias("added"),
        numbers.safe_subtract(F.col("p_partkey"), size).alias("subtracted"),
        numbers.safe_divide(F.col("p_retailprice"), F.col("p_size") - 10).alias("divided"),
    )


@query("shape_url_parts", """
SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host,
  CASE WHEN instr(s, '/') > 0 AND (instr(s, '?') = 0 OR instr(s, '/') < instr(s, '?')) THEN split_part(substr(s, instr(s, '/') + 1), '?', 1) ELSE '' END AS path,
  nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page
FROM (SELECT *, replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '') AS s FROM pages)""")
def shape_url_parts(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id", urls.url_host(url).alias("host"), urls.url_path(url).alias("path"),
        urls.url_parameter(url, "ref").alias("ref"), urls.url_parameter(url, "page").alias("page"),
    )


DAYS_SQL = """days AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d, max(o_orderdate)::DATE AS e FROM orders)"""


def order_days(t: Tables) -> DataFrame:
    """Every day of the order history, the last one left out."""
    bounds = t.orders.agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return calendar.base_dates(bounds, "s", "e")


@query("calendar_base_dates", f"WITH {DAYS_SQL} SELECT CAST(CAST(d AS TIMESTAMP) AS VARCHAR) AS date_day FROM days WHERE d < e")
def calendar_base_dates(t: Tables) -> DataFrame:
    return order_days(t)


@query("calendar_base_dates_back", """
SELECT CAST(w AS VARCHAR) AS date_week FROM (SELECT unnest(generate_series(max(ts)::DATE - INTERVAL 4 WEEK, max(ts)::DATE + INTERVAL 1 DAY, INTERVAL 1 WEEK)) AS w, max(ts)::DATE + 1 AS e FROM events) WHERE w < e""")
def calendar_base_dates_back(t: Tables) -> DataFrame:
    return calendar.base_dates_back(t.events.agg(F.max("ts").alias("now")), "now", 4, "week")


def _sql_week(day: str) -> str:
    return f"({day} - CAST(dayofweek({day}) AS INTEGER))"


DIMENSION_SQL = f"""
SELECT d AS date_day, d - 1 AS prior_date_day, d + 1 AS next_date_day, CAST(d - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day, d - 364 AS prior_year_over_year_date_day,
  dayofweek(d) + 1 AS day_of_week, isodow(d) AS day_of_week_iso, dayname(d) AS day_of_week_name, substr(dayname(d), 1, 3) AS day_of_week_name_short,
  day(d) AS day_of_month, dayofyear(d) AS day_of_year, {_sql_week('d')} AS week_start_date, {_sql_week('d')} + 6 AS week_end_date,
  {_sql_week('(d - 364)')} AS prior_year_week_start_date, {_sql_week('(d - 364)')} + 6 AS prior_year_week_end_date,
  CAST(ceil(dayofyear(d) / 7.0) AS INTEGER) AS week_of_year, date_trunc('week', d)::DATE AS iso_week_start_date, date_trunc('week', d)::DATE + 6 AS iso_week_end_date,
  date_trunc('week', d - 364)::DATE AS prior_year_iso_week_start_date, date_trunc('week', d - 364)::DATE + 6 AS prior_year_iso_week_end_date,
  week(d) AS iso_week_of_year, CAST(ceil(dayofyear(d - 364) / 7.0) AS INTEGER) AS prior_year_week_of_year, week(d - 364) AS prior_year_iso_week_of_year,
  month(d) AS month_of_year, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_name_short, date_trunc('month', d)::DATE AS month_start_date,
  last_day(d) AS month_end_date, date_trunc('month', d - INTERVAL 1 YEAR)::DATE AS prior_year_month_start_date, last_day(d - INTERVAL 1 YEAR) AS prior_year_month_end_date,
  quarter(d) AS quarter_of_year, date_trunc('quarter', d)::DATE AS quarter_start_date, (date_trunc('quarter', d) + INTERVAL 3 MONTH)::DATE - 1 AS quarter_end_date,
  year(d) AS year_number, date_trunc('year', d)::DATE AS year_start_date, (date_trunc('year', d) + INTERVAL 1 YEAR)::DATE - 1 AS year_end_date
FROM days WHERE d < e"""
DATE_COLUMNS = (
    "date_day prior_date_day next_date_day prior_year_date_day prior_year_over_year_date_day week_start_date week_end_date prior_year_week_start_date "
    "prior_year_week_end_date iso_week_start_date iso_week_end_date prior_year_iso_week_start_date prior_year_iso_week_end_date month_start_date month_end_date "
    "prior_year_month_start_date prior_year_month_end_date quarter_start_date quarter_end_date year_start_date year_end_date"
).split()


@query("calendar_date_dimension", f"WITH {DAYS_SQL}, dim AS ({DIMENSION_SQL}) SELECT * REPLACE ("
       + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATE_COLUMNS) + ") FROM dim")
def calendar_date_dimension(t: Tables) -> DataFrame:
    return calendar.date_dimension(order_days(t))


FISCAL_SQL = f"""WITH {DAYS_SQL}, dim AS ({DIMENSION_SQL}),
ends AS (SELECT y, week_end FROM (SELECT year_number - 1 AS y, date_day + 6 AS week_end,
    row_number() OVER (PARTITION BY year_number ORDER BY abs(date_diff('day', date_day + 6, month_end_date))) AS rn
  FROM dim WHERE month_of_year = 1 AND day_of_week = 1) WHERE rn = 1),
years AS (SELECT y, lag(week_end) OVER (ORDER BY week_end) + 1 AS first_day, week_end AS last_day FROM ends),
weeks AS (SELECT date_day AS ws, date_day + 6 AS we FROM dim WHERE day_of_week = 1),
fy AS (SELECT date_day, y AS fiscal_year_number, first_day, last_day, ws, we, dense_rank() OVER (PARTITION BY y ORDER BY ws) AS w
  FROM dim JOIN years ON date_day BETWEEN first_day AND last_day JOIN weeks ON date_day BETWEEN ws AND we)
"""


@query("calendar_fiscal_years", FISCAL_SQL + """
SELECT CAST(date_day AS VARCHAR) AS date_day, fiscal_year_number, CAST(first_day AS VARCHAR) AS fiscal_year_start_date, CAST(last_day AS VARCHAR) AS fiscal_year_end_date,
  CAST(ws AS VARCHAR) AS week_start_date, CAST(we AS VARCHAR) AS week_end_date, CAST(w AS INTEGER) AS fiscal_week_of_year FROM fy""")
def calendar_fiscal_years(t: Tables) -> DataFrame:
    """Fiscal years ending with the Saturday closest to the end of January."""
    return calendar.fiscal_year_dates(calendar.date_dimension(order_days(t)), year_end_month=1)


@query("calendar_fiscal_periods", FISCAL_SQL + """,
p AS (SELECT *, least((w - 1) // 13, 3) AS q, CASE WHEN w = 53 THEN 3 WHEN (w - 1) % 13 <= 3 THEN 1 WHEN (w - 1) % 13 <= 8 THEN 2 ELSE 3 END AS poq FROM fy)
SELECT CAST(date_day AS VARCHAR) AS date_day, fiscal_year_number, CAST(ws AS VARCHAR) AS week_start_date, CAST(we AS VARCHAR) AS week_end_date, CAST(w AS INTEGER) AS fiscal_week_of_year,
  CAST(dense_rank() OVER (PARTITION BY q * 3 + poq ORDER BY w) AS INTEGER) AS fiscal_week_of_period, CAST(q * 3 + poq AS INTEGER) AS fiscal_period_number,
  CAST(q + 1 AS INTEGER) AS fiscal_quarter_number, CAST(poq AS INTEGER) AS fiscal_period_of_quarter FROM p""")
def calendar_fiscal_periods(t: Tables) -> DataFrame:
    return calendar.fiscal_periods(calendar.date_dimension(order_days(t)), year_end_month=1)


@query("calendar_day_parts", """
SELECT event_id, dayofweek(ts) + 1 AS dow, isodow(ts) AS dow_iso, day(ts) AS dom, dayofyear(ts) AS doy, dayname(ts) AS day_long, substr(dayname(ts), 1, 3) AS day_short,
  monthname(ts) AS month_long, substr(monthname(ts), 1, 3) AS month_short, CAST(hour(ts) AS INTEGER) AS hour_part FROM events""")
def calendar_day_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id", D.day_of_week(ts, iso=False).alias("dow"), D.day_of_week(ts).alias("dow_iso"), D.day_of_month(ts).alias("dom"),
        D.day_of_year(ts).alias("doy"), D.day_name(ts, short=False).alias("day_long"), D.day_name(ts).alias("day_short"),
        D.month_name(ts, short=False).alias("month_long"), D.month_name(ts).alias("month_short"), D.date_part("hour", ts).alias("hour_part"),
    )


@query("calendar_weeks", f"""
SELECT o_orderkey, CAST({_sql_week('d')} AS VARCHAR) AS week_start, CAST({_sql_week('d')} + 6 AS VARCHAR) AS week_end, CAST(date_trunc('week', d)::DATE AS VARCHAR) AS iso_start,
  CAST(date_trunc('week', d)::DATE + 6 AS VARCHAR) AS iso_end, CAST(ceil(dayofyear(d) / 7.0) AS INTEGER) AS week_of_year, week(d) AS iso_week
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def calendar_weeks(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", D.week_start(d).alias("week_start"), D.week_end(d).alias("week_end"), D.iso_week_start(d).alias("iso_start"),
        D.iso_week_end(d).alias("iso_end"), D.week_of_year(d).alias("week_of_year"), D.iso_week_of_year(d).alias("iso_week"),
    )


@query("calendar_relative_dates", """
SELECT o_orderkey, CAST(d - 3 AS VARCHAR) AS n_days_ago, CAST(d + 3 AS VARCHAR) AS n_days_away, CAST(d - 1 AS VARCHAR) AS yesterday, CAST(d + 1 AS VARCHAR) AS tomorrow,
  CAST(date_trunc('week', d - 14)::DATE AS VARCHAR) AS n_weeks_ago, CAST(date_trunc('week', d + 14)::DATE AS VARCHAR) AS n_weeks_away,
  CAST(date_trunc('week', d - 7)::DATE AS VARCHAR) AS last_week, CAST(date_trunc('week', d + 7)::DATE AS VARCHAR) AS next_week,
  CAST(date_trunc('month', d - INTERVAL 5 MONTH)::DATE AS VARCHAR) AS n_months_ago, CAST(date_trunc('month', d + INTERVAL 5 MONTH)::DATE AS VARCHAR) AS n_months_away,
  CAST(date_trunc('month', d - INTERVAL 1 MONTH)::DATE AS VARCHAR) AS last_month, CAST(date_trunc('month', d + INTERVAL 1 MONTH)::DATE AS VARCHAR) AS next_month,
  month(d - INTERVAL 1 MONTH) AS last_month_number, month(d + INTERVAL 1 MONTH) AS next_month_number,
  substr(monthname(d - INTERVAL 1 MONTH), 1, 3) AS last_month_name, monthname(d + INTERVAL 1 MONTH) AS next_month_name
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def calendar_relative_dates(t: Tables) -> DataFrame:
    d = D.today(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", D.n_days_ago(3, d).alias("n_days_ago"), D.n_days_away(3, d).alias("n_days_away"), D.yesterday(d).alias("yesterday"),
        D.tomorrow(d).alias("tomorrow"), D.n_weeks_ago(2, d).alias("n_weeks_ago"), D.n_weeks_away(2, d).alias("n_weeks_away"),
        D.last_week(d).alias("last_week"), D.next_week(d).alias("next_week"), D.n_months_ago(5, d).alias("n_months_ago"),
        D.n_months_away(5, d).alias("n_months_away"), D.last_month(d).alias("last_month"), D.next_month(d).alias("next_month"),
        D.last_month_number(d).alias("last_month_number"), D.next_month_number(d).alias("next_month_number"),
        D.last_month_name(d).alias("last_month_name"), D.next_month_name(d, short=False).alias("next_month_name"),
    )


@query("calendar_periods_since", """
SELECT event_id, """ + ", ".join(
    f"date_diff('{p}', ts, TIMESTAMP '2024-03-05 10:20:30') AS {p}s" for p in ("second", "minute", "hour", "day", "month", "quarter", "year")
) + """, (date_diff('day', DATE '1970-01-01', DATE '2024-03-05') + 4) // 7 - (date_diff('day', DATE '1970-01-01', ts::DATE) + 4) // 7 AS weeks FROM events""")
def calendar_periods_since(t: Tables) -> DataFrame:
    """Boundaries crossed; weeks turn on Sunday."""
    now = D.as_of("2024-03-05 10:20:30")
    return t.events.select("event_id", *[D.periods_since(F.col("ts"), now, p).alias(f"{p}s") for p in D.PERIODS])


@query("calendar_epochs_and_zones", """
SELECT event_id, epoch_ms(date_trunc('second', ts)) // 1000 AS unix_seconds, CAST(date_trunc('second', ts) AS VARCHAR) AS from_seconds,
  CAST(date_trunc('millisecond', ts) AS VARCHAR) AS from_millis, CAST(ts AS VARCHAR) AS from_micros, CAST(ts - INTERVAL 5 HOUR AS VARCHAR) AS new_york,
  CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS VARCHAR) AS nearest_day FROM events""")
def calendar_epochs_and_zones(t: Tables) -> DataFrame:
    ts = F.col("ts")
    micros = F.unix_micros(ts.cast("timestamp"))
    return t.events.select(
        "event_id", D.to_unixtimestamp(ts).alias("unix_seconds"),
        D.from_unixtimestamp(D.to_unixtimestamp(ts)).alias("from_seconds"),
        D.from_unixtimestamp(F.floor(micros / 1000), "milliseconds").alias("from_millis"),
        D.from_unixtimestamp(micros, "microseconds").alias("from_micros"),
        D.convert_timezone(ts, "America/New_York").alias("new_york"), D.round_timestamp(ts).alias("nearest_day"),
    )
