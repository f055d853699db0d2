"""Check suites, result logs and monitoring queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ordered import with_row_number


class QualityGateError(RuntimeError):
    """Raised when a gate fails; carries the counts that failed it."""


def check_suite(
    df: DataFrame, prefix: str, key: str, required: Mapping[str, str],
    reference: tuple[str, str, DataFrame, str] | None = None,
) -> DataFrame:
    """PASS/FAIL rows for: has rows, key not null, key unique, required columns not null, reference.

    ``required`` maps check label to column; ``reference`` is (label, column, parent, parent key).
    The table is read once: key values are pre-counted, so uniqueness needs no distinct buffer
    and all checks fall out of one aggregate, unpivoted into rows.
    """
    columns = list(dict.fromkeys(required.values()))
    ref = [reference[1]] if reference else []
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
    )
    totals = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count(key).alias("distinct_keys"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"nulls_{c}") for c in columns],
    )
    status = lambda ok: F.when(ok, "PASS").otherwise("FAIL")
    count_text = lambda label, n: F.concat(F.lit(f"{label}="), n.cast("string"))
    entries = [
        (f"{prefix}_has_rows", F.col("rows") > 0, count_text("row_count", F.col("rows"))),
        (f"{prefix}_id_not_null", F.col("null_keys") == 0, count_text("null_id_count", F.col("null_keys"))),
        (
            f"{prefix}_id_unique",
            F.col("rows") == F.col("distinct_keys"),
            F.concat(count_text("row_count", F.col("rows")), F.lit(", "), count_text("distinct_id_count", F.col("distinct_keys"))),
        ),
    ]
    entries += [
        (f"{prefix}_{label}_not_null", F.col(f"nulls_{c}") == 0, count_text(f"null_{label}_count", F.col(f"nulls_{c}")))
        for label, c in required.items()
    ]
    report = totals.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), status(ok).alias("status"), text.alias("details")) for n, ok, text in entries
    ])).alias("r")).select("r.*")
    if reference:
        label, column, parent, parent_key = reference
        missing = (
            df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
            .join(parent.select(F.col(parent_key).alias("_v")), "_v", "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("missing"))
        )
        report = report.unionByName(missing.select(
            F.lit(f"{prefix}_{label}_fk").alias("check_name"),
            status(F.col("missing") == 0).alias("status"),
            count_text(f"missing_{label}_ref_count", F.col("missing")).alias("details"),
        ))
    return report


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = 100) -> DataFrame:
    """Duplicated keys with their row counts, most frequent first; a top-k listing by default."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1").orderBy(F.col("cnt").desc(), *keys)
    return found.limit(limit) if limit else found


def range_check(df: DataFrame, name: str, column: str, low, high) -> DataFrame:
    """Out-of-range count, total, min, max and status of one column."""
    outside = (F.col(column) < low) | (F.col(column) > high)
    return df.agg(
        F.lit(name).alias("check_name"),
        F.count_if(outside).alias("out_of_range_count"),
        F.count(F.lit(1)).alias("total_rows"),
        F.min(column).alias("min_amount"),
        F.max(column).alias("max_amount"),
    ).withColumn("status", F.when(F.col("out_of_range_count") == 0, "PASS").otherwise("FAIL"))


def null_rate(df: DataFrame, name: str, column: str) -> DataFrame:
    """Null count and rate of one column with a PASS/WARN status."""
    return df.agg(
        F.lit(name).alias("check_name"),
        F.count_if(F.col(column).isNull()).alias("null_count"),
        F.count(F.lit(1)).alias("total_rows"),
    ).withColumns(
        {
            "null_rate": F.round(F.try_divide("null_count", "total_rows"), 6),
            "status": F.when(F.col("null_count") == 0, "PASS").otherwise("WARN"),
        }
    )


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate and null key counts, reported apart, with a status."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum(F.when(~null_key, F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"),
            F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        )
        .withColumn("status", F.when(F.col("duplicate_rows") == 0, "PASS").otherwise("FAIL"))
    )


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Gate: raise when the key is duplicated. One aggregate row reaches the driver."""
    row = key_uniqueness(df, keys).first()
    if row["status"] == "FAIL":
        raise QualityGateError(f"{table}: {row['duplicate_rows']} duplicate rows on {list(keys)}")


def result_rows(
    checks: DataFrame, run_id: str, layer: str, table: str, checked_at: Column,
    observed: str | None = None, threshold: float | None = None, message: str | None = None,
) -> DataFrame:
    """Shape check rows for the result log; one append stores a whole run."""
    return checks.select(
        F.lit(run_id).alias("run_id"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        "check_name",
        "status",
        (F.col(observed).cast("double") if observed else F.lit(None).cast("double")).alias("observed_value"),
        F.lit(threshold).cast("double").alias("threshold"),
        (F.col(message) if message else F.lit(None).cast("string")).alias("message"),
        checked_at.alias("checked_at"),
    )


def volume_anomalies(counts: DataFrame, table: str, day: str, rows: str, lookback_days: int = 7, fraction: float = 0.5) -> DataFrame:
    """Status of every table and day against the average of its preceding days.

    ``counts`` holds one row per table and day. Zero rows fail, less than ``fraction`` of the
    average warns, and a day without history passes. Days that failed are left out of averages.
    """
    position = F.unix_date(F.col(day).cast("date"))
    history = Window.partitionBy(table).orderBy(position).rangeBetween(-lookback_days, -1)
    usable = F.when(F.col(rows) > 0, F.col(rows))
    average = F.try_divide(F.sum(usable).over(history).cast("double"), F.count(usable).over(history))
    return counts.select(
        table, day, rows, average.alias("rolling_average"),
    ).withColumn(
        "status",
        F.when(F.col(rows) == 0, "FAIL")
        .when(F.col("rolling_average").isNull() | (F.col("rolling_average") == 0), "PASS")
        .when(F.col(rows) < F.col("rolling_average") * fraction, "WARN")
        .otherwise("PASS"),
    )


def suite_status(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overall status per suite: PASS only if every check passed."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("status") != "PASS").alias("n_not_passed"),
        F.when(F.bool_and(F.col("status") == "PASS"), "PASS").otherwise("FAIL").alias("overall_status"),
    )


def recent_failures(results: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Failed and warned checks of the last hours, newest first."""
    return results.filter(
        F.col("status").isin("FAIL", "WARN") & (F.col("checked_at") >= F.timestamp_add("HOUR", F.lit(-hours), as_of))
    ).orderBy(F.col("checked_at").desc())


def failure_trend(results: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Failure counts per check, table and layer over the last days, highest first."""
    return (
        results.filter((F.col("status") == "FAIL") & (F.col("checked_at") >= F.timestamp_add("DAY", F.lit(-days), as_of)))
        .groupBy("check_name", "table_name", "layer")
        .agg(F.count(F.lit(1)).alias("failures"))
        .orderBy(F.col("failures").desc(), "check_name", "table_name", "layer")
    )


def quarantine_review(quarantine: DataFrame, since: Column) -> DataFrame:
    """Quarantined events per reason and table since a time."""
    return (
        quarantine.filter(F.col("quarantined_at") >= since)
        .groupBy("quarantine_reason", "table_name")
        .agg(F.count(F.lit(1)).alias("n"), F.max("quarantined_at").alias("last_seen"))
        .orderBy(F.col("n").desc(), "quarantine_reason", "table_name")
    )


def duplicate_preview(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Every row beyond the first of its key in ascending order, with its rank.

    Keys that occur once are dropped first by a pre-counted semi join, so only real
    duplicates are ranked.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    return with_row_number(df.join(repeated, list(keys), "left_semi"), keys, order_by, "rn").filter("rn > 1")


def pass_rate(results: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Share of passed checks per layer and day."""
    return (
        results.filter(F.col("checked_at") >= F.timestamp_add("DAY", F.lit(-days), as_of))
        .groupBy("layer", F.col("checked_at").cast("date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n_checks"),
            (F.count_if(F.col("status") == "PASS") / F.count(F.lit(1))).alias("pass_rate"),
        )
    )


def volume_trend(events: DataFrame, table: str, time: str) -> DataFrame:
    """Rows per table and day."""
    return events.groupBy(table, F.col(time).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def freshness(df: DataFrame, time: str, as_of: Column, warn_minutes: int = 30, error_minutes: int = 120, by: Sequence[str] = ()) -> DataFrame:
    """Age of the newest row against warn and error limits."""
    age = F.timestamp_diff("SECOND", F.col("latest"), as_of)
    return (
        df.groupBy(*by).agg(F.max(time).alias("latest"))
        .withColumn("age_seconds", age)
        .withColumn(
            "status",
            F.when(F.col("latest").isNull() | (F.col("age_seconds") > error_minutes * 60), "ERROR")
            .when(F.col("age_seconds") > warn_minutes * 60, "WARN")
            .otherwise("PASS"),
        )
    )


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.01) -> DataFrame:
    """Keys whose measure differs between two tables by more than the tolerance."""
    a = left.select(*keys, F.col(measure).alias("left_total"))
    b = right.select(*keys, F.col(measure).alias("right_total"))
    gap = F.abs(F.coalesce("left_total", F.lit(0)) - F.coalesce("right_total", F.lit(0)))
    return a.join(b, list(keys), "full_outer").withColumn("discrepancy", gap).filter(
        F.col("discrepancy") > F.lit(tolerance).cast("decimal(18,6)")
    )


def assertion_results(outcomes: Mapping[str, DataFrame], run_id: str, layer: str, table: str, checked_at: Column) -> DataFrame:
    """One log row per named assertion, from the number of failing rows each returned."""
    rows = [
        failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"),
            F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"),
            "failures",
        )
        for name, failing in outcomes.items()
    ]
    return result_rows(
        reduce(DataFrame.unionByName, rows), run_id, layer, table, checked_at, observed="failures", threshold=0.0
    )
