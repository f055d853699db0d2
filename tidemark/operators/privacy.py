"""Per-subject encryption, crypto-shredding and erasure over whole tables.

Keys live in one table, one row per subject; shredding a subject nulls its key and stamps the
time. Lookups never create keys for a shredded subject.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Placeholder for values whose key is gone, request states, response limit.
ERASED = "[ERASED]"
OPEN_STATES = ("pending", "suppressed")
REQUEST_LIMIT_DAYS = 30

# An event is identified by where it was read from.
EVENT_IDENTITY = ("topic", "partition", "offset")


def personal_columns(config: Sequence[Mapping[str, object]], spark) -> DataFrame:
    """Registry of personal columns from configuration entries."""
    schema = "table_name string, column_name string, sensitivity string, subject_id_col string, encrypt boolean"
    rows = [
        (e["table"], e["column"], e.get("sensitivity"), e.get("subject_id_col"), bool(e.get("encrypt"))) for e in config
    ]
    return spark.createDataFrame(rows, schema)


def random_key() -> Column:
    """A fresh 256-bit key per row of ``subject_id``. Store the result before using it: it differs per evaluation.

    The entropy is that of the nonces which encryption draws from the system's secure generator. The encrypted
    texts depend on the row and differ, or the optimizer would fold the calls into one constant.
    """
    def nonce(i: int) -> Column:
        text = F.concat(F.coalesce(F.col("subject_id").cast("string"), F.lit("")), F.lit(f"#{i}"))
        return F.substring(F.aes_encrypt(text, F.lit("0" * 16), F.lit("GCM")), 1, 12)

    return F.unhex(F.sha2(F.concat(*[nonce(i) for i in range(3)]), 256))


def derived_key(secret: str) -> Column:
    """A repeatable 256-bit key from a secret and the subject, for tests and key rotation drills."""
    return F.unhex(F.sha2(F.concat_ws("|", F.lit(secret), "subject_type", "subject_id"), 256))


def missing_keys(subjects: DataFrame, keys: DataFrame, subject_type: str, make_key: Column, created_at: Column) -> DataFrame:
    """Key rows for subjects that have none yet; shredded subjects keep their empty row."""
    wanted = subjects.select(
        F.col(subjects.columns[0]).cast("string").alias("subject_id"), F.lit(subject_type).alias("subject_type")
    ).filter("subject_id is not null").distinct()
    return wanted.join(keys, ["subject_id", "subject_type"], "left_anti").select(
        "subject_id", "subject_type", make_key.alias("dek"), created_at.alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("shredded_at"),
    )


def _keyed(df: DataFrame, keys: DataFrame, subject: str, subject_type: str) -> DataFrame:
    live = keys.filter((F.col("subject_type") == subject_type) & F.col("dek").isNotNull()).select(
        F.col("subject_id").alias("_subject"), F.col("dek").alias("_dek")
    )
    return df.join(live, df[subject].cast("string") == live["_subject"], "left")


def encrypt_columns(df: DataFrame, keys: DataFrame, columns: Sequence[str], subject: str, subject_type: str) -> DataFrame:
    """Replace columns by AES-GCM ciphertext under the subject's key; null without value or key."""
    keyed = _keyed(df, keys, subject, subject_type)
    sealed = {c: F.aes_encrypt(F.col(c).cast("string"), F.col("_dek"), F.lit("GCM")) for c in columns}
    return keyed.withColumns(sealed).drop("_subject", "_dek")


def decrypt_columns(df: DataFrame, keys: DataFrame, columns: Sequence[str], subject: str, subject_type: str) -> DataFrame:
    """Readable values where the key lives; a placeholder where it is gone."""
    keyed = _keyed(df, keys, subject, subject_type)
    opened = {
        c: F.when(F.col(c).isNull(), F.lit(None).cast("string"))
        .when(F.col("_dek").isNull(), F.lit(ERASED))
        .otherwise(F.try_aes_decrypt(F.col(c), F.col("_dek"), F.lit("GCM")).cast("string"))
        for c in columns
    }
    return keyed.withColumns(opened).drop("_subject", "_dek")


def shred(keys: DataFrame, requests: DataFrame, shredded_at: Column) -> DataFrame:
    """Next key table: keys of the requested subjects removed and stamped."""
    hit = requests.select("subject_id", "subject_type").distinct().withColumn("_hit", F.lit(True))
    gone = F.coalesce("_hit", F.lit(False)) & F.col("shredded_at").isNull()
    return keys.join(hit, ["subject_id", "subject_type"], "left").withColumns(
        {
            "dek": F.when(gone, F.lit(None)).otherwise(F.col("dek")),
            "shredded_at": F.when(gone, shredded_at).otherwise(F.col("shredded_at")),
        }
    ).drop("_hit")


def suppress_subjects(df: DataFrame, registry: DataFrame, subject: str, subject_type: str, strict_nulls: bool = False) -> DataFrame:
    """Leave out rows of registered subjects.

    Null registry entries are ignored and rows without a subject are kept. ``strict_nulls`` drops
    rows without a subject, as ``NOT IN`` does.
    """
    erased = registry.filter((F.col("subject_type") == subject_type) & F.col("subject_id").isNotNull()).select(
        F.col("subject_id").cast("string").alias("_subject")
    ).distinct()
    kept = df.join(erased, df[subject].cast("string") == erased["_subject"], "left_anti")
    return kept.filter(F.col(subject).isNotNull()) if strict_nulls else kept


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with a verdict: open status and an integer subject are needed to proceed."""
    number = F.col("subject_id").try_cast("bigint")
    return requests.withColumns(
        {
            "subject_number": number,
            "verdict": F.when(~F.coalesce(F.col("status").isin(*OPEN_STATES), F.lit(False)), "wrong_status")
            .when(number.isNull(), "subject_not_integer")
            .otherwise("accepted"),
        }
    )


def accepted(requests: DataFrame) -> DataFrame:
    return validate_requests(requests).filter("verdict = 'accepted'")


def register_suppression(registry: DataFrame, requests: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """New registry rows for accepted requests, and the request table with their status moved."""
    good = accepted(requests).select(
        F.col("subject_number").cast("string").alias("subject_id"), "subject_type"
    ).distinct()
    added = good.join(registry, ["subject_id", "subject_type"], "left_anti").withColumn("suppressed_at", at)
    checked = validate_requests(requests)
    moved = checked.withColumn(
        "status", F.when(F.col("verdict") == "accepted", "suppressed").otherwise(F.col("status"))
    ).select(*requests.columns)
    return added, moved


def event_subjects(events: DataFrame, id_field: str) -> DataFrame:
    """Events with every subject id found in their before and after images.

    Both the enveloped form (under ``payload``) and the bare form are read.
    """
    paths = [f"$.{prefix}{image}.{id_field}" for prefix in ("payload.", "") for image in ("after", "before")]
    ids = F.array_distinct(F.array_compact(F.array(*[F.get_json_object("value", p) for p in paths])))
    return events.withColumn("_ids", ids)


def _doomed(events: DataFrame, subjects: DataFrame, id_field: str, columns: Sequence[str]) -> DataFrame:
    """Identity of every event that mentions one of the subjects.

    Only identities and ids are shuffled, never the event text, and ids are distinct per event.
    """
    wanted = subjects.select(F.col(subjects.columns[0]).cast("string").alias("_id")).distinct()
    mentioned = event_subjects(events, id_field).select(*columns, F.explode("_ids").alias("_id"))
    return mentioned.join(wanted, "_id", "left_semi").select(*columns).distinct()


def erase_events(events: DataFrame, subjects: DataFrame, id_field: str, identity: Sequence[str] = EVENT_IDENTITY) -> DataFrame:
    """Events that mention none of the subjects."""
    return events.join(_doomed(events, subjects, id_field, identity), list(identity), "left_anti")


def erasure_preview(events: DataFrame, subjects: DataFrame, id_field: str, by: str = "table_name", identity: Sequence[str] = EVENT_IDENTITY) -> DataFrame:
    """Dry run: events that would be deleted, per table."""
    return _doomed(events, subjects, id_field, [by, *identity]).groupBy(by).agg(F.count(F.lit(1)).alias("n_events"))


def still_readable(df: DataFrame, keys: DataFrame, columns: Sequence[str], subject: str, subject_type: str, shredded: DataFrame) -> DataFrame:
    """Post-shred check row: how many values of shredded subjects can still be read."""
    mine = shredded.filter(F.col("subject_type") == subject_type).select(F.col("subject_id").alias("_shredded")).distinct()
    theirs = df.join(mine, df[subject].cast("string") == mine["_shredded"], "left_semi")
    opened = decrypt_columns(theirs, keys, columns, subject, subject_type)
    readable = reduce(
        lambda a, b: a + b,
        [F.count_if(F.coalesce(F.col(c) != ERASED, F.lit(False))) for c in columns],
    )
    return opened.agg(readable.alias("readable_values"), F.count(F.lit(1)).alias("rows_checked")).withColumn(
        "status", F.when(F.col("readable_values") == 0, "PASS").otherwise("FAIL")
    )


def audit_rows(requests: DataFrame, steps: Sequence[str], run_id: str, at: Column) -> DataFrame:
    """One audit row per accepted request and step, for a single append."""
    return accepted(requests).select(
        F.lit(run_id).alias("erasure_run_id"), "request_id", "subject_id", "subject_type",
        F.posexplode(F.array(*[F.lit(s) for s in steps])).alias("step_no", "step"),
        at.alias("logged_at"),
    )


def complete_requests(requests: DataFrame) -> DataFrame:
    """Requests that were suppressed move to complete."""
    return requests.withColumn(
        "status", F.when(F.col("status") == "suppressed", "complete").otherwise(F.col("status"))
    )


def requests_due(requests: DataFrame, as_of: Column, warn_days: int = 5) -> DataFrame:
    """Open requests by age, with those near the limit flagged."""
    age = F.datediff(as_of.cast("date"), F.col("requested_at").cast("date"))
    return (
        requests.filter(F.col("status") != "complete")
        .select("request_id", "subject_type", "status", age.alias("age_days"))
        .withColumns(
            {
                "days_left": REQUEST_LIMIT_DAYS - F.col("age_days"),
                "approaching_limit": F.col("age_days") >= REQUEST_LIMIT_DAYS - warn_days,
            }
        )
        .orderBy(F.col("age_days").desc(), "request_id")
    )


def completed_trend(requests: DataFrame) -> DataFrame:
    """Completed erasures per month."""
    return (
        requests.filter("status = 'complete'")
        .groupBy(F.trunc(F.col("requested_at").cast("date"), "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_completed"))
    )


def active_keys(keys: DataFrame) -> DataFrame:
    """Keys not shredded."""
    return keys.filter(F.col("shredded_at").isNull()).select("subject_id", "subject_type", "created_at")
