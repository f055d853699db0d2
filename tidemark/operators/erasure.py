"""Erasure over several subject types: one run from requests to rewritten files, status, checks and audit.

An index holds, for each subject type and id, which events name the subject and in which file they are. A run looks its
subjects up there, so it reads and rewrites only the files that name one of them; all others keep their names. Survivors of
the touched files are staged beside the table first, then the touched files are deleted, then the staged ones move in. A
run that stopped between can be run again: what is staged completely is not staged anew. The index is ids and places, never
event texts; a run writes its next version without the erased subjects and drops the former one.

Event texts are parsed once for all subject types where that gives the ids for certain, else by a path for each image and
field. A run's requests, the index rows of its subjects and its checks are tables; the driver holds names of files only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import privacy
from tidemark.session import stored

STEPS = ("validate", "suppress", "shred", "delete_events", "check", "complete")
IDENTITY = list(privacy.EVENT_IDENTITY)
INDEX = "subject_type string, subject_id string, file string, topic string, partition int, offset bigint"


@dataclass(frozen=True)
class Scan:
    """Where a subject type occurs: source tables, and the fields of an event's images that hold its id."""

    tables: tuple[str, ...]
    fields: tuple[str, ...]


@dataclass(frozen=True)
class ErasureState:
    """Tables after a run; the caller stores them. ``checks`` has a row for each accepted request."""

    requests: DataFrame
    registry: DataFrame
    keys: DataFrame
    audit: DataFrame
    checks: DataFrame


def image_schema(fields: Sequence[str]) -> str:
    """Both images, enveloped and bare, with the fields as text."""
    image = f"struct<{', '.join(f'`{f}`: string' for f in fields)}>"
    return f"payload struct<after: {image}, before: {image}>, after {image}, before {image}"


def field_ids(field: str, plain: bool) -> Column:
    """Ids in a field of an event's images, null where an image has none; ``plain`` fields are in ``_images``.

    The parsed texts are taken if they are digits and as many as the text names the field: it then occurs nowhere else, so paths
    would find the same. Repeated names, escaped ones, broken texts and other values go by paths.
    """
    places = [f"{prefix}{image}" for prefix in ("payload.", "") for image in ("after", "before")]
    by_path = F.array(*[F.get_json_object("value", f"$.{p}.{field}") for p in places])
    if not plain:
        return by_path
    parsed = [F.col(f"_images.{p}.`{field}`") for p in places]
    name = f'"{field}"'
    named = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(name), F.lit("")))
    certain = [F.when(p.isNull(), 0).when(p.rlike("^[0-9]+$"), len(name)) for p in parsed]
    return F.when(named == reduce(lambda a, b: a + b, certain), F.array(*parsed)).otherwise(by_path)


def subject_ids(scan: Scan, plain: Sequence[str] = ()) -> Column:
    """Distinct ids of the type that an event's images name, enveloped or bare; none in other tables."""
    ids = F.array_except(F.concat(*[field_ids(f, f in plain) for f in scan.fields]), F.array(F.lit(None).cast("string")))
    return F.when(F.col("table_name").isin(*scan.tables), ids)


def index_rows(events: DataFrame, scans: Mapping[str, Scan]) -> DataFrame:
    """A row for each subject an event names, with the event's identity and file; one reading and parsing for all types."""
    plain = sorted({f for scan in scans.values() for f in scan.fields if f.isidentifier()})
    found = F.array(*[
        F.struct(F.lit(kind).alias("subject_type"), F.coalesce(subject_ids(scan, plain), F.array().cast("array<string>")).alias("ids"))
        for kind, scan in scans.items()])
    searched = F.col("table_name").isin(*{table for scan in scans.values() for table in scan.tables})
    file = F.col("_metadata.file_path").alias("file")
    texts = events.select(file, *IDENTITY, "table_name", F.when(searched, F.col("value")).alias("value"))
    if plain:
        texts = texts.withColumn("_images", F.from_json("value", image_schema(plain)))
    each = texts.select("file", *IDENTITY, F.explode(found).alias("s"))
    return each.select("s.subject_type", F.explode("s.ids").alias("subject_id"), "file", *IDENTITY).select(*[c.split()[0] for c in INDEX.split(", ")])


class EventStore:
    """Events in Parquet files, partitioned by ``table_name``, and their subject index."""

    def __init__(self, spark: SparkSession, path: str, scans: Mapping[str, Scan]):
        self.spark, self.path, self.scans = spark, path.rstrip("/"), dict(scans)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/events")

    def files(self) -> list[str]:
        """Names of the event files, as the reader lists them."""
        return sorted(self.events().inputFiles())

    def _versions(self) -> list[int]:
        place = self._hadoop.Path(f"{self.path}/index")
        if not self._fs.exists(place):
            return []
        names = [s.getPath() for s in self._fs.listStatus(place)]
        done = [p for p in names if self._fs.exists(self._hadoop.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def index(self) -> DataFrame:
        """The newest complete version of the index."""
        return self.spark.read.schema(INDEX).parquet(f"{self.path}/index/version={self._versions()[-1]}")

    def _publish(self, rows: DataFrame) -> None:
        old = self._versions()
        rows.write.mode("overwrite").parquet(f"{self.path}/index/version={old[-1] + 1 if old else 0}")
        for version in old:
            self._fs.delete(self._hadoop.Path(f"{self.path}/index/version={version}"), True)

    def build_index(self) -> None:
        """Index all events; later ``add`` indexes new files alone."""
        self._publish(index_rows(self.events(), self.scans))

    def add(self, events: DataFrame) -> None:
        """Append events and index their files."""
        known = set(self.files()) if self._fs.exists(self._hadoop.Path(f"{self.path}/events")) else set()
        events.hint("rebalance", "table_name").write.mode("append").partitionBy("table_name").parquet(f"{self.path}/events")
        fresh = [f for f in self.files() if f not in known]
        made = index_rows(self._read(fresh), self.scans) if fresh else self.spark.createDataFrame([], INDEX)
        self._publish(self.index().unionByName(made) if self._versions() else made)

    def _read(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/events").parquet(*files)

    def named(self, subjects: DataFrame) -> DataFrame:
        """Index rows of the subjects (``subject_type``, ``subject_id``)."""
        wanted = subjects.select("subject_type", "subject_id").distinct().hint("shuffle_hash")
        return self.index().join(wanted, ["subject_type", "subject_id"], "left_semi")

    def erase(self, subjects: DataFrame, run_id: str, named: DataFrame | None = None) -> list[str]:
        """Rewrite the files that name a subject; returns the files that went. ``named`` has the subjects' index rows, if they are at hand.

        The driver holds the touched files' names, fewer than those it lists to read the table.
        """
        staged = self._hadoop.Path(f"{self.path}/_erasure/{run_id}")
        journal = f"{self.path}/_erasure/{run_id}-files"
        if not self._fs.exists(self._hadoop.Path(f"{journal}/_SUCCESS")):
            named = stored(self.named(subjects), "erasure-named") if named is None else named
            touched = [r["file"] for r in named.select("file").distinct().collect()]
            if touched:
                doomed = named.select(*IDENTITY).distinct()
                kept = self._read(touched).join(doomed.hint("shuffle_hash"), IDENTITY, "left_anti")  # texts aren't sorted
                kept.write.mode("overwrite").partitionBy("table_name").parquet(staged.toString())
            self.spark.createDataFrame([(f,) for f in touched], "file string").coalesce(1).write.mode("overwrite").parquet(journal)
        touched = [r["file"] for r in self.spark.read.schema("file string").parquet(journal).collect()]
        for file in touched:
            self._fs.delete(self._hadoop.Path(file), False)
        self._move_in(staged)
        gone = self.spark.createDataFrame([(f,) for f in touched], "file string")
        known = self.index().select("file").distinct()
        named = self.index().join(gone, "file", "left_anti")
        fresh = self._fresh(known)
        self._publish(named.unionByName(index_rows(self._read(fresh), self.scans)) if fresh else named)
        return touched

    def _move_in(self, staged) -> None:
        if not self._fs.exists(staged):
            return
        for folder in self._fs.listStatus(staged):
            if folder.isDirectory():
                target = self._hadoop.Path(f"{self.path}/events/{folder.getPath().getName()}")
                self._fs.mkdirs(target)
                for file in self._fs.listStatus(folder.getPath()):
                    self._fs.rename(file.getPath(), self._hadoop.Path(target, file.getPath().getName()))
        self._fs.delete(staged, True)

    def _fresh(self, known: DataFrame) -> list[str]:
        """Event files that the index doesn't know; files without any subject are among them and cost a reading only."""
        live = self.spark.createDataFrame([(f,) for f in self.files()], "file string")
        return [r["file"] for r in live.join(known, "file", "left_anti").collect()]


def counted(named: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each request its events and files, from the index rows of all subjects."""
    each = named.join(wanted.select("request_id", "subject_type", "subject_id").hint("shuffle_hash"), ["subject_type", "subject_id"])
    return each.groupBy("request_id").agg(F.count_distinct(*IDENTITY).alias("n_events"), F.count_distinct("file").alias("n_files"))


def accepted_requests(requests: DataFrame) -> DataFrame:
    return privacy.accepted(requests).select("request_id", F.col("subject_number").cast("string").alias("subject_id"), "subject_type")


def preview(store: EventStore, requests: DataFrame) -> DataFrame:
    """Dry run: for each accepted request the events and files that would go."""
    wanted = accepted_requests(requests)
    return counted(store.named(wanted), wanted)


def run(store: EventStore, requests: DataFrame, registry: DataFrame, keys: DataFrame, run_id: str, at: Column) -> ErasureState:
    """All steps for all accepted requests of all types.

    Subjects are erased by type and id together, so equal ids of other types stay. A request whose type has no scan is
    suppressed and its key shredded, but there are no events to delete. A request is complete when its check passes: no
    readable key and no event in the index.
    """
    wanted = stored(accepted_requests(requests), "erasure-requests")
    subjects = wanted.select("subject_type", "subject_id").distinct()
    named = stored(store.named(subjects), "erasure-named")
    evidence = counted(named, wanted).join(wanted, "request_id", "right").select(
        "request_id", F.coalesce("n_events", F.lit(0)).alias("n_events"), F.coalesce("n_files", F.lit(0)).alias("n_files"))
    evidence = stored(evidence, "erasure-evidence")  # before files go

    added, moved = privacy.register_suppression(registry, requests, at)
    shredded = privacy.shred(keys, subjects, at)
    store.erase(subjects, run_id, named)

    live = shredded.filter(F.col("dek").isNotNull()).select("subject_type", "subject_id", F.lit(1).alias("n_keys"))
    left = store.named(subjects).groupBy("subject_type", "subject_id").agg(F.count(F.lit(1)).alias("n_left"))
    checks = wanted.join(live, ["subject_type", "subject_id"], "left").join(left, ["subject_type", "subject_id"], "left").select(
        "request_id", "subject_type", "subject_id", F.coalesce("n_keys", F.lit(0)).alias("readable_keys"), F.coalesce("n_left", F.lit(0)).alias("events_left")
    ).withColumn("status", F.when((F.col("readable_keys") == 0) & (F.col("events_left") == 0), "PASS").otherwise("FAIL"))
    checks = stored(checks, "erasure-checks")
    passed = checks.filter("status = 'PASS'").select("request_id", F.lit(True).alias("_passed"))
    done = moved.join(passed, "request_id", "left").withColumn("status", F.when(F.col("_passed"), F.lit("complete")).otherwise(F.col("status"))).drop("_passed")

    texts = {
        "validate": F.concat(F.lit("subject_type="), "subject_type"), "suppress": F.lit("registered"), "shred": F.lit("key removed"),
        "delete_events": F.concat(F.lit("events="), F.col("n_events").cast("string"), F.lit(", files="), F.col("n_files").cast("string")),
        "check": F.col("status"), "complete": F.when(F.col("status") == "PASS", "complete").otherwise("halted"),
    }
    steps = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), texts[s].alias("evidence")) for i, s in enumerate(STEPS)])
    audit = checks.join(evidence, "request_id").select(
        F.lit(run_id).alias("erasure_run_id"), "request_id", "subject_type", "subject_id", F.inline(steps), at.alias("logged_at"))
    return ErasureState(done, registry.unionByName(added, allowMissingColumns=True), shredded, audit, checks)
