"""Q10: the persisted job run log, and leases that keep a job from running twice.

A run has a ``running`` event and one that ends it, each a small file that appears whole or not at
all.  A run's state is that of its newest event, with the metadata of all its events merged (newer
entries win).  ``compact`` folds the event files into a snapshot of one row per run, so that their number stays
bounded; a reader takes the snapshot and the files that it does not hold yet.

A lease is a numbered file of its job that exactly one starter can create; the next number is free once
the newest lease is released or has run out (its holder died).
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.sources.sinks import _file_system
from meterline.sources.versions import Table, create_exclusive, names_in, read_text

#: fixed values: states of a run
STATUSES = ("running", "success", "failed", "partial")
SCHEMA = ("run_id string, job_name string, status string, started_at timestamp, finished_at timestamp, "
          "rows_ingested long, error_message string, metadata map<string,string>, event_time timestamp")
#: event files from which the end of a run folds them
MOST_FILES = 64


class JobActive(RuntimeError):
    """Another run of the job holds its lease."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLog:
    def __init__(self, spark: SparkSession, path: str, most_files: int = MOST_FILES):
        self.spark, self.path, self.most_files = spark, path.rstrip("/"), most_files
        self._started: dict[str, tuple[str, dt.datetime]] = {}
        self._snapshot = Table(spark, f"{self.path}/snapshot", "kind")

    # events

    def _append(self, run_id, job, status, started, finished, rows, error, metadata, at) -> None:
        event = {"run_id": run_id, "job_name": job, "status": status, "started_at": started.isoformat(),
                 "finished_at": finished and finished.isoformat(), "rows_ingested": rows, "error_message": error,
                 "metadata": {k: None if v is None else str(v) for k, v in metadata.items()}, "event_time": at.isoformat()}
        create_exclusive(self.spark, f"{self.path}/events/{uuid.uuid4().hex}.json", json.dumps(event))

    def start(self, job: str, metadata: dict | None = None) -> str:
        run_id, now = uuid.uuid4().hex, _now()
        self._started[run_id] = (job, now)
        self._append(run_id, job, "running", now, None, None, None, metadata or {}, now)
        return run_id

    def end(self, run_id: str, status: str, rows: int | None = None, error: str | None = None,
            metadata: dict | None = None) -> None:
        if status not in STATUSES or status == "running":
            raise ValueError(f"not an end of a run: {status}")
        job, started = self._started.pop(run_id)
        now = _now()
        self._append(run_id, job, status, started, now, rows, error, metadata or {}, now)
        if len(self._files()) > self.most_files:
            self.compact()

    def _files(self) -> list[str]:
        return sorted(n for n in names_in(self.spark, f"{self.path}/events") if n.endswith(".json"))

    def _read(self, files: list[str], folded: DataFrame | None) -> DataFrame:
        paths = [f"{self.path}/events/{n}" for n in files]
        found = self.spark.read.schema(SCHEMA).json(paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return found if folded is None else folded.select(*found.columns).unionByName(found)

    def _parts(self) -> tuple[list[str], DataFrame | None, set[str]]:
        """(event files not folded yet, snapshot, names of folded files)."""
        files = self._files()                               # listed first: a fold meanwhile only adds to the names
        last = self._snapshot.manifest()
        folded = set() if last is None else set(last.notes.get("files", []))
        return [f for f in files if f not in folded], None if last is None else self._snapshot.read(version=last.version), folded

    def events(self) -> DataFrame:
        files, snapshot, _ = self._parts()
        return self._read(files, snapshot)

    def compact(self) -> int:
        """Fold the event files into the snapshot; returns how many.  A failure at any step loses and doubles nothing."""
        files, snapshot, before = self._parts()
        self._delete(before)                                # left by a fold that ended early
        if not files:
            return 0
        rows = self._state(self._read(files, snapshot)).withColumn("kind", F.lit("state"))
        self._snapshot.replace(rows, notes={"files": files})
        self._delete(files)
        self._snapshot.vacuum()
        return len(files)

    def _delete(self, names) -> None:
        for n in names:
            fs, p = _file_system(self.spark, f"{self.path}/events/{n}")
            fs.delete(p, False)

    @staticmethod
    def _state(events: DataFrame) -> DataFrame:
        last = F.struct("job_name", "status", "started_at", "finished_at", "rows_ingested", "error_message")
        merged = F.aggregate(F.array_sort(F.collect_list(      # two events a run, or one of the snapshot
            F.struct("event_time", F.map_entries("metadata").alias("entries")))),
            F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>")),
            lambda a, e: rules.merge_metadata_map(a, F.map_from_entries(e["entries"])))
        return (events.groupBy("run_id").agg(F.max_by(last, "event_time").alias("s"), merged.alias("metadata"),
                                             F.max("event_time").alias("event_time"))
                      .select("run_id", "s.*", "metadata", "event_time"))

    def state(self) -> DataFrame:
        """One row per run."""
        return self._state(self.events()).drop("event_time")

    def latest(self, days: float = 1, runs: int = 5) -> DataFrame:
        """Of the runs started within ``days``, the ``runs`` that finished last."""
        return (self.state().where(F.col("started_at") > F.lit(_now() - dt.timedelta(days=days)))
                    .orderBy(F.col("finished_at").desc_nulls_first(), F.col("run_id").desc())
                    .select("job_name", "status", "finished_at").limit(runs))

    def last_success(self, job: str) -> dt.datetime | None:
        s = self.state().where((F.col("job_name") == job) & (F.col("status") == "success"))
        return s.agg(F.max("finished_at")).first()[0]

    def is_active(self, job: str) -> bool:
        """Whether a run of the job has started and not ended, by the log or by its lease."""
        number, held = self._lease(job)
        if held:
            return True
        return not self.state().where((F.col("job_name") == job) & (F.col("status") == "running")).isEmpty()

    # leases

    def _lease_folder(self, job: str) -> str:
        return f"{self.path}/leases/{re.sub('[^A-Za-z0-9_.-]', '_', job)}"

    def _lease(self, job: str) -> tuple[int, bool]:
        """(newest lease's number, whether it is held now)."""
        folder = self._lease_folder(job)
        names = names_in(self.spark, folder)
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return 0, False
        n = max(numbers)
        if f"{n}.released" in names:
            return n, False
        until = dt.datetime.fromisoformat(json.loads(read_text(self.spark, f"{folder}/{n}"))["until"])
        return n, until > _now()

    def acquire(self, job: str, hours: float = 24.0) -> int:
        """Take the job's lease; of starters at the same time one gets it, the others fail with ``JobActive``."""
        n, held = self._lease(job)
        until = _now() + dt.timedelta(hours=hours)
        folder = self._lease_folder(job)
        if held or not create_exclusive(self.spark, f"{folder}/{n + 1}", json.dumps({"until": until.isoformat()})):
            raise JobActive(job)
        for old in names_in(self.spark, folder):            # earlier leases say nothing any more
            if int(old.split(".")[0]) < n:
                fs, p = _file_system(self.spark, f"{folder}/{old}")
                fs.delete(p, False)
        return n + 1

    def release(self, job: str, number: int) -> None:
        create_exclusive(self.spark, f"{self._lease_folder(job)}/{number}.released", "{}")
