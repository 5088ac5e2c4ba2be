"""The run log on disk: events appended, one row per change of state."""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.operators import runlog
from quayside.operators.keyed import search
from quayside.session import (
    child_names,
    delete_path,
    path_exists,
    rename_path,
    small_frame,
    write_json_lines,
)

# Folders that name the files put into the file of the same name. Spark reads past the underscore.
_COVERED = "_covered-"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@dataclass(frozen=True)
class Event:
    """A change of state of one run."""

    run_id: str
    job_name: str
    step: int
    phase: str
    status: str
    at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())
    n_rows: int | None = None
    mark: str | None = None
    message: str | None = None
    generation: int | None = None


@dataclass(frozen=True)
class Standing:
    """Where a job stands: the last value its loads reached, and a run left unfinished."""

    mark: str | None
    open_run: str | None


@dataclass
class RunLog:
    """Events under one root, a folder per job: runs side by side never write to one folder,
    and looking at one job reads that job's events only.

    Each change of state is a small file. Once a job has `tidy_after` of them, `tidy` puts them
    into one.
    """

    spark: SparkSession
    root: str
    tidy_after: int = 100

    def append(self, *events: Event) -> None:
        """Write events of one job together."""
        records = [asdict(event) for event in events]
        write_json_lines(self.spark, self._folder(events[0].job_name), records)

    def events(self, job_name: str | None = None) -> DataFrame:
        """All events, each once."""
        return self._events(job_name).distinct()

    def _events(self, job_name: str | None = None) -> DataFrame:
        """All events; some twice between two turns of `tidy`, which no fold minds."""
        path = self.root if job_name is None else self._folder(job_name)
        if not path_exists(self.spark, path):
            return small_frame(self.spark, [], runlog.EVENT_SCHEMA)
        reader = self.spark.read.schema(runlog.EVENT_SCHEMA).option("recursiveFileLookup", "true")
        return reader.json(path)

    def search(self, job_name: str | None = None, status: str | None = None) -> DataFrame:
        return search(self.events(job_name), status=status)

    def runs(self, job_name: str | None = None) -> DataFrame:
        return runlog.run_view(self._events(job_name))

    def is_loaded(self, job_name: str, run_id: str) -> bool:
        states = runlog.run_states(search(self._events(job_name), run_id=run_id))
        return not states.where("loaded").isEmpty()

    def standing(self, job_name: str, generation: int | None = None) -> Standing:
        """The mark of the latest load, and the id of the latest run if it did not load.

        With a generation, marks reached under another one do not count.
        """
        if not path_exists(self.spark, self._folder(job_name)):
            return Standing(None, None)
        states = runlog.run_states(self._events(job_name))
        counts = F.col("loaded") & F.col("mark").isNotNull()
        if generation is not None:
            counts &= F.coalesce(F.col("generation") == generation, F.lit(True))
        marked_at = F.when(counts, F.col("last_at"))
        unfinished = F.when(~F.col("loaded"), F.col("run_id"))
        row = states.agg(F.max_by("mark", marked_at), F.max_by(unfinished, "last_at")).first()
        return Standing(*row)

    def tidy(self, job_name: str) -> bool:
        """Put the files of a job's events into one, if there are many; true when it did.

        The files put together stay until the next turn, for readers that have listed them, and
        a list of them is kept beside. A driver lost on the way leaves events twice, never none.
        Tidy a job from the driver that runs it.
        """
        folder = self._folder(job_name)
        names = child_names(self.spark, folder)
        files = {n for n in names if n.endswith(".json") and not n.startswith("_")}
        if len(files) < self.tidy_after:
            return False
        for note in (n for n in names if n.startswith(_COVERED)):
            whole = note.removeprefix(_COVERED)
            if whole in files:
                covered = {r["name"] for r in self._notes(f"{folder}/{note}")} & files
                for name in covered:
                    delete_path(self.spark, f"{folder}/{name}")
                files -= covered
            delete_path(self.spark, f"{folder}/{note}")
        # The list must not name a file whose events are not in the new one, so it comes first.
        made = f"{time.time_ns()}-{uuid.uuid4().hex}.json"
        work, paths = f"{folder}/_{made}", [f"{folder}/{n}" for n in sorted(files)]
        events = self.spark.read.schema(runlog.EVENT_SCHEMA).json(paths).distinct()
        events.coalesce(1).write.option("timestampFormat", _MICROS).json(work)
        write_json_lines(self.spark, f"{folder}/{_COVERED}{made}", [{"name": n} for n in sorted(files)])
        (part,) = (n for n in child_names(self.spark, work) if n.startswith("part-"))
        rename_path(self.spark, f"{work}/{part}", f"{folder}/{made}")
        delete_path(self.spark, work)
        return True

    def _notes(self, path: str) -> list[Row]:
        return self.spark.read.schema("name string").json(path).collect()

    def _folder(self, job_name: str) -> str:
        return f"{self.root}/{quote(job_name, safe='')}"


def new_run_id() -> str:
    return uuid.uuid4().hex
