"""The jobs a user starts: set up a database, import a table, import a database, list."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.functions.naming import named
from quayside.operators import keyed, runlog
from quayside.operators.discovery import discover_specs
from quayside.operators.groups import GROUP_SIZE
from quayside.operators.schema import normalised_schema
from quayside.operators.specs import REFUSED_SCHEMA, good_specs, once_per_job, parse_specs, rejected_specs
from quayside.plans import load
from quayside.plans.registry import START_AFTER, START_ALL, Registry, spec_of
from quayside.plans.runs import Event, RunLog, new_run_id
from quayside.session import apply_settings, small_frame
from quayside.sources.databases import JdbcDatabase, LakeDatabase

log = logging.getLogger(__name__)

Database = LakeDatabase | JdbcDatabase

# What a run does about rows that turned up at or below its last value, or have no check value:
# import them, count them and say so, or nothing.
LATE_IMPORT, LATE_COUNT, LATE_IGNORE = "import", "count", "ignore"


@dataclass(frozen=True)
class Outcome:
    """How one run ended. `error` is none when it succeeded."""

    job_name: str
    run_id: str | None
    n_rows: int
    mark: str | None
    error: str | None = None
    n_late: int = 0
    generation: int | None = None


@dataclass
class Intake:
    """Imports from databases into target tables.

    `late` says what a run does about rows that an earlier one would have had to take: import
    them too, "count" them only, or "ignore" them, which spares the look at the check column.

    `connect` gives the database for (db_type, server, database), so credentials stay with
    the caller. The session's zone is pinned, so that a last value stored as text names the
    same moment in every session.
    """

    spark: SparkSession
    registry: Registry
    run_log: RunLog
    connect: Callable[[str, str, str], Database]
    target_root: str = load.TARGET_ROOT
    late: str = LATE_IMPORT

    def __post_init__(self):
        apply_settings(self.spark)

    def initialise(self, db_type: str, server: str, database: str) -> DataFrame:
        """Register a job for each table that has none yet; the specs refused come back."""
        jobs = self.registry.search_jobs(server=server, database=database)
        known = {row["table_name"] for row in jobs.select("table_name").collect()}
        tables, columns = self.connect(db_type, server, database).catalogue(known)
        specs = discover_specs(tables, columns, db_type, server, database)
        # The last value found is only where the rows began, so nothing is left out on purpose.
        return self._create(specs, START_ALL)

    def create_jobs(self, specs: DataFrame) -> DataFrame:
        """Register the specs in column `input`; the specs refused come back.

        Of several specs of one job the first by text is registered, the others are refused. A
        job that exists stays as it is. Rows up to a spec's last value are never wanted.
        """
        return self._create(specs, START_AFTER)

    def _create(self, specs: DataFrame, start: str) -> DataFrame:
        parsed = once_per_job(parse_specs(specs.select("input"), "input"), "input")
        # Kept as they are: creating makes the jobs that a second look would find.
        refused = small_frame(
            self.spark, [tuple(r) for r in rejected_specs(parsed, "input").collect()], REFUSED_SCHEMA
        )
        self.registry.create(good_specs(parsed), start)
        return refused

    def run_table(self, job_name: str, run_id: str | None = None) -> Outcome:
        """Import, load and clean up one table; each phase is logged with its row count.

        A run that was cut short is taken up again under its own id: its rows are landed
        anew and replace whatever it had loaded. A run id whose load finished is not run
        again. The last value moves with the event that says the load finished. Run a job
        from one driver at a time.
        """
        outcome = self._run(self.registry.read(job_name), run_id)
        self._save_marks([outcome])
        return outcome

    def run_database(self, database: str, batch_size: int = GROUP_SIZE) -> list[Outcome]:
        """Run the enabled jobs of a database, up to `batch_size` at a time.

        The next job starts as soon as one ends, so a long table holds up no others. A job
        that fails does not stop the rest; its outcome carries the error. Start the session with
        spark.scheduler.mode=FAIR, so that tables imported side by side share the executors.
        """
        jobs = self.registry.details(database=database, enabled=True).orderBy("job_name").collect()
        if not jobs:
            log.warning("No jobs found for database %s", database)
            return []
        if self.spark.sparkContext.getConf().get("spark.scheduler.mode", "FIFO") != "FAIR":
            log.warning("spark.scheduler.mode is not FAIR: a long table's tasks go before those of later ones")

        def run(job: Row) -> Outcome:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", job["job_name"])
            try:
                return self._run(job)
            except Exception as error:
                log.exception("Job %s failed", job["job_name"])
                return Outcome(job["job_name"], None, 0, None, str(error))

        run_inherited = inheritable_thread_target(self.spark)(run)
        with ThreadPoolExecutor(batch_size) as pool:
            outcomes = list(pool.map(run_inherited, jobs))
        self._save_marks(outcomes)
        return outcomes

    def list_jobs(self, database: str | None = None) -> DataFrame:
        """One JSON object per job."""
        return json_lines(self.registry.search_jobs(database=database or None))

    def job_details(self, job_name: str) -> DataFrame:
        """One JSON object per property of a job."""
        return json_lines(self.registry.search_props(job_name=job_name))

    def _run(self, job: Row, run_id: str | None = None) -> Outcome:
        job_name = job["job_name"]
        standing = self.run_log.standing(job_name, job["generation"])
        if run_id and self.run_log.is_loaded(job_name, run_id):
            log.info("Run %s of %s is loaded already.", run_id, job_name)
            return Outcome(job_name, run_id, 0, standing.mark)
        run_id = run_id or standing.open_run or new_run_id()
        event = partial(Event, run_id, job_name, generation=job["generation"])
        phase = runlog.IMPORT
        self.run_log.append(event(1, phase, runlog.STARTED))
        try:
            spec, landing = spec_of(job), f"{job['target_dir']}/run-{run_id}"
            rows, high, n_late = self._source_rows(job, spec, standing.mark, run_id)
            landed = load.land(rows, landing)
            imported = event(2, phase, runlog.FINISHED, n_rows=landed.n_rows)
            phase = runlog.LOAD
            self.run_log.append(imported, event(3, phase, runlog.STARTED))
            database, table = spec["database"], spec["table"]
            target = load.ensure_target(
                self.spark, database, table, self.target_root, rows.schema
            )
            path = load.table_path(self.target_root, database, table)
            loaded = load.load(
                self.spark,
                landing,
                target,
                path,
                run_id,
                job["layout"],
                normalised_schema(rows.schema),
            )
            self.run_log.append(
                event(4, phase, runlog.FINISHED, n_rows=loaded.n_rows, mark=high)
            )
        except Exception as error:
            self.run_log.append(event(5, phase, runlog.ERROR, message=str(error)))
            raise
        load.clean_up(self.spark, landing)
        self.run_log.tidy(job_name)
        return Outcome(job_name, run_id, loaded.n_rows, high, n_late=n_late, generation=job["generation"])

    def _source_rows(
        self, job: Row, spec: dict[str, str], mark: str | None, run_id: str
    ) -> tuple[DataFrame, str | None, int]:
        """The rows to import, the last value they reach, and how many late ones were found.

        Without a check column that is the whole table. Else it is the rows past the last
        value, and the late ones as the intake is told to treat them.
        """
        source = self.connect(spec["db_type"], spec["server"], spec["database"])
        table, check_col = spec["table"], spec["check_col"] or None
        split_by, mappers = spec["split_by"] or None, int(spec["mappers"])
        if not check_col:
            return source.read(table, split_by, mappers), None, 0
        last = mark or spec["last_val"] or None
        high = source.high_mark(table, check_col, last)
        rows = source.read(table, split_by, mappers, check_col, last, high)
        late = self._late_rows(job, spec, source, check_col, last, run_id)
        if late is None:
            return rows, high, 0
        n_late = late.count()
        if self.late == LATE_COUNT:
            log.warning("Job %s: %d rows came below its last value and stay out", job["job_name"], n_late)
            return rows, high, n_late
        return rows.unionByName(late), high, n_late

    def _late_rows(self, job, spec, source: Database, check_col: str, last: str | None, run_id: str) -> DataFrame | None:
        """Rows between where the job began and its last value that its target lacks; none if proved."""
        name = f"`{spec['database']}`.`{spec['table']}`"
        floor = None if job["start"] == START_ALL else job["declared"] or None
        if self.late == LATE_IGNORE:
            return None
        if not self.spark.catalog.tableExists(name):
            without = source.read(spec["table"]).where(named(check_col).isNull())
            return None if keyed.is_empty(without) else without
        # What this run loaded before it was cut short will be replaced.
        own = F.contains(F.col("_metadata.file_path"), F.lit(f"/run-{run_id}/"))
        target = self.spark.table(name).where(~own)
        if check_col.lower() not in target.columns or last is None:
            return None
        return source.late_rows(spec["table"], check_col, target, floor, last)

    def _save_marks(self, outcomes: list[Outcome]) -> None:
        marks = [(o.job_name, o.mark, o.generation) for o in outcomes if o.error is None and o.mark is not None]
        if marks:
            rows = small_frame(self.spark, marks, "job_name string, last_val string, generation bigint")
            self.registry.save_marks(rows)


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; nulls are left out."""
    if keyed.is_empty(df):
        log.warning("Nothing to list.")
    return df.select(F.to_json(F.struct("*")).alias("j"))
