"""The registered jobs and their properties, kept as a stream of events.

Every change is a batch of events in a folder of its own, written out of sight and renamed once
complete. What is registered is a fold over all events, so writers side by side lose nothing:
of batches that create one job the first counts, of values of one property the last, and
nothing from before a job's deletion. Tidying writes the events that still count into one batch
and removes those it read; whatever is read twice meanwhile folds to the same. Order is that of
the writers' clocks.

The events that set a job's last value other than by reaching it number its generations. A mark
reached under an earlier one does not count any more.
"""

from __future__ import annotations

import threading
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.errors import JobNotFound
from quayside.functions import naming
from quayside.operators import keyed
from quayside.operators.specs import describe_jobs
from quayside.plans.load import CODEC, LAYOUT
from quayside.session import child_names, delete_path, rename_path, small_frame

JOBS_SCHEMA = (
    "id bigint, job_type string, job_name string, server string, database string, "
    "table_name string, enabled boolean"
)
PROPS_SCHEMA = (
    "job_id bigint, job_name string, prop_name string, prop_val string, prop_class string"
)

EVENT_SCHEMA = (
    "at bigint, batch string, op string, job_name string, prop_name string, id bigint, job_type string, "
    "server string, database string, table_name string, enabled boolean, job_id bigint, prop_val string, "
    "prop_class string, generation bigint"
)
# What an event does: create a job with its properties unless it is there, put a row in place,
# put a last value that was reached, or delete a property, a job with its properties.
CREATE, PUT, MARK, DELETE = "create", "put", "mark", "delete"

# The job type, the classes of a property and the names of the properties.
JOB_TYPE = "import"
CLASS_SCHEMA, CLASS_OPTIONS, CLASS_CONFIG = "schema", "options", "config"
TOOL, PROPERTY_SET = "tool", "property.set.id"
CURRENT_PROPERTY_SET = "0"
LAST_VALUE = "incremental.last.value"
SPEC_PROPERTIES = {
    "db.connect.string": "connect_string",
    "db.table": "table",
    "db.split.column": "split_by",
    "mapreduce.num.mappers": "mappers",
    "hdfs.target.dir": "target_dir",
    "incremental.col": "check_col",
    LAST_VALUE: "last_val",
}
LAYOUT_PROPERTY = "hdfs.file.format"
# Whether rows at or below the first last value are wanted when they turn up: "all" or "after".
START_PROPERTY, START_ALL, START_AFTER = "incremental.start", "all", "after"
FIXED_PROPERTIES = {
    LAYOUT_PROPERTY: LAYOUT,
    "compression.codec": CODEC,
    "direct.import": "false",
    "hive.drop.delims": "true",
    "null.string": "",
    "null.non-string": "",
}

JOB_KEY = ["job_name"]
PROP_KEY = ["job_name", "prop_name"]
EVENT_ORDER = ["at", "batch"]

_clock = threading.Lock()
_last_at = 0


def _now() -> int:
    """Nanoseconds by this driver's clock, later than any it gave before."""
    global _last_at
    with _clock:
        _last_at = max(time.time_ns(), _last_at + 1)
        return _last_at


class Registry:
    """Jobs and properties under one root directory."""

    def __init__(self, spark: SparkSession, root: str, landing_root: str):
        self.spark = spark
        self.root = root
        self.landing_root = landing_root
        self._folded: tuple[tuple[str, ...], DataFrame | None] = ((), None)

    def jobs(self) -> DataFrame:
        return _jobs(self._live_events())

    def props(self) -> DataFrame:
        return _props(self._live_events())

    def generations(self) -> DataFrame:
        """job_name, generation (when its last value was last set) and declared (that value)."""
        return _generations(self._live_events())

    def search_jobs(
        self,
        job_name: str | None = None,
        server: str | None = None,
        database: str | None = None,
        table: str | None = None,
        enabled: bool | None = None,
    ) -> DataFrame:
        return keyed.search(
            self.jobs(),
            job_name=job_name,
            server=server,
            database=database,
            table_name=table,
            enabled=enabled,
        )

    def search_props(self, job_name: str | None = None, prop_name: str | None = None) -> DataFrame:
        return keyed.search(self.props(), job_name=job_name, prop_name=prop_name)

    def exists(self, job_name: str) -> tuple[int, bool]:
        """The job's id and true, or -1 and false."""
        found = keyed.lookup(self.jobs(), job_name=job_name).first()
        return (-1, False) if found is None else (found["id"], True)

    def read(self, job_name: str) -> Row:
        """One job with its spec, put together from its properties."""
        live = keyed.search(self._live_events(), job_name=job_name)
        found = self._details(_jobs(live), _props(live), _generations(live)).first()
        if found is None:
            raise JobNotFound(f"job {job_name} does not exist")
        return found

    def details(self, **criteria: object) -> DataFrame:
        """The jobs searched for, each with a column for every property a run needs."""
        return self._details(self.search_jobs(**criteria), self.props(), self.generations())

    def specs(self) -> DataFrame:
        """One row per job with a column for each property a run needs."""
        return _specs(self.props())

    def _details(self, jobs: DataFrame, props: DataFrame, generations: DataFrame) -> DataFrame:
        return keyed.with_children(jobs, _specs(props), JOB_KEY).join(generations, JOB_KEY, "left")

    def create(self, specs: DataFrame, start: str = START_AFTER) -> None:
        """Register the specs whose job is new, each job once; jobs that exist stay as they are."""
        new = _once(specs).join(self.jobs().select(*JOB_KEY), JOB_KEY, "left_anti")
        new = self._taken(new)
        self._append(CREATE, self._job_rows(new), self._prop_rows(new, start))

    def save(self, specs: DataFrame) -> None:
        """Register new jobs, and write the properties of new and old ones."""
        found = self._taken(keyed.with_found(_once(specs), self.jobs(), JOB_KEY))
        new, old = found.where(~F.col("found")).drop("found"), found.where("found").drop("found")
        self._append(CREATE, self._job_rows(new), self._prop_rows(new))
        self._append(PUT, self._changed(self._prop_rows(old, None)))

    def update(self, specs: DataFrame) -> DataFrame:
        """Write the properties of the jobs that exist; the other specs come back.

        A last value other than the one set before starts a new generation of the job; the same
        one changes nothing, however far the job has come since. To go back to that very value
        use `rewind`.
        """
        found = self._taken(keyed.with_found(specs, self.jobs(), JOB_KEY))
        known = _once(found.where("found").drop("found"))
        self._append(PUT, self._changed(self._prop_rows(known, None)))
        return found.where(~F.col("found")).drop("found")

    def update_job(self, rows: DataFrame) -> DataFrame:
        """Replace whole job rows by name; rows of unknown jobs come back."""
        jobs = self.jobs()
        updated, unmatched = keyed.update(jobs, rows, JOB_KEY)
        self._append(PUT, updated.join(keyed.distinct_keys(rows, JOB_KEY), JOB_KEY, "left_semi"))
        return unmatched

    def write_properties(self, rows: DataFrame) -> None:
        """Put property rows in place; the rows hold each job and name once."""
        self._append(PUT, rows)

    def rewind(self, job_name: str, last_val: str) -> None:
        """Make the next run of a job start after this value, whatever its runs have reached."""
        job_id, found = self.exists(job_name)
        if not found:
            raise JobNotFound(f"job {job_name} does not exist")
        row = (job_id, job_name, LAST_VALUE, last_val, CLASS_OPTIONS)
        self.write_properties(small_frame(self.spark, [row], PROPS_SCHEMA))

    def save_settings(self, job_name: str, settings: DataFrame, defaults: DataFrame) -> None:
        """Keep the settings (name, value) that differ from a default of the same name."""
        job_id, found = self.exists(job_name)
        if not found:
            raise JobNotFound(f"job {job_name} does not exist")
        changed = keyed.changed_values(defaults, settings, ["name"], "value")
        self.write_properties(
            changed.select(
                F.lit(job_id).alias("job_id"),
                F.lit(job_name).alias("job_name"),
                F.col("name").alias("prop_name"),
                F.col("new_value").alias("prop_val"),
                F.lit(CLASS_CONFIG).alias("prop_class"),
            )
        )

    def save_marks(self, marks: DataFrame) -> None:
        """Store the last values (job_name, last_val, perhaps generation) reached by jobs."""
        ids = self.jobs().select("job_name", F.col("id").alias("job_id"))
        under = self.generations().select("job_name", "generation")
        marks = marks if "generation" in marks.columns else marks.join(under, JOB_KEY, "left")
        self._append(
            MARK,
            keyed.with_children(ids, marks, JOB_KEY).select(
                "job_id",
                "job_name",
                F.lit(LAST_VALUE).alias("prop_name"),
                F.col("last_val").alias("prop_val"),
                F.lit(CLASS_OPTIONS).alias("prop_class"),
                "generation",
            ),
        )

    def delete(self, job_name: str) -> tuple[int, int]:
        """Delete a job and its properties; the number of each that went."""
        n_jobs = self.search_jobs(job_name=job_name).count()
        n_props = self.search_props(job_name=job_name).count()
        if n_jobs:
            self._append(DELETE, small_frame(self.spark, [(job_name,)], "job_name string"))
        return n_jobs, n_props

    def delete_property(self, job_name: str, prop_name: str) -> int:
        n_gone = self.search_props(job_name, prop_name).count()
        if n_gone:
            key = [(job_name, prop_name)]
            self._append(DELETE, small_frame(self.spark, key, "job_name string, prop_name string"))
        return n_gone

    def tidy(self) -> int:
        """Write the events that still count into one batch; how many batches went.

        Deletions stay: a slow writer's earlier event may still come to light. A driver lost
        between the two steps leaves events twice, which changes nothing.
        """
        folder = f"{self.root}/events"
        names = [n for n in child_names(self.spark, folder) if not n.startswith("_")]
        if len(names) < 2:
            return 0
        events = self._read([f"{folder}/{n}" for n in names])
        live = _live(events).select(*events.columns, F.coalesce("prop_name", F.lit("")).alias("_slot"))
        # Of every slot the last event, of last values the last one set and the last one reached.
        live = live.withColumn("_set", F.col("op") != MARK)
        kept = _last(live, ["job_name", "_slot", "_set"]).drop("_slot", "_set")
        first = live.where(F.col("op") == CREATE).drop("_slot", "_set")
        gone = _last(_deletions(events), JOB_KEY)
        self._write(kept.unionByName(first).unionByName(gone).distinct())
        for name in names:
            delete_path(self.spark, f"{folder}/{name}")
        return len(names)

    def _changed(self, rows: DataFrame) -> DataFrame:
        """Property rows without last values that are the ones set before."""
        before = self.generations().select("job_name", F.col("declared").alias("prop_val"))
        before = before.withColumn("prop_name", F.lit(LAST_VALUE))
        return rows.join(before, ["job_name", "prop_name", "prop_val"], "left_anti")

    def _job_rows(self, specs: DataFrame) -> DataFrame:
        described = describe_jobs(specs, self.landing_root)
        return keyed.with_row_id(described, JOB_KEY).select(
            "id",
            F.lit(JOB_TYPE).alias("job_type"),
            "job_name",
            "server",
            "database",
            F.col("table").alias("table_name"),
            "enabled",
        )

    def _prop_rows(self, specs: DataFrame, start: str | None = START_AFTER) -> DataFrame:
        described = describe_jobs(specs, self.landing_root)
        jobs = keyed.with_row_id(described, JOB_KEY, "job_id")
        options = {name: F.col(column) for name, column in SPEC_PROPERTIES.items()}
        options |= {name: F.lit(value) for name, value in FIXED_PROPERTIES.items()}
        options["incremental.mode"] = F.when(F.col("check_col") != "", F.lit("append")).otherwise(
            F.lit("none")
        )
        if start:
            options[START_PROPERTY] = F.lit(start)
        about = {TOOL: F.lit(JOB_TYPE), PROPERTY_SET: F.lit(CURRENT_PROPERTY_SET)}
        keys = ["job_id", "job_name"]
        return keyed.stack_properties(jobs, keys, about, CLASS_SCHEMA).unionByName(
            keyed.stack_properties(jobs, keys, options, CLASS_OPTIONS)
        )

    def _append(self, op: str, *frames: DataFrame) -> None:
        """All rows as one batch of events, seen together or not at all."""
        at, batch = _now(), uuid.uuid4().hex
        schema = T.StructType.fromDDL(EVENT_SCHEMA)
        given = {"at": F.lit(at), "batch": F.lit(batch), "op": F.lit(op)}
        rows = [
            df.select(
                *(
                    given.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in schema
                )
            )
            for df in frames
        ]
        self._write(reduce(DataFrame.unionByName, rows))

    def _write(self, events: DataFrame) -> None:
        name = f"{time.time_ns()}-{uuid.uuid4().hex}"
        hidden, final = f"{self.root}/events/_{name}", f"{self.root}/events/{name}"
        events.coalesce(1).write.parquet(hidden)
        rename_path(self.spark, hidden, final)

    def _taken(self, specs: DataFrame) -> DataFrame:
        """The specs as they are now, a row per table, so that one look at the registry serves all that follows."""
        return small_frame(self.spark, [tuple(row) for row in specs.collect()], specs.schema)

    def _live_events(self) -> DataFrame:
        """The events that count, folded anew only when there are other batches than the last time.

        Batches never change, so their names tell. What is kept is some rows for each table of
        a database, held by the driver, which makes every look at it a plan without a scan.
        """
        folder = f"{self.root}/events"
        names = tuple(n for n in child_names(self.spark, folder) if not n.startswith("_"))
        known, live = self._folded
        if live is None or names != known:
            found = _live(self._read([f"{folder}/{name}" for name in names]))
            live = self.spark.createDataFrame(found.toArrow(), found.schema).coalesce(1)
            self._folded = (names, live)
        return live

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return small_frame(self.spark, [], EVENT_SCHEMA)
        # A registry is some rows for each table of a database: in one partition no fold shuffles.
        return self.spark.read.schema(EVENT_SCHEMA).parquet(*paths).coalesce(1)


def _names(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).names


def _order(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + name) for name in EVENT_ORDER))


def _once(specs: DataFrame) -> DataFrame:
    """One spec of each job, the first by its fields, so that the same one counts on every run."""
    others = [name for name in specs.columns if name not in JOB_KEY]
    first = specs.groupBy(*JOB_KEY).agg(F.min(F.struct(*others)).alias("_first"))
    return first.select(*JOB_KEY, "_first.*").select(*specs.columns)


def _deletions(events: DataFrame) -> DataFrame:
    return events.where((F.col("op") == DELETE) & F.col("prop_name").isNull())


def _last(events: DataFrame, keys: list[str]) -> DataFrame:
    """The last event of each key (W-03), as one value: events are few, and so one aggregate is quickest."""
    others = [name for name in events.columns if name not in (*keys, *EVENT_ORDER)]
    whole = F.max(F.struct(*EVENT_ORDER, *others)).alias("_event")
    return events.groupBy(*keys).agg(whole).select(*keys, "_event.*").select(*events.columns)


def _jobs(live: DataFrame) -> DataFrame:
    rows = live.where(F.col("prop_name").isNull())
    return _last(rows, JOB_KEY).select(*_names(JOBS_SCHEMA))


def _props(live: DataFrame) -> DataFrame:
    """The last event of each property, reached last values of an earlier generation left out."""
    stale = (F.col("op") == MARK) & (F.coalesce("generation", F.lit(0)) < F.coalesce("_set_at", F.lit(0)))
    rows = live.where(F.col("prop_name").isNotNull() & F.col("_has_job") & ~stale)
    return _last(rows, PROP_KEY).where(F.col("op") != DELETE).select(*_names(PROPS_SCHEMA))


def _generations(live: DataFrame) -> DataFrame:
    return _last(live.where(_sets_last_value()), JOB_KEY).select(
        "job_name", F.col("at").alias("generation"), F.col("prop_val").alias("declared")
    )


def _specs(props: DataFrame) -> DataFrame:
    names = {**SPEC_PROPERTIES, LAYOUT_PROPERTY: "layout", START_PROPERTY: "start"}
    return keyed.read_properties(props, JOB_KEY, names, prop_class=CLASS_OPTIONS)


def _sets_last_value() -> Column:
    return (F.col("prop_name") == LAST_VALUE) & F.col("op").isin(CREATE, PUT)


def _live(events: DataFrame) -> DataFrame:
    """Events after their job's last deletion; of batches that create it those of the first.

    Adds whether the job has a row and when its last value was last set. All of it is told per
    job, so the one shuffle by job also serves what is folded later.
    """
    job = Window.partitionBy("job_name")
    deleted = (F.col("op") == DELETE) & F.col("prop_name").isNull()
    gone = F.max(F.when(deleted, _order())).over(job)
    after = events.withColumn("_gone", gone).where(F.col("_gone").isNull() | (_order() > F.col("_gone")))
    created = F.min(F.when(F.col("op") == CREATE, _order())).over(job)
    first = (F.col("op") != CREATE) | (F.col("batch") == F.col("_first.batch"))
    counts = after.withColumn("_first", created).where(first)
    return counts.withColumns(
        {
            "_has_job": F.max(F.col("prop_name").isNull()).over(job),
            "_set_at": F.max(F.when(_sets_last_value(), F.col("at"))).over(job),
        }
    ).drop("_gone", "_first")


def spec_of(job: Row) -> dict[str, str]:
    """The eight fields of a stored job, each from its own column."""
    db_type = job["job_name"].split(naming.SPEC_SEPARATOR, 1)[0]
    place = [db_type, job["server"], job["database"], job["table_name"]]
    values = [*place, job["split_by"], job["mappers"], job["check_col"], job["last_val"]]
    return dict(zip(naming.SPEC_FIELDS, values, strict=True))
