"""Run-log events, folded and reconciled.

The log is append-only: one row per change of state. What a run looks like now is a fold
over its events, made with aggregates that combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.clock import to_display

# Phases and states of a run.
IMPORT, LOAD = "import", "load"
STARTED, FINISHED, ERROR = "STARTED", "FINISHED", "ERROR"

EVENT_SCHEMA = (
    "run_id string, job_name string, step int, phase string, status string, "
    "at timestamp, n_rows bigint, mark string, message string, generation bigint"
)

def fold_states(
    events: DataFrame, keys: list[str], at: str, status: str, order: list[str]
) -> DataFrame:
    """Per key: first and last time as text, and the status of the last event by `order`."""
    return events.groupBy(*keys).agg(
        to_display(F.min(at)).alias("start_time"),
        to_display(F.max(at)).alias("finish_time"),
        F.max_by(status, F.struct(*order)).alias("status"),
    )


def run_view(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per run: start, finish, status and row count of each phase.

    A phase that has not finished has no finish time and no count; it may well have failed.
    """
    columns = []
    for phase in (IMPORT, LOAD):
        here = F.col("phase") == phase
        started, done = here & (F.col("status") == STARTED), here & (F.col("status") == FINISHED)
        columns += [
            to_display(F.min(F.when(started, F.col("at")))).alias(f"{phase}_start_time"),
            to_display(F.max(F.when(done, F.col("at")))).alias(f"{phase}_finish_time"),
            F.max_by("status", F.when(here, _order())).alias(f"{phase}_status"),
            _rows_of(phase).alias(f"{phase}_rows"),
        ]
    return events.groupBy(*(keys or ["run_id", "job_name"])).agg(*columns)


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: whether its load finished, the mark it reached, its last event.

    Also the generation of the last value it ran under, where the events tell.
    """
    done = (F.col("phase") == LOAD) & (F.col("status") == FINISHED)
    told = ["mark", *(["generation"] if "generation" in events.columns else [])]
    return events.groupBy("job_name", "run_id").agg(
        F.max(done).alias("loaded"),
        *(F.max_by(name, F.when(done, _order())).alias(name) for name in told),
        F.max("at").alias("last_at"),
    )


def last_marks(events: DataFrame) -> DataFrame:
    """The last value reached by each job: the mark of its latest loaded run that has one."""
    marked = run_states(events).where(F.col("mark").isNotNull())
    return marked.groupBy("job_name").agg(F.max_by("mark", "last_at").alias("last_val"))


def phase_counts(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows imported and loaded by each run, and how far they differ."""
    return _compare(events, keys or ["run_id"], _rows_of)


def reconcile(landed: DataFrame, loaded: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group on either side, and how far they differ."""
    tagged = landed.select(*by, F.lit(IMPORT).alias("phase")).unionByName(
        loaded.select(*by, F.lit(LOAD).alias("phase"))
    )
    return _compare(tagged, by, lambda phase: F.count_if(F.col("phase") == phase))


def _order() -> Column:
    return F.struct("at", "step")


def _rows_of(phase: str) -> Column:
    """Rows of a phase when it last finished; a run that started over counts once."""
    done = (F.col("phase") == phase) & (F.col("status") == FINISHED)
    return F.max_by("n_rows", F.when(done, _order()))


def _compare(df: DataFrame, by: list[str], count) -> DataFrame:
    def total(phase: str) -> Column:
        return F.coalesce(count(phase), F.lit(0))

    counted = df.groupBy(*by).agg(total(IMPORT).alias("landed"), total(LOAD).alias("loaded"))
    return counted.withColumn("difference", F.col("landed") - F.col("loaded"))
