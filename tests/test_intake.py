import threading

import pytest

from conftest import rows
from quayside.errors import JobNotFound, SchemaConflict
from quayside.operators.specs import parse_specs
from quayside.plans import load
from quayside.plans.intake import Intake
from quayside.plans.registry import Registry
from quayside.plans.runs import RunLog
from quayside.session import path_exists
from quayside.sources.databases import ParquetDatabase


class Shop:
    """A folder of Parquet tables and an intake that imports from it."""

    def __init__(self, spark, root, database):
        self.spark, self.root, self.database = spark, root, database
        self.source = f"{root}/source"
        self.intake = Intake(
            spark,
            Registry(spark, f"{root}/registry", f"{root}/landing"),
            RunLog(spark, f"{root}/runs"),
            lambda db_type, server, name: ParquetDatabase(spark, name, self.source),
            f"{root}/target",
        )

    def put(self, table, data, schema):
        df = self.spark.createDataFrame(data, schema)
        df.write.mode("overwrite").parquet(f"{self.source}/{table}.parquet")

    def job(self, table):
        return f"parquet:local:{self.database}:{table}"

    def table(self, table):
        return rows(self.spark.table(f"{self.database}.{table}"))

    def initialise(self):
        return self.intake.initialise("parquet", "local", self.database)


@pytest.fixture
def shop(spark, tmp_path, database):
    return Shop(spark, str(tmp_path), database)


def test_initialise_adds_only_new_tables(shop, monkeypatch):
    shop.put("a", [(1, 5), (2, 5)], "id bigint, n int")
    shop.put("b", [(7,), (7,)], "n int")
    assert shop.initialise().count() == 0
    shop.put("c", [(1,)], "id int")
    looked_at = []
    table = ParquetDatabase.table
    monkeypatch.setattr(
        ParquetDatabase, "table", lambda self, name: looked_at.append(name) or table(self, name)
    )
    shop.initialise()
    assert looked_at == ["c"]
    jobs = shop.intake.registry.jobs().select("table_name", "enabled")
    assert rows(jobs) == [("a", True), ("b", False), ("c", True)]
    assert shop.intake.list_jobs(shop.database).count() == 3
    assert shop.intake.list_jobs("").count() == 3
    assert shop.intake.list_jobs("elsewhere").count() == 0
    assert shop.intake.job_details(shop.job("a")).count() > 7


def test_bad_specs_are_handed_back(spark, shop):
    refused = shop.intake.create_jobs(
        spark.createDataFrame([("mysql:h:d:t:id:4:id:0",), ("mysql:h",)], "input string")
    )
    assert [r["input"] for r in refused.collect()] == ["mysql:h"]
    assert shop.intake.registry.jobs().count() == 1


def test_runs_pick_up_where_the_last_one_stopped(shop):
    shop.put("a", [(0, "x"), (1, "y")], "id bigint, v string")
    shop.initialise()
    first = shop.intake.run_table(shop.job("a"))
    assert (first.n_rows, first.mark) == (2, "1")
    shop.put("a", [(0, "changed"), (1, "y"), (2, "z"), (None, "n")], "id bigint, v string")
    second = shop.intake.run_table(shop.job("a"))
    assert (second.n_rows, second.n_late, second.mark) == (2, 1, "2")
    empty = shop.intake.run_table(shop.job("a"))
    assert (empty.n_rows, empty.mark) == (0, None)
    assert shop.table("a") == [(0, "x"), (1, "y"), (2, "z"), (None, "n")]
    assert shop.intake.registry.read(shop.job("a"))["last_val"] == "2"
    runs = shop.intake.run_log.runs().collect()
    assert sorted((r["import_rows"], r["load_rows"]) for r in runs) == [(0, 0), (2, 2), (2, 2)]
    assert {(r["import_status"], r["load_status"]) for r in runs} == {("FINISHED", "FINISHED")}


def numbers(*ranges):
    return [(i, f"v{i}") for r in ranges for i in r]


def test_late_rows_arrive(shop):
    shop.put("a", numbers(range(100, 200)), "k bigint, v string")
    shop.initialise()
    assert shop.intake.run_table(shop.job("a")).mark == "199"
    shop.put("a", numbers(range(50, 60), range(100, 200)) + [(None, "n")], "k bigint, v string")
    late = shop.intake.run_table(shop.job("a"))
    assert (late.n_rows, late.n_late, late.mark) == (11, 11, None)
    assert shop.intake.run_table(shop.job("a")).n_rows == 0
    # The last value is still the one reached, and later rows are taken once.
    shop.put("a", numbers(range(45, 60), range(100, 210)) + [(None, "n")], "k bigint, v string")
    both = shop.intake.run_table(shop.job("a"))
    assert (both.n_rows, both.n_late, both.mark) == (15, 5, "209")
    assert len(shop.table("a")) == 126


def test_rows_without_a_check_value_arrive_with_the_first_run(shop, spark):
    shop.put("a", [(1, "x"), (None, "n"), (None, "n")], "k bigint, v string")
    spec = (f"{shop.job('a')}:k:4:k:0",)
    shop.intake.create_jobs(spark.createDataFrame([spec], "input string"))
    assert shop.intake.run_table(shop.job("a")).n_rows == 3
    assert shop.intake.run_table(shop.job("a")).n_rows == 0


def test_late_rows_can_be_counted_or_ignored(shop, caplog):
    shop.put("a", numbers(range(10, 20)), "k bigint, v string")
    shop.initialise()
    shop.intake.run_table(shop.job("a"))
    shop.put("a", numbers(range(5, 21)), "k bigint, v string")
    shop.intake.late = "count"
    counted = shop.intake.run_table(shop.job("a"))
    assert (counted.n_rows, counted.n_late) == (1, 5)
    assert "5 rows came below" in caplog.text
    shop.intake.late = "ignore"
    assert shop.intake.run_table(shop.job("a")).n_late == 0


def test_rows_up_to_the_last_value_of_a_spec_are_not_wanted(shop, spark):
    shop.put("a", numbers(range(20)), "k bigint, v string")
    spec = (f"{shop.job('a')}:k:4:k:9",)
    shop.intake.create_jobs(spark.createDataFrame([spec], "input string"))
    assert [shop.intake.run_table(shop.job("a")).n_rows for _ in range(2)] == [10, 0]


def test_a_run_cut_short_after_its_load_keeps_its_late_rows(shop, monkeypatch):
    shop.put("a", numbers(range(10, 20)), "k bigint, v string")
    shop.initialise()
    shop.intake.run_table(shop.job("a"))
    shop.put("a", numbers(range(5, 22)), "k bigint, v string")
    append = RunLog.append

    def lost(self, *events):
        if events[-1].phase == "load" and events[-1].status == "FINISHED":
            raise KeyboardInterrupt
        append(self, *events)

    monkeypatch.setattr(RunLog, "append", lost)
    with pytest.raises(KeyboardInterrupt):
        shop.intake.run_table(shop.job("a"))
    monkeypatch.undo()
    again = shop.intake.run_table(shop.job("a"))
    assert (again.n_rows, again.n_late) == (7, 5)
    assert shop.table("a") == numbers(range(5, 22))


def test_an_edited_last_value_outranks_what_was_reached(shop, spark):
    shop.put("a", numbers(range(10)), "k bigint, v string")

    def spec(last, mappers=4):
        text = (f"{shop.job('a')}:k:{mappers}:k:{last}",)
        return parse_specs(spark.createDataFrame([text], "input string"), "input").drop("spec_error", "input")

    registry, run = shop.intake.registry, lambda: shop.intake.run_table(shop.job("a"))
    registry.create(spec(-1))
    assert [run().n_rows for _ in range(2)] == [10, 0]
    registry.update(spec(-1, mappers=2))
    assert run().n_rows == 0
    registry.update(spec(6))
    assert [run().n_rows for _ in range(2)] == [3, 0]
    registry.rewind(shop.job("a"), "7")
    assert [run().n_rows for _ in range(2)] == [2, 0]
    registry.delete(shop.job("a"))
    registry.create(spec(8))
    assert [run().n_rows for _ in range(2)] == [1, 0]
    assert len(shop.table("a")) == 16


def test_of_two_specs_of_a_job_one_is_refused(shop, spark):
    texts = [(f"{shop.job('a')}:k:4:k:0",), (f"{shop.job('a')}:k:8:k:0",), (f"{shop.job('a')}:k:4:k:0",)]
    refused = shop.intake.create_jobs(spark.createDataFrame(texts, "input string"))
    assert rows(refused) == [(f"{shop.job('a')}:k:8:k:0", "another spec of this job comes first")]
    assert shop.intake.registry.jobs().count() == 1


def test_moments_as_marks_do_not_depend_on_the_session_zone(spark, shop):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    shop = Shop(spark, shop.root, shop.database)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    moments = spark.sql("SELECT timestamp'2024-01-01 00:00:00.5 UTC' + make_dt_interval(id) AS at FROM range(3)")
    moments.write.parquet(f"{shop.source}/a.parquet")
    spec = (shop.job("a") + "::4:at:2024-01-01",)
    shop.intake.create_jobs(spark.createDataFrame([spec], "input string"))
    assert shop.intake.run_table(shop.job("a")).mark == "2024-01-03 00:00:00.5"
    assert shop.intake.run_table(shop.job("a")).n_rows == 0


def test_without_a_check_column_the_whole_table_comes(spark, shop):
    shop.put("a", [(1,), (1,)], "n int")
    shop.intake.create_jobs(spark.createDataFrame([(shop.job("a") + "::4::0",)], "input string"))
    assert shop.intake.run_table(shop.job("a")).n_rows == 2
    assert shop.intake.run_table(shop.job("a")).n_rows == 2
    assert shop.table("a") == [(1,)] * 4


def test_a_finished_run_is_not_run_again(shop):
    shop.put("a", [(1,), (2,)], "id int")
    shop.initialise()
    shop.intake.run_table(shop.job("a"), "run-one")
    assert shop.intake.run_table(shop.job("a"), "run-one").n_rows == 0
    assert shop.table("a") == [(1,), (2,)]


def test_unknown_job(shop):
    with pytest.raises(JobNotFound):
        shop.intake.run_table("parquet:local:d:none")


def test_a_failed_load_changes_nothing_and_can_be_taken_up(shop):
    shop.put("a", [(1, 1)], "id int, v int")
    shop.initialise()
    shop.intake.run_table(shop.job("a"))
    shop.put("a", [(1, "1"), (2, "2")], "id int, v string")
    with pytest.raises(SchemaConflict):
        shop.intake.run_table(shop.job("a"))
    assert shop.table("a") == [(1, 1)]
    assert shop.intake.registry.read(shop.job("a"))["last_val"] == "1"
    standing = shop.intake.run_log.standing(shop.job("a"))
    assert standing.mark == "1"
    landing = f"{shop.root}/landing/local/{shop.database}/a/run-{standing.open_run}"
    assert path_exists(shop.spark, landing)
    (failed,) = shop.intake.run_log.runs().where("load_status = 'ERROR'").collect()
    assert (failed["run_id"], failed["import_rows"]) == (standing.open_run, 1)
    shop.put("a", [(1, 1), (2, 2), (3, 3)], "id int, v int")
    again = shop.intake.run_table(shop.job("a"))
    assert (again.run_id, again.n_rows) == (standing.open_run, 2)
    assert shop.table("a") == [(1, 1), (2, 2), (3, 3)]
    assert not path_exists(shop.spark, landing)


def test_a_failed_import_is_logged(shop):
    shop.put("a", [(1,)], "id int")
    shop.initialise()
    shop.source = f"{shop.root}/gone"
    with pytest.raises(Exception, match="gone"):
        shop.intake.run_table(shop.job("a"))
    (run,) = shop.intake.run_log.runs().collect()
    assert (run["import_status"], run["load_status"]) == ("ERROR", None)


class DriverLost(BaseException):
    """Ends a run the way a lost driver does: nothing more is logged."""


@pytest.mark.parametrize("lost_at", ["land", "ensure_target", "load", "event"])
def test_a_lost_driver_doubles_no_rows(shop, monkeypatch, lost_at):
    shop.put("a", [(i, i) for i in range(10)], "id int, v int")
    shop.initialise()
    with monkeypatch.context() as patch:
        if lost_at == "event":
            append = RunLog.append

            def lose(self, *events):
                if events[-1].step == 4:
                    raise DriverLost
                append(self, *events)

            patch.setattr(RunLog, "append", lose)
        else:
            work = getattr(load, lost_at)

            def lose(*args):
                work(*args)
                raise DriverLost

            patch.setattr(load, lost_at, lose)
        with pytest.raises(DriverLost):
            shop.intake.run_table(shop.job("a"))
    shop.put("a", [(i, i) for i in range(12)], "id int, v int")
    assert shop.intake.run_table(shop.job("a")).n_rows == 12
    assert shop.table("a") == [(i, i) for i in range(12)]
    assert shop.intake.run_table(shop.job("a")).n_rows == 0


def test_a_database_runs_side_by_side_and_survives_a_bad_job(spark, shop, monkeypatch):
    for i in range(13):
        shop.put(f"t{i:02d}", [(k, i) for k in range(i + 1)], "id int, v int")
    shop.put("plain", [(1,), (1,)], "n int")
    shop.initialise()
    busy, most, lock, land = 0, 0, threading.Lock(), load.land

    def watched(df, path, check_col=None):
        nonlocal busy, most
        with lock:
            busy += 1
            most = max(most, busy)
        try:
            if "/t05/" in path:
                raise RuntimeError("disk full")
            return land(df, path, check_col)
        finally:
            with lock:
                busy -= 1

    monkeypatch.setattr(load, "land", watched)
    outcomes = {o.job_name: o for o in shop.intake.run_database(shop.database, batch_size=4)}
    assert len(outcomes) == 13 and 1 < most <= 4
    assert [n for n, o in outcomes.items() if o.error] == [shop.job("t05")]
    for i in (0, 4, 6, 12):
        assert outcomes[shop.job(f"t{i:02d}")].n_rows == i + 1
        assert shop.table(f"t{i:02d}") == [(k, i) for k in range(i + 1)]
    assert not spark.catalog.tableExists(f"{shop.database}.plain")
    assert shop.intake.registry.read(shop.job("t12"))["last_val"] == "12"
    assert shop.intake.registry.read(shop.job("t05"))["last_val"] == "-1"


def test_no_jobs_to_run(shop, caplog):
    assert shop.intake.run_database("nothing") == []
    assert "No jobs found" in caplog.text


def test_sources_with_other_columns_evolve_their_target(shop):
    shop.put("a", [(1, "x")], "ID int, v string")
    shop.initialise()
    shop.intake.run_table(shop.job("a"))
    shop.put("a", [(1, "x", 0.5), (2**40, "y", 1.5)], "Id bigint, v string, W double")
    shop.intake.run_table(shop.job("a"))
    assert shop.table("a") == [(1, "x", None), (2**40, "y", 1.5)]


def test_ports_and_odd_names_go_all_the_way(spark, shop):
    shop.put("odd", [(1, 7, "x"), (2, 8, "y")], "`a.b` bigint, `c`` d` int, `e.f` string")
    shop.put("plain", [(1,)], "id int")
    assert shop.intake.initialise("mysql", "h:3306", shop.database).count() == 0
    job = f"mysql:h:3306:{shop.database}:odd"
    assert rows(shop.intake.registry.jobs().select("job_name", "server", "enabled")) == [
        (job, "h:3306", True), (f"mysql:h:3306:{shop.database}:plain", "h:3306", True),
    ]
    seen = []
    connect = shop.intake.connect
    shop.intake.connect = lambda *place: seen.append(place) or connect(*place)
    assert shop.intake.run_table(job).n_rows == 2
    assert seen == [("mysql", "h:3306", shop.database)]
    shop.put("odd", [(1, 7, "x"), (2, 8, "y"), (3, 9, "z"), (0, 6, "late")], "`a.b` bigint, `c`` d` int, `e.f` string")
    again = shop.intake.run_table(job)
    assert (again.n_rows, again.n_late) == (2, 1)
    assert shop.table("odd") == [(0, 6, "late"), (1, 7, "x"), (2, 8, "y"), (3, 9, "z")]


def test_a_table_that_cannot_be_read_holds_up_no_others(shop, tmp_path, caplog):
    shop.put("good", [(1,)], "id int")
    (tmp_path / "source" / "bad.parquet").mkdir()
    (tmp_path / "source" / "bad.parquet" / "part-0.parquet").write_bytes(b"no parquet")
    assert shop.initialise().count() == 0
    assert rows(shop.intake.registry.jobs().select("table_name")) == [("good",)]
    assert "Table bad" in caplog.text
    shop.put("bad", [(4,)], "id int")
    shop.initialise()
    assert rows(shop.intake.registry.jobs().select("table_name")) == [("bad",), ("good",)]
