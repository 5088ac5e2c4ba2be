from datetime import datetime

import pytest

from conftest import rows
from quayside.operators import runlog
from quayside.plans import runs
from quayside.plans.runs import Event, RunLog, Standing
from quayside.session import child_names


@pytest.fixture
def log(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "runs"))


def note(log, run, step, phase, status, second, **facts):
    at = f"2024-03-01T10:00:{second:02d}.000001+00:00"
    log.append(Event(run, "mysql:h:d:t", step, phase, status, at, **facts))


def test_empty_log(log):
    assert log.events().count() == 0
    assert log.standing("mysql:h:d:t") == Standing(None, None)
    assert not log.is_loaded("mysql:h:d:t", "r")


def test_a_run_from_start_to_finish(log):
    note(log, "r1", 1, "import", "STARTED", 1)
    assert log.standing("mysql:h:d:t") == Standing(None, "r1")
    note(log, "r1", 2, "import", "FINISHED", 2, n_rows=7)
    note(log, "r1", 3, "load", "STARTED", 3)
    assert rows(log.runs()) == [
        ("r1", "mysql:h:d:t", "01-03-2024 10:00:01", "01-03-2024 10:00:02", "FINISHED", 7,
         "01-03-2024 10:00:03", None, "STARTED", None)
    ]
    note(log, "r1", 4, "load", "FINISHED", 4, n_rows=6, mark="99")
    assert log.is_loaded("mysql:h:d:t", "r1")
    assert log.standing("mysql:h:d:t") == Standing("99", None)
    assert rows(runlog.phase_counts(log.events())) == [("r1", 7, 6, 1)]
    assert log.search(status="STARTED").count() == 2
    assert log.search(job_name="mysql:h:d:other").count() == 0


def test_a_failed_import(log):
    note(log, "r1", 1, "import", "STARTED", 1)
    note(log, "r1", 5, "import", "ERROR", 2, message="line one\nline two")
    (run,) = log.runs().collect()
    assert (run["import_status"], run["import_finish_time"], run["import_rows"]) == ("ERROR", None, None)
    assert log.search(status="ERROR").first()["message"] == "line one\nline two"


def test_a_run_that_starts_over_counts_once(log):
    note(log, "r1", 1, "import", "STARTED", 1)
    note(log, "r1", 2, "import", "FINISHED", 2, n_rows=5)
    note(log, "r1", 5, "load", "ERROR", 3)
    note(log, "r1", 1, "import", "STARTED", 11)
    note(log, "r1", 2, "import", "FINISHED", 12, n_rows=8)
    note(log, "r1", 4, "load", "FINISHED", 13, n_rows=8, mark="8")
    assert rows(runlog.phase_counts(log.events())) == [("r1", 8, 8, 0)]
    (run,) = log.runs().collect()
    assert (run["load_status"], run["import_start_time"]) == ("FINISHED", "01-03-2024 10:00:01")


def test_mark_survives_an_empty_run(log):
    note(log, "r1", 4, "load", "FINISHED", 1, n_rows=3, mark="30")
    note(log, "r2", 4, "load", "FINISHED", 2, n_rows=0)
    assert log.standing("mysql:h:d:t") == Standing("30", None)
    assert rows(runlog.last_marks(log.events())) == [("mysql:h:d:t", "30")]


def test_fold_states(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 1, "x"), ("a", datetime(2024, 1, 2), 2, "y"),
         ("a", datetime(2024, 1, 2), 3, "z")],
        "k string, t timestamp_ntz, i int, s string",
    )
    assert rows(runlog.fold_states(df, ["k"], "t", "s", ["t", "i"])) == [
        ("a", "01-01-2024 00:00:00", "02-01-2024 00:00:00", "z")
    ]


def test_reconcile_has_groups_of_either_side(spark):
    landed = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    loaded = spark.createDataFrame([("a",), ("c",)], "g string")
    assert rows(runlog.reconcile(landed, loaded, ["g"])) == [
        ("a", 2, 1, 1), ("b", 1, 0, 1), ("c", 0, 1, -1),
    ]


def _thousand_runs(log, n=60):
    for i in range(n):
        second = i % 60
        note(log, f"r{i:03d}", 1, "import", "STARTED", second, generation=i % 3)
        note(log, f"r{i:03d}", 4, "load", "FINISHED", second, n_rows=i, mark=str(i), generation=i % 3)


def _read(log):
    job = "mysql:h:d:t"
    folded = [log.standing(job), log.standing(job, 1), rows(log.runs()), log.search(status="STARTED").count()]
    return folded, rows(log.events())


def test_tidied_events_tell_the_same(log):
    job, folder = "mysql:h:d:t", f"{log.root}/mysql%3Ah%3Ad%3At"
    _thousand_runs(log)
    before = _read(log)
    log.tidy_after = 100
    assert log.tidy(job) and _read(log) == before  # the old files are still there
    assert log.tidy(job) and _read(log) == before
    files = [n for n in child_names(log.spark, folder) if n.endswith(".json") and not n.startswith("_")]
    assert len(files) == 2 and not log.tidy(job)
    note(log, "r100", 1, "import", "STARTED", 59, mark=None)
    assert log.standing(job).open_run == "r100"


@pytest.mark.parametrize("lost_at", ["write_json_lines", "rename_path", "delete_path"])
def test_a_tidy_cut_short_loses_no_event(log, monkeypatch, lost_at):
    job = "mysql:h:d:t"
    log.tidy_after = 20
    _thousand_runs(log, 12)
    before = _read(log)

    def lost(*_):
        raise RuntimeError("driver lost")

    for _ in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(runs, lost_at, lost)
            with pytest.raises(RuntimeError):
                log.tidy(job)
        assert _read(log) == before
    log.tidy_after = 1
    for _ in range(3):
        assert log.tidy(job) and _read(log) == before
