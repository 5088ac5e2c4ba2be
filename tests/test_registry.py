import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.errors import JobNotFound
from quayside.operators.specs import good_specs, parse_specs
from quayside.plans.intake import json_lines
from quayside.plans.registry import Registry, spec_of
from quayside.session import child_names

NAME = "mysql:localhost:testdb:testtable"


@pytest.fixture
def registry(spark, tmp_path):
    return Registry(spark, str(tmp_path / "registry"), "/data/lz")


def specs(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "input string")
    return good_specs(parse_specs(df, "input"))


def props(registry, job=NAME):
    found = registry.search_props(job_name=job).collect()
    assert len({r["prop_name"] for r in found}) == len(found)
    return {r["prop_name"]: (r["prop_val"], r["prop_class"]) for r in found}


def test_created_job_reads_back(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0", "mysql:localhost:testdb:other::4::0"))
    job = registry.read(NAME)
    assert spec_of(job) == {
        "db_type": "mysql", "server": "localhost", "database": "testdb", "table": "testtable",
        "split_by": "id", "mappers": "4", "check_col": "id", "last_val": "0",
    }
    assert (job["job_type"], job["enabled"], job["layout"]) == ("import", True, "parquet")
    stored = props(registry)
    assert stored["db.connect.string"] == ("jdbc:mysql://localhost/testdb", "options")
    assert stored["hdfs.target.dir"] == ("/data/lz/localhost/testdb/testtable", "options")
    assert stored["incremental.mode"] == ("append", "options")
    assert stored["tool"] == ("import", "schema")
    assert props(registry, "mysql:localhost:testdb:other")["incremental.mode"] == ("none", "options")
    assert rows(registry.search_jobs(enabled=False).select("table_name")) == [("other",)]
    assert registry.search_jobs(database="testdb").count() == 2
    assert registry.search_jobs(server="elsewhere").count() == 0


def test_a_port_stays_with_its_server(spark, registry):
    df = specs(spark, "mysql:host:db:t:id:4:id:0").withColumn("server", F.lit("host:3306"))
    registry.create(df)
    spec = spec_of(registry.jobs().join(registry.specs(), "job_name").first())
    assert (spec["db_type"], spec["server"], spec["database"], spec["table"]) == (
        "mysql", "host:3306", "db", "t",
    )


def test_ids_join_properties_to_jobs(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    job_id, found = registry.exists(NAME)
    assert found
    assert {r["job_id"] for r in registry.props().collect()} == {job_id}


def test_unknown_job(registry):
    assert registry.exists("foo") == (-1, False)
    with pytest.raises(JobNotFound):
        registry.read("foo")


def test_create_leaves_existing_jobs_as_they_are(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    before = rows(registry.props())
    registry.create(specs(spark, f"{NAME}:other:8:other:5"))
    assert rows(registry.props()) == before
    assert registry.jobs().count() == 1


def test_save_creates_or_updates(spark, registry):
    registry.save(specs(spark, f"{NAME}:id:4:id:0"))
    registry.save(specs(spark, f"{NAME}:id:8:id:5"))
    assert props(registry)["mapreduce.num.mappers"][0] == "8"
    assert props(registry)["incremental.last.value"][0] == "5"
    assert registry.jobs().count() == 1


def test_update_is_for_existing_jobs_only(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    unknown = registry.update(specs(spark, f"{NAME}:id:2:id:0", "mysql:h:d:x:id:4:id:0"))
    assert rows(unknown.select("job_name")) == [("mysql:h:d:x",)]
    assert props(registry)["mapreduce.num.mappers"][0] == "2"
    assert registry.jobs().count() == 1


def test_job_rows_can_be_replaced(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    off = registry.jobs().select("job_name", F.lit(False).alias("enabled"))
    assert registry.update_job(off).count() == 0
    assert registry.search_jobs(enabled=True).count() == 0


def test_delete_takes_properties_along(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0", "mysql:h:d:x:id:4:id:0"))
    n_props = registry.search_props(job_name=NAME).count()
    assert registry.delete(NAME) == (1, n_props)
    assert registry.delete(NAME) == (0, 0)
    assert registry.exists(NAME) == (-1, False)
    assert rows(registry.props().select("job_name").distinct()) == [("mysql:h:d:x",)]


def test_delete_one_property(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    assert registry.delete_property(NAME, "tool") == 1
    assert registry.delete_property(NAME, "tool") == 0
    assert "tool" not in props(registry)


def test_marks_and_settings(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    registry.save_marks(spark.createDataFrame([(NAME, "41"), ("no:such:job:x", "1")], "job_name string, last_val string"))
    assert registry.read(NAME)["last_val"] == "41"
    defaults = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "name string, value string")
    given = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("d", "5")], "name string, value string")
    registry.save_settings(NAME, given, defaults)
    assert {k: v for k, v in props(registry).items() if v[1] == "config"} == {"b": ("3", "config")}


def event_folders(registry):
    return sorted(n for n in child_names(registry.spark, f"{registry.root}/events") if not n.startswith("_"))


def test_writers_side_by_side_lose_nothing(spark, registry):
    names = [f"mysql:h:d:t{i}" for i in range(4)]

    def register(name):
        own = Registry(spark, registry.root, "/data/lz")
        own.create(specs(spark, f"{name}:id:4:id:0"))
        own.save_marks(spark.createDataFrame([(name, "9")], "job_name string, last_val string"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(register, names))
    assert rows(registry.jobs().select("job_name")) == [(n,) for n in names]
    assert rows(registry.specs().select("job_name", "last_val")) == [(n, "9") for n in names]


def test_the_first_of_two_that_create_one_job_counts(spark, registry, monkeypatch):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    import quayside.plans.registry as module

    # A second writer that looked before the first was done.
    monkeypatch.setattr(Registry, "_live_events", lambda self: module._live(self._read([])))
    registry.create(specs(spark, f"{NAME}:other:8:other:5", f"{NAME}:more:8:more:5"))
    monkeypatch.undo()
    assert registry.jobs().count() == 1
    job = registry.read(NAME)
    assert (job["split_by"], job["mappers"], job["last_val"], job["declared"]) == ("id", "4", "0", "0")


def test_specs_of_one_job_register_once(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0", f"{NAME}:id:4:id:0", f"{NAME}:no:4:no:0"))
    assert registry.jobs().count() == 1
    assert registry.read(NAME)["split_by"] == "id"


def test_tidying_loses_nothing(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0", "mysql:h:d:x:id:4:id:0", "mysql:h:d:y:id:4:id:0"))
    registry.delete("mysql:h:d:x")
    registry.update(specs(spark, f"{NAME}:id:8:id:5"))
    registry.save_marks(spark.createDataFrame([(NAME, "41")], "job_name string, last_val string"))
    registry.delete_property(NAME, "tool")
    before = rows(registry.jobs()), rows(registry.props()), rows(registry.generations())
    assert len(event_folders(registry)) > 4
    assert registry.tidy() > 4
    assert len(event_folders(registry)) == 1
    assert (rows(registry.jobs()), rows(registry.props()), rows(registry.generations())) == before
    assert registry.tidy() == 0
    registry.create(specs(spark, "mysql:h:d:x:id:4:id:7"))
    assert registry.read("mysql:h:d:x")["last_val"] == "7"


def test_events_read_twice_change_nothing(spark, registry, monkeypatch):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    registry.save_marks(spark.createDataFrame([(NAME, "41")], "job_name string, last_val string"))
    before = rows(registry.jobs()), rows(registry.props()), rows(registry.generations())
    import quayside.plans.registry as module

    # The driver is lost before the old batches go.
    monkeypatch.setattr(module, "delete_path", lambda s, path: None)
    registry.tidy()
    assert len(event_folders(registry)) == 3
    assert (rows(registry.jobs()), rows(registry.props()), rows(registry.generations())) == before


def test_a_batch_cut_short_is_passed_over(spark, registry, monkeypatch):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    import quayside.plans.registry as module

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(module, "rename_path", lost)
    with pytest.raises(KeyboardInterrupt):
        registry.create(specs(spark, "mysql:h:d:x:id:4:id:0"))
    assert rows(registry.jobs().select("job_name")) == [(NAME,)]


def test_generations(spark, registry):
    def mark(value):
        registry.save_marks(spark.createDataFrame([(NAME, value)], "job_name string, last_val string"))

    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    first = registry.read(NAME)
    mark("41")
    registry.update(specs(spark, f"{NAME}:id:8:id:0"))
    same = registry.read(NAME)
    assert (same["mappers"], same["last_val"], same["generation"]) == ("8", "41", first["generation"])
    registry.update(specs(spark, f"{NAME}:id:8:id:20"))
    edited = registry.read(NAME)
    assert (edited["last_val"], edited["declared"]) == ("20", "20")
    assert edited["generation"] > first["generation"]
    # A run that began before the edit ends after it.
    late = [(NAME, "77", first["generation"])]
    registry.save_marks(spark.createDataFrame(late, "job_name string, last_val string, generation long"))
    assert registry.read(NAME)["last_val"] == "20"
    mark("50")
    registry.rewind(NAME, "20")
    assert registry.read(NAME)["last_val"] == "20"
    assert registry.read(NAME)["generation"] > edited["generation"]
    registry.delete(NAME)
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    assert registry.read(NAME)["last_val"] == "0"
    with pytest.raises(JobNotFound):
        registry.rewind("no:such:job:x", "1")


def test_listing(spark, registry):
    registry.create(specs(spark, f"{NAME}:id:4:id:0"))
    (line,) = [json.loads(r["j"]) for r in json_lines(registry.jobs()).collect()]
    assert line == {
        "id": registry.exists(NAME)[0], "job_type": "import", "job_name": NAME,
        "server": "localhost", "database": "testdb", "table_name": "testtable", "enabled": True,
    }
