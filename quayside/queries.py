"""Every operator as a query on the given tables, next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import clock
from quayside.functions import text as texts
from quayside.functions.naming import (
    config_key,
    connect_string,
    environment_key,
    job_name_of_connection,
    landing_path,
)
from quayside.operators import groups, keyed, profile, runlog, schema
from quayside.operators.discovery import discover_specs
from quayside.operators.specs import describe_jobs, good_specs, parse_specs
from quayside.plans import load
from quayside.plans.intake import Intake, json_lines
from quayside.plans.registry import Registry
from quayside.plans.runs import RunLog
from quayside.session import apply_settings, new_dir, small_frame
from quayside.sources import datasets
from quayside.sources.databases import ParquetDatabase
from quayside.sources.incremental import high_mark, increment
from quayside.streaming.file_import import land_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# The given tables and their whole-number columns, in order.
WHOLE_NUMBERS = {
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "customer": ["c_custkey", "c_nationkey"],
    "documents": ["doc_id", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "events": ["event_id", "user_id"],
    "labels": ["doc_id", "quality", "toxic"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "nation": ["n_nationkey", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "pages": ["page_id"],
    "part": ["p_partkey", "p_size"],
    "region": ["r_regionkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
}
DATABASE = "sf"


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_settings(spark), sf_dir)

        QUERIES[function.__name__] = run
        ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _union_all(parts) -> str:
    return " union all ".join(parts)


# Sources and sinks


@query("select * from orders")
def full_import(spark, sf_dir):
    """A source with upper-case names; the landed table has lower-case ones."""
    landing, orders = new_dir(spark, "landing"), table(spark, sf_dir, "orders")
    load.land(orders.toDF(*(c.upper() for c in orders.columns)), landing)
    return datasets.open_landing(spark, landing)


@query(
    "with b as (select (min(o_orderkey) + max(o_orderkey)) // 2 as middle from orders) "
    "select o.*, cast(case when o_orderkey <= middle then 1 else 2 end as integer) as batch "
    "from orders o, b"
)
def incremental_append(spark, sf_dir):
    """A first import of the table as it once stood, then an import of what came since."""
    orders = table(spark, sf_dir, "orders")
    low, top = profile.split_bounds(orders, "o_orderkey") or (0, 0)
    earlier = orders.where(F.col("o_orderkey") <= (low + top) // 2)
    last, batches = None, []
    for number, source in enumerate((earlier, orders), start=1):
        landing = new_dir(spark, "landing")
        high = high_mark(source, "o_orderkey", last)
        rows = increment(source, "o_orderkey", last, high)
        last = load.land(rows, landing, "o_orderkey").mark or last
        batch = datasets.open_landing(spark, landing)
        batches.append(batch.withColumn("batch", F.lit(number)))
    return schema.union_by_name(*batches)


@query("select * from orders")
def stream_import(spark, sf_dir):
    """Import by files that are new since the last import; the second call finds none."""
    landing, checkpoint = new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    orders = table(spark, sf_dir, "orders").schema
    for _ in range(2):
        land_new_files(spark, sf_dir, orders, landing, checkpoint, "orders.parquet")
    return datasets.open_landing(spark, landing)


@query("select * from documents")
def csv_import(spark, sf_dir):
    """Texts with line breaks, quotes and outer blanks."""
    documents, path = table(spark, sf_dir, "documents"), new_dir(spark, "csv")
    datasets.write_csv(documents, path)
    return datasets.read_csv(spark, path, documents.schema)


@query(
    "select doc_id, nullif(replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), ''), '')"
    " as text, lang, source, n_chars from documents"
)
def unescape_text(spark, sf_dir):
    documents, path = table(spark, sf_dir, "documents"), new_dir(spark, "text")
    datasets.write_escaped(documents, path)
    return datasets.read_escaped(spark, path, documents.schema)


@query("select * from part")
def chosen_format(spark, sf_dir):
    part, path = table(spark, sf_dir, "part"), new_dir(spark, "dataset")
    datasets.create_dataset(spark, path, part.schema, "orc")
    part.write.format("orc").mode("append").save(path)
    return datasets.create_dataset(spark, path, part.schema, "orc")


@query(
    "select count(*) as n_rows, cast(max(o_orderkey) as varchar) as last_value from orders"
)
def load_counts(spark, sf_dir):
    """Row count and high-water mark as the load reports them."""
    loaded, landed = _land_and_load(
        spark, new_dir(spark, "load"), table(spark, sf_dir, "orders"), "orders", "o_orderkey"
    )
    return small_frame(
        spark, [(loaded.n_rows, landed.mark)], "n_rows bigint, last_value string"
    )


@query(
    "select c_custkey, c_name, c_nationkey, "
    "case when c_nationkey >= 12 then c_mktsegment end as c_mktsegment from customer"
)
def evolve_load(spark, sf_dir):
    """Two batches into one table; the second has a wider key and one more column."""
    customer = table(spark, sf_dir, "customer")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    narrow = customer.withColumn("c_custkey", F.col("c_custkey").cast("int"))
    first = narrow.where("c_nationkey < 12").select(*columns[:-1])
    second = customer.where("c_nationkey >= 12").select(*columns)
    root = new_dir(spark, "load")
    for batch in (first, second):
        _land_and_load(spark, root, batch, "customer")
    return spark.table(f"{_catalog_name(root)}.customer").select(*columns)


@query(
    "select o_orderkey, cast(round(case when o_orderstatus = 'O' then o_totalprice / 4 else o_totalprice end, "
    "case when o_orderstatus = 'O' then 4 else 2 end) as double) as price from orders"
)
def evolve_decimals(spark, sf_dir):
    """Two batches of prices, the second with more digits behind the point."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    is_open, price = F.col("o_orderstatus") == "O", F.col("o_totalprice")
    first = orders.where(~is_open).select("o_orderkey", price.cast("decimal(12,2)").alias("price"))
    second = orders.where(is_open).select("o_orderkey", (price / 4).cast("decimal(13,4)").alias("price"))
    root = new_dir(spark, "load")
    for batch in (first, second):
        _land_and_load(spark, root, batch, "orders")
    return spark.table(f"{_catalog_name(root)}.orders").select("o_orderkey", F.col("price").cast("double"))


def _land_and_load(spark, root, rows, name, check_col=None):
    run_id = new_dir(spark, "run").rsplit("-", 1)[1]
    landing, database = f"{root}/landing/run-{run_id}", _catalog_name(root)
    landed = load.land(rows, landing, check_col)
    target = load.ensure_target(spark, database, name, f"{root}/target", rows.schema)
    path = load.table_path(f"{root}/target", database, name)
    loaded = load.load(spark, landing, target, path, run_id)
    load.clean_up(spark, landing)
    return loaded, landed


def _catalog_name(root: str) -> str:
    return "load_" + root.rsplit("-", 1)[1]


# Cleaning and types


@query(
    "select doc_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), '') as text, "
    "lang, source from documents"
)
def drop_delimiters(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return texts.drop_all_delimiters(documents)


@query(
    "select d.doc_id, ifnull(cast(l.quality as varchar), '') as quality "
    "from documents d left join labels l on d.doc_id = l.doc_id"
)
def null_substitute(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return labelled.select("doc_id", texts.null_to_text(F.col("quality")).alias("quality"))


@query("select event_id, epoch_us(ts) // 1000 as ts from events")
def epoch_flatten(spark, sf_dir):
    return schema.flatten_types(table(spark, sf_dir, "events").select("event_id", "ts"))


# Schemas


@query(
    "select s_suppkey as k, s_name as name, s_acctbal as balance, null::varchar as seg from supplier "
    "union all select c_custkey, c_name, c_acctbal, c_mktsegment from customer "
    "union all select n_nationkey, n_name, null, null from nation"
)
def conform_append(spark, sf_dir):
    """Three batches, each short of some columns, one with a narrower key."""
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS k", "s_name AS name", "s_acctbal AS balance"
    )
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_acctbal AS balance", "c_mktsegment AS seg", "c_name AS name", "c_custkey AS k"
    )
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS k", "n_name AS name")
    return schema.union_by_name(supplier, customer, nation)


@query(
    "with s as (select count(c_custkey) a, count(c_name) b, count(c_acctbal) c, "
    "count(nullif(c_mktsegment, 'FURNITURE')) d from customer), "
    "t as (select count(c_custkey) a, count(c_name) b, count(c_nationkey) c from customer) "
    "select 'c_custkey' as field, 'bigint' as source_type, 'int' as target_type, "
    "'widened' as action, s.a as n_source, t.a as n_target from s, t "
    "union all select 'c_name', 'string', 'string', 'same', s.b, t.b from s, t "
    "union all select 'c_nationkey', null, 'int', 'kept', null, t.c from s, t "
    "union all select 'c_acctbal', 'double', null, 'added', s.c, null from s, t "
    "union all select 'c_mktsegment', 'string', null, 'added', s.d, null from s, t"
)
def schema_diff(spark, sf_dir):
    """What loading a batch would change in its table, with the values each field holds."""
    customer = table(spark, sf_dir, "customer")
    source = customer.selectExpr(
        "c_custkey AS C_CUSTKEY",
        "c_name",
        "c_acctbal",
        "nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment",
    )
    target = customer.selectExpr("CAST(c_custkey AS int) AS c_custkey", "c_name", "c_nationkey")
    n_source = schema.values_per_field(source).withColumnRenamed("n_values", "n_source")
    n_target = schema.values_per_field(target).withColumnRenamed("n_values", "n_target")
    diff = schema.schema_diff(source, target)
    return diff.join(n_source, "field", "left").join(n_target, "field", "left")


# Splits, keys and discovery


@query(
    "with b as (select min(o_orderkey) lo, max(o_orderkey) hi from orders), "
    "s as (select cast(i as integer) split_id, lo + i * ((hi - lo) // 4 + 1) lower_bound, "
    "lo + (i + 1) * ((hi - lo) // 4 + 1) upper_bound from b, range(4) t(i)) "
    "select split_id, lower_bound, upper_bound, count(*) as n_rows from orders "
    "join s on o_orderkey >= lower_bound and o_orderkey < upper_bound group by all"
)
def split_report(spark, sf_dir):
    return profile.split_report(table(spark, sf_dir, "orders"), "o_orderkey", 4)


@query(
    _union_all(
        f"select '{name}' as table_name, '{c}' as column_name, count(*) as n_rows, "
        f"count(*) - count({c}) as n_nulls, count(distinct {c}) as n_distinct, "
        f"cast(min({c}) as bigint) as lo, cast(max({c}) as bigint) as hi from {name}"
        for name, columns in WHOLE_NUMBERS.items()
        for c in columns
    )
)
def key_profile(spark, sf_dir):
    return profile.column_profile({name: table(spark, sf_dir, name) for name in WHOLE_NUMBERS})


@query(
    "select distinct lang || '_' || source || '_' || d.doc_id as table_name, "
    "concat_ws(':', 'mysql', 'localhost', 'lake', lang || '_' || source || '_' || d.doc_id, "
    "ifnull(case when l.quality = 1 then 'q' || l.toxic end, ''), '4', "
    "ifnull(case when l.quality = 1 then 'q' || l.toxic end, ''), '0') as input "
    "from documents d left join labels l on d.doc_id = l.doc_id order by table_name"
)
def table_discovery(spark, sf_dir):
    """Each document stands for a table, each label for a column of it."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    name = F.concat_ws("_", "lang", "source", "doc_id").alias("table_name")
    tables = documents.select(F.lit("lake").alias("table_schema"), name)
    columns = documents.join(labels, "doc_id").select(
        F.lit("lake").alias("table_schema"),
        name,
        F.concat(F.lit("q"), "toxic").alias("column_name"),
        F.when(F.col("quality") == 1, "auto_increment").otherwise("").alias("extra"),
        F.lit(None).cast("string").alias("last_val"),
    )
    return discover_specs(tables, columns, "mysql", "localhost", "lake")


_SPEC = (
    "concat_ws(':', 'mysql', o_orderstatus, o_orderpriority, concat('t', o_custkey), "
    "case when o_orderstatus = 'F' then '' else 'o_orderkey' end, "
    "case when o_orderpriority = '1-URGENT' then 'four' else '4' end, 'o_orderkey', "
    "case when o_orderpriority = '2-HIGH' then '' else cast(o_orderkey as varchar(20)) end)"
)


@query(
    f"with s as (select o_orderkey, string_split({_SPEC}, ':') as p, o_orderpriority as pr from orders) "
    "select o_orderkey, p[1] as db_type, p[2] as server, p[3] as database, p[4] as \"table\", "
    "p[5] as split_by, p[6] as mappers, p[7] as check_col, nullif(p[8], '') as last_val, "
    "concat_ws(':', p[1], p[2], p[3], p[4]) as job_name, "
    "case when pr = '2-HIGH' then 'expected 8 fields, found 7' "
    "when pr = '1-URGENT' then 'mappers is not a number' end as spec_error, "
    "'jdbc:' || p[1] || '://' || p[2] || '/' || p[3] as connect_string, "
    "'/data/lz/' || p[2] || '/' || p[3] || '/' || p[4] as target_dir, "
    "concat_ws(':', p[1], p[2], p[3], p[4]) as name_again from s"
)
def spec_parse(spark, sf_dir):
    specs = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SPEC).alias("spec"))
    place = F.col("server"), F.col("database")
    return (
        parse_specs(specs, "spec")
        .withColumn("connect_string", connect_string(F.col("db_type"), *place))
        .withColumn("target_dir", landing_path(load.LANDING_ROOT, *place, F.col("table")))
        .withColumn("name_again", job_name_of_connection(F.col("connect_string"), F.col("table")))
        .drop("spec")
    )


@query(
    "select s_suppkey, 'host-' || s_nationkey || ':' || (3306 + s_nationkey) as server, 'shop' as database, "
    "'t' || s_suppkey as \"table\", 'mysql:host-' || s_nationkey || ':' || (3306 + s_nationkey) || ':shop:t' || s_suppkey "
    "as job_name, 'jdbc:mysql://host-' || s_nationkey || ':' || (3306 + s_nationkey) || '/shop' as connect_string, "
    "'/data/lz/host-' || s_nationkey || '_' || (3306 + s_nationkey) || '/shop/t' || s_suppkey as target_dir from supplier"
)
def server_ports(spark, sf_dir):
    """Specs of servers with a port."""
    spec = F.expr("'mysql:host-' || s_nationkey || ':' || (3306 + s_nationkey) || ':shop:t' || s_suppkey || ':id:4:id:0'")
    specs = table(spark, sf_dir, "supplier").select("s_suppkey", spec.alias("spec"))
    return describe_jobs(good_specs(parse_specs(specs, "spec")), load.LANDING_ROOT).select(
        "s_suppkey", "server", "database", "table", "job_name", "connect_string", "target_dir"
    )


@query(
    "select doc_id, lower(concat_ws('.', lang, source, 'Doc.' || doc_id, 'username')) as config_key, "
    "upper(concat_ws('_', lang, replace(replace(source || '-a.b', '.', '_'), '-', '_'), "
    "'Doc.' || doc_id, 'usr')) as environment_key from documents"
)
def setting_keys(spark, sf_dir):
    """Names under which a database's user would be looked up."""
    kind, place = F.col("lang"), F.concat("source", F.lit("-a.b"))
    name = F.concat(F.lit("Doc."), "doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        config_key(kind, F.col("source"), name, "username").alias("config_key"),
        environment_key(kind, place, name, "usr").alias("environment_key"),
    )


@query(
    "select event_id, strftime(ts, '%d-%m-%Y %H:%M:%S') as shown, "
    "date_trunc('second', ts)::timestamp as read_back from events"
)
def display_times(spark, sf_dir):
    shown = table(spark, sf_dir, "events").select(
        "event_id", clock.to_display(F.col("ts")).alias("shown")
    )
    read_back = clock.from_display(F.col("shown")).cast("timestamp_ntz")
    return shown.withColumn("read_back", read_back)


# Keyed tables


@query(
    "select 'c' || c_custkey as row_key, c_name as name from customer "
    "union all select 's' || s_suppkey, s_name from supplier"
)
def insert_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return keyed.insert(
        customer.select(F.concat(F.lit("c"), "c_custkey").alias("row_key"), F.col("c_name").alias("name")),
        supplier.select(F.col("s_name").alias("name"), F.concat(F.lit("s"), "s_suppkey").alias("row_key")),
    )


@query("select * from events where event_type = 'error' and user_id = 13")
def optional_search(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return keyed.search(events, event_type="error", user_id=13, props=None)


@query("select * from orders where o_orderkey = 1000")
def point_lookup(spark, sf_dir):
    return keyed.lookup(table(spark, sf_dir, "orders"), o_orderkey=1000)


@query(
    "select d.doc_id, d.lang, exists(select 1 from labels l where l.doc_id = d.doc_id) as found "
    "from documents d"
)
def key_exists(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return keyed.with_found(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "select doc_id, quality from labels union all select doc_id, -1 from documents d "
    "where not exists (select 1 from labels l where l.doc_id = d.doc_id)"
)
def insert_if_absent(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return keyed.insert_if_absent(labels, rows, ["doc_id"])


@query(
    "select user_id, event_type, value, event_id from events qualify row_number() over "
    "(partition by user_id, event_type order by case when event_type in ('click', 'view') "
    "then -event_id else event_id end) = 1"
)
def upsert_latest(spark, sf_dir):
    """The first event of each user and type is kept; later clicks and views replace it."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    key = ["user_id", "event_type"]
    kept = keyed.first_per_key(events, key, ["event_id"])
    incoming = events.where(F.col("event_type").isin("click", "view"))
    return keyed.upsert(kept, incoming, key, ["event_id"])


@query(
    "select d.doc_id, d.lang, case when l.doc_id is not null then l.quality else -1 end as quality "
    "from documents d left join labels l on d.doc_id = l.doc_id"
)
def update_by_key(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.lit(-1).alias("quality")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return keyed.update(documents, labels, ["doc_id"])[0]


@query(
    "select 'customer' as table_name, c_custkey as row_key from customer "
    "where c_mktsegment <> 'FURNITURE' "
    "union all select 'orders', o_orderkey from orders where not exists "
    "(select 1 from customer where c_custkey = o_custkey and c_mktsegment = 'FURNITURE')"
)
def delete_cascade(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    doomed = customer.where("c_mktsegment = 'FURNITURE'")
    customers, kept = keyed.delete_cascade(customer, orders, doomed, "c_custkey", "o_custkey")
    return customers.select(
        F.lit("customer").alias("table_name"), F.col("c_custkey").alias("row_key")
    ).unionByName(
        kept.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("row_key"))
    )


@query(
    "select * from (select user_id, event_type, arg_min(value, event_id) as base_value, "
    "arg_max(value, event_id) as new_value from events group by all) "
    "where base_value is not null and base_value is distinct from new_value"
)
def changed_values(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    key, order = ["user_id", "event_type"], ["event_id"]
    base, new = keyed.first_per_key(events, key, order), keyed.latest_per_key(events, key, order)
    return keyed.changed_values(base, new, key, "value")


@query(
    _union_all(
        f"select c_custkey, 'options' as prop_class, '{c}' as prop_name, "
        f"cast({c} as varchar) as prop_val from customer"
        for c in ("c_name", "c_nationkey", "c_mktsegment")
    )
)
def property_stack(spark, sf_dir):
    properties = {c: F.col(c) for c in ("c_name", "c_nationkey", "c_mktsegment")}
    customer = table(spark, sf_dir, "customer")
    return keyed.stack_properties(customer, ["c_custkey"], properties, "options")


@query(
    "select user_id, arg_max(value, event_id) filter (where event_type = 'click') as click, "
    "arg_max(value, event_id) filter (where event_type = 'view') as view "
    "from events group by user_id"
)
def property_read(spark, sf_dir):
    return keyed.read_properties(
        table(spark, sf_dir, "events"),
        ["user_id"],
        {"click": "click", "view": "view"},
        "event_type",
        "value",
        ["event_id"],
    )


@query(
    "select c_custkey, c_name as name, cast(c_nationkey as varchar) as nation, "
    "null::varchar as segment from customer"
)
def property_class(spark, sf_dir):
    """Properties of two classes written, those of one read back."""
    customer, key = table(spark, sf_dir, "customer"), ["c_custkey"]
    options = {"name": F.col("c_name"), "nation": F.col("c_nationkey")}
    config = {"name": F.lit("not this"), "segment": F.col("c_mktsegment")}
    stored = keyed.stack_properties(customer, key, options, "options").unionByName(
        keyed.stack_properties(customer, key, config, "config")
    )
    names = {"name": "name", "nation": "nation", "segment": "segment"}
    return keyed.read_properties(stored, key, names, prop_class="options")


@query(
    "select c_custkey, c_name, o_orderkey, o_totalprice from customer join orders "
    "on c_custkey = o_custkey"
)
def parent_child(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    return keyed.with_children(customer, orders, ["c_custkey"])


@query(
    "select to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, "
    "'c_mktsegment': c_mktsegment})::varchar as j from customer"
)
def json_listing(spark, sf_dir):
    return json_lines(table(spark, sf_dir, "customer").drop("c_acctbal"))


# Run log


@query(
    "select user_id, strftime(min(ts), '%d-%m-%Y %H:%M:%S') as start_time, "
    "strftime(max(ts), '%d-%m-%Y %H:%M:%S') as finish_time, "
    "last(event_type order by ts, event_id) as status from events group by user_id"
)
def run_log_fold(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return runlog.fold_states(events, ["user_id"], "ts", "event_type", ["ts", "event_id"])


_PHASE = "case when value < 20 then 'import' else 'load' end"
_STATUS = (
    "case when event_type = 'error' then 'ERROR' when event_type = 'view' then 'STARTED' "
    "else 'FINISHED' end"
)


def _run_view_sql() -> str:
    columns = []
    for phase in (runlog.IMPORT, runlog.LOAD):
        here = f"phase = '{phase}'"
        columns += [
            f"strftime(min(ts) filter ({here} and status = 'STARTED'), '%d-%m-%Y %H:%M:%S') "
            f"as {phase}_start_time",
            f"strftime(max(ts) filter ({here} and status = 'FINISHED'), '%d-%m-%Y %H:%M:%S') "
            f"as {phase}_finish_time",
            f"last(status order by ts, event_id) filter ({here}) as {phase}_status",
            f"last(event_id order by ts, event_id) filter ({here} and status = 'FINISHED') "
            f"as {phase}_rows",
        ]
    return (
        f"with e as (select *, {_PHASE} as phase, {_STATUS} as status from events) "
        f"select user_id, {', '.join(columns)} from e group by user_id"
    )


def _as_run_events(events: DataFrame) -> DataFrame:
    """Events read as run events: a user is a run, the event's id is its row count."""
    return events.select(
        "user_id",
        F.expr(_PHASE).alias("phase"),
        F.expr(_STATUS).alias("status"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("step"),
        F.col("event_id").alias("n_rows"),
    )


@query(_run_view_sql())
def run_log_view(spark, sf_dir):
    return runlog.run_view(_as_run_events(table(spark, sf_dir, "events")), ["user_id"])


@query(
    f"with e as (select *, {_PHASE} as phase, {_STATUS} as status from events), "
    "c as (select user_id, "
    "ifnull(last(event_id order by ts, event_id) filter (phase = 'import' and status = 'FINISHED'), 0) "
    "as landed, "
    "ifnull(last(event_id order by ts, event_id) filter (phase = 'load' and status = 'FINISHED'), 0) "
    "as loaded from e group by user_id) select *, landed - loaded as difference from c"
)
def phase_counts(spark, sf_dir):
    events = _as_run_events(table(spark, sf_dir, "events"))
    return runlog.phase_counts(events, ["user_id"])


@query(
    "select o_orderpriority, count(*) as landed, count(*) filter (m) as loaded, "
    "count(*) filter (not m) as difference from (select o_orderpriority, "
    "exists(select 1 from lineitem where l_orderkey = o_orderkey) as m from orders) "
    "group by o_orderpriority"
)
def phase_reconcile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    _, with_lines = keyed.delete(orders, lines, ["o_orderkey"])
    return runlog.reconcile(orders, with_lines, ["o_orderpriority"])


@query(
    f"with e as (select *, {_PHASE} as phase, {_STATUS} as status from events), "
    "r as (select user_id, event_type, max(ts) as last_at, cast(last(event_id order by ts, event_id) "
    "filter (phase = 'load' and status = 'FINISHED') as varchar) as mark from e group by all) "
    "select cast(user_id as varchar) as job_name, arg_max(mark, last_at) as last_val from r "
    "where mark is not null group by user_id"
)
def last_marks(spark, sf_dir):
    """A user is a job, its events of one type are a run, an event's id is the mark."""
    events = table(spark, sf_dir, "events")
    return runlog.last_marks(
        events.select(
            F.col("user_id").cast("string").alias("job_name"),
            F.col("event_type").alias("run_id"),
            F.expr(_PHASE).alias("phase"),
            F.expr(_STATUS).alias("status"),
            F.col("ts").alias("at"),
            F.col("event_id").alias("step"),
            F.col("event_id").cast("string").alias("mark"),
        )
    )


# Groups of neighbouring rows


@query(
    "select c_custkey, c_nationkey, "
    "(row_number() over (partition by c_nationkey order by c_custkey) - 1) // 10 as batch_id "
    "from customer"
)
def batch_groups(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return groups.disjoint_groups(customer, ["c_nationkey"], "c_custkey")


@query(
    "select c_nationkey, c_custkey as first_key, last_key, cast(n as integer) as n from "
    "(select c_nationkey, c_custkey, last(c_custkey) over w as last_key, count(*) over w as n, "
    "row_number() over (partition by c_nationkey order by c_custkey) as row_no from customer "
    "window w as (partition by c_nationkey order by c_custkey "
    "rows between current row and 9 following)) where n = 10 or row_no = 1"
)
def sliding_groups(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return groups.sliding_groups(customer, ["c_nationkey"], "c_custkey").drop("members")


# Whole jobs


def _key_case(columns: list[str], found, missing: str) -> str:
    cases = (
        f"when count({c}) = count(*) and count(distinct {c}) = count(*) then {found(c)}"
        for c in columns
    )
    return f"case {' '.join(cases)} else {missing} end"


@query(
    _union_all(
        f"select '{name}' as table_name, 'parquet:local:sf:{name}' as job_name, "
        f"{_key_case(columns, lambda c: 'true', 'false')} as enabled, "
        f"{_key_case(columns, lambda c: repr(c), repr(''))} as split_by, "
        f"{_key_case(columns, lambda c: repr(c), repr(''))} as check_col, "
        f"{_key_case(columns, lambda c: f'cast(min({c}) - 1 as varchar)', repr('0'))} as last_val "
        f"from {name}"
        for name, columns in WHOLE_NUMBERS.items()
    )
)
def initialise_database(spark, sf_dir):
    """The jobs registered for a folder of tables, with the keys found in their rows."""
    intake = _intake(spark, sf_dir)
    intake.initialise("parquet", "local", DATABASE)
    specs = intake.registry.specs().select("job_name", "split_by", "check_col", "last_val")
    jobs = intake.registry.search_jobs(database=DATABASE)
    jobs = jobs.select("table_name", "job_name", "enabled")
    return keyed.with_children(jobs, specs, ["job_name"])


@query("select * from orders")
def resume_import(spark, sf_dir):
    """A job run twice; its second run goes on from the last value its first run reached."""
    orders = table(spark, sf_dir, "orders")
    low, top = profile.split_bounds(orders, "o_orderkey") or (0, 0)
    earlier = new_dir(spark, "source")
    orders.where(F.col("o_orderkey") <= (low + top) // 2).write.parquet(f"{earlier}/orders.parquet")
    intake, database = _intake(spark, earlier), _fresh_database(spark)
    job = f"parquet:local:{database}:orders"
    spec = f"{job}:o_orderkey:4:o_orderkey:{low - 1}"
    intake.create_jobs(small_frame(spark, [(spec,)], "input string"))
    for folder in (earlier, sf_dir):
        intake.connect = lambda db_type, server, name, at=folder: ParquetDatabase(spark, name, at)
        intake.run_table(job)
    return spark.table(f"{database}.orders")


@query(
    """
    select *, case when o_orderstatus <> 'P' then o_orderkey end as check_key from orders
    """
)
def late_keys(spark, sf_dir):
    """A table whose urgent orders turn up after the first run, below its last value; some rows have no check value."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "check_key", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    )
    early, whole = new_dir(spark, "source"), new_dir(spark, "source")
    orders.where("o_orderpriority <> '1-URGENT'").write.parquet(f"{early}/orders.parquet")
    orders.write.parquet(f"{whole}/orders.parquet")
    low, _ = profile.split_bounds(orders, "check_key") or (0, 0)
    intake, database = _intake(spark, early), _fresh_database(spark)
    job = f"parquet:local:{database}:orders"
    intake.create_jobs(small_frame(spark, [(f"{job}:o_orderkey:4:check_key:{low - 1}",)], "input string"))
    for folder in (early, whole):
        intake.connect = lambda db_type, server, name, at=folder: ParquetDatabase(spark, name, at)
        intake.run_table(job)
    return spark.table(f"{database}.orders")


@query(
    """
    select * from orders union all
    select * from orders where o_orderkey > (select (min(o_orderkey) + max(o_orderkey)) // 2 from orders)
    """
)
def rewind_import(spark, sf_dir):
    """A job set back to the middle after its run: what comes after it is imported again, and then no more."""
    low, top = profile.split_bounds(table(spark, sf_dir, "orders"), "o_orderkey") or (0, 0)
    intake, database = _intake(spark, sf_dir), _fresh_database(spark)
    job = f"parquet:local:{database}:orders"
    intake.create_jobs(small_frame(spark, [(f"{job}:o_orderkey:4:o_orderkey:{low - 1}",)], "input string"))
    intake.run_table(job)
    intake.registry.rewind(job, str((low + top) // 2))
    intake.run_table(job)
    intake.run_table(job)
    return spark.table(f"{database}.orders")


@query(
    _union_all(
        f"(select '{name}' as table_name, count(*) as n_rows, count(*) as landed, "
        f"count(*) as loaded from {name} where (select {_key_case(columns, lambda c: 'true', 'false')} "
        f"from {name}) having count(*) > 0)"
        for name, columns in WHOLE_NUMBERS.items()
    )
)
def import_database(spark, sf_dir):
    """Every enabled table imported; rows found in its target and counted by its run."""
    intake, database = _intake(spark, sf_dir), _fresh_database(spark)
    intake.initialise("parquet", "local", database)
    outcomes = intake.run_database(database)
    names = [outcome.job_name.rsplit(":", 1)[1] for outcome in outcomes]
    counts = (
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows")
        )
        for name in names
    )
    runs = intake.run_log.runs().select(
        F.element_at(F.split("job_name", ":"), -1).alias("table_name"),
        F.col("import_rows").alias("landed"),
        F.col("load_rows").alias("loaded"),
    )
    return reduce(DataFrame.unionByName, counts).join(runs, "table_name", "left")


@query("select * from lineitem")
def import_keyless(spark, sf_dir):
    """A table without a key: whole, by a job without split and check column."""
    intake, database = _intake(spark, sf_dir), _fresh_database(spark)
    job = f"parquet:local:{database}:lineitem"
    intake.create_jobs(small_frame(spark, [(f"{job}::4::0",)], "input string"))
    intake.run_table(job)
    return spark.table(f"{database}.lineitem")


def _fresh_database(spark: SparkSession) -> str:
    return "db_" + new_dir(spark, "x").rsplit("-", 1)[1]


def _intake(spark: SparkSession, sf_dir: str) -> Intake:
    root = new_dir(spark, "intake")
    return Intake(
        spark,
        Registry(spark, f"{root}/registry", f"{root}/landing"),
        RunLog(spark, f"{root}/runs"),
        lambda db_type, server, database: ParquetDatabase(spark, database, sf_dir),
        f"{root}/target",
    )
