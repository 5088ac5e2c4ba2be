"""Job specs, job names, connect strings and landing paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and the eight fields of a job spec, in order.
SPEC_SEPARATOR = ":"
SPEC_FIELDS = (
    "db_type",
    "server",
    "database",
    "table",
    "split_by",
    "mappers",
    "check_col",
    "last_val",
)
# Read parallelism and first last value that discovery writes into a spec.
DEFAULT_MAPPERS = "4"
FIRST_LAST_VALUE = "0"


def named(name: str) -> Column:
    """The column of just this name, dots and quotes in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def build_spec(*parts: Column) -> Column:
    return F.concat_ws(SPEC_SEPARATOR, *(F.coalesce(p, F.lit("")) for p in parts))


def spec_parts(spec: Column) -> Column:
    """Fields of a spec as an array: inner empty fields stay, trailing empty ones go.

    A server may carry a port: a third field of digits only belongs to the second.
    """
    fields = F.split(F.rtrim(spec, F.lit(SPEC_SEPARATOR)), SPEC_SEPARATOR)
    with_port = F.concat(
        F.slice(fields, 1, 1),
        F.array(F.array_join(F.slice(fields, 2, 2), SPEC_SEPARATOR)),
        F.slice(fields, 4, F.size(fields)),
    )
    return F.when(F.get(fields, F.lit(2)).rlike(r"^[0-9]+$"), with_port).otherwise(fields)


def spec_part(parts: Column, field: str) -> Column:
    """One field of a spec by name; null where the spec is too short to hold it."""
    return F.get(parts, F.lit(SPEC_FIELDS.index(field)))


def job_name(parts: Column) -> Column:
    """The first four fields of a spec identify a job."""
    return F.array_join(F.slice(parts, 1, 4), SPEC_SEPARATOR)


def connect_string(db_type: Column, server: Column, database: Column) -> Column:
    return F.concat(F.lit("jdbc:"), db_type, F.lit("://"), server, F.lit("/"), database)


def job_name_of_connection(connection: Column, table: Column) -> Column:
    """Inverse of `connect_string`; a port stays with the server."""
    pattern = r"^jdbc:([^:]+)://([^/]+)/(.*)$"
    return F.concat_ws(
        SPEC_SEPARATOR,
        *(F.regexp_extract(connection, pattern, i) for i in (1, 2, 3)),
        table,
    )


def landing_path(prefix: str, server: Column, database: Column, table: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), server, database, table)


def config_key(db_type: Column, server: Column, database: Column, field: str) -> Column:
    """Lower-case dotted key of a database's user or password in a settings file."""
    return F.concat_ws(".", *(F.lower(part) for part in (db_type, server, database)), F.lit(field))


def environment_key(db_type: Column, server: Column, database: Column, suffix: str) -> Column:
    """Upper-case variable name of the same setting; dots and dashes of the server go."""
    server = F.replace(F.replace(server, F.lit("."), F.lit("_")), F.lit("-"), F.lit("_"))
    return F.upper(F.concat_ws("_", db_type, server, database, F.lit(suffix)))
