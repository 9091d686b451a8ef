"""Tables of the lake in Spark's catalog: external, with comment, properties and committed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from shedlake.functions.columns import quoted
from shedlake.operators.scd1 import MARK
from shedlake.operators.serving import TABLE_NAME
from shedlake.sources.paths import make_folder
from shedlake.sources.tables import BATCH_ID
from shedlake.streaming.targets import VERSION, AppendTarget, KeyedTarget, PartitionTarget, Target

KEYS = "keys"  # table property: the key columns, comma-separated


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(target: Target) -> str:
    found = {KEYS: ",".join(target.keys), **target.properties}
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in found.items())


def _table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: Sequence[str], about: str = ""
) -> None:
    make_folder(spark, path)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION {_text(path)} {about}")


def _numbered(
    spark: SparkSession, name: str, path: str, schema: T.StructType, number: str, committed: Sequence[int],
    partitions: Sequence[str] = (), about: str = "",
) -> None:
    """A table whose folders are numbered; it has the committed ones, and nothing half written."""
    stored = T.StructType([*schema.fields, T.StructField(number, T.LongType())])
    _table(spark, name, path, stored, [number, *partitions], about)
    listed = {int(r.partition.split("/")[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    fresh = sorted(set(committed) - listed)
    if not fresh:
        return
    if not partitions:
        parts = " ".join(f"PARTITION ({number} = {n})" for n in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        spec = dict(p.split("=", 1) for p in row.partition.split("/"))
        if int(spec[number]) not in committed:
            exact = ", ".join(f"{quoted(k)} = {_text(v)}" for k, v in spec.items())
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({exact})")


def declare(spark: SparkSession, target: Target, database: str) -> str:
    """Make a target readable by name, as of now; returns the name. Declaring again takes in what is new.

    Append targets are tables of their committed batches. Keyed targets are views that fold the stored
    changes, which are a table of their own, ``<name>_changes``, beside ``<name>_base`` once compacted.
    Tables refreshed by partitions are declared as they lie.
    """
    for name in (database, target.name):
        if not TABLE_NAME.fullmatch(name):
            raise ValueError(f"not a table name: {name!r}")
    name = f"{database}.{target.name}"
    about = f"COMMENT {_text(target.comment)} TBLPROPERTIES ({_properties(target)})"
    if isinstance(target, AppendTarget):
        _numbered(spark, name, target.data, target.schema, BATCH_ID, target.versions(spark), target.partition_by, about)
        spark.catalog.refreshTable(name)
    elif isinstance(target, KeyedTarget):
        changes, base = f"{name}_changes", target.base_version(spark)
        _numbered(
            spark, changes, target.deltas, target.state_schema, BATCH_ID, target.versions(spark), target.partition_by
        )
        spark.catalog.refreshTable(changes)
        keys, marks = list(map(quoted, target.keys)), [quoted(MARK + c) for c in target.values]
        columns = ", ".join([*keys, *marks])
        rows = f"SELECT {columns} FROM {changes}"
        if base is not None:
            stored = f"{name}_base"
            _numbered(spark, stored, target.bases, target.state_schema, VERSION, [base], target.partition_by)
            spark.catalog.refreshTable(stored)
            rows += f" WHERE {BATCH_ID} > {base} UNION ALL SELECT {columns} FROM {stored} WHERE {VERSION} = {base}"
        values = [f"max({m}).value AS {quoted(c)}" for m, c in zip(marks, target.values, strict=True)]
        named = {k: k for k in keys} | dict(zip(map(quoted, target.values), values, strict=True))
        shown = ", ".join(named[quoted(c)] for c in target.schema.names)
        spark.sql(f"CREATE OR REPLACE VIEW {name} {about} AS SELECT {shown} FROM ({rows}) GROUP BY {', '.join(keys)}")
    elif isinstance(target, PartitionTarget):
        _table(spark, name, target.data, target.schema, target.partition_by, about)
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
    else:
        raise TypeError(f"{target.name} cannot be declared")
    return name


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: name, comment, and its properties."""
    table = spark.catalog.getTable(name)
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {**found, "name": table.name, "comment": table.description or ""}
