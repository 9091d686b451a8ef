"""Comparison of a Spark result with the result of its SQL in DuckDB."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql):
    """What differs between the two results; an empty list when they are equal."""
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} but SQL has {sorted(names)}"]
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    sql_types = {d[0]: str(d[1]).lower() for d in found.description}
    known = {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}
    for name in names:
        sql_type = known.get(sql_types[name], sql_types[name])
        if spark_types[name] != sql_type:
            problems.append(f"{name}: type {spark_types[name]} but SQL has {sql_type}")
    actual = _rows(spark_df.columns, spark_df.collect())
    wanted = _rows(names, expected)
    if actual != wanted:
        only_spark = sorted(set(actual) - set(wanted))[:3]
        only_sql = sorted(set(wanted) - set(actual))[:3]
        problems.append(f"{len(actual)} rows but SQL has {len(wanted)}; only Spark: {only_spark}; only SQL: {only_sql}")
    return problems
