"""Named tables and a configured list of Spark SQL statements over them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roomtide.sources import read_named_fields, write_delimited


@dataclass(frozen=True)
class TableFile:
    """A delimited file set and its ``#``-separated column names."""

    name: str
    fields: str
    path: str


@dataclass(frozen=True)
class SqlStatement:
    name: str
    index: int
    sql: str
    enable: bool = True
    out_path: str | None = None


def open_tables(spark: SparkSession, tables: Sequence[TableFile], sep: str = "#") -> dict[str, DataFrame]:
    """The tables by name, all columns as text."""
    return {t.name: read_named_fields(spark, t.path, t.fields.split("#"), sep=sep) for t in tables}


def _own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, with its settings, and with names of its own."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def run_statements(
    spark: SparkSession, tables: dict[str, DataFrame], statements: Sequence[SqlStatement], sep: str = "#"
) -> dict[str, DataFrame]:
    """Run the enabled statements in index order; write those that name an output folder.

    The tables are views of a session that ends with the call, so views of
    the caller with the same names stay what they are, and statements that
    make views leave none behind.
    """
    own, names = _own_session(spark), {}
    try:
        for name, df in tables.items():
            names[name] = f"sql_list_{uuid.uuid4().hex}"
            df.createGlobalTempView(names[name])
            own.sql(f"create temporary view `{name}` as select * from global_temp.{names[name]}")
        results = {}
        for statement in sorted((s for s in statements if s.enable), key=lambda s: s.index):
            results[statement.name] = own.sql(statement.sql)
            if statement.out_path:
                write_delimited(results[statement.name], statement.out_path, sep)
        return results
    finally:
        # results are bound to the tables' plans by now
        for name in names.values():
            spark.catalog.dropGlobalTempView(name)
