"""Catalog tables (S7-S9): create-as-select, declared table + insert
overwrite, and database / table lifecycle.

Tables are external: their files live at an explicit location (the shared
scratch folder or a dataset root), never in a machine-local warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)}{loc}")
    return db


def drop_table(spark: SparkSession, db: str, name: str) -> None:
    """``DROP TABLE IF EXISTS``."""
    spark.sql(f"DROP TABLE IF EXISTS {_ident(db)}.{_ident(name)}")


def save_table(df: DataFrame, db: str, name: str, path: str) -> DataFrame:
    """Create (or replace) ``db.name`` as Parquet at ``path`` from ``df``."""
    table = f"{_ident(db)}.{_ident(name)}"
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def declare_table(spark: SparkSession, db: str, name: str, schema: T.StructType,
                  path: str) -> str:
    """``CREATE TABLE`` with a declared schema.

    A table of that name may exist already if its columns and types agree;
    anything else is an error.
    """
    table = f"{_ident(db)}.{_ident(name)}"
    if spark.catalog.tableExists(table):
        have = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if have != [(f.name, f.dataType) for f in schema.fields]:
            raise ValueError(f"{table} exists with other columns")
        return table
    spark.sql(f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet LOCATION {_text(path)}")
    return table


def insert_overwrite(df: DataFrame, db: str, name: str) -> DataFrame:
    """``INSERT OVERWRITE`` into a declared table; columns matched by name."""
    spark = df.sparkSession
    table = f"{_ident(db)}.{_ident(name)}"
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    return spark.table(table)
