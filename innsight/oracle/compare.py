"""Order-insensitive comparison of a Spark result with a DuckDB result (row count, columns, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
from dataclasses import dataclass

import duckdb

from ..sources.tables import DRIVER_TABLES


def _norm(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def row_lines(columns: list[str], rows: list[tuple]) -> list[str]:
    """Rows as sorted text lines with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@dataclass
class Comparison:
    name: str
    spark_rows: int
    oracle_rows: int
    same_columns: bool
    same_values: bool
    spark_only: list[str]
    oracle_only: list[str]

    @property
    def ok(self) -> bool:
        return self.same_columns and self.spark_rows == self.oracle_rows and self.same_values

    def __str__(self) -> str:
        return (f"{self.name}: rows {self.spark_rows}/{self.oracle_rows} columns_match={self.same_columns} "
                f"values_match={self.same_values} spark_only={self.spark_only[:3]} oracle_only={self.oracle_only[:3]}")


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(name: str, spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> Comparison:
    s_cols = spark_df.columns
    s_lines = row_lines(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols = rel.columns
    d_lines = row_lines(d_cols, rel.fetchall())
    digest_s = hashlib.sha256("\n".join(s_lines).encode()).hexdigest()
    digest_d = hashlib.sha256("\n".join(d_lines).encode()).hexdigest()
    a, b = set(s_lines), set(d_lines)
    return Comparison(name, len(s_lines), len(d_lines), sorted(s_cols) == sorted(d_cols), digest_s == digest_d,
                      sorted(a - b), sorted(b - a))
