"""Temporary SQL functions: scalar expressions and table functions that the
optimizer expands in place (no Python worker)."""

from __future__ import annotations

from pyspark.sql import SparkSession

SHARDS = 64


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_code_lookup(spark: SparkSession, name: str, codes: dict[str, str], default: str = "Unknown") -> None:
    """``name(text)``: literal lookup table as a SQL function."""
    pairs = ", ".join(f"{_text(k)}, {_text(v)}" for k, v in codes.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING "
        f"RETURN coalesce(try_element_at(map({pairs}), code), {_text(default)})"
    )


def register_total_price(spark: SparkSession, name: str = "total_price") -> None:
    """``name(price, tax_rate, days)``: price with tax for a number of days."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(price DOUBLE, tax_rate DOUBLE, days INT) RETURNS DOUBLE "
        "RETURN (price + price * tax_rate) * days"
    )


def register_latest_rows(
    spark: SparkSession, name: str, view: str, key: str, order: list[str], columns: list[str], played: str | None = None, default_rows: int = 3
) -> None:
    """``name(key, n)``: table function with the newest n rows of one key.

    The key's rows are ranked in SHARDS parts first, so that a crowded key keeps
    several tasks busy and the last ranking sees n rows of each part only.
    """
    schema = spark.table(view).schema
    returns = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in columns)
    newest = ", ".join(f"`{c}` DESC" for c in order)
    condition = f"AND `{played}` IS NOT NULL" if played else ""
    listed = ", ".join(f"`{c}`" for c in columns)
    needed = ", ".join(f"`{c}`" for c in dict.fromkeys([*columns, *order]))
    ordered = ", ".join(f"`{c}`" for c in order)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted {schema[key].dataType.simpleString()}, n INT DEFAULT {default_rows}) "
        f"RETURNS TABLE({returns}) RETURN SELECT {listed} FROM ("
        f"SELECT *, row_number() OVER (ORDER BY {newest}) AS _rn FROM ("
        f"SELECT {needed}, row_number() OVER (PARTITION BY pmod(xxhash64({ordered}), {SHARDS}) ORDER BY {newest}) AS _part "
        f"FROM {view} WHERE `{key}` = wanted {condition}) WHERE _part <= n) WHERE _rn <= n"
    )


def register_sample(spark: SparkSession, name: str, view: str, columns: list[str], order: list[str], rows: int = 25) -> None:
    """``name()``: table function with the first ``rows`` rows in an order."""
    schema = spark.table(view).schema
    returns = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in columns)
    listed, ordered = ", ".join(f"`{c}`" for c in columns), ", ".join(f"`{c}`" for c in order)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE({returns}) "
        f"RETURN SELECT {listed} FROM {view} ORDER BY {ordered} LIMIT {rows}"
    )
