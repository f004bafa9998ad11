"""Identifier and text clean-up, code lookups, prompt text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.functions.numbers import as_column


def clean_id(c: Column | str) -> Column:
    """Identifier as text without the ``.0`` that a float round trip leaves."""
    return F.regexp_replace(as_column(c).cast("string"), r"\.0$", "")


def collapse_spaces(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(as_column(c), r"\s+", " "))


def composite_id(*parts: Column | str, separator: str = "0") -> Column:
    return F.concat_ws(separator, *[as_column(p).cast("string") for p in parts])


def contains_ignoring_case(c: Column | str, needle: str) -> Column:
    return F.lower(as_column(c)).contains(needle.lower())


def lookup_code(c: Column | str, codes: dict[str, str], default: str | None = "Unknown") -> Column:
    """Literal lookup table as an expression; for fixed tables of a few dozen
    entries. Tables held as data are joined instead (``matching.lookup``)."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.coalesce(F.try_element_at(mapping, as_column(c)), F.lit(default))


def prompt_text(df: DataFrame, instructions: str, columns=None, alias: str = "prompt") -> DataFrame:
    """Append a prompt column: instructions, one line per column with its
    comment from the schema, then the row itself as JSON."""
    columns = list(columns or df.columns)
    described = "\n".join(f"{n}: {df.schema[n].metadata.get('comment', '')}".rstrip() for n in columns)
    head = f"{instructions}\n{described}\n"
    return df.select("*", F.concat(F.lit(head), F.to_json(F.struct(*columns))).alias(alias))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as schema metadata."""
    return df.select(
        *[
            F.col(n).alias(n, metadata={**df.schema[n].metadata, "comment": comments[n]}) if n in comments else F.col(n)
            for n in df.columns
        ]
    )
