"""Message bytes and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def string_payload(value: Column) -> Column:
    """Message bytes as text."""
    return value.cast("string")


def number(value: Column) -> Column:
    """Text as a double; null if it is none, which "NaN" counts as."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def parse_json(text: Column, schema: T.StructType | str) -> Column:
    """JSON text as a struct; text that is not JSON gives a struct of nulls."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def json_rows(df: DataFrame, text: Column, schema: T.StructType | str,
              keep: Sequence[Column | str] = ()) -> DataFrame:
    """The fields of a JSON column as columns, beside the `keep` columns.

    `inline` keeps the optimizer from copying the parser into every later filter and projection,
    so that each text is parsed once.
    """
    return df.select(*keep, F.inline(F.array(parse_json(text, schema))))


def json_text(*columns: Column | str) -> Column:
    """A JSON object of the given columns; times keep their microseconds."""
    return F.to_json(F.struct(*columns), TIME_FORMATS)
