"""Delimited text output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

NULL_TEXT = "\\N"


def write_delimited(df: DataFrame, path: str, *, delimiter: str = ",", mode: str = "append") -> None:
    """Write rows as unquoted delimited text: no header, ``\\N`` for NULL, decimals
    without trailing zeros. ``mode`` is append or overwrite."""

    def as_text(field) -> Column:
        value = F.col(f"`{field.name}`").cast("string")
        if isinstance(field.dataType, DecimalType) and field.dataType.scale > 0:
            # A plain cast may write a small decimal with an exponent.
            plain = F.format_number(F.col(f"`{field.name}`"), field.dataType.scale)
            value = F.regexp_replace(F.translate(plain, ",", ""), r"\.?0+$", "")
        return F.coalesce(value, F.lit(NULL_TEXT))

    line = F.concat_ws(delimiter, *[as_text(f) for f in df.schema.fields])
    df.select(line.alias("value")).write.mode(mode).text(path)
