"""Results as text: key fields, a tab, value fields; blanks between the fields of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv_lines(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One ``value`` line per row; NULL is written as nothing, and without values there is no tab."""

    def joined(columns: list[str]) -> Column:
        return F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))

    sides = [joined(keys), joined(values)] if values else [joined(keys)]
    return df.select(F.concat_ws("\t", *sides).alias("value"))


def write_tsv(df: DataFrame, keys: list[str], values: list[str], path: str) -> None:
    """One file per task; a result that is ordered as a whole is in order across its files too."""
    tsv_lines(df, keys, values).write.mode("overwrite").text(path)
