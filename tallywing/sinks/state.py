"""Counts by year and key from which ratios of any years are put together.

A new year is counted and stored beside the others, none of which is read; storing a year again replaces it. A ratio
needs no more than the sums of the counts, of which there is one row for each year and key, however many flights there were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.operators.ontime import on_time_state, ratios_of_state


@dataclass(frozen=True)
class RatioState:
    name: str
    keys: tuple[str, ...]
    delay_flag: str

    def path(self, root: str) -> str:
        return f"{root}/{self.name}"

    def add(self, flights: DataFrame, root: str) -> None:
        """Store the counts of the years of ``flights``, each of which has to be there in full."""
        state = on_time_state(flights, list(self.keys), self.delay_flag)
        writer = state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("year").parquet(self.path(root))

    def ratios(self, spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> DataFrame:
        """Ratios of all stored years, or of ``[first, last]``, which reads those only."""
        state = spark.read.parquet(self.path(root))
        state = state if first is None else state.filter(F.col("year").between(first, last))
        return ratios_of_state(state, list(self.keys))


# The ratios that jobs ask for, and the flag each goes by.
STATES = {
    s.name: s
    for s in [
        RatioState("airline_state", ("airline_id",), "arr_del15"),
        RatioState("airport_carrier_state", ("origin", "airline_id"), "dep_del15"),
        RatioState("airport_dest_state", ("origin", "dest"), "dep_del15"),
        RatioState("source_dest_carrier_state", ("origin", "dest", "airline_id"), "dep_del15"),
    ]
}
