"""Result tables to be read by key: Parquet split into folders by partition key, sorted by clustering order within.

Writing is an upsert: rows replace those of the same key and leave all others. The key is made of ids only, so a rerun
that changes a ratio replaces the row instead of adding one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywing.operators.topn import best_per_key

FOLDER = "folder"


def merge(old: DataFrame | None, new: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``old`` with the rows of ``new`` put in: one row per key, and NULL is a key like any other.

    A new row goes before an old one; among new rows of one key the first by ``order`` stays, and then the least row.
    """
    both = new.withColumn("age", F.lit(0))
    if old is not None:
        both = both.unionByName(old.withColumn("age", F.lit(1)))
    rest = [F.col(c) for c in new.columns if c not in key]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("age", *order, *rest))
    return both.withColumn("place", place).filter("place = 1").drop("age", "place")


@dataclass(frozen=True)
class KeyedTable:
    """``month_of`` names a yyyymmdd column to make folders of its months; without it, folders are ``buckets`` hashes
    of the partition key. The name of the folder column holds the number of buckets, so a table that is stored keeps
    its own. ``row_group`` is the size in bytes of what a lookup by key reads at once."""

    name: str
    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    month_of: str | None = None
    buckets: int = 32
    row_group: int = 16 << 20

    def order(self) -> list[Column]:
        return [F.desc(c) if way == "desc" else F.asc(c) for c, way in self.clustering]

    def folder_column(self, stored: DataFrame | None = None) -> str:
        if stored is not None:
            return next(c for c in stored.columns if c.startswith(FOLDER))
        return FOLDER if self.month_of else f"{FOLDER}_of_{self.buckets}"

    def folder(self, column: str, values: Sequence[Column] | None = None) -> Column:
        """The folder of a row, or of one partition key given as ``values``."""
        values = values or [F.col(c) for c in self.partition_key]
        if self.month_of:
            return F.floor(values[self.partition_key.index(self.month_of)] / 100).cast("int")
        buckets = int(column.rpartition("_")[2])
        return F.pmod(F.xxhash64(*(v.cast("string") for v in values)), F.lit(buckets)).cast("int")

    def upsert(self, rows: DataFrame, root: str) -> None:
        """Merge ``rows`` into the table under ``root``; of several rows of one key, the first in clustering order.

        Only folders that get rows are read and written: their numbers, at most as many as the table has folders, are a
        filter on the partition column. The new rows are kept in memory and on disk meanwhile, as they are used twice.
        Folders are replaced one by one when the job commits. A job that dies before leaves the table as it was; one
        that dies during the commit may leave some folders new and some old, and is to be run again, which mends it.
        """
        spark, path = rows.sparkSession, self.path(root)
        old = self._stored(spark, path)
        column = self.folder_column(old)
        fresh = rows.withColumn(column, self.folder(column)).persist()
        try:
            if old is not None:
                touched = [r[0] for r in fresh.select(column).distinct().collect()]
                old = old.filter(self._in_folders(column, touched))
            merged = merge(old, fresh, self.key, self.order())
            # A rebalance, not a repartition: a folder too large for one task is split over several.
            placed = merged.hint("rebalance", column).sortWithinPartitions(column, *self.partition_key, *self.order())
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.options(**self.layout()).partitionBy(column).parquet(path)
        finally:
            fresh.unpersist()

    def layout(self) -> dict[str, str]:
        """Small row groups and bloom filters on the partition key: ``get`` reads the group that may hold its key and passes
        over the others. The rows of a file being sorted by that key, least and greatest value say so too; the filters
        help where a file has many keys of a wide range."""
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.partition_key}
        return {"parquet.block.size": str(self.row_group), **filters}

    @staticmethod
    def _in_folders(column: str, folders: list[int | None]) -> Column:
        known = F.col(column).isin([f for f in folders if f is not None])
        return known | F.col(column).isNull() if None in folders else known

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        stored = spark.read.parquet(self.path(root))
        return stored.drop(self.folder_column(stored))

    def get(self, spark: SparkSession, root: str, *partition_key: object) -> DataFrame:
        """The rows of one partition key, in clustering order; reads its one folder, and there the row groups of the key."""
        rows = spark.read.parquet(self.path(root))
        column = self.folder_column(rows)
        values = [F.lit(v).cast(rows.schema[c].dataType) for v, c in zip(partition_key, self.partition_key, strict=True)]
        wanted = F.col(column).eqNullSafe(self.folder(column, values))
        for value, c in zip(values, self.partition_key, strict=True):
            wanted = wanted & F.col(c).eqNullSafe(value)
        return rows.filter(wanted).drop(column).orderBy(*self.order())

    def best(self, spark: SparkSession, root: str, k: int) -> DataFrame:
        """The first ``k`` rows of every partition key in clustering order."""
        return best_per_key(self.read(spark, root), list(self.partition_key), self.order(), k)

    def path(self, root: str) -> str:
        return f"{root}/{self.name}"

    @staticmethod
    def _stored(spark: SparkSession, path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise


def _ratios(name: str, partition_key: tuple[str, ...], entity: str) -> KeyedTable:
    return KeyedTable(
        name, partition_key, (("ontime_percentage", "desc"), (entity, "asc")), (*partition_key, entity)
    )


def _counts(name: str, partition_key: tuple[str, ...], entity: str) -> KeyedTable:
    return KeyedTable(name, partition_key, ((entity, "asc"),), (*partition_key, entity))


def _schedules(name: str) -> KeyedTable:
    key = ("airline_id", "flight_date", "flight_num")
    return KeyedTable(name, key[:2], (("flight_num", "asc"),), key, month_of="flight_date")


# The result tables and their keys.
TABLES = {
    t.name: t
    for t in [
        _ratios("airport_carrier_ontime", ("origin",), "airline_id"),
        _ratios("airport_dest_ontime", ("origin",), "destination"),
        _ratios("source_dest_carrier_ontime", ("origin", "destination"), "airline_id"),
        KeyedTable(
            "connecting_flights",
            ("origin_flight_date",),
            (("origin", "asc"), ("layover", "asc"), ("destination", "asc")),
            ("origin_flight_date", "origin", "layover", "destination"),
            month_of="origin_flight_date",
        ),
        _schedules("source_dest_schedules"),
        _schedules("named_source_dest_schedules"),
        _counts("airport_carrier_ontime_departures", ("origin",), "airline_id"),
        _counts("airport_dest_ontime_departures", ("origin",), "destination"),
        _counts("source_dest_carrier_ontime_arrivals", ("origin", "destination"), "airline_id"),
    ]
}
