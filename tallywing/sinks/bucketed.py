"""Result tables in buckets of their partition key, whose merge moves the new rows only.

The old rows lie in buckets by the same hash that a shuffle would deal them by, so they are read where they lie, next to
the new rows dealt to as many parts. A merge writes the next version of the whole table into a folder of its own; readers
take the last version that is complete, and so see a merge as a whole or not at all. Meant for merges that touch most of a
table; ``KeyedTable`` rewrites only the folders that get rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.operators.topn import best_per_key
from tallywing.sinks.keyed import KeyedTable, merge

VERSION = "version-"


@dataclass(frozen=True)
class BucketedTable:
    """``keyed`` says name and keys. A table keeps the number of buckets it was made with, as it is part of its path."""

    keyed: KeyedTable
    buckets: int = 32
    kept_versions: int = 2

    def folder(self, root: str) -> str:
        return f"{root}/{self.keyed.name}-in-{self.buckets}"

    def upsert(self, rows: DataFrame, root: str) -> None:
        """Merge ``rows`` in, by the rules of ``merge``, as the next version.

        A job that dies leaves a version that is not complete, which nobody reads. Of two merges at the same time one fails,
        as both write the same version.
        """
        spark, key = rows.sparkSession, list(self.keyed.partition_key)
        complete, last = self._versions(spark, root)
        old = self.read(spark, root) if complete else None
        merged = self.merged(old, rows)
        path, table = f"{self.folder(root)}/{VERSION}{last + 1:09d}", self._table(root, last + 1)
        spark.sql(f"drop table if exists {table}")
        writer = merged.write.bucketBy(self.buckets, *key).sortBy(*key, *self._sorted(merged))
        writer.option("path", path).saveAsTable(table)
        for version in complete[: -(self.kept_versions - 1) or None]:
            self._delete(spark, f"{self.folder(root)}/{VERSION}{version:09d}")

    def merged(self, old: DataFrame | None, rows: DataFrame) -> DataFrame:
        """Only ``rows`` are dealt out; ``old`` has to be in buckets."""
        dealt = rows.repartition(self.buckets, *self.keyed.partition_key)
        return merge(old, dealt, self.keyed.key, self.keyed.order())

    def _sorted(self, rows: DataFrame) -> list[str]:
        return [c for c, _ in self.keyed.clustering if c not in self.keyed.partition_key and c in rows.columns]

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        """The last complete version, known to this session by its buckets."""
        complete, _ = self._versions(spark, root)
        if not complete:
            raise FileNotFoundError(f"no complete version under {self.folder(root)}")
        table, path = self._table(root, complete[-1]), f"{self.folder(root)}/{VERSION}{complete[-1]:09d}"
        if not spark.catalog.tableExists(table):
            columns = spark.read.parquet(path).schema.toDDL()
            key = ", ".join(f"`{c}`" for c in self.keyed.partition_key)
            spark.sql(f"create table {table} ({columns}) using parquet clustered by ({key}) into {self.buckets} buckets location '{path}'")
        return spark.table(table)

    def get(self, spark: SparkSession, root: str, *partition_key: object) -> DataFrame:
        """The rows of one partition key, in clustering order; reads its one bucket."""
        rows = self.read(spark, root)
        for value, c in zip(partition_key, self.keyed.partition_key, strict=True):
            rows = rows.filter(F.col(c).eqNullSafe(F.lit(value).cast(rows.schema[c].dataType)))
        return rows.orderBy(*self.keyed.order())

    def best(self, spark: SparkSession, root: str, k: int) -> DataFrame:
        """The first ``k`` rows of every partition key in clustering order, without a shuffle."""
        return best_per_key(self.read(spark, root), list(self.keyed.partition_key), self.keyed.order(), k)

    def _table(self, root: str, version: int) -> str:
        return f"{self.keyed.name}_{zlib.crc32(self.folder(root).encode()):08x}_{version}"

    def _versions(self, spark: SparkSession, root: str) -> tuple[list[int], int]:
        """The complete versions in order, and the highest number that is taken."""
        files, path = _file_system(spark, self.folder(root))
        if not files.exists(path):
            return [], 0
        names = {s.getPath().getName(): s.getPath() for s in files.listStatus(path)}
        all_ = sorted(int(n[len(VERSION) :]) for n in names if n.startswith(VERSION))
        of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return [v for v in all_ if files.exists(of(names[f"{VERSION}{v:09d}"], "_SUCCESS"))], max(all_, default=0)

    @staticmethod
    def _delete(spark: SparkSession, folder: str) -> None:
        files, path = _file_system(spark, folder)
        files.delete(path, True)


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
