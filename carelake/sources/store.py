"""Parquet folders the layers are kept in."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.session import delete, exists

_PARTITIONS = ("source_date", "drop_file")


class DeliveryStore:
    """Tables in which every delivered file is one partition.

    Loading a file replaces its partition and nothing else, also where the new delivery has no rows
    for it, so a load that was cut short is repaired by running it again.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], folder_of: dict[str, str]):
        """`folder_of` gives the drop folder (first part of `source_file`) of each table."""
        self.spark, self.root, self.schemas, self.folder_of = spark, root, schemas, folder_of

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        schema = self.schemas[table]
        stored = T.StructType(
            [f for f in schema if f.name not in ("source_date", "source_file")]
            + [T.StructField("source_date", T.DateType()), T.StructField("drop_file", T.StringType())])
        rows = _read_or_empty(self.spark, self.path(table), stored)
        source_file = F.concat_ws(
            "/", F.lit(self.folder_of[table]), F.col("source_date").cast("string"), F.col("drop_file"))
        return rows.select(
            *(source_file.alias("source_file") if f.name == "source_file" else F.col(f.name) for f in schema))

    def replace_files(self, table: str, rows: DataFrame, files: Iterable, stamp: str | None = None) -> None:
        """Write the rows of `files` (source_date, source_file), replacing all that the table has of them.

        What the table has is replaced only when the new rows are written whole; rows that cannot be read leave it as
        it was. Files without rows, which no written partition replaces, are removed then.
        """
        written = Observation()
        names = F.collect_set("source_file").alias("names")  # one name per delivered file
        self._overwrite("dynamic", table, rows.observe(written, names), stamp)
        self.remove_files(table, [f for f in files if f.source_file not in set(written.get["names"])])

    def remove_files(self, table: str, files: Iterable) -> None:
        """Remove all rows of `files`."""
        for file in files:
            name = file.source_file.rsplit("/", 1)[-1]
            delete(self.spark, f"{self.path(table)}/source_date={file.source_date}/drop_file={name}")

    def replace_table(self, table: str, rows: DataFrame, stamp: str | None = None) -> None:
        """Write the rows as the whole content of the table."""
        self._overwrite("static", table, rows, stamp)

    def _overwrite(self, mode: str, table: str, rows: DataFrame, stamp: str | None) -> None:
        # no shuffle: an input split holds rows of one or few files, so each task writes few partitions
        # and a large delivery is still written by many tasks
        rows = _stamped(rows, stamp).withColumn("drop_file", F.substring_index("source_file", "/", -1))
        (
            rows.drop("source_file").write.mode("overwrite").option("partitionOverwriteMode", mode)
            .partitionBy(*_PARTITIONS).parquet(self.path(table))
        )

    def files(self, tables: Sequence[str]) -> DataFrame:
        """(kind, source_date, source_file) of the files with stored rows, from a listing of the folders alone."""
        return reduce(DataFrame.unionByName, map(self._listed, tables))

    def _listed(self, table: str) -> DataFrame:
        if not exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], "kind string, source_date date, source_file string")
        found = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", True).load(self.path(table)).select("path")
        place = r"/source_date=(\d{4}-\d{2}-\d{2})/drop_file=([^/]+)/[^/]+$"
        return found.select(
            F.lit(table).alias("kind"), F.regexp_extract("path", place, 1).cast("date").alias("source_date"),
            F.concat_ws("/", F.lit(self.folder_of[table]), F.regexp_extract("path", place, 1),
                        F.regexp_extract("path", place, 2)).alias("source_file"),
        ).distinct()


class TableStore:
    """Tables rebuilt as a whole. With `starts_empty` a table not written yet reads as empty, else it is an error."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], starts_empty: bool = True):
        self.spark, self.root, self.schemas, self.starts_empty = spark, root, schemas, starts_empty

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        if not self.starts_empty:
            return self.spark.read.schema(self.schemas[table]).parquet(self.path(table))
        return _read_or_empty(self.spark, self.path(table), self.schemas[table])

    def replace(
        self, table: str, rows: DataFrame, *,
        cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (), stamp: str | None = None,
    ) -> None:
        """Overwrite the table.

        `cluster_by` brings rows of equal values together, so that row groups can be skipped by their
        min and max. It is a rebalance, not a hash repartition: AQE splits values that are too large
        for one file and merges small ones.
        """
        rows = _stamped(rows, stamp)
        if cluster_by:
            rows = rows.hint("rebalance", *partition_by, *cluster_by[:1]).sortWithinPartitions(
                *partition_by, *cluster_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(table))

    def append_log(self, table: str, rows: DataFrame) -> None:
        """Append a few log rows as one file."""
        rows.coalesce(1).write.mode("append").parquet(self.path(table))


class PartStore:
    """Tables made of parts, every one of them written once per version and never changed.

    Who reads names the version of each part: a build that changes one part names a new version of that one and the
    former versions of all others, whose files it neither reads nor copies.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root, schemas

    def path(self, table: str, part: str, version: str) -> str:
        return f"{self.root}/{table}/part={part}/version={version}"

    def write(
        self, table: str, rows: DataFrame, part: Column, version: str, *,
        cluster_by: Sequence[str] = (), stamp: str | None = None,
    ) -> list[str]:
        """Write the rows as a new version of the parts that they belong to; returns these parts.

        A rebalance brings the rows of a part together, splits large parts and merges the files of small ones.
        """
        seen = Observation()
        rows = _stamped(rows, stamp).withColumn("part", part).hint("rebalance", "part", *cluster_by[:1])
        rows = rows.sortWithinPartitions("part", *cluster_by).observe(seen, F.collect_set("part").alias("parts"))
        rows.withColumn("version", F.lit(version)).write.mode("append").partitionBy("part", "version").parquet(f"{self.root}/{table}")
        return sorted(seen.get["parts"])

    def read(self, table: str, versions: dict[str, str]) -> DataFrame:
        """The table of these versions by part; no other part is even listed."""
        if not versions:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*(self.path(table, p, v) for p, v in sorted(versions.items())))

    def remove(self, table: str, part: str, version: str) -> None:
        delete(self.spark, self.path(table, part, version))


def _stamped(rows: DataFrame, column: str | None) -> DataFrame:
    return rows.withColumn(column, F.current_timestamp()) if column else rows


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
