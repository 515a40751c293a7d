"""What the operators share: tables, scratch tables on shared storage, row locators, free column names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import shared_folder

#: Java and Python regular expression of a run of the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where it lies; on a cluster it is installed or sent with --py-files."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name on the storage that driver and executors share."""
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table on shared storage: the plan is cut, and a lost executor costs a scan."""
    spark = rows.sparkSession
    path = scratch(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def free_name(rows: DataFrame, base: str) -> str:
    """A column name that the rows don't have, in any case."""
    taken = {c.lower() for c in rows.columns}
    while base.lower() in taken:
        base += "_"
    return base


def making_room(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """The rows, whose columns called like one of `names` (in any case) go by a free name instead: `tokens` becomes `tokens_`."""
    wanted = {n.lower() for n in names}
    for column in [c for c in rows.columns if c.lower() in wanted]:
        rows = rows.withColumnRenamed(column, free_name(rows, column))
    return rows


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once a row, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def located(docs: DataFrame, landed: bool, label: str) -> tuple[DataFrame, str]:
    """The rows with a unique, stable locator struct(file, row), and the name of its column.

    Rows that come straight from Parquet files (`landed`) are located in those; others are written first.
    """
    docs = docs if landed else written(docs, label)
    at = free_name(docs, "_at")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select("*", place.alias(at)), at


def only(docs: DataFrame, at: str, keep: DataFrame) -> DataFrame:
    """The rows whose locator is in `keep` (file, row), which holds none twice."""
    file, row = free_name(docs, "_file"), free_name(docs, "_row")
    here = docs.withColumns({file: F.col(f"{at}.file"), row: F.col(f"{at}.row")})
    keys = keep.select(F.col("file").alias("_kf"), F.col("row").alias("_kr"))
    return here.join(keys, (F.col(file) == F.col("_kf")) & (F.col(row) == F.col("_kr")), "left_semi").drop(file, row, at)
