"""Session settings the warehouse relies on.

Nothing here sizes the cluster. `spark.sql.shuffle.partitions` and memory belong to the
submitter; adaptive execution coalesces or splits partitions from what it measures.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from carelake.functions.privacy import REDACTION_PATTERN

RUNTIME_SETTINGS = {
    # day boundaries (to_date, datediff) must not depend on the cluster's locale
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # some writers store nanosecond timestamps, which Spark can only read as numbers; the drop reader
    # turns them into timestamps
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # one stay or patient may own a large share of the facts: let AQE split such partitions, even
    # where the operator above the join would have reused the join's partitioning
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    They hold for all later queries of that session, in UTC too; pass `spark.newSession()` to keep one
    with other settings apart.
    """
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    hide_secret_literals(spark)
    return spark


def hide_secret_literals(spark: SparkSession) -> None:
    """Make Spark mask the pseudonymisation key blocks wherever it prints a plan."""
    key = "spark.sql.redaction.string.regex"
    current = spark.conf.get(key, None)
    if not current:
        spark.conf.set(key, REDACTION_PATTERN)
    elif REDACTION_PATTERN not in current:
        spark.conf.set(key, f"{current}|{REDACTION_PATTERN}")


def local_session(app: str, cpus: int | str = "*", **settings: str) -> SparkSession:
    """Session for tests and the bench on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, on storage that driver and executors share.

    The one the cluster names in `spark.checkpoint.dir`; where that is unset, one below
    `spark.sql.warehouse.dir`, which is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's file system; one that is not there is no error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
