"""Operator 7: exact deduplication with a stream whose keyed state never expires.

Every document arrives as (digest, identifier, locator). A streaming aggregation keeps, per digest, the number of
arrivals and the smallest identifier with the locator of its content. The state has no watermark, so it never
expires, and lives in RocksDB: on the executors' disks, with its checkpoints on shared storage. Arrivals are combined
in the map tasks, so a text that makes up a third of all rows reaches its state as one row a task.

A digest that was hit again is only a claim. The full texts of all documents of such digests are compared, grouped by
the text itself; should two texts share a digest, each gets its own group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.llm.common import SPACES, located, only, scratch, text_of, written
from carelake.operators.lookup import lookup

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_MB = 128
ARRIVALS = "digest string, doc_id bigint, file string, row bigint"


def normalised(text: str) -> Column:
    """Texts are equal if they are identical after this; null counts as empty."""
    return F.regexp_replace(text_of(text), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _first() -> Column:
    """The smallest identifier and its locator; rows without identifier come last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")).alias("first")


def start(arrivals: DataFrame, folder: str) -> StreamingQuery:
    """Feed a stream of arrivals (`ARRIVALS`) to the state; changed digests go to `folder`/changes.

    `folder`/checkpoint holds the state. Started again on the same folder, it goes on where it stopped. A batch that
    is run again replaces what it wrote.
    """
    state = arrivals.groupBy("digest").agg(F.count("*").alias("n"), _first())

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")

    return (
        state.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def state_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream, so that the state's settings don't reach the caller's."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    # each store would reserve 4 MB for its manifest, however little it holds
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # however many partitions of the state an executor holds, they share this memory, and buffers begin small
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", STATE_MB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "4")
    return own


def held(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, n, first): the newest entry of every digest. Counts only grow, so the largest is the newest."""
    changes = spark.read.schema(
        "digest string, n bigint, first struct<none: boolean, doc_id: bigint, file: string, row: bigint>",
    ).option("recursiveFileLookup", True).parquet(f"{folder}/changes")
    return changes.groupBy("digest").agg(F.max(F.struct("n", "first")).alias("s")).select("digest", "s.*")


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, landed: bool = False,
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = 1000,
) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, file, row.

    Of equal texts the row with the smallest identifier stays; of rows that repeat it, the first by locator. Null
    texts count as empty, null identifiers as largest. An empty table gives no rows. Other columns of `docs`, of any
    name, are not read. `landed` says that docs is a plain read of Parquet files.
    """
    spark = docs.sparkSession
    if not landed:
        docs = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "op7-texts")
        id_col, text_col = "doc_id", "text"
    rows, at = located(docs, True, "op7-texts")
    texts = rows.select(F.col(id_col).cast("bigint").alias("doc_id"), f"{at}.file", f"{at}.row", normalised(text_col).alias("norm"))
    folder = scratch(spark, "op7")
    texts.select(digest(F.col("norm")).alias("digest"), "doc_id", "file", "row").write.parquet(f"{folder}/arrivals")

    own = state_session(spark)
    stream = own.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/arrivals")
    start(stream, folder).awaitTermination()

    arrivals = spark.read.schema(ARRIVALS).parquet(f"{folder}/arrivals")
    members = written(lookup(arrivals, held(spark, folder), "digest"), "op7-members")
    claimed = members.filter("n > 1").select("digest", "doc_id", F.col("file").alias("f"), F.col("row").alias("r"))
    content = texts.drop("doc_id").join(claimed, (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")))
    content = content.select("digest", "doc_id", "file", "row", "norm")
    classes = written(content.groupBy("digest", "norm").agg(F.count("*").alias("n"), _first()), "op7-classes")
    clashing = classes.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")
    if not clashing.isEmpty():
        members = _split(members, content, classes, clashing)
    return members.select(
        "doc_id", "digest", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("first.file") == F.col("file")) & (F.col("first.row") == F.col("row"))).alias("kept"), "file", "row",
    )


def _split(members: DataFrame, content: DataFrame, classes: DataFrame, clashing: DataFrame) -> DataFrame:
    """Members of digests that several texts share get the group of their own text."""
    alone = members.join(clashing, "digest", "left_anti")
    groups = classes.join(clashing, "digest", "left_semi").select(
        F.col("digest").alias("d"), F.col("norm").alias("t"), "n", "first")
    split = content.join(groups, (F.col("digest") == F.col("d")) & (F.col("norm") == F.col("t")))
    return alone.unionByName(split.select(*alone.columns))


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return deduplicate(docs, landed=True).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without exact copies."""
    found = deduplicate(docs, landed=True).filter("kept").select("file", "row")
    rows, at = located(docs, True, "op7-stage")
    return only(rows, at, found)


SQL = r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = min(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)
"""
