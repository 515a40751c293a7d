"""Raw drops: `<root>/<entity>/<yyyy-mm-dd>/<file>`, listed and read as DataFrames.

A delivered `file` may also be a folder of part files, as large Parquet deliveries are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake import schemas
from carelake.session import exists
from carelake.sources import arrays, diagnostics

# Which file of a drop holds what. Other files in a drop are left alone.
KINDS = {
    "patients/patients.csv": "patients",
    "sejours/sejours.csv": "sejours",
    "diagnostics/diagnostics.json": "diagnostics",
    "monitoring/monitoring.parquet": "monitoring",
    "actes/actes.parquet": "actes",
    "referentiels/services.csv": "services",
    "referentiels/cim10.csv": "cim10",
    "referentiels/description_service.csv": "description_service",
    "referentiels/ccam.csv": "ccam",
}
FILE_OF = {kind: path for path, kind in KINDS.items()}
REFERENCE_KINDS = ("services", "cim10", "description_service", "ccam")

_DROP = rf"^.*/({'|'.join(schemas.ENTITIES)})/(\d{{4}}-\d{{2}}-\d{{2}})/([^/]+)"
_PLACE = rf"^.*/((?:{'|'.join(schemas.ENTITIES)})/\d{{4}}-\d{{2}}-\d{{2}}/[^/]+)"
_DAY = "-".join("[0-9]" * n for n in (4, 2, 2))  # as a glob: nothing that lies deeper is taken for a delivery
DAMAGED_COLUMNS = "a file lacks the columns"
DAMAGED = "a diagnosis file is not one sound JSON array"
_FILES_SCHEMA = "kind string, source_date date, source_file string, path string, bytes bigint, version string"

# Whole numbers below this are no nanoseconds of a date after 1973; writers that mean seconds,
# milliseconds or microseconds without saying so are not guessed at.
_LEAST_NANOSECONDS = 10**17


class DamagedFile(ValueError):
    """A delivered file that cannot be taken as what its name says."""


def lineage(path: Column) -> list[Column]:
    """`source_date` and `source_file` (relative to the root) of a file path.

    Every row of a file goes through this, so the pattern is looked for once and not for each part of the place.
    """
    place = F.regexp_extract(path, _PLACE, 1)
    entity, day, file = (F.split_part(place, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    return [
        day.try_cast("date").alias("source_date"),
        F.concat_ws("/", entity, day, file).alias("source_file"),
    ]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(kind, source_date, source_file, path, bytes, version) of every delivered file of a known kind.

    The listing is a scan of file names; no content is read. The version changes whenever a part of the
    file is written, added or removed: it is made of the parts' names, lengths and modification times. A file
    without a byte is not delivered yet and not listed, whatever else its day holds; if it had content
    before, that stays until it is delivered with content again. A root that is not there is an error, not
    an empty delivery.
    """
    if not exists(spark, root):
        raise FileNotFoundError(f"no drops at {root}")
    try:
        found = spark.read.format("binaryFile").load(f"{root}/*/{_DAY}/*").select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES_SCHEMA)
    kinds = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    entity, file = F.regexp_extract("path", _DROP, 1), F.regexp_extract("path", _DROP, 3)
    delivered = F.regexp_extract("path", _DROP, 0).alias("path")
    return found.select(
        F.try_element_at(kinds, F.concat_ws("/", entity, file)).alias("kind"),
        *lineage(F.col("path")),
        delivered,
        "length",
        F.xxhash64(F.regexp_replace("path", _DROP, ""), "length", F.unix_micros("modificationTime")).alias("part"),
    ).filter("kind is not null and source_date is not null").groupBy(
        "kind", "source_date", "source_file", "path",
    ).agg(
        F.sum("length").alias("bytes"),
        F.concat_ws("-", F.count("*"), F.sum("length"), F.hex(F.bit_xor("part"))).alias("version"))


def source_dates(files: DataFrame) -> DataFrame:
    """The drop dates, ascending."""
    return files.select("source_date").distinct().orderBy("source_date")


# ---- readers -------------------------------------------------------------------------------------


def read(spark: SparkSession, kind: str, paths: Sequence[str]) -> DataFrame:
    """Raw rows of the given files with their lineage and, but for diagnoses, what is `malformed` in them."""
    if kind in schemas.RAW_TEXT:
        raw = _read_csv(spark, kind, paths)
    elif kind == "diagnostics":
        raw = _read_diagnostics(spark, paths)
    else:
        raw = _read_parquet(spark, kind, paths)
    columns = [c for c in raw.columns if c != "_path"]
    return raw.select(*columns, *lineage(F.col("_path")))


def _read_diagnostics(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records of the delivered arrays. A file of any size is read by as many tasks as it has byte ranges.

    A file that is not one sound array fails the read and is named in the error: nothing of it is
    taken for a success.
    """
    parts = arrays.sound(arrays.records(spark, paths))
    parsed = diagnostics.parse(F.concat(F.lit("["), "record", F.lit("]")))
    broken = F.raise_error(F.concat(F.lit(f"{DAMAGED}: "), F.col("path"))).cast(f"array<{schemas.RAW_DIAGNOSTICS.simpleString()}>")
    none = F.array().cast(f"array<{schemas.RAW_DIAGNOSTICS.simpleString()}>")
    found = F.when(F.col("damaged"), broken).when(F.col("record").isNull(), none).when(
        diagnostics.damaged(parsed), broken).otherwise(diagnostics.records(parsed))
    return parts.select(F.explode(found).alias("r"), F.col("path").alias("_path")).select("r.*", "_path")


_RECORD = "_unparsed_record"


def _read_csv(spark: SparkSession, kind: str, paths: Sequence[str]) -> DataFrame:
    """Text columns picked by header name, so their order in the file does not matter.

    `enforceSchema=False` makes Spark compare every file's header with the first one and fail on a
    difference, instead of filling the wrong columns. A column the files lack reads as NULL. A record
    with too few or too many fields, such as either half of one that is torn by a line break, is
    marked as malformed; its text is dropped, as it may identify a patient.
    """
    def options(schema: str | None):
        reader = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            # quoted line breaks only occur in labels; the large files stay splittable
            .option("multiLine", kind in REFERENCE_KINDS)
            # all fields of a record are looked at, whichever are asked for
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _RECORD)
        )
        return (reader.schema(schema) if schema else reader).csv(list(paths))

    present = options(None).columns
    schema = ", ".join(f"`{c}` string" for c in [*present, _RECORD])
    raw = options(schema)
    return raw.select(
        *(
            (F.col(f"`{c}`") if c in present else F.lit(None).cast("string")).alias(c)
            for c in schemas.RAW_TEXT[kind]
        ),
        F.when(F.col(_RECORD).isNotNull(), "record").alias("malformed"),
        F.col("_metadata.file_path").alias("_path"),
    )


def _read_parquet(spark: SparkSession, kind: str, paths: Sequence[str]) -> DataFrame:
    """Only the declared columns, in the declared types, whatever widths the writer chose.

    A value that is there but does not fit its type marks the row: `malformed` names the first such
    column.
    """
    declared = {"monitoring": schemas.RAW_MONITORING, "actes": schemas.RAW_ACTES}[kind]
    raw = spark.read.parquet(*paths)
    types = dict(raw.dtypes)
    lacking = [f.name for f in declared if f.name not in types]
    if lacking:
        raise DamagedFile(f"{DAMAGED_COLUMNS} {', '.join(lacking)}: {', '.join(paths)}")
    typed, misfits = typed_columns(declared, types)
    return raw.select(*typed, F.coalesce(*misfits).alias("malformed"), F.col("_metadata.file_path").alias("_path"))


def typed_columns(declared: StructType, types: dict[str, str]) -> tuple[list[Column], list[Column]]:
    """Each declared column cast from the type it was read in, and its name where the cast lost a value."""
    typed, misfits = [], []
    for field in declared:
        value = F.col(field.name)
        if types[field.name] in ("double", "float"):
            value = F.nullif(value, F.lit(float("nan")))  # writers without NULL store NaN
        column = value
        if field.dataType.typeName() == "timestamp" and types[field.name] == "bigint":
            # nanoseconds, see session settings; whole division, as doubles cannot hold them
            micros = F.expr(f"(`{field.name}` - pmod(`{field.name}`, 1000)) div 1000")
            column = F.when(F.abs(value) >= _LEAST_NANOSECONDS, F.timestamp_micros(micros))
        column = column.try_cast(field.dataType)
        typed.append(column.alias(field.name))
        misfits.append(F.when(value.isNotNull() & column.isNull(), field.name))
    return typed, misfits
