"""Nested diagnosis records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import schemas

_UNPARSED = "_unparsed"
_PARSED = f"records array<{schemas.RAW_DIAGNOSTICS.simpleString()}>, {_UNPARSED} string"

PRINCIPAL = "principal"


def parse(text: Column) -> Column:
    """The text of one delivered file, an array of records. Judge the result with `damaged`.

    The array is parsed as the only member of an object, so that text behind it is seen as well.
    """
    whole = F.concat(F.lit('{"records":'), text, F.lit("}"))
    return F.from_json(whole, _PARSED, {"columnNameOfCorruptRecord": _UNPARSED})


def damaged(parsed: Column) -> Column:
    """Whether the text was not one sound array: cut off, broken inside, empty, or something else."""
    return parsed.isNull() | parsed[_UNPARSED].isNotNull() | parsed["records"].isNull() | F.coalesce(
        F.exists(parsed["records"], lambda r: r.isNull()), F.lit(True))


def records(parsed: Column) -> Column:
    return parsed["records"]


def flatten(nested: DataFrame) -> DataFrame:
    """One row per diagnosis of a stay; a stay with an empty list gives none.

    A missing code becomes the empty text, a missing type the principal diagnosis. The empty lists go
    after the explode: before it, Catalyst would evaluate the list once more only to test its size,
    which for a list parsed from JSON means parsing it again.
    """
    lineage = [c for c in ("source_date", "source_file") if c in nested.columns]
    return nested.select("stay_id", F.explode_outer("diagnostics").alias("d"), *lineage).filter(
        F.col("d").isNotNull(),
    ).select(
        F.coalesce("stay_id", F.lit("")).alias("stay_id"),
        F.coalesce("d.code_cim10", F.lit("")).alias("code_cim10"),
        F.coalesce("d.type", F.lit(PRINCIPAL)).alias("diag_type"),
        *lineage,
    )
