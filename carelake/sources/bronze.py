"""Lake rows -> typed bronze rows, with the rows that do not type set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.privacy import strip
from carelake.operators import quality
from carelake.sources import diagnostics

_STAMP = "yyyy-M-d H:m:s"

# Bronze table of each lake kind.
TABLE_OF = {
    "patients": "patients",
    "sejours": "sejours",
    "diagnostics": "diagnostics",
    "monitoring": "monitoring",
    "actes": "actes",
    "services": "ref_services",
    "cim10": "ref_cim10",
    "description_service": "ref_description_service",
    "ccam": "ref_ccam",
}


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def _whole_number(column: str) -> Column:
    """Blank counts as 0; text that is no number becomes NULL and is rejected."""
    return F.when(_blank(column), F.lit("0")).otherwise(strip(F.col(column))).try_cast("int")


def tagged(kind: str, lake: DataFrame) -> DataFrame:
    """Typed rows of one kind, each with the reason it would be rejected for, if any.

    What was `malformed` when the drop was read comes first, then the rules of the kind.
    """
    rows = _tagged(kind, lake)
    if "malformed" not in rows.columns:
        return rows
    misread = F.concat(F.lit("malformed_"), "malformed")
    return rows.withColumn(quality.REASON, F.coalesce(misread, quality.REASON)).drop("malformed")


def rejects(tagged_rows: DataFrame) -> DataFrame:
    """(reason, record, lineage) of the rows that are set apart; the record is the typed row as JSON."""
    return quality.rejected(tagged_rows).select(
        F.col(quality.REASON).alias("reason"),
        F.to_json(F.struct(*(c for c in tagged_rows.columns if c != quality.REASON))).alias("record"),
        "source_date", "source_file")


def _carried(lake: DataFrame) -> list[str]:
    return [c for c in ("malformed", "source_date", "source_file") if c in lake.columns]


def _tagged(kind: str, lake: DataFrame) -> DataFrame:
    return {
        "patients": _patients,
        "sejours": _sejours,
        "diagnostics": lambda rows: quality.tag(diagnostics.flatten(rows)),
        "monitoring": lambda rows: quality.tag(rows, missing_ts=F.col("ts").isNotNull()),
        "actes": lambda rows: quality.tag(rows, missing_ts=F.col("acte_ts").isNotNull()),
        "services": lambda rows: quality.tag(_texts(rows, "service_code", "service_label")),
        "cim10": lambda rows: quality.tag(_texts(rows, "code_cim10", "libelle")),
        "description_service": _description_service,
        "ccam": _ccam,
    }[kind](lake)


def _texts(lake: DataFrame, *columns: str) -> DataFrame:
    return lake.select(*map(_text, columns), *_carried(lake))


def _patients(lake: DataFrame) -> DataFrame:
    """S3: a blank year of birth is 0, which means unknown."""
    typed = lake.select(
        _text("patient_pseudo_id"), _whole_number("birth_year").alias("birth_year"),
        _text("sex"), _text("region_code"), *_carried(lake),
    )
    return quality.tag(typed, malformed_birth_year=F.col("birth_year").isNotNull())


def _sejours(lake: DataFrame) -> DataFrame:
    """Timestamps from text; a blank discharge means the stay is ongoing."""
    stamps = {c: F.try_to_timestamp(F.col(c), F.lit(_STAMP)) for c in ("admission_ts", "discharge_ts")}
    tagged_rows = quality.tag(
        lake.withColumns({f"_{c}": stamp for c, stamp in stamps.items()}),
        missing_admission=~_blank("admission_ts"),
        malformed_admission=F.col("_admission_ts").isNotNull(),
        malformed_discharge=_blank("discharge_ts") | F.col("_discharge_ts").isNotNull(),
    )
    return tagged_rows.select(
        _text("stay_id"), _text("patient_pseudo_id"), _text("service_code"),
        F.col("_admission_ts").alias("admission_ts"), F.col("_discharge_ts").alias("discharge_ts"),
        _text("admission_mode"), _text("discharge_mode"),
        *_carried(lake), quality.REASON,
    )


def _description_service(lake: DataFrame) -> DataFrame:
    """Stripped texts, a blank number of beds is 0."""
    typed = lake.select(
        strip(_text("service_code")).alias("service_code"),
        strip(_text("categorie")).alias("categorie"),
        _whole_number("capacite_lits").alias("capacite_lits"),
        strip(_text("pole")).alias("pole"),
        *_carried(lake),
    )
    return quality.tag(typed, malformed_beds=F.col("capacite_lits").isNotNull())


def _ccam(lake: DataFrame) -> DataFrame:
    """Stripped texts, a blank tariff is 0."""
    typed = lake.select(
        strip(_text("code_ccam")).alias("code_ccam"),
        strip(_text("libelle")).alias("libelle"),
        _whole_number("tarif_euros").alias("tarif_euros"),
        *_carried(lake),
    )
    return quality.tag(typed, malformed_tariff=F.col("tarif_euros").isNotNull())
