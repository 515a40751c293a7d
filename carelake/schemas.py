"""Schemas of every table, declared once; no reader infers types."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITIES = ("patients", "sejours", "diagnostics", "monitoring", "referentiels", "actes")

LINEAGE = [
    T.StructField("source_date", T.DateType()),
    T.StructField("source_file", T.StringType()),
]


# What a raw row of the lake could not be typed or parsed for; NULL for a sound row. Never its text, which may identify.
MALFORMED = T.StructField("malformed", T.StringType())


def _table(*fields: tuple[str, T.DataType], lineage: bool = False) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields] + (LINEAGE if lineage else []))


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_TS, _D, _SH, _F = T.TimestampType(), T.DateType(), T.ShortType(), T.FloatType()

# Columns of the raw text files, in file order. Every value is read as text and typed later, so a
# bad value becomes a counted reject and not a failed job.
RAW_TEXT = {
    "patients": ["patient_id", "nir", "nom", "prenom", "birth_date", "sex", "region_code"],
    "sejours": [
        "stay_id", "patient_id", "service_code", "admission_ts", "discharge_ts",
        "admission_mode", "discharge_mode",
    ],
    "services": ["service_code", "service_label"],
    "cim10": ["code_cim10", "libelle"],
    "description_service": ["service_code", "categorie", "capacite_lits", "pole"],
    "ccam": ["code_ccam", "libelle", "tarif_euros"],
}

RAW_DIAGNOSTICS = T.StructType([
    T.StructField("stay_id", _S),
    T.StructField("diagnostics", T.ArrayType(_table(("code_cim10", _S), ("type", _S)))),
])
RAW_MONITORING = _table(
    ("stay_id", _S), ("ts", _TS), ("heart_rate", _SH), ("spo2", _SH), ("temp_c", _F))
RAW_ACTES = _table(("stay_id", _S), ("code_ccam", _S), ("acte_ts", _TS))

# The lake keeps text for the two pseudonymised CSV entities and for the reference files. CSV and
# Parquet rows carry `malformed`; a diagnosis file that does not parse never gets here.
_LAKE = {
    "patients": _table(
        ("patient_pseudo_id", _S), ("birth_year", _S), ("sex", _S), ("region_code", _S), lineage=True),
    "sejours": _table(
        ("stay_id", _S), ("patient_pseudo_id", _S), ("service_code", _S), ("admission_ts", _S),
        ("discharge_ts", _S), ("admission_mode", _S), ("discharge_mode", _S), lineage=True),
    "diagnostics": T.StructType(RAW_DIAGNOSTICS.fields + LINEAGE),
    "monitoring": T.StructType(RAW_MONITORING.fields + LINEAGE),
    "actes": T.StructType(RAW_ACTES.fields + LINEAGE),
    "services": _table(("service_code", _S), ("service_label", _S), lineage=True),
    "cim10": _table(("code_cim10", _S), ("libelle", _S), lineage=True),
    "description_service": _table(
        ("service_code", _S), ("categorie", _S), ("capacite_lits", _S), ("pole", _S), lineage=True),
    "ccam": _table(("code_ccam", _S), ("libelle", _S), ("tarif_euros", _S), lineage=True),
}

LAKE = {
    kind: table if kind == "diagnostics" else T.StructType([
        *(f for f in table if f not in LINEAGE), MALFORMED, *LINEAGE])
    for kind, table in _LAKE.items()
}

BRONZE = {
    "patients": _table(
        ("patient_pseudo_id", _S), ("birth_year", _I), ("sex", _S), ("region_code", _S), lineage=True),
    "sejours": _table(
        ("stay_id", _S), ("patient_pseudo_id", _S), ("service_code", _S), ("admission_ts", _TS),
        ("discharge_ts", _TS), ("admission_mode", _S), ("discharge_mode", _S), lineage=True),
    "diagnostics": _table(("stay_id", _S), ("code_cim10", _S), ("diag_type", _S), lineage=True),
    "monitoring": _LAKE["monitoring"],
    "actes": _LAKE["actes"],
    "ref_services": _table(("service_code", _S), ("service_label", _S), lineage=True),
    "ref_cim10": _table(("code_cim10", _S), ("libelle", _S), lineage=True),
    "ref_description_service": _table(
        ("service_code", _S), ("categorie", _S), ("capacite_lits", _I), ("pole", _S), lineage=True),
    "ref_ccam": _table(("code_ccam", _S), ("libelle", _S), ("tarif_euros", _I), lineage=True),
}

SILVER = {
    "dim_patients": _table(
        ("patient_pseudo_id", _S), ("birth_year", _I), ("sex", _S), ("region_code", _S), ("updated_at", _D)),
    "dim_services": _table(
        ("service_code", _S), ("service_label", _S), ("categorie", _S), ("capacite_lits", _I), ("pole", _S)),
    "dim_ccam": _table(("code_ccam", _S), ("libelle", _S), ("tarif_euros", _I)),
    "dim_cim10": _table(("code_cim10", _S), ("libelle", _S)),
    "fact_sejours": _table(
        ("stay_id", _S), ("patient_pseudo_id", _S), ("service_code", _S), ("admission_ts", _TS),
        ("discharge_ts", _TS), ("admission_mode", _S), ("discharge_mode", _S), ("is_ongoing", _I),
        ("duree_sejour_heures", T.DoubleType()), ("duree_sejour_jours", T.DoubleType())),
    "fact_diagnostics": _table(
        ("stay_id", _S), ("patient_pseudo_id", _S), ("age_at_diagnostics", _I), ("code_cim10", _S),
        ("diag_type", _S)),
    "fact_monitoring": _table(
        ("stay_id", _S), ("service_code", _S), ("ts", _TS), ("heart_rate", _SH), ("spo2", _SH),
        ("temp_c", _F), ("is_alert", _I), ("is_alert_fc", _I), ("is_alert_spo2", _I),
        ("is_alert_temp", _I), ("alert_reasons", _S)),
    "fact_acte": _table(("stay_id", _S), ("service_code", _S), ("code_ccam", _S), ("acte_ts", _TS)),
}

RUN_LOG = T.StructType([
    T.StructField("run_id", _S),
    T.StructField("started_at", _TS),
    T.StructField("finished_at", _TS),
    T.StructField("status", _S),
    T.StructField("step_name", _S),
    T.StructField("files_processed", T.ArrayType(_S)),
    T.StructField("records_ingested", _L),
    T.StructField("records_rejected", _L),
    T.StructField("error_message", _S),
])
