"""Silver: four dimensions and four facts, each a function of bronze DataFrames.

The facts are large and one stay or one patient may own a large share of their rows. So duplicates
are removed by keys before anything is joined, and facts are joined by `lookup`, which leaves AQE free
to split such keys. No join is hinted: Catalyst broadcasts a side only if it knows it to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import clinical
from carelake.operators import history, quality
from carelake.operators.dedup import latest_per_key
from carelake.operators.lookup import lookup

# Words used for what the reference data does not say.
NO_CATEGORY = "Non catégorisé"
NO_POLE = "Pôle Indéterminé"
NO_SERVICE = "INCONNU"

# States of rows that are kept, as counted by `reject_counts`.
KEPT_STATES = ("latest", "ongoing", "finished", "alert", "normal")

# ---- dimensions ----------------------------------------------------------------------------------


def dim_services(ref_services: DataFrame, ref_description: DataFrame) -> DataFrame:
    """B1: services with category, beds and pole; services without description get defaults."""
    services = latest_per_key(ref_services, ["service_code"])
    details = latest_per_key(ref_description, ["service_code"])
    return services.join(details.drop("source_date", "source_file"), "service_code", "left").select(
        "service_code",
        "service_label",
        clinical.blank_to(F.col("categorie"), NO_CATEGORY).alias("categorie"),
        F.coalesce("capacite_lits", F.lit(0)).alias("capacite_lits"),
        clinical.blank_to(F.col("pole"), NO_POLE).alias("pole"),
    )


def dim_ccam(ref_ccam: DataFrame) -> DataFrame:
    """B2: one label and tariff per procedure code."""
    return latest_per_key(ref_ccam, ["code_ccam"]).select("code_ccam", "libelle", "tarif_euros")


def dim_cim10(ref_cim10: DataFrame) -> DataFrame:
    """One label per diagnosis code."""
    return latest_per_key(ref_cim10, ["code_cim10"]).select("code_cim10", "libelle")


def dim_patients(patients: DataFrame) -> DataFrame:
    """The newest version of each patient, taken as a whole row."""
    return latest_per_key(patients, ["patient_pseudo_id"]).select(
        "patient_pseudo_id", "birth_year", "sex", "region_code",
        F.col("source_date").alias("updated_at"),
    )


def dim_patients_history(patients: DataFrame) -> DataFrame:
    """D1 as history: every version of a patient with the days it was valid on, of which `dim_patients` is the last."""
    return history.intervals(patients, "patient_pseudo_id", ["birth_year", "sex", "region_code"])


# ---- stays ---------------------------------------------------------------------------------------


def _coherent() -> Column:
    return clinical.is_coherent(F.col("admission_ts"), F.col("discharge_ts"))


def tagged_sejours(sejours: DataFrame) -> DataFrame:
    return quality.tag(sejours, discharge_before_admission=_coherent())


def fact_sejours(sejours: DataFrame) -> DataFrame:
    """Coherent stays, newest delivery per (service, admission, stay), with length of stay."""
    newest = latest_per_key(sejours.filter(_coherent()), ["service_code", "admission_ts", "stay_id"])
    admission, discharge = F.col("admission_ts"), F.col("discharge_ts")
    return newest.select(
        "stay_id", "patient_pseudo_id", "service_code", "admission_ts", "discharge_ts",
        "admission_mode", "discharge_mode",
        clinical.ongoing_flag(discharge).alias("is_ongoing"),
        clinical.length_of_stay(admission, discharge, 3600).alias("duree_sejour_heures"),
        clinical.length_of_stay(admission, discharge, 86400).alias("duree_sejour_jours"),
    )


def stay_index(sejours: DataFrame) -> DataFrame:
    """One row per stay for the event facts to look up, so a stay delivered again never doubles them.

    Patient, service and admission come from the newest delivery, coherent or not. `acte_service`
    prefers the newest coherent delivery that names a service, then any that does.
    """
    version = F.struct(
        "source_date", "source_file", "admission_ts", "discharge_ts", "patient_pseudo_id", "service_code")
    named = F.col("service_code") != ""
    return sejours.groupBy("stay_id").agg(
        F.max(version).alias("v"),
        F.max_by("service_code", F.when(named & _coherent(), version)).alias("coherent_service"),
        F.max_by("service_code", F.when(named, version)).alias("named_service"),
    ).select(
        "stay_id", "v.patient_pseudo_id", "v.service_code", "v.admission_ts",
        F.coalesce("coherent_service", "named_service", F.lit(NO_SERVICE)).alias("acte_service"),
    )


# ---- events of a stay ----------------------------------------------------------------------------


def _diagnoses(diagnostics: DataFrame) -> DataFrame:
    """One row per stay and code, principal where any delivery says so."""
    rank = F.struct(F.col("diag_type") != "principal", F.col("diag_type"))
    return diagnostics.groupBy("stay_id", "code_cim10").agg(F.min_by("diag_type", rank).alias("diag_type"))


def fact_diagnostics(
    diagnostics: DataFrame, stays: DataFrame, patients: DataFrame, carry: Sequence[str] = (),
) -> DataFrame:
    """One row per (code, patient, stay) with the age at admission, and the columns to `carry` from the stay.

    A stay has one patient, so the key is settled before the joins; a code given both as principal
    and as associated diagnosis stays principal.
    """
    aged_stays = lookup(stays, patients, "patient_pseudo_id").select(
        "stay_id",
        "patient_pseudo_id",
        clinical.age_at(F.col("admission_ts"), F.col("birth_year")).alias("age_at_diagnostics"),
        *carry,
    )
    return _diagnoses(diagnostics).join(aged_stays, "stay_id").select(
        "stay_id", "patient_pseudo_id", "age_at_diagnostics", "code_cim10", "diag_type", *carry)


def fact_diagnostics_as_of(diagnostics: DataFrame, stays: DataFrame, versions: DataFrame) -> DataFrame:
    """B6 with age and region as they were known at admission: of the patient's version valid on that day.

    versions: `dim_patients_history`. Rows and keys are those of `fact_diagnostics`.
    """
    admitted = stays.select("stay_id", "patient_pseudo_id", "admission_ts", F.to_date("admission_ts").alias("admission_day"))
    valid = history.as_of(admitted, versions, "patient_pseudo_id", "admission_day", ["birth_year", "region_code"])
    known = valid.select(
        "stay_id", "patient_pseudo_id", "region_code",
        clinical.age_at(F.col("admission_ts"), F.col("birth_year")).alias("age_at_diagnostics"))
    return _diagnoses(diagnostics).join(known, "stay_id").select(
        "stay_id", "patient_pseudo_id", "age_at_diagnostics", "region_code", "code_cim10", "diag_type")


def score_vitals(monitoring: DataFrame) -> DataFrame:
    """Plausible measures with their alert flags. Stateless: the same for a batch and a stream."""
    return monitoring.filter(clinical.vitals_plausible()).select(
        "stay_id", "ts", "heart_rate", "spo2", "temp_c",
        *clinical.alert_flags(), clinical.alert_reasons().alias("alert_reasons"),
    )


def fact_monitoring(monitoring: DataFrame, stays: DataFrame) -> DataFrame:
    """Plausible measures of known stays, with service and alert flags."""
    services = stays.select("stay_id", "service_code")
    return lookup(score_vitals(monitoring), services, "stay_id").select(
        "stay_id", "service_code", "ts", "heart_rate", "spo2", "temp_c",
        "is_alert", "is_alert_fc", "is_alert_spo2", "is_alert_temp", "alert_reasons",
    )


def vital_counts(monitoring: DataFrame, facts: DataFrame) -> DataFrame:
    """(table_name, reason, nb_rows) of the vital signs, given the `fact_monitoring` built from them.

    Nothing is joined: the plausible measures that the fact lacks are those of unknown stays.
    """
    rules = {f"{v.column}_out_of_range": v.plausible for v in clinical.VITALS}
    measured = quality.count_by_reason("monitoring", quality.tag(monitoring, **rules), F.lit("unknown_stay"))
    state = F.when(F.col("is_alert") == 1, "alert").otherwise("normal").alias("reason")
    kept = facts.groupBy(state).agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(
        F.struct("reason", F.col("n").alias("nb_rows")),
        F.struct(F.lit("unknown_stay").alias("reason"), (-F.col("n")).alias("nb_rows")),
    )).alias("c")).select(F.lit("monitoring").alias("table_name"), "c.*")
    return measured.unionByName(kept).groupBy("table_name", "reason").agg(
        F.sum("nb_rows").alias("nb_rows")).filter("nb_rows > 0")


def fact_acte(actes: DataFrame, stays: DataFrame) -> DataFrame:
    """One row per (service, code, stay, time); procedures of unknown stays are kept."""
    distinct = actes.select("stay_id", "code_ccam", "acte_ts").distinct()
    services = stays.select("stay_id", "acte_service")
    return lookup(distinct, services, "stay_id", "left").select(
        "stay_id",
        F.coalesce("acte_service", F.lit(NO_SERVICE)).alias("service_code"),
        "code_ccam",
        "acte_ts",
    )


# ---- accounting ----------------------------------------------------------------------------------


def reject_counts(bronze: dict[str, DataFrame], vitals: DataFrame) -> DataFrame:
    """Q9: (table_name, reason, nb_rows) for patients, stays and vital signs; `vitals` is their fact.

    Every input row is counted once: rejected rows under their reason, kept rows under `latest`
    (patients), `ongoing` or `finished` (stays), `alert` or `normal` (vital signs).
    """
    versions = bronze["patients"].groupBy("patient_pseudo_id").agg(F.count(F.lit(1)).alias("n"))
    merged = versions.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("merged_duplicate"),
        F.count(F.lit(1)).alias("latest"),
    ).unpivot([], ["merged_duplicate", "latest"], "reason", "nb_rows")
    stay_state = F.when(F.col("discharge_ts").isNull(), "ongoing").otherwise("finished")
    return (
        merged.select(F.lit("patients").alias("table_name"), "reason", "nb_rows")
        .unionByName(quality.count_by_reason("sejours", tagged_sejours(bronze["sejours"]), stay_state))
        .unionByName(vital_counts(bronze["monitoring"], vitals))
    )


def build(
    bronze: dict[str, DataFrame], stays: DataFrame | None = None, patients: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All eight tables.

    Pass the `stay_index` and `dim_patients` already written, so the facts read them instead of
    deduplicating stays and patients once more each.
    """
    stays = stay_index(bronze["sejours"]) if stays is None else stays
    patients = dim_patients(bronze["patients"]) if patients is None else patients
    return {
        "dim_services": dim_services(bronze["ref_services"], bronze["ref_description_service"]),
        "dim_ccam": dim_ccam(bronze["ref_ccam"]),
        "dim_cim10": dim_cim10(bronze["ref_cim10"]),
        "dim_patients": patients,
        "fact_sejours": fact_sejours(bronze["sejours"]),
        "fact_diagnostics": fact_diagnostics(bronze["diagnostics"], stays, patients),
        "fact_monitoring": fact_monitoring(bronze["monitoring"], stays),
        "fact_acte": fact_acte(bronze["actes"], stays),
    }
