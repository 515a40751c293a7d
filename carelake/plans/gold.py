"""Gold: the twelve datamarts as functions of silver DataFrames.

Every mart first shrinks the fact to its grouping keys and joins labels afterwards, so the joins see
as many rows as there are services or codes, and a service that owns a third of all rows is reduced
inside each map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions import clinical
from carelake.functions.numeric import hundredths, percent, ratio, round_even
from carelake.operators.generalise import Hierarchy, as_it_is, generalised, merged
from carelake.operators.suppression import MINIMUM_CELL

EMERGENCY_SERVICE = "URGENCES"
READMISSION_DAYS = (1, 30)

_SERVICE = ["service_code", "service_label", "categorie", "pole"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _finished() -> Column:
    return F.col("is_ongoing") == 0


def _ongoing() -> Column:
    return F.col("is_ongoing") == 1



# ---- stays ---------------------------------------------------------------------------------------


def dms(silver: dict[str, DataFrame]) -> DataFrame:
    """G1: length of stay per service.

    Stays are counted per service and length in hundredths of a day, which spreads a large service
    over many keys; mean, exact median and extremes then come from those few weighted rows.
    """
    return dms_of_lengths(length_counts(silver["fact_sejours"]), silver["dim_services"])


def length_counts(stays: DataFrame, *keys: str | Column) -> DataFrame:
    """Stays per service, state, length in hundredths of a day, and `keys`."""
    return stays.groupBy(
        "service_code", "is_ongoing", hundredths(F.col("duree_sejour_jours")).alias("length"), *keys).agg(_rows().alias("n"))


def dms_of_lengths(lengths: DataFrame, services: DataFrame) -> DataFrame:
    """G1 from counted lengths; counts of the same length may come in several rows."""
    length = F.when(_finished(), F.col("length"))
    finished = F.coalesce(F.sum(F.when(_finished(), F.col("n"))), F.lit(0))
    per_service = lengths.groupBy("service_code").agg(
        finished.alias("nb_sejours_termines"),
        F.coalesce(F.sum(F.when(_ongoing(), F.col("n"))), F.lit(0)).alias("nb_sejours_en_cours"),
        (F.rint(ratio(F.sum(length * F.col("n")), finished)) / 100).alias("dms_jours"),
        (F.rint(F.percentile(length, 0.5, F.col("n"))) / 100).alias("dms_mediane_jours"),
        (F.min(length) / 100.0).alias("dms_min_jours"),
        (F.max(length) / 100.0).alias("dms_max_jours"),
    )
    labels = services.select("service_code", "service_label")
    return per_service.join(labels, "service_code", "left").select(
        "service_code",
        F.coalesce("service_label", "service_code").alias("service_label"),
        "nb_sejours_termines", "nb_sejours_en_cours",
        "dms_jours", "dms_mediane_jours", "dms_min_jours", "dms_max_jours",
    ).orderBy("service_code")


def urgences(silver: dict[str, DataFrame]) -> DataFrame:
    """Visits and outcomes of the emergency service per admission day."""
    outcome = F.col("discharge_mode")
    return silver["fact_sejours"].filter(F.col("service_code") == EMERGENCY_SERVICE).groupBy(
        F.to_date("admission_ts").alias("date_passage"),
    ).agg(
        _rows().alias("nb_passages_total"),
        F.count_if(F.col("admission_mode") == "urgence").alias("nb_urgences_directes"),
        F.count_if(outcome == "domicile").alias("nb_sorties_domicile"),
        F.count_if(outcome == "mutation").alias("nb_mutations_internes"),
        F.count_if(outcome == "transfert").alias("nb_transferts_externes"),
        F.count_if(outcome == "deces").alias("nb_deces"),
        F.count_if(_ongoing()).alias("nb_patients_en_cours"),
        percent(
            F.count_if(outcome.isin("mutation", "transfert")), F.count_if(_finished()),
        ).alias("taux_hospitalisation_pct"),
    ).orderBy("date_passage")


def readmissions_30j(silver: dict[str, DataFrame]) -> DataFrame:
    """Finished stays that begin 1 to 30 calendar days after the patient's previous discharge.

    Stays follow each other by admission, then discharge. A discharge is never before its admission,
    so of the stays a patient begins on one day only the first can be such a readmission: the gap of
    the others is zero or negative. The stays are therefore reduced to one row per patient and day
    first, and the window per patient holds days, however many stays one patient may have.
    """
    days = silver["fact_sejours"].filter(_finished() & F.col("discharge_ts").isNotNull()).groupBy(
        "patient_pseudo_id", F.to_date("admission_ts").alias("day"),
    ).agg(
        _rows().alias("n"),
        F.max(F.struct("admission_ts", "discharge_ts")).alias("last"),
    )
    order = Window.partitionBy("patient_pseudo_id").orderBy("day")
    gap = F.datediff("day", F.to_date(F.lag("last.discharge_ts").over(order)))
    return days.select("n", gap.alias("gap")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nb_sejours_total"),
        F.count_if(F.col("gap").between(*READMISSION_DAYS)).alias("nb_readmissions_30j"),
    ).select(
        "nb_sejours_total", "nb_readmissions_30j",
        percent(F.col("nb_readmissions_30j"), F.col("nb_sejours_total")).alias("taux_readmission_pct"),
    )


def categories(silver: dict[str, DataFrame]) -> DataFrame:
    """Stays and length of stay per category and pole."""
    per_service = silver["fact_sejours"].groupBy("service_code").agg(
        F.count_if(_finished()).alias("finished"),
        F.count_if(_ongoing()).alias("ongoing"),
        F.sum(F.when(_finished(), hundredths(F.col("duree_sejour_jours")))).alias("length"),
    )
    services = silver["dim_services"].select("service_code", "categorie", "pole")
    return per_service.join(services, "service_code").groupBy("categorie", "pole").agg(
        F.sum("finished").alias("nb_sejours_termines"),
        F.sum("ongoing").alias("nb_sejours_en_cours"),
        (F.rint(ratio(F.sum("length"), F.sum("finished"))) / 100).alias("dms_jours"),
    ).orderBy(F.desc("nb_sejours_termines"), "categorie", "pole")


# ---- vital signs ---------------------------------------------------------------------------------


def alert_counts() -> list[Column]:
    """Measures, alerts, and alerts per vital sign."""
    flags = {"totales": "is_alert", "fc": "is_alert_fc", "spo2": "is_alert_spo2", "temp": "is_alert_temp"}
    return [_rows().alias("nb_mesures_totales"), *(F.count_if(F.col(c) == 1).alias(f"nb_alertes_{n}") for n, c in flags.items())]


def alertes(silver: dict[str, DataFrame]) -> DataFrame:
    """Measures and alerts per day."""
    return silver["fact_monitoring"].groupBy(F.to_date("ts").alias("jour")).agg(
        *alert_counts(),
        percent(F.count_if(F.col("is_alert") == 1), _rows()).alias("taux_alertes_pct"),
    ).orderBy("jour")


# ---- research ------------------------------------------------------------------------------------


def _with_pathology(df: DataFrame, silver: dict[str, DataFrame]) -> DataFrame:
    return df.join(silver["dim_cim10"], "code_cim10", "left").withColumn(
        "libelle_pathologie", F.coalesce("libelle", "code_cim10"))


def prevalence(silver: dict[str, DataFrame]) -> DataFrame:
    """Patients and diagnoses per pathology."""
    per_code = silver["fact_diagnostics"].groupBy("code_cim10").agg(
        F.count_distinct("patient_pseudo_id").alias("nb_patients_uniques"),
        _rows().alias("nb_diagnostics_total"),
        F.count_if(F.col("diag_type") == "principal").alias("nb_diagnostic_principal"),
        F.count_if(F.col("diag_type") == "associe").alias("nb_diagnostic_associe"),
    )
    return _with_pathology(per_code, silver).select(
        "code_cim10", "libelle_pathologie", "nb_patients_uniques", "nb_diagnostics_total",
        "nb_diagnostic_principal", "nb_diagnostic_associe",
    ).orderBy(F.desc("nb_patients_uniques"), "code_cim10")


def cohortes(silver: dict[str, DataFrame]) -> DataFrame:
    """Patients per pathology, age band and sex. Small cells are still in: see P6.

    A patient is reduced to one row per pathology and band before the join to the patients, whose key
    is unique, so the final count needs no second distinct. Bands travel as their first age; labels
    are put on the finished cells.
    """
    members = silver["fact_diagnostics"].select(
        "code_cim10",
        clinical.age_band_start(F.col("age_at_diagnostics")).alias("band_start"),
        "patient_pseudo_id",
    ).distinct()
    sexes = silver["dim_patients"].select("patient_pseudo_id", "sex")
    cells = members.join(sexes, "patient_pseudo_id").groupBy(
        "code_cim10", "band_start", "sex").agg(_rows().alias("nb_patients"))
    return _with_pathology(cells, silver).orderBy(
        "code_cim10", F.asc_nulls_last("band_start"), "sex",
    ).select(
        "code_cim10", "libelle_pathologie",
        clinical.age_band(F.col("band_start")).alias("tranche_age"), "sex", "nb_patients")


def cohort_cells(silver: dict[str, DataFrame]) -> DataFrame:
    """Patients per pathology, age at its first diagnosis (the youngest), region and sex.

    Each patient is in one cell of a pathology, so cells may be added up; ages unknown come last and are one.
    """
    first = silver["fact_diagnostics"].groupBy("code_cim10", "patient_pseudo_id").agg(F.min("age_at_diagnostics").alias("age"))
    people = silver["dim_patients"].select("patient_pseudo_id", "region_code", "sex")
    return first.join(people, "patient_pseudo_id").groupBy("code_cim10", "age", "region_code", "sex").agg(_rows().alias("nb_patients"))


def _age_span(years: int) -> Callable[[Column], Column]:
    """Ages as `from-to`, in spans that divide those above them; no age is `inconnu`."""
    def span(age: Column) -> Column:
        start = F.floor(age / years) * years
        named = start.cast("string") if years == 1 else F.concat_ws("-", start.cast("string"), (start + years - 1).cast("string"))
        return F.when(age.isNull(), F.lit(clinical.UNKNOWN_BAND)).otherwise(named)

    return span


COHORT_LEVELS = (
    Hierarchy("age", (*map(_age_span, (1, 5, 10, 20, 40)), merged)),
    Hierarchy("region_code", (as_it_is, merged)),
    Hierarchy("sex", (as_it_is, merged)),
)


def cohortes_generalisees(cells: DataFrame, minimum: int = MINIMUM_CELL) -> DataFrame:
    """G6 for publication without a hole: written `cohort_cells` at the finest levels at which every cohort has `minimum` patients."""
    return generalised(cells, COHORT_LEVELS, ["code_cim10"], "nb_patients", minimum)


def synthese(silver: dict[str, DataFrame]) -> DataFrame:
    """Patients, diagnoses and pathologies overall."""
    return silver["fact_diagnostics"].agg(
        F.count_distinct("patient_pseudo_id").alias("nb_patients_total"),
        _rows().alias("nb_diagnostics_total"),
        F.count_distinct("code_cim10").alias("nb_pathologies_surveillees"),
    )


# ---- procedures ----------------------------------------------------------------------------------


def actes_services(silver: dict[str, DataFrame]) -> DataFrame:
    """Procedures per service and per stay concerned."""
    per_stay = silver["fact_acte"].groupBy("service_code", "stay_id").agg(_rows().alias("n"))
    per_service = per_stay.groupBy("service_code").agg(
        F.sum("n").alias("nb_actes_total"), _rows().alias("nb_sejours_concernes"))
    return per_service.join(silver["dim_services"], "service_code").select(
        *_SERVICE, "nb_actes_total", "nb_sejours_concernes",
        round_even(ratio(F.col("nb_actes_total"), F.col("nb_sejours_concernes")))
        .alias("moyenne_actes_par_sejour"),
    ).orderBy(F.desc("nb_actes_total"), "service_code")


def actes_ccam(silver: dict[str, DataFrame]) -> DataFrame:
    """Procedures and amount per procedure code."""
    per_code = silver["fact_acte"].groupBy("code_ccam").agg(_rows().alias("nb_actes_total"))
    return per_code.join(silver["dim_ccam"], "code_ccam").select(
        "code_ccam",
        F.col("libelle").alias("libelle_acte"),
        F.col("tarif_euros").alias("tarif_unitaire_euros"),
        "nb_actes_total",
        (F.col("nb_actes_total") * F.col("tarif_euros")).alias("montant_total_euros"),
    ).orderBy(F.desc("nb_actes_total"), "code_ccam")


def densite_plateau(silver: dict[str, DataFrame]) -> DataFrame:
    """Procedures per bed; services without procedures count 0, without beds NULL."""
    per_service = silver["fact_acte"].groupBy("service_code").agg(_rows().alias("n"))
    actes = F.coalesce("n", F.lit(0).cast("long"))
    return silver["dim_services"].join(per_service, "service_code", "left").select(
        *_SERVICE, "capacite_lits",
        actes.alias("nb_actes_total"),
        round_even(ratio(actes, F.col("capacite_lits"))).alias("densite_actes_par_lit"),
    ).orderBy(F.desc_nulls_last("densite_actes_par_lit"), "service_code")


def facturation_t2a(silver: dict[str, DataFrame]) -> DataFrame:
    """Amount billed per service, for procedures whose code has a tariff."""
    per_code = silver["fact_acte"].groupBy("service_code", "code_ccam").agg(_rows().alias("n"))
    tariffs = silver["dim_ccam"].select("code_ccam", "tarif_euros")
    per_service = per_code.join(tariffs, "code_ccam").groupBy("service_code").agg(
        F.sum("n").alias("nb_actes_total"),
        F.sum(F.col("n") * F.col("tarif_euros")).alias("montant_total_t2a_euros"),
    )
    return per_service.join(silver["dim_services"], "service_code").select(
        *_SERVICE, "nb_actes_total", "montant_total_t2a_euros",
    ).orderBy(F.desc("montant_total_t2a_euros"), "service_code")


VIEWS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "vue_pilotage_dms": dms,
    "vue_pilotage_urgences": urgences,
    "vue_pilotage_readmissions_30j": readmissions_30j,
    "vue_pilotage_alertes": alertes,
    "vue_recherche_prevalence": prevalence,
    "vue_recherche_cohortes": cohortes,
    "vue_recherche_synthese": synthese,
    "vue_pilotage_categories": categories,
    "vue_pilotage_actes_services": actes_services,
    "vue_pilotage_actes_ccam": actes_ccam,
    "vue_pilotage_densite_plateau": densite_plateau,
    "vue_pilotage_facturation_t2a": facturation_t2a,
}


def register_views(silver: dict[str, DataFrame]) -> None:
    """Make every mart available to SQL as a temporary view. Nothing runs until one is queried."""
    for name, view in VIEWS.items():
        view(silver).createOrReplaceTempView(name)
