from __future__ import annotations

import helpers as h
from helpers import at, day, rows
from pyspark.sql import functions as F

from carelake.operators import history
from carelake.plans import silver


def test_dim_services_defaults(spark):
    services = h.ref_services(spark, ("A", "Alpha"), ("B", "Beta"), ("C", "Gamma"), ("A", "Alpha"))
    details = h.ref_description(spark, ("A", "med", 10, "P1"), ("B", "", 0, ""), ("Z", "x", 1, "y"))
    assert rows(silver.dim_services(services, details)) == [
        ("A", "Alpha", "med", 10, "P1"),
        ("B", "Beta", "Non catégorisé", 0, "Pôle Indéterminé"),
        ("C", "Gamma", "Non catégorisé", 0, "Pôle Indéterminé"),
    ]


def test_reference_dimensions_have_one_row_per_key(spark):
    ccam = h.ref_ccam(spark, ("X1", "b", 10), ("X1", "a", 20), ("X2", "c", 5), ("X2", "c", 5))
    assert rows(silver.dim_ccam(ccam)) == [("X1", "b", 10), ("X2", "c", 5)]
    cim10 = h.ref_cim10(spark, ("I21", "x"), ("I21", "x"), ("I50", "a"), ("I50", "b"))
    assert rows(silver.dim_cim10(cim10)) == [("I21", "x"), ("I50", "b")]


def test_dim_patients_takes_the_newest_row_as_a_whole(spark):
    versions = h.patients(
        spark, ("p", 1980, "M", "R1", "2026-08-01"), ("p", 0, "F", "R2", "2026-08-03"),
        ("p", 1981, "M", "R3", "2026-08-02"),
        ("q", 1990, "F", "R1", "2026-08-01", "a.csv"), ("q", 1991, "F", "R1", "2026-08-01", "b.csv"))
    assert rows(silver.dim_patients(versions)) == [
        ("p", 0, "F", "R2", day("2026-08-03")), ("q", 1991, "F", "R1", day("2026-08-01"))]


def test_fact_sejours(spark):
    stays = h.sejours(
        spark,
        ("s1", "p", "A", "2026-08-01 10:00", "2026-08-03 22:00"),
        ("s2", "p", "A", "2026-08-01 10:00", None),
        ("s3", "p", "A", "2026-08-01 10:00", "2026-08-01 10:00"),
        ("s4", "p", "A", "2026-08-01 10:00", "2026-08-01 09:59"),
        # delivered again, finished: same key, newest delivery wins
        ("s2", "p", "A", "2026-08-01 10:00", "2026-08-02 10:00", "urgence", "deces", "2026-08-05"),
    )
    got = silver.fact_sejours(stays)
    assert rows(got, "stay_id", "is_ongoing", "duree_sejour_heures", "duree_sejour_jours", "discharge_mode") == [
        ("s1", 0, 60.0, 2.5, "domicile"), ("s2", 0, 24.0, 1.0, "deces"), ("s3", 0, 0.0, 0.0, "domicile")]


def test_incoherent_redelivery_does_not_hide_the_coherent_stay(spark):
    stays = h.sejours(
        spark, ("s", "p", "A", "2026-08-01 10:00", "2026-08-03 10:00"),
        ("s", "p", "A", "2026-08-01 10:00", "2026-07-01 10:00", "urgence", "domicile", "2026-08-02"))
    assert rows(silver.fact_sejours(stays), "stay_id", "duree_sejour_jours") == [("s", 2.0)]


def test_stay_index_has_one_row_per_stay(spark):
    stays = h.sejours(
        spark,
        ("s1", "p1", "A", "2026-08-01", "2026-08-02"),
        ("s1", "p2", "B", "2026-08-01", "2026-07-01", "urgence", "domicile", "2026-08-09"),  # incoherent, newer
        ("s2", "p1", "", "2026-08-01", None),
        ("s3", "p1", "C", "2026-08-01", "2026-07-01"),  # only an incoherent delivery
        ("s4", "p1", "D", "2026-08-01", None),
        ("s4", "p1", "", "2026-08-01", None, "urgence", "", "2026-08-09"),
    )
    got = rows(silver.stay_index(stays), "stay_id", "patient_pseudo_id", "service_code", "acte_service")
    assert got == [
        ("s1", "p2", "B", "A"), ("s2", "p1", "", "INCONNU"), ("s3", "p1", "C", "C"), ("s4", "p1", "", "D")]


def test_fact_diagnostics(spark):
    stays = silver.stay_index(h.sejours(
        spark, ("s1", "p", "A", "2026-08-01", None), ("s2", "q", "A", "2026-08-01", "2026-07-01"),
        ("s2", "q", "A", "2026-08-01", "2026-07-01", "urgence", "", "2026-08-05"),
        ("s3", "nobody", "A", "2026-08-01", None), ("s4", "r", "A", "2026-08-01", None)))
    patients = silver.dim_patients(h.patients(spark, ("p", 1986, "M"), ("q", 0, "F"), ("r", 2030, "F")))
    diagnoses = h.diagnostics(
        spark, ("s1", "I21", "associe"), ("s1", "I21", "principal"), ("s1", "I21", "principal"),
        ("s1", "E11", "associe"), ("s2", "I21", "principal"), ("s3", "I21", "principal"),
        ("s4", "I21", "autre"), ("none", "I21", "principal"))
    assert rows(silver.fact_diagnostics(diagnoses, stays, patients)) == [
        ("s1", "p", 40, "E11", "associe"), ("s1", "p", 40, "I21", "principal"),
        ("s2", "q", None, "I21", "principal"), ("s4", "r", 0, "I21", "autre")]


def test_fact_monitoring(spark):
    stays = silver.stay_index(h.sejours(
        spark, ("s1", "p", "A", "2026-08-01", None),
        ("s1", "p", "A", "2026-08-01", "2026-08-09", "urgence", "deces", "2026-08-05"),  # delivered again
        ("s2", "p", "B", "2026-08-01", "2026-07-01")))  # rejected stays still count
    measures = h.monitoring(
        spark, ("s1", "2026-08-01 10:00", 70, 98, 37.0), ("s1", "2026-08-01 10:00", 70, 98, 37.0),
        ("s1", "2026-08-01 11:00", 300, 98, 37.0), ("s2", "2026-08-01 10:00", 130, 90, None),
        ("s9", "2026-08-01 10:00", 70, 98, 37.0))
    got = silver.fact_monitoring(measures, stays)
    assert rows(got, "stay_id", "service_code", "is_alert", "alert_reasons") == [
        ("s1", "A", 0, ",,"), ("s1", "A", 0, ",,"), ("s2", "B", 1, "FC_ANORMALE,HYPOXIE,")]


def test_fact_acte(spark):
    stays = silver.stay_index(h.sejours(
        spark, ("s1", "p", "A", "2026-08-01", None), ("s2", "p", "B", "2026-08-01", "2026-07-01")))
    procedures = h.actes(
        spark, ("s1", "X", "2026-08-02"), ("s1", "X", "2026-08-02"), ("s1", "X", "2026-08-03"),
        ("s2", "X", "2026-08-02"), ("s9", "Y", "2026-08-02"))
    assert rows(silver.fact_acte(procedures, stays), "stay_id", "service_code", "code_ccam", "acte_ts") == [
        ("s1", "A", "X", at("2026-08-02")), ("s1", "A", "X", at("2026-08-03")),
        ("s2", "B", "X", at("2026-08-02")), ("s9", "INCONNU", "Y", at("2026-08-02"))]


def test_reject_counts_add_up(spark):
    stays = h.sejours(
        spark, ("s1", "p", "A", "2026-08-01", None), ("s2", "p", "A", "2026-08-01", "2026-08-02"),
        ("s3", "p", "A", "2026-08-01", "2026-07-02"))
    bronze = {
        "sejours": stays,
        "patients": h.patients(spark, ("p", 1980, "M"), ("p", 1981, "M"), ("q", 1980, "M")),
        "monitoring": h.monitoring(
            spark, ("s1", "2026-08-01", 70, 98, 37.0), ("s1", "2026-08-01", 130, 98, 37.0),
            ("s1", "2026-08-01", 300, 20, 37.0), ("s1", "2026-08-01", None, 20, 50.0),
            ("s1", "2026-08-01", None, None, 50.0), ("s9", "2026-08-01", 70, 98, 37.0)),
    }
    facts = silver.fact_monitoring(bronze["monitoring"], silver.stay_index(stays))
    got = rows(silver.reject_counts(bronze, facts))
    assert got == [
        ("monitoring", "alert", 1), ("monitoring", "heart_rate_out_of_range", 1), ("monitoring", "normal", 1),
        ("monitoring", "spo2_out_of_range", 1), ("monitoring", "temp_c_out_of_range", 1),
        ("monitoring", "unknown_stay", 1), ("patients", "latest", 2), ("patients", "merged_duplicate", 1),
        ("sejours", "discharge_before_admission", 1), ("sejours", "finished", 1), ("sejours", "ongoing", 1)]


def test_patient_history_and_the_version_at_admission(spark):
    """Runs of equal versions are one interval; a fact before, on, between and after version days, without a day, of no patient."""
    versions = h.patients(
        spark, ("P1", 1950, "F", "R1", "2026-08-01"), ("P1", 1950, "F", "R1", "2026-08-03"), ("P1", 1960, "F", "R2", "2026-08-05", "a"),
        ("P1", 1961, "F", "R2", "2026-08-05", "b"), ("P1", 1950, "F", "R1", "2026-08-09"), ("P2", 0, "M", "R3", "2026-08-02"))
    past = silver.dim_patients_history(versions)
    assert rows(past, "patient_pseudo_id", "birth_year", "region_code", "valid_from", "valid_to") == sorted([
        ("P1", 1950, "R1", day("2026-08-01"), day("2026-08-05")), ("P1", 1961, "R2", day("2026-08-05"), day("2026-08-09")),
        ("P1", 1950, "R1", day("2026-08-09"), None), ("P2", 0, "R3", day("2026-08-02"), None)], key=repr)
    facts = spark.createDataFrame([
        (1, "P1", day("2026-07-01")), (2, "P1", day("2026-08-04")), (3, "P1", day("2026-08-05")), (4, "P1", day("2026-08-08")),
        (5, "P1", day("2026-09-01")), (6, "P1", None), (7, "P2", day("2026-01-01")), (8, "P9", day("2026-08-01")), (9, None, day("2026-08-01")),
        (2, "P1", day("2026-08-04")),
    ], "id int, patient_pseudo_id string, at date")
    found = history.as_of(facts, past, "patient_pseudo_id", "at", ["birth_year"])
    assert rows(found, "id", "birth_year") == [(1, 1950), (2, 1950), (2, 1950), (3, 1961), (4, 1961), (5, 1950), (6, 1950), (7, 0)]


def test_diagnoses_as_of_admission(spark):
    stays = silver.stay_index(h.sejours(spark, ("S1", "P1", "A", "2026-08-04 10:00", None), ("S2", "P1", "A", "2026-08-06 10:00", None), ("S3", "P9", "A", "2026-08-06 10:00", None)))
    past = silver.dim_patients_history(h.patients(spark, ("P1", 1950, "F", "R1", "2026-08-01"), ("P1", 1960, "F", "R2", "2026-08-05")))
    found = silver.fact_diagnostics_as_of(h.diagnostics(spark, ("S1", "C1", "associe"), ("S1", "C1", "principal"), ("S2", "C1", "associe"), ("S3", "C1", "associe")), stays, past)
    assert rows(found, "stay_id", "age_at_diagnostics", "region_code", "diag_type") == [("S1", 76, "R1", "principal"), ("S2", 66, "R2", "associe")]


def test_a_hot_patient_is_reduced_to_days_before_any_window(spark):
    """Every window of the as-of join reads rows that an aggregation by patient and day gave; the facts meet it in a join that can be split."""
    past = silver.dim_patients_history(h.patients(spark, ("P1", 1950, "F", "R1", "2026-08-01")))
    facts = spark.range(100).select(F.lit("P1").alias("patient_pseudo_id"), F.lit(day("2026-08-01")).alias("at"), "id")
    plan = history.as_of(facts, past, "patient_pseudo_id", "at", ["birth_year"])._jdf.queryExecution().optimizedPlan().toString()
    facts_side, days_side = plan.split("Window", 1)
    assert "Aggregate" in days_side and "Aggregate" not in facts_side and "Window" not in facts_side
