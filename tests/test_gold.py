from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from statistics import median

import helpers as h
from helpers import day, rows

from carelake.operators.suppression import suppress_small_cells
from carelake.plans import gold, reports, silver


def stay_tables(spark, *stays, services=(("A", "Alpha"), ("B", "Beta")), details=()):
    bronze = h.sejours(spark, *stays)
    return {
        "fact_sejours": silver.fact_sejours(bronze),
        "dim_services": silver.dim_services(h.ref_services(spark, *services), h.ref_description(spark, *details)),
    }


def acte_tables(spark, procedures, services, details, codes):
    stays = silver.stay_index(h.sejours(spark, *(
        (stay, "p", service, "2026-08-01", None) for stay, service in sorted({(s, v) for s, v, _, _ in procedures if v}))))
    return {
        "fact_acte": silver.fact_acte(h.actes(spark, *((s, c, t) for s, _, c, t in procedures)), stays),
        "dim_services": silver.dim_services(h.ref_services(spark, *services), h.ref_description(spark, *details)),
        "dim_ccam": silver.dim_ccam(h.ref_ccam(spark, *codes)),
    }


# ---- length of stay ------------------------------------------------------------------------------


def test_dms(spark):
    tables = stay_tables(
        spark,
        ("s1", "p", "A", "2026-08-01", "2026-08-02"), ("s2", "p", "A", "2026-08-01", "2026-08-03"),
        ("s3", "p", "A", "2026-08-01", "2026-08-05"), ("s4", "p", "A", "2026-08-01", "2026-08-06"),
        ("s5", "p", "A", "2026-08-01", None), ("s6", "p", "U", "2026-08-01", None),
        ("s7", "p", "B", "2026-08-01 00:00", "2026-08-01 09:00"))
    got = [tuple(r) for r in gold.dms(tables).collect()]
    assert got == [
        ("A", "Alpha", 4, 1, 3.0, 3.0, 1.0, 5.0), ("B", "Beta", 1, 0, 0.38, 0.38, 0.38, 0.38),
        ("U", "U", 0, 1, None, None, None, None)]


def test_dms_against_plain_python(spark):
    random.seed(7)
    stays, lengths = [], defaultdict(list)
    for n in range(400):
        service, start = random.choice("AAAAB"), datetime(2026, 8, 1) + timedelta(minutes=random.randrange(9999))
        end = start + timedelta(minutes=random.randrange(20000))
        stays.append((f"s{n}", "p", service, str(start), str(end)))
        lengths[service].append(round((end - start).total_seconds() / 86400.0, 2))
    got = {r.service_code: r for r in gold.dms(stay_tables(spark, *stays)).collect()}
    for service, values in lengths.items():
        row = got[service]
        assert row.nb_sejours_termines == len(values)
        assert abs(row.dms_jours - sum(values) / len(values)) < 0.0051
        assert abs(row.dms_mediane_jours - median(values)) < 0.0051
        assert (row.dms_min_jours, row.dms_max_jours) == (min(values), max(values))


def test_categories(spark):
    tables = stay_tables(
        spark, ("s1", "p", "A", "2026-08-01", "2026-08-02"), ("s2", "p", "B", "2026-08-01", "2026-08-04"),
        ("s3", "p", "B", "2026-08-01", None), ("s4", "p", "C", "2026-08-01", "2026-08-02"),
        ("s5", "p", "UNKNOWN", "2026-08-01", "2026-08-02"),
        services=(("A", "a"), ("B", "b"), ("C", "c")), details=(("A", "med", 1, "P"), ("B", "med", 2, "P")))
    got = [tuple(r) for r in gold.categories(tables).collect()]
    assert got == [("med", "P", 2, 1, 2.0), ("Non catégorisé", "Pôle Indéterminé", 1, 0, 1.0)]


# ---- emergencies ---------------------------------------------------------------------------------


def test_urgences(spark):
    tables = stay_tables(
        spark,
        ("s1", "p", "URGENCES", "2026-08-01 01:00", "2026-08-01 05:00", "urgence", "domicile"),
        ("s2", "p", "URGENCES", "2026-08-01 23:59", "2026-08-02 05:00", "programme", "mutation"),
        ("s3", "p", "URGENCES", "2026-08-01 12:00", "2026-08-03", "urgence", "transfert"),
        ("s4", "p", "URGENCES", "2026-08-01 12:00", None, "urgence", ""),
        ("s5", "p", "URGENCES", "2026-08-02 00:00", None, "urgence", ""),
        ("s6", "p", "A", "2026-08-01 12:00", "2026-08-03", "urgence", "deces"))
    assert [tuple(r) for r in gold.urgences(tables).collect()] == [
        (day("2026-08-01"), 4, 3, 1, 1, 1, 0, 1, 66.67), (day("2026-08-02"), 1, 1, 0, 0, 0, 0, 1, None)]
    assert rows(reports.report("flux_urgences")(tables), "hospitalisations") == [(0,), (2,)]
    assert reports.report("total_urgences")(tables).first()[0] == 5


# ---- readmissions --------------------------------------------------------------------------------


def readmissions(spark, *stays):
    return tuple(gold.readmissions_30j(stay_tables(spark, *stays)).first())


def test_readmission_gaps(spark):
    def pair(gap_start):
        return readmissions(
            spark, ("s1", "p", "A", "2026-08-01 10:00", "2026-08-03 23:00"), ("s2", "p", "B", gap_start, "2026-12-01"))

    assert pair("2026-08-03 23:30") == (2, 0, 0.0)  # same day
    assert pair("2026-08-04 00:10") == (2, 1, 50.0)  # one calendar day, seventy minutes
    assert pair("2026-09-02 23:59") == (2, 1, 50.0)  # thirty days
    assert pair("2026-09-03 00:00") == (2, 0, 0.0)  # thirty-one
    assert pair("2026-08-02 00:00") == (2, 0, 0.0)  # overlapping


def test_readmission_ignores_other_patients_and_ongoing_stays(spark):
    assert readmissions(
        spark, ("s1", "p", "A", "2026-08-01", "2026-08-03"), ("s2", "q", "A", "2026-08-05", "2026-08-06"),
        ("s3", "p", "A", "2026-08-05", None)) == (2, 0, 0.0)
    assert readmissions(spark, ("s1", "p", "A", "2026-08-01", None)) == (0, 0, None)


def brute_force_readmissions(stays):
    by_patient = defaultdict(list)
    for _, patient, _, start, end, *_ in stays:
        if end is not None and end >= start:
            by_patient[patient].append((datetime.fromisoformat(start), datetime.fromisoformat(end)))
    found = 0
    for spells in by_patient.values():
        spells.sort()
        for (_, before), (start, _) in zip(spells, spells[1:], strict=False):
            found += 1 <= (start.date() - before.date()).days <= 30
    return sum(map(len, by_patient.values())), found


def test_readmissions_against_lag_over_all_stays(spark):
    """The mart works on days; this follows every single stay. One patient owns a third of them."""
    random.seed(11)
    stays = []
    for n in range(900):
        patient = "" if n % 3 == 0 else f"p{random.randrange(60)}"
        start = datetime(2026, 1, 1) + timedelta(hours=random.randrange(24 * 200))
        end = None if random.random() < 0.1 else start + timedelta(hours=random.randrange(-5, 400))
        stays.append((f"s{n}", patient, random.choice("ABC"), str(start), end and str(end)))
    total, found = brute_force_readmissions(stays)
    assert found > 50
    assert readmissions(spark, *stays)[:2] == (total, found)


# ---- vital signs ---------------------------------------------------------------------------------


def test_alertes(spark):
    stays = silver.stay_index(h.sejours(spark, ("s1", "p", "A", "2026-08-01", None)))
    tables = {"fact_monitoring": silver.fact_monitoring(h.monitoring(
        spark, ("s1", "2026-08-01 10:00", 130, 90, 37.0), ("s1", "2026-08-01 11:00", 70, 98, 39.0),
        ("s1", "2026-08-01 12:00", 70, 98, 37.0), ("s1", "2026-08-02 00:00", 70, 98, 37.0)), stays)}
    assert [tuple(r) for r in gold.alertes(tables).collect()] == [
        (day("2026-08-01"), 3, 2, 1, 1, 1, 66.67), (day("2026-08-02"), 1, 0, 0, 0, 0, 0.0)]
    assert reports.report("taux_alertes")(tables).first()[0] == 50.0
    assert rows(reports.report("mesures_conformes")(tables), "mesures_conformes", "alertes") == [(1, 0), (1, 2)]


# ---- research ------------------------------------------------------------------------------------


def research_tables(spark):
    people = [(f"p{n}", 1980 + n % 3, "FM"[n % 2]) for n in range(12)] + [("old", 1900, "F"), ("unk", 0, "M")]
    stays = [(f"s-{p}-{k}", p, "A", "2026-08-01", None) for p, _, _ in people for k in (1, 2)]
    codes = [(s, "I21", "principal") for s, *_ in stays] + [("s-p1-1", "E11", "associe"), ("s-p2-1", "I21", "associe")]
    patients = silver.dim_patients(h.patients(spark, *people))
    return {
        "dim_patients": patients,
        "dim_cim10": silver.dim_cim10(h.ref_cim10(spark, ("I21", "Infarctus"))),
        "fact_diagnostics": silver.fact_diagnostics(
            h.diagnostics(spark, *codes), silver.stay_index(h.sejours(spark, *stays)), patients),
    }


def test_prevalence_and_summary(spark):
    tables = research_tables(spark)
    assert [tuple(r) for r in gold.prevalence(tables).collect()] == [
        ("I21", "Infarctus", 14, 28, 28, 0), ("E11", "E11", 1, 1, 0, 1)]
    assert tuple(gold.synthese(tables).first()) == (14, 29, 2)


def test_cohorts(spark):
    tables = research_tables(spark)
    cells = [tuple(r) for r in gold.cohortes(tables).collect()]
    # p0..p11 are 44 to 46 years old; bands are listed by age, the unknown last
    assert cells == [
        ("E11", "E11", "40-49 ans", "M", 1), ("I21", "Infarctus", "40-49 ans", "F", 6),
        ("I21", "Infarctus", "40-49 ans", "M", 6), ("I21", "Infarctus", "100+ ans", "F", 1),
        ("I21", "Infarctus", "inconnu", "M", 1)]
    shown = suppress_small_cells(gold.cohortes(tables), "nb_patients")
    assert rows(shown, "nb_patients") == [(6,), (6,)]
    assert rows(reports.report("cohortes_publiables")(tables), "sexe", "patients_inclus") == [("F", 6), ("M", 6)]
    assert [tuple(r) for r in reports.report("demographie")(tables).collect()] == [
        ("40-49 ans", 6, 7), ("100+ ans", 1, 0), ("inconnu", 0, 1)]


def test_cell_of_four_is_hidden_and_of_five_shown(spark):
    people = [(f"f{n}", 1980, "F") for n in range(4)] + [(f"m{n}", 1980, "M") for n in range(5)]
    patients = silver.dim_patients(h.patients(spark, *people))
    stays = silver.stay_index(h.sejours(spark, *((f"s{p}", p, "A", "2026-08-01", None) for p, *_ in people)))
    tables = {
        "dim_patients": patients, "dim_cim10": silver.dim_cim10(h.ref_cim10(spark, ("I21", "x"))),
        "fact_diagnostics": silver.fact_diagnostics(
            h.diagnostics(spark, *((f"s{p}", "I21", "principal") for p, *_ in people)), stays, patients)}
    assert rows(reports.report("cohortes_publiables")(tables), "sexe", "patients_inclus") == [("M", 5)]


# ---- procedures ----------------------------------------------------------------------------------


def test_procedure_marts(spark):
    procedures = [
        # stay, service, code, time
        ("s1", "A", "X", "2026-08-02"), ("s1", "A", "X", "2026-08-03"), ("s1", "A", "Y", "2026-08-02"),
        ("s2", "A", "X", "2026-08-02"), ("s3", "B", "Z", "2026-08-02"), ("s3", "B", "X", "2026-08-02"),
        ("s9", None, "X", "2026-08-02")]
    tables = acte_tables(
        spark, procedures, (("A", "Alpha"), ("B", "Beta"), ("C", "Gamma")), (("A", "m", 3, "P"), ("C", "m", 5, "P")),
        (("X", "x-ray", 100), ("Y", "yoga", 10)))
    none = ("Non catégorisé", "Pôle Indéterminé")
    assert [tuple(r) for r in gold.actes_services(tables).collect()] == [
        ("A", "Alpha", "m", "P", 4, 2, 2.0), ("B", "Beta", *none, 2, 1, 2.0)]
    assert [tuple(r) for r in gold.actes_ccam(tables).collect()] == [
        ("X", "x-ray", 100, 5, 500), ("Y", "yoga", 10, 1, 10)]
    assert [tuple(r) for r in gold.densite_plateau(tables).collect()] == [
        ("A", "Alpha", "m", "P", 3, 4, 1.33), ("C", "Gamma", "m", "P", 5, 0, 0.0), ("B", "Beta", *none, 0, 2, None)]
    assert [tuple(r) for r in gold.facturation_t2a(tables).collect()] == [
        ("A", "Alpha", "m", "P", 4, 310), ("B", "Beta", *none, 1, 100)]
    assert reports.report("total_actes")(tables).first()[0] == 6
    assert reports.report("total_t2a")(tables).first()[0] == 410
    assert reports.report("densite_moyenne")(tables).first()[0] == 0.7  # mean of 1.33 and 0 is 0.665


def test_amount_by_code_equals_amount_by_service(spark):
    random.seed(3)
    procedures = [
        (f"s{n % 50}", "ABC"[n % 50 % 3], random.choice("UVWXYZ"), f"2026-08-{random.randrange(1, 28):02d}")
        for n in range(500)]
    tables = acte_tables(
        spark, procedures, [(s, s) for s in "ABC"], (), [(c, c, 10 * i) for i, c in enumerate("UVWXYZ")])
    by_code = gold.actes_ccam(tables).agg({"montant_total_euros": "sum"}).first()[0]
    by_service = gold.facturation_t2a(tables).agg({"montant_total_t2a_euros": "sum"}).first()[0]
    plain = Counter((s, c, t) for s, _, c, t in procedures)
    assert by_code == by_service == sum(10 * "UVWXYZ".index(c) for _, c, _ in plain)


# ---- views and reports ---------------------------------------------------------------------------


def test_views_answer_sql(spark):
    tables = {
        **stay_tables(spark, ("s1", "p", "A", "2026-08-01", "2026-08-02")), **research_tables(spark),
        **acte_tables(spark, [("s1", "A", "X", "2026-08-02")], (("A", "Alpha"),), (), (("X", "x", 1),)),
        "fact_monitoring": silver.fact_monitoring(h.monitoring(spark), silver.stay_index(h.sejours(spark)))}
    gold.register_views(tables)
    assert spark.sql("select sum(nb_sejours_termines) from vue_pilotage_dms").first()[0] == 1
    assert len(gold.VIEWS) == 12
    for name in gold.VIEWS:
        spark.sql(f"select * from {name}").collect()
    # 24 dashboard questions, one re-aggregation, six top-k previews, four plain previews
    assert len(reports.REPORTS) == 24 + 1 + 6 + 4
    for build in reports.REPORTS.values():
        build(tables).collect()
