from __future__ import annotations

import hashlib
import hmac
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.functions import clinical, numeric, privacy
from carelake.sources import drops


def expected_pseudonym(raw, secret):
    if not raw:
        return ""
    digest = hmac.new(secret.encode(), raw.strip().encode(), hashlib.sha256).hexdigest()
    return "PSEUDO_" + digest[:16]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.select("i", expression.alias("y")).orderBy("i").select("y").collect()]


# ---- numeric -------------------------------------------------------------------------------------


def test_round_even_keeps_exact_halves_even(spark):
    values = [0.125, 0.375, 2.5 / 100, 0.285, 1.005, 7.0, 0.0, 12.96]
    got = evaluate(column(spark, values, "double"), numeric.round_even(F.col("x")))
    assert got == [float(np.rint(v * 100) / 100) for v in values]
    assert got[:2] == [0.12, 0.38]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 4)], "i int, x int")
    got = [r[0] for r in df.select(numeric.ratio(F.col("i"), F.col("x"))).collect()]
    assert got == [None, None, 0.25]


def test_percent(spark):
    df = spark.createDataFrame([(637, 6046), (1, 0)], "i int, x int")
    got = [r[0] for r in df.select(numeric.percent(F.col("i"), F.col("x"))).collect()]
    assert got == [10.54, None]


# ---- privacy -------------------------------------------------------------------------------------

IDS = ["IPP0000016", "  IPP1 ", "\tIPP1\n", " IPP1 ", "   ", "", None, "Ünï-é", "IPP 1", "\x1cIPP1\x1f"]


@pytest.mark.parametrize("secret", ["short", "é" * 10, "x" * 64, "x" * 65, "long" * 50])
def test_pseudonym_is_hmac(spark, secret):
    got = evaluate(column(spark, IDS), privacy.pseudonymize(F.col("x"), privacy.pseudonym_key(spark, secret)))
    assert got == [expected_pseudonym(v, secret) for v in IDS]


def test_blank_id_is_hashed_and_empty_is_not(spark):
    blank, empty, missing = evaluate(
        column(spark, ["  ", "", None]), privacy.pseudonymize(F.col("x"), privacy.pseudonym_key(spark, "k")))
    assert blank == expected_pseudonym("  ", "k") != ""
    assert (empty, missing) == ("", "")


def test_pseudonyms_are_stable_and_distinct(spark):
    ids = [f"IPP{n:07d}" for n in range(5000)]
    df = column(spark, ids + ids)
    got = evaluate(df, privacy.pseudonymize(F.col("x"), privacy.pseudonym_key(spark, "k")))
    assert got[:5000] == got[5000:]
    assert len(set(got)) == 5000


def test_pseudonyms_can_be_wider(spark):
    key = privacy.pseudonym_key(spark, "k")
    (got,) = evaluate(column(spark, ["IPP1"]), privacy.pseudonymize(F.col("x"), key, 40))
    assert len(got) == len("PSEUDO_") + 40 and got.startswith(expected_pseudonym("IPP1", "k"))


def test_pseudonym_needs_a_secret(spark):
    with pytest.raises(ValueError):
        privacy.pseudonym_key(spark, "")


def test_plans_do_not_show_the_key(spark, settings, capsys):
    settings(redaction__string__regex="nothing to mask")
    secret = "very secret indeed"
    blocks = [b.hex() for b in privacy._key_blocks(secret)]
    df = column(spark, ["a"]).select(
        privacy.pseudonymize(F.col("x"), privacy.pseudonym_key(spark, secret)).alias("p")).distinct()
    for run in (False, True):
        if run:
            df.collect()
        for mode in ("simple", "extended", "formatted", "codegen"):
            df.explain(mode=mode)
            shown = capsys.readouterr().out.lower()
            assert "subquery" in shown or mode == "codegen"
            assert not any(b[:40] in shown for b in blocks), mode


@hypothesis_settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\0"), max_size=12), min_size=1, max_size=20))
def test_pseudonym_of_any_text(spark, ids):
    got = evaluate(column(spark, ids), privacy.pseudonymize(F.col("x"), privacy.pseudonym_key(spark, "k")))
    assert got == [expected_pseudonym(v, "k") for v in ids]


def test_birth_year(spark):
    values = ["1985-04-12", "1985", " 1990-01-01 ", "85-04-12", "", None, "19855-01", "abcd-01", "12/04/1985"]
    got = evaluate(column(spark, values), privacy.birth_year(F.col("x")))
    assert got == [1985, 1985, 1990, None, None, None, None, None, None]


# ---- clinical ------------------------------------------------------------------------------------


def test_age_bands(spark):
    ages = [0, 9, 10, 19, 20, 89, 90, 99, 100, 131, None]
    got = evaluate(column(spark, ages, "int"), clinical.age_band(F.col("x")))
    assert got == [
        "0-9 ans", "0-9 ans", "10-19 ans", "10-19 ans", "20-29 ans", "80-89 ans", "90-99 ans", "90-99 ans",
        "100+ ans", "100+ ans", "inconnu"]
    starts = evaluate(column(spark, ages, "int"), clinical.age_band_start(F.col("x")))
    assert starts == [0, 0, 10, 10, 20, 80, 90, 90, 100, 100, None]


def test_age(spark):
    df = spark.createDataFrame(
        [("2026-08-01", 1986), ("2026-01-01", 2030), ("2026-01-01", 0), ("2026-01-01", None)], "d string, y int")
    got = [r[0] for r in df.select(clinical.age_at(F.to_timestamp("d"), F.col("y"))).collect()]
    assert got == [40, 0, None, None]


def test_length_of_stay(spark):
    df = spark.createDataFrame(
        [("2026-08-01 00:00:00", "2026-08-01 03:00:00"), ("2026-08-01 00:00:00", "2026-08-01 00:00:00"),
         ("2026-08-01 00:00:00", None), ("2026-08-01 06:23:00", "2026-08-07 13:23:00")], "a string, b string")
    a, b = F.to_timestamp("a"), F.to_timestamp("b")
    got = [tuple(r) for r in df.select(
        clinical.length_of_stay(a, b, 3600), clinical.length_of_stay(a, b, 86400),
        clinical.ongoing_flag(b)).collect()]
    assert got == [(3.0, 0.12, 0), (0.0, 0.0, 0), (None, None, 1), (151.0, 6.29, 0)]


VITALS = [
    # heart rate, spo2, temperature, plausible, flags (any, fc, spo2, temp), reasons, compact reasons
    (70, 98, 37.0, True, (0, 0, 0, 0), ",,", ""),
    (None, None, None, True, (0, 0, 0, 0), ",,", ""),
    (50, 92, 36.0, True, (0, 0, 0, 0), ",,", ""),
    (49, 92, 36.0, True, (1, 1, 0, 0), "FC_ANORMALE,,", "FC_ANORMALE"),
    (120, 91, 38.4, True, (1, 0, 1, 0), ",HYPOXIE,", "HYPOXIE"),
    (121, None, 38.5, True, (1, 1, 0, 1), "FC_ANORMALE,,TEMP_ANORMALE", "FC_ANORMALE,TEMP_ANORMALE"),
    (None, 91, 35.9, True, (1, 0, 1, 1), ",HYPOXIE,TEMP_ANORMALE", "HYPOXIE,TEMP_ANORMALE"),
    (20, 50, 30.0, True, (1, 1, 1, 1), "FC_ANORMALE,HYPOXIE,TEMP_ANORMALE", "FC_ANORMALE,HYPOXIE,TEMP_ANORMALE"),
    (250, 100, 45.0, True, (1, 1, 0, 1), "FC_ANORMALE,,TEMP_ANORMALE", "FC_ANORMALE,TEMP_ANORMALE"),
    (19, 98, 37.0, False, None, None, None),
    (251, 98, 37.0, False, None, None, None),
    (70, 49, 37.0, False, None, None, None),
    (70, 101, 37.0, False, None, None, None),
    (70, 98, 29.9, False, None, None, None),
    (70, 98, 45.1, False, None, None, None),
]


def test_vital_rules(spark):
    df = spark.createDataFrame(
        [(i, *v[:3]) for i, v in enumerate(VITALS)], "i int, heart_rate short, spo2 short, temp_c float")
    got = df.select(
        "i", clinical.vitals_plausible().alias("ok"), *clinical.alert_flags(),
        clinical.alert_reasons().alias("reasons"), clinical.alert_reasons(compact=True).alias("compact"),
    ).orderBy("i").collect()
    for row, (_, _, _, plausible, flags, reasons, compact) in zip(got, VITALS, strict=True):
        assert row.ok is plausible
        if plausible:
            assert tuple(row)[2:6] == flags
            assert (row.reasons, row.compact) == (reasons, compact)


# ---- cost a row ----------------------------------------------------------------------------------


def test_strip_looks_at_the_ends_alone(spark, capsys):
    """All that Python strips, and nothing else, without a regular expression over the text."""
    points = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    values = [*(f"{c}a{c}b{c}" for c in points), "", "  ", " \u3000\x1f", "a b", None]
    stripped = column(spark, values).select("i", privacy.strip(F.col("x")).alias("y"))
    assert [r.y for r in stripped.orderBy("i").collect()] == [v if v is None else v.strip() for v in values]
    stripped.explain()
    assert "regexp" not in capsys.readouterr().out


def test_lineage_looks_for_the_pattern_once(spark, capsys):
    paths = ["file:/d/sejours/2026-08-01/sejours.csv", "s3a://b/sejours/2020-01-01/x/patients/2026-08-02/patients.csv/part-0.csv",
             "/d/sejours/2026-13-01/sejours.csv", "/d/other/2026-08-01/sejours.csv", "/d/sejours/2026-08-01"]
    found = column(spark, paths).select("i", *drops.lineage(F.col("x")))
    assert [(str(r.source_date), r.source_file) for r in found.orderBy("i").collect()] == [
        ("2026-08-01", "sejours/2026-08-01/sejours.csv"), ("2026-08-02", "patients/2026-08-02/patients.csv"),
        ("None", "sejours/2026-13-01/sejours.csv"), ("None", "//"), ("None", "//")]
    found.select("source_file").explain()
    assert set(re.findall(r"regexp_extract\(.*?, (\d)\)", capsys.readouterr().out)) == {"1"}  # one expression, which Spark computes once a row
