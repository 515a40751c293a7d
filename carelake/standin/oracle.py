"""The registered queries as SQL for the correctness check.

Written from the rules, table by table, with plain joins, windows and aggregates: not a rendering of
the Spark plans, which reduce the facts before joining them.
"""

from __future__ import annotations

from carelake.standin import loading, redelivery

SECRET = "carelake-check-only"  # the check needs a known key; real runs take theirs from the settings

# ---- bronze-shaped tables ------------------------------------------------------------------------

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, *needs: str):
    def keep(text: str) -> None:
        _CTES[name] = (needs, text)
    return keep


_cte("sejours")("""
    select 'S' || o_orderkey as stay_id,
           'P' || o_custkey as patient_pseudo_id,
           case when o_orderkey % 26 = 0 then 'URGENCES' else 'NATION_' || (o_orderkey % 26) end as service_code,
           admission as admission_ts,
           case when version = 1 and o_orderstatus = 'P' then null
                when version = 1 then admission + to_hours(cast(o_orderkey * 7 % 241 - 5 as integer))
                else admission + to_hours(cast(o_orderkey * 7 % 241 + 1 as integer)) end as discharge_ts,
           case when o_orderpriority like '1%' or o_orderpriority like '2%' then 'urgence'
                when o_orderpriority like '3%' then 'mutation' else 'programme' end as admission_mode,
           case when version = 1 and o_orderstatus = 'P' then ''
                when o_custkey % 4 = 0 then 'domicile' when o_custkey % 4 = 1 then 'mutation'
                when o_custkey % 4 = 2 then 'transfert' else 'deces' end as discharge_mode,
           delivered as source_date,
           'sejours/' || delivered || '/sejours.csv' as source_file
    from (select *, o_orderdate + to_minutes(cast(o_orderkey * 37 % 1440 as integer)) as admission,
                 cast(o_orderdate as date) + case when version = 1 then 0 else 30 end as delivered
          from orders, (values (1), (2)) as v(version)
          where version = 1 or o_orderkey % 10 = 0)""")

_cte("patients")("""
    select 'P' || o_custkey as patient_pseudo_id,
           cast(case when o_custkey % 37 <> 0 then 1920 + o_custkey % 90 else 0 end as integer) as birth_year,
           case when o_orderkey % 2 = 0 then 'F' else 'M' end as sex,
           'R' || (o_orderkey % 13) as region_code,
           cast(o_orderdate as date) as source_date,
           'patients/' || cast(o_orderdate as date) || '/patients.csv' as source_file
    from orders""")

_cte("diagnostics")("""
    select 'S' || l_orderkey as stay_id, 'C' || (l_partkey % 41) as code_cim10,
           case when l_linenumber in (1, 2) then 'principal' else 'associe' end as diag_type,
           cast(l_shipdate as date) as source_date,
           'diagnostics/' || cast(l_shipdate as date) || '/diagnostics.json' as source_file
    from lineitem where l_quantity >= 10 or l_returnflag <> 'N'
    union all
    select 'S' || l_orderkey, 'C' || (l_suppkey % 41), 'associe', cast(l_shipdate as date),
           'diagnostics/' || cast(l_shipdate as date) || '/diagnostics.json'
    from lineitem where l_quantity >= 10""")

_cte("monitoring")("""
    select 'S' || (user_id * 101) as stay_id, ts,
           case when event_id % 17 <> 0 then cast(floor(value) + 30 as smallint) end as heart_rate,
           case when event_id % 19 <> 0 then cast(100 - event_id % 60 as smallint) end as spo2,
           cast((350 + event_id % 120) / 10.0 as float) as temp_c,
           cast(ts as date) as source_date,
           'monitoring/' || cast(ts as date) || '/monitoring.parquet' as source_file
    from events""")

_cte("actes")("""
    select case when l_linenumber = 7 and l_returnflag = 'R' then 'X' else 'S' end || l_orderkey as stay_id,
           'A' || l_partkey as code_ccam, l_shipdate as acte_ts,
           cast(l_shipdate as date) + copy as source_date,
           'actes/' || (cast(l_shipdate as date) + copy) || '/actes.parquet' as source_file
    from lineitem, (values (0), (1)) as c(copy) where copy = 0 or l_linenumber = 1""")

_cte("ref_services")("""
    select case when n_nationkey = 0 then 'URGENCES' else n_name end as service_code,
           'Service ' || n_name as service_label
    from nation""")

_cte("ref_description_service")("""
    select case when n_nationkey = 0 then 'URGENCES' else n_name end as service_code,
           case when n_nationkey = 5 then '' else r_name end as categorie,
           cast(case when n_nationkey = 7 then 0 else 10 + n_nationkey end as integer) as capacite_lits,
           case when n_nationkey = 9 then '' else 'Pole ' || n_regionkey end as pole
    from nation join region on n_regionkey = r_regionkey where n_nationkey <> 3""")

_cte("ref_cim10")("select 'C' || (p_partkey % 40) as code_cim10, p_name as libelle from part")

_cte("ref_ccam")("""
    select 'A' || p_partkey as code_ccam, p_name as libelle,
           cast(floor(p_retailprice) as integer) as tarif_euros
    from part""")

# ---- silver --------------------------------------------------------------------------------------

_cte("dim_services", "ref_services", "ref_description_service")("""
    select s.service_code, s.service_label,
           coalesce(nullif(d.categorie, ''), 'Non catégorisé') as categorie,
           coalesce(d.capacite_lits, 0) as capacite_lits,
           coalesce(nullif(d.pole, ''), 'Pôle Indéterminé') as pole
    from ref_services s left join ref_description_service d on s.service_code = d.service_code""")

_cte("dim_ccam", "ref_ccam")("""
    select code_ccam, libelle, tarif_euros from ref_ccam
    qualify row_number() over (partition by code_ccam order by libelle desc, tarif_euros desc) = 1""")

_cte("dim_cim10", "ref_cim10")("""
    select code_cim10, max(libelle) as libelle from (select distinct * from ref_cim10) group by code_cim10""")

_cte("dim_patients", "patients")("""
    select patient_pseudo_id, birth_year, sex, region_code, source_date as updated_at from patients
    qualify row_number() over (partition by patient_pseudo_id
        order by source_date desc, source_file desc, birth_year desc, sex desc, region_code desc) = 1""")

_cte("patient_days", "patients")("""
    select patient_pseudo_id, birth_year, sex, region_code, source_date from patients
    qualify row_number() over (partition by patient_pseudo_id, source_date
        order by source_file desc, birth_year desc, sex desc, region_code desc) = 1""")

_cte("fact_sejours", "sejours")("""
    select stay_id, patient_pseudo_id, service_code, admission_ts, discharge_ts, admission_mode, discharge_mode,
           cast(discharge_ts is null as integer) as is_ongoing,
           round_even(date_diff('second', admission_ts, discharge_ts) / 3600.0 * 100, 0) / 100 as duree_sejour_heures,
           round_even(date_diff('second', admission_ts, discharge_ts) / 86400.0 * 100, 0) / 100 as duree_sejour_jours
    from sejours where discharge_ts is null or discharge_ts >= admission_ts
    qualify row_number() over (partition by service_code, admission_ts, stay_id
        order by source_date desc, source_file desc) = 1""")

_cte("stays", "sejours")("""
    select stay_id, patient_pseudo_id, service_code, admission_ts from sejours
    qualify row_number() over (partition by stay_id order by source_date desc, source_file desc) = 1""")

_cte("fact_diagnostics", "diagnostics", "stays", "dim_patients")("""
    select stay_id, patient_pseudo_id, age_at_diagnostics, code_cim10, diag_type
    from (select distinct d.stay_id, s.patient_pseudo_id,
                 cast(case when p.birth_year <> 0
                      then greatest(0, year(s.admission_ts) - p.birth_year) end as integer) as age_at_diagnostics,
                 d.code_cim10, d.diag_type
          from diagnostics d join stays s on d.stay_id = s.stay_id
          join dim_patients p on s.patient_pseudo_id = p.patient_pseudo_id)
    qualify row_number() over (partition by code_cim10, patient_pseudo_id, stay_id
        order by diag_type <> 'principal', diag_type) = 1""")

_cte("fact_monitoring", "monitoring", "stays")("""
    select *, cast(is_alert_fc + is_alert_spo2 + is_alert_temp > 0 as integer) as is_alert,
           case when is_alert_fc = 1 then 'FC_ANORMALE' else '' end || ',' ||
           case when is_alert_spo2 = 1 then 'HYPOXIE' else '' end || ',' ||
           case when is_alert_temp = 1 then 'TEMP_ANORMALE' else '' end as alert_reasons
    from (select m.stay_id, s.service_code, m.ts, m.heart_rate, m.spo2, m.temp_c,
                 case when heart_rate < 50 or heart_rate > 120 then 1 else 0 end as is_alert_fc,
                 case when spo2 < 92 then 1 else 0 end as is_alert_spo2,
                 case when temp_c < 36.0 or temp_c >= 38.5 then 1 else 0 end as is_alert_temp
          from monitoring m join stays s on m.stay_id = s.stay_id
          where (heart_rate is null or heart_rate between 20 and 250)
            and (spo2 is null or spo2 between 50 and 100)
            and (temp_c is null or temp_c between 30.0 and 45.0))""")

_cte("fact_acte", "actes", "fact_sejours", "stays")("""
    select distinct a.stay_id,
           coalesce(nullif(f.service_code, ''), nullif(b.service_code, ''), 'INCONNU') as service_code,
           a.code_ccam, a.acte_ts
    from actes a left join fact_sejours f on a.stay_id = f.stay_id left join stays b on a.stay_id = b.stay_id""")

# ---- gold ----------------------------------------------------------------------------------------


def _pct(part: str, whole: str) -> str:
    return f"round_even(100.0 * {part} / nullif({whole}, 0) * 100, 0) / 100"


def _dms(where: str = "") -> str:
    return f"""
    select f.service_code, coalesce(any_value(s.service_label), f.service_code) as service_label,
           count(*) filter (where is_ongoing = 0) as nb_sejours_termines,
           count(*) filter (where is_ongoing = 1) as nb_sejours_en_cours,
           round_even(cast(sum(cast(round_even(duree_sejour_jours * 100, 0) as bigint)) as double)
               / count(duree_sejour_jours), 0) / 100 as dms_jours,
           round_even(median(round_even(duree_sejour_jours * 100, 0)), 0) / 100 as dms_mediane_jours,
           min(duree_sejour_jours) as dms_min_jours, max(duree_sejour_jours) as dms_max_jours
    from fact_sejours f left join dim_services s on f.service_code = s.service_code {where}
    group by f.service_code"""


_cte("dms", "fact_sejours", "dim_services")(_dms())

_PERIOD = "between date '1996-03-15' and date '1998-09-14'"
_cte("dms_period", "fact_sejours", "dim_services")(_dms(f"where cast(admission_ts as date) {_PERIOD}"))

# the stay index has one admission per stay, that of the newest delivery
_cte("diagnosed", "fact_diagnostics", "stays")(f"""
    select d.*, cast(least(100, age_at_diagnostics // 10 * 10) as integer) as band_start
    from fact_diagnostics d join stays s on d.stay_id = s.stay_id where cast(s.admission_ts as date) {_PERIOD}""")

_cte("urgences", "fact_sejours")(f"""
    select cast(admission_ts as date) as date_passage, count(*) as nb_passages_total,
           count(*) filter (where admission_mode = 'urgence') as nb_urgences_directes,
           count(*) filter (where discharge_mode = 'domicile') as nb_sorties_domicile,
           count(*) filter (where discharge_mode = 'mutation') as nb_mutations_internes,
           count(*) filter (where discharge_mode = 'transfert') as nb_transferts_externes,
           count(*) filter (where discharge_mode = 'deces') as nb_deces,
           count(*) filter (where is_ongoing = 1) as nb_patients_en_cours,
           {_pct("count(*) filter (where discharge_mode in ('mutation', 'transfert'))",
                 "count(*) filter (where is_ongoing = 0)")} as taux_hospitalisation_pct
    from fact_sejours where service_code = 'URGENCES' group by 1""")

_cte("readmissions", "fact_sejours")(f"""
    select count(*) as nb_sejours_total,
           count(*) filter (where gap between 1 and 30) as nb_readmissions_30j,
           {_pct("count(*) filter (where gap between 1 and 30)", "count(*)")} as taux_readmission_pct
    from (select date_diff('day', lag(discharge_ts) over (partition by patient_pseudo_id
                     order by admission_ts, discharge_ts), admission_ts) as gap
          from fact_sejours where is_ongoing = 0)""")

_cte("alertes", "fact_monitoring")(f"""
    select cast(ts as date) as jour, count(*) as nb_mesures_totales,
           cast(sum(is_alert) as bigint) as nb_alertes_totales, cast(sum(is_alert_fc) as bigint) as nb_alertes_fc,
           cast(sum(is_alert_spo2) as bigint) as nb_alertes_spo2,
           cast(sum(is_alert_temp) as bigint) as nb_alertes_temp,
           {_pct("cast(sum(is_alert) as bigint)", "count(*)")} as taux_alertes_pct
    from fact_monitoring group by 1""")

_cte("delivered", "fact_monitoring")("""
    select f.*, unnest(case when epoch(date_trunc('second', ts)) % 10 = 0 then [eighth + 1]
                            when epoch(date_trunc('second', ts)) % 7 = 1 then [eighth, eighth + 1] else [eighth] end) as delivery
    from (select *, least(3, (cast(ts as date) - date '2024-01-01') // 8) as eighth from fact_monitoring) f""")

_cte("flagged", "delivered")("""
    select d.*, coalesce(ts <= (select max(ts) from delivered b where b.delivery < d.delivery) - to_days(3), false) as late
    from delivered d""")

_cte("alert_windows", "flagged")(f"""
    select coalesce(c.debut, l.debut) as debut, coalesce(c.debut, l.debut) + to_days(2) as fin,
           coalesce(nb_mesures_totales, 0) as nb_mesures_totales, coalesce(nb_alertes_totales, 0) as nb_alertes_totales,
           coalesce(nb_alertes_fc, 0) as nb_alertes_fc, coalesce(nb_alertes_spo2, 0) as nb_alertes_spo2,
           coalesce(nb_alertes_temp, 0) as nb_alertes_temp, coalesce(nb_tardives, 0) as nb_tardives,
           {_pct("nb_alertes_totales", "nb_mesures_totales")} as taux_alertes_pct
    from (select debut, count(*) as nb_mesures_totales, count(*) filter (where is_alert = 1) as nb_alertes_totales,
                 count(*) filter (where is_alert_fc = 1) as nb_alertes_fc, count(*) filter (where is_alert_spo2 = 1) as nb_alertes_spo2,
                 count(*) filter (where is_alert_temp = 1) as nb_alertes_temp
          from (select distinct stay_id, ts, heart_rate, spo2, temp_c, is_alert, is_alert_fc, is_alert_spo2, is_alert_temp,
                       date_trunc('day', ts) - to_days(cast(back as integer)) as debut
                from flagged, (values (0), (1)) as w(back) where not late)
          where debut + to_days(2) <= (select max(ts) from delivered) - to_days(3) group by debut) c
    full join (select date_trunc('day', ts) - to_days(cast(back as integer)) as debut, count(*) as nb_tardives
               from flagged, (values (0), (1)) as w(back) where late group by 1) l on c.debut = l.debut""")

_cte("prevalence", "fact_diagnostics", "dim_cim10")("""
    select d.code_cim10, coalesce(any_value(r.libelle), d.code_cim10) as libelle_pathologie,
           count(distinct patient_pseudo_id) as nb_patients_uniques, count(*) as nb_diagnostics_total,
           count(*) filter (where diag_type = 'principal') as nb_diagnostic_principal,
           count(*) filter (where diag_type = 'associe') as nb_diagnostic_associe
    from fact_diagnostics d left join dim_cim10 r on d.code_cim10 = r.code_cim10 group by d.code_cim10""")

_cte("cohortes", "fact_diagnostics", "dim_patients", "dim_cim10")("""
    select d.code_cim10, coalesce(any_value(r.libelle), d.code_cim10) as libelle_pathologie,
           case when age_at_diagnostics is null then 'inconnu'
                when age_at_diagnostics >= 100 then '100+ ans'
                else (age_at_diagnostics // 10 * 10) || '-' || (age_at_diagnostics // 10 * 10 + 9) || ' ans'
           end as tranche_age,
           p.sex, count(distinct d.patient_pseudo_id) as nb_patients
    from fact_diagnostics d join dim_patients p on d.patient_pseudo_id = p.patient_pseudo_id
    left join dim_cim10 r on d.code_cim10 = r.code_cim10 group by d.code_cim10, 3, p.sex""")

_cte("cohort_cells", "fact_diagnostics", "dim_patients")("""
    select code_cim10, age, region_code, sex, count(*) as n
    from (select code_cim10, patient_pseudo_id, min(age_at_diagnostics) as age from fact_diagnostics group by all) d
    join dim_patients p on d.patient_pseudo_id = p.patient_pseudo_id group by all""")

# all 24 nodes of the lattice, each rolled up; the finest that holds
_cte("lattice", "cohort_cells")("""
    select niveau_age, niveau_region_code, niveau_sex, code_cim10,
           case when niveau_age = 5 then '*' when age is null then 'inconnu' when niveau_age = 0 then cast(age as varchar)
                else (age // years * years) || '-' || (age // years * years + years - 1) end as age,
           case when niveau_region_code = 1 then '*' else region_code end as region_code,
           case when niveau_sex = 1 then '*' else sex end as sex, cast(sum(n) as bigint) as nb_patients
    from cohort_cells, (values (0, 1), (1, 5), (2, 10), (3, 20), (4, 40), (5, 0)) as a(niveau_age, years),
         (values (0), (1)) as r(niveau_region_code), (values (0), (1)) as s(niveau_sex)
    where code_cim10 in (select code_cim10 from cohort_cells group by code_cim10 having sum(n) >= 5) group by all""")

_cte("synthese", "fact_diagnostics")("""
    select count(distinct patient_pseudo_id) as nb_patients_total, count(*) as nb_diagnostics_total,
           count(distinct code_cim10) as nb_pathologies_surveillees from fact_diagnostics""")

_cte("categories", "fact_sejours", "dim_services")("""
    select s.categorie, s.pole, count(*) filter (where is_ongoing = 0) as nb_sejours_termines,
           count(*) filter (where is_ongoing = 1) as nb_sejours_en_cours,
           round_even(cast(sum(cast(round_even(duree_sejour_jours * 100, 0) as bigint)) as double)
               / count(duree_sejour_jours), 0) / 100 as dms_jours
    from fact_sejours f join dim_services s on f.service_code = s.service_code group by 1, 2""")

_SERVICE = "s.service_code, s.service_label, s.categorie, s.pole"

_cte("actes_services", "fact_acte", "dim_services")(f"""
    select {_SERVICE}, count(*) as nb_actes_total, count(distinct a.stay_id) as nb_sejours_concernes,
           round_even(count(*) / nullif(count(distinct a.stay_id), 0) * 100, 0) / 100 as moyenne_actes_par_sejour
    from fact_acte a join dim_services s on a.service_code = s.service_code group by all""")

_cte("actes_ccam", "fact_acte", "dim_ccam")("""
    select c.code_ccam, c.libelle as libelle_acte, c.tarif_euros as tarif_unitaire_euros,
           count(*) as nb_actes_total, count(*) * c.tarif_euros as montant_total_euros
    from fact_acte a join dim_ccam c on a.code_ccam = c.code_ccam group by c.code_ccam, c.libelle, c.tarif_euros""")

_cte("densite", "fact_acte", "dim_services")(f"""
    select {_SERVICE}, s.capacite_lits, count(a.stay_id) as nb_actes_total,
           round_even(count(a.stay_id) / nullif(s.capacite_lits, 0) * 100, 0) / 100 as densite_actes_par_lit
    from dim_services s left join fact_acte a on s.service_code = a.service_code group by {_SERVICE}, s.capacite_lits""")

_cte("t2a", "fact_acte", "dim_services", "dim_ccam")(f"""
    select {_SERVICE}, count(*) as nb_actes_total, cast(sum(c.tarif_euros) as bigint) as montant_total_t2a_euros
    from fact_acte a join dim_services s on a.service_code = s.service_code
    join dim_ccam c on a.code_ccam = c.code_ccam group by all""")


def _with(query: str, *needs: str) -> str:
    """The query behind the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in _CTES[name][0]:
            add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} as ({_CTES[name][1]})" for name in ordered)
    return f"with {ctes}\n{query}"


def _from(table: str, columns: str = "*", tail: str = "", *more: str) -> str:
    return _with(f"select {columns} from {table} {tail}", table, *more)


# ---- privacy -------------------------------------------------------------------------------------


def _hmac(text: str) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in key).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


_STRIPPED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_PATIENT_ID = "' IPP' || c_custkey || chr(9)"
_BIRTH = """case when c_custkey % 7 = 0 then null when c_custkey % 5 = 0 then '1950-04-12'
    when c_custkey % 5 = 1 then ' 1985-11-30' when c_custkey % 5 = 2 then '85-04-12'
    when c_custkey % 5 = 3 then '' else '2001' end"""
_YEAR = f"""case when regexp_matches(trim({_BIRTH}), '^[0-9]{{4}}(-|$)')
    then cast(left(trim({_BIRTH}), 4) as integer) end"""
_PSEUDONYM = f"'PSEUDO_' || left({_hmac(_STRIPPED.format(_PATIENT_ID))}, 16)"

_rate1 = "round_even({} * 10, 0) / 10"
_by_dms = "order by dms_jours desc nulls last, service_code"

SQL: dict[str, str] = {
    # silver
    **{name: _from(name) for name in (
        "dim_services", "dim_ccam", "dim_cim10", "dim_patients", "fact_sejours", "fact_diagnostics",
        "fact_monitoring", "fact_acte")},
    # gold
    "dms_by_service": _from("dms"),
    "dms_period": _from("dms_period"),
    "prevalence_period": _from("diagnosed", """code_cim10, case when age_at_diagnostics is not null then band_start end as band_start,
        count(distinct patient_pseudo_id) as nb_patients""", "group by all"),
    "comorbidity_period": _with("""
        select code_a, code_b, count(distinct a.patient_pseudo_id) filter (where b.patient_pseudo_id is not null) as nb_patients
        from (select distinct 'C' || (p_partkey % 41) as code_a, 'C' || (p_partkey * 7 % 43) as code_b from part)
        left join (select distinct code_cim10, patient_pseudo_id from diagnosed) a on a.code_cim10 = code_a
        left join (select distinct code_cim10, patient_pseudo_id from diagnosed) b
            on b.code_cim10 = code_b and b.patient_pseudo_id = a.patient_pseudo_id
        group by code_a, code_b""", "diagnosed"),
    "emergency_daily": _from("urgences"),
    "readmission_30d": _from("readmissions"),
    "readmission_stream": _from("readmissions"),
    "alerts_daily": _from("alertes"),
    "alerts_daily_written": _from("alertes"),
    "alerts_stream": _from("alert_windows"),
    "prevalence": _from("prevalence"),
    "cohorts": _from("cohortes"),
    "cohorts_suppressed": _from("cohortes", "*", "where nb_patients >= 5"),
    "cohorts_generalised": _with("""
        select l.* from lattice l join (
            select niveau_age, niveau_region_code, niveau_sex from lattice
            group by niveau_age, niveau_region_code, niveau_sex having min(nb_patients) >= 5
            order by niveau_age + 5 * niveau_region_code + 5 * niveau_sex, niveau_age, niveau_region_code, niveau_sex limit 1) f
        using (niveau_age, niveau_region_code, niveau_sex)""", "lattice"),
    "research_summary": _from("synthese"),
    "activity_by_category": _from("categories"),
    "procedures_by_service": _from("actes_services"),
    "procedures_by_code": _from("actes_ccam"),
    "procedures_per_bed": _from("densite"),
    "billing_by_service": _from("t2a"),
    # privacy and ingestion
    "pseudonymize": f"select c_custkey, {_PSEUDONYM} as patient_pseudo_id from customer",
    "birth_year": f"select c_custkey, coalesce({_YEAR}, 0) as birth_year from customer",
    "identifier_purge": f"""
        select {_PSEUDONYM} as patient_pseudo_id, coalesce(cast({_YEAR} as varchar), '') as birth_year,
               case when c_custkey % 3 = 0 then 'F' else 'M' end as sex, 'R' || c_nationkey as region_code
        from customer""",
    "stay_pseudonyms": f"""
        select 'S' || o_orderkey as stay_id,
               'PSEUDO_' || left({_hmac("'IPP' || o_custkey")}, 16) as patient_pseudo_id, o_orderpriority as admission_mode
        from orders""",
    "flatten_diagnostics": _from("diagnostics", "stay_id, code_cim10, diag_type, source_date, source_file"),
    "source_dates": _with(
        """select distinct source_date from (select source_date from sejours union all
           select source_date from patients union all select source_date from diagnostics union all
           select source_date from monitoring union all select source_date from actes)""",
        "sejours", "patients", "diagnostics", "monitoring", "actes"),
    "ingest_idempotent": _from("sejours"),
    "ingest_stream": _from("monitoring"),
    "ref_snapshot_replace": """
        select 'A' || p_partkey as code_ccam, p_name as libelle, cast(floor(p_retailprice) as integer) as tarif_euros,
               date '2026-08-01' + p_size as source_date,
               'referentiels/' || (date '2026-08-01' + p_size) || '/ccam.csv' as source_file
        from part where p_size = (select max(p_size) from part)""",
    "lake_dates_to_process": """
        with attempts as (
            select cast(l_shipdate as date) as source_date, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   l_linestatus = 'F' as success from lineitem),
        last as (
            select source_date, success from attempts
            qualify row_number() over (partition by source_date
                order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, success desc) = 1)
        select distinct cast(o_orderdate as date) as source_date from orders
        where cast(o_orderdate as date) not in (select source_date from last where success)""",
    "dim_patients_history": _with("""
        select patient_pseudo_id, birth_year, sex, region_code, source_date as valid_from,
               lead(source_date) over (partition by patient_pseudo_id order by source_date) as valid_to
        from (select *, lag((birth_year, sex, region_code)) over w as before
              from patient_days window w as (partition by patient_pseudo_id order by source_date))
        where before is distinct from (birth_year, sex, region_code)""", "patient_days"),
    "diagnostics_as_of": _with("""
        select stay_id, patient_pseudo_id, age_at_diagnostics, region_code, code_cim10, diag_type
        from (select distinct d.stay_id, s.patient_pseudo_id, d.code_cim10, d.diag_type, p.region_code,
                     cast(case when p.born <> 0 then greatest(0, year(s.admission_ts) - p.born) end as integer) as age_at_diagnostics
              from diagnostics d join stays s on d.stay_id = s.stay_id
              join (select *, birth_year + case when sex = 'M' then 5 else 0 end as born from patient_days) p
                on s.patient_pseudo_id = p.patient_pseudo_id
              where p.source_date = (
                  select coalesce(max(o.source_date) filter (o.source_date <= cast(s.admission_ts as date)), min(o.source_date))
                  from patient_days o where o.patient_pseudo_id = s.patient_pseudo_id))
        qualify row_number() over (partition by code_cim10, patient_pseudo_id, stay_id
            order by diag_type <> 'principal', diag_type) = 1""", "diagnostics", "stays", "patient_days"),
    **loading.SQL,
    **redelivery.SQL,
    # quality and audit
    "rejects_by_reason": _with("""
        select 'patients' as table_name, 'latest' as reason, count(distinct patient_pseudo_id) as nb_rows from patients
        union all
        select 'patients', 'merged_duplicate', count(*) - count(distinct patient_pseudo_id) from patients
        union all
        select 'sejours', case when discharge_ts < admission_ts then 'discharge_before_admission'
                               when discharge_ts is null then 'ongoing' else 'finished' end,
               count(*) from sejours group by 2
        union all
        select 'monitoring',
               case when heart_rate not between 20 and 250 then 'heart_rate_out_of_range'
                    when spo2 not between 50 and 100 then 'spo2_out_of_range'
                    when temp_c not between 30.0 and 45.0 then 'temp_c_out_of_range'
                    when stay_id not in (select stay_id from stays) then 'unknown_stay'
                    when heart_rate < 50 or heart_rate > 120 or spo2 < 92 or temp_c < 36.0 or temp_c >= 38.5
                    then 'alert' else 'normal' end,
               count(*) from monitoring group by 2""", "patients", "sejours", "monitoring", "stays"),
    "table_counts": _with(
        " union all ".join(
            f"select '{t}' as table_name, count(*) as nb_rows from {t}" for t in (
                "patients", "sejours", "diagnostics", "monitoring", "actes", "ref_services",
                "ref_cim10", "ref_description_service", "ref_ccam")),
        "patients", "sejours", "diagnostics", "monitoring", "actes", "ref_services", "ref_cim10",
        "ref_description_service", "ref_ccam"),
    "run_log": _with("""
        select '2_INGEST_BRONZE' as step_name, 'RUNNING' as status, count(distinct source_file) as nb_files,
               count(*) as records_ingested, cast(0 as bigint) as records_rejected from sejours
        union all
        select '3_TRANSFORM_SILVER', 'RUNNING', count(distinct source_file), (select count(*) from fact_sejours),
               count(*) filter (where discharge_ts < admission_ts) from sejours
        union all
        select 'ALL_STEPS_COMPLETED', 'SUCCESS', count(distinct source_file), (select count(*) from fact_sejours),
               count(*) filter (where discharge_ts < admission_ts) from sejours""", "sejours", "fact_sejours"),
    "age_band": _with("""
        select case when age_at_diagnostics is null then 'inconnu' when age_at_diagnostics < 10 then '0-9 ans'
                    when age_at_diagnostics < 100 then (age_at_diagnostics // 10) || '0-' || (age_at_diagnostics // 10) || '9 ans'
                    else '100+ ans' end as tranche_age, count(*) as nb_diagnostics
        from fact_diagnostics group by 1""", "fact_diagnostics"),
    # reports
    "report_total_urgences": _from("urgences", "cast(sum(nb_passages_total) as bigint) as total_urgences"),
    "report_dms_globale": _from("dms", _rate1.format(
        "(cast(sum(cast(round_even(dms_jours * 100, 0) as bigint) * nb_sejours_termines) as double)"
        " / cast(sum(nb_sejours_termines) as bigint) / 100)") + " as dms_globale"),
    "report_taux_readmission": _from("readmissions", _rate1.format("taux_readmission_pct") + " as taux_readm"),
    "report_taux_alertes": _from("alertes", _rate1.format(
        "(100.0 * cast(sum(nb_alertes_totales) as bigint) / cast(sum(nb_mesures_totales) as bigint))")
        + " as taux_alertes"),
    "report_dms_par_service": _from("dms", "service_label as service, dms_jours", _by_dms),
    "report_detail_services": _from("dms", f"""service_label as service, dms_jours,
        dms_mediane_jours as mediane_jours, {_rate1.format("dms_min_jours")} as min_jours,
        {_rate1.format("dms_max_jours")} as max_jours, nb_sejours_termines as sejours_clotures,
        nb_sejours_en_cours as sejours_en_cours""", _by_dms),
    "report_flux_urgences": _from("urgences", """date_passage, nb_passages_total as total_passages,
        nb_sorties_domicile as sorties_domicile,
        nb_mutations_internes + nb_transferts_externes as hospitalisations, nb_deces as deces"""),
    "report_taux_hospitalisation": _from("urgences", "date_passage, taux_hospitalisation_pct"),
    "report_mesures_conformes": _from(
        "alertes", "jour, nb_mesures_totales - nb_alertes_totales as mesures_conformes, nb_alertes_totales as alertes"),
    "report_alertes_par_type": _from(
        "alertes", "jour, nb_alertes_fc as fc_anormale, nb_alertes_spo2 as hypoxie, nb_alertes_temp as temperature"),
    "report_total_actes": _from("actes_services", "cast(sum(nb_actes_total) as bigint) as total_actes"),
    "report_total_t2a": _from("t2a", "cast(sum(montant_total_t2a_euros) as bigint) as total_t2a"),
    "report_densite_moyenne": _from("densite", _rate1.format(
        "(cast(sum(cast(round_even(densite_actes_par_lit * 100, 0) as bigint)) as double)"
        " / count(densite_actes_par_lit) / 100)") + " as densite_moyenne", "where capacite_lits > 0"),
    "report_palmares_actes": _from("actes_ccam", "libelle_acte as acte, nb_actes_total as nb_actes"),
    "report_t2a_par_service": _from("t2a", "service_label as service, montant_total_t2a_euros as montant_t2a_euros"),
    "report_activite_categories": _from(
        "categories", "categorie, pole, nb_sejours_termines as sejours_clotures, dms_jours"),
    "report_actes_par_lit": _from(
        "densite", "service_label as service, densite_actes_par_lit as actes_par_lit", "where capacite_lits > 0"),
    "report_patients_inclus": _from("synthese", "nb_patients_total as total_patients"),
    "report_diagnostics_poses": _from("synthese", "nb_diagnostics_total as total_diagnostics"),
    "report_pathologies_distinctes": _from("synthese", "nb_pathologies_surveillees as nb_pathologies"),
    "report_prevalence_pathologies": _from("prevalence", """libelle_pathologie as pathologie,
        nb_patients_uniques as patients_uniques, nb_diagnostics_total as diagnostics_totaux"""),
    "report_principal_vs_associe": _from("prevalence", """libelle_pathologie as pathologie,
        nb_diagnostic_principal as diagnostic_principal, nb_diagnostic_associe as diagnostic_associe""",
        "order by nb_diagnostic_principal + nb_diagnostic_associe desc, code_cim10 limit 8"),
    "report_demographie": _from("cohortes", """tranche_age,
        cast(coalesce(sum(nb_patients) filter (where sex = 'F'), 0) as bigint) as femmes,
        cast(coalesce(sum(nb_patients) filter (where sex = 'M'), 0) as bigint) as hommes""", "group by 1"),
    "report_cohortes_publiables": _from("cohortes", """libelle_pathologie as pathologie, tranche_age,
        sex as sexe, nb_patients as patients_inclus""", "where nb_patients >= 5"),
    # previews
    "report_apercu_dms": _from(
        "dms", "service_code, service_label, nb_sejours_termines, nb_sejours_en_cours, dms_jours", _by_dms),
    "report_apercu_urgences": _from("urgences", """date_passage, nb_passages_total, nb_sorties_domicile,
        nb_mutations_internes, nb_deces, taux_hospitalisation_pct"""),
    "report_apercu_readmissions": _from("readmissions"),
    "report_apercu_categories": _from("categories", "categorie, pole, nb_sejours_termines, dms_jours"),
    "alerts_rate_by_day": _from("alertes", f"""jour, cast(sum(nb_mesures_totales) as bigint) as nb_mesures,
        cast(sum(nb_alertes_totales) as bigint) as nb_alertes,
        {_pct("cast(sum(nb_alertes_totales) as bigint)", "cast(sum(nb_mesures_totales) as bigint)")}
        as taux_alertes_pct""", "group by jour"),
    "report_apercu_prevalence": _from(
        "prevalence", "code_cim10, libelle_pathologie, nb_patients_uniques, nb_diagnostics_total",
        "order by nb_patients_uniques desc, code_cim10 limit 5"),
    "report_apercu_cohortes": _from("cohortes", "*", """order by code_cim10,
        try_cast(regexp_extract(tranche_age, '^[0-9]+') as integer) nulls last, sex limit 6"""),
    "report_apercu_actes_services": _from(
        "actes_services", "service_label, nb_actes_total, nb_sejours_concernes, moyenne_actes_par_sejour",
        "order by nb_actes_total desc, service_code limit 5"),
    "report_apercu_actes_ccam": _from(
        "actes_ccam", "libelle_acte, nb_actes_total, tarif_unitaire_euros, montant_total_euros",
        "order by nb_actes_total desc, code_ccam limit 5"),
    "report_apercu_densite": _from(
        "densite", "service_label, capacite_lits, nb_actes_total, densite_actes_par_lit",
        "where capacite_lits > 0 order by densite_actes_par_lit desc nulls last, service_code limit 5"),
    "report_apercu_t2a": _from(
        "t2a", "service_label, nb_actes_total, montant_total_t2a_euros",
        "order by montant_total_t2a_euros desc, service_code limit 5"),
}
