"""Dimension and fact builders as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.functions.fixed_values import MONTHS, WEEKDAYS
from klinark.operators.privacy import build_mapping
from klinark.plans import dimensions, facts
from klinark.plans.registry.base import query
from klinark.plans.registry.quality import death_fact, numbered_stays, stay_fact, survey_fact, visit_fact
from klinark.plans.registry.views import oracle, pseudonym_sql
from klinark.plans.standins import (
    MASTER, SEED, VISIT_KEY, YEAR, departments, patients, professionals, sites, specialties, stays,
    surveys, table,
)


def _names(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query("dim_time", f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(day(d) AS INTEGER) AS jour,
       CAST(month(d) AS INTEGER) AS mois, {_names(MONTHS)}[month(d)] AS libelle_mois,
       CAST(quarter(d) AS INTEGER) AS trimestre, CAST(year(d) AS INTEGER) AS annee,
       {_names(WEEKDAYS)}[isodow(d)] AS jour_semaine
FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
             date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)""")
def dim_time(spark, folder):
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date"))
    return dimensions.calendar(dimensions.calendar_bounds(days))


@query("dim_geography", oracle("v_geo", """
SELECT geo_id, code_region, region, CAST(NULL AS VARCHAR) AS code_departement, CAST(NULL AS VARCHAR) AS departement
FROM v_geo"""))
def dim_geography(spark, folder):
    return dimensions.geography(departments(spark, folder))


def establishment_dim(spark, folder):
    surveyed = surveys(spark, folder).select(
        F.col("finess_geo").alias("etab_id"), F.col("rs_finess_geo").alias("nom_etab"), "region")
    admitting = stays(spark, folder).select(F.col("identifiant_organisation").alias("etab_id"))
    return dimensions.establishment(surveyed, admitting, dimensions.geography(departments(spark, folder)))


@query("dim_establishment", oracle("v_site_geo v_stay", """
SELECT etab_id, min(nom) AS nom_etab, CAST(NULL AS VARCHAR) AS type_etab, coalesce(min(region), 'INCONNU') AS region,
       CAST(NULL AS VARCHAR) AS departement
FROM (SELECT site AS etab_id, nom, region FROM v_site_geo WHERE trim(site) <> ''
      UNION ALL SELECT id_site, NULL, NULL FROM v_stay WHERE id_site IS NOT NULL
      UNION ALL SELECT 'INCONNU', 'INCONNU', 'INCONNU') GROUP BY etab_id"""))
def dim_establishment(spark, folder):
    return establishment_dim(spark, folder)


@query("dim_diagnosis", oracle("v_stay_ok v_visit_ok", """
SELECT diag_id, diag_id AS code_cim10, CAST(NULL AS VARCHAR) AS libelle,
       CASE WHEN diag_id = 'UNKNOWN' THEN '?' ELSE upper(substr(diag_id, 1, 1)) END AS chapitre_cim10
FROM (SELECT diag_id FROM v_visit_ok UNION SELECT diag_id FROM v_stay_ok)"""))
def dim_diagnosis(spark, folder):
    return dimensions.diagnosis(visit_fact(spark, folder), stay_fact(spark, folder))


@query("dim_diagnosis_mean_stay", oracle("v_stay_ok", """
SELECT diag_id, round(CAST(sum(jours) AS DOUBLE) / count(jours), 6) AS dms_moyen FROM v_stay_ok GROUP BY 1"""))
def dim_diagnosis_mean_stay(spark, folder):
    stay = stay_fact(spark, folder)
    return (dimensions.mean_stay_by_diagnosis(dimensions.diagnosis(stay), stay)
            .select("diag_id", F.round("dms_moyen", 6).alias("dms_moyen")))


@query("dim_patient", oracle("v_patient", f"""
SELECT {pseudonym_sql('id_patient')} AS patient_id, sexe, tranche_age, region_residence FROM v_patient"""))
def dim_patient(spark, folder):
    known = patients(spark, folder)
    return dimensions.patient(known, build_mapping(known, "id_patient", MASTER, SEED))


@query("dim_professional", """
SELECT CAST(s_suppkey AS VARCHAR) AS prof_id, n_name AS specialite,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Médecin' ELSE 'Infirmier' END AS categorie_prof,
       CAST(s_nationkey AS VARCHAR) AS code_specialite
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""")
def dim_professional(spark, folder):
    return dimensions.professional(professionals(spark, folder), specialties(spark, folder))


@query("fact_consultation", oracle("v_visit_ok", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS consultation_key, date_id, patient_id, prof_id, diag_id,
       CAST(1 AS INTEGER) AS nb_consultation, CAST(CASE WHEN duree_valide THEN minutes END AS DOUBLE) AS duree_minutes,
       CAST(annee AS INTEGER) AS annee FROM v_visit_ok"""))
def fact_consultation(spark, folder):
    return facts.number_consultations(visit_fact(spark, folder), VISIT_KEY)


@query("fact_hospitalisation", oracle("v_stay_ok", """
SELECT row_number() OVER (ORDER BY entree, id_site, num_stay, patient_id, date_entree) AS hosp_key, date_id, patient_id,
       id_site AS etab_id, diag_id, CAST(1 AS INTEGER) AS nb_hospitalisation, jours AS duree_sejour,
       CAST(annee AS INTEGER) AS annee FROM v_stay_ok"""))
def fact_hospitalisation(spark, folder):
    return numbered_stays(spark, folder)


@query("fact_satisfaction", oracle("v_survey_ok", f"""
SELECT row_number() OVER (ORDER BY site) AS satisfaction_key, CAST({YEAR}0101 AS INTEGER) AS date_id, site AS etab_id,
       geo_id, CAST(note AS DOUBLE) AS note_satisfaction, CAST({YEAR} AS INTEGER) AS annee FROM v_survey_ok"""))
def fact_satisfaction(spark, folder):
    return (facts.number_surveys(survey_fact(spark, folder))
            .withColumn("note_satisfaction", F.col("note_satisfaction").cast("double")))


@query("fact_deaths", oracle("v_death_ok", """
SELECT row_number() OVER (ORDER BY date_deces, lieu, acte) AS deces_key, date_id, geo_id, sx AS sexe, tranche_age,
       CAST(1 AS INTEGER) AS nb_deces, CAST(annee AS INTEGER) AS annee FROM v_death_ok"""))
def fact_deaths(spark, folder):
    return facts.number_deaths(death_fact(spark, folder))
