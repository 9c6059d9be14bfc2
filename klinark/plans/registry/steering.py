"""Steering questions (B2 to B8) and dashboard views as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.functions.bands import band_of_age
from klinark.functions.codes import known_or, sex_code
from klinark.functions.privacy import pseudonym
from klinark.functions.values import decimal_comma
from klinark.operators.joins import event_within, readmission
from klinark.operators.rankings import share_of_total, year_on_year
from klinark.operators.sketches import error_bound, estimates, merge, sketches
from klinark.plans import cubes, kpi
from klinark.plans.dimensions import geography
from klinark.plans.facts import clean_surveys, number_surveys, type_stays, type_surveys
from klinark.plans.registry.base import query
from klinark.plans.registry.cleaning import order_stays
from klinark.plans.registry.quality import death_fact, stay_fact, survey_fact
from klinark.plans.registry.views import oracle, pseudonym_sql
from klinark.plans.registry.warehouse import establishment_dim
from klinark.plans.standins import (
    MASTER, SEED, WIDE_CAMPAIGNS, YEAR, departments, patients, sites, specialties, stays, survey_files, surveys, table, visits,
)
from klinark.session import stage, staging_path
from klinark.sources.surveys import read_surveys, sub_score_rows

# Consultations -----------------------------------------------------------------------------


@query("kpi_total_year", f"""
SELECT count(*) AS nb FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE year(o_orderdate) = {YEAR}""")
def kpi_total_year(spark, folder):
    return kpi.total(visits(spark, folder, with_code=False, year=YEAR), "nb_consultation", YEAR)


@query("kpi_seasonality", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, CAST(month(o_orderdate) AS INTEGER) AS mois, count(*) AS n
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def kpi_seasonality(spark, folder):
    return kpi.seasonality(visits(spark, folder, with_code=False), "jour")


@query("kpi_yearly_overview", oracle("v_line", """
SELECT CAST(annee AS INTEGER) AS annee, count(*) AS total, count(DISTINCT o_custkey) AS patients_distincts,
       count(DISTINCT l_suppkey) AS professionnels_distincts, count(DISTINCT code) AS diagnostics_distincts,
       round(CAST(sum(CASE WHEN duree_valide THEN minutes END) AS DOUBLE)
             / count(CASE WHEN duree_valide THEN 1 END), 1) AS duree_moyenne_min FROM v_line GROUP BY 1"""))
def kpi_yearly_overview(spark, folder):
    return kpi.yearly_overview(visits(spark, folder), {
        "patients_distincts": "id_patient", "professionnels_distincts": "id_prof_sante",
        "diagnostics_distincts": "code_diag"}, "duree_minutes")


@query("kpi_distinct_sketches", oracle("v_line", """
SELECT CAST(annee AS INTEGER) AS annee, axe, n_exact, TRUE AS dans_la_borne FROM (
  SELECT annee, count(DISTINCT o_custkey) AS patients, count(DISTINCT l_suppkey) AS professionnels, count(DISTINCT code) AS diagnostics
  FROM v_line GROUP BY GROUPING SETS ((annee), ()))
UNPIVOT (n_exact FOR axe IN (patients, professionnels, diagnostics))"""))
def kpi_distinct_sketches(spark, folder):
    """Distinct counts per year and over all years from mergeable sketches, held against exact ones."""
    axes = {"patients": "id_patient", "professionnels": "id_prof_sante", "diagnostics": "code_diag"}
    events = visits(spark, folder)
    per_year = stage(sketches(events, ["annee"], axes), "esquisses")
    total = merge(per_year, [], list(axes)).withColumns({"annee": F.lit(None).cast("int"), "_total": F.lit(True)})
    found = (estimates(per_year.withColumn("_total", F.lit(False)).unionByName(total), list(axes)).drop("n")
             .unpivot(["annee", "_total"], list(axes), "axe", "estime"))
    # events without a date make a year that is null, as the total has it: `_total` keeps them apart
    exact = (events.groupingSets([[F.col("annee")], []], F.col("annee"))
             .agg((F.grouping("annee") == 1).alias("_t"),
                  *[F.count_distinct(F.col(column)).alias(name) for name, column in axes.items()])
             .unpivot(["annee", "_t"], list(axes), "axe", "n_exact"))
    near = F.abs(F.col("estime") - F.col("n_exact")) <= F.lit(error_bound()) * F.col("n_exact")
    return (found.join(exact.withColumnsRenamed({"annee": "_a", "axe": "_x"}),
                       F.col("annee").eqNullSafe(F.col("_a")) & (F.col("_total") == F.col("_t")) & (F.col("axe") == F.col("_x")))
            .select("annee", "axe", "n_exact", near.alias("dans_la_borne")))


@query("kpi_top_diagnosis", oracle("v_line", f"""
SELECT CASE WHEN trim(code) = '' THEN 'UNKNOWN' ELSE code END AS diag_id, count(*) AS nb FROM v_line
WHERE annee = {YEAR} GROUP BY 1 ORDER BY nb DESC, diag_id LIMIT 10"""))
def kpi_top_diagnosis(spark, folder):
    fact = visits(spark, folder, year=YEAR).withColumn("diag_id", known_or(F.col("code_diag")))
    return kpi.top_by_axis(fact, "diag_id", "nb_consultation", YEAR, 10)


@query("kpi_top_diagnosis_year", """
SELECT annee, libelle, n, CAST(rn AS INTEGER) AS rang FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, p_brand AS libelle, count(*) AS n,
         row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY count(*) DESC, p_brand) AS rn
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY year(o_orderdate), p_brand)
WHERE rn <= 15""")
def kpi_top_diagnosis_year(spark, folder):
    labels = table(spark, folder, "part").select(F.col("p_partkey").alias("part_no"), F.col("p_brand").alias("libelle"))
    return kpi.top_labels_per_year(visits(spark, folder, with_code=False), "part_no", labels, "libelle", 15)


@query("kpi_top_specialty", """
SELECT annee, specialite, n, CAST(rn AS INTEGER) AS rang FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, n_name AS specialite, count(*) AS n,
         row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY count(*) DESC, n_name) AS rn
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN (SELECT n_nationkey, n_name FROM nation) ON n_nationkey = s_nationkey GROUP BY year(o_orderdate), n_name)
WHERE rn <= 12""")
def kpi_top_specialty(spark, folder):
    return kpi.top_labels_per_year(visits(spark, folder, with_code=False), "id_prof_sante",
                                   specialty_of(spark, folder, "id_prof_sante"), "specialite", 12)


def specialty_of(spark, folder, key):
    """Professional -> specialty label."""
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias(key), F.col("s_nationkey").cast("string").alias("code_specialite"))
    return supplier.join(specialties(spark, folder), "code_specialite", "left").select(key, "specialite")


@query("kpi_by_sex_year", oracle("v_patient", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, sexe, count(*) AS n
FROM orders JOIN v_patient ON id_patient = CAST(o_custkey AS VARCHAR) GROUP BY 1, 2"""))
def kpi_by_sex_year(spark, folder):
    events = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("annee"), F.col("o_custkey").cast("string").alias("id_patient"))
    per_patient = events.groupBy("annee", "id_patient").agg(F.count("*").alias("n"))
    sexes = patients(spark, folder).select("id_patient", sex_code(F.col("sexe")).alias("sexe"))
    return per_patient.join(sexes, "id_patient").groupBy("annee", "sexe").agg(F.sum("n").alias("n"))


@query("kpi_by_professional", f"""
SELECT l_suppkey AS id_prof_sante, count(*) AS nb FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE year(o_orderdate) = {YEAR} GROUP BY 1""")
def kpi_by_professional(spark, folder):
    return (kpi.by_axis(visits(spark, folder, with_code=False, year=YEAR), "id_prof_sante", "nb_consultation", YEAR)
            .orderBy(F.desc("nb"), "id_prof_sante"))


@query("kpi_yoy", """
SELECT annee, n, CASE WHEN prec_annee = annee - 1 THEN prec END AS precedent,
       CASE WHEN prec_annee = annee - 1 THEN CAST(floor(100.0 * (n - prec) / prec + 0.5) AS INTEGER) END AS evolution_pct
FROM (SELECT annee, n, lag(n) OVER (ORDER BY annee) AS prec, lag(annee) OVER (ORDER BY annee) AS prec_annee FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1))""")
def kpi_yoy(spark, folder):
    per_year = (visits(spark, folder, with_code=False)
                .groupBy("annee").agg(F.count("*").alias("n")))
    return year_on_year(per_year, "annee", "n")


@query("kpi_share_diagnosis", oracle("v_line", """
SELECT diag_id, nb, CAST(round(100.0 * nb / (SELECT count(*) FROM v_line), 2) AS DOUBLE) AS part_pct FROM (
  SELECT CASE WHEN trim(code) = '' THEN 'UNKNOWN' ELSE code END AS diag_id, count(*) AS nb FROM v_line GROUP BY 1)"""))
def kpi_share_diagnosis(spark, folder):
    fact = visits(spark, folder).withColumn("diag_id", known_or(F.col("code_diag")))
    return share_of_total(kpi.by_axis(fact, "diag_id", "nb_consultation"), "nb", 2)


# Hospital stays ------------------------------------------------------------------------------


@query("kpi_stays_total_year", oracle("v_stay_ok", f"SELECT count(*) AS nb FROM v_stay_ok WHERE annee = {YEAR}"))
def kpi_stays_total_year(spark, folder):
    return kpi.total(stay_fact(spark, folder), "nb_hospitalisation", YEAR)


@query("kpi_stays_by_diagnosis", oracle("v_stay_ok", f"""
SELECT diag_id, count(*) AS nb FROM v_stay_ok WHERE annee = {YEAR} GROUP BY 1 ORDER BY nb DESC, diag_id LIMIT 10"""))
def kpi_stays_by_diagnosis(spark, folder):
    return kpi.top_by_axis(stay_fact(spark, folder), "diag_id", "nb_hospitalisation", YEAR, 10)


@query("kpi_stays_by_establishment", oracle("v_stay_ok v_site", f"""
SELECT id_site AS etab_id, count(*) AS nb, round(CAST(sum(jours) AS DOUBLE) / count(jours), 6) AS dms FROM v_stay_ok
WHERE annee = {YEAR} AND id_site IN (SELECT etab_id FROM v_site) GROUP BY 1 ORDER BY nb DESC, etab_id LIMIT 10"""))
def kpi_stays_by_establishment(spark, folder):
    return (kpi.stays_by_establishment(stay_fact(spark, folder), sites(spark, folder), YEAR)
            .withColumn("dms", F.round("dms", 6)))


@query("kpi_stays_sex_age", oracle("v_stay_ok v_patient", f"""
SELECT sexe, tranche_age, count(*) AS nb FROM v_stay_ok s JOIN v_patient p ON p.id_patient = s.id_patient
WHERE annee = {YEAR} GROUP BY 1, 2"""))
def kpi_stays_sex_age(spark, folder):
    known = patients(spark, folder).select(
        pseudonym(F.col("id_patient"), MASTER, SEED).alias("patient_id"), sex_code(F.col("sexe")).alias("sexe"),
        band_of_age(F.col("age").try_cast("int")).alias("tranche_age"))
    return kpi.stays_by_sex_and_age(stay_fact(spark, folder), known, YEAR)


@query("bed_occupancy", oracle("v_stay_ok", f"""
SELECT id_site AS etab_id, jours, lits, CAST(round(100.0 * jours / (lits * 365), 2) AS DOUBLE) AS taux_pct FROM (
  SELECT id_site, CAST(sum(jours) AS BIGINT) AS jours FROM v_stay_ok WHERE annee = {YEAR} GROUP BY 1)
JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS etab_id, CAST(10 + s_suppkey % 50 AS INTEGER) AS lits FROM supplier)
  ON etab_id = id_site"""))
def bed_occupancy(spark, folder):
    capacity = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("etab_id"), (10 + F.col("s_suppkey") % 50).cast("int").alias("lits"))
    return kpi.bed_occupancy(stay_fact(spark, folder), capacity, YEAR)


@query("drilldown_rollup", oracle("v_stay_ok v_site", """
SELECT region, pays, etab_id, CAST(annee AS INTEGER) AS annee,
       CAST(grouping(region, pays, etab_id, annee) AS INTEGER) AS niveau, count(*) AS nb,
       round(CAST(sum(jours) AS DOUBLE) / count(jours), 6) AS dms
FROM v_stay_ok JOIN v_site ON etab_id = id_site GROUP BY ROLLUP (region, pays, etab_id, annee)"""))
def drilldown_rollup(spark, folder):
    return (kpi.drilldown(stay_fact(spark, folder), sites(spark, folder), ["region", "pays", "etab_id", "annee"])
            .withColumn("dms", F.round("dms", 6)))


@query("rate_per_group", """
WITH d AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS entree,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS sortie,
       lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS suivante
       FROM orders),
s AS (SELECT d.*, c_mktsegment AS groupe, coalesce(suivante > sortie AND suivante <= sortie + 30, FALSE) AS retour,
      EXISTS (SELECT 1 FROM d f WHERE f.o_custkey = d.o_custkey AND f.o_orderstatus = 'F'
              AND f.entree BETWEEN d.entree AND d.entree + 30) AS deces
      FROM d JOIN customer ON c_custkey = o_custkey)
SELECT indicateur, groupe, numerateur, denominateur, CAST(round(100.0 * numerateur / denominateur, 2) AS DOUBLE) AS taux_pct
FROM (SELECT 'readmission' AS indicateur, groupe, count(CASE WHEN retour THEN 1 END) AS numerateur, count(*) AS denominateur
      FROM s GROUP BY 2
      UNION ALL SELECT 'mortalite', groupe, count(CASE WHEN deces THEN 1 END), count(*) FROM s GROUP BY 2)""")
def rate_per_group(spark, folder):
    segments = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("groupe"))
    stay = order_stays(spark, folder)
    deceased = (table(spark, folder, "orders").filter("o_orderstatus = 'F'")
                .select("o_custkey", F.col("o_orderdate").cast("date").alias("date_deces")))
    returned = readmission(stay, "o_custkey", "entree", "sortie", "o_orderkey", 30, "retour")
    died = event_within(stay, deceased, "o_custkey", "entree", "date_deces", 30, "deces")
    return (kpi.rate(returned, "o_custkey", segments, "groupe", F.col("retour"), "readmission")
            .unionAll(kpi.rate(died, "o_custkey", segments, "groupe", F.col("deces"), "mortalite")))


# Deaths --------------------------------------------------------------------------------------


@query("kpi_deaths_by_region", oracle("v_death_ok v_geo", f"""
SELECT region, count(*) AS nb_deces FROM v_death_ok JOIN v_geo USING (geo_id) WHERE annee = {YEAR}
GROUP BY 1 ORDER BY nb_deces DESC, region LIMIT 5"""))
def kpi_deaths_by_region(spark, folder):
    return kpi.deaths_by_region(death_fact(spark, folder, YEAR), geography(departments(spark, folder)), YEAR)


@query("kpi_top_regions", oracle("v_death_ok", f"""
SELECT geo_id, count(*) AS nb FROM v_death_ok WHERE annee = {YEAR} GROUP BY 1 ORDER BY nb DESC, geo_id LIMIT 5"""))
def kpi_top_regions(spark, folder):
    return kpi.top_by_axis(death_fact(spark, folder, YEAR), "geo_id", "nb_deces", YEAR, 5)


@query("kpi_deaths_total_year", oracle("v_death_ok", f"SELECT count(*) AS nb FROM v_death_ok WHERE annee = {YEAR}"))
def kpi_deaths_total_year(spark, folder):
    return kpi.total(death_fact(spark, folder, YEAR), "nb_deces", YEAR)


@query("kpi_sex_age", oracle("v_death_ok", f"""
SELECT sx AS sexe, tranche_age, count(*) AS n FROM v_death_ok WHERE annee = {YEAR} GROUP BY 1, 2"""))
def kpi_sex_age(spark, folder):
    return kpi.by_sex_and_band(death_fact(spark, folder, YEAR), "nb_deces", YEAR)


@query("kpi_age_order", oracle("v_death_ok", """
SELECT tranche_age, count(*) AS nb, CAST(CASE tranche_age WHEN '0-19' THEN 1 WHEN '20-39' THEN 2 WHEN '40-59' THEN 3
  WHEN '60-74' THEN 4 WHEN '75-84' THEN 5 WHEN '85+' THEN 6 ELSE 7 END AS INTEGER) AS rang FROM v_death_ok GROUP BY 1"""))
def kpi_age_order(spark, folder):
    return kpi.in_band_order(kpi.by_axis(death_fact(spark, folder), "tranche_age", "nb_deces"), "tranche_age")


# Satisfaction ----------------------------------------------------------------------------------


@query("kpi_satisfaction_region", oracle("v_survey_ok v_site_geo", f"""
SELECT g.region, round(CAST(avg(CAST(note AS DOUBLE)) AS DOUBLE), 5) AS satisf_moy, count(*) AS n_sites
FROM v_survey_ok f JOIN v_site_geo g USING (site) GROUP BY 1"""))
def kpi_satisfaction_region(spark, folder):
    return (kpi.mean_mark_by_region(survey_fact(spark, folder), establishment_dim(spark, folder), YEAR)
            .withColumn("satisf_moy", F.round("satisf_moy", 5)))


def campaign_lines(spark, folder):
    """Lines of the survey files of three campaigns, read by position."""
    return read_surveys(spark, survey_files(spark, folder, staging_path(spark, "campagnes")))


def campaign_fact(spark, folder):
    good = campaign_lines(spark, folder).filter("motif IS NULL")
    return clean_surveys(type_surveys(good), sites(spark, folder), geography(departments(spark, folder)), None)


@query("survey_layouts", oracle("v_campaign", f"""
SELECT annee, CAST(CASE WHEN annee IN {WIDE_CAMPAIGNS} THEN 25 ELSE 23 END AS INTEGER) AS largeur, count(*) AS n_lignes,
       CAST(0 AS BIGINT) AS n_illisibles, count(DISTINCT site) AS n_sites FROM v_campaign GROUP BY 1"""))
def survey_layouts(spark, folder):
    return (campaign_lines(spark, folder).withColumn("_w", F.when(F.element_at("champs", 25).isNotNull(), 25).otherwise(23))
            .groupBy("annee").agg(F.max("_w").alias("largeur"), F.count("*").alias("n_lignes"),
                                  F.count("motif").alias("n_illisibles"), F.count_distinct("finess_geo").alias("n_sites")))


@query("fact_satisfaction_campaigns", oracle("v_campaign v_site_geo", """
SELECT row_number() OVER (ORDER BY annee, site) AS satisfaction_key, CAST(annee * 10000 + 101 AS INTEGER) AS date_id, site AS etab_id,
       geo_id, CAST(floor(score + 0.5) / 10 AS DOUBLE) AS note_satisfaction, annee
FROM v_campaign JOIN v_site_geo USING (site) WHERE score BETWEEN 0 AND 100"""))
def fact_satisfaction_campaigns(spark, folder):
    return (number_surveys(campaign_fact(spark, folder))
            .withColumn("note_satisfaction", F.col("note_satisfaction").cast("double")))


@query("kpi_satisfaction_all", oracle("v_campaign v_site_geo", """
SELECT geo_id, round(CAST(sum(floor(score + 0.5)) AS DOUBLE) / 10 / count(*), 5) AS satisf_moy, count(DISTINCT site) AS n_sites
FROM v_campaign JOIN v_site_geo USING (site) WHERE score BETWEEN 0 AND 100 GROUP BY 1"""))
def kpi_satisfaction_all(spark, folder):
    return kpi.mean_mark(campaign_fact(spark, folder), "geo_id").withColumn("satisf_moy", F.round("satisf_moy", 5))


def scored_surveys(spark, folder):
    return surveys(spark, folder).withColumn("score", decimal_comma(F.col("score_all_rea_ajust")))


SUMMARY_SQL = """s AS (SELECT region_std AS region, TRY_CAST(replace(texte, ',', '.') AS DOUBLE) AS score FROM v_survey),
m AS (SELECT CASE WHEN grouping(region) = 1 THEN 'FRANCE' ELSE region END AS region,
      round(avg(CASE WHEN score BETWEEN 0 AND 100 THEN score END) / 10, 6) AS moyenne,
      count(CASE WHEN score BETWEEN 0 AND 100 THEN 1 END) AS diffuses, count(*) AS total
      FROM s GROUP BY GROUPING SETS ((region), ()))"""


@query("satisfaction_region_national", oracle("v_survey", "SELECT 1").rsplit("SELECT 1", 1)[0].rstrip()
       + f", {SUMMARY_SQL} SELECT * FROM m WHERE diffuses > 0")
def satisfaction_region_national(spark, folder):
    official = scored_surveys(spark, folder).withColumn("region", F.col("region_officielle"))
    return cubes.satisfaction_summary(official)


@query("satisfaction_gap", oracle("v_survey", "SELECT 1").rsplit("SELECT 1", 1)[0].rstrip() + f""", {SUMMARY_SQL}
SELECT region, moyenne, round(moyenne - (SELECT moyenne FROM m WHERE region = 'FRANCE'), 6) AS ecart,
       region = (SELECT region FROM m WHERE region <> 'FRANCE' AND diffuses > 0 ORDER BY moyenne DESC, region LIMIT 1)
       AS est_meilleure,
       region = (SELECT region FROM m WHERE region <> 'FRANCE' AND diffuses > 0 ORDER BY moyenne, region LIMIT 1)
       AS est_moins_bonne
FROM m WHERE region <> 'FRANCE' AND diffuses > 0""")
def satisfaction_gap(spark, folder):
    official = scored_surveys(spark, folder).withColumn("region", F.col("region_officielle"))
    return cubes.satisfaction_gaps(cubes.satisfaction_summary(official))


@query("satisfaction_subscores", oracle("v_campaign", """
SELECT sous_score, round(CAST(sum(valeur) AS DOUBLE) / count(*) / 10, 6) AS moyenne, count(*) AS n
FROM (SELECT sous_score, (q * (rang + 3) + k) % 107 AS valeur FROM v_campaign, (VALUES (0, 'Accueil'),
        (1, 'Prise en charge infirmiers'), (2, 'Prise en charge médecins'), (3, 'Chambre'), (4, 'Repas'),
        (5, 'Organisation sortie')) v(rang, sous_score) WHERE score BETWEEN 0 AND 100)
WHERE valeur BETWEEN 0 AND 100 GROUP BY 1"""))
def satisfaction_subscores(spark, folder):
    return cubes.sub_score_means(sub_score_rows(campaign_lines(spark, folder)))


# Cubes -------------------------------------------------------------------------------------------

CUBE_SQL = """SELECT CAST(annee AS INTEGER) AS annee,
  CASE WHEN geo_id = 'INCONNU' THEN 'Autre / étranger' ELSE region END AS region, sx AS sexe, tranche_age, count(*) AS n
  FROM v_death_ok JOIN v_geo USING (geo_id) GROUP BY 1, 2, 3, 4"""
DIMS = ["annee", "region", "sexe", "tranche_age"]
STATE = {"annee": YEAR, "sexe": "F"}


def death_cube(spark, folder):
    return cubes.deaths_cube(death_fact(spark, folder), geography(departments(spark, folder)))


@query("cube_deaths", oracle("v_death_ok v_geo", CUBE_SQL))
def cube_deaths(spark, folder):
    return death_cube(spark, folder).orderBy(*DIMS)


@query("cube_deaths_json", oracle("v_death_ok v_geo", f"""
SELECT '[' || annee || ',"' || region || '","' || sexe || '","' || tranche_age || '",' || n || ']' AS ligne
FROM ({CUBE_SQL})"""))
def cube_deaths_json(spark, folder):
    return cubes.cube_as_json(death_cube(spark, folder))


@query("cube_hospital", oracle("v_stay v_patient", """
SELECT CAST(year(try_strptime(date_entree, '%d/%m/%Y')) AS INTEGER) AS annee, {chapter} AS chapitre,
       coalesce(sexe, '?') AS sexe, coalesce(tranche_age, 'Inconnu') AS tranche_age, count(*) AS n
FROM v_stay s LEFT JOIN v_patient p ON p.id_patient = s.id_patient
WHERE try_strptime(date_entree, '%d/%m/%Y') IS NOT NULL GROUP BY 1, 2, 3, 4""").replace("{chapter}", """
CASE WHEN trim(code_diag) = '' THEN 'Inconnu' ELSE CASE substr(code_diag, 1, 1) WHEN 'S' THEN 'Lésions traumatiques'
WHEN 'E' THEN 'Endocrinien & métabolique' WHEN 'P' THEN 'Période périnatale' WHEN 'M' THEN 'Ostéo-articulaire'
WHEN 'L' THEN 'Peau' END END"""))
def cube_hospital(spark, folder):
    typed = type_stays(stays(spark, folder)).filter(F.col("date_entree_typee").isNotNull())
    events = typed.select(F.year("date_entree_typee").alias("annee"), "id_patient",
                          F.col("code_diagnostic").alias("code_diag"))
    return cubes.stays_cube(events, patients(spark, folder))


@query("cube_consultation", oracle("v_line v_patient", """
SELECT CAST(annee AS INTEGER) AS annee, CASE WHEN rn <= 12 THEN n_name ELSE 'Autres' END AS specialite, sexe, chapitre,
       count(*) AS n
FROM (SELECT *, CASE WHEN trim(code) = '' THEN 'Inconnu' ELSE CASE substr(code, 1, 1) WHEN 'S' THEN 'Lésions traumatiques'
        WHEN 'E' THEN 'Endocrinien' WHEN 'P' THEN 'Périnatal' WHEN 'M' THEN 'Ostéo-articulaire' WHEN 'L' THEN 'Peau'
        END END AS chapitre FROM v_line)
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
JOIN v_patient ON id_patient = CAST(o_custkey AS VARCHAR)
JOIN (SELECT n_nationkey AS nk, row_number() OVER (ORDER BY count(*) DESC, n_name) AS rn
      FROM v_line JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
      GROUP BY n_nationkey, n_name) ON nk = n_nationkey
GROUP BY 1, 2, 3, 4"""))
def cube_consultation(spark, folder):
    events = visits(spark, folder).select(
        "annee", F.col("id_prof_sante").alias("id_prof"), F.col("id_patient").cast("string").alias("id_patient"),
        "code_diag")
    return cubes.consultations_cube(events, specialty_of(spark, folder, "id_prof"), patients(spark, folder))


@query("cross_filter", oracle("v_death_ok v_geo", f"""
SELECT * FROM (WITH c AS ({CUBE_SQL})
SELECT 'annee' AS visuel, CAST(annee AS VARCHAR) AS valeur, CAST(sum(n) AS BIGINT) AS n FROM c WHERE sexe = 'F' GROUP BY 2
UNION ALL SELECT 'region', region, CAST(sum(n) AS BIGINT) FROM c WHERE annee = {YEAR} AND sexe = 'F' GROUP BY 2
UNION ALL SELECT 'sexe', sexe, CAST(sum(n) AS BIGINT) FROM c WHERE annee = {YEAR} GROUP BY 2
UNION ALL SELECT 'tranche_age', tranche_age, CAST(sum(n) AS BIGINT) FROM c WHERE annee = {YEAR} AND sexe = 'F' GROUP BY 2)"""))
def cross_filter(spark, folder):
    return cubes.cross_filter(death_cube(spark, folder), DIMS, STATE)


@query("kpi_cards", oracle("v_death_ok v_geo", f"""
SELECT * FROM (WITH c AS (SELECT region, CAST(sum(n) AS BIGINT) AS n,
    CAST(sum(CASE WHEN sexe = 'F' THEN n ELSE 0 END) AS BIGINT) AS f FROM ({CUBE_SQL}) WHERE annee = {YEAR} GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS total, (SELECT region FROM c ORDER BY n DESC, region LIMIT 1) AS premier,
       max(n) AS n_premier, count(*) AS n_valeurs, CAST(floor(100.0 * max(n) / sum(n) + 0.5) AS INTEGER) AS part_premier_pct,
       CAST(floor(100.0 * sum(f) / sum(n) + 0.5) AS INTEGER) AS femmes_pct FROM c)"""))
def kpi_cards(spark, folder):
    return cubes.kpi_cards(death_cube(spark, folder), "region", {"annee": YEAR})


@query("kpi_trend", oracle("v_death_ok", """
SELECT annee, n, prec AS precedent, CAST(floor(100.0 * (n - prec) / prec + 0.5) AS INTEGER) AS evolution_pct
FROM (SELECT annee, n, lag(n) OVER (ORDER BY annee) AS prec FROM (
  SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n FROM v_death_ok WHERE sx = 'F' GROUP BY 1))"""))
def kpi_trend(spark, folder):
    return cubes.trend(death_cube(spark, folder), STATE)


@query("kpi_sparkline", oracle("v_death_ok", """
SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n FROM v_death_ok WHERE sx = 'F' GROUP BY 1"""))
def kpi_sparkline(spark, folder):
    return cubes.series(death_cube(spark, folder), STATE)
