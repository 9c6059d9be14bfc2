"""Queries on parsing, recoding, joins, deduplication and rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.functions.bands import age_band, age_band_legacy, stay_type
from klinark.functions.codes import (
    department_code, fold_accents, icd_chapter, known_or, sex_code,
)
from klinark.functions.fixed_values import AGE_BANDS, ICD_CHAPTERS, STAY_AGE_BANDS, UNKNOWN_GEO
from klinark.functions.values import (
    date_id, decimal_comma, discharge_date, parse_dmy, parse_iso,
)
from klinark.operators.checks import orphan_counts, orphans, reason_counts
from klinark.operators.joins import event_within, lookup, readmission, resolve_keys
from klinark.operators.rankings import lump_other
from klinark.operators.rows import REASON, classify, keep_first, rejected, require, surrogate_key
from klinark.plans.facts import (
    clean_stays, consultation_rules, death_rules, flag_known_sites, resolve_region, stay_rules,
    survey_rules, type_stays, type_surveys,
)
from klinark.plans.dimensions import geography
from klinark.plans.registry.base import query
from klinark.plans.registry.views import DATE_SHAPE, band_case, oracle
from klinark.plans.standins import (
    FIRST_YEAR, LAST_YEAR, MASTER, SEED, STAY_TIE, VISIT_KEY, VISIT_ORDER, deaths, departments,
    professionals, sites, stays, surveys, table, visits,
)


@query("filter_year_range", f"""
SELECT l_orderkey AS num_consultation, l_linenumber AS line_no, CAST(o_orderdate AS DATE) AS jour
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE year(o_orderdate) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}""")
def filter_year_range(spark, folder):
    return (visits(spark, folder, with_code=False)
            .filter(F.year("jour").between(FIRST_YEAR, LAST_YEAR)).select(*VISIT_KEY, "jour"))


@query("filter_date_regex", oracle("v_death", f"""
SELECT acte AS numero_acte_deces, CAST(date_deces AS DATE) AS jour FROM v_death
WHERE regexp_matches(date_deces, '{DATE_SHAPE}') AND CAST(substr(date_deces, 1, 4) AS INTEGER) >= {FIRST_YEAR}"""))
def filter_date_regex(spark, folder):
    day = parse_iso(F.col("date_deces"))
    return (deaths(spark, folder).filter(F.year(day) >= FIRST_YEAR)
            .select("numero_acte_deces", day.alias("jour")))


@query("recode_sex", oracle("v_death", """
SELECT CASE sexe WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE '?' END AS sexe, count(*) AS n FROM v_death GROUP BY 1"""))
def recode_sex(spark, folder):
    return deaths(spark, folder).groupBy(sex_code(F.col("sexe")).alias("sexe")).agg(F.count("*").alias("n"))


AGED = """(SELECT acte, date_naissance, TRY_CAST(substr(date_deces, 1, 4) AS INTEGER)
  - TRY_CAST(substr(date_naissance, 1, 4) AS INTEGER) AS age FROM v_death)"""
STAY_BAND_SQL = """CASE WHEN age IS NULL OR age < 0 OR age > 120 THEN 'Inconnu' WHEN age <= 18 THEN '0-18'
  WHEN age <= 35 THEN '19-35' WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65' ELSE '66+' END"""
LEGACY_BAND_SQL = """CASE WHEN NOT regexp_matches(date_naissance, '^[0-9]{4}') THEN 'Inconnu' WHEN age < 20 THEN '0-19'
  WHEN age < 40 THEN '20-39' WHEN age < 60 THEN '40-59' WHEN age < 75 THEN '60-74' WHEN age < 85 THEN '75-84'
  ELSE '85+' END"""


@query("age_bands", oracle("v_death", f"""
SELECT acte AS numero_acte_deces, {band_case('age')} AS tranche_age, {STAY_BAND_SQL} AS tranche_sejour,
       {LEGACY_BAND_SQL} AS tranche_historique FROM {AGED}"""))
def age_bands(spark, folder):
    dates = F.col("date_deces"), F.col("date_naissance")
    return deaths(spark, folder).select(
        "numero_acte_deces", age_band(*dates, AGE_BANDS).alias("tranche_age"),
        age_band(*dates, STAY_AGE_BANDS).alias("tranche_sejour"),
        age_band_legacy(*dates).alias("tranche_historique"))


@query("lump_top_n", """
WITH b AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_brand) AS rn FROM b)
SELECT CASE WHEN rn <= 12 THEN p_brand ELSE 'Autres' END AS p_brand, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""")
def lump_top_n(spark, folder):
    per_brand = (table(spark, folder, "lineitem")
                 .join(table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"))
                 .groupBy("p_brand").agg(F.count("*").alias("n")))
    return lump_other(per_brand, "p_brand", 12, weight="n").groupBy("p_brand").agg(F.sum("n").alias("n"))


@query("default_unknown", oracle("v_line", """
SELECT CASE WHEN trim(code) = '' THEN 'UNKNOWN' ELSE code END AS diag_id, count(*) AS n FROM v_line GROUP BY 1"""))
def default_unknown(spark, folder):
    return (visits(spark, folder).groupBy(known_or(F.col("code_diag")).alias("diag_id"))
            .agg(F.count("*").alias("n")))


@query("dept_code", oracle("v_death", """
SELECT lieu, dep, n FROM (
SELECT lieu, substr(lieu, 1, 2) AS dep, count(*) AS n FROM v_death GROUP BY 1
UNION ALL SELECT '97' || lieu, substr('97' || lieu, 1, 3), count(*) FROM v_death GROUP BY lieu
UNION ALL SELECT '2A' || lieu, '2A', count(*) FROM v_death GROUP BY lieu)"""))
def dept_code(spark, folder):
    places = deaths(spark, folder).select(F.explode(F.array(
        "code_lieu_deces", F.concat(F.lit("97"), "code_lieu_deces"), F.concat(F.lit("2A"), "code_lieu_deces")))
        .alias("lieu"))
    return places.groupBy("lieu", department_code(F.col("lieu")).alias("dep")).agg(F.count("*").alias("n"))


@query("dept_to_region_join", oracle("v_death v_ref", """
SELECT coalesce(code_region, 'INCONNU') AS geo_id, count(*) AS n
FROM v_death LEFT JOIN v_ref ON code_departement = substr(lieu, 1, 2) GROUP BY 1"""))
def dept_to_region_join(spark, folder):
    located = deaths(spark, folder).withColumn("code_departement", department_code(F.col("code_lieu_deces")))
    return (lookup(located, departments(spark, folder), "code_departement")
            .groupBy(F.coalesce("code_region", F.lit(UNKNOWN_GEO)).alias("geo_id")).agg(F.count("*").alias("n")))


@query("region_label_match", oracle("v_survey v_geo", """
SELECT site, coalesce(geo_id, 'INCONNU') AS geo_id FROM v_survey s LEFT JOIN v_geo g
ON regexp_replace(lower(g.region), '[ .''-]', '', 'g') = regexp_replace(lower(s.region), '[ .''-]', '', 'g')"""))
def region_label_match(spark, folder):
    return (resolve_region(surveys(spark, folder), geography(departments(spark, folder)), "region")
            .select(F.col("finess_geo").alias("site"), "geo_id"))


@query("orphan_keys", oracle("v_death v_ref", """
SELECT 'document' AS cle, count(*) AS n_orphelins FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'departement', count(*) FROM v_death WHERE substr(lieu, 1, 2) NOT IN (SELECT code_departement FROM v_ref)"""))
def orphan_keys(spark, folder):
    located = deaths(spark, folder).select(department_code(F.col("code_lieu_deces")).alias("departement"))
    return orphan_counts({
        "document": (table(spark, folder, "documents"), "doc_id", table(spark, folder, "labels"), "doc_id"),
        "departement": (located, "departement", departments(spark, folder), "code_departement")})


@query("unknown_departments", oracle("v_death v_ref", """
SELECT substr(lieu, 1, 2) AS departement, count(*) AS n FROM v_death
WHERE substr(lieu, 1, 2) NOT IN (SELECT code_departement FROM v_ref) GROUP BY 1"""))
def unknown_departments(spark, folder):
    located = deaths(spark, folder).select(department_code(F.col("code_lieu_deces")).alias("departement"))
    return (orphans(located, "departement", departments(spark, folder), "code_departement")
            .groupBy("departement").agg(F.count("*").alias("n")))


@query("fk_resolution", """
SELECT count(*) AS total, CAST(sum(CASE WHEN p_partkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS part_connu,
       CAST(sum(CASE WHEN s_suppkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS site_connu,
       CAST(sum(CASE WHEN o_orderkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS commande_connue
FROM (SELECT CASE WHEN l_linenumber = 7 THEN -l_partkey ELSE l_partkey END AS p,
             CASE WHEN l_quantity > 40 THEN NULL ELSE l_suppkey END AS s,
             CASE WHEN l_returnflag = 'R' THEN -l_orderkey ELSE l_orderkey END AS o FROM lineitem)
LEFT JOIN part ON p_partkey = p LEFT JOIN supplier ON s_suppkey = s LEFT JOIN orders ON o_orderkey = o""")
def fk_resolution(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_quantity") <= 40, F.col("l_suppkey")).alias("l_suppkey"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey"))
    resolved = resolve_keys(lines, {
        "l_partkey": (table(spark, folder, "part"), "p_partkey"),
        "l_suppkey": (table(spark, folder, "supplier"), "s_suppkey"),
        "l_orderkey": (table(spark, folder, "orders"), "o_orderkey")})
    return resolved.agg(F.count("*").alias("total"), F.count_if("l_partkey_connu").alias("part_connu"),
                        F.count_if("l_suppkey_connu").alias("site_connu"),
                        F.count_if("l_orderkey_connu").alias("commande_connue"))


@query("event_within_30d", """
SELECT a.o_orderkey AS sejour, EXISTS (
  SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus = 'F'
  AND CAST(b.o_orderdate AS DATE) BETWEEN CAST(a.o_orderdate AS DATE) AND CAST(a.o_orderdate AS DATE) + 30) AS deces_30j
FROM orders a""")
def event_within_30d(spark, folder):
    orders = (table(spark, folder, "orders").withColumn("jour", F.col("o_orderdate").cast("date"))
              .withColumnRenamed("o_orderkey", "sejour"))
    deceased = orders.filter("o_orderstatus = 'F'").select("o_custkey", F.col("jour").alias("date_deces"))
    admitted = orders.select("sejour", "o_custkey", "jour")
    return (event_within(admitted, deceased, "o_custkey", "jour", "date_deces", 30, "deces_30j")
            .select("sejour", "deces_30j"))


def order_stays(spark, folder):
    """Orders as stays: the length of stay is zero to nine days."""
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("entree"),
        discharge_date(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 10).cast("int")).alias("sortie"))


READMISSION_SQL = """
SELECT o_orderkey, coalesce(suivante > sortie AND suivante <= sortie + 30, FALSE) AS readmission
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS sortie,
             lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
             AS suivante FROM orders)"""


@query("readmission_30d", READMISSION_SQL)
def readmission_30d(spark, folder):
    return (readmission(order_stays(spark, folder), "o_custkey", "entree", "sortie", "o_orderkey", 30, "readmission")
            .select("o_orderkey", "readmission"))


@query("stay_type_bands", oracle("v_stay", """
SELECT CASE WHEN jours < 1 THEN 'Ambulatoire' WHEN jours BETWEEN 1 AND 2 THEN 'Court séjour'
            ELSE 'Séjour standard' END AS type_sejour, count(*) AS n FROM v_stay GROUP BY 1"""))
def stay_type_bands(spark, folder):
    return (type_stays(stays(spark, folder)).groupBy(stay_type(F.col("jours")).alias("type_sejour"))
            .agg(F.count("*").alias("n")))


@query("dedup_first", """
SELECT num_consultation, line_no, part_no, id_prof_sante FROM (
  SELECT l_orderkey AS num_consultation, l_linenumber AS line_no, l_partkey AS part_no, l_suppkey AS id_prof_sante,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE rn = 1""")
def dedup_first(spark, folder):
    return (keep_first(visits(spark, folder, with_code=False), list(VISIT_KEY), list(VISIT_ORDER))
            .select(*VISIT_KEY, "part_no", "id_prof_sante"))


@query("hospital_silver", oracle("v_stay_ok", """
SELECT num_stay AS num_hospitalisation, id_site AS etab_id, entree, jours AS duree_sejour FROM v_stay_ok"""))
def hospital_silver(spark, folder):
    clean = clean_stays(type_stays(stays(spark, folder)), MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE)
    return clean.select("num_hospitalisation", "etab_id", F.col("date_entree_typee").alias("entree"), "duree_sejour")


@query("surrogate_key", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS cle FROM orders""")
def surrogate_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return surrogate_key(orders, "cle", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "cle")


@query("parse_dmy_date", oracle("v_stay", """
SELECT num_stay AS num_hospitalisation, line_no, part_no, CAST(try_strptime(date_entree, '%d/%m/%Y') AS DATE) AS entree
FROM v_stay"""))
def parse_dmy_date(spark, folder):
    return stays(spark, folder).select("num_hospitalisation", "line_no", "part_no",
                                       parse_dmy(F.col("date_entree")).alias("entree"))


@query("duration_minutes", """
SELECT l_orderkey AS num_consultation, l_linenumber AS line_no, l_partkey AS part_no, l_suppkey AS id_prof_sante,
       CAST(CASE WHEN l_shipdate >= o_orderdate THEN date_diff('second', o_orderdate, l_shipdate) / 60.0 END AS DOUBLE)
       AS duree_minutes FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def duration(spark, folder):
    return visits(spark, folder, with_code=False).select(*VISIT_KEY, "part_no", "id_prof_sante", "duree_minutes")


@query("date_id", """
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, count(*) AS n FROM orders GROUP BY 1""")
def date_keys(spark, folder):
    return (table(spark, folder, "orders").groupBy(date_id(F.col("o_orderdate")).alias("date_id"))
            .agg(F.count("*").alias("n")))


@query("decimal_comma_parse", oracle("v_survey", """
SELECT site, CAST(TRY_CAST(replace(texte, ',', '.') AS DECIMAL(18, 4)) AS DOUBLE) AS score FROM v_survey"""))
def decimal_comma_parse(spark, folder):
    return surveys(spark, folder).select(
        F.col("finess_geo").alias("site"),
        decimal_comma(F.col("score_all_rea_ajust")).cast("double").alias("score"))


@query("accent_fold", """
SELECT doc_id, translate(lower(text), 'àáâäçèéêëîïôöùûü', 'aaaaceeeeiioouuu') AS texte FROM documents""")
def accent_fold(spark, folder):
    return table(spark, folder, "documents").select("doc_id", fold_accents(F.col("text")).alias("texte"))


CHAPTER_SQL = ("CASE WHEN trim({c}) = '' THEN 'Inconnu' ELSE CASE upper(substr({c}, 1, 1)) "
               + " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in ICD_CHAPTERS.items())
               + " ELSE 'Autres' END END")


@query("icd_chapter", oracle("v_line", f"""
SELECT {CHAPTER_SQL.format(c='code')} AS chapitre, count(*) AS n FROM v_line GROUP BY 1"""))
def icd_chapters(spark, folder):
    return (visits(spark, folder).groupBy(icd_chapter(F.col("code_diag")).alias("chapitre"))
            .agg(F.count("*").alias("n")))


@query("discharge_date", oracle("v_stay", """
SELECT num_stay AS num_hospitalisation, line_no, part_no,
       CAST(try_strptime(date_entree, '%d/%m/%Y') AS DATE) + jours AS sortie FROM v_stay"""))
def discharge_dates(spark, folder):
    return type_stays(stays(spark, folder)).select(
        "num_hospitalisation", "line_no", "part_no",
        discharge_date(F.col("date_entree_typee"), F.col("jours")).alias("sortie"))


@query("reject_missing_keys", oracle("v_stay", """
SELECT count(*) AS total, CAST(sum(CASE WHEN id_patient IS NOT NULL AND id_site IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
AS complets FROM v_stay"""))
def reject_missing_keys(spark, folder):
    raw = stays(spark, folder)
    complete = F.col("id_patient").isNotNull() & F.col("identifiant_organisation").isNotNull()
    return raw.agg(F.count("*").alias("total"), F.count_if(complete).alias("complets"))


@query("require_keys", oracle("v_stay", """
SELECT num_stay AS num_hospitalisation, line_no, part_no, id_patient FROM v_stay
WHERE id_patient IS NOT NULL AND id_site IS NOT NULL"""))
def require_keys(spark, folder):
    return (require(stays(spark, folder), ["id_patient", "identifiant_organisation"])
            .select("num_hospitalisation", "line_no", "part_no", "id_patient"))


def classified_stays(spark, folder):
    return classify(type_stays(stays(spark, folder)), stay_rules(FIRST_YEAR, LAST_YEAR))


def classified_surveys(spark, folder):
    typed = flag_known_sites(type_surveys(surveys(spark, folder)), sites(spark, folder))
    return classify(typed, survey_rules())


def classified_visits(spark, folder):
    return classify(visits(spark, folder, with_code=False), consultation_rules(FIRST_YEAR, LAST_YEAR))


def classified_deaths(spark, folder):
    return classify(deaths(spark, folder), death_rules(FIRST_YEAR))


@query("reject_hospital", oracle("v_stay_reason", """
SELECT concat_ws(';', num_stay, id_patient, id_site, date_entree) AS ligne_source, line_no, part_no, raison_rejet
FROM v_stay_reason WHERE raison_rejet IS NOT NULL"""))
def reject_hospital(spark, folder):
    line = F.concat_ws(";", "num_hospitalisation", "id_patient", "identifiant_organisation", "date_entree")
    return rejected(classified_stays(spark, folder)).select(line.alias("ligne_source"), "line_no", "part_no", REASON)


@query("reject_satisfaction", oracle("v_survey_reason", """
SELECT concat_ws(';', site, region, texte) AS ligne_source, raison_rejet FROM v_survey_reason
WHERE raison_rejet IS NOT NULL"""))
def reject_satisfaction(spark, folder):
    line = F.concat_ws(";", "finess_geo", "region", "score_all_rea_ajust")
    return rejected(classified_surveys(spark, folder)).select(line.alias("ligne_source"), REASON)


@query("reject_reason_counts", oracle("v_stay_reason v_survey_reason v_death", f"""
SELECT 'hospitalisation' AS source, raison_rejet, count(*) AS n FROM v_stay_reason WHERE raison_rejet IS NOT NULL GROUP BY 2
UNION ALL SELECT 'satisfaction', raison_rejet, count(*) FROM v_survey_reason WHERE raison_rejet IS NOT NULL GROUP BY 2
UNION ALL SELECT 'consultation', 'HORS_PLAGE', count(*) FROM v_line WHERE annee NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR}
UNION ALL SELECT 'deces', CASE WHEN date_deces = 'X' THEN 'DATE_INVALIDE' ELSE 'HORS_PLAGE' END, count(*) FROM v_death
WHERE date_deces = 'X' OR CAST(substr(date_deces, 1, 4) AS INTEGER) < {FIRST_YEAR} GROUP BY 2"""))
def reject_reasons(spark, folder):
    return reason_counts({"hospitalisation": rejected(classified_stays(spark, folder)),
                          "satisfaction": rejected(classified_surveys(spark, folder)),
                          "consultation": rejected(classified_visits(spark, folder)),
                          "deces": rejected(classified_deaths(spark, folder))})


@query("professional_fk", """
SELECT CAST(s_suppkey AS VARCHAR) AS identifiant, n_nationkey IS NOT NULL AS connu
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 13 = 0 THEN -s_nationkey - 1 ELSE s_nationkey END AS code FROM supplier)
LEFT JOIN nation ON n_nationkey = code""")
def professional_fk(spark, folder):
    """Professionals whose specialty is in the reference; one in thirteen asks for one that is not."""
    known = table(spark, folder, "nation").select(F.col("n_nationkey").cast("string").alias("code"))
    code = F.col("code_specialite").cast("long")
    asked = professionals(spark, folder).withColumn("code_specialite", F.when(
        F.col("identifiant").cast("long") % 13 == 0, -code - 1).otherwise(code).cast("string"))
    return (resolve_keys(asked, {"code_specialite": (known, "code")})
            .select("identifiant", F.col("code_specialite_connu").alias("connu")))
