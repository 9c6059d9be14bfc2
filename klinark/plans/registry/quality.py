"""Profiling, checks, reconciliation and privacy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.functions.codes import department_code
from klinark.functions.fixed_values import UNKNOWN_GEO
from klinark.functions.privacy import (
    EMAIL_PATTERN, MOJIBAKE_PATTERN, PHONE_PATTERN, has_mojibake, pseudonym,
)
from klinark.functions.values import month_start, parse_iso
from klinark.operators import checks, privacy, profiling
from klinark.operators.rows import accepted
from klinark.plans.dimensions import geography
from klinark.plans.facts import (
    STAY_KEY, clean_consultations, clean_deaths, clean_stays, clean_surveys, number_deaths, number_stays, shape_stays,
    type_stays, type_surveys,
)
from klinark.plans.registry.base import query
from klinark.plans.registry.cleaning import classified_stays, classified_visits
from klinark.plans.registry.views import oracle, pseudonym_sql
from klinark.plans.standins import (
    FIRST_YEAR, LAST_YEAR, MASTER, SEED, STAY_TIE, VISIT_KEY, VISIT_ORDER, YEAR, deaths,
    departments, sites, stays, surveys, table, visits,
)
from klinark.schemas import FORBIDDEN
from klinark.session import stage

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def death_fact(spark, folder, year=None):
    return clean_deaths(deaths(spark, folder, year), departments(spark, folder), FIRST_YEAR)


def stay_fact(spark, folder):
    return clean_stays(type_stays(stays(spark, folder)), MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE)


def numbered_stays(spark, folder):
    clear = clean_stays(type_stays(stays(spark, folder)), MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE, clear=True)
    return number_stays(clear, MASTER, SEED)


def visit_fact(spark, folder):
    return clean_consultations(visits(spark, folder), MASTER, SEED, FIRST_YEAR, LAST_YEAR, VISIT_KEY, VISIT_ORDER)


def survey_fact(spark, folder):
    return clean_surveys(type_surveys(surveys(spark, folder)), sites(spark, folder),
                         geography(departments(spark, folder)), YEAR)


# Profiles --------------------------------------------------------------------------------
@query("profile_volumes", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in TABLES))
def profile_volumes(spark, folder):
    return profiling.volumes({name: table(spark, folder, name) for name in TABLES})


STAY_COLUMNS = {"num_hospitalisation": "num_stay", "id_patient": "id_patient",
                "identifiant_organisation": "id_site", "code_diagnostic": "code_diag",
                "date_entree": "date_entree", "jour_hospitalisation": "CAST(jours AS VARCHAR)"}


@query("profile_completeness", oracle("v_stay", " UNION ALL ".join(
    f"SELECT count(*) AS total, '{name}' AS colonne, count(*) - count({sql}) AS n_null, "
    f"count(CASE WHEN trim({sql}) = '' THEN 1 END) AS n_vide, CAST(round(100.0 * (count(*) - count({sql}) "
    f"+ count(CASE WHEN trim({sql}) = '' THEN 1 END)) / count(*), 1) AS DOUBLE) AS pct_manquant FROM v_stay"
    for name, sql in STAY_COLUMNS.items())))
def profile_completeness(spark, folder):
    return profiling.completeness(stays(spark, folder), list(STAY_COLUMNS))


@query("profile_blank_pct", oracle("v_stay", """
SELECT CAST(round(100.0 * sum(CASE WHEN id_patient IS NULL OR trim(id_patient) = '' THEN 1 ELSE 0 END) / count(*), 1)
            AS DOUBLE) AS pct_id_patient,
       CAST(round(100.0 * sum(CASE WHEN trim(code_diag) = '' THEN 1 ELSE 0 END) / count(*), 1) AS DOUBLE)
       AS pct_code_diagnostic FROM v_stay"""))
def profile_blank_pct(spark, folder):
    return profiling.blanks(stays(spark, folder), ["id_patient", "code_diagnostic"])


@query("profile_duplicates", """
SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_doublons FROM lineitem""")
def profile_duplicates(spark, folder):
    return profiling.duplicate_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("profile_dates", """
SELECT min(CAST(o_orderdate AS DATE)) AS date_min, max(CAST(o_orderdate AS DATE)) AS date_max,
       count(CASE WHEN l_shipdate < o_orderdate THEN 1 END) AS n_inverse,
       count(CASE WHEN l_shipdate = o_orderdate THEN 1 END) AS n_duree_zero
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def profile_dates(spark, folder):
    return profiling.date_range(visits(spark, folder, with_code=False), "jour", "t_start", "t_end")


@query("profile_cardinality", oracle("v_line", """
SELECT count(DISTINCT o_custkey) AS id_patient_distinct, count(DISTINCT l_suppkey) AS id_prof_sante_distinct,
       count(DISTINCT code) AS code_diag_distinct FROM v_line"""))
def profile_cardinality(spark, folder):
    return profiling.cardinalities(visits(spark, folder), ["id_patient", "id_prof_sante", "code_diag"])


@query("profile_numeric", """
SELECT count(*) AS n, min(s_acctbal) AS valeur_min, max(s_acctbal) AS valeur_max,
       CAST(sum(CAST(s_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS valeur_moyenne,
       count(CASE WHEN s_acctbal NOT BETWEEN 0 AND 9000 THEN 1 END) AS n_hors_plage FROM supplier""")
def profile_numeric(spark, folder):
    exact = table(spark, folder, "supplier").withColumn("solde", F.col("s_acctbal").cast("decimal(18,2)"))
    profile = profiling.numeric_profile(exact, "solde", 0, 9000)
    return profile.select("n", F.col("valeur_min").cast("double").alias("valeur_min"),
                          F.col("valeur_max").cast("double").alias("valeur_max"),
                          F.col("valeur_moyenne").cast("double").alias("valeur_moyenne"), "n_hors_plage")


@query("profile_code_lengths", """
SELECT CAST(length(text) AS INTEGER) AS longueur, count(*) AS n FROM documents GROUP BY 1""")
def profile_code_lengths(spark, folder):
    return table(spark, folder, "documents").groupBy(F.length("text").alias("longueur")).agg(F.count("*").alias("n"))


@query("profile_histograms", oracle("v_death", """
SELECT 'annee' AS axe, substr(date_deces, 1, 4) AS valeur, count(*) AS n FROM v_death GROUP BY 2
UNION ALL SELECT 'longueur_lieu', CAST(length(lieu) AS VARCHAR), count(*) FROM v_death GROUP BY 2
UNION ALL SELECT 'departement', substr(lieu, 1, 2), count(*) FROM v_death GROUP BY 2
UNION ALL SELECT 'sexe', sexe, count(*) FROM v_death GROUP BY 2"""))
def profile_histograms(spark, folder):
    return profiling.histograms(deaths(spark, folder), {
        "annee": F.substring("date_deces", 1, 4), "longueur_lieu": F.length("code_lieu_deces"),
        "departement": F.substring("code_lieu_deces", 1, 2), "sexe": F.col("sexe")})


@query("profile_deaths", oracle("v_death", """
SELECT count(*) AS lignes, min(CASE WHEN date_deces <> 'X' THEN date_deces END) AS date_min,
       max(CASE WHEN date_deces <> 'X' THEN date_deces END) AS date_max,
       count(CASE WHEN date_deces = 'X' THEN 1 END) AS n_date_non_conforme,
       count(CASE WHEN substr(lieu, 1, 2) IN ('97', '98') THEN 1 END) AS n_outre_mer FROM v_death"""))
def profile_deaths(spark, folder):
    valid = parse_iso(F.col("date_deces")).isNotNull()
    return deaths(spark, folder).agg(
        F.count("*").alias("lignes"), F.min(F.when(valid, F.col("date_deces"))).alias("date_min"),
        F.max(F.when(valid, F.col("date_deces"))).alias("date_max"),
        F.count_if(~valid).alias("n_date_non_conforme"),
        F.count_if(F.substring("code_lieu_deces", 1, 2).isin("97", "98")).alias("n_outre_mer"))


@query("mojibake_count", f"""
SELECT source, count(*) AS n_textes, count(CASE WHEN regexp_matches(text, '{MOJIBAKE_PATTERN}') THEN 1 END) AS n_mojibake
FROM (SELECT source, CASE WHEN doc_id % 9 = 0 THEN replace(text, 'é', 'Ã©') ELSE text END AS text FROM documents)
GROUP BY source""")
def mojibake_count(spark, folder):
    damaged = F.when(F.col("doc_id") % 9 == 0, F.replace("text", F.lit("é"), F.lit("Ã©"))).otherwise(F.col("text"))
    return (table(spark, folder, "documents").withColumn("text", damaged).groupBy("source")
            .agg(F.count("*").alias("n_textes"), F.count_if(has_mojibake(F.col("text"))).alias("n_mojibake")))


# Checks ----------------------------------------------------------------------------------
@query("dq_duplicate_keys", """
SELECT l_orderkey AS num_consultation, l_linenumber AS line_no, count(*) AS n
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicate_keys(spark, folder):
    return checks.repeated_keys(visits(spark, folder, with_code=False), list(VISIT_KEY))


@query("dq_surrogate_unique", oracle("v_death_ok", """
SELECT 'deces_key' AS controle, CAST(0 AS BIGINT) AS n_anomalies, count(*) AS n, CAST(1 AS BIGINT) AS cle_min,
       count(*) AS cle_max FROM v_death_ok"""))
def dq_surrogate_unique(spark, folder):
    fact = number_deaths(death_fact(spark, folder))
    bounds = fact.agg(F.count("*").alias("n"), F.min("deces_key").alias("cle_min"), F.max("deces_key").alias("cle_max"))
    excess = checks.check_unique(fact, ["deces_key"], "deces_key").select("n_anomalies").scalar()
    return bounds.select(F.lit("deces_key").alias("controle"), excess.alias("n_anomalies"), "n", "cle_min", "cle_max")


@query("dq_suite", oracle("v_stay_ok v_visit_ok v_death_ok v_survey_ok", """
SELECT 'sejour_pseudonyme' AS controle, count(CASE WHEN length(patient_id) <> 64 THEN 1 END) AS n_anomalies FROM v_stay_ok
UNION ALL SELECT 'sejour_duree_negative', count(CASE WHEN jours < 0 THEN 1 END) FROM v_stay_ok
UNION ALL SELECT 'consultation_pseudonyme', count(CASE WHEN length(patient_id) <> 64 THEN 1 END) FROM v_visit_ok
UNION ALL SELECT 'consultation_duree_negative', count(CASE WHEN duree_valide AND minutes < 0 THEN 1 END) FROM v_visit_ok
UNION ALL SELECT 'satisfaction_hors_plage', count(CASE WHEN note NOT BETWEEN 0 AND 10 THEN 1 END) FROM v_survey_ok
UNION ALL SELECT 'deces_age_inconnu', count(CASE WHEN tranche_age = 'Inconnu' THEN 1 END) FROM v_death_ok
UNION ALL SELECT 'satisfaction_doublons', count(*) - count(DISTINCT site) FROM v_survey_ok
UNION ALL SELECT 'consultation_doublons', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM v_visit_ok"""))
def dq_suite(spark, folder):
    stay, visit = stay_fact(spark, folder), visit_fact(spark, folder)
    survey, death = survey_fact(spark, folder), death_fact(spark, folder)
    for fact, internal in ((stay, ("num_hospitalisation",)), (visit, VISIT_KEY), (survey, ()),
                           (death, ("numero_acte_deces",))):
        checks.assert_no_columns(fact.drop(*internal), FORBIDDEN)
    return checks.stack([
        checks.check_rows(stay, {"sejour_pseudonyme": checks.bad_pseudonym("patient_id"),
                                 "sejour_duree_negative": F.col("duree_sejour") < 0}),
        checks.check_fact(visit, list(VISIT_KEY), "consultation_doublons", {
            "consultation_pseudonyme": checks.bad_pseudonym("patient_id"),
            "consultation_duree_negative": F.col("duree_minutes") < 0}),
        checks.check_fact(survey, ["etab_id", "date_id"], "satisfaction_doublons", {
            "satisfaction_hors_plage": checks.out_of_range("note_satisfaction", 0, 10)}),
        checks.check_rows(death, {"deces_age_inconnu": F.col("tranche_age") == "Inconnu"})])


@query("dq_unknown_share", oracle("v_death_ok", """
SELECT CAST(sum(CASE WHEN geo_id = 'INCONNU' THEN 1 ELSE 0 END) AS BIGINT) AS n_inconnu, count(*) AS total,
       CAST(round(100.0 * sum(CASE WHEN geo_id = 'INCONNU' THEN 1 ELSE 0 END) / count(*), 2) AS DOUBLE) AS pct_inconnu
FROM v_death_ok"""))
def dq_unknown_share(spark, folder):
    return checks.unknown_share(death_fact(spark, folder), "geo_id", UNKNOWN_GEO, F.col("nb_deces"))


@query("dq_reconcile", oracle("v_stay_reason v_stay_ok", """
SELECT bronze, charge, bronze - rejets - charge AS doublons, rejets, CAST(0 AS BIGINT) AS ecart FROM (
  SELECT (SELECT count(*) FROM v_stay_reason) AS bronze, (SELECT count(*) FROM v_stay_ok) AS charge,
         (SELECT count(*) FROM v_stay_reason WHERE raison_rejet IS NOT NULL) AS rejets)"""))
def dq_reconcile(spark, folder):
    """Source, rejects, duplicates and fact are each counted on their own, so a lost row shows.

    As in a load, the fact is made from the staged rows: the source is joined for them and for its own count.
    """
    classified = stage(classified_stays(spark, folder), "sejours-classes")
    fact = stage(shape_stays(accepted(classified), MASTER, SEED, STAY_TIE), "sejours-fait")
    return checks.reconcile_written(stays(spark, folder), classified, fact, STAY_KEY)


@query("dq_reconcile_stages", oracle("v_stay v_stay_ok", """
SELECT 'source' AS etape, count(*) AS n_lignes, count(DISTINCT id_patient) AS n_axe_1, count(DISTINCT id_site) AS n_axe_2
FROM v_stay UNION ALL
SELECT 'fait_hospitalisation', count(*), count(DISTINCT patient_id), count(DISTINCT id_site) FROM v_stay_ok"""))
def dq_reconcile_stages(spark, folder):
    return checks.reconcile_stages({
        "source": (stays(spark, folder), ["id_patient", "identifiant_organisation"]),
        "fait_hospitalisation": (stay_fact(spark, folder), ["patient_id", "etab_id"])})


@query("dq_gates", oracle("v_line", f"""
SELECT 'part_chargee_pct' AS seuil, v AS valeur, CAST(80 AS DOUBLE) AS borne, v >= 80 AS respecte FROM (
  SELECT CAST(round(100.0 * sum(CASE WHEN annee BETWEEN {FIRST_YEAR} AND {LAST_YEAR} THEN 1 ELSE 0 END) / count(*), 2)
              AS DOUBLE) AS v FROM v_line)
UNION ALL SELECT 'ecart_pct', 0, 5, TRUE"""))
def dq_gates(spark, folder):
    counts = checks.reconcile(classified_visits(spark, folder), [*VISIT_KEY, "part_no", "id_prof_sante"])
    metrics = counts.select(
        F.round(100.0 * (F.col("charge") + F.col("doublons")) / F.col("bronze"), 2).alias("part_chargee_pct"),
        F.round(100.0 * F.col("ecart") / F.col("bronze"), 2).alias("ecart_pct"))
    return checks.gates(metrics, {"part_chargee_pct": ("min", 80), "ecart_pct": ("max", 5)})


@query("fk_match_rate", oracle("v_death v_ref", """
SELECT dimension, n_resolus, total, CAST(round(100.0 * n_resolus / total, 2) AS DOUBLE) AS taux_pct FROM (
SELECT 'departement' AS dimension, CAST(count(code_departement) AS BIGINT) AS n_resolus, count(*) AS total
FROM v_death LEFT JOIN v_ref ON code_departement = substr(lieu, 1, 2)
UNION ALL SELECT 'document', CAST(count(l.doc_id) AS BIGINT), count(*) FROM documents d
LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id)"""))
def fk_match_rate(spark, folder):
    located = deaths(spark, folder).select(department_code(F.col("code_lieu_deces")).alias("departement"))
    return checks.stack([
        checks.match_rate(located, "departement", departments(spark, folder), "code_departement", "departement"),
        checks.match_rate(table(spark, folder, "documents"), "doc_id", table(spark, folder, "labels"), "doc_id",
                          "document")])


# Privacy ---------------------------------------------------------------------------------
@query("pseudonymise", f"""
SELECT c_custkey, {pseudonym_sql('CAST(c_custkey AS VARCHAR)')} AS patient_id FROM customer""")
def pseudonymise(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", pseudonym(F.col("c_custkey"), MASTER, SEED).alias("patient_id"))


@query("patient_mapping", f"""
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id_patient_original, {pseudonym_sql('CAST(o_custkey AS VARCHAR)')}
AS id_patient_pseudo, sha256(CAST(o_custkey AS VARCHAR) || '{SEED}') AS salt_patient FROM orders""")
def patient_mapping(spark, folder):
    return privacy.build_mapping(table(spark, folder, "orders"), "o_custkey", MASTER, SEED).drop("creation_date")


@query("mapping_join", f"""
SELECT o_orderkey, {pseudonym_sql('CAST(o_custkey AS VARCHAR)')} AS patient_id FROM orders""")
def mapping_join(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    mapping = privacy.build_mapping(table(spark, folder, "customer"), "c_custkey", MASTER, SEED)
    return privacy.attach_pseudonym(orders, "o_custkey", mapping)


@query("privacy_minimise", oracle("v_death", "SELECT sexe, date_deces, lieu AS code_lieu_deces FROM v_death"))
def privacy_minimise(spark, folder):
    return privacy.minimise(deaths(spark, folder), ["sexe", "date_deces", "code_lieu_deces"])


@query("round_month", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mois, count(*) AS n FROM orders GROUP BY 1""")
def round_month(spark, folder):
    return (table(spark, folder, "orders").groupBy(month_start(F.col("o_orderdate").cast("date")).alias("mois"))
            .agg(F.count("*").alias("n")))


@query("pii_scan", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{EMAIL_PATTERN}')) AS INTEGER) AS n_emails,
       CAST(len(regexp_extract_all(text, '{PHONE_PATTERN}')) AS INTEGER) AS n_telephones FROM documents""")
def pii_scan(spark, folder):
    return privacy.scan_text(table(spark, folder, "documents"), "doc_id", "text")


@query("role_view", oracle("v_death_ok", """
SELECT CAST(annee AS INTEGER) AS annee, sx AS sexe, count(*) AS nb_deces FROM v_death_ok WHERE geo_id = '02' GROUP BY 1, 2"""))
def role_view(spark, folder):
    return privacy.view_for_role(death_fact(spark, folder), "praticien", scope=F.col("geo_id") == "02",
                                 axes=["annee", "sexe"], measures={"nb_deces": F.sum("nb_deces")})


@query("erase_patient", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n, count(DISTINCT o_custkey) AS n_patients
FROM orders WHERE o_custkey % 100 <> 0 GROUP BY 1""")
def erase_patient(spark, folder):
    erased = table(spark, folder, "customer").filter("c_custkey % 100 = 0").select(
        F.col("c_custkey").alias("o_custkey"))
    left = privacy.erase(table(spark, folder, "orders"), "o_custkey", erased)
    return (left.groupBy(F.year("o_orderdate").alias("annee"))
            .agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_patients")))


@query("erase_touched_years", """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders WHERE o_custkey % 100 = 0""")
def erase_touched_years(spark, folder):
    erased = table(spark, folder, "customer").filter("c_custkey % 100 = 0").select(
        F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("annee"))
    return privacy.touched_partitions(orders, "o_custkey", erased, "annee")
