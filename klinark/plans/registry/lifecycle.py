"""What happens to tables over time: reloads, increments, erasure, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.functions.privacy import canonical_id, pseudonym
from klinark.operators.keymap import digest, stable_keys
from klinark.operators.layout import write_fact, write_partitions
from klinark.operators.privacy import build_mapping
from klinark.operators.rows import accepted, classify
from klinark.plans.erasure import Target, erase_from
from klinark.plans.facts import shape_stays, stay_rules, type_stays
from klinark.plans.registry.base import query
from klinark.plans.registry.quality import numbered_stays, stay_fact
from klinark.plans.registry.views import oracle
from klinark.plans.standins import FIRST_YEAR, LAST_YEAR, MASTER, SEED, STAY_TIE, YEAR, patients, stays
from klinark.schemas import BUCKET_KEYS, BUCKETS
from klinark.session import stage, staging_path
from klinark.streaming.incremental import incremental_load
from klinark.streaming.keyindex import KeyIndex

ERASED = "id_patient % 20 = 0"


@query("erase_rewrites_tables", oracle("v_stay_ok v_patient", """
SELECT 'fait_hospitalisation' AS cible, CAST(annee AS INTEGER) AS annee, count(*) AS n, count(DISTINCT id_patient) AS n_patients
FROM v_stay_ok WHERE CAST(id_patient AS BIGINT) % 20 <> 0 GROUP BY 2
UNION ALL SELECT 'mapping', NULL, count(*), count(DISTINCT id_patient) FROM v_patient WHERE CAST(id_patient AS BIGINT) % 20 <> 0"""))
def erase_rewrites_tables(spark, folder):
    """Stays by year and the mapping, written, then read again after one patient in twenty was erased from them."""
    root = staging_path(spark, "effacement-tables")
    name = f"sejours_{root.rsplit('-', 1)[1]}"
    write_fact(numbered_stays(spark, folder), name, BUCKET_KEYS["fait_hospitalisation"], BUCKETS, f"{root}/sejours",
               lying=True)  # numbered by day
    mapping = build_mapping(patients(spark, folder), "id_patient", MASTER, SEED)
    write_partitions(mapping.withColumn("prefixe", F.substring("id_patient_pseudo", 1, 1)), f"{root}/mapping", ["prefixe"])
    known = patients(spark, folder).filter(ERASED).select(canonical_id(F.col("id_patient")).alias("personne"))
    secret = known.select(pseudonym(F.col("personne"), MASTER, SEED).alias("personne"))
    fact = Target(name, "table", ("annee",), F.col("patient_id"), BUCKET_KEYS["fait_hospitalisation"], BUCKETS)
    erase_from(spark, [fact], secret, f"{root}/journal")
    erase_from(spark, [Target(f"{root}/mapping", "dossier", ("prefixe",), F.col("id_patient_original"))], known, f"{root}/journal")
    left = (spark.table(name).groupBy("annee").agg(F.count("*").alias("n"), F.count_distinct(F.unhex("patient_id")).alias("n_patients"))
            .select(F.lit("fait_hospitalisation").alias("cible"), "annee", "n", "n_patients"))
    kept = (spark.read.parquet(f"{root}/mapping").agg(F.count("*").alias("n"), F.count_distinct("id_patient_original").alias("n_patients"))
            .select(F.lit("mapping").alias("cible"), F.lit(None).cast("int").alias("annee"), "n", "n_patients"))
    return left.unionAll(kept)


@query("stable_surrogates", oracle("v_stay_ok", f"""
SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n, count(*) AS n_cles,
       CAST(sum(CASE WHEN annee <= {YEAR} THEN 1 ELSE 0 END) AS BIGINT) AS n_gardees FROM v_stay_ok GROUP BY 1"""))
def stable_surrogates(spark, folder):
    """Stays loaded up to a year, then all of them: earlier rows keep their surrogate key, all keys differ."""
    table = f"cles_{staging_path(spark, 'cles').rsplit('-', 1)[1]}"
    natural = ["patient_id", "num_hospitalisation", "date_id", "annee"]
    # the day of admission is in `date_id`; its text is not part of the fact
    fact = stage(stay_fact(spark, folder).drop("date_entree", "date_entree_typee"), "sejours-cles", compression="zstd")
    first = stable_keys(fact.filter(F.col("annee") <= YEAR), "hosp_key", natural, table, hexadecimal=("patient_id",))
    again = stable_keys(fact, "hosp_key", natural, table, hexadecimal=("patient_id",))
    stay = F.substring(digest(natural), 1, 16).alias("_sejour")  # 128 bits tell stays apart; equal ones then compare keys
    before = first.select(stay, F.col("hosp_key").alias("_avant"))
    return (again.select("annee", "hosp_key", stay).join(before, "_sejour", "left").groupBy("annee")
            .agg(F.count("*").alias("n"), F.count_distinct("hosp_key").alias("n_cles"),
                 F.count_if(F.col("_avant") == F.col("hosp_key")).alias("n_gardees")))


@query("incremental_with_index", oracle("v_stay_ok v_stay_reason", """
SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n, CAST(sum(jours) AS BIGINT) AS jours FROM v_stay_ok GROUP BY 1
UNION ALL SELECT NULL, count(*), NULL FROM v_stay_reason WHERE raison_rejet IS NOT NULL"""))
def incremental_with_index(spark, folder):
    """Stays that arrive in three files, one of them twice: loaded rows per year, and rejects, are those of one batch load."""
    raw, root = stage(stays(spark, folder), "sejours-recus"), staging_path(spark, "increments")  # joined once for all files
    part, rules = F.pmod(F.hash("num_hospitalisation"), F.lit(3)), stay_rules(FIRST_YEAR, LAST_YEAR)
    # the file that comes again holds valid rows only, so that no reject is counted twice
    again = accepted(classify(type_stays(raw), rules)).select(raw.columns).filter(part == 1)
    for file in (*[raw.filter(part == number) for number in range(3)], again):
        file.write.mode("append").parquet(f"{root}/arrivees")
        incremental_load(spark, f"{root}/arrivees", raw.schema, root, rules, type_stays,
                         lambda valid: shape_stays(valid, MASTER, SEED, STAY_TIE),
                         ["patient_id", "num_hospitalisation", "date_entree"], index=KeyIndex(f"{root}/index", 8, 2))
    loaded = spark.read.parquet(f"{root}/valides").groupBy("annee").agg(
        F.count("*").alias("n"), F.sum("duree_sejour").cast("long").alias("jours"))
    refused = spark.read.parquet(f"{root}/rejets").agg(F.count("*").alias("n"))
    return loaded.unionAll(refused.select(F.lit(None).cast("int").alias("annee"), "n", F.lit(None).cast("long").alias("jours")))
