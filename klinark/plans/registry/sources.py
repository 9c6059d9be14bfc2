"""Queries that write the given tables as files and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from klinark.operators.buckets import SALT, bucket_skew, hot_keys, join_salted, salted, write_salted
from klinark.operators.checks import reconcile
from klinark.operators.layout import (
    partition_counts, value_skew, write_partitions, write_table,
)
from klinark.operators.rows import classify, shift_years
from klinark.plans.facts import STAY_KEY, clean_deaths, number_deaths, stay_rules
from klinark.plans.files import TextFile, count_lines, line_rules, read_stays
from klinark.plans.registry.base import query
from klinark.plans.registry.views import oracle
from klinark.plans.standins import (
    FIRST_YEAR, LAST_YEAR, YEAR, deaths, departments, stays, table, visits,
)
from klinark.schemas import BUCKET_KEYS, BUCKETS, CORRUPT, RAW_STAYS, text_schema
from klinark.session import stage, staging_path
from klinark.sources.delimited import (
    malformed_reason, read_delimited, union_campaigns, write_text_export,
)
from klinark.sources.files import profile_files

ORDER_TEXT = text_schema("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query("csv_quarantine", """
SELECT motif, count(*) AS n, CAST(sum(CASE WHEN motif = 'OK' THEN o_custkey END) AS BIGINT) AS somme_cle
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'LIGNE_COURTE'
                             WHEN o_orderkey % 89 = 0 THEN 'LIGNE_LONGUE' ELSE 'OK' END AS motif FROM orders)
GROUP BY motif""")
def csv_quarantine(spark, folder):
    path = staging_path(spark, "orders-text")
    orders = table(spark, folder, "orders")
    first = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    last = F.col("o_orderpriority")
    line = (F.when(F.col("o_orderkey") % 97 == 0, first)
            .when(F.col("o_orderkey") % 89 == 0, F.concat_ws(",", first, last, F.lit("en trop")))
            .otherwise(F.concat_ws(",", first, last)))
    orders.select(line).write.text(path)
    read = read_delimited(spark, path, ORDER_TEXT, header=False)
    motif = F.coalesce(malformed_reason(ORDER_TEXT, ","), F.lit("OK"))
    key = F.when(F.col(CORRUPT).isNull(), F.col("o_custkey").try_cast("long"))
    return (read.select(motif.alias("motif"), key.alias("cle")).groupBy("motif")
            .agg(F.count("*").alias("n"), F.sum("cle").alias("somme_cle")))


@query("campaign_year_from_path", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS somme_cle
FROM orders GROUP BY 1""")
def campaign_year_from_path(spark, folder):
    path = staging_path(spark, "campaigns")
    (table(spark, folder, "orders").withColumn("annee", F.year("o_orderdate"))
     .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "annee")
     .write.partitionBy("annee").options(header=True, sep=";").csv(path))
    return (read_delimited(spark, path, ORDER_TEXT, sep=";").groupBy("annee")
            .agg(F.count("*").alias("n"), F.sum(F.col("o_custkey").try_cast("long")).alias("somme_cle")))


def text_lines(spark, folder):
    """Documents cut into lines, so that no field holds a line break."""
    return (table(spark, folder, "documents")
            .select("doc_id", F.posexplode(F.split("text", "\n")).alias("ligne_no", "ligne")))


@query("file_profile", """
SELECT 'clients' AS dossier, 'utf-8' AS encodage, '|' AS separateur, CAST(3 AS INTEGER) AS n_colonnes,
       count(*) AS n_lignes FROM customer
UNION ALL SELECT 'commandes', 'utf-8', ',', 4, count(*) FROM orders
UNION ALL SELECT 'textes', 'latin-1', ';', 3, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) FROM documents""")
def file_profile(spark, folder):
    path = staging_path(spark, "files")
    write_text_export(table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), f"{path}/commandes")
    write_text_export(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                      f"{path}/clients", sep="|")
    write_text_export(text_lines(spark, folder), f"{path}/textes", sep=";", encoding="ISO-8859-1")
    return (profile_files(spark, path)
            .groupBy(F.regexp_extract("file", "/([a-z]+)/[^/]+$", 1).alias("dossier"))
            .agg(F.min("encoding").alias("encodage"), F.max("separator").alias("separateur"),
                 F.max("n_columns").alias("n_colonnes"), F.sum("n_rows").alias("n_lignes")))


@query("schema_drift_union", """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer""")
def schema_drift_union(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    names = customers.columns
    without_balance = customers.filter("c_mktsegment = 'BUILDING'").drop("c_acctbal")
    other_header = (customers.filter("c_mktsegment = 'MACHINERY'")
                    .withColumn("nb_c_acctbal", F.lit(0))
                    .select("nb_c_acctbal", F.col("c_mktsegment").alias(" C_MKTSEGMENT "),
                            F.col("c_acctbal").alias("c_acctbal_ajust"), "c_name", "c_custkey"))
    same = customers.filter("c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_mktsegment IS NULL")
    return union_campaigns([same, without_balance, other_header], names).select(*names)


@query("encoding_roundtrip", """
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS ligne_no, ligne
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS ligne, generate_subscripts(string_split(text, chr(10)), 1) AS pos
      FROM documents)""")
def encoding_roundtrip(spark, folder):
    path = staging_path(spark, "cp1252")
    write_text_export(text_lines(spark, folder), path, sep=";", encoding="windows-1252")
    read = read_delimited(spark, path, text_schema("doc_id", "ligne_no", "ligne"), sep=";",
                          encoding="windows-1252")
    return read.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("ligne_no").cast("int").alias("ligne_no"),
                       F.coalesce("ligne", F.lit("")).alias("ligne"))


@query("dynamic_partition_overwrite", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n FROM orders
WHERE year(o_orderdate) <> {YEAR} OR o_orderstatus = 'F' GROUP BY 1""")
def dynamic_partition_overwrite(spark, folder):
    path = staging_path(spark, "orders-by-year")
    orders = (table(spark, folder, "orders").withColumn("annee", F.year("o_orderdate"))
              .select("o_orderkey", "o_orderstatus", "annee"))
    write_partitions(orders, path, ["annee"])
    write_partitions(orders.filter((F.col("annee") == YEAR) & (F.col("o_orderstatus") == "F")), path, ["annee"])
    return partition_counts(spark.read.parquet(path), "annee")


@query("layout_flat_vs_partitioned", oracle("v_line", """
SELECT disposition, annee, n, minutes FROM (
  SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n,
         CAST(sum(CASE WHEN duree_valide THEN minutes END) AS DOUBLE) AS minutes FROM v_line GROUP BY 1),
(SELECT unnest(['a_plat', 'partitions', 'partitions_buckets']) AS disposition)"""))
def layout_flat_vs_partitioned(spark, folder):
    fact = visits(spark, folder, with_code=False).select("id_prof_sante", "nb_consultation", "duree_minutes", "annee")
    root = staging_path(spark, "layouts")
    suffix = root.rsplit("-", 1)[1]
    fact.write.parquet(f"{root}/flat")
    flat = spark.read.parquet(f"{root}/flat")
    write_partitions(flat, f"{root}/by_year", ["annee"])
    write_table(flat, f"visites_{suffix}", f"{root}/by_year_bucket", ("annee",), ("id_prof_sante",))
    layouts = {"a_plat": flat, "partitions": spark.read.parquet(f"{root}/by_year"),
               "partitions_buckets": spark.table(f"visites_{suffix}")}
    frames = [df.groupBy("annee").agg(F.sum("nb_consultation").alias("n"), F.sum("duree_minutes").alias("minutes"))
              .select(F.lit(name).alias("disposition"), "annee", "n", "minutes") for name, df in layouts.items()]
    return frames[0].unionAll(frames[1]).unionAll(frames[2])


def bucketed_pair(spark, folder):
    """Order lines and suppliers, both bucketed on the supplier."""
    root = staging_path(spark, "buckets")
    suffix = root.rsplit("-", 1)[1]
    write_table(table(spark, folder, "lineitem").select("l_suppkey", "l_quantity"),
                f"lignes_{suffix}", f"{root}/lines", bucket_by=("l_suppkey",))
    write_table(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"),
                f"fournisseurs_{suffix}", f"{root}/suppliers", bucket_by=("l_suppkey",))
    return spark.table(f"lignes_{suffix}"), spark.table(f"fournisseurs_{suffix}")


@query("layout_bucketed_join", """
SELECT l_suppkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantite
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def layout_bucketed_join(spark, folder):
    lines, suppliers = bucketed_pair(spark, folder)
    return (lines.join(suppliers, "l_suppkey").groupBy("l_suppkey")
            .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantite")))


@query("layout_salted_join", """
SELECT l_suppkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantite
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey, l_quantity FROM lineitem)
JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def layout_salted_join(spark, folder):
    """A third of all lines on one supplier: its rows are spread over buckets and joined where they lie."""
    root = staging_path(spark, "salted")
    name = f"lignes_{root.rsplit('-', 1)[1]}"
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_suppkey"))
    lines = table(spark, folder, "lineitem").select(key.alias("l_suppkey"), "l_orderkey", "l_linenumber", "l_quantity")
    write_salted(lines, name, "l_suppkey", ["l_orderkey", "l_linenumber"], BUCKETS, root)
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return (join_salted(spark, name, suppliers, "l_suppkey").groupBy("l_suppkey")
            .agg(F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("quantite")))


@query("bucket_layout_skew")
def bucket_layout_skew(spark, folder):
    """Rows per bucket of the deaths, bucketed on the region alone, on the declared columns, and with cut hot regions."""
    fact = stage(clean_deaths(deaths(spark, folder), departments(spark, folder), FIRST_YEAR), "deces-seaux")
    cut = salted(fact, "geo_id", hot_keys(fact, "geo_id", BUCKETS), ["numero_acte_deces"])
    return (bucket_skew(fact, ["geo_id"], BUCKETS, "geo_id")
            .unionAll(bucket_skew(fact, list(BUCKET_KEYS["fait_deces"]), BUCKETS, "geo_id+sexe+tranche_age"))
            .unionAll(bucket_skew(cut, ["geo_id", SALT], BUCKETS, "geo_id+sel")))


@query("files_to_facts", oracle("v_stay_reason", """
SELECT issue, n FROM (WITH r AS (SELECT *, CASE WHEN CAST(num_stay AS BIGINT) % 83 = 0 THEN 'LIGNE_COURTE'
    WHEN CAST(num_stay AS BIGINT) % 79 = 0 THEN 'LIGNE_LONGUE' ELSE raison_rejet END AS raison FROM v_stay_reason),
  c AS (SELECT count(*) AS n, count(DISTINCT (id_patient, num_stay, date_entree)) AS k FROM r WHERE raison IS NULL)
SELECT raison AS issue, count(*) AS n FROM r WHERE raison IS NOT NULL GROUP BY 1
UNION ALL SELECT 'CHARGE', k FROM c UNION ALL SELECT 'DOUBLON', n - k FROM c
UNION ALL SELECT 'LIGNES_LUES', count(*) FROM r)"""))
def files_to_facts(spark, folder):
    """Hospital stays written as a file with broken lines: every line of it ends as fact, duplicate or reject."""
    path = staging_path(spark, "sejours")
    raw = stays(spark, folder)
    fields = [F.coalesce(F.col(c) if c in raw.columns else F.lit(""), F.lit("")) for c in RAW_STAYS.fieldNames()]
    number = F.col("num_hospitalisation").cast("long")
    line = (F.when(number % 83 == 0, F.concat_ws(";", *fields[:3]))
            .when(number % 79 == 0, F.concat_ws(";", *fields, F.lit("en trop"))).otherwise(F.concat_ws(";", *fields)))
    # the CSV writer puts the name of the column, the header, at the top of each file; no character is quoted
    (raw.select(line.alias(";".join(RAW_STAYS.fieldNames())))
     .write.options(header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))
    file = TextFile(path)
    source = read_stays(spark, file)
    staged = stage(classify(source, line_rules(source) + stay_rules(FIRST_YEAR, LAST_YEAR)), "sejours-lus")
    per_reason = staged.filter("raison_rejet IS NOT NULL").groupBy(F.col("raison_rejet").alias("issue")).agg(F.count("*").alias("n"))
    counts = reconcile(staged, STAY_KEY).select(F.explode(F.create_map(
        F.lit("CHARGE"), "charge", F.lit("DOUBLON"), "doublons")).alias("issue", "n"))
    lines = spark.createDataFrame([("LIGNES_LUES", count_lines(spark, file))], "issue string, n long")
    return per_reason.unionAll(counts).unionAll(lines)


@query("partition_row_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n FROM orders GROUP BY 1""")
def partition_row_counts(spark, folder):
    return partition_counts(table(spark, folder, "orders").select(F.year("o_orderdate").alias("annee")), "annee")


@query("bucket_skew", oracle("v_death_ok", """
SELECT 'geo_id' AS cles, count(*) AS n_valeurs, max(n) AS n_max, min(n) AS n_min,
       round(CAST(max(n) AS DOUBLE) / min(n), 2) AS rapport FROM (SELECT count(*) AS n FROM v_death_ok GROUP BY geo_id)
UNION ALL SELECT 'geo_id+sexe+tranche_age', count(*), max(n), min(n), round(CAST(max(n) AS DOUBLE) / min(n), 2)
FROM (SELECT count(*) AS n FROM v_death_ok GROUP BY geo_id, sx, tranche_age)"""))
def bucket_skew_report(spark, folder):
    fact = clean_deaths(deaths(spark, folder), departments(spark, folder), FIRST_YEAR)
    return value_skew(fact, ["geo_id"]).unionAll(value_skew(fact, ["geo_id", "sexe", "tranche_age"]))


@query("shift_replicate", oracle("v_death_ok", """
SELECT deces_key + CAST(k AS BIGINT) * 1000000000000 AS deces_key,
       CAST(date_id - k * 10000 - CASE WHEN date_id % 10000 = 229 AND (annee - k) % 4 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS date_id,
       CAST(annee - k AS INTEGER) AS annee, geo_id
FROM (SELECT *, row_number() OVER (ORDER BY date_deces, lieu, acte) AS deces_key FROM v_death_ok),
     (SELECT unnest([0, 1, 2, 3, 4]) AS k)"""))
def shift_replicate(spark, folder):
    fact = number_deaths(clean_deaths(deaths(spark, folder), departments(spark, folder), FIRST_YEAR))
    return (shift_years(fact, 5, "deces_key", "date_id", "annee")
            .select("deces_key", "date_id", "annee", "geo_id"))
