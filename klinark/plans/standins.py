"""Health sources derived from the order tables, so that every job runs on given data.

Orders stand for deaths, order lines for consultations and hospital stays, customers
for patients, suppliers for professionals and establishments, parts for diagnoses and
nations for departments. Defects (missing keys, impossible dates, negative lengths,
unreadable marks) are placed by rules on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.functions.values import duration_minutes, in_year, local_seconds
from klinark.operators.layout import deal

FIRST_YEAR, LAST_YEAR = 1996, 2000
YEAR = 1999
DEALT_FROM = 2_000_000  # fixed value: order lines
MASTER, SEED = "cle-de-demonstration", "graine-de-demonstration"
VISIT_KEY = ("num_consultation", "line_no")
VISIT_ORDER = ("t_end", "part_no", "id_prof_sante")
STAY_TIE = ("line_no", "part_no", "identifiant_organisation")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _two_digits(number):
    return F.lpad(number.cast("string"), 2, "0")


def departments(spark, folder) -> DataFrame:
    """Department reference: one code covers five territories."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    overseas = F.col("n_nationkey") >= 20
    return (nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"))
            .select(_two_digits(F.col("n_nationkey")).alias("code_departement"),
                    F.when(overseas, "00").otherwise(_two_digits(F.col("r_regionkey") + 1)).alias("code_region"),
                    F.when(overseas, F.col("n_name")).otherwise(F.col("r_name")).alias("nom_region")))


def _diagnosis_code():
    return F.when(F.col("l_partkey") % 50 == 0, "").otherwise(F.col("p_type"))


def _lines(spark, folder, with_part: bool, year: int | None) -> DataFrame:
    orders = table(spark, folder, "orders")
    if year is not None:
        orders = orders.filter(in_year(F.col("o_orderdate"), year))
    lines = table(spark, folder, "lineitem")
    rows = lines.count()  # from the footers of the files
    if rows > DEALT_FROM:  # fewer rows can meet broadcast orders instead
        lines, orders = deal(lines, rows, "l_orderkey"), deal(orders, rows, "o_orderkey")
    lines = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    if with_part:
        lines = lines.join(table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return lines


def visits(spark, folder, with_code: bool = True, year: int | None = None) -> DataFrame:
    """Consultations; the diagnosis code costs a join and is left out when not needed."""
    code = [_diagnosis_code().alias("code_diag")] if with_code else []
    return (_lines(spark, folder, with_code, year)
            .select(F.col("l_orderkey").alias("num_consultation"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("part_no"), F.col("l_suppkey").alias("id_prof_sante"),
                    F.col("o_custkey").alias("id_patient"), *code,
                    F.col("o_orderdate").cast("date").alias("jour"),
                    F.col("o_orderdate").alias("t_start"), F.col("l_shipdate").alias("t_end"))
            .withColumn("annee", F.year("jour"))
            .withColumn("nb_consultation", F.lit(1))
            .withColumn("duree_minutes",
                        duration_minutes(local_seconds(F.col("t_start"), F.col("t_end")))))


def stays(spark, folder) -> DataFrame:
    """Raw hospital stays: all text, with missing keys, bad dates and negative lengths."""
    text = lambda name: F.col(name).cast("string")
    date_text = F.date_format("l_shipdate", "dd/MM/yyyy")
    days = F.when(F.col("l_partkey") % 89 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return (_lines(spark, folder, True, None)
            .select(text("l_orderkey").alias("num_hospitalisation"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("part_no"),
                    F.when(F.col("o_custkey") % 61 != 0, text("o_custkey")).alias("id_patient"),
                    F.when(F.col("l_suppkey") % 40 != 0, text("l_suppkey")).alias("identifiant_organisation"),
                    _diagnosis_code().alias("code_diagnostic"),
                    F.when(F.col("l_orderkey") % 97 == 0, "32/13/1999").otherwise(date_text).alias("date_entree"),
                    days.cast("int").cast("string").alias("jour_hospitalisation")))


def deaths(spark, folder, year: int | None = None) -> DataFrame:
    """Raw deaths: missing birth dates, malformed dates, unresolved places."""
    orders = table(spark, folder, "orders")
    if year is not None:
        orders = orders.filter(in_year(F.col("o_orderdate"), year))
    customers = table(spark, folder, "customer")
    birth_year = F.year("o_orderdate") - F.col("o_custkey") % 130
    status = F.col("o_orderstatus")
    return (orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
            .select(F.col("o_orderkey").cast("string").alias("numero_acte_deces"),
                    F.when(status == "F", "1").when(status == "O", "2").otherwise("9").alias("sexe"),
                    F.when(F.col("o_custkey") % 53 != 0,
                           F.concat(birth_year.cast("string"), F.lit("-01-01"))).alias("date_naissance"),
                    F.when(F.col("o_orderkey") % 101 == 0, "X")
                    .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date_deces"),
                    F.when(F.col("o_orderkey") % 71 == 0, "99001")
                    .otherwise(F.concat(_two_digits(F.col("c_nationkey")), F.lit("001"))).alias("code_lieu_deces")))


def surveys(spark, folder) -> DataFrame:
    """Raw satisfaction survey: blank and unreadable scores, two spellings of regions."""
    located = (table(spark, folder, "supplier")
               .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
               .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey")))
    other_spelling = F.replace(F.lower("r_name"), F.lit(" "), F.lit("-"))
    score = F.concat(F.floor(F.col("s_acctbal") / 100).cast("int").cast("string"), F.lit(",5"))
    return located.select(
        F.col("s_suppkey").cast("string").alias("finess_geo"), F.col("s_name").alias("rs_finess_geo"),
        F.col("r_name").alias("region_officielle"),
        F.when(F.col("s_suppkey") % 3 == 0, other_spelling).otherwise(F.col("r_name")).alias("region"),
        F.when(F.col("s_suppkey") % 7 == 0, "").when(F.col("s_suppkey") % 31 == 0, "n/a")
        .otherwise(score).alias("score_all_rea_ajust"))


CAMPAIGNS = (1997, 1998, 1999)
WIDE_CAMPAIGNS = (1998, 1999)


def campaign_scores(spark, folder) -> DataFrame:
    """Scores of the sites that shipped orders of a campaign year, made from the lines of that year."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("annee"))
    sums = (table(spark, folder, "lineitem").join(orders.filter(F.col("annee").isin(*CAMPAIGNS)), F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("annee", F.col("l_suppkey").alias("site"))
            .agg(F.sum("l_quantity").cast("long").alias("q"), F.count("*").alias("n")))
    return sums.select("annee", "site", F.when(F.col("site") % 9 == 0, "").when(F.col("site") % 37 == 0, "n/a")
                       .otherwise(F.concat((F.col("q") % 104).cast("string"), F.lit(",5"))).alias("score"), "q", "n")


def survey_files(spark, folder, path: str) -> str:
    """Survey files of three campaigns: 23 columns in one year, 25 in the others, sub-scores by position."""
    from klinark.functions.fixed_values import SUB_SCORES
    from klinark.sources.delimited import write_text_export
    sites = surveys(spark, folder).select(F.col("finess_geo").cast("long").alias("site"), "rs_finess_geo", "region")
    rows = campaign_scores(spark, folder).join(sites, "site")
    places = {at: ((F.col("q") * (rank + 3) + F.col("site")) % 107).cast("string")
              for rank, at in enumerate(SUB_SCORES.values())}
    names = {0: "finess", 1: "rs_finess", 2: "finess_geo", 3: "rs_finess_geo", 4: "region", 5: "participation",
             6: "depot", 7: "nb_rep_score_all", 8: "score_all_rea_ajust"}
    values = {0: F.concat(F.lit("E"), F.col("site")), 2: F.col("site").cast("string"), 3: F.col("rs_finess_geo"),
              4: F.col("region"), 7: F.col("n").cast("string"), 8: F.col("score"), **places}
    fields = [values.get(at, F.lit("")).alias(names.get(at, f"s{at}")) for at in range(23)]
    extra = [F.lit("81").alias("taux_reco_brut"), F.col("n").cast("string").alias("nb_reco_brut")]
    for year in CAMPAIGNS:
        own = rows.filter(F.col("annee") == year).select(*fields, *(extra if year in WIDE_CAMPAIGNS else []))
        write_text_export(own, f"{path}/annee={year}", sep=";")
    return path


def patients(spark, folder) -> DataFrame:
    """Patients with sex and age as text, and the region of residence."""
    segment = F.col("c_mktsegment")
    return (table(spark, folder, "customer")
            .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select(F.col("c_custkey").cast("string").alias("id_patient"),
                    F.when(segment.isin("BUILDING", "MACHINERY"), "male")
                    .when(segment.isin("HOUSEHOLD", "FURNITURE"), "Female").alias("sexe"),
                    F.when(F.col("c_custkey") % 41 == 0, "x")
                    .otherwise((F.col("c_custkey") % 127).cast("string")).alias("age"),
                    F.col("r_name").alias("region_residence")))


def professionals(spark, folder) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("identifiant"),
        F.when(F.col("s_suppkey") % 2 == 0, "Médecin").otherwise("Infirmier").alias("categorie_professionnelle"),
        F.col("s_nationkey").cast("string").alias("code_specialite"))


def specialties(spark, folder) -> DataFrame:
    """Specialty labels."""
    return (table(spark, folder, "nation")
            .select(F.col("n_nationkey").cast("string").alias("code_specialite"),
                    F.col("n_name").alias("specialite")))


def sites(spark, folder) -> DataFrame:
    """Establishments with their region and country."""
    return (table(spark, folder, "supplier")
            .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
            .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select(F.col("s_suppkey").cast("string").alias("etab_id"), F.col("r_name").alias("region"),
                    F.col("n_name").alias("pays")))


def load_inputs(spark, folder, root: str, batch: str = "lot-1"):
    """Sources and settings of a complete load over the stand-ins."""
    from klinark.plans.facts import type_stays, type_surveys
    from klinark.plans.warehouse import Settings, Sources
    sources = Sources(
        consultations=visits(spark, folder), stays=type_stays(stays(spark, folder)),
        surveys=type_surveys(surveys(spark, folder)), deaths=deaths(spark, folder),
        departments=departments(spark, folder), patients=patients(spark, folder),
        professionals=professionals(spark, folder), specialties=specialties(spark, folder))
    settings = Settings(
        root=root, master=MASTER, seed=SEED, first_year=FIRST_YEAR, last_year=LAST_YEAR,
        first_death_year=FIRST_YEAR, campaign=YEAR, batch=batch, consultation_key=VISIT_KEY,
        consultation_order=VISIT_ORDER, stay_order=STAY_TIE)
    return sources, settings
