"""Dashboard cubes and the cross-filtered views read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.functions.bands import band_of_age
from klinark.functions.codes import icd_chapter, sex_code, standard_region
from klinark.functions.fixed_values import (
    ABROAD_LABEL, ICD_CHAPTERS, ICD_CHAPTERS_SHORT, OTHER_LABEL, UNKNOWN_BAND, UNKNOWN_GEO,
    UNKNOWN_SEX,
)
from klinark.functions.values import decimal_comma, whole_percent
from klinark.operators.joins import lookup
from klinark.operators.rankings import first_by, last_by, lump_other, year_on_year

ALL_REGIONS = "FRANCE"


def cube(df: DataFrame, dims: list[str]) -> DataFrame:
    """Number of rows per combination of dimension values."""
    return df.groupBy(*dims).agg(F.count("*").alias("n"))


def deaths_cube(deaths: DataFrame, geography: DataFrame) -> DataFrame:
    """Deaths per year, region name, sex and age band."""
    per_key = deaths.groupBy("annee", "geo_id", "sexe", "tranche_age").agg(F.sum("nb_deces").alias("n"))
    named = per_key.join(geography.select("geo_id", "region"), "geo_id", "left")
    region = F.when(F.col("geo_id") == UNKNOWN_GEO, ABROAD_LABEL).otherwise(
        F.coalesce("region", F.lit(ABROAD_LABEL)))
    return (named.withColumn("region", region).groupBy("annee", "region", "sexe", "tranche_age")
            .agg(F.sum("n").cast("long").alias("n")))


def stays_cube(stays: DataFrame, patients: DataFrame) -> DataFrame:
    """Stays per admission year, chapter, sex and age band.

    `stays` has annee, id_patient and code_diag; `patients` has id_patient, sexe and
    age. Stays of unknown patients are counted under unknown sex and band.
    """
    per_patient = (stays.withColumn("chapitre", icd_chapter(F.col("code_diag"), ICD_CHAPTERS))
                   .groupBy("annee", "chapitre", "id_patient").agg(F.count("*").alias("n")))
    known = patients.select("id_patient", sex_code(F.col("sexe")).alias("sexe"),
                            band_of_age(F.col("age").try_cast("int")).alias("tranche_age"))
    return (per_patient.join(known, "id_patient", "left")
            .withColumn("sexe", F.coalesce("sexe", F.lit(UNKNOWN_SEX)))
            .withColumn("tranche_age", F.coalesce("tranche_age", F.lit(UNKNOWN_BAND)))
            .groupBy("annee", "chapitre", "sexe", "tranche_age").agg(F.sum("n").cast("long").alias("n")))


def consultations_cube(visits: DataFrame, specialties: DataFrame, patients: DataFrame,
                       kept: int = 12) -> DataFrame:
    """Consultations per year, specialty (most frequent ones), sex and chapter.

    `visits` has annee, id_prof, id_patient and code_diag; `specialties` maps id_prof
    to specialite. Visits without a specialty count under INCONNU, those of unknown patients
    under unknown sex. The chapter is derived before grouping, so that letters sharing a
    chapter form one row.
    """
    labelled = lookup(visits, specialties, "id_prof", "left").withColumns({
        "specialite": F.coalesce("specialite", F.lit(UNKNOWN_GEO)),
        "chapitre": icd_chapter(F.col("code_diag"), ICD_CHAPTERS_SHORT)})
    by_specialty = (labelled.groupBy("annee", "specialite", "id_patient", "chapitre")
                    .agg(F.count("*").alias("n")))
    sexes = patients.select("id_patient", sex_code(F.col("sexe")).alias("sexe"))
    named = (by_specialty.join(sexes, "id_patient", "left")
             .withColumn("sexe", F.coalesce("sexe", F.lit(UNKNOWN_SEX))).groupBy("annee", "specialite", "sexe", "chapitre")
             .agg(F.sum("n").alias("n")))
    return (lump_other(named, "specialite", kept, weight="n")
            .groupBy("annee", "specialite", "sexe", "chapitre").agg(F.sum("n").cast("long").alias("n")))


def matches(state: dict[str, object], except_dim: str | None = None) -> Column:
    """Rows selected by all filters but the one on `except_dim`."""
    condition = F.lit(True)
    for dim, value in state.items():
        if value is not None and dim != except_dim:
            condition = condition & (F.col(dim) == value)
    return condition


def cross_filter(cube_df: DataFrame, dims: list[str], state: dict[str, object]) -> DataFrame:
    """Every visual at once: sums per value of each dimension, filtered by the others.

    The cube is read once; each row is sent to the visuals whose filters it passes.
    """
    entries = F.array(*[F.struct(F.lit(dim).alias("visuel"), F.col(dim).cast("string").alias("valeur"),
                                 matches(state, dim).alias("garde")) for dim in dims])
    return (cube_df.select("n", F.explode(entries).alias("e")).filter("e.garde")
            .groupBy(F.col("e.visuel").alias("visuel"), F.col("e.valeur").alias("valeur"))
            .agg(F.sum("n").cast("long").alias("n")))


def kpi_cards(cube_df: DataFrame, axis: str, state: dict[str, object]) -> DataFrame:
    """One row: total, leading axis value with its share, share of women, axis values."""
    per_value = (cube_df.filter(matches(state)).groupBy(axis)
                 .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("sexe") == "F", F.col("n")).otherwise(0)).alias("f")))
    return (per_value.agg(F.sum("n").cast("long").alias("total"), first_by(axis, "n").alias("premier"),
                          F.max("n").cast("long").alias("n_premier"), F.sum("f").alias("f"),
                          F.count("*").alias("n_valeurs"))
            .withColumn("part_premier_pct", whole_percent(F.col("n_premier"), F.col("total")))
            .withColumn("femmes_pct", whole_percent(F.col("f"), F.col("total"))).drop("f"))


def series(cube_df: DataFrame, state: dict[str, object], year: str = "annee") -> DataFrame:
    """Yearly series under the current filters: trend line and sparkline."""
    return (cube_df.filter(matches(state, year)).groupBy(year)
            .agg(F.sum("n").cast("long").alias("n")).orderBy(year))


def trend(cube_df: DataFrame, state: dict[str, object], year: str = "annee") -> DataFrame:
    """Yearly totals under the other filters, with the change on the year before."""
    return year_on_year(series(cube_df, state, year), year, "n")


def export_cube(cube_df: DataFrame, path: str, fmt: str = "json") -> None:
    """Aggregates for publication, sorted on every dimension (JSON or CSV)."""
    dims = [c for c in cube_df.columns if c != "n"]
    writer = cube_df.orderBy(*dims).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def cube_as_json(cube_df: DataFrame) -> DataFrame:
    """Each cube row as a JSON array, the form dashboards load: numbers as numbers, texts quoted."""
    def item(name: str, kind: str) -> Column:
        if kind in ("int", "bigint", "smallint", "tinyint", "double", "float", "boolean") or kind.startswith("decimal"):
            return F.coalesce(F.col(name).cast("string"), F.lit("null"))
        quoted = F.to_json(F.array(F.col(name).cast("string")))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    items = F.concat_ws(",", *[item(name, kind) for name, kind in cube_df.dtypes])
    return cube_df.select(F.concat(F.lit("["), items, F.lit("]")).alias("ligne"))


def published(surveys: DataFrame) -> Column:
    return F.col("score").between(0, 100)


def satisfaction_summary(surveys: DataFrame) -> DataFrame:
    """Mean score /10 over sites per region and nationally, sites published and total.

    `surveys` has region and score (0-100). The national row averages sites, not
    regions; regions that publish nothing are left out. Sites without a region are only in
    the national total: they count as published neither there nor in a region.
    """
    region = standard_region(F.col("region"))
    shown = published(surveys) & (F.col("region") != UNKNOWN_GEO)
    grouped = (surveys.withColumn("region", F.when(F.trim(region) != "", region).otherwise(UNKNOWN_GEO))
               .groupingSets([[F.col("region")], []], F.col("region"))
               .agg(F.grouping("region").alias("_all"),
                    (F.avg(F.when(shown, F.col("score"))) / 10).cast("double").alias("moyenne"),
                    F.count_if(shown).alias("diffuses"), F.count("*").alias("total")))
    return (grouped.filter("diffuses > 0")
            .select(F.when(F.col("_all") == 1, ALL_REGIONS).otherwise(F.col("region")).alias("region"),
                    F.round("moyenne", 6).alias("moyenne"), "diffuses", "total"))


def sub_scores(surveys: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Mean /10 of each sub-score over the sites whose global score is published."""
    parsed = surveys.filter(published(surveys)).select(
        *[decimal_comma(F.col(source).cast("string")).alias(name) for name, source in columns.items()])
    return (parsed.unpivot([], list(columns), "sous_score", "valeur")
            .filter(F.col("valeur").between(0, 100)).groupBy("sous_score")
            .agg(F.round((F.avg("valeur") / 10).cast("double"), 6).alias("moyenne"), F.count("*").alias("n")))


def sub_score_means(rows: DataFrame) -> DataFrame:
    """Mean /10 of each sub-score from its rows (sous_score, valeur, score_all_rea_ajust), published sites only."""
    shown = rows.withColumn("score", decimal_comma(F.col("score_all_rea_ajust"))).filter(published(rows))
    return (shown.withColumn("valeur", decimal_comma(F.col("valeur"))).filter(F.col("valeur").between(0, 100))
            .groupBy("sous_score").agg(F.round((F.avg("valeur") / 10).cast("double"), 6).alias("moyenne"), F.count("*").alias("n")))


def satisfaction_gaps(summary: DataFrame) -> DataFrame:
    """Gap of each region to the national mean, and which regions are best and worst."""
    national = summary.filter(F.col("region") == ALL_REGIONS).select("moyenne").scalar()
    regions = summary.filter(F.col("region") != ALL_REGIONS)
    ends = regions.agg(F.struct(first_by("region", "moyenne").alias("best"),
                                last_by("region", "moyenne").alias("worst"))).scalar()
    return regions.select("region", "moyenne", F.round(F.col("moyenne") - national, 6).alias("ecart"),
                          (F.col("region") == ends["best"]).alias("est_meilleure"),
                          (F.col("region") == ends["worst"]).alias("est_moins_bonne"))
