"""Builders of the conformed dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.functions.bands import band_of_age
from klinark.functions.codes import chapter_letter, is_blank, sex_code
from klinark.functions.fixed_values import MONTHS, OVERSEAS_LABEL, UNKNOWN_GEO, WEEKDAYS
from klinark.functions.privacy import canonical_id
from klinark.functions.values import date_id
from klinark.operators.joins import lookup
from klinark.plans.facts import resolve_region
from klinark.schemas import DIMENSIONS, enforce_schema


def _no_text():
    return F.lit(None).cast("string")


def calendar(bounds: DataFrame) -> DataFrame:
    """`dim_temps` from a one-row frame with the first (`debut`) and last (`fin`) day."""
    days = bounds.select(F.explode(F.sequence("debut", "fin", F.expr("interval 1 day"))).alias("d"))
    label = lambda names, index: F.element_at(F.array(*[F.lit(n) for n in names]), index)
    built = days.select(
        date_id(F.col("d")).alias("date_id"), F.dayofmonth("d").alias("jour"),
        F.month("d").alias("mois"), label(MONTHS, F.month("d")).alias("libelle_mois"),
        F.quarter("d").alias("trimestre"), F.year("d").alias("annee"),
        label(WEEKDAYS, F.weekday("d") + 1).alias("jour_semaine"))
    return enforce_schema(built, DIMENSIONS["dim_temps"])


def calendar_bounds(*day_columns: DataFrame) -> DataFrame:
    """First and last day over several one-column frames of dates, in whole years."""
    ranges = [df.toDF("d").agg(F.min("d").alias("a"), F.max("d").alias("b")) for df in day_columns]
    return (reduce(DataFrame.unionAll, ranges)
            .agg(F.min("a").alias("a"), F.max("b").alias("b"))
            .select(F.make_date(F.year("a"), F.lit(1), F.lit(1)).alias("debut"),
                    F.make_date(F.year("b"), F.lit(12), F.lit(31)).alias("fin")))


def geography(departments: DataFrame) -> DataFrame:
    """`dim_geographie`: one row per region code, and one for unresolved places.

    A code shared by several territories gets a common label, so that a join on the
    key never counts a row twice.
    """
    regions = (departments.groupBy("code_region")
               .agg(F.min("nom_region").alias("a"), F.max("nom_region").alias("b"))
               .select(F.col("code_region").alias("geo_id"), "code_region",
                       F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(OVERSEAS_LABEL).alias("region")))
    unknown = departments.sparkSession.range(1).select(
        F.lit(UNKNOWN_GEO).alias("geo_id"), _no_text().alias("code_region"),
        F.lit(UNKNOWN_GEO).alias("region"))
    built = (regions.unionByName(unknown)
             .withColumn("code_departement", _no_text()).withColumn("departement", _no_text()))
    return enforce_schema(built, DIMENSIONS["dim_geographie"])


def surviving(column: str, rank: str) -> Column:
    """Value of a group from its best source: lowest rank, then the smallest value; blanks never count."""
    filled = F.when(~is_blank(F.col(column)), F.struct(F.col(rank).alias("rank"), F.col(column).alias("value")))
    return F.min(filled)["value"]


def establishment(surveyed: DataFrame, admitting: DataFrame, geographies: DataFrame) -> DataFrame:
    """`dim_etablissement` merged from survey sites and admitting sites, and one row for unresolved sites.

    `surveyed` has etab_id, nom_etab and region; `admitting` has etab_id, on many rows
    that shrink to one per site before the union. Regions are first resolved to the labels of
    `geographies`; then each attribute comes from the best source that has it, surveys before stays. A
    region that no source names, or that is not resolved, is INCONNU.
    """
    names = geographies.select("geo_id", F.col("region").alias("_label")).filter(F.col("geo_id") != UNKNOWN_GEO)
    resolved = (lookup(resolve_region(surveyed.select("etab_id", "nom_etab", "region").distinct(), geographies, "region"), names, "geo_id")
                .select(F.trim("etab_id").alias("etab_id"), "nom_etab", F.col("_label").alias("region"), F.lit(1).alias("_rank")))
    unknown = F.lit(UNKNOWN_GEO)
    member = surveyed.sparkSession.range(1).select(
        unknown.alias("etab_id"), unknown.alias("nom_etab"), unknown.alias("region"), F.lit(0).alias("_rank"))
    both = (resolved.unionByName(admitting.select(F.trim("etab_id").alias("etab_id")).distinct()
                                 .select("etab_id", _no_text().alias("nom_etab"), _no_text().alias("region"), F.lit(2).alias("_rank")))
            .filter(~is_blank(F.col("etab_id"))).unionByName(member))
    merged = (both.groupBy("etab_id")
              .agg(surviving("nom_etab", "_rank").alias("nom_etab"), F.coalesce(surviving("region", "_rank"), unknown).alias("region"))
              .withColumn("type_etab", _no_text()).withColumn("departement", _no_text()))
    return enforce_schema(merged, DIMENSIONS["dim_etablissement"])


def diagnosis(*facts: DataFrame) -> DataFrame:
    """`dim_diagnostic` from the codes observed in the facts."""
    codes = reduce(DataFrame.unionAll, [f.select("diag_id") for f in facts])
    built = (codes.filter(F.col("diag_id").isNotNull()).distinct()
             .select("diag_id", F.col("diag_id").alias("code_cim10"), _no_text().alias("libelle"),
                     chapter_letter(F.col("diag_id")).alias("chapitre_cim10")))
    return enforce_schema(built, DIMENSIONS["dim_diagnostic"])


def mean_stay_by_diagnosis(dim: DataFrame, stays: DataFrame) -> DataFrame:
    """`dim_diagnostic` with the mean length of stay of each code."""
    means = stays.groupBy("diag_id").agg(F.avg("duree_sejour").alias("dms_moyen"))
    return dim.join(means, "diag_id", "left")


def patient(patients: DataFrame, mapping: DataFrame) -> DataFrame:
    """`dim_patient`: pseudonym, sex, age band and region of residence.

    Both sides have one row per patient, so they meet in an ordinary shuffled join.
    """
    known = patients.withColumn("id_patient_original", canonical_id(F.col("id_patient")))
    built = known.join(mapping, "id_patient_original").select(
        F.col("id_patient_pseudo").alias("patient_id"), sex_code(F.col("sexe")).alias("sexe"),
        band_of_age(F.col("age").try_cast("int")).alias("tranche_age"), "region_residence")
    return enforce_schema(built, DIMENSIONS["dim_patient"])


def professional(professionals: DataFrame, specialties: DataFrame) -> DataFrame:
    """`dim_professionnel`: professional with the specialty label when it is known."""
    built = (lookup(professionals, specialties, "code_specialite")
             .select(F.col("identifiant").alias("prof_id"), "specialite",
                     F.col("categorie_professionnelle").alias("categorie_prof"), "code_specialite")
             .distinct())
    return enforce_schema(built, DIMENSIONS["dim_professionnel"])
