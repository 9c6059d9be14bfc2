"""Steering questions over the facts and dimensions.

Facts are summed on their own key before they meet a dimension: the join then handles
one row per key instead of one per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.functions.bands import band_rank
from klinark.functions.fixed_values import UNKNOWN_BAND, UNKNOWN_GEO, UNKNOWN_SEX
from klinark.functions.values import percent
from klinark.operators.rankings import top_n, top_n_per_group


def one_year(fact: DataFrame, year: int | None) -> DataFrame:
    """Restrict to a year partition (pruned at the scan), or keep all years."""
    return fact if year is None else fact.filter(F.col("annee") == year)


def total(fact: DataFrame, measure: str, year: int) -> DataFrame:
    """B3: events of one year."""
    return one_year(fact, year).agg(F.coalesce(F.sum(measure), F.lit(0)).cast("long").alias("nb"))


def by_axis(fact: DataFrame, axis: str, measure: str, year: int | None = None) -> DataFrame:
    return one_year(fact, year).groupBy(axis).agg(F.sum(measure).cast("long").alias("nb"))


def top_by_axis(fact: DataFrame, axis: str, measure: str, year: int | None, n: int) -> DataFrame:
    """B2, B4, B7 on the key: the n most frequent axis values of a year."""
    return top_n(by_axis(fact, axis, measure, year), "nb", axis, n)


def deaths_by_region(deaths: DataFrame, geography: DataFrame, year: int, n: int = 5) -> DataFrame:
    """B7: deaths per region name of one year, top n; keys that the dimension lacks count as INCONNU."""
    per_key = by_axis(deaths, "geo_id", "nb_deces", year)
    named = (per_key.join(geography.select("geo_id", "region"), "geo_id", "left")
             .withColumn("region", F.coalesce("region", F.lit(UNKNOWN_GEO))))
    per_region = named.groupBy("region").agg(F.sum("nb").cast("long").alias("nb_deces"))
    return top_n(per_region, "nb_deces", "region", n)


def by_sex_and_band(fact: DataFrame, measure: str, year: int | None) -> DataFrame:
    """Events per sex and age band carried by the fact, in report order."""
    return (one_year(fact, year).groupBy("sexe", "tranche_age")
            .agg(F.sum(measure).cast("long").alias("n")).orderBy("sexe", F.desc("n"), "tranche_age"))


def in_band_order(totals: DataFrame, band: str) -> DataFrame:
    """Add the fixed rank of age bands and sort by it."""
    return totals.withColumn("rang", band_rank(F.col(band))).orderBy("rang")


def yearly_overview(events: DataFrame, axes: dict[str, str], minutes: str) -> DataFrame:
    """Volume, distinct values of the axes and mean valid duration, per year."""
    return events.groupBy("annee").agg(
        F.count("*").alias("total"),
        *[F.count_distinct(F.col(column)).alias(name) for name, column in axes.items()],
        F.round(F.avg(minutes), 1).alias("duree_moyenne_min"))


def seasonality(events: DataFrame, day: str) -> DataFrame:
    """Volume per year and month."""
    return events.groupBy(F.year(day).alias("annee"), F.month(day).alias("mois")).agg(F.count("*").alias("n"))


def top_labels_per_year(events: DataFrame, key: str, labels: DataFrame, label: str, n: int) -> DataFrame:
    """B2, B6: most frequent labels of each year.

    Events are counted per year and key, then named through `labels` (key -> label). Events
    whose key has no label count under INCONNU.
    """
    per_key = events.groupBy("annee", key).agg(F.count("*").alias("n"))
    per_label = (per_key.join(labels, key, "left").withColumn(label, F.coalesce(label, F.lit(UNKNOWN_GEO)))
                 .groupBy("annee", label)
                 .agg(F.sum("n").cast("long").alias("n")))
    return top_n_per_group(per_label, "annee", "n", label, n)


def stays_by_establishment(stays: DataFrame, establishments: DataFrame, year: int, n: int = 10) -> DataFrame:
    """Stays and mean length per site of one year, top n; sites that are not known count as INCONNU."""
    per_site = one_year(stays, year).groupBy("etab_id").agg(
        F.sum("nb_hospitalisation").alias("nb"), F.sum("duree_sejour").alias("jours"),
        F.count("duree_sejour").alias("n_duree"))
    named = (_resolved(per_site, establishments.select("etab_id")).groupBy("etab_id")
             .agg(F.sum("nb").cast("long").alias("nb"), (F.sum("jours") / F.sum("n_duree")).alias("dms")))
    return top_n(named, "nb", "etab_id", n)


def _resolved(per_site: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows with the columns of their site; where it is not known, these and its id are INCONNU."""
    unknown = F.lit(UNKNOWN_GEO)
    found = per_site.join(sites.withColumn("_known", F.lit(True)), "etab_id", "left")
    found = found.withColumn("etab_id", F.when(F.col("_known"), F.col("etab_id")).otherwise(unknown))
    return found.withColumns({c: F.coalesce(c, unknown) for c in sites.columns if c != "etab_id"}).drop("_known")


def stays_by_sex_and_age(stays: DataFrame, patients: DataFrame, year: int | None) -> DataFrame:
    """B5: stays per sex and age band of the patient; those of unknown patients under unknown sex and band."""
    per_patient = by_axis(stays, "patient_id", "nb_hospitalisation", year)
    return (per_patient.join(patients.select("patient_id", "sexe", "tranche_age"), "patient_id", "left")
            .withColumns({"sexe": F.coalesce("sexe", F.lit(UNKNOWN_SEX)), "tranche_age": F.coalesce("tranche_age", F.lit(UNKNOWN_BAND))})
            .groupBy("sexe", "tranche_age").agg(F.sum("nb").cast("long").alias("nb")))


def mean_mark(marks: DataFrame, axis: str) -> DataFrame:
    """B8: mean mark and number of sites per axis value, over one campaign or several."""
    per_site = marks.groupBy(axis, "etab_id").agg(F.sum("note_satisfaction").alias("s"), F.count("note_satisfaction").alias("n"))
    return per_site.groupBy(axis).agg((F.sum("s") / F.sum("n")).cast("double").alias("satisf_moy"),
                                      F.count("*").alias("n_sites"))


def mean_mark_by_region(marks: DataFrame, establishments: DataFrame, year: int) -> DataFrame:
    """B8: mean mark per region of the establishment, one campaign; marks of unknown sites under INCONNU."""
    named = one_year(marks, year).join(establishments.select("etab_id", "region"), "etab_id", "left")
    return mean_mark(named.withColumn("region", F.coalesce("region", F.lit(UNKNOWN_GEO))), "region")


def rate(df: DataFrame, key: str, labels: DataFrame, axis: str, hits, name: str) -> DataFrame:
    """Share of rows for which a condition holds, per axis value.

    Rows are counted per key before `labels` (key -> axis value) is joined; rows whose key has no label
    count under INCONNU.
    """
    per_key = df.groupBy(key).agg(F.count_if(hits).alias("hits"), F.count("*").alias("rows"))
    return (per_key.join(labels, key, "left").withColumn(axis, F.coalesce(F.col(axis).cast("string"), F.lit(UNKNOWN_GEO))).groupBy(axis)
            .agg(F.sum("hits").alias("numerateur"), F.sum("rows").alias("denominateur"))
            .select(F.lit(name).alias("indicateur"), F.col(axis).cast("string").alias("groupe"),
                    "numerateur", "denominateur",
                    percent(F.col("numerateur"), F.col("denominateur"), 2).alias("taux_pct")))


def bed_occupancy(stays: DataFrame, capacity: DataFrame, year: int, days_in_year: int = 365) -> DataFrame:
    """Days of stay over the bed days a site offers in a year (`capacity`: etab_id, lits).

    Days of sites whose capacity is not known are one row INCONNU without a rate.
    """
    used = one_year(stays, year).groupBy("etab_id").agg(F.sum("duree_sejour").cast("long").alias("jours"))
    return (used.join(capacity, "etab_id", "left")
            .withColumn("etab_id", F.when(F.col("lits").isNotNull(), F.col("etab_id")).otherwise(UNKNOWN_GEO))
            .groupBy("etab_id", "lits").agg(F.sum("jours").cast("long").alias("jours")).select("etab_id", "jours", "lits")
            .withColumn("taux_pct", percent(F.col("jours"), F.col("lits") * days_in_year, 2)))


def drilldown(stays: DataFrame, sites: DataFrame, levels: list[str]) -> DataFrame:
    """Stays and mean length at each level of a hierarchy of sites, and in total.

    `sites` maps etab_id to the levels; stays of other sites count as INCONNU. Sums per site are
    rolled up, not the stays.
    """
    per_site = stays.groupBy("etab_id", "annee").agg(
        F.sum("nb_hospitalisation").alias("nb"), F.sum("duree_sejour").alias("jours"),
        F.count("duree_sejour").alias("n_duree"))
    return (_resolved(per_site, sites).rollup(*levels)
            .agg(F.grouping_id().cast("int").alias("niveau"), F.sum("nb").cast("long").alias("nb"),
                 (F.sum("jours") / F.sum("n_duree")).alias("dms")))
