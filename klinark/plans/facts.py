"""Builders of the four facts: rules, cleaning, derivation and numbering.

Each source has a `*_rules` list (reject reasons in order of precedence), a `shape_*`
function (from valid rows to unique rows with gold columns and the columns that order
them), a `clean_*` function (both at once) and a `number_*` function that adds the
surrogate key and drops what must not be published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.functions.bands import age_band, leading_year
from klinark.functions.codes import (
    department_code, fold_label, is_blank, known_or, sex_code, standard_region,
)
from klinark.functions.fixed_values import UNKNOWN_GEO
from klinark.functions.privacy import canonical_id, pseudonym
from klinark.functions.values import (
    clock_seconds, date_id, decimal_comma, duration_minutes, mark_out_of_ten, parse_dmy,
    parse_iso,
)
from klinark.operators.joins import lookup
from klinark.operators.rows import accepted, classify, keep_first, surrogate_key, unrejected
from klinark.schemas import FACTS, enforce_schema

# Consultations -----------------------------------------------------------------------
CONSULTATION_KEY = ["num_consultation"]
CONSULTATION_ORDER = ("jour", "heure_debut", "heure_fin", "id_patient", "id_prof_sante", "code_diag")


def type_consultations(raw: DataFrame) -> DataFrame:
    """Typed date and duration of raw consultations (clock texts HH:mm:ss), and one spelling per key before any comparison."""
    seconds = clock_seconds(F.col("heure_fin")) - clock_seconds(F.col("heure_debut"))
    return raw.withColumns({
        "jour": parse_iso(F.col("date_consultation")), "duree_minutes": duration_minutes(seconds),
        "num_consultation": F.trim("num_consultation"), "id_patient": canonical_id(F.col("id_patient")),
        "id_prof_sante": F.trim("id_prof_sante"), "code_diag": F.trim("code_diag")})


def consultation_rules(first_year: int, last_year: int):
    return [
        ("CONSULTATION_NULLE", is_blank(F.col("num_consultation").cast("string"))),
        ("PATIENT_NULL", is_blank(F.col("id_patient").cast("string"))),
        ("DATE_INVALIDE", F.col("jour").isNull()),
        ("HORS_PLAGE", ~F.year("jour").between(first_year, last_year)),
    ]


def clean_consultations(typed: DataFrame, master: str, seed: str, first_year: int, last_year: int,
                        keys=CONSULTATION_KEY, order=CONSULTATION_ORDER) -> DataFrame:
    valid = accepted(classify(typed, consultation_rules(first_year, last_year)))
    return shape_consultations(valid, master, seed, keys, order)


def shape_consultations(valid: DataFrame, master: str, seed: str, keys=CONSULTATION_KEY,
                        order=CONSULTATION_ORDER) -> DataFrame:
    """One row per key, with the pseudonym computed in place."""
    return keep_first(valid, list(keys), list(order)).select(
        *keys, date_id(F.col("jour")).alias("date_id"),
        pseudonym(F.col("id_patient"), master, seed).alias("patient_id"),
        known_or(F.col("id_prof_sante").cast("string")).alias("prof_id"),
        known_or(F.col("code_diag")).alias("diag_id"),
        F.lit(1).alias("nb_consultation"), "duree_minutes", F.year("jour").alias("annee"))


def number_consultations(clean: DataFrame, keys=CONSULTATION_KEY) -> DataFrame:
    numbered = surrogate_key(clean, "consultation_key", list(keys), drop=tuple(keys), hexadecimal=("patient_id",))
    return enforce_schema(numbered, FACTS["fait_consultation"])


# Hospital stays ------------------------------------------------------------------------
STAY_KEY = ["id_patient", "num_hospitalisation", "date_entree_typee"]
STAY_ORDER = ["date_entree_typee", "etab_id", "num_hospitalisation", "patient_id"]


def type_stays(raw: DataFrame) -> DataFrame:
    """Typed day and length, and one spelling per patient, stay, site and diagnosis, before any comparison."""
    return raw.withColumns({
        "date_entree_typee": parse_dmy(F.col("date_entree")),
        "jours": F.col("jour_hospitalisation").try_cast("int"),
        "id_patient": canonical_id(F.col("id_patient")),
        "num_hospitalisation": F.trim("num_hospitalisation"),
        "identifiant_organisation": F.trim("identifiant_organisation"),
        "code_diagnostic": F.trim("code_diagnostic")})


def stay_rules(first_year: int, last_year: int):
    return [
        ("PATIENT_NULL", is_blank(F.col("id_patient"))),
        ("ETAB_NULL", is_blank(F.col("identifiant_organisation"))),
        ("DATE_INVALIDE", F.col("date_entree_typee").isNull()),
        ("DUREE_NEGATIVE", F.col("jours") < 0),
        ("HORS_PLAGE", ~F.year("date_entree_typee").between(first_year, last_year)),
    ]


def clean_stays(typed: DataFrame, master: str, seed: str, first_year: int, last_year: int,
                order=("identifiant_organisation", "code_diagnostic", "jours"), clear: bool = False) -> DataFrame:
    valid = unrejected(typed, stay_rules(first_year, last_year))
    return shape_stays(valid, master, seed, order, clear)


def shape_stays(valid: DataFrame, master: str, seed: str,
                order=("identifiant_organisation", "code_diagnostic", "jours"), clear: bool = False) -> DataFrame:
    """One row per (patient, stay number, day of admission), whatever their spelling.

    With `clear` the identifier stays in the row, for `number_stays` to replace it once the rows are in order.
    """
    return keep_first(valid, STAY_KEY, list(order)).select(
        "date_entree_typee", "num_hospitalisation", "date_entree",
        date_id(F.col("date_entree_typee")).alias("date_id"),
        F.col("id_patient") if clear else pseudonym(F.col("id_patient"), master, seed).alias("patient_id"),
        F.col("identifiant_organisation").alias("etab_id"),
        known_or(F.col("code_diagnostic")).alias("diag_id"),
        F.lit(1).alias("nb_hospitalisation"), F.col("jours").alias("duree_sejour"),
        F.year("date_entree_typee").alias("annee"))


def number_stays(clean: DataFrame, master: str | None = None, seed: str | None = None) -> DataFrame:
    """Numbered stays; of `clear` ones the pseudonym, longer than all the rest of a row, is made after the shuffle."""
    late = {"patient_id": pseudonym(F.col("id_patient"), master, seed)} if "id_patient" in clean.columns else None
    # what the day gives is added after the shuffle; patient, stay and day are the key of a stay, so no text of the day is needed
    numbered = surrogate_key(clean.drop("date_entree", "date_id", "nb_hospitalisation", "annee"), "hosp_key", STAY_ORDER,
                             drop=("num_hospitalisation", "id_patient"), hexadecimal=("patient_id",), late=late)
    day = F.col("date_entree_typee")
    numbered = numbered.withColumns({"date_id": date_id(day), "nb_hospitalisation": F.lit(1), "annee": F.year(day)})
    return enforce_schema(numbered, FACTS["fait_hospitalisation"])


# Satisfaction surveys -------------------------------------------------------------------
def type_surveys(raw: DataFrame) -> DataFrame:
    return raw.withColumn("score", decimal_comma(F.col("score_all_rea_ajust")))


def survey_rules():
    """`site_connu` tells whether the site is in the establishment dimension."""
    return [
        ("NOTE_NULLE", is_blank(F.col("score_all_rea_ajust"))),
        ("NOTE_NON_NUMERIQUE", F.col("score").isNull()),
        ("NOTE_HORS_PLAGE", ~F.col("score").between(0, 100)),
        ("ETAB_INCONNU", ~F.col("site_connu")),
    ]


def flag_known_sites(typed: DataFrame, establishments: DataFrame) -> DataFrame:
    known = establishments.select(F.col("etab_id").alias("finess_geo"), F.lit(True).alias("site_connu"))
    return typed.join(known, "finess_geo", "left").withColumn(
        "site_connu", F.coalesce("site_connu", F.lit(False)))


def resolve_region(df: DataFrame, geographies: DataFrame, label: str) -> DataFrame:
    """Region key of a free label, whatever its case, accents or punctuation."""
    regions = (geographies.select("geo_id", fold_label(F.col("region")).alias("_folded"))
               .groupBy("_folded").agg(F.min("geo_id").alias("geo_id")))
    return (lookup(df.withColumn("_folded", fold_label(standard_region(F.col(label)))), regions, "_folded")
            .withColumn("geo_id", F.coalesce("geo_id", F.lit(UNKNOWN_GEO))).drop("_folded"))


def clean_surveys(typed: DataFrame, establishments: DataFrame, geographies: DataFrame,
                  campaign: int | None, order=("score", "region")) -> DataFrame:
    valid = accepted(classify(flag_known_sites(typed, establishments), survey_rules()))
    return shape_surveys(valid, geographies, campaign, order)


def shape_surveys(valid: DataFrame, geographies: DataFrame, campaign: int | None,
                  order=("score", "region")) -> DataFrame:
    """Marks, one per site and campaign; only valid rows compete for a site.

    Without a `campaign` the rows name their own in the column `annee`.
    """
    dated = valid if campaign is None else valid.withColumn("annee", F.lit(campaign))
    one_per_site = keep_first(dated, ["annee", "finess_geo"], list(order))
    return resolve_region(one_per_site, geographies, "region").select(
        (F.col("annee") * 10000 + 101).cast("int").alias("date_id"), F.col("finess_geo").alias("etab_id"), "geo_id",
        mark_out_of_ten(F.col("score")).alias("note_satisfaction"), F.col("annee").cast("int").alias("annee"))


def number_surveys(clean: DataFrame) -> DataFrame:
    numbered = surrogate_key(clean, "satisfaction_key", ["annee", "etab_id"])
    return enforce_schema(numbered, FACTS["fait_satisfaction"])


# Deaths ----------------------------------------------------------------------------------
def death_rules(first_year: int):
    return [
        ("DATE_INVALIDE", parse_iso(F.col("date_deces")).isNull()),
        ("HORS_PLAGE", leading_year(F.col("date_deces")) < first_year),
    ]


def clean_deaths(raw: DataFrame, departments: DataFrame, first_year: int) -> DataFrame:
    return shape_deaths(accepted(classify(raw, death_rules(first_year))), departments)


def shape_deaths(valid: DataFrame, departments: DataFrame) -> DataFrame:
    """Deaths with their region key, sex and age band; no name.

    A small department reference is broadcast by adaptive execution, so the deaths are not
    shuffled. A code listed twice in it does not double them. Deaths have no natural
    key: equal lines are separate deaths.
    """
    regions = (departments.groupBy(F.col("code_departement").alias("_dept"))
               .agg(F.min("code_region").alias("code_region")))
    located = lookup(valid.withColumn("_dept", department_code(F.col("code_lieu_deces"))), regions, "_dept")
    day = parse_iso(F.col("date_deces"))
    return located.select(
        "date_deces", "code_lieu_deces", "numero_acte_deces", date_id(day).alias("date_id"),
        F.coalesce("code_region", F.lit(UNKNOWN_GEO)).alias("geo_id"),
        sex_code(F.col("sexe")).alias("sexe"),
        age_band(F.col("date_deces"), F.col("date_naissance")).alias("tranche_age"),
        F.lit(1).alias("nb_deces"), F.year(day).alias("annee"))


DEATH_ORDER = ["date_deces", "code_lieu_deces", "numero_acte_deces"]


def number_deaths(clean: DataFrame) -> DataFrame:
    numbered = surrogate_key(clean, "deces_key", DEATH_ORDER, drop=tuple(DEATH_ORDER), unique=False)
    return enforce_schema(numbered, FACTS["fait_deces"])
