"""Declared schemas of the sources, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def text_schema(*names: str) -> T.StructType:
    """All-text schema of a raw file."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def columns(ddl: str) -> dict[str, str]:
    """Column names and types of a `name type, name type` declaration."""
    return dict(part.split(" ") for part in ddl.split(", "))


# Raw sources ---------------------------------------------------------------------
RAW_DEATHS = text_schema(
    "nom", "prenom", "sexe", "date_naissance", "code_lieu_naissance", "lieu_naissance",
    "pays_naissance", "date_deces", "code_lieu_deces", "numero_acte_deces")
RAW_STAYS = text_schema(
    "num_hospitalisation", "id_patient", "identifiant_organisation", "code_diagnostic",
    "suite_diagnostic_consultation", "date_entree", "jour_hospitalisation")
RAW_SURVEY = text_schema(
    "finess", "rs_finess", "finess_geo", "rs_finess_geo", "region", "participation",
    "depot", "nb_rep_score_all", "score_all_rea_ajust")
RAW_CONSULTATIONS = text_schema(
    "num_consultation", "id_mut", "id_patient", "id_prof_sante", "code_diag", "motif",
    "date_consultation", "heure_debut", "heure_fin")
RAW_DEPARTMENTS = text_schema("code_departement", "code_region", "nom_region")

# Dimensions ----------------------------------------------------------------------
DIMENSIONS = {
    "dim_temps": columns(
        "date_id int, jour int, mois int, libelle_mois string, trimestre int, annee int, "
        "jour_semaine string"),
    "dim_patient": columns(
        "patient_id string, sexe string, tranche_age string, region_residence string"),
    "dim_professionnel": columns(
        "prof_id string, specialite string, categorie_prof string, code_specialite string"),
    "dim_diagnostic": columns(
        "diag_id string, code_cim10 string, libelle string, chapitre_cim10 string"),
    "dim_etablissement": columns(
        "etab_id string, nom_etab string, type_etab string, region string, departement string"),
    "dim_geographie": columns(
        "geo_id string, code_region string, region string, code_departement string, "
        "departement string"),
}
DIMENSION_KEYS = {
    "dim_temps": "date_id", "dim_patient": "patient_id", "dim_professionnel": "prof_id",
    "dim_diagnostic": "diag_id", "dim_etablissement": "etab_id", "dim_geographie": "geo_id",
}

# Facts, each with its year partition column ----------------------------------------
FACTS = {
    "fait_consultation": columns(
        "consultation_key bigint, date_id int, patient_id string, prof_id string, "
        "diag_id string, nb_consultation int, duree_minutes double, annee int"),
    "fait_hospitalisation": columns(
        "hosp_key bigint, date_id int, patient_id string, etab_id string, diag_id string, "
        "nb_hospitalisation int, duree_sejour int, annee int"),
    "fait_satisfaction": columns(
        "satisfaction_key bigint, date_id int, etab_id string, geo_id string, "
        "note_satisfaction decimal(3,1), annee int"),
    "fait_deces": columns(
        "deces_key bigint, date_id int, geo_id string, sexe string, tranche_age string, "
        "nb_deces int, annee int"),
}
SURROGATES = {
    "fait_consultation": "consultation_key", "fait_hospitalisation": "hosp_key",
    "fait_satisfaction": "satisfaction_key", "fait_deces": "deces_key",
}
# Buckets of a fact, whatever the size of one load. Deaths add the sex and band to the region, which alone is skewed.
BUCKET_KEYS = {
    "fait_consultation": ("prof_id",),
    "fait_hospitalisation": ("etab_id",),
    "fait_deces": ("geo_id", "sexe", "tranche_age"),
}
BUCKETS = 8

# Columns that must never reach a published table.
FORBIDDEN = (
    "nom", "prenom", "numero_acte_deces", "num_hospitalisation", "num_consultation",
    "id_patient", "motif", "suite_diagnostic_consultation", "date_naissance",
    "email", "telephone", "telecopie",
)


def enforce_schema(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Exactly the declared columns, in order and with the declared types."""
    return df.select([F.col(name).cast(kind).alias(name) for name, kind in target.items()])
