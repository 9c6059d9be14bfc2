"""Patient mapping, minimisation, role views, erasure and text scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.functions.privacy import (
    EMAIL_PATTERN, PHONE_PATTERN, canonical_id, count_matches, patient_salt, pseudonym,
)
from klinark.operators.joins import lookup
from klinark.schemas import FORBIDDEN

# What a role may see: whether single rows are visible, and which columns are hidden.
ROLES = {
    "admin": {"rows": True, "hidden": ()},
    "analyste": {"rows": True, "hidden": FORBIDDEN},
    "praticien": {"rows": False, "hidden": FORBIDDEN + ("patient_id",)},
    "gestionnaire": {"rows": False, "hidden": FORBIDDEN + ("patient_id",)},
}


def build_mapping(df: DataFrame, column: str, master: str, seed: str,
                  created: Column | None = None) -> DataFrame:
    """Secure mapping: one row per patient with its salt and pseudonym."""
    moment = created if created is not None else F.current_timestamp()
    return (df.select(canonical_id(F.col(column)).alias("id_patient_original"))
            .filter(F.col("id_patient_original").isNotNull()).distinct()
            .select("id_patient_original",
                    pseudonym(F.col("id_patient_original"), master, seed).alias("id_patient_pseudo"),
                    patient_salt(F.col("id_patient_original"), seed).alias("salt_patient"),
                    moment.alias("creation_date")))


def attach_pseudonym(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace a clear identifier by the pseudonym of the mapping (inner join).

    Facts do not need it: they compute the same hash in place. It serves mappings
    that were built elsewhere.
    """
    named = mapping.select(F.col("id_patient_original").alias("_id"),
                           F.col("id_patient_pseudo").alias("patient_id"))
    return (lookup(df.withColumn("_id", canonical_id(F.col(column))), named, "_id", "inner")
            .drop("_id", column))


def minimise(df: DataFrame, keep: list[str]) -> DataFrame:
    """Only the columns a purpose needs; direct identifiers are refused."""
    refused = [c for c in keep if c.lower() in FORBIDDEN]
    if refused:
        raise ValueError(f"direct identifiers cannot be kept: {', '.join(refused)}")
    return df.select(*keep)


def scan_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """E-mail addresses and phone numbers found in each text."""
    return df.select(key, count_matches(F.col(text), EMAIL_PATTERN, "@").alias("n_emails"),
                     count_matches(F.col(text), PHONE_PATTERN).alias("n_telephones"))


def view_for_role(df: DataFrame, role: str, scope: Column | None = None,
                  axes: list[str] = (), measures: dict[str, Column] | None = None) -> DataFrame:
    """What a role may read: its perimeter only, and aggregates when rows are closed."""
    rights = ROLES[role]
    inside = df.filter(scope) if scope is not None else df
    if rights["rows"]:
        return inside.drop(*rights["hidden"])
    closed = [a for a in axes if a in rights["hidden"]]
    if closed or not measures:
        raise ValueError(f"role {role} reads aggregates on open axes only {closed}")
    return inside.groupBy(*axes).agg(*[m.alias(name) for name, m in measures.items()])


def erase(df: DataFrame, column: str, erased: DataFrame) -> DataFrame:
    """Remove every row of the patients in `erased` (same column name)."""
    return lookup(df, erased.select(column).distinct(), column, "left_anti")


def touched_partitions(df: DataFrame, column: str, erased: DataFrame, partition: str) -> DataFrame:
    """Partitions that hold rows of the erased patients: the only ones to rewrite."""
    concerned = lookup(df, erased.select(column).distinct(), column, "left_semi")
    return concerned.select(partition).distinct()
