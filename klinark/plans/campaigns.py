"""Survey campaigns from their files to the fact: each campaign is replaced alone, also by an empty one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.operators.layout import replace_batch
from klinark.operators.rows import classify
from klinark.plans import facts
from klinark.plans.warehouse import Settings, load_fact, stage_source
from klinark.sources.surveys import REASON as MALFORMED
from klinark.sources.surveys import LONG, NO_LAYOUT, SHORT, UNREADABLE

MANIFEST = "annee int, n_lignes long, empreinte long"


def campaign_rules():
    """Reject reasons of survey lines: malformed lines first, then those of the values."""
    return [(reason, F.col(MALFORMED) == reason) for reason in (NO_LAYOUT, UNREADABLE, SHORT, LONG)] + facts.survey_rules()


def fingerprints(read: DataFrame) -> DataFrame:
    """Lines per campaign and a fingerprint of them, whatever their order and files."""
    line = F.xxhash64("ligne")
    return read.groupBy("annee").agg(F.count("*").alias("n_lignes"),
                                     F.bit_xor(F.xxhash64(line, F.lit(1))).bitwiseXOR(F.sum(F.pmod(line, F.lit(2 ** 31)))).alias("empreinte"))


def manifest(spark: SparkSession, settings: Settings) -> DataFrame:
    """Campaigns of the last loads: (annee, n_lignes, empreinte)."""
    try:
        return spark.read.parquet(f"{settings.root}/{settings.staging}/campagnes").select(*[c.split(" ")[0] for c in MANIFEST.split(", ")])
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], MANIFEST)


def changed_campaigns(spark: SparkSession, read: DataFrame, settings: Settings) -> dict[int, tuple]:
    """Campaigns whose lines differ from the last load: new, changed, or now without any line."""
    now = {r.annee: (r.n_lignes, r.empreinte) for r in fingerprints(read).collect()}  # one row per campaign
    before = {r.annee: (r.n_lignes, r.empreinte) for r in manifest(spark, settings).collect()}
    gone = {year: (0, 0) for year, (n, _) in before.items() if year not in now and n}
    return {year: mark for year, mark in {**now, **gone}.items() if before.get(year) != mark and year is not None}


def load_campaigns(spark: SparkSession, read: DataFrame, establishments: DataFrame, geography: DataFrame,
                   settings: Settings) -> DataFrame | None:
    """Load the campaigns that changed since the last load into the satisfaction fact; None if none did.

    Each of them replaces its own year, whatever it holds now; the other years keep their files and keys. Rejects
    of a campaign replace those of its last load. The manifest is written after the fact, so a failed load is repeated.
    """
    changed = changed_campaigns(spark, read, settings)
    if not changed:
        return None
    own = read.filter(F.col("annee").isin(*changed)).drop("champs")
    typed = facts.flag_known_sites(facts.type_surveys(own), establishments)
    staged = stage_source("fait_satisfaction", classify(typed, campaign_rules()))
    summary = load_fact(spark, "fait_satisfaction", staged, lambda valid: facts.shape_surveys(valid, geography, None),
                        ["annee", "finess_geo"], ["etab_id"], settings, sorted(changed))
    for year, (n, mark) in changed.items():
        replace_batch(spark.createDataFrame([(n, mark)], "n_lignes long, empreinte long"),
                      f"{settings.root}/{settings.staging}/campagnes", {"annee": str(year)})
    return summary
