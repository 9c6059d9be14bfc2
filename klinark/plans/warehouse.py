"""The whole load: sources -> rejects and facts -> dimensions, with checks and audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.functions.fixed_values import UNKNOWN_GEO
from klinark.operators import checks
from klinark.operators.keymap import stable_keys
from klinark.operators.layout import analyse, ensure_zones, gather, replace_batch, write_fact, write_partitions, write_table
from klinark.operators.privacy import build_mapping
from klinark.operators.rows import REASON, classify
from klinark.plans import dimensions, facts
from klinark.plans.files import line_rules
from klinark.schemas import BUCKET_KEYS, BUCKETS, DIMENSION_KEYS, FACTS, FORBIDDEN, SURROGATES, enforce_schema
from klinark.session import stage


@dataclass
class Sources:
    """Typed sources of a load. Surveys are those of one campaign."""

    consultations: DataFrame
    stays: DataFrame
    surveys: DataFrame
    deaths: DataFrame
    departments: DataFrame
    patients: DataFrame
    professionals: DataFrame
    specialties: DataFrame
    sites: DataFrame | None = None  # official list of sites (etab_id); without it every surveyed site is known


@dataclass
class Settings:
    """Parameters of a load. Secrets come from the caller and are never stored."""

    root: str
    master: str = field(repr=False)
    seed: str = field(repr=False)
    first_year: int
    last_year: int
    first_death_year: int
    campaign: int
    batch: str
    gold: str = "entrepot"
    staging: str = "staging"
    consultation_key: tuple[str, ...] = tuple(facts.CONSULTATION_KEY)
    consultation_order: tuple[str, ...] = facts.CONSULTATION_ORDER
    stay_order: tuple[str, ...] = ("identifiant_organisation", "code_diagnostic", "jours")
    thresholds: dict[str, tuple[str, float]] = field(default_factory=lambda: {
        "ecart_pct": ("max", 0.0), "variation_pct": ("max", 10.0), "taux_min_pct": ("min", 90.0)})
    buckets: dict[str, int] = field(default_factory=dict)  # per fact, BUCKETS where it is not named


def stage_source(name: str, classified: DataFrame) -> DataFrame:
    """A classified source, split by outcome and written once: rows, rejects, sites and patients are read from it."""
    outcome = F.when(F.col(REASON).isNull(), "valide").otherwise("rejete")
    return stage(classified.withColumn("statut", outcome), name, ("statut",))


def classified(source: DataFrame, rules: list) -> DataFrame:
    """A source with the first reason that rejects each row; malformed lines of files come first."""
    return classify(source, line_rules(source) + rules)


def load_fact(spark: SparkSession, name: str, staged: DataFrame, build: Callable[[DataFrame], DataFrame],
              keys: list[str], natural: list[str] | None, settings: Settings, years: list[int] | None = None,
              dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Load one fact and its rejects from a staged source; return the count per outcome.

    Rejects overwrite their own batch, so a rerun does not double them. `natural` names the columns of `build`
    whose values, with the year, keep their surrogate key from one load to the next (None: the whole row).
    `years` are replaced even where no row of them is loaded. `dims` maps foreign keys of the fact to frames
    with their known values, for the gate on match rates.
    """
    columns = [c for c in staged.columns if c not in (REASON, "statut")]
    rejects = (staged.filter("statut = 'rejete'")
               .select(F.to_json(F.struct(*columns)).alias("ligne_source"),
                       REASON, F.current_timestamp().alias("ts_rejet")))
    replace_batch(rejects, f"{settings.root}/{settings.staging}/rejets", {"source": name, "lot": settings.batch})

    valid = staged.filter("statut = 'valide'").drop("statut", REASON)
    shaped = build(valid)
    keyed = stable_keys(shaped, SURROGATES[name], None if natural is None else [*natural, "annee"],
                        f"{settings.staging}.cles_{name}", settings.buckets.get(name, BUCKETS),
                        hexadecimal=tuple(c for c in ("patient_id",) if c in shaped.columns))
    fact = checks.assert_no_columns(enforce_schema(keyed, FACTS[name]), FORBIDDEN)

    counts = (checks.reconcile(staged, keys) if keys else
              staged.agg(F.count("*").alias("bronze"), F.count_if(F.col(REASON).isNull()).alias("charge"),
                         F.lit(0).cast("long").alias("doublons"),
                         F.count_if(F.col(REASON).isNotNull()).alias("rejets"))
              .withColumn("ecart", F.col("bronze") - F.col("charge") - F.col("rejets")))
    written = fact.agg(F.count("*")).scalar()
    summary = stage(counts.select(F.lit(name).alias("fait"), "bronze", "charge", "doublons", "rejets",
                         written.alias("gold"),
                         (F.abs("ecart") + F.abs(written - F.col("charge"))).alias("ecart")), f"{name}-bilan")
    rates = [checks.match_rate(fact, fk, known, fk, fk).select("taux_pct") for fk, known in (dims or {}).items()]
    worst = checks.stack(rates).agg(F.min("taux_pct")).first()[0] if rates else None
    volumes = fact.groupBy("annee").agg(F.count("*").alias("n"))
    line = summary.select((100.0 * F.col("ecart") / F.greatest(F.col("bronze"), F.lit(1))).alias("ecart_pct"),
                          (100.0 * F.col("gold") / F.greatest(F.col("bronze"), F.lit(1))).alias("part_chargee_pct"),
                          F.lit(volume_change(spark, name, volumes, years, settings)).alias("variation_pct"),
                          F.lit(100.0 if worst is None else float(worst)).alias("taux_min_pct"))
    audit = f"{settings.root}/{settings.staging}/audit"
    try:
        checks.enforce(checks.gates(line, settings.thresholds))
    except Exception:
        checks.audit_row(fact, "build_gold", name, "FAILED").write.mode("append").parquet(audit)
        raise
    publish(spark, fact, name, settings, years)
    write_partitions(volumes.withColumn("fait", F.lit(name)), f"{settings.root}/{settings.staging}/volumes", ["fait", "annee"])
    checks.audit_row(fact, "build_gold", name, "SUCCESS").write.mode("append").parquet(audit)
    return summary


def volume_change(spark: SparkSession, name: str, volumes: DataFrame, years: list[int] | None, settings: Settings) -> float:
    """Change in percent of the rows of the years loaded now against the last load of these years that was published.

    Years that are new are no change; 0 at the first load.
    """
    try:
        before = spark.read.parquet(f"{settings.root}/{settings.staging}/volumes").filter(F.col("fait") == name)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0.0
    now = {r.annee: r.n for r in volumes.collect()}  # one row per year
    now = {**dict.fromkeys(years or [], 0), **now}
    held = {r.annee: r.n for r in before.filter(F.col("annee").isin(*now)).collect()} if now else {}
    total = sum(held.values())
    return 100.0 * abs(sum(now[year] for year in held) - total) / total if total else 0.0


def publish(spark: SparkSession, fact: DataFrame, name: str, settings: Settings, years: list[int] | None = None) -> None:
    """Replace the years of a checked fact (and `years`) in the gold zone; the other years keep their files."""
    write_fact(fact, f"{settings.gold}.{name}", BUCKET_KEYS.get(name, ()), settings.buckets.get(name, BUCKETS), years=years)


def build_gold(spark: SparkSession, sources: Sources, settings: Settings) -> DataFrame:
    """Run the load and return the reconciliation per fact; raise when a gate fails."""
    ensure_zones(spark, settings.root, (settings.staging, settings.gold))

    def save(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{settings.gold}.{name}")
        return spark.table(f"{settings.gold}.{name}")

    geography = save(dimensions.geography(sources.departments), "dim_geographie")
    surveyed = sources.surveys.select(F.col("finess_geo").alias("etab_id"),
                                      F.col("rs_finess_geo").alias("nom_etab"), "region")
    staged = {
        "fait_consultation": stage_source("fait_consultation", classified(
            sources.consultations, facts.consultation_rules(settings.first_year, settings.last_year))),
        "fait_hospitalisation": stage_source("fait_hospitalisation", classified(
            sources.stays, facts.stay_rules(settings.first_year, settings.last_year)))}
    admitting = staged["fait_hospitalisation"].select(F.col("identifiant_organisation").alias("etab_id"))
    establishments = save(dimensions.establishment(surveyed, admitting, geography), "dim_etablissement")
    official = establishments if sources.sites is None else sources.sites.select("etab_id").distinct()

    key = list(settings.consultation_key)
    located = geography.select("geo_id").filter(F.col("geo_id") != UNKNOWN_GEO)
    key_values = lambda df, column, name: df.select(F.col(column).cast("string").alias(name)).distinct()
    results = [
        load_fact(spark, "fait_consultation", staged["fait_consultation"],
                  lambda valid: facts.shape_consultations(valid, settings.master, settings.seed, key, settings.consultation_order),
                  key, key, settings, dims={"prof_id": key_values(sources.professionals, "identifiant", "prof_id")}),
        load_fact(spark, "fait_hospitalisation", staged["fait_hospitalisation"],
                  lambda valid: facts.shape_stays(valid, settings.master, settings.seed, settings.stay_order),
                  facts.STAY_KEY, ["patient_id", "num_hospitalisation", "date_id"], settings,
                  dims={"etab_id": establishments.select("etab_id")}),
        load_fact(spark, "fait_satisfaction", stage_source("fait_satisfaction", classified(
                      facts.flag_known_sites(sources.surveys, official), facts.survey_rules())),
                  lambda valid: facts.shape_surveys(valid, geography, settings.campaign),
                  ["finess_geo"], ["etab_id"], settings, [settings.campaign],
                  {"etab_id": establishments.select("etab_id"), "geo_id": located}),
        load_fact(spark, "fait_deces", stage_source("fait_deces", classified(
                      sources.deaths, facts.death_rules(settings.first_death_year))),
                  lambda valid: facts.shape_deaths(valid, sources.departments), [], None, settings,
                  dims={"geo_id": located}),
    ]
    for name in SURROGATES:
        analyse(spark, f"{settings.gold}.{name}")
    gold = {name: spark.table(f"{settings.gold}.{name}") for name in SURROGATES}

    days = [F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")]
    save(dimensions.calendar(dimensions.calendar_bounds(*[f.select(*days) for f in gold.values()])), "dim_temps")
    save(dimensions.diagnosis(gold["fait_consultation"], gold["fait_hospitalisation"]), "dim_diagnostic")
    save(dimensions.professional(sources.professionals, sources.specialties), "dim_professionnel")
    # The mapping stays out of the gold zone: only administrators may read it. It holds the listed patients and
    # those of the facts, by the first digits of the pseudonym, so that an erasure rewrites few files.
    secure = f"{settings.root}/secure/patient_mapping"
    persons = checks.stack([df.select(F.col("id_patient").cast("string").alias("id_patient")).distinct() for df in (
        sources.patients, *[rows.filter("statut = 'valide'") for rows in staged.values()])])
    mapping = build_mapping(persons, "id_patient", settings.master, settings.seed)
    (gather(mapping.withColumn("prefixe", F.substring("id_patient_pseudo", 1, 1)), F.col("prefixe"))
     .write.mode("overwrite").partitionBy("prefixe").parquet(secure))
    save(dimensions.patient(sources.patients, spark.read.parquet(secure)), "dim_patient")

    return stage(checks.stack(results), "reconciliation")


def integrity(spark: SparkSession, settings: Settings) -> DataFrame:
    """Post-load controls, all expected at zero."""
    table = lambda name: spark.table(f"{settings.gold}.{name}")
    conditions = {
        "fait_consultation": {"consultation_pseudonyme": checks.bad_pseudonym("patient_id"),
                              "consultation_duree_negative": F.col("duree_minutes") < 0},
        "fait_hospitalisation": {"sejour_pseudonyme": checks.bad_pseudonym("patient_id"),
                                 "sejour_duree_negative": F.col("duree_sejour") < 0},
        "fait_satisfaction": {"note_hors_plage": checks.out_of_range("note_satisfaction", 0, 10)},
    }
    rows = [checks.check_fact(table(name), [key], f"{name}.{key}", conditions.get(name, {}))
            for name, key in {**SURROGATES, **DIMENSION_KEYS}.items()]
    rows.append(checks.orphan_counts({
        "deces_geo_orphelins": (table("fait_deces"), "geo_id", table("dim_geographie"), "geo_id"),
        "sejour_diag_orphelins": (table("fait_hospitalisation"), "diag_id", table("dim_diagnostic"), "diag_id"),
        "consultation_temps_orphelins": (table("fait_consultation"), "date_id", table("dim_temps"), "date_id"),
    }).toDF("controle", "n_anomalies"))
    return checks.stack(rows)
