"""Right to erasure: patients are taken out of facts, dimensions, mapping and rejects by rewriting what holds them.

Every rewrite has two steps. The rows that stay are first written whole to the staging folder and noted in a journal;
then they replace the partitions they came from. A failure before the second step leaves the old rows, a failure within it
is mended by `resume`, which replaces again from the noted copy.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.functions.privacy import canonical_id, pseudonym
from klinark.operators.layout import COMPRESSION, clear_partition, replace_batch, write_fact, write_partitions, write_table
from klinark.session import small_reads, stage, staging_path

PENDING, DONE = "PRET", "FAIT"
JOURNAL = "operation string, cible string, genre string, partitions array<string>, copie string, etat string, ts timestamp"


@dataclass
class Target:
    """A table or folder that holds rows of patients.

    `kind` is "table" for a catalog table and "dossier" for a folder of Parquet files; `partitions` are its
    partition columns (none: it is replaced whole); `person` is the column or expression that is compared.
    """

    name: str
    kind: str
    partitions: tuple[str, ...]
    person: Column
    bucket_by: tuple[str, ...] = ()
    buckets: int = 8

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name) if self.kind == "table" else spark.read.parquet(self.name)

    def exists(self, spark: SparkSession) -> bool:
        if self.kind == "table":
            return spark.catalog.tableExists(self.name)
        try:
            return bool(self.read(spark).columns)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False


def _note(spark: SparkSession, journal: str, operation: str, target: Target, values: list[str], copy: str, state: str) -> None:
    row = spark.createDataFrame([(operation, target.name, target.kind, values, copy, state)], JOURNAL.rsplit(", ", 1)[0])
    row.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(journal)


def _places(target: Target) -> Column:
    """Name of the partition of a row, such as annee=1999."""
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in target.partitions]
    return F.concat_ws("/", *parts) if parts else F.lit("")


def _digest(person: Column) -> Column:
    """Eight bytes that stand for a person in a join, so that a million persons are small enough for a broadcast."""
    return F.xxhash64(person)


def swap(spark: SparkSession, target: Target, values: list[str], copy: str) -> None:
    """Replace the named partitions of a target by the rows of its copy; the others keep their files.

    The copy was read file by file from these partitions, so its rows are written where they lie, without a shuffle.
    """
    rows = spark.read.parquet(copy)
    if target.kind == "table" and target.partitions:
        (year,) = target.partitions
        write_fact(rows, target.name, target.bucket_by, target.buckets, year=year,
                   years=[int(v.split("=")[1]) for v in values], lying=True)
    elif target.kind == "table":
        write_table(rows, target.name, bucket_by=target.bucket_by, buckets=target.buckets, lying=True)
    else:
        left = {r[0] for r in rows.select(_places(target)).distinct().collect()}  # at most the partitions that are replaced
        if left:
            write_partitions(rows, target.name, list(target.partitions), lying=True)
        for value in sorted(set(values) - left):
            replace_batch(rows.drop(*target.partitions).limit(0), target.name, dict(p.split("=", 1) for p in value.split("/")))
    if target.kind == "table":
        spark.catalog.refreshTable(target.name)


def erase_from(spark: SparkSession, targets: list[Target], persons: DataFrame, journal: str) -> DataFrame:
    """Remove every row of `persons` (one column `personne`) from the targets; what was removed per partition.

    Only partitions that hold such rows are read whole and rewritten. Persons that no target holds change
    nothing. Null persons match no row. All copies are written and counted before the first partition is replaced.
    Rows meet the digests of persons; their texts are compared for the rows found, and for all rows where one that is
    not wanted shares a digest.
    """
    operation = uuid.uuid4().hex
    wanted = stage(persons.select(F.col("personne").cast("string").alias("_personne"))
                   .filter("_personne is not null").distinct(), "effacement-personnes")
    digests = stage(wanted.select(_digest(F.col("_personne")).alias("_empreinte")).distinct(), "effacement-empreintes")
    reports, plans = [], []
    for target in targets:
        if not target.exists(spark):
            continue
        rows = target.read(spark)
        marked = (rows.withColumn("_personne", target.person.cast("string")).withColumn("_place", _places(target))
                  .withColumn("_empreinte", _digest(F.col("_personne"))))
        found = stage(marked.select("_personne", "_place", "_empreinte").join(digests, "_empreinte", "left_semi")
                      .groupBy("_personne", "_place").agg(F.count("*").alias("n")), "effacement-trouves")
        hits = stage(found.join(wanted, "_personne", "left_semi").groupBy("_place").agg(F.sum("n").alias("n")), "effacement-lignes")
        values = [r[0] for r in hits.select("_place").collect()]  # one row per partition
        if not values:
            continue
        touched = marked.filter(F.col("_place").isin(values)) if target.partitions else marked
        copy = staging_path(spark, "effacement")
        alike = not found.join(wanted, "_personne", "left_anti").isEmpty()
        kept = touched.join(wanted, "_personne", "left_anti") if alike else touched.join(digests, "_empreinte", "left_anti")
        with small_reads(spark):
            kept.drop("_personne", "_place", "_empreinte").write.option("compression", COMPRESSION).parquet(copy)
        before, erased = touched.count(), hits.agg(F.sum("n")).first()[0]
        if spark.read.parquet(copy).count() + erased != before:
            raise RuntimeError(f"{target.name}: the copy is not complete, nothing was replaced")
        reports.append(hits.select(F.lit(target.name).alias("cible"), F.col("_place").alias("partition"), F.col("n").alias("n_effaces")))
        plans.append((target, values, copy))
    for target, values, copy in plans:
        _note(spark, journal, operation, target, values, copy, PENDING)
    for target, values, copy in plans:
        swap(spark, target, values, copy)
        _note(spark, journal, operation, target, values, copy, DONE)
    if not reports:
        return spark.createDataFrame([], "cible string, partition string, n_effaces long")
    out = reports[0]
    for report in reports[1:]:
        out = out.unionAll(report)
    return out


def resume(spark: SparkSession, targets: list[Target], journal: str) -> list[str]:
    """Finish replacements that were noted but not done; the names of the targets they concern."""
    notes = spark.read.schema(JOURNAL).parquet(journal)
    open_ = notes.filter(F.col("etat") == PENDING).join(
        notes.filter(F.col("etat") == DONE).select("operation", "cible"), ["operation", "cible"], "left_anti")
    by_name, mended = {t.name: t for t in targets}, []
    for row in open_.orderBy("ts").collect():  # one row per table of an operation that failed
        target = by_name[row.cible]
        swap(spark, target, list(row.partitions), row.copie)
        _note(spark, journal, row.operation, target, list(row.partitions), row.copie, DONE)
        mended.append(row.cible)
    return mended


def gold_targets(settings) -> tuple[list[Target], list[Target]]:
    """What holds patients after a load: by pseudonym, and by clear identifier."""
    from klinark.schemas import BUCKET_KEYS, BUCKETS
    facts = [Target(f"{settings.gold}.{name}", "table", ("annee",), F.col("patient_id"), BUCKET_KEYS[name],
                    settings.buckets.get(name, BUCKETS)) for name in ("fait_consultation", "fait_hospitalisation")]
    hidden = [*facts, Target(f"{settings.gold}.dim_patient", "table", (), F.col("patient_id"))]
    clear = [Target(f"{settings.root}/secure/patient_mapping", "dossier", ("prefixe",), F.col("id_patient_original")),
             Target(f"{settings.root}/{settings.staging}/rejets", "dossier", ("source", "lot"),
                    canonical_id(F.get_json_object("ligne_source", "$.id_patient")))]
    return hidden, clear


def erase_from_gold(spark: SparkSession, settings, patients: DataFrame, column: str = "id_patient") -> DataFrame:
    """Erase patients, given by their clear identifiers, from facts, patient dimension, rejects and mapping.

    The mapping goes last: until then a failed run can be repeated with the same identifiers.
    Pseudonyms are computed, so a patient who is not in the mapping is erased as well.
    """
    hidden, clear = gold_targets(settings)
    journal = f"{settings.root}/{settings.staging}/effacements"
    known = patients.select(canonical_id(F.col(column)).alias("personne")).filter("personne is not null").distinct()
    secret = known.select(pseudonym(F.col("personne"), settings.master, settings.seed).alias("personne"))
    report = stage(erase_from(spark, hidden, secret, journal), "effacement-faits")
    return report.unionAll(stage(erase_from(spark, clear[::-1], known, journal), "effacement-clair"))


def resume_in_gold(spark: SparkSession, settings) -> list[str]:
    """Finish an erasure of `erase_from_gold` that failed while it replaced partitions."""
    hidden, clear = gold_targets(settings)
    return resume(spark, hidden + clear, f"{settings.root}/{settings.staging}/effacements")
