"""Quality checks after a load, reconciliation, gates and audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.functions.values import percent
from klinark.operators.joins import lookup
from klinark.operators.rows import REASON, accepted, duplicates, rejected


class GateFailed(ValueError):
    """A load does not meet its thresholds."""


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys met more than once (none after a correct load)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row: number of rows in excess of one per key."""
    excess = F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).cast("long")
    return (df.groupBy(*keys).agg(F.count("*").alias("n"))
            .agg(excess.alias("n_anomalies")).select(F.lit(name).alias("controle"), "n_anomalies"))


def _labelled(one_row: DataFrame, labels: list[str]) -> DataFrame:
    """Turn the columns c0, c1... of a one-row frame into one labelled row each."""
    entries = F.array(*[F.struct(F.lit(label).alias("controle"), F.col(f"c{i}").alias("n_anomalies"))
                        for i, label in enumerate(labels)])
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def check_fact(df: DataFrame, keys: list[str], name: str, conditions: dict[str, Column]) -> DataFrame:
    """Uniqueness of a key and named row conditions, in one pass over a fact.

    Rows of a key are counted along the sort by key, which a fact without duplicates already has from their removal; a hash
    table would hold every key of the task, since all differ.
    """
    flags = [condition.alias(f"c{i}") for i, condition in enumerate(conditions.values(), 1)]
    so_far = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = df.select(*keys, *flags).withColumn("c0", F.count("*").over(so_far) > 1)
    return _labelled(marked.agg(*[F.count_if(f"c{i}").alias(f"c{i}") for i in range(len(conditions) + 1)]), [name, *conditions])


def check_rows(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row per named condition: rows for which it holds; one pass for all."""
    one_row = df.agg(*[F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(conditions.values())])
    return _labelled(one_row, list(conditions))


def bad_pseudonym(column: str) -> Column:
    """True unless the value is a 64-character hash."""
    return F.col(column).isNull() | (F.length(column) != 64)


def out_of_range(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def forbidden_columns(df: DataFrame, forbidden) -> list[str]:
    """Columns that should not be published, found in a frame."""
    return [c for c in df.columns if c.lower() in forbidden]


def assert_no_columns(df: DataFrame, forbidden) -> DataFrame:
    found = forbidden_columns(df, forbidden)
    if found:
        raise ValueError(f"personal data in a published table: {', '.join(found)}")
    return df


def unknown_share(df: DataFrame, column: str, unknown: str, weight: Column | None = None) -> DataFrame:
    """Rows whose key was not resolved, all rows, and the share in percent."""
    size = weight if weight is not None else F.lit(1)
    inconnus = F.sum(F.when(F.col(column) == unknown, size).otherwise(0))
    return (df.agg(inconnus.cast("long").alias("n_inconnu"), F.sum(size).cast("long").alias("total"))
            .withColumn("pct_inconnu", percent(F.col("n_inconnu"), F.col("total"), 2)))


def orphans(fact: DataFrame, fk: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key is not in the dimension (missing keys included)."""
    return lookup(fact, dim.select(F.col(key).alias(fk)), fk, "left_anti")


def orphan_counts(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Number of orphan rows per named foreign key."""
    return stack([orphans(*check).agg(F.count("*").alias("n_orphelins"))
                  .select(F.lit(name).alias("cle"), "n_orphelins")
                  for name, check in checks.items()])


def match_rate(fact: DataFrame, fk: str, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Share of rows whose foreign key exists in the dimension.

    The fact is first counted per key value, so the join meets each value once.
    """
    per_key = fact.groupBy(fk).agg(F.count("*").alias("n"))
    known = dim.select(F.col(key).alias(fk)).distinct().withColumn("_hit", F.lit(1))
    hits = F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("n"))), F.lit(0))
    return (per_key.join(known, fk, "left")
            .agg(hits.cast("long").alias("n_resolus"), F.sum("n").cast("long").alias("total"))
            .select(F.lit(name).alias("dimension"), "n_resolus", "total")
            .withColumn("taux_pct", percent(F.col("n_resolus"), F.col("total"), 2)))


def reason_counts(rejects: dict[str, DataFrame]) -> DataFrame:
    """Rejects per source and reason."""
    return stack([df.groupBy(REASON).agg(F.count("*").alias("n"))
                  .select(F.lit(source).alias("source"), REASON, "n")
                  for source, df in rejects.items()])


def reconcile(classified: DataFrame, keys: list[str]) -> DataFrame:
    """One row: bronze, rejected, duplicate and loaded rows; `ecart` must be zero.

    Valid rows are counted per key, so each row is accounted for exactly once.
    """
    valid = F.col(REASON).isNull()
    per_key = (classified.groupBy(*[F.when(valid, F.col(k)).alias(k) for k in keys], REASON)
               .agg(F.count("*").alias("n")))
    total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("long")
    return (per_key.agg(
        total(F.col("n")).alias("bronze"),
        total(F.when(valid, 1)).alias("charge"),
        total(F.when(valid, F.col("n") - 1)).alias("doublons"),
        total(F.when(~valid, F.col("n"))).alias("rejets"))
        .withColumn("ecart", F.col("bronze") - F.col("charge") - F.col("doublons") - F.col("rejets")))


def reconcile_written(source: DataFrame, classified: DataFrame, fact: DataFrame, keys: list[str]) -> DataFrame:
    """One row as `reconcile`, but each term is counted from its own table: `ecart` shows rows that were lost or doubled."""
    valid = accepted(classified)
    total = lambda df, count: df.agg(F.coalesce(count, F.lit(0)).cast("long")).scalar()
    return (source.agg(F.count("*").alias("bronze"))
            .select("bronze", total(fact, F.count("*")).alias("charge"),
                    total(duplicates(valid, keys), F.sum("n_doublons")).alias("doublons"),
                    total(rejected(classified), F.count("*")).alias("rejets"))
            .withColumn("ecart", F.col("bronze") - F.col("charge") - F.col("doublons") - F.col("rejets")))


def reconcile_stages(stages: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows and distinct values of the given columns, stage by stage."""
    return stack([df.agg(F.count("*").alias("n_lignes"),
                         *[F.count_distinct(F.col(c)).alias(f"n_axe_{i}")
                           for i, c in enumerate(columns, 1)])
                  .select(F.lit(name).alias("etape"), "n_lignes",
                          *[f"n_axe_{i}" for i in range(1, len(columns) + 1)])
                  for name, (df, columns) in stages.items()])


def gates(metrics: DataFrame, thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """Compare the columns of a one-row frame with thresholds (`min` or `max`, bound)."""
    entries = []
    for name, (kind, bound) in thresholds.items():
        value = F.col(name).cast("double")
        ok = value >= bound if kind == "min" else value <= bound
        entries.append(F.struct(F.lit(name).alias("seuil"), value.alias("valeur"),
                                F.lit(float(bound)).alias("borne"),
                                F.coalesce(ok, F.lit(False)).alias("respecte")))
    return metrics.select(F.explode(F.array(*entries)).alias("g")).select("g.*")


def enforce(gate_rows: DataFrame) -> None:
    """Stop a load whose gates are not all met (one row per gate is collected)."""
    failed = [f"{r.seuil}={r.valeur} (bound {r.borne})"
              for r in gate_rows.filter(~F.col("respecte")).collect()]
    if failed:
        raise GateFailed("; ".join(failed))


def audit_row(df: DataFrame, job: str, phase: str, status: str, moment: Column | None = None) -> DataFrame:
    """One audit line of a load, to be appended to the audit log."""
    when = moment if moment is not None else F.current_timestamp()
    return df.agg(F.count("*").alias("nb_lignes")).select(
        F.lit(job).alias("job"), F.lit(phase).alias("phase"), "nb_lignes",
        F.lit(status).alias("statut"), when.alias("horodatage"))
