"""Row-level cleaning: rejects with a reason, duplicates, surrogate keys, replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.session import stage

REASON = "raison_rejet"
FILE_ROWS = 500_000  # of a numbered range: a file is one block, so whoever sorts what it reads holds no more
Rules = list[tuple[str, Column]]


def classify(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the first reason that rejects a row, NULL for a valid row.

    A rule whose condition is NULL does not reject.
    """
    reason = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return df.withColumn(REASON, reason)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull()).drop(REASON)


def unrejected(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that no rule rejects, by one condition per rule: each is met as early as its columns are there, also before a join."""
    for _, condition in rules:
        df = df.filter(~F.coalesce(condition, F.lit(False)))
    return df


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNotNull())


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose mandatory columns are all present."""
    return df.dropna(subset=columns)


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key; `order` must be total within a key.

    Spark keeps only the leading row of each key on the map side before the shuffle
    (WindowGroupLimit), so a key that holds many rows does not fill one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys met more than once, with the number of rows that deduplication removes."""
    return (df.groupBy(*keys).agg((F.count("*") - 1).alias("n_doublons"))
            .filter("n_doublons > 0"))


def surrogate_key(df: DataFrame, name: str, order: list[str], drop: tuple[str, ...] = (),
                  unique: bool = True, hexadecimal: tuple[str, ...] = (), late: dict[str, Column] | None = None) -> DataFrame:
    """Number rows 1..n in a global order without sorting them in one task.

    Rows are range-partitioned on the order columns and sorted inside each range. The
    ranges are staged, because counting them and numbering them must see the same cut;
    the count then reads a single column. `drop` names order columns that must not be
    stored with the numbered rows. Columns of lower-case `hexadecimal` digests travel and are staged as
    bytes, in half the room and the same order. `late` columns are computed where a row has come to its place and do
    not travel; the order may name them.

    When the order is not `unique`, a last random column splits runs of equal rows,
    which any numbering may permute. It is drawn over a staged copy: a recomputed task
    then reads the same rows in the same order and draws the same values, so no row can
    change range after the loss of an executor.
    """
    late = {c: F.unhex(v) if c in hexadecimal else v for c, v in (late or {}).items()}
    df = df.withColumns({c: F.unhex(c) for c in hexadecimal if c not in late})
    if unique:
        source, sort = df, [late.get(c, c) for c in order]
    else:
        source, sort = stage(df, f"{name}-source").withColumn("_split", F.rand(1)), [*[late.get(c, c) for c in order], "_split"]
    ranged = source.repartitionByRange(*sort).sortWithinPartitions(*sort)
    kept = [*[c for c in df.columns if c not in drop], *late]
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(ranged.withColumns(late).select(*kept, F.spark_partition_id().alias("_range"), in_range.alias("_position")),
                   name, maxRecordsPerFile=FILE_ROWS, compression="zstd")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_range").count()
               .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")))
    # One row per range of the partitioning: never more than the shuffle partitions.
    texts = [F.lower(F.hex(c)).alias(c) if c in hexadecimal else F.col(c) for c in kept]
    return (placed.join(F.broadcast(offsets), "_range")
            .select((F.col("_offset") + F.col("_position") + 1).alias(name), *texts))


def shift_years(df: DataFrame, copies: int, key: str, date_key: str, year: str,
                step: int = 1_000_000_000_000) -> DataFrame:
    """Replicate a fact on the preceding years: copy k is moved back k years.

    Keys move by `step`, which must exceed every key of the fact (a larger key fails the
    job). The 29th of February becomes the 28th in a year without it.
    """
    shift = F.explode(F.array(*[F.lit(k) for k in range(copies)]))
    moved = F.col(year) - F.col("_shift")
    leap = (moved % 4 == 0) & ((moved % 100 != 0) | (moved % 400 == 0))
    lost = F.when((F.col(date_key) % 10_000 == 229) & ~leap, 1).otherwise(0)
    fits = F.when(F.abs(F.col(key)) >= F.lit(step), F.raise_error(F.lit(f"{key} exceeds the step of the copies"))).otherwise(F.col(key))
    return (df.withColumn("_shift", shift)
            .withColumn(key, fits.cast("long") + F.col("_shift").cast("long") * step)
            .withColumn(date_key, (F.col(date_key) - F.col("_shift") * 10_000 - lost).cast("int"))
            .withColumn(year, moved)
            .drop("_shift"))
