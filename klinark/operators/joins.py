"""Joins of a large frame with a dimension, and follow-up of events in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join many rows with a dimension that holds one row per key.

    No hint: adaptive execution broadcasts the dimension when its measured bytes are small,
    else both sides are shuffled and the partitions of a key with many rows are split.
    """
    return df.join(dim, on, how)


def resolve_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Add `<key>_connu` flags telling whether each foreign key exists in its dimension.

    `dims` maps a foreign key of the fact to (dimension, key column).
    """
    for fk, (dim, key) in dims.items():
        flag = f"{fk}_connu"
        known = dim.select(F.col(key).alias(fk)).filter(F.col(fk).isNotNull()).distinct()
        fact = lookup(fact, known.withColumn(flag, F.lit(True)), fk)
        fact = fact.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return fact


def event_within(df: DataFrame, events: DataFrame, key: str, start: str, event_date: str,
                 days: int, flag: str) -> DataFrame:
    """Flag rows followed, the same day or at most `days` days later, by an event.

    Time is cut in slots of `days` days. For a row in slot s, any event of slot s from
    its date on is close enough, and an event of slot s+1 is if it is at most `days`
    days away. So the latest event of slot s and the earliest of slot s+1 decide, and
    the events shrink to one row per key and slot before the join: no pair of rows of
    one key is ever built, and a busy key is spread over its slots.
    """
    def slot(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days)

    per_slot = (events.filter(F.col(key).isNotNull() & F.col(event_date).isNotNull())
                .groupBy(F.col(key), slot(F.col(event_date)).alias("_slot"))
                .agg(F.min(event_date).alias("_first"), F.max(event_date).alias("_last")))
    sides = F.explode(F.array(
        F.struct(F.col("_slot").alias("_slot"), F.col("_last").alias("_here"),
                 F.lit(None).cast("date").alias("_next")),
        F.struct((F.col("_slot") - 1).alias("_slot"), F.lit(None).cast("date").alias("_here"),
                 F.col("_first").alias("_next"))))
    around = (per_slot.select(key, sides.alias("s")).select(key, "s.*")
              .groupBy(key, "_slot").agg(F.max("_here").alias("_here"), F.min("_next").alias("_next")))
    close = (F.col("_here") >= F.col(start)) | (F.col("_next") <= F.date_add(start, days))
    asked = F.col(key).isNotNull() & F.col(start).isNotNull()
    found = (df.filter(asked).withColumn("_slot", slot(F.col(start)))
             .join(around, [key, "_slot"], "left")
             .withColumn(flag, F.coalesce(close, F.lit(False)))
             .select(*df.columns, flag))
    # rows that nothing can follow skip the join, where they would all meet in one task
    return found.unionByName(df.filter(~asked).withColumn(flag, F.lit(False)))


def readmission(df: DataFrame, key: str, admission: str, discharge: str, stay_id: str,
                days: int, flag: str) -> DataFrame:
    """Flag stays followed by another one after discharge and within `days` days.

    The next stay is the next row of the key by (admission, stay id). Stays admitted
    the same day follow each other without a gap, so only the last one of each day can
    be flagged. Rows are therefore first reduced to one per key and day, which bounds
    the window of any key by the number of days of the history.
    """
    per_day = (df.filter(F.col(key).isNotNull() & F.col(admission).isNotNull())
               .groupBy(key, admission)
               .agg(F.max(stay_id).alias("_id"), F.max_by(discharge, stay_id).alias("_out")))
    following = F.lead(admission).over(Window.partitionBy(key).orderBy(admission))
    readmitted = (per_day.select(F.col("_id").alias(stay_id), "_out", following.alias("_next"))
                  .filter((F.col("_next") > F.col("_out"))
                          & (F.col("_next") <= F.date_add("_out", days)))
                  .select(stay_id, F.lit(True).alias(flag)))
    return (df.join(readmitted, stay_id, "left")
            .withColumn(flag, F.coalesce(flag, F.lit(False))))
