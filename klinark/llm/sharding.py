"""Shards by jump consistent hashing, and gapless numbers inside each shard, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.session import stage

# Fixed values of jump consistent hashing: its linear congruential generator on 64 bits.
MULTIPLIER = 2862933555777941757
WORD = 1 << 64

BUCKETS = 4096  # parts of a shard that are numbered on their own


def _number(value: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({len(str(value))},0)")


def _unsigned(key: Column) -> Column:
    """A long as an unsigned 64-bit number; null counts as 0."""
    wide = F.coalesce(key.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.when(wide < 0, wide + _number(WORD)).otherwise(wide).cast("decimal(20,0)")


def _next_state(state: Column) -> Column:
    return ((state * _number(MULTIPLIER) + 1) % _number(WORD)).cast("decimal(20,0)")


def _high_bits(state: Column, bits: int) -> Column:
    """The leading bits of a 64-bit state as a long."""
    return F.floor(state.cast("decimal(38,18)") / F.lit(str(1 << (64 - bits))).cast("decimal(20,0)")).cast("long")


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long key.

    The key seeds a generator whose draws are jumps to ever later shards; the last one
    before `shards` is the shard. With one more shard a key either stays or goes to the new
    shard. A jump always goes at least one shard on, so `shards` steps suffice; finished
    keys skip the rest.
    """
    start = F.struct(_unsigned(key).alias("state"), F.lit(-1).cast("long").alias("shard"),
                     F.lit(0).cast("long").alias("next"))

    def step(now: Column, _: Column) -> Column:
        jumped = F.transform(F.array(_next_state(now["state"])), lambda state: F.struct(
            state.alias("state"), now["next"].alias("shard"),
            F.floor((now["next"] + 1) * (F.lit(float(1 << 31)) / (_high_bits(state, 31) + 1))).alias("next")))
        return F.when(now["next"] < shards, jumped[0]).otherwise(now)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["shard"].cast("int")


def shard_rows(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Add the shard of each row; no row moves."""
    return df.withColumn(name, jump_shard(F.col(key), shards))


def number_slots(digests: DataFrame, shard: str, key: str, name: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... by (bucket of the key, all columns).

    Equal rows are counted before the shuffle and written out again at the end, so a group
    of them is never sorted. Each shard is cut into 4,096 buckets by the key, each bucket into runs
    of rows with the same values in the first two columns. A run is numbered by itself and starts
    where the ones before it end; so rows of one key with many different texts are sorted
    by many tasks. The starts are one row per run.
    """
    columns = digests.columns
    leading = columns[:2]
    bucket = _high_bits(_next_state(_unsigned(F.col(key))), 12)
    counted = stage(digests.withColumn("_bucket", bucket).groupBy("_bucket", *columns)
                    .agg(F.count("*").alias("_count")), "slots")
    past = (Window.unboundedPreceding, -1)

    def before(total: str, window) -> Column:
        return F.coalesce(F.sum(total).over(window.rowsBetween(*past)), F.lit(0))

    runs = counted.groupBy(shard, "_bucket", *leading).agg(F.sum("_count").alias("_total"))
    buckets = runs.groupBy(shard, "_bucket").agg(F.sum("_total").alias("_all"))
    buckets = buckets.select(shard, "_bucket", before("_all", Window.partitionBy(shard).orderBy("_bucket")).alias("_first"))
    in_bucket = Window.partitionBy(shard, "_bucket").orderBy(*leading)
    starts = (runs.withColumn("_past", before("_total", in_bucket)).join(buckets, [shard, "_bucket"])
              .select((F.col("_first") + F.col("_past")).alias("_start"),
                      *[F.col(c).alias(f"_own_{k}") for k, c in enumerate([shard, "_bucket", *leading])]))
    in_run = Window.partitionBy(shard, "_bucket", *leading).orderBy(*[F.col(c) for c in columns])
    placed = counted.withColumn("_inside", before("_count", in_run))
    same = [placed[c].eqNullSafe(starts[f"_own_{k}"]) for k, c in enumerate([shard, "_bucket", *leading])]
    first = F.col("_start") + F.col("_inside")
    return (placed.join(starts, same)
            .select(*[placed[c] for c in columns], F.explode(F.sequence(first, first + F.col("_count") - 1)).alias(name)))


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every document by its id: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    The law is `key`: doc_id and the number of shards decide. size is the UTF-8 length plus 1,
    text_crc32 the unsigned checksum of the text, slot the gapless place in the shard and
    grown_shard the shard with one shard more.

    A null text has size 1 and checksum 0, like an empty one; a null doc_id is placed as id 0;
    repeated rows get one slot each; an empty table gives no row; other columns are ignored.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = shard_rows(shard_rows(rows, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    numbered = number_slots(placed, "shard", "doc_id")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
