"""Index of loaded keys: bucketed key files and one Bloom filter per bucket, so that a batch reads few of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.operators.keymap import digest
from klinark.operators.layout import write_partitions
from klinark.session import stage

BATCH, BUCKET = "lot", "seau"
PAGE_BITS = 32_768  # fixed value: bits of one bitmap of the bitmap functions
MERGED = -1         # batch number of compacted key files


@dataclass(frozen=True)
class KeyIndex:
    """Keys loaded so far, below `root`.

    `cles/seau=b/lot=k` has the digests that batch k added to bucket b. `filtres/seau=b` has the Bloom filter of
    bucket b over all batches: `pages` bitmaps of 32,768 bits, `probes` bits per key. Filters have a fixed size;
    where they fill up more buckets are read, and none that holds a key is missed.
    """

    root: str
    buckets: int = 64
    pages: int = 4
    probes: int = 4

    @property
    def keys(self) -> str:
        return f"{self.root}/cles"

    @property
    def filters(self) -> str:
        return f"{self.root}/filtres"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def keyed(df: DataFrame, index: KeyIndex, keys: list[str]) -> DataFrame:
    """Rows with the digest of their key and its bucket."""
    return (df.withColumn("_cle", digest(keys))
            .withColumn(BUCKET, F.pmod(F.xxhash64("_cle"), F.lit(index.buckets)).cast("int")))


def places(index: KeyIndex) -> list[Column]:
    """Places of a key in the filter of its bucket: page and bit, one for each probe."""
    def place(number: int) -> Column:
        at = F.pmod(F.xxhash64(F.lit(number), F.col("_cle")), F.lit(index.pages * PAGE_BITS))
        return F.struct(F.floor(at / PAGE_BITS).cast("int").alias("page"), (at % PAGE_BITS).cast("int").alias("bit"))
    return [place(i) for i in range(index.probes)]


def probes(index: KeyIndex) -> Column:
    """One row for each probe of a key."""
    return F.explode(F.array(*places(index)))


def _bit(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << n) for n in range(8)]), bit % 8 + 1)) != 0


def hit_buckets(spark: SparkSession, index: KeyIndex, batch: DataFrame) -> list[int]:
    """Buckets whose filter may hold a key of the batch, at most `index.buckets` numbers.

    Reads the filters only: a table of fixed size, whatever the history. A key may be held if all its bits are set.
    """
    filters = _read(spark, index.filters)
    if filters is None:
        return []
    # One row per bucket, with the bitmaps of its pages: never more than the fixed size of the filters. Each key is
    # tested where it lies, so nothing of the batch is shuffled.
    pages = filters.groupBy(BUCKET).agg(F.map_from_entries(F.collect_list(F.struct("page", "bitmap"))).alias("_pages"))
    met = batch.select("_cle", BUCKET).join(F.broadcast(pages), BUCKET)
    held = reduce(and_, [F.coalesce(_bit(F.try_element_at("_pages", p["page"]), p["bit"]), F.lit(False)) for p in places(index)])
    return sorted(r[0] for r in met.filter(held).select(BUCKET).distinct().collect())


def known_keys(spark: SparkSession, index: KeyIndex, batch: DataFrame, batch_id: int) -> DataFrame | None:
    """Keys that other batches loaded, in the buckets the batch may hit; None if there are none.

    The buckets are given as literals, so they prune the folders before a file is opened.
    """
    wanted = hit_buckets(spark, index, batch)
    keys = _read(spark, index.keys) if wanted else None
    if keys is None:
        return None
    return keys.filter(F.col(BUCKET).isin(wanted) & (F.col(BATCH) != batch_id)).select("_cle", BUCKET)


def add_keys(spark: SparkSession, index: KeyIndex, batch: DataFrame, batch_id: int) -> None:
    """Add the keys of a loaded batch and set their bits; a repeated call replaces its own keys.

    Keys go first: a failure before the filters is followed by a replay of the batch, which adds them again. A key that
    the batch holds twice is noted twice, which changes no answer; `compact` leaves one.
    """
    own = batch.select("_cle", BUCKET).withColumn(BATCH, F.lit(batch_id))
    write_partitions(own, index.keys, [BUCKET, BATCH])
    _set_bits(spark, index, batch.select("_cle", BUCKET))


def _bitmaps(index: KeyIndex, keys: DataFrame) -> DataFrame:
    return (keys.select(BUCKET, probes(index).alias("p")).select(BUCKET, "p.*")
            .groupBy(BUCKET, "page").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def _set_bits(spark: SparkSession, index: KeyIndex, keys: DataFrame) -> None:
    """Merge new bits into the filters of the buckets they fall in; the others keep their files."""
    fresh = stage(_bitmaps(index, keys), "filtres-nouveaux")
    before = _read(spark, index.filters)
    if before is not None:
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most `index.buckets`
        fresh = stage(fresh.unionByName(before.filter(F.col(BUCKET).isin(touched)).select(*fresh.columns))
                      .groupBy(BUCKET, "page").agg(F.bitmap_or_agg("bitmap").alias("bitmap")), "filtres")
    write_partitions(fresh, index.filters, [BUCKET])


def rebuild(spark: SparkSession, index: KeyIndex, loaded: DataFrame, keys: list[str]) -> None:
    """Make the index again from the loaded rows (with their column `lot`), such as after a lost folder."""
    rows = keyed(loaded, index, keys).select("_cle", BUCKET, BATCH)
    rows.write.mode("overwrite").partitionBy(BUCKET, BATCH).parquet(index.keys)
    _bitmaps(index, rows).write.mode("overwrite").partitionBy(BUCKET).parquet(index.filters)


def compact(spark: SparkSession, index: KeyIndex) -> KeyIndex:
    """A copy of the index below `<root>-tasse`, with one folder for each bucket, to be used from the next call on.

    The old folders stay until the caller removes them, so a load that runs meanwhile loses nothing it reads.
    """
    packed = KeyIndex(f"{index.root}-tasse", index.buckets, index.pages, index.probes)
    keys = spark.read.parquet(index.keys).select("_cle", BUCKET).distinct().withColumn(BATCH, F.lit(MERGED))
    keys.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET, BATCH).parquet(packed.keys)
    spark.read.parquet(index.filters).write.mode("overwrite").partitionBy(BUCKET).parquet(packed.filters)
    return packed
