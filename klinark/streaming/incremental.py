"""Incremental load of arriving files with the batch builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klinark.operators.layout import replace_batch
from klinark.operators.rows import REASON, accepted, classify, rejected
from klinark.session import stage
from klinark.streaming.keyindex import BATCH, KeyIndex, add_keys, keyed, known_keys


def incremental_load(spark: SparkSession, path: str, schema: T.StructType, root: str, rules: list,
                     prepare: Callable[[DataFrame], DataFrame],
                     shape: Callable[[DataFrame], DataFrame], keys: list[str],
                     fmt: str = "parquet", options: dict | None = None, index: KeyIndex | None = None) -> None:
    """Load the files that arrived since the last call, then stop.

    Each micro-batch goes through the batch rules and `shape`; a row whose key another
    batch already loaded is left out. The loaded keys are in an index (`<root>/index` if none is given): the batch
    reads its filters, of fixed size, and only the buckets that may hold one of its keys, never the loaded rows. Valid rows and rejects are written in the
    partition of their batch, which a replayed batch overwrites: a file counts once even
    after a failure. Progress is kept in `<root>/checkpoint`.
    """
    seen = index or KeyIndex(f"{root}/index")

    def load(batch: DataFrame, batch_id: int) -> None:
        classified = classify(prepare(batch), rules)
        fresh = keyed(stage(shape(accepted(classified)), "increment"), seen, keys)  # digests are computed where they are read
        known = known_keys(spark, seen, fresh, batch_id)
        if known is not None:  # keys alone are shuffled; whole rows only where some were loaded before and some not
            again = stage(fresh.select("_cle", "seau").join(known, ["_cle", "seau"], "left_semi"), "deja-charges")
            found = again.count()
            if found == fresh.count():
                fresh = fresh.limit(0)
            elif found:
                fresh = fresh.join(again, ["_cle", "seau"], "left_anti")
        # a batch is one partition: its rows are written by the tasks that hold them, without a shuffle
        replace_batch(fresh.drop("_cle", "seau"), f"{root}/valides", {BATCH: str(batch_id)})
        written = spark.read.schema(fresh.drop("_cle", "seau").schema).parquet(f"{root}/valides/{BATCH}={batch_id}")
        add_keys(spark, seen, keyed(written, seen, keys), batch_id)
        refused = rejected(classified)
        lines = F.to_json(F.struct(*[c for c in refused.columns if c != REASON]))
        replace_batch(refused.select(lines.alias("ligne_source"), REASON), f"{root}/rejets", {BATCH: str(batch_id)})

    stream = spark.readStream.schema(schema).options(**(options or {})).format(fmt).load(path)
    (stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
