"""Token counts of documents from flat token files without an index, by a scan for separators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.llm.shared import small_batches
from klinark.session import stage, staging_path

BLOCK_TOKENS = 1 << 18  # tokens of a block
TASK_BYTES = 1 << 27    # bytes of token files that one task reads
BATCH_ROWS = 1000       # documents of an Arrow batch
RUN_BLOCKS = 1024       # blocks that one window of the prefix scan holds


def write_tokens(encoded: DataFrame, eod: int, width: int, key: str = "doc_id", ids: str = "ids",
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token files from encoded documents: (file, block, tokens, keys).

    Each task writes one file: its documents one after the other, each closed by `eod`, as
    little-endian numbers of `width` bytes, cut into blocks of equal size wherever that falls.
    `keys` only notes which documents end in the block, for comparing results; no offset or
    length is kept.
    """
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("tokens", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, held, waiting, ended = TaskContext.get().partitionId(), 0, 0, [], []

        def cut(values: np.ndarray, n: int):
            """The first block of the waiting tokens, with the keys of the separators in it."""
            nonlocal ended, block
            part = values[:n]
            closed = int((part == eod).sum())
            row = pa.record_batch([[file], [block], [part.astype(f"<u{width}").tobytes()], [ended[:closed]]], schema=schema)
            ended, block = ended[closed:], block + 1
            return row

        for batch in batches:
            for name, own in zip(batch[key].to_pylist(), batch[ids]):
                values = own.values.to_numpy(zero_copy_only=False) if own.is_valid else np.zeros(0, np.int64)
                waiting += [values.astype(np.int64), np.array([eod])]
                ended.append(name)
                held += len(values) + 1
                if held >= block_tokens:
                    flat = np.concatenate(waiting)
                    while len(flat) >= block_tokens:
                        yield cut(flat, block_tokens)
                        flat = flat[block_tokens:]
                    waiting, held = [flat], len(flat)
        if held:
            yield cut(np.concatenate(waiting), held)

    return encoded.select(key, ids).mapInArrow(run, "file long, block long, tokens binary, keys array<long>")


def _flat(lists: pa.Array, eod: int, width: int) -> bytes:
    """Documents one after the other, each closed by `eod`, as little-endian numbers of `width` bytes."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = pc.list_flatten(lists)
    values = ids.to_numpy(zero_copy_only=False)
    if ids.null_count or (len(values) and (values.min() < 0 or values.max() >= 1 << 8 * width or (values == eod).any())):
        raise ValueError(f"token ids are numbers of {width} bytes other than {eod}")
    out = np.full(len(values) + len(lengths), eod, f"<u{width}")
    own = np.ones(len(out), bool)
    own[np.cumsum(lengths + 1) - 1] = False
    out[own] = values
    return out.tobytes()


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_token_files(encoded: DataFrame, folder: str, eod: int, width: int, key: str = "doc_id",
                      ids: str = "ids") -> DataFrame:
    """Write flat binary token files below `folder`; rows (file, doc, key) name the documents of each, in order.

    Each task writes one file of nothing but tokens: no offset, no length. A repeated attempt of a task
    writes a file of its own, and only the files that the rows name count, so stage the rows
    before use. A null list is a document without tokens; ids that are null, equal to `eod` or too large for
    `width` bytes are an error. `folder` is a URI that pyarrow opens (local, hdfs, s3, gs).
    """
    place, root = _located(folder)
    place.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
        file, doc = None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if file is None:
                    place, root = _located(folder)
                    file = place.open_output_stream(f"{root.rstrip('/')}/{name}")
                file.write(_flat(batch[ids], eod, width))
                k = batch.num_rows
                yield pa.record_batch([pa.array([name] * k), pa.array(range(doc, doc + k), pa.int64()), batch[key]],
                                      names=["file", "doc", "key"])
                doc += k
        finally:
            if file is not None:
                file.close()

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, ids).mapInArrow(run, f"file string, doc long, key {kind}")


def read_token_files(spark: SparkSession, path: str, width: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat binary token files (file, block, tokens), read by byte ranges; a file may have any size.

    A file is named by its path. Spark lists the files; each task then opens its ranges, which are dealt out evenly,
    so neither a file nor the list of ranges is held whole anywhere.
    """
    files = (spark.read.format("binaryFile").load(path)
             .select(F.col("path").alias("file"), "length").filter("length > 0"))  # contents stay unread
    step = block_tokens * width
    total = files.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    last = F.floor((F.col("length") - 1) / step)
    ranges = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block in zip(batch["file"].to_pylist(), batch["block"].to_pylist()):
                place, at = _located(file)
                with place.open_input_file(at) as opened:
                    content = opened.read_at(min(step, opened.size() - block * step), block * step)
                yield pa.record_batch([[file], [block], [content]], names=["file", "block", "tokens"])

    return ranges.repartition(parts, "file", "block").mapInArrow(run, "file string, block long, tokens binary")


def _summaries(eod: int, width: int, with_keys: bool, file: str):
    """Per block: tokens, tokens before the first separator, after the last one, lengths between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch["tokens"].to_pylist():
                values = np.frombuffer(content or b"", f"<u{width}")
                found = np.flatnonzero(values == eod)
                head = int(found[0]) if len(found) else len(values)
                tail = len(values) - 1 - int(found[-1]) if len(found) else len(values)
                rows.append((len(values), len(found), head, tail, np.diff(found) - 1 if len(found) else found[:0]))
            total, seps, head, tail, between = zip(*rows) if rows else ((), (), (), (), ())
            offsets = np.concatenate(([0], np.cumsum([len(b) for b in between]))).astype(np.int32)
            flat = np.concatenate(between).astype(np.int64) if rows else np.zeros(0, np.int64)
            columns = [batch["file"], batch["block"], *[pa.array(c, pa.int64()) for c in (total, seps, head, tail)],
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            names = ["file", "block", "n", "seps", "head", "tail", "between"]
            if with_keys:
                columns, names = [*columns, batch["keys"]], [*names, "keys"]
            yield pa.record_batch(columns, names=names)
    kind = f"file {file}, block long, n long, seps long, head long, tail long, between array<long>"
    return run, kind + (", keys array<long>" if with_keys else "")


def scan_documents(blocks: DataFrame, eod: int, width: int) -> DataFrame:
    """Documents of flat token files: (file, doc, start, n_tokens[, key]).

    `blocks` has file (a number or a path), block (0, 1, ... without gap) and tokens, the raw bytes of a block; a
    column `keys` with one key per separator is handed through as `key`. Each block is searched
    by itself. A prefix scan over the block summaries then gives the documents before a block
    and the place of the last separator before it, so that a document across any number of
    blocks is stitched. The scan has two levels: inside runs of 1,024 blocks and over the runs,
    so a file of any size is not one window.

    n_tokens leaves the separator out; two separators in a row enclose a document of no token;
    tokens after the last separator of a file make a last document without key; an empty or
    null block adds nothing.
    """
    with_keys = "keys" in blocks.columns
    run, kind = _summaries(eod, width, with_keys, blocks.schema["file"].dataType.simpleString())
    found = stage(blocks.select("file", "block", "tokens", *(["keys"] if with_keys else [])).mapInArrow(run, kind)
                  .withColumn("run", F.floor(F.col("block") / RUN_BLOCKS)), "token-blocks")
    past = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(*past)
    over = Window.partitionBy("file").orderBy("run").rowsBetween(*past)

    def before(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # Where the last separator of a block ends, counted from the start of its run.
    local = found.withColumn("begin", before("n", inside))
    local = local.withColumn("closed", F.when(F.col("seps") > 0, F.col("begin") + F.col("n") - F.col("tail")))
    runs = local.groupBy("file", "run").agg(F.sum("n").alias("run_n"), F.sum("seps").alias("run_seps"),
                                            F.max("closed").alias("run_closed"), F.max("block").alias("last_block"))
    runs = runs.withColumn("run_begin", before("run_n", over)).withColumn("run_docs", before("run_seps", over))
    runs = (runs.withColumn("run_open", F.coalesce(F.max(F.col("run_begin") + F.col("run_closed")).over(over), F.lit(0)))
            .withColumn("file_last", F.max("last_block").over(Window.partitionBy("file"))))
    scanned = (local.withColumn("docs", before("seps", inside)).withColumn("open", F.max("closed").over(inside))
               .join(runs.select("file", "run", "run_begin", "run_docs", "run_open", "file_last"), ["file", "run"]))
    first = F.coalesce(F.col("run_begin") + F.col("open"), F.col("run_open"))  # start of the document open at the block
    lengths = F.concat(F.array(F.col("run_begin") + F.col("begin") + F.col("head") - first), F.col("between"))
    lengths = F.when(F.col("seps") > 0, lengths).otherwise(F.array().cast("array<long>"))
    end = F.col("run_begin") + F.col("begin") + F.col("n")
    tail_at = F.when(F.col("seps") > 0, end - F.col("tail")).otherwise(first)
    unclosed = (F.col("block") == F.col("file_last")) & (end > tail_at)
    lengths = F.when(unclosed, F.concat(lengths, F.array(end - tail_at))).otherwise(lengths)
    # start of each document: the first one's plus lengths and separators before it
    parts = scanned.select(
        "file", (F.col("run_docs") + F.col("docs")).alias("docs"), first.alias("first"), lengths.alias("lengths"),
        *([F.col("keys")] if with_keys else []))
    starts = F.transform("lengths", lambda n, k: F.struct(
        (F.col("docs") + k).alias("doc"), n.alias("n_tokens"),
        *([F.get("keys", k).alias("key")] if with_keys else [])))
    out = parts.select("file", "first", F.inline(starts))
    return out.drop("first")


def document_tokens(encoded: DataFrame, eod: int, width: int, doc_id: str = "doc_id") -> DataFrame:
    """Write documents as flat token files in the shared folder, then count each one's tokens from the files.

    The scan sees nothing but the bytes of the files. Which document is the n-th of a file is in a table
    beside them, joined at the end. Repeated ids each keep their row; an empty table gives none.
    """
    spark = encoded.sparkSession
    folder = staging_path(spark, "token-files")
    with small_batches(spark, BATCH_ROWS):
        names = stage(write_token_files(encoded, folder, eod, width, doc_id), "token-names")
        blocks = read_token_files(spark, folder, width)
        counted = scan_documents(blocks, eod, width).withColumn("file", F.substring_index("file", "/", -1))
    return names.join(counted, ["file", "doc"], "left").select(F.col("key").alias(doc_id), "n_tokens")
