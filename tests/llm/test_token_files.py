"""Flat token files: what is written, read by ranges, and counted."""

import numpy as np
import pytest
from pyspark.errors import PythonException

from klinark.llm.token_scan import document_tokens, read_token_files, scan_documents, write_token_files

LENGTHS = [0, 5, 1, 0, 0, 30, 2, 12, 0, 700]


def encoded(spark, parts=1):
    rows = [(k, [7 + k] * n) for k, n in enumerate(LENGTHS)] + [(20, None), (None, [1, 2]), (5, [3])]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(parts).sortWithinPartitions("doc_id")


def expected():
    return sorted([(k, n) for k, n in enumerate(LENGTHS)] + [(20, 0), (-1, 2), (5, 1)])


@pytest.mark.parametrize("width", [2, 4])
def test_files_hold_tokens_and_separators_only(spark, tmp_path, width):
    names = write_token_files(encoded(spark), str(tmp_path / "out"), 60000, width).collect()
    [path] = (tmp_path / "out").glob("*.bin")
    values = np.fromfile(path, f"<u{width}").tolist()
    assert len(values) == sum(LENGTHS) + 3 + len(LENGTHS) + 3
    assert values.count(60000) == len(names) == len(LENGTHS) + 3
    assert values[:4] == [1, 2, 60000, 60000]  # the row without an id, then document 0


@pytest.mark.parametrize("block", [1, 3, 64, 100_000])
def test_ranges_of_a_file_give_its_bytes(spark, tmp_path, block):
    values = (np.arange(1000) % 11).astype("<u2")
    values.tofile(tmp_path / "a.bin")
    blocks = sorted(read_token_files(spark, str(tmp_path), 2, block_tokens=block).collect(), key=lambda r: r.block)
    assert [r.block for r in blocks] == list(range(-(-1000 // block)))
    assert b"".join(bytes(r.tokens) for r in blocks) == values.tobytes()
    found = scan_documents(read_token_files(spark, str(tmp_path), 2, block_tokens=block), 10, 2).orderBy("doc").collect()
    assert [r.n_tokens for r in found] == [10] * 90 + [10]


@pytest.mark.parametrize("parts", [1, 4])
def test_counts_through_files(spark, parts):
    got = document_tokens(encoded(spark, parts), 60000, 2).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got) == expected()


def test_a_file_of_a_failed_attempt_changes_nothing(spark, tmp_path):
    names = write_token_files(encoded(spark), str(tmp_path), 60000, 2)
    first, second = names.collect(), names.collect()  # two attempts, one file each
    assert len({r.file for r in first + second}) == 2
    counted = {(r.file.rsplit("/", 1)[1], r.doc): r.n_tokens
               for r in scan_documents(read_token_files(spark, str(tmp_path), 2), 60000, 2).collect()}
    assert sorted((-1 if r.key is None else r.key, counted[r.file, r.doc]) for r in second) == expected()


def test_empty_table_and_ids_that_do_not_fit(spark, tmp_path):
    assert document_tokens(encoded(spark).filter("false"), 60000, 2).count() == 0
    for wrong in ([70000], [-1], [60000], [None]):
        docs = spark.createDataFrame([(1, wrong)], "doc_id long, ids array<int>")
        with pytest.raises(PythonException):
            write_token_files(docs, str(tmp_path), 60000, 2).collect()
