"""Delimited text sources: declared schemas, quarantine of malformed lines, encodings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klinark.functions.fixed_values import DEPARTMENTS, FORMER_DEPARTMENTS
from klinark.schemas import CORRUPT, RAW_DEPARTMENTS


def allow_legacy_encodings(spark: SparkSession) -> None:
    """Let the session read and write Windows code pages such as windows-1252."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def read_delimited(spark: SparkSession, path, schema: T.StructType, sep: str = ",",
                   encoding: str = "UTF-8", quote: str = '"', escape: str = '"',
                   skip_malformed: bool = False, pattern: str | None = None,
                   multiline: bool = False, header: bool = True) -> DataFrame:
    """Read header-first text with an all-declared schema.

    Column names come from the schema, the header line is only skipped. Every line is
    parsed in full even when few columns are used, since a pruned parse would not
    notice missing or extra fields.
    Lines that do not fit the schema are kept with their text in `_corrupt_record`
    (see `split_malformed`), or left out when `skip_malformed` is set. `pattern`
    selects files by name below `path`, at any depth. Hive-style folders
    (`annee=2020/`) become partition columns when no pattern is given.
    """
    if encoding.upper() not in ("UTF-8", "ISO-8859-1", "US-ASCII", "UTF-16"):
        allow_legacy_encodings(spark)
    reader = spark.read.options(
        header=header, sep=sep, encoding=encoding, quote=quote, escape=escape,
        multiLine=multiline, enforceSchema=True, columnPruning=False)
    if pattern:
        reader = reader.options(recursiveFileLookup=True, pathGlobFilter=pattern)
    if skip_malformed:
        return reader.option("mode", "DROPMALFORMED").schema(schema).csv(path)
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(full).csv(path))


def separators_in(line: Column, sep: str, quote: str = '"') -> Column:
    """Separators of a line outside quoted fields."""
    unquoted = F.regexp_replace(line, f"{quote}[^{quote}]*{quote}", "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))


def malformed_reason(schema: T.StructType, sep: str) -> Column:
    """LIGNE_COURTE, LIGNE_LONGUE or LIGNE_ILLISIBLE for a quarantined line, else NULL."""
    found, expected = separators_in(F.col(CORRUPT), sep), len(schema.fields) - 1
    return (F.when(F.col(CORRUPT).isNull(), F.lit(None).cast("string"))
            .when(found < expected, "LIGNE_COURTE")
            .when(found > expected, "LIGNE_LONGUE")
            .otherwise("LIGNE_ILLISIBLE"))


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the malformed lines next to what could be read of them.

    Spark refuses plans that read nothing but the malformed text, so both filters also
    look at a field, with a test that always holds.
    """
    field = next(c for c in df.columns if c != CORRUPT)
    read = F.length(F.coalesce(F.col(field).cast("string"), F.lit(""))) >= 0
    good = df.filter(F.col(CORRUPT).isNull() & read).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull() & read)


def resolve_column(columns: list[str], name: str) -> str | None:
    """Column with the exact name, else one containing it; counts (`nb...`) never match."""
    folded = {column.strip().lower(): column for column in reversed(columns)}
    if name in folded:
        return folded[name]
    candidates = [c for c in columns
                  if name in c.strip().lower() and not c.strip().lower().startswith("nb")]
    return candidates[0] if candidates else None


def conform_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Select the wanted columns under their canonical names; absent ones are left out."""
    found = {name: resolve_column(df.columns, name) for name in names}
    return df.select([F.col(f"`{source}`").alias(name)
                      for name, source in found.items() if source is not None])


def union_campaigns(frames: list[DataFrame], names: list[str]) -> DataFrame:
    """Stack files of different years whose columns drift; absent columns are NULL."""
    conformed = [conform_columns(frame, names) for frame in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), conformed)


def read_departments(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Department -> region reference, from a file or from the built-in official list."""
    if path:
        return read_delimited(spark, path, RAW_DEPARTMENTS, skip_malformed=True)
    return spark.createDataFrame(DEPARTMENTS + FORMER_DEPARTMENTS, RAW_DEPARTMENTS)


def write_text_export(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """Export as delimited text with a header, keeping blanks and quoting as needed.

    An empty text and a missing value read back alike, as missing.
    """
    if encoding.upper() not in ("UTF-8", "ISO-8859-1", "US-ASCII", "UTF-16"):
        allow_legacy_encodings(df.sparkSession)
    df.write.options(header=True, sep=sep, encoding=encoding, quote='"', escape='"',
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
