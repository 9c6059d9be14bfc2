"""Survey files of several campaigns: columns found by the header of each file, fields by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.functions.fixed_values import SUB_SCORES, SURVEY_POSITIONS, SURVEY_WIDTHS
from klinark.sources.delimited import allow_legacy_encodings, separators_in

REASON = "motif"
SHORT, LONG, UNREADABLE, NO_LAYOUT = "LIGNE_COURTE", "LIGNE_LONGUE", "LIGNE_ILLISIBLE", "ENTETE_INCONNU"
WIDEST = max(SURVEY_WIDTHS)


def _folded(name: Column) -> Column:
    return F.lower(F.trim(F.translate(name, "\"﻿", "")))


def column_place(header: Column, name: str, usual: int) -> Column:
    """Place (from 1) of a column in a header: by its exact name, else by a name that contains it, else the usual place.

    Counts (`nb...`) never match by containing a name.
    """
    names = F.transform(header, _folded)
    near = F.array_position(F.transform(names, lambda n: n.contains(name) & ~n.startswith("nb")), F.lit(True))
    place = lambda p: F.when(p > 0, p)
    return F.coalesce(place(F.array_position(names, F.lit(name))), place(near), F.lit(usual + 1)).cast("int")


def layouts(lines: DataFrame, sep: str) -> DataFrame:
    """(fichier, largeur, places, entete): the layout of each file, from its first line.

    A header is the first line of the first block of a file. A width that no campaign has gives no places.
    """
    heads = (lines.filter("_debut = 0").groupBy("fichier")
             .agg(F.min_by("ligne", "_rang").alias("entete"), F.min("_rang").alias("_premier")))
    header = F.split(F.col("entete"), sep, -1)
    found = F.create_map(*[part for name, at in SURVEY_POSITIONS.items() for part in (F.lit(name), column_place(header, name, at))])
    known = F.size(header).isin(*SURVEY_WIDTHS)
    return heads.select("fichier", F.size(header).alias("largeur"), F.when(known, found).alias("places"), "_premier")


def read_surveys(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Every line of the survey files below `path` (folders `annee=YYYY`), with the fields of its own layout.

    Columns annee, fichier, the names of `SURVEY_POSITIONS`, `champs` (all fields) and `motif`: null for a good line, else why
    it is malformed (too few or too many fields for its file, unreadable, file with an unknown header); the text is kept in
    `ligne`. One scan of the folder reads files of all widths; only one row per file is joined to the lines.
    A blank line is no line; a file without lines gives none.
    """
    if encoding.upper() not in ("UTF-8", "ISO-8859-1", "US-ASCII", "UTF-16"):
        allow_legacy_encodings(spark)
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    raw = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
           .select(text.alias("ligne"), F.col("_metadata.file_path").alias("fichier"), F.col("_metadata.file_block_start").alias("_debut"),
                   F.monotonically_increasing_id().alias("_rang"))
           .filter(F.trim("ligne") != ""))
    files = layouts(raw, sep)
    lines = (raw.join(files, "fichier").filter("_debut > 0 or _rang <> _premier").withColumn("_n", separators_in(F.col("ligne"), sep) + 1))
    kind = ", ".join(f"c{i} string" for i in range(WIDEST))
    fields = F.from_csv("ligne", kind, {"sep": sep, "mode": "PERMISSIVE", "quote": '"', "escape": '"'})
    unclosed = (F.length("ligne") - F.length(F.replace("ligne", F.lit('"'), F.lit("")))) % 2 == 1
    reason = (F.when(F.col("places").isNull(), NO_LAYOUT).when(unclosed, UNREADABLE)
              .when(F.col("_n") < F.col("largeur"), SHORT).when(F.col("_n") > F.col("largeur"), LONG))
    cut = lines.withColumn("_f", fields).withColumn("champs", F.array(*[F.col(f"_f.c{i}") for i in range(WIDEST)]))
    named = [F.element_at("champs", F.element_at("places", name)).alias(name) for name in SURVEY_POSITIONS]
    return (cut.withColumn(REASON, reason)
            .select(F.regexp_extract("fichier", "annee=([0-9]{4})/", 1).cast("int").alias("annee"), "fichier", *named,
                    "champs", "ligne", REASON))


def sub_score_rows(read: DataFrame, positions: dict[str, int] = SUB_SCORES) -> DataFrame:
    """One row per good line and sub-score: annee, finess_geo, score_all_rea_ajust, sous_score, valeur (text).

    The sub-scores stand at the same places in every layout, so they are unpivoted by position.
    """
    pairs = F.array(*[F.struct(F.lit(label).alias("sous_score"), F.element_at("champs", at + 1).alias("valeur"))
                      for label, at in positions.items()])
    return (read.filter(F.col(REASON).isNull())
            .select("annee", "finess_geo", "score_all_rea_ajust", F.explode(pairs).alias("p"))
            .select("annee", "finess_geo", "score_all_rea_ajust", "p.*"))
