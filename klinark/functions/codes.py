"""Recoding of sexes, diagnoses and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from klinark.functions.fixed_values import (
    ICD_CHAPTERS, OTHER_LABEL, REGION_SPELLINGS, UNKNOWN_CHAPTER, UNKNOWN_CODE,
    UNKNOWN_SEX,
)


def lookup_label(key: Column, labels: dict[str, str]) -> Column:
    """Label of a key in a small fixed mapping, NULL when absent."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def sex_code(sex: Column) -> Column:
    """M, F or ? from the numeric and textual codings in use."""
    text = F.lower(F.trim(sex))
    return (F.when(text.isin("1", "m", "male", "h", "homme"), "M")
            .when(text.isin("2", "f", "female", "femme"), "F")
            .otherwise(UNKNOWN_SEX))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def known_or(text: Column, default: str = UNKNOWN_CODE) -> Column:
    """The value without outer blanks, or a default when it is missing or blank."""
    return F.when(is_blank(text), default).otherwise(F.trim(text))


def chapter_letter(code: Column) -> Column:
    """First letter of a diagnosis code; unknown codes have no chapter letter."""
    return F.when(is_blank(code) | (code == UNKNOWN_CODE), UNKNOWN_SEX).otherwise(
        F.upper(F.substring(code, 1, 1)))


def icd_chapter(code: Column, labels: dict[str, str] = ICD_CHAPTERS) -> Column:
    """Chapter label of a diagnosis code."""
    return F.when(is_blank(code) | (code == UNKNOWN_CODE), UNKNOWN_CHAPTER).otherwise(
        F.coalesce(lookup_label(chapter_letter(code), labels), F.lit(OTHER_LABEL)))


def department_code(place: Column) -> Column:
    """Department of a commune code: three characters overseas, two elsewhere."""
    head = F.substring(place, 1, 2)
    return F.when(head.isin("97", "98"), F.substring(place, 1, 3)).otherwise(head)


def fold_accents(text: Column) -> Column:
    """Lower-case text with French accents removed."""
    return F.translate(F.lower(text), "àáâäçèéêëîïôöùûü", "aaaaceeeeiioouuu")


def fold_label(label: Column) -> Column:
    """Comparison form of a region label: no case, accents, blanks or punctuation."""
    return F.regexp_replace(fold_accents(label), "[ .'-]", "")


def standard_region(label: Column) -> Column:
    """Official spelling of a region label."""
    trimmed = F.trim(label)
    return F.coalesce(lookup_label(trimmed, REGION_SPELLINGS), trimmed)
