"""Pseudonyms and detection of personal data in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_PATTERN = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
# National numbers of ten digits in pairs (0X XX XX XX XX), or a + and country code with groups. Dates
# have neither a leading 0 followed by four pairs nor a +.
PHONE_PATTERN = (r"\b0[1-9]([ .-]?[0-9]{2}){4}\b|[+][0-9]{1,3}[ .-]?([(][0-9]{1,4}[)][ .-]?)?[0-9]{1,4}([ .-]?[0-9]{2,4}){1,5}\b"
                 r"|\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b")
MOJIBAKE_PATTERN = "�|Ã"


def canonical_id(identifier: Column) -> Column:
    """One spelling per identifier: '007', ' 7' and 7 are the same patient.

    Identifiers that are not integers keep their trimmed text; blanks are NULL.
    """
    text = F.trim(identifier.cast("string"))
    return F.coalesce(text.try_cast("long").cast("string"), F.nullif(text, F.lit("")))


def patient_salt(identifier: Column, seed: str) -> Column:
    return F.sha2(F.concat(canonical_id(identifier), F.lit(seed)), 256)


def pseudonym(identifier: Column, master: str, seed: str) -> Column:
    """64-character keyed hash of an identifier, stable between loads."""
    return F.sha2(F.concat(canonical_id(identifier), F.lit(master),
                           patient_salt(identifier, seed)), 256)


def has_mojibake(text: Column) -> Column:
    """True for text that was decoded with the wrong character set."""
    return text.rlike(MOJIBAKE_PATTERN)


def count_matches(text: Column, pattern: str, needed: str | None = None) -> Column:
    """Matches of a pattern; texts without a substring it needs skip the regex."""
    count = F.regexp_count(text, F.lit(pattern))
    return count if needed is None else F.when(F.contains(text, F.lit(needed)), count).otherwise(
        F.when(text.isNotNull(), 0))
