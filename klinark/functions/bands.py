"""Age bands and stay types as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from klinark.functions.fixed_values import (
    AGE_BANDS, DAY_CASE, OLDEST_AGE, SHORT_STAY, STANDARD_STAY, UNKNOWN_BAND,
)


def band_of_age(age: Column, bands=AGE_BANDS, oldest: int = OLDEST_AGE) -> Column:
    """Label of the band an age falls in; missing or impossible ages are unknown."""
    label = F.when(age.isNull() | (age < 0) | (age > oldest), UNKNOWN_BAND)
    for first_age, name in reversed(bands):
        label = label.when(age >= first_age, name)
    return label


def leading_year(text: Column) -> Column:
    """Year written in the first four characters, NULL when they are not digits."""
    return F.when(text.rlike("^[0-9]{4}"), F.substring(text, 1, 4).try_cast("int"))


def age_band(event_date: Column, birth_date: Column, bands=AGE_BANDS) -> Column:
    """Band of the age at an event, from two ISO date texts (only years are used)."""
    return band_of_age(leading_year(event_date) - leading_year(birth_date), bands)


def age_band_legacy(event_date: Column, birth_date: Column, bands=AGE_BANDS) -> Column:
    """Band as the historical load computed it.

    A missing birth date or an age over 120 counts in the last band and a negative
    age in the first one. Kept to reproduce old figures; use `age_band` otherwise.
    """
    age = leading_year(event_date) - leading_year(birth_date)
    label = F.when(~birth_date.rlike("^[0-9]{4}"), UNKNOWN_BAND)
    for (_, name), (next_age, _) in zip(bands, bands[1:]):
        label = label.when(age < next_age, name)
    return label.otherwise(bands[-1][1])


def band_rank(band: Column, bands=AGE_BANDS) -> Column:
    """Position of a band in its fixed order; unknown bands come last."""
    labels = F.array(*[F.lit(name) for _, name in bands])
    return F.coalesce(F.nullif(F.array_position(labels, band), F.lit(0)),
                      F.lit(len(bands) + 1)).cast("int")


def stay_type(days: Column) -> Column:
    """Stay type by length; a missing length counts as a standard stay."""
    return (F.when(days < 1, DAY_CASE)
            .when(days.between(1, 2), SHORT_STAY)
            .otherwise(STANDARD_STAY))
