"""Mappings of values to named classes, and heat-map colors."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelens.functions.text import strip

# Time-zone cohort of each US state.
STATE_COHORTS = {
    "AK": "pacific",
    "AL": "central",
    "AR": "central",
    "AZ": "mountain",
    "CA": "pacific",
    "CO": "mountain",
    "CT": "eastern",
    "DC": "eastern",
    "DE": "eastern",
    "FL": "eastern",
    "GA": "eastern",
    "HI": "pacific",
    "IA": "central",
    "ID": "mountain",
    "IL": "central",
    "IN": "eastern",
    "KS": "central",
    "KY": "eastern",
    "LA": "central",
    "MA": "eastern",
    "MD": "eastern",
    "ME": "eastern",
    "MI": "eastern",
    "MN": "central",
    "MO": "central",
    "MS": "central",
    "MT": "mountain",
    "NC": "eastern",
    "ND": "central",
    "NE": "central",
    "NH": "eastern",
    "NJ": "eastern",
    "NM": "mountain",
    "NV": "pacific",
    "NY": "eastern",
    "OH": "eastern",
    "OK": "central",
    "OR": "pacific",
    "PA": "eastern",
    "RI": "eastern",
    "SC": "eastern",
    "SD": "central",
    "TN": "central",
    "TX": "central",
    "UT": "mountain",
    "VA": "eastern",
    "VT": "eastern",
    "WA": "pacific",
    "WI": "central",
    "WV": "eastern",
    "WY": "mountain",
}

# Names of the parts of the day.
DAY_PARTS = ("morning", "afternoon", "evening", "night")

# Markdown classes in report order.
MARKDOWN_BUCKETS = ("0% (Full Price)", "1-20%", "21-50%", "50%+")

# Heat-map limits and colors.
HEAT_LOW, HEAT_HIGH = 0.30, 0.70
HEAT_BASE_ALPHA, HEAT_ALPHA_RANGE = 0.3, 0.5
COLOR_DIGITS = 8
HEAT_RED, HEAT_GREEN, HEAT_NONE = "rgba(255, 107, 107, ", "rgba(46, 204, 113, ", "transparent"


def tz_cohort(c: Column) -> Column:
    """Time-zone cohort of a two-letter state code; anything else is null."""
    cohorts = F.create_map(*[F.lit(x) for x in chain.from_iterable(STATE_COHORTS.items())])
    return F.try_element_at(cohorts, F.upper(strip(c)))


def hour_bucket(c: Column) -> Column:
    """Part of the day of an hour; null stays null."""
    morning, afternoon, evening, night = DAY_PARTS
    return (
        F.when(c.isNull(), None)
        .when((c >= 6) & (c < 12), morning)
        .when((c >= 12) & (c < 18), afternoon)
        .when((c >= 18) & (c < 24), evening)
        .otherwise(night)
    )


def markdown_bucket(c: Column) -> Column:
    """Markdown class of a share; a missing share lands in the last class."""
    full, low, middle, high = MARKDOWN_BUCKETS
    return (
        F.when(c == 0, full).when(c <= 0.20, low).when(c <= 0.50, middle).otherwise(high)
    )


def markdown_order(c: Column) -> Column:
    """Report position of a markdown class."""
    return F.array_position(F.array(*[F.lit(b) for b in MARKDOWN_BUCKETS]), c)


def heat_band(rank: Column, invert: bool = False) -> Column:
    """-1 for the lowest ranks, 1 for the highest, 0 between or when unknown."""
    r = 1 - rank if invert else rank
    return F.when(r <= HEAT_LOW, -1).when(r >= HEAT_HIGH, 1).otherwise(0)


def heat_alpha(rank: Column, invert: bool = False) -> Column:
    """Opacity of a colored rank: stronger toward the extremes; null when uncolored."""
    r = 1 - rank if invert else rank
    distance = F.when(r <= HEAT_LOW, HEAT_LOW - r).when(r >= HEAT_HIGH, r - HEAT_HIGH)
    return F.lit(HEAT_BASE_ALPHA) + F.lit(HEAT_ALPHA_RANGE) * distance / F.lit(0.30)


def heat_color(band: Column, alpha: Column, digits: int | None = COLOR_DIGITS) -> Column:
    """Style value of a band and opacity.

    The opacity is written with ``digits`` digits, as the last ones of a
    percentile depend on how an engine adds; None writes all of them.
    """
    text = alpha.cast("string") if digits is None else F.format_string(f"%.{digits}f", alpha)
    shade = F.concat(text, F.lit(")"))
    return (
        F.when(band < 0, F.concat(F.lit(HEAT_RED), shade))
        .when(band > 0, F.concat(F.lit(HEAT_GREEN), shade))
        .otherwise(HEAT_NONE)
    )
