"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" in the source files (case matters).
NULL_TOKENS = ("", "NULL", "N/A", "None")

# Every character the Unicode standard counts as white space, plus the four
# information separators, so that a strip removes tabs and no-break spaces too.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Fixed value: prefix of a product's global id.
PRODUCT_GID_PREFIX = "gid://shopify/Product/"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_cell(name: str) -> Column:
    """A column's texts stripped, null as the empty string. Texts that begin and end
    with a visible ASCII character, as most do, are not searched for white space."""
    c = F.col(f"`{name}`")
    visible = [F.ascii(end).between(0x21, 0x7E) for end in (c, F.substring(c, -1, 1))]
    return F.when(visible[0] & visible[1], c).otherwise(nonempty(c))


def tokens_to_null(c: Column) -> Column:
    """Null for the declared null tokens, tested before any trimming."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def nonempty(c: Column) -> Column:
    """Null becomes the empty string, everything else is stripped."""
    return strip(F.coalesce(c, F.lit("")))


def upper_key(c: Column) -> Column:
    """A key as the product master compares it: stripped and upper case."""
    return F.upper(nonempty(c))


def email_key(c: Column) -> Column:
    """Lower-case, stripped email for matching."""
    return strip(F.lower(c))


def match_name(c: Column) -> Column:
    """A name reduced for matching: lower case, no punctuation, single spaces."""
    bare = F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def product_gid(c: Column) -> Column:
    """Global product id; ids that already are global stay as they are."""
    text = strip(c.cast("string"))
    return F.when(text.startswith("gid://"), text).otherwise(
        F.concat(F.lit(PRODUCT_GID_PREFIX), text)
    )


def title_words(c: Column) -> Column:
    """Display name of a dashed handle."""
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))
