"""Wide size columns of an order sheet and their long form."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.casts import number

# Fixed value: the size that exists even when no product of the master has it.
ONE_SIZE = "OSFM"


def header_tokens(column: str) -> list[str]:
    """Words of a sheet header in which a size may appear."""
    return column.upper().replace("QTY", "").replace("/", " ").split()


def size_columns(columns: Iterable[str], master: DataFrame, size_column: str) -> dict[str, str]:
    """Sheet columns that hold quantities of a size, with that size.

    Only words that occur in the headers are looked up in the master, so what
    reaches the driver is bounded by the width of the sheet.
    """
    columns = list(columns)
    words = sorted({word for c in columns for word in header_tokens(c)})
    known = master.select(F.upper(F.col(f"`{size_column}`")).alias("size")).filter(
        F.col("size").isin(words)
    )
    sizes = {row["size"] for row in known.distinct().collect()} | {ONE_SIZE}
    found = {}
    for column in columns:
        hits = sorted(sizes.intersection(header_tokens(column)))
        if hits:
            found[column] = hits[0]
    if not found:
        raise ValueError("no column of the sheet names a known size")
    return found


def unpivot_sizes(
    sheet: DataFrame, keys: list[str], sizes: dict[str, str], parent: str = "parent_sku"
) -> DataFrame:
    """One row per ordered size: parent, size, size position and quantity.

    Cells that are not numbers and zeros are skipped, fractions are cut off,
    rows without a parent are dropped. Where the rows say in ``header`` which
    columns their file has, the position is the one in that file.
    """
    places = {column: F.lit(pos) for pos, column in enumerate(sizes)}
    own = []
    if "header" in sheet.columns:
        own = [F.array_intersect("header", F.array(*map(F.lit, sizes))).alias("__own")]
        places = {c: (F.array_position("__own", F.lit(c)) - 1).cast("int") for c in sizes}
    cells = F.array(
        *[
            F.struct(
                places[column].alias("size_pos"),
                F.lit(size).alias("size"),
                number(F.col(f"`{column}`")).alias("amount"),
            )
            for column, size in sizes.items()
        ]
    )
    # a lambda over the cells would be interpreted, and with it all they are made of
    needed = dict.fromkeys([*keys, parent, *sizes])
    return (
        sheet.filter(F.col(parent) != "")
        .select(*[F.col(f"`{c}`") for c in needed], *own)
        .select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{parent}`").alias("parent"), F.inline(cells))
        .filter(F.col("amount") != 0)
        .withColumn("qty", F.col("amount").try_cast("bigint"))
        .drop("amount")
    )


def pack_sizes(
    sheet: DataFrame, keys: list[str], sizes: dict[str, str], parent: str = "parent_sku"
) -> DataFrame:
    """The rows of ``unpivot_sizes`` before they are brought to long form: keys, parent,
    ``amounts`` and, where files have headers of their own, ``places``, both in the
    order of ``sizes``.

    One row moves where the long form has one per ordered size. Rows without any text
    under a size are left out, as most of a printed order form are.
    """
    places, own = [], []
    if "header" in sheet.columns:
        own = [F.array_intersect("header", F.array(*map(F.lit, sizes))).alias("__own")]
        places = [(F.array_position("__own", F.lit(c)) - 1).cast("int") for c in sizes]
    filled = reduce(Column.__or__, [F.col(f"`{c}`") != "" for c in sizes])
    needed = dict.fromkeys([*keys, parent, *sizes])
    return (
        sheet.filter((F.col(parent) != "") & filled)
        .select(*[F.col(f"`{c}`") for c in needed], *own)
        .select(
            *[F.col(f"`{k}`") for k in keys],
            F.col(f"`{parent}`").alias("parent"),
            F.array(*[number(F.col(f"`{c}`")) for c in sizes]).alias("amounts"),
            *([F.array(*places).alias("places")] if own else []),
        )
    )


def unpack_sizes(packed: DataFrame, sizes: dict[str, str], found: list[str], first: list[str]) -> DataFrame:
    """Long form of packed rows that met what their sizes are found as.

    ``answers`` maps sizes to structs of the columns ``found``; what has no answer has no
    row. ``leads`` says whether nothing of the same packed row comes before a row by the
    columns ``first``; rows that lack one of these don't count and don't lead.
    """
    others = [c for c in packed.columns if c not in ("amounts", "places", "answers")]
    cells, ranks = [], []
    for i, size in enumerate(sizes.values()):
        amount, answer = F.col("amounts")[i], F.try_element_at("answers", F.lit(size))
        values = {
            "size_pos": F.col("places")[i] if "places" in packed.columns else F.lit(i),
            "size": F.lit(size),
            "qty": amount.try_cast("bigint"),
            **{c: answer[c] for c in found},
        }
        there = (amount != 0) & answer.isNotNull()
        known = reduce(Column.__and__, [values[c].isNotNull() for c in first])
        cells.append(F.when(there, F.struct(*[v.alias(c) for c, v in values.items()])))
        ranks.append(F.when(there & known, F.struct(*[values[c].alias(c) for c in first])))
    least = F.array_min(F.array(*ranks))
    return (
        packed.select(*others, least.alias("__least"), F.inline(F.array(*cells)))
        .filter(F.col("size").isNotNull())
        .withColumn("leads", F.coalesce(F.struct(*first) == F.col("__least"), F.lit(False)))
        .drop("__least")
    )
