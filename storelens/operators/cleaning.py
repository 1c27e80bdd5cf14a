"""Header and cell cleaning driven by the table registry."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens import schemas
from storelens.functions.casts import CASTS
from storelens.functions.text import strip_cell

# Columns of order sheets and the product master that are compared as keys.
KEY_COLUMNS = ("Parent SKU", "SKU", "SKU (Parent)", "Size Abbreviation")


def clean_header(name: str) -> str:
    """Lower-case header with word separators as single underscores."""
    name = re.sub(r"[ \-/\n]", "_", name.lower().strip())
    name = re.sub(r"[().$,?#]", "", name)
    return re.sub(r"_+", "_", name).strip("_")


def _rename(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = list(names)
    clashes = [n for n, count in Counter(names).items() if count > 1]
    if clashes:
        raise ValueError(f"headers collide after cleaning: {clashes}")
    return df.toDF(*names)


def normalize_headers(df: DataFrame) -> DataFrame:
    return _rename(df, map(clean_header, df.columns))


def process_table(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean headers, keep the declared columns in declared order, cast them.

    Declared columns that are absent are skipped. Columns that already have
    the right timestamp type pass unchanged; everything else is read as text.
    ``keep`` names columns of the pull itself, such as the collection a page
    belongs to, that go along unchanged.
    """
    df = normalize_headers(df)
    columns = [F.col(name) for name in keep]
    for name, kind in schemas.TABLES[table].items():
        if name not in df.columns:
            continue
        source = df.schema[name].dataType
        if kind == schemas.DATETIME and isinstance(
            source, (T.TimestampNTZType, T.TimestampType, T.DateType)
        ):
            cell = F.col(name).cast("timestamp_ntz")
        else:
            cell = CASTS[kind](F.col(name).cast("string"))
        columns.append(cell.alias(name))
    return df.select(*columns)


def preprocess_strings(df: DataFrame, key_columns: Iterable[str] = KEY_COLUMNS) -> DataFrame:
    """Strip headers and text cells; keys become upper case."""
    df = _rename(df, [c.strip() for c in df.columns])
    keys = set(key_columns)
    cells = []
    for field in df.schema.fields:
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            cell = strip_cell(field.name)
            if field.name in keys:
                cell = F.upper(cell)
        cells.append(cell.alias(field.name))
    return df.select(*cells)


def id_columns_first(df: DataFrame, id_columns: Iterable[str]) -> DataFrame:
    """Move the named columns to the front, keep the order of the rest."""
    front = list(id_columns)
    return df.select(*front, *[c for c in df.columns if c not in front])
