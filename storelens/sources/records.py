"""CSV files read in parts: records from lines, cells from records.

A quoted cell may hold line ends, so where a record begins depends on all quotes
before it. Every line is a small function of that: it ends inside or outside of a
quoted cell depending on whether it began there. Four such functions exist: a line
changes nothing, changes sides, or ends on one side whatever came before. They are
put together within a split of a file by windows, and across the splits of a file
by a window over one row a split. A file of any size is therefore read by as many
tasks as it has splits, in file order, and its lines are moved once.

Quotes count as in the reader used before: only at the beginning of a cell do they
open one; ``""`` inside is a quote character. Lines end with a line feed, with or
without a carriage return.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelens.functions.text import strip
from storelens.operators.ordering import carry_forward
from storelens.session import stage

# Fixed value: the byte-order mark.
BOM = "\ufeff"

UTF_8, WINDOWS_1252, LATIN_1 = "UTF-8", "windows-1252", "ISO-8859-1"

#: A record of several lines becomes one value; a larger one is an unclosed quote.
MAX_RECORD_BYTES = 64 << 20

SPLIT = ["file_path", "split"]


def _windows_characters() -> dict[str, str]:
    """Characters windows-1252 has where latin-1 has control characters."""
    pairs = {}
    for code in range(0x80, 0xA0):
        try:
            pairs[chr(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return pairs


WINDOWS_CHARACTERS = _windows_characters()
UNDEFINED_IN_WINDOWS = [
    f"{code:02X}" for code in range(0x80, 0xA0) if chr(code) not in WINDOWS_CHARACTERS
]


def file_name() -> Column:
    return F.col("_metadata.file_name").alias("file")


def decodable(value: Column) -> tuple[Column, Column]:
    """Whether bytes are valid as utf-8, and as utf-8 or windows-1252."""
    valid = F.is_valid_utf8(value)
    byte_pairs = F.regexp_replace(F.hex(value), "(..)", "$1 ")
    undefined = rf"(^| )({'|'.join(UNDEFINED_IN_WINDOWS)}) "
    return valid, valid | ~byte_pairs.rlike(undefined)


def chosen_encoding(utf_8: Column, windows: Column) -> Column:
    return F.when(utf_8, UTF_8).when(windows, WINDOWS_1252).otherwise(LATIN_1)


def _ends_inside(text: Column) -> Column:
    """Whether text that begins outside (``from0``) and inside (``from1``) of a
    quoted cell ends inside of one, and how many cells it ends (``cells``)."""

    def step(acc: Column, piece: Column) -> Column:
        odd = F.length(F.regexp_replace(piece, '[^"]', "")) % 2 == 1
        opens = odd & piece.startswith('"')
        inside = {c: F.when(acc[c], ~odd).otherwise(opens) for c in ("from0", "from1")}
        return F.struct(
            *[inside[c].alias(c) for c in inside],
            (acc["cells"] + F.when(inside["from0"], 0).otherwise(1)).alias("cells"),
        )

    def state(from0: bool, from1: bool, cells: Column) -> Column:
        return F.struct(F.lit(from0).alias("from0"), F.lit(from1).alias("from1"), cells.alias("cells"))

    pieces = F.split(text, ",")
    walked = F.aggregate(pieces, state(False, True, F.lit(0)), step)
    return F.when(text.contains('"'), walked).otherwise(state(False, True, F.size(pieces)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as bytes with their split of the file and what they do to quotes."""
    read = spark.read.option("lineSep", "\n").text(path)
    lines = read.select(
        file_name(),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split"),
        # a split is read front to back by one task, the running id follows it
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    at_start = (F.col("split") == 0) & F.col("value").startswith(BOM)
    # the first line of a split only; a mark at the start of another is text
    first = F.row_number().over(Window.partitionBy(*SPLIT).orderBy("id"))
    lines = lines.withColumn("line", first.cast("bigint"))
    value = F.when(at_start & (F.col("line") == 1), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    ends = _ends_inside(F.col("value"))
    return lines.withColumn("value", value).withColumn("ends", ends).drop("id")


def _with_states(lines: DataFrame) -> DataFrame:
    """Add whether the file is inside a quoted cell before and after each line of a
    split: ``fixed``, whether a line so far decides it, and ``flips``, what it is
    then, or else whether it differs from the beginning of the split."""
    so_far = Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.col("ends.from0") & ~F.col("ends.from1")
    decides = F.col("ends.from0") == F.col("ends.from1")
    counted = lines.withColumn("swaps", F.count_if(swaps).over(so_far))
    last = F.last(F.when(decides, F.struct(F.col("ends.from0").alias("side"), "swaps")), ignorenulls=True)
    known = counted.withColumn("last", last.over(so_far))
    since = F.col("swaps") - F.coalesce("last.swaps", F.lit(0))
    side = F.coalesce("last.side", F.lit(False))
    after = F.struct(F.col("last").isNotNull().alias("fixed"), (side != (since % 2 == 1)).alias("flips"))
    at_first = F.struct(F.lit(False).alias("fixed"), F.lit(False).alias("flips"))
    before = F.lag("after").over(Window.partitionBy(*SPLIT).orderBy("line"))
    stated = known.withColumn("after", after).withColumn("before", F.coalesce(before, at_first))
    return stated.select("file", *SPLIT, "line", "value", "after", "before")


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split: whether it begins inside a quoted cell, lines before it, and
    the encoding of its file: the first of utf-8, windows-1252 and latin-1 that can
    decode all of it."""
    utf_8, windows = decodable(F.col("value"))
    summed = lines.groupBy(*SPLIT).agg(
        F.max("line").alias("n"),
        # as a number, which an aggregate by hash can hold
        F.max_by(F.col("after.fixed").cast("int") * 2 + F.col("after.flips").cast("int"), "line").alias("end"),
        F.bool_and(utf_8).alias("utf_8"),
        F.bool_and(windows).alias("windows"),
    )
    end = F.struct((F.col("end") >= 2).alias("fixed"), (F.col("end") % 2 == 1).alias("flips"))
    summed = summed.withColumn("end", end)
    file = Window.partitionBy("file_path")
    before = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.count_if(~F.col("end.fixed") & F.col("end.flips")).over(before)
    last = F.last(F.when(F.col("end.fixed"), F.struct(F.col("end.flips").alias("side"), "own")), ignorenulls=True)
    encoding = chosen_encoding(F.bool_and("utf_8").over(file), F.bool_and("windows").over(file))
    up_to = file.orderBy("split").rowsBetween(Window.unboundedPreceding, 0)
    own = F.count_if(~F.col("end.fixed") & F.col("end.flips")).over(up_to)
    placed = summed.withColumn("own", own).withColumn("last", last.over(before)).withColumn("swaps", swaps)
    since = F.coalesce("swaps", F.lit(0)) - F.coalesce("last.own", F.lit(0))
    return placed.select(
        *SPLIT,
        (F.coalesce("last.side", F.lit(False)) != (since % 2 == 1)).alias("inside"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
        encoding.alias("encoding"),
    )


def _whole(parts: DataFrame, max_bytes: int) -> DataFrame:
    """Records of several lines, put together."""
    # stored there, and read twice
    keyed = carry_forward(parts, ["file_path"], "row_no", F.col("starts"), "first")
    keys = ["file", "file_path", "encoding", "first"]
    sizes = keyed.groupBy(*keys).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    large = sizes.filter(F.col("bytes") > max_bytes).limit(1).collect()
    if large:
        raise ValueError(f"{large[0]['file']}: the record in line {large[0]['first']} has {large[0]['bytes']} bytes")
    listed = F.array_sort(F.collect_list(F.struct("row_no", "value")))
    return keyed.groupBy(*keys).agg(F.array_join(listed["value"], "\n").alias("value")).select(
        "file", "file_path", "encoding", F.col("first").alias("row_no"), "value"
    )


def read_records(
    spark: SparkSession, path: str, encoding: str | None = None, max_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """(file, file_path, encoding, row_no, text) of every record of a folder's CSV
    files that isn't empty, headers included; ``row_no`` is its first line's number
    in the file. The files are read once, their lines staged.

    ``encoding`` is what all files have; by default it is found out per file.
    """
    return _texts(_raw_records(spark, path, encoding, max_bytes))


def _raw_records(spark: SparkSession, path: str, encoding: str | None, max_bytes: int) -> DataFrame:
    """Records as the bytes they have in the file."""
    lines = stage(_with_states(_lines(spark, path)), "csv-lines")
    splits = stage(_splits(lines), "csv-splits")
    placed = lines.join(splits, SPLIT).withColumn("row_no", F.col("lines_before") + F.col("line"))
    if encoding:
        placed = placed.withColumn("encoding", F.lit(encoding))

    def inside(state: str) -> Column:
        fixed, flips = F.col(f"{state}.fixed"), F.col(f"{state}.flips")
        return F.when(fixed, flips).otherwise(F.col("inside") != flips)

    placed = placed.withColumns({"starts": ~inside("before"), "ends": ~inside("after")})
    columns = ["file", "file_path", "encoding", "row_no", "value"]
    single = placed.filter("starts and ends").select(*columns)
    parts = placed.filter("not (starts and ends)").select(*columns, "starts")
    records = single.unionByName(_whole(parts, max_bytes))
    # told by the bytes, in every encoding the same: a filter on the text decodes it again
    return records.filter(~F.col("value").isin("", "\r"))


def _texts(records: DataFrame) -> DataFrame:
    others = [c for c in records.columns if c != "value"]
    text = F.col("text")
    bare = F.when(text.endswith("\r"), F.expr("left(text, length(text) - 1)")).otherwise(text)
    return records.select(*others, _decoded("value").alias("text")).withColumn("text", bare)


def _decoded(name: str) -> Column:
    latin = F.decode(F.col(name).cast("binary"), LATIN_1)
    windows = F.translate(latin, "".join(WINDOWS_CHARACTERS), "".join(WINDOWS_CHARACTERS.values()))
    return (
        F.when(F.col("encoding") == UTF_8, F.col(name))
        .when(F.col("encoding") == WINDOWS_1252, windows)
        .otherwise(latin)
    )


def _with_cells(df: DataFrame, text: str, width: int, name: str) -> DataFrame:
    """Add the cells of a record as texts, ``width`` of them at least.

    A record without quotes and line ends is cut at its commas, the others are parsed,
    once each.
    """
    quoted = reduce(Column.__or__, [F.col(text).contains(c) for c in '"\r\n\0'])
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(
        F.when(quoted, F.col(text)),
        ", ".join(f"{n} string" for n in names),
        {"quote": '"', "escape": '"', "multiLine": "true"},
    )
    own = F.array(*[F.coalesce(F.col("__parsed")[n], F.lit("")) for n in names])
    cut = F.split(text, ",")
    lacking = F.array_repeat(F.lit(""), F.lit(width) - F.size(cut))
    cells = F.when(quoted, own).when(F.size(cut) < width, F.concat(cut, lacking)).otherwise(cut)
    return df.withColumn("__parsed", parsed).withColumn(name, cells).drop("__parsed")


def _safe_names(header: Column) -> Column:
    """Names that differ: a column without one is called by its place, of equal
    ones each gets its place added."""
    lower = F.transform(header, F.lower)
    return F.transform(
        header,
        lambda h, i: F.when(h == "", F.concat(F.lit("_c"), i.cast("string")))
        .when(F.size(F.filter(lower, lambda other: other == F.lower(h))) > 1, F.concat(h, i.cast("string")))
        .otherwise(h),
    )


def _read_headers(records: DataFrame) -> tuple[DataFrame, int]:
    """(file, file_path, header_row, header, filled) of every file of raw records,
    ``filled`` where it has rows below the header, and the width of the widest header."""
    rows = records.groupBy("file_path").agg(
        F.min("row_no").alias("header_row"), F.max("row_no").alias("last_row")
    )
    # the first rows are plain minima, so that no line is sorted or decoded for its text
    rows = stage(rows, "csv-first-rows")
    first = records.withColumnRenamed("row_no", "header_row").join(rows, ["file_path", "header_row"])
    first = _texts(first).withColumn("width", _ends_inside(F.col("text"))["cells"])
    first = stage(first, "csv-headers")
    width = first.agg(F.max("width")).first()[0]  # the widest header
    if width is None:
        raise FileNotFoundError("no CSV files with a header")
    headers = _with_cells(first, "text", width, "named").select(
        "file",
        "file_path",
        "header_row",
        _safe_names(F.slice("named", F.lit(1), F.col("width"))).alias("header"),
        (F.col("last_row") > F.col("header_row")).alias("filled"),
    )
    return headers, width


def _with_headers(
    spark: SparkSession, path: str, encoding: str | None, max_bytes: int
) -> tuple[DataFrame, DataFrame, int]:
    raw = _raw_records(spark, path, encoding, max_bytes)
    try:
        headers, width = _read_headers(raw)
    except FileNotFoundError as error:
        raise FileNotFoundError(f"{error} in {path}") from None
    return _texts(raw), headers, width


def read_cells(
    spark: SparkSession, path: str, encoding: str | None = None, max_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """(file, row_no, header, cells) of every row of a folder's CSV files: ``cells``
    maps the names in ``header``, the first record of the row's own file, to texts.
    However many different headers there are, all files go through one plan."""
    records, headers, width = _with_headers(spark, path, encoding, max_bytes)
    rows = records.join(headers.drop("filled", "file"), "file_path").filter(F.col("row_no") > F.col("header_row"))
    rows = _with_cells(rows, "text", width, "own")
    own = F.slice("own", F.lit(1), F.size("header"))
    return rows.select("file", "file_path", "row_no", "header", F.map_from_arrays("header", own).alias("cells"))


def read_wide(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    max_bytes: int = MAX_RECORD_BYTES,
    own_headers: bool = False,
) -> DataFrame:
    """(file, row_no, a column per name) of the rows that ``read_cells`` has, with
    ``own_headers`` also ``header``, its names stripped. Where a name is in a file is looked up once a file, and the rows
    are stored: a filter on a cell would otherwise have every record parsed again."""
    records, headers, width = _with_headers(spark, path, encoding, max_bytes)
    names = column_names(headers.filter("filled"))
    numbers = F.sequence(F.lit(0), F.size("header") - 1)
    placed = headers.withColumn("places", F.map_from_arrays("header", numbers)).select(
        "file_path",
        "header_row",
        F.array(*[F.try_element_at("places", F.lit(n)) for n in names]).cast("array<int>").alias("at"),
    )
    rows = records.join(placed, "file_path").filter(F.col("row_no") > F.col("header_row"))
    rows = _with_cells(rows, "text", width, "own")
    cells = [F.coalesce(F.get("own", F.col("at")[i]), F.lit("")) for i in range(len(names))]
    # under numbers: names of a sheet may hold what a stored column's may not
    numbered = [c.alias(f"c{i}") for i, c in enumerate(cells)]
    stored = stage(rows.select("file_path", "row_no", *numbered), "csv-rows")
    named = [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
    stripped = headers.select("file", "file_path", F.transform("header", strip).alias("header"))
    whole = stored.join(stripped, "file_path")
    return whole.select("file", *(["header"] if own_headers else []), "row_no", *named)


def column_names(cells: DataFrame) -> list[str]:
    """The names of all columns: those of the first file in its order, then what
    the next one adds. As many reach the driver as the wide table has columns."""
    heads = cells.select("file_path", "header").distinct()
    places = heads.select("file_path", F.posexplode("header").alias("place", "name"))
    first = places.groupBy("name").agg(F.min(F.struct("file_path", "place")).alias("at"))
    return [row["name"] for row in first.orderBy("at").collect()]
