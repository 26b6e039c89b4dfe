"""From raw sheet cells to entity rows and metric rows.

A cell table has file, file_ord, sheet, sheet_ord, row_idx, col_idx, value. Facts
about a sheet (its header row, columns) are found once per sheet and attached by
``lookup``, so a sheet that holds much of the data stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerbench.constants import (
    CODE_MAP,
    ENTITY_SHEET_WORDS,
    ID_HEADER,
    LABEL_FOCUS,
    LABEL_SECTOR,
    LABEL_SHEET_FIELDS,
    LABEL_SUB_INDUSTRY,
    LABEL_VENDOR_FIELDS,
    NAME_HEADERS,
    SUPERHEADER_WORDS,
)
from peerbench.functions.labels import sheet_has
from peerbench.functions.text import blank_to_null, has_any, norm_key, strip
from peerbench.operators.joins import lookup
from peerbench.session import durable

SHEET = ("file", "file_ord", "sheet", "sheet_ord")


def prune_sheets(cells: DataFrame, words: Sequence[str]) -> DataFrame:
    """Cells of sheets whose name contains any of the words."""
    return cells.where(sheet_has(F.col("sheet"), words))


def header_rows(cells: DataFrame) -> DataFrame:
    """Per sheet the first row with the id header in it, however far down."""
    marks = norm_key(F.col("value")) == ID_HEADER
    return cells.where(marks).groupBy(*SHEET).agg(F.min("row_idx").alias("header_row"))


def sheets_without_header(cells: DataFrame) -> DataFrame:
    """Sheets in which no cell is the id header, with their number of cells."""
    is_header = F.coalesce(norm_key(F.col("value")) == ID_HEADER, F.lit(False))
    return (
        cells.groupBy(*SHEET)
        .agg(F.count("*").alias("n_cells"), F.bool_or(is_header).alias("_has"))
        .where(~F.col("_has"))
        .drop("_has")
    )


def name_columns(cells: DataFrame) -> DataFrame:
    """Per sheet the header row and name column: holding/universe before the id."""
    word = F.lower(strip(F.col("value")))
    rank = F.when(word.isin(*NAME_HEADERS), 0).when(word == ID_HEADER.lower(), 1)
    first = F.min(F.struct("row_idx", rank.alias("rank"), "col_idx"))
    return (
        cells.where(rank.isNotNull())
        .groupBy(*SHEET)
        .agg(first.alias("_f"))
        .select(
            *SHEET,
            F.col("_f.row_idx").alias("header_row"),
            F.col("_f.col_idx").alias("name_col"),
        )
    )


def sheet_headers(cells: DataFrame, rows: DataFrame, repair: bool = False) -> DataFrame:
    """(sheet, col_idx, header) given each sheet's header_row.

    Repeated names get ".1", ".2"; with ``repair`` a blank header takes the
    first cell above it that holds one of the known words.
    """
    top = lookup(cells, rows, SHEET, spread=["row_idx", "col_idx"]).where(
        F.col("row_idx") <= F.col("header_row")
    )
    at_header = F.col("row_idx") == F.col("header_row")
    own = F.max(F.when(at_header, blank_to_null(F.col("value"))))
    usable = ~at_header & has_any(F.upper("value"), SUPERHEADER_WORDS)
    above = F.min_by(strip(F.col("value")), F.when(usable, F.col("row_idx")))
    header = F.coalesce(strip(own), above) if repair else own
    named = (
        top.groupBy(*SHEET, "header_row", "col_idx")
        .agg(header.alias("header"))
        .where(F.col("header").isNotNull())
    )
    nth = F.row_number().over(Window.partitionBy(*SHEET, "header").orderBy("col_idx")) - 1
    return named.withColumn("_nth", nth).select(
        *SHEET,
        "header_row",
        "col_idx",
        F.when(F.col("_nth") == 0, F.col("header"))
        .otherwise(F.concat_ws(".", "header", "_nth"))
        .alias("header"),
    )


BY_ID, BY_NAME = "id", "name"


def header_index(cells: DataFrame) -> DataFrame:
    """The headers of all sheets, a written table that every promotion uses.

    A row per named column: kind (``id``: below the first row with the id header; ``name``: below the first
    row with any name header, blanks repaired from above), sheet_no, sheet, header_row, col_idx, header, and
    the sheet's id_col and name_col. Two scans whose rows are filtered before they are grouped: one for the
    marks, one for what stands at or above them.
    """
    word = F.lower(strip(F.col("value")))
    rank = F.when(word.isin(*NAME_HEADERS), 0).when(word == ID_HEADER.lower(), 1)
    marks = durable(
        cells.select(*SHEET, "row_idx", "col_idx", rank.alias("rank"))
        .where("rank IS NOT NULL")
        .groupBy(*SHEET)
        .agg(
            F.min(F.when(F.col("rank") == 1, F.col("row_idx"))).alias("id_row"),
            F.min(F.struct("row_idx", "rank", "col_idx")).alias("_f"),
        )
        .select(*SHEET, "id_row", F.col("_f.row_idx").alias("name_row"), F.col("_f.col_idx").alias("name_at"))
        .withColumn("sheet_no", F.monotonically_increasing_id())
    )
    row = F.col("row_idx")
    above = F.greatest("id_row", "name_row")
    top = lookup(cells, marks, SHEET, spread=["row_idx", "col_idx"]).where(row <= above)
    usable = (row < F.col("name_row")) & has_any(F.upper("value"), SUPERHEADER_WORDS)
    at = lambda r: F.max(F.when(row == F.col(r), blank_to_null(F.col("value"))))
    named = top.groupBy("sheet_no", *SHEET, "id_row", "name_row", "name_at", "col_idx").agg(
        at("id_row").alias("by_id"),
        F.coalesce(strip(at("name_row")), F.min_by(strip(F.col("value")), F.when(usable, row))).alias("by_name"),
    )
    kinds = F.array(
        F.struct(F.lit(BY_ID).alias("kind"), F.col("id_row").alias("header_row"), F.col("by_id").alias("header")),
        F.struct(F.lit(BY_NAME).alias("kind"), F.col("name_row").alias("header_row"), F.col("by_name").alias("header")),
    )
    each = named.select("sheet_no", *SHEET, "name_at", "col_idx", F.inline(kinds)).where("header IS NOT NULL")
    same = Window.partitionBy("kind", "sheet_no", "header").orderBy("col_idx")
    nth = F.row_number().over(same) - 1
    sheet = Window.partitionBy("kind", "sheet_no")
    spelled = F.when(F.col("_nth") == 0, F.col("header")).otherwise(F.concat_ws(".", "header", "_nth"))
    id_col = F.min(F.when(F.col("header") == ID_HEADER, F.col("col_idx"))).over(sheet)
    return durable(
        each.withColumn("_nth", nth)
        .withColumn("header", spelled)
        .withColumn("id_col", id_col)
        .select("kind", "sheet_no", *SHEET, "header_row", "col_idx", "header", "id_col", F.col("name_at").alias("name_col"))
    )


def _promote(cells: DataFrame, index: DataFrame, kind: str) -> DataFrame:
    """Data rows below each header as one row per named column, blanks included.

    Cells meet the index by sheet, where it is small without being moved; only cells of named columns below the
    header go on, under the sheet's number and their row.
    """
    columns = index.where(F.col("kind") == kind)
    facts = columns.groupBy("sheet_no", *SHEET, "header_row", "id_col", "name_col").agg(
        F.collect_list(F.struct("col_idx", "header")).alias("headers")
    )
    facts = durable(facts.where("id_col IS NOT NULL") if kind == BY_ID else facts)
    sheets = facts.select("sheet_no", *SHEET, "header_row", F.array_append(F.col("headers.col_idx"), F.col("name_col")).alias("_named"))
    below = lookup(cells, sheets, SHEET, spread=["row_idx", "col_idx"])
    below = below.where((F.col("row_idx") > F.col("header_row")) & F.array_contains("_named", F.col("col_idx")))
    grid = below.groupBy("sheet_no", "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("_cells")
    )
    cell = lambda c: F.when(F.col(c).isNotNull(), F.try_element_at("_cells", F.col(c)))
    rows = lookup(grid, facts, ["sheet_no"], spread=["row_idx"])
    keyed = rows.select(*SHEET, "row_idx", cell("id_col").alias("id"), cell("name_col").alias("name"), "_cells", "headers")
    return keyed.where(F.col(kind).isNotNull()).select(
        "id", "name", *SHEET, "row_idx", "_cells", F.inline("headers")
    ).select(
        "id", "name", *SHEET, "row_idx", F.col("col_idx").alias("col_ord"), "header", F.try_element_at("_cells", F.col("col_idx")).alias("value")
    )


def promote_headers(cells: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Metric rows of all sheets that have a column named exactly like the id header."""
    return _promote(cells, header_index(cells) if index is None else index, BY_ID).drop("name")


def promote_headers_by_name(cells: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Metric rows keyed by the name column, with blank headers repaired from above."""
    return _promote(cells, header_index(cells) if index is None else index, BY_NAME)


def positional_entities(
    cells: DataFrame, header_row: int = 2, words: Sequence[str] | None = ENTITY_SHEET_WORDS
) -> DataFrame:
    """Entity rows of sheets laid out as A holding .. E id below a fixed header row.

    A sheet needs five columns; a row of such a sheet may end before the fifth.
    """
    rows = cells if words is None else prune_sheets(cells, words)
    names = ["holding", "universe", "sub_industry", "focus", "id"]
    wide = durable(rows.where(F.col("col_idx") >= len(names) - 1).select(*SHEET).distinct())
    below = rows.where(F.col("row_idx") > header_row)
    return (
        lookup(below, wide, SHEET, "left_semi", ["row_idx", "col_idx"])
        .groupBy(*SHEET, "row_idx")
        .agg(
            *[
                F.max(F.when(F.col("col_idx") == i, blank_to_null(F.col("value")))).alias(n)
                for i, n in enumerate(names)
            ]
        )
    )


def bounded_rows(cells: DataFrame, n: int, header_row: int = 2) -> DataFrame:
    """The first n rows below the header of each sheet."""
    return cells.where((F.col("row_idx") > header_row) & (F.col("row_idx") <= header_row + n))


def rewrite_codes(cells: DataFrame, code_map: dict[str, str] = dict(CODE_MAP)) -> DataFrame:
    """Replace cells that equal an old code (trimmed, any case); adds changed."""
    pairs = F.create_map(*[F.lit(x) for pair in code_map.items() for x in pair])
    new = F.try_element_at(pairs, norm_key(F.col("value")))
    return cells.withColumn("changed", F.coalesce(new.isNotNull(), F.lit(False))).withColumn(
        "value", F.coalesce(new, F.col("value"))
    )


def changed_sheets(rewritten: DataFrame) -> DataFrame:
    return (
        rewritten.groupBy(*SHEET)
        .agg(F.count_if("changed").alias("n_changed"))
        .where(F.col("n_changed") > 0)
    )


def requests_from_cells(cells: DataFrame) -> DataFrame:
    """The request sheet: name and id by position, flags and sector by label.

    Rows without a cell above the last filled one are rows too, with nulls.
    """
    return _labelled(
        cells,
        {
            "sub_industry_flag": LABEL_SUB_INDUSTRY,
            "focus_flag": LABEL_FOCUS,
            "sector": LABEL_SECTOR,
        },
        {"name": 0, "id": 1},
    )


def wanted_fields_from_cells(cells: DataFrame) -> DataFrame:
    """The two field lists of the request sheet as (ord, origin, field)."""
    lists = _labelled(cells, {"sheet": LABEL_SHEET_FIELDS, "vendor": LABEL_VENDOR_FIELDS}, {})
    return lists.unpivot(
        [F.col("row_number").alias("ord")], ["sheet", "vendor"], "origin", "field"
    ).where(F.col("field").isNotNull())


def _labelled(cells: DataFrame, labels: dict[str, str], places: dict[str, int]) -> DataFrame:
    head = cells.where(F.col("row_idx") == 0)
    at = {
        out: head.agg(F.min(F.when(F.col("value") == text, F.col("col_idx")))).scalar()
        for out, text in labels.items()
    }
    at.update({out: F.lit(i) for out, i in places.items()})
    filled = (
        cells.where(F.col("row_idx") > 0)
        .groupBy(F.col("row_idx").alias("row_number"))
        .agg(*[F.max(F.when(F.col("col_idx") == c, F.col("value"))).alias(o) for o, c in at.items()])
    )
    last = cells.agg(F.max("row_idx").alias("last")).where(F.col("last") > 0)
    every = last.select(F.explode(F.sequence(F.lit(1).cast(filled.schema["row_number"].dataType), "last")).alias("row_number"))
    return every.join(filled, "row_number", "left")
