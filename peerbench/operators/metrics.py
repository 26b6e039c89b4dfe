"""Metric lookup: tiered header matching on sheets, and the vendor field table.

``metrics`` rows are cells of data rows: id, file, sheet, file_ord, sheet_ord,
row_idx, col_ord, header, value. Blank cells are rows too (value null), because
a blank in the first row of an id must not be filled from a later row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.functions.fieldnames import field_base, field_key, field_keys, years_back
from peerbench.functions.numbers import display_value, is_code_like, is_error_text
from peerbench.functions.text import blank_to_null, is_blank, norm_key
from peerbench.operators.header_match import LOOSE, STRICT, Matching, each_field, match_headers
from peerbench.operators.joins import Wanted, by_shuffle, first_by, lookup, only
from peerbench.session import durable

SHEET = ("file_ord", "sheet_ord")
PLACE = (*SHEET, "row_idx", "col_ord")
PERIOD_MARK = "(Period="
SLOTS = 8  # fields whose picks stand in one row


def _upper_ids(ids: DataFrame) -> DataFrame:
    return ids.select(norm_key(F.col("id")).alias("id"))


def _texts(fields: Sequence[str]) -> Column:
    return F.array(*[F.lit(f) for f in fields]).cast("array<string>")


def _candidates(
    metrics: DataFrame, fields: Sequence[str], matching: Matching, headers: DataFrame | None
) -> DataFrame:
    """Metric cells under a header that fits a wanted field: one for each group of SLOTS fields (_part), a tier for each slot."""
    fit = match_headers(metrics if headers is None else headers, fields, matching)
    number = F.array_position(_texts(fields), F.col("field").cast("string")) - 1
    slots = [F.max(F.when(number % SLOTS == i, F.col("tier"))).alias(f"_tier{i}") for i in range(SLOTS)]
    fit = durable(fit.groupBy("header", F.floor(number / SLOTS).cast("int").alias("_part")).agg(*slots))
    return lookup(metrics, fit, ["header"], spread=PLACE)


def sheet_picks(
    metrics: DataFrame,
    fields: Sequence[str],
    key: str = "id",
    matching: Matching = STRICT,
    headers: DataFrame | None = None,
) -> DataFrame:
    """One value per (key, field, sheet): first row of the key, best tier, first column.

    Blank cells give way to the next column or tier, never to the next row.
    ``headers`` is where headers are looked up, ``metrics`` itself by default.
    Picks of up to SLOTS fields are shuffled as one row per key and sheet.
    """
    fields = list(dict.fromkeys(fields))
    slots = range(max(1, min(SLOTS, len(fields))))
    blank = is_blank(F.col("value")).cast("byte").alias("blank")
    value = blank_to_null(F.col("value")).alias("value")
    cell = lambda i: F.struct("row_idx", blank, F.col(f"_tier{i}"), "col_ord", value)
    picks = (
        _candidates(metrics, fields, matching, headers)
        .groupBy(key, "_part", *SHEET, "file")
        .agg(*[F.min(F.when(F.col(f"_tier{i}").isNotNull(), cell(i))).alias(f"_pick{i}") for i in slots])
    )
    field = lambda i: F.get(_texts(fields), F.col("_part") * SLOTS + i).alias("field")
    each = [F.when(F.col(f"_pick{i}").isNotNull(), F.struct(field(i), F.col(f"_pick{i}.value").alias("value"))) for i in slots]
    return picks.select(key, *SHEET, "file", F.inline(F.array_compact(F.array(*each)))).select(key, "field", *SHEET, "file", "value")


def judge(picks: DataFrame, strict_codes: bool = True) -> DataFrame:
    """Adds is_error and is_hit; an error text ends the search with a null.

    A code-like value is no hit, so a later sheet may still supply the field.
    """
    error = is_error_text(F.col("value"))
    code = is_code_like(F.col("value"), F.col("id")) if strict_codes else F.lit(False)
    hit = F.col("value").isNotNull() & (error | ~code)
    return picks.select(
        "*", error.alias("is_error"), hit.alias("is_hit")
    ).withColumn("value", F.when(~F.col("is_error"), F.col("value")))


def until_first_yield(metrics: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits a search that stops early would see.

    It reads sheets in order up to the first that yields anything for the id;
    in each later file it reads only the first sheet holding the id.
    """
    first_sheet = metrics.groupBy("id", "file_ord").agg(F.min("sheet_ord").alias("_head"))
    at = F.struct(*SHEET)
    seen = at <= F.col("_first")
    later = F.col("file_ord") > F.col("_first.file_ord")
    return (
        hits.withColumn("_first", F.min(at).over(Window.partitionBy("id")))
        .where(seen | later)
        .join(by_shuffle(first_sheet), ["id", "file_ord"])
        .where(seen | (later & (F.col("sheet_ord") == F.col("_head"))))
    )


def metric_lookup(
    metrics: DataFrame,
    ids: DataFrame | None,
    fields: Sequence[str],
    files: DataFrame | None = None,
    strict_codes: bool = True,
    stop_after_first_hit: bool = False,
) -> DataFrame:
    """(id, field, value) for every field found; value is null after an error text.

    ``ids`` and ``files`` narrow the search; ids come back in upper case.
    """
    rows = metrics.withColumn("id", norm_key(F.col("id")))
    if files is not None:
        rows = rows.join(files.select("file").distinct(), "file", "left_semi")
    wanted = None if ids is None else Wanted.of(_upper_ids(ids), ["id"])
    rows = rows if wanted is None else wanted.before(rows)
    hits = judge(sheet_picks(rows, fields, headers=metrics), strict_codes).where("is_hit").select("id", "field", *SHEET, "value")
    hits = hits if wanted is None else wanted.after(hits)
    if stop_after_first_hit:
        hits = until_first_yield(rows, hits)
    return hits.groupBy("id", "field").agg(first_by(F.col("value"), SHEET).alias("value"))


def metric_lookup_by_name(
    metrics: DataFrame, names: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """(name, field, value) looked up by entity name instead of id.

    ``metrics`` needs a name column. Two header tiers, values as they stand.
    """
    keyed = metrics.withColumn("key", F.lower(F.trim("name")))
    wanted = names.select("name", F.lower(F.trim("name")).alias("key")).distinct()
    asked = Wanted.of(wanted, ["key"])
    picks = asked.after(sheet_picks(asked.before(keyed), fields, "key", LOOSE, metrics).where(F.col("value").isNotNull()))
    found = picks.groupBy("key", "field").agg(first_by(F.col("value"), SHEET).alias("value"))
    return found.join(by_shuffle(wanted), "key").select("name", "field", "value")


def every_field(ids: DataFrame, found: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every id with every field; null where nothing was found, with is_found."""
    wanted = ids.select("id").distinct().withColumn("field", each_field(fields))
    marked = found.select(
        norm_key(F.col("id")).alias("key"), "field", "value", F.lit(True).alias("_found")
    )
    return (
        wanted.withColumn("key", norm_key(F.col("id")))
        .join(by_shuffle(marked), ["key", "field"], "left")
        .select("id", "field", "value", F.coalesce("_found", F.lit(False)).alias("is_found"))
    )


def missing_fields(ids: DataFrame, found: DataFrame, fields: Sequence[str]) -> DataFrame:
    return every_field(ids, found, fields).where(~F.col("is_found")).select("id", "field")


# --- vendor fields: id, field, fy, value, ord -------------------------------


def last_wins(vendor: DataFrame) -> DataFrame:
    """One value per (id, field): the last row of a reply wins, even if null."""
    return vendor.groupBy(
        norm_key(F.col("id")).alias("id"), field_key(F.col("field")).alias("field")
    ).agg(F.max_by("value", "ord").alias("value"))


def _entries(keys: Sequence[str], order: Column, value: Column) -> Column:
    """What a row (id, field, base, fy, latest) may answer: an entry for each request that it fits.

    A request for a field is answered by the row of that name (rank 0); one with a period also by the base
    field's row of that year (rank 1).
    """
    entry = lambda key, rank: F.struct(F.lit(key).alias("key"), F.lit(rank).alias("rank"), order.alias("order"), value.alias("value"))
    fits = [F.when(F.col("field") == k, entry(k, 0)) for k in keys]
    for k in keys:
        if PERIOD_MARK in k:
            year = F.col("latest") - years_back(F.lit(k))
            fits.append(F.when((F.col("base") == field_base(F.lit(k))) & (F.col("fy") == year), entry(k, 1)))
    return F.array_compact(F.array(*fits))


def vendor_answers(rows: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """(id, field, value): the last row that answers each request, one under its own name before one by year."""
    fitting = rows.select("id", F.explode(_entries(keys, order, F.col("value"))).alias("_e"))
    best = F.max_by("_e.value", F.struct(-F.col("_e.rank"), "_e.order"))
    return fitting.groupBy("id", F.col("_e.key").alias("field")).agg(best.alias("value"))


def every_value(ids: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every id with every field: value and display text, null and '' where nothing was found."""
    batch = every_field(ids, found, keys)
    return batch.select("id", "field", "value", display_value(F.col("value")).alias("display"))


def yearly(rows: DataFrame, ids: Wanted | None = None) -> DataFrame:
    """The last row of each (id, field, year), with the field's base name and the id's latest year.

    Rows meet once; the window is over what an id has left of them. ``ids`` are those wanted, all by default.
    """
    rows = rows if ids is None else ids.before(rows)
    last = F.max_by(F.struct("value", "ord"), "ord").alias("_last")
    kept = rows.groupBy("id", field_key(F.col("field")).alias("field"), "fy").agg(last).select("id", "field", "fy", "_last.*")
    kept = kept if ids is None else ids.after(kept)
    latest = F.max("fy").over(Window.partitionBy("id"))
    return kept.withColumn("base", field_base(F.col("field"))).withColumn("latest", latest)


def vendor_lookup(vendor: DataFrame, ids: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(id, field, value, display) for every id and requested field.

    One scan and one semi-join for all fields; only rows of wanted ids are shuffled, and without a
    period only those of wanted fields. A field with a period takes the row stored under that
    name, else the value of that year.
    """
    keys = field_keys(fields)
    rows = vendor.withColumn("id", norm_key(F.col("id")))
    if any(PERIOD_MARK in k for k in keys):
        answers = vendor_answers(yearly(rows, Wanted.of(_upper_ids(ids), ["id"])), keys, F.col("ord"))
    else:
        rows = rows.where(field_key(F.col("field")).isin(*keys))
        answers = last_wins(only(rows, _upper_ids(ids), ["id"], ["ord"]))
    return every_value(ids, answers, keys)


def point_lookup(vendor: DataFrame, ids: DataFrame, fields: Sequence[str]) -> DataFrame:
    """First row per wanted id and existing field, spelled as stored."""
    rows = only(vendor.where(F.col("field").isin(*fields)), ids, ["id"], ["ord"])
    return (
        rows.groupBy("id", "field")
        .agg(first_by(F.col("value"), ["ord"]).alias("value"))
    )


def relative_period(
    vendor: DataFrame, fields: Sequence[str], ids: DataFrame | None = None
) -> DataFrame:
    """Values for fields such as EBIT(Period=FY-1): n years before the id's latest year.

    Only rows of wanted ids (all without ``ids``) are shuffled; an id's latest year is that
    of any of its fields. Ids come back in upper case.
    """
    rows = vendor.withColumn("id", norm_key(F.col("id")))
    if ids is not None:
        rows = only(rows, _upper_ids(ids), ["id"], ["ord"])
    base = field_base(F.col("field"))
    by_year = rows.groupBy("id", base.alias("base"), "fy").agg(F.max_by("value", "ord").alias("value"))
    dated = by_year.withColumn("latest", F.max("fy").over(Window.partitionBy("id")))
    asked = [F.struct(F.lit(f).alias("field"), field_base(F.lit(f)).alias("base"), years_back(F.lit(f)).alias("back")) for f in dict.fromkeys(fields)]
    fits = F.filter(F.array(*asked), lambda a: (a["base"] == F.col("base")) & (F.col("fy") == F.col("latest") - a["back"]))
    return dated.select("id", F.explode(fits).alias("_a"), "fy", "value").select("id", "_a.field", "fy", "value")


def first_filled(raw: Column, cleaned: Column) -> Column:
    """The value under the requested spelling, else under the cleaned one."""
    return F.coalesce(F.when(raw != "", raw), cleaned)
