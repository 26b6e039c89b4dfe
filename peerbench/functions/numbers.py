"""Numbers held as text: reading and display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from peerbench.constants import ERROR_TOKENS
from peerbench.functions.text import any_word, norm_key, strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a finite plain number is null.

    The pattern keeps out forms a bare cast takes ("1d", "nan", "Infinity"),
    so no NaN or infinity ever reaches an average.
    """
    t = strip(c.cast("string"))
    v = F.when(t.rlike(NUMBER), t.try_cast("double"))
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def finite(c: Column) -> Column:
    """A numeric column without NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def as_number(df: DataFrame, name: str) -> Column:
    """A column as finite double, read from text where the column is text."""
    c = F.col(name)
    return to_number(c) if df.schema[name].dataType == StringType() else finite(c.cast("double"))


def without_marks(c: Column) -> Column:
    """Drop thousands separators and percent signs."""
    return F.regexp_replace(c, "[,%]", "")


def display_value(c: Column) -> Column:
    """Vendor display text: from 1000 up grouped without decimals, else two decimals."""
    v = to_number(c)
    return (
        F.when(c.isNull(), "")
        .when(v >= 1000, F.format_number(v, 0))
        .when(v.isNotNull(), F.format_string("%.2f", v))
        .otherwise(c.cast("string"))
    )


def display_magnitude(c: Column) -> Column:
    """Report display text for digit-only values: two decimals from 1 up, four below."""
    t = c.cast("string")
    digits = F.regexp_replace(t, r"[.\-]", "").rlike(r"^\d+$")
    v = F.when(digits, to_number(t))
    return (
        F.when(F.abs(v) >= 1, F.format_number(v, 2))
        .when(v.isNotNull(), F.format_number(v, 4))
        .otherwise(t)
    )


def is_error_text(c: Column) -> Column:
    return F.coalesce(norm_key(c).rlike(any_word(ERROR_TOKENS)), F.lit(False))


def is_code_like(c: Column, own_id: Column) -> Column:
    """A value that is an instrument code rather than a metric."""
    t = norm_key(c)
    return F.coalesce(
        (t == norm_key(own_id)) | t.rlike(r"^[A-Z]{1,6}(\.[A-Z]{1,3})?$"), F.lit(False)
    )
