"""Column expressions that clean and type raw text.

Everything here is a built-in expression, so a whole model projects in one
code-generated stage. A value that cannot be typed becomes NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters cut from both ends, date patterns, flag words, band limits.
WHITESPACE = " \t\n\x0b\x0c\r"
ISO_DATE = "yyyy-M-d"
US_DATE = "M/d/yyyy"
COMPACT_DATE = "yyyyMMdd"
US_DATE_IN_TEXT = r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
PERIOD_PATTERN = r"^[0-9]{8}-[0-9]{8}$"
EIGHT_DIGITS = r"^[0-9]{8}$"
TRUE_WORDS = ("Y", "YES", "TRUE", "T", "1")
FALSE_WORDS = ("N", "NO", "FALSE", "F", "0")
BODY_MASS_BANDS = ((18.5, "Underweight"), (25.0, "Normal weight"), (30.0, "Overweight"))
BODY_MASS_TOP = "Obese"

FACILITY_KEY_WIDTH = 6
ZIP_WIDTH = 5


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def trimmed(column: Column | str) -> Column:
    """Cut white space, tabs and line ends from both sides."""
    return F.btrim(_c(column), F.lit(WHITESPACE))


def drop_quotes(column: Column | str) -> Column:
    return F.replace(_c(column), F.lit('"'), F.lit(""))


def unquoted(column: Column | str) -> Column:
    """Trim, then take every double quote out."""
    return drop_quotes(trimmed(column))


def padded_key(column: Column | str, width: int = FACILITY_KEY_WIDTH) -> Column:
    """Clean an identifier and left-pad it with zeros; longer text is cut to ``width``."""
    return F.lpad(unquoted(column), width, "0")


def zip_code(column: Column | str) -> Column:
    return padded_key(column, ZIP_WIDTH)


def to_number(column: Column | str, dtype: str) -> Column:
    """Type the text as it stands; NULL when it does not parse."""
    return _c(column).try_cast(dtype)


def unquoted_number(column: Column | str, dtype: str) -> Column:
    return unquoted(column).try_cast(dtype)


# The shape each pattern asks for; the named groups are put in ISO order before the cast.
_DATE_SHAPES = {
    ISO_DATE: "(?<y{0}>[0-9]{{4}})-(?<m{0}>[0-9]{{1,2}})-(?<d{0}>[0-9]{{1,2}})",
    US_DATE: "(?<m{0}>[0-9]{{1,2}})/(?<d{0}>[0-9]{{1,2}})/(?<y{0}>[0-9]{{4}})",
    COMPACT_DATE: "(?<y{0}>[0-9]{{4}})(?<m{0}>[0-9]{{2}})(?<d{0}>[0-9]{{2}})",
}


def parse_date(column: Column | str, *patterns: str) -> Column:
    """First pattern that parses wins; NULL when none does. Impossible days do not parse.

    A pattern parser throws, inside the task, for every text that does not fit, and several patterns
    repeat the text's own expression. Here one replacement puts whichever shape fits into ISO order
    and leaves ``--`` of any other text, which the cast turns to NULL. The shapes exclude each other,
    so their order does not matter.
    """
    patterns = patterns or (ISO_DATE,)
    if any(p not in _DATE_SHAPES for p in patterns):
        return F.coalesce(*(F.try_to_date(_c(column), p) for p in patterns))
    shapes = "|".join(_DATE_SHAPES[p].format(i) for i, p in enumerate(patterns))
    iso = "-".join("".join(f"${{{part}{i}}}" for i in range(len(patterns))) for part in "ymd")
    return F.regexp_replace(_c(column), rf"(?s)^(?:(?:{shapes})\z|.*)", iso).try_cast("date")


def blank_to_null(column: Column | str) -> Column:
    return F.nullif(_c(column), F.lit(""))


def us_date_text(column: Column | str) -> Column:
    """The first month/day/year group inside free text, NULL when there is none."""
    return blank_to_null(F.regexp_extract(trimmed(column), US_DATE_IN_TEXT, 1))


def date_in_text(column: Column | str) -> Column:
    return parse_date(us_date_text(column), US_DATE)


def period_bounds(column: Column | str) -> tuple[Column, Column]:
    """Start and end date of ``YYYYMMDD-YYYYMMDD``; both NULL for any other text."""
    text = trimmed(column)
    is_period = text.rlike(PERIOD_PATTERN)
    start = F.when(is_period, parse_date(F.substring(text, 1, 8), COMPACT_DATE))
    end = F.when(is_period, parse_date(F.substring(text, 10, 8), COMPACT_DATE))
    return start, end


def flag(column: Column | str) -> Column:
    """Yes/no words to a three-valued boolean."""
    word = F.upper(trimmed(column))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def typed_null(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def has_text(column: Column | str) -> Column:
    return trimmed(column) != ""


def is_compact_date(column: Column | str) -> Column:
    text = trimmed(column)
    return (F.length(text) == 8) & text.rlike(EIGHT_DIGITS)


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator where the denominator is above zero, else NULL."""
    below = _c(denominator)
    return F.when(F.coalesce(below, F.lit(0)) > 0, _c(numerator) / below.cast("double"))


def product_or_zero(left: Column | str, right: Column | str) -> Column:
    return F.coalesce(_c(left), F.lit(0.0)) * F.coalesce(_c(right), F.lit(0.0))


def body_mass(height_cm: Column | str, weight_kg: Column | str) -> Column:
    metres = _c(height_cm) / 100
    return _c(weight_kg) / (metres * metres)


def body_mass_band(index: Column | str) -> Column:
    value = _c(index)
    (low, low_name), *rest = BODY_MASS_BANDS
    band = F.when(value < low, low_name)
    for limit, name in rest:
        band = band.when(value < limit, name)
    return band.when(value.isNotNull(), BODY_MASS_TOP)


def prefix(column: Column | str, length: int) -> Column:
    return F.substring(_c(column), 1, length)


def counts_struct(**counters: Column) -> Column:
    """Counters and their sum as one struct of bigint."""
    total = None
    for value in counters.values():
        total = value if total is None else total + value
    fields = [value.cast("bigint").alias(name) for name, value in counters.items()]
    return F.struct(*fields, total.cast("bigint").alias("total_files_seen"))


def run_status(errors: Column | str) -> Column:
    return F.when(_c(errors) == 0, "ok").otherwise("partial_failure")


def iso_wall_time(column: Column | str) -> Column:
    """ISO-8601 text to a zone-less timestamp; the wall time stays, the offset goes."""
    return _c(column).cast("timestamp_ntz")


# --- frame-level helpers -------------------------------------------------------------------


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema`` from ``df``; columns it lacks are typed NULLs."""
    present = set(df.columns)
    return df.selectExpr(
        *(
            f"`{f.name}`" if f.name in present else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`"
            for f in schema.fields
        )
    )


def keep_required(df: DataFrame, columns: Sequence[str], not_blank: Iterable[str] = ()) -> DataFrame:
    """Rows whose required columns are set, and not blank where asked."""
    kept = df.dropna(subset=list(columns))
    for name in not_blank:
        kept = kept.where(has_text(name))
    return kept


def keep_year_and_members(df: DataFrame, date_text: str, year: str, column: str, members: Sequence) -> DataFrame:
    return df.where((prefix(date_text, 4) == year) & F.col(column).isin(*members))


def keep_date_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """start <= column < end."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def with_reversed_text(df: DataFrame, column: str) -> DataFrame:
    """Reverse the text of ``column`` when the frame has it."""
    return df.withColumn(column, F.reverse(column)) if column in df.columns else df
