"""Lenient numbers and dates: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words and marks that make a number negative, in vendor data and in pasted rows.
FALLS, PASTED_FALLS = r"하락|▼", r"하락|감소|▼"
# What counts as a number, the units that a page's numbers stand with, what pasted numbers are made of, and
# the forms of a date: in pasted rows, and anywhere in a feed's date.
NUMBER, UNITS, NOT_NUMERIC = r"[-+]?\d+(?:\.\d+)?", r"[,%원톤\s]", r"[^0-9.+-]"
EIGHT_DIGITS, YEAR_MONTH_DAY, DATE_ANYWHERE = r"^\d{8}$", r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"(20\d{2})[./-]?(\d{1,2})[./-]?(\d{1,2})"


def number(text: Column) -> Column:
    """First number in the text: thousands commas dropped, negative after a falling mark; null for '', '-', '--'."""
    t = F.replace(F.trim(text), F.lit(","))
    value = F.regexp_extract(t, NUMBER, 0).try_cast("double")
    return F.when(t.isin("", "-", "--"), None).when(t.rlike(FALLS), -F.abs(value)).otherwise(value)


def clean_number(value: Column) -> Column:
    """Null becomes 0; four decimals, halves up."""
    return F.coalesce(F.floor(value * 10000 + 0.5) / 10000, F.lit(0.0))


def ui_number(text: Column) -> Column:
    """The text without units and white space as a number; 0 if it is none."""
    return F.coalesce(F.regexp_replace(text, UNITS, "").try_cast("double"), F.lit(0.0))


def pasted_number(text: Column) -> Column:
    """What is left of digits, signs and points as a number; 0 if it is none; negative after a falling mark."""
    t = F.trim(F.replace(text, F.lit(",")))
    value = F.coalesce(F.regexp_replace(t, NOT_NUMERIC, "").try_cast("double"), F.lit(0.0))
    return F.when(t.rlike(PASTED_FALLS), -F.abs(value)).otherwise(value)


def iso_date(text: Column) -> Column:
    """YYYY-MM-DD of YYYYMMDD or of year, month and day between -, . or /; else ''."""
    t = F.translate(F.trim(text), "./", "--")
    part = lambda k, n: F.lpad(F.regexp_extract(t, YEAR_MONTH_DAY, k), n, "0")
    return (
        F.when(t.rlike(EIGHT_DIGITS), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))
        .when(t.rlike(YEAR_MONTH_DAY), F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2)))
        .otherwise("")
    )


def feed_date(text: Column, as_of: Column) -> Column:
    """Business date in Seoul of a feed's RFC-2822 date, or of any year, month and day in it; ``as_of`` if it has none."""
    t = F.replace(F.trim(text), F.lit(" KST "), F.lit(" +0900 "))
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3},\s*", ""), r"\s+(?:GMT|UTC|UT)$", " +0000"), r" KST$", " +0900")
    bare = F.regexp_replace(t, r"\s+[+-]\d{4}$", "")
    zone = F.regexp_extract(t, r"([+-])(\d{2})(\d{2})$", 0)
    minutes = F.when(zone == "", 540).otherwise(F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1) * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int")))
    # Days and month names are read as text, as they come; the offset is applied by arithmetic, so no session zone matters.
    local = F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")
    seoul = local + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(540) - minutes)
    part = lambda k, n: F.lpad(F.regexp_extract(t, DATE_ANYWHERE, k), n, "0")
    return F.coalesce(F.date_format(seoul, "yyyy-MM-dd"), F.when(part(1, 4) != "0000", F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2))), as_of)


def header_key(name: Column) -> Column:
    """A column's name for comparison: lower case, without blanks and punctuation."""
    return F.regexp_replace(F.lower(name), r"[\s_()（）%·/.-]", "")


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, value))
