"""Scalar rules of the market data, all as built-in expressions."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value.
SENTINELS = ("none", "nan", "null", "")
#: Kinds of securities by the form of their id; the first that fits decides.
SHAPES = (
    ("index", r"^[A-Za-z]"),
    ("etf", r"^00\d{2,4}[A-Z]?$"),
    ("common", r"^[1-9]\d{3}$"),
    ("preferred", r"^[1-9]\d{3}[A-Z]$"),
    ("tdr", r"^\d{5}[A-Z]$"),
    ("warrant", r"^0\d{3}[A-Z]?$"),
    ("warrant", r"^\d{5}$"),
    ("warrant", r"^\d{6}$"),
)
#: Kinds that belong to the universe though the master lacks them.
IN_SCOPE = ("common", "etf")
#: Day 0 of spreadsheet serials; those up to 60 are ambiguous, as the calendar had a day that never was.
SERIAL_EPOCH, LAST_AMBIGUOUS = "1899-12-30", 60


def clean_text(text: Column) -> Column:
    """Trimmed, or null for a sentinel."""
    t = F.trim(text.cast("string"))
    return F.when(~F.lower(t).isin(*SENTINELS), t)


def parse_date(text: Column) -> Column:
    """The ISO date that a text starts with, else null."""
    return F.try_to_date(F.substring(clean_text(text), 1, 10), "yyyy-MM-dd")


def to_double(text: Column) -> Column:
    return clean_text(text).try_cast("double")


def to_long(text: Column) -> Column:
    """Rounded half to even."""
    return F.bround(to_double(text)).try_cast("bigint")


def classify(stock_id: Column) -> Column:
    out = F
    for shape, pattern in SHAPES:
        out = out.when(stock_id.rlike(pattern), shape)
    return out.otherwise("other")


def in_scope(stock_id: Column) -> Column:
    return F.coalesce(classify(stock_id).isin(*IN_SCOPE), F.lit(False))


def normalise_industry(name: Column, aliases: dict[str, str]) -> Column:
    """The alias of an industry, or its own name."""
    if not aliases:
        return name
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(F.try_element_at(table, name), name)


def serial_to_date(serial: Column) -> Column:
    """A spreadsheet's serial day; ambiguous ones raise an error."""
    wrong = F.raise_error(F.concat(F.lit("ambiguous day serial "), serial.cast("string"))).cast("date")
    return F.when(serial <= LAST_AMBIGUOUS, wrong).otherwise(F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial.cast("int")))


def split_security(text: Column) -> tuple[Column, Column]:
    """'2330 Some Name' -> id and name; without a name it is null."""
    parts = F.split(F.trim(text), " ", 2)
    name = F.trim(F.get(parts, F.lit(1)))
    return F.get(parts, F.lit(0)), F.when(name != "", name)


def safe_filename(stock_id: str) -> str:
    """A file name that no other id has, on file systems that ignore case, too."""
    plain = re.sub(r"[^A-Za-z0-9._-]", "_", stock_id)
    if plain == stock_id and stock_id == stock_id.upper() and stock_id not in ("", ".", ".."):
        return plain
    return f"{plain or 'id'}~{hashlib.sha1(stock_id.encode()).hexdigest()[:10]}"
