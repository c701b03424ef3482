"""Scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACRE_FOOT_M3 = 1233.48184


def _null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def site_no(text: Column) -> Column:
    """The digits after site_no=, in any case; else the first number of 5 to 15 digits that stands alone; else null."""
    return F.coalesce(_null_if_empty(F.regexp_extract(text, r"(?i)site_no=(\d+)", 1)), _null_if_empty(F.regexp_extract(text, r"\b(\d{5,15})\b", 1)))


def strip_html(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "<[^>]+>", ""))


def state_from_file_name(stem: Column) -> Column:
    """What follows streamgages_, or else the last _ token, with blanks for _ and - and capitals."""
    low = F.lower(stem)
    part = F.when(F.contains(low, F.lit("streamgages_")), F.substring_index(low, "streamgages_", -1)).otherwise(F.substring_index(low, "_", -1))
    return F.initcap(F.trim(F.regexp_replace(part, "[_-]+", " ")))


def without_suffix(text: Column, suffix: str = "OT") -> Column:
    return F.regexp_replace(text, f"{suffix}$", "")


def id_text(value: Column) -> Column:
    """An id read as a number, as text without decimals."""
    return value.cast("double").cast("long").cast("string")


def zero_to_null(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(number != 0, number)


def null_text_to_null(text: Column) -> Column:
    return F.when(~text.isin("<NA>", "None", "nan"), text)


def flag(value: Column) -> Column:
    """True for true and 1, whatever the type."""
    return F.lower(value.cast("string")).isin("true", "1")


def relative_error(value: Column, target: Column) -> Column:
    return F.when(target > 0, F.abs(value - target) / target)


def slope(dz: Column, distance: Column, least: float = 1e-5) -> Column:
    return F.greatest(F.coalesce(F.when(distance > 0, F.abs(dz) / distance), F.lit(least)), F.lit(least))


def file_date(name: Column) -> Column:
    return F.try_to_date(_null_if_empty(F.regexp_extract(name, r"(\d{8})", 1)), "yyyyMMdd")


#: The 20 characters of a location code, in order of their worth.
CODE_ALPHABET = "23456789CFGHJMPQRVWX"


def location_code_number(code: Column) -> Column:
    """A location code as a number to base 20; characters that aren't in the alphabet are passed over."""
    digits = F.split(F.regexp_replace(F.upper(code), f"[^{CODE_ALPHABET}]", ""), "")
    return F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0).cast("long"), lambda total, d: total * 20 + (F.instr(F.lit(CODE_ALPHABET), d) - 1).cast("long"))


def location_code(lat: Column, lon: Column, digits: int = 12) -> Column:
    """The Open Location Code of a point with 10 to 15 digits, in whole-number arithmetic of the finest cell.

    Ten digits are pairs of base-20 places of latitude and longitude; each further digit is one of a grid of 5 rows and 4 columns.
    """
    grid = 5
    lat_units, lon_units = 8000 * 5**grid, 8000 * 4**grid  # finest cells to a degree
    y = F.floor(F.round((lat + 90) * lat_units, 6)).cast("long")
    y = F.greatest(F.lit(0), F.least(y, F.lit(180 * lat_units - 1)))
    x = F.pmod(F.floor(F.round((lon + 180) * lon_units, 6)).cast("long"), F.lit(360 * lon_units))
    alphabet = F.lit(CODE_ALPHABET)
    at = lambda place: F.substr(alphabet, place.cast("int") + 1, F.lit(1))
    whole = lambda c, n: (c - F.pmod(c, F.lit(n))) / n
    parts = []
    for k in range(5):
        parts += [at(F.pmod(whole(y, 5**grid * 20 ** (4 - k)), F.lit(20))), at(F.pmod(whole(x, 4**grid * 20 ** (4 - k)), F.lit(20)))]
        if k == 3:
            parts.append(F.lit("+"))
    for k in range(digits - 10):
        row = F.pmod(whole(y, 5 ** (grid - 1 - k)), F.lit(5))
        col = F.pmod(whole(x, 4 ** (grid - 1 - k)), F.lit(4))
        parts.append(at(row * 4 + col))
    return F.concat(*parts)
