"""Text expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A local part, an @ and at least two domain labels joined by dots. An address starts where a run of local
# characters starts (or right after the last match) and the quantifiers never give back, so the matcher
# looks at every character once.
EMAIL = r"(?:\G|(?<![\w.%+-]))[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"


def capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


_LOW, _UP = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def swap_case(c: Column) -> Column:
    return F.translate(c, _LOW + _UP, _UP + _LOW)


def centred(c: Column, width: int, fill: str = " ") -> Column:
    """Pad on both sides; never cuts."""
    gap = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    left = F.floor(gap / 2).cast("int")
    return F.concat(F.repeat(F.lit(fill), left), c, F.repeat(F.lit(fill), gap - left))


def pad_left(c: Column, width: int, fill: str = " ") -> Column:
    return F.concat(F.repeat(F.lit(fill), F.greatest(F.lit(width) - F.length(c), F.lit(0))), c)


def pad_right(c: Column, width: int, fill: str = " ") -> Column:
    return F.concat(c, F.repeat(F.lit(fill), F.greatest(F.lit(width) - F.length(c), F.lit(0))))


def find(c: Column, needle: str) -> Column:
    """0-based place of the first match, -1 if absent."""
    return F.instr(c, needle) - 1


def rfind(c: Column, needle: str) -> Column:
    """0-based place of the last match, -1 if absent."""
    at = F.instr(F.reverse(c), needle[::-1])
    return F.when(at > 0, F.length(c) - at - len(needle) + 1).otherwise(-1)


def wrapped(c: Column, width: int) -> Column:
    """Break at spaces so that lines of ordinary words fit ``width``."""
    return F.rtrim(F.regexp_replace(c, rf"(.{{1,{width}}})(?:\s+|$)", "$1\n"), F.lit("\n"))


def clock_seconds(c: Column) -> Column:
    """``h:m:s`` as seconds."""
    p = F.split(c, ":")
    return p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int")


def mask_emails(c: Column, mask: str = "[address]") -> Column:
    """Hide e-mail addresses; texts without an @ skip the regular expression."""
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, mask)).otherwise(c)


def count_emails(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), F.regexp_count(c, F.lit(EMAIL))).otherwise(0)


def clean_sensor_label(c: Column) -> Column:
    """Canonical label from the first number in a messy one."""
    number = F.regexp_extract(c, r"(\d+)", 1).try_cast("int")
    return F.concat(F.lit("WEC-"), pad_left(number.cast("string"), 2, "0"))


def unicode_nfc(c: Column) -> Column:
    """Unicode composed form; the JVM has no SQL function for it."""

    @F.pandas_udf("string")
    def nfc(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")

    return nfc(c)
