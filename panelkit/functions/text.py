"""Parsing of published text columns and rendering of numbers for display."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.numeric import as_col, round_half_up

# Texts that publishers print in place of a withheld number.
SUPPRESSION_TOKENS = ("-", "–", "Suppressed", "Suppr.", "N/A", "")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def tidy(c: Column | str) -> Column:
    """Trim spaces, counting the no-break space as one."""
    return F.trim(F.translate(as_col(c), "\u00a0", " "))


def parse_number(c: Column | str, tokens: Sequence[str] = SUPPRESSION_TOKENS) -> Column:
    """A double from text with thousands separators; NULL for a token or for junk."""
    text = tidy(c)
    digits = F.regexp_replace(text, ",", "")
    return F.when(~text.isin(*tokens) & digits.rlike(NUMBER), digits.try_cast("double"))


def is_unparsed(c: Column | str, tokens: Sequence[str] = SUPPRESSION_TOKENS) -> Column:
    """True for text that is neither a number nor a known token, for quality counts."""
    text = tidy(c)
    return F.coalesce(~text.isin(*tokens) & ~F.regexp_replace(text, ",", "").rlike(NUMBER), F.lit(False))


def parse_period(c: Column | str) -> Column:
    """The first four digits of a label such as '2022-2023' or '20202021*'."""
    return F.left(F.regexp_replace(as_col(c), "[^0-9]", ""), F.lit(4)).try_cast("int")


def parse_leading_year(c: Column | str) -> Column:
    """The first four characters of a label such as '2019-01-01'."""
    return F.left(F.trim(as_col(c)), F.lit(4)).try_cast("int")


def partial_period_flag(c: Column | str) -> Column:
    """True for a label that names only part of a year, as in '2025 (Jan to Sep)'."""
    return F.coalesce(F.trim(as_col(c)).like("%(%)%"), F.lit(False))


@lru_cache(1)
def _accent_table() -> tuple[str, str]:
    """Each letter with marks and its base letter, by the canonical decompositions of all of Unicode."""
    accented, base = [], []
    for point in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFD", chr(point))
        plain = "".join(x for x in parts if unicodedata.category(x) != "Mn")
        if len(plain) == 1 and len(parts) > 1:
            accented.append(chr(point))
            base.append(plain)
    return "".join(accented), "".join(base)


def fold_accents(c: Column | str) -> Column:
    """Replace letters with marks by their base letters and drop combining marks."""
    return F.regexp_replace(F.translate(as_col(c), *_accent_table()), r"\p{Mn}", "")


def show_number(c: Column | str, digits: int = 1, signed: bool = False, missing: str = "N/A") -> Column:
    """Fixed-decimal text, ``missing`` for NULL. Halves round away from zero,
    and a small negative number keeps its sign."""
    value = as_col(c).cast("double")
    size = F.format_string(f"%.{digits}f", F.abs(round_half_up(value, digits)))
    size = F.when(value.isNotNull() & ~F.isnan(value), size)
    sign = F.when(value < 0, "-").otherwise("+" if signed else "")
    return F.coalesce(F.concat(sign, size), F.lit(missing))
