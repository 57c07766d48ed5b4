"""Cleaning of header and cell text, number recognition, column letters, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: text that counts as "no value", and the footnote marker in headers
NULL_MARKERS = ("[x]", "[c]", "[z]", "..", "")
NOTE_PATTERN = r"\[[Nn]ote\s*\d+\]"

# --- fixed values: characters that count as white space at the ends of a text
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

_CODE = r"^0[0-9]+$"
_NUMBER = r"^[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Ends stripped; the character-set trim only runs where an end is not plain ASCII."""
    plain_ends = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(plain_ends, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; the ends are stripped."""
    return strip(F.regexp_replace(text, _WHITESPACE_RUN, " "))


def clean_header(text: Column, note_pattern: str | None = NOTE_PATTERN) -> Column:
    """Header label: note marker removed, white space squeezed, empty becomes null."""
    stripped = strip(text)
    if note_pattern:
        stripped = F.regexp_replace(stripped, F.lit(note_pattern), F.lit(""))
    return F.nullif(squeeze(stripped), F.lit(""))


def clean_value(
    text: Column, kind: Column | None = None, null_markers: Sequence[str] = NULL_MARKERS
) -> Column:
    """Cell text: stripped, null markers to null. Cells that are not text pass untouched."""
    stripped = strip(text)
    empty = stripped.isin(*null_markers, "")
    cleaned = F.when(~empty, stripped)
    return cleaned if kind is None else F.when(kind == "string", cleaned).otherwise(text)


def number_text(text: Column, thousands: str = ",", decimal: str = ".") -> Column:
    """The plain number a text spells, as text; null when it is not safely numeric.

    A run of digits with a leading zero is a code, not a number. The pattern gates
    the later cast, because a cast alone would also accept ``1d`` or ``NaN``.
    """
    t = strip(text)
    plain = F.replace(t, F.lit(thousands), F.lit("")) if thousands else t
    if decimal and decimal != ".":
        plain = F.replace(plain, F.lit(decimal), F.lit("."))
    is_code = t.startswith("0") & t.rlike(_CODE)
    return F.when(~is_code & plain.rlike(_NUMBER), plain)


def is_whole_text(number: Column) -> Column:
    """True for number text without a fraction or exponent."""
    return ~(number.contains(".") | number.contains("e") | number.contains("E"))


def number_double(number: Column) -> Column:
    return number.try_cast("double")


def number_bigint(number: Column) -> Column:
    """BIGINT of number text whose value is whole; null when it does not fit."""
    as_double = number.try_cast("double")
    return F.when(is_whole_text(number), number.try_cast("bigint")).when(
        (as_double == F.floor(as_double)) & (F.abs(as_double) < F.lit(9.2e18)),
        as_double.try_cast("bigint"),
    )


def column_index(letters: Column) -> Column:
    """``A`` → 1, ``AB`` → 28; a number given as text stays that number."""
    t = F.upper(strip(letters))
    folded = F.aggregate(
        F.split(t, ""),
        F.lit(0),
        lambda acc, ch: F.when(ch == "", acc).otherwise(acc * 26 + F.ascii(ch) - 64),
    )
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("int")).when(t.rlike("^[A-Z]{1,3}$"), folded)


def column_letters(index: Column) -> Column:
    """1 → ``A``, 28 → ``AB``; three letters cover every legal sheet column."""
    one = F.pmod(index - 1, F.lit(26))
    rest = F.floor((index - 1) / 26)
    two = F.pmod(rest - 1, F.lit(26))
    top = F.floor((rest - 1) / 26)

    def letter(n: Column) -> Column:
        return F.char((n + 65).cast("int"))

    return F.concat(
        F.when(top > 0, letter(top - 1)).otherwise(""),
        F.when(rest > 0, letter(two)).otherwise(""),
        letter(one),
    )


def slug(name: Column) -> Column:
    """Output name of a sheet: lower case, blanks and dots to underscores."""
    return F.regexp_replace(F.lower(name), "[ .]", "_")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def trim_slash(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def table_name(catalog: Column, schema: Column, domain: Column, entity: Column) -> Column:
    """``catalog.schema.domain_entity``"""
    return F.concat_ws(".", catalog, schema, F.concat_ws("_", domain, entity))


# --- plain-Python twins for values that are part of the (driver-side) configuration
def letters_to_index(column: str | int) -> int:
    if isinstance(column, int):
        return column
    text = str(column).strip().upper()
    if text.isdigit():
        return int(text)
    index = 0
    for ch in text:
        index = index * 26 + ord(ch) - 64
    return index


def squeeze_name(name: str) -> str:
    return " ".join(str(name).split())
