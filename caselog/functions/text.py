"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as text tools count it: Unicode spaces (NBSP too) plus the four separators.
BLANK = r"[\s\x1c-\x1f]"
# The same characters one by one.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def strip_cell(cell: Column) -> Column:
    """strip_blank of a column of short cells: only those that start or end in a blank are searched.

    The cell is mentioned several times, so pass a column, not a costly expression.
    """
    ends = [F.ascii(cell), F.ascii(F.substring(cell, -1, 1))]
    return F.when(ends[0].between(33, 126) & ends[1].between(33, 126), cell).otherwise(strip_blank(cell))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once per row, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(text, rf"(?U){BLANK}+", " ")


def squeeze_strip(text: Column) -> Column:
    return F.trim(squeeze(text))


def clean_cell(value: Column) -> Column:
    """Spreadsheet cell to text: null to empty, strip, drop one leading equals sign.

    Without a pattern, whose code per cell makes a table's cleaning a method too long for Java to compile.
    """
    text = strip_blank(F.coalesce(value.cast("string"), F.lit("")))
    return F.substr(text, F.when(F.startswith(text, F.lit("=")), 2).otherwise(1))


def pipe_safe(value: Column) -> Column:
    """Text that cannot break a bar-separated timeline."""
    text = F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("|"), F.lit(" / "))
    return squeeze_strip(text)


def is_blank(text: Column) -> Column:
    return F.coalesce(strip_blank(text), F.lit("")) == ""


def null_if_blank(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def word_count(text: Column) -> Column:
    """Runs of other characters than white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"(?U)[^{BLANK[1:-1]}]+")), F.lit(0))


def _latin_folding() -> tuple[str, str]:
    source, target = [], []
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0].lower()
        if base.isascii() and base.isalpha():
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _latin_folding()


def fold(text: Column) -> Column:
    """Lower case without accents, the form every phrase list is matched against."""
    return F.translate(F.lower(text), _ACCENTED, _PLAIN)


def plain_words(name: str) -> str:
    """The folded words of a name, one space apart."""
    folded = name.lower().translate(str.maketrans(_ACCENTED, _PLAIN))
    return " ".join(re.findall(r"[a-z0-9]+", folded))


def phrase_pattern(phrase: str) -> str:
    """A phrase starts where a word starts; one that ends in a space also ends where a word ends."""
    start = r"(?<![a-z0-9])" if phrase[:1].isalnum() else ""
    end = r"(?![a-z0-9])" if phrase.endswith(" ") else ""
    return start + re.escape(phrase.rstrip(" ") if end else phrase).replace(r"\ ", " ") + end


def has_any(folded: Column, phrases: list[str]) -> Column:
    """True where one of the folded phrases occurs at the start of a word; null text gives false."""
    return F.coalesce(folded.rlike("|".join(map(phrase_pattern, phrases))), F.lit(False))


def matches(folded: Column, pattern: str) -> Column:
    return F.coalesce(folded.rlike(pattern), F.lit(False))


def first_of_list(value: Column, blank_to_null: bool = False) -> Column:
    """Scalar of a cell: strip, and take the first element of a bracketed list literal."""
    text = strip_blank(value.cast("string"))
    parsed = F.from_json(text, "array<string>")
    bracketed = text.startswith("[") & text.endswith("]") & (F.size(parsed) > 0)
    first = F.when(bracketed, F.coalesce(F.get(parsed, F.lit(0)), text)).otherwise(text)
    return F.nullif(first, F.lit("")) if blank_to_null else first


def json_text(value: Column) -> Column:
    """A string column as a JSON string token, null as the JSON null."""
    wrapped = F.to_json(F.struct(value.cast("string").alias("v")))
    return F.when(value.isNull(), F.lit("null")).otherwise(
        F.regexp_extract(wrapped, r'(?s)^\{"v":(.*)\}$', 1)
    )
