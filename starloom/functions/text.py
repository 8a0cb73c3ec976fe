"""Text cleaning, splitting, case and digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starloom.functions.timeparts import SECOND_FORMAT


# What counts as whitespace, as \\s does in a regular expression.
WHITESPACE = " \t\n\x0b\f\r"


def blank_to_null(text: Column) -> Column:
    """NULL for an empty or whitespace-only string (tabs and newlines included).

    Trimming on the left stops at the first other character, which a regular expression search
    would not.
    """
    return F.when(F.ltrim(text, F.lit(WHITESPACE)) != "", text)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def truncate(text: Column, length: int, unit: str = "chars") -> Column:
    """Cut to a declared length, counted in characters or in UTF-8 bytes.

    A byte limit never splits a character: a broken last character is left out.
    """
    if unit == "chars":
        return F.substring(text, 1, length)
    if unit != "bytes":
        raise ValueError(f"unit must be 'chars' or 'bytes', not {unit!r}")
    cut = F.substring(F.encode(text, "UTF-8"), 1, length).cast("string")
    whole = F.substring(cut, F.lit(1), F.char_length(cut) - F.lit(1))
    return F.when(F.is_valid_utf8(cut), cut).otherwise(whole)


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.regexp_replace(text, rf"^\Q{prefix}\E", "")


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    words = F.split(F.lower(text), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(words, lambda w: F.initcap(w)), "")


def split_city_state(label: Column, legacy: bool = False) -> tuple[Column, Column]:
    """Lower-case city and state of "CITY, ST", "CITY,ST" or "CITY ST".

    With `legacy` only ", " separates, a label without it is cut at its last blank, and the
    remaining words are joined by commas.
    """
    text = F.rtrim(label)
    words = F.split(text, " ")
    if legacy:
        parts = F.split(text, ", ")
        has_state = F.size(parts) > 1

        def head(items: Column) -> Column:
            return F.array_join(F.slice(items, F.lit(1), F.size(items) - F.lit(1)), ",")

        city = F.when(has_state, head(parts)).otherwise(head(words))
        state = F.when(has_state, F.substring(F.element_at(parts, -1), 1, 2)).otherwise(
            F.element_at(words, -1)
        )
        return F.lower(city), F.lower(state)
    # City, then either a comma and the state, or a blank and a two-letter state.
    pattern = r"^(.*?)(?:\s*,\s*([^,]*)|\s+([A-Z]{2}))?$"
    tail = F.concat(F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3))
    city = F.regexp_extract(text, pattern, 1)
    return F.lower(city), empty_to_null(F.lower(F.substring(tail, 1, 2)))


def as_text(value: Column, kind: str = "string") -> Column:
    """Text of a value; timestamps get an explicit format."""
    return F.date_format(value, SECOND_FORMAT) if kind == "timestamp" else value.cast("string")


def md5_key(*texts: Column) -> Column:
    """Hex digest of the texts put together; NULL if any is NULL."""
    return F.md5(F.concat(*texts))
