"""Field extraction and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# Unicode white space as a regex class both Java and RE2 accept.
WS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
WS_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
ASCII_WS = r"[\x{09}-\x{0d}\x{20}]+"

# Date-time group, marker and coordinate patterns.
DTG = r"(?i)(\d{2})(\d{2})(\d{2})Z[\x{09}-\x{0d}\x{20}]*(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)(\d{2})"
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
FLASH = r"(?i)FLASH[\x{09}-\x{0d}\x{20}]*[:\-]?[\x{09}-\x{0d}\x{20}]*"
LATLON = r"(\d{1,3}\.\d+)([NS])[,\x{09}-\x{0d}\x{20}]+(\d{1,3}\.\d+)([EW])"
TIER_WORDS = {
    "CRITICAL": ("imminent", "attack", "strike", "flash"),
    "HIGH": ("movement", "surveillance", "observed"),
}
PRIORITY_WORDS = ("FLASH", "IMMEDIATE", "PRIORITY")

# Numbered report line, distance and speed patterns.
REPORT_LINE = r"^(\d+)\.[\x{09}-\x{0d}\x{20}]+(\d+)/(\d+)Z:[\x{09}-\x{0d}\x{20}]+([^\n]+)"
DISTANCE = r"(?i)(\d+(?:\.\d+)?)[\x{09}-\x{0d}\x{20}]*NM"
SPEED = r"(?i)(\d+(?:\.\d+)?)[\x{09}-\x{0d}\x{20}]*knots?"


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.trim(text, F.lit(WS_CHARS))


def words(text: Column) -> Column:
    """White-space separated words of the whole text; empty array for blank text."""
    return F.array_remove(F.split(text, WS), "")


def tokens(text: Column) -> Column:
    return words(F.lower(text))


def group_or_null(text: Column, pattern: str, group: int) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def dtg_match(text: Column) -> Column:
    """The first date-time group as written, '' when there is none."""
    return F.regexp_extract(text, DTG, 0)


def dtg_time(match: Column) -> Column:
    """A matched date-time group as a timestamp; NULL when absent or impossible."""
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.upper(F.substring(match, -5, 3)))

    def number(start: int) -> Column:
        return F.substring(match, start, 2).try_cast("int")

    return F.try_make_timestamp_ntz(
        2000 + number(-2), month.cast("int"), number(1), number(3), number(5), F.lit(0).cast("decimal(16,6)")
    )


def strip_flash(text: Column) -> Column:
    return strip(F.regexp_replace(text, FLASH, ""))


def position_match(text: Column) -> Column:
    """The first latitude/longitude pair as written, '' when there is none."""
    return F.regexp_extract(text, LATLON, 0)


def coordinate(match: Column, axis: str, signed: bool = True) -> Column:
    """One coordinate of a matched pair."""
    number, letter, negative = (1, 2, "S") if axis == "lat" else (3, 4, "W")
    value = group_or_null(match, LATLON, number).cast("double")
    if not signed:
        return value
    return F.when(F.regexp_extract(match, LATLON, letter) == negative, -value).otherwise(value)


def first_match(cases: Iterable[tuple[Column, str]], default: str | None) -> Column:
    """Value of the first true case, else ``default``."""
    hits = [F.when(condition, F.lit(value)) for condition, value in cases]
    return F.coalesce(*hits, F.lit(default).cast("string"))


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    hit = F.lit(False)
    for k in keywords:
        hit = hit | text.contains(k)
    return hit


def keyword_tier(text: Column, words_by_tier: Mapping[str, Sequence[str]] = TIER_WORDS) -> Column:
    low = F.lower(text)
    return first_match([(contains_any(low, ks), tier) for tier, ks in words_by_tier.items()], "MEDIUM")


def priority_tier(text: Column) -> Column:
    upper = F.upper(text)
    return first_match([(upper.contains(word), word) for word in PRIORITY_WORDS], "ROUTINE")


def entity_tokens(text: Column, keep: int = 10) -> Column:
    """Tokens reduced to capitals A-Z, 2..8 long, distinct in order, first ``keep``."""
    capitals = F.transform(F.split(text, ASCII_WS), lambda t: F.regexp_replace(t, "[^A-Z]", ""))
    sized = F.filter(capitals, lambda t: F.length(t).between(2, 8))
    return F.coalesce(F.slice(F.array_distinct(sized), 1, keep), F.array().cast("array<string>"))


def summary(text: Column, longest: int = 120) -> Column:
    """First sentence, cut to ``longest`` with an ellipsis; '' for blank text."""
    stop = F.instr(text, ".")
    first = F.when(stop > 1, F.substring(text, F.lit(1), stop)).otherwise(text)
    cut = F.when(F.length(first) > longest, F.concat(F.substring(first, 1, longest - 3), F.lit("...")))
    return F.when(text.isNull() | (strip(text) == ""), "").otherwise(F.coalesce(cut, first))


def fingerprint(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def excerpt(text: Column, longest: int = 300) -> Column:
    return F.substring(text, 1, longest)
