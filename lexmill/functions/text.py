"""Text expressions that agree with Python's string methods; all run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends and blanks as Python's splitlines and strip know them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
BLANK = r"[\s\p{Z}\x1C-\x1F\x85]"
#: A word: letters, digits and underscores, with hyphens inside.
WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_-]*[\p{L}\p{N}_])?"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it; Spark repeats it otherwise."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def lines(text: Column) -> Column:
    """splitlines(): no last empty line."""
    return let(F.split(text, LINE_END, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$(?![\\s\\S])", "")


def squeeze(text: Column) -> Column:
    """Blanks in a row become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"{BLANK}+", " "))


def clean_block(text: Column) -> Column:
    """Line ends to \\n, hyphenated line breaks joined, blanks in a row and blank lines in a row reduced, line ends and outer lines trimmed."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N}_])-\n(?=[a-zA-Z])", "")
    t = F.regexp_replace(t, "[ \t]{2,}", " ")
    t = F.regexp_replace(t, "(?dm)[ \t]+$", "")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    return F.regexp_replace(t, "^\n+|\n+\\z", "")


def words(text: Column) -> Column:
    """Lower-case words; hyphens inside stay."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def plain_words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def tokens(text: Column) -> Column:
    """Runs of characters that are not blank."""
    return F.regexp_extract_all(text, F.lit(r"[^\s\p{Z}\x1C-\x1F\x85]+"), F.lit(0))


def sentences(text: Column, most: int | None = None) -> Column:
    """Naive sentences: cut behind . ! or ? and blanks; blank ones dropped; all, or the first ``most``."""
    parts = F.split(text, r"(?<=[.!?])\s+", -1)
    kept = F.filter(F.transform(parts, strip), lambda s: s != "")
    return kept if most is None else F.slice(kept, 1, most)


def count_of(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("int")


def short_sha1(*parts: Column, sep: str = ":", n: int = 12) -> Column:
    return F.substring(F.sha1(F.concat_ws(sep, *parts)), 1, n)


def millionths(value: Column) -> Column:
    """A share from 0 to 1, rounded to six places, in the fewest digits and as other engines write it: 0.00039, 1.2e-05 (a cast gives 3.9E-4)."""

    def of(n: Column) -> Column:
        fixed = F.regexp_replace(F.format_string("%d.%06d", F.floor(n / 1_000_000), n % 1_000_000), "(?<=[0-9])0+$", "")
        tens = F.concat(F.floor(n / 10).cast("string"), F.when(n % 10 > 0, F.concat(F.lit("."), (n % 10).cast("string"))).otherwise(""), F.lit("e-05"))
        return F.when((n == 0) | (n >= 100), F.regexp_replace(fixed, r"\.$", ".0")).when(n < 10, F.concat(n.cast("string"), F.lit("e-06"))).otherwise(tens)

    return let(F.round(F.round(value, 6) * 1_000_000).cast("long"), of)
