"""Cleaning rules as column expressions.

All rules are string built-ins or regular expressions: no Python per row, no array
intermediates, so a cleaning projection stays inside whole-stage codegen. Repetitions that could
backtrack over a long run (a megabyte of blanks, of ``<`` or of word characters) are possessive
or anchored at the start of the run, which keeps every rule linear in the length of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The character classes of the cleaning rules (Java regular expression syntax).
BLANKS = r"\t\n\x0B\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANKS_IN_LINE = BLANKS.replace(r"\n", "")
ASCII_BLANKS_IN_LINE = r"\t\x0B\f\r \x1c-\x1f"
WORD = r"\p{L}\p{N}_"
SIGNATURE_MARKERS = ["\n-- \n", "\n--\n"]
HEADER_END = "\n\n"

# The same blanks as plain characters, for trim.
BLANK_CHARACTERS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
ASCII_BLANK_CHARACTERS = "".join(c for c in BLANK_CHARACTERS if ord(c) < 0x80)


def _replace(text: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def normalize_newlines(text: Column) -> Column:
    """CR LF and lone CR become LF, as when a file is read in text mode."""
    return _replace(text, r"\r\n?", "\n")


def header_part(text: Column) -> Column:
    """What stands before the first blank line; empty when there is none."""
    return F.when(F.contains(text, F.lit(HEADER_END)), F.substring_index(text, HEADER_END, 1)).otherwise(
        F.when(text.isNotNull(), F.lit(""))
    )


def strip_headers(text: Column) -> Column:
    """Drop everything up to the first blank line; a text without one is kept as it is."""
    end = F.locate(HEADER_END, text)
    return F.when(end > 0, F.substring(text, end + len(HEADER_END), F.length(text))).otherwise(text)


def remove_signature(text: Column) -> Column:
    """Cut at the first signature marker of each kind, one kind after the other."""
    for marker in SIGNATURE_MARKERS:
        text = F.substring_index(text, marker, 1)
    return text


def remove_quoted_lines(text: Column) -> Column:
    """Drop lines whose first character after blanks is ``>`` or ``|``.

    Later lines go with the line break before them, a quoted first line with the one after it,
    which equals splitting into lines, filtering and joining again.
    """
    text = _replace(text, rf"\n[{BLANKS_IN_LINE}]*+[>|][^\n]*+")
    return _replace(text, rf"\A[{BLANKS_IN_LINE}]*+[>|][^\n]*+\n?")


def remove_emails(text: Column) -> Column:
    # An address starts at the start of a run of name characters, or where the last one ended.
    name = rf"[{WORD}.\-+]"
    return _replace(text, rf"(?:\G|(?<!{name})){name}++@[{WORD}.\-]+\.[{WORD}]++")


def remove_tags(text: Column) -> Column:
    """Drop ``<...>`` with at least one character inside, also across lines.

    The second branch takes an unclosed ``<`` to the end of the text and puts it back, so that
    the tail is read once rather than once per ``<``.
    """
    return _replace(text, r"<[^>]++>|(<[^>]++\z)", "$1")


def remove_urls(text: Column) -> Column:
    rest = rf"[^{BLANKS}]++"
    return _replace(text, rf"(?=[hfw])(?:https?://|ftp://|www\.){rest}")


def remove_non_ascii(text: Column) -> Column:
    return _replace(text, r"[^\x00-\x7F]++")


def collapse_newlines(text: Column) -> Column:
    """Three or more newlines become two."""
    return _replace(text, r"\n{3,}+", "\n\n")


def strip_line_ends(text: Column) -> Column:
    """Lines lose trailing blanks, then the text those at both ends; expects ASCII text."""
    blank = f"[{ASCII_BLANKS_IN_LINE}]"
    text = _replace(text, rf"{blank}(?<!{blank}{blank}){blank}*+(?=\n|\z)")
    return F.btrim(text, F.lit(ASCII_BLANK_CHARACTERS))


def normalize_whitespace(text: Column) -> Column:
    """Collapse newlines first, so that lines of blanks are not collapsed."""
    return strip_line_ends(collapse_newlines(text))


# Fixed order: later rules see the output of earlier ones.
CLEANING_RULES = [
    strip_headers,
    remove_signature,
    remove_quoted_lines,
    remove_emails,
    remove_tags,
    remove_urls,
    remove_non_ascii,
    normalize_whitespace,
]

# Texts without any of these strings are left as they are by the rule, so a byte search spares them
# the regular expression.
NEEDED_STRINGS = {
    strip_headers: [HEADER_END],
    remove_signature: SIGNATURE_MARKERS,
    remove_quoted_lines: [">", "|"],
    remove_emails: ["@"],
    remove_tags: ["<"],
    remove_urls: ["http", "ftp://", "www."],
    collapse_newlines: ["\n\n\n"],
}


def _may_change(rule: Callable[[Column], Column], text: Column) -> Column | None:
    if rule is remove_non_ascii:
        return F.octet_length(text) > F.length(text)
    if rule in NEEDED_STRINGS:
        return reduce(Column.__or__, [F.contains(text, F.lit(s)) for s in NEEDED_STRINGS[rule]])
    return None


def add_cleaned_text(df: DataFrame, text: str = "text", cleaned: str = "cleaned_text") -> DataFrame:
    """Add the cleaned text, rule by rule in columns of their own, each rule only where it can matter.

    Same result as ``clean_text``. A rule names its input several times, so Spark keeps one
    projection per rule and computes every step once.
    """
    df = df.withColumn(cleaned, F.col(text))
    for rule in [*CLEANING_RULES[:-1], collapse_newlines, strip_line_ends]:
        column = F.col(cleaned)
        needed = _may_change(rule, column)
        changed = rule(column)
        df = df.withColumn(cleaned, changed if needed is None else F.when(needed, changed).otherwise(column))
    return df


def clean_text(text: Column) -> Column:
    """The whole cleaning chain as one column expression."""
    for rule in CLEANING_RULES:
        text = rule(text)
    return text


def strip_blanks(text: Column) -> Column:
    """Trim every Unicode blank from both ends."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def _count_if_any(text: Column, pattern: str, possible: Column) -> Column:
    """Matches of a pattern, 0 without looking where none is possible."""
    return F.when(possible, F.regexp_count(text, F.lit(pattern))).when(text.isNotNull(), F.lit(0))


def quoted_line_count(text: Column) -> Column:
    """Lines that start with ``>`` after blanks (the profile does not count ``|``)."""
    return _count_if_any(text, rf"(?:\A|\n)[{BLANKS_IN_LINE}]*+>", F.contains(text, F.lit(">")))


def has_signature(text: Column) -> Column:
    found = F.lit(False)
    for marker in SIGNATURE_MARKERS:
        found = found | F.contains(text, F.lit(marker))
    return found


def non_ascii_count(text: Column) -> Column:
    n = F.length(text) - F.length(remove_non_ascii(text))
    return F.when(F.octet_length(text) > F.length(text), n).when(text.isNotNull(), F.lit(0))


def newsgroup_count(text: Column) -> Column:
    """Comma-separated parts of the ``Newsgroups:`` header, 1 when there is no such header."""
    groups = F.regexp_extract(header_part(text), rf"Newsgroups:[{BLANKS}]*([^\n]+)", 1)
    return F.when(groups != "", F.length(groups) - F.length(F.replace(groups, F.lit(","), F.lit(""))) + 1).otherwise(
        F.when(text.isNotNull(), F.lit(1))
    )


def has_html_tag(text: Column) -> Column:
    """Whether ``<letter ... >`` occurs: an opening before the last ``>`` of the text."""
    tail = F.substring_index(text, ">", -1)
    return F.substring(text, F.lit(1), F.length(text) - F.length(tail)).rlike(r"<[a-zA-Z]")


def has_mime_header(text: Column) -> Column:
    return F.contains(text, F.lit("Content-Type:")) | F.contains(text, F.lit("MIME-Version:"))


def mentions_base64(text: Column) -> Column:
    return F.contains(F.lower(text), F.lit("base64"))


def email_count(text: Column) -> Column:
    """Loose e-mail count of the profile: no dot needed after the ``@``."""
    name = rf"[{WORD}.\-]"
    return _count_if_any(text, rf"(?:\G|(?<!{name})){name}++@{name}++", F.contains(text, F.lit("@")))


def text_digest(text: Column) -> Column:
    """32-byte key of a text for grouping, so that shuffles and sorts do not compare whole texts."""
    return F.unhex(F.sha2(text, 256))
