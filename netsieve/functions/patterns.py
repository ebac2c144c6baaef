"""Attack-pattern counters over decoded request text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .text import as_text


def java_regex(pattern: str) -> str:
    """Unicode-aware, case-blind form; Java's ``\\s`` lacks the four separator control codes."""
    return "(?iU)" + pattern.replace(r"\s", r"[\s\x1c-\x1f]")


def count_text(text: Column, needle: str) -> Column:
    """Occurrences of a single character: a byte search, no regular expression."""
    return F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))


def count_matches(text: Column, pattern: str, needs: tuple[str, ...] = ()) -> Column:
    """Non-overlapping matches. ``needs``: the text can match only if it holds one of these."""
    hits = F.regexp_count(text, F.lit(java_regex(pattern)))
    possible = text != ""
    if needs:
        possible = F.contains(text, F.lit(needs[0]))
        for needle in needs[1:]:
            possible = possible | F.contains(text, F.lit(needle))
    return F.when(possible, hits).otherwise(F.lit(0))


def sql_keywords(text: Column) -> Column:
    return count_matches(text, fixed.SQL_KEYWORD_PATTERN)


def sql_tautologies(text: Column) -> Column:
    return count_matches(text, fixed.SQL_TAUTOLOGY_PATTERN, ("=",))


def sql_comments(text: Column) -> Column:
    return count_matches(text, fixed.SQL_COMMENT_PATTERN, ("--", "#", "*", ";"))


def sql_encoded_meta(text: Column) -> Column:
    return count_matches(F.lower(text), fixed.SQL_ENCODED_META_PATTERN, ("%", "*/"))


def xss_keywords(text: Column) -> Column:
    return count_matches(text, fixed.XSS_KEYWORD_PATTERN, ("<", ":", "(", "."))


def xss_event_handlers(text: Column) -> Column:
    return count_matches(text, fixed.XSS_EVENT_HANDLER_PATTERN, ("=",))


def xss_script_tags(text: Column) -> Column:
    return count_matches(F.lower(text), fixed.XSS_SCRIPT_TAG_PATTERN, ("<", "%"))


def special_characters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, fixed.PLAIN_URI_CHARACTERS, ""))


def is_suspicious(uri: Column) -> Column:
    """Any attack pattern occurs in the URI as received, before decoding."""
    raw = as_text(uri)
    found = F.lit(False)
    for pattern in (
        fixed.SQL_COMMENT_PATTERN,
        fixed.SQL_ENCODED_META_PATTERN,
        fixed.XSS_EVENT_HANDLER_PATTERN,
        fixed.XSS_KEYWORD_PATTERN,
        fixed.SQL_TAUTOLOGY_PATTERN,
        fixed.SQL_KEYWORD_PATTERN,
    ):
        found = found | raw.rlike(java_regex(pattern))
    return (raw != "") & found
