"""Text standardisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.regex import java_regex

#: White space that has to change: two or more in a row, or one that is no plain space.
_WS = java_regex(r"\s{2,}|[^\S ]")
#: What a text must hold for that to occur: two spaces, or a character that is neither printable ASCII nor Latin-1. Cheap to test.
_SUSPECT = r"  |[^ -~\xA1-\xFF]"


def collapse_ws(c: Column) -> Column:
    """Collapse every run of (Unicode) whitespace to one space and trim: ``'  a\\n b '`` -> ``'a b'``. Plain text is only tested, by two
    character ranges; ``c`` is read three times, so it should be a column."""
    return F.trim(F.when(c.rlike(_SUSPECT), F.regexp_replace(c, _WS, " ")).otherwise(c))


def clean_log_text(c: Column, max_chars: int = 300) -> Column:
    """Error-log description: newlines to spaces, trimmed, capped to ``max_chars`` characters."""
    stripped = F.regexp_replace(F.regexp_replace(c, "\n", " "), java_regex(r"^\s+|\s+$"), "")
    return F.substring(stripped, 1, max_chars)
