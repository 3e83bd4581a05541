"""Text scalars for generated responses."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jsonx import _c, let, strict_json, ustrip

# Fence patterns of the response parser.
FENCE_OPEN = "^```[a-zA-Z]*\\n?"
FENCE_CLOSE = "\\n?```$"


def drop_fence(s: Column) -> Column:
    """The second half of :func:`strip_fence`, for text that is trimmed."""
    inner = ustrip(F.regexp_replace(F.regexp_replace(s, FENCE_OPEN, ""), FENCE_CLOSE, ""))
    return F.when(s.startswith("```"), inner).otherwise(s)


def strip_fence(c) -> Column:
    """Trim; if the text starts with a code fence, drop the opening fence (with
    its language tag and one newline) and the closing fence; trim again (G2)."""
    return let(ustrip(_c(c)), drop_fence)


def json_span(s: Column) -> Column:
    """First ``[`` to last ``]``, else first ``{`` to last ``}``, else NULL. Both
    ends are found by position, so the time is linear in the text."""

    def span(opening: str, closing: str) -> Column:
        start = F.instr(s, opening)
        end = F.length(s) - F.length(F.substring_index(s, closing, -1))  # 0 if there is none
        return F.when((start > 0) & (end > start), F.substring(s, start, end - start + 1))

    return F.coalesce(span("[", "]"), span("{", "}"))


def extract_json_text(c) -> Column:
    """The JSON part of a response.

    The whole de-fenced text when it parses; else the widest ``[...]`` span
    (first ``[`` to last ``]``); else the widest ``{...}`` span; else the text.
    Arrays are tried first, so prose around ``{"a":[1]}`` yields ``[1]``.
    The de-fenced text is computed once per row (``let``).
    """
    return let(strip_fence(c), lambda s: F.when(strict_json(s).isNotNull(), s).otherwise(F.coalesce(json_span(s), s)))


def parse_json_text(c) -> Column:
    """The parsed JSON value of a response, or NULL: the de-fenced text when it
    parses, else the array span, else the object span (the value of
    ``strict_json(extract_json_text(c))``, parsing each candidate at most once).
    """
    return let(strip_fence(c), lambda s: F.coalesce(strict_json(s), let(json_span(s), strict_json)))
