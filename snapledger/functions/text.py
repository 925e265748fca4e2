"""Text expressions and column-name conventions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Unicode White_Space characters. `trim(c, chars)` walks in from both ends
# and stops at the first other character, which no backtracking regex does.
WHITE_SPACE = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def strip_text(c: Column) -> Column:
    """Remove all Unicode white space at both ends (plain ``trim`` leaves tabs)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def extract_or_null(c: Column, pattern: str) -> Column:
    """First capture group of ``pattern``, null when nothing matches.

    ``(?U)`` makes the character classes Unicode-aware and ``(?d)`` leaves the
    newline as the only line end, so ``.`` excludes nothing else.
    """
    return F.nullif(F.regexp_extract(c.cast("string"), "(?Ud)" + pattern, 1), F.lit(""))


def title_name(name: str) -> str:
    """``PI_FROM_SPRINT`` -> ``Pi From Sprint``."""
    return name.lower().replace("_", " ").title()


def snake_name(name: str) -> str:
    """``Pi From Sprint`` -> ``PI_FROM_SPRINT``."""
    return name.upper().replace(" ", "_")


def parse_column(spec: str) -> tuple[str, str]:
    """``"A -> B"`` names source and output; a bare name keeps its name."""
    source, _, output = (part.strip() for part in spec.partition("->"))
    return source, output or source
