"""Column references and header normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: header rewrite rules, applied in this order ---------------
# Rules "basic": used for provider info, MDS and claims files.
HEADER_RULES_BASIC: tuple[tuple[str, str], ...] = (
    (" ", "_"),
    ("-", "_"),
    ("(", ""),
    (")", ""),
)
# Rules "extended": used for facility performance and skilled nursing files.
# (A " -- " rule would never fire after spaces are replaced, so it is left
# out; "A -- B" becomes "A____B" either way.)
HEADER_RULES_EXTENDED: tuple[tuple[str, str], ...] = (
    (" ", "_"),
    ("-", "_"),
    ("(", ""),
    (")", ""),
    (":_", "_"),
)
# -----------------------------------------------------------------------------

HEADER_RULES = {"basic": HEADER_RULES_BASIC, "extended": HEADER_RULES_EXTENDED}


def quote(name: str) -> str:
    """Back-tick a column name so dots, slashes and spaces are literal."""
    return "`" + name.replace("`", "``") + "`"


def col_of(c) -> Column:
    """Accept a Column or a raw column name (taken literally)."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def normalize_header(name: str, rules: str | Sequence[tuple[str, str]] = "basic") -> str:
    """Apply the ordered replacement rules to one header."""
    steps = HEADER_RULES[rules] if isinstance(rules, str) else rules
    for old, new in steps:
        name = name.replace(old, new)
    return name


def normalized_headers(
    names: Iterable[str], rules: str | Sequence[tuple[str, str]] = "basic"
) -> list[str]:
    """Normalise all headers; refuse when two of them end up equal.

    Column resolution is case-insensitive, so a collision is checked on the
    lower-cased result.
    """
    names = list(names)
    out = [normalize_header(n, rules) for n in names]
    seen: dict[str, str] = {}
    for src, dst in zip(names, out):
        key = dst.lower()
        if key in seen:
            raise ValueError(
                f"headers {seen[key]!r} and {src!r} both normalise to {dst!r}"
            )
        seen[key] = src
    return out
