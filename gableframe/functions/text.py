"""Text keys: normalised city and metro names, mapped values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that Java's \s leaves out.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
# A run that would change: two spaces, or white space that is no space.
_UNEVEN = r"(?U)  |[\s\x1c-\x1f&&[^ ]]"


def normalize_city(value: Column) -> Column:
    """Lower case, en/em dash to hyphen, white-space runs to one space, ends trimmed.

    Dashes go first, as lowering plain ASCII is far cheaper. Only texts with
    uneven white space are rewritten, and trimmed again, as other white space at
    an end has become a space. Null stays null.
    """
    text = value.cast("string")
    for dash in "–—":
        text = F.replace(text, F.lit(dash), F.lit("-"))
    text = F.trim(F.lower(text))
    collapsed = F.trim(F.regexp_replace(text, _SPACES, " "))
    return F.when(text.rlike(_UNEVEN), collapsed).otherwise(text)


def normalize_metro(value: Column) -> Column:
    """City form of the text before the first comma (not trimmed again)."""
    return F.substring_index(normalize_city(value), ",", 1)


def replace_mapped(value: Column, mapping: dict[str, str]) -> Column:
    """Whole-value replacement in one pass; both sides of the mapping are
    normalised by Spark, unmapped values are kept."""
    if not mapping:
        return value
    pairs = [normalize_city(F.lit(side)) for pair in mapping.items() for side in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), value), value)
