"""Configuration keys and values, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sections whose keys keep their dots, and the key that is always a list.
OPEN_SECTIONS = ("transport.properties.", "transport.urlParams.", "transport.headers.")
LIST_KEY = "facets.disabled"


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but whitespace of any kind."""
    return F.coalesce(~value.rlike(r"\P{javaWhitespace}"), F.lit(True))


def setting_path(key: Column) -> Column:
    """Dotted key as a path; below an open section the rest of the key is one leaf."""
    dotted = F.split(F.regexp_replace(key, r"\.+\z", ""), r"\.")

    def below(otherwise: Column, section: str) -> Column:
        parents = [F.lit(part) for part in section.rstrip(".").split(".")]
        rest = F.substring(key, len(section) + 1, 2**31 - 1)
        return F.when(key.startswith(section), F.array(*parents, rest)).otherwise(otherwise)

    return reduce(below, OPEN_SECTIONS, dotted)


def is_list_text(value: Column) -> Column:
    return value.startswith("[") & value.endswith("]") & value.contains(";")


def list_items(key: Column, value: Column) -> Column:
    """Items of a list value, null for a plain one; brackets go only where the value is list text."""
    bare = F.when(is_list_text(value), F.substr(value, F.lit(2), F.length(value) - 2)).when(
        key == LIST_KEY, value
    )
    return F.filter(F.split(bare, ";"), lambda item: ~is_blank(item))
