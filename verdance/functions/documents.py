"""JSON documents and nested access with defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_document(*columns: Column | str) -> Column:
    """One JSON object; NULL fields are left out, map keys become strings."""
    return F.to_json(F.struct(*columns))


def from_document(text: Column, schema) -> Column:
    return F.from_json(text, schema)


def get_path(root: Column, path: str, default=None) -> Column:
    """Nested field by dotted path, or the default where any step is missing."""
    value = root
    for part in path.split("."):
        value = value.getField(part)
    return value if default is None else F.coalesce(value, F.lit(default))
