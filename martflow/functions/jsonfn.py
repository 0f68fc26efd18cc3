"""JSON tests and serialisation.

All JVM-side expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_json_object(value) -> Column:
    """True iff the text is a JSON *object*.

    ``json_object_keys`` yields null for invalid JSON, the empty string and
    every non-object value (arrays, scalars, ``null``), and never builds the
    parsed document; a SQL null input gives false.
    """
    return F.coalesce(F.json_object_keys(_c(value)).isNotNull(), F.lit(False))


def drop_null_values(m) -> Column:
    """Remove null-valued entries from a map (serialisers omit null fields)."""
    return F.map_filter(_c(m), lambda k, v: v.isNotNull())


def to_json_text(*cols, drop_nulls: bool = True) -> Column:
    """Serialise columns as one JSON object.

    Struct fields that are null are omitted by ``to_json``; map columns are
    filtered first so that null map values are omitted as well.
    """
    parts = []
    for c in cols:
        if isinstance(c, str):
            parts.append(F.col(c).alias(c.split(".")[-1]))
        else:
            parts.append(c)
    return F.to_json(F.struct(*parts), {"ignoreNullFields": str(drop_nulls).lower()})


def map_json(m) -> Column:
    """Map column -> JSON object text without null entries (null map -> null)."""
    return F.to_json(drop_null_values(m))
