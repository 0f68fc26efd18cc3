"""Delimited text -> typed records (P5); bad rows are dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def parse_delimited(lines: DataFrame, names: list[str], types: dict[str, str] | None = None,
                    value: str = "value", sep: str = ",") -> DataFrame:
    """Split each line on ``sep``; keep lines with at least ``len(names)``
    fields whose typed fields all convert (``try_cast``, no ANSI errors)."""
    types = types or {}
    parts = F.split(F.col(value), sep)
    fields = [F.try_element_at(parts, F.lit(i + 1)) for i in range(len(names))]
    typed = [f.try_cast(types[n]) if n in types else f for f, n in zip(fields, names)]
    out = lines.select(*[c.alias(n) for c, n in zip(typed, names)],
                       (F.size(parts) >= len(names)).alias("__wide"))
    ok = reduce(lambda a, b: a & b,
                [F.col("__wide")] + [F.col(n).isNotNull() for n in names if n in types])
    return out.filter(ok).drop("__wide")
