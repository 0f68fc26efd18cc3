"""Projection helpers over change-log maps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_fields(m: str, keys: Iterable[str], prefix: str = "") -> list[Column]:
    """``m['k'] AS k`` for each key; a missing key reads as null."""
    col = F.col(m)
    return [col.getItem(k).alias(prefix + k) for k in keys]


def as_bigint(x) -> Column:
    """text -> BIGINT, null on bad text (an ANSI ``cast`` would raise)."""
    return _c(x).try_cast("bigint")


def as_decimal(x, precision: int = 16, scale: int = 2) -> Column:
    """text -> DECIMAL(p, s), null on bad text."""
    return _c(x).try_cast(f"decimal({precision},{scale})")


def decimal_product_text(a, b, precision: int = 16, scale: int = 2) -> Column:
    """``string(decimal(a) * decimal(b))`` -- e.g. '12.5' x '3' -> '37.5000'."""
    return (as_decimal(a, precision, scale) * as_decimal(b, precision, scale)).cast("string")


def delta_text(new, old) -> Column:
    """F5 body: ``string(bigint(new) - bigint(old))``."""
    return (as_bigint(new) - as_bigint(old)).cast("string")


def whitelist(m, columns) -> Column:
    """F8: keep only the map keys named in the comma list ``columns``.

    ``columns`` is a column (or column name) holding the per-row config list;
    pass ``F.lit('id,name')`` for a fixed list.  The list is split on ','
    without trimming, as configured.
    """
    names = F.split(_c(columns), ",")
    return F.map_filter(_c(m), lambda k, v: F.array_contains(names, k))


# What stands between packed columns, and what escapes it (and itself) inside them.
_BETWEEN, _ESCAPE = "\x01", "\x02"


def pack(*columns: str) -> Column:
    """Columns as one text (:func:`unpack` gives them back): a row of many short texts takes a fifth less in a shuffle."""
    def escaped(c):
        c = F.replace(F.col(c).cast("string"), F.lit(_ESCAPE), F.lit(_ESCAPE + "2"))
        return F.coalesce(F.replace(c, F.lit(_BETWEEN), F.lit(_ESCAPE + "1")), F.lit(_ESCAPE + "0"))
    return F.concat_ws(_BETWEEN, *[escaped(c) for c in columns])


def unpack(packed: str, *columns: str) -> list[Column]:
    """The columns of :func:`pack`, as texts; nulls stay."""
    parts = F.split(F.col(packed), _BETWEEN, -1)
    def plain(c):
        whole = F.replace(F.replace(c, F.lit(_ESCAPE + "1"), F.lit(_BETWEEN)), F.lit(_ESCAPE + "2"), F.lit(_ESCAPE))
        return F.when(c != _ESCAPE + "0", whole)
    return [plain(parts[i]).alias(c) for i, c in enumerate(columns)]
