"""String cleaning (P5, X8, X9) and header normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BOM = "\ufeff"
# Edge whitespace: Java's \s set plus no-break and ideographic spaces
# (Spark's trim() alone strips only ' ').  btrim over a character set needs
# no regex engine.
EDGE_WS_CHARS = " \t\n\u000b\f\r\u00a0\u3000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    return F.btrim(_col(c), F.lit(EDGE_WS_CHARS))


def clean_str(c) -> Column:
    """null -> '', BOM removed (anywhere), surrounding whitespace removed."""
    return strip_ws(F.replace(F.coalesce(_col(c).cast("string"), F.lit("")), F.lit(BOM), F.lit("")))


def join_list(c, sep: str = ",") -> Column:
    """Join an array column's elements (as text) with ``sep``."""
    return F.array_join(F.transform(_col(c), lambda x: x.cast("string")), sep)


_NOT_IN_NAMES = str.maketrans("", "", BOM + '"')


def normalize_header(h: str | None) -> str:
    """Header cell -> column name: byte order marks and double quotes deleted,
    surrounding blanks stripped; null is empty.

    Operates on schema metadata (column names) on the driver, never on data.
    """
    return (h or "").translate(_NOT_IN_NAMES).strip()
