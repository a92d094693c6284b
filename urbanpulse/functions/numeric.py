"""Number parsing rules (P6 lenient, P7 strict).

Both are a regex guard in front of ``try_cast``, so text that Spark's cast
would otherwise accept but the source rule rejects (``1d``, ``0x1p3``) is
null, and nothing raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .strings import clean_str, strip_ws

# Lenient: optional sign, digits with optional fraction (or a bare fraction),
# optional exponent.  Commas are removed before the test.
LENIENT_NUMBER = r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"
# Strict: optional minus, digits, optional fraction.
STRICT_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
# Numbers that need no trimming, the usual case: what both rules would make of
# them is the text without its commas.
PLAIN_LENIENT = r"^[+-]?[0-9][0-9,]*(?:\.[0-9]+)?$"
PLAIN_STRICT = r"^-?[0-9][0-9,]*(?:\.[0-9]+)?$"
_NONFINITE = r"(?i)^[+-]?(nan|inf|infinity)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_lenient(c, keep_nan: bool = False) -> Column:
    """Drop thousands separators, trim, parse as double; null when unparsable
    (whitespace left between separators is trimmed too, as float() does)."""
    plain = F.replace(_col(c), F.lit(","), F.lit(""))
    s = strip_ws(plain)
    out = (F.when(_col(c).rlike(PLAIN_LENIENT), plain.try_cast("double"))
           .when(s.rlike(LENIENT_NUMBER), s.try_cast("double")))
    if keep_nan:
        out = F.when(s.rlike(_NONFINITE), s.try_cast("double")).otherwise(out)
    return out


def parse_strict(c) -> Column:
    """Without commas, byte order marks and surrounding blanks: a number if it
    is ``-?digits(.digits)?``, else null (so also ``-``, ``N/A`` and the like)."""
    return strict_text(c).try_cast("double")


def strict_text(c) -> Column:
    """The text of a number that ``parse_strict`` reads, without commas, byte
    order marks and surrounding blanks; null for any other."""
    text = _col(c).cast("string")
    s = F.replace(clean_str(text), F.lit(","), F.lit(""))
    return (F.when(text.rlike(PLAIN_STRICT), F.replace(text, F.lit(","), F.lit("")))
            .when(s.rlike(STRICT_NUMBER), s))
