"""Column-expression builders (all JVM-side, codegen-friendly; no Python UDFs)."""

from .numeric import parse_lenient, parse_strict, LENIENT_NUMBER, STRICT_NUMBER  # noqa: F401
from .periods import (extract_year, extract_month, code_year, code_month,  # noqa: F401
                      code_quarter, month_end_yyyymmdd, period_key, quarter_of_month)
from .strings import clean_str, join_list, strip_ws, normalize_header  # noqa: F401
