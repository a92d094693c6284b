"""Inspect processed Parquet (S7, S8, U1, S14, A1, L1) from the command line:

    python -m urbanpulse.sources.inspect <path> [--rows 20]

Every readable sub-folder of <path> (or <path> itself) is loaded, unreadable
ones are reported and left out, the rest are unioned; then the schema, the
per-column profile (type, nulls, rows) and a row sample are printed.
"""

from __future__ import annotations

import argparse
import sys

from .parquet import read_parquet_folders
from .sinks import profile, sample_rows


def main(argv: list[str] | None = None) -> int:
    from ..session import get_session

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("path")
    ap.add_argument("--rows", type=int, default=20)
    a = ap.parse_args(argv)
    spark = get_session(app="urbanpulse-inspect")
    try:
        df, failed = read_parquet_folders(spark, root=a.path)
    except ValueError as e:
        print(f"no readable parquet data: {e}", file=sys.stderr)
        return 1
    for folder, err in failed.items():
        print(f"FAILED: {folder}: {err}")
    print(df.schema.treeString())
    for r in profile(df).collect():   # one row per column
        print(f"{r['column_name']}\t{r['data_type']}\tnulls={r['null_count']}\trows={r['row_count']}")
    for r in sample_rows(df, a.rows).collect():   # bounded sample
        print(r)
    return 0


if __name__ == "__main__":
    sys.exit(main())
