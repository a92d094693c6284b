"""Scans and sinks: delimited text (S1-S5), JSON pages (S6), Parquet (S7,
S8, S10), catalog tables (S9, S13), CSV / partitioned sinks and profiles
(S11, S12, S14)."""
