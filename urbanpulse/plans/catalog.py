"""Query registry: name -> (spark, sf_dir) -> DataFrame, and the DuckDB oracle
SQL for every query SQL can express.  Names follow SURVEY §7.3."""

from __future__ import annotations

from . import arrivals as AR
from . import city as CT
from . import enrichment as EN
from . import expressions as X
from . import landing as L
from . import oracle_arrivals as OA
from . import oracle_enrichment as OE
from . import oracle_landing as OL
from . import oracle_expressions as OX
from . import oracle_structured as OS
from . import structured as S
from . import textual as T
from . import oracle_textual as OT

QUERIES = {
    "sgi_index": S.sgi,
    "ind_price": S.ind_price,
    "ind_rent": S.ind_rent,
    "ind_sales": S.ind_sales,
    "ind_youth_inflow": S.ind_youth_inflow,
    "ind_senior_outflow": S.ind_senior_outflow,
    "string_clean": X.string_clean,
    "number_lenient": X.number_lenient,
    "number_strict": X.number_strict,
    "numeric_by_list": X.numeric_by_list,
    "numeric_by_name": X.numeric_by_name,
    "mini_projection": X.mini_projection,
    "filter_any_column": X.filter_any_column,
    "filter_code_set": X.filter_code_set,
    "filter_optional_column": X.filter_optional_column,
    "filter_period": X.filter_period,
    "filter_month_end": X.filter_month_end,
    "valid_period": X.valid_period,
    "dedup_rows": X.dedup_rows,
    "band_rename": X.band_rename,
    "band_unpivot": X.band_unpivot,
    "csv_landing_scan": L.csv_landing_scan,
    "csv_subset_by_name": L.csv_subset_by_name,
    "csv_multi_year": L.csv_multi_year,
    "json_pages_inline": L.json_pages_inline,
    "parquet_multi_union": L.parquet_multi_union,
    "external_text_table": L.external_text_table,
    "parquet_sink_roundtrip": L.parquet_sink_roundtrip,
    "region_partitioned_sink": L.region_partitioned_sink,
    "profile_table": L.profile_table,
    "sample_rows": L.sample_rows,
    "header_normalise": L.header_normalise,
    "rename_map": L.rename_map,
    "processed_deals": L.processed_deals,
    "processed_rent": L.processed_rent,
    "processed_sales": L.processed_sales,
    "processed_population": L.processed_population,
    "load_counts": L.load_counts,
    "text_clean_filter": T.text_clean_filter,
    "sentiment_monthly": T.sentiment_monthly,
    "keywords_tfidf": T.keywords_tfidf,
    "keywords_region_month": T.keywords_region_month,
    "topics": T.topics,
    "topic_shares": T.topic_shares,
    "embedding_centroid_cosine": T.embedding_centroid_cosine,
    "ugi_index": T.ugi_index,
    "gpi_index": T.gpi_index,
    "region_standardise": T.region_standardise,
    "zscore": T.zscore_query,
    "minmax_100": T.minmax_query,
    "period_change": T.period_change_query,
    "city_indicators": CT.city_indicators,
    "month_ends": CT.month_ends,
    "page_reconciliation": AR.page_reconciliation,
    "csv_hostile_records": AR.csv_hostile_records,
    "csv_reject_table": AR.csv_reject_table,
    "csv_header_drift": AR.csv_header_drift,
    "youth_inflow_bands": AR.youth_inflow_bands,
    "daily_run_index": AR.daily_run_index,
    "indicators_incremental": AR.indicators_incremental,
    "region_apportion": EN.region_apportion,
    "calendar_spine": EN.calendar_spine_query,
    "lexicon_induced": EN.lexicon_induced,
    "sentiment_induced": EN.sentiment_induced,
    "phrases_region_month": EN.phrases_region_month,
    "embedding_drift": EN.embedding_drift,
}

ORACLE_SQL = {
    "sgi_index": OS.SGI,
    "ind_price": OS.IND_PRICE,
    "ind_rent": OS.IND_RENT,
    "ind_sales": OS.IND_SALES,
    "ind_youth_inflow": OS.IND_YOUTH,
    "ind_senior_outflow": OS.IND_SENIOR,
    "string_clean": OX.STRING_CLEAN,
    "number_lenient": OX.NUMBER_LENIENT,
    "number_strict": OX.NUMBER_STRICT,
    "numeric_by_list": OX.NUMERIC_BY_LIST,
    "numeric_by_name": OX.NUMERIC_BY_NAME,
    "mini_projection": OX.MINI_PROJECTION,
    "filter_any_column": OX.FILTER_ANY_COLUMN,
    "filter_code_set": OX.FILTER_CODE_SET,
    "filter_optional_column": OX.FILTER_OPTIONAL_COLUMN,
    "filter_period": OX.FILTER_PERIOD,
    "filter_month_end": OX.FILTER_MONTH_END,
    "valid_period": OX.VALID_PERIOD,
    "dedup_rows": OX.DEDUP_ROWS,
    "band_rename": OX.BAND_RENAME,
    "band_unpivot": OX.BAND_UNPIVOT,
    "csv_landing_scan": OL.CSV_LANDING_SCAN,
    "csv_subset_by_name": OL.CSV_SUBSET_BY_NAME,
    "csv_multi_year": OL.CSV_MULTI_YEAR,
    "json_pages_inline": OL.JSON_PAGES_INLINE,
    "parquet_multi_union": OL.PARQUET_MULTI_UNION,
    "external_text_table": OL.EXTERNAL_TEXT_TABLE,
    "parquet_sink_roundtrip": OL.PARQUET_SINK_ROUNDTRIP,
    "region_partitioned_sink": OL.REGION_PARTITIONED_SINK,
    "profile_table": OL.PROFILE_TABLE,
    "sample_rows": OL.SAMPLE_ROWS,
    "header_normalise": OL.HEADER_NORMALISE,
    "rename_map": OL.RENAME_MAP,
    "processed_deals": OL.PROCESSED_DEALS,
    "processed_rent": OL.PROCESSED_RENT,
    "processed_sales": OL.PROCESSED_SALES,
    "processed_population": OL.PROCESSED_POPULATION,
    "load_counts": OL.LOAD_COUNTS,
    "text_clean_filter": OT.TEXT_CLEAN_FILTER,
    "sentiment_monthly": OT.SENTIMENT_MONTHLY,
    "keywords_tfidf": OT.KEYWORDS_TFIDF,
    "keywords_region_month": OT.KEYWORDS_REGION_MONTH,
    "topics": OT.TOPIC_SQL,
    "topic_shares": OT.TOPIC_SHARES_SQL,
    "embedding_centroid_cosine": OT.EMBEDDING_CENTROID_COSINE,
    "ugi_index": OT.UGI_INDEX,
    "gpi_index": OT.GPI_INDEX,
    "region_standardise": OT.REGION_STANDARDISE,
    "zscore": OT.ZSCORE,
    "minmax_100": OT.MINMAX_100,
    "period_change": OT.PERIOD_CHANGE,
    "city_indicators": CT.CITY_INDICATORS_SQL,
    "month_ends": CT.MONTH_ENDS_SQL,
    "page_reconciliation": OA.PAGE_RECONCILIATION,
    "csv_hostile_records": OA.CSV_HOSTILE_RECORDS,
    "csv_reject_table": OA.CSV_REJECT_TABLE,
    "csv_header_drift": OA.CSV_HEADER_DRIFT,
    "youth_inflow_bands": OA.YOUTH_INFLOW_BANDS,
    "daily_run_index": OA.DAILY_RUN_INDEX,
    "indicators_incremental": OA.INDICATORS_INCREMENTAL,
    "region_apportion": OE.REGION_APPORTION,
    "calendar_spine": OE.CALENDAR_SPINE,
    "lexicon_induced": OE.LEXICON_INDUCED,
    "sentiment_induced": OE.SENTIMENT_INDUCED,
    "phrases_region_month": OE.PHRASES_REGION_MONTH,
    "embedding_drift": OE.EMBEDDING_DRIFT,
}
