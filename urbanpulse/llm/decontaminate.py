"""Benchmark decontamination with a positional inverted index.

The index stores, for the rare terms of the benchmark's windows, every place in
the corpus where the term stands (term, row, position, and the words around it
that a window may need).  A window's matches are found by intersecting the
lists of its two rarest terms after subtracting their offsets; the stored words
verify the whole phrase.  Proximity matches intersect an item's rarest terms
within a span.  All steps are DataFrame functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse.llm.common import table
from urbanpulse.session import stage_table

WINDOW = 13
#: Terms broadcast at once; more terms are looked up in several blocks.
BLOCK_TERMS = 100_000

# ASCII letters become lower case, other ASCII but digits a blank
_OTHERS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_FROM = string.ascii_uppercase + _OTHERS
_TO = string.ascii_lowercase + " " * len(_OTHERS)


def words(text: Column) -> Column:
    """Words of ASCII letters (as lower case), digits and any other non-ASCII
    characters; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO), " "), "")


def tokenised(docs: DataFrame) -> DataFrame:
    """Stored words of every row: row (a number of its own), doc_id, n_words,
    words.  Only doc_id and text are read."""
    return stage_table(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
                       .withColumn("n_words", F.size("words").cast("long")), "words")


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, phrase (the window's words, blank between) of every window; an
    item of fewer words is one window, one without words has none."""
    w = F.col("words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1)))
    return (items.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
            .select("item_id", "words", F.explode(starts).alias("at"))
            .select("item_id", F.array_join(F.slice("words", F.col("at"), F.lit(size)), " ").alias("phrase")))


def _found_terms(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """Places of ``terms`` in the corpus: row, pos, words, and the terms'
    columns.  The terms are broadcast in blocks of a bounded size."""
    blocks = -(-terms.count() // BLOCK_TERMS) or 1
    places = corpus.select("row", "words", F.posexplode("words").alias("pos", "term"))
    out = None
    for b in range(blocks):
        block = terms if blocks == 1 else terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b)
        got = places.join(F.broadcast(block), "term")
        out = got if out is None else out.unionByName(got)
    return out


def rare_terms(corpus: DataFrame, phrases: DataFrame, keep: int) -> DataFrame:
    """phrase, rare: its ``keep`` rarest places (count in the corpus, offset,
    term), rarest first.  Phrases with a term that the corpus lacks are left
    out: they can't occur."""
    places = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    vocabulary = stage_table(places.select("term").distinct(), "vocabulary")
    count = _found_terms(corpus, vocabulary).groupBy("term").agg(F.count("*").alias("count"))
    return (places.join(count, "term", "left").groupBy("phrase")
            .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "term")))
                 .alias("rare"))
            .filter(F.get("rare", F.lit(0))["count"] > 0).select("phrase", F.slice("rare", 1, keep).alias("rare")))


def build_index(corpus: DataFrame, anchors: DataFrame, extra_terms: DataFrame | None = None) -> DataFrame:
    """Stored postings term, row, pos, before, around for the terms of
    ``anchors`` (phrase, rare).  ``around`` holds the words from ``before`` words
    ahead of the place on, as far as phrases whose rarest term this is need."""
    size = F.size(F.split("phrase", " "))
    first, second = F.get("rare", F.lit(0)), F.get("rare", F.lit(1))
    roles = (anchors.select(first["term"].alias("term"), first["offset"].alias("before"),
                            (size - first["offset"]).alias("after"))
             .unionByName(anchors.filter(second.isNotNull())
                          .select(second["term"].alias("term"), F.lit(0).alias("before"), F.lit(0).alias("after"))))
    if extra_terms is not None:
        roles = roles.unionByName(extra_terms.select("term", F.lit(0).alias("before"), F.lit(0).alias("after")))
    terms = stage_table(roles.groupBy("term").agg(F.max("before").alias("before"), F.max("after").alias("after")), "terms")
    start = F.greatest(F.col("pos") - F.col("before"), F.lit(0))
    return stage_table(
        _found_terms(corpus, terms)
        .withColumn("start", start)
        .select("term", "row", "pos", (F.col("pos") - F.col("start")).alias("before"),
                F.slice("words", F.col("start") + 1, F.col("pos") + F.col("after") - F.col("start")).alias("around")),
        "postings")


def phrase_matches(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """row, start, size, phrase of every exact place of the anchors' phrases."""
    first, second = F.get("rare", F.lit(0)), F.get("rare", F.lit(1))
    wanted = anchors.select("phrase", F.split("phrase", " ").alias("whole"), first["term"].alias("term"),
                            first["offset"].alias("offset"), second["term"].alias("term2"),
                            second["offset"].alias("offset2"))
    from_first = (index.join(wanted, "term")
                  .withColumn("start", F.col("pos") - F.col("offset"))
                  .filter((F.col("start") >= 0) & (F.col("offset") <= F.col("before")))
                  .withColumn("pos2", F.col("start") + F.col("offset2")))
    lists = index.select(F.col("term").alias("term2"), "row", F.col("pos").alias("pos2"))
    both = from_first.filter("term2 is not null").join(lists, ["term2", "row", "pos2"], "left_semi")
    columns = ["row", "start", "phrase", "whole", "around", "before", "offset"]
    candidates = both.select(*columns).unionByName(from_first.filter("term2 is null").select(*columns))
    here = F.slice("around", F.greatest(F.col("before") - F.col("offset") + 1, F.lit(1)), F.size("whole"))
    return candidates.filter(here == F.col("whole")).select("row", "start", F.size("whole").alias("size"), "phrase")


def proximity_matches(index: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """item_id, row, first, last: places where all terms of an item stand within
    ``span`` words, one for each place of the last of them.  ``wanted``: item_id,
    term (distinct within the item)."""
    need = wanted.groupBy("item_id").agg(F.count("*").alias("need"))
    near = Window.partitionBy("item_id", "row").orderBy("pos").rangeBetween(-(span - 1), 0)
    return (index.select("term", "row", "pos").join(wanted, "term")
            .withColumns({"seen": F.size(F.collect_set("term").over(near)), "first": F.min("pos").over(near)})
            .join(need, "item_id").filter("seen = need")
            .select("item_id", "row", "first", F.col("pos").alias("last")))


def proximity(docs: DataFrame, items: DataFrame, *, terms: int = 3, span: int = 2 * WINDOW) -> DataFrame:
    """item_id, doc_id, first, last: where the ``terms`` rarest different words
    of an item (all, if fewer) stand within ``span`` words of a document.  Items
    with a word that no document has are matched by the others."""
    corpus = tokenised(docs)
    own = (items.select("item_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term")))
    count = _found_terms(corpus, stage_table(own.select("term").distinct(), "vocabulary")).groupBy("term").agg(
        F.count("*").alias("count"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("count", "term"))
    wanted = stage_table(own.join(count, "term").withColumn("rank", rank).filter(F.col("rank") <= terms)
                         .select("item_id", "term"), "wanted")
    lists = stage_table(_found_terms(corpus, wanted.select("term").distinct()).select("term", "row", "pos"), "postings")
    return (proximity_matches(lists, wanted, span).join(corpus.select("row", "doc_id"), "row")
            .select("item_id", "doc_id", "first", "last"))


def decontaminate(docs: DataFrame, items: DataFrame, *, size: int = WINDOW, hit_share: int = 20) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): n_words, n_hit, n_items,
    items_sha256, contaminated, against ``items`` (item_id, text).

    A word is hit if it lies in an exact place of any window of ``size`` item
    words; a document is contaminated if it has hits and at least one word in
    ``hit_share`` is hit.  Null and empty texts have no words.  Repeated rows,
    and rows that share a doc_id, are judged one by one; two items with the
    same text both count; items with null id count once together.  Other
    columns are not read.
    """
    corpus = tokenised(docs)
    windows = stage_table(item_windows(items, size).distinct(), "windows")
    anchors = stage_table(rare_terms(corpus, windows.select("phrase").distinct(), 2), "anchors")
    index = build_index(corpus, anchors)
    matches = stage_table(phrase_matches(index, anchors), "matches")
    ends = matches.groupBy("row", "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hits = (ends.withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
            .groupBy("row").agg(F.sum(F.greatest(F.col("stop") - F.greatest("start", "reached"), F.lit(0)))
                                .cast("long").alias("n_hit")))
    named = (matches.select("row", "phrase").distinct().join(windows, "phrase")
             .select("row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("found")))
    none = F.array().cast("array<string>")
    found = F.coalesce("found", none)
    return (corpus.select("row", "doc_id", "n_words").join(hits, "row", "left").join(named, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(found).cast("long").alias("n_items"),
                    F.sha2(F.array_join(found, ","), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (hit_share * F.col("n_hit") >= F.col("n_words"))))


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), '" + string.ascii_uppercase + "', '"
              + string.ascii_lowercase + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size, array_to_string(list_slice(w, s, s + {WINDOW} - 1), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS phrase
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT DISTINCT r, s, places.size, item_id FROM places JOIN windows USING (phrase)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
