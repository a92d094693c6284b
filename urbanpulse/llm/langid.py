"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte trigrams; each language
has several centroids (spherical k-means); a text gets the language of the
centroid with the highest cosine, and is rejected when that cosine is far below
what training texts of its length reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import fold, slices, table

DIMS = 4096
CHUNK = 1 << 20
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"
#: Training texts that every language may keep, however many languages there are.
LEAST_SAMPLE = 100
#: Sampled texts that a rejection floor rests on, and the first length class
#: (power of two of the number of trigrams) that has one.
LEAST_CLASS, SHORTEST = 20, 3

# ASCII that is no letter counts as a blank; other bytes stand for themselves
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class LanguageModel:
    """languages: owner of each centroid row; floor: per power-of-two length,
    the cosine under which a text is rejected."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floor: dict[int, float] = field(default_factory=dict)


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Hashed trigram counts, one row of DIMS per text (null: zeros)."""
    counts = np.zeros((len(texts), DIMS), dtype=np.float32)
    group: list[tuple[int, bytes]] = []
    held = 0

    def flush():
        nonlocal group, held
        if not group:
            return
        rows = np.array([r for r, _ in group])
        sizes = np.array([len(b) for _, b in group])
        a = np.frombuffer(b"".join(b for _, b in group), dtype=np.uint8).astype(np.uint32)
        h = a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(20)
        local = np.repeat(np.arange(len(group), dtype=np.int64), sizes)
        ends = np.cumsum(sizes)
        keep = np.ones(len(a), dtype=bool)
        keep[ends - 1] = keep[ends - 2] = False
        keep = keep[:-2]
        flat = (local[:-2] * DIMS + h)[keep]
        part = np.bincount(flat, minlength=len(group) * DIMS).reshape(len(group), DIMS)
        np.add.at(counts, rows, part.astype(np.float32))
        group, held = [], 0

    for row, text in enumerate(texts):
        data = b" " + " ".join((text or "").lower().split()).encode().translate(_BLANK) + b" "
        for at in range(0, max(1, len(data) - 2), CHUNK):
            piece = data[at:at + CHUNK + 2]
            if len(piece) < 3:
                continue
            group.append((row, piece))
            held += len(piece)
            if held >= CHUNK or len(group) >= 128:
                flush()
    flush()
    return counts


def _tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm == 0, 1, norm)).astype(np.float32)


def _length(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts.sum(axis=1) + 1)).astype(int)


def _document_frequency(batches):
    df, n = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for part in slices(batch):
            texts = [t for t in part.column("text").to_pylist() if t and LETTER.search(t)]
            if texts:
                df += (trigram_counts(texts) > 0).sum(axis=0)
                n += len(texts)
    # the last feature number counts the documents
    yield pa.RecordBatch.from_pydict({"feature": pa.array(range(DIMS + 1), pa.int32()),
                                      "df": pa.array([*df, n], pa.int64())})


def _with_letters(batches):
    for batch in batches:
        for part in slices(batch):
            keep = pa.array([bool(t and LETTER.search(t)) for t in part.column("text").to_pylist()], pa.bool_())
            yield part.select(["lang", "ord"]).filter(keep)


def _sparse_rows(batches):
    seen = set()
    for batch in batches:
        for part in slices(batch):
            rows = []
            for l, t, o in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "ord"))):
                if t and (l, o) not in seen and LETTER.search(t):
                    seen.add((l, o))
                    rows.append((l, t, o))
            if not rows:
                continue
            counts = trigram_counts([t for _, t, _ in rows])
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([r[0] for r in rows], pa.string()),
                "ord": pa.array([r[2] for r in rows], pa.int64()),
                "feature": pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()),
                "n": pa.array([c[i].astype("<f4").tobytes() for c, i in zip(counts, at)], pa.binary())})


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with farthest-first seeds, the first nearest the mean."""
    mean = x.mean(axis=0)
    seeds = [int(np.argmax(x @ mean))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit_languages(train: DataFrame, *, sample: int = 3000, clusters: int = 4,
                  slack: float = 0.5, low: float = 0.005) -> LanguageModel:
    """Fit on ``train`` (doc_id, text, lang).

    Inverse document frequencies are taken over all training texts.  Centroids
    and rejection floors are fitted on a sample of every language: of its
    distinct rows (doc_id, text) the first in the order of a hash, at most
    ``sample`` divided by the number of languages, or LEAST_SAMPLE if that is
    more.  So each language with a training row has centroids.  The floor of a length class is ``slack``
    times the ``low`` quantile of the cosines that sampled texts of that class have
    with their own language; a class with under LEAST_CLASS sampled texts is taken
    together with its nearest neighbours.  Texts of under 2^SHORTEST - 1 trigrams,
    and those of a model of under LEAST_CLASS texts, have none.  Rows with null
    lang or without a letter are not learned; without rows the model is empty.
    """
    spark = train.sparkSession
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    total = {r["feature"]: r["df"] for r in
             train.select("text").mapInArrow(_document_frequency, "feature int, df long")
             .groupBy("feature").agg(F.sum("df").alias("df")).collect()}
    n = total.get(DIMS, 0)
    df = np.array([total.get(i, 0) for i in range(DIMS)], dtype=np.float64)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 0.05
    if not n:
        return LanguageModel(idf, np.zeros((0, DIMS), np.float32), [])
    # a hash of id and text: rows that share an id, or have none, differ in it
    train = train.withColumn("ord", F.xxhash64("doc_id", "text"))
    rows = {r["lang"]: r["n"] for r in train.mapInArrow(_with_letters, "lang string, ord long")
            .groupBy("lang").agg(F.approx_count_distinct("ord").alias("n")).collect()}
    each = max(LEAST_SAMPLE, sample // len(rows))
    # the estimate is off by a few hundredths; what is too much goes below
    upto = {lang: int(-2**63 + share * (2**64 - 1)) if (share := 1.5 * each / max(1, k)) < 1 else 2**63 - 1
            for lang, k in rows.items()}
    limit = spark.createDataFrame(list(upto.items()), "lang string, upto long")
    picked = (train.join(F.broadcast(limit), "lang").filter("ord <= upto").select("lang", "text", "ord")
              .mapInArrow(_sparse_rows, "lang string, ord long, feature binary, n binary")
              .dropDuplicates(["lang", "ord"]).collect())
    by: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r["ord"], r["lang"])):
        by.setdefault(r["lang"], []).append(r)
    centroids, owners, lengths, cosines = [], [], [], []
    for lang in sorted(by):  # one language at a time is a dense matrix
        x = np.zeros((min(each, len(by[lang])), DIMS), dtype=np.float32)
        for i, r in enumerate(by.pop(lang)[:each]):
            x[i, np.frombuffer(r["feature"], "<u2")] = np.frombuffer(r["n"], "<f4")
        lengths.append(_length(x))
        x = _tfidf(x, idf)
        c = _cluster(x, clusters)
        centroids.append(c)
        owners += [lang] * len(c)
        cosines.append((x @ c.T).max(axis=1))
    length, own_cosine = np.concatenate(lengths), np.concatenate(cosines)
    return LanguageModel(idf, np.vstack(centroids), owners, _floors(length, own_cosine, slack, low))


def _floors(length: np.ndarray, cosine: np.ndarray, slack: float, low: float) -> dict[int, float]:
    """Rejection floor of every length class (see ``fit_languages``)."""
    floor = {}
    for bucket in range(SHORTEST, 64 if len(cosine) >= LEAST_CLASS else 0):
        away = np.abs(length - bucket)
        reach = np.sort(away)[LEAST_CLASS - 1]  # the class alone, or with as many neighbours as it takes
        floor[bucket] = max(0.0, slack * float(np.quantile(cosine[away <= reach], low)))
    return floor


def judge(texts: list[str | None], model: LanguageModel) -> list[tuple[str, float, bool]]:
    """Language, cosine and whether it is rejected, of each text."""
    out = [(UNDETERMINED, 0.0, True)] * len(texts)
    rows = [i for i, t in enumerate(texts) if model.languages and t and LETTER.search(t)]
    if rows:
        counts = trigram_counts([texts[i] for i in rows])
        cosine = _tfidf(counts, model.idf) @ model.centroids.T
        best = cosine.argmax(axis=1)
        for i, b, c, n in zip(rows, best, cosine[np.arange(len(rows)), best], _length(counts)):
            score = float(min(1.0, max(0.0, c)))
            out[i] = model.languages[b], score, score < model.floor.get(int(n), 0.0)
    return out


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), rejected, for every row.

    Null texts and texts without a letter are ``und``, score 0, rejected; so is
    every text when the model is empty.  Repeated rows are judged one by one;
    equal cosines go to the first language in order.  Other columns of ``docs``
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            for part in slices(batch):
                found = judge(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                    "score": pa.array([f[1] for f in found], pa.float64()),
                    "rejected": pa.array([f[2] for f in found], pa.bool_())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns, that ``identify`` doesn't reject.  Only
    the texts go to Python, and a flag comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            flags = [not far for part in slices(pa.RecordBatch.from_arrays([batch], names=["text"]))
                     for _, _, far in judge(part.column("text").to_pylist(), shared.value)]
            yield pa.array(flags, pa.bool_())

    return docs.filter(kept("text"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(fold() != 0)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(training_rows(docs)))
    return found.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score", "rejected")
