"""Toxicity by weak supervision.

Many lexicon and pattern voters look at every text.  A generative label model,
fitted by expectation maximisation on the counts of vote patterns over all
training texts, estimates how often each voter fires for toxic and for clean
texts (its accuracy) and, through a dependency tree, which voters fire together
(their correlations).  Its posterior labels train a logistic classifier.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import PieceCache, fold, slices, table

# Seed lexicons, one voter each.
INSULT_NOUNS = ("idiot", "moron", "loser", "scum", "clown", "trash", "imbecile", "vermin", "idiota", "abruti",
                "connard", "trottel", "arschloch", "dummkopf", "imbécil")
ABUSIVE_WORDS = ("stupid", "disgusting", "pathetic", "worthless", "despicable", "filthy", "asqueroso", "estúpido",
                 "dégoûtant", "widerlich", "wertlos", "erbärmlich")

WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[^\W\d_][*@#$]{2,}[^\W\d_]")
STRETCHED = re.compile(r"([^\W\d_])\1{3}")
SHOUTED = re.compile(r"[^\W\d_]{4,}[!?]{2,}$")
PREFIXES = (4, 5, 6, 7)
DENSE_LEAST, DENSE_SHARE = 2, 0.01


def piece_features(piece: str) -> tuple[str, ...]:
    """Words, word beginnings (``abcd*``) and surface patterns (``#name``) of
    one white-space piece."""
    out = []
    for w in WORD.findall(piece.lower()):
        out.append(w)
        out.extend(w[:n] + "*" for n in PREFIXES if len(w) > n)
    if MASKED.search(piece):
        out.append("#masked")
    if STRETCHED.search(piece):
        out.append("#stretched")
    if piece.isupper() and SHOUTED.search(piece):
        out.append("#shouted")
    return tuple(out)


def is_dense(times: int, pieces: int) -> bool:
    """Whether a feature stands often enough in a text for its dense form
    (``name%``): twice, and at one piece in a hundred."""
    return times >= DENSE_LEAST and times >= DENSE_SHARE * pieces


@dataclass
class ToxicityModel:
    """features: what the classifier looks at, by column; voters: for each
    voter, the features that make it fire; weights: features, voters, bias."""

    features: dict[str, int]
    voters: list[frozenset[int]]
    weights: np.ndarray

    def __post_init__(self):
        self.dense = {i: self.features[f + "%"] for f, i in self.features.items() if f + "%" in self.features}

    def found(self, text: str | None, memo: PieceCache) -> set[int]:
        pieces = (text or "").split()
        hits = Counter(i for hit in filter(None, map(memo.__getitem__, pieces)) for i in hit)
        dense = {self.dense[i] for i, n in hits.items() if i in self.dense and is_dense(n, len(pieces))}
        return dense.union(hits)

    def pattern(self, found: set[int]) -> int:
        return sum(1 << j for j, v in enumerate(self.voters) if not v.isdisjoint(found))

    def memo(self) -> PieceCache:
        look = self.features.get
        return PieceCache(lambda p: tuple(i for i in map(look, piece_features(p)) if i is not None))


def _class_counts(batches):
    for batch in batches:
        seen, toxic = Counter(), Counter()
        docs = [0, 0]
        for part in slices(batch):
            for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                pieces = (text or "").split()
                times = Counter()
                for p, n in Counter(pieces).items():
                    for f in piece_features(p):
                        times[f] += n
                own = [*times, *(f + "%" for f, n in times.items() if is_dense(n, len(pieces)))]
                seen.update(own)
                docs[label] += 1
                if label:
                    toxic.update(own)
        names = list(seen)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array([*names, ""], pa.string()),
            "n": pa.array([*(seen[f] for f in names), sum(docs)], pa.int64()),
            "toxic": pa.array([*(toxic[f] for f in names), docs[1]], pa.int64())})


def induce_features(labelled: DataFrame, *, most: int = 300, least: int = 5) -> dict[str, float]:
    """The ``most`` features whose presence tells most about the label (by the
    G statistic) among those in at least ``least`` of the labelled texts, with
    their log odds ratio.  Of a word beginning and its continuations with the
    same counts only the shortest is kept."""
    counts = (labelled.mapInArrow(_class_counts, "feature string, n long, toxic long")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")))
    total = counts.filter("feature = ''").first()
    if not total:
        return {}
    docs, toxic = total["n"], total["toxic"]
    p, c = F.col("toxic") + 0.5, F.col("n") - F.col("toxic") + 0.5
    odds = F.log(p / (toxic - F.col("toxic") + 0.5)) - F.log(c / (docs - toxic - F.col("n") + F.col("toxic") + 0.5))
    rate, base = F.col("toxic") / F.col("n"), toxic / docs
    gain = F.when(F.lit(toxic in (0, docs)), F.lit(0.0)).otherwise(
        F.col("n") * (F.when(rate > 0, rate * F.log(rate / base)).otherwise(0.0)
                      + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - base))).otherwise(0.0)))
    best = (counts.filter((F.col("feature") != "") & (F.col("n") >= least))
            .select("feature", "n", "toxic", odds.alias("odds"), gain.alias("gain"))
            .orderBy(F.desc("gain"), F.length("feature"), "feature").limit(6 * most).collect())
    kept: dict[str, float] = {}
    stems: dict[tuple, list[str]] = {}
    for r in best:
        same = stems.setdefault((r["n"], r["toxic"], r["feature"][-1] == "%"), [])
        stem = r["feature"].rstrip("*%")
        if r["gain"] > 0 and len(kept) < most and not any(stem.startswith(x) for x in same):
            kept[r["feature"]] = r["odds"]
            same.append(stem)
    return kept


def build_voters(odds: dict[str, float], per_kind: int = 3) -> tuple[dict[str, int], list[frozenset[int]]]:
    """Feature columns and voters: two seed lexicons, three surface patterns,
    and the strongly toxic induced words, word beginnings and dense features,
    each kind dealt by rank to ``per_kind`` voters."""
    plain = [f.removesuffix("%") for f in odds]
    names = dict.fromkeys([*INSULT_NOUNS, *ABUSIVE_WORDS, "#masked", "#stretched", "#shouted", *plain, *odds])
    column = {f: i for i, f in enumerate(names)}
    groups = [INSULT_NOUNS, ABUSIVE_WORDS, ["#masked"], ["#stretched"], ["#shouted"]]
    for end in ("", "*", "%"):
        strong = [f for f, o in odds.items() if o > 3 and f[0] != "#"
                  and (f[-1] == end if end else f[-1] not in "*%")]
        groups += [strong[k::per_kind] for k in range(per_kind) if strong[k::per_kind]]
    return column, [frozenset(column[f] for f in g) for g in groups]


class LabelModel:
    """P(label) and, for each label, a tree P(vote | vote of its parent)."""

    def __init__(self, prior: float, parent: list[int], fire: np.ndarray):
        self.prior, self.parent, self.fire = prior, parent, fire  # fire[label, voter, parent's vote]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.empty((2, len(votes)))
        for y in (0, 1):
            logs[y] = np.log(self.prior if y else 1 - self.prior)
            for j, p in enumerate(self.parent):
                f = self.fire[y, j, votes[:, p] if p >= 0 else 0]
                logs[y] += np.where(votes[:, j] == 1, np.log(f), np.log(1 - f))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def _tree(votes: np.ndarray, weight: np.ndarray) -> list[int]:
    """Parents in the maximum spanning tree of the voters' mutual information
    within the labels (weight[label, pattern]); -1 for the root."""
    n = votes.shape[1]
    info = np.zeros((n, n))
    for w in weight:
        total = max(w.sum(), 1e-9)
        both = (votes * w[:, None]).T @ votes / total
        one = np.diag(both).copy()
        for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
            pa_, pb = one if a else 1 - one, one if b else 1 - one
            joint = both if a and b else one[:, None] - both if a else one[None] - both if b else \
                1 - one[:, None] - one[None] + both
            joint = np.maximum(joint, 1e-12)
            info += total * joint * np.log(joint / np.maximum(np.outer(pa_, pb), 1e-12))
    parent, near = [-1] * n, info[0].copy()
    source, inside = np.zeros(n, dtype=int), {0}
    while len(inside) < n:
        j = max((k for k in range(n) if k not in inside), key=lambda k: (near[k], -k))
        parent[j] = int(source[j])
        inside.add(j)
        better = info[j] > near
        source[better], near[better] = j, info[j][better]
    return parent


def fit_label_model(votes: np.ndarray, count: np.ndarray, known: np.ndarray, rounds: int = 40) -> LabelModel:
    """Expectation maximisation.  ``count``: texts per pattern; ``known``
    [2, patterns]: those whose label is given, which stay with it.  Without
    given labels, a text where any voter fires starts out as toxic."""
    n = votes.shape[1]
    rest = np.maximum(count - known.sum(axis=0), 0)
    if known[1].sum() and known[0].sum():
        share = known[1].sum() / known.sum()
        post = np.where(known.sum(axis=0) > 0, known[1] / np.maximum(known.sum(axis=0), 1), share)
    else:
        post = np.where(votes.any(axis=1), 0.9, 0.02)
    model = None
    for _ in range(rounds):
        weight = known + np.array([rest * (1 - post), rest * post])
        parent = _tree(votes, weight)
        fire = np.empty((2, n, 2))
        for y in (0, 1):
            overall = ((votes * weight[y][:, None]).sum(axis=0) + 0.1) / (weight[y].sum() + 1)
            for j, p in enumerate(parent):
                for v in (0, 1):
                    here = weight[y] * (votes[:, p] == v) if p >= 0 else weight[y]
                    fire[y, j, v] = ((here * votes[:, j]).sum() + 2 * overall[j]) / (here.sum() + 2)
        fire = np.clip(fire, 1e-6, 1 - 1e-6)
        prior = float(np.clip((weight[1].sum() + 1) / (weight.sum() + 2), 1e-4, 1 - 1e-4))
        model = LabelModel(prior, parent, fire)
        post = model.posterior(votes)
    return model


def fit_logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.3, rounds: int = 25) -> np.ndarray:
    """Newton steps for logistic regression on soft targets; the last weight is
    the bias, which isn't shrunk."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink),
                               x.T @ (target - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _matrix(found: list[set[int]], patterns: np.ndarray, columns: int, voters: int) -> np.ndarray:
    x = np.zeros((len(found), columns + voters), dtype=np.float32)
    for i, f in enumerate(found):
        x[i, list(f)] = 1
    x[:, columns:] = (patterns[:, None] >> np.arange(voters)) & 1
    return x


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, sample: int = 10_000) -> ToxicityModel:
    """Learn from training texts ``docs`` (doc_id, text) and ``labels``
    (doc_id, toxic).

    Features and the given labels come from at most ``sample`` labelled texts,
    the first by a hash of doc_id (a doc_id labelled twice is toxic if any of
    its labels is; null labels are left out).  The label model sees the vote
    patterns of all texts.  The classifier is trained on at most about
    ``sample`` texts, again by that hash.  Without labels the seed lexicons and
    surface patterns alone vote; without texts every score is that of an
    empty text.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    known = (labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` rows of two numbers: small enough for every task
    labelled = docs.join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")
    features, voters = build_voters(induce_features(labelled))
    model = ToxicityModel(features, voters, np.zeros(len(features) + len(voters) + 1))
    shared = spark.sparkContext.broadcast(model)

    def vote(batches):
        m = shared.value
        memo = m.memo()
        for batch in batches:
            n = Counter()
            label = batch.column("toxic").to_pylist()
            for at, part in zip(*_offsets(batch)):
                for i, text in enumerate(part.column("text").to_pylist()):
                    n[m.pattern(m.found(text, memo)), label[at + i]] += 1
            yield pa.RecordBatch.from_pydict({"pattern": pa.array([k[0] for k in n], pa.int64()),
                                              "toxic": pa.array([k[1] for k in n], pa.int32()),
                                              "n": pa.array(list(n.values()), pa.int64())})

    # one row per pattern and label: at most 3 x 2^14, as there are 14 voters at most
    rows = (docs.join(F.broadcast(known), "doc_id", "left").select("text", "toxic")
            .mapInArrow(vote, "pattern long, toxic int, n long")
            .groupBy("pattern", "toxic").agg(F.sum("n").alias("n")).collect())
    patterns = sorted({r["pattern"] for r in rows}) or [0]
    at = {p: i for i, p in enumerate(patterns)}
    count, given = np.zeros(len(patterns)), np.zeros((2, len(patterns)))
    for r in rows:
        count[at[r["pattern"]]] += r["n"]
        if r["toxic"] is not None:
            given[r["toxic"], at[r["pattern"]]] += r["n"]
    votes = (np.array(patterns)[:, None] >> np.arange(len(voters))) & 1
    label_model = fit_label_model(votes, count, given)

    def look(batches):
        m = shared.value
        memo = m.memo()
        for batch in batches:
            for part in slices(batch):
                found = [m.found(t, memo) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "ord": part.column("ord"),
                    "pattern": pa.array([m.pattern(f) for f in found], pa.int64()),
                    "found": pa.array([np.array(sorted(f), "<u2").tobytes() for f in found], pa.binary())})

    n = int(count.sum())
    share = min(1.0, 1.2 * sample / max(n, 1))
    top = 2**63 - 1 if share == 1 else int(-2**63 + share * 2**64)
    seen = (docs.withColumn("ord", F.xxhash64("doc_id", "text")).filter(F.col("ord") <= top).select("ord", "text")
            .mapInArrow(look, "ord long, pattern long, found binary").orderBy("ord").limit(sample).collect())
    if seen:
        pattern = np.array([r["pattern"] for r in seen], dtype=np.int64)
        x = _matrix([set(np.frombuffer(r["found"], "<u2").tolist()) for r in seen], pattern, len(features), len(voters))
        target = label_model.posterior((pattern[:, None] >> np.arange(len(voters))) & 1)
        model.weights = fit_logistic(x, target)
    return model


def _offsets(batch):
    parts = list(slices(batch))
    starts = np.cumsum([0, *(p.num_rows for p in parts)])[:-1].tolist()
    return starts, parts


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) for every row.

    Null and empty texts get the score of a text without any feature; repeated
    rows are scored one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        memo, columns = m.memo(), len(m.features)
        for batch in batches:
            for part in slices(batch):
                found = [m.found(t, memo) for t in part.column("text").to_pylist()]
                logit = np.array([m.weights[list(f)].sum() for f in found]) + m.weights[-1]
                for j, v in enumerate(m.voters):
                    logit += m.weights[columns + j] * np.array([not v.isdisjoint(f) for f in found])
                score = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(score, pa.float64()),
                                                  "predicted": pa.array((score >= 0.5).astype(np.int32))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs.filter(fold() != 0), labels.filter(fold() != 0))
    found = score_toxicity(docs, model)
    return found.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
