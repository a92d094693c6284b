"""Every operator against a plain version on a small hostile table: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import hostile_rows
from urbanpulse.llm import decontaminate as dec
from urbanpulse.llm import jaccard, langid, lcpmerge, licenses, packing, shingles, suffixdedup, tokencount, toxicity, urls, vafile

ROWS = hostile_rows()
PLAIN = [(d, t) for d, t in ROWS]
# ids that stand for one text only: plain versions of some operators need that
UNIQUE = list({d: (d, t) for d, t in reversed(PLAIN) if d is not None}.values())


def table_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def unique(spark):
    return spark.createDataFrame(UNIQUE, "doc_id long, text string").repartition(4)


# 1 suffix dedup

SUFFIX = ("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_matches_brute_force(spark, clashing):
    got = Counter(tuple(r) for r in suffixdedup.remove_repeats(clashing).select(*SUFFIX).collect())
    assert got == Counter(brute.suffix_dedup(PLAIN))


def test_suffix_dedup_small_runs_and_buckets(spark, unique, monkeypatch):
    for name, n in (("RUN_TEXTS", 7), ("RUN_SUFFIXES", 40), ("BUCKET_GRAMS", 300), ("BUCKET_SUFFIXES", 50), ("HOT_MOST", 5)):
        monkeypatch.setattr(suffixdedup, name, n)
    monkeypatch.setattr(suffixdedup.hot_grams, "__defaults__", (5,))
    got = Counter(tuple(r) for r in suffixdedup.remove_repeats(unique).select(*SUFFIX).collect())
    assert got == Counter(brute.suffix_dedup(UNIQUE))


def test_suffix_dedup_keeps_columns_and_text(spark, empty, clashing):
    odd = clashing.withColumn("a b-c", F.lit("x"))
    out = suffixdedup.remove_repeats(odd)
    assert out.select("row.*").columns == [c for c in odd.columns if c != "text"]
    assert out.filter("row.`a b-c` = 'x'").count() == len(ROWS)
    assert suffixdedup.remove_repeats(empty).count() == 0


def test_lcp_merge_is_a_merge():
    rng = random.Random(3)
    for _ in range(60):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12)))
                for _ in range(rng.randint(1, 6))]
        coded = [lcpmerge.front_code(r) for r in runs]
        for r, (shared, rest) in zip(runs, coded):
            assert lcpmerge.front_decode(shared, np.array([len(x) for x in r], dtype=int), rest) == r
        run, at, lcp = lcpmerge.merge(runs, [c[0].tolist() for c in coded])
        out = [runs[i][j] for i, j in zip(run, at)]
        assert out == sorted(x for r in runs for x in r)
        assert lcp[1:].tolist() == [lcpmerge.common(a, b, 0) for a, b in zip(out, out[1:])]


def test_texts_whose_hashes_meet_stay_apart(spark, monkeypatch):
    from urbanpulse.llm import common

    real = common.hash_id
    monkeypatch.setattr(common, "hash_id", lambda *c, salt=0: F.pmod(real(*c, salt=salt), F.lit(3)) if salt < 2 else real(*c, salt=salt))
    rows = [(i, f"a text of its own, number {i}, that no other document shares any part of {i * 7919}" * (1 + i % 2)) for i in range(12)]
    rows += [(20, rows[3][1]), (21, rows[4][1])]
    got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    want = Counter(brute.suffix_dedup(rows))
    assert table_of(got.select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256"),
                    "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


# 2 Jaccard join

def test_jaccard_matches_brute_force(spark, unique):
    got = table_of(jaccard.jaccard_components(unique), "doc_id", "n_shingles", "component_id")
    assert got == Counter(brute.jaccard(UNIQUE))


def test_jaccard_large_keys_and_hot_shingles(spark, monkeypatch):
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choice(voc) for _ in range(25))
    base = [rng.choice(voc) for _ in range(60)]
    rows = []
    for i in range(150):
        if i % 3 == 0:
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(60)] = f"e{rng.random()}"
            rows.append((i, " ".join(w)))
        elif i % 3 == 1:
            rows.append((i, line + " " + " ".join(rng.choice(voc) for _ in range(rng.randint(0, 40)))))
        else:
            rows.append((i, " ".join(rng.choice(voc) for _ in range(30))))
    want = Counter(brute.jaccard(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for small, most in ((2, 200_000), (32, 200_000), (2, 0)):
        monkeypatch.setattr(jaccard, "SMALL_KEY", small)
        if not most:
            monkeypatch.setattr(jaccard, "hot_shingles", lambda *a: np.zeros(0, np.uint64))
        assert table_of(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == want


def test_jaccard_defined_cases(spark, clashing, empty):
    out = jaccard.jaccard_components(clashing).collect()
    assert len(out) == len(ROWS)
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    assert all(r["component_id"] <= r["doc_id"] for r in out if r["doc_id"] is not None)
    assert all(r["component_id"] == r["doc_id"] for r in out if r["n_shingles"] == 0)
    assert jaccard.jaccard_components(empty).count() == 0


def plain_links(rows, percent=75):
    """Links of each row with other rows, and the pairs of different sets."""
    sets = []
    for d, t in rows:
        w = brute.re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(brute.LOWER))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w and d is not None else frozenset())
    near = lambda x, y: bool(x and y) and 100 * len(x & y) >= percent * len(x | y)
    count = Counter((rows[i][0], sum(near(x, y) for j, y in enumerate(sets) if i != j)) for i, x in enumerate(sets))
    distinct = sorted(set(sets) - {frozenset()}, key=sorted)
    return count, sum(near(x, y) for i, x in enumerate(distinct) for y in distinct[:i])


def test_jaccard_join_counts_every_link(spark, clashing, empty, monkeypatch):
    rng = random.Random(15)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(90):  # near copies of one text: one component, many of its pairs under keys of over 32 groups
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(90)] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, rows[5][1]) for i in range(7)] + [rows[9], rows[9], (300, "alone " * 9), (301, None), (None, rows[5][1])]
    want, pairs = plain_links(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # one group, then chunks of a component by shingles, by sets
    for shingles_most, nodes_most in ((jaccard.LINK_SHINGLES, jaccard.LINK_NODES), (900, 2048), (400_000, 20)):
        monkeypatch.setattr(jaccard, "LINK_SHINGLES", shingles_most)
        monkeypatch.setattr(jaccard, "LINK_NODES", nodes_most)
        got = jaccard.jaccard_join(docs)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
        assert table_of(got, "doc_id", "n_links") == want
        members, links = jaccard.jaccard_links(docs)
        assert links.distinct().count() == links.count() == pairs and members.count() == len(rows)
        assert table_of(jaccard.jaccard_join(clashing), "doc_id", "n_links") == plain_links(PLAIN)[0]
    assert jaccard.jaccard_join(empty).count() == 0


def test_jaccard_makes_few_sets_of_unlike_texts(spark, monkeypatch):
    rows = []
    for k in range(20):  # half of one is in the other: they share prefix shingles, but don't link
        w = [f"w{k}_{i}" for i in range(84)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:44] + [f"v{k}_{i}" for i in range(20)]))]
    for k in range(3):
        w = [f"c{k}_{i}" for i in range(84)]
        rows += [(100 + 2 * k, " ".join(w)), (101 + 2 * k, " ".join([*w[:80], f"e{k}"]))]
    made, sets = [], jaccard._sets

    def counted(*args):
        name = sets(*args)
        made.append({r["doc_id"] for r in spark.table(name).collect()})
        return name

    monkeypatch.setattr(jaccard, "_sets", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert table_of(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == Counter(brute.jaccard(rows))
    made = set().union(*made)
    assert made >= set(range(100, 106)) and len(made) < 26


def test_signatures_refuse_no_link():
    rng = np.random.default_rng(8)
    refused = 0
    for _ in range(3000):
        n = int(rng.integers(1, 300))
        pool = np.unique(rng.integers(1, 2**63, 2 * n, dtype=np.uint64))
        a, both = pool[:n], pool[:int(rng.integers(0, n + 1))]
        b = np.union1d(both, pool[n:n + int(rng.integers(0 if len(both) else 1, n // 2 + 2))])
        link = 100 * len(both) >= 75 * (len(a) + len(b) - len(both))
        for x, y in ((a, b), (b, a)):
            may = jaccard.may_link(jaccard.signature(x), jaccard.signature(y), len(x), len(y))
            assert may or not link
        refused += not may
    assert refused > 1500


def test_bitmaps_keep_every_needed_text(spark, monkeypatch):
    docs = spark.range(-3000, 3000).selectExpr("id as doc_id", "cast(id as string) as text")
    need = docs.filter("doc_id % 30 = 0").selectExpr("doc_id as node", "doc_id")
    found = jaccard._among(docs, need)
    assert found.columns == docs.columns
    rows = [r["doc_id"] for r in found.collect()]
    assert len(set(rows)) == len(rows) < 400 and {r["doc_id"] for r in need.collect()} <= set(rows)
    assert jaccard._among(docs, need.limit(0)).count() == 0


def test_similar_as_grouped_prefix_join(monkeypatch):
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 2**63, 80, dtype=np.uint64))
    sets = []
    for i in range(70):  # near copies, half of a text, single shingles, strangers
        s = np.array(base)
        s[rng.integers(0, len(s), rng.integers(0, 16))] = rng.integers(1, 2**63, dtype=np.uint64)
        sets.append(np.unique((s, s[:40], base[:1], rng.integers(1, 2**63, 30, dtype=np.uint64))[min(3, i % 7)]))
    hot = np.sort(base[::3])
    gid = np.array([jaccard._digest(np.append(jaccard.prefix(s, hot), np.uint64(len(s))), 2) for s in sets]).view(np.int64)
    want = [[100 * len(x := set(a.tolist()) & set(b.tolist())) >= 75 * (len(a) + len(b) - len(x)) for b in sets] for a in sets]
    assert (jaccard._similar(sets, gid, sets, gid, hot, 75) == np.array(want)).all()
    one = jaccard._similar(sets[:1], gid[:1], sets, gid, hot, 75)  # few candidates: pairs one by one
    assert (one == np.array(want)[:1]).all()


def test_word_hashes_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = (" ".join(f"word{i}" for i in range(5000)) + " " + "x" * 3000).encode()
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "CHUNK", 1000)
    assert (shingles.word_hashes(text) == whole).all()


# 3 exact top-k

def brute_top(vectors, queries, k):
    out = []
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in set(vectors) if v != q and len(x) == len(y))
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scored[:k])]
    return Counter(out)


@pytest.mark.parametrize("blocks", [1, 3])
def test_top_k_matches_brute_force(spark, monkeypatch, blocks):
    rng = np.random.default_rng(2)
    vecs = rng.normal(0, 0.3, (300, 6))
    vecs[40:140] = vecs[0]  # a vector that a third of the rows share
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6),
             (904, []), (905, [0.5, 0.5]), (906, [0.5, -0.5]), (None, [0.0] * 6), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query_id", F.lit(1)).repartition(5)
    if blocks > 1:
        monkeypatch.setattr(vafile, "BLOCK_QUERIES", 10)
    q = vafile.quantised(df)
    plain = [(r["vec_id"], tuple(r["vec"])) for r in q.collect()]
    assert {v for v, _ in plain}.isdisjoint({900, 901, 902, 903, None})
    got = table_of(vafile.exact_top_k(q, q.filter("vec_id % 10 = 0 or vec_id > 900"), 5), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(plain, set(x for x in plain if x[0] % 10 == 0 or x[0] > 900), 5)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, vec array<long>")
    assert vafile.exact_top_k(none, none, 5).count() == 0


def test_top_k_of_large_components(spark):
    rng = random.Random(33)
    rows = [(i, [rng.uniform(-4e6, 4e6) for _ in range(3)]) for i in range(200)]
    rows += [(200 + i, [4e6, 4e6 - i / 64, 4e6]) for i in range(40)]  # scores that differ in their last digits
    rows += [(300, [1e20, 0.0, 0.0]), (301, [-1e300, 1.0, 1.0]), (302, [1e8, 0.0, 0.0])]
    q = vafile.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plain = [(r["vec_id"], tuple(r["vec"])) for r in q.collect()]
    assert {v for v, _ in plain} == set(range(240))
    got = table_of(vafile.exact_top_k(q, q.filter("vec_id % 4 = 0"), 5), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(plain, set(x for x in plain if x[0] % 4 == 0), 5)


# 4 packing

def check_packing(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for start, size in sorted(places):
            assert start == at
            at += size
        assert at <= length
    return len(by)


def test_best_fit_fills_bins():
    bins, offsets = packing.best_fit(np.array([6, 5, 5, 4, 10, 1]), 10)
    assert len(set(bins.tolist())) == 4 and offsets.min() == 0


def test_packing_is_gapless_and_dense(spark):
    rng = random.Random(4)
    sizes = [rng.choice([3, 40, 200, 513, 700, 1024]) for _ in range(3000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long").repartition(9)
    out = packing.pack(df, block=60, merge_items=300).collect()
    assert Counter((r["doc_id"], r["length"]) for r in out) == Counter(enumerate(sizes))
    used = check_packing(out, 1024)
    bins, _ = packing.best_fit(np.array(sizes), 1024)
    assert used <= 1.02 * (bins.max() + 1)


def test_pieces_match_the_tokenizers_library(spark, clashing, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(clashing).collect()
    check_packing(got, 1024)
    want = Counter()
    for d, t in PLAIN:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert packing.pack_documents(empty).count() == 0


# 5 decontamination

def items_of(rows):
    long = [t for _, t in rows if t and len(t.split()) > 40]
    w = long[0].split()
    return [(1, " ".join(w[:20]).upper() + "!"), (2, " ".join(w[5:30])), (3, "x"), (4, None), (5, "..."), (6, "a b c"),
            (7, "never seen words " * 6), (8, " ".join(w[5:30])), (10, long[1])]


DECON = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination_matches_brute_force(spark, clashing, monkeypatch):
    items = items_of(PLAIN)
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(0))
    want = Counter(brute.decontaminate(PLAIN, items))
    assert table_of(dec.decontaminate(clashing, df), *DECON) == want
    monkeypatch.setattr(dec, "BLOCK_TERMS", 9)
    assert table_of(dec.decontaminate(clashing, df), *DECON) == want


def test_decontamination_of_and_with_nothing(spark, clashing, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    assert all(not r["contaminated"] and r["n_items"] == 0 for r in dec.decontaminate(clashing, items).collect())
    assert dec.decontaminate(empty, items).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "u u u alpha u beta u u gamma u"), (2, "alpha " + "u " * 40 + "beta gamma"), (3, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, "Alpha beta, gamma u u u")], "item_id long, text string")
    got = [tuple(r) for r in dec.proximity(docs, items, terms=3, span=10).collect()]
    assert got == [(7, 1, 3, 8)]
    assert {r["doc_id"] for r in dec.proximity(docs, items, terms=3, span=60).collect()} == {1, 2}


# 6 token counts

def test_token_counts_match_the_library(spark, clashing, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in PLAIN)
    assert table_of(tokencount.count_tokens(clashing), "doc_id", "n_bytes", "n_tokens") == want
    assert tokencount.count_tokens(empty).count() == 0


def test_token_counts_of_unassigned_code_points(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(16)
    odd = "\ua7cb\ua7dc\u0378\u0380\u05ff\U000e0080\U0002fffe\uffff"
    texts = ["".join(rng.choice(odd + "aB\u0301 1.\u0130\u03a3'") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    got = tokencount.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["n_tokens"] for r in sorted(got)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


# 7 toxicity

def toxic_table(spark):
    rng = random.Random(6)
    voc = [f"plain{i}" for i in range(300)]
    rows, labels = [(9000, None), (9001, ""), (9002, "x" * 100_000)], [(9000, 0), (9001, None), (70_000, 1)]
    for i in range(1500):
        w = [rng.choice(voc) for _ in range(rng.randint(5, 80))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "Scum,", "vilgen", "vilber", "zorkan"]))
        rows.append((i, " ".join(w)))
        if i % 2:
            labels.append((i, int(bad)))
    labels.append((1, labels[3][1]))
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(0)).repartition(4),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels[3:-1]))


def test_toxicity_held_out(spark):
    docs, labels, truth = toxic_table(spark)
    model = toxicity.fit_toxicity(docs.filter("doc_id % 5 <> 0"), labels.filter("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert len(got) == 1503 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [d for d in truth if d % 5 == 0]
    assert np.mean([got[d]["predicted"] == truth[d] for d in held]) > 0.97
    assert got[9000]["predicted"] == got[9001]["predicted"] == 0


def test_toxicity_without_labels_and_texts(spark, clashing, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs, _, truth = toxic_table(spark)
    model = toxicity.fit_toxicity(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([got[d] == y for d, y in truth.items()]) > 0.85  # the seed lexicons alone
    model = toxicity.fit_toxicity(empty, labels)
    assert toxicity.score_toxicity(clashing, model).count() == len(ROWS)


# 8 language ID

def language_table(spark):
    rng = random.Random(8)
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["sch", "ung", "ein", "ach"], "cc": ["eau", "oi", "tre", "que"]}
    rows = []
    for i in range(600):
        lang = rng.choice(list(parts))
        word = lambda: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3)))  # noqa: B023, E731
        rows.append((i, " ".join(word() for _ in range(rng.randint(3, 60))), lang if i % 7 else None, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")


def test_language_id_held_out(spark):
    docs = language_table(spark)
    model = langid.fit_languages(docs.filter("doc_id % 5 <> 0"))
    got = langid.identify(docs, model).join(docs, "doc_id").filter("doc_id % 5 = 0").collect()
    assert np.mean([r["lang_pred"] == r["truth"] for r in got]) > 0.97
    assert np.mean([r["rejected"] for r in got]) < 0.02


def test_language_id_rejects_junk(spark):
    docs = language_table(spark)
    model = langid.fit_languages(docs.filter("doc_id % 5 <> 0"))
    rng = random.Random(28)
    drawn = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    scripts = ["abcdefghijklmnopqrstuvwxyz     ", "αβγδεζηθικλμνξοπρστυφχψω ", "абвгдежзийклмнопрстуфхцч ", "的一是不了人我在有他这中大来上国"]
    for letters in scripts:
        for n in (30, 100, 400, 2000):
            found = langid.judge([drawn(letters, n) for _ in range(50)], model)
            assert sum(f[2] for f in found) >= 48, (letters, n)
    clean = langid.judge([r["text"] for r in docs.filter("doc_id % 5 = 0").collect()], model)
    assert np.mean([f[2] for f in clean]) < 0.02


def test_language_id_learns_a_rare_language(spark):
    rng = random.Random(18)
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["sch", "ung", "ein", "ach"], "rr": ["kuu", "ylo", "vaa", "ppi"]}
    text = lambda lang: " ".join("".join(rng.choice(parts[lang]) for _ in range(2)) for _ in range(12))
    # 4 of 20,000 rows, 0.02 %
    rows = [(i, text("rr" if i % 5000 == 7 else "aa" if i % 2 else "bb"), "rr" if i % 5000 == 7 else "aa" if i % 2 else "bb")
            for i in range(20_000)]
    rows += [(None, "12", "letterless")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit_languages(docs)
    assert sorted(set(model.languages)) == ["aa", "bb", "rr"]
    unseen = [text("rr") for _ in range(20)] + [text("aa") for _ in range(20)]
    got = langid.judge(unseen, model)
    assert [g[0] for g in got] == ["rr"] * 20 + ["aa"] * 20 and not any(g[2] for g in got)


def test_language_id_defined_cases(spark, clashing, empty):
    model = langid.fit_languages(language_table(spark))
    got = langid.identify(clashing, model).collect()
    assert len(got) == len(ROWS)
    for t in (None, "", " ", "12 ²", "😀"):
        assert langid.judge([t], model) == [("und", 0.0, True)]
    kept = langid.drop_rejected(clashing, model)
    assert kept.columns == clashing.columns and kept.count() == sum(not r["rejected"] for r in got)
    nothing = langid.fit_languages(empty)
    assert {r["lang_pred"] for r in langid.identify(clashing, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_trigrams_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = "some words here " * 400
    whole = langid.trigram_counts([text])
    monkeypatch.setattr(langid, "CHUNK", 500)
    assert (langid.trigram_counts([text]) == whole).all()


# 9 URL filters

URLS = [("http://Example.org/es/x?q", "example.org", "/es/x", "example.org/es/", "block"),
        ("https://a.example.org/en/17#z", "a.example.org", "/en/17", "example.org/en/1", "block"),
        ("http://b.org/", "b.org", "/", "org/", "allow"), ("http://b.org", "b.org", "", None, "allow"),
        ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"), ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://É.net/p?u=http://q.org/", "É.net", "/p", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow")]


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(0, URLS[0][0])], "page_id long, url string")
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    got = urls.filter_urls(pages.withColumn("n", F.lit(1)), outcomes).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]][1:]


def test_url_reputation_blocks_bad_hosts(spark):
    rows, bad = [], []
    for i in range(400):
        host = "bad.net" if i % 2 else "good.net"
        rows.append((i, f"http://{'w.' if i % 3 else ''}{host}/{i}"))
        if i < 200:
            bad.append((i, int(i % 2)))
    rows += [(1000, "http://new.bad.net/"), (1001, "http://other.info/")]
    bad += [(5, 1), (None, 1), (7, None)]
    got = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"),
                                                     spark.createDataFrame(bad, "page_id long, bad int")).collect()}
    assert {got[i]["verdict"] for i in range(1, 400, 2)} == {"block"} and {got[i]["verdict"] for i in range(0, 400, 2)} == {"allow"}
    assert got[1000]["rate"] > 0.8 and got[1001]["verdict"] == "allow"


def shrinkage(rows, z=urls.Z):
    """Rate and bound of every bare host of (host, domain, suffix, bad or None), in plain Python."""
    def counts(at):
        out = {}
        for r in rows:
            n, k = out.get(r[at], (0, 0))
            out[r[at]] = (n + (r[3] is not None), k + (r[3] or 0))
        return out

    def strength(level, prior):
        own = [(n, k, prior[x]) for x, (n, k) in level.items() if n]
        spread = sum((k - n * p) ** 2 / n for n, k, p in own)
        noise, weight = sum(p * (1 - p) for _, _, p in own), sum(n * p * (1 - p) for n, _, p in own)
        inside = (spread - noise) / max(weight - noise, 1e-9)
        return min(1000.0, max(1.0, 1 / inside - 1)) if inside > 0 else 1000.0

    n = sum(r[3] is not None for r in rows)
    overall = (sum(r[3] or 0 for r in rows) + 1) / (n + 2)
    rate, parent = {"": overall}, {r[2]: "" for r in rows}
    for at in (2, 1, 0):
        level, prior = counts(at), {r[at]: rate[r[at + 1]] if at < 2 else overall for r in rows}
        s = strength(level, prior)
        weight = {x: n + s for x, (n, _) in level.items()}
        rate = {x: (k + s * prior[x]) / weight[x] for x, (n, k) in level.items()}
    return {x: (p, max(0.0, p - z * (p * (1 - p) / (weight[x] + 1)) ** 0.5)) for x, p in rate.items()}, overall


def test_url_reputation_matches_plain_shrinkage(spark):
    rng = random.Random(19)
    hosts = [(f"{a}.{d}.{s}", f"{d}.{s}", s) for s in ("net", "info", "co.uk") for d in ("one", "two", "bad") for a in ("www", "x", "y")]
    hosts += [("10.0.0.1", "10.0.0.1", ""), ("10.9.0.1", "10.9.0.1", ""), ("[::1]", "[::1]", "")]
    rows, pages, outcomes = [], [], []
    for i in range(3000):
        h = hosts[0] if i % 3 == 0 else rng.choice(hosts)  # one host holds a third
        bad = None if rng.random() < 0.4 else int(rng.random() < (0.7 if "bad" in h[1] else 0.9 if h[0] == "10.0.0.1" else 0.05))
        rows.append((*h, bad))
        pages.append((i, f"http://{rng.choice(['', 'user:pw@'])}{h[0]}{rng.choice(['', ':8080', '.'])}/{i}"))
        outcomes += [(i, bad)] * 2
    want, overall = shrinkage(rows)
    got = urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string").repartition(5),
                           spark.createDataFrame(outcomes, "page_id long, bad int")).collect()
    assert len(got) == 3000
    for r in got:
        rate, bound = want[rows[r["page_id"]][0]]
        assert abs(r["rate"] - rate) < 1e-4 and abs(r["bound"] - bound) < 1e-4
        assert r["verdict"] == ("block" if bound > min(0.5, 2 * overall) else "allow")
    assert {r["verdict"] for r in got} == {"block", "allow"}


# 10 license scans

def test_license_base_matches_brute_force(spark, clashing):
    texts = ["Released under the MIT License.", "under the mit licenses under the MIT-license under the mit license",
             "Apache License, Version 2.0; apache license version 21", "CC BY-NC cc by nc/CC_BY_NC", "", None, "cc by nc" * 2000,
             "Apache apache license version 2 license version 2"]
    df = clashing.select("doc_id", "text").unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = licenses.license_digest(licenses.scan_licenses(df))
    want = Counter((d, *brute.licenses(t, licenses.BASE_PHRASES)) for d, t in PLAIN + [(1000 + i, t) for i, t in enumerate(texts)])
    assert table_of(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want


@pytest.mark.parametrize("text, labels", [
    ("This is releesed undr the MIT licence today", "mit"), ("under the apache licnse version 2.0 ok", "apache-2"),
    ("Licensed under the GNU General Public License, version 3", "gpl-3"), ("all rights reserved", "all-rights-reserved"),
    ("under the tree and the mitten", ""), ("version 2 of the general plan", ""), ("", "")])
def test_license_near_matches(spark, text, labels):
    got = licenses.license_digest(licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert got["labels"] == labels and (got["score"] > 0) == bool(labels)


def test_license_neighbours_keep_their_labels():
    ready = [(n, n.pattern()) for n in (licenses.Notice(w.encode(), label, k) for w, label, k in licenses.NOTICES)]
    for text, labels in [("under the bsd 2 clause license", ["bsd-2"]), ("undr the bsd 4 clause licence", ["bsd-4"]),
                         ("licensed under cc by nd 4 0", ["cc-by-nd"]), ("licensed under cc by nc nd 4 0", ["cc-by-nc-nd"]),
                         ("under the apache license version 1 1", ["apache-1.1"]), ("under the mix license", []),
                         ("under the gnu general public license version 1", ["gpl-1"]),
                         ("under the gnu general public license version 4", []),
                         ("under the gnu lesser general public licence version 3", ["lgpl-3"]),
                         ("under the bsd 3 clause licens under the bsd 3 clause license", ["bsd-3", "bsd-3"])]:
        found = licenses.best_matches(licenses._normal(text.encode())[0], ready)
        assert [m[0].label for m in found] == labels, text


def test_license_scan_of_very_many_notices(spark):
    text = "under the bsd 3 clause license, all rights reserved. " * 4000
    got = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(m["label"], m["word"]) for m in got["near"][:3]] == [("bsd-3", 0), ("all-rights-reserved", 6), ("bsd-3", 9)]
    assert len(got["near"]) == 8000 and got["n_words"] == 36_000


def test_license_seeds_find_every_match():
    import regex

    rng = random.Random(9)
    for notice in (licenses.Notice(n.encode(), label, k) for n, label, k in licenses.NOTICES):
        assert b"".join(s for _, s in notice.seeds()) == notice.words
        for _ in range(30):
            data = bytearray(notice.words)
            for _ in range(notice.edits):
                i = rng.randrange(len(data))
                data[i:i + rng.randint(0, 1)] = bytes([rng.choice(b"abcxyz ")]) * rng.randint(0, 1)
            text = b" filler words " + bytes(data) + b" more filler "
            whole = regex.search(b"(?:" + regex.escape(notice.words) + b"){e<=%d}" % notice.edits, text)
            assert bool(licenses.near_matches(text, notice, notice.pattern())) == bool(whole)


def test_license_scan_of_nothing(empty):
    assert licenses.license_digest(licenses.scan_licenses(empty)).count() == 0


def test_pieces_of_one_size_per_file_still_meet(spark, tmp_path):
    """1,000 pieces of 700 and 1,000 of 300 tokens in separate files fill 1,000 sequences."""
    for size in (700, 300):
        spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(size).cast("long").alias("length")).coalesce(1).write.parquet(
            f"{tmp_path}/size={size}")
    for items in (100_000, 400):
        out = packing.pack(spark.read.parquet(f"{tmp_path}/size=700", f"{tmp_path}/size=300"), merge_items=items)
        assert out.select("sequence_id").distinct().count() <= 1000 + 20 * (items == 400)


def test_piece_ids_equal_the_tokenizers_library(spark):
    import os

    import public_tokenizers as public
    from tokenizers import Tokenizer

    sf = os.environ.get("UP_TEST_SF", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    library, ids = Tokenizer.from_file(str(public.path("byte_bpe_50k.json"))), packing._ids(None)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + [t or "" for _, t in PLAIN]
    for text in texts:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
