"""Secret scans, Merkle manifest and hard negatives against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import hostile_rows
from urbanpulse.llm import lemp, merkle, secrets

ROWS = hostile_rows()


# 11 secret scans

def base(text):
    """n_assign, n_access, n_hex, digest: a plain version of the base patterns."""
    text, spans = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, "assign", m.end()))
    for place, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 18), ("hex", r"[0-9a-f]+", 16)), 1):
        spans += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    said = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    kinds = Counter(x[2] for x in spans)
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(said.encode()).hexdigest()


SECRET_TEXTS = [
    "token: password = aaaaaaaaaaaaaa", "PASSWORD='abcdefghijkl'", "paſſword=abcdefghijklmn toKen=abcdefghijklmn", "api_key=short api_key=longer_than_twelve",
    "AKIA" + "A" * 13, "AKIA" + "A" * 14, "AKIAAKIA" + "0" * 12 + "é", "0123456789abcdef", "0123456789abcde", "x0123456789abcdef0gF",
    "password=token=abcdefghijkl", 'secret"  :  "' + "a" * 40, "日本 password=abcdefghijklmnop 😀 0123456789abcdef0123", "secret=\nabcdefghijklmnop",
    "password=" * 2000, "a=password\npassword=a\n" * 500, "password:password " * 2000, "0123456789abcdef" * 3000, '"' * 999, "'", '"""', "${", "x = f(" * 999,
]


def test_secret_base_matches_brute_force(spark, hostile):
    rows = [(i, t) for i, t in enumerate(SECRET_TEXTS)] + ROWS
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"base": F.lit(1), "found": F.lit(2), "own": F.lit(3)})
    got = secrets.secret_digest(secrets.scan_secrets(docs.repartition(5)))
    assert got.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter((d, *base(t)) for d, t in rows)
    assert secrets.secret_digest(secrets.scan_secrets(hostile.limit(0))).count() == 0


# text, literals found with their best name
LEXED = [
    ('password = "hunter2secret!"', [("hunter2secret!", "password")]),
    ('A = "Zx9"\nB = "kk2!pQ"\ndb_password = A + B\n', [("Zx9", "db_password"), ("kk2!pQ", "db_password")]),
    ("export BASE=abcDEF123456\nPASSWORD=$BASE-x", [("abcDEF123456", "PASSWORD")]),
    ('key = "ab12CD34ef"\nurl = f"https://x?{key}"\nsecret = url', [("ab12CD34ef", "secret")]),
    ('a = "Ab12cd34Ef"\nb = a\nc = b\ntoken = c', [("Ab12cd34Ef", "token")]),
    ("<password>Xy7_kkQ99</password>", [("Xy7_kkQ99", "password")]),
    ('cfg["api_key"] = "Q1w2E3r4T5"', [("Q1w2E3r4T5", "api_key")]),
    ('{"user": "bob", "client_secret": "aB3dE5fG7h"}', [("aB3dE5fG7h", "client_secret")]),
    ('conn.setPassword("s3cr3tPass9")', [("s3cr3tPass9", "conn.setPassword")]),
    ('define("DB_PASSWORD", "q9W8e7R6")', [("q9W8e7R6", "DB_PASSWORD")]),
    ("postgres://me:Pa55w0rd9x@host/db", [("Pa55w0rd9x", "url.password")]),
    ("mysql --password Pa55w0rd9x -h", [("Pa55w0rd9x", "password")]),
    ('val token: String = "abCD1234xyz"', [("abCD1234xyz", "token")]),
    ('- name: PASSWORD\n  value: "Xk29fj3LLw"', [("Xk29fj3LLw", "PASSWORD")]),
    ('secret = decode("QWxhZGRpbjpvcGVu")', [("QWxhZGRpbjpvcGVu", "secret")]),
    # no secrets: words, placeholders, names about secrets, reads, circles
    ("the token: of the password: is word.", []), ('password = "changeme"', []), ('token = "<your token>"', []),
    ('password_length = "12345678ab"', []), ('password = os.environ["DB_PASSWORD"]', []), ("secret = getpass('Enter Passw0rd1')", []),
    ("a = b\nb = a\npassword = a", []), ("password = password", []), ("", []), (None, []),
]


def test_secret_lexing(spark):
    got = {r["doc_id"]: r for r in secrets.scan_secrets(
        spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LEXED)], "doc_id long, text string")).collect()}
    for i, (text, want) in enumerate(LEXED):
        assert [(text[x["start"]:x["end"]], x["name"]) for x in got[i]["found"]] == want, text
        assert all(secrets.THRESHOLD <= x["score"] <= 1 for x in got[i]["found"])
    assert [x["steps"] for x in got[4]["found"]] == [3]


def test_secret_digest_adds_what_base_spans_do_not_cover(spark):
    docs = spark.createDataFrame([(1, 'password = "abcDEF123456ghi"; db = "me:x"; pwd = "Xk29fj3LLw"')], "doc_id long, text string")
    r = secrets.secret_digest(secrets.scan_secrets(docs)).first()
    assert (r["spans"], r["n_lexed"]) == ("assign:0:27,lexed:50:60", 1) and 0.5 <= r["score"] <= 1


def test_secret_texts_stay_fast():
    import time

    weights = secrets.Weights()
    for text in ("password:password " * 20000, "password=" * 20000, "x = f(" * 20000, "a+" * 50000, '"\\' * 40000, "<a " * 30000):
        start = time.monotonic()
        secrets.base_spans(text), secrets.scored_literals(text, weights)
        assert time.monotonic() - start < 20


# 12 Merkle manifest

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(d, text, lang, source, n):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, source, lang, n, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = list(range(i - i % 3, min(i - i % 3 + 3, len(level))))
        out.append((i % 3, [level[j] for j in run if j != i]))
        i //= 3
    return out


def manifest_rows(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for s in order}
    trees = {s: tree([leaf_of(*r) for r in own[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order]) if order else []
    for k, s in enumerate(order):
        for i, (d, text, *rest) in enumerate(own[s]):
            steps = path(trees[s], i) + path(top, k)
            lost = d is not None and text is not None and zlib.crc32(str(d).encode()) % 2 == 0
            x = leaf_of(d, text.replace("\n", "") if lost else text, *rest)
            for place, others in steps:
                x = digest("".join([*others[:place], x, *others[place:]]))
            yield (d, leaf_of(d, text, *rest), trees[s][-1][0], top[-1][0],
                   digest("".join(h for _, others in steps for h in others)), x, x == top[-1][0])


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_matches_brute_force(spark, hostile, clashing, height):
    if height == 6:
        hostile = clashing  # extra columns take no part
    rows = [tuple(r)[:5] for r in hostile.collect()]
    got = merkle.document_manifest(hostile, height)[1]
    assert Counter(map(tuple, got.collect())) == Counter(manifest_rows(rows))


def test_manifest_of_sources_of_every_size(spark, hostile):
    sizes = [0, 1, 2, 3, 4, 8, 9, 10, 27, 28, 30]
    rows = [(1000 * k + i, f"t\n{i}", None, name, i) for k, (name, n) in enumerate(
        zip([None, "", "é", "z", "Z", "𝄞", "￿", "a", "b", "c", "d"], sizes)) for i in range(n)]
    docs = spark.createDataFrame(rows, hostile.schema).repartition(7)
    assert Counter(map(tuple, merkle.document_manifest(docs, 2)[1].collect())) == Counter(manifest_rows(rows))


def test_manifest_of_nothing(spark, empty):
    manifest, checked = merkle.document_manifest(empty)
    assert manifest.root is None and checked.count() == 0


def test_addresses_split_at_half_height():
    for levels in range(1, 8):
        at = merkle.addresses(levels)
        assert [len(a) for a in at] == [3 ** d for d in range(levels)]
        assert sorted(np.concatenate(at).tolist()) == list(range(merkle.tree_size(levels)))
        top = levels // 2
        if top:  # the top half is one stretch, and so is every bottom subtree
            assert max(max(a) for a in at[:top]) == merkle.tree_size(top) - 1
            below = merkle.tree_size(levels - top)
            last = at[-1].reshape(3 ** top, -1)
            assert all(len({(x - merkle.tree_size(top)) // below for x in part}) == 1 for part in last.tolist())


def test_manifest_shape_is_independent_of_partitions(spark, hostile):
    roots = {merkle.document_manifest(hostile.repartition(n), 3)[0].root for n in (1, 3, 8)}
    assert len(roots) == 1


# 13 hard negatives

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def mined(rows, anchors, k=5, m=10):
    """rows: (vec_id, label, whole vector); plain version."""
    out = []
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    for a, label, v in rows:
        if a not in anchors:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, i, lab in [s for s in scores if s[2] == label][:k]:
            band = [s for s in scores if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:m]
            out += [(a, i, r, j, clip(p), clip(s)) for r, (s, j, _) in enumerate(band, 1)]
    return out


def vectors(seed, n=400, dims=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        base = [rng.choice((-1, 0, 1, 2)) + rng.random() * 0.1 for _ in range(dims)]
        rows.append((i, [float(np.float32(x * rng.choice((0.2, 1, 3)))) for x in base], rng.randrange(4)))
    rows += [(n + i, rows[3][1], i % 3) for i in range(40)]  # one vector many times
    rows += [(n + 50 + i, [0.0] * dims, 1) for i in range(3)] + [(n + 60 + i, [], 2) for i in range(3)] + [(n + 70, [1.0] * 3, 1)]
    return rows


def whole(v):
    return [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]


@pytest.mark.parametrize("seed, sizes", [(1, (2048, 256)), (2, (16, 8))])
def test_hard_negatives_match_brute_force(spark, monkeypatch, seed, sizes):
    monkeypatch.setattr(lemp, "BUCKET_ROWS", sizes[0])
    monkeypatch.setattr(lemp, "PACK_ROWS", sizes[1])
    rows = vectors(seed)
    hostile = [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 6, 1), (903, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1),
               (904, [1.0] * 6, None)]
    df = spark.createDataFrame(rows + hostile + rows[:5], VECTORS).withColumns({"pack": F.lit(1), "score": F.lit(2), "vec": F.lit(3)})
    data = lemp.scaled(df.repartition(5))
    anchors = {r[0] for r in rows if r[0] % 9 == 0} | {403, 404, 451, 460, 470}
    got = lemp.hard_negatives(data, data.filter(F.col("vec_id").isin(*anchors)))
    want = mined([(i, lab, whole(v)) for i, v, lab in rows], anchors)
    assert want and Counter(tuple(int(x) for x in r) for r in got.collect()) == Counter(want)


def test_hard_negatives_of_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(0.5, 1) * 10 ** rng.choice((0, 6, 8, 20, 30)))) for _ in range(4)], i % 2) for i in range(60)]
    data = lemp.scaled(spark.createDataFrame(rows, VECTORS))
    got = lemp.hard_negatives(data, data.filter("vec_id % 10 = 0"), low=0)
    clip = lambda x: max(-lemp.MOST, min(lemp.MOST, x))
    out = []
    for a, v, label in rows:
        if a % 10 == 0:
            scores = sorted(((clip(sum(x * y for x, y in zip(whole(v), whole(w)))), i, lab) for i, w, lab in rows if i != a),
                            key=lambda s: (-s[0], s[1]))
            for p, i, lab in [s for s in scores if s[2] == label][:5]:
                band = [s for s in scores if s[2] != label and 0 <= 100 * s[0] <= 90 * p][:10]
                out += [(a, i, r, j, p, s) for r, (s, j, _) in enumerate(band, 1)]
    assert Counter(tuple(int(x) for x in r) for r in got.collect()) == Counter(out)


def test_hard_negatives_of_nothing(spark):
    none = lemp.scaled(spark.createDataFrame([], VECTORS))
    assert lemp.hard_negatives(none, none).count() == 0


def test_feasible_ranges_lose_nothing():
    rng = np.random.default_rng(7)
    for dims in (1, 2, 8):
        vecs = rng.integers(-300, 300, (200, dims)).astype(float)
        lengths = np.sqrt((vecs ** 2).sum(axis=1))
        unit = vecs / np.where(lengths > 0, lengths, 1)[:, None]
        orders = np.argsort(unit, axis=0).T
        bucket = {"unit": unit, "lengths": lengths, "high": lengths.max(), "orders": orders,
                  "sorted": np.take_along_axis(unit.T, orders, axis=1)}
        left = 0
        for q in rng.integers(-300, 300, (40, dims)).astype(float):
            length = float(np.sqrt((q ** 2).sum()))
            scores = vecs @ q
            for share in (0.1, 0.5, 0.9, 0.999):
                least = share * length * lengths.max()
                at = lemp.feasible(bucket, q / (length or 1.0), least, length)
                assert set(np.flatnonzero(scores >= least).tolist()) <= set(at.tolist()) or least <= 0
                left += len(at)
        assert left < 200 * 40 * 4  # and something is pruned
