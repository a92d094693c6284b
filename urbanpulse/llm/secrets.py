"""Secret scans by assignment-aware lexing.

Source and configuration texts are lexed into names, string literals and
operators, and read as name-literal pairs: assignments, dictionary and JSON
entries, YAML and INI lines, keyword and setter calls, XML elements, command-line
flags and passwords inside URLs.  Constants are propagated: a literal counts for
every name that it reaches through other names, concatenation or interpolation.
Literals are scored by the sensitivity of the names that they reach and by
whether they look like a secret or like a word, a path or a placeholder.

Beside them stand the base patterns, which only match characters.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import slices, table

# Base patterns, the group that is measured and its least length.
# ASCII letters only: with Unicode rules "ſ" and "K" would match s and k.
BASE_PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
LEXED = "lexed"

# How much a part of a name says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "passcode": 0.9, "pass": 0.7, "pw": 0.6,
    "secret": 1.0, "secrets": 0.9, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.7,
    "auth": 0.6, "authorization": 0.8, "bearer": 0.9, "jwt": 0.8, "signature": 0.6, "salt": 0.6, "pin": 0.5,
}
# Sensitive only together, in this order: "api key", "private_key".
SENSITIVE_PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"),
                   ("encryption", "key"), ("account", "key"), ("auth", "key"), ("shared", "key"), ("master", "key"),
                   ("connection", "string")}
# A name that ends in one of these speaks about a secret and doesn't hold one.
ABOUT = {"name", "file", "path", "dir", "url", "uri", "length", "len", "size", "count", "type", "field", "label", "hint",
         "policy", "expiry", "expires", "ttl", "timeout", "prompt", "message", "error", "format", "regex", "pattern",
         "column", "header", "reset", "min", "max", "limit", "required", "enabled", "id", "version", "endpoint"}
PLACEHOLDER = re.compile(r"(?i)^(?:none|null|nil|undefined|true|false|yes|no|changeme|change_me|todo|tbd|test|example|"
                         r"password|passwd|secret|token|default|empty|string|str|int|redacted|hidden)$"
                         r"|^[<{\[(%$].*[>}\])%]$|^(.)\1*$|your[-_ ]|example|placeholder|xxxx|\*\*\*|\.\.\.")
READS = re.compile(r"(?i)env|getpass|input|prompt|read|load|lookup|fetch|config\b|vault")
#: Least score of a reported literal.
THRESHOLD = 0.5

TOKEN = re.compile(
    r'''(?P<string>"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^'\\]|\\.|'(?!''))*\'\'\''''
    r'''|(?<!\w)[fFrRbBuU]{0,2}"(?:[^"\\\n]|\\.)*"|(?<!\w)[fFrRbBuU]{0,2}'(?:[^'\\\n]|\\.)*'|(?<!\w)`[^`\n]*`)'''
    r'''|(?P<url>(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@"'`<>]*:(?P<inner>[^\s/@"'`<>]+)@)'''
    r'''|(?P<xml><(?P<tag>[A-Za-z_][\w.:-]*)(?:\s[^<>]*)?>(?P<body>[^<>\n]+)</(?P=tag)\s*>)'''
    r'''|(?P<flag>(?<![\w-])--?[A-Za-z][\w-]*)'''
    r'''|(?P<ref>\$\{?[A-Za-z_]\w*\}?)'''
    r'''|(?P<name>[A-Za-z_][\w]*(?:[.-][A-Za-z_]\w*)*)'''
    r'''|(?P<op>:=|=>|==|!=|<=|>=|<-|\+=|[?]=|[=:+,;()\[\]{}])'''
    r'''|(?P<line>\n)|(?P<number>[0-9][\w.]*)''', re.DOTALL)
ASSIGNS = {"=", ":=", ":", "=>", "<-", "?=", "+="}
#: A text without any of these holds no pair.
MARKS = re.compile(r"[=:(<]|(?<![\w-])--?[A-Za-z]")
BARE = re.compile(r"""[^\s"'`,;&(){}\[\]<>]+""")
HOLES = re.compile(r"[$#]?\{\s*([A-Za-z_][\w.]*)[^{}]*\}|\$([A-Za-z_]\w*)|%\(([A-Za-z_]\w*)\)s")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass
class Pair:
    """A name and the terms of its value: (start, end) of literals, or names."""
    name: str
    at: int
    terms: list = field(default_factory=list)


def name_parts(name: str) -> list[str]:
    return [p.lower() for p in CAMEL.findall(name)]


class Weights(dict):
    """Memo of the sensitivity of names."""

    def __missing__(self, name: str) -> float:
        if len(self) > 100_000:
            self.clear()
        parts = name_parts(name)
        weight = 0.0
        if parts and parts[-1] not in ABOUT:
            weight = max([SENSITIVE.get(p, 0.0) for p in parts] +
                         [0.95 for pair in zip(parts, parts[1:]) if pair in SENSITIVE_PAIRS])
        self[name] = weight
        return weight


def evidence(value: str, quoted: bool) -> float:
    """0 to 1: how much a literal looks like a secret."""
    n = len(value)
    if n < 6 or (n <= 64 and PLACEHOLDER.search(value)):
        return 0.0
    counts = Counter(value)
    bits = -sum(c * math.log2(c / n) for c in counts.values())
    kinds = (any(c.islower() for c in counts) + any(c.isupper() for c in counts) + any(c.isdigit() for c in counts)
             + any(not c.isalnum() and not c.isspace() for c in counts))
    strength = min(1.0, bits / 40.0)
    if any(c.isspace() for c in counts):
        strength *= 0.3  # a sentence, not a secret
    if kinds < 2:
        strength *= 0.6 if quoted else 0.2
    if value.startswith(("/", "./", "http://", "https://")) and "@" not in value:
        strength *= 0.2
    return strength


def string_inside(token: str) -> tuple[int, int]:
    """Offsets of a string token's content."""
    mark = next(i for i, c in enumerate(token) if c in "\"'`")
    wide = 3 if len(token) - mark >= 6 and token[mark:mark + 3] in ('"""', "'''") else 1
    return mark + wide, len(token) - wide


def name_literal_pairs(text: str) -> list[Pair]:
    """The text's pairs, in order of their place."""
    if not MARKS.search(text):
        return []
    kinds, starts, ends, found = [], [], [], []
    pairs: list[Pair] = []
    for m in TOKEN.finditer(text):
        kind = m.lastgroup
        if m["url"] is not None:
            pairs.append(Pair("url.password", m.start(), [m.span("inner")]))
            continue
        if m["xml"] is not None:
            a, b = m.span("body")
            body = text[a:b]
            a, b = a + len(body) - len(body.lstrip()), b - len(body) + len(body.rstrip())
            pairs.append(Pair(m["tag"], m.start(), [(a, b)]))
            continue
        kinds.append(kind)
        starts.append(m.start())
        ends.append(m.end())
    n = len(kinds)

    def word(i: int) -> str:
        return text[starts[i]:ends[i]]

    def content(i: int) -> tuple[int, int]:
        a, b = string_inside(word(i))
        return starts[i] + a, starts[i] + b

    def literal(i: int) -> list:
        """Terms of a string: itself, and the names in its holes."""
        a, b = content(i)
        names = [x for h in HOLES.findall(text[a:b]) for x in h if x] if "{" in text[a:b] or "$" in text[a:b] or "%(" in text[a:b] else []
        rest = HOLES.sub("", text[a:b]) if names else "x"
        return ([(a, b)] if rest else []) + names

    def value(i: int) -> tuple[list, int]:
        """Terms of the value that begins at token i, and the token after it."""
        terms, more = [], True
        while i < n and more:
            more = False
            if kinds[i] == "string":
                terms += literal(i)
                i += 1
                if i < n and kinds[i] == "string":
                    more = True  # neighbouring strings are one
            elif kinds[i] == "ref":
                terms.append(word(i).strip("${}"))
                i += 1
                more = i < n and kinds[i] in ("string", "ref") and starts[i] == ends[i - 1]
            elif kinds[i] == "name":
                called = i + 1 < n and word(i + 1) == "(" and starts[i + 1] == ends[i]
                if called:
                    reads, i, depth = READS.search(word(i)), i + 2, 1
                    # a keyword's value belongs to the keyword
                    while i < n and depth and word(i) not in ASSIGNS:
                        depth += {"(": 1, ")": -1}.get(word(i), 0)
                        if depth and not reads and kinds[i] == "string":
                            terms += literal(i)
                        elif depth and not reads and kinds[i] in ("name", "ref"):
                            terms.append(word(i).strip("${}"))
                        i += 1
                else:
                    if text[ends[i]:ends[i] + 1] != "[":  # a read of an entry is no constant
                        terms.append(word(i))
                    i += 1
            else:
                break
            if i < n and not more and word(i) == "+":
                i, more = i + 1, True
        return terms, i

    def bare(at: int) -> tuple[int, int] | None:
        """An unquoted value from ``at`` to the next blank or bracket."""
        m = BARE.match(text, at)
        return m.span() if m else None

    taken = 0  # end of the last unquoted literal: operators inside it are characters
    for i in range(n):
        kind = kinds[i]
        if starts[i] < taken:
            continue
        if kind == "op":
            sign = word(i)
            if sign in ASSIGNS and i:
                before, target = kinds[i - 1], None
                gap = text[ends[i - 1]:starts[i]]
                if gap.strip(" \t"):
                    continue
                if before in ("name", "flag", "ref"):
                    target = word(i - 1).strip("-${}")
                elif before == "string":
                    a, b = content(i - 1)
                    target = text[a:b]
                elif before == "op" and word(i - 1) == "]" and i >= 3 and kinds[i - 2] == "string":
                    a, b = content(i - 2)
                    target = text[a:b]
                if not target or "\n" in target:
                    continue
                if sign in ("=", ":=") and i >= 3 and word(i - 2) == ":" and kinds[i - 3] in ("name", "string"):
                    target = word(i - 3).strip("\"'")  # an annotated name: "name: type = value"
                at = ends[i]
                while at < len(text) and text[at] in " \t":
                    at += 1
                j = i + 1
                if j < n and kinds[j] == "string" and starts[j] == at:
                    terms, _ = value(j)
                    pairs.append(Pair(target, starts[i], terms))
                elif (span := bare(at)) is not None:
                    a, b = span
                    exact = j < n and starts[j] == a and ends[j] == b and kinds[j] in ("name", "ref")
                    if exact or (j < n and starts[j] == a and kinds[j] in ("name", "ref")
                                 and (text[ends[j]:ends[j] + 1] in ("(", "[", "+") or kinds[j] == "ref")):
                        terms, _ = value(j)
                        # a bare word is a name where that name is known, and else a literal
                        pairs.append(Pair(target, starts[i], [(a, b, word(j))] if exact and terms == [word(j)] else terms))
                    else:
                        pairs.append(Pair(target, starts[i], [(a, b)]))
                        taken = b
            elif sign == "(" and i and kinds[i - 1] == "name" and i + 1 < n and kinds[i + 1] == "string":
                a, b = content(i + 1)
                if i + 3 < n and word(i + 2) in (",", "=>") and kinds[i + 3] in ("string", "name"):
                    terms, _ = value(i + 3)
                    pairs.append(Pair(text[a:b], starts[i], terms))  # set("name", value)
                elif not READS.search(word(i - 1)):
                    pairs.append(Pair(word(i - 1), starts[i], literal(i + 1)))  # setName("value")
        elif kind == "flag" and word(i).startswith("--") and i + 1 < n and text[ends[i]:starts[i + 1]].strip(" ") == "" \
                and starts[i + 1] > ends[i]:
            if kinds[i + 1] == "string":
                pairs.append(Pair(word(i).strip("-"), starts[i], literal(i + 1)))
            elif kinds[i + 1] in ("name", "number", "ref") and (span := bare(starts[i + 1])):
                name = word(i + 1).strip("${}") if kinds[i + 1] == "ref" else None
                pairs.append(Pair(word(i).strip("-"), starts[i], [name] if name else [span]))
    return _entries(text, sorted(pairs, key=lambda p: p.at))


def _entries(text: str, pairs: list[Pair]) -> list[Pair]:
    """"name: x" directly before "value: y" is one entry: x holds y."""
    for first, second in zip(pairs, pairs[1:]):
        if last_part(second.name) == "value" and last_part(first.name) in ("name", "key") and len(first.terms) == 1 \
                and not isinstance(first.terms[0], str):
            a, b = first.terms[0][:2]
            second.name = text[a:b]
    return pairs


def _name(term) -> str | None:
    """The name that a term is or may be."""
    return term if isinstance(term, str) else term[2] if len(term) == 3 else None


def last_part(name: str) -> str:
    return name.rsplit(".", 1)[-1]


def scored_literals(text: str, weights: dict, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float, int]]:
    """start, end, name, score, steps of each literal that reaches a sensitive
    name with at least ``threshold``: its best name, and how many names lie
    between.  Of several definitions of a name the last before the use counts,
    or else the first after it."""
    pairs = name_literal_pairs(text)
    if not any(weights[p.name] for p in pairs):
        return []
    defined: dict[str, list[int]] = {}
    for k, p in enumerate(pairs):
        defined.setdefault(p.name, []).append(k)
        if last_part(p.name) != p.name:
            defined.setdefault(last_part(p.name), []).append(k)

    def definition(name: str, k: int) -> int | None:
        places = defined.get(name) or defined.get(last_part(name)) or ()
        i = bisect_left(places, k)
        if i:
            return places[i - 1]
        return next((p for p in places[:2] if p != k), None)

    copied: dict[int, tuple[int | None, int]] = {}

    def origin(k: int) -> tuple[int | None, int]:
        """The pair that pair k's value comes from through names that only copy
        one other name, and how many; none in a circle."""
        way, j = [], k
        while j is not None and j not in copied:
            copied[j] = (None, 0)  # until it is known: a circle comes back here
            way.append(j)
            name = _name(pairs[j].terms[0]) if len(pairs[j].terms) == 1 else None
            at = definition(name, j) if name else None
            if at is None:
                copied[j] = (j, 0)
            j = at
        for j, after in zip(reversed(way), [None, *reversed(way)]):
            if copied[j] != (j, 0):
                end, steps = copied[after if after is not None else definition(_name(pairs[j].terms[0]), j)]
                copied[j] = (end, steps + 1)
        return copied[k]

    def literals(k: int) -> list[tuple[int, int, int]]:
        """start, end, steps of the literals that reach pair k."""
        first, steps = origin(k)
        seen, spans, todo = {first}, [], [(first, steps)] if first is not None else []
        while todo:
            j, steps = todo.pop()
            inner = []
            for term in pairs[j].terms:
                name = _name(term)
                at = definition(name, j) if name else None
                if at is not None:
                    at, more = origin(at)
                    if at is not None and at not in seen:
                        seen.add(at)
                        inner.append((at, steps + more + 1))
                elif not isinstance(term, str):
                    spans.append((term[0], term[1], steps))
            todo += reversed(inner)
        return spans

    best: dict[tuple[int, int], tuple[float, int, str]] = {}
    for k, p in enumerate(pairs):
        weight = weights[p.name]
        if not weight:
            continue
        spans = literals(k)
        quoted = any(a and text[a - 1] in "\"'`" for a, _, _ in spans)
        whole = evidence("".join(text[a:b] for a, b, _ in spans), quoted)
        for a, b, steps in spans:
            # a piece may be a secret in a harmless whole (a URL), or harmless in a secret whole
            looks = max(whole, evidence(text[a:b], quoted)) if len(spans) > 1 else whole
            score = weight * (0.35 + 0.65 * looks) if looks else 0.0
            if b > a and score >= threshold:
                best[a, b] = max(best.get((a, b), (0.0, 0, "")), (score, -steps, p.name))
    return [(a, b, name, score, -steps) for (a, b), (score, steps, name) in sorted(best.items())]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the base patterns' places, in order."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(BASE_PATTERNS):
        out += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


_BASE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64()),
                             ("steps", pa.int32())]))
SPANS = ("doc_id {kind}, base array<struct<kind string, start long, end long>>, "
         "found array<struct<start long, end long, name string, score double, steps int>>")


def scan_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the ``base`` patterns' places,
    and the literals ``found`` by lexing: place, best name, score, and the
    number of names between (0: assigned to it itself).  Places are code points.

    Null and empty texts have none.  Repeated rows are scanned one by one, whole
    texts always; other columns are not read.
    """

    def run(batches):
        weights = Weights()
        for batch in batches:
            for part in slices(batch):
                base, found = [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    base.append([{"kind": k, "start": a, "end": b} for a, b, k in base_spans(text)])
                    found.append([{"start": a, "end": b, "name": name, "score": score, "steps": steps}
                                  for a, b, name, score, steps in scored_literals(text, weights, threshold)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(base, _BASE), pa.array(found, _FOUND)],
                                                 names=["doc_id", "base", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, SPANS.format(kind=kind))


def secret_digest(found: DataFrame) -> DataFrame:
    """Per document: number of base places by kind, their digest, and all spans:
    the base ones, and as ``lexed`` the literals that no base span covers.
    ``n_lexed`` counts these, ``score`` is the best literal's score (else 0)."""
    own = F.filter("found", lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    said = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    lexed = F.transform("own", lambda x: F.struct(x["start"].alias("start"), F.lit(len(BASE_PATTERNS)).alias("place"),
                                                  x["end"].alias("end"), F.lit(LEXED).alias("kind")))
    place = F.create_map(*[F.lit(x) for i, (kind, *_) in enumerate(BASE_PATTERNS) for x in (kind, i)])
    ordered = F.transform("base", lambda b: F.struct(b["start"].alias("start"), place[b["kind"]].alias("place"),
                                                     b["end"].alias("end"), b["kind"].alias("kind")))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.withColumn("own", own).select(
        "doc_id", *[count(kind) for kind, *_ in BASE_PATTERNS], F.sha2(said("base"), 256).alias("base_sha256"),
        said(F.array_sort(F.concat(ordered, lexed))).alias("spans"), F.size("own").cast("long").alias("n_lexed"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("score"))


def op11_secret_scans(spark, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))
