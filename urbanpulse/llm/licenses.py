"""License notices: exact phrases, and near matches of short notices.

A near match has at most ``edits`` character errors.  By the pigeonhole
principle, one of edits + 1 parts of the notice then stands in the text without
error: the parts are the exact seeds that locate candidates, and the regex
library's bounded-error matching verifies each candidate's surroundings.  The
words that tell a licence from its neighbours must stand in a match unchanged.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import encoded, slices, table

# Base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short notices searched with errors: words, label, most character errors.
NOTICES = (
    ("under the mit license", "mit", 2),
    ("under the apache license version 2 0", "apache-2", 3),
    ("licensed under cc by nc 4 0", "cc-by-nc", 2),
    ("licensed under cc by sa 4 0", "cc-by-sa", 2),
    ("under the gnu general public license version 3", "gpl-3", 3),
    ("under the gnu general public license version 2", "gpl-2", 3),
    ("under the bsd 3 clause license", "bsd-3", 2),
    ("under the bsd 2 clause license", "bsd-2", 2),
    ("under the bsd 4 clause license", "bsd-4", 2),
    ("under the apache license version 1 1", "apache-1.1", 3),
    ("under the gnu general public license version 1", "gpl-1", 3),
    ("under the gnu lesser general public license version 3", "lgpl-3", 3),
    ("under the gnu lesser general public license version 2 1", "lgpl-2.1", 3),
    ("under the gnu affero general public license version 3", "agpl-3", 3),
    ("licensed under cc by nd 4 0", "cc-by-nd", 2),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", 2),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", 2),
    ("under the mozilla public license", "mpl", 2),
    ("creative commons attribution noncommercial", "cc-by-nc", 3),
    ("creative commons zero public domain dedication", "cc0", 3),
    ("all rights reserved", "all-rights-reserved", 1),
)

# The words that tell a notice from its neighbours.  Errors may stand
# elsewhere; these words must be in the match as they are (one word, one place).
TELLING = {
    "under the mit license": "mit",
    "under the apache license version 2 0": "apache 2",
    "under the apache license version 1 1": "apache 1",
    "licensed under cc by nc 4 0": "by nc",
    "licensed under cc by sa 4 0": "by sa",
    "licensed under cc by nd 4 0": "by nd",
    "licensed under cc by nc sa 4 0": "by nc sa",
    "licensed under cc by nc nd 4 0": "by nc nd",
    "under the gnu general public license version 1": "version 1",
    "under the gnu general public license version 2": "version 2",
    "under the gnu general public license version 3": "version 3",
    "under the gnu lesser general public license version 3": "version 3",
    "under the gnu lesser general public license version 2 1": "version 2 1",
    "under the gnu affero general public license version 3": "version 3",
    "under the bsd 2 clause license": "bsd 2",
    "under the bsd 3 clause license": "bsd 3",
    "under the bsd 4 clause license": "bsd 4",
}

# a word is a run of ASCII letters and digits and of any non-ASCII characters
_WORDS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Notice:
    words: bytes
    label: str
    edits: int

    def seeds(self) -> list[tuple[int, bytes]]:
        """Offset and bytes of the edits + 1 parts, as even as can be."""
        n, k = len(self.words), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]

    def telling(self) -> list[bytes]:
        return TELLING.get(self.words.decode(), "").encode().split()

    def pattern(self):
        return regex.compile(b"(?b)(?:" + regex.escape(self.words) + b"){e<=%d}" % self.edits)


def places(text: bytes, phrase: bytes) -> list[int]:
    """Starts of all places, overlapping ones too."""
    out, at = [], text.find(phrase)
    while at >= 0:
        out.append(at)
        at = text.find(phrase, at + 1)
    return out


def candidate_windows(text: bytes, notice: Notice) -> list[tuple[int, int]]:
    """Surroundings of the seeds, each wide enough for any match around its seed
    with the allowed errors, and too narrow for two matches side by side."""
    return sorted({(max(0, at - off - notice.edits), min(len(text), at - off + len(notice.words) + notice.edits))
                   for off, seed in notice.seeds() for at in places(text, seed)})


def near_matches(text: bytes, notice: Notice, pattern) -> list[tuple[int, int, int]]:
    """start, end, errors of the best match around every seed."""
    found = (pattern.search(text, a, b) for a, b in candidate_windows(text, notice))
    return sorted({(m.start(), m.end(), sum(m.fuzzy_counts)) for m in found if m and m.end() > m.start()})


def tells(text: bytes, start: int, end: int, telling: list[bytes]) -> bool:
    """Whether the words of a match, whole ones, hold the telling words in order."""
    start, stop = text.rfind(b" ", 0, start + 1) + 1, text.find(b" ", end)
    words = iter(text[start:stop if stop >= 0 else len(text)].split())
    return all(word in words for word in telling)


def best_matches(text: bytes, ready) -> list[tuple[Notice, int, int, int]]:
    """Matches of all notices that hold their notice's telling words; of
    overlapping ones the one with the fewest errors (then the longest, then the
    first) stays, so that neighbours such as two versions of one license don't
    both match."""
    found = [(errors, a - b, a, b, i) for i, (n, p) in enumerate(ready) for a, b, errors in near_matches(text, n, p)
             if tells(text, a, b, n.telling())]
    kept: list[tuple[int, int, int, int]] = []  # in order, none overlaps another
    for errors, _, a, b, i in sorted(found):
        at = bisect_left(kept, (a,))
        if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or kept[at][0] >= b):
            kept.insert(at, (a, b, errors, i))
    return [(ready[i][0], a, b, errors) for a, b, errors, i in kept]


def _normal(text: bytes) -> tuple[bytes, int]:
    words = text.translate(_WORDS).split()
    return b" " + b" ".join(words) + b" ", len(words)


SPANS = ("doc_id {kind}, n_words long, base array<struct<label string, word long>>, "
         "near array<struct<label string, word long, n_words long, errors int, score double, words string>>")


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, notices=None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): number of words, exact places
    of the ``base`` phrases (label, start word), and matches of ``notices``
    (label, start word, length in words, errors, score 1 - errors / length,
    matched words).

    Null and empty texts have no words and no places.  Repeated rows are
    scanned one by one, whole texts always; other columns are not read.
    """
    base = [(b" " + p.encode() + b" ", label) for p, label in (BASE_PHRASES if base is None else base).items()]
    notices = [Notice(n.encode(), label, k) for n, label, k in (NOTICES if notices is None else notices)]

    def run(batches):
        ready = [(n, n.pattern()) for n in notices]
        for batch in batches:
            for part in slices(batch):
                sizes, exact, near = [], [], []
                for data in encoded(part):
                    text, n = _normal(data)
                    sizes.append(n)
                    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                    word = lambda at: int(np.searchsorted(blanks, at, "right")) - 1  # noqa: B023, E731
                    exact.append([{"label": label, "word": word(at)} for p, label in base for at in places(text, p)])
                    own = []
                    for notice, a, b, errors in best_matches(text, ready):
                        inside = text[a:b].strip(b" ")
                        a = text.index(inside, a)
                        own.append({"label": notice.label, "word": word(a), "n_words": inside.count(b" ") + 1,
                                    "errors": errors, "score": 1 - errors / len(notice.words),
                                    "words": inside.decode("utf-8", "replace")})
                    near.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()),
                     pa.array(exact, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                     pa.array(near, pa.list_(pa.struct([
                         ("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()), ("errors", pa.int32()),
                         ("score", pa.float64()), ("words", pa.string())])))],
                    names=["doc_id", "n_words", "base", "near"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, SPANS.format(kind=kind))


def license_digest(found: DataFrame) -> DataFrame:
    """Per document: counts, first and last place, labels and best score (1 if
    a base phrase stands in the text, 0 if nothing was found)."""
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "near.label")).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("near.score"), F.lit(0.0))).alias("score"))


def op10_license_scans(spark, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(table(spark, sf_dir, "documents")))
