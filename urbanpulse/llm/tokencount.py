"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged numpy array of symbol
ids.  In every round each sequence applies its own lowest-rank pair, all
sequences at once; when no pair is left, the surviving symbols are the tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import slices, table

LIMIT = 2048
NO_RANK = np.int64(1 << 40)
_UNICODE_BLANKS = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
_EXTRA_BLANKS = regex.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class MergeTable:
    """Vocabulary and merge ranks of a ``tokenizers`` BPE file whose
    pre-tokens end in a word-end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.size = max(vocab.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        marks = byte_symbols()
        self.inner = np.array([vocab[c] for c in marks], dtype=np.int64)
        self.last = np.array([vocab[c + self.end] for c in marks], dtype=np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split)
        self.path = path

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def pre_tokens(self, piece: str) -> list[bytes]:
        """Pre-tokens of a text without white space (NFC, lower case character
        by character)."""
        piece = unicodedata.normalize("NFC", piece)
        piece = "".join(c.lower() for c in piece) if "Σ" in piece else piece.lower()
        return [x.encode() for x in self.pattern.findall(piece)]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.inner[data]
        ends = np.cumsum(size)
        full = size > 0
        ids[ends[full] - 1] = self.last[data[ends[full] - 1]]
        owner = np.repeat(np.arange(len(words), dtype=np.int64), size)
        counts = size.copy()
        # sequences still merging: ids, owner (ascending)
        while len(ids) > 1:
            pair = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            known = (self.key[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.rank[at], NO_RANK), NO_RANK)
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(ids)))
            hit = (rank == np.repeat(lowest, length)) & (rank < NO_RANK)
            # in a run of overlapping hits (x x x) every second one is applied
            place = np.arange(len(hit))
            run_start = hit & ~np.append(False, hit[:-1])
            first = np.maximum.accumulate(np.where(run_start, place, -1))
            hit &= (place - first) % 2 == 0
            took = np.flatnonzero(hit)
            np.subtract.at(counts, owner[took], 1)
            ids[took] = self.made[at[took]]
            keep = np.ones(len(ids), dtype=bool)
            keep[took + 1] = False
            keep &= np.repeat(lowest < NO_RANK, length)
            ids, owner = ids[keep], owner[keep]
        return counts


@lru_cache(maxsize=2)
def _merge_table(path: str) -> MergeTable:
    return MergeTable(path)


@lru_cache(maxsize=1)
def _unassigned() -> re.Pattern:
    """Code points that Python's Unicode tables don't assign.  The library's may
    be newer, and class, fold or compose them otherwise."""
    odd = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])
    edges = np.flatnonzero(np.diff(odd.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in edges.tolist()) + "]")


def _pieces(text: str, special: regex.Pattern) -> tuple[list[str], int]:
    """White-space pieces of a text, and how many special strings it holds."""
    found = 0
    if "<|" in text:
        parts = special.split(text)
        found = len(parts) - 1
        text = " ".join(parts)
    if _EXTRA_BLANKS.search(text):
        return [p for p in _UNICODE_BLANKS.split(text) if p], found
    return text.split(), found


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row of ``docs`` (doc_id, text).

    ``vocabulary`` is the path of a BPE file that every executor has (default:
    the installed word_bpe_49k.json).  Null and empty texts have no bytes and
    tokens; special strings inside a text count as one token each; repeated
    rows are counted one by one; other columns are not read.  Each slice's
    distinct unseen pieces are merged in one array; a worker remembers a
    bounded number of pieces.  Pieces with code points that Python's Unicode
    tables don't assign are counted by the ``tokenizers`` library itself.
    """

    def run(batches):
        import public_tokenizers

        merges = _merge_table(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
        special = regex.compile("|".join(regex.escape(s) for s in merges.special))
        memo: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                split = [_pieces(t, special) if t else ([], 0) for t in texts]
                if len(memo) > 400_000:
                    memo.clear()
                new = list({p for pieces, _ in split for p in pieces} - memo.keys())
                odd = [p for p in new if not p.isascii() and _unassigned().search(p)]
                if odd:
                    memo.update((p, len(merges.library.encode(p, add_special_tokens=False).ids)) for p in odd)
                    new = [p for p in new if p not in memo]
                if new:
                    pre = [merges.pre_tokens(p) for p in new]
                    words = list({w for p in pre for w in p})
                    tokens = dict(zip(words, merges.count(words).tolist())) if words else {}
                    memo.update((p, sum(map(tokens.__getitem__, w))) for p, w in zip(new, pre))
                look = memo.__getitem__
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "n_bytes": pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    "n_tokens": pa.array([sum(map(look, p)) + s for p, s in split], pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    found = count_tokens(table(spark, sf_dir, "documents"))
    return found.withColumn("over_limit", F.col("n_tokens") > LIMIT)
