"""Exact token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch that the worker has not met before lie one after another in one
numpy array of symbols. Each round finds every sequence's lowest-ranked pair and merges it in
all sequences at once; a sequence without a mergeable pair leaves the rounds. Merging all places
of a pair at once equals merging one after another, since a pair with the new symbol always has
a higher rank. The symbols that survive are the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import MEMO_WORDS, whole_text

#: Symbols merged at once; a longer pre-token comes alone.
RAGGED_SYMBOLS = 1 << 20
NO_RANK = np.int64(1 << 40)


def byte_symbols() -> dict[int, str]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class RaggedMerger:
    """Merges batches of byte strings by a vocabulary's ranks."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        symbols = byte_symbols()
        self.of_byte = np.array([vocabulary[symbols[b]] for b in range(256)], np.int64)
        self.width = np.int64(max(vocabulary.values()) + 1)
        keys = np.array([vocabulary[a] * int(self.width) + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)  # by rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def count(self, words: list[bytes]) -> np.ndarray:
        """The number of tokens of each word; an empty word has none."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols):
            ranks = np.full(len(symbols), NO_RANK)
            same = np.flatnonzero(owner[:-1] == owner[1:])
            ranks[same] = self._rank(symbols[same], symbols[same + 1])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_RANK
            counts[owner[starts[done]]] = lengths[done]
            live = np.repeat(~done, lengths)
            hit = live & (ranks == np.repeat(lowest, lengths))
            hit = _without_overlaps(hit)
            gone = np.r_[False, hit[:-1]]  # the right part of a merged pair
            symbols = np.where(hit, self.made[np.where(hit, ranks, 0)], symbols)
            keep = live & ~gone
            symbols, owner = symbols[keep], owner[keep]
        return counts


def _without_overlaps(hit: np.ndarray) -> np.ndarray:
    """In a run of neighbouring places, every other one from the left: ``aaa`` holds one ``aa``."""
    at = np.flatnonzero(hit)
    if len(at) < 2 or not (np.diff(at) == 1).any():
        return hit
    new_run = np.r_[True, np.diff(at) != 1]
    first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
    out = np.zeros_like(hit)
    out[at[(np.arange(len(at)) - first) % 2 == 0]] = True
    return out


class Counter:
    """Token counts of whole texts as the tokenizers library gives them, special strings included."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in held["model"]["merges"]]
        self.merger = RaggedMerger(held["model"]["vocab"], merges)
        self.pattern = regex.compile(pattern)
        special = [t["content"] for t in held["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.memo: dict[str, int] = {}

    def _pieces(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self.pattern.findall(part)], len(parts) - 1

    def _learn(self, words: list[str]) -> None:
        run, size = [], 0
        for word in [*words, None]:
            if word is None or size > RAGGED_SYMBOLS:
                self.memo.update(zip(run, self.merger.count([w.encode() for w in run]).tolist()))
                run, size = [], 0
            if word is not None:
                run.append(word)
                size += len(word)

    def count(self, texts: list[str]) -> list[int]:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        split = [self._pieces(t) for t in texts]
        new = {w for words, _ in split for w in words}.difference(self.memo)
        if new:
            self._learn(list(new))
        known = self.memo.__getitem__
        return [special + sum(map(known, words)) for words, special in split]


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    """One per worker: the memo of pre-tokens outlives a task."""
    return Counter(path, pattern)


def count_tokens(
    docs: DataFrame, path: str, pattern: str, text: str = "text", id_column: str = "doc_id", limit: int = 512
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, repeated rows and null ids included.

    A null text counts as the empty text: no bytes, no tokens. No shuffle; a batch of rows is held
    at a time, its pre-tokens in runs of about RAGGED_SYMBOLS bytes.
    """
    from parcelpulse.llm.common import runs_of

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [n for run in runs_of(texts) for n in tokens.count(run)]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.int64()), pa.array([n > limit for n in found], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
