"""Quality rules from word statistics and from how a public tokenizer takes a text.

Fertility: a text in the words of its language needs few tokens per character, few bytes that
the vocabulary falls back on, and many different tokens. Each measure has a band per language,
else per script of most words, else a default; a text outside of its band is rejected.

A tokenizer takes digits one by one, so a number says nothing about the language around it. Words of
digits and their signs therefore don't count among the characters per token, the bytes and the entropy;
they have a limit of their own, their share of the characters in words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import MEMO_WORDS, runs_of, whole_text

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED = 20


@dataclass(frozen=True)
class Band:
    """Characters per token within two bounds, at most a share of fallback bytes, and at least an
    entropy in bits, which is asked of texts with ``from_tokens`` tokens or more only; all of words
    that are no numbers. Numbers are at most a share ``numbers`` of the characters in words."""

    least: float
    most: float
    byte_share: float
    entropy: float = 2.5
    from_tokens: int = 64
    numbers: float = 0.6


#: By language as the table names it, then by script as Unicode names it (LATIN MARKED, where a fifth of
#: the words or more have letters beyond ASCII), then the default. The bands of languages follow the
#: quantiles of the documents in README; the least characters per token lie above those of random
#: letters, and shares of fallback bytes well below those of a script without pieces.
BANDS = {
    "en": Band(1.7, 7.0, 0.1, 4.5),
    "de": Band(1.7, 7.0, 0.1, 4.5),
    "fr": Band(1.62, 7.0, 0.1, 4.5),
    "es": Band(1.62, 7.0, 0.1, 4.5),
    "LATIN": Band(1.62, 7.0, 0.15, 4.5),
    "LATIN MARKED": Band(0.9, 7.0, 0.15, 4.5),
    "CYRILLIC": Band(1.3, 7.0, 0.15, 4.0),
    "GREEK": Band(0.6, 7.0, 0.15, 3.6),
    "CJK": Band(0.5, 5.0, 0.5, 3.6),
    "HIRAGANA": Band(0.5, 5.0, 0.5, 3.6),
    "KATAKANA": Band(0.5, 5.0, 0.5, 3.6),
    "HANGUL": Band(0.45, 5.0, 0.5, 3.6),
    "": Band(0.5, 7.0, 0.5, 3.6),
}
#: What a word of a number is made of, digits and the signs that go with them.
NUMBER_SIGNS = b"0123456789.,:;+-/%()'$"
DIGITS = frozenset(b"0123456789")
#: Share of words with letters beyond ASCII from which a text in Latin script is marked.
MARKED = 0.2


@lru_cache(maxsize=1 << 16)
def _script(letter: str) -> str:
    return unicodedata.name(letter, "").split(" ")[0] if letter.isalpha() else ""


class Fertility:
    """Token statistics of texts from the tokens of their words, each encoded once while remembered."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.kind = np.dtype(np.uint32)
        self.memo: dict[bytes, bytes] = {}
        self.scripts: dict[bytes, str] = {}
        self.numbers: set[bytes] = set()

    def learn(self, words: set[bytes]) -> None:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
            self.scripts.clear()
            self.numbers.clear()
        new = list(words.difference(self.memo))
        self.numbers.update(filter(is_number, new))
        for at in range(0, len(new), 4096):
            run = [w.decode() for w in new[at : at + 4096]]
            found = self.model.encode(run, num_threads=1)
            self.memo.update((k, np.array(i, self.kind).tobytes()) for k, i in zip(new[at : at + 4096], found, strict=True))
            self.scripts.update((k, next(filter(None, map(_script, w)), "")) for k, w in zip(new[at : at + 4096], run, strict=True))

    def measure(self, words: list[bytes], chars: int) -> tuple[float, float, float, int, str] | None:
        ids = np.frombuffer(b"".join(map(self.memo.__getitem__, words)), self.kind)
        if not len(ids):
            return None
        counts = np.bincount(ids)
        p = counts[counts > 0] / len(ids)
        names: dict[str, int] = {}
        for name in map(self.scripts.__getitem__, words):
            names[name] = names.get(name, 0) + 1
        names.pop("", None)
        script = min(names, key=lambda s: (-names[s], s)) if names else ""
        return chars / len(ids), float(self.is_byte[ids].mean()), float(-(p * np.log2(p)).sum()), len(ids), script


def is_number(word: bytes) -> bool:
    """Digits, and no letters."""
    return not word.strip(NUMBER_SIGNS) and not DIGITS.isdisjoint(word)


@lru_cache(maxsize=2)
def fertility(path: str) -> Fertility:
    return Fertility(path)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more; exact."""
    if len(words) <= size:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    width, windows = 1, ids  # windows: a number for each run of ``width`` words, equal for equal runs
    while width < size:
        step = min(width, size - width)
        right = windows[step:] if step == width else windows[step : step + len(windows) - step]
        # a run of width + step words is its first and its last ``width`` words
        pair = windows[: len(windows) - step] * (int(windows.max()) + 1) + right
        windows = np.unique(pair, return_inverse=True)[1]
        width += step
    twice = np.bincount(windows)[windows] > 1
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + size, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _judge(fertile: Fertility, texts: list[str], langs: list[str | None], bands: dict[str, Band]) -> Iterator[dict]:
    split = [t.encode().split() for t in texts]  # bytes are split at the six ASCII spaces only
    fertile.learn({w for words in split for w in words})
    for text, lang, words in zip(texts, langs, split, strict=True):
        chars = len(text) - sum(map(text.count, SPACES))
        numbers = [w for w in words if w in fertile.numbers]
        letters = [w for w in words if w not in fertile.numbers] if numbers else words
        digits = sum(map(len, numbers))
        repeated = repeated_words(words)
        failed = len(words) < FEWEST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
        found = fertile.measure(letters, chars - digits)
        fits = False
        if found:
            per_token, share, entropy, n, script = found
            band = bands.get(lang or "") if lang else None
            if band is None and script == "LATIN" and sum(not w.isascii() for w in letters) >= MARKED * len(letters):
                band = bands.get("LATIN MARKED")
            band = band or bands.get(script) or bands[""]
            fits = band.least <= per_token <= band.most and share <= band.byte_share
            fits = fits and (n < band.from_tokens or entropy >= band.entropy) and digits <= band.numbers * chars
        yield {
            "n_words": len(words), "word_chars": chars, "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": duplicate_lines(text),
            "n_repeat_words": repeated, "base_failed": failed, "kept": fits and not failed,
            "chars_per_token": found and found[0], "byte_share": found and found[1], "token_entropy": found and found[2],
            "script": found and found[4],
        }


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "chars_per_token double, byte_share double, token_entropy double, script string"
)
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def _judged(batches: Iterator[pa.RecordBatch], path: str, bands: dict[str, Band]) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
    fertile = fertility(path)
    for batch in batches:
        texts, langs = batch.column("text_").to_pylist(), batch.column("lang_").to_pylist()
        out: list[dict] = []
        for run in runs_of(texts):
            out += _judge(fertile, run, langs[len(out) : len(out) + len(run)], bands)
        yield batch, out


def _inputs(docs: DataFrame, text: str, lang: str | None) -> list:
    known = F.col(lang).cast("string") if lang and lang in docs.columns else F.lit(None).cast("string")
    return [whole_text(text).alias("text_"), known.alias("lang_")]


def judge(
    docs: DataFrame, path: str, bands: dict[str, Band] = BANDS, text: str = "text", id_column: str = "doc_id", lang: str | None = "lang"
) -> DataFrame:
    """doc_id with all measures and both verdicts, one row per row of ``docs``.

    A null text has no words and fails. A null or unknown language is judged by its script. Ids
    may be null or repeat; other columns are left out. No shuffle, a batch of rows at a time.
    """
    kind = dict(docs.dtypes)[id_column]
    fields = [c.strip().split(" ") for c in COLUMNS.split(",")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, out in _judged(batches, path, bands):
            values = [pa.array([r[n] for r in out], ARROW[t]) for n, t in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], ["doc_id", *(n for n, _ in fields)])

    rows = docs.select(F.col(id_column).alias("doc_id"), *_inputs(docs, text, lang))
    return rows.mapInArrow(judged, f"doc_id {kind}, {COLUMNS}")


def keep_good(
    docs: DataFrame, path: str, bands: dict[str, Band] = BANDS, text: str = "text", lang: str | None = "lang"
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, out in _judged(batches, path, bands):
            passed = batch.filter(pa.array([r["kept"] for r in out], pa.bool_()))
            row = passed.column("row_")
            yield pa.RecordBatch.from_arrays(row.flatten(), [f.name for f in row.type])

    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row_"), *_inputs(docs, text, lang))
    return rows.mapInArrow(kept, docs.schema)
