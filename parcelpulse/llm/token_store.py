"""Token ids in sorted shards of wavelet matrices.

A shard is one compressed Parquet file whose rows are blocks of about ``BLOCK`` tokens. A block
holds the ids of whole documents in order of doc_id as a wavelet matrix: its distinct ids, and
one plane of bits for each bit of an id's place among them, most significant first, each plane
with running counts of ones. Access, rank, select and counting read planes without decoding the
block; ``read_documents`` decodes all of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import MEMO_WORDS, binary_column, runs_of, whole_text
from parcelpulse.session import staged

BLOCK = 1 << 20
#: Bytes of the rows whose words are numbered together; a longer text comes alone.
RUN_BYTES = 1 << 23
#: Bits between two running counts of a plane.
STRIDE = 512


class WaveletMatrix:
    """Succinct sequence over a small alphabet with access, rank, select and count."""

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray], ones: list[np.ndarray]):
        self.n, self.alphabet, self.planes, self.ones = n, alphabet, planes, ones
        self.zeros = [n - int(o[-1]) for o in ones]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        used = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
        alphabet = np.flatnonzero(used).astype(np.uint32)
        kind = _narrow(len(alphabet))
        current = (np.cumsum(used) - 1).astype(kind)[ids] if len(ids) else np.zeros(0, kind)
        planes, ones = [], []
        for bit in reversed(range(max(1, int(len(alphabet) - 1).bit_length()))):
            is_one = (current & kind(1 << bit)) != 0
            plane = np.packbits(is_one, bitorder="little")
            planes.append(plane)
            ones.append(_running(plane))
            if bit:
                current = np.concatenate([np.compress(~is_one, current), np.compress(is_one, current)])
        return cls(len(ids), alphabet, planes, ones)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7) & 1)

    def _ones_before(self, level: int, i: int) -> int:
        block = i // STRIDE
        part = np.unpackbits(self.planes[level][block * STRIDE // 8 : (i + 7) // 8], bitorder="little")
        return int(self.ones[level][block]) + int(part[: i - block * STRIDE].sum())

    def access(self, i: int) -> int:
        place = 0
        for level in range(len(self.planes)):
            ones, bit = self._ones_before(level, i), self._bit(level, i)
            place = place << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return int(self.alphabet[place])

    def _range(self, token: int, end: int) -> tuple[int, int] | None:
        """Where the token's copies before ``end`` lie behind the last plane."""
        place = int(np.searchsorted(self.alphabet, token))
        if place == len(self.alphabet) or self.alphabet[place] != token:
            return None
        low = 0
        for level in range(len(self.planes)):
            a, b = self._ones_before(level, low), self._ones_before(level, end)
            if place >> (len(self.planes) - 1 - level) & 1:
                low, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, end = low - a, end - b
        return low, end

    def rank(self, token: int, end: int) -> int:
        found = self._range(token, end)
        return found[1] - found[0] if found else 0

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def positions(self, token: int) -> np.ndarray:
        """Select of every occurrence, in order."""
        found = self._range(token, self.n)
        if not found:
            return np.zeros(0, np.int64)
        at, place = np.arange(*found), int(np.searchsorted(self.alphabet, token))
        for level in reversed(range(len(self.planes))):
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            one = place >> (len(self.planes) - 1 - level) & 1
            at = np.flatnonzero(bits)[at - self.zeros[level]] if one else np.flatnonzero(~bits)[at]
        return at

    def select(self, token: int, k: int) -> int:
        return int(self.positions(token)[k])

    def decode(self) -> np.ndarray:
        """All ids, from the last plane upwards."""
        kind = _narrow(len(self.alphabet))
        current = np.zeros(self.n, kind)
        for level in reversed(range(len(self.planes))):
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above, cut = np.empty(self.n, kind), self.zeros[level]
            above[np.flatnonzero(~bits)] = current[:cut]
            above[np.flatnonzero(bits)] = current[cut:] | kind(1 << (len(self.planes) - 1 - level))
            current = above
        return self.alphabet[current]

    def to_row(self) -> dict[str, object]:
        return {
            "alphabet": self.alphabet.astype("<u4").tobytes(),
            "planes": [p.tobytes() for p in self.planes],
            "ones": [o.astype("<u4").tobytes() for o in self.ones],
        }

    @classmethod
    def from_row(cls, n: int, alphabet: bytes, planes: list[bytes], ones: list[bytes]) -> WaveletMatrix:
        return cls(
            n, np.frombuffer(alphabet, "<u4"), [np.frombuffer(p, np.uint8) for p in planes], [np.frombuffer(o, "<u4") for o in ones]
        )


def _narrow(alphabet: int) -> type:
    """The type of an id's place in the alphabet."""
    return np.uint16 if alphabet <= 1 << 16 else np.uint32


def _running(plane: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(plane) // (STRIDE // 8)) * (STRIDE // 8), np.uint8)
    padded[: len(plane)] = plane
    per = np.bitwise_count(padded).reshape(-1, STRIDE // 8).sum(axis=1, dtype=np.uint32)
    return np.r_[np.uint32(0), np.cumsum(per, dtype=np.uint32)]


class WordIds:
    """Ids of whole texts for a vocabulary that drops white space and marks the end of a word.

    Such a vocabulary never looks across white space, so a text's ids are those of its words one
    after another, and the library encodes each word once while the worker remembers it. Words in
    letters go to the library many at a time as one text, whose ids are cut at the marked ends.
    """

    END = "</w>"
    MARKS = b"!#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if len(vocabulary) <= 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.END)]] = True
        self.memo: dict[bytes, bytes] = {}

    def _one_by_one(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.memo.update((w, np.array(e.ids, self.kind).tobytes()) for w, e in zip(words, found, strict=True))

    def _together(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
        ids = np.array(found[0].ids, self.kind)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or (len(ids) and stops[-1] != len(ids)):
            self._one_by_one(words)  # a letter that the library takes for something else
            return
        raw, size = ids.tobytes(), ids.itemsize
        begin = 0
        for word, stop in zip(words, (stops * size).tolist(), strict=True):
            self.memo[word] = raw[begin:stop]
            begin = stop

    def _learn(self, words: list[bytes]) -> None:
        letters, marked, rest = set(), [], []
        for word in words:
            if word.decode().isalpha():
                letters.add(word)
                continue
            core = word.rstrip(self.MARKS)
            if core and len(core) < len(word) and core.decode().isalpha():
                marked.append((word, core, word[len(core) :]))  # marks behind letters are a word of their own
            else:
                rest.append(word)
        letters |= {core for _, core, _ in marked}.difference(self.memo)
        rest += {marks for _, _, marks in marked}.difference(self.memo)
        together = list(letters)
        for run in (together[i : i + 4096] for i in range(0, len(together), 4096)):
            self._together(run)
        for run in (rest[i : i + 4096] for i in range(0, len(rest), 4096)):
            self._one_by_one(run)
        self.memo.update((word, self.memo[core] + self.memo[marks]) for word, core, marks in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. All words of the texts are numbered at once, so that only different ones
        are looked up; the ids of a text are then gathered by the numbers of its words."""
        if len(self.memo) > 4 * MEMO_WORDS:
            self.memo.clear()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))  # at the six ASCII spaces only
        numbered = split.flatten().dictionary_encode()
        different = numbered.dictionary.cast(pa.binary()).to_pylist()
        self._learn([w for w in different if w not in self.memo])
        parts = list(map(self.memo.__getitem__, different))
        ids, codes = np.frombuffer(b"".join(parts), self.kind), numbered.indices.to_numpy(zero_copy_only=False)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.kind).itemsize
        own = sizes[codes]
        ends = np.cumsum(own)
        # the place of each token: where its word's ids begin, and how far into them it is
        shift = (np.cumsum(sizes) - sizes)[codes] - (ends - own)
        gathered = ids[np.repeat(shift, own) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.r_[0, ends][split.offsets.to_numpy() - split.offsets[0].as_py()]
        raw, width = gathered.tobytes(), np.dtype(self.kind).itemsize
        return [raw[a:b] for a, b in zip((bounds[:-1] * width).tolist(), (bounds[1:] * width).tolist(), strict=True)]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _shard_of(column: Column, bounds: list) -> Column:
    """The number of bounds below a value; nulls come first."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.lit(bounds), lambda b: b < column)), F.lit(0))


def write_shards(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str, shards: int, text: str = "text", id_column: str = "doc_id", block: int = BLOCK
) -> None:
    """Encode all rows and write them to ``folder``, one file per shard, in ascending order of doc_id.

    A null text counts as the empty text and has the end id alone. Rows with equal ids stand side
    by side; null ids come first. The texts are not shuffled, only ids: the bounds of the shards
    are quantiles of doc_id. A block ends with the document that reaches ``block`` tokens, so a
    task holds one block and one batch. An empty table gives files without rows.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text).alias("text"))
    steps = [i / shards for i in range(1, shards)]
    bounds = rows.agg(F.percentile_approx("doc_id", steps, 10_000).alias("b")).first().b if steps else None

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        end = np.array([end_id], words.kind).tobytes()

        def made() -> pa.RecordBatch:
            keys, texts = (pa.concat_arrays([b.column(c) for b in held]) for c in range(2))
            ids = [x + end for run in runs_of(texts.to_pylist(), RUN_BYTES) for x in words.encode(run)]
            return pa.RecordBatch.from_arrays([keys, binary_column(ids)], ["doc_id", "ids"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= RUN_BYTES:
                yield made()
                held = []
        if held:
            yield made()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = word_ids(vocabulary).kind
        keys: list = []
        held: list[np.ndarray] = []
        size = nth = shard = 0

        def made() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(held))
            row = {"shard": shard, "block": nth, "n_tokens": size, "doc_ids": keys, "lengths": [len(x) for x in held]} | matrix.to_row()
            return pa.RecordBatch.from_pylist([row], schema)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [("shard", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(batch.schema.field("doc_id").type)),
                     ("lengths", pa.list_(pa.int64())), ("alphabet", pa.binary()), ("planes", pa.list_(pa.binary())), ("ones", pa.list_(pa.binary()))]
                )
            for key, part, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "ids")), strict=True):
                if held and (part != shard or size >= block):
                    yield made()
                    nth = nth + 1 if part == shard else 0
                    keys, held, size = [], [], 0
                shard = part
                keys.append(key)
                held.append(np.frombuffer(ids, kind))
                size += len(held[-1])
        if held:
            yield made()

    ids = rows.mapInArrow(encoded, f"doc_id {kind}, ids binary").withColumn("shard", _shard_of(F.col("doc_id"), bounds or []))
    placed = ids.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    fields = f"shard int, block int, n_tokens long, doc_ids array<{kind}>, lengths array<long>, alphabet binary, planes array<binary>, ones array<binary>"
    placed.mapInArrow(blocks, fields).write.option("compression", "zstd").parquet(folder)


def _with_starts(stored: DataFrame) -> DataFrame:
    """Adds ``before``, the tokens before a block: a running sum in each shard, and one over the shards."""
    totals = stored.select("shard", "block", "n_tokens")
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    shards = shards.select("shard", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("first"))
    blocks = totals.select("shard", "block", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)).alias("inside"))
    starts = blocks.join(shards, "shard").select("shard", "block", (F.col("first") + F.col("inside")).alias("before"))
    return stored.join(staged(starts, "store-starts"), ["shard", "block"])


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix.from_row(row["n_tokens"], row["alphabet"], row["planes"], row["ones"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of every document of the files; ids as 32-bit little-endian bytes."""
    stored = _with_starts(spark.read.parquet(folder))
    kind = dict(stored.dtypes)["doc_ids"][6:-1]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = _matrix(row).decode().astype("<u4").tobytes()
                sizes = np.array(row["lengths"], np.int64)
                ends = np.cumsum(sizes)
                ids = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(row["before"] + ends - sizes), pa.array(sizes), binary_column(ids),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    columns = ["doc_ids", "n_tokens", "lengths", "alphabet", "planes", "ones", "before"]
    return stored.select(*columns).mapInArrow(documents, f"doc_id {kind}, start long, n_tokens long, ids binary, ids_crc32 long")


def find_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(doc_id, place) of every occurrence of an id, by select on the planes; ``place`` counts in the document."""
    stored = spark.read.parquet(folder)
    kind = dict(stored.dtypes)["doc_ids"][6:-1]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                at = _matrix(row).positions(token)
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                doc = np.searchsorted(ends, at, side="right")
                keys = batch.column("doc_ids")[i].values.take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([keys, pa.array(at - (ends[doc] - np.array(row["lengths"])[doc]))], ["doc_id", "place"])

    return stored.select("doc_ids", "n_tokens", "lengths", "alphabet", "planes", "ones").mapInArrow(found, f"doc_id {kind}, place long")


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """One row with ``n``, the occurrences of an id in all files, by rank on the planes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_matrix(r).count(token) for r in batch.to_pylist()], pa.int64())], ["n"])

    stored = spark.read.parquet(folder).select("n_tokens", "alphabet", "planes", "ones")
    return stored.mapInArrow(counted, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
