"""Near-duplicate texts by BagMinHash signatures of word shingles, banding and exact overlap.

A text is the multiset of its shingles of five lower-case words. A signature holds, for each
register, the first point of a Poisson process over (shingle, level) with level up to the
shingle's count. The levels are cut into dyadic ranges (0,1], (1,2], (2,4], ...; each has one
process with a rate as large as the range, whose points draw their level and count only up to the
shingle's count. So a count costs as many processes as it has binary digits, and two registers
are equal with the probability of the weighted Jaccard similarity: common counts over largest
counts. A process ends at its first point behind all registers of its text.

Texts that share a band of registers meet. Where they meet their signatures are compared; pairs
that look near are verified by the overlap of their multisets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import MEMO_WORDS, binary_column, runs_of, whole_text
from parcelpulse.llm.graph import components, groups
from parcelpulse.session import staged

U = np.uint64
GOLDEN, MIX_A, MIX_B = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


@dataclass(frozen=True)
class Plan:
    """Bands of six registers: a pair at 0.8 shares one of the 36 but for one in 56,000.

    ``slack`` is how far below the threshold the share of equal registers may lie for a pair to be
    verified: three standard deviations of that share at 0.8.
    """

    words: int = 5
    threshold: float = 0.8
    bands: int = 36
    rows: int = 6
    slack: float = 0.085
    block: int = 1024
    #: Nearest texts verified for a text where it meets others, in the first round; the second takes all.
    partners: int = 2

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits look random."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


class Shingler:
    def __init__(self, words: int):
        self.words, self.memo = words, {}

    def split(self, text: str) -> list[bytes]:
        return text.lower().encode().split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """One number per run of words; a text with fewer words is one run, no word is none."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        for word in set(words).difference(memo):
            memo[word] = xxhash.xxh64_intdigest(word)
        one = np.fromiter(map(memo.__getitem__, words), U, len(words))
        size = min(self.words, len(one))
        out = np.zeros(len(one) - size + 1 if size else 0, U)
        for i in range(size):
            out = out * MIX_B + mixed(one[i : len(one) - size + 1 + i] + GOLDEN)
        return mixed(out + U(size))

    def counted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.hashes(words), return_counts=True)


def expanded(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset as a sorted set: the k-th copy of a shingle is an element of its own."""
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(np.where(nth == 0, shingles[row], mixed(shingles[row] + nth.astype(U) * GOLDEN)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """A row of registers per bag of (shingles, counts); a bag without shingles has infinite ones."""
    out = np.full((len(bags), registers), np.inf)
    doc = np.repeat(np.arange(len(bags)), [len(s) for s, _ in bags])
    shingle = np.concatenate([s for s, _ in bags]) if bags else np.zeros(0, U)
    count = np.concatenate([c for _, c in bags]) if bags else np.zeros(0, np.int64)
    # one process per dyadic range of levels that begins below the count
    state, of, low, width, most = [], [], [], [], []
    k, here = 0, np.ones(len(count), bool)
    while here.any():
        begin = 0 if k == 0 else 1 << (k - 1)
        here = count > begin
        state.append(mixed(shingle[here] + U(k + 1) * MIX_A))
        of.append(doc[here])
        n = int(here.sum())
        low.append(np.full(n, begin))
        width.append(np.full(n, max(1, begin)))
        most.append(count[here])
        k += 1
    if not state:
        return out
    state, of, low, width, most = (np.concatenate(x) for x in (state, of, low, width, most))
    at, flat, step = np.zeros(len(of)), out.reshape(-1), U(0)
    with np.errstate(over="ignore"):
        while len(of):
            step += U(1)
            drawn = mixed(state + step * GOLDEN)
            at = at - np.log(_uniform(drawn)) / width
            alive = at < out.max(axis=1)[of]
            state, of, low, width, most, at, drawn = (x[alive] for x in (state, of, low, width, most, at, drawn))
            place = mixed(drawn + GOLDEN)
            register = ((place >> U(32)) * U(registers) >> U(32)).astype(np.int64)
            level = low + (_uniform(mixed(place)) * width).astype(np.int64) + 1
            counts = level <= most
            np.minimum.at(flat, of[counts] * registers + register[counts], at[counts])
    return out


def _signed(plan: Plan):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(plan.words)
        for batch in batches:
            keys, bands, prints = [], [], []
            for run in runs_of(batch.column(1).to_pylist()):
                words = [shingler.split(t) for t in run]
                keys += [blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
                with np.errstate(over="ignore"):
                    found = signatures([shingler.counted(w) for w in words], plan.registers).view(U)
                    spread = mixed(found)
                    band = np.zeros((len(run), plan.bands), U)
                    for i in range(plan.rows):
                        band = band * MIX_A + spread[:, i :: plan.rows]
                    band = mixed(band + np.arange(plan.bands, dtype=U) * GOLDEN)
                bands += band.view(np.int64).tolist()
                prints += [x.tobytes() for x in (spread >> U(56)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binary_column(keys), pa.array(bands, pa.list_(pa.int64())), binary_column(prints)],
                ["doc_id", "key", "bands", "prints"],
            )

    return signed


def _look_near(plan: Plan, group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a group the share of equal registers with rows of other classes, 0 where too low.

    A shared byte by chance, one register in 256, is taken out of the share.
    """
    least = plan.threshold - plan.slack
    least = int(np.floor((least + (1 - least) / 256) * plan.registers))
    kinds, block = group["class"].to_numpy(), group["block"].to_numpy()
    prints = np.frombuffer(b"".join(group["prints"].to_pylist()), np.uint8).reshape(group.num_rows, -1)
    apart = group["block_a"][0].as_py() != group["block_b"][0].as_py()
    for i in range(group.num_rows):
        same = (prints[i] == prints).sum(axis=1)
        same[(kinds == kinds[i]) | (same < least)] = 0
        if apart:
            same[block == block[i]] = 0
        yield i, same


def _mixed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for group in groups(batches, 3):
        kinds = group["class"].to_numpy()
        if (kinds != kinds[0]).any():
            yield group


def _nearest(plan: Plan):
    """Pairs worth verifying: each text's nearest of other classes, where it meets them."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _mixed_groups(batches):
            ids = group["node"].to_numpy()
            found = []
            for i, same in _look_near(plan, group):
                hits = np.flatnonzero(same)
                if len(hits) > plan.partners:
                    hits = hits[np.argsort(-same[hits], kind="stable")[: plan.partners]]
                found.append(np.stack([np.minimum(ids[i], ids[hits]), np.maximum(ids[i], ids[hits])], 1))
            both = np.unique(np.concatenate(found), axis=0)
            if len(both):
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return pairs


def _undecided(plan: Plan):
    """The rows of groups that look near to a row of another class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _mixed_groups(batches):
            open_ = [bool(same.any()) for _, same in _look_near(plan, group)]
            if any(open_):
                yield from group.filter(pa.array(open_)).combine_chunks().to_batches()

    return rows


def _settled(plan: Plan):
    """Verifies all pairs of other classes that look near, each where it meets first; yields links that join."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _mixed_groups(batches):
            ids, band = group["node"].to_numpy(), group["band"][0].as_py()
            bands = np.stack([np.asarray(x.values) for x in group["bands"]])
            bags = [np.frombuffer(x.as_buffer(), U) for x in group["bag"]]
            nth = int(np.flatnonzero(bands[0] == band)[0])
            root = list(range(len(ids)))

            def find(x: int) -> int:
                while root[x] != x:
                    x = root[x]
                return x

            out = []
            for i, same in _look_near(plan, group):
                hits = np.flatnonzero(same[i + 1 :]) + i + 1
                hits = hits[~(bands[hits, :nth] == bands[i, :nth]).any(axis=1)] if nth else hits
                for j in hits.tolist():
                    x, y = find(i), find(j)
                    if x != y and _near(bags[i], bags[j], plan.threshold):
                        root[max(x, y)] = min(x, y)
                        out.append((ids[i], ids[j]))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def _near(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Whether two sorted sets of expanded shingles overlap enough."""
    if not len(x) or not len(y) or min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return common > 0 and common >= threshold * (len(x) + len(y) - common) - 1e-9


def _overlap(plan: Plan):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = zip(batch.column(2), batch.column(3), strict=True)
            near = [_near(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), plan.threshold) for x, y in bags]
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return verified


def near_duplicates(docs: DataFrame, plan: Plan = Plan(), text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, class_id, kept), one row per doc_id that is not null: the least id of its class.

    Texts with equal words are one text from the start, so groups of copies cost one signature
    each. Texts are linked if common over largest counts of their shingles reach the threshold,
    and classes are what links connect. A text with fewer words than a shingle equals only its
    copies; texts without words, null or empty, are alone. An id that occurs again has the class of
    all of its texts. Empty tables give no rows.

    Texts that meet in a band are compared in a task by blocks of ``plan.block``. The first round
    verifies each text's nearest ones, which joins nearly all of a class. In the second the texts
    that still look near to one of another class meet again with their shingles, and all such pairs
    are verified in the task, each once; only links that join leave it.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text")).where("doc_id is not null")
    signed = staged(rows.mapInArrow(_signed(plan), "doc_id long, key binary, bands array<long>, prints binary"), "bagminhash")
    reps = signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("prints").alias("prints"))
    # an id with several texts may stand for more than one of them: a text is known by id and words
    reps = staged(reps.withColumn("node", F.xxhash64("rep", "key")), "bagminhash-texts")

    bands = reps.select("node", F.explode("bands").alias("band"))
    full = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = staged(bands.join(full, "band").select("band", "n", "node"), "bagminhash-bands")
    nodes = staged(reps.join(met.select("node").distinct(), "node", "left_semi"), "bagminhash-nodes")
    bags = _bags_of(rows, nodes, plan)

    n_blocks = F.ceil(F.col("n") / plan.block).cast("int")
    dealt = met.select("band", "node", n_blocks.alias("n_blocks"), F.pmod("node", n_blocks).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    order = ["band", "block_a", "block_b"]
    dealt = dealt.select("band", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", "node")

    alone = nodes.select("node", "prints", F.col("node").alias("class"))
    here = dealt.join(alone, "node").select(*order, "block", "node", "class", "prints")
    pairs = here.repartition(*order).sortWithinPartitions(*order).mapInArrow(_nearest(plan), "a long, b long")
    pairs = staged(pairs.distinct(), "bagminhash-pairs")
    first = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    second = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "bag_a", "bag_b")
    links = staged(both.mapInArrow(_overlap(plan), "a long, b long"), "bagminhash-links")

    classed = staged(_classes(nodes, links), "bagminhash-classes")
    here = dealt.join(classed, "node").select(*order, "block", "node", "class", "prints")
    fields = "band long, block_a int, block_b int, block int, node long, class long, prints binary"
    left = here.repartition(*order).sortWithinPartitions(*order).mapInArrow(_undecided(plan), fields)
    left = staged(left, "bagminhash-undecided")
    again = left.join(nodes.select("node", "bands"), "node").join(bags, "node")
    again = again.select(*order, "block", "node", "class", "prints", "bands", "bag")
    more = again.repartition(*order).sortWithinPartitions(*order).mapInArrow(_settled(plan), "a long, b long")
    links = links.unionByName(staged(more, "bagminhash-links"))
    classes = _classes(nodes, links).select("node", "class")
    # classes of texts as links between ids, together with those of equal words
    name = staged(nodes.join(classes, "node").select("rep", "class"), "bagminhash-names")
    least = name.groupBy("class").agg(F.min("rep").alias("least"))
    edges = name.join(least, "class").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    copies = signed.where("key is not null").select("doc_id", "key").join(reps.select("key", "rep"), "key")
    edges = edges.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    of = components(edges)
    ids = rows.select("doc_id").distinct()
    out = ids.join(of.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    class_id = F.coalesce("component", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), (class_id == F.col("doc_id")).alias("kept"))


def _classes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, prints, class) of every text that met another."""
    joined = components(links).withColumnRenamed("id", "node")
    return nodes.select("node", "prints").join(joined, "node", "left").select("node", "prints", F.coalesce("component", "node").alias("class"))


def _bags_of(rows: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """(node, bag) of the texts that met another. Texts and ids are shuffled alike at every size."""
    wanted = nodes.select(F.col("rep").alias("doc_id")).distinct()
    texts = rows.join(wanted.hint("merge"), "doc_id", "left_semi")
    shingled = texts.mapInArrow(_keyed_bags(plan), "rep long, key binary, bag binary")
    bags = shingled.select(F.xxhash64("rep", "key").alias("node"), "bag").join(nodes.select("node"), "node", "left_semi")
    return staged(bags.groupBy("node").agg(F.first("bag").alias("bag")), "bagminhash-bags")


def _keyed_bags(plan: Plan):
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(plan.words)
        with np.errstate(over="ignore"):
            for batch in batches:
                words = [shingler.split(t) for t in batch.column(1).to_pylist()]
                keys = [blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
                found = [expanded(*shingler.counted(w)).tobytes() for w in words]
                yield pa.RecordBatch.from_arrays([batch.column(0), binary_column(keys), binary_column(found)], ["rep", "key", "bag"])

    return bags


def keep_one(docs: DataFrame, plan: Plan = Plan(), text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row of each class of near-duplicates: that of the least id; of repeated rows one stays.

    Unlike texts of one id are documents of their own: rows are then numbered and compared by number. Rows
    with a null id and texts without words stay. An empty table stays empty; other columns stay as they are,
    whatever their names.
    """
    key, names = docs[f"`{id_column}`"].cast("long"), docs.columns
    ids = docs.select(key.alias("id"), F.xxhash64(whole_text(text)).alias("same")).groupBy("id")
    ids = staged(ids.agg(F.count(F.lit(1)).alias("n"), (F.min("same") != F.max("same")).alias("differ")), "bagminhash-ids")
    if not ids.where("id is not null and differ").isEmpty():
        named = _keep_one_by_row(docs.where(key.isNotNull()), plan, text, id_column)
        return named.unionByName(docs.where(key.isNull()))
    found = near_duplicates(docs, plan, text, id_column)
    lost = staged(found.where("not kept").select(F.col("doc_id").alias("lost_")), "bagminhash-lost")
    kept = docs.join(lost, key == lost["lost_"], "left_anti")
    again = staged(ids.where("n > 1 and id is not null").select(F.col("id").alias("again_")), "bagminhash-again")
    if again.isEmpty():
        return kept
    once = kept.join(again, kept[f"`{id_column}`"].cast("long") == again["again_"], "left_anti")
    more = kept.join(again, kept[f"`{id_column}`"].cast("long") == again["again_"], "left_semi").dropDuplicates([id_column])
    return once.unionByName(more).select(*[F.col(f"`{c}`") for c in names])


def _keep_one_by_row(docs: DataFrame, plan: Plan, text: str, id_column: str) -> DataFrame:
    """``keep_one`` for rows that their ids don't tell apart: repeats go first, then rows are numbered."""
    rows = docs.dropDuplicates([id_column, text]).select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = staged(rows.withColumn("nth", F.monotonically_increasing_id()), "bagminhash-rows")
    numbered = rows.select("nth", F.col(f"row.`{id_column}`").cast("long").alias("id"), F.col(f"row.`{text}`").alias("text"))
    classes = near_duplicates(numbered.select("nth", "text"), plan, "text", "nth").select(F.col("doc_id").alias("nth"), "class_id")
    known = classes.join(numbered.select("nth", "id"), "nth")
    best = known.groupBy("class_id").agg(F.min(F.struct("id", "nth")).alias("best"))
    stay = staged(best.select(F.col("best.nth").alias("nth")), "bagminhash-stay")
    return rows.join(stay, "nth", "left_semi").select("row.*")
