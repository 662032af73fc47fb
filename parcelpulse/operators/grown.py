"""Boosted trees grown by tasks that stay up for the whole fit.

Spark's learner starts two stages for every level of every tree, and a round is mostly waiting for them. Here the rows are
binned once, dealt out in blocks to the tasks of one barrier stage, and stay there as one or two bytes per feature, with their
margins. For each level, the tasks add up counts and sums by node, feature and bin, hand each other these sums and find the
same splits from them. A round reads no row from outside, and patience ends the fit on the round that it runs out. Nothing
that is exchanged or held on the driver grows with the rows.

Sums go through small files in the folder that all executors share, each deleted once all have read it: ``allGather`` of a
barrier stage looks for answers once a second only. It is used once, to agree on a folder per attempt of the stage, so a
lost executor costs the fit from its beginning, and no old file is ever read.

The trees are those of Spark's learner: variance gain, ``max_bins`` bins at quantiles, categories in order of their mean, shares
of rows per round and of features per node, a first tree of weight 1. A row is drawn by a hash of its place in the files.
Gradients are summed as whole numbers, so the trees do not depend on how many tasks there are.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark import BarrierTaskContext, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parcelpulse.session import new_folder, shared_folder, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not find this package

#: Points that stand for a feature's values in one partition while split candidates are sought.
POINTS = 8_192
#: Rows of a block, and least rows that are worth a task of their own.
BLOCK_ROWS, TASK_ROWS = 16_384, 25_000
#: Whole numbers that the greatest gradient, weight or loss may become: sums over 2^29 rows are exact.
FINE = 2.0**24

_POINTS = "feature int, value double, weight double"
_BLOCK = "id long, n int, bins binary, label binary, w binary, is_val binary"
_GROWN = (
    "target int, treeID int, loss double, kept int, nodeData struct<id: int, prediction: double, impurity: double, "
    "impurityStats: array<double>, rawCount: long, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


@dataclass(frozen=True)
class Job:
    """What the tasks are told. ``nominal`` has the number of categories of each feature, 0 for numbers; ``classes`` the
    labels that are told from the rest, one model each, and none in a regression."""

    rounds: int
    step: float
    depth: int
    min_rows: int
    feature_share: float
    row_share: float
    seed: int
    patience: int
    nominal: tuple[int, ...]
    thresholds: tuple[np.ndarray, ...]
    classes: tuple[int, ...]
    weighted: bool
    watched: bool
    top_label: float
    top_weight: float

    @property
    def bins(self) -> int:
        return max([2, *[n or len(t) + 1 for n, t in zip(self.nominal, self.thresholds)]])

    @property
    def kind(self) -> type:
        return np.uint8 if self.bins <= 256 else np.uint16


# --- split candidates ----------------------------------------------------------------


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1) if batch.num_rows else values.reshape(0, 0)


def merged(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights; if there are too many, values at equal steps of weight stand for their neighbours."""
    at, place = np.unique(values, return_inverse=True)
    weight = np.bincount(place, weights=weights, minlength=len(at))
    if len(at) <= most:
        return at, weight
    before = np.cumsum(weight) - weight
    group = np.minimum((before * (most / weight.sum())).astype(np.int64), most - 1)
    last = np.flatnonzero(np.append(np.diff(group) > 0, True))
    return at[last], np.add.reduceat(weight, np.append(0, last[:-1] + 1))


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins`` - 1 midpoints between values, as even in weight as the values allow."""
    if len(values) < 2:
        return np.empty(0)
    if len(values) <= bins:
        low = np.arange(len(values) - 1)
    else:
        total = np.cumsum(weights)
        low = np.unique(np.searchsorted(total, total[-1] * np.arange(1, bins) / bins))
        low = low[low < len(values) - 1]
    middle = (values[low] + values[low + 1]) / 2
    return np.unique(np.where(np.isfinite(middle), middle, values[low]))


def _summaries(nominal: tuple[int, ...], most: int):
    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        n, n_val, top, top_w, since = 0, 0, 0.0, 0.0, 0

        def squeeze() -> None:
            for f, parts in held.items():
                held[f] = [merged(np.concatenate([v for v, _ in parts]), np.concatenate([w for _, w in parts]), most)]

        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch), batch.column("w").to_numpy()
            val = batch.column("is_val").to_numpy(zero_copy_only=False)
            n, n_val = n + batch.num_rows, n_val + int(val.sum())
            top = max(top, float(np.abs(batch.column("label").to_numpy()).max()))
            top_w = max(top_w, float(w.max()))
            for f, size in enumerate(nominal):
                if not size and not val.all():
                    held.setdefault(f, []).append((x[~val, f], w[~val]))
            since += batch.num_rows
            if since >= 200_000:
                squeeze()
                since = 0
        squeeze()
        told = [(f, v, w) for f, [(v, w)] in held.items()]
        facts = np.array([n, n_val, top, top_w])
        told.append((-1, np.arange(4.0), facts))
        columns = [np.concatenate([np.full(len(v), f, np.int32) for f, v, _ in told]), np.concatenate([v for _, v, _ in told]), np.concatenate([w for _, _, w in told])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "value", "weight"])

    return points


# --- blocks --------------------------------------------------------------------------


def _binned(job: Job):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nth = [], 0

        def block() -> pa.RecordBatch:
            x, y, w, val = (np.concatenate(p) for p in zip(*held))
            bins = np.empty((len(job.nominal), len(x)), job.kind)
            for f, size in enumerate(job.nominal):
                bins[f] = x[:, f] if size else np.searchsorted(job.thresholds[f], x[:, f], side="left")
            one = [(TaskContext.get().partitionId() << 32) + nth, len(x), bins.tobytes(), y.tobytes(), w.tobytes(), val.tobytes()]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            names = ["id", "n", "bins", "label", "w", "is_val"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((_matrix(batch), batch.column("label").to_numpy(), batch.column("w").to_numpy(), batch.column("is_val").to_numpy(zero_copy_only=False).astype(np.bool_)))
            if sum(len(y) for _, y, _, _ in held) >= BLOCK_ROWS:
                yield block()
                held, nth = [], nth + 1
        if held:
            yield block()

    return blocks


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64: evenly spread bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = 0x9E3779B97F4A7C15


class _Rows:
    """A task's rows: bins by feature, labels, weights, and a key to draw by."""

    def __init__(self, batches: Iterator[pa.RecordBatch], job: Job):
        blocks = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["id"])
        self.n = sum(b["n"] for b in blocks)
        self.bins = np.empty((len(job.nominal), self.n), job.kind)
        self.label, self.w, val, key = np.empty(self.n), np.empty(self.n), np.empty(self.n, np.bool_), np.empty(self.n, np.uint64)
        at = 0
        for b in blocks:
            here = slice(at, at + b["n"])
            self.bins[:, here] = np.frombuffer(b.pop("bins"), job.kind).reshape(len(job.nominal), -1)
            self.label[here], self.w[here], val[here] = np.frombuffer(b["label"]), np.frombuffer(b["w"]), np.frombuffer(b["is_val"], np.bool_)
            key[here] = _mixed(np.arange(b["n"], dtype=np.uint64) + _mixed(np.array([b["id"]], np.uint64)))
            at += b["n"]
        self.train, self.val, self.place = np.flatnonzero(~val), np.flatnonzero(val), np.arange(self.n)
        self.key = key[self.train]

    def drawn(self, job: Job, nth: int) -> np.ndarray:
        """The training rows of a round."""
        if job.row_share >= 1:
            return self.train
        salt = np.uint64(((job.seed + 1) * _GOLDEN + nth * 0xD1B54A32D192ED03) % 2**64)
        return self.train[_mixed(self.key ^ salt) < np.uint64(int(job.row_share * 2.0**64))]


# --- rounds --------------------------------------------------------------------------


def _opened(uri: str) -> tuple[files.FileSystem, str]:
    if uri.startswith("file:"):
        return files.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return files.FileSystem.from_uri(uri)


class Exchange:
    """Sums over the tasks of a stage, by one file per task and sum."""

    def __init__(self, uri: str, me: int, n_tasks: int):
        self.me, self.n_tasks, self.nth = me, n_tasks, 0
        if n_tasks > 1:
            self.store, self.folder = _opened(uri)
            self.store.create_dir(self.folder)

    def _name(self, nth: int, task: int) -> str:
        return f"{self.folder}/{nth}-{task}"

    def _read(self, name: str) -> np.ndarray:
        wait = 0.0002
        while self.store.get_file_info(name).type == files.FileType.NotFound:
            time.sleep(wait)
            wait = min(1.5 * wait, 0.01)
        with self.store.open_input_file(name) as told:
            return np.frombuffer(told.read(), np.int64)

    def added_up(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """The sums of all tasks' arrays of whole numbers, of the same shapes everywhere."""
        flat = np.concatenate([p.ravel() for p in parts])
        if self.n_tasks > 1:
            name = self._name(self.nth, self.me)
            with self.store.open_output_stream(f"{name}.part") as out:
                out.write(flat.tobytes())
            self.store.move(f"{name}.part", name)  # seen as a whole or not at all
            for k in range(1, self.n_tasks):
                flat = flat + self._read(self._name(self.nth, (self.me + k) % self.n_tasks))
            if self.nth:  # who has told this sum has read the one before
                self.store.delete_file(self._name(self.nth - 1, self.me))
            self.nth += 1
        ends = np.cumsum([p.size for p in parts])[:-1]
        return [a.reshape(p.shape) for a, p in zip(np.split(flat, ends), parts)]


class _Tree:
    """Nodes in the order they are made, so children come after their parent; a node that is no parent is its own child."""

    def __init__(self, job: Job):
        most = 2 ** (job.depth + 1)
        self.n, self.feature, self.left, self.right = 1, np.zeros(most, np.int64), np.arange(most), np.arange(most)
        self.goes_left = np.ones((most, job.bins), np.bool_)
        self.count, self.sum, self.weight, self.gain = np.zeros(most, np.int64), np.zeros(most), np.zeros(most), np.full(most, -1.0)

    @property
    def value(self) -> np.ndarray:
        return np.divide(self.sum, self.weight, out=np.zeros(len(self.sum)), where=self.weight > 0)


class _Target:
    """One model in the making: a class against the rest, or the label itself."""

    def __init__(self, job: Job, rows: _Rows, nth: int):
        self.job, self.rows, self.nth = job, rows, nth
        self.binary = bool(job.classes)
        self.y = np.where(rows.label == job.classes[nth], 1.0, -1.0) if self.binary else rows.label
        self.margin = np.zeros(rows.n)
        self.trees: list[_Tree] = []
        self.curve: list[float] = []
        self.best, self.done = 1, False
        most = 4.0 if self.binary else max(8.0 * job.top_label, 1e-12)
        self.scale, self.w_scale = FINE / (most * job.top_weight), FINE / job.top_weight
        self.loss_scale = FINE / (64.0 if self.binary else most * most)

    def begin(self) -> None:
        y, job, rows = self.y, self.job, self.rows
        nth = len(self.trees)
        if nth == 0:
            slope = y
        elif self.binary:
            slope = 4.0 * y / (1.0 + np.exp(np.clip(2.0 * y * self.margin, -700, 700)))
        else:
            slope = 2.0 * (y - self.margin)
        self.slope = np.rint(slope * rows.w * self.scale)
        self.wq = np.rint(rows.w * self.w_scale) if job.weighted else None
        self.sample = rows.drawn(job, nth)
        self.tree = _Tree(job)
        self.at = np.zeros(rows.n, np.int64)
        self.asked, self.open, self.level = np.array([0]), np.array([0]), 0
        self.known: np.ndarray | None = None

    def sums(self) -> np.ndarray:
        """(counts, gradients and weights) by node asked for, feature and bin, of this task's rows."""
        job, rows, bins = self.job, self.rows, self.job.bins
        slot = np.full(len(self.tree.left), -1)
        slot[self.asked] = np.arange(len(self.asked))
        mine = slot[self.at[self.sample]]
        inside = mine >= 0
        here, base = self.sample[inside], mine[inside] * bins
        slope, w = self.slope[here], self.wq[here] if job.weighted else None
        out = np.empty((3 if job.weighted else 2, len(job.nominal), len(self.asked) * bins), np.int64)
        for f in range(len(job.nominal)):
            place = base + rows.bins[f][here]
            out[0, f] = np.bincount(place, minlength=out.shape[2])
            out[1, f] = np.bincount(place, weights=slope, minlength=out.shape[2])
            if job.weighted:
                out[2, f] = np.bincount(place, weights=w, minlength=out.shape[2])
        return out.reshape(out.shape[0], len(job.nominal), len(self.asked), bins)

    def grow(self, sums: np.ndarray) -> bool:
        """Split the open nodes by the sums of all tasks; whether some are open after that."""
        job, tree = self.job, self.tree
        sums = sums.transpose(2, 0, 1, 3)  # by node
        if self.known is not None:  # the other child has what its sibling leaves of the parent
            both = np.empty((2 * len(sums), *sums.shape[1:]), np.int64)
            small = (self.asked != self.open[::2]).astype(np.int64) + 2 * np.arange(len(sums))
            both[small], both[small ^ 1] = sums, self.known - sums
            sums = both
        count, slope = sums[:, 0], sums[:, 1] / self.scale
        weight = sums[:, 2] / self.w_scale if job.weighted else count.astype(float)
        if self.known is None:
            tree.count[0], tree.sum[0], tree.weight[0] = count[0, 0].sum(), slope[0, 0].sum(), weight[0, 0].sum()
        order = np.broadcast_to(np.arange(job.bins), count.shape).copy()
        for f, size in enumerate(job.nominal):
            if size:
                mean = np.divide(slope[:, f], weight[:, f], out=np.full(slope[:, f].shape, np.inf), where=weight[:, f] > 0)
                order[:, f] = np.argsort(mean, axis=1, kind="stable")
        c, g, w = (np.cumsum(np.take_along_axis(a, order, 2), axis=2) for a in (count, slope, weight))
        cr, gr, wr = c[..., -1:] - c, g[..., -1:] - g, w[..., -1:] - w
        fits = (c >= job.min_rows) & (cr >= job.min_rows) & (w > 0) & (wr > 0)
        parts = np.where(fits, g * g / np.where(w > 0, w, 1) + gr * gr / np.where(wr > 0, wr, 1), 0.0)
        total = w[..., -1:]
        gain = parts - np.where(total > 0, g[..., -1:] ** 2 / np.where(total > 0, total, 1), 0.0)
        gain = np.where(fits & (gain > 1e-12 * parts), gain, -1.0)
        n_features = len(job.nominal)
        drawn = int(np.ceil(job.feature_share * n_features))
        if drawn < n_features:
            dice = np.random.default_rng([job.seed, len(self.trees), self.nth, self.level]).random(gain.shape[:2])
            barred = np.argsort(dice, axis=1)[:, drawn:]
            np.put_along_axis(gain, barred[:, :, None], -1.0, axis=1)
        flat = gain.reshape(len(gain), -1)
        best = flat.argmax(axis=1)
        children, asked, parents = [], [], []
        for k, node in enumerate(self.open):
            f, cut = divmod(int(best[k]), job.bins)
            if flat[k, best[k]] <= 0:
                continue
            left, right = tree.n, tree.n + 1
            tree.n += 2
            tree.feature[node], tree.left[node], tree.right[node] = f, left, right
            tree.goes_left[node] = False
            tree.goes_left[node, order[k, f, : cut + 1]] = True
            tree.gain[node] = flat[k, best[k]] / tree.weight[node]
            tree.count[left], tree.sum[left], tree.weight[left] = c[k, f, cut], g[k, f, cut], w[k, f, cut]
            tree.count[right], tree.sum[right], tree.weight[right] = cr[k, f, cut], gr[k, f, cut], wr[k, f, cut]
            children += [left, right]
            asked.append(left if tree.count[left] <= tree.count[right] else right)
            parents.append(k)
        if children:
            here = self.rows.bins.reshape(-1).take(tree.feature[self.at] * self.rows.n + self.rows.place)
            self.at = np.where(tree.goes_left[self.at, here], tree.left[self.at], tree.right[self.at])
        self.level += 1
        self.open, self.asked, self.known = np.array(children, np.int64), np.array(asked, np.int64), sums[parents]
        return bool(children) and self.level < job.depth

    def end(self) -> None:
        """Add the tree to the margins."""
        self.margin += (self.job.step if self.trees else 1.0) * self.tree.value[self.at]
        tree, self.tree = self.tree, None
        n = tree.n
        for name in ("feature", "left", "right", "goes_left", "count", "sum", "weight", "gain"):
            setattr(tree, name, getattr(tree, name)[:n].copy())
        self.trees.append(tree)

    def loss(self) -> np.ndarray:
        """Loss of this task's validation rows."""
        y, margin = self.y[self.rows.val], self.margin[self.rows.val]
        if self.binary:
            signed = 2.0 * y * margin
            loss = 2.0 * (np.maximum(-signed, 0.0) + np.log1p(np.exp(-np.abs(signed))))
        else:
            loss = (y - margin) ** 2
        return np.array([len(y), np.rint(loss * self.loss_scale).sum()], np.float64).astype(np.int64)

    def judge(self, loss: np.ndarray) -> None:
        """Note the validation loss; the model is done when the best round is ``patience`` rounds old."""
        self.curve.append(float(loss[1]) / self.loss_scale / float(loss[0]))
        if self.curve[-1] < self.curve[self.best - 1]:
            self.best = len(self.curve)
        self.done = len(self.curve) - self.best >= self.job.patience

    def told(self) -> Iterator[dict]:
        job, kept = self.job, self.best if self.job.watched else len(self.trees)
        for nth, loss in enumerate(self.curve):
            yield {"target": self.nth, "treeID": nth, "loss": loss, "kept": kept, "nodeData": None}
        for nth, tree in enumerate(self.trees[:kept]):
            value = tree.value
            for i in range(tree.n):
                f, node = int(tree.feature[i]), {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
                inner = tree.left[i] != i
                if inner and job.nominal[f]:
                    node = {"featureIndex": f, "leftCategoriesOrThreshold": np.flatnonzero(tree.goes_left[i, : job.nominal[f]]).astype(float).tolist(), "numCategories": job.nominal[f]}
                elif inner:
                    node = {"featureIndex": f, "leftCategoriesOrThreshold": [float(job.thresholds[f][int(tree.goes_left[i].sum()) - 1])], "numCategories": -1}
                # the sum of squares is not kept, so neither it nor the impurity are known
                yield {"target": self.nth, "treeID": nth, "loss": None, "kept": kept, "nodeData": {
                    "id": i, "prediction": float(value[i]), "impurity": float("nan"), "impurityStats": [float(tree.weight[i]), float(tree.sum[i]), float("nan")],
                    "rawCount": int(tree.count[i]), "gain": float(tree.gain[i]), "leftChild": int(tree.left[i]) if inner else -1,
                    "rightChild": int(tree.right[i]) if inner else -1, "split": node,
                }}


def _grown(job: Job, schema: pa.Schema, shared: str):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        n_tasks = len(context.getTaskInfos())
        attempt = context.allGather(uuid.uuid4().hex)[0] if n_tasks > 1 else ""
        all_tasks = Exchange(f"{shared}/{attempt}", context.partitionId(), n_tasks)
        rows = _Rows(batches, job)
        targets = [_Target(job, rows, k) for k in range(max(1, len(job.classes)))]
        for nth in range(job.rounds):
            active = [t for t in targets if not t.done]
            for t in active:
                t.begin()
            judged = job.watched and nth > 0
            got = all_tasks.added_up([*[t.sums() for t in active], *[t.loss() for t in active if judged]])
            growing = []
            for k, t in enumerate(active):
                if judged:
                    t.judge(got[len(active) + k])
                if not t.done and t.grow(got[k]):
                    growing.append(t)
            active = [t for t in active if not t.done]
            while growing:
                got = all_tasks.added_up([t.sums() for t in growing])
                growing = [t for t, s in zip(growing, got) if t.grow(s)]
            for t in active:
                t.end()
            if not active:
                break
        active = [t for t in targets if not t.done]
        if job.watched and active:
            for t, loss in zip(active, all_tasks.added_up([t.loss() for t in active])):
                t.judge(loss)
        if context.partitionId() == 0:
            held = []
            for row in (r for t in targets for r in t.told()):
                held.append(row)
                if len(held) == BLOCK_ROWS:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return grow


# --- fits ----------------------------------------------------------------------------


def slots(spark: SparkSession) -> int:
    """Tasks that the session can run at one time."""
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def can_grow(spark: SparkSession) -> bool:
    """Barrier stages need executors that stay, and Python has to reach the folder that they share."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true" or slots(spark) < 1:
        return False
    try:
        _opened(_qualified(spark, shared_folder(spark)))
    except (OSError, ValueError, pa.ArrowException):
        return False
    return True


def fit_grown(
    rows: DataFrame, settings, nominal: Sequence[int], max_bins: int = 32, classes: Sequence[int] = (), weighted: bool = False
) -> list[tuple[GBTClassificationModel | GBTRegressionModel, tuple[float, ...]]]:
    """(the best prefix of a boosted fit, validation loss after each round) of (features, label, w, is_val), a model per class.

    ``nominal`` has the number of categories of each feature, 0 for numbers. Weights count in training only. Without
    validation rows all rounds are done and kept, and there is no curve.
    """
    spark = rows.sparkSession
    at_once, nominal = slots(spark), tuple(nominal)
    table = rows.select(vector_to_array("features").alias("x"), "label", "w", "is_val")
    seen = table.coalesce(at_once).mapInArrow(_summaries(nominal, max(POINTS, 8 * max_bins)), _POINTS).toArrow()  # points, no rows
    feature, value, weight = (seen.column(c).to_numpy() for c in ("feature", "value", "weight"))
    facts = {i: weight[(feature == -1) & (value == i)] for i in range(4)}
    n, n_val, top, top_w = int(facts[0].sum()), int(facts[1].sum()), facts[2].max(initial=0.0), facts[3].max(initial=0.0)
    cuts = []
    for f, size in enumerate(nominal):
        mine = feature == f
        cuts.append(np.empty(0) if size else thresholds(*merged(value[mine], weight[mine], sys.maxsize), max_bins))
    job = Job(
        settings.rounds, settings.step, settings.depth, settings.min_rows, settings.feature_share, settings.row_share, settings.seed,
        settings.patience, nominal, tuple(cuts), tuple(classes), weighted, n_val > 0, float(top), float(top_w) or 1.0,
    )
    tasks = max(1, min(at_once, -(-n // TASK_ROWS)))
    blocks = table.mapInArrow(_binned(job), _BLOCK).repartition(tasks)
    schema = to_arrow_schema(StructType.fromDDL(_GROWN))
    grown = staged(blocks.mapInArrow(_grown(job, schema, _qualified(spark, new_folder(spark, "sums"))), _GROWN, barrier=True), "trees")
    kept = {r.target: r.kept for r in grown.groupBy("target").agg(F.max("kept").alias("kept")).collect()}
    curves = grown.where("loss is not null").select("target", "treeID", "loss").orderBy("target", "treeID").collect()  # a number a round
    kind = GBTClassificationModel if classes else GBTRegressionModel
    out = []
    for k in range(max(1, len(classes))):
        nodes = grown.where((F.col("target") == k) & F.col("nodeData").isNotNull()).select("treeID", "nodeData")
        model = _loaded(spark, kind, nodes, kept[k], len(nominal), settings.step)
        out.append((model, tuple(r.loss for r in curves if r.target == k)))
    return out


def _loaded(spark: SparkSession, kind: type, nodes: DataFrame, n_trees: int, n_features: int, step: float):
    """Spark's model of these nodes, through the files that Spark saves models in."""
    folder = new_folder(spark, "grown")

    def about(name: str, **more) -> str:
        named = {"class": f"org.apache.spark.ml.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": f"grown-{uuid.uuid4().hex[:12]}"}
        return json.dumps({**named, "paramMap": {}, "defaultParamMap": {"impurity": "variance"}, **more})

    of = "classification" if kind is GBTClassificationModel else "regression"
    whole = about(f"{of}.{kind.__name__}", numFeatures=n_features, numTrees=n_trees)
    trees = [(i, about("regression.DecisionTreeRegressionModel"), step if i else 1.0) for i in range(n_trees)]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
    nodes.write.parquet(f"{folder}/data")
    return kind.load(folder)
