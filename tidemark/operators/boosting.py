"""Boosted trees on Spark: second-order and leaf-wise growers over distributed gradient histograms.

Rows are binned once and packed into stored blocks of at most ``BLOCK`` rows.  A pass is one job: each task
brings the predictions of its blocks up to date and adds up gradients and counts by (leaf, feature, bin); what
comes back has ``leaves x features x bins`` cells, whatever the number of rows.  Of two new leaves
only the smaller is counted, the other is their parent minus it.

``newton``
    Level by level to ``depth``.  A leaf with gradient sum G over n rows gets the weight ``-G / (n + l2)``, and a split
    the gain ``(Gl^2 / (nl + l2) + Gr^2 / (nr + l2) - G^2 / (n + l2)) / 2`` (squared error, so the second derivative is 1).
``leaves``
    The same, but the leaf with the largest gain in the queue is split next, until there are ``leaves`` of
    them.  A leaf that is not among as many best ones as may still be split can never be reached, so one pass counts for all
    that can, and the order is settled on the driver.

Gradients are whole numbers (multiples of some ``2 ** -35`` of the largest label), so sums do not depend
on how rows are dealt out: the same rows give the same trees.  Rows and features are drawn per tree, rows by a
hash of their key.  Predictions live in the Python workers only as a memo: a task that does not find them
computes them from the trees that come with the pass, so a lost executor costs time alone.

Several models that learn from the same blocks grow in step, one pass for all of them.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.lineage import stored
from ..functions.long_series import from_end
from ..functions.series import KEY, business_days
from .features import FEATURES, LAGS, WINDOWS
from .trees import relative

#: Rows in a block, and bytes of predictions that a worker remembers.
BLOCK, MEMO = 1 << 16, 256 << 20
#: What trees see of a row: the features and where the series' name falls among 251 numbers.
INPUTS = [*FEATURES, "ticker_hash"]


@dataclass(frozen=True)
class Settings:
    """Of one model; ``leaves`` None grows level by level, ``held`` also learns from rows marked as held out."""

    rounds: int = 300
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    least_rows: int = 1
    leaves: int | None = None
    seed: int = 42
    held: bool = True


# The settings of the two learners.
KINDS = {"gbt": Settings(), "leafwise": Settings(l2=0.0, least_rows=20, leaves=31)}
BINS = 255


@dataclass
class Trees:
    """A fitted model as flat arrays, one row per tree, one column per node; node 0 is the root.

    ``feature`` is -1 at a leaf; a row goes to ``left`` if its value is at most edge ``bin`` of the feature, to the node after it
    if not.  ``value`` holds leaf weights times the rate, ``gain`` those of the splits.
    """

    base: float
    edges: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    inputs: list[str] = field(default_factory=lambda: INPUTS)

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def nodes(self, bins: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row in one tree."""
        return _leaves(bins, self.feature[tree], self.bin[tree], self.left[tree])

    def add(self, bins: np.ndarray, to: np.ndarray, first: int, end: int) -> None:
        """Add the values of trees ``first`` to ``end`` to ``to``."""
        for t in range(first, end):
            to += self.value[t][self.nodes(bins, t)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        self.add(self.bins_of(x), out, 0, len(self.feature))
        return out

    def part(self, end: int) -> Trees:
        return Trees(self.base, [], self.feature[:end], self.bin[:end], self.left[:end], self.value[:end], self.gain[:0])

    def importances(self) -> dict[str, float]:
        """Share of each input in the gain of all splits."""
        sums = np.zeros(len(self.inputs))
        np.add.at(sums, self.feature[self.feature >= 0], self.gain[self.feature >= 0])
        return dict(zip(self.inputs, (sums / (sums.sum() or 1.0)).tolist(), strict=True))

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.feature, self.bin, self.left, self.value, self.gain, *self.edges))


def _leaves(bins: np.ndarray, feature: np.ndarray, bin_: np.ndarray, left: np.ndarray) -> np.ndarray:
    node, every = np.zeros(len(bins), np.int32), np.arange(len(bins))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        over = bins[every, np.maximum(f, 0)] > bin_[node]
        node = np.where(inner, left[node] + over, node)


def _mix(x: np.ndarray) -> np.ndarray:
    """A hash of unsigned 64-bit numbers (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree learns from."""
    salt = _mix(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    return (_mix(key ^ salt) >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


# --- blocks ---


def inputs(rows: DataFrame) -> DataFrame:
    """The relative features with the series' number."""
    return relative(rows).withColumn("ticker_hash", F.pmod(F.xxhash64(KEY), F.lit(251)).cast("double"))


def edges_of(rows: DataFrame, names: list[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` edges of each column: its values if they are few, quantiles if not."""
    shares = ", ".join(str((i + 1) / bins) for i in range(bins - 1))
    few = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    exact = [c for c in names if few[c] < bins // 2]
    cut = rows.agg(
        *[F.expr(f"array_sort(collect_set(`{c}`))").alias(c) if c in exact else F.expr(f"percentile_approx(`{c}`, array({shares}), 20000)").alias(c) for c in names]
    ).first()
    out = [np.unique(np.array(cut[c] or [], float)) for c in names]
    # beyond the last edge there must be something
    return [e[:-1] if c in exact else e for e, c in zip(out, names, strict=True)]


@dataclass
class Blocks:
    """Binned rows, stored: ``bins, label, key, held`` as bytes."""

    frame: DataFrame
    edges: list[np.ndarray]
    inputs: list[str]
    rows: int

    def parts(self):
        """Blocks as arrays, one task for every few of them."""
        width = len(self.inputs)

        def read(row):
            return row.id, np.frombuffer(row.bins, np.uint8).reshape(-1, width), np.frombuffer(row.label), np.frombuffer(row.key, np.uint64), np.frombuffer(row.held, np.uint8)

        few = max(1, min(self.frame.rdd.getNumPartitions(), -(-self.rows // BLOCK)))
        return self.frame.rdd.coalesce(few).map(read)


def blocks(rows: DataFrame, names: list[str], label: str, key: list[str], held: str | None = None, bins: int = BINS) -> Blocks:
    """Bin stored rows; ``key`` names a row for the drawing, ``held`` a column that marks held-out rows.  Rows without a label are left out."""
    rows = rows.where(F.col(label).isNotNull() & ~F.isnan(label))
    n = rows.count()
    edges = edges_of(rows, names, bins)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            parts = [np.concatenate(a).tobytes() for a in zip(*waiting, strict=True)]
            waiting.clear()
            return pa.RecordBatch.from_pydict({"id": [uuid.uuid4().hex], **{c: pa.array([p], pa.binary()) for c, p in zip(("bins", "label", "key", "held"), parts, strict=True)}})

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                columns = [np.nan_to_num(part.column(j).to_numpy(zero_copy_only=False).astype(float)) for j in range(len(names))]
                bins_ = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, columns, strict=True)]).astype(np.uint8)
                rest = [part.column(len(names) + i).to_numpy(zero_copy_only=False) for i in range(3)]
                if sum(len(w[1]) for w in waiting) + part.num_rows > BLOCK:
                    yield flush()
                waiting.append((bins_, rest[0].astype(float), rest[1].astype(np.int64).view(np.uint64), rest[2].astype(np.uint8)))
        if waiting:
            yield flush()

    marked = F.coalesce(F.col(held).cast("int"), F.lit(0)) if held else F.lit(0)
    flat = rows.select(*[F.col(c).cast("double") for c in names], F.col(label).cast("double").alias("_label"), F.xxhash64(*key).alias("_key"), marked.alias("_held"))
    few = max(1, min(rows.rdd.getNumPartitions(), -(-n // BLOCK)))
    packed = flat.coalesce(few).mapInArrow(run, "id string, bins binary, label binary, key binary, held binary")
    return Blocks(stored(packed, "tree-blocks"), edges, names, n)


# --- passes ---

_memo: OrderedDict[tuple, list] = OrderedDict()


def _brought_up(run: str, model: int, block: str, bins: np.ndarray, trees: Trees) -> np.ndarray:
    """Predictions of a block by all finished trees; a worker remembers them from pass to pass."""
    kept = _memo.pop((run, model, block), None)
    if kept is None or kept[0] > len(trees.feature):
        kept = [0, np.full(len(bins), trees.base)]
    trees.add(bins, kept[1], kept[0], len(trees.feature))
    kept[0] = len(trees.feature)
    _memo[run, model, block] = kept
    while len(_memo) > 1 and sum(v[1].nbytes for v in _memo.values()) > MEMO:
        _memo.popitem(last=False)
    return kept[1]


@dataclass
class _Growing:
    """The tree of one model that is being grown, as lists of nodes."""

    settings: Settings
    trees: Trees
    columns: np.ndarray
    scale: float
    feature: list[int]
    bin: list[int]
    left: list[int]
    value: list[float]
    gain: list[float]
    depth: list[int]
    count: list[int]  # nodes whose histogram the next pass adds up
    hist: dict[int, np.ndarray]
    best: dict[int, tuple[float, int, int]]
    pairs: list[tuple[int, int, int]]  # parent, counted child, its sibling

    def ask(self, model: int) -> tuple:
        """What a task needs to know."""
        s = self.settings
        now = tuple(np.array(a, d) for a, d in ((self.feature, np.int16), (self.bin, np.uint8), (self.left, np.int32)))
        return model, self.trees, now, self.count, s, self.scale


def _weight(g: float, n: float, s: Settings) -> float:
    return -g / (n + s.l2) if n + s.l2 else 0.0


def best_split(hist: np.ndarray, columns: np.ndarray, s: Settings, scale: float) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of a leaf, the first one on ties; gain 0 if there is none.  ``hist``: features x bins x (gradient, rows)."""
    g, n = (hist[columns, :, i].astype(float) for i in (0, 1))
    left_g, left_n = np.cumsum(g, axis=1) / scale, np.cumsum(n, axis=1)
    all_g, all_n = left_g[:, -1:], left_n[:, -1:]
    right_g, right_n = all_g - left_g, all_n - left_n
    least = max(s.least_rows, 1)
    ok = (left_n >= least) & (right_n >= least)
    score = lambda a, b: np.divide(a * a, b + s.l2, out=np.zeros_like(a), where=b + s.l2 > 0)
    whole = score(all_g, all_n)
    gain = np.where(ok, (score(left_g, left_n) + score(right_g, right_n) - whole) / 2, 0.0)
    gain[gain <= 1e-12 * whole] = 0.0
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    return float(gain[f, b]), int(columns[f]), b


def fit(blocks: Blocks, models: list[Settings], bins: int = BINS) -> list[Trees]:
    """Grow all models in step.

    A pass is a job over all blocks.  Rows that fill no more than one block have nothing to be added up across tasks, so all
    passes then run beside that block, by the same code and to the same trees.
    """
    run, names = uuid.uuid4().hex, blocks.inputs
    if not blocks.rows:
        fitted = _grown(lambda f: f(iter(())), len(names), models, bins, run)
    elif blocks.rows <= BLOCK:

        def beside(it) -> list[list[Trees]]:
            held = list(it)
            return [_grown(lambda f: f(iter(held)), len(names), models, bins, run)]

        fitted = blocks.parts().coalesce(1).mapPartitions(beside).collect()[0]
    else:
        parts = blocks.parts().cache()  # lost parts are read again from the stored blocks
        fitted = _grown(lambda f: parts.mapPartitions(lambda it: [f(it)]).treeReduce(lambda a, b: a + b, depth=2), len(names), models, bins, run)
        parts.unpersist()
    return [replace(t, edges=blocks.edges, inputs=names) for t in fitted]


def _sums(it) -> np.ndarray:
    """Sum of labels, rows, and largest label as a count of powers of two, of rows not held out and of held-out ones."""
    out = np.zeros((2, 2 + 4096))
    for _, _, y, _, held in it:
        for k in (0, 1):
            mine = y[held == k]
            out[k, :2] += (mine.sum(), len(mine))
            if top := np.abs(mine).max(initial=0.0):
                out[k, 2 + 2048 + int(np.frexp(top)[1])] += 1
    return out


def _grown(total, width: int, models: list[Settings], bins: int, run: str) -> list[Trees]:
    """The growing itself; ``total`` applies a function to every part of the blocks and adds up what it gives."""
    sums = total(_sums)

    def start(s: Settings) -> tuple[Trees, float]:
        own = sums[0] + (sums[1] if s.held else 0)
        most = 2 * min(s.leaves or 1 << s.depth, 1 << s.depth) - 1
        flat = lambda d, v=0: np.full((s.rounds, most), v, d)
        trees = Trees(float(own[0] / own[1]) if own[1] else 0.0, [], flat(np.int16, -1), flat(np.uint8), flat(np.int32), flat(float), flat(float))
        # a power of two, so that 2 ** 16 gradients of a block add up without rounding
        top = np.flatnonzero(own[2:])
        return trees, 2.0 ** (35 - int(top[-1] - 2048 if len(top) else 0))

    fitted, scale = zip(*map(start, models), strict=True) if models else ((), ())

    def histograms(asks: list[tuple]) -> np.ndarray:
        def count(it) -> np.ndarray:
            outs = [np.zeros((len(nodes) * width * bins, 2), np.int64) for _, _, _, nodes, _, _ in asks]
            for block, x, y, key, held in it:
                offset = np.arange(width, dtype=np.int64) * bins + x
                for out, (model, trees, now, nodes, s, by) in zip(outs, asks, strict=True):
                    mine = drawn(key, s.seed, len(trees.feature), s.rows)
                    if not s.held:
                        mine &= held == 0
                    slot = np.full(len(now[0]), -1)
                    slot[nodes] = np.arange(len(nodes))
                    slot = slot[_leaves(x, *now)]
                    at = np.flatnonzero(mine & (slot >= 0))
                    gradient = np.rint((_brought_up(run, model, block, x, trees)[at] - y[at]) * by)
                    cell = (slot[at, None] * (width * bins) + offset[at]).ravel()
                    size = len(out)
                    out[:, 0] += np.bincount(cell, np.repeat(gradient, width), size).astype(np.int64)
                    out[:, 1] += np.bincount(cell, minlength=size)
            return np.concatenate(outs)

        return total(count)

    for tree in range(max((s.rounds for s in models), default=0)):
        growing = []
        for m, s in enumerate(models):
            if tree >= s.rounds:
                continue
            rng = np.random.default_rng([s.seed, tree])
            columns = np.sort(rng.permutation(width)[: max(1, round(s.columns * width))])
            growing.append((m, _Growing(s, fitted[m].part(tree), columns, scale[m], [-1], [0], [0], [0.0], [0.0], [0], [0], {}, {}, [])))
        while active := [(m, g) for m, g in growing if g.count]:
            found = histograms([g.ask(m) for m, g in active]).reshape(-1, width, bins, 2)
            for _, g in active:
                mine, found = found[: len(g.count)], found[len(g.count) :]
                _grow(g, mine)
        for m, g in growing:
            _finish(g)
            t, k = fitted[m], len(g.feature)
            for into, values in ((t.feature, g.feature), (t.bin, g.bin), (t.left, g.left), (t.value, g.value), (t.gain, g.gain)):
                into[tree, :k] = values
    return list(fitted)


def _grow(g: _Growing, found: np.ndarray) -> None:
    """Take in the counted histograms, split what can be split, and say what to count next."""
    s = g.settings
    for node, hist in zip(g.count, found, strict=True):
        g.hist[node] = hist
    for parent, counted, sibling in g.pairs:
        g.hist[sibling] = g.hist[parent] - g.hist[counted]
        del g.hist[parent]
    g.count, g.pairs = [], []
    for node, hist in g.hist.items():
        if node not in g.best:
            total = hist[0].sum(axis=0)
            g.value[node] = s.rate * _weight(total[0] / g.scale, float(total[1]), s)
            g.best[node] = best_split(hist, g.columns, s, g.scale) if g.depth[node] < s.depth else (0.0, 0, 0)
    ready, _ = _best_first(g)
    for node in ready:
        gain, f, b = g.best[node]
        at = len(g.feature)
        g.feature[node], g.bin[node], g.left[node], g.gain[node] = f, b, at, gain
        for values, v in ((g.feature, -1), (g.bin, 0), (g.left, 0), (g.value, 0.0), (g.gain, 0.0), (g.depth, g.depth[node] + 1)):
            values += [v, v]
        hist = g.hist[node]
        rows = hist[f, :, 1]
        small = at if 2 * rows[: b + 1].sum() <= rows.sum() else at + 1
        sums = hist[f, : b + 1].sum(axis=0), hist[f, b + 1 :].sum(axis=0)
        if g.depth[at] >= s.depth:  # children at the last level need their sums only
            for child, (total, n) in zip((at, at + 1), sums, strict=True):
                g.value[child] = s.rate * _weight(total / g.scale, float(n), s)
            del g.hist[node]
        else:
            g.count.append(small)
            g.pairs.append((node, small, 2 * at + 1 - small))


def _best_first(g: _Growing) -> tuple[list[int], list[int]]:
    """Leaves that best-first growth may come to split, and the other leaves it ends with.

    A leaf that is not split yet is passed over as if its children had nothing to gain; they can only take
    splits from others, so whatever real growth reaches is among those found.
    """
    leaves, queue, wanted = 1, [0], []
    while queue and leaves < (g.settings.leaves or len(g.feature) + 1):
        top = max(queue, key=lambda n: (g.best.get(n, (0.0,))[0], -n))
        if g.best.get(top, (0.0,))[0] <= 0:
            break
        queue.remove(top)
        leaves += 1
        if g.feature[top] >= 0:
            queue += [g.left[top], g.left[top] + 1]
        else:
            wanted.append(top)
    return wanted, queue


def _finish(g: _Growing) -> None:
    """Best-first growth keeps the splits that the queue reaches, and numbers the nodes that are left anew."""
    if g.settings.leaves is None:
        return
    keep = set(_best_first(g)[1])
    feature, bin_, left, value, gain, todo = [-1], [0], [0], [0.0], [0.0], [(0, 0)]
    while todo:
        old, new = todo.pop(0)
        value[new] = g.value[old]
        if old in keep or g.feature[old] < 0:
            continue
        feature[new], bin_[new], left[new], gain[new] = g.feature[old], g.bin[old], len(feature), g.gain[old]
        for values, v in ((feature, -1), (bin_, 0), (left, 0), (value, 0.0), (gain, 0.0)):
            values += [v, v]
        todo += [(g.left[old], left[new]), (g.left[old] + 1, left[new] + 1)]
    g.feature, g.bin, g.left, g.value, g.gain = feature, bin_, left, value, gain


# --- models over the feature matrix ---


def learn(matrix: DataFrame, wanted: dict[str, Settings], held: int = 30) -> dict[str, Trees]:
    """Fit models on stored rows of the feature matrix; the last ``held`` rows of a series are seen only by those with ``held``."""
    marked = from_end(matrix, held, time="ds").withColumn("_held", F.col("_back").isNotNull()).drop("_back")
    rows = stored(inputs(marked).select(KEY, "ds", *INPUTS, "label", "_held"), "tree-rows")
    fitted = fit(blocks(rows, INPUTS, "label", [KEY, "ds"], "_held"), list(wanted.values()))
    return dict(zip(wanted, fitted, strict=True))


def predict(models: dict[str, Trees], rows: DataFrame) -> DataFrame:
    """``rows`` with each model's prediction of the next close under its name."""
    names = rows.columns
    kept = inputs(rows.withColumns({f"_keep{i}": F.col(c) for i, c in enumerate(names)}))
    flat = kept.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(names)], F.col("_keep%d" % names.index("close")).cast("double").alias("_close"), *[F.col(c).alias(f"_in{j}") for j, c in enumerate(INPUTS)])
    # rounds x nodes numbers a model: some hundred kilobytes, whatever the data
    shared = rows.sparkSession.sparkContext.broadcast(list(models.values()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(names)
            x = np.column_stack([batch.column(k + 1 + j).to_numpy(zero_copy_only=False) for j in range(len(INPUTS))])
            close = batch.column(k).to_numpy(zero_copy_only=False)
            found = [pa.array(close * (1 + trees.predict(x)), from_pandas=True) for trees in shared.value]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *found], [*names, *models])

    return flat.mapInArrow(run, StructType([*rows.schema, *[StructField(name, DoubleType()) for name in models]]))


def holdout(models: dict[str, Trees], matrix: DataFrame, n: int = 30) -> DataFrame:
    """One-step predictions for the last n rows of each series: ``ticker, ds, previous, actual`` and a column per model.

    The models must not have seen these rows; ``ds`` is the day that is predicted, ``previous`` the close before it.
    """
    last = from_end(matrix, n, time="ds").where("_back is not null")
    out = predict(models, last)
    return out.select(KEY, F.col("target_day").alias("ds"), F.col("close").alias("previous"), F.col("target_next_close").alias("actual"), *models)


def importances(models: dict[str, Trees], spark) -> DataFrame:
    """``model, feature, importance``: shares of the gain."""
    rows = [(name, f, v) for name, trees in models.items() for f, v in trees.importances().items()]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


#: Bars of a series that its price features reach back, with room.
TAIL = 40
FROZEN = [f for f in FEATURES if f not in ("open", "high", "low", "volume", "hl_range", "volume_change") and not f.startswith(("close_lag", "return_", "rolling_"))]


def _relative_inputs(close: np.ndarray, volume: np.ndarray, candle: dict[str, np.ndarray], frozen: dict[str, np.ndarray], number: np.ndarray) -> np.ndarray:
    """The inputs of the last bar of each series; ``close``, ``volume``: series x bars, NaN before a series begins."""
    from .trees import PRICES, SPREADS

    now = close[:, -1]
    share = lambda a, b: np.divide(a, b, out=np.full(len(now), np.nan), where=b != 0)
    raw = {f"close_lag_{k}": close[:, -1 - k] for k in LAGS} | {f"return_{k}d": share(now - close[:, -1 - k], close[:, -1 - k]) for k in (1, 5)}
    for n in WINDOWS:
        raw |= {f"rolling_mean_{n}": close[:, -n:].mean(axis=1), f"rolling_std_{n}": close[:, -n:].std(axis=1, ddof=1)}
    raw |= candle | frozen | {"hl_range": candle["high"] - candle["low"], "volume": np.log1p(volume[:, -1])}
    raw["volume_change"] = share(volume[:, -1] - volume[:, -2], volume[:, -2])
    raw |= {c: share(raw[c], now) - 1 for c in PRICES} | {c: share(raw[c], now) for c in SPREADS}
    return np.nan_to_num(np.column_stack([*[raw[c] for c in FEATURES], number]))


def forecast(models: dict[str, Trees], bars: DataFrame, matrix: DataFrame, n: int = 7, width: float = 0.02) -> DataFrame:
    """Recursive forecasts of the next n business days of all series by all models, bounds of ``width``.

    Each step predicts from the last bar, appends the prediction as a bar and computes the price features again; the
    other features stay those of the series' last row of the matrix.  The recursion runs over many series at a time inside one stage:
    a row is a series with its last ``TAIL`` bars.
    """
    tail = from_end(bars, TAIL, time="ds").where("_back is not null")
    tail = tail.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct("ds", "open", "high", "low", "close", "volume"))).alias("b"))
    other = matrix.groupBy(KEY).agg(F.max_by(F.struct(*FROZEN), "ds").alias("o"))
    list_of = lambda c: F.transform("b", lambda x: x[c].cast("double")).alias(f"_{c}")
    last = [F.element_at("b", -1)[c].cast("double").alias(c) for c in ("open", "high", "low")]
    number = F.pmod(F.xxhash64(KEY), F.lit(251)).cast("double").alias("_number")
    days = business_days(F.element_at("b", -1)["ds"], n).alias("days")
    series = tail.join(other, KEY).select(KEY, days, list_of("close"), list_of("volume"), *last, number, *[F.col("o")[c].cast("double").alias(c) for c in FROZEN])
    shared = bars.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {c: batch.column(j) for j, c in enumerate(batch.schema.names)}
            padded = lambda c: np.array([[np.nan] * (TAIL - len(v)) + v for v in ([np.nan if x is None else x for x in row] for row in at[c].to_pylist())], float)  # noqa: B023,E731
            plain = lambda c: at[c].to_numpy(zero_copy_only=False).astype(float)  # noqa: B023,E731
            closes, volumes, frozen = padded("_close"), padded("_volume"), {c: plain(c) for c in FROZEN}
            for name, trees in shared.value.items():
                close, volume, candle, found = closes, volumes, {c: plain(c) for c in ("open", "high", "low")}, []
                for _ in range(n):
                    p = close[:, -1] * (1 + trees.predict(_relative_inputs(close, volume, candle, frozen, plain("_number"))))
                    found.append(p)
                    close, volume = np.column_stack([close[:, 1:], p]), np.column_stack([volume[:, 1:], volume[:, -1]])
                    candle = dict.fromkeys(("open", "high", "low"), p)
                values = pa.array(np.column_stack(found).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([at[KEY], at["days"], pa.array([name] * batch.num_rows), values], [KEY, "days", "model", "p"])

    rows = series.mapInArrow(run, f"{KEY} string, days array<date>, model string, p array<double>")
    rows = rows.select(KEY, "model", F.inline(F.arrays_zip("days", "p"))).toDF(KEY, "model", "forecast_date", "p")
    p = F.col("p")
    return rows.select(KEY, "model", "forecast_date", p.alias("predicted_close"), (p * (1 - width)).alias("lower_bound"), (p * (1 + width)).alias("upper_bound"))
