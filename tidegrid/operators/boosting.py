"""Histogram gradient boosting: bins by channel, node histograms summed by grouping, a learned side for masked values.

Rows are stored once as a byte for each feature, the number of its bin (0: masked), with their labels.  A level of the trees is one
job: tasks put gradients into histograms by (label, node, feature), these are added up where they are grouped, and a row for each of
these comes to the driver, the feature's best cut of the node.  Gradients are added as whole numbers, so that a fit is the same however
rows lie in partitions.  A row's scores follow from its bins and the trees so far, so a lost task needs nothing but its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import workers_find_package, written

#: Bins of a feature, rows that the bins' edges are taken from (about; all rows where there are no more), most rows of one piece, and least rows of a task.
BINS, EDGE_ROWS, PIECE, TASK_ROWS = 63, 100_000, 1 << 14, 20_000
#: Levels of cuts, least rows of a leaf, penalty on leaf values; rounds after which scores are stored.
DEPTH, LEAF_ROWS, PENALTY, REPLAY = 4, 20, 1.0, 20


@dataclass
class Tree:
    """A binary tree by places: the children of i stand at 2i + 1 and 2i + 2.  A feature of -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    masked_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n, bool), np.zeros(n))

    def places(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after so many levels."""
        at, rows = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(levels):
            f = self.feature[at]
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == 0, self.masked_left[at], b <= self.cut[at])
            at = np.where(f < 0, at, 2 * at + 2 - left)
        return at


@dataclass
class Label:
    """What is fitted to a column: squares or, for ``classes``, log loss.  ``base`` alone stands where there is nothing to fit."""

    classes: bool
    base: float
    fitted: bool
    scale: int = 0
    trees: list[Tree] = field(default_factory=list)

    def score(self, bins: np.ndarray, depth: int, begun: np.ndarray | None = None, since: int = 0) -> np.ndarray:
        total = np.full(len(bins), self.base) if begun is None else begun.copy()
        for t in self.trees[since:]:
            total += t.value[t.places(bins, depth)]
        return total

    def output(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-score)) if self.classes and self.fitted else score

    def slopes(self, score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivative of the loss, as whole numbers."""
        unit = 2.0**self.scale
        if not self.classes:
            return np.rint((score - y) * unit), np.full(len(y), unit)
        p = 1 / (1 + np.exp(-score))
        return np.rint((p - y) * unit), np.rint(p * (1 - p) * unit)


def _scale(rows: int, largest: float) -> int:
    """Binary places of gradients so that sums of a piece stay exact in doubles and sums of all rows in longs."""
    top = math.log2(max(largest, 1e-300))
    return math.floor(min(61 - math.log2(max(rows, 1)) - top, 52 - math.log2(PIECE) - top))


def to_bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers from 1 by each feature's edges, a value on an edge to its left; 0 for what is no number."""
    out = np.zeros(values.shape, np.uint8)
    for i, e in enumerate(edges):
        v = values[:, i]
        out[:, i] = np.where(np.isnan(v), 0, np.searchsorted(e, v, side="left") + 1)
    return out


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges, at most one less than the bins: middles of neighbours if there are few distinct values, else quantiles."""
    known = np.sort(values[~np.isnan(values)])
    distinct = np.unique(known)
    if len(distinct) <= bins:
        return (distinct[:-1] + distinct[1:]) / 2
    return np.unique(known[(np.arange(1, bins) * len(known)) // bins])


def fit_edges(rows: DataFrame, width: int, bins: int = BINS, sample: int = EDGE_ROWS) -> list[np.ndarray]:
    """Edges of each place of the array ``__v``.  Beyond ``sample`` rows, those whose hash is small are taken: the same rows on any cluster."""
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("__v"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    one = lambda pdf: pd.DataFrame({"f": [pdf["f"].iloc[0]], "e": [edges_of(pdf["v"].to_numpy(float), bins)]})
    found = rows.select(F.posexplode("__v").alias("f", "v")).groupBy("f").applyInPandas(one, "f int, e array<double>").collect()
    edges = {r["f"]: np.array(r["e"], float) for r in found}
    return [edges.get(i, np.zeros(0)) for i in range(width)]


def _bins_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(batch.num_rows, width)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(float)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, PIECE):
            yield b.slice(i, PIECE)


_PART = "label int, node int, feature int, h binary"
_CUT = "label int, node int, feature int, gain double, cut int, masked_left boolean, lg double, lh double, rg double, rh double"


def _histograms(labels: list[Label], growing: list[Tree | None], level: int, width: int, size: int, depth: int, since: int):
    """Each task's histograms: gradient, curvature and rows of every bin of a feature in a node, as longs."""

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in _pieces(batches):
            x = _bins_of(b, width)
            for k, (label, tree) in enumerate(zip(labels, growing, strict=True)):
                if tree is None:
                    continue
                y = _column(b, f"y{k}")
                use = ~np.isnan(y)
                xs = x[use]
                g, h = label.slopes(label.score(xs, depth, _column(b, f"s{k}")[use], since), y[use])
                at = tree.places(xs, level)
                for node in np.unique(at):
                    if node < 2**level - 1:  # a leaf of an earlier level
                        continue
                    mine = at == node
                    # all features at once: a bin's number is moved on by the feature's place
                    cells = (xs[mine] + np.arange(width) * size).ravel()
                    made = [np.bincount(cells, np.repeat(v[mine], width), width * size) for v in (g, h, np.ones(len(g)))]
                    have = sums.setdefault((k, int(node)), np.zeros((3, width * size), np.int64))
                    have += np.array(made).astype(np.int64)
        for (k, node), s in sums.items():
            cut = s.reshape(3, width, size)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([k] * width, pa.int32()), "node": pa.array([node] * width, pa.int32()), "feature": pa.array(range(width), pa.int32()),
                "h": pa.array([cut[:, f].tobytes() for f in range(width)], pa.binary()),
            })

    return run


def best_cut(hist: np.ndarray, unit: float, leaf_rows: int = LEAF_ROWS, penalty: float = PENALTY) -> tuple | None:
    """The cut of most gain of a feature in a node: (gain, cut, masked left, sums of the left side, of the right).

    Masked rows go to the side that gains more, if there are none to that with more rows; of equal cuts the least one, masked left.
    """
    whole = hist.sum(axis=1)
    left = np.cumsum(hist[:, 1:-1], axis=1)
    sides = np.stack([left + hist[:, :1], left], axis=-1)  # (sums, cuts, masked left or right)
    rest = whole[:, None, None] - sides
    ok = np.minimum(sides[2], rest[2]) >= leaf_rows
    if not hist[2, 0]:
        to_left = 2 * left[2] >= whole[2]
        ok &= np.stack([to_left, ~to_left], axis=-1)
    if not ok.any():
        return None
    a, b, t = sides[:2] / unit, rest[:2] / unit, whole[:2] / unit
    gain = np.where(ok, a[0] ** 2 / (a[1] + penalty) + b[0] ** 2 / (b[1] + penalty) - t[0] ** 2 / (t[1] + penalty), -np.inf)
    i = int(gain.argmax())
    c, side = divmod(i, 2)
    if gain[c, side] <= 1e-9:
        return None
    return float(gain[c, side]), c + 1, side == 0, *(float(v) for v in (a[0, c, side], a[1, c, side], b[0, c, side], b[1, c, side]))


def _added(units: list[float], size: int, leaf_rows: int, penalty: float):
    """Add up the histograms of each (label, node, feature), all of which are in this task, and cut each."""

    def run(batches):
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for b in batches:
            for k, node, f, h in zip(*(b.column(c).to_pylist() for c in ("label", "node", "feature", "h")), strict=True):
                have = sums.setdefault((k, node, f), np.zeros((3, size), np.int64))
                have += np.frombuffer(h, np.int64).reshape(3, size)
        rows = []
        for (k, node, f), h in sums.items():
            cut = best_cut(h, units[k], leaf_rows, penalty)
            if cut:
                rows.append((k, node, f, *cut))
        names = [c.split()[0] for c in _CUT.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), *[pa.float64()] * 4]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def _grow(rows: DataFrame, one_task: bool, labels: list[Label], width: int, size: int, step: float, depth: int, since: int, leaf_rows: int, penalty: float) -> None:
    """One more tree for each label, level by level; all labels share a pass.  What one task has counted need not be grouped again."""
    trees = [Tree.empty(depth) if label.fitted else None for label in labels]
    units = [2.0**label.scale for label in labels]
    for level in range(depth):
        parts = rows.mapInArrow(_histograms(labels, trees, level, width, size, depth, since), _PART)
        together = parts if one_task else parts.repartition("label", "node", "feature")
        cuts = together.mapInArrow(_added(units, size, leaf_rows, penalty), _CUT)
        found: dict[tuple[int, int], tuple] = {}
        for r in cuts.collect():  # eight nodes' features at most, for each label
            key = r["label"], r["node"]
            found[key] = max(found.get(key, r), r, key=lambda c: (c["gain"], -c["feature"]))
        for r in found.values():
            t, i = trees[r["label"]], r["node"]
            t.feature[i], t.cut[i], t.masked_left[i] = r["feature"], r["cut"], r["masked_left"]
            t.value[2 * i + 1], t.value[2 * i + 2] = (-step * g / (h + penalty) for g, h in ((r["lg"], r["lh"]), (r["rg"], r["rh"])))
        if not found:
            break
    for label, tree in zip(labels, trees, strict=True):
        if tree is not None:
            label.trees.append(tree)


def _advanced(labels: list[Label], width: int, depth: int, since: int):
    """Rows with their scores moved on by the trees since they were stored."""

    def run(batches):
        for b in batches:
            x = _bins_of(b, width)
            made = {c: b.column(c) for c in b.schema.names}
            for k, label in enumerate(labels):
                made[f"s{k}"] = pa.array(label.score(x, depth, _column(b, f"s{k}"), since))
            yield pa.RecordBatch.from_pydict(made)

    return run


@dataclass
class Boosted:
    """Fitted labels over the same features; ``apply`` adds a column for each."""

    features: list[str]
    edges: list[np.ndarray]
    labels: list[Label]
    depth: int

    def apply(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        workers_find_package(df.sparkSession)
        edges, labels, depth, width = self.edges, self.labels, self.depth, len(self.features)

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for values in batches:
                x = to_bins(np.array([np.asarray(v, float) for v in values]).reshape(len(values), width), edges)
                yield pd.DataFrame({f"p{k}": label.output(label.score(x, depth)) for k, label in enumerate(labels)})

        kind = ", ".join(f"p{k} double" for k in range(len(labels)))
        made = df.withColumn("__p", F.pandas_udf(run, kind)(_values(self.features)))
        return made.withColumns({n: F.col("__p")[f"p{k}"] for k, n in enumerate(names)}).drop("__p")


def _values(features: Sequence[str]):
    return F.array(*[F.col(f).cast("double") for f in features])


def fit(
    train: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool, str | None]], rounds: int = 100, step: float = 0.05, depth: int = DEPTH, bins: int = BINS, leaf_rows: int = LEAF_ROWS, penalty: float = PENALTY,
    sample: int = EDGE_ROWS,
) -> Boosted:
    """Fit (column, is it a class, mask column or none) targets, all in the same passes.

    Null or infinite targets and masked rows don't count for their target.  One class only gives its rate, no rows give 0.  Null and NaN
    features are masked; targets are below 1e28.  Edges come from about ``sample`` rows; histograms and leaves from all.
    """
    spark = train.sparkSession
    workers_find_package(spark)
    if not 2 <= bins <= 254:
        raise ValueError("a feature has 2 to 254 bins")
    width, size = len(features), bins + 1
    large = float("inf")
    ys = []
    for k, (name, classes, mask) in enumerate(targets):
        y = (F.col(name) > 0.5).cast("double") if classes else F.col(name).cast("double")
        use = y.isNotNull() & ~F.isnan(y) & (F.abs(y) < large)
        ys.append(F.when(use & (F.col(mask) > 0.5) if mask else use, y).alias(f"y{k}"))
    stored = written(train.select(_values(features).alias("__v"), *ys), "boosting-values")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,10)"))  # noqa: E731  # the same in any order
    count, *stats = stored.agg(F.count(F.lit(1)), *[f(f"y{k}") for k in range(len(ys)) for f in (F.count, F.min, F.max, total)]).first()
    labels = []
    for k, (_, classes, _) in enumerate(targets):
        n, lo, hi, added = stats[4 * k : 4 * k + 4]
        mean = float(added) / n if n else 0.0
        fitted = bool(n) and lo < hi
        labels.append(Label(classes, math.log(mean / (1 - mean)) if classes and fitted else mean, fitted, _scale(n, 1.0 if classes else 4 * max(1.0, (hi or 0) - (lo or 0)))))
    model = Boosted(list(features), fit_edges(stored.select("__v"), width, bins, sample), labels, depth)
    edges, bases = model.edges, [label.base for label in labels]

    def packed(batches):
        for b in batches:
            lists = b.column("__v")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, width)
            made = {"x": pa.array([r.tobytes() for r in to_bins(values, edges)], pa.binary())}
            for k, base in enumerate(bases):
                made[f"y{k}"], made[f"s{k}"] = b.column(f"y{k}"), pa.array(np.full(b.num_rows, base))
            yield pa.RecordBatch.from_pydict(made)

    schema = "x binary, " + ", ".join(f"y{k} double, s{k} double" for k in range(len(ys)))
    tasks = max(1, count // TASK_ROWS)  # a round is a few jobs: small tables are few tasks
    kept = lambda df: written(df, "boosting-rows").coalesce(tasks).persist()
    rows, since = kept(stored.mapInArrow(packed, schema).coalesce(tasks)), 0
    for i in range(rounds if any(label.fitted for label in labels) else 0):
        if i - since == REPLAY:
            moved = kept(rows.mapInArrow(_advanced(labels, width, depth, since), schema))
            rows.unpersist()
            rows, since = moved, i
        _grow(rows, tasks == 1, labels, width, size, step, depth, since, leaf_rows, penalty)
    rows.unpersist()
    return model
