"""Random forests of Spark ML, grown on binned rows.

Spark ML makes the statistics of every node over all bins in each task and shuffles them; some levels down they are far larger than the
rows. Here rows are binned once. Nodes of more than ``most`` rows are split by histograms that tasks make and Spark adds up, in a
job for each level of all trees. The rows of smaller nodes are brought to a task for each of them, which grows the rest of its tree. The
rules are those of Spark ML (bagging, candidates between bins, variance, least rows and gain, features of a node), so are the parameters'
names, and the result is a model of Spark ML, loaded from its format.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from math import ceil, exp, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.session import discard, materialize, scratch_path, small_table

#: Nodes whose histograms a task holds at once, and bytes of sums after which a task passes them on.
NODES, HELD = 512, 64 << 20
#: Trees whose rows are handed over at once.
HANDED = 25

NODE = {"prediction": "double", "impurity": "double", "weight": "double", "total": "double", "square": "double", "gain": "double",
        "left": "int", "right": "int", "feature": "int", "threshold": "double"}


@dataclass(frozen=True)
class Rules:
    """What a split has to keep to; ``cuts`` are the candidates of each feature, rising: a row goes left if its value is no larger."""

    depth: int
    least: int
    gain: float
    per_node: int
    cuts: list[np.ndarray]
    seed: int

    def allowed(self, nodes: int, *key: int) -> np.ndarray | None:
        """The features that each of some nodes may use, drawn by ``key``; None: all."""
        if self.per_node >= len(self.cuts):
            return None
        draw = np.random.default_rng([abs(self.seed), *key]).random((nodes, len(self.cuts)))
        return draw.argsort(1).argsort(1) < self.per_node


@dataclass
class Top:
    """The first levels of a tree: lists over nodes. ``left`` is -1 where a node isn't split (the right child follows the left one)."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    #: Weight, total, square and gain of nodes that are done; others are grown from their rows.
    done: dict[int, tuple[float, float, float, float]] = field(default_factory=dict)

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.left)
        for _ in range(2):
            self.feature.append(0)
            self.cut.append(0)
            self.left.append(-1)
            self.depth.append(self.depth[node] + 1)
        return self.left[node], self.left[node] + 1

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        at = np.zeros(bins.shape[1], np.int64)
        feature, cut, left = map(np.array, (self.feature, self.cut, self.left))
        rows = np.flatnonzero(left[at] >= 0)
        while len(rows):
            node = at[rows]
            at[rows] = left[node] + (bins[feature[node], rows] > cut[node])
            rows = rows[left[at[rows]] >= 0]
        return at


def features_of_a_node(strategy: str, features: int, trees: int) -> int:
    """As many as Spark ML takes for ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "sqrt": sqrt(features), "log2": max(1, log2(features)), "onethird": features / 3}
    if strategy in named:
        return ceil(named[strategy])
    return min(features, int(strategy)) if strategy.isdigit() else ceil(float(strategy) * features)


def candidates(rows: DataFrame, features: int, most: int) -> list[np.ndarray]:
    """Where each feature may be cut: between all of up to ``most`` values, else at as many quantiles."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, features)
            found = [np.unique(x[:, f]) for f in range(features)]
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(np.repeat(np.arange(features, dtype=np.int32), [len(v) for v in found])), "value": pa.array(np.concatenate(found))})

    distinct = materialize(rows.select("x").mapInArrow(values, "feature int, value double").distinct(), "values")
    sizes = {r.feature: r["count"] for r in distinct.groupBy("feature").count().collect()}
    few = [f for f, n in sizes.items() if n <= most]
    known: dict[int, list[float]] = {f: [] for f in range(features)}
    for f, value in distinct.where(F.col("feature").isin(few)).collect():
        known[f].append(value)
    cuts = {f: (np.sort(v)[:-1] + np.sort(v)[1:]) / 2 for f, v in known.items()}
    many = [f for f, n in sizes.items() if n > most]
    if many:
        columns = rows.select([F.col("x")[f].alias(f"x{f}") for f in many])
        shares = [k / most for k in range(1, most)]
        for f, found in zip(many, columns.approxQuantile(columns.columns, shares, 1 / (8 * most))):
            cuts[f] = np.unique(found)
    discard(distinct)
    return [np.asarray(cuts[f], float) for f in range(features)]


def matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(id, bins, y), written: a bin of each feature in as few bytes as they need."""
    kind = bin_type(cuts)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, len(cuts))
            out = np.empty(x.shape, kind)
            for f, at in enumerate(cuts):
                out[:, f] = np.searchsorted(at, x[:, f])
            if batch["y"].null_count or np.isnan(batch["y"].to_numpy(zero_copy_only=False)).any():
                raise ValueError("the target of a row is missing")
            step = out.shape[1] * out.itemsize
            ends = pa.py_buffer(np.arange(0, (batch.num_rows + 1) * step, step, dtype=np.int32)[: batch.num_rows + 1])
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"], "bins": pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(out)]), "y": batch["y"]})

    return materialize(rows.withColumn("id", F.monotonically_increasing_id()).mapInArrow(bins, "id bigint, bins binary, y double"), "binned")


def bin_type(cuts: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16 if max(map(len, cuts)) < 65536 else np.uint32


def unpacked(batch: pa.RecordBatch, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bins (a row for each feature) and target."""
    column = batch["bins"]
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]: ends[-1]]
    bins = np.frombuffer(data.tobytes(), bin_type(cuts)).reshape(len(column), len(cuts))
    return batch["id"].to_numpy(), np.ascontiguousarray(bins.T), batch["y"].to_numpy()


def bag(ids: np.ndarray, seed: int, tree: int, rate: float, again: bool) -> np.ndarray:
    """How often a tree sees each row: a Poisson number of mean ``rate``, without ``again`` once at that rate. Depends on the row's id only."""
    salt = np.random.default_rng([abs(seed), tree]).integers(1 << 63, dtype=np.uint64)
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    drawn = (x >> np.uint64(11)) * 2.0 ** -53
    if not again:
        return (drawn < rate).astype(np.uint8)
    count, share, below = np.zeros(len(ids), np.uint8), exp(-rate), exp(-rate)
    for k in range(1, 200):
        count += drawn >= below
        share *= rate / k
        below += share
        if share < 1e-16 and k > rate:
            break
    return count


def best_splits(histogram: Callable[[int], tuple[np.ndarray, np.ndarray]], weight: np.ndarray, total: np.ndarray, impurity: np.ndarray,
                rules: Rules, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some nodes the feature (-1: none), bin and gain of the best split; ``histogram`` has the weights and totals of a feature's bins."""
    nodes = np.arange(len(weight))
    best, feature, cut = np.full(len(weight), -np.inf), np.full(len(weight), -1, np.int32), np.zeros(len(weight), np.int32)
    for f, cuts in enumerate(rules.cuts):
        if not len(cuts):
            continue
        w, s = (np.cumsum(part, 1)[:, :-1] for part in histogram(f))
        rest, left = weight[:, None] - w, total[:, None] - s
        with np.errstate(divide="ignore", invalid="ignore"):
            score = s * s / w + left * left / rest
        score[(w < rules.least) | (rest < rules.least)] = -np.inf
        at = score.argmax(1)
        found = score[nodes, at]
        better = found > best if allowed is None else (found > best) & allowed[:, f]
        best[better], feature[better], cut[better] = found[better], f, at[better]
    gain = (best - total * total / weight) / weight
    feature[~((gain >= rules.gain) & (gain > 1e-12 * impurity + 1e-14 * (total / weight) ** 2))] = -1  # above what rounding makes
    return feature, cut, np.where(feature < 0, -1.0, gain)


def grow(bins: np.ndarray, y: np.ndarray, bagged: np.ndarray, depth: int, rules: Rules, key: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The nodes of a tree over these rows, its root at ``depth``, in order of levels."""
    w = bagged.astype(float)
    wy, edges, levels, first, scale = w * y, np.array([0, len(y)]), [], 0, None
    while True:
        weight, total, square = (np.add.reduceat(v, edges[:-1]) for v in (w, wy, wy * y))
        impurity = np.maximum(square / weight - (total / weight) ** 2, 0)
        scale = impurity[0] if scale is None else scale
        feature, cut, gain = np.full(len(weight), -1, np.int32), np.zeros(len(weight), np.int32), np.full(len(weight), -1.0)
        wide = (weight >= 2 * rules.least) & (impurity > 1e-12 * scale) & (depth < rules.depth)
        if not wide.all():  # rows of leaves go
            kept = np.flatnonzero(np.repeat(wide, np.diff(edges)))
            edges = np.concatenate([[0], np.cumsum(np.diff(edges)[wide])])
            bins, y, w, wy = bins[:, kept], y[kept], w[kept], wy[kept]
        open_ = np.flatnonzero(wide)
        allowed = rules.allowed(len(open_), *key, first)
        for a in range(0, len(open_), NODES):
            own, rows = open_[a: a + NODES], slice(edges[a], edges[min(a + NODES, len(open_))])
            local = np.repeat(np.arange(len(own)), np.diff(edges[a: a + len(own) + 1]))

            def histogram(f: int) -> tuple[np.ndarray, np.ndarray]:
                size = len(rules.cuts[f]) + 1
                place = local * size + bins[f, rows]
                return tuple(np.bincount(place, v[rows], len(own) * size).reshape(-1, size) for v in (w, wy))

            feature[own], cut[own], gain[own] = best_splits(
                histogram, weight[own], total[own], impurity[own], rules, None if allowed is None else allowed[a: a + NODES])
        split = feature >= 0
        left = np.where(split, first + len(weight) + 2 * (np.cumsum(split) - 1), -1).astype(np.int32)
        threshold = np.array([rules.cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)])
        levels.append({
            "prediction": total / weight, "impurity": impurity, "weight": weight, "total": total, "square": square, "gain": gain, "left": left,
            "right": np.where(split, left + 1, -1).astype(np.int32), "feature": feature, "threshold": threshold})
        if not split.any():
            return {c: np.concatenate([level[c] for level in levels]) for c in NODE}
        node = np.repeat(open_, np.diff(edges))
        rows = np.flatnonzero(split[node])
        node = node[rows]
        child = 2 * (np.cumsum(split) - 1)[node] + (bins[feature[node], rows] > cut[node])
        order = child.astype(np.uint16 if 2 * split.sum() < 65536 else np.int64).argsort(kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(child, minlength=2 * split.sum()))])
        rows = rows[order]
        bins, y, w, wy = bins[:, rows], y[rows], w[rows], wy[rows]
        first, depth = first + len(weight), depth + 1


def first_levels(blocks: DataFrame, tops: list[Top], rules: Rules, draw: Callable[[np.ndarray, int], np.ndarray], most: int) -> None:
    """Split the nodes of more than ``most`` rows, a job for each level; ``tops`` are the trees' roots, all as large."""
    cuts = rules.cuts
    sizes = [len(c) + 1 for c in cuts]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    large = {tree: [0] for tree in range(len(tops))}
    while large:
        now = {tree: (tops[tree], nodes) for tree, nodes in large.items()}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}

            def passed_on() -> pa.RecordBatch:
                trees, nodes = zip(*held)
                out = pa.RecordBatch.from_pydict({
                    "tree": pa.array(trees, pa.int32()), "node": pa.array(nodes, pa.int32()),
                    "sums": pa.array([v.tobytes() for v in held.values()], pa.binary())})
                held.clear()
                return out

            for batch in batches:
                ids, bins, y = unpacked(batch, cuts)
                for tree, (top, nodes) in now.items():
                    count, at = draw(ids, tree), top.places(bins)
                    for node in nodes:
                        rows = np.flatnonzero((at == node) & (count > 0))
                        w, wy = count[rows].astype(float), count[rows] * y[rows]
                        parts = [np.bincount(bins[f, rows], v, sizes[f]) for v in (w, wy) for f in range(len(cuts))]
                        held.setdefault((tree, node), np.zeros(2 * starts[-1] + 3))
                        held[tree, node] += np.concatenate([*parts, [w.sum(), wy.sum(), wy @ y[rows]]])
                if len(held) * 16 * starts[-1] > HELD:
                    yield passed_on()
            if held:
                yield passed_on()

        def best(key: tuple, rows: pa.Table) -> pa.Table:
            tree, node = (k.as_py() for k in key)
            found = np.sum([np.frombuffer(v, float) for v in rows["sums"].to_pylist()], 0)
            weight, total, square = found[-3:]
            impurity = max(square / weight - (total / weight) ** 2, 0)
            feature, cut, gain, left = -1, 0, -1.0, 0.0
            if now[tree][0].depth[node] < rules.depth:
                def histogram(f: int) -> tuple[np.ndarray, np.ndarray]:
                    at = slice(starts[f], starts[f + 1])
                    return found[: starts[-1]][at][None], found[starts[-1]:][at][None]

                one = [np.array([v]) for v in (weight, total, impurity)]
                feature, cut, gain = (v[0] for v in best_splits(histogram, *one, rules, rules.allowed(1, tree, 1 << 30, node)))
                left = found[starts[feature]: starts[feature] + cut + 1].sum() if feature >= 0 else 0.0
            return pa.table({k: [v] for k, v in {
                "tree": tree, "node": node, "weight": float(weight), "total": float(total), "square": float(square), "gain": float(gain),
                "feature": int(feature), "cut": int(cut), "left": float(left)}.items()}).cast(answer)

        answer = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("weight", pa.float64()), ("total", pa.float64()), ("square", pa.float64()),
                            ("gain", pa.float64()), ("feature", pa.int32()), ("cut", pa.int32()), ("left", pa.float64())])
        rows = blocks.mapInArrow(sums, "tree int, node int, sums binary").groupBy("tree", "node").applyInArrow(
            best, "tree int, node int, weight double, total double, square double, gain double, feature int, cut int, left double").collect()
        large = {}
        for r in sorted(rows):
            top = tops[r.tree]
            top.done[r.node] = r.weight, r.total, r.square, r.gain
            if r.feature >= 0:
                for child, weight in zip(top.split(r.node, r.feature, r.cut), (r.left, r.weight - r.left)):
                    if weight > most:
                        large.setdefault(r.tree, []).append(child)


def grown(blocks: DataFrame, tops: list[Top], rules: Rules, draw: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """(tree, part, id, and what NODE has) of the trees below each node of ``tops`` that isn't done; written."""
    wanted = {t: [n for n, left in enumerate(top.left) if left < 0 and n not in top.done] for t, top in enumerate(tops)}
    cuts = rules.cuts

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bins, y = unpacked(batch, cuts)
            out: list[tuple] = []
            for tree, nodes in wanted.items():
                count = draw(ids, tree)
                at = tops[tree].places(bins)
                for node in nodes:
                    rows = np.flatnonzero((at == node) & (count > 0))
                    if len(rows):
                        out.append((tree, node, bins[:, rows].tobytes(), y[rows].tobytes(), count[rows].tobytes()))
                if out and (tree % HANDED == HANDED - 1 or tree == len(tops) - 1):
                    names = ("tree", "part", "bins", "y", "count")
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], list(names))
                    out = []

    def rest(key: tuple, rows: pa.Table) -> pa.Table:
        tree, part = (k.as_py() for k in key)
        kind = bin_type(cuts)
        bins = np.concatenate([np.frombuffer(v, kind).reshape(len(cuts), -1) for v in rows["bins"].to_pylist()], 1)
        y, count = (np.frombuffer(b"".join(rows[c].to_pylist()), k) for c, k in (("y", float), ("count", np.uint8)))
        nodes = grow(bins, y, count, tops[tree].depth[part], rules, (tree, part))
        n = len(nodes["left"])
        ids = {"tree": np.full(n, tree, np.int32), "part": np.full(n, part, np.int32), "id": np.arange(n, dtype=np.int32)}
        return pa.table({**ids, **nodes})

    schema = ", ".join(["tree int, part int, id int", *(f"{c} {k}" for c, k in NODE.items())])
    units = sum(map(len, wanted.values()))
    dealt = blocks.mapInArrow(handed, "tree int, part int, bins binary, y binary, count binary").repartition(max(1, 2 * units), "tree", "part")
    return materialize(dealt.groupBy("tree", "part").applyInArrow(rest, schema), "nodes")


def numbered(nodes: DataFrame, tops: list[Top], rules: Rules, mean: float) -> DataFrame:
    """The nodes of whole trees (tree, id, and what NODE has): first levels, then what was grown below, children after their parents."""
    sizes = {(r.tree, r.part): r["count"] for r in nodes.groupBy("tree", "part").count().collect()}
    offsets, above = [], []
    for tree, top in enumerate(tops):
        ids = {n: i for i, n in enumerate(sorted(top.done))}
        at = len(ids)
        for part in (n for n, left in enumerate(top.left) if left < 0 and n not in top.done):
            if (tree, part) in sizes:
                ids[part] = at
                offsets.append((tree, part, at))
                at += sizes[tree, part]
        if not at:  # no row was drawn
            above.append((tree, 0, mean, 0.0, 0.0, 0.0, 0.0, -1.0, -1, -1, -1, 0.0))
        for node, (weight, total, square, gain) in top.done.items():
            left, f = top.left[node], top.feature[node]
            children = (ids[left], ids[left + 1], f, float(rules.cuts[f][top.cut[node]])) if left >= 0 else (-1, -1, -1, 0.0)
            above.append((tree, ids[node], total / weight, max(square / weight - (total / weight) ** 2, 0.0), weight, total, square, gain, *children))
    spark = nodes.sparkSession
    shift = F.broadcast(small_table(spark, offsets, tree="int", part="int", offset="int"))
    moved = nodes.join(shift, ["tree", "part"]).withColumns(
        {c: F.when(F.col(c) < 0, F.col(c)).otherwise(F.col(c) + F.col("offset")) for c in ("left", "right")}).withColumn("id", F.col("id") + F.col("offset"))
    return moved.select("tree", "id", *NODE).unionByName(small_table(spark, above, tree="int", id="int", **NODE))


def as_model(nodes: DataFrame, estimator: RandomForestRegressor, features: int) -> RandomForestRegressionModel:
    """The model that the nodes of ``estimator``'s trees make, written and read in Spark ML's format."""
    spark, path = nodes.sparkSession, scratch_path(nodes.sparkSession, "forest")
    names = [{p.name: v for p, v in params.items()} for params in (estimator._paramMap, estimator._defaultParamMap)]

    def about(kind: str, uid: str, skipped: tuple[str, ...] = (), **more: int) -> str:
        own = [{k: v for k, v in some.items() if k not in skipped} for some in names]
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own[0], "defaultParamMap": own[1], **more})

    forest_only = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
    trees = [(t, about("DecisionTreeRegressionModel", f"{estimator.uid}_{t}", forest_only), 1.0) for t in range(estimator.getNumTrees())]
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(F.col("feature") < 0, F.array().cast("array<double>")).otherwise(
        F.array("threshold")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.array("weight", "total", "square").alias("impurityStats"), F.col("weight").cast("long").alias("rawCount"),
        "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData"))
    data.write.parquet(f"{path}/data")
    small_table(spark, trees, _1="int", _2="string", _3="double").write.parquet(f"{path}/treesMetadata")
    whole = about("RandomForestRegressionModel", estimator.uid, numFeatures=features, numTrees=len(trees))
    small_table(spark, [(whole,)], value="string").coalesce(1).write.text(f"{path}/metadata")
    model = RandomForestRegressionModel.load(path)
    model.written_to = path
    return model


def fit_forest(rows: DataFrame, estimators: list[RandomForestRegressor], most: int,
               at_once: Callable[[SparkSession, list[Callable]], list]) -> list[RandomForestRegressionModel]:
    """A model of each estimator, which differ in name, seed and number of trees only; the trees are dealt to them in turn."""
    for estimator in estimators:
        estimator._transfer_params_to_java()  # refuses what Spark ML refuses
    one, seed = estimators[0], estimators[0].getSeed()
    trees = sum(e.getNumTrees() for e in estimators)
    rate, again = one.getSubsamplingRate(), one.getBootstrap()
    rows = rows.select(vector_to_array(one.getFeaturesCol()).alias("x"), F.col(one.getLabelCol()).cast("double").alias("y"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.max(F.size("x")).alias("features")).first()
    if not facts.n:
        raise ValueError("there are no rows to fit a forest on")
    cuts = candidates(rows, facts.features, one.getMaxBins())
    per_node = features_of_a_node(one.getFeatureSubsetStrategy(), facts.features, trees)
    rules = Rules(one.getMaxDepth(), one.getMinInstancesPerNode(), one.getMinInfoGain(), per_node, cuts, seed)
    blocks = binned(rows, cuts)

    def draw(ids: np.ndarray, tree: int) -> np.ndarray:
        return bag(ids, seed, tree, rate, again)

    tops = [Top() for _ in range(trees)]
    if facts.n * rate > most:
        first_levels(blocks, tops, rules, draw, most)
    found = grown(blocks, tops, rules, draw)
    whole = numbered(found, tops, rules, facts.mean)
    groups = len(estimators)
    whole = materialize(whole.withColumn("group", F.col("tree") % groups).withColumn("tree", F.floor(F.col("tree") / groups).cast("int")), "trees", by=("group",))
    models = at_once(rows.sparkSession, [
        lambda i=i, e=e: as_model(whole.where(F.col("group") == i), e, facts.features) for i, e in enumerate(estimators)])
    discard(blocks, found, whole)
    return models


@dataclass(frozen=True)
class Tree:
    """Of each node the feature, the cut, and both children; a leaf is its own child and has its prediction as cut."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: int


def trees_of(models: list[RandomForestRegressionModel], spark: SparkSession,
             at_once: Callable[[SparkSession, list[Callable]], list]) -> list[Tree] | None:
    """The trees of Spark ML's models as arrays, from their written form; None if one splits by categories."""
    def read(model: RandomForestRegressionModel) -> list[Tree] | None:
        path = getattr(model, "written_to", None)
        if path is None:
            path = scratch_path(spark, "forest")
            model.save(path)
        split = "nodeData.split"
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID", "nodeData.id", F.col(f"{split}.featureIndex").alias("feature"), F.col(f"{split}.numCategories").alias("categories"),
            F.when(F.col("nodeData.leftChild") < 0, F.col("nodeData.prediction")).otherwise(F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0))).alias("cut"),
            F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right")).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
        columns = {c: nodes[c].to_numpy() for c in nodes.column_names}
        if (columns["categories"] >= 0).any():
            return None
        out = []
        edges = [*np.flatnonzero(columns["id"] == 0), len(nodes)]
        for a, b in zip(edges, edges[1:]):
            feature, cut, left, right = (columns[c][a:b] for c in ("feature", "cut", "left", "right"))
            leaf, own = left < 0, np.arange(b - a)
            child = np.stack([np.where(leaf, own, left), np.where(leaf, own, right)], 1).astype(np.int32)
            depth, level = 0, np.flatnonzero(~leaf[:1])
            while len(level):
                depth, level = depth + 1, child[level].ravel()
                level = level[~leaf[level]]
            out.append(Tree(np.where(leaf, 0, feature).astype(np.int16), cut.copy(), child.ravel(), depth))
        return out

    found = at_once(spark, [lambda m=m: read(m) for m in models])
    return None if any(f is None for f in found) else [tree for own in found for tree in own]


def mean_of(trees: list[Tree], vector: str) -> Column:
    """The mean prediction of the trees; rows of a batch go down a tree together, so that it stays in the processor's cache."""
    @F.arrow_udf("double")
    def mean(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False)
        first = np.arange(len(rows)) * (len(x) // max(1, len(rows)))
        total = np.zeros(len(rows))
        for tree in trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(tree.depth):
                at = tree.child[2 * at + (x[first + tree.feature[at]] > tree.cut[at])]
            total += tree.cut[at]
        return pa.array(total / len(trees))

    return mean(vector_to_array(vector))
