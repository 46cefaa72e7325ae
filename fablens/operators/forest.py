"""Impurity importance of a deep forest, without its trees in any one place.

A forest of full depth has about as many nodes as its training sets have rows; all its importance needs
of a tree is one sum per sensor. The rules are those of MLlib's forest: up to 32 bins per sensor
with bounds from about 10,000 rows, Poisson bags, the square root of the sensors tried at each node, weighted
Gini gain, every row of the bag in the tree, siblings of the same class folded into their parent.

Rows are binned to a byte per sensor and written in blocks. A node with more cells than ``LOCAL_CELLS`` is
split by counts that all blocks add up; a smaller one is grown to its leaves by one task, from the rows that
are dealt to it. The task returns the subtree's sums, so neither the driver nor a task follows the table's size.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import RDD, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.sources.shared import discard, materialize

# Tasks get these functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
#: Rows that the bin bounds are taken from, as in MLlib.
BOUND_ROWS = 10_000
#: Cells (rows times sensors, a byte each) that one task holds.
LOCAL_CELLS = 32_000_000
#: Nodes whose counts a task holds at once.
NODES = 16_384


def _bounds(values: np.ndarray, weights: np.ndarray) -> list[float]:
    """Where one sensor's bins end: between all distinct values if they are few, else at about equal weights."""
    order = np.argsort(values)
    values, weights = values[order], weights[order]
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < BINS:
        return middles.tolist()
    found, stride, upto = [], weights.sum() / BINS, np.cumsum(weights)
    target = stride
    for k, nearer in enumerate(middles):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            found.append(float(nearer))
            target += stride
    return found


def bin_bounds(train: DataFrame, weights: dict[int, float], rows: int, width: int, seed: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each sensor."""
    weight = F.coalesce(*[F.when(F.col("y") == c, F.lit(float(w))) for c, w in weights.items()])
    some = train if rows <= BOUND_ROWS else train.sample(False, BOUND_ROWS / rows, seed)
    cells = some.select(weight.alias("weight"), F.posexplode("values").alias("slot", "value"))
    finite = F.abs("value") < float("inf")  # rows with others raise later
    cells = cells.where(finite).groupBy("slot", "value").agg(F.sum("weight").alias("weight"))

    def of_sensor(found):
        bounds = _bounds(found["value"].to_numpy(), found["weight"].to_numpy())
        return found[["slot"]].head(1).assign(bounds=[bounds])

    found = cells.groupBy("slot").applyInPandas(of_sensor, "slot int, bounds array<double>").collect()
    bounds = {r["slot"]: np.array(r["bounds"]) for r in found}
    return [bounds.get(j, np.empty(0)) for j in range(width)]


def binned_blocks(train: DataFrame, bounds: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: their bins (a byte each, sensor after sensor) and classes."""

    def to_blocks(batches):
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        for k, batch in enumerate(x for x in batches if x.num_rows):
            y, values = batch.column(0), batch.column(1)
            cells = values.flatten()
            if y.null_count or values.null_count or cells.null_count or len(cells) != len(y) * len(bounds):
                raise ValueError("a training row without its class or with missing sensors")
            cells = cells.to_numpy(zero_copy_only=False).reshape(len(y), len(bounds))
            if not np.isfinite(cells).all():
                raise ValueError("a training value that is NaN or infinite")
            bins = np.stack([np.searchsorted(b, cells[:, j]) for j, b in enumerate(bounds)]).astype(np.uint8)
            block = [(part << 32) + k], [len(y)], [bins.tobytes()], [y.to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in block], ["block", "rows", "bins", "y"])

    return train.select("y", "values").mapInArrow(to_blocks, "block bigint, rows bigint, bins binary, y binary")


def _bag(seed: int, tree: int, block: int, rows: int, bootstrap: bool) -> np.ndarray:
    """How often each row of a block is in the tree's bag."""
    if not bootstrap:
        return np.ones(rows, np.uint8)
    return np.random.default_rng([seed, tree, block]).poisson(1.0, rows).astype(np.uint8)


def _tried(rng: np.random.Generator, nodes: int, width: int, k: int) -> np.ndarray:
    """``k`` sensors for each node, without repeats."""
    found = np.tile(np.arange(width, dtype=np.int32), (nodes, 1))
    if k < width:
        each = np.arange(nodes)
        for i in range(k):
            j = i + (rng.random(nodes) * (width - i)).astype(np.int64)
            found[each, i], found[each, j] = found[each, j], found[each, i].copy()
    return found[:, :k]


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1)
    return 1 - ((counts / total[:, None]) ** 2).sum(axis=1)


def _best(cells: np.ndarray, of_node: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, last left bin and left counts of each node's best split by one sensor; ``cells`` are counts (node, bin, class)."""
    flat = cells.reshape(-1, 2)
    full = np.flatnonzero(flat[:, 0] + flat[:, 1])
    node, counts = full // BINS, flat[full]
    upto = counts.cumsum(axis=0)
    first = np.searchsorted(node, np.arange(len(of_node)))
    left = upto - (upto[first] - counts[first])[node]
    right = of_node[node] - left
    last = right.sum(axis=1) == 0
    right[last] = 1  # no split: its gain is put below all others
    all_w, left_w, right_w = of_node * w, left * w, right * w
    total = all_w.sum(axis=1)[node]
    gain = _gini(all_w)[node] - left_w.sum(axis=1) / total * _gini(left_w) - right_w.sum(axis=1) / total * _gini(right_w)
    gain[last] = -1
    best = np.maximum.reduceat(gain, first)
    at = np.flatnonzero(gain == best[node])
    at = at[np.searchsorted(node[at], np.arange(len(of_node)))]
    return best, full[at] % BINS, left[at]


def grow(
    bins: np.ndarray, y: np.ndarray, counts: np.ndarray, w: np.ndarray, levels: int, k: int, rng: np.random.Generator
) -> tuple[np.ndarray, bool, int]:
    """Grow a node's subtree level by level: gain times weight per sensor, and whether it folds into a leaf of which class.

    ``bins`` is (sensor, row); ``counts`` is how often each row is in the bag. Rows are kept as (node, row) in one sorted
    array of integers; an open node's children are numbered two by two.
    """
    width = len(bins)
    row = np.flatnonzero(counts)
    at = row.astype(np.int64)
    of_node = np.bincount(y[row], weights=counts[row], minlength=2)[None, :]
    history = []
    for level in range(levels + 1):
        open_ = (of_node > 0).all(axis=1) if level < levels else np.zeros(len(of_node), bool)
        predicted = of_node[:, 1] * w[1] > of_node[:, 0] * w[0]
        n = int(open_.sum())
        sensor, last, gain, left = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n), np.zeros((n, 2))
        if n:
            rank = np.cumsum(open_) - 1
            kept = open_[at >> 32]
            at = at[kept]
            node, row = rank[at >> 32], at & 0xFFFFFFFF
            parents = of_node[open_]
            times, label = counts[row].astype(np.float64), y[row]
            edges = np.searchsorted(node, np.arange(0, n + NODES, NODES))
            for c, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                here = slice(c * NODES, min(n, (c + 1) * NODES))
                m = here.stop - here.start
                local = node[a:b] - here.start
                for tried in _tried(rng, m, width, k).T:
                    cell = (local * BINS + bins[tried[local], row[a:b]]) * 2 + label[a:b]
                    cells = np.bincount(cell, weights=times[a:b], minlength=m * BINS * 2)
                    found, bin_, side = _best(cells, parents[here], w)
                    better = found > gain[here]
                    for to, value in ((gain, found), (sensor, tried), (last, bin_), (left, side)):
                        to[here][better] = value[better]
        split = gain > 0
        which = np.flatnonzero(open_)[split]
        scaled = gain[split] * (of_node[which] * w).sum(axis=1)
        history.append((len(of_node), which, predicted, sensor[split], scaled))
        if not len(which):
            break
        rank = np.cumsum(split) - 1
        kept = split[node]
        node, row = node[kept], row[kept]
        child = 2 * rank[node] + (bins[sensor[node], row] > last[node])
        at = np.sort((child << 32) | row)
        left = left[split]
        of_node = np.stack([left, parents[split] - left], axis=1).reshape(-1, 2)
    sums, leaf, said = np.zeros(width), None, None
    for nodes, which, predicted, sensor, scaled in reversed(history):
        is_leaf, prediction = np.ones(nodes, bool), predicted.copy()
        if len(which):
            (l1, l2), (p1, p2) = leaf.reshape(-1, 2).T, said.reshape(-1, 2).T
            folds = l1 & l2 & (p1 == p2)
            is_leaf[which], prediction[which] = folds, np.where(folds, p1, predicted[which])
            sums += np.bincount(sensor[~folds], weights=scaled[~folds], minlength=width)
        leaf, said = is_leaf, prediction
    return sums, bool(leaf[0]), int(said[0])


def _walk(top: dict[int, tuple[int, int]], bins: np.ndarray) -> np.ndarray:
    """The node that each row has come to; node h has the children 2 h and 2 h + 1, and parents come first in ``top``."""
    node = np.ones(bins.shape[1], np.int64)
    for h, (sensor, last) in top.items():
        here = np.flatnonzero(node == h)
        node[here] = 2 * h + (bins[sensor, here] > last)
    return node


def _split_large(
    blocks: RDD, sizes: tuple[int, int], trees: int, w: np.ndarray, depth: int, k: int, seed: int, bootstrap: bool
) -> tuple[list[dict], dict, dict, dict]:
    """Split nodes that are too large for a task, all of a level at once, by counts over all blocks.

    Returns per tree the splits, per (tree, node) the gain times weight, the size of nodes left to tasks, and the leaves' classes.
    """
    rows, width = sizes
    tops: list[dict[int, tuple[int, int]]] = [{} for _ in range(trees)]
    gains, small, leaves = {}, {}, {}
    large = [(t, 1) for t in range(trees)] if rows * width > LOCAL_CELLS else []
    if not large:
        small = {(t, 1): rows for t in range(trees)}
    while large:
        wanted = defaultdict(dict)
        for t, h in large:
            wanted[t][h] = _tried(np.random.default_rng([seed, t, h, 1]), 1, width, k)[0]

        def counted(part, tops=tops, wanted=wanted):
            found = {}
            for block, n, bins, y in part:
                bins, y = np.frombuffer(bins, np.uint8).reshape(width, n), np.frombuffer(y, np.uint8)
                for t, nodes in wanted.items():
                    times, node = _bag(seed, t, block, n, bootstrap), _walk(tops[t], bins)
                    for h, sensors in nodes.items():
                        row = np.flatnonzero((node == h) & (times > 0))
                        cells = (bins[sensors][:, row].astype(np.int64) + BINS * np.arange(k)[:, None]) * 2 + y[row]
                        count = np.bincount(cells.ravel(), weights=np.tile(times[row].astype(np.float64), k), minlength=k * BINS * 2)
                        found[t, h] = found[t, h] + count if (t, h) in found else count
            return iter(found.items())

        def decided(cells):
            cells = cells.reshape(k, BINS, 2)
            parents = cells.sum(axis=1)
            if not parents[0].all():
                return parents[0], 0.0, 0, 0, parents[0]
            gain, last, left = _best(cells, parents, w)
            i = int(np.argmax(gain))
            return parents[0], float(gain[i]), i, int(last[i]), left[i]

        found = blocks.mapPartitions(counted).reduceByKey(np.add).mapValues(decided).collect()
        large = []
        for (t, h), (counts, gain, i, last, left) in sorted(found, key=lambda x: x[0]):
            if gain <= 0:
                leaves[t, h] = int(counts[1] * w[1] > counts[0] * w[0])
                continue
            tops[t][h] = int(wanted[t][h][i]), last
            gains[t, h] = gain * float((counts * w).sum())
            for child, of_child in ((2 * h, left), (2 * h + 1, counts - left)):
                if child.bit_length() > depth or not of_child.all():
                    leaves[t, child] = int(of_child[1] * w[1] > of_child[0] * w[0])
                elif of_child.sum() * width > LOCAL_CELLS:
                    large.append((t, child))
                else:
                    small[t, child] = int(of_child.sum())
    return tops, gains, small, leaves


def _packs(small: dict[tuple[int, int], int], most: int, least: int) -> list[list[tuple[int, int]]]:
    """Nodes dealt to tasks, the largest first: ``least`` tasks, or as many as hold ``most`` rows each."""
    share = min(most, max(1, sum(small.values()) // least))
    packs, held = [], share
    for unit in sorted(small, key=lambda u: (-small[u], u)):
        if held + small[unit] > share:
            packs.append([])
            held = 0
        packs[-1].append(unit)
        held += small[unit]
    return packs


def _grow_small(
    blocks: RDD, small: dict, tops: list, width: int, w: np.ndarray, depth: int, k: int, seed: int, bootstrap: bool
) -> list[tuple[tuple[int, int], tuple[np.ndarray, bool, int]]]:
    """Grow the subtrees of all remaining nodes, each in one task."""
    tasks = 2 * blocks.context.defaultParallelism
    whole = not any(tops)  # trees that begin in the task share their rows
    if whole:
        units = sorted(small)
        packs = [units[i::tasks] for i in range(min(tasks, len(units)))]
    else:
        packs = _packs(small, max(1, LOCAL_CELLS // width), tasks)
    place = {unit: p for p, pack in enumerate(packs) for unit in pack}
    of_tree = defaultdict(list)
    for t, h in place:
        of_tree[t].append(h)

    def dealt(part: Iterator) -> Iterator:
        for block, n, bins, y in part:
            if whole:
                yield from ((p, (None, block, n, None, bins, y)) for p in range(len(packs)))
                continue
            cells, label = np.frombuffer(bins, np.uint8).reshape(width, n), np.frombuffer(y, np.uint8)
            for t, nodes in of_tree.items():
                node, bagged = _walk(tops[t], cells), _bag(seed, t, block, n, bootstrap) > 0
                for h in nodes:
                    row = np.flatnonzero((node == h) & bagged)
                    if len(row):
                        yield place[t, h], ((t, h), block, n, row.astype(np.int32).tobytes(), cells[:, row].tobytes(), label[row].tobytes())

    def grown(part: Iterator) -> Iterator:
        parts = defaultdict(list)
        for p, (unit, *rest) in part:
            parts[p, unit].append(rest)
        for p, unit in sorted(parts):
            own = sorted(parts.pop((p, unit)), key=lambda x: x[0])
            bins = np.concatenate([np.frombuffer(x[3], np.uint8).reshape(width, -1) for x in own], axis=1)
            y = np.concatenate([np.frombuffer(x[4], np.uint8) for x in own])
            own = [(block, n, None if row is None else np.frombuffer(row, np.int32)) for block, n, row, _, _ in own]
            for t, h in packs[p] if unit is None else [unit]:
                bags = ((_bag(seed, t, block, n, bootstrap), row) for block, n, row in own)
                counts = np.concatenate([bag if row is None else bag[row] for bag, row in bags])
                if counts.any():
                    yield (t, h), grow(bins, y, counts, w, depth - h.bit_length() + 1, k, np.random.default_rng([seed, t, h, 1]))

    return blocks.mapPartitions(dealt).partitionBy(len(packs), lambda p: p).mapPartitions(grown).collect()


def importances(
    train: DataFrame, weights: dict[int, float], rows: int, width: int, trees: int, depth: int, seed: int,
    per_node: int | None = None, bootstrap: bool = True,
) -> np.ndarray:
    """Mean over the trees of each sensor's share of the tree's gain; they add up to 1, or are all 0 where no tree splits.

    ``train`` has ``y`` (0 or 1) and ``values``; ``weights`` are those of the classes. ``per_node`` is how many sensors a node tries.
    """
    if not rows or not width:
        raise ValueError("no training rows or sensors")
    if not set(weights) <= {0, 1}:
        raise ValueError(f"classes other than 0 and 1: {sorted(weights, key=str)}")
    if depth < 1:  # roots only
        return np.zeros(width)
    w = np.array([float(weights.get(c, 0.0)) for c in (0, 1)])
    k = per_node or int(np.ceil(np.sqrt(width)))
    kept = materialize(binned_blocks(train, bin_bounds(train, weights, rows, width, seed)), "binned-blocks")
    blocks = kept.rdd.map(tuple)
    tops, gains, small, leaves = _split_large(blocks, (rows, width), trees, w, depth, k, seed, bootstrap)
    sums = np.zeros((trees, width))
    for (t, h), (of_unit, leaf, prediction) in _grow_small(blocks, small, tops, width, w, depth, k, seed, bootstrap) if small else ():
        sums[t] += of_unit
        if leaf:
            leaves[t, h] = prediction
    discard(kept)
    for t, top in enumerate(tops):
        for h in sorted(top, reverse=True):
            one, other = leaves.get((t, 2 * h)), leaves.get((t, 2 * h + 1))
            if one is not None and one == other:
                leaves[t, h] = one
            else:
                sums[t, top[h][0]] += gains[t, h]
    of_tree = sums.sum(axis=1, keepdims=True)
    mean = np.divide(sums, of_tree, out=np.zeros_like(sums), where=of_tree > 0).sum(axis=0)
    return mean / mean.sum() if mean.sum() else mean
