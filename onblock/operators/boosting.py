"""Gradient boosting on histograms, leaf by leaf, for any number of models in the same passes over their rows.

Rows are binned once into blocks of one byte per feature. A job brings, for all models at once, the gradient histograms of the nodes
whose splits are still unknown: partitions sum them for the smaller child of every split, the larger one is the parent less its
sibling. Trees grow best first to MAX_LEAVES leaves; since a job explores the whole frontier, a tree takes about as many jobs as it
is deep, and models growing side by side share them. Missing values go to the side that gains more.

Leaves of the logistic loss hold Newton steps, those of the absolute loss exact medians: one job brings evenly spaced residuals of
every leaf and block, which bracket all medians, a second one the residuals in the brackets.

These are many small passes over the same rows that change one number a row each round, which data frames would plan anew every time;
so the blocks are an RDD, each round's a narrow map of the last, persisted and checkpointed in the shared folder every few rounds.
Rows that fit into one block grow their trees where the block is, by the same steps, each model in a task of its own; there the rows
of every open node stay known from one pass to the next, and as a pass costs no job, it takes one split that is sure to stay rather than
a whole frontier of which half would be left out. The rows of the leaves are then known too, so medians are taken where they lie, and no
row goes through the tree again. Sums are added in the order of the rows, as in any other block, so results are the same to the last digit.

Larger sets grow the same way where the shared folder is a plain path that all tasks see: the tasks of one job, one for each core, keep
their blocks and answer what the driver asks through small files there, so a pass costs milliseconds instead of a job. A task that
starts again takes its block once more and repeats the moves it has missed. Where that folder is no path, is slow, or not all tasks get
to run at once, or their rows are too many to keep, every pass is a job.
"""

from __future__ import annotations

import heapq
import json
import os
import pickle
import shutil
import sys
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from onblock.runtime import at_once, fresh_path, shared_folder

LOGISTIC, ABSOLUTE = "logistic", "absolute"
MAX_LEAVES, LEAF_ROWS, BINS = 31, 20, 255
LEAST_HESSIAN = 1e-3
MISSING = 255
BLOCK_ROWS = 1_000_000
SAMPLES = 256
WORD = 8  # features of a row that one look-up brings
COUNTED = float(1 << 26)  # a row's weight above the sum of signs, which stays below half of it
CHECKPOINT_EVERY = 25
DIRECT_BLOCKS = 16
EDGE_ACCURACY = 10_000
KEPT_ROWS = 4_000_000  # rows times models that a task keeps, at about 120 bytes each
START_SECONDS = 60  # how long tasks that keep blocks wait for each other to start
SLOW_SECONDS = 0.2  # an exchange through files that takes longer is not worth it
PAUSE = 0.0003
AHEAD = 0.5

# Worker functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Task:
    """One model to grow: its loss, label column and feature columns. Rows without a label take no part."""

    loss: str
    label: str
    features: list[str]


@dataclass
class Tree:
    """Nodes from the root on; a leaf has feature -1. Rows go left up to the threshold, missing values where missing_left says."""

    feature: list[int]
    threshold: list[float]
    cut: list[int]
    missing_left: list[bool]
    left: list[int]
    right: list[int]
    value: list[float]


@dataclass
class Boosted:
    """A grown model; transform adds the probability (logistic) or the predicted value (absolute)."""

    loss: str
    features: list[str]
    start: float
    step: float
    trees: list[Tree] = field(default_factory=list)

    def transform(self, df: DataFrame, output: str = "prediction", columns: list[str] | None = None) -> DataFrame:
        """Adds the prediction from all trees in one projection. columns names the features in df, by default as in training."""
        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns or self.features])
        return df.withColumn(output, _forest(self)(values))

    def to_json(self) -> str:
        return json.dumps({**vars(self), "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        saved = json.loads(text)
        return Boosted(**{**saved, "trees": [Tree(**t) for t in saved["trees"]]})

    def save(self, path: str) -> None:
        SparkSession.active().createDataFrame([(self.to_json(),)], "value string").write.mode("overwrite").text(path)

    @staticmethod
    def load(path: str) -> Boosted:
        rows = SparkSession.active().read.option("wholetext", True).text(path)
        return Boosted.from_json(rows.filter("length(value) > 1").first()[0])


def _leaf_of(tree: Tree, columns: Callable[[int], np.ndarray], n: int, cuts: list, missing: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The leaf that each of n rows reaches; rows of a node are split together."""
    out = np.zeros(n, np.int32)
    waiting = [(0, np.arange(n))]
    while waiting:
        node, rows = waiting.pop()
        if tree.feature[node] < 0 or not len(rows):
            out[rows] = node
            continue
        x = columns(tree.feature[node])[rows]
        goes_left = x <= cuts[node]  # no missing value is
        if tree.missing_left[node]:
            goes_left |= missing(x)
        waiting += [(tree.left[node], rows[goes_left]), (tree.right[node], rows[~goes_left])]
    return out


def _leaf_masks(model: Boosted) -> tuple[dict[int, np.ndarray], list[tuple[list[tuple[int, np.ndarray]], np.ndarray]]]:
    """The thresholds of every feature, and for every tree its features' masks by a value's place among them, and its leaves' values.

    Leaves are numbered from the left, one a bit. A split that sends a row right rules out the leaves on its left; the masks of all
    features together leave the row's leaf as the lowest bit. The place behind the last threshold is that of a missing value.
    """
    bounds: dict[int, set[float]] = {}
    for tree in model.trees:
        for feature, threshold in zip(tree.feature, tree.threshold, strict=True):
            if feature >= 0:
                bounds.setdefault(feature, set()).add(threshold)
    thresholds = {f: np.array(sorted(found)) for f, found in bounds.items()}
    out = []
    for tree in model.trees:
        masks: dict[int, np.ndarray] = {}
        values: list[float] = []
        waiting: list[tuple[int, int | None]] = [(0, None)]
        while waiting:
            node, begun = waiting.pop()
            feature = tree.feature[node]
            if feature < 0:
                values.append(tree.value[node])
            elif begun is None:
                waiting += [(tree.right[node], None), (node, len(values)), (tree.left[node], None)]
            else:  # its left side is numbered now
                known = thresholds[feature]
                goes_right = np.arange(len(known) + 2) > np.searchsorted(known, tree.threshold[node])
                goes_right[-1] = not tree.missing_left[node]
                mask = masks.setdefault(feature, np.full(len(known) + 2, (1 << 64) - 1, np.uint64))
                mask[goes_right] &= np.uint64(~(((1 << len(values)) - 1) ^ ((1 << begun) - 1)) & ((1 << 64) - 1))
        kind = np.uint32 if len(values) <= 32 else np.uint64
        out.append(([(feature, mask.astype(kind)) for feature, mask in masks.items()], np.array(values)))
    return thresholds, out


def _forest(model: Boosted):
    """Arrow UDF from an array of feature values to the prediction."""

    loss, start, step = model.loss, model.start, model.step
    few = all(tree.feature.count(-1) <= 64 for tree in model.trees)
    thresholds, trees = _leaf_masks(model) if few else ({}, [])
    walked = [] if few else model.trees

    @F.arrow_udf(T.DoubleType())
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            raw = np.full(len(rows), start)
            if len(rows):
                x = np.asfortranarray(np.array(rows.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), -1))
                places = {f: np.where(np.isnan(x[:, f]), len(known) + 1, np.searchsorted(known, x[:, f])) for f, known in thresholds.items()}
                for masks, value in trees:
                    left = None
                    for f, mask in masks:
                        own = mask.take(places[f], mode="clip")  # all places are there; clip is the fast way
                        left = own if left is None else np.bitwise_and(left, own, out=left)
                    raw += step * (value[0] if left is None else value.take(np.bitwise_count((left & -left) - left.dtype.type(1)), mode="clip"))
                for tree in walked:
                    raw += step * np.array(tree.value)[_leaf_of(tree, lambda f: x[:, f], len(rows), tree.threshold, np.isnan)]
            yield pa.array(_probability(raw) if loss == LOGISTIC else raw)

    return predicted


def _probability(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> tuple[int, list[np.ndarray]]:
    """The number of rows, and for every feature the upper bounds of all bins but the last, from one aggregate."""
    at = [i / bins for i in range(1, bins)]
    edges = [F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), at, EDGE_ACCURACY) for f in features]
    n, *found = df.agg(F.count(F.lit(1)), *edges).first()
    return n, [np.unique(np.array(bounds or [], np.float64)) for bounds in found]


def _binned(edges: list[np.ndarray], n_labels: int):
    """Batches of features and labels -> pickled blocks of bins (a row a feature) and labels."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[np.ndarray]]] = []

        def block() -> pa.RecordBatch:
            bins = np.concatenate([b for b, _ in held], axis=1)
            labels = [np.concatenate(parts) for parts in zip(*(y for _, y in held), strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((bins, labels))], pa.binary())], ["block"])

        for batch in batches:
            columns = [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(len(edges) + n_labels)]
            bins = np.empty((len(edges), batch.num_rows), np.uint8)
            for row, x, bounds in zip(bins, columns, edges, strict=False):
                row[:] = np.where(np.isnan(x), MISSING, np.searchsorted(bounds, x))
            held.append((bins, columns[len(edges) :]))
            if sum(b.shape[1] for b, _ in held) >= BLOCK_ROWS:
                yield block()
        if held:
            yield block()

    return build


@dataclass
class _Growing:
    """A model while it grows: what the driver knows of its current tree."""

    task: Task
    data: int  # which of the row sets
    number: int  # which label of that set
    columns: list[int]  # its features among those of the set
    edges: list[np.ndarray]
    model: Boosted
    max_leaves: int
    min_rows: int
    sure: bool = False  # explore only splits that are sure to stay, not the whole frontier
    ahead: float = 0.0  # or this share of those that would stay by what is known
    nodes: list[dict] = field(default_factory=list)
    done: bool = False
    leaves: dict[int, int] = field(default_factory=dict)  # place in the final tree of every open node, or of the leaf above it

    def plant(self) -> None:
        self.nodes, self.done = [{"place": (0,)}], False

    def asked(self) -> list[int]:
        """Nodes whose histograms a job has to bring: the root, or the smaller child of every newly split node."""
        if "hist" not in self.nodes[0]:
            return [0]
        return [min((n["left"], n["right"]), key=lambda c: self.nodes[c]["n"]) for n in self.nodes if "left" in n and "hist" not in self.nodes[n["left"]]]

    def shape(self) -> Tree:
        """The explored nodes as a tree on bins."""
        inner = ["left" in n for n in self.nodes]
        pick = lambda name, none: [n[name] if ok else none for n, ok in zip(self.nodes, inner, strict=True)]
        return Tree(pick("feature", -1), [0.0] * len(inner), pick("cut", 0), pick("missing_left", False), pick("left", 0), pick("right", 0), [])

    def take(self, found: dict[int, np.ndarray]) -> None:
        """Histograms of the asked nodes; siblings follow by subtraction, and the frontier is split as far as leaves may be left."""
        for node, hist in found.items():
            self._learn(node, hist)
        for n in self.nodes:
            if "left" in n:
                left, right = n["left"], n["right"]
                for known, other in ((left, right), (right, left)):
                    if "hist" in self.nodes[known] and "hist" not in self.nodes[other]:
                        self._learn(other, n["hist"] - self.nodes[known]["hist"])
        chosen, open_nodes, blocked = self._best_first()
        self.done = not blocked
        if blocked:
            room = self.max_leaves - 1 - len(chosen)
            if self.sure:
                for node in blocked[: max(1, int(len(blocked) * self.ahead))]:
                    self._split(node)
                return
            for node in sorted(open_nodes, key=lambda i: (-self.nodes[i]["gain"], self.nodes[i]["place"]))[: room + len(blocked)]:
                self._split(node)

    def _learn(self, node: int, hist: np.ndarray) -> None:
        n = self.nodes[node]
        n["hist"] = hist
        n["n"], n["g"], n["h"] = hist[:, 0].sum(axis=1)
        n |= best_split(hist, self.min_rows) if n["n"] >= 2 * self.min_rows else {"gain": 0.0}

    def _split(self, node: int) -> None:
        n = self.nodes[node]
        if "left" not in n:
            n["left"], n["right"] = len(self.nodes), len(self.nodes) + 1
            for side, rows in enumerate((n["n_left"], n["n"] - n["n_left"])):
                self.nodes.append({"n": rows, "place": (n["place"][0] + 1, -n["gain"], n["place"], side)})

    def _best_first(self) -> tuple[list[int], list[int], list[int]]:
        """Splits in best-first order as far as gains are known; open nodes worth exploring; those that hold the order up.

        Equal gains go by the place in the tree, the upper first, then by the parents' order, so the tree does not depend on what was explored.
        """
        heap, chosen, blocked = [], [], []
        push = lambda i: self.nodes[i]["gain"] > 0 and heapq.heappush(heap, (-self.nodes[i]["gain"], self.nodes[i]["place"], i))
        push(0)
        open_nodes = []
        while heap and len(chosen) < self.max_leaves - 1:
            *_, node = heapq.heappop(heap)
            chosen.append(node)
            n = self.nodes[node]
            if "left" in n and "hist" in self.nodes[n["left"]]:
                push(n["left"])
                push(n["right"])
            else:
                open_nodes.append(node)
                # With the last leaf given the children's gains no longer matter; their sums come from their histograms where that costs no job.
                if self.sure or len(chosen) < self.max_leaves - 1:
                    blocked.append(node)
        return chosen, open_nodes, blocked

    def tree(self) -> Tree:
        """The final tree: the best-first splits and their leaves, with Newton steps as values."""
        chosen = set(self._best_first()[0])
        for node in chosen:
            self._split(node)
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            if node in chosen:
                waiting += [self.nodes[node]["right"], self.nodes[node]["left"]]
        at = {node: i for i, node in enumerate(order)}
        place = {node: i for node, i in at.items() if node not in chosen}
        for node, n in enumerate(self.nodes):  # parents come first
            if node in place and "left" in n:
                place[n["left"]] = place[n["right"]] = place[node]
        self.leaves = {node: i for node, i in place.items() if "left" not in self.nodes[node]}
        out = Tree([], [], [], [], [], [], [])
        for node in order:
            n = self.nodes[node]
            inner = node in chosen
            edges = self.edges[self.columns[n["feature"]]] if inner else ()
            out.feature.append(n["feature"] if inner else -1)
            out.cut.append(n["cut"] if inner else 0)
            # A cut behind the last bin parts missing values from all others.
            out.threshold.append(float(edges[n["cut"]]) if inner and n["cut"] < len(edges) else float("inf"))
            out.missing_left.append(bool(n["missing_left"]) if inner else False)
            out.left.append(at[n["left"]] if inner else 0)
            out.right.append(at[n["right"]] if inner else 0)
            parent_split = None if inner else self._sums(node)
            out.value.append(0.0 if inner else float(-parent_split[0] / max(parent_split[1], 1e-12)))
        return out

    def _sums(self, node: int) -> tuple[float, float]:
        """Gradient and hessian of a leaf; those of an unexplored child follow from its parent's histogram."""
        n = self.nodes[node]
        if "g" in n:
            return n["g"], n["h"]
        parent = next(p for p in self.nodes if node in (p.get("left"), p.get("right")))
        _, g, h = parent["sums_left"]
        return (g, h) if node == parent["left"] else (parent["g"] - g, parent["h"] - h)


def best_split(hist: np.ndarray, min_rows: int) -> dict:
    """gain, feature, cut, missing_left, n_left and sums_left of the best split of a histogram ((rows, gradient, hessian), feature, bin).

    Ties go to the first feature, missing values to the right first, the first cut. gain is 0 if no split leaves min_rows on both sides.
    """
    n, g, h = hist[:, 0].sum(axis=1)
    whole = g * g / max(h, 1e-12)
    upto = np.cumsum(hist[:, :, :MISSING], axis=2)
    sides = [upto, upto + hist[:, :, MISSING, None]] if hist[0, :, MISSING].any() else [upto]
    best: dict = {"gain": 0.0}
    found = (1e-12 * max(1.0, abs(whole)), 0, 0, 0)
    for side, (rows, left_g, left_h) in enumerate(sides):
        right_g, right_h = g - left_g, h - left_h
        ok = (rows >= min_rows) & (n - rows >= min_rows) & (left_h >= LEAST_HESSIAN) & (right_h >= LEAST_HESSIAN)
        gain = np.full(rows.shape, -1.0)
        gain[ok] = left_g[ok] ** 2 / left_h[ok] + right_g[ok] ** 2 / right_h[ok] - whole
        if not gain.size:
            continue
        feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        key = (float(gain[feature, cut]), -int(feature), -side, -int(cut))
        if key[0] > found[0] or (best["gain"] and key > found):
            sums = tuple(float(x[feature, cut]) for x in (rows, left_g, left_h))
            found = key
            if upto[0, feature, cut] == upto[0, feature, -1]:  # parts missing values from all others, also from larger ones than were seen
                cut = MISSING - 1
            best = {"gain": key[0], "feature": int(feature), "cut": int(cut), "missing_left": bool(side), "n_left": sums[0], "sums_left": sums}
    return best


# ---- what runs on a block: (set, bins, labels, running predictions, what is known of it in this round by label)


def _gradients(loss: str, y: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """What histograms sum: gradient and hessian as the two parts of a number, or the sign above which rows are counted (all exact)."""
    if loss == LOGISTIC:
        p = _probability(raw)
        out = np.empty(len(p), np.complex128)
        out.real, out.imag = p - y, p * (1 - p)
        return out
    return COUNTED + np.sign(raw - y)


def _reached(tree: Tree, bins: np.ndarray, columns: list[int], known: dict) -> np.ndarray:
    """The leaf of every row, found once for a final tree."""
    if known.get("tree") is not tree:
        known |= {"tree": tree, "leaf": _leaf_of(tree, lambda f: bins[columns[f]], bins.shape[1], tree.cut, lambda x: x == MISSING)}
        known.pop("residuals", None)
        known.pop("rows", None)
    return known["leaf"]


def _open_rows(tree: Tree, bins: np.ndarray, columns: list[int], y: np.ndarray, known: dict) -> dict[int, np.ndarray]:
    """The labelled rows of every open node of a growing tree, ascending. Nodes are numbered as they come, parents first."""
    held = known.setdefault("nodes", {})
    if not held:
        held[0] = np.flatnonzero(~np.isnan(y))
    for node, feature in enumerate(tree.feature):
        if feature >= 0 and node in held:
            rows = held.pop(node)
            x = bins[columns[feature]].take(rows)
            goes_left = x <= tree.cut[node]
            if tree.missing_left[node]:
                goes_left |= x == MISSING
            held[tree.left[node]], held[tree.right[node]] = rows.compress(goes_left), rows.compress(~goes_left)
    return held


def _words(bins: np.ndarray) -> list[np.ndarray]:
    """The bins of WORD features of a row side by side, for all features."""
    out = []
    for first in range(0, len(bins), WORD):
        side = np.zeros((bins.shape[1], WORD), np.uint8)
        side[:, : len(bins) - first] = bins[first : first + WORD].T
        out.append(side.view(np.uint64).ravel())
    return out


def _cells(bins: np.ndarray, columns: list[int], rows: np.ndarray | None, words: list[np.ndarray] | None) -> Iterator[np.ndarray]:
    """The bins of some rows (None: of all) in every column."""
    found: dict[int, np.ndarray] = {}
    for c in columns:
        if rows is None:
            yield bins[c]
        elif words is None:
            yield bins[c].take(rows)
        else:
            if c // WORD not in found:
                found[c // WORD] = words[c // WORD].take(rows).view(np.uint8).reshape(-1, WORD)
            yield found[c // WORD][:, c % WORD]


def _histograms(plans: list[tuple]):
    def count(blocks: Iterator[tuple]) -> Iterator[dict]:
        out: dict[tuple[int, int], np.ndarray] = {}
        for data, bins, labels, raws, known in blocks:
            for m, (of, number, loss, columns, tree, asked) in enumerate(plans):
                if of != data or not asked:
                    continue
                y, raw = labels[number], raws[number]
                held = _open_rows(tree, bins, columns, y, known.setdefault(number, {}))
                parts = [held[node] for node in asked]
                rows = np.concatenate(parts) if len(parts) > 1 else parts[0]
                every = len(parts) == 1 and len(rows) == len(y)  # all rows as they are, such as the root's
                if asked == [0]:
                    known[number]["gradients"] = _gradients(loss, y, raw)
                if "gradients" in known[number]:
                    held = known[number]["gradients"]
                    weights = held if every else held.take(rows)
                else:
                    weights = _gradients(loss, y[rows], raw[rows])
                base, size = np.repeat(np.arange(len(asked)) << 8, [len(part) for part in parts]), len(asked) << 8
                hist = np.empty((3, len(columns), size))
                for k, cell in enumerate(_cells(bins, columns, None if every else rows, known.get("words"))):
                    cell = base | cell if len(asked) > 1 else cell.astype(np.intp)
                    if loss == LOGISTIC:
                        sums = np.zeros(size, np.complex128)
                        np.add.at(sums, cell, weights)
                        hist[0, k], hist[1, k], hist[2, k] = np.bincount(cell, minlength=size), sums.real, sums.imag
                    else:
                        sums = np.bincount(cell, weights=weights, minlength=size)
                        hist[0, k] = hist[2, k] = np.rint(sums / COUNTED)
                        hist[1, k] = sums - hist[0, k] * COUNTED
                parts = hist.reshape(3, len(columns), len(asked), 256)
                for i, node in enumerate(asked):
                    key = (m, node)
                    out[key] = out[key] + parts[:, :, i] if key in out else np.ascontiguousarray(parts[:, :, i])
        yield out

    return count


def _added(a: dict, b: dict) -> dict:
    return a | {k: a[k] + v if k in a else v for k, v in b.items()}


def _listed(a: dict, b: dict) -> dict:
    return a | {k: a.get(k, []) + v for k, v in b.items()}


def _leaf_rows(tree: Tree, bins: np.ndarray, columns: list[int], y: np.ndarray, known: dict) -> dict[int, np.ndarray]:
    """The labelled rows of every leaf of a final tree."""
    leaf = _reached(tree, bins, columns, known)
    if "rows" not in known:
        labelled = np.flatnonzero(~np.isnan(y))
        order = np.argsort(leaf[labelled], kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[labelled][order])) + 1
        known["rows"] = {int(leaf[rows[0]]): rows for rows in np.split(labelled[order], cuts) if len(rows)}
    return known["rows"]


def _by_leaf(plans: list[tuple], blocks: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Sorted residuals of every (model, leaf) of every block."""
    for data, bins, labels, raws, known in blocks:
        for m, (of, number, columns, tree) in enumerate(plans):
            if of == data:
                own, y, raw = known.setdefault(number, {}), labels[number], raws[number]
                held = _leaf_rows(tree, bins, columns, y, own)
                if "residuals" not in own:
                    own["residuals"] = [(node, np.sort(y.take(rows) - raw.take(rows))) for node, rows in sorted(held.items()) if len(rows)]
                for node, values in own["residuals"]:
                    yield (m, node), values


def _spaced(plans: list[tuple]):
    def sample(blocks: Iterator[tuple]) -> Iterator[dict]:
        out: dict = {}
        for key, values in _by_leaf(plans, blocks):
            at = np.unique(np.linspace(0, len(values) - 1, min(SAMPLES, len(values))).astype(np.int64))
            out.setdefault(key, []).append((len(values), at, values[at]))
        yield out

    return sample


def _between(plans: list[tuple], brackets: dict[tuple[int, int], tuple[float, float]]):
    def collect(blocks: Iterator[tuple]) -> Iterator[dict]:
        out: dict = {}
        for key, values in _by_leaf(plans, blocks):
            if key in brackets:
                low, high = brackets[key]
                a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
                out.setdefault(key, []).append((int(a), *np.unique(values[a:b], return_counts=True)))
        yield out

    return collect


def bracket(samples: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[float, float]:
    """Values between which the median must lie, given each block's size and the values at some of its ranks, ends included."""
    n = sum(size for size, _, _ in samples)
    candidates = np.unique(np.concatenate([values for _, _, values in samples]))
    below_at_most, upto_at_least = np.zeros(len(candidates), np.int64), np.zeros(len(candidates), np.int64)
    for size, ranks, values in samples:
        ends = np.append(ranks, size)
        below_at_most += ends[np.searchsorted(values, candidates, "left")]
        upto_at_least += np.append(0, ranks + 1)[np.searchsorted(values, candidates, "right")]
    low = candidates[np.flatnonzero(below_at_most <= (n - 1) // 2)[-1]] if (below_at_most <= (n - 1) // 2).any() else candidates[0]
    high = candidates[np.flatnonzero(upto_at_least >= n // 2 + 1)[0]]
    return float(low), float(high)


def median_of(n: int, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> float:
    """The median of n values of which some lie below, and the counted ones of all blocks hold the middle."""
    below = sum(a for a, _, _ in parts)
    values, counts = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.argsort(values, kind="stable")
    upto = below + np.cumsum(counts[order])
    pick = lambda rank: values[order][np.searchsorted(upto, rank, "right")]
    return float((pick((n - 1) // 2) + pick(n // 2)) / 2)


def _moved(steps: list[tuple]):
    """The block with one more tree in its running predictions."""

    def move(block: tuple) -> tuple:
        data, bins, labels, raws, known = block
        raws = list(raws)
        for of, number, columns, tree, step in steps:
            if of == data:
                raws[number] = raws[number] + step * np.array(tree.value)[_reached(tree, bins, columns, known.setdefault(number, {}))]
        return data, bins, labels, raws, {}

    return move


def _middle(values: np.ndarray) -> float:
    ends = (len(values) - 1) // 2, len(values) // 2
    low, high = np.partition(values, ends)[list(ends)]
    return float((low + high) / 2)


class _Spread:
    """Blocks of all sets on the executors; every pass over them is a job."""

    def __init__(self, blocks: RDD):
        self.blocks, self.last, self.moves = blocks.persist(StorageLevel.MEMORY_AND_DISK), None, 0

    def gathered(self, work, merge, *plans) -> dict:
        """The merged results of all blocks; beyond a few blocks executors merge them first."""
        results = self.blocks.mapPartitions(work(*plans))
        if results.getNumPartitions() <= DIRECT_BLOCKS:
            return reduce(merge, results.collect(), {})
        return results.treeReduce(merge)

    def settle(self, growing: list[_Growing], trees: list[Tree]) -> None:
        """Rows of open nodes are not kept from job to job."""

    def move(self, steps: list[tuple]) -> None:
        self.drop(self.last)
        self.last, self.moves = self.blocks, self.moves + 1
        self.blocks = self.last.map(_moved(steps)).persist(StorageLevel.MEMORY_AND_DISK)
        if self.moves % CHECKPOINT_EVERY == 0:
            self.blocks.checkpoint()

    def drop(self, *held: RDD | None) -> None:
        for blocks in held:
            if blocks is not None:
                blocks.unpersist()


class _Here:
    """Blocks in this very process."""

    def __init__(self, blocks: list[tuple]):
        self.blocks = blocks

    def gathered(self, work, merge, *plans) -> dict:
        return reduce(merge, work(*plans)(iter(self.blocks)), {})

    def settle(self, growing: list[_Growing], trees: list[Tree]) -> None:
        """The rows of open nodes are those of the leaves, so they need not go through the final trees."""
        for data, bins, _, _, known in self.blocks:
            for g, tree in zip(growing, trees, strict=True):
                held = known.get(g.number, {}).get("nodes", {})
                if data == g.data and held.keys() == g.leaves.keys():
                    leaf = np.zeros(bins.shape[1], np.int32)  # rows without a label stay at the root, as they do not count
                    parts: dict[int, list[np.ndarray]] = {}
                    for node, at in g.leaves.items():
                        leaf[held[node]] = at
                        parts.setdefault(at, []).append(held[node])
                    rows = {at: np.concatenate(own) if len(own) > 1 else own[0] for at, own in parts.items()}
                    known[g.number] |= {"tree": tree, "leaf": leaf, "rows": rows}

    def medians(self, plans: list[tuple]) -> dict[tuple[int, int], float]:
        """The exact median residual of every (model, leaf)."""
        found: dict[tuple[int, int], list[np.ndarray]] = {}
        for data, bins, labels, raws, known in self.blocks:
            for m, (of, number, columns, tree) in enumerate(plans):
                if of == data:
                    y, raw = labels[number], raws[number]
                    for node, rows in _leaf_rows(tree, bins, columns, y, known.setdefault(number, {})).items():
                        if len(rows):
                            found.setdefault((m, node), []).append(y.take(rows) - raw.take(rows))
        return {key: _middle(np.concatenate(parts)) for key, parts in found.items()}

    def move(self, steps: list[tuple]) -> None:
        words = [known.get("words") or _words(bins) for _, bins, *_, known in self.blocks]
        self.blocks = list(map(_moved(steps), self.blocks))
        for (*_, known), side in zip(self.blocks, words, strict=True):
            known["words"] = side


def _put(path: str, content: bytes) -> None:
    """A file that is there with all its content or not at all."""
    with open(f"{path}.new", "wb") as file:
        file.write(content)
    os.replace(f"{path}.new", path)


def _taken(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _serving(folder: str):
    """Task that keeps the blocks of its partition and answers the commands in a folder, in order, until the last or the folder is gone."""

    def serve(index: int, blocks: Iterator[tuple[int, int, bytes]]) -> Iterator[int]:
        if not os.path.isdir(folder):
            return
        here = _Here([_unpacked(data, block) for data, _, block in sorted(blocks, key=lambda b: b[:2])])
        parent = os.getppid()
        # A task that starts again makes the moves it has missed, but answers only what it has not answered yet.
        answered = max((int(name.split("-")[1]) for name in os.listdir(folder) if name.startswith(f"answer{index}-") and name[-1].isdigit()), default=-1)
        trees: list[Tree] = []
        tree_of = lambda sent: trees[sent] if isinstance(sent, int) else Tree(**sent)
        works = {"_histograms": _histograms, "_spaced": _spaced, "_between": _between, "_sums": _sums}
        merges = {"_added": _added, "_listed": _listed}
        at = 0
        while True:
            if at:
                while not os.path.exists(f"{folder}/command{at}"):
                    if not os.path.isdir(folder) or os.getppid() != parent:
                        return
                    time.sleep(PAUSE)
                kind, *command = pickle.loads(_taken(f"{folder}/command{at}"))
            else:
                kind, command = "ready", []
            if kind == "end":
                return
            if kind == "settle":
                trees = [Tree(**sent) for sent in command[0]]
                here.settle([SimpleNamespace(data=d, number=n, leaves=leaves) for d, n, leaves in command[1]], trees)
            elif kind == "move":
                for sent, value in command[1]:
                    trees[sent].value = value
                here.move([(*rest, tree_of(sent), step) for *rest, sent, step in command[0]])
                trees = []
            elif at > answered:
                found: dict = {}
                if kind != "ready":
                    work, merge, plans, others = command
                    found = here.gathered(works[work], merges[merge], [tuple(tree_of(x[1]) if isinstance(x, tuple) and x[:1] == ("tree",) else x for x in plan) for plan in plans], *others)
                _put(f"{folder}/answer{index}-{at}", pickle.dumps(found, pickle.HIGHEST_PROTOCOL))
                for before in (name for name in os.listdir(folder) if name.startswith(f"answer{index}-") and name != f"answer{index}-{at}"):
                    os.remove(f"{folder}/{before}")
            at += 1
        yield  # a task has no rows

    return serve


def _sums(_plans: list):
    return _label_sums


class _Kept:
    """Blocks that the tasks of one job keep, as far as they are there at once; a pass is an exchange of files with them."""

    def __init__(self, blocks: RDD, folder: str, spark: SparkSession):
        self.blocks, self.folder, self.at, self.settled = blocks, folder, 0, {}
        self.n = blocks.getNumPartitions()
        os.makedirs(folder)
        self.thread = ThreadPoolExecutor(1)
        self.job = self.thread.submit(inheritable_thread_target(spark)(lambda: blocks.mapPartitionsWithIndex(_serving(folder)).collect()))

    def started(self) -> bool:
        """Whether all tasks are there and exchanges are fast."""
        until = None
        while len(there := [i for i in range(self.n) if os.path.exists(f"{self.folder}/answer{i}-0")]) < self.n:
            if there and until is None:
                until = time.monotonic() + START_SECONDS
            if self.job.done() or (until and time.monotonic() > until):
                return False
            time.sleep(0.01)
        begun = time.monotonic()
        for _ in range(3):
            self.gathered(_sums, _added, [])
        return time.monotonic() - begun < 3 * SLOW_SECONDS

    def _command(self, *command) -> None:
        self.at += 1
        _put(f"{self.folder}/command{self.at}", pickle.dumps(command, pickle.HIGHEST_PROTOCOL))

    def _sent(self, tree: Tree) -> int | dict:
        return self.settled.get(id(tree), vars(tree))

    def gathered(self, work, merge, plans: list[tuple], *others) -> dict:
        plans = [tuple(("tree", self._sent(x)) if isinstance(x, Tree) else x for x in plan) for plan in plans]
        self._command("gather", work.__name__, merge.__name__, plans, others)
        out: dict = {}
        for i in range(self.n):
            while not os.path.exists(path := f"{self.folder}/answer{i}-{self.at}"):
                if self.job.done():
                    self.job.result()
                    raise RuntimeError("a task that keeps blocks has ended")
                time.sleep(PAUSE)
            out = merge(out, pickle.loads(_taken(path)))
        return out

    def settle(self, growing: list[_Growing], trees: list[Tree]) -> None:
        self.settled = {id(tree): i for i, tree in enumerate(trees)}
        self._command("settle", [vars(tree) for tree in trees], [(g.data, g.number, g.leaves) for g in growing])

    def move(self, steps: list[tuple]) -> None:
        values = [(self.settled[id(tree)], tree.value) for *_, tree, _ in steps if id(tree) in self.settled]
        self._command("move", [(*rest, self._sent(tree), step) for *rest, tree, step in steps], values)
        self.settled = {}

    def end(self) -> None:
        try:
            self._command("end")
            self.job.exception()  # waits
        finally:
            self.thread.shutdown()
            shutil.rmtree(self.folder, ignore_errors=True)


def _plain_path(spark: SparkSession) -> str | None:
    """A fresh folder for exchanges below the shared folder, if that is a plain path."""
    path = fresh_path(spark, "passes")
    path = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")
    return path if path.startswith("/") else None


def _medians(blocks: _Spread | _Here | _Kept, plans: list[tuple]) -> dict[tuple[int, int], float]:
    """The exact median residual of every (model, leaf); one pass if the samples hold all residuals, else two. Where all rows are here, none."""
    if isinstance(blocks, _Here):
        return blocks.medians(plans)
    samples = blocks.gathered(_spaced, _listed, plans)
    n = {key: sum(size for size, _, _ in parts) for key, parts in samples.items()}
    whole = {key for key, parts in samples.items() if all(size == len(ranks) for size, ranks, _ in parts)}
    found = {key: median_of(n[key], [(0, values, np.ones(len(values), np.int64)) for _, _, values in samples[key]]) for key in whole}
    brackets = {key: bracket(parts) for key, parts in samples.items() if key not in whole}
    if brackets:
        parts = blocks.gathered(_between, _listed, plans, brackets)
        found |= {key: median_of(n[key], parts[key]) for key in brackets}
    return found


def _with_start(blocks: _Spread | _Here | _Kept, growing: list[_Growing]) -> None:
    """The constants that rows start with: log-odds of the label, or its median."""
    root = Tree([-1], [0.0], [0], [False], [0], [0], [0.0])
    plans = [(g.data, g.number, [], root) for g in growing]
    middle = _medians(blocks, plans) if any(g.task.loss == ABSOLUTE for g in growing) else {}
    sums = blocks.gathered(_sums, _added, [])
    for m, g in enumerate(growing):
        if g.task.loss == ABSOLUTE:
            g.model.start = middle.get((m, 0), 0.0)
        elif (g.data, g.number) in sums:
            n, positive = sums[g.data, g.number]
            share = min(max(positive / n, 1e-9), 1 - 1e-9) if n else 0.5
            g.model.start = float(np.log(share / (1 - share)))
    blocks.move([(g.data, g.number, [], Tree([-1], [0.0], [0], [False], [0], [0], [g.model.start]), 1.0) for g in growing])


def _label_sums(blocks: Iterator[tuple]) -> Iterator[dict]:
    out: dict = {}
    for data, _, labels, *_ in blocks:
        for number, y in enumerate(labels):
            sums = np.array([(~np.isnan(y)).sum(), np.nansum(y)])
            out[data, number] = out[data, number] + sums if (data, number) in out else sums
    yield out


def _grow(blocks: _Spread | _Here | _Kept, growing: list[_Growing], rounds: int) -> None:
    """All rounds of all models over the same passes."""
    _with_start(blocks, growing)
    for _ in range(rounds):
        for g in growing:
            g.plant()
        while not all(g.done for g in growing):
            asked = [[] if g.done else g.asked() for g in growing]
            plans = [(g.data, g.number, g.task.loss, g.columns, g.shape(), a) for g, a in zip(growing, asked, strict=True)]
            found = blocks.gathered(_histograms, _added, plans)
            for m, (g, a) in enumerate(zip(growing, asked, strict=True)):
                if not g.done:
                    none = np.zeros((3, len(g.columns), 256))
                    g.take({node: found.get((m, node), none) for node in a})
        trees = [g.tree() for g in growing]
        blocks.settle(growing, trees)
        absolute = [m for m, g in enumerate(growing) if g.task.loss == ABSOLUTE]
        if absolute:
            middle = _medians(blocks, [(growing[m].data, growing[m].number, growing[m].columns, trees[m]) for m in absolute])
            for i, m in enumerate(absolute):
                trees[m].value = [middle.get((i, node), 0.0) if f < 0 else 0.0 for node, f in enumerate(trees[m].feature)]
        for g, tree in zip(growing, trees, strict=True):
            g.model.trees.append(tree)
        blocks.move([(g.data, g.number, g.columns, tree, g.model.step) for g, tree in zip(growing, trees, strict=True)])


def _grown_here(growing: _Growing, rounds: int):
    """Task that grows a model on a set whose rows are all in one block."""

    def grow(blocks: Iterator[tuple]) -> Iterator[tuple[int, int, str]]:
        if held := list(blocks):
            growing.sure = True
            _grow(_Here(held), [growing], rounds)
            yield growing.data, growing.number, growing.model.to_json()

    return grow


def fit_boosted(
    sets: list[tuple[DataFrame, list[Task]]],
    rounds: int = 300,
    step: float = 0.1,
    max_leaves: int = MAX_LEAVES,
    min_rows: int = LEAF_ROWS,
    max_bins: int = BINS,
    block_rows: int = BLOCK_ROWS,
) -> list[list[Boosted]]:
    """Grows the models of all row sets, `rounds` trees each; those of one set share every pass over its rows.

    A set is a table and the tasks on it; its rows are binned once, over the features of all its tasks. Null and NaN features are
    missing values, rows without a task's label do not count for it, a task whose labels are all alike only keeps its start, and
    the models of a set without rows have no trees.

    Sets of more than block_rows rows grow side by side, in tasks that keep their rows or else by a job a level; the driver holds the
    histograms of one tree a model, never rows. A set of one block has nothing to sum over blocks, so its levels need no jobs: a task for each of its models does the same steps
    beside the block.
    """
    spark = sets[0][0].sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    growing: dict[int, list[_Growing]] = {}
    dealt: dict[int, RDD] = {}
    rows_of: dict[int, int] = {}
    cores = sc.defaultParallelism

    def kept_rows(data: int) -> int:
        """Rows times models of a set in each of the tasks that keep it."""
        return -(-rows_of[data] // cores) * len(sets[data][1])

    def bin_rows(data: int) -> None:
        df, tasks = sets[data]
        features = list(dict.fromkeys(f for t in tasks for f in t.features))
        labels = [F.col(t.label).cast("double").alias(f"_label{i}") for i, t in enumerate(tasks)]
        rows = df.select(*[F.col(f).cast("double").alias(f"_feature{i}") for i, f in enumerate(features)], *labels)
        n, edges = bin_edges(rows, [f"_feature{i}" for i in range(len(features))], max_bins)
        rows_of[data] = n
        # Beyond one block the passes wait for the largest block, so that all cores get a share.
        parts = 1 if n <= block_rows else max(2, cores) if kept_rows(data) <= KEPT_ROWS else max(-(-n // block_rows), -(-cores // len(sets)))
        dealt[data] = _numbered(data, rows.repartition(parts).mapInArrow(_binned(edges, len(tasks)), "block binary"))
        models = [Boosted(t.loss, list(t.features), 0.0, step) for t in tasks]
        growing[data] = [
            _Growing(t, data, i, [features.index(f) for f in t.features], edges, m, max_leaves, min_rows)
            for i, (t, m) in enumerate(zip(tasks, models, strict=True))
        ]

    at_once(spark, bin_rows, range(len(sets)))
    whole = [data for data in range(len(sets)) if rows_of[data] <= block_rows]
    out = {data: [g.model for g in own] for data, own in growing.items()}
    if whole:
        here = [dealt[data].values().map(lambda b: _unpacked(b[0], b[2])).mapPartitions(_grown_here(g, rounds)) for data in whole for g in growing[data]]
        for data, number, text in sc.union(here).collect():
            out[data][number] = Boosted.from_json(text)
    spread = [data for data in range(len(sets)) if data not in whole]
    groups: list[list[int]] = []
    for data in [data for data in spread if kept_rows(data) <= KEPT_ROWS]:
        if groups and sum(map(kept_rows, groups[-1])) + kept_rows(data) <= KEPT_ROWS:
            groups[-1].append(data)
        else:
            groups.append([data])
    for group in groups:
        _grow_kept(spark, [dealt[data] for data in group], [g for data in group for g in growing[data]], rounds)
    if many := [data for data in spread if kept_rows(data) > KEPT_ROWS]:
        binned = sc.union([dealt[data].values() for data in many])
        _grow_spread(binned, [g for data in many for g in growing[data]], rounds)
    return [out[data] for data in range(len(sets))]


def _numbered(data: int, dealt: DataFrame) -> RDD:
    """Every block of a set with its partition, the set, and its place there."""
    return dealt.rdd.mapPartitionsWithIndex(lambda part, rows: ((part, (data, at, bytes(row[0]))) for at, row in enumerate(rows)))


def _grow_kept(spark: SparkSession, dealt: list[RDD], growing: list[_Growing], rounds: int) -> None:
    """Grows models on sets that have a block for each core: each task keeps its share of all sets, where that is possible."""
    shares = dealt[0] if len(dealt) == 1 else spark.sparkContext.union(dealt).partitionBy(dealt[0].getNumPartitions(), lambda part: part)
    binned = shares.values().persist(StorageLevel.MEMORY_AND_DISK)
    binned.checkpoint()
    binned.count()
    binned.unpersist()  # the tasks read the checkpoint
    folder = _plain_path(spark)
    if folder is not None:
        kept = _Kept(binned, folder, spark)
        try:
            if kept.started():
                for g in growing:
                    g.sure, g.ahead = True, AHEAD
                return _grow(kept, growing, rounds)
        finally:
            kept.end()
    _grow_spread(binned, growing, rounds)


def _grow_spread(binned: RDD, growing: list[_Growing], rounds: int) -> None:
    """Grows models with a job for every pass over the blocks."""
    blocks = binned.map(lambda block: _unpacked(block[0], block[2])).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.checkpoint()
    passes = _Spread(blocks)
    _grow(passes, growing, rounds)
    passes.drop(passes.blocks, passes.last, blocks)


def _unpacked(data: int, block: bytes) -> tuple:
    """A block before the first move."""
    bins, labels = pickle.loads(block)
    return data, bins, labels, [np.zeros(bins.shape[1]) for _ in labels], {}
