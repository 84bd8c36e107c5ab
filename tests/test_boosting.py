"""Histogram boosting against a plain version that grows one leaf after another on the same bins."""

import shutil
import threading
from concurrent.futures import Future

import numpy as np
import pandas as pd
import pytest

from onblock.operators import boosting
from onblock.operators.boosting import ABSOLUTE, LOGISTIC, Boosted, Task, bracket, fit_boosted, median_of

FEATURES = ["a", "b", "c", "d"]


def table(n, seed=1):
    rng = np.random.default_rng(seed)
    x = {"a": rng.normal(size=n), "b": rng.integers(0, 6, n).astype(float), "c": rng.exponential(size=n), "d": np.zeros(n)}
    x["c"][rng.random(n) < 0.2] = np.nan
    signal = x["a"] * 2 + (x["b"] == 3) * 3 + np.where(np.isnan(x["c"]), 2, x["c"])
    late = (signal + rng.normal(size=n) > 2).astype(float)
    late[rng.random(n) < 0.05] = np.nan
    minutes = np.round(signal * 5 + rng.normal(size=n))  # whole minutes: many ties
    return pd.DataFrame({"late": late, "minutes": minutes, **x})


def plain_split(bins, rows, g, h, min_rows):
    best = None
    total_g, total_h = g[rows].sum(), h[rows].sum()
    for f in range(len(bins)):
        lost = bins[f][rows] == 255
        for side in (False, True):
            if side and not lost.any():
                continue
            for cut in range(255):
                left = np.where(lost, side, bins[f][rows] <= cut)
                n = left.sum()
                hl = h[rows][left].sum()
                if n < min_rows or len(rows) - n < min_rows or hl < 1e-3 or total_h - hl < 1e-3:
                    continue
                gl = g[rows][left].sum()
                gain = gl**2 / hl + (total_g - gl) ** 2 / (total_h - hl) - total_g**2 / total_h
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, side, left)
    return best


def plain(bins, y, loss, rounds, step, leaves, min_rows):
    start = np.log(y.mean() / (1 - y.mean())) if loss == LOGISTIC else np.median(y)
    raw = np.full(len(y), start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = (p - y, p * (1 - p)) if loss == LOGISTIC else (np.sign(raw - y), np.ones(len(y)))
        open_leaves = [(np.arange(len(y)), plain_split(bins, np.arange(len(y)), g, h, min_rows))]
        while len(open_leaves) < leaves:
            rows, best = max(open_leaves, key=lambda leaf: leaf[1][0] if leaf[1] else 0.0)
            if best is None:
                break
            open_leaves = [leaf for leaf in open_leaves if leaf[0] is not rows]
            for part in (rows[best[4]], rows[~best[4]]):
                open_leaves.append((part, plain_split(bins, part, g, h, min_rows)))
        moved = raw.copy()
        for rows, _ in open_leaves:
            moved[rows] += step * (-g[rows].sum() / h[rows].sum() if loss == LOGISTIC else np.median((y - raw)[rows]))
        raw = moved
    return raw


def binned(frame, edges):
    x = frame[FEATURES].to_numpy(dtype=float).T
    return [np.where(np.isnan(v), 255, np.searchsorted(e, v)).astype(np.uint8) for v, e in zip(x, edges, strict=True)]


@pytest.mark.parametrize("block_rows", [10_000, 130])
def test_trees_equal_the_plain_version_in_one_block_and_in_many(spark, block_rows):
    frame = table(500)
    df = spark.createDataFrame(frame)
    tasks = [Task(LOGISTIC, "late", FEATURES), Task(ABSOLUTE, "minutes", FEATURES)]
    options = {"rounds": 4, "step": 0.3, "max_leaves": 7, "min_rows": 12, "max_bins": 16}
    late, minutes = fit_boosted([(df, tasks)], block_rows=block_rows, **options)[0]
    _, edges = boosting.bin_edges(df, FEATURES, 16)
    scored = late.transform(minutes.transform(df, "m"), "p").toPandas()
    scored = scored.set_index(scored.index)
    bins = binned(scored, edges)
    known = scored["late"].notna().to_numpy()
    want = plain([b[known] for b in bins], scored["late"].to_numpy()[known], LOGISTIC, 4, 0.3, 7, 12)
    assert np.allclose(scored["p"].to_numpy()[known], 1 / (1 + np.exp(-want)))
    assert np.allclose(scored["m"], plain(bins, scored["minutes"].to_numpy(), ABSOLUTE, 4, 0.3, 7, 12))
    assert all((np.array(t.feature) < 0).sum() <= 7 for t in late.trees + minutes.trees)


def test_models_side_by_side_equal_models_alone_and_survive_saving(spark, tmp_path):
    one, two = spark.createDataFrame(table(400, 2)), spark.createDataFrame(table(300, 3))
    nested = [Task(LOGISTIC, "late", FEATURES[:k]) for k in (1, 2, 4)]
    options = {"rounds": 3, "max_leaves": 5, "block_rows": 150}
    together = fit_boosted([(one, nested), (two, [Task(ABSOLUTE, "minutes", FEATURES)])], **options)
    for task, model in zip(nested, together[0], strict=True):
        alone = fit_boosted([(one, [task])], **options)[0][0]
        a, b = (np.array([r[0] for r in m.transform(one, "p").select("p").collect()]) for m in (model, alone))
        assert np.allclose(a, b)
    model = together[1][0]
    model.save(f"{tmp_path}/m")
    assert Boosted.load(f"{tmp_path}/m") == model


def test_models_of_one_block_grow_in_tasks_of_their_own(spark):
    sc = spark.sparkContext
    sc.setJobGroup("one block", "three models")
    fit_boosted([(spark.createDataFrame(table(200)), [Task(LOGISTIC, "late", FEATURES[:k]) for k in (1, 2, 4)])], rounds=2, max_leaves=5)
    tracker = sc.statusTracker()
    last = tracker.getJobInfo(max(tracker.getJobIdsForGroup("one block")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getStageInfo(max(last.stageIds)).numTasks == 3


def test_half_a_million_rows_grow_without_a_job_a_level(spark):
    sc = spark.sparkContext
    df = spark.range(500_000).selectExpr("double(id % 7) x", "double(id % 3 = 0 or id % 7 = 2) y")
    sc.setJobGroup("half a million", "one model")
    model = fit_boosted([(df, [Task(LOGISTIC, "y", ["x"])])], rounds=8, max_leaves=4)[0][0]
    jobs = len(sc.statusTracker().getJobIdsForGroup("half a million"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 8 and jobs < 8


def test_rows_beyond_one_block_are_dealt_to_all_cores(spark, monkeypatch):
    dealt = []
    grow = boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda blocks, *rest: (dealt.append(blocks.blocks.getNumPartitions()), grow(blocks, *rest)))
    fit_boosted([(spark.createDataFrame(table(400)), [Task(LOGISTIC, "late", FEATURES)])], rounds=1, max_leaves=3, block_rows=399)
    assert dealt == [max(2, spark.sparkContext.defaultParallelism)]


def test_a_pass_splits_only_the_nodes_that_are_new():
    bins = np.array([[0, 1, 2, 3, 255, 0]], np.uint8)
    y = np.array([0, 1, 0, 1, 1, np.nan])
    known = {}
    one = boosting.Tree([0, -1, -1], [0.0] * 3, [1, 0, 0], [True, False, False], [1, 0, 0], [2, 0, 0], [])
    assert {k: v.tolist() for k, v in boosting._open_rows(one, bins, [0], y, known).items()} == {1: [0, 1, 4], 2: [2, 3]}
    right = known["nodes"][2]
    two = boosting.Tree([0, 0, -1, -1, -1], [0.0] * 5, [1, 0, 0, 0, 0], [True] + [False] * 4, [1, 3, 0, 0, 0], [2, 4, 0, 0, 0], [])
    assert {k: v.tolist() for k, v in boosting._open_rows(two, bins, [0], y, known).items()} == {2: [2, 3], 3: [0], 4: [1, 4]}
    assert known["nodes"][2] is right


def test_a_set_of_one_block_explores_only_splits_that_stay(spark, monkeypatch):
    n = 4000
    x = np.random.default_rng(5).normal(size=(4, n))
    bins = np.stack([np.searchsorted(np.sort(v)[:: n // 200], v) for v in x]).astype(np.uint8)
    y = (x.sum(axis=0) + x[0] * x[1] > 0).astype(float)
    asked, trees = [], []
    count = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda plans: (asked.extend(plans[0][5]), count(plans))[1])
    for sure in (True, False):
        model = Boosted(LOGISTIC, FEATURES, 0.0, 0.1)
        edges = [np.arange(201.0)] * 4
        growing = boosting._Growing(Task(LOGISTIC, "y", FEATURES), 0, 0, [0, 1, 2, 3], edges, model, 31, 20, sure)
        del asked[:]
        boosting._grow(boosting._Here([(0, bins, [y], [np.zeros(n)], {})]), [growing], 3)
        trees.append(model.trees)
        assert not sure or len(asked) <= 3 * 31  # the root and the smaller child of every split
    for one, two in zip(*trees, strict=True):
        assert (one.feature, one.cut, one.left, one.right) == (two.feature, two.cut, two.left, two.right)
        assert np.allclose(one.value, two.value)


def test_blocks_of_their_own_tasks_grow_the_sure_way(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(boosting, "_grow", lambda blocks, growing, rounds: seen.extend(g.sure for g in growing))
    growing = boosting._Growing(Task(LOGISTIC, "y", ["a"]), 0, 0, [0], [], Boosted(LOGISTIC, ["a"], 0.0, 0.1), 31, 20)
    assert len(list(boosting._grown_here(growing, 1)(iter([()])))) == 1 and seen == [True]


def test_missing_values_learn_their_side(spark):
    n = 400
    lost = np.arange(n) % 4 == 0
    frame = pd.DataFrame({"x": np.where(lost, np.nan, np.arange(n) % 7), "late": lost.astype(float)})
    model = fit_boosted([(spark.createDataFrame(frame), [Task(LOGISTIC, "late", ["x"])])], rounds=20, step=0.5)[0][0]
    odd = spark.createDataFrame([(None,), (float("nan"),), (3.0,), (99.0,)], "x double")
    p = [r["p"] for r in model.transform(odd, "p").collect()]
    assert p[0] == p[1] > 0.9 and p[2] == p[3] < 0.1


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "x double, y double")
    same = spark.createDataFrame([(float(i), 1.0, None) for i in range(50)], "x double, y double, z double")
    for df, label in ((empty, "y"), (same, "y"), (same, "z")):
        for loss in (LOGISTIC, ABSOLUTE):
            model = fit_boosted([(df, [Task(loss, label, ["x"])])], rounds=2)[0][0]
            assert len(model.trees) == (0 if df is empty else 2) and all(t.feature == [-1] for t in model.trees)
            assert model.transform(same, "p").filter("p is null or isnan(p)").count() == 0


def test_medians_of_blocks_are_exact_with_ties():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 4000, 4001):
        for values in (rng.normal(size=n), np.round(rng.normal(size=n)), np.zeros(n)):
            blocks = [np.sort(part) for part in np.array_split(values, 5) if len(part)]
            samples = []
            for part in blocks:
                at = np.unique(np.linspace(0, len(part) - 1, min(16, len(part))).astype(np.int64))
                samples.append((len(part), at, part[at]))
            low, high = bracket(samples)
            parts = []
            for part in blocks:
                a, b = np.searchsorted(part, low, "left"), np.searchsorted(part, high, "right")
                parts.append((int(a), *np.unique(part[a:b], return_counts=True)))
            assert median_of(n, parts) == np.median(values)
            assert sum(counts.sum() for _, _, counts in parts) <= max(n / 2, 40) or len(np.unique(values)) < 20


@pytest.mark.parametrize("loss,label", [(LOGISTIC, "late"), (ABSOLUTE, "minutes")])
def test_rows_of_one_block_do_not_go_through_final_trees(monkeypatch, loss, label):
    frame = table(600, 5)
    frame.loc[::9, label] = np.nan
    edges = [np.unique(np.nanquantile(frame[f], np.linspace(0.1, 0.9, 9))) for f in FEATURES]
    block = (0, np.array(binned(frame, edges)), [frame[label].to_numpy()], [np.zeros(len(frame))], {})
    through, passes = boosting._leaf_of, []
    monkeypatch.setattr(boosting, "_leaf_of", lambda *args: passes.append(1) or through(*args))
    grown = boosting._Growing(Task(loss, label, FEATURES), 0, 0, [0, 1, 2, 3], edges, Boosted(loss, FEATURES, 0.0, 0.3), 7, 12)
    list(boosting._grown_here(grown, 4)(iter([block])))
    assert len(grown.model.trees) == 4 and len(passes) <= 2  # for the start, which has no nodes yet
    known = frame[label].notna().to_numpy()
    want = plain([b[known] for b in binned(frame, edges)], frame[label].to_numpy()[known], loss, 4, 0.3, 7, 12)
    got = np.full(known.sum(), grown.model.start)
    for tree in grown.model.trees:
        reached = through(tree, lambda f: block[1][f][known], known.sum(), tree.cut, lambda x: x == boosting.MISSING)
        got += 0.3 * np.array(tree.value)[reached]
    assert np.allclose(got, want)


def test_tasks_that_keep_their_blocks_need_no_job_a_level_and_change_nothing(spark, monkeypatch):
    sc = spark.sparkContext
    frame = table(900, 4)
    frame.loc[::11, "late"] = np.nan
    one, two = spark.createDataFrame(frame), spark.createDataFrame(table(700, 6))
    sets = [(one, [Task(LOGISTIC, "late", FEATURES), Task(LOGISTIC, "late", FEATURES[:2])]), (two, [Task(ABSOLUTE, "minutes", FEATURES)])]
    options = {"rounds": 6, "max_leaves": 9, "block_rows": 200}
    sc.setJobGroup("kept", "three models")
    kept = fit_boosted(sets, **options)
    jobs = len(sc.statusTracker().getJobIdsForGroup("kept"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(boosting, "_plain_path", lambda _: None)
    by_jobs = fit_boosted(sets, **options)
    assert jobs < 6 * 4
    for a, b in zip(sum(kept, []), sum(by_jobs, []), strict=True):
        assert a.start == b.start
        for one_tree, other in zip(a.trees, b.trees, strict=True):
            assert one_tree.feature == other.feature and one_tree.cut == other.cut and np.allclose(one_tree.value, other.value, atol=1e-12)


def test_sets_too_large_to_keep_and_slow_folders_grow_by_jobs(spark, monkeypatch):
    df, task = spark.createDataFrame(table(400)), Task(LOGISTIC, "late", FEATURES)
    grow, ways = boosting._grow, []
    monkeypatch.setattr(boosting, "_grow", lambda blocks, *rest: (ways.append(type(blocks).__name__), grow(blocks, *rest)))
    want = fit_boosted([(df, [task])], rounds=2, max_leaves=3, block_rows=399)
    for name, value in (("KEPT_ROWS", 10), ("SLOW_SECONDS", 0.0)):
        with monkeypatch.context() as m:
            m.setattr(boosting, name, value)
            got = fit_boosted([(df, [task])], rounds=2, max_leaves=3, block_rows=399)
        assert [t.feature for t in got[0][0].trees] == [t.feature for t in want[0][0].trees]
    assert ways == ["_Kept", "_Spread", "_Spread"]


def test_a_task_that_starts_again_repeats_the_moves_it_missed(tmp_path):
    frame = table(300, 8)
    edges = [np.unique(np.nanquantile(frame[f], np.linspace(0.1, 0.9, 9))) for f in FEATURES]
    block = boosting.pickle.dumps((np.array(binned(frame, edges)), [frame["minutes"].to_numpy()]))

    def driver(folder, at):
        kept = object.__new__(boosting._Kept)
        kept.folder, kept.at, kept.n, kept.settled, kept.job = str(folder), at, 1, {}, Future()
        served = threading.Thread(target=lambda: list(boosting._serving(str(folder))(0, iter([(0, 0, block)]))))
        served.start()
        return kept, served

    (tmp_path / "first").mkdir()
    first, served = driver(tmp_path / "first", 0)
    model = Boosted(ABSOLUTE, FEATURES, 0.0, 0.3)
    growing = boosting._Growing(Task(ABSOLUTE, "minutes", FEATURES), 0, 0, [0, 1, 2, 3], edges, model, 7, 12, True, 0.5)
    boosting._grow(first, [growing], 4)
    shutil.copytree(tmp_path / "first", tmp_path / "again")
    again, served_again = driver(tmp_path / "again", first.at)
    root = boosting.Tree([-1], [0.0], [0], [False], [0], [0], [0.0])
    one, two = (kept.gathered(boosting._spaced, boosting._listed, [(0, 0, [], root)]) for kept in (first, again))
    for kept, thread in ((first, served), (again, served_again)):
        kept._command("end")
        thread.join(20)
        assert not thread.is_alive()
    assert one.keys() == two.keys() and all(np.array_equal(a[2], b[2]) for key in one for a, b in zip(one[key], two[key], strict=True))


def test_all_rows_of_a_block_in_several_nodes_keep_their_nodes():
    bins, y = np.array([[0, 2, 0, 2, 1, 1]], np.uint8), np.array([0.0, 1, 0, 1, 0, 1])
    tree = boosting.Tree([0, -1, 0, -1, -1], [0.0] * 5, [0, 0, 1, 0, 0], [False] * 5, [1, 0, 3, 0, 0], [2, 0, 4, 0, 0], [])
    block = (0, bins, [y], [np.zeros(6)], {})
    (found,) = boosting._histograms([(0, 0, LOGISTIC, [0], tree, [4, 3, 1])])(iter([block]))
    assert [found[0, node][0, 0, :3].tolist() for node in (1, 3, 4)] == [[2, 0, 0], [0, 2, 0], [0, 0, 2]]


@pytest.mark.parametrize("leaves", [2, 31, 40, 90])
def test_scores_by_masks_equal_the_trees_one_by_one(spark, leaves):
    frame = table(2500, 9)
    df = spark.createDataFrame(frame)
    model = fit_boosted([(df, [Task(LOGISTIC, "late", FEATURES)])], rounds=5, step=0.3, max_leaves=leaves, min_rows=3)[0][0]
    assert max(t.feature.count(-1) for t in model.trees) > min(leaves, 64) - 8
    bounds = sorted({(f, t) for tree in model.trees for f, t in zip(tree.feature, tree.threshold, strict=True) if f >= 0})
    odd = [[t if i == f else 0.0 for i in range(4)] for f, t in bounds] + [[v] * 4 for v in (np.inf, -np.inf, np.nan, None)]
    rows = spark.createDataFrame([tuple(None if v is None else float(v) for v in row) for row in odd], ", ".join(f"{f} double" for f in FEATURES)).unionByName(df.select(*FEATURES))
    got = rows.transform(lambda x: model.transform(x, "p")).toPandas()
    x = got[FEATURES].to_numpy(dtype=float)
    raw = np.full(len(x), model.start)
    for tree in model.trees:
        raw += 0.3 * np.array(tree.value)[boosting._leaf_of(tree, lambda f: x[:, f], len(x), tree.threshold, np.isnan)]
    assert np.array_equal(got["p"].to_numpy(), boosting._probability(raw))


def test_no_tree_is_walked_to_score_a_row(spark, monkeypatch):
    model = Boosted(ABSOLUTE, ["x"], 1.0, 0.5, [boosting.Tree([0, -1, -1], [2.0] * 3, [0] * 3, [True] * 3, [1, 0, 0], [2, 0, 0], [0.0, 4.0, 6.0]), boosting.Tree([-1], [0.0], [0], [False], [0], [0], [1.0])])
    monkeypatch.setattr(boosting, "_leaf_of", None)
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double").repartition(1)
    assert sorted(r["p"] for r in model.transform(rows, "p").collect()) == [3.5, 3.5, 3.5, 4.5]
