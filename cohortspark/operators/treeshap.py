"""Path-dependent tree Shapley values for Spark ML tree ensembles of any depth.

Design (the game of Lundberg et al., 2018, path-dependent expectation):

1. The fitted model is saved in Spark ML's native format into the checkpoint
   folder and its node table (``treeID, nodeData``) is read back as a
   DataFrame.  The node table is model-sized, so it is collected once.
2. Every leaf becomes a *path record*: distinct features on the path, the
   interval ``(lo, hi]`` each feature must fall in (left = ``x <= t``), the
   product of child/parent cover ratios per feature, and the leaf value
   vector (already scaled by tree weight).
3. A leaf's game is a product, ``v(S) = value * prod_{f in S} o_f *
   prod_{f not in S} r_f`` with ``o_f = 1[x_f in I_f]``.  Its Shapley values are
   an integral of a polynomial over the share ``t`` of the other features that
   are present:
   ``phi_j = value * (o_j - r_j) * int_0^1 prod_{k != j} (t o_k + (1-t) r_k) dt``.
   The polynomial has degree m - 1 on a path of m features, so
   Gauss-Legendre quadrature with ceil(m / 2) nodes is exact; the work is
   m * ceil(m / 2) per row and leaf instead of 2^m subsets.
   :class:`TreeWalks` shares it among the leaves of a tree: the products grow
   split by split on the way down and the leaves' sums are gathered on the way up,
   so a split costs ceil(m / 2) values per row and output, whatever the path.
4. The trees are broadcast (model-sized); ``mapInArrow`` evaluates row
   blocks of bounded size and keeps only the features that some path touches.
5. Output is long ``(sample_id, class, feature, phi)``; additivity holds:
   ``sum_f phi + expected_value = model output`` (margin for boosted trees,
   probability for a random forest).
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Values of one row block (rows x leaves x path features), at most.
BLOCK_VALUES = 1 << 21
#: Rows that walk down a tree together: an edge's arrays stay in the processor's cache.
WALK_ROWS = 1024


def node_tables(model, spark: SparkSession | None = None) -> tuple[dict, list[float]]:
    """``{tree_id: {node_id: node dict}}`` and tree weights, via the saved model."""
    spark = spark or SparkSession.getActiveSession()  # a thread of its own has no active session
    path = os.path.join(ensure_checkpoint_dir(spark), "models", f"tree-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.rawCount",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").toArrow().to_pylist()
    trees: dict = {}
    for r in rows:
        if r["leftChild"] >= 0 and r["numCategories"] != -1:
            raise ValueError("attributions are defined for continuous splits only")
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    weights = list(getattr(model, "treeWeights", [1.0] * len(trees)))
    return trees, weights


def _leaf_value(node, kind: str, weight: float, n_trees: int) -> np.ndarray:
    if kind == "rf":
        stats = np.asarray(node["impurityStats"], dtype=float)
        tot = stats.sum()
        return (stats / tot if tot > 0 else stats) / n_trees
    return np.asarray([weight * float(node["prediction"])])


def path_records(trees: dict, weights: list[float], kind: str) -> list[tuple]:
    """Leaf path records ``(features, lo, hi, ratio, value)``."""
    recs = []
    n_trees = len(trees)
    for tid, nodes in sorted(trees.items()):
        root = min(nodes)
        stack = [(root, {})]
        while stack:
            nid, cond = stack.pop()
            nd = nodes[nid]
            if nd["leftChild"] < 0:
                feats = sorted(cond)
                lo = np.array([cond[f][0] for f in feats], dtype=float)
                hi = np.array([cond[f][1] for f in feats], dtype=float)
                rr = np.array([cond[f][2] for f in feats], dtype=float)
                recs.append((np.array(feats, dtype=int), lo, hi, rr,
                             _leaf_value(nd, kind, weights[tid], n_trees)))
                continue
            f = int(nd["featureIndex"])
            t = float(nd["leftCategoriesOrThreshold"][0])
            cl = float(nodes[nd["leftChild"]]["rawCount"])
            cr = float(nodes[nd["rightChild"]]["rawCount"])
            tot = cl + cr
            rl, rrt = (cl / tot, cr / tot) if tot > 0 else (0.5, 0.5)
            lo0, hi0, r0 = cond.get(f, (-math.inf, math.inf, 1.0))
            left, right = dict(cond), dict(cond)
            left[f] = (lo0, min(hi0, t), r0 * rl)
            right[f] = (max(lo0, t), hi0, r0 * rrt)
            stack.append((nd["leftChild"], left))
            stack.append((nd["rightChild"], right))
    return recs


def expected_value(recs: list[tuple]) -> np.ndarray:
    return sum(v * np.prod(r) for _, _, _, r, v in recs)


class PathGroups:
    """Path records grouped by path length, over the ``touched`` features only."""

    def __init__(self, recs: list[tuple]):
        self.n_out = len(recs[0][4]) if recs else 1
        self.touched = np.unique(np.concatenate([r[0] for r in recs] or [np.zeros(0, int)])).astype(int)
        self.groups = []
        for m in sorted({len(r[0]) for r in recs} - {0}):
            own = [r for r in recs if len(r[0]) == m]
            feats, lo, hi, ratio, value = (np.array([r[k] for r in own]) for k in range(5))
            place = np.searchsorted(self.touched, feats)
            order = np.argsort(place, axis=None, kind="stable")  # (leaf, feature) cells by feature
            cell = place.ravel()[order]
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            t, w = np.polynomial.legendre.leggauss(-(-m // 2))
            self.groups.append((feats, lo, hi, ratio, value, order, starts, cell[starts], (t + 1) / 2, w / 2))

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """``phi[n, touched, n_out]`` of dense rows."""
        phi = np.zeros((len(x), len(self.touched), self.n_out))
        for feats, lo, hi, ratio, value, order, starts, places, nodes, weights in self.groups:
            step = max(1, BLOCK_VALUES // feats.size)
            for a in range(0, len(x), step):
                own = x[a:a + step][:, feats]  # rows x leaves x path
                # Spark sends x to the left if x <= t, anything else (NaN too) to the right
                inside = (np.isneginf(lo) | ~(own <= lo)) & (np.isposinf(hi) | (own <= hi))
                total = np.zeros(own.shape)
                for t, w in zip(nodes, weights):
                    factor = np.where(inside, t + (1 - t) * ratio, (1 - t) * ratio)
                    whole = factor.prod(axis=2, keepdims=True)
                    # a zero factor is its own (o = r = 0) and earns nothing, or another's, and all is zero
                    total += w * np.divide(whole, factor, out=np.zeros_like(factor), where=factor > 0)
                credit = ((inside - ratio) * total).reshape(len(own), -1)[:, order]
                leaf = order // feats.shape[1]
                for k in range(self.n_out):
                    phi[a:a + step, places, k] += np.add.reduceat(credit * value[leaf, k], starts, axis=1)
        return phi


class TreeWalks:
    """The same attributions as :class:`PathGroups` by one walk over every tree.

    A split on feature j divides the product P of the factors above it: its left share m is the
    left edge's factor over that of the last edge of j above (1 if there is none), its right share
    is 1 - m.  With H the sum of ``value * product of shares`` over the leaves below a node,
    ``H = H_right + m (H_left - H_right)`` on the way up, and phi_j gains
    ``c int P (H_left - H_right) / F^2``, where F is the last factor of j above for a row that met
    all tests of j so far, and c is the right side's part of the cover if the row goes left,
    less the left side's if it goes right, and 0 for any other row; both come from a product of
    matrices.  A node over two leaves has an H
    of two vectors, and one over two of those an H of four: they are put together by products of matrices."""

    def __init__(self, trees: dict, weights: list[float], kind: str):
        self.trees, touched = [], set()
        for tid, nodes in sorted(trees.items()):
            ratio, value, splits = cover_ratios(nodes), {}, {}
            depth, cover, stack = 0, [], [(min(nodes), {})]
            while stack:
                nid, seen = stack.pop()
                nd = nodes[nid]
                depth = max(depth, len(seen))
                if nd["leftChild"] < 0:
                    value[nid] = _leaf_value(nd, kind, weights[tid], len(trees))
                    continue
                f, left, right = int(nd["featureIndex"]), nd["leftChild"], nd["rightChild"]
                above = seen.get(f, 1.0)
                own = above * ratio[left], above * ratio[right]
                splits[nid] = f, float(nd["leftCategoriesOrThreshold"][0]), left, right, len(cover)
                cover.append((above, *own, ratio[left]))
                stack += [(left, {**seen, f: own[0]}), (right, {**seen, f: own[1]})]
            touched |= {x[0] for x in splits.values()}
            self.n_out = len(next(iter(value.values())))
            if depth:
                t, w = np.polynomial.legendre.leggauss(-(-depth // 2))
                t, w = (t + 1) / 2, w / 2
                above, left, right, part = np.array(cover).T[:, :, None]
                whole = t + (1 - t) * above
                # m and c of a split from (left and met above, met above, 1)
                states = np.empty((len(cover), len(t) + 1, 3))
                states[:, :-1, 0] = t / whole
                states[:, :-1, 1] = (1 - t) * left / whole - part
                states[:, :-1, 2] = part
                states[:, -1:] = np.stack([left + right, -left, 0 * left], axis=2)
                self.trees.append((min(nodes), splits, value, len(t), states, (w / whole ** 2)[:, :, None]))
        self.touched = np.array(sorted(touched), int)
        # outputs of leaves that add up to the same everywhere earn 0 together: the last is left out
        totals = [v.sum() for tree in self.trees for v in tree[2].values()]
        self.walked = self.n_out - (self.n_out > 1 and np.ptp(totals or [0.0]) < 1e-12)
        for tree in self.trees:
            tree[2].update({nid: v[:self.walked] for nid, v in tree[2].items()})

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """``phi[n, touched, n_out]`` of dense rows."""
        phi = np.zeros((len(self.touched), self.n_out, len(x)))
        for a in range(0, len(x), WALK_ROWS):
            columns = {f: np.ascontiguousarray(x[a:a + WALK_ROWS, f]) for f in self.touched.tolist()}
            block = np.zeros((len(columns), self.walked, len(x[a:a + WALK_ROWS])))
            earned = dict(zip(columns, block))
            state = np.ones((3, block.shape[2]))
            for root, splits, value, n_shares, states, scale in self.trees:
                shares = np.ones((4, n_shares, block.shape[2]))

                def walk(nid, product, last):
                    """H of the node: the values of a leaf, a pair of leaves, or ``[output, share, row]``."""
                    if nid in value:
                        return value[nid]
                    f, threshold, left, right, at = splits[nid]
                    goes_left, above = columns[f] <= threshold, last.get(f)  # anything else (NaN too) goes to the right
                    goes_right = ~goes_left
                    if above is None:
                        state[1] = 1.0
                    else:
                        goes_left &= above
                        goes_right &= above
                        state[1] = above
                    state[0] = goes_left
                    both = states[at] @ state
                    m, credit = both[:-1], both[-1]
                    if left in value and right in value:
                        difference = value[left] - value[right]
                        earned[f] += difference[:, None] * (credit * (scale[at][:, 0] @ product))
                        return value[right], difference, m
                    below = product * m
                    h_left = walk(left, below, {**last, f: goes_left})
                    h_right = walk(right, product - below, {**last, f: goes_right})
                    scaled = product * scale[at]
                    if isinstance(h_left, tuple) and isinstance(h_right, tuple):
                        (v, d, n), (v_right, d_right, n_right) = h_left, h_right
                        sums = np.empty((3, len(credit)))
                        np.add.reduce(scaled, axis=0, out=sums[0])
                        np.einsum("qr,qr->r", scaled, n, out=sums[1])
                        np.einsum("qr,qr->r", scaled, n_right, out=sums[2])
                        sums *= credit
                        earned[f] += np.array([v - v_right, d, -d_right]).T @ sums
                        shares[0] = m
                        np.multiply(m, n, out=shares[1])
                        np.subtract(1, m, out=shares[2])
                        shares[2] *= n_right
                        return (np.array([v - v_right, d, d_right, v_right]).T @ shares.reshape(4, -1)).reshape(-1, *m.shape)
                    leaf = left in value
                    h_left, h_right = _dense(h_left), _dense(h_right)
                    h = np.subtract(h_left, h_right, out=None if leaf else h_left)
                    gain = np.einsum("qr,kqr->kr", scaled, h)
                    gain *= credit
                    earned[f] += gain
                    h *= m
                    h += h_right
                    return h
                walk(root, np.ones((n_shares, block.shape[2])), {})
            phi[:, :self.walked, a:a + WALK_ROWS] = block
            if self.walked < self.n_out:
                phi[:, -1, a:a + WALK_ROWS] = -block.sum(axis=1)
        return phi.transpose(2, 0, 1)


def _dense(h) -> np.ndarray:
    """H of a node as ``[output, share, row]``; a leaf's has one share and row."""
    if isinstance(h, tuple):
        value, difference, m = h
        return np.multiply.outer(difference, m) + value[:, None, None]
    return h[:, None, None] if h.ndim == 1 else h


def cover_ratios(nodes: dict) -> dict[int, float]:
    """Every child's share of its parent's rows."""
    out = {}
    for nd in nodes.values():
        if nd["leftChild"] >= 0:
            left, right = (float(nodes[nd[side]]["rawCount"]) for side in ("leftChild", "rightChild"))
            whole = left + right
            out[nd["leftChild"]], out[nd["rightChild"]] = (left / whole, right / whole) if whole > 0 else (0.5, 0.5)
    return out


def _evaluator(trees: dict, weights: list[float], kind: str) -> tuple["TreeWalks | PathGroups", np.ndarray]:
    """What computes the attributions, and the expected value; a tree with an empty side (a ratio
    of 0) takes the path records."""
    base, empty = 0.0, False
    for tid, nodes in sorted(trees.items()):
        ratio, stack = cover_ratios(nodes), [(min(nodes), 1.0)]
        empty = empty or 0.0 in ratio.values()
        while stack:
            nid, share = stack.pop()
            nd = nodes[nid]
            if nd["leftChild"] < 0:
                base = base + share * _leaf_value(nd, kind, weights[tid], len(trees))
            else:
                stack += [(child, share * ratio[child]) for child in (nd["leftChild"], nd["rightChild"])]
    return PathGroups(path_records(trees, weights, kind)) if empty else TreeWalks(trees, weights, kind), base


def shap_batch(X: np.ndarray, recs: list[tuple], d: int, n_out: int) -> np.ndarray:
    """``phi[n, d, n_out]`` for a batch of dense rows."""
    groups = PathGroups(recs)
    phi = np.zeros((len(X), d, n_out))
    phi[:, groups.touched, :] = groups.attributions(np.asarray(X, float))
    return phi


def _explain(key: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = shared.value  # (class of the first output, evaluator)
        for batch in batches:
            width = max([1, *(len(g.touched) * g.n_out for _, g in parts)])
            step = max(1, BLOCK_VALUES // width)
            for a in range(0, batch.num_rows, step):
                rows = batch.slice(a, step)
                lists = rows.column(1)
                bounds = lists.offsets.to_numpy()
                x = lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].reshape(rows.num_rows, -1)
                for first, groups in parts:
                    phi = groups.attributions(x)
                    row, place, out = np.nonzero(phi)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pa.array(row)), pa.array((out + first).astype(np.int32)),
                         pa.array(groups.touched[place].astype(np.int32)), pa.array(phi[row, place, out])],
                        names=[key, "_c", "_j", "phi"])
    return run


def _paths(model, kind: str, spark: SparkSession) -> list[tuple[int, "TreeWalks | PathGroups", np.ndarray]]:
    """(class of the first output, evaluator, expected value) of every tree model inside."""
    inner = getattr(model, "models", None)
    if inner is None:
        return [(0, *_evaluator(*node_tables(model, spark), kind))]
    with ThreadPoolExecutor(max_workers=4) as pool:  # one margin per class; saving and reading is waiting
        tables = list(pool.map(lambda m: node_tables(m, spark), inner))
    return [(c, *_evaluator(*table, "gbt")) for c, table in enumerate(tables)]


def tree_shapley(model, frame: DataFrame, kind: str, feature_names: list[str],
                 class_names: list | None = None, key: str = "sample_id",
                 features_col: str = "features") -> tuple[DataFrame, np.ndarray]:
    """Long attributions ``(key, class, feature, phi)`` and the expected values.

    ``kind='rf'`` explains class probabilities, ``kind='gbt'`` the margin: of the
    positive class (``class`` = 1, or the last of ``class_names``) for a binary
    model, of every class for a one-vs-rest set."""
    spark = frame.sparkSession
    parts = _paths(model, kind, spark)
    base = np.concatenate([b for _, _, b in parts])
    if len(base) > 1:
        classes = list(class_names) if class_names is not None else list(range(len(base)))
    else:
        classes = [class_names[-1] if class_names else 1]
    shared = spark.sparkContext.broadcast([(c, g) for c, g, _ in parts])  # as large as the model
    key_type = frame.schema[key].dataType.simpleString()
    inp = frame.select(key, vector_to_array(F.col(features_col)).alias("_x"))
    # attribution is CPU-heavy per row: spread rows over at least one task per core
    cores = spark.sparkContext.defaultParallelism
    if inp.rdd.getNumPartitions() < cores:
        inp = inp.repartition(cores, key)
    out = inp.mapInArrow(_explain(key, shared), f"{key} {key_type}, _c int, _j int, phi double")
    # names are attached JVM-side (integers cross the Arrow boundary, not strings)
    cls_arr = F.array(*[F.lit(str(c)) for c in classes])
    name_arr = F.array(*[F.lit(n) for n in feature_names])
    out = out.select(key, F.element_at(cls_arr, F.col("_c") + 1).alias("class"),
                     F.element_at(name_arr, F.col("_j") + 1).alias("feature"), "phi")
    return out, base


def fold_attributions(models: list, frame: DataFrame, kind: str, feature_names: list[str], class_names: list,
                      key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Attributions of every row by the model of its own fold, which has not seen it.

    Returns ``(key, fold, class, feature, phi)`` over all folds, and the expected
    values ``(fold, class, base)`` (folds x classes rows)."""
    parts, bases = [], []
    with ThreadPoolExecutor(max_workers=4) as pool:
        explained = list(pool.map(lambda at: tree_shapley(at[1], frame.where(F.col("fold") == at[0]), kind, feature_names, class_names, key),
                                  enumerate(models)))
    for fold, (phi, base) in enumerate(explained):
        names = class_names if len(base) > 1 else [class_names[-1]]
        parts.append(phi.withColumn("fold", F.lit(fold)))
        bases += [(fold, str(c), float(b)) for c, b in zip(names, base)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(key, "fold", "class", "feature", "phi"), \
        frame.sparkSession.createDataFrame(bases, "fold int, class string, base double")


def model_outputs(models: list, frame: DataFrame, kind: str, class_names: list, key: str = "sample_id") -> DataFrame:
    """``(key, fold, class, output)``: what attributions add up to, by each row's own fold model."""
    parts = []
    for fold, model in enumerate(models):
        rows = frame.where(F.col("fold") == fold)
        inner = getattr(model, "models", None)
        if inner is not None:
            margins = rows
            for m in inner:
                margins = m.transform(margins)
            values = F.array(*[vector_to_array(F.col(m.getRawPredictionCol()))[1] for m in inner])
            names = class_names
        else:
            margins = model.transform(rows)
            values = vector_to_array(F.col("probability")) if kind == "rf" else F.array(vector_to_array(F.col("rawPrediction"))[1])
            names = class_names if kind == "rf" else [class_names[-1]]
        listed = F.array(*[F.lit(str(c)) for c in names])
        parts.append(margins.select(key, "fold", F.posexplode(values).alias("_c", "output"))
                     .select(key, "fold", F.element_at(listed, F.col("_c") + 1).alias("class"), "output"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def additivity(phi: DataFrame, base: DataFrame, outputs: DataFrame, key: str = "sample_id", tolerance: float = 1e-9) -> DataFrame:
    """Per fold and class: rows, and rows whose attributions and expected value miss the model's
    output by more than ``tolerance``."""
    sums = phi.groupBy(key, "fold", "class").agg(F.sum("phi").alias("_s"))
    both = outputs.join(sums, [key, "fold", "class"], "left").join(F.broadcast(base), ["fold", "class"])
    off = F.abs(F.coalesce("_s", F.lit(0.0)) + F.col("base") - F.col("output"))
    return both.groupBy("fold", "class").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(off > tolerance).alias("n_off"))
