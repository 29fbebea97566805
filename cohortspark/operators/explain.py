"""Attributions and importance roll-ups.

Attributions are long ``(sample_id, class, feature, phi)``; a missing row is a
zero attribution, so means divide by ``N x K`` rather than by the row count.

* :func:`linear_shapley` - exact Shapley values of a linear scorer with an
  independent background (``phi = w * (x - mean)``), pure column arithmetic;
  importance factorises (``mean|phi| = mean_c|w| * mean_s|x - m|``) and is
  formed without densifying absent (zero) cells.
* :func:`tree_shapley` - path-dependent tree Shapley values of Spark ML trees,
  see ``treeshap.py``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.scalar import modality_from_binary_pred, modality_from_pred, modality_from_suffix
from ..session import materialize

#: Values of the synthetic rows made at once, at most (or those of one draw).
STEP_VALUES = 1 << 20


def centroid_model(cells: DataFrame, labels: DataFrame, classes: list,
                   label: str = "label") -> tuple[DataFrame, DataFrame, int]:
    """Linear scorer from the data: ``w[c, f] = mean_f | c - mean_f`` with
    absent cells read as 0.  Returns ``(weights(class, feature, w),
    means(feature, mean, n_present), N)``."""
    lab = labels.select("sample_id", F.col(label).alias("class"))
    # read by three aggregates below: written once to the checkpoint folder
    x = materialize(cells.join(lab, "sample_id"), "centroid_cells")
    samples = x.select("sample_id", "class").distinct()
    n_c = samples.groupBy("class").agg(F.count(F.lit(1)).alias("_nc"))
    N = samples.count()
    s_cf = x.groupBy("class", "feature").agg(F.sum("value").alias("_s"))
    means = x.groupBy("feature").agg((F.sum("value") / F.lit(float(N))).alias("mean"),
                                     F.count(F.lit(1)).alias("n_present"))
    grid = means.select("feature", "mean", F.explode(F.array(*[F.lit(c) for c in classes])).alias("class"))
    w = grid.join(s_cf, ["class", "feature"], "left").join(n_c, "class") \
        .select("class", "feature",
                (F.coalesce(F.col("_s"), F.lit(0.0)) / F.col("_nc") - F.col("mean")).alias("w"))
    return w, means, N


def linear_shapley(cells: DataFrame, weights: DataFrame, means: DataFrame) -> DataFrame:
    """``phi = w * (x - mean)`` for every present cell and class (absent cells
    have ``phi = -w * mean``, implied)."""
    return cells.join(means.select("feature", "mean"), "feature") \
        .join(weights, "feature") \
        .select("sample_id", "class", "feature",
                (F.col("w") * (F.col("value") - F.col("mean"))).alias("phi"))


def linear_importance(cells: DataFrame, weights: DataFrame, means: DataFrame, N: int) -> DataFrame:
    """Mean |phi| over all N samples and K classes per feature (X3) - exact."""
    dev = cells.join(means, "feature").groupBy("feature").agg(
        F.sum(F.abs(F.col("value") - F.col("mean"))).alias("_sd"),
        F.first("mean").alias("mean"), F.first("n_present").alias("n_present"))
    mad = dev.select("feature", ((F.col("_sd") + (F.lit(N) - F.col("n_present")) * F.abs("mean"))
                                 / F.lit(float(N))).alias("_mad"))
    wabs = weights.groupBy("feature").agg(F.avg(F.abs("w")).alias("_w"))
    return wabs.join(mad, "feature").select("feature", (F.col("_w") * F.col("_mad")).alias("importance"))


def feature_importance(phi: DataFrame, n_samples: int, n_classes: int) -> DataFrame:
    """Mean |phi| over samples and classes from a long attribution table."""
    return phi.groupBy("feature").agg(
        (F.sum(F.abs("phi")) / F.lit(float(n_samples * n_classes))).alias("importance"))


_RULES = {"suffix": modality_from_suffix, "pred": modality_from_pred, "binary": modality_from_binary_pred}


def importance_by_modality(importance: DataFrame, rule: str = "suffix",
                           out: str = "omics_type") -> DataFrame:
    """Parse the modality from each feature name, sum importances, sort desc."""
    x = importance.withColumn(out, _RULES[rule](F.col("feature")))
    return x.groupBy(out).agg(F.sum("importance").alias("importance")) \
        .orderBy(F.col("importance").desc(), F.col(out))


def expert_rollup_applies(importance: DataFrame) -> bool:
    """Expert variant: only if some name has ``_`` and >1 modality results."""
    row = importance.agg(F.bool_or(F.col("feature").contains("_")).alias("u"),
                         F.countDistinct(modality_from_suffix(F.col("feature"))).alias("m")).first()
    return bool(row["u"]) and row["m"] > 1


def check_attributions(phi: DataFrame, cells: DataFrame, weights: DataFrame, means: DataFrame,
                       n_classes: int) -> DataFrame:
    """Shape and additivity check of linear attributions.

    Counts must equal the inputs; ``sum_f phi + base_c`` must equal the
    margin ``sum_f w x`` for every sample and class (absent cells included
    analytically)."""
    base = weights.join(means, "feature").groupBy("class").agg(
        F.sum(F.col("w") * F.col("mean")).alias("_base"),
        F.sum(F.col("w") * -F.col("mean")).alias("_absent_all"))
    # phi of absent cells: -w*mean; margin of absent cells: 0
    present_phi = phi.groupBy("sample_id", "class").agg(F.sum("phi").alias("_pp"))
    present_w = cells.join(weights, "feature").join(means.select("feature", "mean"), "feature") \
        .groupBy("sample_id", "class").agg(F.sum(F.col("w") * F.col("value")).alias("_margin"),
                                           F.sum(F.col("w") * -F.col("mean")).alias("_pa"))
    per = present_phi.join(present_w, ["sample_id", "class"]).join(base, "class")
    # total phi = present phi + (all absent phi) - (absent phi of present features)
    total_phi = F.col("_pp") + F.col("_absent_all") - F.col("_pa")
    resid = F.abs(total_phi + F.col("_base") - F.col("_margin"))
    return per.agg(F.countDistinct("sample_id").alias("n_samples"),
                   F.countDistinct("class").alias("n_classes"),
                   F.max(resid).alias("max_residual")) \
        .withColumn("n_classes_expected", F.lit(n_classes)) \
        .withColumn("additive", F.col("max_residual") < F.lit(1e-6))


def background_rows(frame: DataFrame, n: int = 10, seed: int = 42, key: str = "sample_id",
                    features_col: str = "features") -> list[list[float]]:
    """Deterministic background sample: the ``n`` rows with the smallest
    ``md5(seed-key)`` (a bounded top-n, collected as ``n`` arrays)."""
    from pyspark.ml.functions import vector_to_array
    h = F.md5(F.concat(F.lit(str(seed)), F.lit("-"), F.col(key).cast("string")))
    rows = frame.select(h.alias("_h"), vector_to_array(F.col(features_col)).alias("x")) \
        .orderBy("_h").limit(n).collect()
    return [list(r["x"]) for r in rows]


_MD5_SHIFTS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
_MD5_SINES = (np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint64).astype(np.uint32)
_MD5_START = (0x67452301, 0xefcdab89, 0x98badcfe, 0x10325476)
#: Digests computed at once: the arrays of a round stay in the processor's cache.
_MD5_BLOCK = 1 << 14


def _md5_short(words: np.ndarray) -> list[np.ndarray]:
    """The four words of the MD5 of one padded block each, ``words[16, n]``."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in _MD5_START)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            f, g = d ^ (b & (c ^ d)), i
        elif turn == 1:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif turn == 2:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += _MD5_SINES[i]
        f += words[g]
        shift = _MD5_SHIFTS[turn, i % 4]
        turned = f << shift
        f >>= np.uint32(32) - shift
        turned |= f
        turned += b
        a, d, c, b = d, c, b, turned
    return [x + np.uint32(v) for x, v in zip((a, b, c, d), _MD5_START)]


def _digests(prefixes: list[bytes], suffixes: list[bytes]) -> np.ndarray:
    """``[prefix, suffix, 2]``: the MD5 of every prefix and suffix as two big-endian numbers."""
    n, longest = len(suffixes), max(map(len, suffixes))
    out = np.empty((len(prefixes), n, 2), np.uint64)
    sizes = np.array([len(x) for x in prefixes])
    ends = np.zeros((n, longest + 1), np.uint8)  # the suffix and the mark that ends a message
    for i, x in enumerate(suffixes):
        ends[i, :len(x) + 1] = np.frombuffer(x + b"\x80", np.uint8)
    lengths = np.array([len(x) for x in suffixes], np.uint32)
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        if size + longest > 55:  # more than one block
            for i in own:
                whole = b"".join([hashlib.md5(prefixes[i] + x).digest() for x in suffixes])
                out[i] = np.frombuffer(whole, ">u8").reshape(n, 2)
            continue
        step = max(1, _MD5_BLOCK // n)
        for at in (own[a:a + step] for a in range(0, len(own), step)):
            text = np.zeros((len(at), n, 64), np.uint8)
            text[:, :, :size] = np.frombuffer(b"".join([prefixes[i] for i in at]), np.uint8).reshape(len(at), 1, size)
            text[:, :, size:size + longest + 1] = ends
            words = np.ascontiguousarray(text.view("<u4").reshape(-1, 16).T)
            words[14] = np.tile((lengths + np.uint32(size)) * np.uint32(8), len(at))
            a, b, c, d = (x.byteswap().astype(np.uint64) for x in _md5_short(words))
            out[at, :, 0] = (a << np.uint64(32) | b).reshape(len(at), n)
            out[at, :, 1] = (c << np.uint64(32) | d).reshape(len(at), n)
    return out


def _draw_orders(texts: list[str], n_draws: int, n_perm: int, seed: int, d: int) -> np.ndarray:
    """``order[sample, draw, step]``: the features of every draw by the md5 of (seed, key, background
    row, permutation, feature)."""
    suffixes = [f"{i // n_perm}-{i % n_perm}-{j}".encode() for i in range(n_draws) for j in range(d)]
    h = _digests([f"{seed}-{t}-".encode() for t in texts], suffixes).reshape(len(texts), n_draws, d, 2)
    order = np.argsort(h[..., 0], axis=-1)
    first = np.take_along_axis(h[..., 0], order, axis=-1)
    return np.lexsort((h[..., 1], h[..., 0]), axis=-1) if (first[..., 1:] == first[..., :-1]).any() else order


def _switch_steps(background: np.ndarray, n_perm: int, seed: int):
    """Synthetic rows of every sample, draw after draw: the background row (``_on`` = -1), then one
    row for each feature whose switch to the sample's value changes the row."""
    bg = np.repeat(background, n_perm, axis=0)  # one row per draw
    n_draws, d = bg.shape
    step = max(1, STEP_VALUES // ((d + 1) * d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, orders in _samples(batches, n_draws, n_perm, seed, d):
            for lo in range(0, len(x) * n_draws, step):
                pair = np.arange(lo, min(lo + step, len(x) * n_draws))  # (sample, draw)
                row, draw = pair // n_draws, pair % n_draws
                own, order = x[row], orders[row, draw]
                rank = np.argsort(order, axis=1)
                on = np.insert(order, 0, -1, axis=1)
                changed = (own != bg[draw])[np.arange(len(on))[:, None], on]
                changed[:, 0] = True
                at, t = np.nonzero(changed)
                z = np.where(rank[at] < t[:, None], own[at], bg[draw[at]])
                n = len(z)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(z.ravel()))
                vector = pa.StructArray.from_arrays(
                    [pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), lists],
                    names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row[at])), pa.array(on[at, t].astype(np.int32)), vector],
                                                 names=["_key", "_on", "_vector"])
    return run


def _samples(batches: Iterator[pa.RecordBatch], n_draws: int, n_perm: int, seed: int, d: int) -> Iterator[tuple]:
    """Bounded parts of the batches, their values ``[sample, feature]`` and the orders of their draws."""
    size = max(1, STEP_VALUES // (n_draws * d * 8))
    for batch in batches:
        for a in range(0, batch.num_rows, size):
            part = batch.slice(a, size)
            x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield part, x, _draw_orders(part.column(1).to_pylist(), n_draws, n_perm, seed, d)


def _softmax(margins: np.ndarray) -> np.ndarray:
    """Probabilities over the first axis, like Spark's: the first margin of +infinity reads 1, the others 0 times theirs."""
    top = np.isposinf(margins)
    with np.errstate(invalid="ignore"):
        # fmax: a margin that is no number makes the sum one, whatever the largest is
        p = margins - np.fmax.reduce(margins, axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        if top.any():
            cells = np.nonzero(top.any(axis=0))
            p[:, *cells] = margins[:, *cells] * 0.0
            p[top.argmax(axis=0)[cells], *cells] = 1.0
    return p


def _linear_gains(background: np.ndarray, n_perm: int, seed: int, weights: np.ndarray, intercepts: np.ndarray):
    """The steps of :func:`_switch_steps` scored and credited where they are made: a switch moves the
    margins of a linear model by the weights times the change of the value."""
    bg = np.repeat(background, n_perm, axis=0)
    n_draws, d = bg.shape
    n_classes = len(weights)
    start = weights @ bg.T + intercepts[:, None]
    step = max(1, STEP_VALUES // (8 * d * n_classes))

    def gains(x: np.ndarray, orders: np.ndarray) -> np.ndarray:
        """``[sample, feature, class]``: the sums over the draws."""
        out = np.zeros((n_classes, len(x), d))
        for lo in range(0, len(x) * n_draws, step):
            pair = np.arange(lo, min(lo + step, len(x) * n_draws))
            row, draw = pair // n_draws, pair % n_draws
            own, order = x[row], orders[row, draw]
            same = own == bg[draw]
            margins = np.empty((n_classes, len(pair), d + 1))
            margins[:, :, 0] = start[:, draw]
            with np.errstate(invalid="ignore"):
                change = np.take_along_axis(np.where(same, 0.0, own - bg[draw]), order, axis=1)
                np.multiply(weights[:, order], change, out=margins[:, :, 1:])
                p = _softmax(np.cumsum(margins, axis=2))
                gain = p[:, :, 1:] - p[:, :, :-1]
            back = np.empty_like(gain)
            back[:, np.arange(len(pair))[:, None], order] = gain
            if not np.isfinite(own).all():  # an unchanged value earns nothing, whatever the margins
                back[:, same] = 0.0
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            out[:, row[begin]] += np.add.reduceat(back, begin, axis=1)
        return out.transpose(1, 2, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None  # the key that may go on in the next part
        emit = _emitter(n_draws)
        for part, x, orders in _samples(batches, n_draws, n_perm, seed, d):
            keys, sums = part.column(0), gains(x, orders)
            begin = np.append(0, np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1)
            sums, own = np.add.reduceat(sums, begin, axis=0), keys.take(pa.array(begin))
            if key is not None and key[0] == own[0]:
                sums[0] += total[0]
            elif key is not None:
                yield emit(key, total)
            if len(own) > 1:
                yield emit(own.slice(0, len(own) - 1), sums[:-1])
            key, total = own.slice(len(own) - 1), sums[-1:].copy()
        if key is not None:
            yield emit(key, total)
    return run


def _emitter(n_draws: int):
    def emit(keys: pa.Array, total: np.ndarray) -> pa.RecordBatch:
        """Rows of the sums ``total[key, feature, class]``."""
        n, d, n_classes = total.shape
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(np.repeat(np.arange(n, dtype=np.int32), d * n_classes))),
             pa.array(np.tile(np.repeat(np.arange(d, dtype=np.int32), n_classes), n)),
             pa.array(np.tile(np.arange(n_classes, dtype=np.int32), n * d)), pa.array(total.ravel() / n_draws)], names=["_key", "_j", "_c", "phi"])
    return emit


def _linear_parts(model, background: np.ndarray, features_col: str, output: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and intercepts by class if ``output`` is the softmax of linear margins."""
    if not isinstance(model, LogisticRegressionModel) or model.getFeaturesCol() != features_col \
            or model.getProbabilityCol() != output or not np.isfinite(background).all():
        return None
    weights = model.coefficientMatrix.toArray()
    return (weights, model.interceptVector.toArray()) if len(weights) == model.numClasses else None


def _credits(d: int, n_draws: int):
    """A scored step's gain over the row before it, summed by feature; the rows of a key follow each other."""
    emit = _emitter(n_draws)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, last = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, on = batch.column(0), batch.column(1).to_numpy()
            f = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(on), -1)
            gain = f - np.concatenate([f[:1] if last is None else last, f[:-1]])
            last = f[-1:]
            cuts = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(on)]):
                if key is None or keys[a] != key[0]:
                    if key is not None:
                        yield emit(key, total[None])
                    key, total = keys.slice(a, 1), np.zeros((d, f.shape[1]))
                step = np.flatnonzero(on[a:b] >= 0) + a
                np.add.at(total, on[step], gain[step])
        if key is not None:
            yield emit(key, total[None])
    return run


def sampled_shapley(model, frame: DataFrame, background: list[list[float]], classes: list,
                    n_perm: int = 2, seed: int = 42, key: str = "sample_id",
                    features_col: str = "features", feature_names: list[str] | None = None,
                    output: str = "probability") -> DataFrame:
    """Model-agnostic Shapley values by sampled feature permutations.

    For every sample, background row ``b`` and permutation ``p`` (a hash order
    of the features), the features are switched from the background value to
    the sample value one at a time, and the synthetic rows are scored by
    ``model.transform``, which must score row by row (keep the rows' order), as
    Spark ML's models do.  A switch that leaves the row as it is changes no
    output, so its row is not scored again and earns nothing.  The steps of a
    multinomial logistic regression are scored in the task that makes them, from
    the margins of the row before; other models score the rows.  The samples are
    dealt and sorted by key; a task makes the steps of a sample one after the
    other and sums the gains by feature, so nothing but the samples themselves
    is shuffled.  For every (b, p) the credits sum to ``f(x) - f(b)`` exactly.
    Work is at most ``n x B x P x (d + 1)`` scored rows.
    A null vector or a null key takes no part.
    """
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    bg = np.asarray(background, float)
    d, n_draws = bg.shape[1], len(bg) * n_perm
    names = feature_names or [str(i) for i in range(d)]
    kind = frame.schema[key].dataType.simpleString()
    x = frame.where(F.col(key).isNotNull() & F.col(features_col).isNotNull()) \
        .select(key, F.col(key).cast("string").alias("_text"), vector_to_array(F.col(features_col)).alias("_x"))
    # the samples are small beside the work on them: a number of tasks that is not coalesced by size
    conf = frame.sparkSession.conf.get("spark.sql.shuffle.partitions")
    tasks = max(int(conf), frame.sparkSession.sparkContext.defaultParallelism)
    x = x.repartition(tasks, F.xxhash64(key)).sortWithinPartitions(key)
    credited = f"_key {kind}, _j int, _c int, phi double"
    linear = _linear_parts(model, bg, features_col, output)
    if linear is not None:
        phi = x.mapInArrow(_linear_gains(bg, n_perm, seed, *linear), credited)
    else:
        made = x.mapInArrow(_switch_steps(bg, n_perm, seed), StructType([
            StructField("_key", frame.schema[key].dataType), StructField("_on", IntegerType()), StructField("_vector", VectorUDT())]))
        synth = made.select(F.col("_key").alias(key), "_on", F.col("_vector").alias(features_col))
        scored = model.transform(synth).select(key, "_on", vector_to_array(F.col(output)).alias("_f"))
        phi = scored.mapInArrow(_credits(d, n_draws), credited)
    name_arr = F.array(*[F.lit(n) for n in names])
    cls_arr = F.array(*[F.lit(str(c)) for c in classes])
    return phi.select(F.col("_key").alias(key), F.element_at(cls_arr, F.col("_c") + 1).alias("class"),
                      F.element_at(name_arr, F.col("_j") + 1).alias("feature"), "phi")
