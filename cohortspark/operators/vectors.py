"""ML vectors from long cells in linear time.

Cells are shuffled once by sample and sorted by (sample, position); a task
then streams through the runs and builds Spark ML vectors in Arrow batches, so
the work is proportional to the number of cells (plus the dense width, where a
dense vector is asked for) and no sample's cells are ever collected in the
JVM.  There is no width limit.

Absent cells read ``fill``: a number, or one number per position (for example
the scaled zero).  A vector is stored sparse when absent cells read 0 and that
takes less room, dense otherwise; both are the same vector for Spark ML.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Values of one Arrow batch of dense vectors, at most (or one vector).
BATCH_VALUES = 1 << 21

_VECTOR = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())),
                     ("values", pa.list_(pa.float64()))])


def _vector_array(n: np.ndarray, pos: np.ndarray, value: np.ndarray, d: int, fill: np.ndarray | float,
                  form: str | None) -> pa.StructArray:
    """Vectors of consecutive samples with ``n`` cells each."""
    rows = len(n)
    dense = n * 12 + 20 >= d * 8 if form is None else np.full(rows, form == "dense")
    cells = np.repeat(dense, n)
    width = np.where(dense, d, n)
    at = np.concatenate([[0], np.cumsum(width)])
    values = np.empty(int(at[-1]))
    if dense.any():
        block = np.empty((int(dense.sum()), d))
        block[:] = fill
        block[np.repeat(np.arange(len(block)), n[dense]), pos[cells]] = value[cells]
        values[np.repeat(dense, width)] = block.ravel()
    values[~np.repeat(dense, width)] = value[~cells]
    kinds = pa.array(dense.astype(np.int8))  # 1 is dense, 0 sparse
    sizes = pa.array(np.full(rows, d, np.int32), mask=dense)
    places = np.where(dense, 0, n)
    bounds = pa.array(np.concatenate([[0], np.cumsum(places)]).astype(np.int32), mask=np.append(dense, False))
    indices = pa.ListArray.from_arrays(bounds, pa.array(pos[~cells].astype(np.int32)))
    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))
    return pa.StructArray.from_arrays([kinds, sizes, indices, lists], fields=list(_VECTOR))


def _build(d: int, fill: np.ndarray | float, form: str | None):
    zero = np.isscalar(fill) and fill == 0.0

    def vectors(keys: pa.Array, pos: np.ndarray, value: np.ndarray, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole samples, which begin at the given rows; position -1 stands for no cell."""
        end = np.append(begin[1:], len(pos))
        step = max(1, BATCH_VALUES // max(d, 1))
        for lo in range(0, len(begin), step):
            hi = min(lo + step, len(begin))
            a, b = begin[lo], end[hi - 1]
            real = pos[a:b] >= 0
            if zero:
                real &= value[a:b] != 0.0  # the same as an absent cell
            n = np.add.reduceat(real, begin[lo:hi] - a).astype(np.int64)
            p = pos[a:b][real]
            owner = np.repeat(np.arange(hi - lo), n)
            twice = (p[1:] == p[:-1]) & (owner[1:] == owner[:-1])
            if twice.any():
                raise ValueError(f"position {p[1:][twice][0]} occurs twice in a sample; aggregate the cells first")
            if len(p) and p[-1] >= d:
                raise ValueError(f"position {p[-1]} is outside a vector of {d}")
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(begin[lo:hi])), _vector_array(n, p, value[a:b][real], d, fill, form)], names=["key", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the sample that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if held is None else pa.concat_batches([held, batch])
            keys = table.column(0)
            change = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1
            begin = np.concatenate([[0], change])
            held = table.slice(begin[-1])
            if len(begin) > 1:
                whole = table.slice(0, begin[-1])
                yield from vectors(whole.column(0), whole.column(1).to_numpy(), whole.column(2).to_numpy(), begin[:-1])
        if held is not None:
            yield from vectors(held.column(0), held.column(1).to_numpy(), held.column(2).to_numpy(), np.zeros(1, np.int64))
    return run


def assemble_vectors(long_pos: DataFrame, d: int, fill=0.0, key: str = "sample_id", out: str = "features",
                     samples: DataFrame | None = None, form: str | None = None) -> DataFrame:
    """``(key, out)``: one Spark ML vector of width ``d`` per sample, from cells ``(key, pos, value)``.

    NULL values and positions read as absent.  With ``samples`` every sample of
    that table gets a vector, also one without any cell.  A position that occurs
    twice in a sample is an error (aggregate the cells first).  ``form`` may ask
    for "dense" or, where absent cells read 0, "sparse" vectors."""
    if not np.isscalar(fill):
        fill = np.asarray(fill, float)
        if len(fill) != d:
            raise ValueError("one fill value per position is needed")
        if not fill.any():
            fill = 0.0
    else:
        fill = float(fill)
    if np.isscalar(fill) and fill == 0.0:
        pass
    elif form == "sparse":
        raise ValueError("sparse vectors need absent cells to read 0")
    else:
        form = "dense"
    cells = long_pos.where(F.col(key).isNotNull()).select(
        key, F.when(F.col("value").isNotNull(), F.coalesce(F.col("pos").cast("int"), F.lit(-1))).otherwise(F.lit(-1)).alias("pos"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
    if samples is not None:
        spine = samples.where(F.col(key).isNotNull()).select(key, F.lit(-1).alias("pos"), F.lit(0.0).alias("value"))
        cells = cells.join(samples.select(key).distinct(), key, "left_semi").unionByName(spine)
    kind = cells.schema[key].dataType
    # All cells of a sample must meet; a sample holds at most one cell per position.  Dealt by a hash
    # of its own: a plain repartition(key) may be left out over a union whose two sides are
    # already dealt by the key, and those sides' partitions need not match after coalescing.
    ordered = cells.repartition(F.xxhash64(key)).sortWithinPartitions(key, "pos")
    made = ordered.mapInArrow(_build(d, fill, form), StructType([StructField("key", kind), StructField("vector", VectorUDT())]))
    return made.select(F.col("key").alias(key), F.col("vector").alias(out))
