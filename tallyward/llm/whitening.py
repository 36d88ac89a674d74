"""Whitening of embeddings with distributed block matrices.

Centred vectors become the rows of a block matrix. Its transpose times itself is the
scatter, of the vectors' own dimensions and small, whose eigenvectors are found on the
driver; the block matrix times the whitening matrix is the result. All products run
inside the JVM, blocks of some 2 MB at a time.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.llm.store import Scratch

#: Entries are rounded down to whole steps of 1/64, and shifted to be positive.
STEPS = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Numbers in a block: 2 MB.
BLOCK = 1 << 18
#: Row blocks multiplied by one task.
BLOCKS_PER_TASK = 8
#: Tasks that a matrix of enough blocks is dealt to at least.
GROUPS = 64
#: Entries beyond this many steps are no embeddings; whole numbers below are exact as floating point.
LARGEST = float(1 << 52)
#: Eigenvalues below this part of the largest are rounding errors of zero.
LEAST = 1e-12


def usable(vector: Column) -> Column:
    """True for a vector of finite entries."""
    steps = vector.cast("array<double>")
    return F.coalesce(F.forall(steps, lambda c: F.coalesce(F.abs(c * STEPS) < LARGEST, F.lit(False))), F.lit(False))


def in_steps(vector: Column) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * STEPS).cast("bigint") + SHIFT)


def numbered(rows: DataFrame, store: Scratch, name: str) -> DataFrame:
    """The rows, written, with ``index`` from 0 without gaps. No row is shuffled: each task's rows follow the earlier tasks' ones."""
    kept = store.keep(rows.withColumn("_own", F.monotonically_increasing_id()), name)
    task = F.shiftright("_own", 33)
    counted = kept.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_own").alias("_least"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as the table had tasks
    bases = counted.select("_task", "_least", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    met = kept.join(F.broadcast(bases), task == F.col("_task"))
    return met.withColumn("index", F.col("_own") - F.col("_least") + F.col("_base")).select("index", *rows.columns)


def _groups(count: int, width: int) -> int:
    return min(GROUPS, -(-count * width // BLOCK))


def blocked(rows: DataFrame, count: int, width: int) -> BlockMatrix:
    """A block matrix, kept until ``_forget``, from rows ``index, vector``.

    MLlib deals a matrix of one column of blocks to the square root of the rows' partitions,
    so partitions without rows are added where these are few.
    """
    vectors = rows.select("index", array_to_vector("vector").alias("vector"))
    padding = _groups(count, width) ** 2
    none = rows.sparkSession.range(0, padding, 1, padding).filter("id < 0")
    vectors = vectors.union(none.select("id", array_to_vector(F.array().cast("array<double>"))))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), count, width)
    return indexed.toBlockMatrix(max(1, BLOCK // width), width).persist(StorageLevel.MEMORY_AND_DISK)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; ``splits`` tasks share the sum over the common dimension."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _forget(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def scatter(rows: BlockMatrix) -> np.ndarray:
    """The rows' transpose times the rows, a matrix of their width."""
    splits = max(1, -(-rows.numRows() // (rows.rowsPerBlock * BLOCKS_PER_TASK)))
    return product(rows.transpose(), rows, splits).toLocalMatrix().toArray()


def _local_block(spark: SparkSession, matrix: np.ndarray, groups: int) -> BlockMatrix:
    """A matrix of one block, in so many partitions that a product is dealt to ``groups`` tasks."""
    block = ((0, 0), DenseMatrix(*matrix.shape, matrix.ravel(order="F")))
    frame = spark.createDataFrame([block], ["place", "block"]).repartition(groups**2)
    high, width = matrix.shape
    return BlockMatrix(callMLlibFunc("createBlockMatrix", frame, high, width, high, width), high, width)


def _column_sums(rows: DataFrame, column: str, width: int) -> list:
    """Exact sums of whole numbers, one per dimension."""
    one = rows.agg(*[F.sum(F.col(column)[k]).alias(f"s{k}") for k in range(width)]).first()
    return [v or 0 for v in one]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row and component ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``vectors`` has ``vec_id, embedding``. Entries become whole steps; ``n`` rows are fitted
    and projected on the first components of their covariance (divisor n), each brought to
    variance 1. ``deviation`` is the squared distance from the mean, times n squared, exact.
    ``explained`` is the component's part of the whole variance, ``identity_error`` the largest
    deviation of the results' covariance from the identity. A component's sign is such that its
    entry largest in size is positive.

    The driver holds matrices of the vectors' width, and one entry per block of some 2 MB.

    Defined cases: rows whose vector is null, or has null, non-finite or absurdly large entries
    (2^52 steps), are dropped. So are rows of another length than most have (of equally common
    lengths, the larger one counts), and empty vectors. A deviation that fits no 64-bit number
    is null. Directions without variance have no component, so equal vectors give no rows.
    Null and repeated ids are rows like any other. An empty table gives an empty result. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    store = Scratch(spark, "whitening")
    read = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("_v"))
    read = read.filter(usable(F.col("_v"))).select("vec_id", in_steps(F.col("_v")).alias("x"))
    rows = numbered(read.filter(F.size("x") > 0), store, "steps")
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("width")).limit(2).collect()
    width, count = (common[0]["width"], common[0]["n"]) if common else (1, 0)
    if len(common) > 1:
        rows = numbered(rows.filter(F.size("x") == width).drop("index"), store, "steps-of-width")
    if not count:
        return _shown(rows.select("index", "vec_id", F.lit(None).cast("bigint").alias("deviation")), rows.select("index", F.array().cast("array<double>").alias("z")), 0, [], 0.0)

    sums = F.lit(_column_sums(rows, "x", width)).cast("array<bigint>")
    # n times the distance from the mean, in whole numbers
    spread = F.zip_with("x", sums, lambda x, s: x * count - s)
    centred = rows.select("index", "vec_id", spread.alias("spread"))
    blocks = blocked(centred.select("index", F.transform("spread", lambda d: d.cast("double") / count).alias("vector")), count, width)
    variance = scatter(blocks) / count
    values, directions = np.linalg.eigh((variance + variance.T) / 2)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > max(LEAST * values.max(), 0.0)]
    values, directions = values[order], directions[:, order]
    if not len(values):
        return _shown(rows.select("index", "vec_id", F.lit(None).cast("bigint").alias("deviation")), rows.select("index", F.array().cast("array<double>").alias("z")), 0, [], 0.0)
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    projected = product(blocks, _local_block(spark, directions * signs / np.sqrt(values), _groups(count, width)))
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = store.keep(found.select("index", vector_to_array("vector").alias("z")), "projected")
    _forget(blocks)

    means = np.array(_column_sums(found, "z", len(values))) / count
    again = F.zip_with("z", F.lit(means.tolist()).cast("array<double>"), lambda z, m: z - m)
    result = blocked(found.select("index", again.alias("vector")), count, len(values))
    held = scatter(result) / count
    _forget(result)
    error = float(np.abs(held - np.eye(len(values))).max())

    def squares(total: Column, d: Column) -> Column:
        return F.try_add(total, F.try_multiply(d, d))

    deviation = F.aggregate("spread", F.lit(0).cast("bigint"), squares)
    told = centred.select("index", "vec_id", deviation.alias("deviation"))
    return _shown(told, found, count, (values / np.trace(variance)).tolist(), error)


def _shown(told: DataFrame, found: DataFrame, count: int, explained: list[float], error: float) -> DataFrame:
    parts = F.lit(explained).cast("array<double>") if explained else F.array().cast("array<double>")
    each = told.join(found, "index").select("vec_id", "deviation", F.posexplode("z").alias("_at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(count).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(parts, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
