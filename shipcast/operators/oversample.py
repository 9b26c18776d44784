"""ml05: SMOTE over feature vectors, with exact neighbours.

Every smaller class is grown to the majority size with synthetic vectors
``x + u * (nn - x)``, where ``nn`` is one of the ``k`` nearest rows of base row
``x`` in its class (Euclidean distance over all slots, one-hot ones included) and
``u`` is in [0, 1).  Base rows are drawn uniformly.

Neighbours are exact, by pivot cells: up to ``PIVOTS`` rows of a class are pivots,
and every row belongs to the cell of its nearest one.  A base row is compared
with its own cell first, and its k-th distance there bounds the search: another
cell is visited only if the triangle inequality allows a nearer row in it (by the
plane between the two pivots, or by the range of distances that the cell's rows
have to their pivot).  Cells are cut into blocks of ``BLOCK`` rows and meet the
base rows that visit them by an equi-join on (class, cell, block); a task holds
two blocks, whatever a cell's size.  Where cells do not separate a class the work
is quadratic in its size, as it must be for exact neighbours.

Draws come from hashes of (class, copy number) and ranks from hashes of the rows,
so the result does not depend on partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vector, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipcast.operators.quantiles import stable
from shipcast.operators.split import rank_rows

SEED = 42
K_NEIGHBOURS = 5
#: Pivots a class, and rows a block.
PIVOTS, BLOCK = 64, 1024


# ---------------------------------------------------------------- vectors in Arrow

def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the stored entries of a vector column."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    kind, _, indices, values = vectors.flatten()
    sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = kind.to_numpy(zero_copy_only=False) == 0
    slot[sparse[row]] = indices.filter(pa.array(sparse)).flatten().to_numpy(zero_copy_only=False)
    return row, slot, values.flatten().to_numpy(zero_copy_only=False)


def _matrices(*columns: pa.Array) -> list[np.ndarray]:
    """The columns as dense matrices over the slots that any of them uses."""
    parts = [_entries(c) for c in columns]
    used = np.unique(np.concatenate([slot for _, slot, _ in parts]))
    out = []
    for column, (row, slot, value) in zip(columns, parts):
        m = np.zeros((len(column), len(used)))
        m[row, np.searchsorted(used, slot)] = value
        out.append(m)
    return out


def _vectors(row, slot, value, n: int, size: int) -> pa.StructArray:
    """Sparse vectors from entries sorted by row and slot."""
    ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), x) for x in (pa.array(slot, pa.int32()), pa.array(value, pa.float64()))]
    return pa.StructArray.from_arrays([pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, size), pa.int32()), *lists],
                                      ["type", "size", "indices", "values"])


def _distances(a: np.ndarray, b: np.ndarray, rest: np.ndarray | float = 0.0) -> np.ndarray:
    """All distances between two sets of rows, up to rounding of the products; ``rest``
    are the squares of ``a``'s rows in slots that ``b`` lacks."""
    square = ((a * a).sum(1) + rest)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _used(vectors: list[Vector]) -> tuple[np.ndarray, np.ndarray]:
    """(slots that hold something, the vectors over these)."""
    parts = [(v.indices, v.values) if isinstance(v, SparseVector) else (np.arange(len(v)), v.toArray()) for v in vectors]
    slots = np.unique(np.concatenate([at[value != 0] for at, value in parts]))
    held = np.zeros((len(parts), len(slots)))
    for i, (at, value) in enumerate(parts):
        held[i, np.searchsorted(slots, at[value != 0])] = value[value != 0]
    return slots, held


def _to_used(vectors: pa.Array, slots: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Distances of a vector column's rows to ``held`` over ``slots``: a row takes as much
    memory as there are slots used, however many its vector has."""
    row, slot, value = _entries(vectors)
    own = np.isin(slot, slots)
    x = np.zeros((len(vectors), len(slots)))
    x[row[own], np.searchsorted(slots, slot[own])] = value[own]
    return _distances(x, held, np.bincount(row[~own], value[~own] ** 2, len(vectors)))


# ---------------------------------------------------------------- neighbours

def _compare(k: int):
    """Block against block: the k nearest rows of every base row among the block's."""
    def nearest(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {"cls": [], "base": [], "d": [], "r": []}
        if asked.num_rows and held.num_rows:
            q, x = _matrices(asked.column("v"), held.column("v"))
            base, rank = asked.column("base").to_numpy(), held.column("r").to_numpy()
            both = np.flatnonzero(q.any(0) & x.any(0))  # the other slots add nothing to the products
            square = (q * q).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * q[:, both] @ x[:, both].T
            square[base[:, None] == rank[None]] = np.inf
            slack = 1e-9 * (1 + (q * q).sum(1) + (x * x).sum(1).max())
            last = min(k, len(rank)) - 1
            bar = np.partition(square, last, 1)[:, last] + slack  # products round; differences decide below
            for i in range(len(base)):
                near = np.flatnonzero((square[i] <= bar[i]) & np.isfinite(square[i]))
                d = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                first = np.lexsort((rank[near], d))[:k]
                out["base"] += [base[i]] * len(first)
                out["d"] += d[first].tolist()
                out["r"] += rank[near][first].tolist()
            out["cls"] = [key[0].as_py()] * len(out["base"])
        return pa.table({"cls": pa.array(out["cls"], pa.string()), "base": pa.array(out["base"], pa.int64()),
                         "d": pa.array(out["d"], pa.float64()), "r": pa.array(out["r"], pa.int64())})
    return nearest


def _meet(asked: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """(cls, base, d, r): the k nearest of ``held`` (cls, cell, r, v) to each of ``asked``
    (cls, cell, base, v) within the cells they share, by blocks of both."""
    def blocks(df, name):
        return df.groupBy("cls", "cell").agg(F.ceil(F.count("*") / BLOCK).alias(name))

    shape = stable(blocks(asked, "qs").join(blocks(held, "hs"), ["cls", "cell"]))

    def dealt(df, row, own, other, own_name, other_name):
        return (df.join(shape, ["cls", "cell"])
                .withColumn(own_name, F.pmod(F.xxhash64(row), F.col(own)))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
                .drop("qs", "hs"))

    keys = ["cls", "cell", "qb", "hb"]
    left = dealt(asked, "base", "qs", "hs", "qb", "hb").groupBy(*keys)
    right = dealt(held, "r", "hs", "qs", "hb", "qb").groupBy(*keys)
    return left.cogroup(right).applyInArrow(_compare(k), "cls string, base long, d double, r long")


def _least(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("cls", "base").orderBy("d", "r")
    return found.withColumn("at", F.row_number().over(own)).where(F.col("at") <= k)


def neighbours(rows: DataFrame, asked: DataFrame, k: int = K_NEIGHBOURS) -> DataFrame:
    """(cls, base, at 1..k, d, r): the k nearest other rows of each asked row in its
    class, ties by rank.

    ``rows``: cls string, r long (from 0 in each class, in random order), v vector.
    ``asked``: cls, r of the rows to ask for."""
    # At most PIVOTS rows a class: a bounded driver-side table.
    pivots: dict[str, list] = {}
    for p in rows.where(F.col("r") < PIVOTS).orderBy("cls", "r").collect():
        pivots.setdefault(p["cls"], []).append(p["v"])
    pivots = {c: _used(v) for c, v in pivots.items()}

    def to_pivots(rb):
        """(rows, their class's pivots' distances), class by class."""
        classes = np.array(rb.column("cls").to_pylist(), object)
        for c in dict.fromkeys(classes):
            at = np.flatnonzero(classes == c)
            yield c, at, _to_used(rb.column("v").take(pa.array(at)), *pivots[c])

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            cell, ring = np.zeros(rb.num_rows, np.int32), np.zeros(rb.num_rows)
            for _, at, d in to_pivots(rb):
                cell[at], ring[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cell), pa.array(ring)], [*rb.schema.names, "cell", "ring"])

    schema = T.StructType([*rows.select("cls", "r", "v").schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("ring", T.DoubleType())])
    placed = stable(rows.select("cls", "r", "v").mapInArrow(place, schema))
    held = placed.select("cls", "cell", "r", "v")
    wanted = stable(placed.join(asked, ["cls", "r"]).withColumnRenamed("r", "base"))
    first = stable(_least(_meet(wanted.select("cls", "cell", "base", "v"), held, k), k))

    # Other cells, as far as the triangle inequality leaves them: at most PIVOTS x classes ranges.
    rings = {(r["cls"], r["cell"]): (r["low"], r["high"]) for r in placed.groupBy("cls", "cell").agg(
        F.min("ring").alias("low"), F.max("ring").alias("high")).collect()}
    bound = first.where(F.col("at") == k).select("cls", "base", F.col("d").alias("bound"))
    open_ = wanted.join(bound, ["cls", "base"], "left").fillna(float("inf"), ["bound"])

    def visits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            own, bound = rb.column("cell").to_numpy(), rb.column("bound").to_numpy()
            for c, at, d in to_pivots(rb):
                between = _distances(pivots[c][1], pivots[c][1])
                for cell in range(d.shape[1]):
                    if (c, cell) not in rings:
                        continue
                    low, high = rings[c, cell]
                    mine, gap = own[at], np.maximum(between[own[at], cell], 1e-300)
                    plane = (d[:, cell] ** 2 - d[np.arange(len(at)), mine] ** 2) / (2 * gap)
                    least = np.maximum.reduce([plane * (between[mine, cell] > 0), d[:, cell] - high, low - d[:, cell]])
                    go = at[(mine != cell) & (least <= bound[at] * (1 + 1e-9) + 1e-6)]
                    if len(go):
                        picked = pa.array(go)
                        yield pa.RecordBatch.from_arrays(
                            [rb.column("cls").take(picked), pa.array(np.full(len(go), cell, np.int32)),
                             rb.column("base").take(picked), rb.column("v").take(picked)], ["cls", "cell", "base", "v"])

    more = stable(open_.select("cls", "cell", "base", "v", "bound").mapInArrow(
        visits, wanted.select("cls", "cell", "base", "v").schema))
    found = first.drop("at").unionByName(_meet(more, held, k))
    return _least(found, k)


# ---------------------------------------------------------------- oversampling

def smote(df: DataFrame, label: str, features: str | Sequence[str] = "features", k: int = K_NEIGHBOURS, seed: int = SEED,
          synthetic_col: str = "is_synthetic", carry: Sequence[str] = ()) -> DataFrame:
    """``label``, ``features``, the ``carry`` columns and ``is_synthetic``: all rows, and
    synthetic ones so that every class has the majority count.  Synthetic rows
    take the ``carry`` columns of their base row.  A class of one row repeats it;
    in a class of at most k rows all others are neighbours.  Rows without a label
    stay and are not grown.  ``features`` may also be a list of numeric columns,
    which come back as columns (NULL as 0)."""
    carry = [c for c in carry if c in df.columns]
    if not isinstance(features, str):
        cols = list(features)
        flat = VectorAssembler(inputCols=cols, outputCol="features").transform(
            df.select(label, *carry, *cols).fillna(0.0, subset=cols))
        out, v = smote(flat, label, "features", k, seed, synthetic_col, carry), vector_to_array("features")
        return out.select(label, *carry, *[v[i].cast(df.schema[c].dataType).alias(c) for i, c in enumerate(cols)],
                          synthetic_col)
    rows = df.select(label, *carry, features)
    # Class sizes are plan metadata (one row per class).
    sizes = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count(F.lit(1))).collect()}
    most = max(sizes.values(), default=0)
    small = {c: n for c, n in sizes.items() if c is not None and n < most}
    kept = rows.withColumn(synthetic_col, F.lit(0))
    if not small:
        return kept
    spark, kind = df.sparkSession, df.schema[label].dataType
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    base = stable(rows.where(F.col(label).isin(list(small))).select(
        F.col(label).cast("string").alias("cls"), *carry, F.col(features).alias("v")))
    base = stable(rank_rows(base, [F.xxhash64("v"), *carry], by=["cls"], rank_col="r", size_col="_n").drop("_n"))

    index = None
    for c, n in small.items():
        # Copy numbers, spread evenly over tasks whatever the class's size.
        made = spark.range(0, most - n, 1, max(1, min(tasks, (most - n) // 10000 + 1))).select(
            F.lit(c).cast(kind).cast("string").alias("cls"), F.col("id").alias("t"), F.lit(n).cast("long").alias("n"))
        index = made if index is None else index.unionByName(made)
    h = F.xxhash64("cls", "t", F.lit(seed))
    index = stable(index.select(
        "cls", F.pmod(h, F.col("n")).alias("r"), F.xxhash64(h, F.lit(2)).alias("pick"),
        (F.pmod(F.xxhash64(h, F.lit(1)), F.lit(1 << 30)) / float(1 << 30)).alias("u")))

    near = neighbours(base, index.select("cls", "r").distinct(), k)
    near = near.groupBy("cls", F.col("base").alias("r")).agg(F.array_sort(F.collect_list(F.struct("at", "r"))).alias("near"))
    pick = F.get("near", F.pmod(F.col("pick"), F.size("near")).cast("int"))["r"]
    drawn = index.join(near, ["cls", "r"], "left").select("cls", "r", "u", F.coalesce(pick, F.col("r")).alias("nr"))
    pairs = (drawn.join(base, ["cls", "r"])
             .join(base.select("cls", F.col("r").alias("nr"), F.col("v").alias("w")), ["cls", "nr"])
             .select(F.col("cls").cast(kind).alias(label), *carry, "v", "w", "u"))

    def mix(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            n = rb.num_rows
            if not n:
                continue
            size = rb.column("v").flatten()[1][0].as_py() or len(rb.column("v").flatten()[3][0])
            parts = [_entries(rb.column(c)) for c in ("v", "w")]
            keys, where = np.unique(np.concatenate([row * size + slot for row, slot, _ in parts]), return_inverse=True)
            x, y, cut = np.zeros(len(keys)), np.zeros(len(keys)), len(parts[0][0])
            x[where[:cut]], y[where[cut:]] = parts[0][2], parts[1][2]
            row = keys // size
            made = x + rb.column("u").to_numpy()[row] * (y - x)
            yield pa.RecordBatch.from_arrays(
                [*[rb.column(c) for c in (label, *carry)], _vectors(row, keys % size, made, n, size)], [label, *carry, features])

    schema = T.StructType([*pairs.select(label, *carry).schema.fields, T.StructField(features, VectorUDT())])
    return kept.unionByName(pairs.mapInArrow(mix, schema).withColumn(synthetic_col, F.lit(1)))
