"""Embedding near-dedup by lattice hashing.

In each of several tables a random projection takes the unit vectors to eight
dimensions, where they are decoded to the nearest point of the lattice E8.  A
vector stands in its own cell and in the neighbouring cells nearest to it, so
two vectors are candidates when any of these cells agree.  Candidates are
verified by cosine in double precision.

Equal vectors of a label are one class.  Inside a cell only links that connect
its members are kept (large cells in blocks, block against block), and the
links are joined to components.  All links of a vector lie inside its
component; their number is then counted there exactly, again block against
block, with one partial count a vector and block, never a row for each pair.

Vectors that are null, zero, or hold null or non-finite parts, and rows without
label, link with nothing; vectors of different length never link.  Repeated
rows are vectors of their own and link with each other.  An empty table gives an
empty result.  Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import components, group_links, written

THRESHOLD = 0.98
TABLES, PROBES = 6, 2
#: Lattice units that a unit length of the projection spans.  At 1.3, six tables and two neighbours find 99.9 % of pairs
#: at cosine 0.98 in 64 dimensions, and 0.02 % of unrelated pairs are candidates; a larger scale is more selective.
SCALE = 1.3
SEED = 5
#: Classes of a component that one task counts against as many others.
COUNTED = 256


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to the neighbouring cells."""
    pairs = [[s if k == i else t if k == j else 0 for k in range(8)]
             for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    halves = [x for x in itertools.product((0.5, -0.5), repeat=8) if sum(v < 0 for v in x) % 2 == 0]
    return np.array(pairs + halves, float)


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row."""
    def even(y: np.ndarray) -> np.ndarray:
        """Nearest whole numbers with an even sum: where it is odd, the worst rounding is turned round."""
        near = np.rint(y)
        worst = np.abs(y - near).argmax(1)
        rows = np.arange(len(y))
        other = near[rows, worst] + np.where(y[rows, worst] >= near[rows, worst], 1, -1)
        odd = near.sum(1) % 2 != 0
        near[rows[odd], worst[odd]] = other[odd]
        return near

    a, b = even(x), even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cells(unit: np.ndarray, table: int, probes: int, scale: float = SCALE) -> np.ndarray:
    """Keys of each vector's own cell and of the nearest neighbouring ones."""
    rng = np.random.default_rng([SEED, table, unit.shape[1]])
    x = unit @ rng.normal(size=(unit.shape[1], 8)) * scale + rng.random(8)
    home, steps = decode(x), roots()
    toward = np.argsort(-(x - home) @ steps.T, axis=1, kind="stable")[:, :probes]
    points = np.concatenate([home[:, None], home[:, None] + steps[toward]], 1)
    odd = rng.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    key = ((points * 2).astype(np.int64).astype(np.uint64) * odd).sum(2, dtype=np.uint64)
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ key >> np.uint64(32)).view(np.int64)


def cosines(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    p, q = p.astype(float), q.astype(float)
    return (p @ q.T) / (np.sqrt((p * p).sum(1))[:, None] * np.sqrt((q * q).sum(1))[None, :])


def vectors(table: DataFrame) -> DataFrame:
    """vec_id, label, size and vector (bytes of its float64 parts; null if it links with nothing)."""
    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            out = []
            for v, label in zip(rb.column("embedding").to_pylist(), rb.column("label").to_pylist()):
                good = label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
                x = np.array(v, float) if good else None
                good = good and 0 < (x * x).sum() < math.inf
                out.append(x.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([rb.column("vec_id"), rb.column("label"), pa.array(out, pa.binary())],
                                             ["vec_id", "label", "vector"])

    kind = table.schema["label"].dataType.simpleString()
    return table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label").mapInArrow(
        pack, f"vec_id long, label {kind}, vector binary")


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES,
                    scale: float = SCALE) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable by links), kept."""
    rows = written(vectors(table).withColumn("cls", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))),
                   "lattice-vectors")
    good = rows.where("cls is not null")
    classes = written(good.groupBy("cls", "label", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n")),
                      "lattice-classes")

    def match(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return cosines(p, q) >= threshold

    links = None
    for (size,) in classes.select(F.length("vector")).distinct().collect():  # the lengths that occur
        def spread(it: Iterator[pa.RecordBatch], size: int = size) -> Iterator[pa.RecordBatch]:
            for rb in it:
                raw = rb.column("vector").to_pylist()
                x = np.frombuffer(b"".join(raw), float).reshape(len(raw), size // 8)
                unit = x / np.sqrt((x * x).sum(1))[:, None]
                for t in range(tables):
                    keys = cells(unit, t, probes, scale)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.full(keys.size, t, np.int32)),
                         *(rb.column(c).take(pa.array(np.repeat(np.arange(len(raw)), keys.shape[1])))
                           for c in ("label", "cls", "vector"))], ["cell", "t", "label", "id", "payload"])

        kind = classes.schema["label"].dataType.simpleString()
        dealt = (classes.where(F.length("vector") == size).select("label", "cls", "vector")
                 .mapInArrow(spread, f"cell long, t int, label {kind}, id long, payload binary")
                 .select(F.xxhash64("label", "t", "cell").alias("g"), "id", "payload"))
        found = group_links(dealt, match, size // 8, "<f8", f"lattice-{size}")
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = good.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    roots_ = components(links, "lattice")
    joined = written(classes.join(roots_, classes.cls == roots_.id, "left").select(
        "cls", "first_id", "n", "vector", F.coalesce("root", "cls").alias("root")), "lattice-joined")

    # Links within components: blocks of classes, every pair of blocks once.
    wholes = joined.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("classes"))
    wholes = written(wholes.withColumn("blocks", F.ceil(F.col("classes") / COUNTED).cast("int")), "lattice-components")
    dealt = (joined.join(wholes.where("classes > 1"), "root")
             .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     (F.col("block") <= F.col("other")).alias("left"), "cls", "n", "vector"))

    def count(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        ids, n = part.column("cls").to_numpy(), part.column("n").to_numpy()
        x = np.frombuffer(b"".join(part.column("vector").to_pylist()), float).reshape(len(ids), -1)
        if key[1].as_py() == key[2].as_py():
            near = match(x, x)
            np.fill_diagonal(near, False)
            out, sums = ids, near @ n
        else:
            left = part.column("left").to_numpy(zero_copy_only=False).astype(bool)
            near = match(x[left], x[~left])
            out, sums = np.concatenate([ids[left], ids[~left]]), np.concatenate([near @ n[~left], near.T @ n[left]])
        return pa.table({"cls": pa.array(out, pa.int64()), "links": pa.array(sums, pa.int64())})

    counts = (dealt.groupBy("root", "i", "j").applyInArrow(count, "cls long, links long")
              .groupBy("cls").agg(F.sum("links").alias("links")))
    summary = written(joined.select("cls", "root", "n").join(wholes.select("root", "component_id"), "root")
                      .join(counts, "cls", "left")
                      .select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
                      "lattice-summary")
    out = rows.select("vec_id", "cls").join(summary, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
