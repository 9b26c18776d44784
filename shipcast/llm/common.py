"""Helpers shared by the operators: written tables, links inside groups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.session import scratch_path

#: Members of one group that a task compares at once; larger groups are cut
#: into blocks of this size and compared block against block in other tasks.
BLOCK = 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage: later stages survive lost executors by rereading the files,
    and the planner knows the table's bytes.  ``discard`` deletes the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of written tables that no later result reads."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def forest(ids: np.ndarray, linked: np.ndarray, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest, as stars, of the graph whose 0/1 adjacency is ``linked``
    (between ``ids``, or between ``ids`` and ``other``)."""
    if other is not None:
        n, m = len(ids), len(other)
        square = np.zeros((n + m, n + m), bool)
        square[:n, n:], square[n:, :n] = linked, linked.T
        ids, linked = np.concatenate([ids, other]), square
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    label, busy = rank.copy(), np.flatnonzero(linked.any(1))
    while len(busy):
        near = np.where(linked[busy], label[None, :], len(ids)).min(1)
        new = np.minimum(label[busy], near)
        if (new == label[busy]).all():
            break
        label[busy] = new
    by_rank = ids[np.argsort(rank)]
    return [(int(ids[i]), int(by_rank[label[i]])) for i in busy if ids[i] != by_rank[label[i]]]


LINK_SCHEMA = "a long, b long, g long, block int, payload binary"


def group_links(rows: DataFrame, match: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int,
                dtype: str, name: str, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect, inside every group ``g``, the members that match.

    ``rows``: g long, id long, payload binary (``width`` items of ``dtype``).
    ``match(P, Q)`` gives the 0/1 matrix of matching payloads.  Only a spanning
    forest of each group's links comes out, never all its pairs.  Rows are
    sorted by group, and a task streams through them.  A group of more than
    ``block`` members only passes through that task: its members leave in
    numbered blocks, and every pair of blocks is then compared in a task of its
    own, so no group is held whole anywhere and no comparison is left out.
    """
    spark = rows.sparkSession

    def decode(cells: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(cells), dtype).reshape(len(cells), width)

    def batch(links=(), hot=()):
        a, b = [x for x, _ in links], [x for _, x in links]
        n, m = len(a), len(hot)
        return pa.RecordBatch.from_arrays(
            [pa.array([*a, *(h[1] for h in hot)], pa.int64()), pa.array(b + [None] * m, pa.int64()),
             pa.array([None] * n + [h[0] for h in hot], pa.int64()),
             pa.array([None] * n + [h[2] for h in hot], pa.int32()),
             pa.array([None] * n + [h[3] for h in hot], pa.binary())], ["a", "b", "g", "block", "payload"])

    def small(g, ids, load):
        """Links of whole groups; members of one group lie together."""
        starts, sizes = runs(g)
        links = []
        keep = np.repeat(sizes > 1, sizes)
        if keep.any():
            at = np.flatnonzero(keep)
            data = decode([load[i] for i in at])
            begin, left = 0, sizes[sizes > 1]
            for size in left:
                own, x = ids[at[begin:begin + size]], data[begin:begin + size]
                hit = match(x, x)
                np.fill_diagonal(hit, False)
                if hit.any():
                    links += forest(own, hit)
                begin += size
        return links

    def stream(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held_i, held_p = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        open_g, sent = None, 0  # the group that passes through, and its members so far
        for rb in it:
            g = np.concatenate([held_g, rb.column(0).to_numpy(zero_copy_only=False)])
            ids = np.concatenate([held_i, rb.column(1).to_numpy(zero_copy_only=False)])
            load = held_p + rb.column(2).to_pylist()
            if not len(g):
                continue
            starts, sizes = runs(g)
            hot, begin = [], 0
            if open_g is not None and g[0] == open_g:
                hot += [(int(open_g), int(ids[i]), (sent + i) // block, load[i]) for i in range(sizes[0])]
                sent, begin = sent + int(sizes[0]), int(sizes[0])
            end = int(starts[-1])  # the last group may go on in the next batch
            if begin <= end and sizes[-1] > block:
                open_g, sent = g[-1], int(sizes[-1])
                hot += [(int(open_g), int(ids[end + i]), i // block, load[end + i]) for i in range(sent)]
                held = slice(len(g), None)
            else:
                held = slice(max(begin, end), None)
            mid = slice(begin, max(begin, end))
            big = np.repeat(sizes > block, sizes)[mid]
            links = []
            if mid.stop > mid.start:
                gg, ii, ll = g[mid], ids[mid], load[mid]
                if big.any():  # a batch that holds a large group whole
                    for s, n in zip(*runs(gg)):
                        if n > block:
                            hot += [(int(gg[s]), int(ii[s + k]), k // block, ll[s + k]) for k in range(n)]
                    rest = np.flatnonzero(~big)
                    gg, ii, ll = gg[rest], ii[rest], [ll[k] for k in rest]
                links = small(gg, ii, ll)
            held_g, held_i, held_p = g[held], ids[held], load[held]
            if links or hot:
                yield batch(links, hot)
        if links := small(held_g, held_i, held_p):
            yield batch(links)

    n = partitions(spark)
    first = written(rows.select("g", "id", "payload").repartition(n, "g").sortWithinPartitions("g", "id")
                    .mapInArrow(stream, LINK_SCHEMA), f"{name}-links")
    hot = first.where(F.col("g").isNotNull()).select("g", F.col("a").alias("id"), "block", "payload")
    # Every pair of blocks (i <= j) of a large group is one cell; a member goes to the cells of its block.
    top = hot.groupBy("g").agg(F.max("block").alias("top"))
    cells = (hot.join(top, "g")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("top"))))
             .select("g", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     (F.col("block") <= F.col("other")).alias("left"), "id", "payload"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        data = decode(table.column("payload").to_pylist())
        side = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
        if key[1].as_py() == key[2].as_py():
            hit = match(data, data)
            np.fill_diagonal(hit, False)
            links = forest(ids, hit)
        else:
            links = forest(ids[side], match(data[side], data[~side]), ids[~side])
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([x for _, x in links], pa.int64())})

    across = cells.groupBy("g", "i", "j").applyInArrow(compare, "a long, b long")
    return first.where(F.col("g").isNull()).select("a", "b").unionByName(across).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, root): the smallest id reachable from every id that has a link.

    Alternates large-star and small-star steps until nothing changes.  Each
    step writes its edges; per-node minima are partial aggregates, and the
    joins read written tables on both sides, so a hub that holds a third of the
    edges is split by the skew-join rule.
    """
    edges = written(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                    .where("v <> u").distinct(), f"{name}-edges")
    while True:
        # Large star: every node gives its larger neighbours to its smallest one.
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = written(both.groupBy("v").agg(F.min("u").alias("m"))
                      .select("v", F.least("v", "m").alias("m")), f"{name}-low")
        large = written(edges.join(low.withColumnRenamed("v", "u"), "u").select("v", F.col("m").alias("u"))
                        .distinct(), f"{name}-large")
        # Small star: every node gives its smaller neighbours, and itself, to the smallest.
        least = written(large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")), f"{name}-least")
        pairs = large.join(least, "v")
        small = written(pairs.select(F.col("u").alias("v"), F.col("m").alias("u"))
                        .unionByName(least.select("v", F.col("m").alias("u"))).where("v <> u").distinct(),
                        f"{name}-small")
        same = edges.count() == small.count() and edges.join(small, ["v", "u"], "left_anti").isEmpty()
        discard(edges, low, large, least)
        edges = small
        if same:
            break
    return edges.select(F.col("v").alias("id"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("id"), F.col("u").alias("root"))).distinct()
