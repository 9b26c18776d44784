"""Mixing sources to target weights along a time-varying curriculum.

Size of a document: its words ``[^\\x20\\x09-\\x0D]+``.  Every source has a
weight; the weights share the words of all documents, a source's target stops
at ``cap`` times its own words, and the excess is reshared by weight until no
target is above.

Within a source, documents lie in a fixed pseudo-random order on a line of
cumulative words, and the line is run through again for as long as the target
asks.  A run of a document is taken when it ends before the target.  The words
still missing (a long document may straddle the target) are refilled from the
runs behind it, see ``_refill``: a source misses its target by at most half of
a document that could still be taken, or of the last one taken, and no document
is taken more than ``cap`` times.  A source's weight varies over training: its
schedule is integrated to the cumulative demand, and the cumulative words
before a run are put through the inverse of that integral, which gives the run's
training position in [0, 1).  Documents are range-sorted by position.

The order is by a hash of the row, cut into buckets by the hash's leading bits,
so running sums are made per (source, bucket) and no source is gathered in a
task; results do not depend on the number of buckets.

Null text is an empty text of size 0, taken 0 times.  A null source is a
source, last in order.  Rows that repeat in all columns keep the same hash and
lie next to each other.  An empty table gives an empty result.  Columns named
like an internal one are safe: internal names carry the prefix ``_mix``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import discard, partitions, written

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
#: Curriculum of the production mix: times, and for each weight of the cycle
#: its relative strength at those times (linear in between).
TIMES = (0.0, 0.5, 1.0)
SHAPES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    return (F.size(words) - (F.element_at(words, 1) == "").cast("int")
            - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, cycle, target) from (source, source_size), written.

    Sources are numbered in code point order, nulls last, by a range sort with
    per-partition counts; resharing repeats one aggregate over the sources
    until no further source reaches its cap.
    """
    spark = totals.sparkSession
    sorted_ = written(totals.repartitionByRange(partitions(spark), F.col("source").asc_nulls_last())
                      .sortWithinPartitions(F.col("source").asc_nulls_last())
                      .withColumn("_mix_part", F.spark_partition_id())
                      .withColumn("_mix_row", F.monotonically_increasing_id()), "mix-sources")
    parts = sorted_.groupBy("_mix_part").agg(F.count("*").alias("n"), F.min("_mix_row").alias("first"))
    before = F.sum("n").over(Window.orderBy("_mix_part")) - F.col("n")  # one row per partition
    ranked = (sorted_.join(parts.select("_mix_part", "first", before.alias("before")), "_mix_part")
              .withColumn("cycle", ((F.col("before") + F.col("_mix_row") - F.col("first")) % len(weights)).cast("int")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("cycle") + 1)
    ranked = written(ranked.select("source", "source_size", "cycle", weight.alias("weight")), "mix-ranked")
    discard(sorted_)

    level, capped, full = 0.0, -1, F.col("source_size") * float(cap)
    while True:
        over = full < F.col("weight") * level
        row = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, full)).alias("kept"),
                         F.sum(F.when(~over, F.col("weight"))).alias("weight"),
                         F.count_if(over).alias("capped")).first()
        if row["capped"] == capped or not row["weight"]:
            break
        capped = row["capped"]
        level = ((row["all"] or 0) - (row["kept"] or 0.0)) / row["weight"]
    return ranked.select("source", "source_size", "cycle", F.least(full, F.col("weight") * level).alias("target"))


def position(share: Column, cycle: Column, times: Sequence[float], shapes: Sequence[Sequence[float]]) -> Column:
    """The time at which the integral of a source's schedule reaches ``share`` of its whole."""
    whole = F.lit(None).cast("double")
    for c, shape in enumerate(shapes):
        areas = [(t1 - t0) * (a + b) / 2 for t0, t1, a, b in zip(times, times[1:], shape, shape[1:])]
        total, done, at = math.fsum(areas), 0.0, F.lit(float(times[-1]))
        steps = []
        for t0, t1, a, b, area in zip(times, times[1:], shape, shape[1:], areas):
            steps.append((done / total, t0, a / total, (b - a) / (t1 - t0) / total))
            done += area
        for start, t0, w, slope in steps:  # later segments win
            v = F.greatest(share - start, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(w * w) + v * (2 * slope), F.lit(0.0))) + w
            at = F.when(share >= start, t0 + F.when(root > 0, 2 * v / root).otherwise(0.0)).otherwise(at) \
                if start else t0 + F.when(root > 0, 2 * v / root).otherwise(0.0)
        whole = F.when(cycle == c, at).otherwise(whole)
    return whole


def _placed(marked: DataFrame, starts: DataFrame) -> DataFrame:
    """``marked`` with its source's row of ``starts`` and _mix_start, the words that lie before it in its source."""
    order = Window.partitionBy("source", "_mix_bucket").orderBy(
        F.shiftrightunsigned("_mix_hash", 1), "_mix_hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    # The key of the join is that of the window: one shuffle serves both.
    return (marked.join(starts, F.col("source").eqNullSafe(F.col("_mix_s"))
                        & (F.col("_mix_bucket") == F.col("_mix_b")))
            .withColumn("_mix_start", F.col("_mix_before") + F.coalesce(F.sum("_mix_size").over(order), F.lit(0))))


def _runs(cap: int) -> Column:
    """Where each run of a document ends on its source's line."""
    return F.transform(F.sequence(F.lit(0), F.lit(cap - 1)),
                       lambda k: k * F.col("_mix_source_size") + F.col("_mix_start") + F.col("_mix_size"))


def _whole(cap: int) -> Column:
    return F.filter(_runs(cap), lambda end: (F.col("_mix_size") > 0) & (end <= F.col("_mix_target")))


def _refill(placed: DataFrame, cap: int) -> DataFrame:
    """(_mix_f, _mix_fs, _mix_fills): source, start and middles of the further runs that fill the gaps of the sources.

    ``placed``: source, bucket, start, hash, size, target, times (whole runs taken), last (where they end).
    A pass takes, for each source, the one document that comes nearest to the
    gap, if it misses by at most half of the smallest one at hand or if all at
    hand are longer than half of the gap; else it runs through the documents of
    up to half of the gap, in the order of the line, by running sums per
    (source, lap, bucket), which leaves less than half of the gap or none of them.
    So passes grow with the logarithm of the gap, and end when no document is
    shorter than twice the gap.
    """
    gaps = written(placed.groupBy("source").agg(
        F.first("target").alias("target"), (F.first("target") - F.coalesce(F.max("last"), F.lit(0))).alias("gap"))
        .withColumnRenamed("source", "_mix_s"), "mix-gaps")
    same = F.col("source").eqNullSafe(F.col("_mix_s"))
    near = F.col("size") < 2 * F.col("gap")
    # Documents of twice the gap or more never bring a source nearer to its target, as gaps only shrink.
    rest = written(placed.where((F.col("times") < cap) & (F.col("size") > 0)).join(gaps, same).where(near)
                   .select("source", "bucket", "start", "hash", "size", "times"), "mix-rest")
    fills = []
    while True:
        small = F.col("size") <= F.col("gap") / 2
        miss = F.abs(F.col("gap") - F.col("size"))
        steps = (rest.join(gaps, same).groupBy("_mix_s", "target", "gap").agg(
            F.min("size").alias("least"), F.max(small).alias("small"),
            F.min(F.struct(miss.alias("miss"), "hash", "start", "size")).alias("one")))
        steps = written(steps.select("_mix_s", "target", "gap", "one", (
            ~F.col("small") | (F.col("one.miss") <= F.col("least") / 2)).alias("single")), "mix-steps")
        if steps.isEmpty():
            break
        single = steps.where("single").select(
            F.col("_mix_s").alias("source"), F.col("one.start").alias("start"), F.col("one.size").alias("end"),
            F.greatest(F.col("target") - F.col("one.size") / 2, F.lit(0.0)).alias("middle"))
        taken = [written(single, "mix-fill")]
        if not steps.where(~F.col("single")).isEmpty():
            runs = (rest.join(steps.where(~F.col("single")), same).where(small)
                    .withColumn("lap", F.explode(F.sequence("times", F.lit(cap - 1)))))
            sums = runs.groupBy("_mix_s", "gap", "lap", "bucket").agg(F.sum("size").alias("n"))
            before = F.sum("n").over(Window.partitionBy("_mix_s").orderBy("lap", "bucket")) - F.col("n")
            sums = written(sums.select(F.col("_mix_s").alias("_mix_r"), "gap", F.col("lap").alias("_mix_l"),
                                       F.col("bucket").alias("_mix_b"), before.alias("before"))
                           .where(F.col("before") < F.col("gap")).drop("gap"), "mix-sums")
            order = Window.partitionBy("source", "lap", "bucket").orderBy("start")
            ends = (runs.join(sums, F.col("source").eqNullSafe(F.col("_mix_r")) & (F.col("lap") == F.col("_mix_l"))
                              & (F.col("bucket") == F.col("_mix_b")))
                    .withColumn("end", F.col("before") + F.sum("size").over(order)).where(F.col("end") <= F.col("gap")))
            taken.append(written(ends.select(
                "source", "start", "end",
                (F.col("target") - F.col("gap") + F.col("end") - F.col("size") / 2).alias("middle")), "mix-fill"))
            discard(sums)
        fills += taken
        new = reduce(DataFrame.unionByName, taken)
        ends = new.groupBy(F.col("source").alias("_mix_e")).agg(F.max("end").alias("end"))
        left = written(gaps.join(ends, F.col("_mix_s").eqNullSafe(F.col("_mix_e")))
                       .select("_mix_s", "target", (F.col("gap") - F.col("end")).alias("gap")), "mix-gaps")
        used = new.groupBy(F.col("source").alias("_mix_u"), F.col("start").alias("_mix_us")).agg(F.count("*").alias("n"))
        times = (F.col("times") + F.coalesce("n", F.lit(0))).cast("int")
        fewer = written(rest.join(left, same).where(near)
                        .join(used, F.col("source").eqNullSafe(F.col("_mix_u")) & (F.col("start") == F.col("_mix_us")), "left")
                        .select("source", "bucket", "start", "hash", "size", times.alias("times"))
                        .where(F.col("times") < cap), "mix-rest")
        discard(gaps, rest, steps)
        gaps, rest = left, fewer
    all_ = reduce(DataFrame.unionByName, fills) if fills else \
        placed.select("source", "start", F.lit(0.0).alias("middle")).where(F.lit(False))
    out = written(all_.groupBy(F.col("source").alias("_mix_f"), F.col("start").alias("_mix_fs"))
                  .agg(F.sort_array(F.collect_list("middle")).alias("_mix_fills")), "mix-fills")
    discard(gaps, rest, steps, *fills)
    return out


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP,
        times: Sequence[float] = TIMES, shapes: Sequence[Sequence[float]] = SHAPES) -> DataFrame:
    """``docs`` with _mix_size, _mix_source_size, _mix_target and _mix_positions:
    the training position of each time the document is taken (none: left out)."""
    spark = docs.sparkSession
    bits = max(4, math.ceil(math.log2(8 * partitions(spark))))
    hashed = F.xxhash64("doc_id", "source", "text")
    marked = docs.select("*", word_count(F.col("text")).alias("_mix_size"), hashed.alias("_mix_hash"))
    marked = marked.withColumn("_mix_bucket", F.shiftrightunsigned("_mix_hash", 64 - bits))
    sized = written(marked.select("doc_id", "source", "_mix_size", "_mix_hash", "_mix_bucket"), "mix-sized")

    totals = written(sized.groupBy("source", "_mix_bucket").agg(F.sum("_mix_size").alias("n")), "mix-totals")
    targets = source_targets(totals.groupBy("source").agg(F.sum("n").alias("source_size")), weights, cap)
    running = F.sum("n").over(Window.partitionBy("source").orderBy("_mix_bucket")) - F.col("n")
    starts = totals.select("source", F.col("_mix_bucket").alias("_mix_b"), running.alias("_mix_before"))
    starts = written(
        starts.join(targets.select(F.col("source").alias("_mix_s"), "source_size", "cycle", "target"),
                    F.col("source").eqNullSafe(F.col("_mix_s")))
        .select(F.col("source").alias("_mix_s"), "_mix_b", "_mix_before", F.col("source_size").alias("_mix_source_size"),
                F.col("cycle").alias("_mix_cycle"), F.col("target").alias("_mix_target")), "mix-starts")

    placed = written(_placed(sized, starts).select(
        "source", F.col("_mix_bucket").alias("bucket"), F.col("_mix_start").alias("start"),
        F.col("_mix_hash").alias("hash"), F.col("_mix_size").alias("size"), F.col("_mix_target").alias("target"),
        F.size(_whole(cap)).alias("times"), F.array_max(_whole(cap)).alias("last")), "mix-placed")
    fills = _refill(placed, cap)
    discard(sized, totals, placed)

    # A document of words is told from others of its source by its place on the line.
    final = _placed(marked, starts).join(
        fills, F.col("source").eqNullSafe(F.col("_mix_f")) & (F.col("_mix_start") == F.col("_mix_fs"))
        & (F.col("_mix_size") > 0), "left")
    middles = F.transform(_whole(cap), lambda end: end - F.col("_mix_size") / 2)
    taken = F.concat(middles, F.coalesce("_mix_fills", F.array().cast("array<double>")))
    positions = F.transform(taken, lambda m: position(m / F.col("_mix_target"), F.col("_mix_cycle"), times, shapes))
    return final.withColumn("_mix_positions", positions).drop(
        "_mix_hash", "_mix_bucket", "_mix_s", "_mix_b", "_mix_before", "_mix_cycle", "_mix_start", "_mix_f", "_mix_fs", "_mix_fills")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per time a document is taken, range-sorted by training position."""
    return (mixed.select("*", F.explode("_mix_positions").alias("_mix_position"))
            .orderBy("_mix_position", "doc_id")
            .drop("_mix_size", "_mix_source_size", "_mix_target", "_mix_positions"))
