"""Sharding by sampled splitters, with DataFrame operations only.

Records have a key (the text's hash, then the record's), so equal texts lie
together.  A bottom-k sample weighted by size (priority: an exponential variate,
drawn by hash, over the size) estimates the bytes along the key; its quantiles
are the splitters of some dozens of ranges per shard.  Every record finds its
range by binary search in the splitters, exact sums follow, and ranges that turn
out overfull are sampled and split again: at texts as long as a range holds
several, inside a text only if its copies outweigh a whole shard.  Ranges then
go, largest first, to the shard with the least bytes, and a record's slot is its
rank in its shard (range-partitioned sort, counts per partition).

The driver holds the sample, the splitters and a row per range; their numbers
follow from the parameters alone.  Texts are read once and never shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import written
from shipcast.operators.split import rank_rows

#: Ranges a shard, and sampled keys a range.
RANGES, SAMPLED = 32, 16
#: A range is overfull beyond this many times the mean.
OVERFULL = 2.0
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _sample(rows: DataFrame, size: int) -> list[tuple[int, int, int, float]]:
    """(range, h, t, weight) of at most ``size`` records, drawn by size; the weights
    estimate the bytes that each stands for, and are exact if all rows are drawn."""
    unit = (F.pmod(F.xxhash64("h", "t", F.lit(11)), F.lit(1 << 52)) + 1) / float(1 << 52)
    drawn = (rows.select("range", "h", "t", "size", (-F.log(unit) / F.col("size")).alias("at"))
             .orderBy("at", "h", "t").limit(size + 1).collect())
    if len(drawn) <= size:
        return [(r["range"], r["h"], r["t"], float(r["size"])) for r in drawn]
    bar = max(drawn[-1]["at"], 1e-300)
    return [(r["range"], r["h"], r["t"], r["size"] / max(-math.expm1(-r["size"] * bar), 1e-300)) for r in drawn[:-1]]


def _cuts(weights: list[tuple[int, int, float]], quota: float, whole: bool) -> list[tuple[int, int]]:
    """(h, t) splitters that leave about ``quota`` between them; with ``whole`` they stand
    between texts, and a text of more than the quota has a range of its own."""
    along = defaultdict(float)
    for h, t, w in weights:
        along[h, LEAST if whole else t] += w
    cuts, held = [], 0.0
    for (h, t), w in sorted(along.items()):
        if held and held + w > quota:
            cuts.append((h, t))
            held = 0.0
        held += w
        if whole and w > quota and h < MOST:
            cuts += [(h, LEAST), (h + 1, LEAST)]
            held = 0.0
    return cuts


def _table(values: list[int], kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _range_of(cuts: list[tuple[int, int]]) -> Column:
    """How many splitters are at most the record's key, by binary search."""
    if not cuts:
        return F.lit(0)
    first, second = _table([h for h, _ in cuts], "long"), _table([t for _, t in cuts], "long")
    steps = _table([1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)], "int")

    def passed(i):
        a, b = F.get(first, i), F.get(second, i)
        return (a < F.col("h")) | ((a == F.col("h")) & (b <= F.col("t")))

    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        (at + step <= len(cuts)) & passed(at + step - 1), step).otherwise(0))


def _dealt(weights: dict[int, int], shards: int) -> dict[int, int]:
    """Range -> shard: the largest range first, to the shard with the least so far."""
    heap, out = [(0, k) for k in range(shards)], {}
    for r, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        held, k = heapq.heappop(heap)
        out[r] = k
        heapq.heappush(heap, (held + w, k))
    return out


def shard(docs: DataFrame, shards: int = 8, ranges: int = RANGES, sampled: int = SAMPLED) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, range, shard, slot.

    Shards hold nearly equal bytes: they differ by no more than about a range (a
    thirty-second of a shard) unless one document is larger.  Equal texts share
    a shard unless they are more than a shard's bytes together; then they are
    split at documents.  A null text counts as empty.  Null and repeated doc_ids
    and repeated rows are records like others; of equal rows any may take either
    place.  An empty table gives no rows; other columns play no part.
    """
    text = F.coalesce("text", F.lit(""))
    # The low bits of t tell repeated rows apart, so that even these can be split.
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFF))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1).cast("long")).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.xxhash64("doc_id").bitwiseAND(F.lit(~0xFFFF)).bitwiseOR(place).alias("t")), "sharding-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    target, quota = total / shards, total / (shards * ranges)
    size = shards * ranges * sampled
    cuts = sorted(set(_cuts([x[1:] for x in _sample(rows.withColumn("range", F.lit(0)), size)], quota, True)))
    while True:
        ranged = rows.withColumn("range", _range_of(cuts))
        sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.min("h").alias("h0"), F.max("h").alias("h1"),
                                           F.min("t").alias("t0"), F.max("t").alias("t1")).collect()
        full = {r["range"]: r["h0"] < r["h1"] for r in sums if r["bytes"] > OVERFULL * quota and (
            r["h0"] < r["h1"] or r["bytes"] > target and r["t0"] < r["t1"])}
        found = defaultdict(list)
        for r, *key in _sample(ranged.where(F.col("range").isin(list(full))), size) if full else []:
            found[r].append(key)
        more = {c for r, weights in found.items() for c in _cuts(weights, quota, full[r])} - set(cuts)
        if not more:
            break
        cuts = sorted({*cuts, *more})
    of = _dealt({r["range"]: r["bytes"] for r in sums}, shards)
    table = _table([of.get(k, 0) for k in range(len(cuts) + 1)], "int")
    placed = ranged.withColumn("shard", F.get(table, F.col("range")))
    # The range-partitioned sort that numbers the slots.
    return (rank_rows(placed, ["range", "h", "t"], by=["shard"], rank_col="slot")
            .select("doc_id", "size", "text_crc32", "range", "shard", "slot"))
