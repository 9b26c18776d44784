"""Document fingerprints: quartile bucket digests of byte triplets.

Every place of the UTF-8 text gives triplets of its next bytes (places 0, 1, 2
and 0, 1, 3), each hashed to one of ``BUCKETS`` buckets.  A bucket's count is
written as its quartile among the counts (two bits), behind one byte for the
logarithm of the length and one for the ratios of the quartiles.  Two digests
differ by the sum of bounded differences of their parts; likeness is 1 less
that sum's share of its largest value, so it lies between 0 and 1 and is 1 for
equal digests.

Null text is an empty text (all counts zero).  Equal texts have equal digests;
repeated rows are digested each; an empty table gives an empty result.  Only
doc_id and text are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import partitions, written

BUCKETS = 256
#: Bytes counted at a time: bounds the memory of a very long text.
CHUNK = 1 << 20
TRIPLETS = ((0, 1, 2), (0, 1, 3))
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Largest differences of one bucket, of the length byte and of one ratio.
FAR_BUCKET, FAR_LENGTH, FAR_RATIO = 4, 64, 16
LARGEST = BUCKETS * FAR_BUCKET + FAR_LENGTH + 2 * FAR_RATIO


def digest(text: str | None) -> str:
    """Fingerprint as lowercase hex: length byte, ratio byte, two bits a bucket."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    reach = max(max(t) for t in TRIPLETS)
    for begin in range(0, len(data), CHUNK):
        part = data[begin:begin + CHUNK + reach].astype(np.uint32)
        for k, offsets in enumerate(TRIPLETS):
            n = min(CHUNK, len(part) - max(offsets))
            if n > 0:
                h = np.full(n, k * 0x27D4EB2F, np.uint32)
                for at, m in zip(offsets, MULTIPLIERS):
                    h += part[at:at + n] * np.uint32(m)
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                counts += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, round(8 * math.log2(1 + len(data))))
    ratios = (int(q1 * 15 // q3) << 4 | int(q2 * 15 // q3)) if q3 else 0
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return bytes([length, ratios]).hex() + packed.astype(np.uint8).tobytes().hex()


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness, 0 to 1, of each pair of digests."""
    if not a:
        return np.zeros(0)
    x, y = (np.frombuffer(bytes.fromhex("".join(s)), np.uint8).reshape(len(s), -1).astype(np.int16) for s in (a, b))
    total = np.minimum(np.abs(x[:, 0] - y[:, 0]), FAR_LENGTH).astype(np.int64)
    for shift in (0, 4):
        total += np.abs((x[:, 1] >> shift & 15) - (y[:, 1] >> shift & 15))
    for shift in (0, 2, 4, 6):
        step = np.abs((x[:, 2:] >> shift & 3) - (y[:, 2:] >> shift & 3))
        total += (step + (step == 3)).sum(1)  # opposite ends count one more
    return 1 - total / LARGEST


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint); null texts are empty."""
    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            prints = [digest(t.as_py()) for t in rb.column(1)]
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(prints, pa.string())],
                                             ["doc_id", "text", "fingerprint"])

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(score, "doc_id long, text string, fingerprint string")


def with_next(prints: DataFrame, ids: DataFrame) -> DataFrame:
    """``prints`` with next_text and next_fingerprint: those of the next row by
    descending doc_id (nulls last, ties by text hash), the first after the last.

    Rows are dealt to ranges of doc_id; where one doc_id fills whole ranges, and
    where it is null, the rows are dealt on by their text hash, to as many parts
    as ranges would hold them.  The head of each range is also dealt to the
    range before it, so one shuffle brings every row to its next.  The ranges'
    bounds and heads, at most some four for each of ``n``, are all that every
    task sees.  (Of doc_ids beyond 2^53, which ranges tell apart to the nearest
    double only, none is dealt on.)
    """
    n = 4 * partitions(prints.sparkSession)
    ids = ids.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seen = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("b"),
                   F.count("*").alias("rows"), F.count("doc_id").alias("known")).first()
    splits = [-math.inf, *sorted({float(b) for b in seen["b"] or [0]}), math.inf]
    #: Parts for each doc_id that fills ranges (bounds that it repeats) and for null.
    parts = {b: k + 1 for b, k in Counter(seen["b"] or []).items() if k > 1 and abs(b) < 1 << 53}
    lacking = max(1, math.ceil(n * (seen["rows"] - seen["known"]) / max(seen["rows"], 1)))
    tie = F.xxhash64("text")

    def part(of: Column) -> Column:
        """Parts 1 to ``of`` of the text hashes, in their order."""
        return F.least(F.floor((tie.cast("double") / 2.0 ** 64 + 0.5) * of).cast("int"), of - 1) + 1

    def ranged(df: DataFrame) -> DataFrame:
        known = df.withColumn("_x", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
        sub = F.when(F.col("doc_id").isNull(), part(F.lit(lacking)))
        if parts:
            table = F.create_map([F.lit(v) for pair in parts.items() for v in pair])
            sub = sub.when(table[F.col("doc_id")].isNotNull(), part(table[F.col("doc_id")]))
        # A bound opens its range, so larger doc_ids of the range (part 0) come before it.
        return (Bucketizer(splits=splits, inputCol="_x", outputCol="_range").transform(known)
                .withColumn("_range", F.struct(
                    F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("_range").cast("int")).alias("range"),
                    (-sub.otherwise(F.lit(0))).alias("part")))
                .drop("_x"))

    place = F.struct(F.col("doc_id").isNull().alias("late"), (-F.col("doc_id")).alias("down"), tie.alias("tie"))
    order = Window.orderBy(F.col("_range").desc())  # one row per range
    heads = ranged(ids).groupBy("_range").agg(F.min(place).alias("_head"))
    heads = written(heads.select("_range", "_head", F.coalesce(
        F.lag("_range").over(order), F.min("_range").over(Window.partitionBy(F.lit(0)))).alias("_back")), "digest-heads")
    own, back = (F.struct(F.col(c).alias("r"), F.lit(g).alias("ghost")) for c, g in (("_range", False), ("_back", True)))
    is_head = place.eqNullSafe(F.col("_head"))
    dealt = (ranged(prints).join(F.broadcast(heads), "_range")
             .withColumn("_at", F.explode(F.when(is_head, F.array(own, back)).otherwise(F.array(own)))))
    dealt = dealt.select("doc_id", "text", "fingerprint", F.col("_at.r").alias("_r"), F.col("_at.ghost").alias("_ghost"),
                         tie.alias("_tie"))
    by = Window.partitionBy("_r").orderBy("_ghost", F.col("doc_id").desc_nulls_last(), "_tie")
    # One window over plain columns, so that the texts are shuffled once.
    return (dealt.select("doc_id", "text", "fingerprint", "_ghost", F.lead("text").over(by).alias("next_text"),
                         F.lead("fingerprint").over(by).alias("next_fingerprint"))
            .where(~F.col("_ghost")).drop("_ghost"))


def edited(docs: DataFrame) -> DataFrame:
    """The digest of every text and of its edited form: the last third of its
    code points replaced by the first as many of the next document."""
    rows = with_next(fingerprints(docs), docs)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    changed = F.concat(F.left("text", n - third), F.left("next_text", third))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), changed.alias("edited"), "fingerprint",
                       "next_fingerprint").withColumn("edited_sha256", F.sha2("edited", 256))

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            now, after = rb.column("fingerprint").to_pylist(), rb.column("next_fingerprint").to_pylist()
            new = [digest(t.as_py()) for t in rb.column("edited")]
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), rb.column("n_chars"), rb.column("edited_sha256"), rb.column("fingerprint"),
                 pa.array(new, pa.string()), pa.array(likeness(now, new)), pa.array(likeness(now, after))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
