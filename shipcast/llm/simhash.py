"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by one space (repeats count; a shorter text is one
shingle, a text without words has fingerprint zero).  Bit i is 1 if it is set
in over half of the shingles' XXH64 (UTF-8, seed 42).

Search: every position of the fingerprint draws a vector of ``radius + 1``
bits; mask v keeps
the positions whose vector has an odd product with v.  For any ``radius`` positions
some v != 0 has an even product with all their vectors, so two fingerprints that
differ in at most ``radius`` bits agree under one of the
``2^(radius+1) - 1`` masks: no pair within the radius is missed.  Equal
fingerprints are one class, classes that agree under a mask are compared by
exact bit distance (in blocks where many agree), and links are joined to
components.

Null text is an empty text.  Rows are judged one by one, so repeated rows get
the same fingerprint and component; a null ``doc_id`` never names a component
unless all its members are null.  An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import components, group_links, written

SEED = 42
#: Shingles hashed at a time: bounds the memory that one very long text takes.
CHUNK = 1 << 16


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = np.concatenate([[0], ends[:len(words) - shingle]]).tolist()
    last = (ends[shingle - 1:] - 1).tolist()
    digest, n, ones = xxhash.xxh64_intdigest, len(first), np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        h = np.fromiter((digest(line[s:e], SEED) for s, e in zip(first[k:k + CHUNK], last[k:k + CHUNK])),
                        "<u8", min(CHUNK, n - k))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint's 64 bits as a long."""
    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            fp = np.array([text_fingerprint(t.as_py(), shingle) for t in rb.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(2), pa.array(fp.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash()).mapInArrow(
        score, "doc_id long, text_hash long, fp long")


def text_hash():
    return F.xxhash64(F.col("text").cast("string")).alias("text_hash")


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The masks, as signed 64-bit integers."""
    rng = random.Random(seed)
    vectors = [rng.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    masks = [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
             for v in range(1, 1 << (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def grouped(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (a fingerprint that names its
    component), component_id (the smallest doc_id reachable by links)."""
    prints = written(fingerprints(docs, shingle), "simhash-fp")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    masks = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(m).alias("mask"))
                      for v, m in enumerate(covering_masks(radius))])
    rows = (classes.select("fp", F.explode(masks).alias("m"))
            .select(F.xxhash64("m.v", F.col("fp").bitwiseAND(F.col("m.mask"))).alias("g"), F.col("fp").alias("id"),
                    F.unhex(F.lpad(F.hex("fp"), 16, "0")).alias("payload")))

    def match(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.bitwise_count(p[:, 0][:, None] ^ q[:, 0][None, :]) <= radius

    links = group_links(rows, match, 1, ">u8", "simhash")
    roots = components(links, "simhash")
    joined = classes.join(roots, classes.fp == roots.id, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = written(joined.join(smallest, "root").select("fp", "root", "component_id"), "simhash-members")
    return prints.join(members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: doc_id, fp, component_id."""
    return grouped(docs, shingle, radius).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id (null
    last), and of rows that repeat it the one with the smallest text hash.

    Rows are told apart by doc_id and text, so rows that share a doc_id but not a
    component each keep one row of theirs; of equal rows any one stays.
    """
    lacks, text_id = F.col("doc_id").isNull().cast("int"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    first = grouped(docs.select("doc_id", "text"), shingle, radius).groupBy("root").agg(
        F.min(F.struct(lacks.alias("lacks"), F.col("doc_id"), F.col("text_hash"))).alias("row"))
    kept = first.select(F.col("row.lacks").alias("_sh_null"),
                        F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias("_sh_id"),
                        F.col("row.text_hash").alias("_sh_text"))
    keys = ["_sh_null", "_sh_id", "_sh_text"]
    rows = docs.withColumns({"_sh_null": lacks, "_sh_id": text_id, "_sh_text": text_hash()})
    # Equal rows meet after a partial aggregate: one row each a task.
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).select(docs.columns)
