"""Merkle dataset manifest by sibling-shift self-joins.

Every row is a leaf.  Within a group the leaves stand in order and are numbered
from 0; a level's nodes lie in runs of ``arity`` consecutive ones, and a run's
digest is its parent.  A level is one table (group, index, level's size,
digest) that joins itself on computed sibling indices: ``index XOR 1`` for
binary trees, the slot offsets 1 to arity - 1 within the run otherwise.  So
every node knows what stands before and after it in its run, and the rows in
slot zero emit the parents.  The groups' roots, in order of the groups, make one
more tree by the same code.  Proofs come down again by equijoins of a level
with its parents' proofs.

All joins are on (group, index): a group that holds most of the rows is spread
like any other.  A table of n leaves moves about 2 n narrow rows up and n proofs
of log(n) digests down.  Every level is a written table, so a lost executor
costs only tasks.  The driver holds one root and one group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import written
from shipcast.operators.split import rank_rows

#: One step of a proof: the run's digests to the left and to the right, each joined.
STEP = "struct<before:string,after:string>"


def framed(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda at, step: digest(step["before"], at, step["after"]))


def proof_text(proof: Column) -> Column:
    """All sibling digests of a proof, joined from the leaf's run to the root's."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _div(value, by: int) -> Column:
    return F.call_function("div", F.col(value) if isinstance(value, str) else value, F.lit(by))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``before`` and ``after``: the digests beside each node in its run."""
    slot, out = F.col("idx") % arity, nodes
    for k in range(1, arity):
        near = (F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2
                else F.col("idx") - slot + (slot + k) % arity)
        other = nodes.select("g", F.col("idx").alias("near"), F.col("digest").alias(f"s{k}"))
        out = out.withColumn("near", near).join(other, ["g", "near"], "left").drop("near")
    # Offset k leads to a slot on the left if it wraps round the run's end.
    side = {name: F.concat(F.lit(""), *[F.when(cond(k), F.coalesce(f"s{k}", F.lit(""))).otherwise("")
                                        for k in range(1, arity)])
            for name, cond in (("before", lambda k: slot >= arity - k), ("after", lambda k: slot < arity - k))}
    return out.withColumns(side).drop(*[f"s{k}" for k in range(1, arity)])


def _climb(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the leaves up, with siblings; the groups' roots with their height).

    ``nodes``: g, idx (from 0 in each group), n (nodes of the group), digest, and
    at the leaves any further columns."""
    spark, levels, roots = nodes.sparkSession, [], None
    left = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        done = nodes.where("n = 1").select("g", "digest", F.lit(len(levels)).alias("height"))
        roots = done if roots is None else roots.unionByName(done)
        if left <= 1:
            return levels, roots
        levels.append(written(_with_siblings(nodes.where("n > 1"), arity), f"{name}-{len(levels)}"))
        left = -(-left // arity)
        nodes = levels[-1].where(F.col("idx") % arity == 0).select(
            "g", _div("idx", arity).alias("idx"), _div(F.col("n") + (arity - 1), arity).alias("n"),
            digest(F.col("digest"), F.col("after")).alias("digest"))


def _descend(levels: list[DataFrame], tops: DataFrame, arity: int, name: str, carry: Sequence[str]) -> DataFrame:
    """(the leaves' columns, carry..., proof): each leaf's proof up to its group's
    root, followed by the ``proof`` that ``tops`` (g, height, carry..., proof) has for the group."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        ends = tops.where(F.col("height") == k + 1).select("g", F.lit(0).cast("long").alias("up"), *carry, "proof")
        up = ends if above is None else ends.unionByName(above.select("g", F.col("idx").alias("up"), *carry, "proof"))
        step = F.struct("before", "after")
        above = (levels[k].withColumn("up", _div("idx", arity)).join(up, ["g", "up"])
                 .withColumn("proof", F.concat(F.array(step), "proof")).drop("up", "before", "after"))
        if k:
            above = written(above, f"{name}-proofs-{k}")
    return above


def manifest(leaves: DataFrame, group: str, order: str, arity: int = 2) -> DataFrame:
    """``leaves`` (with a column ``leaf``: digest) plus ``subroot``, ``root`` and ``proof``.

    A group's leaves ascend by ``order`` (nulls first, ties by digest, so equal
    rows are interchangeable); groups ascend bytewise, null first.  ``proof``
    lists, from the leaf's run up to the root's, what stands before and after the
    node: ``folded(leaf, proof)`` gives ``root``.  A lone node goes up unchanged
    where its group has no other; a last run of one is hashed alone.  An empty
    table gives no rows.  Repeated rows each have their own leaf and proof.  Any
    other columns pass through, but for the working names ``g idx n digest near
    before after up height proof subroot root``, which are the caller's to avoid.
    """
    if arity < 2:
        raise ValueError("a run needs at least two nodes")
    spark = leaves.sparkSession
    # A string that sorts null first and is never null, so that it can be a join key.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    base = written(leaves.withColumn("g", key), "merkle-rows")
    placed = rank_rows(base, [order, "leaf"], by=["g"], rank_col="idx", size_col="n").withColumnRenamed("leaf", "digest")
    levels, roots = _climb(placed, arity, "merkle")
    subroots = written(roots.withColumnRenamed("digest", "subroot"), "merkle-subroots")
    ranked = (rank_rows(subroots, ["g"], rank_col="idx", size_col="n")
              .select(F.lit("").alias("g"), F.col("g").alias("of"), "idx", "n", F.col("subroot").alias("digest"),
                      "subroot", F.col("height").alias("tree")))
    over, top = _climb(ranked, arity, "merkle-top")
    root = top.first()
    end = spark.range(1).select(F.lit("").alias("g"), F.lit(len(over)).alias("height"),
                                F.array().cast(f"array<{STEP}>").alias("proof"))
    if over:
        tops = _descend(over, end, arity, "merkle-top", [])
    else:  # one group, or none
        tops = ranked.withColumn("proof", F.array().cast(f"array<{STEP}>"))
    tops = written(tops.select(F.col("of").alias("g"), F.col("tree").alias("height"), "subroot", "proof"), "merkle-tops")
    alone = placed.where("n = 1").join(tops.select("g", "subroot", "proof"), "g")
    out = alone
    if levels:
        out = alone.unionByName(_descend(levels, tops, arity, "merkle", ["subroot"]).select(alone.columns))
    return (out.withColumnRenamed("digest", "leaf").drop("g", "idx", "n")
            .withColumn("root", F.lit(root["digest"] if root else None).cast("string")))


#: What a document's leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def documents_manifest(docs: DataFrame, changed: Column, arity: int = 2) -> DataFrame:
    """Manifest of ``documents`` by language, and the verification of rows of
    which those that are ``changed`` (a condition) have one more in ``n_chars``.

    Nulls are framed as ``-`` and stay as they are; every row, with whatever
    nulls, ties or repeats, is one leaf; other columns play no part."""
    def leaf(n_chars):
        return digest(*[framed(n_chars if c == "n_chars" else F.col(c)) for c in FIELDS])

    more = F.col("n_chars").cast("decimal(20,0)") + 1
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"),
                       F.when(changed & F.col("n_chars").isNotNull(), leaf(more)).alias("seen"))
    made = manifest(rows, "lang", "doc_id", arity)
    return (made.withColumn("folded_root", folded(F.coalesce("seen", "leaf"), F.col("proof")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
