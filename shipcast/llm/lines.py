"""Line dedup by a deletion-neighbourhood join, in SQL expressions only.

Lines are the text split at line feeds, compared without white space at either
end.  An occurrence (doc_id, line number) is removed if an earlier one holds
the same line, or a line at most one edit away (insert, delete or replace one
code point) when both have at least ``min_chars`` code points.  So the earliest
stays; occurrences are judged on the input, not on what is left.  Lines of
white space only stay.

1. Equal lines are grouped by a 128-bit hash with their first occurrence.
2. Two lines one edit apart share the first or the last half of the longer.
   Lines that share no half with another line have no neighbour and need no
   variants; this loses none.
3. The others emit one hashed key for each deletion of a code point, and keys
   for the whole line.  Lines with the same key for the same deleted place
   differ in one code point there; a whole line that equals another's variant
   lacks one code point of it.  Such a group holds at most one line for every
   character (and place) there is, however frequent its lines are, and each
   member meets only the earliest of it.
4. Proposed pairs are confirmed by ``levenshtein``.

A variant's key is made of its block of ``CHUNK`` code points and of chained
hashes of the blocks before and behind, so a line costs its length times the
block, not its length squared.

Null text stays null.  Null doc_ids come last, and rows that share a doc_id, or
have none, are ordered by a hash of their texts, so that no doc_id gathers the
lines of many rows.  Rows equal in both are one document: all of them keep the
same lines.  An empty table gives an empty result.  Other columns pass
unchanged, whatever their names: internal ones carry the prefix ``_ln``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import discard, written

MIN_CHARS = 20
CHUNK = 64
#: White space dropped at either end of a line.
BLANK = " \t\r\x0b\x0c"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def place() -> Column:
    """Total order of occurrences: doc_id (nulls last), hash of the text, line number."""
    return F.struct(F.col("_ln_id").isNull().alias("late"), F.col("_ln_id").alias("id"), F.col("_ln_tie").alias("tie"),
                    F.col("_ln_no").alias("no"))


def tie(text: Column) -> Column:
    """Tells rows of one doc_id, or of none, apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and last half, for a longer line of this length and of one more."""
    keys = []
    for length in (n, n + 1):
        half = F.floor((length - 1) / 2).cast("int")
        keys += [F.xxhash64(F.lit("first"), length, F.left(line, half)),
                 F.xxhash64(F.lit("last"), length, F.right(line, half))]
    return F.array(*keys)


def chain(blocks: Column) -> Column:
    """[0, h(0, b1), h(h(0, b1), b2), ...]"""
    start = F.struct(F.lit(0).cast("long").alias("h"), F.array(F.lit(0).cast("long")).alias("all"))

    def add(a: Column, b: Column) -> Column:
        h = F.xxhash64(a["h"], b)
        return F.struct(h.alias("h"), F.concat(a["all"], F.array(h)).alias("all"))

    return F.aggregate(blocks, start, add, lambda a: a["all"])


def blocks_of(line: Column, length: Column, shift: int) -> Column:
    """Blocks of ``line`` from offset ``shift``, numbered 0 to floor(length / CHUNK)."""
    return F.transform(F.sequence(F.lit(0), F.floor(length / CHUNK).cast("int")),
                       lambda j: F.substr(line, j * CHUNK + 1 + shift, F.lit(CHUNK)))


def variant_rows(lines: DataFrame) -> DataFrame:
    """(key, gap, whole, id columns): a key for every deletion (gap: its place) and for the whole line."""
    n = F.col("_ln_len")
    cut = (lines.withColumn("_b", blocks_of(F.col("_ln"), n, 0))
           .withColumn("_s", F.when(n > 0, blocks_of(F.col("_ln"), n - 1, 1)))
           .withColumn("_before", chain(F.col("_b")))
           .withColumn("_behind", F.reverse(chain(F.reverse("_b"))))
           .withColumn("_behind_cut", F.reverse(chain(F.reverse("_s"))))
           .select("_h1", "_h2", "_place", "_ln", "_before", "_behind", "_behind_cut", F.posexplode("_b").alias("_j", "_block")))
    key = lambda block, behind: F.xxhash64("_j", F.get("_before", F.col("_j")), block, behind)
    whole = cut.select("_h1", "_h2", "_place", key(F.col("_block"), F.get("_behind", F.col("_j") + 1)).alias("key"),
                       F.lit(None).cast("long").alias("gap"))
    longer = F.concat("_block", F.substr("_ln", F.col("_j") * CHUNK + CHUNK + 1, F.lit(1)))
    gaps = (cut.where(F.length("_block") > 0)
            .select("_h1", "_h2", "_place", "_j", "_before", F.length("_block").alias("_n"), longer.alias("_block"),
                    # behind the last block of the shorter line comes nothing
                    F.coalesce(F.get("_behind_cut", F.col("_j") + 1), F.lit(0).cast("long")).alias("_behind1"))
            .select("*", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_p"))
            .select("_h1", "_h2", "_place",
                    key(F.concat(F.left("_block", F.col("_p") - 1), F.substr("_block", F.col("_p") + 1)),
                        F.col("_behind1")).alias("key"),
                    (F.col("_j") * CHUNK + F.col("_p")).cast("long").alias("gap")))
    return whole.unionByName(gaps)


def first_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The lines that stay: _h1, _h2 (hash of the line), _place (its first occurrence), written."""
    texts = docs.select(F.col("doc_id").alias("_ln_id"), tie(F.col("text")).alias("_ln_tie"), F.col("text").alias("_ln_text"))
    line = bare(F.col("_ln"))
    found = (texts.select("_ln_id", "_ln_tie", F.posexplode(split_lines(F.col("_ln_text"))).alias("_ln_no", "_ln"))
             .select("_ln_id", "_ln_tie", "_ln_no", line.alias("_ln")).where("_ln <> ''")
             .select(place().alias("_place"), F.xxhash64("_ln").alias("_h1"),
                     F.xxhash64(F.lit("again"), "_ln").alias("_h2"),
                     F.when(F.length("_ln") >= min_chars, half_keys(F.col("_ln"), F.length("_ln"))).alias("_keys")))
    keys = [F.get("_keys", F.lit(i)).alias(f"_k{i}") for i in range(4)]
    first = written(found.select("_h1", "_h2", "_place", *keys)
                    .groupBy("_h1", "_h2", "_k0", "_k1", "_k2", "_k3").agg(F.min("_place").alias("_place")), "lines-first")

    halves = first.where("_k0 is not null").select("_h1", "_h2", F.explode(F.array("_k0", "_k1", "_k2", "_k3")).alias("k"))
    shared = written(halves.groupBy("k").agg(
        ((F.min("_h1") < F.max("_h1")) | (F.min("_h2") < F.max("_h2"))).alias("several")).where("several").select("k"),
        "lines-shared")
    some = written(halves.join(shared, "k").select("_h1", "_h2").distinct(), "lines-some")

    # Their texts, from the documents of their first occurrences.
    wanted = (first.join(some, ["_h1", "_h2"]).groupBy(F.col("_place.id").alias("_w"), F.col("_place.tie").alias("_w_tie"))
              .agg(F.collect_list(F.struct("_h1", "_h2", "_place")).alias("_want")))
    held = (texts.join(wanted, F.col("_ln_id").eqNullSafe(F.col("_w")) & (F.col("_ln_tie") == F.col("_w_tie")))
            .select(split_lines(F.col("_ln_text")).alias("_lines"), F.explode("_want").alias("w"))
            .select("w._h1", "w._h2", "w._place", bare(F.get("_lines", F.col("w._place.no"))).alias("_ln"))
            .where(F.xxhash64("_ln") == F.col("_h1")).dropDuplicates(["_h1", "_h2"])
            .withColumn("_ln_len", F.length("_ln")))
    held = written(held, "lines-held")

    # In a key's group, every member meets the earliest of its kind.
    me = F.struct("_place", "_h1", "_h2")
    same_gap = F.when(F.col("gap").isNotNull(), F.min(me).over(Window.partitionBy("key", "gap")))
    of_key = Window.partitionBy("key")
    other = F.when(F.col("gap").isNull(), F.min(F.when(F.col("gap").isNotNull(), me)).over(of_key)).otherwise(
        F.min(F.when(F.col("gap").isNull(), me)).over(of_key))
    # Dealt by key alone, rows serve both windows.
    pairs = (variant_rows(held).repartition("key").withColumn("_same", same_gap).withColumn("_other", other)
             .select("_h1", "_h2", "_place", F.explode(F.array("_same", "_other")).alias("e"))
             .where(F.col("e._place") < F.col("_place"))
             .select("_h1", "_h2", F.col("e._h1").alias("_e1"), F.col("e._h2").alias("_e2")).distinct())
    early = held.select(F.col("_h1").alias("_e1"), F.col("_h2").alias("_e2"), F.col("_ln").alias("_early"))
    late = (pairs.join(held.select("_h1", "_h2", "_ln"), ["_h1", "_h2"]).join(early, ["_e1", "_e2"])
            .where(F.levenshtein("_ln", "_early", 1) >= 0).select("_h1", "_h2").distinct())
    late = written(late, "lines-late")
    kept = written(first.select("_h1", "_h2", "_place").join(late, ["_h1", "_h2"], "left_anti"), "lines-kept")
    discard(first, shared, some, held, late)
    return kept


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the removed lines left out of text, and with _ln_total and
    _ln_removed, the numbers of its lines and of those removed."""
    kept = (first_lines(docs, min_chars).groupBy(F.col("_place.id").alias("_ln_id"), F.col("_place.tie").alias("_ln_tie"))
            .agg(F.collect_list(F.struct(F.col("_place.no").alias("no"), F.col("_h1").alias("h"))).alias("_ln_kept")))
    joined = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_ln_id")) & (tie(F.col("text")) == F.col("_ln_tie")), "left")
    joined = joined.withColumn("_ln_lines", split_lines(F.col("text")))
    line = lambda i: F.get("_ln_lines", i)
    blanks = F.filter(F.sequence(F.lit(0), F.size("_ln_lines") - 1), lambda i: bare(line(i)) == "")
    own = F.transform(F.filter("_ln_kept", lambda k: F.xxhash64(bare(line(k["no"]))) == k["h"]), lambda k: k["no"])
    stay = F.array_sort(F.concat(F.coalesce(own, F.array().cast("array<int>")), blanks))
    out = (joined.withColumn("_ln_stay", stay)
           .withColumn("_ln_total", F.size("_ln_lines").cast("long"))
           .withColumn("_ln_removed", (F.size("_ln_lines") - F.size("_ln_stay")).cast("long"))
           .withColumn("text", F.when(F.col("text").isNotNull(),
                                      F.array_join(F.transform("_ln_stay", line), "\n"))))
    return out.select(*docs.columns, "_ln_total", "_ln_removed")
