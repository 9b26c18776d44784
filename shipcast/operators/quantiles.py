"""Exact quantiles (linear interpolation, as pandas ``quantile`` / SQL
``percentile_cont``), global or per group.

Columns are stacked into (column, group, x) rows.  A mergeable sketch of every
group, one aggregate with map-side combining, gives two values that bracket each
wanted rank.  A second pass counts the rows below a bracket and the rows of each
value inside it, again with map-side combining, so neither a hot group nor a
repeated value moves as rows.  Only the distinct values inside the brackets, some
percent of large groups, are then range-partitioned by (column, group, x) and
numbered by prefix sums: rows of the group in earlier partitions, then in the
partition that holds the rank.  No task holds a whole large group.  A bracket that misses its rank,
which a sketch may do by chance, is replaced by an open one, so results are exact.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: ``tables``: what ``stable`` has written in a thread within ``stable_alone``.
_NOTED = threading.local()


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: numbered once, read
    by any number of consumers, pruned by column, and of a size that the
    planner knows."""
    from shipcast.session import scratch_path
    path = scratch_path(df.sparkSession, "stable")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    if (noted := getattr(_NOTED, "tables", None)) is not None:
        noted.append(out)
    return out


def stable_alone(make) -> DataFrame:
    """``stable(make())``, after which the tables that ``make`` wrote on the way in this thread are deleted."""
    outer, _NOTED.tables = getattr(_NOTED, "tables", None), []
    try:
        out = stable(make())
        for table in _NOTED.tables[:-1]:
            drop_stable(table)
    finally:
        _NOTED.tables = outer
    if outer is not None:
        outer.append(out)
    return out


def drop_stable(df: DataFrame) -> None:
    """Delete the files of a ``stable`` table that no later result reads."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Size of a group's sketch: groups of no more values are held whole.
SKETCH = 2000
#: Part of a group's ranks on either side of the wanted one that a bracket takes in:
#: three times the error that a sketch of this size exceeds in one case of a hundred.
REACH = 3 * 2.296 / SKETCH ** 0.9723
#: Groups with fewer values keep all of them; up to SKETCH three ranks of a hundred are enough.
HELD = 100


def _by_rank(df: DataFrame, cols, probs, by, with_global: bool = False) -> DataFrame:
    base = df.select(*by, *cols)
    keycond = None
    for b in by:
        c = F.col(b).isNotNull()
        keycond = c if keycond is None else keycond & c
    if with_global:
        # Each value counts twice in the same pass: within its group
        # (_lvl 0) and within the whole column (_lvl 1, group keys NULL).
        lvl = F.explode(F.array(F.lit(0), F.lit(1))).alias("_lvl")
        base = base.select("*", lvl)
        if keycond is not None:
            base = base.where((F.col("_lvl") == 1) | keycond)
        base = base.select(*[F.when(F.col("_lvl") == 0, F.col(b)).alias(b) for b in by],
                           *cols, "_lvl")
        gk = ["_lvl", *by, "column"]
        lead = ["_lvl", *by]
    else:
        if keycond is not None:
            base = base.where(keycond)
        gk = [*by, "column"]
        lead = [*by]
    if len(cols) == 1:
        long = base.select(*lead, F.lit(cols[0]).alias("column"),
                           F.col(cols[0]).cast("double").alias("x"))
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                          for c in cols])
        long = base.select(*lead, F.inline(pairs))
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x"))

    out = _rank_long(long, gk, probs)
    return out.select(*(["_lvl"] if with_global else []), *by, "column", "p", "value")


def _same(left: DataFrame, right: DataFrame, keys: list):
    """Join condition: equal keys, NULL equal to NULL."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def _rank_long(long: DataFrame, gk: list, probs) -> DataFrame:
    """Quantiles of ``x`` per ``gk`` from a stacked table with columns
    gk..., x: rows (gk..., p, value)."""
    groups = long.groupBy(*gk).agg(F.count("x").alias("_n"), F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("_s"))
    n = F.col("_n")

    def end(p: float, way: int):
        """Value of the sketch behind (-1) or beyond (1) the wanted rank."""
        def at(reach):
            return F.kll_sketch_get_quantile_double("_s", F.lit(min(1.0, max(0.0, p + way * reach))))

        return F.when(n > SKETCH, at(REACH)).when(n >= HELD, at(3 / HELD)).otherwise(F.lit(way * math.inf))

    each = F.array(*[F.struct(F.lit(p).alias("p"), end(p, -1).alias("_from"), end(p, 1).alias("_to"))
                     for p in dict.fromkeys(map(float, probs))])
    # Sketches draw at random: their brackets are written, so that all passes see the same.
    brackets = stable(groups.select(*gk, "_n", F.inline(each)))
    found = _inside(long, gk, brackets)
    if found.count() < brackets.count():
        missed = brackets.join(found, _same(brackets, found, [*gk, "p"]), "left_anti")
        opened = stable(missed.withColumns({"_from": F.lit(-math.inf), "_to": F.lit(math.inf)}))
        found = found.unionByName(_inside(long, gk, opened))
    return found


def _inside(long: DataFrame, gk: list, brackets: DataFrame) -> DataFrame:
    """Rows (gk..., p, value) of the brackets (gk..., _n, p, _from, _to) that hold their rank, written."""
    keys = [*gk, "p"]
    x = F.col("x")
    # NULL stands for all values below the bracket; a bracket is one row a group and
    # probability, and the planner broadcasts them if their written size allows.
    counts = (long.join(brackets, _same(long, brackets, gk)).where(x <= F.col("_to"))
              .select(*[brackets[k] for k in keys], "_n", F.when(x >= F.col("_from"), x).alias("x"))
              .groupBy(*keys, "_n", "x").agg(F.count(F.lit(1)).alias("_c")))
    # No fixed number of partitions: AQE sizes them.  Two evaluations could sample
    # different range bounds, so the numbered values are written once.
    ordered = stable(counts.repartitionByRange(*keys, "x").withColumn("_pid", F.spark_partition_id()))

    # One row per (partition, group): how many of the group's rows lie before it and in it.
    parts = ordered.groupBy("_pid", *keys, "_n").agg(F.sum("_c").alias("_cnt"))
    before = F.sum("_cnt").over(Window.partitionBy(*keys).orderBy("_pid")) - F.col("_cnt")
    pos = F.col("p") * (F.col("_n") - 1)
    low, high = F.floor(pos), F.ceil(pos)
    parts = (parts.withColumn("_start", before)
             .where((high >= F.col("_start")) & (low < F.col("_start") + F.col("_cnt")))
             .select("_pid", *keys, "_start"))
    near = ordered.join(parts, _same(ordered, parts, ["_pid", *keys])).select(ordered["*"], "_start")
    upto = F.col("_start") + F.sum("_c").over(
        Window.partitionBy("_pid", *keys).orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_upto", upto)

    def at(rank):
        return F.max(F.when((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_c")), x))

    ends = near.groupBy(*keys, "_n").agg(at(low).alias("_lo"), at(high).alias("_hi"))
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (pos - F.floor(pos)))
    return stable(ends.where("_lo is not null and _hi is not null").select(*keys, value.alias("value")))


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, p, value).  Groups with no non-null value, and rows
    whose group key is NULL, produce nothing (pandas ``groupby`` semantics)."""
    cols, by = list(cols), list(by)
    return _by_rank(df, cols, probs, by)


def qname(col: str, p: float) -> str:
    return f"{col}__q{round(p * 10000):05d}"


def quantiles_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), names: dict | None = None) -> DataFrame:
    """One row per group with one column per (column, p), named
    ``names[(col, p)]`` or ``qname(col, p)``.  With no grouping the result is
    exactly one row, NULL where a column has no values."""
    long = quantiles_long(df, cols, probs, by)
    names = names or {}
    aggs = [F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("value")))
            .alias(names.get((c, p), qname(c, p))) for c in cols for p in probs]
    return long.groupBy(*by).agg(*aggs)


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """Per-group (or global) medians, one column ``{col}{suffix}`` each."""
    names = {(c, 0.5): f"{c}{suffix}" for c in cols}
    return quantiles_wide(df, cols, [0.5], by, names)


def group_and_global_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                               by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per-group and global quantiles from one pass: returns
    (rows (by..., column, p, value), rows (column, p, value))."""
    cols, by = list(cols), list(by)
    both = _by_rank(df, cols, probs, by, with_global=True)
    grp = both.where(F.col("_lvl") == 0).drop("_lvl")
    glob = both.where(F.col("_lvl") == 1).drop("_lvl", *by)
    return grp, glob


def _wide(long: DataFrame, cols, probs, by, names) -> DataFrame:
    aggs = [F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("value")))
            .alias(names.get((c, p), qname(c, p))) for c in cols for p in probs]
    return long.groupBy(*by).agg(*aggs)


def group_and_global_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str],
                             group_suffix: str = "__grp", global_suffix: str = "__glob"):
    """(per-group medians ``{c}{group_suffix}``, one-row global medians
    ``{c}{global_suffix}``) from one pass."""
    cols, by = list(cols), list(by)
    grp, glob = group_and_global_quantiles(df, cols, [0.5], by)
    return (_wide(grp, cols, [0.5], by, {(c, 0.5): f"{c}{group_suffix}" for c in cols}),
            _wide(glob, cols, [0.5], [], {(c, 0.5): f"{c}{global_suffix}" for c in cols}))


def multi_group_medians(df: DataFrame, specs: dict) -> dict:
    """Medians for several groupings at once: ``specs`` maps a name to
    (keys, cols).  One stacked table holds, for every spec, each value under
    its group key and under the global marker, and one pass serves
    them all.  Returns {name: (group rows (keys..., column, value),
    global rows (column, value))}; group keys come back as strings."""
    parts = []
    for name, (keys, cols) in specs.items():
        keys = list(keys)
        cols = [c for c in cols if c in df.columns]
        if not cols:
            continue
        k1 = F.col(keys[0]).cast("string")
        k2 = F.col(keys[1]).cast("string") if len(keys) > 1 else F.lit("").cast("string")
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
        lvl = F.explode(F.array(F.lit(0), F.lit(1))).alias("_lvl")
        st = df.select(k1.alias("_k1"), k2.alias("_k2"), pairs.alias("_p")).select("*", lvl)
        st = st.where((F.col("_lvl") == 1) | (F.col("_k1").isNotNull() & F.col("_k2").isNotNull()))
        st = st.select(F.lit(name).alias("_spec"), "_lvl",
                       F.when(F.col("_lvl") == 0, F.col("_k1")).alias("_k1"),
                       F.when(F.col("_lvl") == 0, F.col("_k2")).alias("_k2"), F.inline("_p"))
        parts.append(st.where(F.col("x").isNotNull() & ~F.isnan("x")))
    if not parts:
        return {}
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    res = _rank_long(long, ["_spec", "_lvl", "_k1", "_k2", "column"], [0.5])
    out = {}
    for name, (keys, cols) in specs.items():
        r = res.where(F.col("_spec") == name)
        keys = list(keys)
        grp = r.where(F.col("_lvl") == 0).select(
            F.col("_k1").alias(keys[0]), *([F.col("_k2").alias(keys[1])] if len(keys) > 1 else []),
            "column", "value")
        glob = r.where(F.col("_lvl") == 1).select("column", "value")
        out[name] = (grp, glob)
    return out
