"""Source divergence audit: how far the sources of a language differ in their words.

Terms are counted in tasks over packed keys: a term of up to 8 bytes is one
uint64 word, up to 16 bytes two, and those are radix-sorted (stable passes over
16-bit digits) and run-counted in numpy; longer terms go to buckets by length,
which are sorted as bytes.  The sort is stable over terms in order of document,
so the same runs give the documents that hold a term.  Spark sums the counts per
(language, source, term), keeps frequent terms, and turns counts into shares of
exact integers.

Pairs of sources are compared in cells (block of terms x two blocks of sources):
a cell is a small dense matrix whose rows start at each source's share of an
absent term, so absent terms cost no rows.  A cell emits one sum per pair of its
sources, never a row per term and pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import runs, written

#: Bytes of text that a task sorts at once.
CHUNK = 4 << 20
#: Terms and sources of a cell of the pairs, on average.
CELL_TERMS, CELL_SOURCES = 1024, 128

_BYTES = np.arange(256)
IS_TERM = (_BYTES >= 0x80) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Keeps the first k bytes of a big-endian word.
MASKS = np.array([(1 << 64) - (1 << (64 - 8 * k)) if k else 0 for k in range(9)], np.uint64)

COUNTS = "lang string, source string, term string, n long, docs long"


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by uint64 words, the first of which counts most."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n: int) -> list[np.ndarray]:
    """The first ``8 n`` bytes of each term as big-endian words, zero beyond its end."""
    cells = np.lib.stride_tricks.sliding_window_view(data, 8 * n)[starts]
    packed = cells.view(">u8").astype(np.uint64)
    return [packed[:, k] & MASKS[np.clip(sizes - 8 * k, 0, 8)] for k in range(n)]


def _run_counts(same: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, rows, documents) of every run of one term in one group; ``same``:
    whether a row has the term of the row before it."""
    new = ~same
    new[1:] |= group[1:] != group[:-1]
    held = new.copy()
    held[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new))), np.add.reduceat(held.astype(np.int64), first)


def _count(data: np.ndarray, begins: np.ndarray, groups: np.ndarray) -> list[tuple]:
    """Runs of the terms of some texts that lie behind one another in ``data`` (from
    ``begins``, ascending by group): [(terms as bytes, group, rows, documents)]."""
    data = np.concatenate([LOWER[data], np.zeros(16, np.uint8)])
    term = IS_TERM[data]
    seam = np.zeros(len(data), bool)
    seam[begins] = True
    inside = np.concatenate([[False], term[:-1]])
    starts = np.flatnonzero(term & (seam | ~inside))
    sizes = np.flatnonzero(inside & (seam | ~term)) - starts
    if not len(starts):
        return []
    doc = np.searchsorted(begins, starts, side="right") - 1
    out = []

    def take(rows, order, same, as_bytes):
        rows = rows[order]
        first, n, docs = _run_counts(same, groups[doc[rows]], doc[rows])
        out.append((as_bytes(first), groups[doc[rows[first]]], n, docs))

    for n, low, high in ((1, 0, 8), (2, 8, 16)):
        rows = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(rows):
            words = _words(data, starts[rows], sizes[rows], n)
            order = radix_order(words)
            words = [w[order] for w in words]
            same = np.concatenate([[False], np.logical_and.reduce([w[1:] == w[:-1] for w in words])])
            take(rows, order, same, lambda first, words=words, n=n: np.ascontiguousarray(
                np.stack([w[first] for w in words], 1).astype(">u8")).view(f"S{8 * n}").ravel())
    long = np.flatnonzero(sizes > 16)
    width = 32
    while len(long):
        rows = long[sizes[long] <= width]
        if len(rows):
            cells = np.zeros((len(rows), width), np.uint8)
            for k, r in enumerate(rows):
                cells[k, :sizes[r]] = data[starts[r]:starts[r] + sizes[r]]
            keys = cells.view(f"S{width}").ravel()
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            take(rows, order, np.concatenate([[False], keys[1:] == keys[:-1]]), lambda first, keys=keys: keys[first])
        long, width = long[sizes[long] > width], 2 * width
    return out


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of one long text, cut where no term is cut."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        while end < len(text) and IS_TERM[text[end]] and IS_TERM[text[end - 1]]:
            end += 1
        yield text[at:end]
        at = end


def _batch(parts: list[tuple], names: list[tuple[str, str]]) -> pa.RecordBatch:
    lang, source = (pa.array([x[k] for x in names], pa.string()) for k in (0, 1))
    group = np.concatenate([p[1] for p in parts])
    term = pa.chunked_array([pa.array(p[0].tolist(), pa.binary()) for p in parts]).combine_chunks().cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [lang.take(pa.array(group)), source.take(pa.array(group)), term,
         pa.array(np.concatenate([p[2] for p in parts]), pa.int64()),
         pa.array(np.concatenate([p[3] for p in parts]), pa.int64())], ["lang", "source", "term", "n", "docs"])


def _count_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) batches to term counts, a chunk of texts at a time."""
    for rb in it:
        keys = list(zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()))
        names = sorted(set(keys))
        code = {k: i for i, k in enumerate(names)}
        group = np.array([code[k] for k in keys], np.int64)
        chunk, held = [], 0

        def flush(chunk):
            data = b"".join(t for _, t in chunk)
            ends = np.cumsum([len(t) for _, t in chunk])
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            return _count(np.frombuffer(data, np.uint8), begins, np.array([g for g, _ in chunk], np.int64))

        for i in np.argsort(group, kind="stable"):
            text = rb.column(2)[int(i)].as_py().encode()
            if len(text) > CHUNK:  # one document: its pieces are summed before its documents are counted
                total: dict[bytes, int] = {}
                for piece in _pieces(text):
                    for terms, _, n, _ in _count(np.frombuffer(piece, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64)):
                        for t, k in zip(terms.tolist(), n.tolist()):
                            total[t] = total.get(t, 0) + k
                if total:
                    m = len(total)
                    yield _batch([(np.array(list(total), object), np.full(m, group[i]), np.array(list(total.values())),
                                   np.ones(m, np.int64))], names)
                continue
            chunk.append((group[i], text))
            held += len(text)
            if held >= CHUNK:
                if parts := flush(chunk):
                    yield _batch(parts, names)
                chunk, held = [], 0
        if chunk and (parts := flush(chunk)):
            yield _batch(parts, names)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); null
    languages, sources and texts read as empty.  Terms: runs of ASCII letters
    (lower-cased) and of all characters beyond ASCII."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (plain.mapInArrow(_count_batches, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n, total, kept) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 kept)), exact."""
    big = [F.col(c).cast("decimal(20,0)") if isinstance(c, str) else F.lit(c).cast("decimal(20,0)") for c in (n, total, kept)]
    over, under = big[0] * 1000000000 + 5000000000, big[1] + big[2] * 5
    return F.when(under > 0, F.call_function("div", over, under) + 1)


PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of |p - q| over a cell's terms, for every pair of its two blocks' sources."""
    left = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
    terms, names = (table.column(c).combine_chunks().dictionary_encode() for c in ("term", "source"))
    column = terms.indices.fill_null(-1).to_numpy()  # -1: the row that has the share of absent terms
    source, p, texts = names.indices.to_numpy(), table.column("p").to_numpy(), np.array(names.dictionary.to_pylist(), object)

    def matrix(rows):
        own, at = np.unique(source[rows], return_inverse=True)
        base = column[rows] < 0
        absent = np.zeros(len(own), np.int64)
        absent[at[base]] = p[rows][base]
        out = np.repeat(absent[:, None], len(terms.dictionary), 1)
        out[at[~base], column[rows][~base]] = p[rows][~base]
        return texts[own], out, absent

    one = key[2].as_py() == key[3].as_py()
    a_names, a, a_base = matrix(np.flatnonzero(left))
    b_names, b, b_base = (a_names, a, a_base) if one else matrix(np.flatnonzero(~left))
    if not len(a_names) or not len(b_names):
        return PAIRS.empty_table()
    sums = np.array([np.abs(b - row).sum(1) for row in a]).reshape(len(a_names), len(b_names))
    # The block's terms that none of these sources has.
    missing = int(pc.max(table.column("terms")).as_py()) - len(terms.dictionary)
    sums += missing * np.abs(a_base[:, None] - b_base[None, :])
    i, j = np.nonzero(~np.eye(len(a_names), dtype=bool)) if one else np.indices(sums.shape).reshape(2, -1)
    first, second, value = a_names[i], b_names[j], sums[i, j]
    if not one:
        first, second, value = np.append(first, second), np.append(second, first), np.append(value, value)
    return pa.table([[key[0].as_py()] * len(value), first.tolist(), second.tolist(), value], schema=PAIRS)


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: per source the distance to every other
    source of its language (part ``pair``), and the ``top`` terms that it has more
    of than its language (part ``term``).

    Terms count if at least ``least_docs`` documents of the language hold them.
    Null languages, sources and texts are empty strings, groups like others; a
    source without terms still has its pairs; a language without kept terms has
    pairs of value 0; a language with one source has no pairs.  Ties rank by the
    item's bytes.  Repeated rows count as often as they stand.  An empty table
    gives no rows, and other columns play no part.
    """
    counts = written(term_counts(docs), "divergence-counts")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                   .where(F.col("docs") >= least_docs).drop("docs"), "divergence-kept")
    used = written(counts.join(kept, ["lang", "term"]).drop("docs"), "divergence-used")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    sizes = written(groups.join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                    .join(sources, "lang").join(langs, "lang", "left")
                    .fillna(0, ["total", "kept", "lang_total"]), "divergence-sizes")
    shares = used.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", "kept", "sources",
        share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q"))

    own = Window.partitionBy("lang", "source")
    order = [F.col("value").desc(), F.col("item")]
    terms = (shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(own.orderBy(*order))).where(F.col("rank") <= top)
             .withColumn("part", F.lit("term")))

    n_terms, n_sources = (F.greatest(F.lit(1).cast("long"), F.ceil(F.col(c) / lim)) for c, lim in (
        ("kept", CELL_TERMS), ("sources", CELL_SOURCES)))
    block, own_block = F.pmod(F.xxhash64("term"), n_terms), F.pmod(F.xxhash64("source", F.lit(3)), n_sources)
    filled = written(kept.join(langs, "lang").groupBy("lang", block.alias("block")).agg(F.count("*").alias("terms")),
                     "divergence-blocks")
    base = sizes.select("lang", "source", F.explode(F.sequence(F.lit(0).cast("long"), n_terms - 1)).alias("block"),
                        F.lit(None).cast("string").alias("term"), F.coalesce(share(0, "total", "kept"), F.lit(0)).alias("p"),
                        own_block.alias("own"), n_sources.alias("blocks"))
    base = base.join(filled, ["lang", "block"], "left").fillna(0, ["terms"])
    rows = shares.select("lang", "source", block.alias("block"), "term", "p", own_block.alias("own"),
                         n_sources.alias("blocks"), F.lit(0).cast("long").alias("terms")).unionByName(base)
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("left"), "source", "term", "p", "terms")
    pairs = (cells.groupBy("lang", "block", "i", "j")
             .applyInArrow(_compare, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(own.orderBy(*order))).withColumn("part", F.lit("pair")))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
