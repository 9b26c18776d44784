"""Substring dedup with fixed-block anchors.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A window is ``window`` consecutive
words of one document; it goes if the same words also start in a document with
a smaller doc_id.  Every word that such a window covers is removed.  Windows
are judged on the input, not on what is left.

1. Anchors.  Every window of 13 words holds a whole block of 7 words that starts
   at a multiple of 7 in its document.  So the non-overlapping blocks are the
   index, and every rolling run of 7 words of every document is a probe.  A
   place whose run is met by an index block elsewhere is an anchor hit.
2. Extension.  Around each hit, the windows that hold the run are hashed, and
   the smallest doc_id of each window's words is found.  The windows that meet
   a smaller one, put together, cover the maximal exact repeats.

Probes travel as sorted arrays of 8 bytes a place, one array for each part of
the hash range and each batch of documents, so a shuffle moves about 8 bytes a
word.  A run that repeats within a batch is a hit at once and is sent a single
time, so a passage that a third of all documents share reaches its part once a
batch.  The same holds for windows.  Answers go back to the batch's list of
documents, and from there by document.

Words and windows are compared by 64-bit hashes (anchors: 43 bits, which only
preselect), so two different windows would have to collide for a wrong removal.

Null text has no words.  A null doc_id comes after all others.  Rows with equal
doc_id never remove each other's words.  An empty table gives an empty result.
Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import partitions, runs, written

WINDOW = 13
LAST = (1 << 63) - 1  # stands for a null doc_id
#: Words of a batch, bytes hashed at a time, words of a piece of a very long document.
BATCH_WORDS, CHUNK, PIECE = 1 << 20, 1 << 21, (1 << 20) - 64
#: An anchor entry: this many bits of hash, of place in the batch, and one that marks an index block.
PLACE = 20
HASH = 63 - PLACE
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    for shift, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(m)
    return x ^ x >> np.uint64(31)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^n modulo 2^64."""
    if len(_powers.get(base, ())) <= n:
        steps = np.full(max(n, CHUNK) + 1, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n + 1]


def _hash(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    edge = np.diff((~SPACE[data]).astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[:-1], out=sums[1:])
    inverse = powers(pow(BASE, -1, 1 << 64), len(data))
    words = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(STEP))
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return words, np.diff(np.searchsorted(begin, offsets))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many each text has."""
    hashes, counts, held, size = [], np.zeros(len(texts), np.int64), [], 0

    def flush() -> None:
        nonlocal size
        if held:
            h, n = _hash([t for _, t in held])
            hashes.append(h)
            np.add.at(counts, [i for i, _ in held], n)
            held.clear()
            size = 0

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):  # a long text is hashed in parts that end at white space
            cut = re.compile(rb"[\x20\x09-\x0D]").search(text, at + CHUNK) if len(text) - at > CHUNK else None
            stop = cut.end() if cut else len(text)
            held.append((i, text[at:stop]))
            size, at = size + stop - at, stop
            if size >= CHUNK:
                flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def rolling(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place."""
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h = h * np.uint64(STEP) + words[at + j]
    return mix(h)


def planes(x: np.ndarray) -> bytes:
    """Bytes by significance: the high ones of sorted numbers compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(raw: list[bytes], dtype: str) -> np.ndarray:
    wide = np.dtype(dtype).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(r, np.uint8).reshape(wide, -1).T).reshape(-1).view(dtype) for r in raw]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def stretches(at: np.ndarray) -> bytes:
    """Sorted distinct numbers as (first, how many) of each stretch without a gap."""
    first = np.flatnonzero(np.diff(at, prepend=at[:1] - 2) != 1)
    return np.stack([at[first], np.diff(np.append(first, len(at)))], 1).astype("<i4").tobytes()


def unstretched(raw: bytes) -> np.ndarray:
    first, many = np.frombuffer(raw, "<i4").reshape(-1, 2).T
    return np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


ENTRIES, DOCUMENTS, HITS = 0, 1, 2
SENT = "part int, batch long, kind int, a binary, ids binary, places binary"
ANSWER = "batch long, kind int, a binary"
PLACE_BITS = np.uint64((1 << PLACE) - 1)
BELOW = np.uint64(PLACE + 1)  # bits below the hash


def sent(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["part", "batch", "kind", "a", "ids", "places"])


def answers(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * 3
    types = [pa.int64(), pa.int32(), pa.binary()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("batch", "kind", "a"), cols, types)})


def hits(batch: np.ndarray, place: np.ndarray) -> pa.Table:
    """One row of places for each batch."""
    order = np.lexsort((place, batch))
    return answers([(int(batch[order[s]]), HITS, planes(place[order[s:s + n]].astype("<i4")))
                    for s, n in zip(*runs(batch[order]))])


class Batch:
    """Documents whose words are numbered through: place = base of the document + word number."""

    def __init__(self, number: int, parts: int):
        self.number, self.parts, self.size = number, parts, 0
        self.listed, self.words, self.marks = [], [], []

    def add(self, i: int, t: int, first: int, words: np.ndarray) -> None:
        self.listed.append((i, t, first, self.size))
        self.words.append(words)
        self.size += len(words)

    def column(self, k: int) -> np.ndarray:
        return np.array([x[k] for x in self.listed], np.int64)

    def rows(self, found: np.ndarray) -> list[tuple]:
        """The list of documents, and hits found within the batch; they pass through a part."""
        part = -1 - self.number % self.parts
        listed = np.array(self.listed, "<i8").tobytes()
        out = [(part, self.number, DOCUMENTS, listed, None, None)]
        return out + [(part, self.number, HITS, planes(np.sort(found).astype("<i4")), None, None)] * bool(len(found))

    def edges(self, hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
        """(part, from, to) of sorted hashes of ``bits`` bits, by the parts of their range."""
        top = (hashes >> np.uint64(bits - 32)).astype(np.uint64)
        at = np.searchsorted(top * np.uint64(self.parts) >> np.uint64(32), np.arange(self.parts + 1))
        return ((k, int(a), int(b)) for k, (a, b) in enumerate(zip(at, at[1:])) if b > a)


def batches(it: Iterator[pa.RecordBatch], parts: int, window: int, marked: bool) -> Iterator[Batch]:
    """Batches of the documents of a partition, with their words' hashes; with
    ``marked`` only documents that have places, whose arrays come with them."""
    number = TaskContext.get().partitionId() << 24
    batch = Batch(number, parts)
    for rb in it:
        if marked:
            rb = rb.filter(rb.column("places").is_valid())
        if not rb.num_rows:
            continue
        words, counts = hash_words(rb.column("text").to_pylist())
        ends = np.cumsum(counts)
        places = rb.column("places").to_pylist() if marked else [None] * rb.num_rows
        for i, t, n, end, at in zip(rb.column("_id").to_pylist(), rb.column("_t").to_pylist(), counts, ends, places):
            if n < window:
                continue
            at = np.concatenate([unstretched(x) for x in at]) if marked else None
            for first in range(0, int(n) - window + 1, PIECE):  # pieces overlap, so each start lies in one
                piece = words[end - n + first:end - n + min(n, first + PIECE + window - 1)]
                if batch.size and batch.size + len(piece) > BATCH_WORDS:
                    yield batch
                    batch = Batch(batch.number + 1, parts)
                if marked:  # with the hits behind its last start that a window of it may hold
                    batch.marks.append(at[(at >= first) & (at < first + PIECE + window)] - first + batch.size)
                batch.add(i, t, first, piece)
    if batch.size:
        yield batch


def passed(table: pa.Table) -> pa.Table | None:
    """Rows that only pass through, if the part is one of those."""
    return None if table.column("kind")[0].as_py() == ENTRIES else table.select(["batch", "kind", "a"])


def places_of(answered: DataFrame) -> DataFrame:
    """(_id, _t, places): the word numbers hit in each document, as stretches."""
    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kinds, data = table.column("kind").to_pylist(), table.column("a").to_pylist()
        listed = np.frombuffer(data[kinds.index(DOCUMENTS)], "<i8").reshape(-1, 4)
        place = np.unique(unplanes([d for k, d in zip(kinds, data) if k == HITS], "<i4")).astype(np.int64)
        doc = np.searchsorted(listed[:, 3], place, "right") - 1
        out = [(int(listed[doc[s], 0]), int(listed[doc[s], 1]),
                stretches(place[s:s + n] - listed[doc[s], 3] + listed[doc[s], 2]))
               for s, n in zip(*runs(doc))]
        cols = list(zip(*out)) or [()] * 3
        return pa.table({"_id": pa.array(cols[0], pa.int64()), "_t": pa.array(cols[1], pa.int64()),
                         "at": pa.array(cols[2], pa.binary())})

    return (answered.groupBy("batch").applyInArrow(gather, "_id long, _t long, at binary")
            .groupBy("_id", "_t").agg(F.collect_list("at").alias("places")))


def anchor_hits(docs: DataFrame, window: int) -> DataFrame:
    """Answers: the places whose run of block length is met elsewhere."""
    parts, block = 4 * partitions(docs.sparkSession), (window + 1) // 2

    def probe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, parts, window, False):
            base, first = batch.column(3), batch.column(2)
            counts = np.diff(np.append(base, batch.size))
            inside = counts - block + 1
            doc = np.repeat(np.arange(len(base)), inside)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(inside) - inside, inside)
            place = base[doc] + at
            code = rolling(np.concatenate(batch.words), place, block) >> BELOW << BELOW
            code |= place.astype(np.uint64) << np.uint64(1) | ((at + first[doc]) % block == 0).astype(np.uint64)
            code.sort()
            starts, sizes = runs(code >> BELOW)
            # Runs that repeat within the batch are hits; one of each goes on, as index block if any is.
            several = code[np.repeat(sizes > 1, sizes)]
            rows = batch.rows(several >> np.uint64(1) & PLACE_BITS)
            code = code[starts] | np.bitwise_or.reduceat(code & np.uint64(1), starts)
            yield sent(rows + [(k, batch.number, ENTRIES, planes(code[a:b]), None, None)
                               for k, a, b in batch.edges(code >> BELOW, HASH)])

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if (through := passed(table)) is not None:
            return through
        packets = table.column("a").to_pylist()
        code = unplanes(packets, "<u8")
        batch = np.repeat(table.column("batch").to_numpy(), [len(p) // 8 for p in packets])
        order = np.argsort(code >> BELOW, kind="stable")
        starts, sizes = runs((code >> BELOW)[order])
        indexed = np.bitwise_or.reduceat(code[order] & np.uint64(1), starts).astype(bool)
        hit = order[np.repeat((sizes > 1) & indexed, sizes)]
        return hits(batch[hit], code[hit] >> np.uint64(1) & PLACE_BITS)

    return docs.mapInArrow(probe, SENT).groupBy("part").applyInArrow(meet, ANSWER)


def repeat_hits(docs: DataFrame, window: int) -> DataFrame:
    """Answers: the starts of windows whose words also start in a document with a smaller id.

    ``docs`` has ``places``, the anchor hits of each document.
    """
    parts, block = 4 * partitions(docs.sparkSession), (window + 1) // 2

    def extend(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, parts, window, True):
            base = batch.column(3)
            last = np.append(base[1:], batch.size) - window  # the last start in each document
            hit = np.concatenate(batch.marks)
            doc = np.searchsorted(base, hit, "right") - 1
            around = hit[:, None] - np.arange(window - block + 1)  # the windows that hold the run
            fits = (around >= base[doc][:, None]) & (around <= last[doc][:, None])
            place = np.unique(around[fits])
            ids = batch.column(0)[np.searchsorted(base, place, "right") - 1]
            h = rolling(np.concatenate(batch.words), place, window)
            order = np.lexsort((ids, h))
            h, ids, place = h[order], ids[order], place[order]
            starts, sizes = runs(h)
            least = np.repeat(ids[starts], sizes)
            # A smaller id in the batch decides; the other windows ask their part.
            rows = batch.rows(place[ids > least])
            own = ids == least
            h, ids, place = h[own], ids[own], place[own]
            yield sent(rows + [(k, batch.number, ENTRIES, planes(h[a:b]), planes(ids[a:b]), planes(place[a:b].astype("<i4")))
                               for k, a, b in batch.edges(h, 64)])

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if (through := passed(table)) is not None:
            return through
        packets = table.column("a").to_pylist()
        h, ids = unplanes(packets, "<u8"), unplanes(table.column("ids").to_pylist(), "<i8")
        place = unplanes(table.column("places").to_pylist(), "<i4")
        batch = np.repeat(table.column("batch").to_numpy(), [len(p) // 8 for p in packets])
        order = np.argsort(h, kind="stable")
        starts, sizes = runs(h[order])
        least = np.repeat(np.minimum.reduceat(ids[order], starts), sizes)
        hit = order[ids[order] > least]
        return hits(batch[hit], place[hit])

    return docs.mapInArrow(extend, SENT).groupBy("part").applyInArrow(meet, ANSWER)


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept: the words that stay, joined by one space."""
    # Both joins read the same three columns, so that the texts are shuffled once for both.
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    texts = texts.select("_id", F.xxhash64("text").alias("_t"), "text")
    marked = written(places_of(anchor_hits(texts, window)), "substring-marks")
    starts = places_of(repeat_hits(texts.join(marked, ["_id", "_t"], "left"), window))

    def strip(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            out = []
            for text, places in zip(rb.column("text").to_pylist(), rb.column("places").to_pylist()):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                if places:
                    at = np.unique(np.concatenate([unstretched(p) for p in places]))
                    gone[at] += 1
                    np.subtract.at(gone, at + window, 1)
                gone = np.cumsum(gone)[:len(words)] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((len(words), int(gone.sum()), kept.decode()))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([rb.column("_id"), *(pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.string())))], ["_id", "n_words", "n_removed", "kept"])

    out = texts.join(starts, ["_id", "_t"], "left").select("_id", "text", "places").mapInArrow(
        strip, "_id long, n_words long, n_removed long, kept string")
    return out.select(F.nullif("_id", F.lit(LAST)).alias("doc_id"), "n_words", "n_removed", "kept")
