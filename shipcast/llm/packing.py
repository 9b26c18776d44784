"""Best-fit packing with Martello-Toth dominance reduction.

Documents become token ids (the document's ids, then ``END``); only documents
longer than the capacity are cut, into full pieces behind a first piece that
takes the remainder.  How many pieces have each length is a table of at most
``capacity`` rows, and the packing is decided on it:

1. reduction: going down from the longest piece, a set of at most three pieces
   that provably dominates every other set around that piece is fixed as a
   sequence of its own; this shrinks the instance and is repeated until
   nothing more can be fixed;
2. best-fit decreasing on what is left: each piece goes to the fullest open
   sequence that still holds it.

Equal lengths are interchangeable, so both steps work on counts, and the plan
is a short table of slots: "pieces number a to b of length n go to these
sequences at this offset".  Every piece gets its number among equal lengths
from per-bucket counts, so no length, however frequent, is gathered in a task.

Null text is an empty text, whose only id is ``END``.  Repeated rows are
packed each; ``doc_id`` may be null or repeated.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import partitions, written

CAPACITY = 2048
END = 0
#: Characters on which both tokenizer libraries are tested to agree; any other text takes the slower one.
PLAIN = "\x00-ɏ"
SPECIAL = "<|endoftext|>"


def tokenizer_paths() -> tuple[str, str]:
    """The vocabulary as JSON (defines the ids) and as ranks (same vocabulary, faster library)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(paths: tuple[str, str] | None = None):
    """A function from text to ids: those of ``tokenizers`` with the JSON vocabulary."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    json_path, rank_path = paths or tokenizer_paths()
    exact = Tokenizer.from_file(json_path)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_path, "rb"))}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = re.compile(f"[^{PLAIN}]")

    def encode(text: str) -> list[int]:
        if SPECIAL in text or (not text.isascii() and odd.search(text)):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False,
           paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids: little-endian unsigned 32-bit ids]."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for rb in it:
            encode = encode or encoder(paths)
            rows = []
            for i, text in enumerate(rb.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    raw = ids[a:b].tobytes()
                    rows.append((i, k, a, b - a, zlib.crc32(raw), raw if keep_ids else None))
            cols = list(zip(*rows)) or [()] * 6
            out = [rb.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                   *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out, names = [*out, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


def _nth_smallest(counts: dict[int, int], order: list[int], n: int, without: dict[int, int]) -> int | None:
    """The n-th smallest length (from 1) among the counts less ``without``."""
    for x in order:
        n -= counts.get(x, 0) - without.get(x, 0)
        if n <= 0:
            return x
    return None


def dominating(counts: dict[int, int], order: list[int], j: int, capacity: int) -> list[int] | None:
    """A set around one piece of length ``j`` that dominates all others, or None.

    ``order``: the lengths with a count, ascending.
    """
    room, own = capacity - j, {j: 1}
    small = [_nth_smallest(counts, order, k, own) for k in (1, 2, 3)]
    if small[0] is None or small[0] > room:
        return [j]  # no other piece fits beside it
    best = next(x for x in reversed(order) if x <= room and counts[x] - own.get(x, 0) > 0)
    if best == room or small[1] is None or small[0] + small[1] > room:
        return [j, best]  # exact, or only one more piece fits
    if small[2] is not None and sum(small) <= room:
        return None  # three more could fit: not decided by sets of three
    pair, lo, hi = (0, 0), 0, len(order) - 1  # the pair with the largest sum that fits
    while lo <= hi:
        a, b = order[hi], order[lo]
        free = counts[a] - own.get(a, 0), counts[b] - own.get(b, 0)
        if a + b > room or free[0] < 1 or (a == b and free[0] < 2):
            hi -= 1
        elif free[1] < 1:
            lo += 1
        else:
            pair = max(pair, (a, b), key=sum)
            lo += 1
    a, b = pair
    if best >= a + b:
        return [j, best]
    if best == a:
        used = {j: 1}
        used[a] = used.get(a, 0) + 1
        longer = [x for x in order if x > b]
        two = [_nth_smallest({x: counts[x] for x in longer}, longer, k, used) for k in (1, 2)]
        if two[1] is None or sum(two) > room:
            return [j, a, b]  # any other pair is no longer, piece by piece
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """The fixed sets as (how often, lengths), and the counts that are left."""
    left, fixed, changed = dict(counts), [], True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j, 0) > 0:
                order = sorted(x for x, n in left.items() if n)
                found = dominating(left, order, j, capacity)
                if found is None:
                    break
                need = {x: found.count(x) for x in found}
                # The argument holds for as long as these lengths last: what else is left only shrinks.
                times = min(left[x] // n for x, n in need.items())
                if len(found) == 1 and order[0] == j and 2 * j <= capacity:
                    times = 1
                fixed.append((times, found))
                for x, n in need.items():
                    left[x] -= times * n
                changed = True
    return fixed, {x: n for x, n in left.items() if n}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on counts: (how many sequences, [(length, how many of it in each)])."""
    open_by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(n: int, content: list[tuple[int, int]], room: int) -> None:
        if n:
            open_by_room.setdefault(room, []).append((n, content))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        for room in sorted(r for r in open_by_room if r >= length):
            while todo and open_by_room.get(room):
                n, content = open_by_room[room].pop()
                each = room // length
                full = min(n, todo // each)
                todo -= full * each
                put(full, [*content, (length, each)], room - each * length)
                if full < n:
                    if todo:
                        put(1, [*content, (length, todo)], room - todo * length)
                        full, todo = full + 1, 0
                    put(n - full, content, room)
                    break
            if not todo:
                break
        each = capacity // length
        put(todo // each, [(length, each)], capacity - each * length)
        if todo % each:
            put(1, [(length, todo % each)], capacity - todo % each * length)
    return [x for groups in open_by_room.values() for x in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """The packing of ``counts`` (length: how many): (how many sequences, [(length, how many of it in each)])."""
    fixed, left = reduce_instance(counts, capacity)
    sets = [(n, [(x, found.count(x)) for x in dict.fromkeys(found)]) for n, found in fixed]
    return sets + best_fit(left, capacity)


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, from number, each, first sequence, offset), sorted: pieces of a
    length, by number, fill ``each`` places in one sequence after the other."""
    rows, taken, sequence = [], {}, 0
    for n, content in patterns:
        offset = 0
        for length, each in content:
            rows.append((length, taken.get(length, 0), each, sequence, offset))
            taken[length] = taken.get(length, 0) + n * each
            offset += length * each
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces (doc_id, piece, start, length, ...).

    Only the counts per length (at most ``capacity`` rows) reach the driver.
    """
    n = 4 * partitions(pieces.sparkSession)
    cut = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n)))
    counts = written(cut.groupBy("bucket", "length").agg(F.count("*").alias("n")), "pack-counts")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(total, capacity))
    keys = table[:, 0] * (1 << 44) + table[:, 1]

    before = (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before")
    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (cut.join(counts.select("bucket", "length", before), ["bucket", "length"])
                .withColumn("number", F.col("before") + F.row_number().over(within) - 1).drop("bucket", "before"))

    def seat(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            length, number = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(keys, length * (1 << 44) + number, "right") - 1
            step = number - table[at, 1]
            each = table[at, 2]
            out = rb.drop_columns(["number"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(table[at, 3] + step // each), pa.array(table[at, 4] + step % each * length)],
                [*out.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False,
         paths: tuple[str, str] | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return place(written(pieces(docs, capacity, keep_ids, paths), "pack-pieces"), capacity)
