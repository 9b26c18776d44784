import random
import zlib

import numpy as np
import pytest
from llm_cases import edge_docs, no_docs, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from shipcast.llm import mixing, packing, queries
from shipcast.llm.common import read


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum_and_plans_are_whole():
    rng, above = random.Random(1), 0
    for _ in range(800):
        capacity = rng.choice([10, 20, 50])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = {x: items.count(x) for x in items}
        best = optimum(items, capacity)
        fixed, left = packing.reduce_instance(counts, capacity)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + (optimum(rest, capacity) if rest else 0) == best
        got = {}
        patterns = packing.plan(counts, capacity)
        for n, content in patterns:
            assert sum(x * each for x, each in content) <= capacity
            for x, each in content:
                got[x] = got.get(x, 0) + n * each
        assert got == counts
        above += sum(n for n, _ in patterns) - best
    assert above <= 4


def test_fast_tokenizer_agrees_on_plain_characters():
    encode, exact = packing.encoder(), Tokenizer.from_file(packing.tokenizer_paths()[0])
    for code in range(0x250):
        for pattern in ("%", "a%b", " % ", "1%2", "  %% x", "%'s\n%\n\n "):
            text = pattern.replace("%", chr(code))
            assert encode(text) == exact.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts):
    exact = Tokenizer.from_file(packing.tokenizer_paths()[0])
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    want = []
    for i, text in texts:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        edges = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows), key=str) \
        == sorted(want, key=str)
    return len(filled), sum(r.length for r in rows) / 2048


def test_packing_query(spark):
    rows = queries.op1_best_fit_packing(spark, SF_SMALL).collect()
    texts = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    used, least = check_packing(rows, texts)
    assert used <= least + 2


def test_packing_edges(spark):
    docs = edge_docs(spark)
    rows = packing.pack(docs, keep_ids=True).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(no_docs(spark)).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, total, capped = {s: k % 3 + 1 for k, s in enumerate(names)}, sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        level = (total - sum(3 * sizes[s] for s in capped)) / free if free else 0
        more = {s for s in names if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= more


def test_mixing_query(spark):
    rows = queries.op2_source_mixing(spark, SF_SMALL).collect()
    docs = {r.doc_id: r for r in read(spark, SF_SMALL, "documents").collect()}
    sizes = {}
    for d in docs.values():
        sizes[d.source] = sizes.get(d.source, 0) + len(words(d.text))
    want, taken = targets(sizes), dict.fromkeys(sizes, 0)
    assert len(rows) == len(docs)
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == len(words(docs[r.doc_id].text)) and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source]) and r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for s in sizes:  # with a handful of documents, half the largest is as near as a run can be sure to come
        assert abs(taken[s] - want[s]) <= max(r["size"] for r in rows if docs[r.doc_id].source == s) / 2
    again = queries.op2_source_mixing(spark, SF_SMALL).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    order = [r.first_position for r in rows if r.first_position is not None]
    assert order == sorted(order) and 0 <= order[0] and order[-1] < 1


def test_caps_and_resharing(spark):
    texts = [("a", 2), ("b", 300), ("c", 5), (None, 200), ("é", 100)]
    docs = spark.createDataFrame([(k * 10 + j, s, " ".join(["w"] * n)) for k, (s, n) in enumerate(texts) for j in range(6)],
                                 "doc_id long, source string, text string")
    got = {r.source: r for r in mixing.mix(docs).groupBy("source").agg(
        F.first("_mix_target").alias("t"), F.max(F.size("_mix_positions")).alias("n")).collect()}
    want = targets({s: 6 * n for s, n in texts})
    assert all(got[s].t == pytest.approx(want[s]) and got[s].n <= 3 for s in want)
    assert want["a"] == 36


@pytest.mark.parametrize("sizes", [[1000] * 99 + [100_000], [2 ** k for k in range(12)] * 4 + [40_000] * 5])
def test_long_documents_do_not_keep_a_source_from_its_target(spark, sizes, mix=mixing.mix):
    docs = spark.createDataFrame([(k, s, n) for s in "abcd" for k, n in enumerate(sizes)], "id int, source string, n int")
    docs = docs.select(F.col("id").alias("doc_id"), "source", F.repeat(F.lit("w "), F.col("n")).alias("text"))
    rows = mix(docs, weights=(1.0, 3.0)).collect()
    for source in "abcd":  # the targets are half of the source's words, or three halves
        own = [r for r in rows if r.source == source]
        gap = own[0]._mix_target - sum(r._mix_size * len(r._mix_positions) for r in own)
        assert all(len(r._mix_positions) <= 3 and all(0 <= p < 1 for p in r._mix_positions) for r in own)
        assert abs(gap) <= 1024
        assert not any(abs(gap - r._mix_size) < gap for r in own if len(r._mix_positions) < 3)
        assert gap >= 0 or any(r._mix_positions and r._mix_size >= -2 * gap for r in own)


def test_repeated_rows_fill_a_gap_once(spark):
    docs = spark.createDataFrame([(1, "a", "w " * 10)] * 7 + [(2, "b", "w " * 10)] * 7, "doc_id int, source string, text string")
    rows = mixing.mix(docs, weights=(1.0, 1.5)).collect()
    for source, n in (("a", 6), ("b", 8)):  # targets of 5.6 and 8.4 rows
        assert sum(len(r._mix_positions) for r in rows if r.source == source) == n


def test_positions_follow_the_schedule(spark):
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(s, c) for s in shares for c in range(3)], "s double, c int")
    for r in df.select("s", "c", mixing.position(F.col("s"), F.col("c"), mixing.TIMES, mixing.SHAPES).alias("t")).collect():
        shape, grid = mixing.SHAPES[r.c], np.linspace(0, 1, 200001)
        weight = np.interp(grid, mixing.TIMES, shape)
        reached = np.cumsum(weight) / weight.sum()
        assert r.t == pytest.approx(grid[min(np.searchsorted(reached, r.s), len(grid) - 1)], abs=1e-4)


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(mixed.columns)
    assert all(r._mix_size == len(words(r.text)) and (r._mix_size > 0 or not r._mix_positions) for r in rows)
    ordered = mixing.training_order(mixed)
    assert ordered.select(docs.columns).count() == sum(len(r._mix_positions) for r in rows)
    assert mixing.mix(no_docs(spark)).count() == 0
