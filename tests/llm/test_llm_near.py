import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import components_of, edge_docs, no_docs, words
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from shipcast.llm import common, lattice, queries, simhash, substring
from shipcast.llm.common import read


def fingerprint(text, k=4):
    parts = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(parts[i:i + k]) for i in range(len(parts) - k + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_covering_masks_miss_no_pair():
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    rng = random.Random(4)
    for _ in range(3000):
        differing = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(differing & m == 0 for m in masks)
    small = [m % (1 << 64) for m in simhash.covering_masks(2)]
    assert all(any(not (m >> a & 1 or m >> b & 1) for m in small) for a, b in itertools.combinations(range(64), 2))


def test_simhash_query(spark):
    docs = {r.doc_id: r.text for r in read(spark, SF_SMALL, "documents").collect()}
    rows = sorted(queries.op8_simhash_near_dedup(spark, SF_SMALL).collect(), key=lambda r: r.doc_id)
    prints = [int(r.fingerprint, 16) for r in rows]
    assert all(len(r.fingerprint) == 16 for r in rows) and prints == [fingerprint(docs[r.doc_id]) for r in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert [r.component_id for r in rows] == components_of([r.doc_id for r in rows], links)


def test_simhash_edges(spark):
    docs = edge_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    source = docs.collect()
    last = 1 << 62  # a null doc_id names no component that has another
    ids, prints = [r.doc_id or last for r in source], [fingerprint(r.text) for r in source]
    near = [(a, b) for a, b in itertools.combinations(range(len(ids)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    component = components_of(ids, near)
    assert sorted((r.doc_id or last, r.component_id or last) for r in rows) == sorted(zip(ids, component))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    # one row of every component; two rows share their doc_id only if their texts are in two components
    assert sorted(r.doc_id or last for r in kept.collect()) == sorted(set(component))
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_keep_first_keeps_one_row_of_every_component_where_doc_ids_repeat(spark):
    a, b = ("the quick brown fox jumps over the lazy dog again and again ", "numbers of ships sail north in winter storms ")
    rows = [(1, a * 3), (1, b * 3), (2, b * 3), (1, a * 3), (None, "a third text that is like no other text here " * 2),
            (None, a * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(simhash.keep_first(docs.repartition(3)).collect(), key=str)
    assert kept == sorted([(1, a * 3), (1, b * 3), rows[4]], key=str)


@pytest.mark.parametrize("block", [4, 16, 1000])
def test_links_join_whole_groups_in_any_block_size(spark, block):
    rng = np.random.default_rng(block)
    points = [(g, 1000 * g + k, float(x)) for g in range(30) for k, x in enumerate(rng.random(rng.integers(1, 60)) * 20)]
    rows = [(g, i, np.array([x]).tobytes()) for g, i, x in points]
    df = spark.createDataFrame(rows, "g long, id long, payload binary").repartition(3)

    def match(p, q):
        return np.abs(p[:, 0][:, None] - q[:, 0][None, :]) <= 0.5

    links = common.group_links(df, match, 1, "<f8", "test", block)
    got = {r.id: r.root for r in common.components(links, "test").collect()}
    near = [(a, b) for a, b in itertools.combinations(range(len(points)), 2)
            if points[a][0] == points[b][0] and abs(points[a][2] - points[b][2]) <= 0.5]
    want = components_of([p[1] for p in points], near)
    assert [got.get(p[1], p[1]) for p in points] == want
    assert links.count() <= 4 * len(points) * (1 + 60 // block)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(900, 700), (700, 800)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    got = {r.id: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    ids = sorted({x for e in edges for x in e})
    want = components_of(ids, [(ids.index(a), ids.index(b)) for a, b in edges])
    assert [got.get(i, i) for i in ids] == want


def test_decoder_finds_the_nearest_point():
    x = np.random.default_rng(1).normal(size=(500, 8)) * 3
    point, steps = lattice.decode(x), lattice.roots()
    assert len(steps) == 240 and (((x[:, None] - point[:, None] - steps) ** 2).sum(2).min(1) >= ((x - point) ** 2).sum(1) - 1e-12).all()


def vectors_brute(rows):
    good = [(k, np.array(v, float)) for k, (_, v, label) in enumerate(rows)
            if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    pairs = [(a, b) for (a, x), (b, y) in itertools.combinations(good, 2)
             if rows[a][2] == rows[b][2] and len(x) == len(y)
             and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98]
    degree = np.bincount([k for p in pairs for k in p], minlength=len(rows))
    return degree.tolist(), components_of([r[0] for r in rows], pairs)


def test_lattice_query(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in read(spark, SF_SMALL, "embeddings").orderBy("vec_id").collect()]
    got = sorted(queries.op6_e8_lattice(spark, SF_SMALL).collect(), key=lambda r: r.vec_id)
    degree, component = vectors_brute(rows)
    assert [r.n_links for r in got] == degree and [r.component_id for r in got] == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_lattice_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64))
    off = rng.normal(size=x.shape)
    off -= ((off * x).sum(1) / (x * x).sum(1))[:, None] * x
    y = x / np.linalg.norm(x, axis=1)[:, None] * 0.981 + off / np.linalg.norm(off, axis=1)[:, None] * np.sqrt(1 - 0.981 ** 2)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(np.concatenate([x, y]))]
    rows += [(1000, [0.0] * 64, 1), (1001, None, 1), (1002, [float("nan")] * 64, 1), (1003, [None] * 64, 1), (1004, [], 1),
             (1005, [1.0, 2.0], 1), (1006, [1.0, 2.0], 1), (1007, [1.0, 2.0], None), (1008, [1.0, 2.0], 2),
             (1009, [float("inf"), 1.0], 1), (1010, [2.0, 4.0], 1), (1005, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cls", F.lit("x"))
    got = lattice.near_duplicates(df).collect()
    found = {r.vec_id: r for r in got}
    assert len(got) == len(rows) and sum(found[k].n_links > 0 for k in range(300)) >= 0.97 * 300
    assert [found[k].n_links for k in (1005, 1006, 1010)] == [3, 3, 3] and found[1010].component_id == 1005
    assert all(found[k].n_links == 0 and found[k].kept for k in (1000, 1001, 1002, 1003, 1004, 1007, 1008, 1009))
    assert lattice.near_duplicates(df.where("1 = 0")).count() == 0
    assert lattice.near_duplicates(df.where("vec_id = 1000")).count() == 1


def repeats_brute(docs, window=13):
    last, first = substring.LAST, {}
    order = [(last if i is None else i, words(t)) for i, t in docs]
    for i, w in order:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, last), i)
    out = []
    for (i, w), (shown, _) in zip(order, docs):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((shown, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def repeat_docs():
    rng = random.Random(5)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(60)] for _ in range(6)]
    docs = []
    for d in range(100):
        w = []
        for _ in range(rng.randint(0, 4)):
            b, a = rng.choice(base), rng.randrange(50)
            w += b[a:a + rng.randrange(5, 30)] + [f"u{d}_{k}" for k in range(rng.randrange(3))]
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(w + ["x"] * 40 * (d % 17 == 0))))
    return docs + [(5, docs[5][1]), (None, docs[9][1]), (7, None), (200, "é" * 50)]


@pytest.mark.parametrize("batch, piece, chunk", [(None, None, None), (150, 40, 64)])
def test_substring_matches_brute_force(spark, monkeypatch, batch, piece, chunk):
    if batch:  # many batches, long documents in pieces and texts hashed in parts
        monkeypatch.setattr(substring, "BATCH_WORDS", batch)
        monkeypatch.setattr(substring, "PIECE", piece)
        monkeypatch.setattr(substring, "CHUNK", chunk)
    docs = repeat_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup(df).collect()), key=str)
    assert got == repeats_brute(docs)


def test_substring_query(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in queries.op7_substring_dedup(spark, SF_SMALL).collect()), key=str)
    want = [(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in repeats_brute(docs)]
    assert got == sorted(want, key=str)


def test_substring_edges(spark):
    docs = edge_docs(spark)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup(docs).collect()), key=str)
    assert got == repeats_brute([(r.doc_id, r.text) for r in docs.collect()])
    assert substring.dedup(no_docs(spark)).count() == 0


def test_packed_arrays_round_trip():
    at = np.array([3, 4, 5, 9, 11, 12], np.int64)
    assert substring.unstretched(substring.stretches(at)).tolist() == at.tolist()
    x = np.random.default_rng(0).integers(0, 1 << 62, 100, dtype=np.uint64)
    assert (substring.unplanes([substring.planes(x[:40]), substring.planes(x[40:])], "<u8") == x).all()
    assert pa.__version__


def test_pipeline_stages_on_edges(spark, tmp_path):
    labels = spark.createDataFrame([(k, int(k % 2 == 0), 0) for k in range(12)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "best-fit packing":
                assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
            out.count()
    assert corpus_pipeline.STAGES[0][1](spark, no_docs(spark), str(tmp_path)).count() == 0


def test_pipeline_takes_every_decision(spark):
    docs, kept = read(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = common.written(stage(spark, docs, SF_SMALL), "stage")
        kept[name] = docs.collect()
    scored = {r.doc_id: r.predicted for r in queries.op3_quality_attention(spark, SF_SMALL).collect()}
    assert {r.doc_id for r in kept["quality classifier"]} == {i for i, p in scored.items() if p}
    lines_left = [x.strip() for r in kept["line dedup"] for x in r.text.split("\n") if len(x.strip()) >= 20]
    assert len(lines_left) == len(set(lines_left))
    assert all(r.n_chars == len(r.text) for r in kept["line dedup"])
    prints = [fingerprint(r.text) for r in kept["SimHash near-dedup"]]
    assert len(set(prints)) == len(prints)
    assert {r.doc_id for r in kept["mixing sources to target weights"]} <= {r.doc_id for r in kept["SimHash near-dedup"]}
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
