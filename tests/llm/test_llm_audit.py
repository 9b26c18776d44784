import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import edge_docs, no_docs
from pyspark.sql import functions as F

from shipcast.llm import divergence, merkle, queries, sharding


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(leaves, arity):
    """(root, [siblings of leaf i, run by run, as (before, after)])."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, k in enumerate(at):
            begin = k - k % arity
            proofs[i].append(("".join(level[begin:k]), "".join(level[k + 1:begin + arity])))
            at[i] = k // arity
        level = [H(*level[k:k + arity]) for k in range(0, len(level), arity)]
    return level[0], proofs


def expected_manifest(rows, arity, changed):
    by = defaultdict(list)
    for r in rows:
        leaf = H(*[framed(r[c]) for c in merkle.FIELDS])
        seen = leaf
        if changed(r) and r["n_chars"] is not None:
            seen = H(*[framed(r[c] + (c == "n_chars") if c == "n_chars" else r[c]) for c in merkle.FIELDS])
        by[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, seen))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    subroots = {}
    for lang in langs:
        by[lang].sort()
        subroots[lang] = tree_of([x[2] for x in by[lang]], arity)
    root, over = tree_of([subroots[x][0] for x in langs], arity) if langs else (None, [])
    out = []
    for lang, above in zip(langs, over):
        for (known, doc_id, leaf, seen), proof in zip(by[lang], subroots[lang][1]):
            steps, at = proof + above, seen
            for before, after in steps:
                at = H(before, at, after)
            out.append((doc_id if known else None, leaf, subroots[lang][0], root,
                        H(*[x for s in steps for x in s]), at, at == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_equals_plain_trees(spark, arity):
    rng = random.Random(arity)
    rows = [(rng.randrange(60) if k % 17 else None, rng.choice("abc") if k % 5 else None,
             rng.choice(["en", "de", "éé", None]) if k else "one", rng.randrange(9) if k % 4 else None,
             rng.choice(["x", "ñandú", "", None])) for k in range(50)] + [(5, "a", "en", 3, "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    changed = F.col("doc_id") % 3 == 0
    made = merkle.documents_manifest(docs, changed, arity)
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], H(r["t"]), r["folded_root"], r["verified"])
           for r in made.withColumn("t", merkle.proof_text(F.col("proof"))).collect()]
    want = expected_manifest([r.asDict() for r in docs.collect()], arity,
                             lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)
    assert sorted(got, key=repr) == want
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_edges_one_group_one_row_and_nothing(spark):
    docs = edge_docs(spark)
    got = merkle.documents_manifest(docs, F.lit(False)).collect()
    want = expected_manifest([r.asDict() for r in docs.collect()], 2, lambda r: False)
    assert sorted((r["doc_id"], r["leaf"], r["root"]) for r in got if r["doc_id"] is not None) == sorted(
        (w[0], w[1], w[3]) for w in want if w[0] is not None)
    assert len(got) == docs.count() and all(r["verified"] for r in got)
    one = docs.where("doc_id = 1").withColumn("lang", F.lit("en"))
    rows = merkle.documents_manifest(one, F.lit(False)).collect()
    assert len(rows) == 1 and rows[0]["verified"] and rows[0]["root"] == rows[0]["leaf"] and rows[0]["proof"] == []
    assert merkle.documents_manifest(no_docs(spark), F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(docs, "lang", "doc_id", 1)


TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def plain_audit(rows, least, top):
    """rows: (lang, source, text)."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", plain_terms(text)
        groups[lang].add(source)
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)}
    return out


def audit_rows(df):
    return [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]


def test_packed_counts_equal_plain_counts_for_every_length():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abYZéß漢😀") for _ in range(n)) for n in (*range(1, 20), 40, 200, 5000) for _ in range(3)]
    texts = ["", "...", *[rng.choice([" ", "-", "3"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))
                          for _ in range(40)]]
    groups = np.sort(np.array([rng.randrange(3) for _ in texts]))
    parts = [t.encode() for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
    n, docs = Counter(), Counter()
    for terms, group, count, held in divergence._count(np.frombuffer(b"".join(parts), np.uint8), begins, groups):
        for t, g, a, b in zip(terms.tolist(), group.tolist(), count.tolist(), held.tolist()):
            assert (t, g) not in n
            n[t, g], docs[t, g] = a, b
    want_n, want_docs = Counter(), Counter()
    for text, g in zip(texts, groups.tolist()):
        terms = [t.encode() for t in plain_terms(text)]
        want_n.update((t, g) for t in terms)
        want_docs.update((t, g) for t in set(terms))
    assert n == want_n and docs == want_docs


def test_radix_order_is_stable_and_sorted():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(60), rng.integers(0, 1 << 63, 500).astype(np.uint64) % np.uint64(7)]
    assert (divergence.radix_order(words) == np.lexsort((np.arange(500), words[1], words[0]))).all()


def test_audit_equals_plain_counting_in_one_cell_and_in_many(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{'abcdefghij'[k % 10]}{'xyzäöü'[k % 6] * (1 + k % 11)}" for k in range(60)]
    rows = [(rng.choice(["en", "de", None]), f"s{rng.randrange(7)}" if k % 11 else None,
             " ".join(rng.choice(vocabulary[:40 + k % 20]) for _ in range(rng.randrange(0, 40))) if k % 13 else None)
            for k in range(300)] + [("fr", "only", "mot"), ("it", "a", None), ("it", "b", "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "lang string, source string, text string, value int")
    want = plain_audit(rows, 5, 6)
    assert len(want) > 100
    for terms, sources in ((1024, 128), (7, 2)):
        monkeypatch.setattr(divergence, "CELL_TERMS", terms)
        monkeypatch.setattr(divergence, "CELL_SOURCES", sources)
        got = audit_rows(divergence.audit(docs.repartition(5), least_docs=5, top=6))
        assert len(got) == len(want) and set(got) == want


def test_audit_of_long_texts_and_edges(spark, monkeypatch):
    rows = [(r["lang"], r["source"], r["text"]) for r in edge_docs(spark).collect()]
    want = plain_audit(rows, 1, 50)
    got = audit_rows(divergence.audit(edge_docs(spark), least_docs=1))
    assert len(got) == len(want) and set(got) == want
    assert audit_rows(divergence.audit(no_docs(spark))) == []
    text = " ".join(random.Random(2).choice(["alpha", "Beta", "x" * 30, "é" * 9]) for _ in range(400))
    monkeypatch.setattr(divergence, "CHUNK", 64)
    pieces = list(divergence._pieces(text.encode()))
    assert b"".join(pieces) == text.encode() and len(pieces) > 20
    table = divergence._count_batches
    import pyarrow as pa
    batch = pa.record_batch({"lang": ["en", "en"], "source": ["a", "a"], "text": [text, "alpha"]})
    n, held = Counter(), Counter()
    for rb in table([batch]):
        for r in rb.to_pylist():
            n[r["term"]] += r["n"]
            held[r["term"]] += r["docs"]
    assert n == Counter(plain_terms(text) + ["alpha"])
    assert held == Counter([*set(plain_terms(text)), "alpha"])


def check_shards(rows, shards, largest_slack):
    by, bytes_of = defaultdict(list), [0] * shards
    for r in rows:
        by[r["shard"]].append(r["slot"])
        bytes_of[r["shard"]] += r["size"]
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    assert max(bytes_of) - min(bytes_of) <= largest_slack
    return bytes_of


def test_shards_are_even_and_keep_equal_texts_together(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(999)}" for _ in range(rng.choice([3, 30, 300]))) for _ in range(900)]
    texts += [texts[k % 40] for k in range(300)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, shard int")
    rows = sharding.shard(docs, shards=8).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    held = defaultdict(set)
    for r in rows:
        held[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in held.values())
    check_shards(rows, 8, 2 * max(r["size"] for r in rows))
    again = sharding.shard(docs.repartition(3), shards=8).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_a_group_beyond_a_shard_is_split_and_repeated_rows_too(spark):
    other = [(k, f"text number {k} " * 20) for k in range(2000)]
    for hot in ([(10000 + k, "the same text " * 30) for k in range(3000)], [(7, "the same row " * 30)] * 3000):
        rows = sharding.shard(spark.createDataFrame(other + hot, "doc_id long, text string"), shards=6).collect()
        assert len(rows) == 5000
        check_shards(rows, 6, 2 * max(r["size"] for r in rows) + sum(r["size"] for r in rows) // (6 * 32))
        assert len({r["shard"] for r in rows if r["doc_id"] in (7, *range(10000, 13000))}) >= 4


def test_one_giant_document_and_edges(spark):
    docs = edge_docs(spark)
    rows = sharding.shard(docs, shards=3).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    check_shards(rows, 3, max(r["size"] for r in rows))
    assert sharding.shard(no_docs(spark)).collect() == []
    got = queries.op13_sampled_sharding
    assert got.__name__ in queries.QUERIES
