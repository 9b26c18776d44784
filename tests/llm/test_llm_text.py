import hashlib
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from llm_cases import edge_docs, no_docs, words
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shipcast.llm import digest, licenses, lines, pii, quality, queries
from shipcast.llm.common import read

BLANK = lines.BLANK


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def line_brute(docs):
    """Rows in order of doc_id and of ``tie``, the text's hash; equal rows are one."""
    seen, out = {}, []
    for i, text, tie in docs:
        for no, raw in enumerate((text or "").split("\n")):
            seen.setdefault(raw.strip(BLANK), []).append((i is None, i or 0, tie, no))
    first = {line: min(at) for line, at in seen.items() if line}
    for i, text, tie in docs:
        kept = []
        for no, raw in enumerate((text or "").split("\n")):
            line, me = raw.strip(BLANK), (i is None, i or 0, tie, no)
            near = any(at < me and (x == line or (len(x) >= 20 <= len(line) and one_edit(x, line))) for x, at in first.items())
            if not line or not near:
                kept.append(raw)
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def tied(docs):
    """(doc_id, text, hash of the text) of every row."""
    return [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abé ") for _ in range(rng.choice([19, 20, 21, 63, 64, 65, 66, 128, 129, 130]))) for _ in range(20)]
    docs = []
    for d in range(90):
        out = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(base)
            if rng.random() < 0.6:
                p, c = rng.randrange(len(x) + 1), rng.choice("abé")
                x = rng.choice([x[:p] + c + x[p:], x[:p] + x[p + 1:], x[:p] + c + x[p + 1:]])
            out.append(rng.choice(["", "  ", "\t"]) + x if rng.random() < 0.9 else " ")
        docs.append((d, "\n".join(out)))
    for ids in (lambda d: d, lambda d: None if d % 2 else 4 if d % 5 else d):  # own ids; none or shared ones
        table = spark.createDataFrame([(ids(d), t) for d, t in docs], "doc_id long, text string")
        got = lines.dedup(table)
        assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
            (str(i), t) for i, t in line_brute(tied(table)))


def test_line_dedup_oracle(spark):
    assert compare(spark, SF_SMALL, "op4", queries.op4_line_dedup, queries.ORACLE["op4_line_dedup"], duck(SF_SMALL))


def test_line_dedup_edges(spark):
    docs = edge_docs(spark)
    got = lines.dedup(docs)
    assert got.columns == [*docs.columns, "_ln_total", "_ln_removed"]
    want = line_brute(tied(docs))
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))
    assert lines.dedup(no_docs(spark)).count() == 0


def test_digest_query(spark):
    got = {r.doc_id: r for r in queries.op5_quartile_digest(spark, SF_SMALL).collect()}
    docs = [(r.doc_id, r.text or "") for r in read(spark, SF_SMALL, "documents").orderBy(F.desc("doc_id")).collect()]
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        third = len(text) // 3
        edited, r = text[:len(text) - third] + after[:third], got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == digest.digest(text) and r.edited_fingerprint == digest.digest(edited)
        assert r.near_next == pytest.approx(digest.likeness([r.fingerprint], [digest.digest(after)])[0])
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.98


def test_digest_is_bounded_and_equal_for_equal_texts():
    rng = random.Random(2)
    prints = [digest.digest("".join(rng.choice("abc def") for _ in range(n))) for n in (0, 1, 2, 3, 10, 500, 5000)]
    assert all(0 <= v <= 1 for a in prints for v in digest.likeness([a] * len(prints), prints))
    assert digest.likeness(prints, prints).tolist() == [1.0] * len(prints)
    whole = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    small, digest.CHUNK = digest.CHUNK, 700
    try:
        chunked = digest.digest(whole)
    finally:
        digest.CHUNK = small
    assert chunked == digest.digest(whole)


def test_digest_edges(spark):
    docs = edge_docs(spark)
    rows = digest.edited(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id == 7}) == 1
    assert digest.edited(no_docs(spark)).count() == 0
    alone = docs.where("doc_id = 6")
    assert digest.edited(alone).first().near_next == 1.0


def test_next_document_where_ids_are_missing_or_shared(spark):
    rng = random.Random(6)
    docs = [(rng.choice([None, None, 7, 7, 7, -3, 12, d]), f"text {d} " + "x" * rng.randrange(9)) for d in range(400)]
    docs += [(None, None), (20, "twice"), (20, "twice")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = sorted(((i is None, -(i or 0), tie, t or "") for i, t, tie in tied(table)))
    got = digest.with_next(digest.fingerprints(table), table).collect()
    want = [(None if r[0] else -r[1], r[3], rows[(k + 1) % len(rows)][3]) for k, r in enumerate(rows)]
    assert sorted(map(str, ((r.doc_id, r.text, r.next_text) for r in got))) == sorted(map(str, want))


def test_no_task_holds_all_rows_without_id(spark):
    table = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = digest.with_next(digest.fingerprints(table), table)
        rows = got.select("text", "next_text", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == 2000 and len({r.next_text for r in rows}) == 2000
    assert max(Counter(r.task for r in rows).values()) < 1000


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    valid = {"email": lambda m, d: True, "ip": lambda m, d: all(int(p) <= 255 for p in m.split(".")),
             "card": lambda m, d: 12 <= len(d) <= 19 and luhn(d), "phone": lambda m, d: 9 <= len(d) <= 15}
    return sorted((m.start(), o, k, m.end()) for o, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text)
                  if valid[k](m.group(), re.sub("[^0-9]", "", m.group())))


PII_TEXTS = ["a@b.cc%d@e.f x", "a@b.c@d.e", "1.2.3.4.5 256.1.1.1 0001.002.3.255 1.2.3.0000000256",
             "4111 1111 1111 1111, 4111-1111-1111-1112 é4111111111111111", "+1 (988) 555-2485 +1++12 345 6789 01",
             "ñ😀 x@y.z.w. +49 89 1234567-", "...@..@a.b", "a" * 3000 + "@b.c", "1" * 20000, "x@y" + ".z" * 5000,
             "+1" + " " * 3000 + "2", "a.b@c-.d- 1.1.1.1.1.1.1.1.1", "pay to IBAN DE89370400440532013000 or DE89370400440532013001",
             "call 415-555-2671 please", "415-555-2671", "my ssn 123-45-6789", "", None]


def test_pii_spans(spark):
    docs = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    for i, text in enumerate(PII_TEXTS):
        assert [(s.start, s.order, s.kind, s.end) for s in got[i] if s.base] == base_spans(text or "")
    added = {i: [(s.kind, PII_TEXTS[i][s.start:s.end]) for s in got[i] if not s.base] for i in (12, 13, 14, 15)}
    assert added == {12: [("iban", "DE89370400440532013000")], 13: [("local_phone", "415-555-2671")], 14: [],
                     15: [("national_id", "123-45-6789")]}
    assert [s.score for s in got[4]][0] == 0.5


def test_pii_query(spark):
    texts = {r.doc_id: r.text or "" for r in read(spark, SF_SMALL, "documents").collect()}
    for r in queries.op10_pii(spark, SF_SMALL).collect():
        spans = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in spans) for k in BASE)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_pii_edges(spark):
    docs = edge_docs(spark).drop("spans")
    got = pii.find(docs)
    assert got.columns == [*docs.columns, "spans"] and got.count() == docs.count()
    assert {s.kind for r in got.where("doc_id = 11").collect() for s in r.spans} == {"email", "phone"}
    assert pii.find(no_docs(spark).drop("spans")).count() == 0


def test_licenses(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        assert scanner.score(text)[0][0] == name and scanner.score(text)[0][2:] == (0, 0)
    changed = licenses.TEMPLATES["MIT-text"].replace("merge, publish", "merge and publish")
    assert scanner.score(changed)[0][0] == "MIT-text"
    assert [x[0] for x in scanner.score("Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    assert scanner.score("The poet has a licence to dream, and no copyright on the moon.") == []
    prose = " ".join(random.Random(k).choice("sun moon star sea".split()) for k in range(3000))
    assert [x[0] for x in scanner.score(prose + " " + licenses.TEMPLATES["ISC-text"] + " " + prose)] == ["ISC-text"]


def test_wrapped_licenses_are_found_whole(spark):
    rng = random.Random(4)
    prose = [" ".join(rng.choice("sun moon star sea".split()) for _ in range(12)) for _ in range(60)]
    scanner, docs, want = licenses.Scanner(licenses.TEMPLATES), [], {}
    for name, text in licenses.TEMPLATES.items():
        for width in (20, 72):
            for prefix in ("", "# ", "//", " * ", "-- "):
                notice = [prefix + x for x in textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False)]
                want[len(docs)] = (name, 60, 59 + len(notice))
                docs.append((len(docs), "\n".join(prose + notice + prose)))
    got = {}
    for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        if r.license == want[r.doc_id][0]:
            got[r.doc_id] = (r.license, r.first_line, r.last_line)
            assert (r.n_missing, r.n_extra) == (0, 0)
    assert got == want
    # Two notices near each other, the first one changed, are two blocks.
    isc = licenses.TEMPLATES["ISC-text"]
    changed = textwrap.wrap(isc.replace("any purpose", "any good purpose"), 72)
    twice = "\n".join([*changed, "", "", "", "", *textwrap.wrap(isc, 72)])
    assert [(a, b, hits[0][0], hits[0][2:]) for a, b, _, hits in scanner.blocks(twice)] \
        == [(0, 2, "ISC-text", (0, 1)), (7, 9, "ISC-text", (0, 0))]
    assert scanner.score(licenses.TEMPLATES["MIT"].upper())[0][0] == "MIT"


def every_place(scanner, words):
    """Wording alone, over a whole window and every template."""
    out = []
    for name, template in scanner.words.items():
        found, n = set(), len(template)
        for begin in range(0, max(1, len(words) - n + 1), n):
            found |= licenses.place_in(words, template, begin, begin + max(8, 3 * n))
        out += [(name, *x) for x in licenses.apart(sorted(found))
                if scanner.saved(" ".join(words[x[2]:x[3] + 1]), name) >= licenses.MIN_REDUCTION]
    return sorted(out)


def test_compression_proposes_what_wording_confirms_in_every_window(spark):
    scanner, asked, proposed, confirmed = licenses.Scanner(licenses.TEMPLATES), 0, 0, 0
    for r in read(spark, SF_SMALL, "documents").collect():
        for window in licenses.windows(r.text or "", scanner.reach):
            words = [w for w, _, _ in window]
            places = sorted(scanner.search(" ".join(words)))
            assert places == every_place(scanner, words)
            asked += sum(1 for t in scanner.words.values() for _ in licenses.parts(words, t))
            proposed += len(scanner.candidates(words))
            confirmed += len(places)
    assert confirmed > 0 and proposed < asked / 2


def test_compression_rejects_and_ranks():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    prose = licenses.wording("the harbour was licensed to sell salt and rope to any ship that came in from the sea that year")
    assert list(licenses.parts(prose, scanner.words["CC-BY-4.0"])) and scanner.candidates(prose) == []
    block = licenses.TEMPLATES["GPL-text"]
    ranked = list(dict.fromkeys(name for _, name, _, _ in scanner.candidates(licenses.wording(block))))
    assert ranked[0] == "GPL-text" and len(ranked) > 1  # its relatives save less
    assert scanner.score(block)[0][0] == "GPL-text"


def test_license_query_finds_every_notice(spark):
    rows = queries.op9_license_scan(spark, SF_SMALL).where("rank = 1").collect()
    docs = read(spark, SF_SMALL, "documents").collect()
    for name, text in licenses.TEMPLATES.items():
        want = {d.doc_id for d in docs if d.text and any(x.strip() == text for x in d.text.split("\n"))}
        assert want <= {r.doc_id for r in rows if r.license == name}


def test_license_edges(spark):
    docs = edge_docs(spark)
    assert licenses.scan(docs).count() == 0 and licenses.scan(no_docs(spark)).count() == 0
    twice = spark.createDataFrame([(None, "MIT\n\nReleased under the MIT License.\nend")] * 2, "doc_id long, text string")
    assert [(r.doc_id, r.first_line, r.last_line, r.license) for r in licenses.scan(twice).collect()] == [(None, 2, 2, "MIT")] * 2


def test_quality_gradients():
    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(7, quality.WIDTH)), np.array([2, 1, 4]), np.array([1.0, 0, 1])
    shape = {"W": (quality.WIDTH, 5), "b": (5,), "V": (5, 3), "U": (5, 3), "w": (3,), "c": (5,), "d": (1,)}
    model = {k: rng.normal(size=s) * 0.3 for k, s in shape.items()} | {"mean": np.zeros(quality.WIDTH), "std": np.ones(quality.WIDTH)}

    def loss():
        p = quality.forward(model, x, sizes)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = quality.gradients(model, x, sizes, y)
    for k in shape:
        at = tuple(rng.integers(0, n) for n in shape[k])
        model[k][at] += 1e-5
        up = loss()
        model[k][at] -= 2e-5
        down = loss()
        model[k][at] += 1e-5
        assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_on_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = {r.doc_id: r for r in queries.op3_quality_attention(spark, sf).collect()}
    labels = read(spark, sf, "labels").collect()
    held = [(scored[r.doc_id].predicted, r.quality) for r in labels if scored[r.doc_id].held_out]
    assert len(held) > 500 and np.mean([p == q for p, q in held]) > 0.97
    assert np.mean([p for p, q in held if q == 1]) > 0.98


def test_quality_scores_depend_on_the_text_alone(spark):
    docs, labels = read(spark, SF_SMALL, "documents").select("doc_id", "text"), read(spark, SF_SMALL, "labels")
    model = quality.fit(docs, labels)
    again = quality.fit(docs.repartition(5).orderBy(F.rand(1)), labels)
    assert all(np.array_equal(model[k], again[k]) for k in model)
    texts = docs.unionByName(docs.where("doc_id % 5 = 0")).unionByName(spark.createDataFrame(
        [(-1, "x"), (-2, "é" * 700), (-3, None), (-4, "x"), (-5, "word " * 300)], docs.schema))

    def scores(df):
        out = {}
        for r in df.withColumn("p", quality.score(model)(F.col("text"))).collect():
            assert out.setdefault(r.text, r.p) == r.p  # equal texts, equal scores
        return out

    first = scores(texts.coalesce(1))
    assert first == scores(texts.repartition(7)) == scores(texts.orderBy(F.desc("doc_id")))
    alone = {t: float(quality.forward(model, *quality.encode([t]))["p"][0].round(9)) for t in list(first)[:40]}
    assert alone == {t: first[t] for t in alone}
    few = quality.fit(docs, labels, most=150)  # the bound in passages, in whole documents
    assert "share" in few or not np.array_equal(few["W"], model["W"])


def test_quality_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (6, 1, 0), (9, None, 0), (None, 1, 0), (7, 1, 0), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels)
    assert got.columns == [*docs.columns, "_q_score"] and got.count() == docs.count()
    assert all(0 <= r._q_score <= 1 for r in got.collect())
    alone = quality.classify(docs, labels.where("1 = 0"))
    assert {r._q_score for r in alone.collect()} == {1.0}
    assert quality.classify(no_docs(spark), labels).count() == 0
    assert quality.encode(["", None, "x" * (quality.CHUNK + 5)])[1].tolist() == [1, 1, quality.CHUNK // quality.PASSAGE + 1]
    assert words("a\tb") == ["a", "b"]
