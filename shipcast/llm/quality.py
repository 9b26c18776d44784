"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes that cover its whole text.
Every passage is encoded from its bytes: shares of byte classes, how many
hashed byte triplets occur and how evenly, the largest share of bytes that repeat
at one distance, and shares of hashed byte pairs.  A
learned layer turns that into a vector, gated attention (tanh times sigmoid)
weighs the document's passages, and the weighted mean of their vectors is
scored.  Only document labels are learned from; where in a document the junk
lies, the attention has to find.

Learning is on at most ``SAMPLE`` labelled documents and ``PASSAGES`` passages:
those with the smallest hash of doc_id, whole documents, without those of more
than a fiftieth of the passages.  Their encoded passages (about 80 numbers each)
come to the driver; the model (a few thousand numbers) goes to every task, which scores
texts row by row without a shuffle.  Same rows, same model.

Null and empty texts are one passage of zeros.  With labels of one class only,
or none, every score is the share (n1 + 1) / (n + 1), so that nothing is
rejected without evidence.  Rows are scored one by one, and a score (to nine
decimals) depends on its text and the model alone, whatever rows stand beside
it: repeats get equal scores, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast.llm.common import discard, written

PASSAGE = 512
#: Bytes encoded at a time (a multiple of PASSAGE): bounds a task's memory.
CHUNK = PASSAGE * 2048
SAMPLE, PASSAGES = 4000, 200_000
THRESHOLD = 0.7
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, DECAY = 24, 16, 30, 128, 0.01, 1e-3
TRIPLES, PAIRS = 256, 64
LAGS = range(2, 21)
#: Added to a passage's length, so that few bytes make no extreme shares.
SHORT = 64

CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!?",
           b"|", b"#$%&*@^~", b"<>[]{}()/\\=_", b"'\"`;:-+", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0)))
WIDTH = len(CLASSES) + 1 + 3 + PAIRS


def class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.int64)
    for k, members in enumerate(CLASSES):
        table[np.frombuffer(members, np.uint8)] = k
    return table


def _encode(data: np.ndarray, bag: np.ndarray, at: np.ndarray, bags: int) -> np.ndarray:
    """Features of passages; ``bag`` has the passage of each byte, ``at`` its place
    there.  Pairs, triplets and repeats count only within a passage, so that a
    passage's features do not depend on what lies beside it."""
    n = np.bincount(bag, minlength=bags).astype(np.float32)[:, None]

    def table(which: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(of * width + which, minlength=bags * width).reshape(bags, width).astype(np.float32)

    kinds = table(class_table()[data], bag, len(CLASSES) + 1) / (n + 1)
    wide = data.astype(np.uint32)
    two = (wide[:-1] * np.uint32(0x9E3779B1) + wide[1:] * np.uint32(0x85EBCA77)) if len(data) > 1 else wide[:0]
    three = (two[:-1] + wide[2:] * np.uint32(0xC2B2AE3D)) if len(data) > 2 else wide[:0]
    whole2, whole3 = at[1:] >= 1, at[2:] >= 2
    two, three = two[whole2], three[whole3]
    pairs = table((two ^ two >> np.uint32(16)) * np.uint32(0x2C1B3C6D) >> np.uint32(26), bag[1:][whole2], PAIRS) / (n + SHORT)
    triples = table((three ^ three >> np.uint32(16)) * np.uint32(0x2C1B3C6D) >> np.uint32(24), bag[2:][whole3], TRIPLES)
    # The largest share of bytes that repeat at one distance: words said over and over.
    again = np.zeros((bags, 1), np.float32)
    for lag in LAGS:
        same = np.bincount(bag[lag:][(data[lag:] == data[:-lag]) & (at[lag:] >= lag)], minlength=bags).astype(np.float32)[:, None]
        again = np.maximum(again, same / (n + SHORT))
    spread = np.stack([(triples > 0).mean(1), np.square(triples / (n + SHORT)).sum(1)], 1)
    return np.concatenate([kinds, spread, again, pairs], 1).astype(np.float32)


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and how many each text has."""
    sizes, parts, held, bytes_held = np.zeros(len(texts), np.int64), [], [], 0

    def flush() -> None:
        nonlocal bytes_held
        if held:
            counts = [max(1, -(-len(r) // PASSAGE)) for r in held]
            base = np.cumsum([0, *counts])
            bag = np.concatenate([b + np.arange(len(r)) // PASSAGE for b, r in zip(base, held)]).astype(np.int64)
            at = np.concatenate([np.arange(len(r)) % PASSAGE for r in held]).astype(np.int16)
            parts.append(_encode(np.frombuffer(b"".join(held), np.uint8), bag, at, int(base[-1])))
            held.clear()
            bytes_held = 0

    for i, t in enumerate(texts):
        r = (t or "").encode("utf-8", "replace")
        sizes[i] = max(1, -(-len(r) // PASSAGE))
        for begin in range(0, max(1, len(r)), CHUNK):
            held.append(r[begin:begin + CHUNK])
            bytes_held += len(held[-1])
            if bytes_held >= CHUNK:
                flush()
    flush()
    return (np.concatenate(parts) if parts else np.zeros((0, WIDTH), np.float32)), sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scaled(model: dict, x: np.ndarray) -> np.ndarray:
    return np.clip((x - model["mean"]) / model["std"], -4, 4)


def forward(model: dict, x: np.ndarray, sizes: np.ndarray) -> dict:
    starts = np.cumsum(sizes) - sizes
    seg = np.repeat(np.arange(len(sizes)), sizes)
    h = np.tanh(scaled(model, x) @ model["W"] + model["b"])
    t, s = np.tanh(h @ model["V"]), sigmoid(h @ model["U"])
    e = (t * s) @ model["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[seg])
    a = e / np.add.reduceat(e, starts)[seg]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": sigmoid(z @ model["c"] + model["d"][0]), "seg": seg, "starts": starts}


def gradients(model: dict, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict:
    f = forward(model, x, sizes)
    h, t, s, a, seg = f["h"], f["t"], f["s"], f["a"], f["seg"]
    do = (f["p"] - y) / len(y)
    dz = (do[:, None] * model["c"])[seg]
    da = (dz * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, f["starts"])[seg])
    dg = de[:, None] * model["w"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ model["V"].T + ds @ model["U"].T) * (1 - h * h)
    return {"W": scaled(model, x).T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds,
            "w": (t * s).T @ de, "c": f["z"].T @ do, "d": np.array([do.sum()])}


def train(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 11) -> dict:
    """Adam on mini-batches of documents."""
    rng = np.random.default_rng(seed)
    shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION),
             "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    model = {k: rng.normal(0, 1 / np.sqrt(v[0]), v) if k not in "bd" else np.zeros(v) for k, v in shape.items()}
    model |= {"mean": x.mean(0).astype(float), "std": x.std(0).astype(float) + 1e-3}
    moment = {k: (np.zeros(v), np.zeros(v)) for k, v in shape.items()}
    starts, step = np.cumsum(sizes) - sizes, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for begin in range(0, len(order), BATCH):
            docs = order[begin:begin + BATCH]
            rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in docs])
            step += 1
            for k, g in gradients(model, x[rows], sizes[docs], y[docs]).items():
                g = g + DECAY * model[k]
                m, v = moment[k] = (0.9 * moment[k][0] + 0.1 * g, 0.999 * moment[k][1] + 0.001 * g * g)
                model[k] -= RATE * (1 - epoch / EPOCHS) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out() -> Column:
    """Rows that learning never sees: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = PASSAGES) -> dict:
    """The model, from at most ``sample`` labelled documents outside the held-out part
    and at most ``most`` passages of them."""
    order = F.xxhash64("doc_id")
    chosen = (labels.where(~held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .select("doc_id", F.col("quality").cast("int").alias("y")).dropDuplicates(["doc_id"])
              .orderBy(order, "doc_id").limit(sample))

    def passages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            x, sizes = encode(rb.column("text").to_pylist())
            edges = np.cumsum([0, *sizes])
            cells = [x[a:b].tobytes() for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), rb.column("y"), pa.array(sizes, pa.int64()), pa.array(cells, pa.binary())],
                ["doc_id", "y", "n", "x"])

    # The sample is bounded by the parameter, so every task may hold it.
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= most // 50 * PASSAGE
    encoded = written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(short)
                      .join(F.broadcast(chosen.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
                      .select("doc_id", "y", "text").mapInArrow(passages, "doc_id long, y int, n long, x binary"), "quality")
    first = encoded.withColumn("h", order).orderBy("h", "doc_id", F.xxhash64("x")).limit(sample)  # doc_ids may repeat
    upto = F.sum("n").over(Window.orderBy("h", "doc_id", F.xxhash64("x")).rowsBetween(Window.unboundedPreceding, 0))
    rows = first.withColumn("upto", upto).where(F.col("upto") <= most).select("doc_id", "y", "x").collect()
    discard(encoded)
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    y = np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        return {"share": (y.sum() + 1) / (len(y) + 1)}
    cells = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in rows]
    return train(np.concatenate(cells), np.array([len(c) for c in cells]), y)


def score(model: dict):
    """A column function from text to a score between 0 and 1."""
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if "share" in model or not len(texts):
            return pd.Series(np.full(len(texts), model.get("share", 0.0)))
        x, sizes = encode(list(texts))
        # Products may round differently by the number of rows; nine decimals do not show it.
        return pd.Series(forward(model, x, sizes)["p"].round(9))

    return of


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``_q_score``."""
    return docs.withColumn("_q_score", score(fit(docs, labels, sample))(F.col("text").cast("string")))
