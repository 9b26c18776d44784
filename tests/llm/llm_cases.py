"""Inputs and plain-Python counterparts shared by the tests of the training-data operators."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: Documents with extra columns whose names the operators use inside.
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "length long, number int, bucket int, g long, id long, fp long, spans string, piece string, "
               "_x double, size long, label string, places string, position double, kept boolean, score double")


def words(text):
    return WORDS.findall(text or "")


def edge_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    rng = random.Random(9)
    long_text = " ".join(rng.choice("alpha beta gamma delta épsilon".split()) + str(rng.randrange(50))
                         for _ in range(30000))
    line = "a line of prose that is long enough to be compared with others"
    texts = [(1, ""), (2, None), (3, " \t\n "), (4, long_text), (5, "x" * 50000), (6, line + "\n" + line),
             (7, line), (7, line), (8, line.replace("prose", "prosa")), (None, line), (None, None), (9, "one"),
             (10, "\n\n\n"), (11, "<|endoftext|> ñandú 漢字 😀 mail a.b@c.example +1 (988) 555-2485")]
    extra = (None, 1, 2, 3, 4, 5, "s", "p", 0.5, 7, None, "q", 1.5, True, 0.1)
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t), *extra)
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def components_of(ids, linked):
    """Smallest id reachable; ``linked`` yields pairs of positions."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        parent[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return [least[find(k)] for k in range(len(ids))]
