"""Small tables and plain-Python versions of the operators."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import types as T

SPACE = " \t\n\x0b\f\r"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
UPPER = {c: c + 32 for c in range(65, 91)}


def documents(spark, texts, extra=()):
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", ".", ","]) for _ in range(words))


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(rows):
    """{id: (set size, component)} of (id, text) rows, every pair compared."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10_000)}" for w in text.split(" "))


ODD = [None, "", "   ", "\n\n", "a", "A\tb\x0bc", "x" * 70_000, "é ß İ ŋ 日本語 🎉‍ end", "same words here once more", "same words here once more", "\x1c \x85  nb"]
