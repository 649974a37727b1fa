import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import types as T

from valuemill.llm import prefix_trie, turns

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def tie(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, tie(role, text), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(members[n]) - 1) * words[n]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(n)).encode()).hexdigest()) for n, m in members.items())


def run(df):
    rows = prefix_trie.prefix_trie(prefix_trie.rebuilt(df)).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows)


def conversations():
    rng, rows = random.Random(5), []
    for c in [*range(0, 70), 100, 103, 107, 119, 241]:  # 100: its block's first is here; 241: it is not
        n = rng.choice([1, 1, 2, 3, 4, 6]) if c not in (20, 41, 63) else rng.choice([70, 64, 97])
        for t in range(n):
            turn = None if t == 0 and c % 7 == 0 else t
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a b", "a  b\tc", "İ x", "w " * 50])))
    rows += [(c, t, "user", f"same turn {t}") for c in (200, 205, 208, 213) for t in range(80)]
    rows += [(30, 2, "user", "tied"), (30, 2, "user", "tied"), (30, 2, "user", "other"), (None, 0, "user", "no id")]
    return rows


def test_against_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert run(df.repartition(5)) == want
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # every few rows are a matrix of their own
    try:
        assert run(df) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table_turnless_and_clashing_columns(spark):
    df = spark.createDataFrame([(5, 0, "user", "x y")], SCHEMA)  # crc32("5") % 4 is 1, and conversation 0 is absent: no turn is left
    assert zlib.crc32(b"5") % 4 > 0 and run(df) == brute([(5, 0, "user", "x y")])
    assert run(df)[0][:4] == (5, 0, -1, 1)
    assert run(df.where("false")) == []
    more = df.selectExpr("*", "1 as conv", "2 as depth", "3 as digest", "'x' as pos", "4 as seg")
    assert run(more) == run(df)


def test_matrix_counts_every_depth():
    cells = np.array([[1, 1, 2], [5, 5, 1], [1, 1, 2], [5, 5, 1], [9, 9, 4], [1, 1, 2]], np.int64)
    out = prefix_trie._partials(np.array([7, 3, 5]), np.zeros(3, np.int64), np.zeros((3, 2), np.int64), np.array([2, 3, 1]), cells, np.array([[1, 0], [2, 1], [4, 0]]))
    rows = {(d, n, c, t, leaves) for d, n, c, t, leaves in zip(out[0], out[5], out[6], out[8], out[9], strict=True)}
    assert rows == {(0, 3, 3, 7, 1), (1, 3, 3, 7, 1), (2, 2, 3, 3, 1), (3, 1, 3, 2, 1)}


def test_places_of_a_large_conversation_come_from_its_pieces(spark):
    rows = spark.range(4000).selectExpr("if(id < 3000, 1, id) as conv", "(id * 37) % 5000 as turn")
    placed = turns.Placed(rows, "conv", ["turn"], "test-turns")
    assert placed.rows.where("conv = 1").select("piece").distinct().count() > 1
    got = [r.turn for r in placed.positioned().where("conv = 1").orderBy("pos").collect()]
    assert got == sorted(got) and placed.positioned().where("conv = 1").agg({"pos": "max"}).first()[0] == 2999


def test_running_sums_in_two_levels(spark):
    rows = spark.range(3000).selectExpr("id % 2 as k", "id as i", "id * 3 as v")
    got = {r.i: r.before for r in turns.running(rows, ["k"], "i", {"v": "before"}).collect()}
    sums = [0, 0]
    for i in range(3000):
        assert got[i] == sums[i % 2]
        sums[i % 2] += 3 * i
