"""Prefix trie of conversations from padded turn-id matrices.

Conversations are cut into segments of ``SEGMENT`` turns, each with a key of all that comes before it, and dealt over range
shards by their turns. An Arrow batch of a shard is a matrix of turn ids, a row for each segment, padded with -1: numpy sorts
its rows, OR-accumulated change masks of the columns mark where nodes start, ``reduceat`` aggregates every depth. A node that
lies across shards or batches has a partial row in each; these recombine by the node's key in one grouped aggregate.

Keys are two 64-bit lanes, the XOR of hashes of (depth, turn) over the turns so far, so a key is found at any depth
without walking down to it, and the segments of a very long conversation are worked on apart.

A node's smallest member names it. The nodes of one name form a path (a smallest member stays smallest further down), so sums
over subtrees are sums over members: each conversation brings what its own path holds, less what lies above the node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemill.llm.turns import Placed, running
from valuemill.session import materialize

SEGMENT = 32
#: Leading turns of a segment that its range shard is chosen by.
SHARD_TURNS = 4
_WORDS = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "ka", "kb"]


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """(conv, depth, digest, words): conversation c as the first h turns of conversation c - c % block, then its own after its first h.

    h = crc32(c as text) % heads. Turns go by ``turn``, nulls first, equal ones by digest; a null role or text is empty; depth
    counts from 1, and each conversation has a row of depth 0 without a turn. Rows without a conv_id take no part.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words"))
    placed = Placed(turns, "conv", [F.col("turn").asc_nulls_first(), F.col("digest")], "turns")
    first = materialize(placed.positioned().where(F.col("pos") < max(heads - 1, 1)).groupBy("conv")
                        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head")), "first-turns")
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(heads)).cast("int")
    base = first.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    convs = first.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("of")).join(base, F.col("of") == F.col("base"), "left")
    convs = convs.select("conv", "h", F.slice(F.coalesce("base_head", F.array().cast(first.schema["head"].dataType)), 1, F.col("h")).alias("prefix"))
    convs = materialize(convs, "rebuilt-heads")
    own = placed.positioned(convs.select(F.col("conv").alias("of"), "h", F.size("prefix").alias("b")), "of").where("pos >= h")
    lead = convs.select("conv", F.explode("prefix").alias("t")).select("conv", (F.col("t.pos") + 1).alias("depth"), "t.digest", "t.words")
    none = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("words"))
    return lead.unionByName(own.select("conv", (F.col("pos") - F.col("h") + F.col("b") + 1).alias("depth"), "digest", "words")).unionByName(none)


def _segments(turns: DataFrame) -> DataFrame:
    """(conv, seg, cells, pa, pb, xa, xb, last): ``cells`` are the turns (a, b, words) of a segment, (pa, pb) the key of what comes before it."""
    cell = F.struct("depth", F.xxhash64(F.lit(1), "depth", "digest").alias("a"), F.xxhash64(F.lit(2), "depth", "digest").alias("b"), "words")
    cells = turns.select("conv", F.floor((F.greatest("depth", F.lit(1)) - 1) / SEGMENT).alias("seg"), F.when(F.col("depth") > 0, cell).alias("cell"))
    segs = materialize(cells.groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list("cell")).alias("cells"),
        F.coalesce(F.bit_xor("cell.a"), F.lit(0)).alias("xa"), F.coalesce(F.bit_xor("cell.b"), F.lit(0)).alias("xb")), "segments")
    long = segs.where((F.col("seg") > 0) | (F.size("cells") == SEGMENT)).select("conv", "seg", "xa", "xb")
    before = running(long, ["conv"], "seg", {"xa": "pa", "xb": "pb"}, F.bit_xor).where("seg > 0").select(F.col("conv").alias("c1"), F.col("seg").alias("s1"), "pa", "pb")
    more = long.where("seg > 0").select(F.col("conv").alias("c2"), (F.col("seg") - 1).alias("s2"))
    rows = (segs.join(before, (F.col("conv") == F.col("c1")) & (F.col("seg") == F.col("s1")), "left")
            .join(more, (F.col("conv") == F.col("c2")) & (F.col("seg") == F.col("s2")), "left"))
    return materialize(rows.select("conv", "seg", "cells", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("pa", "pb")], "xa", "xb", F.col("c2").isNull().alias("last")), "segments")


def _ids(*lanes: np.ndarray) -> np.ndarray:
    """Small integers, equal where all lanes are."""
    rows = np.ascontiguousarray(np.stack(lanes, 1)).view(np.uint8)
    packed = pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)])
    return packed.dictionary_encode().indices.to_numpy()


_PARTIAL = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("pa", pa.int64()), ("pb", pa.int64()),
                      ("n", pa.int64()), ("conv", pa.int64()), ("words", pa.int64()), ("t", pa.int64()), ("l", pa.int64())])


def _partials(conv: np.ndarray, seg: np.ndarray, before: np.ndarray, lengths: np.ndarray, cells: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Columns of ``_PARTIAL``: the nodes of one matrix. ``before``: (rows, 2); ``cells``: (turns, 3), a, b and words, row after row; ``values``: (rows, 2)."""
    rows, width = len(conv), int(lengths.max(initial=0))
    filled = np.arange(width) < lengths[:, None]
    ids = np.full((rows, width), -1, np.int64)
    ids[filled] = _ids(cells[:, 0], cells[:, 1])
    group = _ids(seg, before[:, 0], before[:, 1])
    order = np.lexsort([*ids[:, ::-1].T, group])
    conv, seg, before, lengths, ids, group, values = (x[order] for x in (conv, seg, before, lengths, ids, group, values))
    keys, words = np.zeros((2, rows, width), np.int64), np.zeros((rows, width), np.int64)
    place = np.zeros((rows, width), np.int64)
    place[filled] = np.arange(len(cells))
    place, filled = place[order], filled[order]
    for lane in range(2):
        keys[lane][filled] = cells[place[filled], lane]
        keys[lane] = np.bitwise_xor.accumulate(keys[lane], axis=1) ^ before[:, lane:lane + 1]
    words[filled] = cells[place[filled], 2]
    changed = np.ones((rows, width + 1), bool)
    changed[1:, 0] = group[1:] != group[:-1]
    changed[1:, 1:] = ids[1:] != ids[:-1]
    starts_at = np.logical_or.accumulate(changed, axis=1)
    out = []
    for d in range(width):
        starts = np.flatnonzero(starts_at[:, d + 1])
        sums = [np.diff(np.r_[starts, rows]), np.minimum.reduceat(conv, starts), np.add.reduceat(values[:, 0], starts), np.add.reduceat(values[:, 1], starts)]
        real = lengths[starts] > d  # other runs are padding
        at = starts[real]
        n, least, t, leaves = (x[real] for x in sums)
        up = keys[:, at, d - 1] if d else before[at].T
        out.append([seg[at] * SEGMENT + d + 1, *keys[:, at, d], *up, n, least, words[at, d], t, leaves])
    top = seg == 0
    if top.any():
        zero = np.zeros(1, np.int64)
        out.append([zero] * 5 + [np.array([x]) for x in (top.sum(), conv[top].min(), 0, *values[top].sum(0))])
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _nodes(segments: DataFrame) -> DataFrame:
    """Partial rows of nodes of ``segments``, whose columns t and l are summed over members, combined by key."""
    lead = [F.get("cells", F.lit(i))["a"] for i in range(SHARD_TURNS)]
    by = ["seg", "pa", "pb", *lead, "xa", "conv"]
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = segments.repartitionByRange(n, *by).sortWithinPartitions(*by).select("conv", "seg", "pa", "pb", "cells", "t", "l")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, seg, p, q, _, t, leaves = (None if i == 4 else c.to_numpy() for i, c in enumerate(batch.columns))
            lists = batch.column(4)
            own = lists.flatten()
            cells = np.stack([own.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "words")], 1).astype(np.int64)
            columns = _partials(conv, seg, np.stack([p, q], 1), np.diff(lists.offsets.to_numpy()).astype(np.int64), cells, np.stack([t, leaves], 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PARTIAL)

    found = shards.mapInArrow(run, ", ".join(f"{c} long" for c in _PARTIAL.names))
    return found.groupBy(*_KEY).agg(F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"),
                                    F.min("words").alias("words"), F.sum("t").alias("t"), F.sum("l").alias("l"))


def _ends(segments: DataFrame) -> DataFrame:
    """(depth, ka, kb, ends_sha256) of nodes where conversations end.

    Sorted ids are written as text in range shards, pieces of at most a batch each; only these go to the task that hashes a node,
    in order and without holding them.
    """
    ends = segments.where("last").select((F.col("seg") * SEGMENT + F.size("cells")).alias("depth"), F.col("pa").bitwiseXOR(F.col("xa")).alias("ka"),
                                         F.col("pb").bitwiseXOR(F.col("xb")).alias("kb"), "conv")
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, a, b, conv = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(conv), bool)
            new[1:] = (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            starts, ids = np.flatnonzero(new), conv.tolist()
            texts = [",".join(map(str, ids[i:j])) for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True)] if len(ids) else []
            yield pa.RecordBatch.from_arrays([pa.array(x[starts]) for x in (depth, a, b, conv)] + [pa.array(texts, pa.string())], ["depth", "ka", "kb", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, names = None, None, ["depth", "ka", "kb", "ends_sha256"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            done = []
            for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pack(done)
        if key is not None:
            yield pack([(*key, state.hexdigest())])

    pieces = ends.repartitionByRange(n, *_KEY, "conv").sortWithinPartitions(*_KEY, "conv").mapInArrow(write, "depth long, ka long, kb long, first long, ids string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(digest, "depth long, ka long, kb long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv, depth from 1, digest, words; a row of depth 0 for each conversation).

    conv_id: smallest member; depth; parent_conv_id (root: null); n_convs; n_children; n_leaves: childless nodes of the subtree;
    saved_tokens: over the subtree, (members - 1) * words of the last turn; ends_sha256: SHA-256 of the ids that end there, ascending,
    joined by commas. An empty table has no nodes.
    """
    segments = _segments(turns)
    zero = F.lit(0).cast("long")
    found = materialize(_nodes(segments.withColumns({"t": zero, "l": zero})).drop("t", "l"), "trie-nodes")

    def at(rows: DataFrame, tag: str) -> tuple[DataFrame, Column]:
        """``rows`` with their keys renamed, and the condition that their key is that of a node."""
        same = [F.col(k) == F.col(f"{k}_{tag}") for k in _KEY]
        return rows.withColumnsRenamed({k: f"{k}_{tag}" for k in _KEY}), same[0] & same[1] & same[2]

    children, same = at(found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
                        .agg(F.count("*").alias("n_children")), "c")
    nodes = found.join(children, same, "left").select(*found.columns, F.coalesce("n_children", zero).alias("n_children"),
                                                      ((F.col("n_convs") - 1) * F.col("words")).alias("own"), F.lit(1).cast("long").alias("one"))
    nodes = materialize(running(nodes, ["conv_id"], "depth", {"own": "above", "one": "nth"}), "trie-nodes")
    paths = nodes.groupBy(F.col("conv_id").alias("of")).agg(F.sum("own").alias("t"), F.sum((F.col("n_children") == 0).cast("long")).alias("l"))
    brought = segments.join(paths, F.col("conv") == F.col("of"), "left").withColumns({"t": F.coalesce("t", zero), "l": F.coalesce("l", zero)})
    sums, same = at(_nodes(brought).select(*_KEY, "t", "l"), "s")
    nodes = nodes.join(sums, same)
    ends, same = at(_ends(segments), "e")
    nodes = nodes.join(ends, same, "left")
    # Only the top of a path has a parent of another name. A node with very many children is met by pieces of them.
    tops = nodes.where("nth = 0 and depth > 0").select(F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).alias("up"), *_KEY)
    parents = found.select(F.struct(*_KEY).alias("of"), F.col("conv_id").alias("parent"))
    named = Placed(tops, "up", [], "trie-tops").positioned(parents, "of")
    above, own = at(named.select(*_KEY, "parent"), "t")
    rows = nodes.join(above, own, "left")
    return rows.select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
                       F.col("l").alias("n_leaves"), (F.col("t") - F.col("above")).alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


#: DuckDB: every rebuilt conversation as a list of digests, every prefix as a group; CRC-32 byte by byte.
TRIE_SQL = r"""
WITH tab AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc
  FROM range(256) r(n)),
own AS (
  SELECT conv_id, list(struct_pack(d := d, w := w) ORDER BY turn NULLS FIRST, d) AS turns FROM (
    SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS w
    FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(conv_id::VARCHAR)), lambda i: ('0x' || substr(hex(encode(conv_id::VARCHAR)), 2 * i + 1, 2))::BIGINT)),
                       lambda c, x: xor(c >> 8, tab.crc[(xor(c, x) & 255) + 1])), 4294967295) % 4 AS h FROM own, tab),
r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h.h), []), coalesce(list_slice(h.turns, h.h + 1, len(h.turns)), [])) AS seq
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
n AS (
  SELECT list_transform(list_slice(seq, 1, d), lambda t: t.d) AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(max(seq[d].w), 0) AS w, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d) AS ends
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM r) GROUP BY 1, 2),
k AS (SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.d = k.d AND n.node = k.node),
s AS (
  SELECT list_slice(node, 1, e) AS node, e AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM m) GROUP BY 1, 2)
SELECT m.conv_id, m.d::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s ON m.d = s.d AND m.node = s.node LEFT JOIN n p ON p.d = m.d - 1 AND p.node = list_slice(m.node, 1, m.d - 1)
"""
