"""N-gram Jaccard join with a prefix tree.

1. Every whole text becomes its set of word 5-grams (64-bit hashes). Rows with one 128-bit digest have one set,
   which goes on once.
2. A set's first 0.4 n + 1 members in hash order meet those of all other sets, by member. Linked sets have at least
   0.05 n of them in common (see ``LEAD``), so a set with fewer shared members has no link. Most sets end here.
3. The whole sets of the rest meet by member. What no other set of a size that allows a link has is
   dropped; a set keeps going if 0.75 n members are left. Of these, the rarest first, the first 0.25 n + 1
   (dropped ones counted) tie sets together; components of the ties are the units of work.
4. In a unit the sets, all in hash order, form a compressed prefix tree. A probe goes down the tree with the
   overlap counted so far, shared by all sets below a node; a subtree is left when the overlap plus what
   remains on either side cannot reach any of its sets' bounds. Every set is a probe, so every
   link is found. Large units are cut into blocks that meet pairwise.

``near_pairs`` returns the links themselves. ``near_duplicates`` returns each document's component and number of
links, which are added up where they are found, so its rows do not grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuemill.llm.common import blocks, mix64, utf8_block, word_hashes
from valuemill.llm.graph import components
from valuemill.session import materialize

#: Words of an n-gram; n-grams of a bundle of units or of a block of a large unit.
WORDS, UNIT = 5, 1 << 22
#: A link needs PART * intersection >= SHARE * union.
SHARE, PART = 75, 100
#: Share of a set, in percent, that meets others in the first step, and of which share of the set, in percent, any partner has to be met there.
#: With sizes s and t, 3/4 <= t/s <= 4/3, a link needs i >= 3/7 (s + t). Of the first q members of the one set, at least q - (s - i) are in
#: the other, each before its place q + (t - i); with q = 0.4 t - (t - i) that is inside the other's lead, and q - (s - i) >= 9/35 t - 1/7 s >= 0.05 s.
LEAD, MET = 40, 5
_WEIGHTS = mix64(np.arange(1, WORDS + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def ngram_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each document of a block; of a text with fewer words, its whole sequence."""
    hashes, doc, _, _ = word_hashes(data, offsets, lower=True)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    grams = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        grams += hashes[k:k + len(grams)] * _WEIGHTS[k]
    grams = mix64(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            own = np.sort(grams[a:b - WORDS + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            short = np.append(hashes[a:b] * _WEIGHTS[:b - a], np.array([b - a], np.uint64) * _WEIGHTS[WORDS])
            out.append(mix64(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(grams[:0])
    return out


def _digest(own: np.ndarray) -> tuple[int, int]:
    """Two independent sums over the set."""
    return int(mix64(own).sum(dtype=np.uint64).view(np.int64)), int(mix64(own * _SECOND + np.uint64(1)).sum(dtype=np.uint64).view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = utf8_block(batch.column("text"))
        yield batch, [s for i, j in blocks(offsets) for s in ngram_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])]


def digests(docs: DataFrame) -> DataFrame:
    """(id, n, a, b) of each document: the size of its set and its digest; and ``mark`` (binary) where ``docs`` has it."""
    marked = "mark" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches):
            found = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in found], pa.int64()),
                                              pa.array([b for _, b in found], pa.int64()), *([batch.column("mark")] if marked else [])], ["id", "n", "a", "b", *(["mark"] if marked else [])])

    return docs.mapInArrow(run, "id long, n long, a long, b long" + (", mark binary" if marked else ""))


def _members(docs: DataFrame, lead: bool) -> DataFrame:
    """(gram, a, n) for each member, or each leading member, of the sets of ``docs``; equal sets of a batch go once.

    Leading members are cut to 48 bits: a false meeting can only keep a set for the next step.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches):
            once = {_digest(s): s for s in sets if len(s)}
            for at in range(0, len(once), 1024):
                part = list(once.items())[at:at + 1024]
                heads = [s[:LEAD * len(s) // 100 + 1] & np.uint64(0xFFFFFFFFFFFF0000) if lead else s for _, s in part]
                each = [len(h) for h in heads]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(heads).view(np.int64)), pa.array(np.repeat(np.array([d[0] for d, _ in part], np.int64), each)),
                    pa.array(np.repeat(np.array([len(s) for _, s in part], np.int32), each))], ["gram", "a", "n"])

    return docs.mapInArrow(run, "gram long, a long, n int")


def _meetings(batches: Iterator[pa.RecordBatch]):
    """All rows (gram, a, n) of a partition in the order of gram and n, each once; the number of its run; the number of rows of its run.

    A run: sets with one member whose neighbouring sizes allow a link.
    """
    parts = [[b.column(k).to_numpy() for k in range(3)] for b in batches]
    if not parts:
        return None
    gram, a, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.argsort(gram, kind="stable")
    gram = gram[order]
    twin = np.zeros(len(gram) + 1, bool)
    twin[1:-1] = gram[1:] == gram[:-1]
    some = twin[1:] | twin[:-1]  # a member of a single set meets nothing
    gram, order = gram[some], order[some]
    a, n = a[order], n[order].astype(np.int64)
    order = np.lexsort((a, n, gram))
    gram, a, n = gram[order], a[order], n[order]
    once = np.ones(len(gram), bool)
    once[1:] = (gram[1:] != gram[:-1]) | (a[1:] != a[:-1]) | (n[1:] != n[:-1])
    gram, a, n = gram[once], a[once], n[once]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (PART * n[:-1] < SHARE * n[1:])
    run = np.cumsum(fresh) - 1
    size = np.bincount(run)[run] if len(run) else run
    met = size > 1
    return gram[met], a[met], n[met], run[met], size[met]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, n) once for each member in which a set meets another; Spark adds them up before and after the shuffle."""
    if (found := _meetings(batches)) is not None:
        for k in range(0, len(found[0]), 1 << 18):
            p = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(found[1][p]), pa.array(found[2][p])], ["a", "n"])


def _keep_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, a, n, sets): members in which a set meets another, and how many sets meet in the member's largest run."""
    if (found := _meetings(batches)) is not None and len(found[0]):
        gram, a, n, _, size = found
        at = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        most = np.repeat(np.maximum.reduceat(size, at), np.diff(np.append(at, len(gram))))
        for k in range(0, len(gram), 1 << 18):
            p = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(gram[p]), pa.array(a[p]), pa.array(n[p]), pa.array(most[p])], ["gram", "a", "n", "sets"])


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, n, members, first): the met members of each set in hash order, and those of its prefix, rarest first; of sets that met in enough members."""
    parts = [[b.column(k).to_numpy() for k in range(4)] for b in batches]
    if not parts:
        return
    gram, a, n, sets = (np.concatenate(x) for x in zip(*parts, strict=True))
    gram = gram.view(np.uint64)
    order = np.lexsort((gram, sets, n, a))
    gram, a, n = gram[order], a[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (n[1:] != n[:-1])])).tolist()
    rows = []
    for i, j in zip(at, [*at[1:], len(a)], strict=True):
        size, met = int(n[i]), j - i
        if PART * met >= SHARE * size:
            prefix = size - -(-SHARE * size // PART) + 1 - (size - met)
            rows.append((int(a[i]), size, np.sort(gram[i:j]).tobytes(), gram[i:i + max(0, prefix)].tobytes()))
    for k in range(0, len(rows), 1024):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[k:k + 1024], strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                         ["a", "n", "members", "first"])


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first = [np.frombuffer(x, np.int64) for x in batch.column("first").to_pylist()]
        each = [len(x) for x in first]
        if sum(each):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(first)), pa.array(np.repeat(batch.column("a").to_numpy(), each)),
                                              pa.array(np.repeat(batch.column("n").to_numpy(), each).astype(np.int32))], ["gram", "a", "n"])


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties each set to the least of its run."""
    if (found := _meetings(batches)) is not None and len(found[0]):
        _, a, _, run, _ = found
        at = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        least = np.repeat(np.minimum.reduceat(a, at), np.diff(np.append(at, len(a))))
        pairs = np.unique(np.stack([a, least], axis=1)[a != least], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


class PrefixTree:
    """Compressed prefix tree over ordered sets of small integers; a node holds a run of members that all sets below share.

    ``sizes``: of the whole sets, where members that no other set has were left out.
    """

    def __init__(self, sets: list[np.ndarray], sizes: list[int] | None = None):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.size = np.array([len(sets[i]) if sizes is None else sizes[i] for i in self.order])
        held = [len(sets[i]) for i in self.order]
        flat, begin, end, parent, leaf = [], [], [], [], []
        shared = [0]
        for a, b in zip(self.order, self.order[1:], strict=False):
            k = min(len(sets[a]), len(sets[b]))
            differ = sets[a][:k] != sets[b][:k]
            shared.append(int(differ.argmax()) if differ.any() else k)
        shared.append(0)
        # Depths at which the path of each set branches, left to right; (node, depth of its end) on the current path.
        path: list[tuple[int, int]] = []
        at = 0
        for k, i in enumerate(self.order):
            while path and path[-1][1] > shared[k]:
                path.pop()
            depth = path[-1][1] if path else 0
            stops, low = [], len(sets[i])
            for nxt in range(k + 1, len(self.order) + 1):  # later branchings off this path are known by falling shared depths
                if shared[nxt] < low:
                    low = shared[nxt]
                    stops.append(low)
                if low <= depth:
                    break
            for stop in [s for s in reversed(stops) if s > depth] + [len(sets[i])]:
                if stop > depth:
                    flat.append(sets[i][depth:stop])
                    begin.append(at)
                    at += stop - depth
                    end.append(at)
                    parent.append(path[-1][0] if path else -1)
                    leaf.append([])
                    path.append((len(begin) - 1, stop))
                    depth = stop
            if path:
                leaf[path[-1][0]].append(k)
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        self.begin, self.end, self.parent, self.leaf = np.array(begin, np.int64), np.array(end, np.int64), np.array(parent, np.int64), leaf
        self.depth = np.zeros(len(begin), np.int64)
        for x in range(len(begin)):
            self.depth[x] = (self.depth[parent[x]] if parent[x] >= 0 else 0) + end[x] - begin[x]
        self.least, self.most = np.full(len(begin), 1 << 60), np.zeros(len(begin), np.int64)  # least size and most members of the sets below
        for x in range(len(begin) - 1, -1, -1):
            for k in leaf[x]:
                self.least[x], self.most[x] = min(self.least[x], self.size[k]), max(self.most[x], held[k])
            if parent[x] >= 0:
                p = parent[x]
                self.least[p], self.most[p] = min(self.least[p], self.least[x]), max(self.most[p], self.most[x])
        first = np.argsort(self.parent, kind="stable")
        self.child_from = np.searchsorted(self.parent[first], np.arange(-1, len(begin)))
        self.child_to = np.searchsorted(self.parent[first], np.arange(-1, len(begin)), side="right")
        self.children = first

    def linked(self, probe: np.ndarray, hit: np.ndarray, n: int | None = None) -> list[int]:
        """Positions in ``order`` of the sets with enough overlap with a set of size ``n``; ``hit``: all False, as long as there are members, and left so."""
        hit[probe] = True
        found, n = [], len(probe) if n is None else n
        nodes = self.children[self.child_from[0]:self.child_to[0]]
        overlap = np.zeros(len(nodes), np.int64)
        while len(nodes):
            length = self.end[nodes] - self.begin[nodes]
            ends = np.cumsum(length)
            spots = np.arange(ends[-1]) + np.repeat(self.begin[nodes] - (ends - length), length)
            overlap = overlap + np.add.reduceat(hit[self.flat[spots]].astype(np.int64), ends - length)
            left = np.minimum(len(probe) - np.searchsorted(probe, self.flat[self.end[nodes] - 1], side="right"), self.most[nodes] - self.depth[nodes])
            # The bound is least for the smallest set below: PART * i >= SHARE * (n + m - i).
            alive = (PART + SHARE) * (overlap + left) >= SHARE * (n + np.maximum(self.least[nodes], -(-SHARE * n // PART)))
            nodes, overlap = nodes[alive], overlap[alive]
            for x, o in zip(nodes.tolist(), overlap.tolist(), strict=True):
                found += [k for k in self.leaf[x] if (PART + SHARE) * o >= SHARE * (n + int(self.size[k]))]
            a, b = self.child_from[nodes + 1], self.child_to[nodes + 1]
            total = b - a
            overlap = np.repeat(overlap, total)
            nodes = self.children[np.arange(total.sum()) + np.repeat(a - (np.cumsum(total) - total), total)]
        hit[probe] = False
        return found


def link_unit(sets: list[np.ndarray], sizes: list[int], own: list[bool] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Every link of a unit (sets with members in hash order), once: (position, positions that it is linked with).

    ``own``: sets of the first of two blocks; then only links between the blocks are looked for.
    """
    members = np.unique(np.concatenate(sets))
    ranked = [np.searchsorted(members, s) for s in sets]
    target = np.array([i for i in range(len(sets)) if own is None or own[i]])
    probes = target.tolist() if own is None else [i for i in range(len(sets)) if not own[i]]
    tree = PrefixTree([ranked[i] for i in target], [sizes[i] for i in target])
    place, hit = target[tree.order], np.zeros(len(members), bool)
    for i in probes:
        linked = place[tree.linked(ranked[i], hit, sizes[i])]
        if own is None:
            linked = linked[linked > i]
        if len(linked):
            yield i, linked


def _units(batch: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[int], list[bool] | None]]:
    """(names, copies, sets, sizes, own) of each unit or pair of blocks of a bundle."""
    by: dict[tuple, list[int]] = {}
    for row, key in enumerate(zip(batch.column("component").to_pylist(), batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True)):
        by.setdefault(key, []).append(row)
    names, copies = (batch.column(c).to_numpy() for c in ("a", "copies"))
    members, block, sizes = (batch.column(c).to_pylist() for c in ("members", "block", "n"))
    for (_, one, two), rows in by.items():
        own = None if one == two else [block[r] == one for r in rows]
        if len(rows) > 1 and (own is None or 0 < sum(own) < len(own)):
            yield names[rows], copies[rows], [np.frombuffer(members[r], np.uint64) for r in rows], [sizes[r] for r in rows], own


def _link_units(batch: pa.Table) -> pa.Table:
    """(u, v, links): for each set with links in a unit the least set that these join it to, and the documents linked with it."""
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
    for names, copies, sets, sizes, own in _units(batch):
        root, links = list(range(len(sets))), np.zeros(len(sets), np.int64)

        def find(i: int, root: list[int] = root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, linked in link_unit(sets, sizes, own):
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            for j in linked.tolist():
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
        part = np.array([find(i) for i in range(len(sets))])
        least = names.copy()
        np.minimum.at(least, part, names)
        some = links > 0
        out.append((names[some], least[part][some], links[some]))
    return pa.table(dict(zip(("u", "v", "links"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))


def _pair_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): every link of the units of a bundle, sent on as it is found."""
    for names, _, sets, sizes, own in _units(pa.Table.from_batches(batches)):
        for i, linked in link_unit(sets, sizes, own):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(names[linked], names[i])), pa.array(np.maximum(names[linked], names[i]))], ["u", "v"])


def _placed(docs: DataFrame, each: DataFrame) -> DataFrame:
    """The sets that may have links, each in the units or pairs of blocks in which it meets others; ``copies``: documents that have the set."""
    met = _members(docs, lead=True).repartition("gram").mapInArrow(_met, "a long, n long")
    going = materialize(met.groupBy("a", "n").agg(F.count("*").alias("met")).where(100 * F.col("met") >= MET * F.col("n")).select("a"), "ngram-going")
    rows = each.where("id is not null").groupBy("a", "b", "n").agg(F.min("id").alias("row")).join(going, "a", "left_semi").select("row")
    rest = docs.join(rows, F.col("id") == F.col("row"), "left_semi")
    kept = materialize(_members(rest, lead=False).repartition("gram").mapInArrow(_keep_met, "gram long, a long, n long, sets long")
                       .repartition("a").mapInArrow(_collect_sets, "a long, n long, members binary, first binary"), "ngram-sets")
    ties = kept.select("a", "n", "first").mapInArrow(_unfold, "gram long, a long, n int").repartition("gram").mapInArrow(_ties, "u long, v long")
    unit = components(ties)
    sized = unit.join(kept.select("a", "n", (F.length("members") / 8).cast("long").alias("held")), F.col("node") == F.col("a"))
    sizes = materialize(sized.groupBy("component").agg(F.sum("held").alias("held")).select("component", "held", F.ceil(F.col("held") / UNIT).cast("int").alias("parts")), "ngram-units")
    bundles = max(1, -(-int(sizes.where("parts <= 1").agg(F.sum("held")).first()[0] or 0) // UNIT))
    chosen = unit.join(sizes.select("component", "parts"), "component").select("node", "component", F.greatest("parts", F.lit(1)).alias("parts"))
    # Blocks (one, two) with one <= two of a large unit; a small unit is the block (0, 0) and shares its bundle with others.
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    met_in = F.transform(others, lambda k: F.struct(F.least(k, F.col("block")).alias("one"), F.greatest(k, F.col("block")).alias("two")))
    copies = each.groupBy(F.col("a").alias("named")).agg(F.count("*").alias("copies"))
    chosen = chosen.join(copies, F.col("node") == F.col("named")).drop("named")
    return (kept.drop("first").join(chosen, F.col("a") == F.col("node")).withColumn("block", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
              .withColumn("met", F.explode(met_in)).select("a", "n", "copies", "members", "component", "parts", "block", "met.one", "met.two")
              .withColumn("bundle", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(bundles))).otherwise(F.xxhash64("component", "one", "two"))).drop("parts"))


def near_links(docs: DataFrame, each: DataFrame) -> DataFrame:
    """(u, v, links) for the sets with links, named by digest ``a``: edges that join all linked sets (u = v for the least of them), and the
    number of documents that u's set is linked with; a row for each pair of blocks. ``docs``: id, text; ``each``: their ``digests``."""
    return _placed(docs, each).groupBy("bundle").applyInArrow(_link_units, "u long, v long, links long")


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_a, id_b, n_a, n_b): every pair of linked sets that are not equal, each set by the least id that has it, id_a < id_b.

    With the documents of each set (``digests``) these are all links between documents. The rows can grow with the square of a group of near copies.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    each = materialize(digests(docs), "ngram-digests")
    pairs = _placed(docs, each).groupBy("bundle").applyInArrow(_pair_units, "u long, v long")
    least = each.where("id is not null and n > 0").groupBy("a").agg(F.min("id").alias("id"), F.min("n").alias("n"))
    both = pairs.join(least.selectExpr("a as u", "id as iu", "n as nu"), "u").join(least.selectExpr("a as v", "id as iv", "n as nv"), "v")
    turned = F.col("iu") > F.col("iv")
    return both.select(F.least("iu", "iv").alias("id_a"), F.greatest("iu", "iv").alias("id_b"),
                       F.when(turned, F.col("nv")).otherwise(F.col("nu")).alias("n_a"), F.when(turned, F.col("nu")).otherwise(F.col("nv")).alias("n_b"))




def _components(docs: DataFrame, each: DataFrame) -> DataFrame:
    """(a, b, n, least, copies, links, first) of each set: its least id, its rows, the rows of other sets linked with it, and
    ``first`` (least, a, b) of the set that its component is named by."""
    links = materialize(near_links(docs, each), "ngram-links")
    found = components(links.select("u", "v"))
    near = links.groupBy("u").agg(F.sum("links").alias("links"))
    least = (each.where("n > 0").groupBy("a", "b", "n").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
             .join(found, F.col("a") == F.col("node"), "left").join(near, F.col("a") == F.col("u"), "left"))
    own = F.struct("least", "a", "b")
    whole = least.where("component is not null and least is not null").groupBy("component").agg(F.min(own).alias("of_all")).withColumnRenamed("component", "whole")
    return (least.join(whole, F.col("component") == F.col("whole"), "left")
            .select("a", "b", "n", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("of_all", own).alias("first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component_id (least id that links reach) and n_links (other rows that the row is linked with, copies too) of every row.

    Words are runs of bytes other than blank and 9 to 13, A-Z in lower case. Null and empty texts have no
    set and link with nothing. Every row is a document, also those that share an id; a row with a null id
    has the component of the rows with an id that have their very set, else its links are not followed and the component and n_links are null. An empty
    table gives no rows. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    each = materialize(digests(docs), "ngram-digests")
    named = _components(docs, each).select("a", "b", "n", F.col("first.least").alias("component_id"),
                                           F.when(F.col("least").isNotNull(), F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return each.join(named, ["a", "b", "n"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).alias("n_links"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without near duplicates: of each component the rows with its least id stay.

    Decided row by row: a row goes for its own text only, whatever other rows share its id. Where two different sets of a component
    have the least id, the one with the lesser digest stays; rows equal in id and text stay or go together. Rows without an id or
    without words stay.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"), F.col(id_col).cast("long").alias("id"),
                         F.col(text).alias("text"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("mark"))
    each = materialize(digests(packed.select("id", "text", "mark")), "ngram-digests")
    sets = _components(packed.select("id", "text"), each.drop("mark")).select("a", "b", "n", "first")
    stays = (F.col("id") == F.col("first.least")) & (F.col("a") == F.col("first.a")) & (F.col("b") == F.col("first.b"))
    gone = (each.where("id is not null and n > 0").join(sets, ["a", "b", "n"]).where(~stays)
            .select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct())
    left = packed.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left_anti")
    return left.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)])
