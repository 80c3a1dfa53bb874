"""Similarity self-join on word shingles with a count-vector R-tree.

A document's set is its distinct five-word shingles; documents with equal sets
form one class and the join runs on classes.

1. *Groups.* Two sets with Jaccard >= t share one of the first
   ``n - ceil(t n) + 1`` shingles of either in any common order.  The order puts
   shingles that many documents share last (heavy ones, counted over all
   documents split by split), so a common passage hardly ever makes a group.
   A group bears the least class that holds its shingle: the many shingles of one
   family of copies thus make few groups.  Names and the order decide the cost
   only, never the result.
2. *Index.* Shingles hash into hash groups; a set's counts per hash group are
   a point (``GROUPS`` coordinates, eight times as many for each size class).  In
   each group an R-tree holds the points; a pair of nodes is given up when the sum
   of coordinate minima of their upper corners, which bounds the overlap, is below
   what t needs, or when all points of both are joined already.  What the bound
   joins over all groups are families: only inside one can two sets link.
3. *Verification.* Each set moves once, to its family, where an R-tree again
   finds pairs that are still unlinked and pairs are checked on the whole sets.

Neither step emits pairs: a group's or family's task emits at most one edge a
member, a spanning tree of what it joined.  A wide one is cut into tiles that share
a few members.  After what tiles joined is made components, tiles are cut anew by
set size and by whether a member is in the main component, and those that can
still hold something to join meet in pairs.

Edge cases: null or blank texts have no set and link with nothing; texts with
fewer than five words are one shingle; repeated rows share a class; rows with a
null id get a null component; an empty table gives an empty result.  A set is at
most as long as its text and is held whole by one worker.  Extra columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_runs, maybe_among, packed, run_starts, scratch, stored, table, unpacked
from .components import components
from .textgrams import mix64, set_id, shingle_set

GROUPS = 128
PER_GROUP = 8  # shingles a hash group at most, on average
LEAF = 4
MAX_LEVEL = 8
TILE = 1 << 20  # shingles
TILE_POINTS = 1 << 14
HEADS = 16  # members of a wide group that stand in all its tiles
FANOUT = 32
HEAVY_DOCS = 4
HEAVY_CHUNK = 1 << 22
MAX_HEAVY = 1 << 20
DOCUMENT, POINT, HEAVY = 0, 1, 2  # kinds of rows of the first scan
NUM, DEN = 80, 100  # Jaccard threshold as a fraction


def needed(n_sum):
    """Least overlap of two sets whose sizes add up to ``n_sum``: |A n B| >= t / (1 + t) (|A| + |B|)."""
    return -(-NUM * n_sum // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def level_of(n: int) -> int:
    """Size class of a set: each has eight times as many hash groups as the one before."""
    level = 0
    while n > PER_GROUP * GROUPS << 3 * level:
        level += 1
    return level


def levels_of(n: int) -> list[int]:
    """The size classes a set of n members is compared in: its own, and the next if a set there may link with it."""
    level = level_of(n)
    return [level, level + 1] if level_of(-(-n * DEN // NUM)) > level else [level]


def count_vector(members: np.ndarray, level: int = 0) -> np.ndarray:
    """Set members per hash group."""
    bits = (GROUPS << 3 * level).bit_length() - 1
    return np.bincount((mix64(members) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def packed_vector(counts: np.ndarray) -> bytes:
    """Counts as bytes, four of them each where one does not hold the largest."""
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def unpacked_vectors(held: list[bytes], level: int) -> np.ndarray:
    wide = 4 * (GROUPS << 3 * level)
    return np.stack([np.frombuffer(v, "<u4" if len(v) == wide else np.uint8) for v in held]).astype(np.int64)


class Joined:
    """Disjoint sets of the rows of a group."""

    def __init__(self, labels: np.ndarray):
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.up = first[inverse].tolist()

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        return np.asarray([self.find(i) for i in range(len(self.up))])


class RTree:
    """Bulk-loaded R-tree over count vectors: halves by size or the widest coordinate, leaves of ``LEAF``."""

    def __init__(self, points: np.ndarray, labels: np.ndarray):
        self.points = points.astype(np.int64)
        self.joined = Joined(labels)
        self.sizes = self.points.sum(axis=1)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)), self.joined.roots())

    def _build(self, rows: np.ndarray, roots: np.ndarray) -> int:
        top, least = self.points[rows].max(axis=0), int(self.sizes[rows].min())
        most = int(self.sizes[rows].max())
        one = int(rows[0]) if (roots[rows] == roots[rows[0]]).all() else None
        kids = None
        if len(rows) > LEAF:
            if most * NUM > least * DEN:
                order = rows[np.argsort(self.sizes[rows], kind="stable")]
            else:  # sizes alike: by the widest coordinate, but what is linked already goes together
                widest = int((top - self.points[rows].min(axis=0)).argmax())
                seen, many = np.unique(roots[rows], return_counts=True)
                order = rows[np.lexsort((self.points[rows, widest], roots[rows] != seen[many.argmax()]))]
            kids = (self._build(order[: len(rows) // 2], roots), self._build(order[len(rows) // 2 :], roots))
        self.nodes.append((top, least, most, one, kids, rows))
        return len(self.nodes) - 1

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """(row, rows it may link with and isn't joined with yet); every such pair comes once.

        The caller may ``join`` rows meanwhile, which ends the search between their sets.
        """
        find, stack = self.joined.find, [(self.root, self.root)]
        while stack:
            x, y = stack.pop()
            top, least, most, one, kids, rows = self.nodes[x]
            top2, least2, most2, one2, kids2, rows2 = self.nodes[y]
            if one is not None and one2 is not None and find(one) == find(one2):
                continue
            if least * NUM > most2 * DEN or least2 * NUM > most * DEN:
                continue
            if x != y and int(np.minimum(top, top2).sum()) < needed(least + least2):
                continue
            if kids is None and kids2 is None:
                yield from self._leaf_pairs(rows, rows2, x == y)
            elif x == y:
                a, b = kids
                stack += [(a, b), (b, b), (a, a)]
            elif kids2 is None or (kids is not None and len(rows) >= len(rows2)):
                stack += [(k, y) for k in kids]
            else:
                stack += [(x, k) for k in kids2]

    def _leaf_pairs(self, a: np.ndarray, b: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray]]:
        for n, i in enumerate(a.tolist()):
            mates = self.open_mates(i, a[n + 1 :] if same else b)
            if len(mates):
                yield i, mates

    def open_mates(self, i: int, rows: np.ndarray) -> np.ndarray:
        """Those of ``rows`` that the bound allows to link with row i and that aren't joined with it."""
        if not len(rows):
            return rows
        low = np.minimum(self.points[i], self.points[rows]).sum(axis=1)
        rows = rows[low >= needed(self.sizes[i] + self.sizes[rows])]
        mine = self.joined.find(i)
        return rows[[self.joined.find(j) != mine for j in rows.tolist()]] if len(rows) else rows


def _linked(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sorted sets ``others`` link with ``own``, on the whole sets."""
    many, sizes = np.concatenate(others), np.asarray([len(o) for o in others])
    at = np.minimum(np.searchsorted(own, many), len(own) - 1)
    both = np.add.reduceat((own[at] == many).astype(np.int64), np.cumsum(sizes) - sizes)
    return DEN * both >= NUM * (len(own) + sizes - both)


def joined_roots(points: np.ndarray, labels: np.ndarray, linked=None) -> np.ndarray:
    """Root row of each row after all pairs that the bound allows and ``linked(i, mates)`` affirms
    (all, if None) are joined; rows of one label are joined from the start."""
    tree = RTree(points, labels)

    def check(i: int, mates: np.ndarray) -> None:
        for j in (mates if linked is None or not len(mates) else mates[linked(i, mates)]).tolist():
            tree.joined.join(i, j)

    rows, everyone = np.arange(len(points)), np.arange(len(points))
    # A family of copies mostly links with its middle; what is left over may have a middle of its own.
    for _ in range(3):
        if len(rows) <= 2 * LEAF:
            break
        far = np.abs(points[rows] - points[rows].mean(axis=0)).sum(axis=1)
        center = int(rows[far.argmin()])
        check(center, tree.open_mates(center, everyone))
        rows = rows[[tree.joined.find(j) != tree.joined.find(center) for j in rows.tolist()]]
    if len(points) > 2 * LEAF:
        tree = RTree(points, tree.joined.roots())
    for i, mates in tree.candidates():
        check(i, mates)
    return tree.joined.roots()


def link_group(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Root row of each row after all links between the sets; rows of one label count as linked from the start."""
    level = level_of(sum(map(len, sets)) // len(sets))
    points = np.stack([count_vector(s, level) for s in sets]).astype(np.int64)
    return joined_roots(points, labels, lambda i, mates: _linked(sets[i], [sets[j] for j in mates.tolist()]))


def _edges(cls: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tree of small degree over each set of joined rows, so that no node is hot."""
    order = np.lexsort((cls, roots))
    cut = run_starts(roots[order])
    a, b = [cls[:0]], [cls[:0]]
    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
        who = np.unique(cls[order[x:y]])
        a.append(who[1:])
        b.append(who[(np.arange(1, len(who)) - 1) // FANOUT])
    return np.concatenate(a), np.concatenate(b)


def _meet(rows: DataFrame, payload: str, roots_of) -> DataFrame:
    """(a, b): edges that span what ``roots_of(payloads, classes, labels, k)`` joins in each group.  rows: (k, cls, label, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, "k"):
            k, cls, label = (batch[c].to_numpy(zero_copy_only=False) for c in ("k", "cls", "label"))
            held = batch[payload].to_pylist()
            starts = run_starts(k)
            out = []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if (label[s:e] != label[s]).any():
                    out.append(_edges(cls[s:e], roots_of(held[s:e], cls[s:e], label[s:e], int(k[s]))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["a", "b"])

    return rows.repartition("k").sortWithinPartitions("k").mapInArrow(run, "a long, b long")


def _document_rows(docs: DataFrame) -> DataFrame:
    """Rows of three kinds: per document its id, set size and class; per class (once a chunk) its point in each of
    its size classes; and the heavy shingles of each chunk of a split, with the least class that holds them."""
    names = ["kind", "doc_id", "n", "cls", "token", "level", "vec"]
    types = (pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.binary())

    def rows(kind: int, size: int, **columns) -> pa.RecordBatch:
        given = {"kind": np.full(size, kind), **columns}
        return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(size, t) for c, t in zip(names, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[np.ndarray] = []
        owners: list[int] = []
        held, seen = 0, set()

        def heavy() -> Iterator[pa.RecordBatch]:
            if not chunk:
                return
            token = np.concatenate(chunk)
            owner = np.repeat(np.asarray(owners, np.int64), [len(c) for c in chunk])
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            cut = run_starts(token)
            n, least = np.diff(cut), np.minimum.reduceat(owner, cut[:-1])
            many = n >= HEAVY_DOCS
            if many.any():
                yield rows(HEAVY, int(many.sum()), n=n[many], cls=least[many], token=token[cut[:-1]][many].view(np.int64))

        for batch in batches:
            out, points = ([], [], []), ([], [], [])
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                members = shingle_set(text)
                cls = set_id(members) if len(members) else None
                for column, v in zip(out, (doc_id, len(members), cls)):
                    column.append(v)
                if cls is not None and cls not in seen:
                    for level in levels_of(len(members)):
                        for column, v in zip(points, (cls, level, packed_vector(count_vector(members, level)))):
                            column.append(v)
                if cls is not None and cls not in seen:
                    seen.add(cls)
                    chunk.append(members)
                    owners.append(cls)
                    held += len(members)
                if held >= HEAVY_CHUNK:
                    yield from heavy()
                    chunk, owners, held, seen = [], [], 0, set()
            yield rows(DOCUMENT, len(out[0]), doc_id=out[0], n=out[1], cls=out[2])
            yield rows(POINT, len(points[0]), cls=points[0], level=points[1], vec=points[2])
        yield from heavy()

    return docs.mapInArrow(run, "kind int, doc_id long, n long, cls long, token long, level int, vec binary")


def _prefixes(docs: DataFrame, heavy: np.ndarray, names: np.ndarray) -> DataFrame:
    """(named, key, cls): the prefix of each class, once a split; heavy shingles as the names of their groups."""
    shared = docs.sparkSession.sparkContext.broadcast((heavy, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        known, name = shared.value
        for batch in batches:
            keys, flags, classes = [], [], []
            for text in batch["text"].to_pylist():
                members = shingle_set(text)
                if not len(members) or (cls := set_id(members)) in seen:
                    continue
                seen.add(cls)
                p = prefix_length(len(members))
                late = np.zeros(len(members), bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, members), len(known) - 1)
                    late = known[at] == members
                light = members[~late][:p].view(np.int64)
                groups = np.unique(name[at[late][: p - len(light)]]) if len(light) < p else light[:0]
                keys += [light, groups]
                flags.append(np.repeat([False, True], [len(light), len(groups)]))
                classes.append(np.full(len(light) + len(groups), cls, np.int64))
            if keys:
                columns = [pa.array(np.concatenate(c)) for c in (flags, keys, classes)]
                yield pa.RecordBatch.from_arrays(columns, ["named", "key", "cls"])

    return docs.select("text").mapInArrow(run, "named boolean, key long, cls long")


def _groups(prefixes: DataFrame) -> DataFrame:
    """(g, cls): classes by the groups they meet in.  A shingle's list streams by and is named by its first class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # shingle, class, leader and whether the leader stands already
        for batch in batches:
            if not batch.num_rows:
                continue
            named, key, cls = (batch[c].to_numpy(zero_copy_only=False) for c in ("named", "key", "cls"))
            out_g, out_c = [key[named]], [cls[named]]
            key, cls = key[~named], cls[~named]
            if len(key):
                if last is not None:
                    key, cls = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], cls])
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
                key, cls = key[new], cls[new]
                starts = run_starts(key)
                sizes = np.diff(starts)
                leader = np.repeat(cls[starts[:-1]], sizes)
                place = np.arange(len(key)) - np.repeat(starts[:-1], sizes)
                second = place == 1
                if last is not None:  # the first row stood in an earlier batch
                    leader[: sizes[0]] = last[2]
                    second[: sizes[0]] &= not last[3]
                follow = place >= 1
                out_g += [leader[follow], leader[second]]
                out_c += [cls[follow], leader[second]]
                stands = bool(sizes[-1] > 1 or (last is not None and len(sizes) == 1 and last[3]))
                last = (key[-1], cls[-1], leader[-1], stands)
            g, c = np.concatenate(out_g), np.concatenate(out_c)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], ["g", "cls"])

    # Named rows are final: they are dealt evenly and never gather by their group.
    deal = F.when(F.col("named"), F.xxhash64("key", "cls")).otherwise(F.col("key"))
    rows = prefixes.repartition(deal).sortWithinPartitions("named", "key", "cls").mapInArrow(run, "g long, cls long")
    return rows.dropDuplicates(["g", "cls"])


def _bound_edges(members: DataFrame, points: DataFrame) -> DataFrame:
    """(a, b): edges that span what the bound leaves in each group.  members: (k, cls, label); points: (cls, level, vec)."""
    members = stored(members)
    points = maybe_among(points, "cls", members.select("cls")).dropDuplicates(["cls", "level"])
    # The level in the last bits, so that a group is of one level.
    key = F.call_function("shiftleft", F.xxhash64("k", "level"), F.lit(5)).bitwiseOR(F.col("level"))
    rows = members.join(points, "cls").select(key.alias("k"), "cls", "label", "vec")

    def roots(vecs: list[bytes], cls: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
        return joined_roots(unpacked_vectors(vecs, k & 31), labels)

    return _meet(rows, "vec", roots)


def _set_edges(members: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): edges that span what the whole sets of each family link.  members: (k, node, cls, label).

    Texts move, not sets, which are larger.
    """
    goals = stored(members.select("k", F.col("node").alias("_node"), "cls", "label"))
    texts = maybe_among(docs, "doc_id", goals.select("_node")).join(goals, F.col("doc_id") == F.col("_node")).select("k", "cls", "label", "text")

    def roots(texts: list[str], cls: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
        sets = [shingle_set(t) for t in texts]
        # An id may stand for several texts: only the one of the class counts.
        own = np.asarray([len(s) > 0 and set_id(s) == c for s, c in zip(sets, cls.tolist())])
        out = np.arange(len(sets))
        at = np.flatnonzero(own)
        if len(at):
            out[at] = at[link_group([sets[i] for i in at.tolist()], labels[at])]
        return out

    return _meet(texts, "text", roots)


def _tile_pairs(members: DataFrame, tile: int) -> DataFrame:
    """(k, node, cls, label): members (g, node, cls, n, weight, label) of groups of several tiles, over the pairs of
    tiles that may hold a link between two components.

    A tile holds members of one size class, either of the group's main component or of others; two
    tiles of the main component have nothing open, nor have sizes too far apart.
    """
    main = members.groupBy("g", "label").agg(F.count("*").alias("_m")).groupBy("g").agg(F.max_by("label", F.struct("_m", "label")).alias("main"))
    # Linked sets are at most 1 / t apart in size, so in the same size class or the next.
    sized = members.join(main, "g").select(
        "g", "node", "cls", "n", "label", (F.col("label") == F.col("main")).alias("inner"),
        F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM))).cast("int").alias("band"), "weight",
    )
    bins = sized.groupBy("g", "inner", "band").agg(F.ceil(F.sum("weight") / tile).cast("int").alias("parts"))
    tiled = sized.join(bins, ["g", "inner", "band"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    tiles = bins.select("g", "inner", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    one = tiles.filter(~F.col("inner"))
    two = tiles.select(F.col("g").alias("g2"), F.struct("inner", "band", "part").alias("two"))
    met = one.select("g", F.struct("inner", "band", "part").alias("one")).join(
        two, (F.col("g") == F.col("g2")) & (F.abs(F.col("one.band") - F.col("two.band")) <= 2)
    )
    met = met.filter(F.col("two.inner") | (F.col("one") <= F.col("two"))).select("g", F.xxhash64("g", "one", "two").alias("k"), "one", "two")
    sides = met.select("g", "k", F.explode(F.array_distinct(F.array("one", "two"))).alias("t")).select(
        "g", "k", F.col("t.inner").alias("inner"), F.col("t.band").alias("band"), F.col("t.part").alias("part")
    )
    return tiled.join(sides, ["g", "inner", "band", "part"]).select("k", "node", "cls", "label")


def _joined(members: DataFrame, tile: int, edges) -> DataFrame:
    """(cls, label): components of what ``edges`` joins in the groups of members (g, node, cls, n, weight), where it joins any.

    edges(rows) gives the edges in each group k of rows (k, node, cls, label).
    """
    sizes = members.groupBy("g").agg(F.count("*").alias("_many"), F.ceil(F.sum("weight") / tile).cast("int").alias("tiles")).filter("_many > 1")
    points = stored(members.join(sizes, "g"))
    head = (F.col("tiles") > 1) & (F.pmod(F.xxhash64("cls", "g"), F.col("_many")) < HEADS)
    tiles = F.when(head, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")))
    placed = points.select("g", "node", "cls", F.explode(tiles).alias("tile"))
    found = stored(edges(placed.select(F.xxhash64("g", "tile").alias("k"), "node", "cls", F.col("cls").alias("label"))))
    labels = components(found).withColumnRenamed("node", "cls")
    wide = points.filter("tiles > 1")
    if not wide.isEmpty():
        labelled = wide.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        more = edges(stored(_tile_pairs(labelled.select("g", "node", "cls", "n", "weight", "label"), tile)))
        labels = components(found.unionByName(stored(more))).withColumnRenamed("node", "cls")
    return labels


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    with scratch(docs.sparkSession) as keep:
        return keep(stored(_linked_documents(docs)))


def _linked_documents(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(_document_rows(docs))
    per_doc = rows.filter(F.col("kind") == DOCUMENT).select("doc_id", "n", "cls")
    heavy = rows.filter(F.col("kind") == HEAVY).groupBy("token").agg(F.sum("n").alias("n"), F.min("cls").alias("name"))
    # At most MAX_HEAVY pairs of longs.
    known = heavy.orderBy(F.desc("n"), "token").limit(MAX_HEAVY).select("token", "name").toPandas()
    tokens, names = known["token"].to_numpy(np.int64).view(np.uint64), known["name"].to_numpy(np.int64)
    order = np.argsort(tokens)
    classes = stored(
        per_doc.filter("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"))
    )
    groups = _groups(_prefixes(docs, tokens[order], names[order]))
    # A point weighs as many as its vector is wider than the narrowest.
    width = F.lit(1)
    for level in range(MAX_LEVEL):
        width = F.when(F.col("n") > PER_GROUP * GROUPS << 3 * level, 8 << 3 * level).otherwise(width)
    members = groups.join(classes, "cls").withColumn("weight", width)
    # Only rows that have another of linkable size in their group need points.
    by_size = Window.partitionBy("g").orderBy("n", "cls")
    close = lambda less, more: less * DEN >= more * NUM
    before, behind = (F.coalesce(f("n").over(by_size), F.lit(0)) for f in (F.lag, F.lead))
    members = members.withColumn("alike", close(before, F.col("n")) | (close(F.col("n"), behind) & (behind > 0))).filter("alike").drop("alike")
    points = rows.filter(F.col("kind") == POINT).select("cls", "level", "vec")
    families = _joined(members, TILE_POINTS, lambda m: _bound_edges(m.select("k", "cls", "label"), points))
    members = families.withColumnRenamed("label", "g").join(classes, "cls").withColumn("weight", F.col("n"))
    labels = _joined(members, TILE, lambda m: _set_edges(m, docs))
    named = classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = named.groupBy("label").agg(F.min("node").alias("component"))
    named = named.join(least, "label").select("cls", "component")
    return per_doc.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def dedup_near(docs: DataFrame) -> DataFrame:
    """One document of each component stays (the smallest id), with the columns of ``docs``.

    Blank documents and rows without an id stay; rows that repeat an id count as one document.
    """
    linked = link_documents(docs)
    stay = linked.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    kept = packed(docs).join(stay, F.col("doc").getField("doc_id").cast("long") == F.col("_id")).dropDuplicates(["_id"])
    return kept.select(*unpacked(docs.columns)).unionByName(docs.filter("doc_id is null"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return link_documents(table(spark, sf_dir, "documents"))
