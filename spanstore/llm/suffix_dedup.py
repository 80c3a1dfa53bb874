"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

A window is a string of ``WINDOW`` bytes inside one document; bytes covered by a
window that also starts anywhere else are removed.

*Cover.*  A difference cover is a sample of positions such that any two equal
strings hold sampled positions at the same distance.  Here the text chooses it:
each window p has an anchor m(p), the position with the least hash of a
``GRAM``-byte string among those the window holds, so equal windows have their
anchors at the same distance.  Only anchors are sampled suffixes, about one in
forty bytes, and suffixes to be compared always have one gram at their anchor, so
the sort runs gram by gram.  An anchor whose gram no other anchor has settles all
its windows (none repeats), and a surrounding (the string all windows of an anchor
cover) that stands at two anchors settles them too (all repeat).

*Sort.*  What is left open:
1. The right contexts of a gram's anchors are cut into words of eight bytes; triples
   of words are sorted and named, triples of names are sorted and named again
   (the recursion), and one more triple, 27 words, is longer than a window:
   its name is the rank of the sampled suffix.  The left contexts are sorted alike.
2. Suffixes that start ``d`` bytes before an anchor, the ones not sampled, are merged by
   their leading ``d`` bytes and the order of the suffix at the anchor.
3. Neighbours in the order are compared: those that share ``WINDOW`` bytes repeat.

Every comparison of step 3 is on bytes; hashes only bring together what is to be
compared (a gram's 64 bits) or state the equality of a surrounding (gram and
64 more bits).  A text is known by its 128-bit hash, and equal texts count as one that
stands several times.  A gram with more than ``SPLIT`` surroundings is split by the
bytes around it.  A text moves only if it has open windows or bytes to lose.  A gram
of very many anchors (a passage that many texts share) is settled by counts of its
surroundings, added up before they move, instead of by one task that reads them all.

Edge cases: a null text is empty; texts shorter than a window lose nothing;
repeated rows are copies of each other; windows may overlap themselves in a
periodic text; a text is held whole by one worker, with some ten arrays of its length;
an empty table gives an empty result.  Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_runs, maybe_among, run_starts, scratch, stored, table
from .textgrams import Powers, mix64

WINDOW = 200
GRAM = 32
WORD = 8  # bytes of a letter of the sort
SPLIT = 20_000
AT_ONCE = 20_000  # contexts sorted together
# A gram or surrounding is hot if it has more than this many anchors and more than this share of all: at most 1 / share are.
HOT, HOT_SHARE = 1000, 1 / 20_000
OUT_BYTES = 1 << 23

_POWERS = (Powers(), Powers(0xD1B54A32D192ED03))


class Prints:
    """Fingerprints of substrings of one text from prefix sums."""

    def __init__(self, raw: np.ndarray, which: int):
        self.up, self.down = _POWERS[which].upto(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x, lo, hi, gram print): anchors in order, and the windows lo..hi each one has."""
    n, span = len(raw), WINDOW - GRAM + 1
    if n < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    at = np.arange(n - GRAM + 1)
    gram = Prints(raw, 0).of(at, at + GRAM)
    # Least (hash, position) of each window: prefix and suffix minima of blocks as wide as a window.
    value = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    blocks = -(-len(value) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    padded = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(padded, axis=1).reshape(-1)
    windows = n - WINDOW + 1
    best = np.minimum(ahead[:windows], behind[span - 1 : span - 1 + windows])
    place = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = run_starts(place)
    x = place[cut[:-1]]
    return x, cut[:-1], cut[1:] - 1, gram[x]


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


LETTER = "g long, block long, row binary, x int, lo int, hi int"


def _letters(docs: DataFrame) -> DataFrame:
    """Anchors of every text, once a split: gram, surrounding, text, place, first and last window."""
    names = ["g", "block", "row", "x", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out: list[tuple] = []
            rows: list[bytes] = []
            for row, text in zip(batch["row"].to_pylist(), batch["text"].to_pylist()):
                if row in seen:
                    continue
                seen.add(row)
                raw = _raw(text)
                x, lo, hi, gram = anchors(raw)
                if not len(x):
                    continue
                block = Prints(raw, 1).of(lo, hi + WINDOW) ^ mix64(((x - lo) * 1024 + (hi - lo)).astype(np.uint64))
                out.append((gram.view(np.int64), block.view(np.int64), x.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)))
                rows += [row] * len(x)
            if out:
                g, block, x, lo, hi = (pa.array(np.concatenate(c)) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([g, block, pa.array(rows, pa.binary()), x, lo, hi], names)

    return docs.mapInArrow(run, LETTER)


def _settled(letters: DataFrame) -> DataFrame:
    """Letters whose gram stands in two places at least, as they stream by in order: ``known`` if the
    surrounding stands twice, ``lead`` for the first letter of each surrounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, (None, None)  # the last row, which waits for its next neighbour, and the gram and surrounding before it

        def decided(t: pa.RecordBatch, last: bool) -> pa.RecordBatch | None:
            nonlocal held, before
            g, block = (t[c].to_numpy(zero_copy_only=False) for c in ("g", "block"))
            same_g = np.concatenate([[g[0] == before[0]], g[1:] == g[:-1], [False]])
            same = np.concatenate([[same_g[0] and block[0] == before[1]], same_g[1:-1] & (block[1:] == block[:-1]), [False]])
            n = len(g) if last else len(g) - 1
            held = None if last else t.slice(n)
            if n:
                before = (g[n - 1], block[n - 1])
            take = (same_g[:-1] | same_g[1:])[:n]
            known, lead = (same[:-1] | same[1:])[:n], ~same[:-1][:n]
            take &= known | lead
            if not take.any():
                return None
            mask = pa.array(take)
            columns = [pc.filter(t[c].slice(0, n), mask) for c in ("g", "row", "x", "lo", "hi")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(known[take]), pa.array(lead[take])], ["g", "row", "x", "lo", "hi", "known", "lead"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            # The same letter from another split is the next row.
            g, block, x = (t[c].to_numpy(zero_copy_only=False) for c in ("g", "block", "x"))
            twin = np.concatenate([[False], (g[1:] == g[:-1]) & (block[1:] == block[:-1]) & (x[1:] == x[:-1])])
            if twin.any():
                rows = t["row"]
                at = np.flatnonzero(twin)
                twin[at] = pc.equal(rows.take(pa.array(at)), rows.take(pa.array(at - 1))).to_numpy(zero_copy_only=False)
                t = pa.RecordBatch.from_arrays([pc.filter(c, pa.array(~twin)) for c in t.columns], t.schema.names)
            out = decided(t, False)
            if out is not None:
                yield out
        if held is not None:
            out = decided(held, True)
            if out is not None:
                yield out

    ordered = letters.repartition("g").sortWithinPartitions("g", "block", "x", "row")
    return ordered.mapInArrow(run, "g long, row binary, x int, lo int, hi int, known boolean, lead boolean")


def _settled_hot(letters: DataFrame, limit: int) -> DataFrame:
    """The same of hot grams: surroundings are counted, and only those of at most ``limit`` letters meet them in a shuffle."""
    one = stored(letters.dropDuplicates(["g", "block", "x", "row"]))
    place = F.struct("x", "row")
    about = stored(one.groupBy("g", "block").agg(F.count("*").alias("n"), F.min(place).alias("first")))
    heavy = F.broadcast(about.filter(F.col("n") > limit))
    rest = one.join(heavy, ["g", "block"], "left_anti").join(about, ["g", "block"])
    return one.join(heavy, ["g", "block"]).unionByName(rest).select(
        "g", "row", "x", "lo", "hi", (F.col("n") > 1).alias("known"), (place == F.col("first")).alias("lead")
    )


def _asked(settled: DataFrame, hot: DataFrame, split: int) -> DataFrame:
    """(g, row, x, first, last, open, wide): the windows whose contexts are to be sorted.

    In a gram's group every distance from the anchor that is open somewhere is shown
    by one letter of each surrounding that has it.  hot: the same columns, of hot grams.
    """
    distance = lambda c: F.when(~F.col("known"), F.col("x") - F.col(c))
    about = {"far": F.max(distance("lo")), "near": F.min(distance("hi")), "many": F.count("*")}
    group = Window.partitionBy("g")
    rows = settled.filter("lead").select("*", *(c.over(group).alias(name) for name, c in about.items()))
    leads = hot.filter("lead")
    of_hot = leads.groupBy("g").agg(*(c.alias(name) for name, c in about.items()))
    rows = rows.unionByName(leads.join(F.broadcast(of_hot), "g"))
    return rows.select(
        "g", "row", "x", F.greatest(F.col("lo"), F.col("x") - F.col("far")).alias("first"), F.least(F.col("hi"), F.col("x") - F.col("near")).alias("last"),
        (~F.col("known")).alias("open"), (F.col("many") > split).alias("wide"),
    ).filter((F.col("first") <= F.col("last")) & F.col("far").isNotNull() & (F.col("many") > 1))


def _listed(column: pa.ListArray, *names: str) -> Iterator[list[np.ndarray]]:
    """The fields of a list<struct> column, one list of arrays a row, without Python objects."""
    at = column.offsets.to_numpy() - column.offsets[0].as_py()
    fields = [column.flatten().field(n).to_numpy(zero_copy_only=False) for n in names]
    for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
        yield [f[s:e] for f in fields]


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(k, row, x, first, last, open, bytes): the bytes that the windows of each asked letter cover, by the group k they are sorted in.

    A letter of a wide gram goes to one group for its windows that hold the bytes on the right of the
    anchor, and to another for those that hold the bytes on its left: groups are split by these bytes.
    """
    half = (WINDOW - GRAM) // 2
    goals = stored(asked.groupBy("row").agg(F.collect_list(F.struct("g", "x", "first", "last", "open", "wide")).alias("goals")).withColumnRenamed("row", "_row"))
    key = F.xxhash64("row")
    texts = maybe_among(docs.withColumn("_key", key), "_key", goals.select(F.xxhash64("_row"))).select("row", "text").dropDuplicates(["row"])
    texts = texts.join(goals, F.col("row") == F.col("_row")).select("row", "text", "goals")
    names = ["k", "row", "x", "first", "last", "open", "bytes"]

    def together(parts: list[tuple]) -> pa.RecordBatch:
        k, x, first, last, open_ = (np.concatenate(c) for c in list(zip(*parts))[2:])
        rows = pa.array([row for row, cut, *_ in parts for _ in cut], pa.binary())
        cut = pa.array([c for _, cut, *_ in parts for c in cut], pa.binary())
        ints = (pa.array(v.astype(np.int32)) for v in (x, first, last))
        return pa.RecordBatch.from_arrays([pa.array(k), rows, *ints, pa.array(open_ > 0), cut], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held_bytes = [], 0
        for batch in batches:
            for row, text, got in zip(batch["row"].to_pylist(), batch["text"].to_pylist(), _listed(batch["goals"], "g", "x", "first", "last", "open", "wide")):
                g, x, first, last, open_, wide = (v.astype(np.int64) for v in got)
                raw = _raw(text)
                if wide.any():
                    prints = Prints(raw, 1)
                    w = np.flatnonzero(wide)
                    right, left = w[last[w] >= x[w] - half], w[first[w] < x[w] - half]
                    ends = np.minimum(x[right] + WINDOW - half, len(raw))
                    keys = [mix64(g[right].view(np.uint64) ^ prints.of(x[right], ends)), mix64(g[left].view(np.uint64) ^ ~prints.of(x[left] - half - 1, x[left] + GRAM))]
                    n = np.flatnonzero(wide == 0)
                    g = np.concatenate([g[n], *(k.view(np.int64) for k in keys)])
                    first = np.concatenate([first[n], np.maximum(first[right], x[right] - half), first[left]])
                    last = np.concatenate([last[n], last[right], np.minimum(last[left], x[left] - half - 1)])
                    which = np.concatenate([n, right, left])
                    x, open_ = x[which], open_[which]
                held = raw.tobytes()
                parts.append((row, [held[a:b] for a, b in zip(first.tolist(), (last + WINDOW).tolist())], g, x, first, last, open_))
                held_bytes += int((last - first + WINDOW).sum())
                if held_bytes > OUT_BYTES:
                    yield together(parts)
                    parts, held_bytes = [], 0
        if parts:
            yield together(parts)

    return texts.mapInArrow(run, "k long, row binary, x int, first int, last int, open boolean, bytes binary")


def _named_triples(names: np.ndarray) -> np.ndarray:
    """Order-preserving names of the triples of columns of ``names``, equal for equal triples."""
    k, width = names.shape
    padded = np.zeros((k, -(-width // 3) * 3), names.dtype)
    padded[:, :width] = names
    triples = padded.reshape(-1, 3)
    order = np.lexsort((triples[:, 2], triples[:, 1], triples[:, 0]))
    ordered = triples[order]
    new = np.ones(len(order), np.int64)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out.reshape(k, -1)


def _ranked(context: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): the rows of a byte matrix sorted inside their groups, and the bytes each shares with the one
    before it (-1 at the start of a group).  Triples of words are named, then triples of names, until one name is left."""
    k, width = context.shape
    padded = np.zeros((k, -(-width // WORD) * WORD), np.uint8)
    padded[:, :width] = context
    names = padded.view(">u8").astype(np.uint64)
    while names.shape[1] > 1:
        names = _named_triples(names)
    order = np.lexsort((names[:, 0], group))
    differs = context[order[1:]] != context[order[:-1]]
    shared = np.full(k, -1, np.int64)
    shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    shared[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, shared


def _classes(context: np.ndarray, group: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each row and depth, the place in the order where its run of rows with equal first ``depth`` bytes begins."""
    order, shared = _ranked(context, group)
    begins = np.where(shared[:, None] < depths[None, :], np.arange(len(order))[:, None], 0)
    out = np.empty((len(order), len(depths)), np.int64)
    out[order] = np.maximum.accumulate(begins, axis=0)
    return out


def repeated_distances(group: np.ndarray, ahead: np.ndarray, after: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """(rows x distances) whether the window that starts d bytes before a row's anchor also starts d bytes
    before another anchor of its group.

    A row's context begins ``ahead`` bytes before its anchor, and its windows have distances after..ahead.
    """
    k, most = len(group), int(ahead.max()) + 1
    right, left = np.zeros((k, WINDOW), np.uint8), np.zeros((k, max(most, 1)), np.uint8)
    sizes = np.asarray([len(c) for c in contexts])
    flat, start = np.frombuffer(b"".join(contexts), np.uint8), np.cumsum(sizes) - sizes
    for matrix, count, at, step in ((right, sizes - ahead, start + ahead, 1), (left, ahead, start + ahead - 1, -1)):
        row = np.repeat(np.arange(k), count)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        matrix[row, place] = flat[np.repeat(at, count) + step * place]
    distances = np.arange(most)
    behind, front = _classes(left, group, distances), _classes(right, group, WINDOW - distances)
    row, d = np.nonzero((distances >= after[:, None]) & (distances <= ahead[:, None]))
    # Merged by the distance, the leading bytes and the order at the anchor; equal neighbours share WINDOW bytes.
    merged = (d * (k + 1) + behind[row, d]) * (k + 1) + front[row, d]
    order = np.argsort(merged, kind="stable")
    twin = merged[order[1:]] == merged[order[:-1]]
    again = np.zeros(len(order), bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    out = np.zeros((k, most), bool)
    out[row[again], d[again]] = True
    return out


def _merged(contexts: DataFrame) -> DataFrame:
    """(row, start, end): spans of the open windows that stand twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, "k"):
            k = batch["k"].to_numpy(zero_copy_only=False)
            starts = run_starts(k)
            # As many whole groups at a time as hold about AT_ONCE contexts.
            cuts = np.unique(np.concatenate([[0], starts[np.searchsorted(starts, np.arange(AT_ONCE, len(k) + AT_ONCE, AT_ONCE), "left").clip(max=len(starts) - 1)]]))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(s, e - s)
                x, first, last = (part[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("x", "first", "last"))
                again = repeated_distances(k[s:e], x - first, x - last, part["bytes"].to_pylist())
                again &= part["open"].to_numpy(zero_copy_only=False)[:, None]
                edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
                row, near = np.nonzero(edge == 1)
                _, far = np.nonzero(edge == -1)
                if len(row):
                    columns = [part["row"].take(pa.array(row)), pa.array((x[row] - far + 1).astype(np.int32)), pa.array((x[row] - near + WINDOW).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "start", "end"])

    return contexts.repartition("k").sortWithinPartitions("k").mapInArrow(run, "row binary, start int, end int")


def repeated_spans(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """(row, spans): byte spans [start, end) of repeated windows, sorted but perhaps touching.  docs: (row, text), row the text's own key."""
    with scratch(docs.sparkSession) as keep:
        letters = stored(_letters(docs))
        limit = max(HOT, int(letters.count() * HOT_SHARE))
        hot = stored(letters.groupBy("g").count().filter(F.col("count") > limit).select("g"))
        settled = stored(_settled(letters.join(F.broadcast(hot), "g", "left_anti")))
        settled_hot = stored(_settled_hot(letters.join(F.broadcast(hot), "g"), limit))
        open_ = stored(_merged(_contexts(docs, _asked(settled, settled_hot, split))))
        known = settled.unionByName(settled_hot).filter("known").select("row", F.col("lo").alias("start"), (F.col("hi") + WINDOW).alias("end"))
        size = F.octet_length("text")
        copies = docs.select("row", size.alias("end")).groupBy("row", "end").agg(F.count("*").alias("n"))
        copies = copies.filter((F.col("n") > 1) & (F.col("end") >= WINDOW)).select("row", F.lit(0).alias("start"), "end")
        found = known.unionByName(open_).unionByName(copies)
        return keep(stored(found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(rows, changed): all rows as (id, text, row), and (row, runs, kept) of those that lose bytes.

    runs are the maximal removed byte spans, kept the bytes that stay.  Rows of equal texts share a ``row``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("row"))
    found = repeated_spans(rows.select("row", "text"), split)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for text, (start, end) in zip(batch["text"].to_pylist(), _listed(batch["spans"], "start", "end")):
                raw = _raw(text)
                size = len(raw) + 1
                gone = np.cumsum(np.bincount(start, minlength=size) - np.bincount(end, minlength=size))[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                runs.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(raw[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(runs, span), pa.array(kept, pa.binary())], ["row", "runs", "kept"])

    texts = maybe_among(rows.withColumn("_key", F.xxhash64("row")), "_key", found.select(F.xxhash64("row"))).select("row", "text")
    texts = texts.dropDuplicates(["row"]).join(found, "row").select("row", "text", "spans")
    changed = texts.mapInArrow(cut, "row binary, runs array<struct<start:long,end:long>>, kept binary")
    return rows, changed


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, changed = remove_repeats(docs)
    narrow = rows.select(F.col("id").alias("doc_id"), "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    digest = changed.select(
        "row", F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("removed"),
        F.size("runs").cast("long").alias("runs"), F.sha2("kept", 256).alias("kept"),
    )
    zero = F.lit(0).cast("long")
    return narrow.join(digest, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("removed", zero).alias("n_removed"), F.coalesce("runs", zero).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )
