"""Periodic runs of words: union-find over suffix classes in order of falling common prefix.

The suffixes of a document's words are sorted (prefix doubling, only where a word
sequence stands twice), and neighbours in that order are joined by their common
prefix length, the longest first.  A class of the union-find holds suffixes that
share a prefix of the current length, and keeps their positions in order.  When two
classes meet, positions that become neighbours inside the union have exactly the
current length ``l`` in common; if they stand ``d`` apart and ``d`` is at most
``l / (exponent - 1)``, then a run of period ``d`` and length ``l + d`` starts at the
first of them, unless the word before it goes on with the period.

Why neighbours suffice: if a position stood between the two and in their class, its
nearer distance would be a period of the run as well, and with the longer one
(Fine and Wilf) force a period that divides it.  So the smallest period is found, each run
once, and without a test of all periods.

A document is one row and is worked in memory: some hundred bytes a word, and time of
the order n log n also for one word repeated throughout.  Short documents are worked
``CHUNK_WORDS`` words at a time.  Rows don't meet, so nothing is shuffled.

Edge cases: null and blank texts have no words and no runs; a very long text is
one row, whole; repeated rows and ids are worked each; a null id is kept; an
empty table gives an empty result; extra columns are kept by the operator and ignored by the query.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, run_starts, table, unpacked, words_of

MIN_LENGTH = 6
EXPONENT = 4
BLOCK = 1024
CHUNK_WORDS = 1 << 17
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_codes(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(codes.__getitem__, words), np.int64, len(words))


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order (of the codes), and the common prefix length of each and the next.

    A suffix's rank is its group's first place in the order; only groups of several are sorted
    further.  The ranks after 1, 2, 4, ... words answer the common prefixes by halving.
    """
    n = len(codes)
    size = np.bincount(codes)
    rank, wide = (np.cumsum(size) - size)[codes], np.flatnonzero(size[codes] > 1)
    levels = [rank]
    while len(wide):
        step = 1 << (len(levels) - 1)
        after = wide + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        pair = rank[wide] * (n + 1) + second
        order = np.argsort(pair)
        at, pair = wide[order], pair[order]
        first = pair // (n + 1)
        parts, groups = run_starts(pair), run_starts(first)
        size = np.diff(parts)
        group = np.repeat(groups[:-1], np.diff(groups))
        rank = rank.copy()
        rank[at] = first + np.repeat(parts[:-1], size) - group
        wide = at[np.repeat(size, size) > 1]
        levels.append(rank)
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    common = np.zeros(max(n - 1, 0), np.int64)
    near = np.flatnonzero(levels[0][suffixes[:-1]] == levels[0][suffixes[1:]]) if n else common
    one, two = suffixes[near], suffixes[near + 1] if len(near) else near
    shared = np.zeros(len(near), np.int64)
    for k in reversed(range(len(levels))):
        a, b = one + shared, two + shared
        inside = (a < n) & (b < n)
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]) & (a != b)
        shared += same.astype(np.int64) << k
    common[near] = shared
    return suffixes, common


class Positions:
    """An ordered set of positions in blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, x: int):
        self.blocks, self.firsts, self.size = [[x]], [x], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int, int]:
        """Inserts ``x`` and gives its neighbours, -1 where there is none."""
        k = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[k]
        j = bisect_left(block, x)
        before = block[j - 1] if j else self.blocks[k - 1][-1] if k else -1
        after = block[j] if j < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else -1
        block.insert(j, x)
        self.size += 1
        self.firsts[k] = block[0]
        if len(block) > 2 * BLOCK:
            self.blocks[k : k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.firsts[k : k + 1] = [block[0], block[BLOCK]]
        return before, after


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of several texts, worked as one sequence: each text's codes are its own, so nothing is shared between texts."""
    codes, offset = [], 0
    for words in texts:
        codes.append(word_codes(words) + offset)
        offset += len(words)
    starts = np.cumsum([0, *map(len, texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(np.concatenate([*codes, np.zeros(0, np.int64)]), min_length, exponent):
        k = int(np.searchsorted(starts, start, "right")) - 1
        out[k].append((start - int(starts[k]), length, period))
    return out


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; exponent: at least 2."""
    # The least common prefix that can seed a run of any period.
    least = min(max((exponent - 1) * q, min_length - q) for q in range(1, max(min_length, 2)))
    if len(codes) <= least:
        return []
    suffixes, common = suffix_order(codes)
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    words = codes.tolist() if len(edges) else []
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    runs: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def seed(i: int, j: int, shared: int) -> None:
        d = j - i
        if d * (exponent - 1) <= shared and d + shared >= min_length and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, d + shared, d))

    for t, shared in zip(edges.tolist(), common[edges].tolist()):
        a, b = root(t), root(t + 1)
        small, large = classes.pop(a, None) or Positions(int(suffixes[a])), classes.pop(b, None) or Positions(int(suffixes[b]))
        if small.size > large.size:
            small, large, a, b = large, small, b, a
        parent[a] = b
        mine = list(small)
        last = -1
        for x, coming in zip(mine, [*mine[1:], -1]):
            before, after = large.add(x)
            if before >= 0 and before != last:
                seed(before, x, shared)
            if after >= 0 and not 0 <= coming < after:
                seed(x, after, shared)
            last = x
        classes[b] = large
    return sorted((i, length, d) for i, length, d in runs)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def collapse_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with the repetitions taken out of ``text_col`` (one space between the words that stay).

    Adds ``n_words`` (before) and ``runs``, by start and period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, since, size = [], 0, 0
            for i, text in enumerate(batch["_text"]):
                # bytes.split cuts at ASCII white space only.
                held.append((text.as_py() or "").encode().split())
                size += len(held[-1])
                if size >= CHUNK_WORDS or i == batch.num_rows - 1:
                    yield rows_of(batch["doc"].slice(since, len(held)), held)
                    held, since, size = [], i + 1, 0

    def rows_of(docs: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(texts, min_length, exponent)
        found = [[{"start": s, "length": n, "period": p} for s, n, p in one] for one in runs]
        kept = [collapsed(words, one).decode() for words, one in zip(texts, runs)]
        return pa.RecordBatch.from_arrays(
            [docs, pa.array(kept, pa.string()), pa.array([*map(len, texts)], pa.int64()), pa.array(found, pa.list_(RUN_TYPE))],
            ["doc", "_text", "n_words", "runs"],
        )

    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.lit(True).alias("_"), *others).alias("doc"), F.col(text_col).alias("_text"))
    out = rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, _text string, n_words bigint, runs {RUNS}")
    fresh = {text_col: F.col("_text"), "n_words": F.col("n_words"), "runs": F.col("runs")}
    return out.select(*unpacked(list(dict.fromkeys([*docs.columns, "n_words", "runs"])), **fresh))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32(doc_id) % 10 is 0, the words from one on repeat a period."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10).cast("long")

    def rewritten(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    text = F.when(h % 10 == 0, let(words_of(F.col("text")), rewritten)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    found = collapse_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.short")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
