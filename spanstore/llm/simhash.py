"""SimHash near-duplicates by a segment-popcount embedding and a grid join.

A document's fingerprint has a bit where more than half of its shingles' hashes have
it.  A fingerprint is embedded as the counts of set bits in its 32 segments of two
bits each: no two embedded points are farther apart (Manhattan distance) than their
fingerprints (Hamming distance), so the embedding can only let too many pairs through.

The grid join: the 32 coordinates are dealt to ``blocks`` blocks.  Points at most 3 apart
differ in at most 3 blocks, so they agree in all others; a grid over each choice of
``blocks - 3`` blocks puts them into one cell at least once.  More blocks mean more grids
and finer cells; their number follows that of the fingerprints.  Inside a cell the
Manhattan distance prunes and the fingerprints themselves decide.

Equal fingerprints are one point, so copies cost nothing.  Cells of more than ``CELL``
points are dense clusters: their points are dealt again to finer grids, and what is crowded
in the finest is met tile by tile.  No group gives all its pairs, only a star for each
component that it holds.  Counts are kept in unary, so that one XOR and a population
count give the Manhattan distance.

Edge cases: null and blank texts have fingerprint zero and are linked as any other;
a text of fewer words than a shingle is one shingle; a very long text is hashed
piece by piece, whole; rows without an id have a fingerprint, link with nothing and
have a null component; rows that repeat an id are worked each; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_skewed, scratch, stored, table
from .components import components

SHINGLE = 3
SEED = 42
BITS = 3
SEGMENTS = 32
# A pair of random counts of two bits agrees with this probability.
AGREE = 3 / 8
COMPANY = 32
BLOCKS, MAX_BLOCKS, FINER = 4, 10, 2
CELL = 1024
TILE = 512
PIECE = 1 << 16
ODD = 0x5555555555555555


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64 bits that more than half of the shingles' hashes have, as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    line, size = b" ".join(words), min(size, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - size + 1], ends[size - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        spans = zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of rows (doc_id, text); fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), size) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def unary_counts(fp: Column) -> Column:
    """The count of each two-bit segment in unary, in the segment's place."""
    odd, low = F.lit(ODD), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(low).bitwiseAND(odd).bitwiseOR(F.shiftleft(fp.bitwiseAND(low).bitwiseAND(odd), 1))


def _unary(fps: np.ndarray) -> np.ndarray:
    odd, one = np.uint64(ODD), np.uint64(1)
    return ((fps | fps >> one) & odd) | ((fps & fps >> one) & odd) << one


def grids(blocks: int, bits: int = BITS) -> list[int]:
    """The coordinates that each grid fixes, as signed masks over the unary counts."""
    part = [sum(3 << 2 * c for c in range(b, SEGMENTS, blocks)) for b in range(blocks)]
    masks = [sum(part[b] for b in chosen) for chosen in combinations(range(blocks), blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(points: int) -> int:
    """The fewest blocks with which a point shares a cell with about ``COMPANY`` others at most."""
    fits = (b for b in range(BLOCKS, MAX_BLOCKS) if points * AGREE ** (SEGMENTS * (b - BITS) / b) <= COMPANY)
    return next(fits, MAX_BLOCKS)


def _cells(points: DataFrame, blocks: int) -> DataFrame:
    """(grid, cell, fp): the cell of each point in each grid."""
    at = [F.struct(F.lit(i).alias("grid"), unary_counts(F.col("fp")).bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(grids(blocks))]
    return points.select("fp", F.explode(F.array(*at)).alias("at")).select("at.grid", "at.cell", "fp")


def linked_stars(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Each point that links to others of the group, and the first point of its component."""
    counts = _unary(fps)
    near = np.argwhere(np.triu(np.bitwise_count(counts[:, None] ^ counts[None, :]) <= bits, 1))
    near = near[np.bitwise_count(fps[near[:, 0]] ^ fps[near[:, 1]]) <= bits]
    label = np.arange(len(fps))
    while len(near):
        least = np.minimum(label[near[:, 0]], label[near[:, 1]])
        new = label.copy()
        np.minimum.at(new, near[:, 0], least)
        np.minimum.at(new, near[:, 1], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    on = np.flatnonzero(label != np.arange(len(fps)))
    return on, label[on]


def _stars(groups: DataFrame) -> DataFrame:
    """(a, b) of groups (fps: array of points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch["fps"]:
                fps = group.values.to_numpy().view(np.uint64)
                on, root = linked_stars(fps)
                if len(on):
                    yield pa.RecordBatch.from_arrays([pa.array(fps[x].view(np.int64)) for x in (on, root)], ["a", "b"])

    return groups.filter(F.size("fps") > 1).mapInArrow(run, "a long, b long")


def grid_links(points: DataFrame, n: int, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """(a, b): edges that span the components of ``n`` distinct points (fp) at most 3 bits apart."""
    blocks, edges = blocks_for(n), []
    while True:
        cells = stored(_cells(points, blocks))
        key = ["grid", "cell"]
        crowded = stored(cells.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > cell))
        if crowded.isEmpty():
            edges.append(_stars(cells.groupBy(*key).agg(F.collect_list("fp").alias("fps"))))
            break
        spread = join_skewed(cells, crowded, key, "n", anti=True)
        edges.append(stored(_stars(spread.groupBy(*key).agg(F.collect_list("fp").alias("fps")))))
        inside = stored(join_skewed(cells, crowded, key, "n"))
        if blocks >= MAX_BLOCKS:
            edges.append(_tile_stars(inside, key, tile))
            break
        points, blocks = stored(inside.select("fp").distinct()), min(blocks + FINER, MAX_BLOCKS)
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _tile_stars(rows: DataFrame, key: list[str], tile: int) -> DataFrame:
    """Edges inside crowded cells (grid, cell, n, fp): tiles of about ``tile`` points meet in pairs, a pair a group."""
    parts = F.ceil(F.col("n") / tile).cast("int")
    tiles = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = tiles.groupBy(*key, "parts", "part").agg(F.collect_list("fp").alias("fps"))
    met = tiles.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.groupBy(*key, F.least("part", "with").alias("one"), F.greatest("part", "with").alias("two"))
    return _stars(met.agg(F.flatten(F.collect_list("fps")).alias("fps")))


def link_fingerprints(rows: DataFrame, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """``rows`` (doc_id, fp) with ``component_id``, the smallest doc_id reachable by links."""
    with scratch(rows.sparkSession) as keep:
        points = stored(rows.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
        labels = components(stored(grid_links(points.select("fp"), points.count(), cell, tile))).withColumnRenamed("node", "fp")
        # Points on their own are not in ``labels``; those in it take the least id of their component.
        linked = stored(points.join(labels, "fp"))
        least = linked.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("many"))
        known = join_skewed(linked, stored(least), ["label"], "many").select("fp", "component_id", "n")
        alone = points.join(labels, "fp", "left_anti").select("fp", F.col("least").alias("component_id"), "n")
        named = stored(known.unionByName(alone))
        nameless = rows.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
        return keep(stored(join_skewed(rows.filter("doc_id is not null"), named, ["fp"], "n").drop("n").unionByName(nameless)))


def simhash_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text)."""
    with scratch(docs.sparkSession) as keep:
        rows = stored(with_fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), size))
        return keep(link_fingerprints(rows)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))
