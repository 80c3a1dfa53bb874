"""Vector code compression: product quantisation over value dictionaries.

Components become integers ``floor(SCALE x)``.  Rows are packed once into blocks of at most
``BLOCK_ROWS`` vectors that hold, for each dimension, the distinct integers that stand in the block
and a code of two bytes for each vector.  Each round tabulates, a dimension at a time,
the squared differences of every distinct integer to all codebook entries; the
distance of a vector's part to an entry is then a sum of gathers from these tables by code, and what
an entry gathers is the number of vectors by (code, entry) times the integers.  A task gives
one row for each sum it has, so a round shuffles next to nothing and the driver
gets at most parts x entries x (width / parts + 1) sums, whatever the table's size.

All arithmetic is exact: where squares could leave 64 bits, integers of any length are
used, and sums travel as limbs of 40 bits.

Edge cases: null vectors and vectors with null or non-finite components are dropped;
shorter vectors count as padded with zeros, up to a multiple of ``PARTS``; rows without an id
are coded as all others and stand behind them in the order of ids; rows that repeat an id count
each, and the least of an id's vectors starts a codebook entry; fewer than
``ENTRIES`` ids make fewer entries; equal entries tie to the lower index; an error that 64 bits do not hold is
null, and so is its label's; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_skewed, scratch, stored, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_ROWS = 1 << 16
BLOCK_CELLS = 1 << 22
LIMB = 40
SAFE = 1 << 62
LONGEST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def scaled(x: float) -> int:
    """``floor(SCALE x)``, exact also where a double would overflow."""
    return math.floor(x * SCALE) if abs(x) < 1 << 40 else int(x) * SCALE


def integers(values: np.ndarray) -> np.ndarray:
    """The integers of dictionary values: int64, or Python integers where they are large."""
    if np.abs(values).max(initial=0) < 1 << 40:
        return np.floor(values * SCALE).astype(np.int64)
    return np.asarray([scaled(x) for x in values.tolist()], object)


def pack(vectors: DataFrame, width: int, carried: list[str]) -> DataFrame:
    """Blocks (carried columns as arrays, dictionaries, codes) of rows (carried columns, v).

    A dictionary holds the floors divided by ``SCALE``, which doubles do exactly at any size.
    """
    most = max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(width, 1)))

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        lists = rows["v"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        cells = np.zeros((rows.num_rows, width))
        cells[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        small = np.abs(cells) < 1 << 40
        cells = np.where(small, np.floor(np.where(small, cells, 0) * SCALE) / SCALE, cells)
        codes, values = np.zeros(cells.shape, np.uint16), []
        for j in range(width):
            distinct, codes[:, j] = np.unique(cells[:, j], return_inverse=True)
            values.append(distinct)
        whole = lambda c: pa.ListArray.from_arrays([0, rows.num_rows], rows[c].combine_chunks())
        return pa.RecordBatch.from_arrays(
            [*map(whole, carried), pa.array([values], pa.list_(pa.list_(pa.float64()))), pa.array([codes.tobytes()], pa.binary())], [*carried, "values", "codes"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, most - n)
                held.append(taken)
                n, batch = n + taken.num_rows, batch.slice(taken.num_rows)
                if n == most:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    kinds = [f"`{c}` array<{vectors.schema[c].dataType.simpleString()}>" for c in carried]
    return vectors.select(*carried, "v").mapInArrow(run, ", ".join([*kinds, "values array<array<double>>", "codes binary"]))


@dataclass
class Codebooks:
    """entries[e][j]: component j of entry e of the part that holds dimension j."""

    entries: list[list[int]]
    width: int
    parts: int

    def part(self, m: int) -> range:
        return range(m * self.width // self.parts, (m + 1) * self.width // self.parts)

    def assigned(self, values: list[np.ndarray], codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, nearest entry of each vector, its squared distance), from tables of dictionary values against entries."""
        largest = max((abs(x) for e in self.entries for x in e), default=0)
        for m in range(self.parts):
            dims = self.part(m)
            reach = max((int(np.abs(values[j]).max(initial=0)) for j in dims), default=0) + largest
            kind = np.int64 if reach * reach * len(dims) < SAFE else object
            far = np.zeros((len(codes), len(self.entries)), kind)
            for j in dims:
                entry = np.asarray([e[j] for e in self.entries], kind)
                difference = values[j].astype(kind)[:, None] - entry[None, :]
                far += (difference * difference)[codes[:, j]]
            nearest = far.argmin(axis=1)
            yield m, nearest, far[np.arange(len(far)), nearest]

    def digest(self) -> str:
        """All entries' components by part, entry and place."""
        said = (str(e[j]) for m in range(self.parts) for e in self.entries for j in self.part(m))
        return hashlib.sha256(",".join(said).encode()).hexdigest()


def _unpacked(batch: pa.RecordBatch, i: int, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    values = [integers(np.asarray(v, np.float64)) for v in batch["values"][i].as_py()]
    return values, np.frombuffer(batch["codes"][i].as_py(), np.uint16).reshape(-1, width) if width else np.zeros((0, 0), np.uint16)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, rest, k = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        yield k, sign * (rest & ((1 << LIMB) - 1))
        rest, k = rest >> LIMB, k + 1


def refined(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over all vectors."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        k = len(now.entries)
        count, total = np.zeros((now.parts, k), object), np.zeros((k, now.width), object)
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _unpacked(batch, i, now.width)
                for m, nearest, _ in now.assigned(values, codes):
                    count[m] += np.bincount(nearest, minlength=k)
                    for j in now.part(m):
                        met = np.bincount(codes[:, j].astype(np.int64) * k + nearest, minlength=len(values[j]) * k).reshape(-1, k)
                        exact = int(np.abs(values[j]).max(initial=0)) * len(codes) < SAFE
                        total[:, j] += values[j] @ met if exact else values[j].astype(object) @ met.astype(object)
        out = [(m, e, -1, limb, v) for m in range(now.parts) for e in range(k) for limb, v in _limbs(int(count[m, e]))]
        out += [(m, e, j, limb, v) for m in range(now.parts) for e in range(k) for j in now.part(m) for limb, v in _limbs(int(total[e, j]))]
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()])], ["part", "entry", "place", "limb", "v"]
        )

    sums = blocks.select("values", "codes").mapInArrow(run, "part int, entry int, place int, limb int, v long")
    found: dict[tuple[int, int, int], int] = {}
    for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("v").alias("v")).collect():
        key = (r["part"], r["entry"], r["place"])
        found[key] = found.get(key, 0) + (r["v"] << LIMB * r["limb"])
    entries = [list(e) for e in books.entries]
    for m in range(books.parts):
        for e, entry in enumerate(entries):
            n = found.get((m, e, -1), 0)
            for j in books.part(m) if n else ():
                entry[j] = found.get((m, e, j), 0) // n
    return Codebooks(entries, books.width, books.parts)


def coded(blocks: DataFrame, books: Codebooks, carried: list[str]) -> DataFrame:
    """(carried columns, code, error) of every vector: the code has a byte for each part; a null error is beyond 64 bits."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _unpacked(batch, i, now.width)
                n = len(batch[carried[0]][i])
                code, error = np.zeros((n, now.parts), np.uint8), np.zeros(n, object)
                for m, nearest, far in now.assigned(values, codes) if now.width else ():
                    code[:, m] = nearest
                    error += far
                yield pa.RecordBatch.from_arrays(
                    [batch[c][i].values for c in carried]
                    + [pa.array([row.tobytes() for row in code], pa.binary()), pa.array([x if x <= LONGEST else None for x in map(int, error)], pa.int64())],
                    [*carried, "code", "error"],
                )

    kinds = [f"`{c}` {blocks.schema[c].dataType.elementType.simpleString()}" for c in carried]
    return blocks.mapInArrow(run, ", ".join([*kinds, "code binary", "error long"]))


def compress(
    vectors: DataFrame, carried: list[str], id_col: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """(carried columns, code, error) of every usable vector of ``vectors`` (carried columns, v), and the codebooks.

    ``id_col``, one of the carried columns, chooses the first entries.  At most 256 entries.  Without vectors
    there are no codebooks.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(usable(F.col("v")))
    with scratch(spark) as keep:
        longest = kept.agg(F.max(F.size("v"))).first()[0]
        width = -(-(longest or 0) // parts) * parts
        blocks = stored(pack(kept, width, carried))
        books = None
        if longest is not None:
            # As many ids as the codebook has entries, and one vector of each.
            first = kept.select(F.col(id_col).alias("_id")).distinct().orderBy(F.col("_id").asc_nulls_last()).limit(entries)
            starts = kept.join(F.broadcast(first), F.col(id_col).eqNullSafe(F.col("_id"))).groupBy("_id").agg(F.min("v").alias("v"))
            rows = starts.orderBy(F.col("_id").asc_nulls_last()).collect()
            books = Codebooks([[scaled(float(x)) for x in r["v"]] + [0] * (width - len(r["v"])) for r in rows], width, parts)
            for _ in range(rounds if width else 0):
                books = refined(blocks, books)
        return keep(stored(coded(blocks, books or Codebooks([], width, parts), carried))), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null")).alias("label"), F.col("embedding").alias("v"))
    with scratch(spark) as keep:
        found, books = compress(rows, ["vec_id", "label"])
        whole = F.sum(F.col("error").cast("decimal(38,0)"))
        by_label = found.groupBy("label").agg(
            F.when((F.count("error") == F.count("*")) & (whole <= LONGEST), whole.cast("long")).alias("label_error"), F.count("*").alias("n")
        )
        out = join_skewed(found, stored(by_label), ["label"], "n")
        digest = books.digest() if books else ""
        hexed = F.lower(F.hex("code"))
        return keep(stored(out.select("vec_id", hexed.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))))


def _sql() -> str:
    """The same in SQL: cells, then a codebook and an assignment for each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), wide AS (SELECT ceil(max(len(embedding)) / {PARTS}.0)::BIGINT * {PARTS} AS width FROM kept
), cells AS MATERIALIZED (
  SELECT r, (j // (width // {PARTS}))::INTEGER AS part, j, coalesce(floor({SCALE} * embedding[j + 1]::DOUBLE), 0)::BIGINT AS x
  FROM kept, wide, unnest(range(width)) AS t(j)
), starts AS (
  SELECT min_by(r, embedding) AS r, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS entry
  FROM kept GROUP BY vec_id ORDER BY vec_id NULLS LAST LIMIT {ENTRIES}
), book0 AS MATERIALIZED (SELECT entry, part, j, x AS c FROM starts JOIN cells USING (r))"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(far, entry)) AS best FROM (
    SELECT r, b.part, entry, sum((x - c) * (x - c))::BIGINT AS far FROM cells a JOIN book{i} b ON a.j = b.j GROUP BY r, b.part, entry
  ) GROUP BY r, part
)""")
        if i < ROUNDS:
            steps.append(f"""mean{i} AS (
  SELECT n.part, n.best.entry AS entry, j, sum(x)::HUGEINT AS s, count(*) AS n FROM near{i} n JOIN cells a ON a.r = n.r AND a.part = n.part GROUP BY ALL
), book{i + 1} AS MATERIALIZED (
  SELECT b.entry, b.part, b.j, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c FROM book{i} b LEFT JOIN mean{i} m ON m.j = b.j AND m.entry = b.entry
)""")
    steps.append(f"""codes AS (
  SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.far)::BIGINT AS error FROM near{ROUNDS} GROUP BY r
), named AS (
  SELECT vec_id, label, code, error FROM codes JOIN kept USING (r)
), digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM named, digest""")
    return "WITH " + ", ".join(steps)


OP12_SQL = _sql()
