"""Substring index: which units may hold a needle, by the three-letter pieces of their texts.

``postings`` (gram, n, units) and ``counts`` (gram, n) lie below a shared folder as
Parquet.  Texts are cut by the block of some million letters, and a row of postings
holds the units of a block that have the piece, so a row is shuffled for each piece
of a block and not for each piece of a unit.  Rows are dealt by piece, a common one
over several files, and sorted by piece: a lookup reads the row groups of its pieces
only.  A lookup takes the rarest pieces of the needle, meets their postings by unit,
and tests the text of what is left, so the index decides what is read and never what
is found.

Texts and needles are compared as :func:`.query.contains` does: A-Z case-blind,
``%`` and ``_`` wild, which here cut the needle into parts.  A needle without
a part of three letters, or of common pieces only, is a scan.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import small_batches
from .query import ascii_lower, contains

GRAM = 3
MAX_GRAMS = 6
# Beyond this share of all units the texts are read rather than the postings.
SCAN_SHARE = 0.2
ROW_GROUP = 8 << 20
# Letters that are cut at once, and over how many files at least a common piece may spread.
BLOCK_LETTERS = 2 << 20
SPREAD = 8
# Every unit is posted under the empty piece too, so its count is that of all units.
_ALL = ""


def grams_of(text: Column) -> Column:
    """Three-letter pieces of a text, repeats included: the pieces that :func:`block_postings` finds, as a column."""
    # Each match takes one letter and looks at the two behind it.
    return F.regexp_extract_all(ascii_lower(text), F.lit(r"(?s)(?=(...))."), F.lit(1))


def needle_grams(needle: str) -> list[str]:
    """The pieces that any text with the needle holds."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), needle)
    return sorted({part[i : i + GRAM] for part in re.split("[%_]", low) for i in range(len(part) - GRAM + 1)})


def _key(id_: Column) -> Column:
    # Two ids of one key cost a needless test, no more.
    return F.xxhash64(id_)


def block_postings(texts: list[str], keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(gram, n, units) of a block: the distinct keys of the texts that hold each piece."""
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    alphabet = np.flatnonzero(np.bincount(letters, minlength=1))
    size, n = max(len(alphabet), 1), len(texts)
    if size**GRAM * n >= 1 << 63:  # a piece and a text in one number; a text alone always fits
        for part in (slice(None, n // 2), slice(n // 2, None)):
            yield from block_postings(texts[part], keys[part])
        return
    code = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
    code[alphabet] = np.arange(len(alphabet))
    dealt = code[letters]
    owner = np.repeat(np.arange(n), [len(t) for t in texts])
    pieces = (dealt[:-2] * size + dealt[1:-1]) * size + dealt[2:]
    inside = owner[:-2] == owner[2:]
    found = np.sort((pieces * n + owner[:-2])[inside])
    found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    piece, unit = np.divmod(found, n)
    starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(piece) else piece
    named = piece[starts]
    shown = np.stack([alphabet[named // size**2], alphabet[named // size % size], alphabet[named % size]], 1).astype(np.uint32)
    spelt = shown.tobytes().decode("utf-32-le")
    grams = [_ALL, *(spelt[i : i + GRAM] for i in range(0, len(spelt), GRAM))]
    counts = np.diff(np.concatenate([starts, [len(piece)]])) if len(piece) else piece
    ends = np.cumsum(np.concatenate([[0, n], counts])).astype(np.int32)
    units = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([keys, keys[unit]])))
    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(np.diff(ends)), units], ["gram", "n", "units"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a task's units (unit, text as bytes), block by block."""
    texts, keys, held = [], [], 0
    for batch in batches:
        for key, data in zip(batch["unit"].to_pylist(), batch["text"].to_pylist()):
            texts.append((data or b"").decode("utf-8", "replace"))
            keys.append(key)
            held += len(texts[-1])
            if held >= BLOCK_LETTERS:
                yield from block_postings(texts, np.array(keys, np.int64))
                texts, keys, held = [], [], 0
    if texts:
        yield from block_postings(texts, np.array(keys, np.int64))


class SubstringIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.postings, self.counts = os.path.join(root, "postings"), os.path.join(root, "counts")

    def add(self, units: DataFrame) -> None:
        """Adds units (id, text); null texts hold nothing.

        Units that are gone stay harmless, as lookups start from the units.  A batch that
        failed half-way may be added again: repeated postings change no result, and counts
        only decide which pieces are looked up.
        """
        spread = units.select(_key(F.col("id")).alias("unit"), F.col("text").cast("binary").alias("text")).repartition("unit")  # a small table may be one split
        rows = spread.mapInArrow(_cut, "gram string, n int, units array<bigint>")
        dealt = rows.repartition("gram", F.pmod(F.get("units", F.lit(0)), F.lit(SPREAD))).sortWithinPartitions("gram")
        batch = os.path.join(self.postings, f"batch={uuid.uuid4().hex}")
        with small_batches(self.spark):  # a text may be long
            dealt.write.option("parquet.block.size", ROW_GROUP).parquet(batch)
        # Counted from what was written, so that texts are not cut again.
        found = self.spark.read.schema("gram string, n int").parquet(batch).groupBy("gram").agg(F.sum("n").alias("n"))
        found.repartition("gram").sortWithinPartitions("gram").write.mode("append").parquet(self.counts)

    def plan(self, needle: str) -> list[str] | None:
        """The pieces to look up, rarest first; None for a scan."""
        grams = needle_grams(needle)
        if not grams:
            return None
        rows = self.spark.read.schema("gram string, n long").parquet(self.counts).filter(F.col("gram").isin(_ALL, *grams)).groupBy("gram").agg(F.sum("n"))
        known = dict(rows.collect())  # at most a row a letter of the needle
        chosen = sorted(grams, key=lambda g: (known.get(g, 0), g))[:MAX_GRAMS]
        return None if known.get(chosen[0], 0) > SCAN_SHARE * known.get(_ALL, 0) else chosen

    def candidates(self, chosen: list[str]) -> DataFrame:
        """(unit) keys that hold all pieces."""
        rows = self.spark.read.schema("gram string, units array<bigint>").parquet(self.postings).filter(F.col("gram").isin(*chosen))
        rows = rows.select("gram", F.explode("units").alias("unit"))
        bit = F.lit(0)
        for k, gram in enumerate(chosen):
            bit = F.when(F.col("gram") == gram, 1 << k).otherwise(bit)
        return rows.groupBy("unit").agg(F.bit_or(bit).alias("held")).filter(F.col("held") == (1 << len(chosen)) - 1).select("unit")

    def matching(self, units: DataFrame, needle: str) -> DataFrame:
        """The rows of ``units`` (id, text, ...), all of them added before, whose text holds the needle."""
        chosen, found = self.plan(needle), contains(units["text"], needle)
        if chosen is None:
            return units.filter(found)
        # Bound to the join, as a test of the text alone would run over all units before it.
        near = units.join(self.candidates(chosen), _key(units["id"]) == F.col("unit"))
        return near.filter(F.when(F.col("unit").isNotNull(), found)).select(*(units[c] for c in units.columns))
