"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

A document is its token ids and a closing id; only one longer than a sequence
is cut.  Pieces are spread over groups of about ``group_rows`` by hash.  In a
group each piece goes where the sum over gaps g of (open sequences with gap
g)^2 becomes smallest (Csirik et al., 2006), ties to the smaller gap.  What is
still loosely filled when a group ends moves, whole sequences at a time, to a
few shared groups that pack again, so waste stays a small share at any size.

Tokens never move: the scan reduces each document to lengths and CRCs.

Edge cases: a null or empty text is the closing id alone; repeated rows are
packed each; a very long text is one row while it is tokenised and then pieces of one
sequence each; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import groups_for, stored, table

CAPACITY = 4096
END_ID = 1
GROUP_ROWS = 20_000
CACHE_WORDS = 1_000_000
MARKS = ".,:;!?*#$%&|"
BLANKS = re.compile("[^ \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# The classes at the end of the pattern of the pre-tokenizer: letter runs, single numbers, runs of other characters.
WORD_CLASSES = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def check_tokenizer(path: str) -> None:
    """Refuses a vocabulary whose ids of a text are not those of its words in order."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = (made.get("normalizer") or {}).get("normalizers", [])
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = cuts[0] if cuts else {}
    pattern = (split.get("pattern") or {}).get("Regex", "")
    model = made["model"]
    if not (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and pattern.endswith(WORD_CLASSES) and split["behavior"] == "Removed" and split["invert"]
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and made.get("post_processor") is None and model["type"] == "BPE"
        and model["dropout"] is None and not model["fuse_unk"]
    ):
        raise ValueError(f"{path}: not a lower-casing tokenizer that drops white space between words")


def _narrow(text: str) -> bool:
    """Whether all code points are below U+0100."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class WordIds(dict):
    """Token ids of a text as little-endian bytes, remembered word by word.

    A tokenizer of this kind lower-cases, splits at white space before anything
    else and drops it, so a text's ids are its words' ids in order; a word is cut
    into pieces by the tokenizer's own pre-tokenizer and each piece is merged by
    its model.  The keys are lower-case words; a missing one is encoded when it is
    asked for.  The memory is cleared when it holds ``limit`` words.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        super().__init__()
        check_tokenizer(path)
        self.tokenizer = _tokenizer(path)
        self.limit = limit
        self.cut, self.merge = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        letters = word.rstrip(MARKS) if word.isascii() else ""
        if letters.isalpha() and letters != word:
            # Letters and the marks behind them are a piece each.
            ids = self[letters] + self[word[len(letters) :]]
        else:
            pieces = (word,) if letters.isalpha() else [p for p, _ in self.cut(word)]
            got = [t.id for p in pieces for t in self.merge(p)]
            ids = struct.pack(f"<{len(got)}I", *got)
        self[word] = ids
        return ids

    def _odd_word(self, word: str) -> bytes:
        ids = self.odd.get(word)
        if ids is None:
            got = self.tokenizer.encode(word, add_special_tokens=False).ids
            self.odd[word] = ids = struct.pack(f"<{len(got)}I", *got)
        return ids

    @staticmethod
    def _split(text: str) -> list[str]:
        # str.split() also cuts at U+001C..U+001F, which the tokenizer keeps.
        return BLANKS.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def of(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if len(self) + len(self.odd) > self.limit:
                self.clear()
                self.odd.clear()
            low = text.lower()
            # Up to U+00FF lower-casing is one to one and nothing composes.
            if _narrow(text) and not any(t in low for t in self.added):
                yield b"".join(map(self.__getitem__, self._split(low)))
            else:
                yield b"".join(map(self._odd_word, self._split(text)))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One memory a worker process, kept from task to task."""
    return WordIds(path)


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer), np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = [t or "" for t in batch["text"].to_pylist()]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.of(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    stacks: dict[int, list[int]] = {}
    which, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    opened = 0
    for i, s in enumerate(sizes.tolist()):
        # Into gap g: -2 N(g) + 1 for the gap that goes, 2 N(g-s) + 1 for the one that comes.
        change = 2 * (count[: capacity + 1 - s] - count[s:]) + 2
        change[0] -= 2 * count[0] + 1  # a full sequence isn't open
        change[count[s:] == 0] = np.iinfo(np.int64).max
        after = int(change.argmin())
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if change[after] <= fresh:
            gap = after + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            b, gap, opened = opened, capacity, opened + 1
        which[i], offset[i] = b, capacity - gap
        left = gap - s
        if left:
            count[left] += 1
            stacks.setdefault(left, []).append(b)
    return which, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (PIECES)."""
    pieces = stored(pieces)
    n = pieces.count()

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((pdf["piece"], pdf["doc_id"], -pdf["length"].to_numpy()))
        pdf = pdf.iloc[order].reset_index(drop=True)
        pdf["bin"], pdf["offset"] = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf["fill"] = pdf.groupby("bin")["length"].transform("sum")
        return pdf

    groups = groups_for(n, group_rows)
    spread = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    packed = stored(
        spread.groupBy("group").applyInPandas(first, f"{PIECES}, group long, bin long, offset long, fill long")
    )
    # Loosely filled sequences are items of a second round.
    loose = packed.filter(F.col("fill") <= capacity - capacity // 32).groupBy("group", "bin").agg(F.max("fill").alias("fill"))
    loose = stored(loose)

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fill", "group", "bin"], ascending=[False, True, True]).reset_index(drop=True)
        pdf["host"], pdf["shift"] = sum_of_squares(pdf["fill"].to_numpy(), capacity)
        return pdf

    again = groups_for(loose.count(), group_rows)
    hosts = (
        loose.withColumn("again", F.pmod(F.xxhash64("group", "bin"), F.lit(again)))
        .groupBy("again")
        .applyInPandas(second, "group long, bin long, fill long, again long, host long, shift long")
        .drop("fill")
    )
    big = F.lit(1 << 31).cast("long")
    return (
        packed.join(hosts, ["group", "bin"], "left")
        .withColumn(
            "sequence_id",
            F.when(F.col("host").isNull(), F.col("group") * big + F.col("bin")).otherwise(
                -(F.col("again") * big + F.col("host")) - 1
            ),
        )
        .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenises and packs ``docs`` (doc_id, text)."""
    return pack(tokenized_pieces(docs, tokenizer or public_tokenizer(), capacity), capacity)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return pack_documents(table(spark, sf_dir, "documents"))
