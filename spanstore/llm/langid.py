"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of 1 to 3 code points (lower-cased) hash into ``BUCKETS`` counts.
Training is a distributed sum over all labelled rows: each task adds up its
counts and emits one row per language, so what meets on the driver has
languages x buckets cells at any input size.  The log-probability matrix is
broadcast; a batch of texts is scored in numpy by gathering the matrix rows of the
n-grams that stand in each text and summing them text by text.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when no labelled row exists; ties go to the smaller language
name.  Very long texts are taken in slices.  Repeated rows are trained on and
predicted each; an empty table gives an empty result.  Only text, language and the row
key are read, so extra columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BUCKETS = 1 << 15
MAX_N = 3
CELLS = 1 << 23
MAX_LANGS = 1000
ALPHA = 0.5
SLICE = 1 << 20
UNKNOWN = "und"


def ngram_rows(texts: list[str], buckets: int = BUCKETS, max_n: int = MAX_N) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, buckets) of the n-grams of the lower-cased texts, sorted by row for each n: many short texts
    at a time, a very long one in slices that overlap so that no n-gram is lost."""
    held: list[tuple[int, str]] = []
    size = 0
    for row, text in enumerate(texts):
        low = text.lower()
        for at in range(0, len(low), SLICE):
            held.append((row, low[at : at + SLICE + max_n - 1]))
            size += len(held[-1][1])
            if size >= SLICE:
                yield from _hashed(held, buckets, max_n)
                held, size = [], 0
    if held:
        yield from _hashed(held, buckets, max_n)


def _hashed(held: list[tuple[int, str]], buckets: int, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    cps = np.frombuffer("".join(p for _, p in held).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.asarray([len(p) for _, p in held])
    row = np.repeat(np.asarray([r for r, _ in held]), lengths)
    place = np.arange(len(cps)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    room = np.where(place < SLICE, np.repeat(lengths, lengths) - place, 0)
    rolled = np.zeros(len(cps), np.uint32)
    for n in range(1, max_n + 1):
        if len(cps) < n:
            return
        rolled = rolled[: len(cps) - n + 1] * np.uint32(0x01000193) + cps[n - 1 :] + np.uint32(n)
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        inside = room[: len(rolled)] >= n  # the n-gram ends in its own text
        yield row[: len(rolled)][inside], ((mixed >> np.uint32(16)) & np.uint32(buckets - 1))[inside]


class Model:
    """Languages in order and their log probabilities (buckets x languages)."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray, alpha: float = ALPHA):
        self.langs = langs
        smooth = counts + alpha
        self.log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float64).copy()
        self.prior = np.log((docs + alpha) / (docs + alpha).sum()) if len(langs) else np.zeros(0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores of a batch: the log-probability rows of the n-grams each text holds, summed by text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        asked = [i for i, t in enumerate(texts) if t and self.langs and any(map(str.isalpha, t))]
        total = np.tile(self.prior, (len(asked), 1))
        for row, bucket in ngram_rows([texts[i] for i in asked]):
            # However many languages there are, so many cells are gathered at a time.
            step = max(1, CELLS // max(1, len(self.langs)))
            for at in range(0, len(row), step):
                mine = row[at : at + step]
                cut = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                total[mine[cut]] += np.add.reduceat(self.log_p[bucket[at : at + step]], cut, axis=0)
        if asked:
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best = total.argmax(axis=1)
            sure = odds[np.arange(len(asked)), best] / odds.sum(axis=1)
            for i, k, p in zip(asked, best.tolist(), sure.tolist()):
                langs[i], scores[i] = self.langs[k], p
        return langs, scores


def train(rows: DataFrame, max_langs: int = MAX_LANGS) -> Model:
    """Fits on all rows of (text, lang); null languages are left out.  More than ``max_langs`` languages are refused."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                counts = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, bucket in ngram_rows(texts):
                    counts += np.bincount(bucket, minlength=BUCKETS)
                docs[lang] = docs.get(lang, 0) + len(texts)
        for lang, counts in sums.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * (len(seen) + 1)), "bucket": pa.array(np.append(-1, seen), pa.int32()),
                 "n": pa.array(np.append(docs[lang], counts[seen]), pa.int64())}
            )

    parts = rows.select("text", "lang").filter("text is not null and lang is not null")
    langs = sorted(r["lang"] for r in parts.select("lang").distinct().limit(max_langs + 1).collect())
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    # At most max_langs x (BUCKETS + 1) cells, however many rows there are.
    got = parts.mapInArrow(add_up, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts, docs = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    at = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    bucket, n = got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    inside = bucket >= 0
    counts[at[inside], bucket[inside]] = n[inside]
    docs[at[~inside]] = n[~inside]
    return Model(langs, counts, docs)


def predict(df: DataFrame, model: Model) -> DataFrame:
    """``df``'s columns but the text, with ``lang_pred`` and ``score``.  df must hold ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c not in ("text", "lang_pred", "score")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep] + ["lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch["text"].to_pylist())
            columns = [batch[c] for c in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that training never sees."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
