"""Quality rules: a decision list learned by sequential covering.

Statistics are Spark expressions; learning runs on a bounded sample of labelled
rows (``max_labelled``, taken in hash order of the id, so reruns agree) and
yields threshold conjunctions; applying them is one ordered ``CASE`` over the
statistics.  No Python runs on the documents.

Each rule is grown on two thirds of the sample by information gain (one
condition ``feature <= t`` or ``feature > t`` at a time), pruned on the other
third by dropping trailing conditions, and accepted while it is precise enough
there.  Rows it covers leave the sample and the next rule is grown.

Edge cases: null or empty text has no words, so the base rule rejects it; with
no labels, or labels of one kind, the list is empty and rejects nothing; labels
without a document and null labels are ignored; a label that repeats for a document
counts once; a document id that stands for several texts counts with the least of them;
ties in the sample's hash go to the smaller id; very long texts are one row each; an
empty table gives an empty result.  Extra columns pass through :func:`filter_quality`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, packed, table, unpacked, words_of

MAX_LABELLED = 20_000
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """Words that lie in a ``WINDOW``-word window found twice or more, O(n log n)."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )

    def covered(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twin = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
            at = F.transform(s, lambda e, k: F.when(twin(e, k - 1) | twin(e, k + 1), e["i"]))
            return F.sort_array(F.array_compact(at))

        def union_length(ps: Column) -> Column:
            gaps = F.transform(ps, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(ps, k + 1) - p, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(let(ordered, positions), union_length)

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(
            hashes,
            lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)),
        )
    )


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n", -1), lambda s: F.btrim(s, F.lit(" \t\n\x0b\x0c\r")) != "")
    return let(full, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the struct ``_stats``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ..."""

    def count(t: Column, chars: str) -> Column:
        return (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")

    def stats(t: Column) -> Column:
        return let(
            words_of(t),
            lambda ws: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                count(t, SYMBOLS).alias("n_symbols"),
                _dup_lines(t).alias("n_dup_lines"),
                _repeat_words(ws).alias("n_repeat_words"),
                F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
                count(t, "0123456789").alias("n_digits"),
                (F.size(F.split(t, "\n", -1))).cast("long").alias("n_lines"),
            ),
        )

    return docs.withColumn("_stats", let(F.coalesce(F.col(text_col), F.lit("")), stats))


def base_failed(s: Column) -> Column:
    """Too short, or mostly repeated windows."""
    return (s["n_words"] < 20) | (s["n_repeat_words"] * 100 > s["n_words"] * 30)


def features(s: Column) -> dict[str, Column]:
    """Statistics the rules test; a ratio is per word (or per line)."""
    per = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1)).cast("double")
    return {
        "n_words": s["n_words"].cast("double"),
        "chars_per_word": per(s["word_chars"], s["n_words"]),
        "symbols_per_word": per(s["n_symbols"], s["n_words"]),
        "digits_per_word": per(s["n_digits"], s["n_words"]),
        "dup_lines_per_line": per(s["n_dup_lines"], s["n_lines"]),
        "repeat_share": per(s["n_repeat_words"], s["n_words"]),
        "distinct_share": per(s["n_distinct"], s["n_words"]),
        "words_per_line": per(s["n_words"], s["n_lines"]),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        x = values[self.feature]
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def learn_rules(
    rows: list[dict], bad: list[bool], max_rules: int = 12, max_conditions: int = 4, cuts: int = 24,
    min_precision: float = 0.9, min_cover: int = 8,
) -> list[Rule]:
    """Sequential covering.  Row sets are bit masks, so a condition costs two ANDs."""
    if not rows:
        return []
    conditions: dict[Condition, int] = {}
    for name in rows[0]:
        values = sorted({r[name] for r in rows})
        step = max(1, len(values) // cuts)
        for lo, hi in zip(values[step - 1 :: step], values[step::step]):
            cut = (lo + hi) / 2
            above = sum(1 << i for i, r in enumerate(rows) if r[name] > cut)
            conditions[Condition(name, True, cut)] = above
            conditions[Condition(name, False, cut)] = ((1 << len(rows)) - 1) & ~above
    grow_part = sum(1 << i for i in range(len(rows)) if i % 3 != 2)
    positive = sum(1 << i for i, b in enumerate(bad) if b)
    left, found = (1 << len(rows)) - 1, []

    def counts(mask: int) -> tuple[int, int]:
        p = (mask & positive).bit_count()
        return p, mask.bit_count() - p

    def mask_of(rule: Rule, within: int) -> int:
        for c in rule:
            within &= conditions[c]
        return within

    while len(found) < max_rules:
        rule: Rule = ()
        covered = left & grow_part
        while len(rule) < max_conditions:
            p0, n0 = counts(covered)
            if not p0 or not n0:
                break
            best, gain = None, 1e-9
            for c, m in conditions.items():
                p, n = counts(covered & m)
                if p >= min_cover:
                    g = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain = c, g
            if best is None:
                break
            rule, covered = (*rule, best), covered & conditions[best]
        if not rule:
            break
        worth = {}
        for k in range(1, len(rule) + 1):
            p, n = counts(mask_of(rule[:k], left & ~grow_part))
            worth[k] = ((p - n) / (p + n) if p + n else -1.0, -k)
        rule = rule[: max(worth, key=worth.get)]
        p, n = counts(mask_of(rule, left & ~grow_part))
        pg, ng = counts(mask_of(rule, left))
        if not p or p < min_precision * (p + n) or pg < min_precision * (pg + ng):
            break
        found.append(rule)
        left &= ~mask_of(rule, left)
    return found


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learns from at most ``max_labelled`` labelled rows (quality 0 is to be rejected)."""
    sample = (
        labels.filter("quality is not null and doc_id is not null")
        .select("doc_id", F.col("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_quality")
        .limit(max_labelled)
    )
    # max_labelled narrow rows bound what is broadcast; a document that stands several times counts once a label.
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # Repeated rows of one document would otherwise multiply what is gathered.
    known = known.groupBy("doc_id", "_quality").agg(F.min("text").alias("text"))
    named = features(F.col("_stats"))
    order = F.struct(F.xxhash64("doc_id", F.lit(1)), F.col("doc_id"), F.col("_quality")).alias("order")
    got = with_stats(known).select(order, "_quality", F.struct(*[c.alias(k) for k, c in named.items()]).alias("f")).collect()
    got.sort(key=lambda r: r["order"])  # the same in every process
    return learn_rules([r["f"].asDict() for r in got], [r["_quality"] == 0 for r in got])


def rejects(rules: list[Rule], s: Column) -> Column:
    """The decision list as one ordered conditional: number of the rule that fires, else null."""
    values = features(s)
    fired = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        test = F.lit(True)
        for c in rules[k]:
            test = test & c.column(values)
        fired = F.when(test, F.lit(k)).otherwise(fired)
    return fired


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with ``_stats``, ``base_failed``, ``fired`` (rule number or null) and ``kept``."""
    s = F.col("_stats")
    return (
        with_stats(docs)
        .withColumn("base_failed", base_failed(s))
        .withColumn("fired", rejects(rules, s))
        .withColumn("kept", ~F.col("base_failed") & F.col("fired").isNull())
    )


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judge(packed(docs, "text"), fit_rules(docs, labels)).filter("kept").select(*unpacked(docs.columns))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_rules(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs, rules).select(
        "doc_id", *[F.col(f"_stats.{n}").alias(n) for n in names], "base_failed", "kept", "fired"
    )
