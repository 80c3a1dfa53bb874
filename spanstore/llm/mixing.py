"""Mixing sources to target weights by blocks (DataFrame functions only).

Each source's words form one stream, cut into blocks of ``block`` words.  Every
output shard draws a multinomial count of blocks per source (one categorical
draw a slot, by hash); counts beyond a source's quota are settled against
sources below theirs, so the totals meet the targets exactly.  A source's slots
run through pseudorandom permutations of its block indices (a swap-or-not
network, one key an epoch), and slots meet blocks by index.  A slot number
below twice the number of blocks touches a block at most twice.

Edge cases: null text has size 0 and is never taken; a null source is a source
of its own, last in order; sources of size 0 get target 0; repeated rows are
separate documents; a very long text is one row whose blocks are taken apart; extra
columns are kept by :func:`mix_documents`; an empty table gives an empty result.  The recipe (one row a
source) is gathered on the driver and refused beyond ``max_sources``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import groups_for, let, n_words, packed, stored, table, unpacked

BLOCK = 128
SHARDS = 64
ROUNDS = 12
SEED = 20240517
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150% as a fraction
MAX_REPEAT = 2
PART_ROWS = 10_000
CHUNK = 4096
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Recipe:
    """Per source: name, words, weight, target words, blocks and slots."""

    source: str | None
    index: int
    size: int
    target: float
    n_blocks: int
    quota: int


def targets_of(sizes: list[int], weights: list[int], share=SHARE, repeat: int = MAX_REPEAT) -> list[float]:
    """Water filling: shares by weight, stopped at ``repeat`` times the size, excess reshared by weight."""
    total = sum(sizes) * share[0]  # in units of 1 / share[1]
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] * repeat / weights[i], i))
    out, weight = [0.0] * len(sizes), sum(weights)
    for k, i in enumerate(order):
        if weights[i] * total >= sizes[i] * repeat * share[1] * weight:
            out[i] = float(sizes[i] * repeat)
            total -= sizes[i] * repeat * share[1]
            weight -= weights[i]
        else:
            for j in order[k:]:
                out[j] = weights[j] * total / (share[1] * weight)
            break
    return out


def recipe_of(totals: list[tuple[str | None, int]], block: int = BLOCK) -> list[Recipe]:
    """Sources in code point order (null last) with weights 3, 1, 2, repeating."""
    ordered = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(ordered))]
    targets = targets_of([n for _, n in ordered], weights)
    out = []
    for i, ((name, size), target) in enumerate(zip(ordered, targets)):
        blocks = -(-size // block)
        # The last block is short: size / blocks words a slot on average.
        quota = min(MAX_REPEAT * blocks, round(target * blocks / size)) if size else 0
        out.append(Recipe(name, i, size, target, blocks, quota))
    return out


def _unit(*parts: Column) -> Column:
    """A hash of ``parts`` as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Pseudorandom permutation of 0..n-1 (swap-or-not; Hoang, Morris and Rogaway, 2012)."""

    def step(x: Column, i: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, i, F.lit(1)), n) + n - x, n)
        top = F.greatest(x, partner)
        return F.when(F.xxhash64(key, i, top).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), step)


def alias_table(weights: list[int]) -> list[tuple[int, float, int]]:
    """Rows (j, stay, other) of Walker's alias method: column j stands for itself with probability ``stay``, else for ``other``."""
    n, total = len(weights), sum(weights)
    share = [w * n / total for w in weights]
    low, high = [j for j in range(n) if share[j] < 1], [j for j in range(n) if share[j] >= 1]
    out = [(j, 1.0, j) for j in range(n)]
    while low and high:
        j, k = low.pop(), high[-1]
        out[j] = (j, share[j], k)
        share[k] -= 1 - share[j]
        if share[k] < 1:
            low.append(high.pop())
    return out


def spread(rows: DataFrame, n: str, name: str, chunk: int = CHUNK) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``name``: first chunk by chunk and dealt out, then inside the chunks,
    so that neither a row's array nor a task grows with ``n``."""
    parts = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / chunk))).alias("_chunk"))
    # By number: Spark would merge these few rows, which are about to become many, into a task or two.
    parts = parts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*parts.columns))
    inside = F.sequence(F.col("_chunk") * chunk, F.least(F.col(n), (F.col("_chunk") + 1) * chunk) - 1)
    return parts.select("*", F.explode(inside).alias(name)).drop("_chunk")


def draw_slots(spark: SparkSession, recipe: list[Recipe], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, source_index, slot): slot runs over 0..quota-1 of each source."""
    live = [r for r in recipe if r.quota]
    total = sum(r.quota for r in live)
    out = "shard int, source_index int, slot long"
    if not live:
        return spark.createDataFrame([], out)
    # One row a source: no more than the recipe's.
    table_ = spark.createDataFrame([(j, stay, live[j].index, live[k].index) for j, stay, k in alias_table([r.quota for r in live])], "j long, stay double, own int, other int")
    quotas = spark.createDataFrame([(r.index, r.quota) for r in live], "source_index int, quota long")
    u = F.col("u") * len(live)
    draws = (
        spark.range(total)
        .select((F.col("id") % shards).cast("int").alias("shard"), _unit(F.lit(seed), F.col("id")).alias("u"))
        .select("shard", F.floor(u).alias("j"), (u - F.floor(u)).alias("rest"))
        .join(F.broadcast(table_), "j")
        .select("shard", F.when(F.col("rest") < F.col("stay"), F.col("own")).otherwise(F.col("other")).alias("source_index"))
    )
    counts = draws.groupBy("shard", "source_index").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_index").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = stored(
        counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(F.broadcast(quotas), "source_index")
        .withColumn("inside", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("start"))))
        .withColumn("over", F.col("n") - F.col("inside"))
    )
    kept = spread(drawn.filter("inside > 0").select("shard", "source_index", "start", "inside"), "inside", "k")
    kept = kept.select("shard", "source_index", (F.col("start") + F.col("k")).alias("slot"))
    # Surplus places and missing slots are as many; both are numbered and paired.
    # One row a shard and one a source meet on the driver.
    over = sorted((r["shard"], r["n"]) for r in drawn.groupBy("shard").agg(F.sum("over").alias("n")).collect())
    have = {r["source_index"]: r["n"] for r in drawn.groupBy("source_index").agg(F.sum("inside").alias("n")).collect()}
    if not sum(n for _, n in over):
        return kept
    ahead, run = [], 0
    for shard, n in over:
        ahead.append((shard, run))
        run += n
    first = spark.createDataFrame(ahead, "shard int, first long")
    within = Window.partitionBy("shard").orderBy("source_index").rowsBetween(Window.unboundedPreceding, -1)
    surplus = drawn.filter("over > 0").withColumn("base", F.coalesce(F.sum("over").over(within), F.lit(0)))
    surplus = surplus.join(F.broadcast(first), "shard").select("shard", "source_index", "over", (F.col("first") + F.col("base")).alias("base"))
    places = spread(surplus, "over", "k").select("shard", (F.col("base") + F.col("k")).alias("r"))
    missing, run = [], 0
    for r in live:
        lack = r.quota - have.get(r.index, 0)
        if lack:
            missing.append((r.index, have.get(r.index, 0), lack, run))
            run += lack
    needs = spread(spark.createDataFrame(missing, "source_index int, have long, lack long, base long"), "lack", "k").select(
        "source_index", (F.col("have") + F.col("k")).alias("slot"), (F.col("base") + F.col("k")).alias("r")
    )
    return kept.unionByName(places.join(needs, "r").select("shard", "source_index", "slot"))


def with_streams(docs: DataFrame) -> DataFrame:
    """(key, source, size, start): each document's place in its source's word stream.

    docs: (key, source, size).  Documents are numbered inside parts of about
    ``PART_ROWS`` rows and shifted by the parts before them, so a source with a
    third of all rows never meets in one task.
    """
    parts = docs.withColumn(
        "_part", F.pmod(F.xxhash64("key"), F.lit(groups_for(docs.count(), PART_ROWS))).cast("int")
    )
    sums = parts.groupBy("source", "_part").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("source", "_part").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return ranked.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))).select(
        "key", "source", "size", (F.col("_start") + F.col("_before")).alias("start")
    )


@dataclass
class Mix:
    """sizes: (key, source, size, source_index, source_size, target); takes: which words of which document each slot takes."""

    sizes: DataFrame
    takes: DataFrame
    recipe: list[Recipe]


def mix(docs: DataFrame, key: Column, block: int = BLOCK, shards: int = SHARDS, max_sources: int = MAX_SOURCES) -> Mix:
    """Plans the mix.  A document with words is known by its key, source and start in the stream,
    so rows that repeat a key stay apart.

    takes: (key, source_index, start, shard, slot, epoch, from_word, n_words).
    """
    spark = docs.sparkSession
    sizes = stored(docs.select(key.alias("key"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size")))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    recipe = recipe_of([(r["source"], r["n"]) for r in totals], block)
    about = spark.createDataFrame(
        [(r.source, r.index, r.size, r.target, r.n_blocks, r.quota) for r in recipe],
        "_s string, source_index int, source_size long, target double, n_blocks long, quota long",
    )
    placed = with_streams(sizes).join(F.broadcast(about), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = (
        placed.filter("size > 0 and quota > 0")
        .select("key", "source_index", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        .select(
            "key", "source_index", "start", "block",
            F.greatest(F.lit(0), F.col("block") * block - F.col("start")).cast("long").alias("from_word"),
            F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")).cast("long").alias("to_word"),
        )
    )
    blocks = about.select("source_index", "n_blocks")
    slots = (
        draw_slots(spark, recipe, shards)
        .join(F.broadcast(blocks), "source_index")
        .withColumn("epoch", F.floor(F.col("slot") / F.col("n_blocks")))
        .withColumn(
            "block",
            permuted(
                F.pmod(F.col("slot"), F.col("n_blocks")), F.col("n_blocks"),
                F.xxhash64(F.lit(SEED), F.col("source_index"), F.col("epoch")),
            ),
        )
    )
    takes = slots.join(pieces, ["source_index", "block"]).select(
        "key", "source_index", "start", "shard", "slot", "epoch", "from_word",
        (F.col("to_word") - F.col("from_word")).alias("n_words"),
    )
    return Mix(placed, takes, recipe)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents: the words the mix takes of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    got = mix(docs, F.col("doc_id"))
    taken = got.takes.groupBy("key", "source_index", "start").agg(F.sum("n_words").alias("_n"))
    taken = taken.toDF("_key", "_source", "_start", "_n")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("source_index") == F.col("_source")) & (F.col("start") == F.col("_start"))
    return got.sizes.join(taken, same & (F.col("size") > 0), "left").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", F.coalesce("_n", F.lit(0)).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: one row per document and
    epoch that takes any of its words, holding those words with the white space before them."""
    keyed = packed(docs, "source", "text").withColumn("_key", F.struct(F.col("doc.doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))))
    got = mix(keyed, F.col("_key"))
    spans = (
        got.takes.groupBy("key", "start", "epoch")
        .agg(F.sort_array(F.collect_set(F.struct("from_word", "n_words"))).alias("_spans"))
        .withColumnRenamed("key", "_taken_key")
    )
    tokens = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = let(
        tokens,
        lambda ts: F.array_join(
            F.flatten(F.transform("_spans", lambda s: F.slice(ts, s["from_word"].cast("int") + 1, s["n_words"].cast("int")))), ""
        ),
    )
    # Rows equal in id and text share a key; each of their places in the stream has spans of its own.
    out = keyed.dropDuplicates(["_key"]).join(spans, F.col("_key").eqNullSafe(F.col("_taken_key"))).withColumn("text", text)
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*unpacked(docs.columns, **fresh))
