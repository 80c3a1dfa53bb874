"""Removal of lines that many documents share (DataFrame functions only).

Lines are exploded as (document, position, 128-bit hash of the normalised
line); keys found in at least ``min_docs`` documents are joined back and the
document is reassembled from the positions that stay.  Line texts are never
shuffled, only their hashes; documents move once, to meet their positions.

Edge cases: a null or empty text is one empty line; an empty key is never
counted; the queries count distinct ids, as their SQL does, so a repeated row
adds nothing and a null id is not counted (the general operator counts rows unless
told otherwise); a document that loses all its lines keeps the empty string.  An empty table gives
an empty result; extra columns pass through the general operator unharmed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, let, maybe_among, packed, stored, table, unpacked

MIN_DOCS = 10
HOT_KEYS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """ASCII white space off both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_positions(rows: DataFrame, min_docs: int, distinct: bool = False) -> DataFrame:
    """(_row, _gone): positions of the lines each row loses.  rows: (_row, _text).

    distinct: a key's documents are the distinct ids (``_row.id``) that hold it, not the rows.
    """
    hashed = stored(
        rows.select(
            "_row",
            F.filter(
                F.transform(
                    _lines(F.col("_text")),
                    lambda line, i: F.struct(
                        i.alias("pos"),
                        let(line_key(line), lambda k: F.when(k != "", F.unhex(F.md5(k)))).alias("key"),
                    ),
                ),
                lambda s: s["key"].isNotNull(),
            ).alias("_hashed"),
        )
    )
    # A key counts once a row, and partial aggregation runs before the shuffle,
    # so a very common line costs each task one row.
    common = stored(
        hashed.select(F.explode(F.array_distinct("_hashed.key")).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("docs"))
        .filter(F.col("docs") >= min_docs)
    )
    # The HOT_KEYS most frequent keys are joined by broadcast; no other key has more than 1 / HOT_KEYS of all lines,
    # and of the other lines only those that may have such a key are shuffled.
    hot = common.orderBy(F.desc("docs"), "key").limit(HOT_KEYS).select("key")
    lines = hashed.select("_row", F.inline("_hashed"))
    cold = common.join(F.broadcast(hot), "key", "left_anti").select("key")
    hits = lines.join(F.broadcast(hot), "key", "left_semi").unionByName(
        maybe_among(lines, "key", cold).join(F.broadcast(hot), "key", "left_anti").join(cold, "key", "left_semi")
    )
    if distinct:
        # No key has more ids than rows, so only the lines found so far need to be counted by id.
        hits = stored(hits)
        few = hits.groupBy("key").agg(F.count_distinct("_row.id").alias("ids")).filter(F.col("ids") < min_docs).select("key")
        few = stored(few)
        if not few.isEmpty():  # only where rows repeat their id
            hits = hits.join(few, "key", "left_anti")
    return hits.groupBy("_row").agg(F.collect_set("pos").alias("_gone"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """``docs`` with common lines taken out of ``text_col``.

    Adds ``n_lines`` (before) and ``n_dropped``.  ``id_col`` names a row; rows
    that repeat an id are told apart by their text's hash.  distinct: count ids, not rows.
    """
    text = F.col("doc").getField(text_col)
    keyed = packed(docs).withColumn("_row", F.struct(F.col("doc").getField(id_col).alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit(""))))))
    gone = dropped_positions(keyed.select("_row", text.alias("_text")), min_docs, distinct)
    joined = keyed.join(gone.withColumnRenamed("_row", "_gone_row"), F.col("_row").eqNullSafe(F.col("_gone_row")), "left")
    kept = let(
        _lines(text),
        lambda ls: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_gone")), lambda i: F.get(ls, i)), "\n"
        ),
    )
    fresh = {
        text_col: F.when(F.size("_gone") > 0, kept).otherwise(F.coalesce(text, F.lit(""))),
        "n_lines": F.size(_lines(text)).cast("long"),
        "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
    }
    return joined.select(*unpacked(list(dict.fromkeys([*docs.columns, "n_lines", "n_dropped"])), **fresh))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, distinct=True).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), flagged AS (
  SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""


def dedup_documents(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Line dedup with the columns of ``docs`` (``n_chars`` kept in step)."""
    out = dedup_lines(packed(docs, "doc_id", "text"), min_docs, distinct=True)
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*unpacked(docs.columns, **fresh))
