"""Line deduplication across documents, in DataFrame functions only.

Every line of every text becomes a narrow row (document, position, 128-bit hash of the normalised
line); the rows are pre-aggregated per (hash, document) before they are counted per hash, so a
line that a third of all rows hold is spread over all tasks. Only positions of dropped lines come
back to the documents, and the kept runs between them are cut out of the split text.

Defined cases: a null or empty text is one empty line. Repeated rows of a doc_id count as one
document and lose the same lines. Rows with a null doc_id hold no document's lines: they do not
count, and lose the lines that other documents make frequent. Extra columns pass through; an extra
column named like an output is replaced by it. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WHITE, ascii_lower, cut, folded, kept_names, unfolded

OUT = ("text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(WHITE)))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` freed of frequent lines, plus n_lines and n_dropped (long).

    A line whose key has at least ``min_chars`` code points and occurs in at least ``min_docs``
    documents stays only in the largest id that holds it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = kept_names(docs, OUT)
    base = docs.select(folded(docs, own).alias("_own"), F.col(id_col).alias("_did"), text.alias("text"), F.xxhash64(text).alias("_fp"))
    lines = (base.select("_did", "_fp", F.posexplode(F.split("text", "\n", -1)).alias("_pos", "_line"))
             .where(F.char_length(F.trim("_line", F.lit(WHITE))) >= min_chars)
             .select("_did", "_fp", "_pos", F.unhex(F.md5(line_key(F.col("_line")))).alias("_h")))
    lines = cut(lines)
    frequent = (lines.where(F.col("_did").isNotNull()).groupBy("_h")
                .agg(F.count_distinct("_did").alias("_n"), F.max("_did").alias("_last"))
                .where(F.col("_n") >= min_docs).select("_h", "_last"))
    frequent = cut(frequent)  # a plain table, so that the join back can split a hot line
    drops = (lines.join(frequent, "_h").where(~F.col("_did").eqNullSafe(F.col("_last")))
             .groupBy("_did", "_fp").agg(F.array_sort(F.collect_set("_pos")).alias("_drop"))
             .select(F.col("_did").alias("_d"), F.col("_fp").alias("_f"), "_drop"))
    joined = base.join(drops, base["_did"].eqNullSafe(drops["_d"]) & (base["_fp"] == drops["_f"]), "left")
    split = joined.withColumn("_lines", F.split("text", "\n", -1))
    n = F.size("_lines")
    # the runs between dropped positions: each line is copied once, however many are dropped
    edges = F.concat(F.array(F.lit(-1)), F.col("_drop"), F.array(n))
    edged = split.withColumn("_edges", F.when(F.col("_drop").isNotNull(), edges))
    runs = F.transform(F.sequence(F.lit(1), F.size("_edges") - 1), lambda j: F.slice(
        F.col("_lines"), F.get("_edges", j - 1) + 2, F.get("_edges", j) - F.get("_edges", j - 1) - 1))
    kept = F.when(F.col("_edges").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n"))
    made = F.struct(kept.alias("text"), n.cast("long").alias("n_lines"), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"))
    return edged.select("_own", made.alias("_made")).select(*unfolded("_own", own), "_made.*")


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, (f.key IS NOT NULL AND k.doc_id <> f.last) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
