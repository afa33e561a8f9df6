"""Problem 2: references to records that never existed, were deleted or came later."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators.orphans import orphan_references
from lexiloom.tables import table

#: (referring table, its reference column, the table of the keys)
REFERENCES = (
    ("xrefs", "target_article_id", "articles"),
    ("article_contributors", "contributor_id", "contributors"),
    ("article_segments", "article_id", "articles"),
)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each referring row whose reference fails; copies of a row count once."""
    out = None
    for name, column, parent in REFERENCES:
        child = table(spark, sf_dir, name).select("id", column, "loaded_at")
        keys = table(spark, sf_dir, parent).select(F.col("id").alias("key"), "loaded_at", "deleted_at")
        rows = orphan_references(child, keys, [column], ["key"]).select(
            F.lit(name).alias("ref_table"), F.col("id").alias("row_id"), F.date_format("loaded_at", "yyyy-MM").alias("load_month"), "reason"
        )
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans for each table, month and reason, with the table's share of rows that fail that month."""
    orphans = found(spark, sf_dir).groupBy("ref_table", "load_month", "reason").agg(F.count(F.lit(1)).alias("n_orphans"))
    rows = None
    for name, column, _ in REFERENCES:
        month = table(spark, sf_dir, name).where(F.col(column).isNotNull()).select(
            F.lit(name).alias("ref_table"), F.date_format("loaded_at", "yyyy-MM").alias("load_month"), "id", column, "loaded_at"
        )
        counted = month.distinct().groupBy("ref_table", "load_month").agg(F.count(F.lit(1)).alias("n_references"))
        rows = counted if rows is None else rows.unionByName(counted)
    return orphans.join(rows, ["ref_table", "load_month"]).select("ref_table", "load_month", "reason", "n_orphans", "n_references")


def composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References by article and section under each match semantics: orphans by null mask and reason."""
    child = table(spark, sf_dir, "xrefs").select("id", "target_article_id", "target_section", "loaded_at").distinct()
    parent = table(spark, sf_dir, "articles").select(F.col("id").alias("key"), "section_name", "loaded_at", "deleted_at")
    out = None
    for match in ("simple", "partial", "full"):
        rows = orphan_references(child, parent, ["target_article_id", "target_section"], ["key", "section_name"], match=match)
        mask = F.concat(F.when(F.col("target_article_id").isNull(), "0").otherwise("1"), F.when(F.col("target_section").isNull(), "0").otherwise("1"))
        counted = rows.groupBy(F.lit(match).alias("match"), mask.alias("present"), "reason").agg(F.count(F.lit(1)).alias("n_orphans"))
        out = counted if out is None else out.unionByName(counted)
    return out


_LIVES = """
lives AS (
  SELECT kind, id, min(loaded_at) AS born, bool_or(rn = 1 AND gone) AS dead FROM (
    SELECT kind, id, loaded_at, deleted_at IS NOT NULL AS gone,
           rank() OVER (PARTITION BY kind, id ORDER BY loaded_at DESC) AS rn
    FROM (SELECT 'a' AS kind, id, loaded_at, deleted_at FROM articles
          UNION ALL SELECT 'c', id, loaded_at, deleted_at FROM contributors) WHERE id IS NOT NULL) GROUP BY kind, id),
refs AS (
  SELECT DISTINCT 'xrefs' AS ref_table, 'a' AS kind, id, target_article_id AS ref, loaded_at FROM xrefs WHERE target_article_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'article_contributors', 'c', id, contributor_id, loaded_at FROM article_contributors WHERE contributor_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'article_segments', 'a', id, article_id, loaded_at FROM article_segments WHERE article_id IS NOT NULL),
judged AS (
  SELECT r.ref_table, r.id AS row_id, strftime(r.loaded_at, '%Y-%m') AS load_month,
         CASE WHEN l.id IS NULL THEN 'missing' WHEN l.dead THEN 'deleted' WHEN l.born > r.loaded_at THEN 'late' END AS reason
  FROM refs r LEFT JOIN lives l ON l.kind = r.kind AND l.id = r.ref)
"""

_COMPOSITE = """
WITH child AS (SELECT DISTINCT id, target_article_id AS a, target_section AS s, loaded_at FROM xrefs),
lives AS (
  SELECT id, section_name AS s, min(loaded_at) AS born, bool_or(rn = 1 AND gone) AS dead FROM (
    SELECT id, section_name, loaded_at, deleted_at IS NOT NULL AS gone,
           rank() OVER (PARTITION BY id, section_name ORDER BY loaded_at DESC) AS rn
    FROM articles WHERE id IS NOT NULL AND section_name IS NOT NULL) GROUP BY 1, 2),
by_a AS (SELECT id, min(born) AS born, bool_and(dead) AS dead FROM lives GROUP BY 1),
by_s AS (SELECT s, min(born) AS born, bool_and(dead) AS dead FROM lives GROUP BY 1),
j AS (
  SELECT '11' AS present, c.loaded_at, l.id IS NULL AS miss, l.dead, l.born FROM child c LEFT JOIN lives l ON l.id = c.a AND l.s = c.s WHERE c.a IS NOT NULL AND c.s IS NOT NULL
  UNION ALL SELECT '10', c.loaded_at, l.id IS NULL, l.dead, l.born FROM child c LEFT JOIN by_a l ON l.id = c.a WHERE c.a IS NOT NULL AND c.s IS NULL
  UNION ALL SELECT '01', c.loaded_at, l.s IS NULL, l.dead, l.born FROM child c LEFT JOIN by_s l ON l.s = c.s WHERE c.a IS NULL AND c.s IS NOT NULL),
r AS (SELECT present, CASE WHEN miss THEN 'missing' WHEN dead THEN 'deleted' WHEN born > loaded_at THEN 'late' END AS reason FROM j)
SELECT 'simple' AS "match", present, reason, count(*) AS n_orphans FROM r WHERE present = '11' AND reason IS NOT NULL GROUP BY 2, 3
UNION ALL SELECT 'partial', present, reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY 2, 3
UNION ALL SELECT 'full', present, reason, count(*) FROM (SELECT present, CASE WHEN present = '11' THEN reason ELSE 'partial_null' END AS reason FROM r) WHERE reason IS NOT NULL GROUP BY 2, 3
"""

QUERIES = {"p2_found": found, "p2_report": report, "p2_composite": composite}
SQL = {
    "p2_found": f"WITH {_LIVES} SELECT DISTINCT ref_table, row_id, load_month, reason FROM judged WHERE reason IS NOT NULL",
    "p2_report": f"""WITH {_LIVES},
o AS (SELECT ref_table, load_month, reason, count(*) AS n_orphans FROM (SELECT DISTINCT * FROM judged WHERE reason IS NOT NULL) GROUP BY 1, 2, 3),
n AS (SELECT ref_table, load_month, count(*) AS n_references FROM judged GROUP BY 1, 2)
SELECT ref_table, load_month, reason, n_orphans, n_references FROM o JOIN n USING (ref_table, load_month)""",
    "p2_composite": _COMPOSITE,
}
