"""The query over mixed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import mixing
from prosewell.llm.common import stored
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table

OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS turn
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM docs GROUP BY source
), ordered AS (
  SELECT *, coalesce(sum(source_size) OVER b, 0)::DOUBLE AS filled, coalesce(sum(weight) OVER b, 0) AS done,
    sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS weights
  FROM totals WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (1.5::DOUBLE * total - 2 * filled) / (weights - done) AS level FROM ordered
), level AS (
  SELECT arg_min(level, done) AS level FROM levels WHERE level * weight <= 2 * source_size
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM level) * weight, 2.0::DOUBLE * source_size)) AS target
  FROM totals
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM targets
), summed AS (
  SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY turn ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (size * (passes + CASE WHEN 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


@query("op4_source_mix", OP4_SQL)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, with how many of their words the mix takes."""
    sizes = stored(mixing.sized(read_table(spark, folder, "documents")), "sizes")
    rows = mixing.mixed(sizes, mixing.plan_mix(sizes))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)
