"""Queries p3_ and p4_ and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomline.operators.delivery import surplus_deliveries
from loomline.operators.incremental import due_lines
from loomline.session import table


def p3_found(spark, sf_dir):
    log = table(spark, sf_dir, "story_translations")
    return surplus_deliveries(log, ["key", "updatedAt"], "seq", "batch_id")


def p4_found(spark, sf_dir):
    return due_lines(table(spark, sf_dir, "story_job"), table(spark, sf_dir, "story_translations"), table(spark, sf_dir, "worker_runs"))


QUERIES = {"p3_found": p3_found, "p4_found": p4_found}

SQL = {
    "p3_found": """
SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY key, "updatedAt" ORDER BY seq) AS n
  FROM story_translations WHERE key IS NOT NULL AND "updatedAt" IS NOT NULL) WHERE n > 1""",
    "p4_found": """
WITH t AS (SELECT max(finished_at) AS t FROM worker_runs WHERE outcome = 'COMPLETE'),
held AS (SELECT key, "sourceHash" AS h FROM story_translations, t
  WHERE key IS NOT NULL AND "updatedAt" <= t.t
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY "updatedAt" DESC, seq DESC) = 1)
SELECT j.key AS key, min(CASE WHEN held.key IS NULL THEN 'new' ELSE 'changed' END) AS change
FROM story_job j LEFT JOIN held ON held.key = j.key
WHERE j.key IS NOT NULL AND (held.key IS NULL OR held.h IS DISTINCT FROM j."sourceHash")
GROUP BY j.key""",
}
