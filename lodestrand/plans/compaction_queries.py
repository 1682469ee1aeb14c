"""Queries of problem 2."""

from __future__ import annotations

from lodestrand.operators.compaction import compact_cache
from lodestrand.session import scratch, table


def p2_found(spark, d):
    return compact_cache(table(spark, d, "cache_files"), scratch(spark, "p2-compacted")).select("rec_id")


def queries():
    return {"p2_found": p2_found}


def oracle_sql():
    return {
        "p2_found": """
            WITH l AS (SELECT trim(unnest(string_split(body, chr(10))), chr(10) || chr(13) || chr(9) || ' ') AS line FROM cache_files),
            j AS (SELECT CASE WHEN line LIKE '{%}' AND json_valid(line) THEN TRY_CAST(json_extract_string(line, '$.rec_id') AS BIGINT) END AS rec_id FROM l)
            SELECT DISTINCT rec_id FROM j WHERE rec_id IS NOT NULL""",
    }
