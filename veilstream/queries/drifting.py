"""Queries of the schema-drift operator (p2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift
from .repair import table, zoned_sql


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.drift(table(spark, folder, "envelope_files"))[0]


def p2_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The union schema: every attribute of a source table with the kind its files' kinds promote to."""
    _, named, rows = drift.drift(table(spark, folder, "envelope_files"))
    return drift.union_schema(named, rows)


def consistent(source_table: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return drift.consistent_table(table(spark, folder, "envelope_files"), source_table)

    return query


QUERIES = {"p2_found": p2_found, "p2_schema": p2_schema} | {f"p2_{t}": consistent(t) for t in ("patients", "providers", "appointments", "claims", "notes")}

_KIND = "CASE json_type(v) WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'whole number' WHEN 'BIGINT' THEN 'whole number' WHEN 'HUGEINT' THEN 'whole number' WHEN 'DOUBLE' THEN 'number with fraction' WHEN 'VARCHAR' THEN 'string' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END"
_LEAVES = "CASE json_type(v) WHEN 'ARRAY' THEN v->>'$[*]' WHEN 'OBJECT' THEN v->>'$.*' ELSE [v->>'$'] END"
_LEAF = (
    f"CASE WHEN {zoned_sql('x')} IS NOT NULL THEN (epoch_us({zoned_sql('x')}) // 1000)::DECIMAL(38,8)::VARCHAR WHEN regexp_full_match(trim(x), '-?\\d+(\\.\\d+)?') THEN try_cast(trim(x) AS DECIMAL(38,8))::VARCHAR"
    " WHEN x = 'true' THEN 1::DECIMAL(38,8)::VARCHAR WHEN x = 'false' THEN 0::DECIMAL(38,8)::VARCHAR ELSE lower(trim(x)) END"
)
_P2_WITH = f"""
WITH RECURSIVE env AS (SELECT DISTINCT topic, file_name, line_no, payload::JSON AS j FROM envelope_files WHERE json_valid(payload)),
files AS (SELECT topic, file_name, row_number() OVER (PARTITION BY topic ORDER BY min((j->'source'->>'ts_ms')::BIGINT) NULLS LAST, file_name) AS seq FROM env GROUP BY 1, 2),
images AS (SELECT topic, file_name, seq, line_no, (j->'source'->>'lsn')::BIGINT AS lsn, j->'after' AS a, coalesce(j->'source'->>'table', split_part(topic, '.', -1)) AS tbl FROM env JOIN files USING (topic, file_name) WHERE json_type(j->'after') = 'OBJECT'),
cells AS (SELECT topic, seq, line_no, lsn, tbl, k AS field, json_extract(a, '$."' || k || '"') AS v, json_extract_string(a, '$."' || regexp_replace(lower(tbl), 's$', '') || '_id"') AS pk FROM (SELECT *, unnest(json_keys(a)) AS k FROM images)),
kinds AS (SELECT topic, seq, field, list_sort(list(DISTINCT {_KIND}) FILTER (json_type(v) <> 'NULL')) AS ks FROM cells GROUP BY 1, 2, 3),
heads AS (SELECT topic, seq, field, CASE WHEN ks IS NULL OR len(ks) = 0 THEN NULL WHEN len(ks) = 1 THEN ks[1] WHEN ks = ['number with fraction', 'whole number'] THEN 'number with fraction' ELSE 'mixed' END AS kind FROM kinds),
before AS (SELECT topic, seq + 1 AS seq, field FROM heads SEMI JOIN (SELECT topic, seq - 1 AS seq FROM files) USING (topic, seq)),
gone AS (SELECT * FROM before ANTI JOIN heads USING (topic, seq, field)),
fresh AS (SELECT topic, seq, field FROM heads WHERE seq > 1 AND (topic, seq, field) NOT IN (SELECT topic, seq, field FROM before)),
filled AS (SELECT * FROM cells WHERE json_type(v) <> 'NULL' AND pk IS NOT NULL),
old AS (SELECT c.topic, c.seq + 1 AS seq, c.field, c.pk, arg_max(c.v, (c.lsn, c.line_no)) AS v FROM filled c JOIN gone g ON c.topic = g.topic AND c.seq = g.seq - 1 AND c.field = g.field GROUP BY 1, 2, 3, 4),
new AS (SELECT c.topic, c.seq, c.field, c.pk, arg_min(c.v, (c.lsn, c.line_no)) AS v FROM filled c JOIN fresh f USING (topic, seq, field) GROUP BY 1, 2, 3, 4),
old_leaves AS (SELECT * EXCLUDE (v), list_transform({_LEAVES}, lambda x: {_LEAF}) AS l FROM old), new_leaves AS (SELECT * EXCLUDE (v), list_transform({_LEAVES}, lambda x: {_LEAF}) AS l FROM new),
pairs AS (
  SELECT o.topic, o.seq, o.field AS old, n.field AS new, count(*) AS common, count(*) FILTER (o.l = n.l OR ((len(o.l) = 1) <> (len(n.l) = 1) AND list_has_any(o.l, n.l))) AS same
  FROM old_leaves o JOIN new_leaves n ON o.topic = n.topic AND o.seq = n.seq AND o.pk = n.pk WHERE len(o.l) > 0 AND len(n.l) > 0 GROUP BY 1, 2, 3, 4
), renames AS (
  SELECT topic, seq, old, new FROM (
    SELECT *, row_number() OVER (PARTITION BY topic, seq, old ORDER BY same / common DESC, common DESC, new) AS ro, row_number() OVER (PARTITION BY topic, seq, new ORDER BY same / common DESC, common DESC, old) AS rn
    FROM pairs WHERE common >= 2 AND same >= 0.8 * common
  ) WHERE ro = 1 AND rn = 1
), turns AS (SELECT topic, seq, new AS field, 1 AS turn FROM renames UNION SELECT topic, seq, old, 1 FROM renames),
nodes AS (
  SELECT topic, seq, field, kind, field || '#' || sum(coalesce(turn, 0)) OVER (PARTITION BY topic, field ORDER BY seq ROWS UNBOUNDED PRECEDING) AS node
  FROM heads FULL JOIN turns USING (topic, seq, field)
), edges AS (
  SELECT DISTINCT r.topic, c.node AS child, p.node AS parent FROM renames r JOIN nodes c ON c.topic = r.topic AND c.seq = r.seq AND c.field = r.new JOIN nodes p ON p.topic = r.topic AND p.seq = r.seq - 1 AND p.field = r.old
), up AS (SELECT topic, child, parent, 1 AS depth FROM edges UNION ALL SELECT u.topic, u.child, e.parent, depth + 1 FROM up u JOIN edges e ON e.topic = u.topic AND e.child = u.parent),
roots AS (SELECT topic, child AS node, arg_max(parent, depth) AS root FROM up GROUP BY 1, 2),
typed AS (SELECT n.topic, n.seq, n.field, n.kind, lag(n.kind) OVER (PARTITION BY n.topic, coalesce(r.root, n.node) ORDER BY n.seq) AS was FROM nodes n LEFT JOIN roots r USING (topic, node) WHERE n.kind IS NOT NULL)
"""
_P2_SQL = _P2_WITH + """SELECT topic, file_name, field_name, change_kind, new_name FROM (
  SELECT topic, seq, field AS field_name, 'added' AS change_kind, '' AS new_name FROM fresh WHERE (topic, seq, field) NOT IN (SELECT topic, seq, new FROM renames)
  UNION ALL SELECT topic, seq, field, 'removed', '' FROM gone WHERE (topic, seq, field) NOT IN (SELECT topic, seq, old FROM renames)
  UNION ALL SELECT topic, seq, old, 'renamed', new FROM renames
  UNION ALL SELECT topic, seq, field, 'retyped', '' FROM typed WHERE was <> kind
) JOIN files USING (topic, seq)
"""

_P2_SCHEMA_SQL = _P2_WITH + """,
attrs AS (SELECT n.topic, n.seq, n.field, regexp_replace(coalesce(r.root, n.node), '#0$', '') AS attribute FROM nodes n LEFT JOIN roots r USING (topic, node)),
places AS (SELECT DISTINCT topic, seq, coalesce(j->'source'->>'table', split_part(topic, '.', -1)) AS source_table FROM env JOIN files USING (topic, file_name)),
sets AS (SELECT p.source_table, a.attribute, list_sort(list_distinct(flatten(list(coalesce(k.ks, []))))) AS ks FROM attrs a JOIN kinds k USING (topic, seq, field) JOIN places p USING (topic, seq) GROUP BY 1, 2)
SELECT source_table, attribute, CASE WHEN len(ks) = 0 THEN NULL WHEN len(ks) = 1 THEN ks[1] WHEN ks = ['number with fraction', 'whole number'] THEN 'number with fraction' ELSE 'mixed' END AS kind FROM sets
"""

SQL = {"p2_found": _P2_SQL, "p2_schema": _P2_SCHEMA_SQL}
