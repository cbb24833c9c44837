"""Queries of the general data-quality operators (problems 1, 3, 5 and 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import diff, drift, nested, orphans
from tessera.operators.orphans import Reference
from tessera.plans.runtime import materialize, table

REFERENCES = [
    Reference("objectives", "objective", "endpointIds", "objectives", "endpoint", many=True),
    Reference("objectives", "estimand", "analysisPopulationId", "objectives", "analysis_population"),
    Reference("objectives", "estimand", "interventionIds", "interventions", "study_intervention", many=True),
    Reference("soa_vision", "encounter", "epochId", "soa_vision", "epoch"),
]
SECTIONS = [
    Reference("narrative", "narrative_content", "childIds", "narrative", "narrative_content_item", many=True),
    Reference("narrative", "narrative_content_item", "parent_id", "narrative", "narrative_content"),
]


def p1_found(spark, d):
    """Keys and fields in which the two narrative systems differ."""
    return diff.diff_entities(table(spark, d, "narrative"), table(spark, d, "narrative_mirror"), ["name", "text"], "narrative", "mirror")


def p1_by_study(spark, d):
    """The same differences counted by study and kind."""
    return diff.diff_summary(p1_found(spark, d))


def p3_found(spark, d):
    """Changes of shape from one output file to the next."""
    return drift.changes(table(spark, d, "agent_files")).select("file_no", "entity_type", "field", "change")


def p3_schema(spark, d):
    """The fused schema of all readable records, alternative types kept."""
    return drift.fused_schema(drift.file_fields(table(spark, d, "agent_files")))


def p3_paths(spark, d):
    """The same at every depth of the payloads."""
    return drift.path_schema(table(spark, d, "agent_files"))


def p3_unified(spark, d):
    """All readable records in one consistent table."""
    files = table(spark, d, "agent_files")
    fields = drift.file_fields(files)
    return drift.unified(files, drift.fused_schema(fields), drift.changes(files, fields).where("change = 'renamed'"))


def p3_unified_counts(spark, d):
    """How many records have a value in each column of the consistent table, renamings left apart."""
    files = table(spark, d, "agent_files")
    wide = drift.unified(files, drift.fused_schema(drift.file_fields(files)))
    names = wide.columns[8:]
    counts = wide.agg(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.count(F.col(f"`{c}`")) for c in names])).alias("m"))
    return counts.select(F.explode("m").alias("column_name", "n"))


def p5_found(spark, d):
    """Child rows of objectives and amendments with their parents."""
    return nested.objective_children(table(spark, d, "objectives")).unionByName(nested.scope_children(table(spark, d, "advanced_entities")))


def p5_levels(spark, d):
    """Amendments in shredded form, with repetition and definition levels."""
    records = table(spark, d, "advanced_entities").where("entity_type = 'study_amendment'").selectExpr("entity_no", "data AS json")
    return nested.level_columns(records)


def _reference_tables(spark, d):
    return {t: table(spark, d, t) for t in ("objectives", "interventions", "soa_vision")}


def p6_found(spark, d):
    """References whose target is missing, deleted or later: the direct part of the cascade."""
    return orphans.find_orphans(_reference_tables(spark, d), REFERENCES).where("round = 0").select("entity_no", "field", "ref_id", "kind")


def p6_report(spark, d):
    """Direct and inherited orphans by table, month and field."""
    return orphans.orphan_report(orphans.find_orphans(_reference_tables(spark, d), REFERENCES))


def p6_cascade(spark, d):
    """The same for the sections of narrative and their items, which refer to one another."""
    narrative = table(spark, d, "narrative")
    tables = {"narrative": narrative.withColumn("data", F.struct("data.childIds", "parent_id"))}
    return orphans.orphan_report(orphans.find_orphans(tables, SECTIONS))


_LIVE = """{t}_live AS (
  SELECT * FROM (
    SELECT *, lower(replace(trim(id), '-', '_')) AS sid,
           row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn
    FROM {t})
  WHERE rn = 1 AND NOT is_deleted)"""

_P1 = (
    "WITH " + _LIVE.format(t="narrative") + ", " + _LIVE.format(t="narrative_mirror") + r""",
l AS (SELECT study_id, sid, trim(regexp_replace(coalesce(data.name, ''), '[ \t\r\n\x{00A0}]+', ' ', 'g')) AS name,
             trim(regexp_replace(coalesce(data.text, ''), '[ \t\r\n\x{00A0}]+', ' ', 'g')) AS text FROM narrative_live),
r AS (SELECT study_id, sid, trim(regexp_replace(coalesce(data.name, ''), '[ \t\r\n\x{00A0}]+', ' ', 'g')) AS name,
             trim(regexp_replace(coalesce(data.text, ''), '[ \t\r\n\x{00A0}]+', ' ', 'g')) AS text FROM narrative_mirror_live),
found AS (
SELECT l.study_id, l.sid AS id, 'missing_in_mirror' AS diff FROM l LEFT JOIN r USING (study_id, sid) WHERE r.sid IS NULL
UNION ALL SELECT r.study_id, r.sid, 'missing_in_narrative' FROM r LEFT JOIN l USING (study_id, sid) WHERE l.sid IS NULL
UNION ALL SELECT l.study_id, l.sid, 'name' FROM l JOIN r USING (study_id, sid) WHERE l.name <> r.name
UNION ALL SELECT l.study_id, l.sid, 'text' FROM l JOIN r USING (study_id, sid) WHERE l.text <> r.text)
"""
)

_SID = "lower(replace(trim({}), '-', '_'))"


def _p6_refs(table, kind, field, target, target_type, many):
    ids = f"unnest(data.{field})" if many else f"data.{field}"
    return f"""SELECT DISTINCT '{table}' AS table_name, entity_no, study_id, sid, entity_type, created_at, '{field}' AS field, '{target}' AS target, '{target_type}' AS target_type,
      lower(replace(trim(ref), '-', '_')) AS ref_id
    FROM (SELECT *, {ids} AS ref FROM {table}_live WHERE entity_type = '{kind}') WHERE trim(ref) <> ''"""


def _p6(references, own_field=""):
    tables = dict.fromkeys(r.table for r in references)
    targets = dict.fromkeys(r.target for r in references)
    return (
        "WITH RECURSIVE "
        + ", ".join(_LIVE.format(t=t) for t in tables)
        + ", refs AS ("
        + " UNION ALL ".join(_p6_refs(r.table, r.entity_type, r.field, r.target, r.target_type, r.many) for r in references).replace(f"data.{own_field} AS", f"{own_field} AS")
        + "), states AS ("
        + " UNION ALL ".join(
            f"""SELECT '{t}' AS target, entity_type AS target_type, study_id, lower(replace(trim(id), '-', '_')) AS ref_id,
        arg_max(is_deleted, version) AS gone, min(created_at) AS since FROM {t} GROUP BY ALL"""
            for t in targets
        )
        + """), found AS (SELECT refs.*, CASE WHEN gone IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN since > created_at THEN 'late' END AS kind
      FROM refs LEFT JOIN states USING (target, target_type, study_id, ref_id)),
reached AS (SELECT DISTINCT table_name, entity_type, study_id, sid FROM found WHERE kind IS NOT NULL
  UNION SELECT f.table_name, f.entity_type, f.study_id, f.sid FROM found f JOIN reached r ON r.table_name = f.target AND r.entity_type = f.target_type AND r.study_id = f.study_id AND r.sid = f.ref_id WHERE f.kind IS NULL),
every AS (SELECT * FROM found WHERE kind IS NOT NULL
  UNION ALL SELECT f.* REPLACE ('inherited' AS kind) FROM found f SEMI JOIN reached r ON r.table_name = f.target AND r.entity_type = f.target_type AND r.study_id = f.study_id AND r.sid = f.ref_id WHERE f.kind IS NULL)
"""
    )


_P6 = _p6(REFERENCES)
_REPORT = "SELECT table_name, strftime(created_at, '%Y-%m') AS month, field, kind, count(*) AS n FROM every GROUP BY ALL"

_P3_CELLS = """WITH readable AS (SELECT DISTINCT file_no, entity_type, record_id, file_ts, payload FROM agent_files WHERE json_valid(payload)),
cell AS (SELECT r.*, k.key AS field, CASE k.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
    WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS tag
  FROM readable r, json_each(r.payload) k WHERE k.type <> 'NULL')
"""

_P3 = (
    _P3_CELLS
    + """, f AS (SELECT DISTINCT a.study_id, a.agent_id, r.entity_type, r.file_no, r.file_ts FROM readable r JOIN (SELECT DISTINCT file_no, study_id, agent_id FROM agent_files) a USING (file_no)),
pairs AS (SELECT file_no, entity_type, before FROM (SELECT l.file_no, l.entity_type, e.file_no AS before, row_number() OVER (PARTITION BY l.file_no, l.entity_type ORDER BY e.file_ts DESC, e.file_no DESC) AS rn
  FROM f l JOIN f e ON e.study_id = l.study_id AND e.agent_id = l.agent_id AND e.entity_type = l.entity_type AND e.file_ts < l.file_ts) WHERE rn = 1),
tags AS (SELECT file_no, entity_type, field, list_sort(list(DISTINCT tag)) AS tags FROM cell GROUP BY ALL),
sides AS (SELECT p.file_no, p.entity_type, t.field, t.tags AS new, NULL AS old FROM pairs p JOIN tags t ON t.file_no = p.file_no AND t.entity_type = p.entity_type
  UNION ALL SELECT p.file_no, p.entity_type, t.field, NULL, t.tags FROM pairs p JOIN tags t ON t.file_no = p.before AND t.entity_type = p.entity_type),
found AS (SELECT * FROM (SELECT file_no, entity_type, field, CASE WHEN max(new) IS NULL THEN 'removed' WHEN max(old) IS NULL THEN 'added' WHEN max(new) <> max(old) THEN 'type' END AS change FROM sides GROUP BY ALL) WHERE change IS NOT NULL),
shared AS (SELECT DISTINCT p.file_no, p.before, p.entity_type, a.record_id FROM pairs p JOIN readable a ON a.file_no = p.file_no AND a.entity_type = p.entity_type JOIN readable b ON b.file_no = p.before AND b.entity_type = p.entity_type AND b.record_id = a.record_id),
vals AS (SELECT c.file_no, c.entity_type, c.record_id, c.field, k.value::VARCHAR AS v FROM cell c, json_each(c.payload) k WHERE k.key = c.field),
olds AS (SELECT x.file_no, x.entity_type, x.field, list_sort(list(DISTINCT s.record_id || '=' || v.v)) AS shape FROM found x JOIN shared s USING (file_no, entity_type) JOIN vals v ON v.file_no = s.before AND v.entity_type = s.entity_type AND v.record_id = s.record_id AND v.field = x.field WHERE change = 'removed' GROUP BY ALL),
news AS (SELECT x.file_no, x.entity_type, x.field, list_sort(list(DISTINCT s.record_id || '=' || v.v)) AS shape FROM found x JOIN shared s USING (file_no, entity_type) JOIN vals v ON v.file_no = s.file_no AND v.entity_type = s.entity_type AND v.record_id = s.record_id AND v.field = x.field WHERE change = 'added' GROUP BY ALL),
moved AS (SELECT n.file_no, n.entity_type, n.field, o.field AS old_field FROM news n JOIN olds o USING (file_no, entity_type, shape))
SELECT file_no, entity_type, field, change FROM found x WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.file_no = x.file_no AND m.entity_type = x.entity_type AND ((x.change = 'removed' AND m.old_field = x.field) OR (x.change = 'added' AND m.field = x.field)))
UNION ALL SELECT file_no, entity_type, field, 'renamed' FROM moved"""
)



def _opened(source: str, name: str) -> str:
    """JSON trees with every string that holds JSON replaced by its own tree, one level of holding at a time."""
    return f"""
{name}_b AS (SELECT *, type = 'VARCHAR' AND regexp_matches(value->>'$', '^\\s*[\\[{{]') AND json_valid(value->>'$') AS held FROM {source}),
{name}_h AS (SELECT b.entity_no, b.key AS outer_key, b.id AS outer_id, b.parent AS outer_parent, j.key, j.type, j.value, j.id AS i, j.parent AS p FROM (SELECT * FROM {name}_b WHERE held) b, json_tree(b.value->>'$') j),
{name} AS (SELECT entity_no, key, type, value, id, parent FROM {name}_b WHERE NOT held
  UNION ALL SELECT entity_no, CASE WHEN p IS NULL THEN outer_key ELSE key END, type, value, CASE WHEN p IS NULL THEN outer_id ELSE outer_id || '/' || i END,
    CASE WHEN p IS NULL THEN outer_parent WHEN p = min(i) OVER (PARTITION BY entity_no, outer_id) THEN outer_id ELSE outer_id || '/' || p END FROM {name}_h),"""


_P5 = (
    "WITH RECURSIVE " + _LIVE.format(t="objectives") + ", " + _LIVE.format(t="advanced_entities") + """,
t0 AS (SELECT a.entity_no, j.key, j.type, j.value, j.id::VARCHAR AS id, j.parent::VARCHAR AS parent FROM (SELECT * FROM advanced_entities_live WHERE entity_type = 'study_amendment' AND json_valid(data)) a, json_tree(a.data) j),
""" + _opened("t0", "t1") + _opened("t1", "t") + """
ids AS (SELECT entity_no, parent, value->>'$' AS v FROM t WHERE key = 'id' AND type NOT IN ('NULL', 'OBJECT', 'ARRAY')),
up AS (SELECT entity_no, id AS node, parent AS at FROM t WHERE key = 'geographicScopes'
  UNION ALL SELECT u.entity_no, u.node, p.parent FROM up u JOIN t p ON p.entity_no = u.entity_no AND p.id = u.at ANTI JOIN ids q ON q.entity_no = u.entity_no AND q.parent = u.at WHERE p.parent IS NOT NULL),
owner AS (SELECT u.entity_no, u.node, q.v AS parent_id FROM up u JOIN ids q ON q.entity_no = u.entity_no AND q.parent = u.at),
kids AS (SELECT g.entity_no, g.id AS node, CAST(c.key AS INT) AS pos, c.value AS v FROM t g JOIN t c ON c.entity_no = g.entity_no AND c.parent = g.id AND c.type = 'OBJECT' WHERE g.key = 'geographicScopes' AND g.type = 'ARRAY'
  UNION ALL SELECT entity_no, id, 0, value FROM t WHERE key = 'geographicScopes' AND type = 'OBJECT')
SELECT k.entity_no, 'geographicScopes' AS child_kind, o.parent_id, k.pos AS child_pos, coalesce(k.v->>'$.id', '') AS child_id FROM kids k LEFT JOIN owner o USING (entity_no, node)
UNION ALL SELECT entity_no, 'level', data.id, 0, data.level.code FROM objectives_live WHERE data.level.code IS NOT NULL
UNION ALL SELECT entity_no, 'intercurrentEvents', parent_id, pos, coalesce(e.id, '') FROM (SELECT entity_no, data.id AS parent_id, unnest(data.intercurrentEvents) AS e, CAST(generate_subscripts(data.intercurrentEvents, 1) - 1 AS INT) AS pos FROM objectives_live) WHERE e IS NOT NULL"""
)

QUERIES = {
    "p1_found": p1_found,
    "p1_by_study": p1_by_study,
    "p3_found": p3_found,
    "p3_schema": p3_schema,
    "p3_paths": p3_paths,
    "p3_unified": p3_unified,
    "p3_unified_counts": p3_unified_counts,
    "p5_found": p5_found,
    "p5_levels": p5_levels,
    "p6_found": p6_found,
    "p6_report": p6_report,
    "p6_cascade": p6_cascade,
}
ORACLES = {
    "p1_found": _P1 + "SELECT study_id, id, diff FROM found",
    "p1_by_study": _P1 + "SELECT study_id, diff, count(*) AS n FROM found GROUP BY ALL",
    "p3_found": _P3,
    "p3_schema": _P3_CELLS
    + """, c AS (SELECT DISTINCT file_no, entity_type, record_id, field, tag, file_ts FROM (SELECT a.record_no, c.* FROM cell c JOIN agent_files a ON a.file_no = c.file_no AND a.record_id = c.record_id AND a.entity_type = c.entity_type)),
n AS (SELECT k.key AS field, a.entity_type, count(*) AS n FROM agent_files a, json_each(a.payload) k WHERE json_valid(a.payload) AND k.type <> 'NULL' GROUP BY ALL)
SELECT entity_type, field, [x for x in ['string', 'number', 'boolean', 'object', 'array'] if list_contains(list(DISTINCT tag), x)] AS types, any_value(n) AS n_values, count(DISTINCT file_no) AS n_files,
  min(file_ts) AS first_ts, max(file_ts) AS last_ts FROM c JOIN n USING (entity_type, field) GROUP BY ALL""",
    "p3_paths": r"""SELECT entity_type, regexp_replace(regexp_replace(fullkey[2:], '\[\d+\]', '[]', 'g'), '^\.', '') AS path,
  [x for x in ['string', 'number', 'boolean', 'object', 'array'] if list_contains(list(DISTINCT CASE j.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END), x)] AS types, count(*) AS n_values
FROM (SELECT entity_type, payload FROM agent_files WHERE json_valid(payload)) f, json_tree(f.payload) j WHERE j.type <> 'NULL' GROUP BY ALL""",
    "p3_unified_counts": """WITH r AS (SELECT DISTINCT ON (file_no, record_no, entity_type, record_id) payload FROM agent_files WHERE json_valid(payload)),
c AS (SELECT k.key, CASE k.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS t
  FROM r, json_each(r.payload) k WHERE k.type <> 'NULL'),
n AS (SELECT *, count(DISTINCT t) OVER (PARTITION BY key) AS kinds FROM c),
w AS (SELECT key, key AS name, count(*) AS n FROM n GROUP BY 1 UNION ALL SELECT key, key || '__' || t, count(*) FROM n WHERE kinds > 1 GROUP BY 1, t, 2),
-- names that differ in case only, or are those of head columns, get a number
o AS (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY key) + (lower(name) IN ('file_no', 'file_name', 'study_id', 'agent_id', 'file_ts', 'record_no', 'entity_type', 'record_id'))::INT AS i FROM w)
SELECT name || CASE WHEN i > 1 THEN '_' || i ELSE '' END AS column_name, n FROM o""",
    "p5_found": _P5,
    "p6_found": _P6 + "SELECT entity_no, field, ref_id, kind FROM found WHERE kind IS NOT NULL",
    "p6_report": _P6 + _REPORT,
    "p6_cascade": _p6(SECTIONS, "parent_id") + _REPORT,
}
