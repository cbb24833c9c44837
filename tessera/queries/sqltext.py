"""DuckDB texts shared by the oracles."""

from __future__ import annotations

from tessera.functions.ladder import Ladder


def quoted(v) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def any_of(x: str, words, test: str = "contains({}, {})") -> str:
    return "(" + " OR ".join(test.format(x, quoted(w)) for w in words) + ")"


def ladder(x: str, lad: Ladder) -> str:
    """A ladder as a CASE over the lower-cased text."""
    low = f"lower({x})"
    arms = [f"WHEN coalesce({x}, '') = '' THEN {quoted(lad.blank)}"]
    for r in lad.rules:
        tests = [any_of(low, r.any)] if r.any else []
        tests += [f"contains({low}, {quoted(w)})" for w in r.every] + [f"NOT contains({low}, {quoted(w)})" for w in r.but]
        tests += [f"{low} IN ({', '.join(map(quoted, r.equal))})"] if r.equal else []
        tests += [f"regexp_matches({low}, {quoted(r.like)})"] if r.like else []
        arms.append(f"WHEN {' AND '.join(tests)} THEN {quoted(r.result)}")
    return f"CASE {' '.join(arms)} ELSE {quoted(lad.default)} END"


def drop_each(x: str, patterns) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, {quoted(p)}, '', 'g')"
    return x


def one_space(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def group(x: str, pattern: str, n: int = 1) -> str:
    return f"CASE WHEN regexp_matches({x}, {quoted(pattern)}) THEN regexp_extract({x}, {quoted(pattern)}, {n}) END"


#: distinct non-null names of several tables
NAMES = """names AS (SELECT DISTINCT name FROM (SELECT data.name AS name FROM soa_vision UNION ALL SELECT data.name FROM interventions
  UNION ALL SELECT data.name FROM objectives UNION ALL SELECT entity_name FROM enrichment) WHERE name IS NOT NULL)"""
#: one row per stored entity row of five tables
ENTITIES = "entities AS (" + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, entity_no, study_id, pos, id, lower(replace(trim(id), '-', '_')) AS sid, entity_type, {n} AS name, source_agent, confidence,
    source_pages, model, version, parent_id, is_deleted, created_at, updated_at FROM {t}"""
    for t, n in (("narrative", "data.name"), ("objectives", "data.name"), ("soa_vision", "data.name"), ("interventions", "data.name"), ("advanced_entities", "CASE WHEN json_valid(data) THEN data->>'$.name' END"))
) + ")"
LIVE = """live AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY table_name, study_id, sid ORDER BY version DESC) AS rn FROM entities)
  WHERE rn = 1 AND NOT is_deleted)"""
