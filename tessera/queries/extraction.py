"""Queries of row generators, rules, terminology and assembly (B, J, K, L, M, O, A rows)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions import patterns as P
from tessera.functions import timing as T
from tessera.functions.keys import same_id
from tessera.operators import extract as X
from tessera.operators import fuzzy as Z
from tessera.operators import linking as K
from tessera.operators import metrics as M
from tessera.operators import resolve as R
from tessera.operators import similarity as Y
from tessera.operators import validate as V
from tessera.operators.live import live_entities
from tessera.operators.sequence import lines_of
from tessera.plans.runtime import table
from tessera.queries import sqltext as Q
from tessera.queries import views
from tessera.queries.linking import OB, SV, _current, _encounters, _epochs, _objectives
from tessera.sources import documents as D

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _docs(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text").dropDuplicates(["doc_id"])


DOCS = "d AS (SELECT doc_id, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY doc_id)"


def _matches_sql(patterns, groups=0) -> str:
    """All matches with their places, from the text between them."""
    parts = []
    for no, (p, kind) in enumerate(patterns):
        q = Q.quoted("(?i)" + p)
        have = min(groups, re.compile(p).groups)
        got = [f"regexp_extract_all(text, {q}, {i}) AS {n}" for i, n in list(enumerate(("found", "g1", "g2")))[: have + 1]]
        took = [f"{n}[i] AS {n}" for n in ("found", "g1", "g2")[: have + 1]] + [f"NULL::VARCHAR AS {n}" for n in ("g1", "g2")[have:]]
        place = "coalesce(list_sum([length(x) for x in between_[1:i]]), 0) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS start"
        parts.append(f"SELECT doc_id, text, {Q.quoted(kind)} AS kind, {no} AS pattern_no, i - 1 AS match_no, {', '.join(took)}, {place} FROM (SELECT doc_id, text, {', '.join(got)}, string_split_regex(text, {q}) AS between_ FROM d), unnest(range(1, len(found) + 1)) r(i)")
    return " UNION ALL ".join(parts)


_ANCHOR_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS anchor_type, coalesce({', '.join('nullif(regexp_extract(text, ' + Q.quoted('(?i)' + p) + ', 0), ' + chr(39) * 2 + ')' for p, kk in P.ANCHORS if kk == k)}) AS found, {i} AS rank FROM d"
    for i, k in enumerate(P.ANCHOR_ORDER, 1)
)


@query(f"WITH {DOCS}, a AS ({_ANCHOR_SQL}) SELECT * FROM a WHERE found IS NOT NULL")
def j01_anchors(spark, d):
    """The first time anchor of each type in each text (with g05's order)."""
    return X.anchors(_docs(spark, d), ["doc_id"])


_DAILY = [(p, "daily") for p in P.DAILY]


@query(f"WITH {DOCS}, m AS ({_matches_sql(_DAILY)}) SELECT doc_id, kind, pattern_no, match_no, found, 'P1D' AS interval FROM m")
def j02_daily(spark, d):
    """Daily repetitions."""
    return X.matches(_docs(spark, d), ["doc_id"], _DAILY).select("doc_id", "kind", "pattern_no", "match_no", "found", F.lit("P1D").alias("interval"))


_INTERVAL = [(p, X.interval_unit(p)) for p in P.INTERVALS]
_TRIMMED = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')".replace("\\\\", "\\")


@query(rf"""WITH {DOCS}, m AS ({_matches_sql(_INTERVAL, 1)}), t AS (SELECT *, [{_TRIMMED.format('x')} for x in string_split(g1, ',')] AS parts FROM m),
  w AS (SELECT *, contains(g1, ',') AS listed, len([x for x in parts if NOT regexp_full_match(x, '\d+')]) = 0 AS whole FROM t)
  SELECT doc_id, pattern_no, match_no, found, CASE WHEN listed AND whole THEN 'PT' || (parts[2]::BIGINT - parts[1]::BIGINT) || 'M' WHEN NOT listed AND whole THEN 'PT' || parts[1]::BIGINT || kind END AS interval, CASE WHEN listed AND whole THEN len(parts)::INT END AS observations FROM w""")
def j03_intervals(spark, d):
    """Repetitions at an interval, and lists of times."""
    m = X.matches(_docs(spark, d), ["doc_id"], _INTERVAL, 1)
    iso, n = X.interval(F.col("g1"), F.col("kind"))
    return m.select("doc_id", "pattern_no", "match_no", "found", iso.alias("interval"), n.alias("observations"))


_CYC = [(p, "cycle") for p in P.CYCLES]
_CONTEXT = "lower(substring(text, (greatest(start - {0}, 0) + 1)::BIGINT, (start + length(found) + {0} - greatest(start - {0}, 0))::BIGINT))"
_EXIT_SQL = "CASE " + " ".join(f"WHEN contains({_CONTEXT.format(200)}, {Q.quoted(w)}) THEN {Q.quoted(x)}" for w, x in P.CYCLE_EXITS.items()) + " END"


@query(f"WITH {DOCS}, m AS ({_matches_sql(_CYC, 1)}) SELECT doc_id, pattern_no, match_no, found, CASE WHEN try_cast(g1 AS BIGINT) <> 0 THEN 'P' || g1::BIGINT || 'D' END AS cycle_length, {_EXIT_SQL} AS exit_condition FROM m")
def j04_cycles(spark, d):
    """Treatment cycles with their length and the condition that ends them, if one is within 200 characters."""
    m = X.matches(_docs(spark, d), ["doc_id"], _CYC, 1, context=200)
    n = F.col("g1").try_cast("bigint")
    near = F.lower("context")
    ends = F.coalesce(*[F.when(near.contains(w), x) for w, x in P.CYCLE_EXITS.items()])
    return m.select("doc_id", "pattern_no", "match_no", "found", F.when(n != 0, F.concat(F.lit("P"), n.cast("string"), F.lit("D"))).alias("cycle_length"), ends.alias("exit_condition"))


_RANGE = [(p, "range") for p in P.DAY_RANGES]
_DAYNUM = "(CASE WHEN regexp_matches({0}, '[-–−]') THEN -1 ELSE 1 END * CAST(regexp_extract({0}, '\\d+', 0) AS BIGINT))".replace("\\\\", "\\")
_ISO = "CASE WHEN {0} = 0 THEN NULL WHEN {0} < 0 THEN '-P' || -({0}) || 'D' ELSE 'P' || {0} || 'D' END"


@query(f"WITH {DOCS}, m AS ({_matches_sql(_RANGE, 2)}) SELECT doc_id, pattern_no, match_no, found, CASE WHEN g2 IS NOT NULL THEN {_ISO.format(_DAYNUM.format('g1'))} END AS start_iso, CASE WHEN g2 IS NOT NULL THEN {_ISO.format(_DAYNUM.format('g2'))} END AS end_iso FROM m")
def j05_day_ranges(spark, d):
    """Windows of continuous collection; those with two days as signed ISO text."""
    m = X.matches(_docs(spark, d), ["doc_id"], _RANGE, 2)
    iso = lambda c: F.when(F.col("g2").isNotNull() & (T.signed_day(c) != 0), T.iso_duration(T.signed_day(c).cast("bigint")))
    return m.select("doc_id", "pattern_no", "match_no", "found", iso("g1").alias("start_iso"), iso("g2").alias("end_iso"))


_NEAR = Q.quoted("(?i)" + P.NEARBY_RANGE)
_SIGNED = "CASE WHEN {0} >= 0 THEN 'P' || {0} || 'D' ELSE '-P' || -({0}) || 'D' END"


@query(f"""WITH {DOCS}, m AS ({_matches_sql(P.DAILY_COLLECTIONS)}), c AS (SELECT *, substring(text, (greatest(start - 200, 0) + 1)::BIGINT, (start + length(found) + 200 - greatest(start - 200, 0))::BIGINT) AS near FROM m),
  r AS (SELECT doc_id, kind, pattern_no, match_no, found, unnest(range(0, len(regexp_extract_all(near, {_NEAR})))) AS range_no, unnest(regexp_extract_all(near, {_NEAR}, 1)) AS g1, unnest(regexp_extract_all(near, {_NEAR}, 2)) AS g2 FROM c),
  n AS (SELECT *, {_DAYNUM.format('g1')} AS a, {_DAYNUM.format('g2')} AS b FROM r)
  SELECT doc_id, kind AS activity, pattern_no, match_no, found AS activity_name, range_no::INT AS range_no, abs(b - a) + 1 AS expected, {_SIGNED.format('a')} AS start_iso, {_SIGNED.format('b')} AS end_iso FROM n""")
def j06_daily_bindings(spark, d):
    """Daily collections bound to every range of days within 200 characters, with the number of collections expected."""
    return X.daily_bindings(_docs(spark, d), ["doc_id"])


_ANW = [(p, k) for k, p in P.ANALYSIS_WINDOWS.items()]


@query(f"""WITH {DOCS}, m AS ({_matches_sql(_ANW, 2)}), k AS ({_matches_sql(P.ANALYSIS_MARKS)})
  SELECT doc_id, kind, found, {_DAYNUM.format('g1')} AS start_day, {_DAYNUM.format('g2')} AS end_day FROM m UNION ALL SELECT doc_id, kind, found, NULL, NULL FROM k""")
def j07_analysis_windows(spark, d):
    """Analysis windows with their days, like 'Baseline period: days -7 to -1', and those named without days."""
    docs, day = _docs(spark, d), lambda c: T.signed_day(c).cast("bigint")
    with_days = X.matches(docs, ["doc_id"], _ANW, 2).select("doc_id", "kind", "found", day("g1").alias("start_day"), day("g2").alias("end_day"))
    named = X.matches(docs, ["doc_id"], P.ANALYSIS_MARKS).select("doc_id", "kind", "found", F.lit(None).cast("bigint").alias("start_day"), F.lit(None).cast("bigint").alias("end_day"))
    return with_days.unionByName(named)


@query(f"""WITH {DOCS}, m AS ({_matches_sql(P.SAMPLINGS, 1)}), n AS (SELECT *, len(string_split(g1, ',')) AS times, try_cast(g1 AS BIGINT) AS least FROM m)
  SELECT doc_id, kind, pattern_no, match_no, found, CASE WHEN kind IN ('pk', 'glucose') THEN times WHEN kind = 'minimum' THEN least END AS samples,
    CASE WHEN kind = 'glucose' THEN 'minutes' WHEN kind = 'pk' THEN CASE WHEN contains(lower(found), 'hour') OR contains(lower(found), ' h') THEN 'hours' ELSE 'minutes' END END AS unit
  FROM n WHERE kind IN ('dense', 'sparse') OR (kind IN ('pk', 'glucose') AND times >= 3) OR (kind = 'minimum' AND least BETWEEN 2 AND 50)""")
def j10_sampling(spark, d):
    """Sampling schedules (three times or more), least numbers of samples (2 to 50), dense and sparse sampling."""
    return X.samplings(_docs(spark, d), ["doc_id"])


@query()
def j15_footnote_layouts(spark, d):
    """Footnotes of five layouts in order."""
    return X.footnote_layouts(_docs(spark, d), ["doc_id"]).select("doc_id", "pos", "layout", "label", F.md5("footnote").alias("footnote"))


@query(rf"WITH {DOCS} SELECT doc_id, regexp_extract(text, '(?i)(?:\d+)[\-\s]?hours?', 0) AS first_span FROM d WHERE regexp_matches(text, '(?i)(?:\d+)[\-\s]?hours?')")
def j08_collection_anchor(spark, d):
    """One anchor a text for spans of hours."""
    return _docs(spark, d).select("doc_id", X.first_match(F.col("text"), r"(?:\d+)[\-\s]?hours?").alias("first_span")).where("first_span IS NOT NULL")


@query(rf"WITH {DOCS} SELECT doc_id, len(regexp_extract_all(text, '\d+(?:\.\d+)?')) AS numbers FROM d WHERE len(regexp_extract_all(text, '\d+(?:\.\d+)?')) >= 3")
def j09_number_lists(spark, d):
    """Texts with three numbers or more."""
    n = F.size(F.regexp_extract_all("text", F.lit(r"\d+(?:\.\d+)?"), F.lit(0)))
    return _docs(spark, d).select("doc_id", n.alias("numbers")).where("numbers >= 3")


_VIS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, line_no, {i} AS no, " + (f"'{k} ' || regexp_extract(line, {Q.quoted('(?i)' + p)}, 1)" if k else f"regexp_extract(line, {Q.quoted('(?i)' + p)}, 1)") + f" AS visit FROM l WHERE regexp_matches(line, {Q.quoted('(?i)' + p)})"
    for i, (p, k) in enumerate(P.VISITS)
)


@query(f"WITH {DOCS}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM d), v AS ({_VIS_SQL}) SELECT doc_id, lower(visit) AS k, CAST(min(line_no) AS INT) AS first_line, min_by(visit, struct_pack(l := line_no, n := no)) AS visit FROM v GROUP BY ALL")
def j11_visits(spark, d):
    """Visits by line, each name once (with j12)."""
    lines = lines_of(_docs(spark, d), ["doc_id"])
    cells = []
    for i, (p, k) in enumerate(P.VISITS):
        name = X.T.group(F.col("line"), "(?i)" + p, 1)
        cells.append(F.struct(F.lit(i).alias("no"), (F.concat(F.lit(k + " "), name) if k else name).alias("visit")))
    v = lines.select("doc_id", "line_no", F.explode(F.array(*cells)).alias("c")).select("doc_id", "line_no", "c.*").where("visit IS NOT NULL")
    return v.groupBy("doc_id", F.lower("visit").alias("k")).agg(F.min("line_no").alias("first_line"), F.min_by("visit", F.struct("line_no", "no")).alias("visit"))


_DOSE = r"([a-z]{5,})\s+(\d+)\s*(?:mg|mL|IU|ng)"


@query(f"WITH {DOCS}, m AS ({_matches_sql([(_DOSE, 'dose')], 2)}) SELECT doc_id, lower(g1) AS treatment, min_by(g2, match_no) AS amount FROM m WHERE lower(g1) NOT IN ('raised', 'under', 'lower', 'about') GROUP BY ALL")
def j13_dosing(spark, d):
    """Treatments with a dose, the first of each (with j14, e27)."""
    m = X.matches(_docs(spark, d), ["doc_id"], [(_DOSE, "dose")], 2).withColumn("treatment", F.lower("g1"))
    return m.where(~F.col("treatment").isin("raised", "under", "lower", "about")).groupBy("doc_id", "treatment").agg(F.min_by("g2", "match_no").alias("amount"))


@query(f"""WITH {DOCS}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM d),
  m AS (SELECT *, CASE WHEN regexp_matches(line, '^\\s*([a-z]|\\d{{1,2}})[.)]\\s+\\S') THEN regexp_extract(line, '^\\s*([a-z]|\\d{{1,2}})[.)]\\s+\\S', 1) END AS label, trim(line) = '' OR regexp_matches(line, '^(?:Page \\d+|Abbreviations:)') AS stop FROM l),
  b AS (SELECT *, sum((label IS NOT NULL OR stop)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM m),
  n AS (SELECT doc_id, block, max(label) AS label, string_agg(CASE WHEN label IS NOT NULL THEN trim(regexp_replace(line, '^\\s*(?:[a-z]|\\d{{1,2}})[.)]\\s+', '')) ELSE trim(line) END, ' ' ORDER BY line_no) AS f FROM b WHERE NOT stop GROUP BY ALL)
  SELECT doc_id, label, md5(max_by(f, block)) AS footnote FROM n WHERE label IS NOT NULL GROUP BY ALL""".replace("\\\\", "\\"))
def j27_footnotes(spark, d):
    """Footnotes out of lines, the last of a label."""
    return X.footnote_blocks(lines_of(_docs(spark, d), ["doc_id"]), ["doc_id"]).select("doc_id", "label", F.md5("footnote").alias("footnote"))


@query(f"""WITH {DOCS}, s AS (SELECT doc_id, [{', '.join(f"CASE WHEN contains(lower(text), {Q.quoted(w)}) THEN {Q.quoted(s)} END" for s, w in P.STATE_WORDS.items())}] AS st FROM d)
  SELECT doc_id, f AS from_state, t AS to_state, trigger FROM s, (VALUES {', '.join('(' + ', '.join(map(Q.quoted, x)) + ')' for x in P.TRANSITIONS)}) x(f, t, trigger) WHERE list_contains(st, f) AND list_contains(st, t)""")
def j18_transitions(spark, d):
    """Standard transitions between states that a text mentions (with j19)."""
    states = F.array_compact(F.array(*[F.when(F.lower("text").contains(w), s) for s, w in P.STATE_WORDS.items()]))
    docs = _docs(spark, d).select("doc_id", states.alias("st"))
    cells = [F.when(F.array_contains("st", a) & F.array_contains("st", b), F.struct(F.lit(a).alias("from_state"), F.lit(b).alias("to_state"), F.lit(t).alias("trigger"))) for a, b, t in P.TRANSITIONS]
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*cells))).alias("t")).select("doc_id", "t.*")


@query(SV + """, s AS (SELECT study_id, sid, name, lead(name) OVER w AS nxt FROM epochs WINDOW w AS (PARTITION BY study_id ORDER BY o)) SELECT study_id, sid, name AS from_state, nxt AS to_state FROM s WHERE nxt IS NOT NULL AND nxt <> name""")
def j19_state_edges(spark, d):
    """Edges between neighbouring epochs of different names (with m33)."""
    w = Window.partitionBy("study_id").orderBy("o")
    return _epochs(spark, d).withColumn("to_state", F.lead("name").over(w)).where("to_state IS NOT NULL AND to_state <> name").select("study_id", "sid", F.col("name").alias("from_state"), "to_state")


@query(f"WITH {DOCS} SELECT doc_id, greatest(2, coalesce(list_max([CAST(x AS INT) for x in regexp_extract_all(lower(text), 'part (\\d+)', 1)]), 0)) AS periods FROM d WHERE regexp_matches(lower(text), 'part \\d+')".replace("\\\\", "\\"))
def j20_periods(spark, d):
    """The largest part that a text numbers, two at least (with j21)."""
    found = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(r"part (\d+)"), F.lit(1)), lambda x: x.cast("int"))
    return _docs(spark, d).where(F.lower("text").rlike(r"part \d+")).select("doc_id", F.greatest(F.lit(2), F.coalesce(F.array_max(found), F.lit(0))).alias("periods"))


@query(f"WITH {DOCS} SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '(screening|week \\d+|day \\d+|cycle \\d+)'))) AS visits FROM d".replace("\\\\", "\\"))
def j23_mandatory_visits(spark, d):
    """The distinct visits a text names (with j22, j26)."""
    return _docs(spark, d).select("doc_id", F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(screening|week \d+|day \d+|cycle \d+)"), F.lit(1)))).alias("visits"))


@query(rf"WITH {DOCS} SELECT doc_id, coalesce(nullif(regexp_extract(text, '(\d+\s*:\s*\d+)', 1), ''), '1:1') AS ratio, try_cast(nullif(regexp_extract(lower(text), 'blocks of (\d+)', 1), '') AS INT) AS block_size, contains(lower(text), 'stratified') AS stratified FROM d WHERE contains(lower(text), 'randomi')")
def j24_randomisation(spark, d):
    """Ratio, block size and stratification."""
    x = F.col("text")
    return _docs(spark, d).where(F.lower("text").contains("randomi")).select(
        "doc_id", F.coalesce(T.group(x, r"(\d+\s*:\s*\d+)"), F.lit("1:1")).alias("ratio"), T.first_int(F.lower("text"), r"blocks of (\d+)").alias("block_size"), F.lower("text").contains("stratified").alias("stratified")
    )


_AREAS = {"oncology": ["tumour", "cycle"], "ophthalmology": ["retina", "graph"], "hepatology": ["liver"], "nephrology": ["kidney", "urine"], "neurology": ["nerve"]}


@query(f"WITH {DOCS} SELECT doc_id, unnest(list_filter([{', '.join(f'CASE WHEN {Q.any_of(chr(108) + chr(111) + chr(119), w)} THEN {Q.quoted(a)} END' for a, w in _AREAS.items())}], lambda x: x IS NOT NULL)) AS area FROM (SELECT doc_id, lower(text) AS low FROM d)")
def j30_areas(spark, d):
    """Therapeutic areas by keyword."""
    low = F.lower("text")
    cells = [F.when(reduce(lambda a, b: a | b, [low.contains(w) for w in ws]), F.lit(a)) for a, ws in _AREAS.items()]
    return _docs(spark, d).select("doc_id", F.explode(F.array_compact(F.array(*cells))).alias("area"))


_JSON = "struct<id:string,name:string,text:string,purpose:string,endpointIds:array<string>,interventionIds:array<string>>"


@query("""SELECT file_no, record_no, entity_type, payload->>'$.id' AS id, payload->>'$.name' AS name, len(CASE WHEN json_type(payload, '$.endpointIds') = 'ARRAY' THEN json_extract(payload, '$.endpointIds[*]') END) AS n_refs
  FROM (SELECT DISTINCT file_no, record_no, entity_type, payload FROM agent_files WHERE json_valid(payload) AND agent_id = 'objectives_agent')""")
def j34_objective_rows(spark, d):
    """Objective output as typed rows (with j33 to j40: one record type each)."""
    rows = table(spark, d, "agent_files").where("agent_id = 'objectives_agent'").select("file_no", "record_no", "entity_type", "payload").distinct()
    v = rows.select("file_no", "record_no", "entity_type", F.try_parse_json("payload").alias("v")).where("v IS NOT NULL")
    refs = F.try_variant_get("v", "$.endpointIds", "array<string>")
    return v.select("file_no", "record_no", "entity_type", F.try_variant_get("v", "$.id", "string").alias("id"), F.try_variant_get("v", "$.name", "string").alias("name"), F.when(refs.isNotNull(), F.size(refs)).cast("bigint").alias("n_refs"))


@query("""SELECT entity_no, version, data->>'$.id' AS id, data->>'$.primaryReason.code.code' AS reason, len(CASE WHEN json_type(data, '$.dateValues') = 'ARRAY' THEN json_extract(data, '$.dateValues[*]') END) AS dates
  FROM (SELECT DISTINCT entity_no, version, data FROM advanced_entities WHERE entity_type = 'study_amendment' AND json_valid(data))""")
def j40_amendment_rows(spark, d):
    """Amendments as typed rows (with m30)."""
    rows = table(spark, d, "advanced_entities").where("entity_type = 'study_amendment'").select("entity_no", "version", "data").distinct()
    v = rows.select("entity_no", "version", F.try_parse_json("data").alias("v")).where("v IS NOT NULL")
    dates = F.try_variant_get("v", "$.dateValues", "array<variant>")
    return v.select("entity_no", "version", F.try_variant_get("v", "$.id", "string").alias("id"), F.try_variant_get("v", "$.primaryReason.code.code", "string").alias("reason"), F.when(dates.isNotNull(), F.size(dates)).cast("bigint").alias("dates"))


@query("WITH n AS (SELECT study_id, id, unnest(data.childIds) AS child, generate_subscripts(data.childIds, 1) - 1 AS ord FROM narrative WHERE entity_type = 'narrative_content' AND NOT is_deleted) SELECT DISTINCT study_id, id, child, CAST(ord AS INT) AS ord FROM n")
def j38_sections(spark, d):
    """Sections with their subsections in order."""
    return table(spark, d, "narrative").where("entity_type = 'narrative_content' AND NOT is_deleted").select("study_id", "id", F.posexplode("data.childIds").alias("ord", "child")).select("study_id", "id", "child", "ord").distinct()


_FOOT = "CASE " + " ".join(f"WHEN regexp_matches(lower(text), {Q.quoted(p)}) THEN {Q.quoted(k)}" for p, k in P.FOOTNOTES) + " ELSE 'general' END"


@query(f"WITH n AS (SELECT DISTINCT data.text AS text FROM narrative WHERE data.text IS NOT NULL) SELECT md5(text) AS text, {_FOOT} AS kind FROM n")
def i51_footnote_class(spark, d):
    """Texts by the class of condition they state."""
    n = table(spark, d, "narrative").select(F.col("data.text").alias("text")).where("text IS NOT NULL").distinct()
    return n.select(F.md5("text").alias("text"), X.classify("text", P.FOOTNOTES, "general").alias("kind"))


@query(rf"""WITH n AS (SELECT DISTINCT lower(data.text) AS low FROM narrative WHERE data.text IS NOT NULL) SELECT md5(low) AS text, CASE WHEN regexp_matches(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)') THEN
  'timing.before(' || trim(regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)', 3)) || ', PT' || regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)', 1)
   || CASE WHEN starts_with(regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)', 2), 'h') THEN 'H' ELSE 'M' END || ')' WHEN regexp_matches(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)') THEN
  'timing.after(' || trim(regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)', 3)) || ', PT' || regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)', 1)
   || CASE WHEN starts_with(regexp_extract(low, '(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)', 2), 'h') THEN 'H' ELSE 'M' END || ')' END AS condition FROM n""")
def i50_conditions(spark, d):
    """Conditions as expressions."""
    n = table(spark, d, "narrative").select(F.lower("data.text").alias("low")).where("low IS NOT NULL").distinct()
    return n.select(F.md5("low").alias("text"), X.structured_condition("low", F.lit("timing_any")).alias("condition"))


@query(rf"""WITH n AS (SELECT DISTINCT data.text AS x FROM narrative WHERE data.text IS NOT NULL) SELECT md5(x) AS text, length(trim(lower(x))) >= 15 AND NOT (x = upper(x) AND x <> lower(x) AND length(x) > 20)
  AND NOT {Q.any_of('trim(lower(x))', P.NOISE_STARTS, 'starts_with({}, {})')} AND NOT (length(x) - length(regexp_replace(x, '[0-9]', '', 'g'))) * 2 > length(x) AND NOT regexp_matches(trim(lower(x)), '^[\[\(]?\d+[\]\)]?\.?\s*$')
  AND ({Q.any_of('trim(lower(x))', P.FOOTNOTE_WORDS)} OR length(x) > 50) AS valid FROM n""")
def b10_valid_footnotes(spark, d):
    """Texts that may be footnotes."""
    n = table(spark, d, "narrative").select(F.col("data.text").alias("x")).where("x IS NOT NULL").distinct()
    return n.select(F.md5("x").alias("text"), X.is_footnote("x").alias("valid"))


@query(rf"""WITH n AS (SELECT DISTINCT name, lower(trim(name)) AS x FROM (SELECT entity_name AS name FROM enrichment UNION ALL SELECT data.name FROM interventions) WHERE name IS NOT NULL)
  SELECT name, length(x) < 3 OR {Q.any_of('x', P.PROSE_STARTS, 'starts_with({}, {})')} OR x IN ({', '.join(map(Q.quoted, P.STOP_ONLY))}) OR regexp_matches(x, '^\d+\s*(mg|ml|mcg|g|kg|iu)?\s*(and|or)?$') OR regexp_matches(x, '^(day|week|month)\s*(and|or|$)') OR {Q.any_of('x', P.PROSE_WORDS)} AS prose FROM n""")
def b12_prose_fragments(spark, d):
    """Names that are pieces of sentences (with b11)."""
    n = table(spark, d, "enrichment").select(F.col("entity_name").alias("name")).unionByName(table(spark, d, "interventions").select(F.col("data.name").alias("name")))
    return n.where("name IS NOT NULL").distinct().select("name", X.is_prose_fragment("name").alias("prose"))


@query("WITH " + DOCS + f" SELECT doc_id, {' + '.join(f'regexp_matches(lower(text), {Q.quoted(p)})::INT' for p in P.TITRATION)} AS score, score >= 2 AS titration FROM d")
def b16_titration(spark, d):
    """Texts of titration studies by the number of signs."""
    return _docs(spark, d).select("doc_id", X.pattern_score("text", P.TITRATION).alias("score")).withColumn("titration", F.col("score") >= 2)


@query("SELECT file_no, record_no, length(payload) - length(replace(payload, '{', '')) > length(payload) - length(replace(payload, '}', '')) OR length(payload) - length(replace(payload, '[', '')) > length(payload) - length(replace(payload, ']', '')) AS truncated FROM (SELECT DISTINCT file_no, record_no, payload FROM agent_files)")
def b17_truncated_json(spark, d):
    """Payloads that were cut off."""
    from tessera.functions.names import is_truncated_json

    return table(spark, d, "agent_files").select("file_no", "record_no", "payload").distinct().select("file_no", "record_no", is_truncated_json("payload").alias("truncated"))


# --- rules ------------------------------------------------------------------------

FIELDS = [
    V.Field("objective", "text", required=True), V.Field("objective", "endpointIds", "list", required=True, most=3), V.Field("endpoint", "text", required=True),
    V.Field("endpoint", "purpose", default="Efficacy"), V.Field("estimand", "interventionIds", "list", required=True, least=2), V.Field("analysis_population", "name", required=True),
]


@query(OB + """SELECT entity_no, entity_type, 'text' AS field, 'missing' AS category, 'ERROR' AS severity FROM ob WHERE entity_type IN ('objective', 'endpoint') AND trim(coalesce(data.text, '')) = ''
  UNION ALL SELECT entity_no, entity_type, 'endpointIds', 'missing', 'ERROR' FROM ob WHERE entity_type = 'objective' AND coalesce(len(data.endpointIds), 0) = 0
  UNION ALL SELECT entity_no, entity_type, 'endpointIds', 'cardinality', 'WARNING' FROM ob WHERE entity_type = 'objective' AND len(data.endpointIds) > 3
  UNION ALL SELECT entity_no, entity_type, 'interventionIds', 'missing', 'ERROR' FROM ob WHERE entity_type = 'estimand' AND coalesce(len(data.interventionIds), 0) = 0
  UNION ALL SELECT entity_no, entity_type, 'interventionIds', 'cardinality', 'ERROR' FROM ob WHERE entity_type = 'estimand' AND len(data.interventionIds) = 1
  UNION ALL SELECT entity_no, entity_type, 'name', 'missing', 'ERROR' FROM ob WHERE entity_type = 'analysis_population' AND trim(coalesce(data.name, '')) = ''""")
def k01_schema_check(spark, d):
    """Required fields and cardinalities by a specification (with k02, k11)."""
    cols = {f: F.col(f"f_{f}") for f in ("text", "endpointIds", "interventionIds", "name", "purpose")}
    obj = _objectives(spark, d, **{f"f_{f}": F.col(f"data.{f}") for f in cols})
    return V.issues(obj, ["entity_no"], FIELDS, cols, ["objective", "endpoint", "estimand", "analysis_population"])


@query(SV + """, x AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, version, count(*) AS n FROM soa_vision GROUP BY ALL) SELECT 'encounter_name' AS rule, 'ERROR' AS severity, study_id, sid FROM encounters WHERE trim(coalesce(name, '')) = ''
  UNION ALL SELECT 'epoch_name', 'ERROR', study_id, sid FROM epochs WHERE trim(coalesce(name, '')) = '' UNION ALL SELECT 'encounter_epoch', 'WARNING', study_id, sid FROM encounters WHERE epoch IS NULL
  UNION ALL SELECT 'duplicate_row', 'WARNING', study_id, sid FROM x WHERE n > 1""")
def k03_conformance(spark, d):
    """Rules as queries, their rows in one list (with k04, k09)."""
    enc, ep = _encounters(spark, d), _epochs(spark, d)
    dup = table(spark, d, "soa_vision").groupBy("study_id", same_id("id").alias("sid"), "version").agg(F.count("*").alias("n")).where("n > 1")
    return V.rule_rows(
        [("encounter_name", "ERROR", enc.where("trim(coalesce(name, '')) = ''")), ("epoch_name", "ERROR", ep.where("trim(coalesce(name, '')) = ''")), ("encounter_epoch", "WARNING", enc.where("epoch IS NULL")), ("duplicate_row", "WARNING", dup)],
        ["study_id", "sid"],
    )


@query(OB + "SELECT entity_no, CASE WHEN trim(coalesce(data.purpose, '')) = '' AND entity_type = 'endpoint' THEN 'Efficacy' ELSE data.purpose END AS purpose, CASE WHEN trim(coalesce(data.purpose, '')) = '' AND entity_type = 'endpoint' THEN ['purpose'] ELSE [] END AS filled FROM ob")
def k07_defaults(spark, d):
    """Blank fields filled from the specification, with what was filled (with k05, k06)."""
    obj = _objectives(spark, d, purpose=F.col("data.purpose")).select("entity_no", "entity_type", "purpose")
    return V.fill_defaults(obj, [f for f in FIELDS if f.name == "purpose"]).select("entity_no", "purpose", "filled")


@query(OB + "SELECT entity_no, data.level.code AS code FROM ob WHERE data.level.code IS NOT NULL AND data.level.code NOT IN ('Q90011', 'Q90012')")
def k10_terminology(spark, d):
    """Codes outside a controlled list (with k08)."""
    return _objectives(spark, d, code=F.col("data.level.code")).where("code IS NOT NULL AND code NOT IN ('Q90011', 'Q90012')").select("entity_no", "code")


@query(SV + r""", x AS (SELECT study_id, coalesce(try_cast(regexp_extract(lower(name), 'day\s*(-?\d+)', 1) AS INT), try_cast(regexp_extract(lower(name), '\bd(-?\d+)', 1) AS INT)) AS day, sid FROM encounters)
  SELECT study_id, day, count(*) AS n, CASE WHEN day = 1 THEN 'blocking' ELSE 'warning' END AS severity FROM x WHERE day IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def k15_day_conflicts(spark, d):
    """Days that several visits claim; the first day is blocking (with k14, k16)."""
    x = _encounters(spark, d).select("study_id", T.name_timing("name")["day"].alias("day")).where("day IS NOT NULL")
    return x.groupBy("study_id", "day").agg(F.count("*").alias("n")).where("n > 1").withColumn("severity", F.when(F.col("day") == 1, "blocking").otherwise("warning"))


@query("SELECT study_id, count(*) AS n, count(*) >= 30 AS enough FROM narrative GROUP BY ALL")
def k13_enough_records(spark, d):
    """Studies with enough records (with k18)."""
    return table(spark, d, "narrative").groupBy("study_id").agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= 30)


# --- terminology ------------------------------------------------------------------


@query("""WITH t AS (SELECT DISTINCT trim(entity_name) AS term FROM enrichment WHERE trim(entity_name) <> ''), s AS (SELECT code, unnest(synonyms) AS syn FROM concepts), e AS (SELECT lower(name) AS k, code, 1 AS tier FROM concepts UNION ALL SELECT lower(syn), code, 2 FROM s)
  SELECT term, min_by(code, struct_pack(t := tier, c := code)) AS code, min(tier) AS tier FROM t JOIN e ON lower(term) = k GROUP BY ALL""")
def a22_exact_lookup(spark, d):
    """Terms by exact name, else exact synonym (with a23, l04)."""
    c = table(spark, d, "concepts")
    e = c.select(F.lower("name").alias("k"), "code", F.lit(1).alias("tier")).unionByName(c.select("code", F.explode("synonyms").alias("s")).select(F.lower("s").alias("k"), "code", F.lit(2).alias("tier")))
    t = table(spark, d, "enrichment").where("trim(entity_name) <> ''").select(F.trim("entity_name").alias("term")).distinct()
    return t.join(e, F.lower("term") == F.col("k")).groupBy("term").agg(F.min_by("code", F.struct("tier", "code")).alias("code"), F.min("tier").alias("tier"))


@query("SELECT code, name FROM concepts WHERE contains(lower(name), 'test') ORDER BY code LIMIT 10")
def a24_term_search(spark, d):
    """The first ten concepts that contain a term."""
    return table(spark, d, "concepts").where(F.lower("name").contains("test")).select("code", "name").orderBy("code").limit(10)


@query("SELECT e.result_no, e.code, coalesce(c.name, e.display_name) AS display FROM (SELECT DISTINCT result_no, code, display_name FROM enrichment) e LEFT JOIN concepts c ON c.code = regexp_replace(trim(e.code), '^vocab:', '')")
def l02_write_back(spark, d):
    """Results with the name their code has in the list (with l03, l05)."""
    e = table(spark, d, "enrichment").select("result_no", "code", "display_name").distinct().withColumn("k", F.regexp_replace(F.trim("code"), "^vocab:", ""))
    c = table(spark, d, "concepts").select(F.col("code").alias("k"), "name")
    return e.join(c, "k", "left").select("result_no", "code", F.coalesce("name", "display_name").alias("display"))


def _codes(table_):
    return "(VALUES " + ", ".join(f"({Q.quoted(k)}, {Q.quoted(v)}, {i})" for i, (k, v) in enumerate(table_.items())) + ") c(k, code, i)"


@query(f"WITH {Q.NAMES}, t AS (SELECT name AS text FROM names WHERE name <> '' UNION SELECT entity_name FROM enrichment WHERE entity_name <> '' UNION SELECT trim(unnest(string_split(text, chr(10)))) FROM documents) SELECT text, min_by(code, CASE WHEN k = lower(text) THEN -1 ELSE i END) AS code FROM t JOIN {_codes({**P.PHASES, **P.BLINDING_CODES})} ON contains(lower(text), k) OR contains(k, lower(text)) WHERE text <> '' GROUP BY ALL")
def i52_code_by_text(spark, d):
    """Names, typed terms and lines that have a code, by equal, else by first contained or containing key (with i53, l07)."""
    keys = {**P.PHASES, **P.BLINDING_CODES}
    low = F.lower("text")
    code = F.when(F.lit(False), "")
    for k, v in keys.items():
        code = code.when(low == k, v)
    for k, v in keys.items():
        code = code.when(low.contains(k) | F.lit(k).contains(low), v)
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("text")).select(F.trim("text").alias("text"))
    texts = views.names(spark, d).select(F.col("name").alias("text")).unionByName(table(spark, d, "enrichment").select(F.col("entity_name").alias("text"))).unionByName(lines)
    return texts.where("text <> ''").distinct().select("text", code.otherwise(None).alias("code")).where("code IS NOT NULL")


# --- assembly ---------------------------------------------------------------------

_PLACE = "CASE entity_type " + " ".join(f"WHEN {Q.quoted(k)} THEN {Q.quoted(v)}" for k, v in P.PLACEMENT.items()) + " END"


@query(f"WITH {Q.ENTITIES}, {Q.LIVE} SELECT study_id, coalesce({_PLACE}, 'rejected') AS path, list(sid ORDER BY pos, entity_no) AS ids FROM live GROUP BY ALL")
def m02_placement(spark, d):
    """Entities by their place in the study document, in order; types without one are set aside (with m01, m03)."""
    from tessera.queries import views

    place = reduce(lambda w, kv: w.when(F.col("entity_type") == kv[0], kv[1]), P.PLACEMENT.items(), F.when(F.lit(False), "")).otherwise("rejected")
    rows = views.live(spark, d).withColumn("path", place).withColumn("o", F.struct("pos", "entity_no"))
    return K.nest(rows, ["study_id", "path"], "o", ["sid"], "x").select("study_id", "path", F.transform("x", lambda x: x["sid"]).alias("ids"))


@query(SV + "SELECT p.study_id, p.sid AS epoch, list_sort(list(e.sid) FILTER (e.sid IS NOT NULL)) AS encounters FROM epochs p LEFT JOIN encounters e ON e.study_id = p.study_id AND e.epoch = p.sid GROUP BY ALL".replace("list_sort(list(e.sid) FILTER (e.sid IS NOT NULL))", "coalesce(list_sort(list(e.sid) FILTER (e.sid IS NOT NULL)), [])"))
def m04_instances(spark, d):
    """One record per epoch with its encounters, empty where it has none (with m11, m25)."""
    enc = _encounters(spark, d).select("study_id", "epoch", F.col("sid").alias("e"))
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    return ep.join(enc, ["study_id", "epoch"], "left").groupBy("study_id", "epoch").agg(F.array_sort(F.collect_list("e")).alias("encounters"))


_KINDS = ["screening", "treatment", "follow-up"]


@query(SV + ", k AS (SELECT study_id, epoch, sid, CASE " + " ".join(f"WHEN contains(lower(name), '{k}') THEN '{k}'" for k in _KINDS) + """ ELSE 'other' END AS kind FROM encounters WHERE epoch IS NOT NULL)
  SELECT study_id, epoch, """ + ", ".join(f"CASE WHEN count(*) FILTER (kind = '{k}') > 0 THEN 'X' END AS \"{k}\"" for k in [*_KINDS, "other"]) + " FROM k GROUP BY ALL")
def m05_schedule(spark, d):
    """A schedule table: rows by epoch, an X for each kind of visit (with m06)."""
    kind = reduce(lambda w, k: w.when(F.lower("name").contains(k), k), _KINDS, F.when(F.lit(False), "")).otherwise("other")
    enc = _encounters(spark, d).where("epoch IS NOT NULL").withColumn("kind", kind).withColumn("x", F.lit("X"))
    return enc.groupBy("study_id", "epoch").pivot("kind", [*_KINDS, "other"]).agg(F.first("x"))


@query(SV + """SELECT study_id, 'epoch' AS what, sid AS a, NULL AS b FROM epochs UNION ALL SELECT study_id, 'encounter', sid, NULL FROM encounters
  UNION ALL SELECT e.study_id, 'edge', e.epoch, e.sid FROM encounters e SEMI JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch""")
def m07_graph(spark, d):
    """Nodes and valid edges of the schedule graph."""
    enc, ep = _encounters(spark, d), _epochs(spark, d)
    none = F.lit(None).cast("string").alias("b")
    nodes = ep.select("study_id", F.lit("epoch").alias("what"), F.col("sid").alias("a"), none).unionByName(enc.select("study_id", F.lit("encounter").alias("what"), F.col("sid").alias("a"), none))
    edges = enc.join(ep.select("study_id", F.col("sid").alias("epoch")), ["study_id", "epoch"], "left_semi").select("study_id", F.lit("edge").alias("what"), F.col("epoch").alias("a"), F.col("sid").alias("b"))
    return nodes.unionByName(edges)


@query(OB + """, o AS (SELECT study_id, coalesce(data.level.decode, 'none') AS level, list(DISTINCT data.text ORDER BY data.text) FILTER (data.text IS NOT NULL) AS texts, count(*) AS n FROM ob WHERE entity_type = 'objective' GROUP BY ALL) SELECT study_id, level, n, md5(array_to_string(texts, ' ')) AS text FROM o WHERE texts IS NOT NULL""")
def m09_merged_objectives(spark, d):
    """Objectives of one level merged, their texts joined once each."""
    o = _objectives(spark, d, "objective", t=F.col("data.text"), level=F.coalesce("data.level.decode", F.lit("none")))
    return o.groupBy("study_id", "level").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("t")).alias("x")).where("size(x) > 0").select("study_id", "level", "n", F.md5(F.array_join("x", " ")).alias("text"))


@query("SELECT entity_no, version, data.id AS id, replace(data.name, '_', '-') AS name, strftime(created_at, '%Y-%m-%d') AS \"dateValue\" FROM interventions")
def m10_cleanup(spark, d):
    """Final cleanup: fields dropped, renamed and rewritten (with m08)."""
    return table(spark, d, "interventions").select("entity_no", "version", F.col("data").dropFields("instanceType", "description", "role").alias("data"), F.date_format("created_at", "yyyy-MM-dd").alias("dateValue")).select("entity_no", "version", "data.id", F.replace("data.name", F.lit("_"), F.lit("-")).alias("name"), "dateValue")


@query(SV + """, t AS (SELECT study_id, lower(name) AS k, max_by(sid, o) AS target FROM epochs GROUP BY ALL) SELECT e.study_id, e.sid, coalesce(p.sid, t.target) AS target FROM encounters e LEFT JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch LEFT JOIN t ON t.study_id = e.study_id AND t.k = lower(e.name)""")
def m12_targets(spark, d):
    """Targets by id, else by name, the last one of a name (with m13, m14, m16, m17)."""
    ep = _epochs(spark, d)
    by_id = ep.select("study_id", F.col("sid").alias("epoch"), F.col("sid").alias("t1"))
    by_name = ep.groupBy("study_id", F.lower("name").alias("k")).agg(F.max_by("sid", "o").alias("t2"))
    enc = _encounters(spark, d).withColumn("k", F.lower("name"))
    return enc.join(by_id, ["study_id", "epoch"], "left").join(by_name, ["study_id", "k"], "left").select("study_id", "sid", F.coalesce("t1", "t2").alias("target"))


@query(SV + """SELECT study_id, sid AS arm, unnest(range(1, 1 + CAST(pos % 3 + 1 AS INT))) AS period, pos % 3 + 1 AS periods FROM epochs""".replace("AS period,", "AS period,"))
def m18_crossover(spark, d):
    """Arms with one cell for each period."""
    n = F.col("pos") % 3 + 1
    return _epochs(spark, d).select("study_id", F.col("sid").alias("arm"), F.explode(F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"))).alias("period"), n.alias("periods"))


@query("""SELECT entity_no, version, list_append([x for x in [{'url': 'a', 'v': 'old'}, {'url': 'b', 'v': source_agent}] if x.url <> 'a'], {'url': 'a', 'v': coalesce(model, '')}) AS ext FROM interventions""")
def m22_extensions(spark, d):
    """An extension set by its address: the old one goes, the new one is last."""
    s = lambda u, v: F.struct(F.lit(u).alias("url"), v.alias("v"))
    old = F.array(s("a", F.lit("old")), s("b", F.col("source_agent")))
    return table(spark, d, "interventions").select("entity_no", "version", F.array_append(F.filter(old, lambda x: x["url"] != "a"), s("a", F.coalesce("model", F.lit("")))).alias("ext"))


@query(SV + """SELECT study_id, sid, 'kept' AS origin FROM epochs UNION ALL SELECT study_id, 'el_' || md5(study_id || lower(name)), 'made' FROM (SELECT DISTINCT study_id, name FROM (SELECT study_id, lower(name) AS name FROM encounters WHERE name IS NOT NULL)) x ANTI JOIN (SELECT study_id, lower(name) AS name FROM epochs) y USING (study_id, name)""")
def m26_elements(spark, d):
    """Elements that are there, and one made for each name without (with m27 to m31)."""
    ep = _epochs(spark, d)
    need = _encounters(spark, d).where("name IS NOT NULL").select("study_id", F.lower("name").alias("name")).distinct()
    made = K.missing_from(need, ep.select("study_id", F.lower("name").alias("name")), ["study_id", "name"])
    return ep.select("study_id", "sid", F.lit("kept").alias("origin")).unionByName(made.select("study_id", F.concat(F.lit("el_"), F.md5(F.concat("study_id", "name"))).alias("sid"), F.lit("made").alias("origin")))


@query("""WITH g AS (SELECT source, n, row_number() OVER (ORDER BY source) - 1 AS r FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)) SELECT source, n, 'grp_' || r AS grp, r % 2 = 0 AS shown FROM g""")
def m19_reporting(spark, d):
    """Groups of a report with stable numbers (with m15, m20, m21)."""
    g = table(spark, d, "documents").where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"))
    r = F.row_number().over(Window.orderBy("source")) - 1  # one row a source
    return g.select("source", "n", F.concat(F.lit("grp_"), r.cast("string")).alias("grp"), (r % 2 == 0).alias("shown"))


# --- pages and exports ------------------------------------------------------------


@query(r"""WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\n\s*\n')) AS t, generate_subscripts(regexp_split_to_array(text, '\n\s*\n'), 1) - 1 AS page_no FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, CAST(page_no AS INT) AS page_no, length(t) AS char_count, md5(t) AS text FROM p""")
def a04_pages(spark, d):
    """Texts as pages (with a02, a05)."""
    return D.pages_of(table(spark, d, "documents").where("text IS NOT NULL"), "doc_id").select("doc_id", "page_no", F.col("char_count").cast("bigint").alias("char_count"), F.md5("text").alias("text"))


@query(r"""WITH p AS (SELECT doc_id, regexp_split_to_array(text, '\n\s*\n') AS a FROM (SELECT doc_id, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY 1))
  SELECT doc_id, md5('--- Page 1 ---' || chr(10) || CASE WHEN length(a[1]) > 10000 THEN left(a[1], 10000) || ' [cut]' ELSE a[1] END || CASE WHEN len(a) >= 3 THEN chr(10) || chr(10) || '--- Page 3 ---' || chr(10) || CASE WHEN length(a[3]) > 10000 THEN left(a[3], 10000) || ' [cut]' ELSE a[3] END ELSE '' END) AS text FROM p""")
def a01_joined_pages(spark, d):
    """Chosen pages as one text with page marks."""
    return D.joined_pages(D.pages_of(_docs(spark, d), "doc_id"), "doc_id", [0, 2]).select("doc_id", F.md5("text").alias("text"))


@query("SELECT file_name, file_no FROM (SELECT DISTINCT file_name, file_no, study_id FROM agent_files) QUALIFY row_number() OVER (PARTITION BY study_id, split_part(file_name, '/', 2) ORDER BY file_name DESC) = 1")
def a08_latest_output(spark, d):
    """The latest output folder of each study and file (with a07)."""
    f = table(spark, d, "agent_files").select("file_name", "file_no", "study_id").distinct().withColumn("part", F.split_part("file_name", F.lit("/"), F.lit(2)))
    return M.rank_first(f, ["study_id", "part"], [F.desc("file_name")]).select("file_name", "file_no")


@query("SELECT entity_no, version, coalesce(CASE WHEN json_valid(data) THEN data->>'$.number' END, CASE WHEN json_valid(data) THEN data->>'$.name' END) AS label FROM advanced_entities")
def a09_alternate_paths(spark, d):
    """A value under either of two names (with a17, o01)."""
    v = F.try_parse_json("data")
    return table(spark, d, "advanced_entities").select("entity_no", "version", F.coalesce(F.try_variant_get(v, "$.number", "string"), F.try_variant_get(v, "$.name", "string")).alias("label"))


@query("SELECT entity_no, version, array_to_string(source_pages, '; ') AS pages, left(data.text, 100) AS text FROM narrative")
def a12_flat_component(spark, d):
    """A component as text columns: lists joined, texts cut (with a15)."""
    df = table(spark, d, "narrative").select("entity_no", "version", F.col("source_pages").alias("pages"), F.col("data.text").alias("text"))
    return D.flat_component(df, ["entity_no", "version", "pages", "text"]).withColumns({"entity_no": F.col("entity_no").cast("bigint"), "version": F.col("version").cast("int")})


@query("SELECT result_no, md5(coalesce(entity_name, '') || '|' || coalesce(code, '')) AS row_hash FROM enrichment")
def a16_export_hash(spark, d):
    """Rows as they leave, one text each (with i55)."""
    return table(spark, d, "enrichment").select("result_no", F.md5(F.concat(F.coalesce("entity_name", F.lit("")), F.lit("|"), F.coalesce("code", F.lit("")))).alias("row_hash"))


@query("SELECT study_id, count(DISTINCT file_no) AS files, count(*) FILTER (entity_type = 'objective') AS objectives, max(file_ts) AS newest FROM agent_files GROUP BY ALL")
def a18_listing(spark, d):
    """Studies with counts and time of their newest output."""
    return table(spark, d, "agent_files").groupBy("study_id").agg(F.count_distinct("file_no").alias("files"), F.count_if(F.col("entity_type") == "objective").alias("objectives"), F.max("file_ts").alias("newest"))


# --- greedy and fuzzy operators (no SQL form) ------------------------------------


@query()
def e01_fuzzy_groups(spark, d):
    """Leaders of similar names among a study's endpoints and objectives, in order (with e06, e07, e09, e26)."""
    return Z.similar_leaders(_objectives(spark, d).where("name IS NOT NULL"), ["study_id", "entity_type"], "entity_no", "name")


@query()
def o03_greedy_matching(spark, d):
    """Live records of one copy against those of the other by study and type, each taken once, best first in order (with h08, o04)."""
    row = lambda t, c: _current(spark, d, t, entity_no=F.lit(0)).select("study_id", "entity_type", F.struct("study_id", "entity_type", "pos", "sid").alias(c), F.col("name").alias("text"))
    found = Z.greedy_text_matching(row("narrative", "g"), row("narrative_mirror", "e"), ["study_id", "entity_type"], 0.7)
    return found.select("g.study_id", "g.entity_type", F.col("g.sid").alias("g"), F.col("e.sid").alias("e"), F.round("score", 6).alias("score"))


_VERSIONS = """WITH v AS (SELECT study_id, entity_type, lower(replace(trim(id), '-', '_')) AS sid, version, is_deleted, data.name AS name, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn FROM soa_vision),
  g AS (SELECT study_id, sid, entity_type, max(name) AS name FROM v WHERE version = 1 GROUP BY ALL), e AS (SELECT study_id, sid, name FROM v WHERE rn = 1 AND NOT is_deleted)"""
_PLAIN = r"(CASE WHEN lower(trim(coalesce({0}, ''))) IN (" + ", ".join(map(Q.quoted, N.PLACEHOLDERS)) + r") THEN '' ELSE regexp_replace(lower(trim({0})), '\s+', ' ', 'g') END)"
_either = lambda words, a="a", b="b": "(" + " OR ".join(f"(contains({a}, {Q.quoted(w)}) AND contains({b}, {Q.quoted(w)}))" for w in words) + ")"


@query(rf"""{_VERSIONS}, p AS (SELECT study_id, sid, entity_type, {_PLAIN.format('g.name')} AS a, {_PLAIN.format('e.name')} AS b FROM g JOIN e USING (study_id, sid)),
  c AS (SELECT *, trim(regexp_replace(a, '\s+[a-z]$', '')) AS x, trim(regexp_replace(b, '\s+[a-z]$', '')) AS y FROM p)
  SELECT study_id, sid, entity_type, CASE WHEN entity_type = 'encounter' THEN CASE WHEN list_has_any(regexp_extract_all(a, 'day\s*(-?\d+)', 1), regexp_extract_all(b, '(-?\d+)', 1)) THEN 0.9::DOUBLE WHEN {_either(Y.VISIT_WORDS)} THEN 0.8 END
    ELSE CASE WHEN {_either(Y.EPOCH_WORDS, 'x', 'y')} THEN 0.85 WHEN starts_with(x, y) OR starts_with(y, x) OR {" OR ".join(f"(contains(x, {Q.quoted(k)}) AND contains(y, {Q.quoted(w)}))" for k, v in Y.EPOCH_SHORT.items() for w in v)} THEN 0.8 END END AS score FROM c""")
def o02_typed_similarity(spark, d):
    """The first versions of epochs and encounters beside the current ones, scored by the rules of their types; null where only the texts can tell."""
    first = table(spark, d, "soa_vision").where("version = 1").groupBy("study_id", same_id("id").alias("sid"), "entity_type").agg(F.max("data.name").alias("g"))
    both = first.join(live_entities(table(spark, d, "soa_vision"), {"e": F.col("data.name")}), ["study_id", "sid"])
    none = lambda a, b: F.lit(None).cast("double")
    score = F.coalesce(*[F.when(F.col("entity_type") == k, Y.typed_similarity(k, {"name": F.col("g")}, {"name": F.col("e")}, none)) for k in ("encounter", "epoch")])
    return both.select("study_id", "sid", "entity_type", score.alias("score"))


@query()
def o06_set_match(spark, d):
    """Share of epoch names with a similar name among encounters, per study (with i14)."""
    e = _epochs(spark, d).where("name IS NOT NULL").select("study_id", F.col("name").alias("text")).distinct()
    a = _encounters(spark, d).where("name IS NOT NULL").select("study_id", F.col("name").alias("text")).distinct()
    return Z.set_match_share(e, a, ["study_id"])
