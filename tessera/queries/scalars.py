"""Queries of the scalar functions (I rows and the predicates of B)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions import timing as T
from tessera.functions.mappings import LADDERS
from tessera.plans.runtime import table
from tessera.queries import sqltext as Q
from tessera.queries import views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _phrases(spark, d):
    """Every short text of the tables once: names, typed terms, section types and the lines of documents."""
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("phrase"))
    typed = table(spark, d, "enrichment").select(F.explode(F.array("entity_name", "display_name")).alias("phrase"))
    kinds = table(spark, d, "documents").select(F.explode(F.array("source", "section_type", "lang")).alias("phrase"))
    return reduce(lambda x, y: x.unionByName(y), [views.names(spark, d).select(F.col("name").alias("phrase")), typed, kinds, lines]).distinct()


_PHRASES = f"""{Q.NAMES}, p AS (SELECT name AS phrase FROM names UNION SELECT unnest([entity_name, display_name]) FROM enrichment UNION SELECT unnest([source, section_type, lang]) FROM documents
  UNION SELECT unnest(string_split(text, chr(10))) FROM documents)"""


def _ladder_query(name, row, lad):
    def query(spark, d):
        return _phrases(spark, d).select("phrase", lad.column("phrase").alias("mapped")).groupBy("mapped").agg(F.count("*").alias("n"), F.sum(F.length("phrase")).alias("characters"), F.max("phrase").alias("last"))

    sql = f"WITH {_PHRASES}, m AS (SELECT phrase, {Q.ladder('phrase', lad)} AS mapped FROM p) SELECT mapped, count(*) AS n, sum(length(phrase)) AS characters, max(phrase) AS last FROM m GROUP BY 1"
    query.__doc__ = f"The short texts of all tables mapped by the rules of {name}, counted by result."
    QUERIES[f"{row}_{name}"], ORACLES[f"{row}_{name}"] = query, sql


for _name, (_row, _lad) in LADDERS.items():
    _ladder_query(_name, _row, _lad)


def _over_names(key, columns, sql: dict[str, str], doc: str):
    """A query that adds columns to the distinct names."""

    def query(spark, d):
        return views.names(spark, d).select("name", *[c.alias(k) for k, c in columns().items()])

    query.__doc__ = doc
    QUERIES[key] = query
    ORACLES[key] = f"WITH {Q.NAMES} SELECT name, {', '.join(f'{v} AS {k}' for k, v in sql.items())} FROM names"


_over_names("i01_clean_name", lambda: {"clean": N.clean_name("name")}, {"clean": Q.one_space(Q.drop_each(Q.one_space("name"), N.TRAILING_MARKS))}, "Names without footnote marks.")
_over_names("i02_clean_name_letters", lambda: {"clean": N.clean_name_letters("name")}, {"clean": Q.one_space(Q.drop_each("trim(name)", N.LETTER_SUFFIXES))}, "Names without footnote letters.")
_over_names(
    "i03_footnote_letters", lambda: {"refs": F.array_join(N.footnote_letters("name"), "|")},
    {"refs": r"concat_ws('|', nullif(regexp_extract(name, '\s+([a-z])\.?$', 1), ''), nullif(regexp_extract(name, '\(([a-z])\)$', 1), ''))"}, "Footnote letters of names.",
)
_over_names("i04_matching_form", lambda: {"form": N.matching_form("name")}, {"form": Q.one_space(r"regexp_replace(lower(name), '[^a-z0-9\s\-]', '', 'g')")}, "Names for matching.")
_marks = N.SUPERSCRIPTS + "".join(N.SYMBOL_WORDS)
_words = [*N.PLAIN, *N.SYMBOL_WORDS.values()]
_over_names(
    "i05_superscripts", lambda: {"clean": N.split_superscripts("name")["clean"], "refs": F.array_join(N.split_superscripts("name")["refs"], "|")},
    {
        "clean": f"trim(translate(name, {Q.quoted(_marks)}, ''))",
        "refs": f"array_to_string([list_extract([{', '.join(map(Q.quoted, _words))}], instr({Q.quoted(_marks)}, c)) for c in string_split(name, '') if c <> '' and contains({Q.quoted(_marks)}, c)], '|')",
    },
    "Names and their superscripts.",
)
_over_names("i06_strip_superscripts", lambda: {"clean": N.strip_superscripts("name")}, {"clean": f"trim(translate(name, {Q.quoted(N.SUPERSCRIPTS)}, ''))"}, "Names without superscripts.")
_over_names("i07_drop_timing", lambda: {"clean": N.drop_timing("name")}, {"clean": f"trim({Q.drop_each('trim(name)', N.TIMING_SUFFIXES)})"}, "Names without timing.")
_over_names("i10_epoch_form", lambda: {"form": N.epoch_form("name")}, {"form": "lower(" + Q.one_space(r"regexp_replace(regexp_replace(name, '[¹²³⁰-⁹₀-₉*†‡§¶ᵃ-ᵛ]', '', 'g'), '[-_]', ' ', 'g')") + ")"}, "Epoch names for comparison.")
_over_names(
    "i11_tokens", lambda: {"tokens": F.array_join(N.token_set("name"), "|")},
    {"tokens": r"array_to_string(list_sort(list_distinct([w for w in regexp_split_to_array(lower(name), '[\s/\-(),]+') if w <> '' and not list_contains([" + ", ".join(map(Q.quoted, N.STOP_WORDS)) + "], w)])), '|')"},
    "Token sets of names.",
)
_over_names("i12_ampersands", lambda: {"escaped": N.escape_ampersands(F.concat("name", F.lit(" & b &amp; &#12; &x")))}, {"escaped": "replace(regexp_replace(regexp_replace(name || ' & b &amp; &#12; &x', '&([a-zA-Z]+|#[0-9]+|#x[0-9a-fA-F]+);', chr(1) || '\\1;', 'g'), '&', '&amp;', 'g'), chr(1), '&')"}, "Ampersands as entities.")
_over_names("i13_plain_text", lambda: {"plain": N.plain_text("name")}, {"plain": r"CASE WHEN lower(trim(coalesce(name, ''))) IN (" + ", ".join(map(Q.quoted, N.PLACEHOLDERS)) + r") THEN '' ELSE regexp_replace(lower(trim(name)), '\s+', ' ', 'g') END"}, "Text for comparison.")
_over_names("i17_name_timing", lambda: {k: T.name_timing("name")[k] for k in ("day", "week", "month")}, {
    "day": r"coalesce(try_cast(regexp_extract(lower(name), 'day\s*(-?\d+)', 1) AS INT), try_cast(regexp_extract(lower(name), '\bd(-?\d+)', 1) AS INT))",
    "week": r"coalesce(try_cast(regexp_extract(lower(name), 'week\s*(\d+)', 1) AS INT), try_cast(regexp_extract(lower(name), 'wk\s*(\d+)', 1) AS INT))",
    "month": r"try_cast(regexp_extract(lower(name), 'month\s*(\d+)', 1) AS INT)"}, "Days, weeks and months of names.")
_over_names("i18_signed_day", lambda: {"day": T.signed_day("name")}, {"day": r"coalesce(CASE WHEN regexp_matches(translate(name, '–−—', '---'), '-\s*\d') THEN -1 ELSE 1 END * try_cast(regexp_extract(name, '(\d+)', 1) AS INT), 0)"}, "Signed days.")
_over_names("i38_dose_range", lambda: {k: T.dose_range("name")[k] for k in ("low", "high")}, {
    "low": r"CASE WHEN regexp_matches(trim(name), '^(\d+(?:\.\d+)?)\s*[-–]\s*(\d+(?:\.\d+)?)') THEN try_cast(regexp_extract(trim(name), '^(\d+(?:\.\d+)?)', 1) AS DOUBLE) ELSE coalesce(try_cast(regexp_extract(name, '(\d+(?:\.\d+)?)', 1) AS DOUBLE), 0) END",
    "high": r"CASE WHEN regexp_matches(trim(name), '^(\d+(?:\.\d+)?)\s*[-–]\s*(\d+(?:\.\d+)?)') THEN try_cast(regexp_extract(trim(name), '^(\d+(?:\.\d+)?)\s*[-–]\s*(\d+(?:\.\d+)?)', 2) AS DOUBLE) END"}, "Doses and dose ranges.")
_win = lambda i: "CASE " + " ".join(f"WHEN contains(lower(name), {Q.quoted(k)}) THEN {v[i]}" for k, v in T.DEFAULT_WINDOWS.items()) + f" ELSE {T.OTHER_WINDOW[i]} END"
_over_names("i46_default_window", lambda: {"before": T.default_window("name")["before"], "after": T.default_window("name")["after"]}, {"before": _win(0), "after": _win(1)}, "Usual windows of visits.")
_visit = r"trim(regexp_replace(regexp_replace(trim(lower(name)), '\s*\([^)]+\)\s*$', ''), '\s*[-/]\s*(discharge|start|return|end|visit).*$', ''))"
_over_names("i49_visit_form", lambda: {"form": T.visit_form("name")}, {"form": "CASE " + " ".join(f"WHEN {_visit} IN ({', '.join(map(Q.quoted, v))}) THEN {Q.quoted(k)}" for k, v in T.VISIT_SYNONYMS.items()) + f" ELSE {_visit} END"}, "Visit names with synonyms as one.")
_over_names("i59_state_key", lambda: {"key": N.state_key("name")}, {"key": "translate(name, ' -', '__')"}, "Names as keys.")
_over_names("i60_activity_name", lambda: {"inner": N.activity_name(F.concat(F.lit("Activity(id='1', name='"), "name", F.lit("', x=2)")))}, {"inner": "CASE WHEN regexp_extract('Activity(id=''1'', name=''' || name || ''', x=2)', 'Activity\\(.*?name=''([^'']*)''', 1) <> '' THEN regexp_extract('Activity(id=''1'', name=''' || name || ''', x=2)', 'Activity\\(.*?name=''([^'']*)''', 1) ELSE 'Activity(id=''1'', name=''' || name || ''', x=2)' END"}, "Names inside printed objects.")
_over_names("i56_extension_url", lambda: {"url": F.concat(F.lit("urn:tessera:extension/x-"), N.state_key("name"))}, {"url": "'urn:tessera:extension/x-' || translate(name, ' -', '__')"}, "Extension addresses.")
_over_names("e03_timepoint", lambda: {"timepoint": T.timepoint("name")}, {"timepoint": "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(name, {Q.quoted(p)}) THEN {Q.quoted(t.split('{}')[0])} || " + " || ".join(f"replace(regexp_extract(name, {Q.quoted(p)}, {i + 1}), '_', '-') || {Q.quoted(x)}" for i, x in enumerate(t.split('{}')[1:])) + " END" for p, t in T.TIMEPOINTS)
    + r", CASE WHEN regexp_matches(name, '\([^)]{2,}\)') THEN 'rel_' || regexp_replace(trim(replace(regexp_extract(name, '\(([^)]{2,})\)', 1), '_', '-')), '\s+', '_', 'g') END)"}, "Time points of visit names.")


def i08_standard_id(spark, d):
    """Ids with underscores."""
    return views.entities(spark, d).select("table_name", "id", N.standard_id("id").alias("standard")).distinct()


def i16_iso_duration(spark, d):
    """Signed amounts as ISO 8601 text, in several units."""
    df = table(spark, d, "lineitem").select((F.col("l_linenumber") - 4).alias("amount"), F.element_at(F.array(*map(F.lit, ["days", "weeks", "hours", "min", "other"])), (F.col("l_suppkey") % 5 + 1).cast("int")).alias("unit"))
    return df.select("amount", "unit", T.iso_duration(F.col("amount"), F.col("unit")).alias("iso")).distinct()


def i15_iso_date(spark, d):
    """Dates in several layouts as ISO text."""
    day = F.col("o_orderdate")
    layouts = [F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd MMM yyyy"), F.date_format(day, "MMMM d, yyyy"), F.date_format(day, "dd/MM/yyyy"), F.date_format(day, "yyyy/MM/dd"), F.lit("soon")]
    df = table(spark, d, "orders").select(F.element_at(F.array(*layouts), (F.col("o_orderkey") % 6 + 1).cast("int")).alias("written"))
    return df.select("written", T.iso_date("written").alias("iso")).distinct()


def i19_path_access(spark, d):
    """A value deep in JSON with a default."""
    return table(spark, d, "advanced_entities").select("entity_no", "version", F.coalesce(F.get_json_object("data", "$.primaryReason.code.code"), F.lit("none")).alias("reason")).distinct()


def i24_code_text(spark, d):
    """The readable part of a code, else the code."""
    return table(spark, d, "objectives").select("entity_no", "version", F.coalesce("data.level.decode", "data.level.code").alias("level")).distinct()


def i25_complete_code(spark, d):
    """Codes with defaults for what they lack."""
    lv = "data.level."
    return table(spark, d, "objectives").where("data.level.code IS NOT NULL").select(
        F.coalesce(F.nullif(F.col(lv + "id"), F.lit("")), F.concat(F.lit("code_"), F.col(lv + "code"))).alias("id"), F.col(lv + "code").alias("code"),
        F.coalesce(lv + "codeSystem", F.lit("urn:default")).alias("code_system"), F.coalesce(lv + "codeSystemVersion", F.lit("1")).alias("code_system_version"),
        F.coalesce(lv + "decode", lv + "code").alias("decode"), F.coalesce(lv + "instanceType", F.lit("Code")).alias("instance_type"),
    ).distinct()


def i48_window_allowance(spark, d):
    """Windows that texts state."""
    df = table(spark, d, "lineitem").select((F.col("l_linenumber")).alias("a"), (F.col("l_suppkey") % 5).alias("b"), (F.col("l_partkey") % 6).alias("k"))
    a, b = F.col("a").cast("string"), F.col("b").cast("string")
    texts = [F.concat(F.lit("Day 7 (± "), a, F.lit(" days)")), F.concat(F.lit("within "), a, F.lit(" days")), F.concat(F.lit("-"), a, F.lit(" to +"), b, F.lit(" days")), F.concat(F.lit("window of "), a, F.lit(" days")), F.concat(a, F.lit("-day window")), F.lit("none stated")]
    df = df.select(F.element_at(F.array(*texts), (F.col("k") + 1).cast("int")).alias("text"))
    return df.select("text", T.window_allowance("text")["before"].alias("before"), T.window_allowance("text")["after"].alias("after")).distinct()


def i47_visit_timing(spark, d):
    """Day and week of visits from name and surroundings."""
    df = table(spark, d, "soa_vision").where("data.name IS NOT NULL").select(F.col("data.name").alias("name"), F.concat(F.lit("Week "), (F.col("pos") % 9).cast("string")).alias("context"))
    timing = T.visit_timing("name", "context")
    return df.select("name", "context", timing["day"].alias("day"), timing["week"].alias("week"), T.is_required_visit("name").alias("required")).distinct()


def i54_confidence_label(spark, d):
    """Confidence as level and percent, pages as text."""
    c, p = F.col("confidence"), F.col("source_pages")
    level = F.when(c.isNull(), "unknown").when(c >= 0.75, "high").when(c >= 0.5, "medium").otherwise("low")
    pages = (
        F.when(F.coalesce(F.size(p), F.lit(0)) <= 0, "No pages").when(F.size(p) == 1, F.concat(F.lit("Page "), p[0].cast("string")))
        .when(F.size(p) <= 3, F.concat(F.lit("Pages "), F.array_join(p.cast("array<string>"), ", ")))
        .otherwise(F.concat(F.lit("Pages "), p[0].cast("string"), F.lit("-"), F.element_at(p, -1).cast("string"), F.lit(" ("), F.size(p).cast("string"), F.lit(" total)")))
    )
    percent = F.coalesce(F.concat(F.floor(c * 100 + 0.5).cast("string"), F.lit("%")), F.lit("N/A"))
    return views.entities(spark, d).select("table_name", "entity_no", "version", level.alias("level"), percent.alias("percent"), pages.alias("pages")).distinct()


def i58_cardinality(spark, d):
    """Cardinality marks as flags."""
    df = table(spark, d, "lineitem").select(F.element_at(F.array(*map(F.lit, ["1", "0..1", "0..*", "1..*"])), (F.col("l_orderkey") % 4 + 1).cast("int")).alias("mark"))
    return df.select("mark", F.col("mark").isin("1", "1..*").alias("required"), F.col("mark").endswith("*").alias("many")).groupBy("mark", "required", "many").agg(F.count("*").alias("n"))


def i21_json_part(spark, d):
    """JSON found in fenced and noisy text."""
    p = F.col("payload")
    noisy = [F.concat(F.lit("Here:\n```json\n"), p, F.lit("\n```")), F.concat(F.lit("So "), p, F.lit(" end")), p, F.lit("no json")]
    df = table(spark, d, "agent_files").select("file_no", "record_no", F.element_at(F.array(*noisy), (F.col("record_no") % 4 + 1).cast("int")).alias("t"))
    return df.select("file_no", "record_no", F.md5(N.json_part("t")).alias("part")).distinct()


def i22_repaired_json(spark, d):
    """JSON read after simple repairs, else null."""
    p = F.col("payload")
    broken = F.when(F.col("record_no") % 2 == 0, F.regexp_replace(p, r"\}$", ",}")).otherwise(p)
    return table(spark, d, "agent_files").select("file_no", "record_no", N.repaired_json(broken).isNotNull().alias("reads"), N.is_truncated_json(p).alias("truncated")).distinct()


def b18_unknown_values(spark, d):
    """Blank and placeholder values counted per field."""
    df = table(spark, d, "enrichment")
    parts = [df.select(F.lit(c).alias("field"), (F.coalesce(F.trim(c), F.lit("")) == "").alias("unknown")) for c in ("entity_name", "display_name", "code", "error")]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("field", "unknown").agg(F.count("*").alias("n"))


def b19_simple_ids(spark, d):
    """Ids that are no UUIDs and have a separator."""
    ids = views.entities(spark, d).select("id").unionByName(table(spark, d, "documents").select(F.concat(F.lit("123e4567-e89b-12d3-a456-"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("id")))
    return ids.select("id", N.is_simple_id("id").alias("simple")).distinct()


_T = lambda i: f"list_extract(['days', 'weeks', 'hours', 'min', 'other'], CAST(l_suppkey % 5 + 1 AS INT))"
_MONTH_NAMES = "['January','February','March','April','May','June','July','August','September','October','November','December']"
QUERIES |= {f.__name__: f for f in (i08_standard_id, i15_iso_date, i16_iso_duration, i19_path_access, i21_json_part, i22_repaired_json, i24_code_text, i25_complete_code, i47_visit_timing, i48_window_allowance, i54_confidence_label, i58_cardinality, b18_unknown_values, b19_simple_ids)}
_event = Q.any_of("lower(name)", T.EVENT_VISITS)
_own_day, _own_week = (r"try_cast(regexp_extract(name, '(?i)Day\s*(\d+)', 1) AS INT)", r"try_cast(regexp_extract(name, '(?i)Week\s*(\d+)', 1) AS INT)")
_fixed = " ".join(f"WHEN contains(lower(name), {Q.quoted(k)}) THEN {{}}" for k in T.FIXED_DAYS)
ORACLES |= {
    "i08_standard_id": f"WITH {Q.ENTITIES} SELECT DISTINCT table_name, id, replace(id, '-', '_') AS standard FROM entities",
    "i15_iso_date": f"""SELECT DISTINCT list_extract([strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%d %b %Y'),
      list_extract({_MONTH_NAMES}, month(o_orderdate)) || ' ' || day(o_orderdate) || ', ' || year(o_orderdate), strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%Y/%m/%d'), 'soon'],
      CAST(o_orderkey % 6 + 1 AS INT)) AS written, CASE WHEN o_orderkey % 6 = 5 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""",
    "i16_iso_duration": """WITH x AS (SELECT DISTINCT l_linenumber - 4 AS amount, list_extract(['days', 'weeks', 'hours', 'min', 'other'], CAST(l_suppkey % 5 + 1 AS INT)) AS unit FROM lineitem)
      SELECT amount, unit, CASE WHEN amount < 0 THEN '-' ELSE '' END || CASE unit WHEN 'weeks' THEN 'P' || abs(amount) || 'W' WHEN 'hours' THEN 'PT' || abs(amount) || 'H'
      WHEN 'min' THEN 'PT' || abs(amount) || 'M' ELSE 'P' || abs(amount) || 'D' END AS iso FROM x""",
    "i19_path_access": "SELECT DISTINCT entity_no, version, coalesce(CASE WHEN json_valid(data) THEN data->>'$.primaryReason.code.code' END, 'none') AS reason FROM advanced_entities",
    "i21_json_part": """SELECT DISTINCT file_no, record_no, CASE WHEN record_no % 4 = 3 THEN NULL WHEN record_no % 4 = 0 THEN md5(payload)
      WHEN instr(payload, '}') = 0 THEN NULL ELSE md5(left(payload, length(payload) - instr(reverse(payload), '}') + 1)) END AS part FROM agent_files""",
    "i24_code_text": "SELECT DISTINCT entity_no, version, coalesce(data.level.decode, data.level.code) AS level FROM objectives",
    "i25_complete_code": """SELECT DISTINCT coalesce(nullif(data.level.id, ''), 'code_' || data.level.code) AS id, data.level.code AS code, coalesce(data.level.codeSystem, 'urn:default') AS code_system,
      coalesce(data.level.codeSystemVersion, '1') AS code_system_version, coalesce(data.level.decode, data.level.code) AS decode, coalesce(data.level.instanceType, 'Code') AS instance_type
      FROM objectives WHERE data.level.code IS NOT NULL""",
    "i47_visit_timing": rf"""WITH x AS (SELECT DISTINCT data.name AS name, 'Week ' || (pos % 9) AS context, pos % 9 AS w FROM soa_vision WHERE data.name IS NOT NULL)
      SELECT name, context, CASE WHEN {_own_day} IS NOT NULL THEN {_own_day} WHEN {_own_week} IS NOT NULL THEN ({_own_week} - 1) * 7 + 1 WHEN {_event} THEN NULL
      {_fixed.format(*T.FIXED_DAYS.values())} ELSE (w - 1) * 7 + 1 END AS day,
      CASE WHEN {_own_day} IS NOT NULL THEN NULL WHEN {_own_week} IS NOT NULL THEN {_own_week} WHEN {_event} THEN NULL {_fixed.format(*["NULL"] * 4)} ELSE w END AS week,
      NOT {Q.any_of("lower(name)", T.OPTIONAL_WORDS)} AS required FROM x""",
    "i48_window_allowance": """WITH x AS (SELECT DISTINCT l_linenumber AS a, l_suppkey % 5 AS b, l_partkey % 6 AS k FROM lineitem)
      SELECT DISTINCT CASE k WHEN 0 THEN 'Day 7 (± ' || a || ' days)' WHEN 1 THEN 'within ' || a || ' days' WHEN 2 THEN '-' || a || ' to +' || b || ' days' WHEN 3 THEN 'window of ' || a || ' days'
      WHEN 4 THEN a || '-day window' ELSE 'none stated' END AS text, CASE WHEN k = 5 THEN 0 ELSE a END AS before, CASE WHEN k = 5 THEN 0 WHEN k = 2 THEN b ELSE a END AS after FROM x""",
    "i54_confidence_label": f"""WITH {Q.ENTITIES} SELECT DISTINCT table_name, entity_no, version,
      CASE WHEN confidence IS NULL THEN 'unknown' WHEN confidence >= 0.75 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' ELSE 'low' END AS level,
      coalesce(CAST(CAST(floor(confidence * 100 + 0.5) AS BIGINT) AS VARCHAR) || '%', 'N/A') AS percent,
      CASE WHEN coalesce(len(source_pages), 0) = 0 THEN 'No pages' WHEN len(source_pages) = 1 THEN 'Page ' || source_pages[1] WHEN len(source_pages) <= 3 THEN 'Pages ' || array_to_string(source_pages, ', ')
      ELSE 'Pages ' || source_pages[1] || '-' || source_pages[-1] || ' (' || len(source_pages) || ' total)' END AS pages FROM entities""",
    "i58_cardinality": """WITH x AS (SELECT list_extract(['1', '0..1', '0..*', '1..*'], CAST(l_orderkey % 4 + 1 AS INT)) AS mark FROM lineitem)
      SELECT mark, mark IN ('1', '1..*') AS required, ends_with(mark, '*') AS many, count(*) AS n FROM x GROUP BY ALL""",
    "b18_unknown_values": " UNION ALL ".join(f"SELECT '{c}' AS field, coalesce(trim({c}), '') = '' AS unknown, count(*) AS n FROM enrichment GROUP BY ALL" for c in ("entity_name", "display_name", "code", "error")),
    "b19_simple_ids": rf"""WITH {Q.ENTITIES}, x AS (SELECT id FROM entities UNION SELECT '123e4567-e89b-12d3-a456-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') FROM documents)
      SELECT id, NOT regexp_matches(regexp_replace(lower(id), '[{{}}-]', '', 'g'), '^[0-9a-f]{{32}}$') AND regexp_matches(id, '[_-]') AND length(id) < 50 AS simple FROM x""",
}
