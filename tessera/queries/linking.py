"""Queries of joins, entity resolution, sequences and top-k (C, E, F, G, H rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions import timing as T
from tessera.functions.keys import same_id
from tessera.operators import linking as K
from tessera.operators import metrics as M
from tessera.operators import orphans as O
from tessera.operators import provenance as P
from tessera.operators import resolve as R
from tessera.operators import sequence as W
from tessera.operators.live import live_entities
from tessera.plans.runtime import table
from tessera.queries import sqltext as Q
from tessera.queries.data import REFERENCES

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


SV = """WITH sv AS (SELECT * FROM (SELECT *, lower(replace(trim(id), '-', '_')) AS sid, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn
  FROM soa_vision) WHERE rn = 1 AND NOT is_deleted),
epochs AS (SELECT study_id, sid, pos, CAST(pos AS BIGINT) * 1000000000 + entity_no AS o, entity_no, data.name AS name, source_agent, confidence, source_pages FROM sv WHERE entity_type = 'epoch'),
encounters AS (SELECT study_id, sid, pos, CAST(pos AS BIGINT) * 1000000000 + entity_no AS o, entity_no, data.name AS name, nullif(lower(replace(trim(data.epochId), '-', '_')), '') AS epoch, confidence, source_pages FROM sv WHERE entity_type = 'encounter')
"""
OB = """WITH ob AS (SELECT * FROM (SELECT *, lower(replace(trim(id), '-', '_')) AS sid, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn
  FROM objectives) WHERE rn = 1 AND NOT is_deleted)
"""


def _current(spark, d, name, **payload):
    cols = {"pos": F.col("pos"), "entity_no": F.col("entity_no"), "entity_type": F.col("entity_type"), "name": F.col("data.name"), **payload}
    return live_entities(table(spark, d, name), cols)


#: pos repeats in some studies; the entity number settles ties
ORDER = "CAST(pos AS BIGINT) * 1000000000 + entity_no"


def _epochs(spark, d):
    return _current(spark, d, "soa_vision").where("entity_type = 'epoch'").drop("entity_type").withColumn("o", F.expr(ORDER))


def _encounters(spark, d):
    ref = F.nullif(same_id("data.epochId"), F.lit(""))
    return _current(spark, d, "soa_vision", epoch=ref).where("entity_type = 'encounter'").drop("entity_type").withColumn("o", F.expr(ORDER))


def _objectives(spark, d, kind=None, **payload):
    df = _current(spark, d, "objectives", **payload)
    return df.where(F.col("entity_type") == kind) if kind else df


_REFS = " UNION ALL ".join(
    f"SELECT DISTINCT '{r.field}' AS field, entity_no, study_id, lower(replace(trim(ref), '-', '_')) AS ref_id, '{r.target}' AS target, '{r.target_type}' AS target_type FROM (SELECT *, "
    + (f"unnest(data.{r.field})" if r.many else f"data.{r.field}")
    + f" AS ref FROM {'ob' if r.table == 'objectives' else 'sv'} WHERE entity_type = '{r.entity_type}') WHERE trim(ref) <> ''"
    for r in REFERENCES
)
_LIVE_TARGETS = """targets AS (SELECT 'objectives' AS target, entity_type AS target_type, study_id, sid AS ref_id FROM ob UNION ALL SELECT 'soa_vision', entity_type, study_id, sid FROM sv
  UNION ALL SELECT 'interventions', entity_type, study_id, sid FROM (SELECT *, lower(replace(trim(id), '-', '_')) AS sid, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_'))
  ORDER BY version DESC) AS rn FROM interventions) WHERE rn = 1 AND NOT is_deleted)"""


def _dangling(spark, d):
    tables = {t: table(spark, d, t) for t in ("objectives", "interventions", "soa_vision")}
    refs = O.reference_rows(tables, REFERENCES)
    targets = reduce(
        DataFrame.unionByName,
        [_current(spark, d, t).select(F.lit(t).alias("target"), F.col("entity_type").alias("target_type"), "study_id", F.col("sid").alias("ref_id")) for t in tables],
    )
    return refs.join(targets, ["target", "target_type", "study_id", "ref_id"], "left_anti")


_SVOB = SV + ", " + OB.replace("WITH ", "")


@query(_SVOB + f", refs AS ({_REFS}), {_LIVE_TARGETS} SELECT field, study_id, count(*) AS dangling FROM refs ANTI JOIN targets USING (target, target_type, study_id, ref_id) GROUP BY ALL")
def c04_reference_integrity(spark, d):
    """References without a live target, per field and study."""
    return _dangling(spark, d).groupBy("field", "study_id").agg(F.count("*").alias("dangling"))


@query(_SVOB + """, o AS (SELECT study_id, sid FROM ob WHERE entity_type = 'endpoint' EXCEPT SELECT study_id, lower(replace(trim(r), '-', '_')) FROM (SELECT study_id, unnest(data.endpointIds) AS r FROM ob))
  SELECT study_id, sid FROM (SELECT *, count(*) OVER (PARTITION BY study_id) AS n FROM o) WHERE n < 10""")
def c05_few_orphans(spark, d):
    """Endpoints without an objective, listed only where a study has fewer than ten."""
    obj = _objectives(spark, d, refs=F.col("data.endpointIds"))
    used = obj.select("study_id", F.explode("refs").alias("r")).select("study_id", same_id("r").alias("sid"))
    return K.small_group(K.missing_from(obj.where("entity_type = 'endpoint'").select("study_id", "sid"), used, ["study_id", "sid"]), ["study_id"], 10)


@query(SV + """SELECT 'encounter_without_epoch' AS issue, study_id, sid FROM encounters WHERE epoch IS NULL
  UNION ALL SELECT 'unknown_epoch', e.study_id, e.sid FROM encounters e ANTI JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch WHERE e.epoch IS NOT NULL
  UNION ALL SELECT 'empty_epoch', p.study_id, p.sid FROM epochs p ANTI JOIN encounters e ON p.study_id = e.study_id AND p.sid = e.epoch""")
def c06_promotion_checks(spark, d):
    """Several reference checks in one list of issues."""
    enc, ep = _encounters(spark, d), _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    parts = [
        ("encounter_without_epoch", enc.where("epoch IS NULL").select("study_id", "sid")),
        ("unknown_epoch", K.missing_from(enc.where("epoch IS NOT NULL"), ep, ["study_id", "epoch"]).select("study_id", "sid")),
        ("empty_epoch", K.missing_from(ep, enc.where("epoch IS NOT NULL"), ["study_id", "epoch"]).select("study_id", F.col("epoch").alias("sid"))),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("issue"), "study_id", "sid") for k, df in parts])


@query(SV + """SELECT 'duplicate_name' AS issue, study_id, lower(name) AS what, count(*) AS n FROM encounters WHERE name IS NOT NULL GROUP BY ALL HAVING n > 1
  UNION ALL SELECT 'bad_confidence', study_id, sid, 1 FROM encounters WHERE confidence < 0 OR confidence > 1
  UNION ALL SELECT 'no_pages', study_id, sid, 1 FROM encounters WHERE source_pages IS NULL OR len(source_pages) = 0""")
def c07_model_integrity(spark, d):
    """Duplicate names, values out of range and missing sources."""
    enc = _current(spark, d, "soa_vision", confidence=F.col("confidence"), pages=F.col("source_pages")).where("entity_type = 'encounter'")
    dup = enc.where("name IS NOT NULL").groupBy("study_id", F.lower("name").alias("what")).agg(F.count("*").alias("n")).where("n > 1")
    one = lambda k, c: enc.where(c).select(F.lit(k).alias("issue"), "study_id", F.col("sid").alias("what"), F.lit(1).cast("bigint").alias("n"))
    parts = [dup.select(F.lit("duplicate_name").alias("issue"), "study_id", "what", "n"), one("bad_confidence", "confidence < 0 OR confidence > 1"), one("no_pages", "pages IS NULL OR size(pages) = 0")]
    return reduce(DataFrame.unionByName, parts)


@query(OB + """, refs AS (SELECT entity_no, study_id, generate_subscripts(data.endpointIds, 1) AS p, unnest(data.endpointIds) AS r FROM ob WHERE entity_type = 'objective' AND data.endpointIds IS NOT NULL)
  SELECT r.entity_no, list(coalesce(e.sid || ': ' || coalesce(e.data.name, ''), 'stub: ' || coalesce(r.r, '')) ORDER BY r.p) AS endpoints
  FROM refs r LEFT JOIN (SELECT * FROM ob WHERE entity_type = 'endpoint') e ON e.study_id = r.study_id AND e.sid = lower(replace(trim(r.r), '-', '_')) GROUP BY ALL""")
def c08_nested_endpoints(spark, d):
    """Objectives with their endpoints in order; what can't be resolved is a stub."""
    obj = _objectives(spark, d, refs=F.col("data.endpointIds"))
    refs = obj.where("entity_type = 'objective'").select("entity_no", "study_id", F.posexplode("refs").alias("p", "r")).withColumn("sid", same_id("r"))
    ends = obj.where("entity_type = 'endpoint'").select("study_id", "sid", F.concat(F.col("sid"), F.lit(": "), F.coalesce("name", F.lit(""))).alias("found"))
    items = refs.join(ends, ["study_id", "sid"], "left").select("entity_no", "p", F.coalesce("found", F.concat(F.lit("stub: "), F.coalesce("r", F.lit("")))).alias("e"))
    return K.nest(items, ["entity_no"], "p", ["e"], "x").select("entity_no", F.transform("x", lambda x: x["e"]).alias("endpoints"))


_TERM = "t AS (SELECT DISTINCT lower(trim(entity_name)) AS term FROM enrichment WHERE trim(entity_name) <> '')"


@query(f"""WITH {_TERM}, c AS (SELECT code, lower(trim(name)) AS name FROM concepts WHERE name IS NOT NULL),
  e AS (SELECT term, min(code) AS code FROM t JOIN c ON term = name GROUP BY 1),
  s AS (SELECT term, min(code) AS code FROM t JOIN c ON contains(term, name) AND length(name) >= 3 GROUP BY 1),
  w AS (SELECT term, unnest(list_distinct(string_split(term, ' '))) AS w FROM t), v AS (SELECT code, name, unnest(list_distinct(string_split(name, ' '))) AS w FROM c),
  o AS (SELECT term, min(code) AS code FROM (SELECT term, code, name, count(*) AS n FROM w JOIN v USING (w) WHERE w.w <> '' GROUP BY ALL HAVING n * 2 >= least(len(list_distinct([x for x in string_split(term, ' ') if x <> ''])), len(list_distinct(string_split(name, ' '))))) GROUP BY 1)
  SELECT term, coalesce(e.code, s.code, o.code) AS code, CASE WHEN e.code IS NOT NULL THEN 1 WHEN s.code IS NOT NULL THEN 2 WHEN o.code IS NOT NULL THEN 3 END AS tier
  FROM t LEFT JOIN e USING (term) LEFT JOIN s USING (term) LEFT JOIN o USING (term)""")
def c09_tiered_terms(spark, d):
    """Terms to concepts: equal, containing, or at least half of the words shared."""
    t = table(spark, d, "enrichment").where("trim(entity_name) <> ''").select(F.lower(F.trim("entity_name")).alias("term")).distinct()
    c = table(spark, d, "concepts").where("name IS NOT NULL").select("code", F.lower(F.trim("name")).alias("name"))
    least = lambda df: df.groupBy("term").agg(F.min("code").alias("code"))
    exact = least(t.join(c, F.col("term") == F.col("name")))
    inside = least(K.containing(t, c, [], "term", "name").join(c, "name"))
    tokens = lambda col: F.array_distinct(F.filter(F.split(col, " "), lambda x: x != ""))
    shared = t.select("term", F.size(tokens("term")).alias("a"), F.explode(tokens("term")).alias("w")).join(c.select("code", "name", F.size(tokens("name")).alias("b"), F.explode(tokens("name")).alias("w")), "w")
    half = least(shared.groupBy("term", "code", "name", "a", "b").agg(F.count("*").alias("n")).where("n * 2 >= least(a, b)"))
    out = t
    for i, df in enumerate((exact, inside, half)):
        out = out.join(df.withColumnRenamed("code", f"c{i}"), "term", "left")
    return out.select("term", F.coalesce("c0", "c1", "c2").alias("code"), F.when(F.col("c0").isNotNull(), 1).when(F.col("c1").isNotNull(), 2).when(F.col("c2").isNotNull(), 3).alias("tier"))


@query("""WITH i AS (SELECT * FROM (SELECT *, lower(replace(trim(id), '-', '_')) AS sid, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn FROM interventions) WHERE rn = 1 AND NOT is_deleted),
  k AS (SELECT study_id, sid, CAST(pos AS BIGINT) * 1000000000 + entity_no AS o, lower(string_split(data.name, ' ')[1]) AS word FROM i WHERE length(string_split(data.name, ' ')[1]) >= 3), t AS (SELECT DISTINCT study_id, lower(data.text) AS text FROM narrative WHERE data.text IS NOT NULL)
  SELECT t.study_id, md5(text) AS text, arg_min(sid, pos * 1000000 + length(sid)) AS sid FROM t JOIN k ON k.study_id = t.study_id AND contains(text, word) GROUP BY ALL""".replace("arg_min(sid, pos * 1000000 + length(sid))", "min_by(sid, o)"))
def c10_first_word(spark, d):
    """Texts of a study to the first intervention whose first word they contain."""
    k = _current(spark, d, "interventions").select("study_id", "sid", F.expr(ORDER).alias("o"), F.lower(F.split("name", " ")[0]).alias("word"))
    t = table(spark, d, "narrative").where("data.text IS NOT NULL").select("study_id", F.lower("data.text").alias("text"))
    return K.containing(t, k, ["study_id"], "text", "word").join(k, ["study_id", "word"]).groupBy("study_id", F.md5("text").alias("text")).agg(F.min_by("sid", "o").alias("sid"))


_WORDS = ["screening", "baseline", "run-in", "treatment", "washout", "follow"]


@query(SV + f""", k AS (SELECT unnest([{', '.join(map(Q.quoted, _WORDS))}]) AS w), ek AS (SELECT study_id, w, min_by(sid, o) AS epoch, min(o) AS o FROM epochs JOIN k ON contains(lower(name), w) GROUP BY ALL)
  SELECT e.study_id, e.sid, min_by(ek.epoch, ek.o) AS matched FROM encounters e JOIN k ON contains(lower(e.name), w) JOIN ek ON ek.study_id = e.study_id AND ek.w = k.w GROUP BY ALL""")
def c11_epoch_by_keyword(spark, d):
    """Encounters to the first epoch that shares a keyword."""
    hits = lambda df: df.withColumn("w", F.explode(F.filter(F.array(*map(F.lit, _WORDS)), lambda w: F.lower("name").contains(w))))
    ek = hits(_epochs(spark, d)).groupBy("study_id", "w").agg(F.min_by("sid", "o").alias("epoch"), F.min("o").alias("epoch_pos"))
    enc = hits(_encounters(spark, d).drop("epoch")).select("study_id", "sid", "w")
    return enc.join(ek, ["study_id", "w"]).groupBy("study_id", "sid").agg(F.min_by("epoch", "epoch_pos").alias("matched"))


_FORM = "lower(" + Q.one_space(r"regexp_replace(regexp_replace({}, '[¹²³⁰-⁹₀-₉*†‡§¶ᵃ-ᵛ]', '', 'g'), '[-_]', ' ', 'g')") + ")"


@query(SV + f""", n AS (SELECT study_id, {_FORM.format('name')} AS f, min_by(sid, o) AS sid FROM epochs GROUP BY ALL)
  SELECT e.study_id, e.sid, coalesce(p.sid, n.sid) AS match_id, CASE WHEN p.sid IS NOT NULL THEN 1 WHEN n.sid IS NOT NULL THEN 2 END AS tier FROM encounters e
  LEFT JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch LEFT JOIN n ON n.study_id = e.study_id AND n.f = {_FORM.format('e.name')}""")
def c12_stale_epoch_ids(spark, d):
    """Epoch references by id, else by comparable name."""
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("target_id"), "o", F.col("name").alias("n"))
    enc = _encounters(spark, d).select("study_id", "sid", "epoch", "name")
    tiers = [(F.col("epoch"), F.col("target_id")), (N.epoch_form("name"), N.epoch_form("n"))]
    return K.tiered_match(enc, ep, ["study_id"], tiers, "o", "target_id").select("study_id", "sid", "match_id", "tier")


_DAY = r"try_cast(regexp_extract(lower({0}), 'day\s*(-?\d+)', 1) AS INT)"
_DAY2 = r"coalesce(try_cast(regexp_extract(lower({0}), 'day\s*(-?\d+)', 1) AS INT), try_cast(regexp_extract(lower({0}), '\bd(-?\d+)', 1) AS INT))"
_WEEK = r"coalesce(try_cast(regexp_extract(lower({0}), 'week\s*(\d+)', 1) AS INT), try_cast(regexp_extract(lower({0}), 'wk\s*(\d+)', 1) AS INT))"


@query(SV + f""", d AS (SELECT study_id, {_DAY2.format('name')} AS k, min_by(sid, o) AS sid FROM encounters WHERE k IS NOT NULL GROUP BY ALL), w AS (SELECT study_id, {_WEEK.format('name')} AS k, min_by(sid, o) AS sid FROM encounters WHERE k IS NOT NULL GROUP BY ALL),
  x AS (SELECT study_id, lower(name) AS k, min_by(sid, o) AS sid FROM epochs GROUP BY ALL)
  SELECT e.study_id, e.sid, coalesce(x.sid, d.sid, w.sid) AS match_id, CASE WHEN x.sid IS NOT NULL THEN 1 WHEN d.sid IS NOT NULL THEN 2 WHEN w.sid IS NOT NULL THEN 3 END AS tier FROM encounters e
  LEFT JOIN x ON x.study_id = e.study_id AND x.k = lower(e.name) LEFT JOIN d ON d.study_id = e.study_id AND d.k = {_DAY2.format('e.name')} LEFT JOIN w ON w.study_id = e.study_id AND w.k = {_WEEK.format('e.name')}""")
def c13_timing_links(spark, d):
    """Instances to timings by name, else day, else week; also the shape of c17, c23 and c24."""
    enc = _encounters(spark, d).select("study_id", "sid", "name", "o")
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("target_id"), "o", F.lower("name").alias("n"), F.lit(None).cast("int").alias("d"), F.lit(None).cast("int").alias("w"))
    own = enc.select("study_id", F.col("sid").alias("target_id"), "o", F.lit(None).cast("string").alias("n"), T.name_timing("name")["day"].alias("d"), T.name_timing("name")["week"].alias("w"))
    t = T.name_timing("name")
    tiers = [(F.lower("name"), F.col("n")), (t["day"], F.col("d")), (t["week"], F.col("w"))]
    return K.tiered_match(enc.drop("o"), ep.unionByName(own), ["study_id"], tiers, "o", "target_id").select("study_id", "sid", "match_id", "tier")


@query("""WITH x AS (SELECT DISTINCT study_id, entity_no, version, id, data.childIds AS c FROM narrative WHERE data.childIds IS NOT NULL), m AS (SELECT DISTINCT study_id, id FROM narrative)
  SELECT x.study_id, x.entity_no, x.version, list(CASE WHEN m.id IS NOT NULL THEN md5(x.study_id || '/' || m.id) ELSE u.v END ORDER BY u.p) AS children
  FROM x, LATERAL (SELECT unnest(c) AS v, generate_subscripts(c, 1) AS p) u LEFT JOIN m ON m.study_id = x.study_id AND m.id = u.v GROUP BY ALL""")
def c14_id_remap(spark, d):
    """Lists of ids with every known id replaced, order kept."""
    n = table(spark, d, "narrative")
    rows = n.where("data.childIds IS NOT NULL AND size(data.childIds) > 0").select("study_id", "entity_no", "version", F.col("data.childIds").alias("children")).distinct()
    mapping = K.id_map(n, "id", ["study_id"])
    return K.remap_array(rows, mapping, ["study_id"], ["study_id", "entity_no", "version"], "children")


@query(OB + """, k AS (SELECT DISTINCT study_id, sid || '|' || lower(replace(trim(r), '-', '_')) AS key FROM (SELECT study_id, sid, unnest(data.endpointIds) AS r FROM ob WHERE entity_type = 'objective') WHERE trim(r) <> '')
  SELECT k.study_id, key, coalesce(md5(a.study_id || '/' || a.sid), split_part(key, '|', 1)) || '|' || coalesce(md5(b.study_id || '/' || b.sid), split_part(key, '|', 2)) AS new_key FROM k
  LEFT JOIN ob a ON a.study_id = k.study_id AND a.sid = split_part(key, '|', 1) LEFT JOIN ob b ON b.study_id = k.study_id AND b.sid = split_part(key, '|', 2)""")
def c15_key_remap(spark, d):
    """Cell keys 'a|b' with both halves replaced where known."""
    obj = _objectives(spark, d, refs=F.col("data.endpointIds"))
    keys = obj.where("entity_type = 'objective'").select("study_id", "sid", F.explode("refs").alias("r")).where("trim(r) <> ''")
    keys = keys.select("study_id", F.concat("sid", F.lit("|"), same_id("r")).alias("key")).distinct()
    parts = keys.withColumns({"a": F.split_part("key", F.lit("|"), F.lit(1)), "b": F.split_part("key", F.lit("|"), F.lit(2))})
    mapping = K.id_map(obj.select("study_id", F.col("sid").alias("id")), "id", ["study_id"])
    return K.remap(parts, mapping, ["study_id"], ["a", "b"]).select("study_id", "key", F.concat("a", F.lit("|"), "b").alias("new_key"))


@query(OB + """, m AS (SELECT study_id, sid, first_value(sid) OVER (PARTITION BY study_id, data.name ORDER BY pos, sid) AS keep FROM ob WHERE entity_type = 'endpoint' AND data.name IS NOT NULL)
  SELECT o.entity_no, list(DISTINCT coalesce(m.keep, o.r) ORDER BY coalesce(m.keep, o.r)) AS refs FROM (SELECT entity_no, study_id, lower(replace(trim(x), '-', '_')) AS r FROM (SELECT *, unnest(data.endpointIds) AS x FROM ob WHERE entity_type = 'objective') WHERE x IS NOT NULL) o
  LEFT JOIN m ON m.study_id = o.study_id AND m.sid = o.r GROUP BY ALL""")
def c18_merged_ids(spark, d):
    """References after endpoints of one name became one."""
    obj = _objectives(spark, d, refs=F.col("data.endpointIds"))
    keep = F.first_value("sid").over(Window.partitionBy("study_id", "name").orderBy("pos", "sid"))
    merged = obj.where("entity_type = 'endpoint' AND name IS NOT NULL").select("study_id", F.col("sid").alias("r"), keep.alias("keep"))
    refs = obj.where("entity_type = 'objective'").select("entity_no", "study_id", F.explode("refs").alias("x")).where("x IS NOT NULL").withColumn("r", same_id("x"))
    return refs.join(merged, ["study_id", "r"], "left").groupBy("entity_no").agg(F.array_sort(F.collect_set(F.coalesce("keep", "r"))).alias("refs"))


@query(SV + """SELECT study_id, sid, 'stored' AS origin FROM epochs UNION ALL SELECT DISTINCT e.study_id, e.epoch, 'injected' FROM encounters e ANTI JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch WHERE e.epoch IS NOT NULL""")
def c19_inject_missing(spark, d):
    """Epochs with those that encounters name but nobody stored."""
    ep = _epochs(spark, d).select("study_id", "sid")
    named = _encounters(spark, d).where("epoch IS NOT NULL").select("study_id", F.col("epoch").alias("sid")).distinct()
    return ep.withColumn("origin", F.lit("stored")).unionByName(K.missing_from(named, ep, ["study_id", "sid"]).withColumn("origin", F.lit("injected")))


@query("""WITH n AS (SELECT lower(trim(name)) AS k, min(code) AS code FROM concepts GROUP BY 1), s AS (SELECT lower(trim(x)) AS k, min(code) AS code FROM (SELECT code, unnest(synonyms) AS x FROM concepts) GROUP BY 1)
  SELECT result_no, coalesce(e.code, n.code, s.code) AS code FROM (SELECT DISTINCT result_no, code, entity_name FROM enrichment) e LEFT JOIN n ON n.k = lower(trim(entity_name)) LEFT JOIN s ON s.k = lower(trim(entity_name))""")
def c21_backfill_codes(spark, d):
    """Codes filled in by name, else by synonym, only where there was none (with c20)."""
    c = table(spark, d, "concepts")
    by = lambda col: lambda df: df.groupBy(F.lower(F.trim(col)).alias("k")).agg(F.min("code").alias("c"))
    names = by("name")(c).withColumnRenamed("c", "c1")
    syn = by("x")(c.select("code", F.explode("synonyms").alias("x"))).withColumnRenamed("c", "c2")
    rows = table(spark, d, "enrichment").select("result_no", "code", "entity_name").distinct().withColumn("k", F.lower(F.trim("entity_name")))
    return rows.join(names, "k", "left").join(syn, "k", "left").select("result_no", F.coalesce("code", "c1", "c2").alias("code"))


@query(SV + r"""SELECT study_id, sid, a AS first_day, b AS last_day, abs(b - a) + 1 AS expected FROM (SELECT *, try_cast(regexp_extract(name, '(?i)Day\s+(-?\d+)\s*(?:to|through|-)\s*(-?\d+)', 1) AS INT) AS a,
  try_cast(regexp_extract(name, '(?i)Day\s+(-?\d+)\s*(?:to|through|-)\s*(-?\d+)', 2) AS INT) AS b FROM (SELECT study_id, sid, 'Day ' || pos || ' to ' || (pos + pos % 5) AS name FROM encounters))""")
def c22_bindings(spark, d):
    """Expected number of instances of day ranges."""
    p = r"(?i)Day\s+(-?\d+)\s*(?:to|through|-)\s*(-?\d+)"
    enc = _encounters(spark, d).select("study_id", "sid", F.concat(F.lit("Day "), F.col("pos").cast("string"), F.lit(" to "), (F.col("pos") + F.col("pos") % 5).cast("string")).alias("n"))
    a, b = T.first_int(F.col("n"), p, 1), T.first_int(F.col("n"), p, 2)
    return enc.select("study_id", "sid", a.alias("first_day"), b.alias("last_day"), (F.abs(b - a) + 1).alias("expected"))


@query(SV + f""", day AS (SELECT study_id, {_DAY2.format('name')} AS day, min_by(sid, o) AS enc FROM encounters WHERE day IS NOT NULL GROUP BY ALL), r AS (SELECT study_id, sid, 1 AS a, pos AS z, CASE WHEN pos % 2 = 0 THEN 7 ELSE 1 END AS step FROM epochs WHERE pos >= 1)
  SELECT r.study_id, r.sid, day.day, day.enc FROM (SELECT study_id, sid, unnest(generate_series(a, z * 5, step)) AS day FROM r) r JOIN day ON day.study_id = r.study_id AND day.day = r.day""")
def c25_repetitions(spark, d):
    """Repetitions laid out by day and bound to the first encounter of that day (with c28)."""
    enc = _encounters(spark, d)
    days = K.first_wins(enc.select("study_id", T.name_timing("name")["day"].alias("day"), "sid", "o").where("day IS NOT NULL"), ["study_id", "day"], "sid", "o").withColumnRenamed("sid", "enc")
    rep = _epochs(spark, d).where("pos >= 1").select("study_id", "sid", F.explode(F.sequence(F.lit(1), F.col("pos") * 5, F.when(F.col("pos") % 2 == 0, 7).otherwise(1))).alias("day"))
    return rep.join(days, ["study_id", "day"]).select("study_id", "sid", "day", "enc")


_ALIASES = "[upper(name), replace(upper(name), ' ', '_'), 'PERIOD_' || pos]"


@query(SV + f"""SELECT study_id, alias, max_by(sid, o) AS sid FROM (SELECT study_id, sid, o, unnest(list_distinct({_ALIASES})) AS alias FROM epochs WHERE name IS NOT NULL) GROUP BY ALL""")
def c27_alias_map(spark, d):
    """Every way to name an epoch, the last one of a name counts (used by c26)."""
    al = F.array_distinct(F.array(F.upper("name"), F.replace(F.upper("name"), F.lit(" "), F.lit("_")), F.concat(F.lit("PERIOD_"), F.col("pos").cast("string"))))
    return K.last_wins(_epochs(spark, d).where("name IS NOT NULL").select("study_id", "sid", "o", F.explode(al).alias("alias")), ["study_id", "alias"], "sid", "o")


@query(SV + f""", al AS (SELECT study_id, alias, max_by(sid, o) AS sid FROM (SELECT study_id, sid, o, unnest(list_distinct({_ALIASES})) AS alias FROM epochs WHERE name IS NOT NULL) GROUP BY ALL)
  SELECT e.study_id, list(coalesce(al.sid, 'unresolved') ORDER BY e.pos, e.sid) AS steps FROM encounters e LEFT JOIN al ON al.study_id = e.study_id AND al.alias = upper(e.name) GROUP BY ALL""")
def c26_traversal(spark, d):
    """Steps of a sequence resolved through the alias map, in order."""
    al = c27_alias_map(spark, d).withColumnRenamed("sid", "target")
    enc = _encounters(spark, d).select("study_id", "sid", "pos", F.upper("name").alias("alias"))
    rows = enc.join(al, ["study_id", "alias"], "left").withColumn("o", F.struct("pos", "sid")).withColumn("t", F.coalesce("target", F.lit("unresolved")))
    return K.nest(rows, ["study_id"], "o", ["t"], "x").select("study_id", F.transform("x", lambda x: x["t"]).alias("steps"))


@query(SV + """, a AS (SELECT *, row_number() OVER (PARTITION BY study_id ORDER BY pos, sid) - 1 AS i FROM encounters) SELECT study_id, sid, 'encounter/' || i AS by_index FROM a""")
def c30_by_index(spark, d):
    """Records named by type and index where ids are lost."""
    i = F.row_number().over(Window.partitionBy("study_id").orderBy("pos", "sid")) - 1
    return _encounters(spark, d).select("study_id", "sid", F.concat(F.lit("encounter/"), i.cast("string")).alias("by_index"))


@query("""WITH c AS (SELECT study_id, entity_id, entity_type, 1 AS rank, result_no FROM enrichment WHERE source = 'manual' UNION ALL SELECT study_id, entity_id, entity_type, 2, result_no FROM enrichment WHERE source <> 'manual')
  SELECT study_id, entity_id, entity_type, result_no FROM (SELECT *, row_number() OVER (PARTITION BY study_id, entity_id, entity_type ORDER BY rank, result_no DESC) AS rn FROM c) WHERE rn = 1""")
def c31_cell_links(spark, d):
    """One link a cell: the first kind of source before the second, the last of a kind."""
    df = table(spark, d, "enrichment").withColumn("rank", F.when(F.col("source") == "manual", 1).when(F.col("source").isNotNull(), 2)).where("rank IS NOT NULL")
    return M.rank_first(df, ["study_id", "entity_id", "entity_type"], [F.col("rank"), F.desc("result_no")]).select("study_id", "entity_id", "entity_type", "result_no")


@query(SV + "SELECT e.study_id, p.sid AS epoch, min_by(e.sid, e.o) AS first_encounter, count(*) AS n FROM encounters e JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch GROUP BY ALL")
def c32_first_valid(spark, d):
    """The first encounter of each existing epoch."""
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    return _encounters(spark, d).join(ep, ["study_id", "epoch"]).groupBy("study_id", "epoch").agg(F.min_by("sid", "o").alias("first_encounter"), F.count("*").alias("n"))


@query(SV + """SELECT 'missing' AS issue, study_id, epoch AS id, count(*) AS n FROM encounters e ANTI JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch WHERE epoch IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'duplicate', study_id, sid, count(*) FROM (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid FROM soa_vision) GROUP BY ALL HAVING count(*) > 1""")
def c33_graph_checks(spark, d):
    """Edges without an end and ids that occur more than once."""
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    miss = K.missing_from(_encounters(spark, d).where("epoch IS NOT NULL"), ep, ["study_id", "epoch"]).groupBy("study_id", F.col("epoch").alias("id")).agg(F.count("*").alias("n"))
    dup = table(spark, d, "soa_vision").groupBy("study_id", same_id("id").alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    return miss.select(F.lit("missing").alias("issue"), "study_id", "id", "n").unionByName(dup.select(F.lit("duplicate").alias("issue"), "study_id", "id", "n"))


_SUPER = f"list_extract([{', '.join(map(Q.quoted, [*N.PLAIN, *N.SYMBOL_WORDS.values()]))}], instr({Q.quoted(N.SUPERSCRIPTS + ''.join(N.SYMBOL_WORDS))}, c))"


@query(SV + f"""SELECT study_id, label, list_sort(list(DISTINCT sid)) AS ids FROM (SELECT study_id, sid, unnest([{_SUPER} for c in string_split(name, '') if c <> '' and contains({Q.quoted(N.SUPERSCRIPTS + ''.join(N.SYMBOL_WORDS))}, c)]) AS label
  FROM (SELECT study_id, sid, name FROM epochs UNION ALL SELECT study_id, sid, name FROM encounters) WHERE name IS NOT NULL) GROUP BY ALL""")
def c34_footnote_labels(spark, d):
    """Footnote labels and the records that carry them."""
    rows = _current(spark, d, "soa_vision").where("name IS NOT NULL").select("study_id", "sid", F.explode(N.split_superscripts("name")["refs"]).alias("label"))
    return rows.groupBy("study_id", "label").agg(F.array_sort(F.collect_set("sid")).alias("ids"))


@query(OB + r""", p AS (SELECT study_id, sid, pos, trim(regexp_replace(lower(data.populationSummary), '\(.*?\)', '', 'g')) AS k FROM ob WHERE entity_type = 'estimand' AND data.populationSummary IS NOT NULL),
  f AS (SELECT study_id, k, min(pos * 1000000 + length(sid)) AS seen, min(struct_pack(pos := pos, sid := sid)) AS o FROM p GROUP BY ALL)
  SELECT p.study_id, p.sid, dense_rank() OVER (PARTITION BY p.study_id ORDER BY f.o) AS population FROM p JOIN f USING (study_id, k)""")
def c36_populations(spark, d):
    """Analysis populations numbered in the order in which their text is first seen."""
    k = F.trim(F.regexp_replace(F.lower("summary"), r"\(.*?\)", ""))
    p = _objectives(spark, d, "estimand", summary=F.col("data.populationSummary")).where("summary IS NOT NULL").withColumn("k", k)
    first = F.min(F.struct("pos", "sid")).over(Window.partitionBy("study_id", "k"))
    return p.withColumn("o", first).select("study_id", "sid", F.dense_rank().over(Window.partitionBy("study_id").orderBy("o")).alias("population"))


@query(SV + r"""SELECT study_id, sid, label, CASE WHEN label IN ('a', 'b', 'c', 'i', '5') THEN label WHEN label IN ('1', 'l') THEN 'i' WHEN label = 's' THEN '5' ELSE label END AS corrected FROM
  (SELECT study_id, sid, regexp_extract(lower(name), '[\[(]([a-z0-9])[\])]', 1) AS label FROM encounters) WHERE label <> ''""")
def c38_ocr_labels(spark, d):
    """Footnote labels of visit names that can't be, read as what looks like them, in a fixed order."""
    valid, confused = ["a", "b", "c", "i", "5"], {"1": ["i", "l"], "l": ["1", "i"], "i": ["1", "l"], "0": ["o"], "o": ["0"], "5": ["s"], "s": ["5"]}
    label = F.regexp_extract(F.lower("name"), r"[\[(]([a-z0-9])[\])]", 1)
    fix = F.when(label.isin(valid), label)
    for bad, goods in confused.items():
        for g in goods:
            if g in valid:
                fix = fix.when(label == bad, g)
    return _encounters(spark, d).select("study_id", "sid", label.alias("label"), fix.otherwise(label).alias("corrected")).where("label <> ''")


# --- entity resolution ------------------------------------------------------------

_SRC = "list_extract(['execution_agent', 'procedures_agent', 'soa_vision_agent', 'soa_text_agent', 'other'], CAST(l_linenumber % 5 + 1 AS INT))"
_PRI = "CASE l_linenumber % 5 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END"
_CON = f"""WITH c AS (SELECT l_partkey AS key, {_SRC} AS source, {_PRI} AS priority, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_discount = 0 THEN '' ELSE l_returnflag || l_suppkey END AS name,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_linestatus END AS status, CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INT) END AS lo, CAST(l_quantity AS INT) + 5 AS hi, l_shipdate AS at FROM lineitem)
"""


def _contributions(spark, d):
    li = table(spark, d, "lineitem")
    names = ["execution_agent", "procedures_agent", "soa_vision_agent", "soa_text_agent", "other"]
    q = F.col("l_quantity").cast("int")
    return li.select(
        F.col("l_partkey").alias("key"), F.element_at(F.array(*map(F.lit, names)), F.col("l_linenumber") % 5 + 1).alias("source"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.when(F.col("l_discount") == 0, "").otherwise(F.concat("l_returnflag", F.col("l_suppkey").cast("string"))).alias("name"), F.when(F.col("l_tax") != 0, F.col("l_linestatus")).alias("status"),
        F.when(F.col("l_quantity") > 25, q).alias("lo"), (q + 5).alias("hi"), F.col("l_shipdate").alias("at"),
    ).withColumn("priority", R.source_priority("source"))


@query(_CON + "SELECT source, priority, count(*) AS n FROM c GROUP BY ALL")
def e05_source_priority(spark, d):
    """Ranks of sources (with e08)."""
    return _contributions(spark, d).groupBy("source", "priority").agg(F.count("*").alias("n"))


@query(_CON + """SELECT key, max_by(name, struct_pack(p := priority, o := -pos)) FILTER (name <> '') AS name, max_by(status, struct_pack(p := priority, o := -pos)) FILTER (status IS NOT NULL) AS status,
  max_by(pos, struct_pack(p := priority, o := -pos)) AS best_pos, count(*) AS n, list_sort(list(DISTINCT source)) AS sources, bool_or(status = 'F') AS any_f FROM c GROUP BY ALL""")
def e04_merge_by_priority(spark, d):
    """Records merged by source priority, blanks filled from lower ones (with e10, e11, e12, e15)."""
    return R.merge_by_priority(
        _contributions(spark, d), ["key"], ["name", "status"], best_pos=F.max_by("pos", F.struct("priority", -F.col("pos"))), n=F.count("*"),
        sources=F.array_sort(F.collect_set("source")), any_f=F.bool_or(F.col("status") == "F"),
    )


@query(_CON + """SELECT key, max_by(lo, struct_pack(p := priority, o := -pos)) FILTER (lo IS NOT NULL) AS lo, max_by(hi, struct_pack(p := priority, o := -pos)) FILTER (lo IS NOT NULL) AS hi, bool_and(status = 'F') AS required FROM c GROUP BY ALL""")
def e14_window_pairs(spark, d):
    """Fields that only come together, from the first source that has them."""
    out = R.merge_by_priority(_contributions(spark, d), ["key"], pairs={"w": ["lo", "hi"]}, required=F.bool_and(F.col("status") == "F"))
    return out.select("key", "w.lo", "w.hi", "required")


@query(SV + f""", x AS (SELECT study_id, {Q.one_space(r"regexp_replace(lower(name), '[^a-z0-9\s\-]', '', 'g')")} AS k, sid, o, epoch FROM encounters WHERE name IS NOT NULL)
  SELECT study_id, k, count(*) AS n, min_by(sid, o) AS sid, min_by(epoch, o) FILTER (epoch IS NOT NULL) AS epoch FROM x GROUP BY ALL""")
def e17_exact_names(spark, d):
    """Encounters of one normalised name merged (with e16, e18)."""
    x = _encounters(spark, d).where("name IS NOT NULL").withColumn("k", N.matching_form("name"))
    return x.groupBy("study_id", "k").agg(F.count("*").alias("n"), F.min_by("sid", "o").alias("sid"), F.min_by("epoch", F.when(F.col("epoch").isNotNull(), F.col("o"))).alias("epoch"))


@query(SV + """, s AS (SELECT study_id, list(sid ORDER BY pos, sid) AS seq FROM epochs GROUP BY 1), t AS (SELECT study_id, unnest(seq) AS sid, generate_subscripts(seq, 1) AS ord FROM s)
  SELECT e.study_id, e.sid, t.ord IS NOT NULL AS main, CAST(t.ord - 1 AS INT) AS ord FROM epochs e LEFT JOIN t USING (study_id, sid)""")
def e13_traversal_contribution(spark, d):
    """Epochs in a sequence are main ones and take its order."""
    ep = _epochs(spark, d)
    seq = K.nest(ep.withColumn("o", F.struct("pos", "sid")), ["study_id"], "o", ["sid"], "seq").select("study_id", F.posexplode("seq").alias("ord", "x")).select("study_id", "ord", F.col("x.sid").alias("sid"))
    return ep.select("study_id", "sid").join(seq, ["study_id", "sid"], "left").select("study_id", "sid", F.col("ord").isNotNull().alias("main"), "ord")


_TWO = """WITH l AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, data.name AS v, CAST(round(confidence * 10000) AS BIGINT) AS vb FROM (SELECT *, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn FROM narrative) WHERE rn = 1 AND NOT is_deleted),
  r AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, data.name AS t, CAST(round(confidence * 10000) AS BIGINT) AS tb FROM (SELECT *, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn FROM narrative_mirror) WHERE rn = 1 AND NOT is_deleted),
  k AS (SELECT study_id AS o, sid AS n, v, t, vb, tb FROM l FULL JOIN r USING (study_id, sid) WHERE v IS NOT NULL OR t IS NOT NULL)"""
_CELL = _TWO + """, q AS (SELECT *, regexp_replace(v, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS x, regexp_replace(t, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS y, coalesce(vb, 5000) AS vc, coalesce(tb, 5000) AS tc, v IS NOT NULL AND t IS NOT NULL AS both_there,
  x IN ({ticks}) AS xt, y IN ({ticks}) AS yt, x IN ({empty}) AS xe, y IN ({empty}) AS ye, try_cast(x AS DOUBLE) AS xn, try_cast(y AS DOUBLE) AS yn FROM k),
  a AS (SELECT *, both_there AND ((xt AND yt) OR (xe AND ye) OR coalesce(xn = yn, false) OR lower(x) = lower(y)) AS agree FROM q)
  SELECT o, n, CASE WHEN NOT both_there THEN coalesce(v, t) WHEN agree OR (xt AND ye) THEN v WHEN yt AND xe THEN t WHEN xn IS NOT NULL AND yn IS NOT NULL AND vc < tc THEN t ELSE v END AS resolved,
  CAST(CASE WHEN both_there AND agree THEN least(10000, greatest(vc, tc) + 1000) WHEN both_there THEN greatest(0, greatest(vc, tc) - 1500) END AS BIGINT) AS confidence_bp,
  CASE WHEN NOT both_there THEN 'single' WHEN agree THEN 'agree' WHEN (xt AND ye) OR (yt AND xe) THEN 'tick_present_over_absent' WHEN xn IS NOT NULL AND yn IS NOT NULL THEN 'numeric_higher_confidence' ELSE 'source_priority' END AS strategy FROM a""".format(
    ticks=", ".join(map(Q.quoted, R.TICKS)), empty=", ".join(map(Q.quoted, R.EMPTY_CELLS))
)


@query(_CELL)
def e19_reconcile_cells(spark, d):
    """The names that the two narrative systems give one record, resolved as cells of two readers (with e20, e21)."""
    return R.reconcile_cells(two_readers(spark, d)).select("o", "n", "resolved", "confidence_bp", "strategy")


def two_readers(spark, d):
    """(o, n, vision_value, text_value, vision_bp, text_bp): a record's name in both narrative systems."""
    side = lambda t, r: live_entities(table(spark, d, t), {f"{r}_value": F.col("data.name"), f"{r}_bp": F.round(F.col("confidence") * 10000).cast("bigint")})
    both = side("narrative", "vision").join(side("narrative_mirror", "text"), ["study_id", "sid"], "full")
    return both.where("vision_value IS NOT NULL OR text_value IS NOT NULL").withColumnsRenamed({"study_id": "o", "sid": "n"})


@query(_CON + """, x AS (SELECT key, source, max_by(name, struct_pack(p := pos, n := name)) AS value FROM c WHERE name <> '' GROUP BY ALL) SELECT key, 'name' AS field, count(DISTINCT source) AS sources, min(value) = max(value) AS agrees,
  max_by(value, struct_pack(p := CASE source WHEN 'execution_agent' THEN 5 WHEN 'procedures_agent' THEN 4 WHEN 'soa_vision_agent' THEN 3 WHEN 'soa_text_agent' THEN 2 ELSE 1 END, s := source)) AS resolved,
  max_by(source, struct_pack(p := CASE source WHEN 'execution_agent' THEN 5 WHEN 'procedures_agent' THEN 4 WHEN 'soa_vision_agent' THEN 3 WHEN 'soa_text_agent' THEN 2 ELSE 1 END, s := source)) AS winner FROM x GROUP BY key HAVING count(DISTINCT source) > 1""")
def e22_field_conflicts(spark, d):
    """Fields on which sources agree or not, and whose value counts."""
    x = _contributions(spark, d).where("name <> ''").groupBy("key", "source").agg(F.max_by("name", F.struct("pos", "name")).alias("value")).withColumn("field", F.lit("name"))
    return R.field_conflicts(x, ["key"])


@query("SELECT study_id, sid, version, pos FROM (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, version, pos, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY pos, version) AS rn FROM soa_vision WHERE entity_type = 'epoch') WHERE rn = 1")
def e23_keep_first(spark, d):
    """Epochs of one id: the first stays."""
    df = table(spark, d, "soa_vision").where("entity_type = 'epoch'").withColumn("sid", same_id("id"))
    return R.keep_first(df, ["study_id", "sid"], ["pos", "version"]).select("study_id", "sid", "version", "pos")


@query(SV + rf""", x AS (SELECT study_id, sid, o, CASE WHEN regexp_matches(lower(name), 'end\s*of\s*study|\be\.?o\.?s\b') THEN 'eos' WHEN regexp_matches(lower(name), 'early\s*termination|\be\.?t\b') THEN 'et' WHEN regexp_matches(lower(name), 'screen(?:ing)?') THEN 'screening' WHEN regexp_matches(lower(name), 'base\s*line') THEN 'baseline' ELSE lower(name) END AS k,
  coalesce({_DAY2.format('name')}, 0) AS day FROM encounters WHERE name IS NOT NULL)
  SELECT study_id, k, CASE WHEN k IN ('eos', 'et') THEN max_by(sid, struct_pack(d := day, p := -o)) WHEN k IN ('screening', 'baseline') THEN min_by(sid, struct_pack(d := CASE WHEN day = 0 THEN 999 ELSE day END, p := o)) ELSE min_by(sid, o) END AS sid FROM x GROUP BY study_id, k""")
def e24_collapse_windows(spark, d):
    """Visits of one meaning collapse to the most plausible."""
    low = F.lower("name")
    k = F.when(low.rlike(r"end\s*of\s*study|\be\.?o\.?s\b"), "eos").when(low.rlike(r"early\s*termination|\be\.?t\b"), "et").when(low.rlike("screen(?:ing)?"), "screening").when(low.rlike(r"base\s*line"), "baseline").otherwise(low)
    x = _encounters(spark, d).where("name IS NOT NULL").select("study_id", "sid", "o", k.alias("k"), F.coalesce(T.name_timing("name")["day"], F.lit(0)).alias("day"))
    late, early = F.max_by("sid", F.struct("day", -F.col("o"))), F.min_by("sid", F.struct(F.when(F.col("day") == 0, 999).otherwise(F.col("day")), "o"))
    return x.groupBy("study_id", "k").agg(late.alias("late"), early.alias("early"), F.min_by("sid", "o").alias("first")).select(
        "study_id", "k", F.when(F.col("k").isin("eos", "et"), F.col("late")).when(F.col("k").isin("screening", "baseline"), F.col("early")).otherwise(F.col("first")).alias("sid")
    )


@query("""WITH x AS (SELECT lower(trim(data.name)) AS k, entity_no, version, (data.role IS NOT NULL)::INT + (data.description IS NOT NULL)::INT + (model IS NOT NULL)::INT AS score FROM interventions WHERE length(trim(data.name)) >= 3)
  SELECT k, entity_no, version, score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, entity_no, version) AS rn FROM x) WHERE rn = 1""")
def e27_most_complete(spark, d):
    """Of records with one name the most complete, the earliest on a tie."""
    there = lambda c: F.col(c).isNotNull().cast("int")
    x = table(spark, d, "interventions").where("length(trim(data.name)) >= 3").select(F.lower(F.trim("data.name")).alias("k"), "entity_no", "version", (there("data.role") + there("data.description") + there("model")).alias("score"))
    return R.keep_first(x, ["k"], [F.desc("score"), "entity_no", "version"])


@query("SELECT agent_id, record_id, pages, file_no FROM (SELECT agent_id, record_id, left(payload, 50) AS pages, file_no, row_number() OVER (PARTITION BY agent_id, record_id, left(payload, 50) ORDER BY file_no, record_no) AS rn FROM (SELECT DISTINCT agent_id, record_id, payload, file_no, record_no FROM agent_files)) WHERE rn = 1")
def e28_first_per_prefix(spark, d):
    """The first record per key and beginning of its text (with e29, e30, e31)."""
    df = table(spark, d, "agent_files").select("agent_id", "record_id", "payload", "file_no", "record_no").distinct().withColumn("pages", F.substring("payload", 1, 50))
    return R.keep_first(df, ["agent_id", "record_id", "pages"], ["file_no", "record_no"]).select("agent_id", "record_id", "pages", "file_no")


@query("""WITH a AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, max(confidence) AS x, max(data.name) AS n FROM narrative GROUP BY ALL), b AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, max(confidence) AS x, max(data.name) AS n FROM narrative_mirror GROUP BY ALL)
  SELECT coalesce(a.study_id, b.study_id) AS study_id, coalesce(a.sid, b.sid) AS sid, coalesce(nullif(b.x, 0), a.x) AS x, coalesce(nullif(b.n, ''), a.n) AS n FROM a FULL JOIN b ON a.study_id = b.study_id AND a.sid = b.sid""")
def e32_overlay(spark, d):
    """Fields of one source over those of another where it has them (with e33, e41)."""
    s = lambda t: table(spark, d, t).groupBy("study_id", same_id("id").alias("sid")).agg(F.max("confidence").alias("x"), F.max("data.name").alias("n"))
    return R.overlay(s("narrative"), s("narrative_mirror"), ["study_id", "sid"], ["x", "n"])


@query(SV + """SELECT study_id, sid, CASE WHEN row_number() OVER w > 1 THEN name || ' (' || row_number() OVER w || ')' ELSE name END AS name FROM encounters WHERE name IS NOT NULL WINDOW w AS (PARTITION BY study_id, name ORDER BY pos, sid)""")
def e34_unique_names(spark, d):
    """Repeated names numbered (with m23, m32)."""
    return R.numbered_names(_encounters(spark, d).where("name IS NOT NULL"), ["study_id"], "name", ["pos", "sid"]).select("study_id", "sid", "name")


@query(OB + """, i AS (SELECT study_id, sid, data.treatment AS t, data.populationSummary AS p, unnest(data.intercurrentEvents) AS e FROM ob WHERE data.intercurrentEvents IS NOT NULL)
  SELECT study_id, sid, e.id AS ice, CASE WHEN count(*) OVER (PARTITION BY study_id, e.name) > 1 AND coalesce(nullif(trim(t), ''), nullif(trim(p), '')) IS NOT NULL THEN e.name || ' (' || CASE WHEN trim(coalesce(t, '')) <> '' THEN t ELSE p END || ')' ELSE e.name END AS name FROM i WHERE e.name IS NOT NULL""")
def e35_names_with_context(spark, d):
    """Names used more than once with their context."""
    obj = _objectives(spark, d, t=F.col("data.treatment"), p=F.col("data.populationSummary"), ice=F.col("data.intercurrentEvents"))
    rows = obj.select("study_id", "sid", "t", "p", F.explode("ice").alias("e")).select("study_id", "sid", "t", "p", F.col("e.id").alias("ice"), F.col("e.name").alias("name")).where("name IS NOT NULL")
    return R.names_with_context(rows, ["study_id"], "name", ["t", "p"]).select("study_id", "sid", "ice", "name")


@query("""WITH c AS (SELECT entity_no, version, data.level.codeSystem AS s, data.level.codeSystemVersion AS v, data.level.code AS code, data.level.decode AS decode FROM objectives WHERE data.level.code IS NOT NULL)
  SELECT DISTINCT entity_no, version, code, CASE WHEN code = 'Q90011' AND s = 'urn:invented:levels' AND v = '2024-03' THEN 'seeded' ELSE first_value(decode) OVER (PARTITION BY s, v, code ORDER BY entity_no, version, decode) END AS decode FROM c""")
def e36_one_decode(spark, d):
    """One decode per code, the first seen; a seeded one before all."""
    lv = "data.level."
    c = table(spark, d, "objectives").where("data.level.code IS NOT NULL").select("entity_no", "version", F.col(lv + "codeSystem").alias("s"), F.col(lv + "codeSystemVersion").alias("v"), F.col(lv + "code").alias("code"), F.col(lv + "decode").alias("decode"))
    seed = spark.createDataFrame([("urn:invented:levels", "2024-03", "Q90011", "seeded")], "s string, v string, code string, decode string")
    return R.one_decode(c, ["s", "v", "code"], ["entity_no", "version", "decode"], seed).select("entity_no", "version", "code", "decode").distinct()


@query("SELECT study_id, entity_id, CASE WHEN min(source) = max(source) THEN min(source) WHEN min(source) IS NOT NULL THEN 'both' END AS source FROM enrichment GROUP BY ALL")
def e37_tag_sources(spark, d):
    """One tag per record: its source, or both (with e38, e39)."""
    return P.tag_sources(table(spark, d, "enrichment"), ["study_id", "entity_id"])


@query("""WITH i AS (SELECT DISTINCT study_id, entity_id FROM enrichment WHERE coalesce(confidence, 0) >= 0.9) SELECT t.study_id, t.entity_id, i.entity_id IS NOT NULL AS doubtful FROM (SELECT DISTINCT study_id, entity_id FROM enrichment) t LEFT JOIN i USING (study_id, entity_id)""")
def e40_screen(spark, d):
    """Ticks split by issues of high confidence."""
    e = table(spark, d, "enrichment")
    good, bad = R.screen_ticks(e.select("study_id", "entity_id").distinct(), e.select("study_id", "entity_id", "confidence"), ["study_id", "entity_id"], 0.9)
    return good.withColumn("doubtful", F.lit(False)).unionByName(bad.withColumn("doubtful", F.lit(True)))


# --- sequences --------------------------------------------------------------------


@query("""WITH RECURSIVE n AS (SELECT DISTINCT l_partkey AS node FROM lineitem), e AS (SELECT node, node // 3 AS dep FROM n WHERE node > 0 AND node // 3 IN (SELECT node FROM n)),
  w AS (SELECT node, 0 AS wave FROM n WHERE node NOT IN (SELECT node FROM e) UNION ALL SELECT e.node, w.wave + 1 FROM e JOIN w ON w.node = e.dep) SELECT node, max(wave) AS wave FROM w GROUP BY 1""")
def f01_waves(spark, d):
    """Levels of a dependency graph, each part after the one of a third of its number (with f02)."""
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node"))
    return W.waves(li, li.where("node > 0").select("node", F.expr("node div 3").alias("depends_on")))


@query(SV + """SELECT study_id, sid, row_number() OVER (PARTITION BY study_id ORDER BY CASE WHEN contains(lower(name), 'treatment') THEN 0 ELSE 1 END, coalesce(pos, 999), sid) AS ord, first_value(sid) OVER (PARTITION BY study_id ORDER BY CASE WHEN contains(lower(name), 'treatment') THEN 0 ELSE 1 END, coalesce(pos, 999), sid) AS first_main FROM epochs""")
def f03_epoch_order(spark, d):
    """Main epochs first, the unordered last."""
    w = Window.partitionBy("study_id").orderBy(F.when(F.lower("name").contains("treatment"), 0).otherwise(1), F.coalesce("pos", F.lit(999)), "sid")
    return _epochs(spark, d).select("study_id", "sid", F.row_number().over(w).alias("ord"), F.first_value("sid").over(w).alias("first_main"))


@query(SV + f"SELECT study_id, sid, row_number() OVER (PARTITION BY study_id ORDER BY coalesce({_DAY2.format('name')}, 9999), coalesce({_WEEK.format('name')}, 9999), coalesce(epoch, 'zzz'), coalesce(name, ''), sid) AS ord FROM encounters")
def f04_encounter_order(spark, d):
    """Encounters by day, week, group and name, the unknown last (with f05)."""
    t = T.name_timing("name")
    w = Window.partitionBy("study_id").orderBy(F.coalesce(t["day"], F.lit(9999)), F.coalesce(t["week"], F.lit(9999)), F.coalesce("epoch", F.lit("zzz")), F.coalesce("name", F.lit("")), "sid")
    return _encounters(spark, d).select("study_id", "sid", F.row_number().over(w).alias("ord"))


@query(SV + "SELECT study_id, sid, lag(sid) OVER w AS previous_id, lead(sid) OVER w AS next_id FROM encounters WINDOW w AS (PARTITION BY study_id, epoch ORDER BY pos, sid)")
def f06_links(spark, d):
    """Previous and next encounter within each epoch (with f07, f08, m24)."""
    return W.neighbours(_encounters(spark, d), ["study_id", "epoch"], ["pos", "sid"], "sid").select("study_id", "sid", "previous_id", "next_id")


@query(SV + "SELECT study_id, sid, CAST(coalesce(sum(greatest(120, length(coalesce(name, '')) * 8)) OVER (PARTITION BY study_id ORDER BY pos, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM epochs")
def f09_offsets(spark, d):
    """Where each epoch starts when they are laid side by side."""
    width = F.greatest(F.lit(120), F.length(F.coalesce("name", F.lit(""))) * 8)
    return W.offsets(_epochs(spark, d), ["study_id"], ["pos", "sid"], width).select("study_id", "sid", "offset")


_PAGES = "p AS (SELECT DISTINCT study_id, unnest(source_pages) AS page FROM narrative)"


@query(f"""WITH {_PAGES}, g AS (SELECT *, page - lag(page) OVER (PARTITION BY study_id ORDER BY page) > 3 AS jump, lag(page) OVER (PARTITION BY study_id ORDER BY page) IS NULL AS first FROM p),
  r AS (SELECT *, sum((jump OR first)::INT) OVER (PARTITION BY study_id ORDER BY page) AS run FROM g), i AS (SELECT study_id, run, min(page) AS a, max(page) AS b FROM r GROUP BY ALL)
  SELECT DISTINCT study_id, unnest(generate_series(greatest(0, a - 1), least(119, b + 1))) AS page FROM i WHERE greatest(0, a - 1) <= least(119, b + 1)""")
def f10_expanded_pages(spark, d):
    """Pages with small gaps filled and runs widened."""
    p = table(spark, d, "narrative").select("study_id", F.explode("source_pages").alias("page"))
    return W.expanded_pages(p, ["study_id"], "page", F.lit(120))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
  m AS (SELECT doc_id, line_no, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM l WHERE regexp_matches(line, '^\s*(?:[-*•]|[a-z]\)|\d+[.)]|\|)') )
  SELECT doc_id, CAST(min(line_no) AS INT) AS start, CAST(max(line_no) AS INT) AS "end", count(*) AS n, CAST(least(9000, 5000 + 1000 * count(*)) AS BIGINT) AS confidence_bp FROM m GROUP BY doc_id, run HAVING count(*) >= 3""")
def f11_regions(spark, d):
    """Runs of at least three lines of a list or table."""
    docs = table(spark, d, "documents")
    return W.line_regions(W.lines_of(docs, ["doc_id"]), ["doc_id"], F.col("line").rlike(r"^\s*(?:[-*•]|[a-z]\)|\d+[.)]|\|)"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, CAST(line_no AS INT) AS line_no, md5(concat_ws(chr(10), line, lead(line, 1) OVER w, lead(line, 2) OVER w)) AS context FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)""")
def f12_line_context(spark, d):
    """Lines with the two after them."""
    return W.line_context(W.lines_of(table(spark, d, "documents"), ["doc_id"]), ["doc_id"]).select("doc_id", "line_no", F.md5("context").alias("context"))


@query(r"""SELECT doc_id, CASE WHEN m <> '' THEN substr(text, CAST(greatest(1, p - 100) AS INT), CAST(p - greatest(1, p - 100) + length(m) + 100 AS INT)) END AS context FROM (SELECT doc_id, text, regexp_extract(text, 'Week \d+', 0) AS m, instr(text, regexp_extract(text, 'Week \d+', 0)) AS p FROM documents WHERE text IS NOT NULL) WHERE m <> ''""")
def f13_match_context(spark, d):
    """The first mention of a week with what is around it."""
    return table(spark, d, "documents").select("doc_id", W.match_context("text", r"Week \d+").alias("context")).where("context IS NOT NULL")


@query(SV + "SELECT study_id, sid, row_number() OVER (PARTITION BY study_id ORDER BY CASE WHEN pos % 3 = 0 THEN pos ELSE 999999 END, pos, sid) AS ord FROM encounters")
def f14_overlay_order(spark, d):
    """A given order for some, the rest after them as they were."""
    w = Window.partitionBy("study_id").orderBy(F.when(F.col("pos") % 3 == 0, F.col("pos")).otherwise(999999), "pos", "sid")
    return _encounters(spark, d).select("study_id", "sid", F.row_number().over(w).alias("ord"))


@query("SELECT study_id, sid, kind, lag(sid) OVER w AS previous_id, lead(sid) OVER w AS next_id FROM (SELECT study_id, entity_no AS sid, entity_type AS kind, pos, version FROM narrative WHERE trim(data.text) <> '') WINDOW w AS (PARTITION BY study_id, kind ORDER BY pos, sid, version)")
def f15_linked_lists(spark, d):
    """Items chained within their kind, blank ones left out."""
    rows = table(spark, d, "narrative").where("trim(data.text) <> ''").select("study_id", F.col("entity_no").alias("sid"), F.col("entity_type").alias("kind"), "pos", "version")
    return W.neighbours(rows, ["study_id", "kind"], ["pos", "sid", "version"], "sid").select("study_id", "sid", "kind", "previous_id", "next_id")


# --- top-k ------------------------------------------------------------------------

_KEYS = ["schedule of activities", "schedule", "visit schedule", "study procedures", "follow-up"]


@query(rf"""WITH s AS (SELECT doc_id, study_id, {' + '.join(f"4 * contains(lower(text), {Q.quoted(k)})::INT" for k in _KEYS)} + len(regexp_extract_all(lower(text), '\b(?:week|day|visit)\s*[-+]?\d+')) AS score FROM documents WHERE text IS NOT NULL)
  SELECT study_id, doc_id, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY score DESC, doc_id) <= 5""")
def g01_top_pages(spark, d):
    """The five texts of each study that look most like a schedule; scores in halves (with g06, j28, j29)."""
    low = F.lower("text")
    score = reduce(lambda a, b: a + b, [low.contains(k).cast("int") * 4 for k in _KEYS]) + F.regexp_count(low, F.lit(r"\b(?:week|day|visit)\s*[-+]?\d+"))
    s = table(spark, d, "documents").where("text IS NOT NULL").select("study_id", "doc_id", score.alias("score")).where("score > 0")
    return M.rank_first(s, ["study_id"], [F.desc("score"), F.col("doc_id")], 5)


@query(f"""WITH {_TERM}, c AS (SELECT code, lower(trim(name)) AS name FROM concepts), w AS (SELECT term, unnest(list_distinct(string_split(term, ' '))) AS w FROM t), v AS (SELECT code, name, unnest(list_distinct(string_split(name, ' '))) AS w FROM c),
  p AS (SELECT term, code, name, count(*) AS n FROM w JOIN v USING (w) WHERE w.w <> '' GROUP BY ALL),
  s AS (SELECT term, code, CASE WHEN term = name THEN 10000 ELSE CAST(floor(5000 * n / len(list_distinct([x for x in list_concat(string_split(term, ' '), string_split(name, ' ')) if x <> '']))) AS BIGINT) END AS score FROM p)
  SELECT term, code, score FROM s QUALIFY row_number() OVER (PARTITION BY term ORDER BY score DESC, code) <= 3""")
def g02_ranked_concepts(spark, d):
    """The three best concepts of each term by shared words (with g03, i27, l01)."""
    t = table(spark, d, "enrichment").where("trim(entity_name) <> ''").select(F.lower(F.trim("entity_name")).alias("term")).distinct()
    c = table(spark, d, "concepts").select("code", F.lower(F.trim("name")).alias("name"))
    tokens = lambda col: F.array_distinct(F.filter(F.split(col, " "), lambda x: x != ""))
    p = t.select("term", F.size(tokens("term")).alias("a"), F.explode(tokens("term")).alias("w")).join(c.select("code", "name", F.size(tokens("name")).alias("b"), F.explode(tokens("name")).alias("w")), "w")
    s = p.groupBy("term", "code", "name", "a", "b").agg(F.count("*").alias("n")).select("term", "code", F.when(F.col("term") == F.col("name"), 10000).otherwise(F.expr("5000 * n div (a + b - n)")).cast("bigint").alias("score"))
    return M.rank_first(s, ["term"], [F.desc("score"), F.col("code")], 3)


@query(r"""WITH s AS (SELECT DISTINCT doc_id, len(regexp_extract_all(lower(text), 'daily|every')) AS recurring, len(regexp_extract_all(lower(text), 'window|within')) AS "window", len(regexp_extract_all(lower(text), 'cycle')) AS episode FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, CASE WHEN greatest(recurring, "window", episode) = 0 THEN 'single' WHEN recurring >= "window" AND recurring >= episode THEN 'recurring' WHEN "window" >= episode THEN 'window' ELSE 'episode' END AS kind FROM s""")
def g04_classify(spark, d):
    """The kind with most mentions, ties in a fixed order (with j25)."""
    low = F.lower("text")
    n = {k: F.regexp_count(low, F.lit(p)) for k, p in (("recurring", "daily|every"), ("window", "window|within"), ("episode", "cycle"))}
    best = F.greatest(*n.values())
    kind = reduce(lambda w, kc: w.when(kc[1] == best, kc[0]), n.items(), F.when(best == 0, "single"))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", kind.alias("kind")).distinct()


@query("SELECT event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 10 END, ts, event_id) AS ord FROM events")
def g05_priority_order(spark, d):
    """Messages of each receiver by priority and time (with g07)."""
    p = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(10)
    return table(spark, d, "events").select("event_id", "event_type", F.row_number().over(Window.partitionBy("user_id").orderBy(p, "ts", "event_id")).alias("ord"))


@query(r"SELECT doc_id, array_to_string(regexp_extract_all(text, 'Week \d+')[1:3], '|') AS mentions FROM documents WHERE regexp_matches(text, 'Week \d+')")
def g10_first_mentions(spark, d):
    """The first three mentions of a pattern."""
    return table(spark, d, "documents").where(F.col("text").rlike(r"Week \d+")).select("doc_id", F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"Week \d+"), F.lit(0)), 1, 3), "|").alias("mentions"))


@query("""WITH RECURSIVE n AS (SELECT DISTINCT data.name AS name FROM soa_vision WHERE data.name IS NOT NULL), f AS (SELECT name, 0 AS i, 0 AS p, 0 AS q FROM n
  UNION ALL SELECT name, i + 1, p + instr(substr(lower(name), p + 1), substr('tr1', i + 1, 1)), CASE WHEN i = 0 THEN instr(lower(name), 't') ELSE q END FROM f WHERE i < 3 AND instr(substr(lower(name), p + 1), substr('tr1', i + 1, 1)) > 0)
  SELECT name, CAST(q * 10 + (p - q) AS INT) AS score FROM f WHERE i = 3""")
def g12_subsequence(spark, d):
    """Names that hold the letters of a search in order; first place x 10 plus spread."""
    names = table(spark, d, "soa_vision").select(F.col("data.name").alias("name")).where("name IS NOT NULL").distinct()
    low, at, first = F.lower("name"), F.lit(0), None
    for ch in "tr1":
        step = F.locate(ch, low, 1) if first is None else F.instr(F.substr(low, at + 1), ch)
        at = F.when(step > 0, at + step)
        first = at if first is None else first
    return names.select("name", (first * 10 + (at - first)).alias("score")).where("score IS NOT NULL")


@query("""WITH t AS (SELECT doc_id, 1 AS rank FROM documents WHERE contains(lower(left(text, 200)), 'schedule')), h AS (SELECT doc_id, 2 AS rank FROM documents WHERE contains(lower(text), 'schedule')), toc AS (SELECT doc_id FROM documents WHERE regexp_matches(text, '\\.{5,}'))
  SELECT doc_id, min(rank) AS rank FROM (SELECT * FROM t UNION ALL SELECT * FROM h) ANTI JOIN toc USING (doc_id) GROUP BY 1""".replace("\\\\", "\\"))
def h01_candidates(spark, d):
    """Candidates of two finders, the better one's rank, without tables of contents (with h02)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    t = docs.where(F.lower(F.substring("text", 1, 200)).contains("schedule")).select("doc_id", F.lit(1).alias("rank"))
    h = docs.where(F.lower("text").contains("schedule")).select("doc_id", F.lit(2).alias("rank"))
    return K.missing_from(t.unionByName(h), docs.where(F.col("text").rlike(r"\.{5,}")), ["doc_id"]).groupBy("doc_id").agg(F.min("rank").alias("rank"))
