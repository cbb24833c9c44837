"""Further queries: single operators that the composed ones are made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import mappings as MP
from tessera.functions import names as N
from tessera.functions import patterns as P
from tessera.functions import timing as T
from tessera.functions.keys import same_id
from tessera.operators import extract as X
from tessera.operators import fuzzy as Z
from tessera.operators import linking as K
from tessera.operators import metrics as M
from tessera.operators import provenance as PV
from tessera.operators import resolve as R
from tessera.operators import sequence as W
from tessera.operators import store as S
from tessera.operators import validate as V
from tessera.plans.runtime import materialize, table
from tessera.queries import sqltext as Q
from tessera.queries import views
from tessera.queries.extraction import DOCS, FIELDS, _docs
from tessera.queries.linking import _CON, _TWO, OB, SV, _contributions, _current, _encounters, _epochs, _objectives, two_readers
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


E, L = f"WITH {Q.ENTITIES} ", f"WITH {Q.ENTITIES}, {Q.LIVE} "
PICK = "list_extract([{}], CAST({} AS INT))"


def _pick(values, index):
    return F.element_at(F.array(*map(F.lit, values)), index.cast("int"))


# --- sources, filters -------------------------------------------------------------


@query(r"SELECT doc_id, len(regexp_split_to_array(text, '\n\s*\n')) AS pages FROM documents WHERE text IS NOT NULL")
def a02_page_count(spark, d):
    """Pages of each text."""
    return D.pages_of(table(spark, d, "documents").where("text IS NOT NULL"), "doc_id").groupBy("doc_id").agg(F.count("*").alias("pages"))


@query(L + r", p AS (SELECT unnest(regexp_split_to_array(text, '\n\s*\n')) FROM documents WHERE text IS NOT NULL) SELECT entity_type, count(*) AS n FROM live GROUP BY ALL UNION ALL SELECT 'page', count(*) FROM p")
def a05_page_entities(spark, d):
    """Pages stored beside the other entities."""
    pages = D.pages_of(table(spark, d, "documents").where("text IS NOT NULL"), "doc_id").select(F.lit("page").alias("entity_type"))
    return views.live(spark, d).select("entity_type").unionByName(pages, allowMissingColumns=True).groupBy("entity_type").agg(F.count("*").alias("n"))


@query(OB + """SELECT study_id, 'objective' AS kind, sid, coalesce(data.text, data.name, data.description) AS label FROM ob WHERE entity_type = 'objective' UNION ALL SELECT study_id, 'endpoint', sid, coalesce(data.text, data.name) FROM ob WHERE entity_type = 'endpoint'
  UNION ALL SELECT study_id, 'event', sid, coalesce(e.name, e.text) FROM (SELECT study_id, sid, unnest(data.intercurrentEvents) AS e FROM ob) WHERE e IS NOT NULL""")
def a17_flat_exports(spark, d):
    """A nested study as flat rows, labels under alternate names."""
    o = _objectives(spark, d, text=F.col("data.text"), description=F.col("data.description"), ice=F.col("data.intercurrentEvents"))
    row = lambda df, kind, *c: df.select("study_id", F.lit(kind).alias("kind"), "sid", F.coalesce(*c).alias("label"))
    ice = o.select("study_id", "sid", F.explode("ice").alias("e")).where("e IS NOT NULL")
    return row(o.where("entity_type = 'objective'"), "objective", "text", "name", "description").unionByName(row(o.where("entity_type = 'endpoint'"), "endpoint", "text", "name")).unionByName(row(ice, "event", "e.name", "e.text"))


@query("SELECT result_no, c.name FROM (SELECT DISTINCT result_no, code FROM enrichment) e JOIN concepts c ON c.code = trim(e.code)")
def a23_code_lookup(spark, d):
    """Concepts by code."""
    e = table(spark, d, "enrichment").select("result_no", F.trim("code").alias("code")).distinct()
    return e.join(table(spark, d, "concepts").select("code", "name"), "code").select("result_no", "name")


@query(r"""SELECT DISTINCT entity_no, version, length(trim(data.name)) >= 3 AND NOT regexp_matches(lower(trim(data.name)), '^(for|the|and|or|to|of|in|on|at|by|with|from|as|is|are|was|were)\s|^(day|week|month)\s*(and|or)?|^\d+\s*(mg|ml|mcg|g|kg)\s*(and|or)?$')
  AND (coalesce(data.role, '') <> '' OR coalesce(data.description, '') <> '') AS valid FROM interventions WHERE data.name IS NOT NULL""")
def b11_valid_regimens(spark, d):
    """Records that can be regimens: a real name and at least one detail."""
    x = F.lower(F.trim("data.name"))
    bad = x.rlike(r"^(for|the|and|or|to|of|in|on|at|by|with|from|as|is|are|was|were)\s|^(day|week|month)\s*(and|or)?|^\d+\s*(mg|ml|mcg|g|kg)\s*(and|or)?$")
    some = (F.coalesce("data.role", F.lit("")) != "") | (F.coalesce("data.description", F.lit("")) != "")
    return table(spark, d, "interventions").where("data.name IS NOT NULL").select("entity_no", "version", ((F.length(x) >= 3) & ~bad & some).alias("valid")).distinct()


@query(SV + f"SELECT study_id, sid, NOT {Q.any_of('lower(name)', T.OPTIONAL_WORDS)} AS required FROM encounters WHERE name IS NOT NULL")
def b15_required_visits(spark, d):
    """Visits that aren't called optional."""
    return _encounters(spark, d).where("name IS NOT NULL").select("study_id", "sid", T.is_required_visit("name").alias("required"))


@query("SELECT file_no, record_no, entity_type || '.' || record_id AS loc FROM (SELECT DISTINCT file_no, record_no, entity_type, record_id FROM agent_files) WHERE NOT (entity_type = 'endpoint' AND contains(record_id, 'obj')) AND NOT (entity_type = 'objective' AND contains(record_id, 'ep'))")
def b20_right_branch(spark, d):
    """Locations that don't name another branch of the union they are in."""
    r = table(spark, d, "agent_files").select("file_no", "record_no", "entity_type", "record_id").distinct()
    wrong = ((F.col("entity_type") == "endpoint") & F.col("record_id").contains("obj")) | ((F.col("entity_type") == "objective") & F.col("record_id").contains("ep"))
    return r.where(~wrong).select("file_no", "record_no", F.concat("entity_type", F.lit("."), "record_id").alias("loc"))


# --- links ------------------------------------------------------------------------


@query(SV + ", k AS (SELECT study_id, lower(trim(name)) AS k, min_by(epoch, o) AS g FROM encounters WHERE epoch IS NOT NULL GROUP BY ALL) SELECT e.study_id, e.sid, coalesce(e.epoch, k.g) AS epoch FROM encounters e LEFT JOIN k ON k.study_id = e.study_id AND k.k = lower(trim(e.name))")
def c20_group_by_name(spark, d):
    """A missing group taken from a record of the same name."""
    enc = _encounters(spark, d).withColumn("k", F.lower(F.trim("name")))
    known = enc.where("epoch IS NOT NULL").groupBy("study_id", "k").agg(F.min_by("epoch", "o").alias("g"))
    return enc.join(known, ["study_id", "k"], "left").select("study_id", "sid", F.coalesce("epoch", "g").alias("epoch"))


@query(SV + """, x AS (SELECT e.study_id, e.sid, min_by(p.sid, p.o) AS t FROM encounters e JOIN epochs p ON p.study_id = e.study_id AND lower(p.name) = lower(e.name) GROUP BY ALL),
  c AS (SELECT e.study_id, e.sid, min_by(p.sid, p.o) AS t FROM encounters e JOIN epochs p ON p.study_id = e.study_id AND contains(lower(e.name), lower(p.name)) AND length(p.name) >= 3 GROUP BY ALL)
  SELECT e.study_id, e.sid, coalesce(x.t, c.t) AS target, CASE WHEN e.pos < 0 THEN '-' ELSE '' END || 'P' || abs(e.pos) || 'D' AS before FROM encounters e LEFT JOIN x USING (study_id, sid) LEFT JOIN c USING (study_id, sid)""")
def c23_window_links(spark, d):
    """Visits to windows by equal, else contained name, with ISO bounds (c24's tiers are c13's)."""
    enc, ep = _encounters(spark, d), _epochs(spark, d)
    e = enc.select("study_id", "sid", "pos", F.lower("name").alias("n"))
    p = ep.select("study_id", F.col("sid").alias("t"), "o", F.lower("name").alias("k"))
    exact = p.groupBy("study_id", "k").agg(F.min_by("t", "o").alias("t1")).withColumnRenamed("k", "n")
    inside = K.containing(e, p, ["study_id"], "n", "k").join(p, ["study_id", "k"]).groupBy("study_id", "n").agg(F.min_by("t", "o").alias("t2"))
    return e.join(exact, ["study_id", "n"], "left").join(inside, ["study_id", "n"], "left").select("study_id", "sid", F.coalesce("t1", "t2").alias("target"), T.iso_duration(F.col("pos")).alias("before"))


_D = r"coalesce(try_cast(regexp_extract(lower(name), 'day\s*(-?\d+)', 1) AS INT), try_cast(regexp_extract(lower(name), '\bd(-?\d+)', 1) AS INT))"


@query(SV + f"SELECT study_id, {_D} AS day, min_by(sid, o) AS sid FROM encounters WHERE {_D} IS NOT NULL GROUP BY ALL")
def c28_day_map(spark, d):
    """The first visit of each day."""
    return K.first_wins(_encounters(spark, d).select("study_id", T.name_timing("name")["day"].alias("day"), "sid", "o").where("day IS NOT NULL"), ["study_id", "day"], "sid", "o")


@query()
def c29_fuzzy_first_hit(spark, d):
    """Visits to the first epoch of their study with a similar name, at 0.8 and never with another number at its end."""
    e = _encounters(spark, d).where("name IS NOT NULL").select("study_id", F.col("entity_no").alias("visit"), "name")
    p = _epochs(spark, d).where("name IS NOT NULL").select("study_id", F.col("entity_no").alias("epoch"), "o", "name")
    return Z.first_similar(e, p, ["study_id"], 0.8)


_ORGS = {"org_1": "protocol", "org_2": "registry", "org_3": "analysis_plan"}


@query("SELECT source, count(*) AS n, CASE " + " ".join(f"WHEN contains(source, '{v}') OR contains('{v}', source) THEN '{k}'" for k, v in _ORGS.items()) + " WHEN contains(source, 'site') THEN 'org_site' ELSE 'org_unknown' END AS org FROM documents WHERE source IS NOT NULL GROUP BY ALL")
def c35_scope_organisation(spark, d):
    """Organisations by containment either way, then by constants."""
    s = F.col("source")
    org = reduce(lambda w, kv: w.when(s.contains(kv[1]) | F.lit(kv[1]).contains(s), kv[0]), _ORGS.items(), F.when(F.lit(False), "")).when(s.contains("site"), "org_site").otherwise("org_unknown")
    return table(spark, d, "documents").where("source IS NOT NULL").groupBy("source", org.alias("org")).agg(F.count("*").alias("n"))


@query(OB + """, p AS (SELECT study_id, sid FROM ob WHERE entity_type = 'analysis_population'), f AS (SELECT study_id, min(sid) AS first FROM p GROUP BY 1)
  SELECT o.study_id, o.sid, coalesce(p.sid, f.first) AS population FROM ob o LEFT JOIN p ON p.study_id = o.study_id AND p.sid = lower(replace(trim(o.data.analysisPopulationId), '-', '_')) LEFT JOIN f ON f.study_id = o.study_id WHERE o.entity_type = 'estimand'""")
def c37_analysis_links(spark, d):
    """Estimands to their population, else to the first of the study."""
    o = _objectives(spark, d, ref=same_id("data.analysisPopulationId"))
    p = o.where("entity_type = 'analysis_population'").select("study_id", F.col("sid").alias("ref"), F.col("sid").alias("p"))
    f = p.groupBy("study_id").agg(F.min("p").alias("first"))
    return o.where("entity_type = 'estimand'").join(p, ["study_id", "ref"], "left").join(f, "study_id", "left").select("study_id", "sid", F.coalesce("p", "first").alias("population"))


# --- metrics ----------------------------------------------------------------------


def _tree(spark, d):
    """Nodes of the JSON in advanced entities by type: (entity_no, version, objects, tagged, arrays)."""
    import json

    import pandas as pd

    def run(batches):
        for pdf in batches:
            rows = []
            for no, v, text in zip(pdf["entity_no"], pdf["version"], pdf["data"]):
                try:
                    todo = [json.loads(text)]
                except (ValueError, TypeError):
                    continue
                objects = tagged = arrays = 0
                while todo:
                    x = todo.pop()
                    if isinstance(x, dict):
                        objects, tagged = objects + 1, tagged + ("instanceType" in x)
                        todo += x.values()
                    elif isinstance(x, list):
                        arrays += 1
                        todo += x
                rows.append((no, v, objects, tagged, arrays))
            yield pd.DataFrame(rows, columns=["entity_no", "version", "objects", "tagged", "arrays"])

    rows = table(spark, d, "advanced_entities").select("entity_no", "version", "data").distinct()
    return rows.mapInPandas(run, "entity_no bigint, version int, objects bigint, tagged bigint, arrays bigint")


_TREE = """WITH x AS (SELECT DISTINCT entity_no, version, data FROM advanced_entities WHERE json_valid(data)), t AS (SELECT x.entity_no, x.version, j.type, j.key FROM x, json_tree(x.data) j)
  SELECT entity_no, version, count(*) FILTER (type = 'OBJECT') AS objects, count(*) FILTER (key = 'instanceType') AS tagged, count(*) FILTER (type = 'ARRAY') AS arrays FROM t GROUP BY ALL"""


@query(_TREE)
def i20_walk(spark, d):
    """Every node of JSON trees, counted by kind."""
    return _tree(spark, d)


@query(f"SELECT CAST(sum(objects) AS BIGINT) AS objects, CAST(sum(tagged) AS BIGINT) AS tagged, CAST(floor((sum(tagged) * 20000 + sum(objects)) / (sum(objects) * 2)) AS BIGINT) AS coverage_bp FROM ({_TREE})")
def d16_tag_coverage(spark, d):
    """Share of objects that name their type."""
    t = _tree(spark, d).agg(F.sum("objects").alias("objects"), F.sum("tagged").alias("tagged"))
    return t.withColumn("coverage_bp", M.percent(F.col("tagged"), F.col("objects"), 10000))


@query(E + "SELECT table_name, count(*) AS n, count(model) AS with_model, count(parent_id) AS with_parent FROM entities GROUP BY ALL")
def d19_attribute_coverage(spark, d):
    """Rows that have an optional attribute."""
    return views.entities(spark, d).groupBy("table_name").agg(F.count("*").alias("n"), F.count("model").alias("with_model"), F.count("parent_id").alias("with_parent"))


@query("SELECT study_id, count(*) FILTER (coalesce(error, '') <> '') AS conflicts, greatest(5000, 10000 - 500 * count(*) FILTER (coalesce(error, '') <> '')) AS confidence_bp FROM enrichment GROUP BY ALL")
def d25_report_confidence(spark, d):
    """Confidence of a report by its conflicts."""
    n = F.count_if(F.coalesce("error", F.lit("")) != "")
    return table(spark, d, "enrichment").groupBy("study_id").agg(n.alias("conflicts")).withColumn("confidence_bp", F.greatest(F.lit(5000), 10000 - 500 * F.col("conflicts")))


@query("SELECT file_no, count(*) FILTER (entity_type = 'objective') AS objectives, count(*) FILTER (entity_type = 'endpoint') AS endpoints, count(*) AS n FROM agent_files GROUP BY ALL")
def d28_output_sizes(spark, d):
    """Records of each output by type."""
    return table(spark, d, "agent_files").groupBy("file_no").agg(F.count_if(F.col("entity_type") == "objective").alias("objectives"), F.count_if(F.col("entity_type") == "endpoint").alias("endpoints"), F.count("*").alias("n"))


@query(L + "SELECT table_name, entity_type, count(*) AS n, list(entity_no ORDER BY pos, entity_no)[1:5] AS shown FROM live GROUP BY ALL")
def d29_component_summary(spark, d):
    """Components with their size and first five members."""
    v, by = views.live(spark, d), ["table_name", "entity_type"]
    first = M.rank_first(v, by, [F.col("pos"), F.col("entity_no")], 5).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "entity_no"))).alias("x"))
    return v.groupBy(*by).agg(F.count("*").alias("n")).join(first, by).select(*by, "n", F.transform("x", lambda x: x["entity_no"]).alias("shown"))


@query("SELECT entity_type, count(*) AS checks, count(*) FILTER (enriched) AS passed, CAST(floor((count(*) FILTER (enriched) * 20000 + count(*)) / (count(*) * 2)) AS BIGINT) AS rate_bp FROM enrichment GROUP BY ALL")
def d33_pass_rate(spark, d):
    """Share of passed checks by phase."""
    t = table(spark, d, "enrichment").groupBy("entity_type").agg(F.count("*").alias("checks"), F.count_if("enriched").alias("passed"))
    return t.withColumn("rate_bp", M.percent(F.col("passed"), F.col("checks"), 10000))


# --- resolution -------------------------------------------------------------------

_TP = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches({{0}}, {Q.quoted(p)}) THEN {Q.quoted(t.split('{}')[0])} || " + " || ".join(f"replace(regexp_extract({{0}}, {Q.quoted(p)}, {i + 1}), '_', '-') || {Q.quoted(x)}" for i, x in enumerate(t.split("{}")[1:])) + " END"
    for p, t in T.TIMEPOINTS
) + r", CASE WHEN regexp_matches({0}, '\([^)]{{2,}}\)') THEN 'rel_' || regexp_replace(trim(replace(regexp_extract({0}, '\(([^)]{{2,}})\)', 1), '_', '-')), '\s+', '_', 'g') END)"


@query(SV + ", p AS (SELECT study_id, sid, name AS a, lead(name) OVER (PARTITION BY study_id ORDER BY o) AS b FROM encounters WHERE name IS NOT NULL) SELECT study_id, sid, coalesce(" + _TP.format("a") + " = " + _TP.format("b") + ", true) AS may_match FROM p WHERE b IS NOT NULL")
def e02_visit_guard(spark, d):
    """Neighbouring visits that may be one: no two different time points."""
    nxt = F.lead("name").over(Window.partitionBy("study_id").orderBy("o"))
    p = _encounters(spark, d).where("name IS NOT NULL").withColumn("b", nxt).where("b IS NOT NULL")
    return p.select("study_id", "sid", F.coalesce(T.timepoint("name") == T.timepoint("b"), F.lit(True)).alias("may_match"))


@query()
def e06_name_scores(spark, d):
    """Similarity of neighbouring names, and whether they match by the stricter rule (e07)."""
    p = _encounters(spark, d).where("name IS NOT NULL").withColumn("b", F.lead("name").over(Window.partitionBy("study_id").orderBy("o"))).where("b IS NOT NULL")
    return p.select("study_id", "sid", F.round(Z.name_score(F.col("name"), F.col("b")), 6).alias("score"), Z.names_match(F.col("name"), F.col("b")).alias("matches"))


@query("SELECT 'narrative' AS source, 20 AS priority, count(*) AS n FROM narrative UNION ALL SELECT 'mirror', 10, count(*) FROM narrative_mirror")
def e08_contributions(spark, d):
    """Rows of several sources with their priority."""
    c = R.contributions([("narrative", 20, table(spark, d, "narrative").select("id")), ("mirror", 10, table(spark, d, "narrative_mirror").select("id"))])
    return c.groupBy("source", "priority").agg(F.count("*").alias("n"))


@query(_CON + "SELECT key, max_by(pos, struct_pack(p := priority, o := -pos)) AS best FROM c GROUP BY ALL")
def e10_best_id(spark, d):
    """The id of the contribution with the highest priority."""
    return _contributions(spark, d).groupBy("key").agg(F.max_by("pos", F.struct("priority", -F.col("pos"))).alias("best"))


@query(_CON + "SELECT key, list_sort(list(DISTINCT name) FILTER (name <> '')) AS names FROM c GROUP BY ALL HAVING count(*) FILTER (name <> '') > 0")
def e11_reference_sets(spark, d):
    """All references of a key, once each, sorted."""
    return _contributions(spark, d).where("name <> ''").groupBy("key").agg(F.array_sort(F.collect_set("name")).alias("names"))


@query(_CON + "SELECT key, bool_or(status = 'F') AS main, min_by(lo, pos) FILTER (lo IS NOT NULL) AS first_order FROM c GROUP BY ALL".replace("min_by(lo, pos)", "min_by(lo, struct_pack(p := pos, l := lo))"))
def e12_epoch_merge(spark, d):
    """Main if any contribution says so; the first order that is there."""
    return _contributions(spark, d).groupBy("key").agg(F.bool_or(F.col("status") == "F").alias("main"), F.min_by("lo", F.when(F.col("lo").isNotNull(), F.struct("pos", "lo"))).alias("first_order"))


@query(_CON + "SELECT key, list_sort(list(DISTINCT source)) AS sources, count(DISTINCT name) FILTER (name <> '') AS names, bool_or(status = 'O') AS conditional FROM c GROUP BY ALL")
def e15_activity_merge(spark, d):
    """Sets united, flags raised by any contribution."""
    return _contributions(spark, d).groupBy("key").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count_distinct(F.when(F.col("name") != "", F.col("name"))).alias("names"), F.bool_or(F.col("status") == "O").alias("conditional"))


@query(SV + """, c AS (SELECT study_id, lower(name) AS k, sid, 10 AS p, o FROM epochs UNION ALL SELECT study_id, lower(name), sid, 25, o FROM encounters WHERE contains(lower(name), 'treatment'))
  SELECT study_id, k, max_by(sid, struct_pack(p := p, o := -o)) AS sid, max(p) AS priority, count(*) AS n FROM c WHERE k IS NOT NULL GROUP BY ALL""")
def e16_epoch_sources(spark, d):
    """Epochs of several sources merged by name and priority."""
    row = lambda df, p: df.select("study_id", F.lower("name").alias("k"), "sid", F.lit(p).alias("p"), "o")
    c = row(_epochs(spark, d), 10).unionByName(row(_encounters(spark, d).where(F.lower("name").contains("treatment")), 25)).where("k IS NOT NULL")
    return c.groupBy("study_id", "k").agg(F.max_by("sid", F.struct("p", -F.col("o"))).alias("sid"), F.max("p").alias("priority"), F.count("*").alias("n"))


_ENDS = "regexp_replace({}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"


@query(_TWO + f""", p AS (SELECT DISTINCT v AS a, t AS b, {_ENDS.format('v')} AS x, {_ENDS.format('t')} AS y FROM k WHERE v IS NOT NULL AND t IS NOT NULL)
  SELECT a, b, (x IN ({', '.join(map(Q.quoted, R.TICKS))}) AND y IN ({', '.join(map(Q.quoted, R.TICKS))})) OR (x IN ({', '.join(map(Q.quoted, R.EMPTY_CELLS))}) AND y IN ({', '.join(map(Q.quoted, R.EMPTY_CELLS))})) OR coalesce(try_cast(x AS DOUBLE) = try_cast(y AS DOUBLE), false) OR lower(x) = lower(y) AS agree FROM p""")
def e20_cell_equality(spark, d):
    """Names of both narrative systems that count as the same cell value."""
    k = two_readers(spark, d).select(F.col("vision_value").alias("a"), F.col("text_value").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    return k.select("a", "b", R.values_agree(F.col("a"), F.col("b")).alias("agree"))


@query()
def e26_distinct_notes(spark, d):
    """Visit names with the earliest kept one of the study that they contain, are inside of or resemble by words (Jaccard above 0.8)."""
    return Z.distinct_notes(_encounters(spark, d), ["study_id"], "entity_no", "name")


@query("SELECT entity_type, min_by(result_no, struct_pack(s := CASE source WHEN 'automatic' THEN 0 ELSE 1 END, r := result_no)) AS first_no FROM enrichment GROUP BY ALL")
def e29_first_per_type(spark, d):
    """The first of each type, one source before the other (e31 with a lower-cased key)."""
    return table(spark, d, "enrichment").groupBy("entity_type").agg(F.min_by("result_no", F.struct(F.when(F.col("source") == "automatic", 0).otherwise(1), "result_no")).alias("first_no"))


@query("SELECT study_id, left(data.text, 50) AS k, min(entity_no) AS first_no, max(data.sectionTitle) AS title FROM narrative WHERE data.text IS NOT NULL GROUP BY ALL")
def e30_by_prefix(spark, d):
    """Records with one beginning merged, what is missing filled."""
    return table(spark, d, "narrative").where("data.text IS NOT NULL").groupBy("study_id", F.substring("data.text", 1, 50).alias("k")).agg(F.min("entity_no").alias("first_no"), F.max("data.sectionTitle").alias("title"))


@query("""WITH a AS (SELECT study_id, list(DISTINCT role ORDER BY role) AS x FROM (SELECT study_id, data.role AS role FROM interventions WHERE version = 1 AND data.role IS NOT NULL) GROUP BY 1), b AS (SELECT study_id, list(DISTINCT role ORDER BY role) AS y FROM (SELECT study_id, data.role AS role FROM interventions WHERE version > 1 AND data.role IS NOT NULL) GROUP BY 1)
  SELECT coalesce(a.study_id, b.study_id) AS study_id, list_concat(coalesce(x, []), [v for v in coalesce(y, []) if NOT list_contains(coalesce(x, []), v)]) AS merged FROM a FULL JOIN b ON a.study_id = b.study_id""")
def e33_merge_lists(spark, d):
    """A list with what only another list has after it."""
    side = lambda c, n: table(spark, d, "interventions").where(c).where("data.role IS NOT NULL").groupBy("study_id").agg(F.array_sort(F.collect_set("data.role")).alias(n))
    none = F.array().cast("array<string>")
    x, y = F.coalesce("x", none), F.coalesce("y", none)
    return side("version = 1", "x").join(side("version > 1", "y"), "study_id", "full_outer").select("study_id", F.concat(x, F.array_except(y, x)).alias("merged"))


@query("SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, CASE WHEN count(DISTINCT src) > 1 THEN 'both' ELSE min(src) END AS source FROM (SELECT study_id, id, 'narrative' AS src FROM narrative UNION ALL SELECT study_id, id, 'mirror' FROM narrative_mirror) GROUP BY ALL")
def e38_merge_trackers(spark, d):
    """Two trackers as one: what both tagged is both."""
    t = R.contributions([(s, 1, table(spark, d, n).select("study_id", same_id("id").alias("sid"))) for s, n in (("narrative", "narrative"), ("mirror", "narrative_mirror"))])
    return PV.tag_sources(t, ["study_id", "sid"])


@query(OB + "SELECT DISTINCT study_id, sid || '|' || coalesce(nullif(data.variableOfInterestId, ''), nullif(data.analysisPopulationId, ''), sid) AS cell FROM ob")
def e39_cell_keys(spark, d):
    """Cell keys with the first id that is there."""
    o = _objectives(spark, d, a=F.nullif("data.variableOfInterestId", F.lit("")), b=F.nullif("data.analysisPopulationId", F.lit("")))
    return o.select("study_id", F.concat("sid", F.lit("|"), F.coalesce("a", "b", "sid")).alias("cell")).distinct()


# --- order ------------------------------------------------------------------------


@query(SV + "SELECT e.study_id, e.sid, coalesce(p.sid, t.sid) AS depends_on FROM encounters e LEFT JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch LEFT JOIN (SELECT study_id, min_by(sid, o) AS sid FROM epochs GROUP BY 1) t ON t.study_id = e.study_id")
def f02_dependencies(spark, d):
    """What a record depends on: by id, else by type."""
    ep = _epochs(spark, d)
    by_id, by_type = ep.select("study_id", F.col("sid").alias("epoch"), F.col("sid").alias("p")), ep.groupBy("study_id").agg(F.min_by("sid", "o").alias("t"))
    return _encounters(spark, d).join(by_id, ["study_id", "epoch"], "left").join(by_type, "study_id", "left").select("study_id", "sid", F.coalesce("p", "t").alias("depends_on"))


@query(SV + "SELECT study_id, sid, row_number() OVER (PARTITION BY study_id ORDER BY coalesce(epoch, 'zzz'), name NULLS FIRST, sid) AS ord FROM encounters")
def f05_group_order(spark, d):
    """Records by group and name, those without a group last."""
    w = Window.partitionBy("study_id").orderBy(F.coalesce("epoch", F.lit("zzz")), F.col("name").asc_nulls_first(), "sid")
    return _encounters(spark, d).select("study_id", "sid", F.row_number().over(w).alias("ord"))


@query(SV + "SELECT study_id, sid, 'after ' || lag(sid) OVER w AS rule FROM epochs WINDOW w AS (PARTITION BY study_id ORDER BY o)")
def f07_elements(spark, d):
    """Elements with a rule that names the one before."""
    return W.neighbours(_epochs(spark, d), ["study_id"], ["o"], "sid").select("study_id", "sid", F.concat(F.lit("after "), "previous_id").alias("rule"))


@query(SV + "SELECT e.study_id, e.sid AS a, lead(e.sid) OVER (PARTITION BY e.study_id ORDER BY e.o) AS b FROM encounters e SEMI JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch")
def f08_sequence_edges(spark, d):
    """Edges between visits that are in the graph, in order."""
    ep = _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    return W.neighbours(_encounters(spark, d).join(ep, ["study_id", "epoch"], "left_semi"), ["study_id"], ["o"], "sid").select("study_id", F.col("sid").alias("a"), F.col("next_id").alias("b"))


@query("SELECT study_id, entity_id, result_no FROM enrichment WHERE confidence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY study_id, entity_id ORDER BY confidence DESC, result_no) = 1")
def g03_best_match(spark, d):
    """The surest result of each record, the earliest on a tie."""
    return M.rank_first(table(spark, d, "enrichment").where("confidence IS NOT NULL"), ["study_id", "entity_id"], [F.desc("confidence"), F.col("result_no")]).select("study_id", "entity_id", "result_no")


@query("SELECT study_id, doc_id FROM documents WHERE contains(lower(text), 'dose') QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY doc_id) <= 15")
def g06_first_pages(spark, d):
    """The first fifteen relevant texts of each study."""
    return M.rank_first(table(spark, d, "documents").where(F.lower("text").contains("dose")), ["study_id"], [F.col("doc_id")], 15).select("study_id", "doc_id")


@query(E + "SELECT table_name, entity_no, version, confidence FROM entities ORDER BY coalesce(confidence, 0) DESC, table_name, entity_no, version, pos, created_at LIMIT 100")
def g08_sorted_head(spark, d):
    """The head of a sorted list, missing values as zero."""
    return views.entities(spark, d).orderBy(F.desc(F.coalesce("confidence", F.lit(0))), "table_name", "entity_no", "version", "pos", "created_at").limit(100).select("table_name", "entity_no", "version", "confidence")


@query(r"WITH " + DOCS + r" SELECT doc_id FROM d WHERE len(regexp_extract_all(text, '\.{2,}|\d+\.\d+')) >= 5")
def h02_contents_pages(spark, d):
    """Texts that look like a table of contents."""
    return _docs(spark, d).where(F.regexp_count("text", F.lit(r"\.{2,}|\d+\.\d+")) >= 5).select("doc_id")


# --- scalars ----------------------------------------------------------------------


@query("SELECT entity_no, version, replace(id, '-', '_') AS id, [replace(x, '-', '_') for x in data.childIds] AS children FROM narrative")
def i09_standard_ids(spark, d):
    """Ids and lists of ids with underscores; other texts stay."""
    return table(spark, d, "narrative").select("entity_no", "version", N.standard_id("id").alias("id"), F.transform("data.childIds", N.standard_id).alias("children"))


@query("SELECT DISTINCT data.level.code AS code, CASE WHEN data.level.instanceType = 'AliasCode' THEN 'kept' ELSE 'wrapped' END AS how FROM objectives WHERE data.level.code IS NOT NULL")
def i26_alias_codes(spark, d):
    """Codes wrapped unless they are already."""
    lv = F.col("data.level")
    wrapped = F.when(lv["instanceType"] == "AliasCode", F.struct(F.lit("kept").alias("how"), lv.alias("standardCode"))).otherwise(F.struct(F.lit("wrapped").alias("how"), lv.alias("standardCode")))
    return table(spark, d, "objectives").where("data.level.code IS NOT NULL").select(wrapped.alias("w")).select("w.standardCode.code", "w.how").distinct()


@query("""WITH t AS (SELECT DISTINCT lower(trim(entity_name)) AS n, code FROM enrichment WHERE trim(entity_name) <> '' AND code IS NOT NULL), c AS (SELECT code, lower(trim(name)) AS c, [lower(trim(x)) for x in coalesce(synonyms, [])] AS s FROM concepts)
  SELECT n, code, CASE WHEN n = c THEN 10000 WHEN list_contains(s, n) THEN 9000 WHEN contains(c, n) OR contains(n, c) THEN 7000 WHEN len([x for x in s if contains(x, n) OR contains(n, x)]) > 0 THEN 6000
    ELSE CAST(5000 * len(list_intersect(string_split(n, ' '), string_split(c, ' '))) // len(list_distinct(list_concat(string_split(n, ' '), string_split(c, ' ')))) AS BIGINT) END AS score FROM t JOIN c USING (code)""")
def i27_relevance(spark, d):
    """How well a term fits the concept of its code."""
    t = table(spark, d, "enrichment").where("trim(entity_name) <> '' AND code IS NOT NULL").select(F.lower(F.trim("entity_name")).alias("n"), "code").distinct()
    c = table(spark, d, "concepts").select("code", F.lower(F.trim("name")).alias("c"), F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))).alias("s"))
    n, k = F.col("n"), F.col("c")
    wn, wc = F.array_distinct(F.split(n, " ")), F.array_distinct(F.split(k, " "))
    words = F.expr("0") + F.floor(5000 * F.size(F.array_intersect(wn, wc)) / F.size(F.array_union(wn, wc)))
    score = F.when(n == k, 10000).when(F.array_contains("s", n), 9000).when(k.contains(n) | n.contains(k), 7000).when(F.exists("s", lambda x: x.contains(n) | n.contains(x)), 6000).otherwise(words)
    return t.join(c, "code").select("n", "code", score.cast("bigint").alias("score"))


@query("SELECT doc_id, substr(sha256(text), 1, 12) AS hash FROM documents WHERE text IS NOT NULL")
def i55_text_hash(spark, d):
    """A short hash of each text."""
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.substring(F.sha2("text", 256), 1, 12).alias("hash"))


# --- rows out of text -------------------------------------------------------------

_TIT = r"(\d+)\s*mg for (\d+) days?,? then (\d+)\s*mg"


@query(rf"""WITH {DOCS}, m AS (SELECT doc_id, CAST(regexp_extract(text, {Q.quoted(_TIT)}, 1) AS INT) AS a, CAST(regexp_extract(text, {Q.quoted(_TIT)}, 2) AS INT) AS n, CAST(regexp_extract(text, {Q.quoted(_TIT)}, 3) AS INT) AS b FROM d WHERE regexp_matches(text, {Q.quoted(_TIT)}))
  SELECT doc_id, a || ' mg' AS dose, 1 AS start_day, n AS end_day FROM m UNION ALL SELECT doc_id, b || ' mg', n + 1, NULL FROM m""")
def j14_titration_steps(spark, d):
    """Two dose levels of a titration, the second after the first."""
    docs = _docs(spark, d).where(F.col("text").rlike(_TIT))
    g = lambda i: F.regexp_extract("text", _TIT, i).cast("int")
    step = lambda dose, a, b: F.struct(F.concat(dose.cast("string"), F.lit(" mg")).alias("dose"), a.alias("start_day"), b.alias("end_day"))
    return docs.select("doc_id", F.explode(F.array(step(g(1), F.lit(1), g(2)), step(g(3), g(2) + 1, F.lit(None).cast("int")))).alias("s")).select("doc_id", "s.*")


@query(rf"WITH {DOCS}, p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS part FROM d) SELECT doc_id, trim(regexp_extract(part, '^\s*(\d+(?:\.\d+)+)\s', 1)) AS number, trim(regexp_extract(part, '^\s*\d+(?:\.\d+)+\s+(.*)$', 1)) AS title FROM p WHERE regexp_matches(part, '^\s*\d+(?:\.\d+)+\s+\S')")
def j16_headed_sections(spark, d):
    """Numbered headings of texts as rows (j17's fields come the same way)."""
    lines = W.lines_of(_docs(spark, d), ["doc_id"]).where(F.col("line").rlike(r"^\s*\d+(?:\.\d+)+\s+\S"))
    return lines.select("doc_id", F.trim(F.regexp_extract("line", r"^\s*(\d+(?:\.\d+)+)\s", 1)).alias("number"), F.trim(F.regexp_extract("line", r"^\s*\d+(?:\.\d+)+\s+(.*)$", 1)).alias("title"))


@query("SELECT doc_id, n, list_concat(['Screening'], flatten([CASE WHEN i < n THEN ['Period ' || i, 'Washout'] ELSE ['Period ' || i] END for i in range(1, n + 1)]), ['End of Study']) AS seq FROM (SELECT doc_id, CAST(doc_id % 3 + 2 AS BIGINT) AS n FROM documents)")
def j21_crossover_sequence(spark, d):
    """Periods with washouts between them, screening before and the end after."""
    n = (F.col("doc_id") % 3 + 2).cast("bigint")
    parts = F.flatten(F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda i: F.when(i < n, F.array(F.concat(F.lit("Period "), i.cast("string")), F.lit("Washout"))).otherwise(F.array(F.concat(F.lit("Period "), i.cast("string"))))))
    return table(spark, d, "documents").select("doc_id", n.alias("n"), F.concat(F.array(F.lit("Screening")), parts, F.array(F.lit("End of Study"))).alias("seq"))


@query(SV + ", m AS (SELECT p.study_id, p.sid, p.o, bool_or(contains(lower(e.name), lower(p.name))) AS hit FROM epochs p JOIN encounters e ON e.study_id = p.study_id WHERE p.name IS NOT NULL AND e.name IS NOT NULL GROUP BY ALL), a AS (SELECT *, bool_or(hit) OVER (PARTITION BY study_id) AS anyhit FROM m) SELECT study_id, sid FROM a WHERE hit OR NOT anyhit")
def j22_mentioned_epochs(spark, d):
    """Epochs that visits mention by name; all of a study where none is."""
    ep = _epochs(spark, d).where("name IS NOT NULL").select("study_id", "sid", F.lower("name").alias("k"))
    enc = _encounters(spark, d).where("name IS NOT NULL").select("study_id", F.lower("name").alias("t"))
    short = enc.join(ep.where(F.length("k") < K.GRAM), "study_id").where(F.col("t").contains(F.col("k"))).select("study_id", "k")
    hit = K.containing(enc, ep, ["study_id"], "t", "k").select("study_id", "k").unionByName(short).distinct().withColumn("hit", F.lit(True))
    seen = ep.join(enc.select("study_id").distinct(), "study_id", "left_semi").join(hit, ["study_id", "k"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return seen.withColumn("some", F.bool_or("hit").over(Window.partitionBy("study_id"))).where("hit OR NOT some").select("study_id", "sid")


@query(rf"WITH {DOCS}, s AS (SELECT doc_id, len(regexp_extract_all(lower(text), 'day(?:s)?\s*[-–]?\d+\s*(?:to|through|[-–])')) AS w, len(regexp_extract_all(lower(text), 'if\s+(?:the\s+)?(?:patient|subject|value|level|result)|rescue')) AS e, len(regexp_extract_all(lower(text), 'every|weekly|daily')) AS r FROM d) SELECT doc_id, CASE WHEN greatest(w, e, r) = 0 THEN 'Single' WHEN w = greatest(w, e, r) THEN 'Window' WHEN e = greatest(w, e, r) THEN 'Episode' ELSE 'Recurring' END AS kind FROM s")
def j25_execution_types(spark, d):
    """How an activity is carried out, by the pattern counts of its text."""
    low = F.lower("text")
    n = {"Window": r"day(?:s)?\s*[-–]?\d+\s*(?:to|through|[-–])", "Episode": r"if\s+(?:the\s+)?(?:patient|subject|value|level|result)|rescue", "Recurring": "every|weekly|daily"}
    counts = {k: F.regexp_count(low, F.lit(p)) for k, p in n.items()}
    best = F.greatest(*counts.values())
    return _docs(spark, d).select("doc_id", reduce(lambda w, kc: w.when(kc[1] == best, kc[0]), counts.items(), F.when(best == 0, "Single")).alias("kind"))


_KW = ["dose", "randomi", "follow", "consent", "withdrawal"]


@query(f"WITH {DOCS} SELECT doc_id, {' + '.join(f'contains(lower(text), {Q.quoted(k)})::INT' for k in _KW)} AS hits FROM d WHERE {' + '.join(f'contains(lower(text), {Q.quoted(k)})::INT' for k in _KW)} >= 2")
def j28_relevant_pages(spark, d):
    """Texts with at least two of a list of keywords."""
    hits = reduce(lambda a, b: a + b, [F.lower("text").contains(k).cast("int") for k in _KW])
    return _docs(spark, d).select("doc_id", hits.alias("hits")).where("hits >= 2")


_SIGNS = [r"\bweek\s*[-+]?\d+", r"\bday\s*[-+]?\d+", r"\bcycle\s*\d+", r"\bbaseline\b", r"\bfollow[-\s]*up\b"]


@query(f"WITH {DOCS} SELECT doc_id FROM d WHERE {' + '.join(f'regexp_matches(lower(text), {Q.quoted(p)})::INT' for p in _SIGNS)} >= 3")
def j29_schedule_pages(spark, d):
    """Texts with at least three signs of a schedule."""
    return _docs(spark, d).where(X.pattern_score("text", _SIGNS) >= 3).select("doc_id")


# --- rules, terms, assembly -------------------------------------------------------


@query("SELECT * FROM (VALUES " + ", ".join(f"({Q.quoted(f.entity_type)}, {Q.quoted(f.name)}, {Q.quoted(f.kind)}, {str(f.required).lower()})" for f in FIELDS) + ") t(entity_type, field, kind, required)")
def k02_field_specs(spark, d):
    """The field specification as a table."""
    return spark.createDataFrame([(f.entity_type, f.name, f.kind, f.required) for f in FIELDS], "entity_type string, field string, kind string, required boolean")


@query("SELECT result_no, CASE WHEN code IS NULL THEN 'ERROR' WHEN confidence < 0.5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM enrichment WHERE error IS NOT NULL OR code IS NULL")
def k04_report_issues(spark, d):
    """Rows of an outside report as issues."""
    sev = F.when(F.col("code").isNull(), "ERROR").when(F.col("confidence") < 0.5, "WARNING").otherwise("INFO")
    return table(spark, d, "enrichment").where("error IS NOT NULL OR code IS NULL").select("result_no", sev.alias("severity"))


@query(OB + "SELECT entity_no, CASE WHEN entity_type = 'endpoint' AND trim(coalesce(data.purpose, '')) = '' THEN 'Efficacy' ELSE data.purpose END AS purpose FROM ob")
def k05_fix_loop(spark, d):
    """Fixes applied until no issue goes away any more."""
    obj = _objectives(spark, d, purpose=F.col("data.purpose")).select("entity_no", "entity_type", "purpose")
    specs = [f for f in FIELDS if f.name == "purpose"]
    fixed, _ = V.fix_until_stable(obj, lambda df: V.fill_defaults(df, specs).drop("filled"), lambda df: df.where("entity_type = 'endpoint' AND trim(coalesce(purpose, '')) = ''").count())
    return fixed.select("entity_no", "purpose")


@query(OB + "SELECT entity_no, data.purpose AS before, 'Efficacy' AS after FROM ob WHERE entity_type = 'endpoint' AND trim(coalesce(data.purpose, '')) = ''")
def k06_fix_audit(spark, d):
    """What a fix changed, before and after."""
    obj = _objectives(spark, d, purpose=F.col("data.purpose")).select("entity_no", "entity_type", "purpose")
    after = V.fill_defaults(obj, [f for f in FIELDS if f.name == "purpose"]).where("size(filled) > 0").select("entity_no", F.col("purpose").alias("after"))
    return obj.select("entity_no", F.col("purpose").alias("before")).join(after, "entity_no")


@query("SELECT DISTINCT data.purpose AS raw, CASE lower(trim(data.purpose)) WHEN 'efficacy' THEN 'E' WHEN 'safety' THEN 'S' ELSE coalesce(data.purpose, '') END AS code FROM objectives")
def k08_code_forms(spark, d):
    """Codes in one form where they are known."""
    low = F.lower(F.trim("data.purpose"))
    return table(spark, d, "objectives").select(F.col("data.purpose").alias("raw"), F.when(low == "efficacy", "E").when(low == "safety", "S").otherwise(F.coalesce("data.purpose", F.lit(""))).alias("code")).distinct()


@query(OB + """, s AS (SELECT study_id, count(*) FILTER (entity_type = 'objective') AS o, count(*) FILTER (entity_type = 'endpoint') AS e, count(*) FILTER (entity_type = 'estimand') AS t FROM ob GROUP BY 1)
  SELECT study_id, 'no_objective' AS rule FROM s WHERE o = 0 UNION ALL SELECT study_id, 'no_endpoint' FROM s WHERE e = 0 UNION ALL SELECT study_id, 'few_estimands' FROM s WHERE t < 3""")
def k09_local_checks(spark, d):
    """Studies that lack what a study must have."""
    n = lambda k: F.count_if(F.col("entity_type") == k)
    s = _objectives(spark, d).groupBy("study_id").agg(n("objective").alias("o"), n("endpoint").alias("e"), n("estimand").alias("t"))
    return V.rule_rows([("no_objective", "ERROR", s.where("o = 0")), ("no_endpoint", "ERROR", s.where("e = 0")), ("few_estimands", "WARNING", s.where("t < 3"))], ["study_id"]).select("study_id", "rule")


@query(SV + "SELECT a.study_id, a.epoch AS a, b.epoch AS b, count(*) AS n FROM (SELECT study_id, epoch, lead(epoch) OVER (PARTITION BY study_id ORDER BY o) AS nxt FROM encounters WHERE epoch IS NOT NULL) a JOIN (SELECT study_id, epoch, lead(epoch) OVER (PARTITION BY study_id ORDER BY o) AS nxt FROM encounters WHERE epoch IS NOT NULL) b ON a.study_id = b.study_id AND a.epoch = b.nxt AND a.nxt = b.epoch WHERE a.epoch < b.epoch GROUP BY ALL".replace("SELECT a.study_id, a.epoch AS a, b.epoch AS b, count(*) AS n", "SELECT DISTINCT a.study_id, a.epoch AS a, b.epoch AS b"))
def k14_reciprocal_steps(spark, d):
    """Pairs of epochs that follow each other both ways."""
    nxt = F.lead("epoch").over(Window.partitionBy("study_id").orderBy("o"))
    steps = materialize(_encounters(spark, d).where("epoch IS NOT NULL").select("study_id", "epoch", nxt.alias("nxt")).where("nxt IS NOT NULL").distinct())
    back = steps.select("study_id", F.col("nxt").alias("epoch"), F.col("epoch").alias("nxt"))
    return steps.join(back, ["study_id", "epoch", "nxt"]).where("epoch < nxt").select("study_id", F.col("epoch").alias("a"), F.col("nxt").alias("b"))


@query("SELECT lower(split_part(trim(data.name), ' ', 1)) AS name, count(DISTINCT entity_no) AS records FROM interventions WHERE data.name IS NOT NULL GROUP BY ALL HAVING count(DISTINCT entity_no) > 1")
def k16_fragments(spark, d):
    """Treatments that are spread over several records."""
    return table(spark, d, "interventions").where("data.name IS NOT NULL").groupBy(F.lower(F.split_part(F.trim("data.name"), F.lit(" "), F.lit(1))).alias("name")).agg(F.count_distinct("entity_no").alias("records")).where("records > 1")


@query("""WITH o AS (SELECT entity_name AS term, max(code) AS forced FROM enrichment WHERE source = 'manual' AND code IS NOT NULL AND entity_name IS NOT NULL GROUP BY 1), c AS (SELECT lower(trim(name)) AS k, min(code) AS code FROM concepts GROUP BY 1)
  SELECT DISTINCT e.entity_name AS term, coalesce(o.forced, c.code) AS code FROM enrichment e LEFT JOIN o ON o.term = e.entity_name LEFT JOIN c ON c.k = lower(trim(e.entity_name)) WHERE e.entity_name IS NOT NULL""")
def l01_enrich(spark, d):
    """Terms by override, else by name."""
    e = table(spark, d, "enrichment").where("entity_name IS NOT NULL")
    forced = e.where("source = 'manual' AND code IS NOT NULL").groupBy("entity_name").agg(F.max("code").alias("forced"))
    c = table(spark, d, "concepts").groupBy(F.lower(F.trim("name")).alias("k")).agg(F.min("code").alias("c"))
    return e.select("entity_name").distinct().withColumn("k", F.lower(F.trim("entity_name"))).join(forced, "entity_name", "left").join(c, "k", "left").select(F.col("entity_name").alias("term"), F.coalesce("forced", "c").alias("code"))


@query("SELECT entity_type, code, count(*) AS n FROM (SELECT entity_type, coalesce(data.level.code, 'none') AS code FROM objectives) GROUP BY ALL")
def l03_code_counts(spark, d):
    """Codes by type of record."""
    return table(spark, d, "objectives").groupBy("entity_type", F.coalesce("data.level.code", F.lit("none")).alias("code")).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', {Q.quoted(a)}, {Q.quoted(b)})" for k, t in (("objective", P.OBJECTIVE_LEVELS), ("endpoint", P.ENDPOINT_LEVELS), ("phase", P.PHASES), ("blinding", P.BLINDING_CODES)) for a, b in t.items()) + ") t(list, text, code)")
def l07_code_lists(spark, d):
    """The fixed code lists as a table."""
    lists = (("objective", P.OBJECTIVE_LEVELS), ("endpoint", P.ENDPOINT_LEVELS), ("phase", P.PHASES), ("blinding", P.BLINDING_CODES))
    return spark.createDataFrame([(k, a, b) for k, t in lists for a, b in t.items()], "list string, text string, code string")


@query("SELECT * FROM (VALUES " + ", ".join(f"({Q.quoted(a)}, {Q.quoted(b)})" for a, b in P.PLACEMENT.items()) + ") t(entity_type, path)")
def m03_placement_table(spark, d):
    """Where each type of entity goes."""
    return spark.createDataFrame(list(P.PLACEMENT.items()), "entity_type string, path string")


@query(SV + "SELECT e.study_id, e.sid, 'starts ' || p.name AS rule FROM encounters e JOIN (SELECT study_id, lower(left(name, 4)) AS k, max_by(name, o) AS name FROM epochs WHERE name IS NOT NULL GROUP BY ALL) p ON p.study_id = e.study_id AND p.k = lower(left(e.name, 4))")
def m13_transition_rules(spark, d):
    """Rules on visits that begin like a state, the last one of a beginning."""
    p = _epochs(spark, d).where("name IS NOT NULL").groupBy("study_id", F.lower(F.substring("name", 1, 4)).alias("k")).agg(F.max_by("name", "o").alias("n"))
    return _encounters(spark, d).withColumn("k", F.lower(F.substring("name", 1, 4))).join(p, ["study_id", "k"]).select("study_id", "sid", F.concat(F.lit("starts "), "n").alias("rule"))


@query(SV + f", a AS (SELECT study_id, lower(name) AS k, sid, row_number() OVER (PARTITION BY study_id, lower(name) ORDER BY coalesce({_D}, 9999), o) AS rn FROM encounters WHERE name IS NOT NULL) SELECT a.study_id, a.sid, CASE WHEN {Q.ladder('a.k', MP.TIMING_ANCHOR)} = 'Visit' THEN 'encounter' WHEN {Q.ladder('a.k', MP.TIMING_ANCHOR)} = 'Event' THEN 'activity' END AS bound_to FROM a WHERE rn = 1")
def m16_anchor_instances(spark, d):
    """Anchors once a name in order of day, bound by their class."""
    w = Window.partitionBy("study_id", F.lower("name")).orderBy(F.coalesce(T.name_timing("name")["day"], F.lit(9999)), "o")
    a = _encounters(spark, d).where("name IS NOT NULL").withColumn("rn", F.row_number().over(w)).where("rn = 1")
    kind = MP.TIMING_ANCHOR.column("name")
    return a.select("study_id", "sid", F.when(kind == "Visit", "encounter").when(kind == "Event", "activity").alias("bound_to"))


@query(SV + "SELECT study_id, sid, CASE WHEN row_number() OVER w > 1 THEN coalesce(name, '') || ' (' || row_number() OVER w || ')' ELSE coalesce(name, '') END AS name FROM epochs WINDOW w AS (PARTITION BY study_id, coalesce(name, '') ORDER BY o)")
def m23_numbered_names(spark, d):
    """Repeated names of epochs numbered."""
    ep = _epochs(spark, d).withColumn("name", F.coalesce("name", F.lit("")))
    return R.numbered_names(ep, ["study_id"], "name", ["o"]).select("study_id", "sid", "name")


@query(SV + "SELECT study_id, sid, coalesce(CASE WHEN pos % 4 = 0 THEN 'given' END, lead(sid) OVER (PARTITION BY study_id ORDER BY o)) AS next_id FROM epochs")
def m24_next_ids(spark, d):
    """Next ids where none is given."""
    nxt = F.lead("sid").over(Window.partitionBy("study_id").orderBy("o"))
    return _epochs(spark, d).select("study_id", "sid", F.coalesce(F.when(F.col("pos") % 4 == 0, "given"), nxt).alias("next_id"))


@query(SV + """, f AS (SELECT e.study_id, bool_or(p.sid IS NULL) AS broken FROM encounters e LEFT JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch WHERE e.epoch IS NOT NULL GROUP BY 1)
  SELECT e.study_id, e.sid AS cell, e.epoch FROM encounters e JOIN f USING (study_id) WHERE NOT broken AND e.epoch IS NOT NULL UNION ALL SELECT p.study_id, 'rebuilt', p.sid FROM epochs p JOIN f USING (study_id) WHERE broken""")
def m25_rebuilt_cells(spark, d):
    """Cells kept, or built anew where one of a study points nowhere."""
    enc, ep = _encounters(spark, d).where("epoch IS NOT NULL").select("study_id", F.col("sid").alias("cell"), "epoch"), _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"))
    flag = enc.join(ep.withColumn("known", F.lit(True)), ["study_id", "epoch"], "left").groupBy("study_id").agg(F.bool_or(F.col("known").isNull()).alias("broken"))
    kept = enc.join(flag.where("NOT broken"), "study_id", "left_semi")
    return kept.unionByName(ep.join(flag.where("broken"), "study_id", "left_semi").select("study_id", F.lit("rebuilt").alias("cell"), "epoch"))


@query("SELECT source, count(*) AS n, " + Q.ladder("source", MP.ORGANIZATION_TYPE) + " AS kind FROM documents GROUP BY ALL")
def m27_organisation_types(spark, d):
    """Kinds of organisation by the first keyword in the name."""
    return table(spark, d, "documents").groupBy("source", MP.ORGANIZATION_TYPE.column("source").alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY study_id, role ORDER BY entity_no, version) AS rn FROM (SELECT study_id, entity_no, version, data.role AS role FROM interventions WHERE data.role IN ('Rescue', 'Background', 'Placebo')))
  SELECT study_id, role, entity_no FROM r WHERE rn = 1 UNION ALL SELECT study_id, 'Placebo', NULL FROM (SELECT DISTINCT study_id FROM interventions) s ANTI JOIN (SELECT study_id FROM r WHERE role = 'Placebo') p USING (study_id)""")
def m28_known_roles(spark, d):
    """One record for each known role, the required one made where it lacks (m29 joins the same way)."""
    r = table(spark, d, "interventions").select("study_id", "entity_no", "version", F.col("data.role").alias("role"))
    one = R.keep_first(r.where(F.col("role").isin("Rescue", "Background", "Placebo")), ["study_id", "role"], ["entity_no", "version"]).select("study_id", "role", "entity_no")
    need = K.missing_from(r.select("study_id").distinct(), one.where("role = 'Placebo'"), ["study_id"])
    return one.unionByName(need.select("study_id", F.lit("Placebo").alias("role"), F.lit(None).cast("bigint").alias("entity_no")))


@query("""SELECT DISTINCT entity_no, version, CASE data->>'$.primaryReason.code.decode' WHEN 'Safety update' THEN 'S' WHEN 'Error fix' THEN 'E' ELSE 'O' END AS reason,
  CASE WHEN coalesce(data->>'$.primaryReason.code.decode', '') IN ('Safety update', 'Error fix') THEN NULL ELSE coalesce(data->>'$.primaryReason.otherReason', 'not stated') END AS other FROM advanced_entities WHERE entity_type = 'study_amendment' AND json_valid(data)""")
def m30_amendment_reasons(spark, d):
    """Reasons by map; the other reason set or cleared by the code."""
    v = F.try_parse_json("data")
    rows = table(spark, d, "advanced_entities").where("entity_type = 'study_amendment'").select("entity_no", "version", v.alias("v")).where("v IS NOT NULL")
    code, other = F.try_variant_get("v", "$.primaryReason.code.decode", "string"), F.try_variant_get("v", "$.primaryReason.otherReason", "string")
    known = F.coalesce(code, F.lit("")).isin("Safety update", "Error fix")
    return rows.select("entity_no", "version", F.when(code == "Safety update", "S").when(code == "Error fix", "E").otherwise("O").alias("reason"), F.when(~known, F.coalesce(other, F.lit("not stated"))).alias("other")).distinct()


# --- state, evaluation ------------------------------------------------------------


@query(E + "SELECT table_name, count(*) AS n, CAST(sum(version) AS BIGINT) AS versions FROM entities GROUP BY ALL")
def n05_round_trip(spark, d):
    """The store written out and read back (with n04's snapshots and n15's stages)."""
    kept = materialize(views.entities(spark, d))
    return kept.groupBy("table_name").agg(F.count("*").alias("n"), F.sum("version").alias("versions"))


@query("SELECT entity_type, count(*) FILTER (coalesce(error, '') <> '') AS failed, NOT (entity_type IN ('endpoint') AND count(*) FILTER (coalesce(error, '') <> '') > 0) AS go_on FROM enrichment GROUP BY entity_type")
def n18_continue(spark, d):
    """Go on after failures unless a critical kind failed."""
    t = table(spark, d, "enrichment").groupBy("entity_type").agg(F.count_if(F.coalesce("error", F.lit("")) != "").alias("failed"))
    return t.withColumn("go_on", ~(F.coalesce(F.col("entity_type").isin("endpoint"), F.lit(False)) & (F.col("failed") > 0)))


@query(SV + "SELECT study_id, 'epoch' AS kind, lower(name) AS k, max_by(sid, o) AS sid FROM epochs WHERE name IS NOT NULL GROUP BY ALL UNION ALL SELECT study_id, 'encounter', lower(name), max_by(sid, o) FROM encounters WHERE name IS NOT NULL GROUP BY ALL")
def n22_lookups(spark, d):
    """Lookups by kind and name."""
    one = lambda df, k: K.last_wins(df.where("name IS NOT NULL").select("study_id", F.lit(k).alias("kind"), F.lower("name").alias("k"), "sid", "o"), ["study_id", "kind", "k"], "sid", "o")
    return one(_epochs(spark, d), "epoch").unionByName(one(_encounters(spark, d), "encounter"))


@query("SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, max(version) AS version, CASE WHEN arg_max(is_deleted, version) THEN 'withdrawn' WHEN max(version) = 1 THEN 'draft' ELSE 'published' END AS status FROM narrative GROUP BY ALL")
def n23_overlay_status(spark, d):
    """State of versioned overlays."""
    t = table(spark, d, "narrative").groupBy("study_id", same_id("id").alias("sid")).agg(F.max("version").alias("version"), F.max_by("is_deleted", "version").alias("gone"))
    return t.select("study_id", "sid", "version", F.when(F.col("gone"), "withdrawn").when(F.col("version") == 1, "draft").otherwise("published").alias("status"))


@query(L + "SELECT table_name, count(*) AS n, count(*) >= 10 AS enough, bool_or(contains(lower(name), 'dose')) AS mentions FROM live GROUP BY ALL")
def o07_expectations(spark, d):
    """Expectations as rules over aggregates."""
    t = views.live(spark, d).groupBy("table_name").agg(F.count("*").alias("n"), F.bool_or(F.lower("name").contains("dose")).alias("mentions"))
    return t.select("table_name", "n", (F.col("n") >= 10).alias("enough"), "mentions")


@query("""WITH g AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, max(length(data.text)) AS n FROM narrative GROUP BY ALL), t AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, max(length(data.text)) AS n FROM narrative_mirror GROUP BY ALL)
  SELECT coalesce(g.study_id, t.study_id) AS study_id, coalesce(g.sid, t.sid) AS sid, CASE WHEN t.sid IS NULL THEN 'missing' WHEN g.sid IS NULL THEN 'extra' WHEN g.n IS DISTINCT FROM t.n THEN 'length' ELSE 'same' END AS deviation FROM g FULL JOIN t ON g.study_id = t.study_id AND g.sid = t.sid""")
def o08_deviations(spark, d):
    """Deviations of a test copy from the golden one, key by key."""
    s = lambda t, c: table(spark, d, t).groupBy("study_id", same_id("id").alias("sid")).agg(F.max(F.length("data.text")).alias(c), F.lit(True).alias(f"in_{c}"))
    j = s("narrative", "g").join(s("narrative_mirror", "t"), ["study_id", "sid"], "full_outer")
    kind = F.when(F.col("in_t").isNull(), "missing").when(F.col("in_g").isNull(), "extra").when(~F.col("g").eqNullSafe(F.col("t")), "length").otherwise("same")
    return j.select("study_id", "sid", kind.alias("deviation"))


@query("SELECT entity_type, count(*) AS n, count(DISTINCT study_id) AS studies, min(created_at) AS first_at FROM soa_vision GROUP BY ALL")
def o09_run_summary(spark, d):
    """Saved runs by type."""
    return table(spark, d, "soa_vision").groupBy("entity_type").agg(F.count("*").alias("n"), F.count_distinct("study_id").alias("studies"), F.min("created_at").alias("first_at"))


@query("SELECT doc_id, md5(regexp_replace(text, '<[^>]+>', '', 'g')) AS plain FROM documents WHERE contains(text, '<')")
def o10_without_markup(spark, d):
    """Texts without their HTML rests."""
    return table(spark, d, "documents").where(F.col("text").contains("<")).select("doc_id", F.md5(F.regexp_replace("text", "<[^>]+>", "")).alias("plain"))


@query("SELECT agent_id, list_sort(list(DISTINCT entity_type)) AS outputs FROM agent_files GROUP BY ALL HAVING list_contains(list(DISTINCT entity_type), 'endpoint')")
def p04_by_capability(spark, d):
    """Producers of one kind of output."""
    t = table(spark, d, "agent_files").groupBy("agent_id").agg(F.array_sort(F.collect_set("entity_type")).alias("outputs"))
    return t.where(F.array_contains("outputs", "endpoint"))


@query(SV + rf""", x AS (SELECT study_id, CASE WHEN pos % 2 = 0 THEN 1 ELSE 2 END AS side, regexp_replace(trim(lower(name)), '\s*\([^)]+\)\s*$', '') AS k, name, sid, o, CAST(pos % 3 AS INT) AS before, CAST(pos % 4 AS INT) AS after FROM encounters WHERE name IS NOT NULL)
  SELECT study_id, k, max_by(name, struct_pack(l := length(name), o := -o)) AS name, coalesce(min_by(before, struct_pack(s := side, o := o)) FILTER (before <> 0), 0) AS before, coalesce(min_by(after, struct_pack(s := side, o := o)) FILTER (after <> 0), 0) AS after FROM x GROUP BY ALL""")
def e25_merge_windows(spark, d):
    """Windows of two sources by name: the longer name, bounds of the first source, zero ones filled from the second."""
    k = F.regexp_replace(F.trim(F.lower("name")), r"\s*\([^)]+\)\s*$", "")
    x = _encounters(spark, d).where("name IS NOT NULL").select("study_id", k.alias("k"), "name", "o", F.when(F.col("pos") % 2 == 0, 1).otherwise(2).alias("side"), (F.col("pos") % 3).alias("before"), (F.col("pos") % 4).alias("after"))
    bound = lambda c: F.coalesce(F.min_by(c, F.when(F.col(c) != 0, F.struct("side", "o"))), F.lit(0)).alias(c)
    return x.groupBy("study_id", "k").agg(F.max_by("name", F.struct(F.length("name"), -F.col("o"))).alias("name"), bound("before"), bound("after"))


@query()
def i23_closed_json(spark, d):
    """Cut-off payloads closed after their last whole value."""
    from tessera.functions.repair import close_json

    rows = table(spark, d, "agent_files").select("file_no", "record_no", "payload").distinct()
    return rows.select("file_no", "record_no", F.try_parse_json("payload").isNotNull().alias("was_whole"), F.try_parse_json(close_json("payload")).isNotNull().alias("reads"))


@query(OB + """, a AS (SELECT study_id, sid FROM ob WHERE entity_type = 'analysis_population'), e AS (SELECT study_id, sid FROM ob WHERE entity_type = 'estimand') SELECT a.study_id, a.sid AS arm, e.sid AS epoch, md5(a.study_id || '/' || a.sid || '/' || e.sid) AS cell FROM a JOIN e USING (study_id)""")
def j36_cells(spark, d):
    """A cell for each arm and epoch of a study, with a stable id: the cells are the result."""
    o = _objectives(spark, d)
    a, e = (o.where(F.col("entity_type") == k).select("study_id", F.col("sid").alias(n)) for k, n in (("analysis_population", "arm"), ("estimand", "epoch")))
    return a.join(e, "study_id").select("study_id", "arm", "epoch", F.md5(F.concat_ws("/", "study_id", "arm", "epoch")).alias("cell"))


@query("""WITH t AS (SELECT result_no, study_id, coalesce(nullif(lower(trim(entity_type)), ''), 'other') AS cat FROM enrichment), f AS (SELECT study_id, cat, min(result_no) AS seen FROM t GROUP BY ALL)
  SELECT study_id, cat, dense_rank() OVER (PARTITION BY study_id ORDER BY seen) AS no FROM f""")
def j39_categories(spark, d):
    """Categories of a study, made when first seen, whatever their case."""
    cat = F.coalesce(F.nullif(F.lower(F.trim("entity_type")), F.lit("")), F.lit("other"))
    f = table(spark, d, "enrichment").groupBy("study_id", cat.alias("cat")).agg(F.min("result_no").alias("seen"))
    return f.select("study_id", "cat", F.dense_rank().over(Window.partitionBy("study_id").orderBy("seen")).alias("no"))


@query(SV + """, i AS (SELECT DISTINCT study_id, sid, 'own' AS origin FROM epochs), v AS (SELECT DISTINCT study_id, epoch AS sid FROM encounters WHERE epoch IS NOT NULL) SELECT study_id, sid, origin, CASE WHEN sid = 'epoch_1' THEN 'Open Label' ELSE 'Double Blind' END AS blinding FROM
  (SELECT * FROM i UNION ALL SELECT study_id, sid, 'seen' FROM v ANTI JOIN i USING (study_id, sid))""")
def m08_design_defaults(spark, d):
    """Records united by unseen id, with defaults by map."""
    own = _epochs(spark, d).select("study_id", "sid").distinct().withColumn("origin", F.lit("own"))
    seen = _encounters(spark, d).where("epoch IS NOT NULL").select("study_id", F.col("epoch").alias("sid")).distinct()
    every = own.unionByName(K.missing_from(seen, own, ["study_id", "sid"]).withColumn("origin", F.lit("seen")))
    return every.withColumn("blinding", F.when(F.col("sid") == "epoch_1", "Open Label").otherwise("Double Blind"))


@query(OB + "SELECT entity_type, count(*) AS n, count(DISTINCT coalesce(data.text, data.name, data.description)) AS labels FROM ob GROUP BY ALL")
def o01_entity_lists(spark, d):
    """Entities of each type by whichever name field they have."""
    o = _objectives(spark, d, t=F.coalesce("data.text", "data.name", "data.description"))
    return o.groupBy("entity_type").agg(F.count("*").alias("n"), F.count_distinct("t").alias("labels"))


@query(SV + "SELECT e.study_id, e.sid, p.sid AS moved_to FROM encounters e JOIN (SELECT study_id, min_by(sid, o) AS sid FROM epochs GROUP BY 1) p USING (study_id) ANTI JOIN epochs x ON x.study_id = e.study_id AND x.sid = e.epoch WHERE e.epoch IS NOT NULL")
def m17_dangling_repair(spark, d):
    """References that point nowhere moved to the first record of the study."""
    ep = _epochs(spark, d)
    lost = K.missing_from(_encounters(spark, d).where("epoch IS NOT NULL"), ep.select("study_id", F.col("sid").alias("epoch")), ["study_id", "epoch"])
    return lost.join(ep.groupBy("study_id").agg(F.min_by("sid", "o").alias("moved_to")), "study_id").select("study_id", "sid", "moved_to")


@query(SV + "SELECT study_id, sid, 'administration' AS kind, coalesce(name, '') || ' in ' || epoch AS what FROM encounters WHERE epoch IS NOT NULL AND contains(lower(name), 'day')")
def m15_administrations(spark, d):
    """Rows made from records that have what they need."""
    e = _encounters(spark, d).where("epoch IS NOT NULL").where(F.lower("name").contains("day"))
    return e.select("study_id", "sid", F.lit("administration").alias("kind"), F.concat(F.coalesce("name", F.lit("")), F.lit(" in "), "epoch").alias("what"))


@query("WITH t AS (SELECT DISTINCT lower(trim(entity_name)) AS n FROM enrichment WHERE trim(entity_name) <> ''), c AS (SELECT code, lower(trim(name)) AS k FROM concepts WHERE length(trim(name)) >= 3) SELECT n, min(code) AS code FROM t JOIN c ON contains(n, k) GROUP BY ALL")
def l04_containment(spark, d):
    """Terms that contain the name of a concept."""
    t = table(spark, d, "enrichment").where("trim(entity_name) <> ''").select(F.lower(F.trim("entity_name")).alias("n")).distinct()
    c = table(spark, d, "concepts").select("code", F.lower(F.trim("name")).alias("k"))
    return K.containing(t, c, [], "n", "k").join(c, "k").groupBy("n").agg(F.min("code").alias("code"))


@query("SELECT data.level.codeSystem AS code_system, data.level.code AS code, CASE data.level.codeSystem WHEN 'urn:invented:levels' THEN 'levels' ELSE 'other' END AS list, count(*) AS n FROM objectives WHERE data.level.code IS NOT NULL GROUP BY ALL")
def l05_code_lists(spark, d):
    """Codes by the list their system stands for."""
    lv = F.col("data.level")
    return table(spark, d, "objectives").where("data.level.code IS NOT NULL").groupBy(lv["codeSystem"].alias("code_system"), lv["code"].alias("code"), F.when(lv["codeSystem"] == "urn:invented:levels", "levels").otherwise("other").alias("list")).agg(F.count("*").alias("n"))


@query(r"WITH " + DOCS + r", m AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '(\w+) (?:is|are) (?:taken|drawn|collected)', 1)) AS activity FROM d) SELECT doc_id, activity, count(*) AS n FROM m GROUP BY ALL")
def j26_activities(spark, d):
    """Activities that texts say are carried out."""
    hits = F.regexp_extract_all(F.lower("text"), F.lit(r"(\w+) (?:is|are) (?:taken|drawn|collected)"), F.lit(1))
    return _docs(spark, d).select("doc_id", F.explode(hits).alias("activity")).groupBy("doc_id", "activity").agg(F.count("*").alias("n"))


@query(SV + "SELECT e.study_id, e.sid, e.name AS visit, p.name AS epoch, CASE WHEN contains(lower(e.name), 'screening') THEN -14 ELSE e.pos END AS day FROM encounters e LEFT JOIN epochs p ON p.study_id = e.study_id AND p.sid = e.epoch")
def j12_schedule_windows(spark, d):
    """Visits of the schedule with their epoch and day."""
    p = _epochs(spark, d).select("study_id", F.col("sid").alias("epoch"), F.col("name").alias("p"))
    e = _encounters(spark, d).join(p, ["study_id", "epoch"], "left")
    return e.select("study_id", "sid", F.col("name").alias("visit"), F.col("p").alias("epoch"), F.when(F.lower("name").contains("screening"), -14).otherwise(F.col("pos")).alias("day"))


@query("SELECT agent_id, entity_type, count(*) AS n, count(*) FILTER (CASE WHEN json_valid(payload) THEN json_extract(payload, '$.id') END IS NOT NULL) AS with_id FROM agent_files GROUP BY ALL")
def k18_shape_check(spark, d):
    """Records of each kind that have the shape they should."""
    v = F.try_parse_json("payload")
    return table(spark, d, "agent_files").groupBy("agent_id", "entity_type").agg(F.count("*").alias("n"), F.count_if(F.try_variant_get(v, "$.id", "variant").isNotNull()).alias("with_id"))
