"""Queries over entity tables: storage, provenance, metrics (B, C, D, H, N rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import same_id
from tessera.functions.mappings import ERROR_CATEGORY
from tessera.operators import metrics as M
from tessera.operators import provenance as P
from tessera.operators import store as S
from tessera.plans.runtime import table
from tessera.queries import sqltext as Q
from tessera.queries import views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


E, L = f"WITH {Q.ENTITIES} ", f"WITH {Q.ENTITIES}, {Q.LIVE} "
SHORT = ("table_name", "study_id", "sid")


@query(E + "SELECT table_name, study_id, sid, version FROM entities WHERE entity_type = 'encounter' AND model = 'orin-large'")
def b01_query_entities(spark, d):
    """Entities of one type with a given attribute."""
    return S.query_entities(views.entities(spark, d), "encounter", model="orin-large").select(*SHORT, "version")


@query(E + "SELECT table_name, study_id, sid, version FROM entities WHERE model = 'tavel-2'")
def b02_query_attribute(spark, d):
    """Entities by one attribute; a null never matches."""
    return S.query_entities(views.entities(spark, d), model="tavel-2").select(*SHORT, "version")


@query(E + "SELECT table_name, coalesce(model = 'orin-small', false) AS matches, count(*) AS n FROM entities GROUP BY ALL")
def b03_filter_predicate(spark, d):
    """How many rows match a filter, absent values failing it."""
    return views.entities(spark, d).groupBy("table_name", F.coalesce(F.col("model") == "orin-small", F.lit(False)).alias("matches")).agg(F.count("*").alias("n"))


@query(L + "SELECT table_name, study_id, sid, entity_no, name FROM live WHERE sid = 'epoch_1'")
def b04_point_lookup(spark, d):
    """Live entities by id."""
    return views.live(spark, d).where("sid = 'epoch_1'").select(*SHORT, "entity_no", "name")


@query(L + "SELECT table_name, study_id, sid, name FROM live WHERE entity_type IN ('study_intervention', 'endpoint', 'epoch') AND trim(name) <> ''")
def b05_enrichable(spark, d):
    """Entities that can be enriched: type in a set and a name."""
    return S.enrichable(views.live(spark, d), ["study_intervention", "endpoint", "epoch"]).select(*SHORT, "name")


@query(L + "SELECT table_name, study_id, sid FROM live WHERE entity_type IN ('objective', 'estimand') AND NOT source_agent IN ('checkpoint_agent')")
def b06_provenance_query(spark, d):
    """Optional type filter, agents of the infrastructure left out."""
    return S.optional_filters(views.live(spark, d), F.col("entity_type").isin("objective", "estimand"), None, ~F.col("source_agent").isin("checkpoint_agent")).select(*SHORT)


@query(L + "SELECT entity_type, count(*) AS n FROM live WHERE entity_type IN ('epoch', 'encounter', 'country') AND NOT entity_type IN ('country') GROUP BY ALL")
def b07_include_exclude(spark, d):
    """Included types without the excluded ones."""
    return S.by_types(views.live(spark, d), ["epoch", "encounter", "country"], ["country"]).groupBy("entity_type").agg(F.count("*").alias("n"))


@query("""SELECT entity_no, version, list_sort([k for k in json_keys(data) if NOT starts_with(k, '_') AND k NOT IN ('instanceType', 'summary')]) AS kept FROM advanced_entities WHERE json_valid(data)""")
def b08_prune_properties(spark, d):
    """Property names that stay after internal ones are dropped."""
    df = table(spark, d, "advanced_entities").where(F.try_parse_json("data").isNotNull())
    keys = F.array_sort(F.filter(F.json_object_keys("data"), lambda k: ~k.startswith("_") & ~k.isin("instanceType", "summary")))
    return df.select("entity_no", "version", keys.alias("kept"))


@query("SELECT entity_no, version, data.id AS id, data.name AS name, data.text AS text, data.instanceType AS \"instanceType\" FROM narrative")
def b09_drop_columns(spark, d):
    """Records without the properties that their type must not have."""
    drop = {"narrative": ["childIds", "sectionNumber", "sectionTitle"]}
    return table(spark, d, "narrative").select("entity_no", "version", F.col("data").dropFields(*drop["narrative"]).alias("data")).select("entity_no", "version", "data.*")


@query(L + """SELECT table_name, study_id, sid FROM live WHERE contains(lower(name), 'of') AND (confidence IS NULL OR confidence BETWEEN 0.7 AND 0.9)
  AND entity_type IN ('narrative_content', 'objective')""")
def b13_combined_filter(spark, d):
    """Search, type and confidence filters at once; a null confidence passes the range."""
    c = F.col("confidence")
    return S.optional_filters(views.live(spark, d), F.lower("name").contains("of"), c.isNull() | c.between(0.7, 0.9), F.col("entity_type").isin("narrative_content", "objective"), None).select(*SHORT)


@query(E + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS facet, {c} AS value FROM entities WHERE {c} IS NOT NULL" for c in ("entity_type", "source_agent", "model")))
def b14_facets(spark, d):
    """Distinct values to filter by."""
    return S.facets(views.entities(spark, d), ["entity_type", "source_agent", "model"])


_EDGES = """raw AS (SELECT study_id || '/' || lower(replace(trim(id), '-', '_')) AS from_id, 'endpoint' AS rel_type, study_id || '/' || lower(replace(trim(r), '-', '_')) AS to_id
    FROM (SELECT *, unnest(data.endpointIds) AS r FROM objectives) WHERE trim(r) <> ''),
  nodes AS (SELECT DISTINCT study_id || '/' || sid AS id, entity_type FROM live WHERE table_name = 'objectives'),
  edges AS (SELECT DISTINCT r.* FROM raw r SEMI JOIN nodes a ON a.id = r.from_id SEMI JOIN nodes b ON b.id = r.to_id)"""


def _graph(spark, d):
    df = table(spark, d, "objectives")
    whole = lambda c: F.concat("study_id", F.lit("/"), same_id(c))
    raw = df.select(whole(F.col("id")).alias("from_id"), F.lit("endpoint").alias("rel_type"), F.explode("data.endpointIds").alias("r"), "study_id").where("trim(r) <> ''")
    raw = raw.select("from_id", "rel_type", whole(F.col("r")).alias("to_id"))
    nodes = views.live(spark, d, ("objectives",)).select(F.concat("study_id", F.lit("/"), "sid").alias("id"), "entity_type").distinct()
    return raw, nodes, S.valid_edges(raw, nodes)


@query(L + f", {_EDGES} SELECT from_id, rel_type, id, entity_type FROM edges JOIN nodes ON id = to_id")
def c01_related(spark, d):
    """Entities one hop away."""
    _, nodes, edges = _graph(spark, d)
    return S.related(edges, nodes, "endpoint")


@query(L + f", {_EDGES} SELECT * FROM edges")
def c02_valid_edges(spark, d):
    """Edges with both ends, once each."""
    return _graph(spark, d)[2]


@query(L + f", {_EDGES} SELECT * FROM edges e ANTI JOIN (SELECT id FROM nodes WHERE entity_type = 'endpoint' AND ends_with(id, '1')) g ON g.id = e.to_id OR g.id = e.from_id")
def c03_delete_cascade(spark, d):
    """Edges that stay after nodes are deleted."""
    _, nodes, edges = _graph(spark, d)
    return S.delete_nodes(nodes, edges, nodes.where("entity_type = 'endpoint' AND id LIKE '%1'"))[1]


@query(E + "SELECT table_name, name, arg_max(sid, entity_no * 1000 + version) AS sid FROM entities WHERE name IS NOT NULL GROUP BY ALL")
def c16_name_to_id(spark, d):
    """Name to id, the last one wins."""
    return views.entities(spark, d).where("name IS NOT NULL").groupBy("table_name", "name").agg(F.max_by("sid", F.col("entity_no") * 1000 + F.col("version")).alias("sid"))


_BP = "CAST(floor(confidence * 10000 + 0.5) AS BIGINT)"
_ST = "CASE WHEN contains(source_agent, 'vision') THEN 'vision' WHEN contains(source_agent, 'reconcil') THEN 'both' WHEN contains(source_agent, 'enrich') OR contains(source_agent, 'valid') THEN 'derived' ELSE 'text' END"


@query(L + f"""SELECT entity_type, {_ST} AS kind, count(*) AS entities, count(confidence) AS with_confidence, count(*) FILTER (confidence < 0.5) AS low, min({_BP}) AS min_bp,
  max({_BP}) AS max_bp, CAST(sum({_BP}) AS BIGINT) AS sum_bp FROM live GROUP BY ALL""")  # fmt: skip
def d01_provenance_summary(spark, d):
    """Counts and confidence by type and kind of source."""
    return P.summary(views.live(spark, d).withColumn("kind", P.source_type("source_agent")), ["entity_type", "kind"])


@query(L + f""", {_EDGES}, own AS (SELECT study_id || '/' || sid AS id, source_agent AS agent FROM live WHERE table_name = 'objectives')
  SELECT id, list_sort(list(DISTINCT agent)) AS agents FROM (SELECT * FROM own UNION ALL SELECT e.from_id, o.agent FROM edges e JOIN own o ON o.id = e.to_id) GROUP BY id""")
def d02_contributing_agents(spark, d):
    """Agents of each entity and of those it refers to."""
    own = views.live(spark, d, ("objectives",)).select(F.concat("study_id", F.lit("/"), "sid").alias("id"), F.col("source_agent").alias("agent"))
    edges = _graph(spark, d)[2]
    return P.contributing_agents(own, edges.join(own.withColumnRenamed("id", "to_id"), "to_id").select(F.col("from_id").alias("id"), "agent"))


@query(E + "SELECT entity_type, source, count(*) AS n, grouping_id(entity_type, source) AS level FROM (SELECT entity_type, coalesce(model, 'none') AS source FROM entities) GROUP BY ROLLUP (entity_type, source)")
def d03_source_stats(spark, d):
    """Counts by type and source with totals."""
    return P.source_stats(views.entities(spark, d).withColumn("source", F.coalesce("model", F.lit("none"))), ["entity_type"])


@query(E + """SELECT table_name, count(*) FILTER (model = 'orin-small') AS "orin-small", count(*) FILTER (model = 'orin-large') AS "orin-large",
  count(*) FILTER (model IS NULL OR model NOT IN ('orin-small', 'orin-large')) AS other FROM entities GROUP BY ALL""")  # fmt: skip
def d04_source_counts(spark, d):
    """A column of counts for each known source."""
    return P.source_counts(views.entities(spark, d).withColumnRenamed("model", "source"), ["table_name"], ["orin-small", "orin-large"])


@query(E + "SELECT table_name, CAST(least(4, floor(confidence * 5)) AS INT) AS bin, count(*) AS n FROM entities WHERE confidence IS NOT NULL GROUP BY ALL")
def d05_confidence_bins(spark, d):
    """Histogram of confidence."""
    return P.confidence_bins(views.entities(spark, d), ["table_name"])


@query(E + f"""SELECT coalesce(source_agent, 'unknown') AS agent, count(*) AS n, list_sort(list(DISTINCT model) FILTER (model IS NOT NULL)) AS models, min(created_at) AS first_at, max(created_at) AS last_at,
  CAST(sum({_BP}) AS BIGINT) AS sum_bp FROM entities GROUP BY ALL""")  # fmt: skip
def d06_agent_metrics(spark, d):
    """Volume, models and period of each agent."""
    bp = F.floor(F.col("confidence") * 10000 + 0.5).cast("bigint")
    return views.entities(spark, d).groupBy(F.coalesce("source_agent", F.lit("unknown")).alias("agent")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("model")).alias("models"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"), F.sum(bp).alias("sum_bp")
    )


@query(E + f"""SELECT table_name, page, count(*) AS entities, max(bp) AS max_bp, CAST(sum(bp) AS BIGINT) AS sum_bp FROM (SELECT table_name, entity_no, page, max(bp) AS bp FROM
  (SELECT table_name, entity_no, {_BP} AS bp, unnest(list_distinct(source_pages)) AS page FROM entities) GROUP BY ALL) GROUP BY ALL""")
def d07_page_groups(spark, d):
    """Entities and confidence per page."""
    return P.page_groups(views.entities(spark, d), ["table_name"])


@query(L + "SELECT study_id, entity_type, count(*) AS n, list_sort(list(sid))[1:3] AS first_ids FROM live GROUP BY ALL")
def d08_sections(spark, d):
    """Groups with their first members."""
    v, by = views.live(spark, d), ["study_id", "entity_type"]
    first = M.rank_first(v.select(*by, "table_name", "sid"), by, [F.col("sid"), F.col("table_name")], 3).groupBy(*by).agg(F.array_sort(F.collect_list("sid")).alias("first_ids"))
    return v.groupBy(*by).agg(F.count("*").alias("n")).join(first, by)


@query("SELECT study_id, count(*) AS n, count(*) FILTER (enriched) AS done, CAST(floor((count(*) FILTER (enriched) * 10000 * 2 + count(*)) / (count(*) * 2)) AS BIGINT) AS coverage_bp FROM enrichment GROUP BY ALL")
def d09_coverage(spark, d):
    """Share of enriched results per study."""
    t = table(spark, d, "enrichment").groupBy("study_id").agg(F.count("*").alias("n"), F.count_if("enriched").alias("done"))
    return t.withColumn("coverage_bp", M.percent(F.col("done"), F.col("n"), 10000))


@query("""SELECT entity_type, count(*) AS n, count(*) FILTER (error IS NOT NULL AND error <> '') AS errors, bool_and(error IS NULL OR error = '') AS valid FROM enrichment GROUP BY ALL""")
def d10_validity(spark, d):
    """Errors and validity by type."""
    bad = F.coalesce(F.col("error"), F.lit("")) != ""
    return table(spark, d, "enrichment").groupBy("entity_type").agg(F.count("*").alias("n"), F.count_if(bad).alias("errors"), F.bool_and(~bad).alias("valid"))


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (value > 0) AS good, CAST(floor((count(*) FILTER (value > 0) * 10000 * 2 + count(*)) / (count(*) * 2)) AS BIGINT) AS success_bp FROM events GROUP BY ALL""")
def d11_success_rate(spark, d):
    """Success rate by kind of event."""
    t = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 0).alias("good"))
    return t.withColumn("success_bp", M.percent(F.col("good"), F.col("n"), 10000))


@query("SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM (SELECT *, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) GROUP BY ALL")
def d12_gauges(spark, d):
    """The latest event of each user and type."""
    return M.last_value_by(table(spark, d, "events").withColumn("o", F.struct("ts", "event_id")), ["user_id", "event_type"], "event_id", "o")


@query("SELECT agent_id, entity_type, count(*) AS n, CAST(sum(length(payload)) AS BIGINT) AS chars, grouping_id(agent_id, entity_type) AS level FROM agent_files GROUP BY ROLLUP (agent_id, entity_type)")
def d13_usage_by_phase(spark, d):
    """Use by phase with totals."""
    return table(spark, d, "agent_files").rollup("agent_id", "entity_type").agg(F.count("*").alias("n"), F.sum(F.length("payload")).alias("chars"), F.grouping_id().alias("level"))


@query("SELECT l_linenumber AS wave, max(l_quantity) AS longest, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY ALL")
def d14_wave_times(spark, d):
    """A wave takes as long as its longest member."""
    return table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("wave")).agg(F.max("l_quantity").alias("longest"), F.sum(F.col("l_quantity").cast("bigint")).alias("total"))


_ERR = "(SELECT *, " + "{lad}" + " AS category FROM enrichment WHERE coalesce(error, '') <> '')"
@query("SELECT dimension, value, count(*) AS n FROM (SELECT unnest([{'dimension': 'category', 'value': category}, {'dimension': 'entity_type', 'value': entity_type}, {'dimension': 'source', 'value': source}], recursive := true) FROM "
       + _ERR.replace("{lad}", Q.ladder("error", ERROR_CATEGORY)) + ") GROUP BY ALL")
def d15_error_report(spark, d):
    """Errors by category, type and source in one pass."""
    df = table(spark, d, "enrichment").where("coalesce(error, '') <> ''").withColumn("category", ERROR_CATEGORY.column("error"))
    return M.by_each(df, ["category", "entity_type", "source"], n=F.count("*"))


@query(E + r"""SELECT table_name, CASE WHEN regexp_matches(id, '^[0-9a-f-]{36}$') THEN 'uuid' WHEN regexp_matches(id, '^[a-z]+_\d+$') THEN 'simple' WHEN regexp_matches(id, '^[a-z]+(_\d+)+$') THEN 'nested' ELSE 'other' END AS form, count(*) AS n FROM entities GROUP BY ALL""")
def d17_id_formats(spark, d):
    """Ids by their form."""
    i = F.col("id")
    form = F.when(i.rlike("^[0-9a-f-]{36}$"), "uuid").when(i.rlike(r"^[a-z]+_\d+$"), "simple").when(i.rlike(r"^[a-z]+(_\d+)+$"), "nested").otherwise("other")
    return views.entities(spark, d).groupBy("table_name", form.alias("form")).agg(F.count("*").alias("n"))


@query("SELECT data.level.codeSystem AS code_system, count(*) AS n FROM objectives WHERE data.level.code IS NOT NULL GROUP BY ALL")
def d18_code_systems(spark, d):
    """Codes by code system."""
    return table(spark, d, "objectives").where("data.level.code IS NOT NULL").groupBy(F.col("data.level.codeSystem").alias("code_system")).agg(F.count("*").alias("n"))


@query("""WITH g AS (SELECT entity_type, count(*) AS n FROM narrative GROUP BY ALL), t AS (SELECT entity_type, count(*) AS n FROM narrative_mirror GROUP BY ALL)
  SELECT entity_type, g.n AS golden, t.n AS test, CASE WHEN g.n = 0 THEN CASE WHEN t.n = 0 THEN 'N/A' ELSE 'Extra' END ELSE CAST(floor((t.n * 200 + g.n) / (g.n * 2)) AS BIGINT) || '%' END AS share FROM g JOIN t USING (entity_type)""")
def d20_object_counts(spark, d):
    """Counts on both sides and their ratio as text (with d21)."""
    n = lambda t, c: table(spark, d, t).groupBy("entity_type").agg(F.count("*").alias(c))
    return n("narrative", "golden").join(n("narrative_mirror", "test"), "entity_type").withColumn("share", M.percent_label(F.col("test"), F.col("golden")))


@query("""SELECT file_no, count(*) AS raw, count(*) FILTER (json_valid(payload)) AS parsed, count(*) - count(*) FILTER (json_valid(payload)) AS gap FROM agent_files GROUP BY ALL HAVING gap > 0""")
def d22_gaps(spark, d):
    """Files with fewer readable than delivered records."""
    t = table(spark, d, "agent_files").groupBy("file_no").agg(F.count("*").alias("raw"), F.count_if(F.try_parse_json("payload").isNotNull()).alias("parsed"))
    return t.withColumn("gap", F.col("raw") - F.col("parsed")).where("gap > 0")


@query("""SELECT entity_no, version, CAST(floor(((coalesce(data.name, '') <> '')::INT + (coalesce(data.text, '') <> '')::INT + (coalesce(data.purpose, '') <> '')::INT) * 6000 / 3)
  + CASE WHEN length(data.text) > 50 THEN 4000 ELSE 0 END AS BIGINT) AS confidence_bp FROM objectives""")
def d23_completeness(spark, d):
    """Confidence from completeness and quality."""
    return table(spark, d, "objectives").select("entity_no", "version", M.completeness([F.col("data.name"), F.col("data.text"), F.col("data.purpose")], F.coalesce(F.length("data.text") > 50, F.lit(False))).alias("confidence_bp"))


@query(E + f"""SELECT DISTINCT table_name, entity_no, version, CAST(greatest(0, least(10000, floor({_BP} * CASE {_ST} WHEN 'both' THEN 100 WHEN 'vision' THEN 85 WHEN 'text' THEN 80 WHEN 'derived' THEN 70 ELSE 75 END / 100)
  + CASE WHEN version > 1 THEN least(1000, 200 * (version - 1)) ELSE 0 END)) AS BIGINT) AS confidence_bp FROM entities WHERE confidence IS NOT NULL""")
def d24_aggregate_confidence(spark, d):
    """Confidence weighted by source and number of contributions."""
    bp = P.aggregate_confidence_bp(F.col("confidence"), P.source_type("source_agent"), F.col("version"))
    return views.entities(spark, d).where("confidence IS NOT NULL").select("table_name", "entity_no", "version", bp.alias("confidence_bp")).distinct()


@query(E + "SELECT table_name, CAST(sum(n - 1) AS BIGINT) AS merged FROM (SELECT table_name, study_id, sid, count(*) AS n FROM entities GROUP BY ALL) GROUP BY ALL")
def d26_merged_rows(spark, d):
    """Rows that merging takes away."""
    return views.entities(spark, d).groupBy(*SHORT).agg(F.count("*").alias("n")).groupBy("table_name").agg(F.sum(F.col("n") - 1).alias("merged"))


@query(L + "SELECT entity_type, count(*) AS n, count(DISTINCT study_id) AS studies FROM live GROUP BY ALL")
def d27_type_counts(spark, d):
    """Live entities by type."""
    return views.live(spark, d).groupBy("entity_type").agg(F.count("*").alias("n"), F.count_distinct("study_id").alias("studies"))


@query("WITH g AS (SELECT DISTINCT study_id, lower(replace(trim(id), '-', '_')) AS sid FROM narrative), t AS (SELECT DISTINCT study_id, lower(replace(trim(id), '-', '_')) AS sid FROM narrative_mirror), "
       """c AS (SELECT coalesce(g.study_id, t.study_id) AS study_id, count(g.sid) AS golden, count(t.sid) AS extracted, count(*) FILTER (g.sid IS NOT NULL AND t.sid IS NOT NULL) AS matched
         FROM g FULL JOIN t ON g.study_id = t.study_id AND g.sid = t.sid GROUP BY 1)
       SELECT study_id, golden, extracted, matched, CAST(CASE WHEN extracted = 0 THEN 0 ELSE floor((matched * 20000 + extracted) / (extracted * 2)) END AS BIGINT) AS precision_bp,
         CAST(CASE WHEN golden = 0 THEN 10000 ELSE floor((matched * 20000 + golden) / (golden * 2)) END AS BIGINT) AS recall_bp,
         CAST(CASE WHEN matched = 0 THEN 0 ELSE floor((matched * 40000 + golden + extracted) / ((golden + extracted) * 2)) END AS BIGINT) AS f1_bp FROM c""")  # fmt: skip
def d30_precision_recall(spark, d):
    """Precision, recall and F1 of one copy against the other."""
    side = lambda t, c: table(spark, d, t).select("study_id", same_id("id").alias("sid")).distinct().withColumn(c, F.col("sid"))
    m = side("narrative", "golden_id").join(side("narrative_mirror", "extracted_id"), ["study_id", "sid"], "full_outer")
    return M.precision_recall(m, ["study_id"])


@query("""WITH g AS (SELECT study_id, list(DISTINCT data.name) AS a FROM narrative WHERE data.name IS NOT NULL GROUP BY 1), t AS (SELECT study_id, list(DISTINCT data.name) AS b FROM narrative_mirror WHERE data.name IS NOT NULL GROUP BY 1)
  SELECT study_id, CAST(floor((len(list_intersect(a, b)) * 20000 + len(list_distinct(list_concat(a, b)))) / (len(list_distinct(list_concat(a, b))) * 2)) AS BIGINT) AS score_bp FROM g JOIN t USING (study_id)""")
def d31_set_overlap(spark, d):
    """Overlap of the name sets of two copies."""
    s = lambda t, c: table(spark, d, t).where("data.name IS NOT NULL").groupBy("study_id").agg(F.collect_set("data.name").alias(c))
    return s("narrative", "a").join(s("narrative_mirror", "b"), "study_id").select("study_id", M.overlap_score(F.col("a"), F.col("b")).alias("score_bp"))


@query("""WITH g AS (SELECT study_id, count(*) AS e FROM narrative GROUP BY 1), t AS (SELECT study_id, count(*) AS a FROM narrative_mirror GROUP BY 1)
  SELECT study_id, e, a, CAST(greatest(0, floor(((e - abs(e - a)) * 20000 + e) / (e * 2))) AS BIGINT) AS score_bp FROM g JOIN t USING (study_id)""")
def d32_count_closeness(spark, d):
    """How close the counts of two copies are."""
    n = lambda t, c: table(spark, d, t).groupBy("study_id").agg(F.count("*").alias(c))
    return n("narrative", "e").join(n("narrative_mirror", "a"), "study_id").withColumn("score_bp", M.count_score(F.col("e"), F.col("a")))


@query(L + "SELECT study_id, sid FROM live WHERE table_name = 'objectives' AND entity_type = 'endpoint' EXCEPT SELECT study_id, lower(replace(trim(r), '-', '_')) FROM (SELECT study_id, unnest(data.endpointIds) AS r FROM objectives)")
def h03_orphans(spark, d):
    """Endpoints that nothing refers to."""
    ends = views.live(spark, d, ("objectives",)).where("entity_type = 'endpoint'").select("study_id", "sid")
    used = table(spark, d, "objectives").select("study_id", F.explode("data.endpointIds").alias("r")).select("study_id", same_id("r").alias("sid"))
    return ends.join(used.distinct(), ["study_id", "sid"], "left_anti")


@query("SELECT DISTINCT k.key AS extra FROM agent_files, json_each(payload) k WHERE json_valid(payload) AND k.key NOT IN ('id', 'name', 'text', 'level')")
def h04_extra_keys(spark, d):
    """Top-level keys outside the allowed ones."""
    keys = table(spark, d, "agent_files").where(F.try_parse_json("payload").isNotNull()).select(F.explode(F.array_except(F.json_object_keys("payload"), F.array(*map(F.lit, ["id", "name", "text", "level"])))).alias("extra"))
    return keys.distinct()


@query("SELECT count(DISTINCT list_sort(data.endpointIds)) AS different, count(*) AS n FROM objectives WHERE data.endpointIds IS NOT NULL AND NOT list_contains([x IS NULL for x in data.endpointIds], true)")
def h05_canonical_sets(spark, d):
    """Different reference lists when order doesn't count."""
    df = table(spark, d, "objectives").where("data.endpointIds IS NOT NULL AND NOT exists(data.endpointIds, x -> x IS NULL)")
    return df.agg(F.count_distinct(F.to_json(F.array_sort("data.endpointIds"))).alias("different"), F.count("*").alias("n"))


@query(E + "SELECT DISTINCT entity_type, sid FROM entities WHERE source_agent = 'soa_vision_agent'")
def h06_ids_by_source(spark, d):
    """Ids that came from one source."""
    return views.entities(spark, d).where("source_agent = 'soa_vision_agent'").select("entity_type", "sid").distinct()


@query("""SELECT 'both' AS side, count(*) AS n FROM (SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative INTERSECT SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative_mirror)
  UNION ALL SELECT 'left', count(*) FROM (SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative EXCEPT SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative_mirror)
  UNION ALL SELECT 'right', count(*) FROM (SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative_mirror EXCEPT SELECT study_id, lower(replace(trim(id), '-', '_')) FROM narrative)""")
def h07_id_sets(spark, d):
    """Ids in both copies and in one only."""
    a, b = (table(spark, d, t).select("study_id", same_id("id").alias("sid")) for t in ("narrative", "narrative_mirror"))
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("side"), "n") for k, df in (("both", a.intersect(b)), ("left", a.subtract(b)), ("right", b.subtract(a)))]
    return reduce(DataFrame.unionByName, parts)


@query("""WITH c AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, arg_max(data.name, version) AS name, arg_max(data.text, version) AS text, max(version) AS version FROM narrative GROUP BY 1, 2),
  n AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, arg_max(data.name, version) AS name, arg_max(data.text, version) AS text FROM (SELECT * FROM narrative_mirror ) GROUP BY 1, 2)
  SELECT coalesce(c.study_id, n.study_id) AS study_id, coalesce(c.sid, n.sid) AS sid, coalesce(n.name, c.name) AS name, coalesce(n.text, c.text) AS text, coalesce(c.version, 0) + (n.sid IS NOT NULL)::INT AS version
  FROM c FULL JOIN n ON c.study_id = n.study_id AND c.sid = n.sid""".replace("arg_max(", "arg_max_null("))  # fmt: skip
def n01_upsert(spark, d):
    """The narrative table after the mirror's rows are laid over it (with n03)."""
    last = lambda t: table(spark, d, t).groupBy("study_id", same_id("id").alias("sid")).agg(F.max_by(F.struct("data.name", "data.text"), "version").alias("h"), F.max("version").alias("version")).select("study_id", "sid", "h.name", "h.text", "version")
    return S.upsert(last("narrative"), last("narrative_mirror"), ["study_id", "sid"], ["name", "text"])


@query("""WITH k AS (SELECT DISTINCT study_id, lower(replace(trim(id), '-', '_')) AS sid FROM narrative), r AS (SELECT study_id, lower(replace(trim(id), '-', '_')) AS sid, pos, version, is_deleted,
  row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version, pos, is_deleted) AS rn FROM narrative_mirror)
  SELECT r.study_id, r.sid, r.version FROM r ANTI JOIN k USING (study_id, sid) WHERE rn = 1""")
def n02_insert_new(spark, d):
    """Rows whose key isn't stored yet, the first of each."""
    rows = table(spark, d, "narrative_mirror").select("study_id", same_id("id").alias("sid"), "version", "pos", "is_deleted")
    known = table(spark, d, "narrative").select("study_id", same_id("id").alias("sid"))
    return S.insert_new(known, rows, ["study_id", "sid"], ["version", "pos", "is_deleted"])[0].select("study_id", "sid", "version")


@query("SELECT user_id, event_id, ts FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def n07_filtered_poll(spark, d):
    """The next message of one type for each receiver."""
    return M.rank_first(table(spark, d, "events").where("event_type = 'click'"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "ts")


@query("SELECT event_id, CAST(floor(value) AS BIGINT) % 5 AS retries, CASE WHEN CAST(floor(value) AS BIGINT) % 5 < 3 THEN 'retry' ELSE 'dead' END AS fate FROM events WHERE value IS NOT NULL")
def n08_retry_or_dead(spark, d):
    """Messages to try again and those given up."""
    n = F.floor("value").cast("bigint") % 5
    return table(spark, d, "events").where("value IS NOT NULL").select("event_id", n.alias("retries"), F.when(n < 3, "retry").otherwise("dead").alias("fate"))


@query("SELECT user_id, count(*) AS pending FROM events GROUP BY ALL")
def n09_pending(spark, d):
    """Messages waiting for each receiver."""
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("pending"))


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def n10_log_tail(spark, d):
    """The last 50 messages."""
    return table(spark, d, "events").select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(50)


@query("SELECT user_id, max(ts) AS last_used FROM events GROUP BY 1 ORDER BY last_used DESC, user_id LIMIT 20")
def n11_recently_used(spark, d):
    """The keys that were used last."""
    return table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_used")).orderBy(F.desc("last_used"), "user_id").limit(20)


@query("SELECT event_id FROM events, (SELECT max(ts) AS now FROM events) WHERE event_id % 7 = 0 OR epoch(now) - epoch(ts) < 86400")
def n12_unexpired(spark, d):
    """Entries within their time to live; some never expire (with n14)."""
    e = table(spark, d, "events")
    now = e.agg(F.max("ts").alias("now"))
    with_now = e.join(F.broadcast(now))  # one row
    return S.fresh(with_now, F.col("now"), F.col("ts"), F.when(F.col("event_id") % 7 != 0, 86400)).select("event_id")


@query("SELECT result_no, substr(sha256(concat_ws('|', coalesce(entity_type, ''), coalesce(entity_name, ''))), 1, 16) AS key FROM enrichment")
def n13_cache_key(spark, d):
    """Keys of cached lookups."""
    return table(spark, d, "enrichment").select("result_no", S.cache_key(F.col("entity_type"), F.col("entity_name")).alias("key"))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 3")
def g09_delete_old(spark, d):
    """All but the three newest entries of each key (with n16)."""
    return S.newest(table(spark, d, "events"), 3, [F.desc("ts"), F.desc("event_id")], ["user_id"])[1].select("user_id", "event_id")


@query("SELECT source, count(*) AS n, count(*) FILTER (coalesce(error, '') = '') AS ready FROM enrichment GROUP BY ALL")
def n21_health(spark, d):
    """Ready and failed by kind."""
    return table(spark, d, "enrichment").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.coalesce("error", F.lit("")) == "").alias("ready"))
