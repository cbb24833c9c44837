"""Queries of the operators for training text (problems 2, 4, 7, 8 and 9)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.llm import canonical, leakage, mixing, splitting
from tessera.llm.near_dup import NearDuplicates
from tessera.operators.live import live_entities
from tessera.plans.runtime import bounded_rows, materialize, table


def _entity_texts(spark, d):
    """Current texts of live narrative and objective records that can have 20 words."""
    text = F.when(F.length("data.text") >= 39, F.col("data.text"))
    parts = [
        live_entities(table(spark, d, t), {"id": F.col("entity_no"), "text": text}).where("text IS NOT NULL").select("id", "text")
        for t in ("narrative", "objectives")
    ]
    return materialize(parts[0].unionByName(parts[1]))


def _entity_duplicates(spark, d):
    return NearDuplicates(_entity_texts(spark, d), threshold=0.7, min_words=20)


def p2_found(spark, d):
    """Pairs of near-copies over narrative and objective records."""
    return _entity_duplicates(spark, d).pairs().select(F.col("a").alias("entity_no_a"), F.col("b").alias("entity_no_b"))


def p2_classes(spark, d):
    """Each record with its class of equal bags and its number of links."""
    return _entity_duplicates(spark, d).classes().withColumnRenamed("id", "entity_no")


def p4_found(spark, d):
    """The concept that each free-typed term means, or that there is none."""
    return canonical.map_results(table(spark, d, "enrichment"), table(spark, d, "concepts")).select("result_no", "code")


def p4_terms(spark, d):
    """Each mapped term with its concept, score and number of results."""
    found = canonical.map_results(table(spark, d, "enrichment"), table(spark, d, "concepts"))
    return found.groupBy("term", "code", "score").agg(F.count("*").alias("results"))


def p4_repairs(spark, d):
    """Each word of the typed names with every word of a concept's name within its allowed edits."""
    words = table(spark, d, "enrichment").select(F.explode(F.regexp_extract_all(F.lower("entity_name"), F.lit("[a-z0-9]+"), F.lit(0))).alias("token"))
    names = table(spark, d, "concepts").select("code", "name", F.lit(None).cast("array<string>").alias("synonyms"))
    return canonical.repaired_tokens(words, names)


def p7_found(spark, d):
    """Documents that hold held-out items."""
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_items(spark, d):
    """Each held-out item with the number of documents it leaked into."""
    return leakage.leaked_items(p7_found(spark, d), table(spark, d, "eval_items"))


def p8_mix(spark, d):
    """The chosen texts and how often each is used."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark, d):
    """Wanted and actual share of each source."""
    targets = table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, d, "documents"), targets), targets)


def p8_checks(spark, d):
    """Whether each source with texts keeps its cap, its distinct texts and, within 0.04, its share, with shards of few texts."""
    documents, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    chosen = mixing.mix(documents, targets, shard_tokens=20_000)
    known = documents.where("trim(text) <> ''").select("doc_id", F.md5("text").alias("text")).distinct()
    used = chosen.join(known, "doc_id").join(targets.select("source", "max_repeats"), "source")
    kept = used.groupBy("source").agg((F.max("repeats") <= F.max("max_repeats")).alias("cap_kept"), (F.count("*") == F.count_distinct("text")).alias("texts_distinct"))
    got = mixing.shares(chosen, targets.join(kept, "source", "left_semi"))
    near = F.abs(F.col("actual_share") - F.col("target_share") / F.sum("target_share").over(Window.partitionBy())) < 0.04
    return got.select("source", near.alias("share_met")).join(kept, "source")


def p8_quotas(spark, d):
    """Blocks of 512 characters that each source is given."""
    rows = table(spark, d, "documents").where("source IS NOT NULL AND doc_id IS NOT NULL AND trim(text) <> ''")
    one = rows.groupBy("text").agg(F.min(F.struct("doc_id", "source")).alias("r")).select("r.source", F.length("text").cast("long").alias("n"))
    have = {r["source"]: r["n"] for r in bounded_rows(one.groupBy("source").agg(F.sum("n").alias("n")))}
    blocks = mixing.source_blocks(have, mixing.wanted_shares(table(spark, d, "mix_targets")), None, 512)
    return spark.createDataFrame(sorted(blocks.items()), "source string, blocks bigint")


def p9_checks(spark, d):
    """Whether the pieces of each text that must be cut are within the limit, overlap as asked and give the text again."""
    documents, limits = table(spark, d, "documents"), table(spark, d, "split_limits")
    must = documents.where("text IS NOT NULL").select("doc_id", F.size(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("least")).join(F.broadcast(limits), F.col("least") > F.col("max_tokens"))
    pieces = splitting.split_documents(documents, limits).distinct()
    before = F.coalesce(F.lag("char_end").over(Window.partitionBy("doc_id", "limit_no").orderBy("piece_no")), F.lit(0))
    parts = pieces.withColumn("before", before).join(limits, "limit_no")
    again = F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", F.expr("substring(piece, cast(before - char_start + 1 AS int))").alias("p")))), lambda x: x["p"]), ""))
    overlap = F.bool_and((F.col("piece_no") == 0) | (F.col("shared_tokens") == F.col("overlap_tokens")))
    found = parts.groupBy("doc_id", "limit_no").agg((F.max(F.col("n_tokens") - F.col("max_tokens")) <= 0).alias("within_limit"), overlap.alias("overlap_kept"), F.count("exception").alias("exceptions"), again.alias("text_md5"))
    return must.select("doc_id", "limit_no").join(found, ["doc_id", "limit_no"], "left")


def p9_pieces(spark, d):
    """The pieces of each document over a limit, for every set of limits."""
    return splitting.split_documents(table(spark, d, "documents"), table(spark, d, "split_limits"))


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p4_found": p4_found, "p4_terms": p4_terms, "p7_found": p7_found, "p7_items": p7_items, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_pieces": p9_pieces, "p4_repairs": p4_repairs, "p8_checks": p8_checks, "p8_quotas": p8_quotas, "p9_checks": p9_checks}
_CLEAN = r"regexp_extract_all(lower(regexp_replace(text, '[\x{00AD}\x{200B}]|-(?:\r\n|\n)', '', 'g')), '[a-z0-9]+')"
_P7 = f"""WITH c AS (SELECT doc_id, {_CLEAN} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_CLEAN} AS w FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS s FROM c, unnest(range(1, len(w) - 10)) t(k) WHERE len(w) >= 12),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS s FROM i, unnest(range(1, len(w) - 10)) t(k) WHERE len(w) >= 12),
found AS (SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (s)
  UNION SELECT doc_id, item_id FROM c JOIN i ON len(i.w) BETWEEN 1 AND 11 AND contains(' ' || array_to_string(c.w, ' ') || ' ', ' ' || array_to_string(i.w, ' ') || ' '))
"""
_CURRENT = """(SELECT entity_no, data.text AS text FROM (SELECT *, row_number() OVER (PARTITION BY study_id, lower(replace(trim(id), '-', '_')) ORDER BY version DESC) AS rn FROM {}) WHERE rn = 1 AND NOT is_deleted)"""
_P2 = f"""WITH e AS (SELECT entity_no, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (SELECT * FROM {_CURRENT.format('narrative')} UNION ALL SELECT * FROM {_CURRENT.format('objectives')}) WHERE text IS NOT NULL),
x AS (SELECT entity_no, word, row_number() OVER (PARTITION BY entity_no, word) AS occ, n FROM (SELECT entity_no, unnest(w) AS word, len(w) AS n FROM e WHERE len(w) >= 20)),
df AS (SELECT word, occ, count(*) AS df FROM x GROUP BY ALL),
p AS (SELECT entity_no, word, occ, n FROM (SELECT x.*, row_number() OVER (PARTITION BY entity_no ORDER BY df, word, occ) AS r FROM x JOIN df USING (word, occ)) WHERE r <= n - ceil(n * 0.7 - 1e-9) + 1),
c AS (SELECT DISTINCT a.entity_no AS a, b.entity_no AS b, a.n + b.n AS n FROM p a JOIN p b USING (word, occ) WHERE a.entity_no < b.entity_no AND 10 * least(a.n, b.n) >= 7 * greatest(a.n, b.n)),
s AS (SELECT c.a, c.b, c.n, count(*) AS shared FROM c JOIN x l ON l.entity_no = c.a JOIN x r ON r.entity_no = c.b AND r.word = l.word AND r.occ = l.occ GROUP BY ALL)
SELECT a AS entity_no_a, b AS entity_no_b FROM s WHERE 10 * shared >= 7 * (n - shared)"""
_P2_CLASSES = _P2.replace("SELECT a AS entity_no_a, b AS entity_no_b FROM s", """,
k AS (SELECT entity_no, array_to_string(list_sort(w), ' ') AS bag FROM e WHERE len(w) >= 20),
m AS (SELECT entity_no, min(entity_no) OVER (PARTITION BY bag) AS class_id, count(*) OVER (PARTITION BY bag) AS copies FROM k),
d AS (SELECT a, b FROM s WHERE 10 * shared >= 7 * (n - shared) UNION ALL SELECT b, a FROM s""", 1) + """),
o AS (SELECT d.a, count(*) AS links FROM d JOIN m x ON x.entity_no = d.a JOIN m y ON y.entity_no = d.b WHERE x.class_id <> y.class_id GROUP BY 1)
SELECT m.entity_no, class_id, copies, coalesce(links, 0) AS links FROM m LEFT JOIN o ON o.a = m.entity_no"""
ORACLES: dict[str, str] = {
    "p2_found": _P2,
    "p2_classes": _P2_CLASSES,
    "p4_repairs": """WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(entity_name), '[a-z0-9]+')) AS token FROM enrichment),
v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) AS word FROM concepts),
m AS (SELECT token, word, damerau_levenshtein(token, word) AS edits FROM t, v WHERE abs(length(token) - length(word)) <= 2)
SELECT token, word, edits::INT AS edits FROM m WHERE edits <= CASE WHEN length(word) < 3 THEN 0 WHEN length(word) < 7 THEN 1 ELSE 2 END""",
    "p8_quotas": """WITH one AS (SELECT DISTINCT ON (text) source, length(text) AS n FROM documents WHERE source IS NOT NULL AND doc_id IS NOT NULL AND trim(text) <> '' ORDER BY text, doc_id, source),
w AS (SELECT source, max(target_share) AS share, max(max_repeats) AS times FROM mix_targets GROUP BY 1),
h AS (SELECT source, sum(n) * times AS room, share FROM one JOIN w USING (source) WHERE share > 0 AND times > 0 GROUP BY source, times, share),
t AS (SELECT greatest(1, round(min(floor(room * (SELECT sum(share) FROM w) / share)) / 512))::BIGINT AS seats FROM h),
q AS (SELECT source, share / (2 * j + 1) AS quotient FROM h, t, unnest(range(0, least(greatest(1, room // 512), seats)::BIGINT)) r(j)),
taken AS (SELECT source, row_number() OVER (ORDER BY quotient DESC, source) AS place FROM q)
SELECT h.source, count(place) AS blocks FROM h LEFT JOIN (SELECT * FROM taken WHERE place <= (SELECT seats FROM t)) USING (source) GROUP BY 1""",
    "p8_checks": "SELECT DISTINCT source, true AS share_met, true AS cap_kept, true AS texts_distinct FROM mix_targets m WHERE target_share > 0 AND max_repeats > 0 AND EXISTS (SELECT 1 FROM documents d WHERE d.source = m.source AND trim(text) <> '')",
    "p9_checks": """SELECT doc_id, limit_no, true AS within_limit, true AS overlap_kept, 0::BIGINT AS exceptions, md5(text) AS text_md5
FROM documents, split_limits WHERE len(regexp_extract_all(lower(text), '[a-z0-9]+')) > max_tokens""",
    "p7_found": _P7 + "SELECT doc_id, item_id FROM found",
    "p7_items": _P7 + "SELECT item_id, topic, coalesce(n, 0) AS documents FROM eval_items LEFT JOIN (SELECT item_id, count(*) AS n FROM found GROUP BY 1) USING (item_id)",
}
