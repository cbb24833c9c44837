"""Schemas that drift between files: fused types, one table, a list of changes.

Payloads are parsed and taken apart inside the JVM, as variants. What each file
holds is folded to one row per file and field while it is read, so no cells are
laid out but those of the few fields that may have been renamed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.runtime import bounded_rows, materialize

#: JSON types as bits of a tag, in the order of their branches.
TYPES = {"string": 1, "number": 2, "boolean": 4, "object": 8, "array": 16}
GROUP = ["study_id", "agent_id", "entity_type"]
#: Ends the list that a payload is put into; see :func:`readable`.
_END = "end-of-payload-9f4b3c"


def readable(rows: DataFrame, payload: str = "payload", name: str = "doc") -> DataFrame:
    """``rows`` whose payload is one valid JSON value and nothing else, with that value as a variant in ``name`` instead.

    The parser ignores what follows a value, so the payload is read as the
    first member of a list that must end with the mark right after it. Of
    repeated keys the last one counts. The list comes out of a generator, so
    that no filter on it makes the optimizer parse twice.
    """
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    both = F.try_parse_json(F.concat(F.lit("["), F.col(payload), F.lit(f',"{_END}"]')))
    rest = [c for c in rows.columns if c != payload]
    listed = rows.select(*rest, F.explode(F.array(both)).alias("__both"))
    ended = (F.try_variant_get("__both", "$[1]", "string") == _END) & F.variant_get("__both", "$[2]", "variant").isNull()
    return listed.where(ended).select(*rest, F.variant_get("__both", "$[0]", "variant").alias(name))


def tag_of(shape: str) -> Column:
    """The type of a variant as a bit of a tag, 0 for null, from its schema in column ``shape``."""
    s = F.col(shape)
    return F.when(s == "STRING", 1).when(s == "VOID", 0).when(s == "BOOLEAN", 4).when(s.startswith("OBJECT"), 8).when(s.startswith("ARRAY"), 16).otherwise(2)


def _records(files: DataFrame, *columns: str) -> DataFrame:
    return readable(files.select(*columns, "payload"))


def _members(rows: DataFrame, doc: str) -> DataFrame:
    """``rows`` with (pos, key, value) of each member of an object or array; one row with nulls where there is none."""
    return rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col(doc).outer()))


def file_fields(files: DataFrame) -> DataFrame:
    """What each file holds: (study_id, agent_id, entity_type, file_no, field, tag, n, first_ts, last_ts), written.

    One row per file and top-level key with a non-null value, the alternatives
    of its type fused into ``tag``, and one with a null field for each file
    that has readable records. Payloads that are not valid JSON give none.
    """
    rows = _members(_records(files, *GROUP, "file_no", "file_ts"), "doc")
    # members of arrays have no key, and nothing but null has a value of type VOID
    shape = F.when(F.col("key").isNotNull(), F.schema_of_variant("value")).otherwise("VOID")
    rows = rows.select(*GROUP, "file_no", "file_ts", F.when(~F.is_variant_null("value"), F.col("key")).alias("field"), shape.alias("shape"))
    return materialize(
        rows.withColumn("tag", tag_of("shape"))
        .groupBy(*GROUP, "file_no", "field")
        .agg(F.bit_or("tag").alias("tag"), F.count("*").alias("n"), F.min("file_ts").alias("first_ts"), F.max("file_ts").alias("last_ts"))
    )


def _previous_files(fields: DataFrame) -> DataFrame:
    """(study_id, agent_id, entity_type, file_no, before): each file and the latest earlier one of its line.

    Files of one ``file_ts`` all have the same predecessor, the highest
    ``file_no`` of the latest earlier time. Files without time take no part.
    """
    files = fields.groupBy(*GROUP, "file_no").agg(F.max("last_ts").alias("file_ts")).where("file_ts IS NOT NULL")
    times = files.groupBy(*GROUP, "file_ts").agg(F.max("file_no").alias("last"))
    before = F.lag("last").over(Window.partitionBy(*GROUP).orderBy("file_ts")).alias("before")
    earlier = times.select(*GROUP, "file_ts", before).where("before IS NOT NULL")
    return files.join(earlier, [*GROUP, "file_ts"]).select(*GROUP, "file_no", "before")


def _sides(pairs: DataFrame) -> DataFrame:
    """(*GROUP, file_no, later, side): side 'b' is the later file of a pair itself, 'a' its predecessor."""
    pair = F.explode(F.array(F.struct(F.col("file_no"), F.col("file_no").alias("later"), F.lit("b").alias("side")), F.struct(F.col("before").alias("file_no"), F.col("file_no").alias("later"), F.lit("a").alias("side"))))
    return pairs.select(*GROUP, pair.alias("x")).select(*GROUP, "x.*")


def changes(files: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """Schema changes against the preceding file: (study_id, agent_id, entity_type, file_no, field, change, old_field, old_types, new_types).

    ``removed``, ``added``, ``type`` or ``renamed``, the last under the new key
    with the old one beside it. A removed and an added field are one renaming
    when their values agree in every record that both files hold and one such
    record has a value: each field is reduced to a count and the exclusive or
    of its (record, value) digests, and equal reductions join, so no pairs of
    records or fields are ever laid out. Only the values of removed and added
    fields are read for that, in files that have both. ``fields`` are those of
    :func:`file_fields`, if there already. Rows with a null study, agent, type
    or file number take part in no comparison.
    """
    key = [*GROUP, "file_no"]
    fields = (file_fields(files) if fields is None else fields).where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in key)))
    pairs = materialize(_previous_files(fields))
    held = fields.where("field IS NOT NULL").select(*key, "field", "tag")
    old, new = (F.max(F.when(F.col("side") == s, F.col("tag"))) for s in ("a", "b"))
    sides = (
        held.join(_sides(pairs), key).groupBy(*GROUP, F.col("later").alias("file_no"), "field").agg(old.alias("old"), new.alias("new"))
    )
    change = F.when(F.col("new").isNull(), "removed").when(F.col("old").isNull(), "added").when(F.col("old") != F.col("new"), "type")
    found = materialize(sides.withColumn("change", change).where("change IS NOT NULL"))

    kinds = F.bit_or(F.when(F.col("change") == "removed", 1).when(F.col("change") == "added", 2).otherwise(0))
    open_files = found.groupBy(*key).agg(kinds.alias("m")).where("m = 3").drop("m")
    link = _sides(pairs.join(open_files, key, "left_semi"))
    later = [*GROUP, "later"]
    seen = materialize(_records(files.join(link.select(*key).distinct(), key, "left_semi"), *key, "record_id").join(link, key).drop("file_no"))
    shared = seen.groupBy(*later, "record_id").agg((F.bool_or(F.col("side") == "a") & F.bool_or(F.col("side") == "b")).alias("both")).where("both").drop("both")
    wanted = found.where("change <> 'type'").select(*GROUP, F.col("file_no").alias("later"), "field", F.when(F.col("change") == "removed", "a").otherwise("b").alias("side"))
    text = F.to_json("value")
    values = (
        _members(seen.where("record_id IS NOT NULL"), "doc")
        .where("key IS NOT NULL AND NOT is_variant_null(value)")
        .select(*later, "side", F.col("key").alias("field"), "record_id", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))
        .join(wanted, [*later, "field", "side"], "left_semi")
        .distinct()
        .join(shared, [*later, "record_id"], "left_semi")
    )
    shape = values.groupBy(*later, "side", "field").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("record_id", "h1", "h2")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "record_id", "h2", "h1")).alias("x2"),
    )
    shape = materialize(shape.withColumnRenamed("later", "file_no"))
    olds = shape.where("side = 'a'").select(*key, "n", "x1", "x2", F.col("field").alias("old_field"))
    news = shape.where("side = 'b'").select(*key, "n", "x1", "x2", "field")
    renamed = materialize(news.join(olds, [*key, "n", "x1", "x2"]).select(*key, "field", "old_field"))

    gone = renamed.select(*key, F.explode(F.array(F.struct(F.col("old_field").alias("field"), F.lit("removed").alias("change")), F.struct(F.col("field"), F.lit("added").alias("change")))).alias("x")).select(*key, "x.*")
    rest = found.join(gone, [*key, "field", "change"], "left_anti").select(
        *key, "field", "change", F.lit(None).cast("string").alias("old_field"), _names(F.col("old")).alias("old_types"), _names(F.col("new")).alias("new_types")
    )
    moved = renamed.select(
        *key, "field", F.lit("renamed").alias("change"), "old_field", F.array().cast("array<string>").alias("old_types"), F.array().cast("array<string>").alias("new_types")
    )
    return rest.unionByName(moved)


def _names(tag: Column) -> Column:
    tag = F.coalesce(tag, F.lit(0))
    return F.array_compact(F.array(*[F.when(tag.bitwiseAND(b) != 0, F.lit(n)) for n, b in TYPES.items()]))


def fused_schema(fields: DataFrame) -> DataFrame:
    """The fused schema of :func:`file_fields` with every alternative type kept: (entity_type, field, types, n_values, n_files, first_ts, last_ts)."""
    return (
        fields.where("field IS NOT NULL")
        .groupBy("entity_type", "field")
        .agg(F.bit_or("tag").alias("tag"), F.sum("n").alias("n_values"), F.count_distinct("file_no").alias("n_files"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
        .select("entity_type", "field", _names(F.col("tag")).alias("types"), "n_values", "n_files", "first_ts", "last_ts")
    )


def path_schema(files: DataFrame) -> DataFrame:
    """The fused schema of whole payloads: (entity_type, path, types, n_values), paths like ``a.b[].c``.

    Every key and list member at any depth is a path of its own with all its
    alternative types; ``[]`` stands for the members of a list, the empty path
    for the payload itself. Nulls count for nothing. One round per level of
    nesting, each over what is left to be opened, folded as it is read.
    """
    open_rows = materialize(_records(files, "entity_type").select("entity_type", F.lit("").alias("path"), F.col("doc").alias("value")))
    levels = []
    while True:
        marked = open_rows.withColumn("shape", F.schema_of_variant("value")).withColumn("tag", tag_of("shape"))
        levels.append(marked.where("tag > 0").groupBy("entity_type", "path").agg(F.bit_or("tag").alias("tag"), F.count("*").alias("n")))
        # names with dots, brackets or blanks stay as they are written
        name = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.when(F.col("path") == "", "").otherwise("."), F.col("key")))
        inner = _members(marked.where("tag >= 8").select("entity_type", "path", F.col("value").alias("doc")), "doc").where("pos IS NOT NULL AND NOT is_variant_null(value)")
        open_rows = materialize(inner.select("entity_type", F.concat("path", name).alias("path"), "value"))
        if open_rows.isEmpty():
            break
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.select("entity_type", "path", _names(F.col("tag")).alias("types"), F.col("n").alias("n_values"))


def unified(files: DataFrame, schema: DataFrame, renamings: DataFrame | None = None) -> DataFrame:
    """All readable records in one consistent table, by a projection alone.

    A column per field of the fused schema, in the order of the names: fields
    of one type are typed, a field with several types becomes a canonical text
    column and one branch column per type (``name__string`` ...), each null
    where a record has another type. With ``renamings`` (field, old_field) the
    names of one chain share the most used one. Names that differ only in case,
    or clash with the head columns, get a number. Repeated deliveries of a
    record count once. The schema is gathered on the driver, one row per field
    (an error beyond the limit of ``bounded_rows``).
    """
    rows = bounded_rows(schema.groupBy("field").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("types")))).alias("types"), F.sum("n_values").alias("n")))
    weight = {r["field"]: r["n"] for r in rows}
    types = {r["field"]: set(r["types"]) for r in rows}
    head = {x: x for x in weight}

    def root(x: str) -> str:
        while head[x] != x:
            x = head[x]
        return x

    links = bounded_rows(renamings.select("field", "old_field").distinct()) if renamings is not None else []
    for r in sorted(map(tuple, links)):
        a, b = root(r[0]), root(r[1])
        if a != b:
            keep, drop = sorted((a, b), key=lambda x: (-weight[x], x))
            head[drop] = keep
    members: dict[str, list[str]] = {}
    for x in sorted(weight, key=lambda x: (-weight[x], x)):
        members.setdefault(root(x), []).append(x)

    fixed = ["file_no", "file_name", "study_id", "agent_id", "file_ts", "record_no", "entity_type", "record_id"]
    taken = {c.lower() for c in fixed}

    def fresh(name: str) -> str:
        n, out = 2, name
        while out.lower() in taken:
            out, n = f"{name}_{n}", n + 1
        taken.add(out.lower())
        return out

    cast = {"string": "string", "number": "double", "boolean": "boolean", "object": "string", "array": "string"}
    source = readable(files.select(*fixed, "payload"), name="__v")

    def path(name: str) -> str:
        return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"

    def pick(names: list[str], kind: str) -> Column:
        return F.coalesce(*[F.try_variant_get("__v", path(x), kind) for x in names])

    out: list[Column] = []
    shapes: dict[str, Column] = {}
    for name in sorted(members):
        names = members[name]
        kinds = sorted(set().union(*(types[x] for x in names)), key=list(TYPES).index)
        if len(kinds) == 1:
            out.append(pick(names, cast[kinds[0]]).alias(fresh(name)))
            continue
        out.append(pick(names, "string").alias(fresh(name)))
        shape = f"__shape_{len(shapes)}"
        shapes[shape] = F.schema_of_variant(pick(names, "variant"))
        out += [F.when(tag_of(shape) == TYPES[k], pick(names, cast[k])).alias(fresh(f"{name}__{k}")) for k in kinds]
    return source.dropDuplicates(["file_no", "record_no", "entity_type", "record_id"]).withColumns(shapes).select(*fixed, *out)
