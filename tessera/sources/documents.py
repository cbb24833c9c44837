"""Reading and writing documents, pages and component tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_MARK = "--- Page {} ---"


def read_json_documents(spark: SparkSession, path: str, schema: str | T.StructType, glob: str | None = None) -> DataFrame:
    """Whole-file JSON documents with a given schema.

    A file that can't be read is a row of nulls with its text in
    ``_corrupt_record``; ``glob`` picks files by name.
    """
    full = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if "_corrupt_record" not in full.names:
        full = T.StructType([*full.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path).withColumn("file", F.input_file_name())


def latest_per_prefix(df: DataFrame, path: str) -> DataFrame:
    """Of run folders ``PREFIX_date_time`` the last one of each prefix: the input and (prefix)."""
    rows = df.withColumn("prefix", F.regexp_replace(path, r"_\d{8}_\d{6}$", ""))
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc(path)))
    return rows.withColumn("__n", rank).where("__n = 1").drop("__n")


def write_json_by_agent(df: DataFrame, path: str, drop: tuple[str, ...] = ("raw_response",)) -> None:
    """JSON lines in one folder per agent, without bulky columns."""
    df.drop(*drop).write.mode("overwrite").partitionBy("agent_id").json(path)


def flat_component(df: DataFrame, columns: list[str], cut: int = 100) -> DataFrame:
    """A component as text columns: arrays joined by '; ', texts cut to ``cut`` characters."""
    out = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.ArrayType):
            out.append(F.array_join(F.col(c).cast("array<string>"), "; ").alias(c))
        elif isinstance(kind, T.StringType):
            out.append(F.substring(c, 1, cut).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.select(*out)


def write_components(components: dict[str, DataFrame], path: str) -> None:
    """One folder of CSV files with header per component."""
    for name, df in components.items():
        flat_component(df, df.columns).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_union_csv(parts: list[DataFrame], path: str) -> None:
    """Tables of different columns in one CSV with all of them, every value quoted and quotes doubled."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header and a given schema; rows that don't fit keep their text in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("header", True).option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)


def pages_of(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Texts as pages, cut at blank lines: (key, page_no, text, char_count, has_tables, error)."""
    rows = df.select(key, F.posexplode_outer(F.split(text, r"\n\s*\n")).alias("page_no", "text"))
    table = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\|.*\||\S {2,}\S+ {2,}\S"))) >= 2
    return rows.select(
        key, "page_no", "text", F.length("text").alias("char_count"), F.coalesce(table, F.lit(False)).alias("has_tables"), F.when(F.col("text").isNull(), "no text").alias("error")
    )


def joined_pages(pages: DataFrame, key: str, wanted: list[int], most: int = 10_000) -> DataFrame:
    """The wanted pages of each document as one text with page marks: (key, text); cut pages say so, documents without any are left out."""
    cut = F.when(F.length("text") > most, F.concat(F.substring("text", 1, most), F.lit(" [cut]"))).otherwise(F.col("text"))
    one = F.struct("page_no", F.concat(F.lit("--- Page "), (F.col("page_no") + 1).cast("string"), F.lit(" ---\n"), cut).alias("t"))
    rows = pages.where(F.col("page_no").isin(wanted) & F.col("text").isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("x"))
    return rows.select(key, F.array_join(F.transform("x", lambda x: x["t"]), "\n\n").alias("text"))
