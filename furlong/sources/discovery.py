"""What keys JSON documents hold: every path with its kinds, counts, sizes and a preview, over all documents and all items of arrays.

Documents are parsed to variants and walked level by level; each level is written once, holds only what is nested, and is summed up by path with
partial counts, so no path is gathered in one task. The number of levels is that of the deepest document.

Paths are written as a.b[].c, [] standing for any item of an array; keys with other signs than letters, digits and _ are quoted, as in a["b.c"]. The document itself
has the empty path. Kinds are object, array, string, integer, number, boolean, null and other (dates and the like never come from JSON); a text that is no JSON, or holds a key
twice in one object, is of kind invalid and has no paths below it. Null documents do not count; an empty table gives an empty result. A path has a row however many kinds
it has. n counts occurrences, least and most are the numbers of keys or items of its objects and arrays, and preview is the least of its plain values as JSON, cut to
`preview` signs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import written

NESTED = ("object", "array")


def kind_of(value: Column) -> Column:
    """The JSON kind of a variant; null for null."""
    said = F.schema_of_variant(value)
    return (
        F.when(said.startswith("OBJECT"), "object").when(said.startswith("ARRAY"), "array").when(said == "STRING", "string").when(said == "BIGINT", "integer")
        .when(said.startswith("DECIMAL") | said.isin("DOUBLE", "FLOAT"), "number").when(said == "BOOLEAN", "boolean").when(said == "VOID", "null").when(said.isNotNull(), "other")
    )


def step(key: Column) -> Column:
    """How a key (null: an item of an array) continues a path."""
    quoted = F.concat(F.lit('["'), F.regexp_replace(key, r'(["\\])', r"\\$1"), F.lit('"]'))
    return F.when(key.isNull(), F.lit("[]")).when(key.rlike(r"^\w+$"), F.concat(F.lit("."), key)).otherwise(quoted)


def described(nodes: DataFrame, preview: int) -> DataFrame:
    """(path, kind, n, preview, least, most) of nodes (path, kind, value)."""
    text = F.when(~F.col("kind").isin(*NESTED, "invalid"), F.to_json("value"))
    shown = F.when(F.length(text) > preview, F.concat(F.substring(text, 1, preview - 3), F.lit("..."))).otherwise(text)
    size = F.when(F.col("kind") == "object", F.size(F.try_variant_get("value", "$", "map<string,variant>"))).when(F.col("kind") == "array", F.size(F.try_variant_get("value", "$", "array<variant>")))
    each = nodes.select("path", "kind", shown.alias("preview"), size.alias("size"))
    return each.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("preview").alias("preview"), F.min("size").alias("least"), F.max("size").alias("most"))


def key_paths(docs: DataFrame, doc: str = "doc", preview: int = 80) -> DataFrame:
    """(path, kinds, n, least, most, preview) of all JSON texts in a column; kinds in alphabetical order, joined by commas."""
    spark = docs.sparkSession
    value = F.try_parse_json(F.col(doc))
    nodes = docs.where(F.col(doc).isNotNull()).select(F.lit("").alias("path"), F.coalesce(kind_of(value), F.lit("invalid")).alias("kind"), value.alias("value"))
    levels: list[DataFrame] = []
    while True:
        levels.append(written(described(nodes, preview), "paths"))
        if levels[-1].where(F.col("kind").isin(*NESTED) & (F.col("most") > 0)).isEmpty():
            break
        inside = nodes.where(F.col("kind").isin(*NESTED)).select("path", F.col("value").alias("outer")).lateralJoin(spark.tvf.variant_explode(F.col("outer").outer()))
        path = F.regexp_replace(F.concat("path", step(F.col("key"))), r"^\.", "")
        nodes = written(inside.select(path.alias("path"), kind_of(F.col("value")).alias("kind"), "value"), "nodes")
    found = reduce(DataFrame.unionByName, levels).groupBy("path")
    return found.agg(
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.min("preview").alias("preview")
    )
