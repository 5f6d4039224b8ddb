"""Readers: JSON, JSON lines, page texts with form feeds, scans in XML, file receipts. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators.pages import form_feed_pages


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON objects, one to a file, with the file's path."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE").withColumn("source_file", F.col("_metadata.file_path"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines; blank lines are skipped, a line that doesn't parse ends the job if ``strict``, else becomes nulls."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "PERMISSIVE")


def read_paged_texts(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, pdf_page, page_text`` of text files whose pages are parted by form feeds."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    return form_feed_pages(files, "source_file", "value")


WORD = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_coords", T.StringType()), T.StructField("_x-confidence", T.DoubleType())])
PAGE_XML = T.StructType([T.StructField("LINE", T.ArrayType(T.StructType([T.StructField("WORD", T.ArrayType(WORD))]))), T.StructField("_usemap", T.StringType())])


def read_scan_xml(spark: SparkSession, path: str, row_tag: str = "OBJECT") -> DataFrame:
    """``page, line, text, x0, y0, x1, y1, confidence``: lines of a recognised scan with the union of their words' boxes
    and the median of their confidences. A word's ``coords`` are left, bottom, right, top."""
    pages = spark.read.format("xml").option("rowTag", row_tag).schema(PAGE_XML).load(path)
    lines = pages.select(F.col("_usemap").alias("page"), F.posexplode("LINE").alias("line", "l"))
    box = lambda i: F.transform("l.WORD", lambda w: F.split(w["_coords"], ",")[i].cast("int"))
    return lines.select(
        "page", "line",
        F.array_join(F.transform("l.WORD", lambda w: F.trim(w["_VALUE"])), " ").alias("text"),
        F.array_min(box(0)).alias("x0"), F.array_min(box(3)).alias("y0"), F.array_max(box(2)).alias("x1"), F.array_max(box(1)).alias("y1"),
        median_of(F.transform("l.WORD", lambda w: w["_x-confidence"])).alias("confidence"),
    )


NAMES_XML = T.StructType([T.StructField("PageID", T.StringType()), T.StructField("Names", T.StructType([T.StructField("Name", T.ArrayType(T.StructType([T.StructField("NameFound", T.StringType()), T.StructField("NameConfirmed", T.StringType())])))]))])


def read_names_xml(spark: SparkSession, path: str, row_tag: str = "Page") -> DataFrame:
    """``page, found, confirmed``: names that an index found on a page and confirmed, each pair of a page once; pages without names don't come out."""
    pages = spark.read.format("xml").option("rowTag", row_tag).schema(NAMES_XML).load(path)
    names = pages.select(F.col("PageID").alias("page"), F.explode(F.array_distinct("Names.Name")).alias("n"))
    return names.select("page", F.col("n.NameFound").alias("found"), F.col("n.NameConfirmed").alias("confirmed")).distinct()


def embedded_state(html: Column, attribute: str, schema: str) -> Column:
    """The JSON that a page's markup holds, escaped, in an attribute; null if there is none or it doesn't parse."""
    raw = F.regexp_extract(html, attribute + '="([^"]*)"', 1)
    for name, char in (("&quot;", '"'), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(name), F.lit(char))
    return F.from_json(raw, schema)


def median_of(values: Column) -> Column:
    """Median of an array of numbers; null if it is empty."""
    v = F.array_sort(F.array_compact(values))
    n = F.size(v)
    mid = F.floor(n / 2).cast("int")
    return F.when(n == 0, F.lit(None)).when(n % 2 == 1, F.get(v, mid)).otherwise((F.get(v, mid - 1) + F.get(v, mid)) / 2)


def recognised_lines(receipts: DataFrame, key: str, lines: str, tolerance: float = 0.012) -> DataFrame:
    """``key, text``: lines of a recognition in reading order, from the top down, boxes of one row from left to right.

    A row goes on while the height falls by no more than ``tolerance`` from one box to the next one below it."""
    down = F.array_sort(F.transform(lines, lambda x: F.struct((-x["y"]).alias("d"), x["x"].alias("x"), x["text"].alias("text"))))
    new_row = F.transform(down, lambda b, i: F.when((i > 0) & (b["d"] - F.get(down, F.greatest(i - 1, F.lit(0)))["d"] > tolerance), 1).otherwise(0))
    row = lambda i: F.aggregate(F.slice(new_row, F.lit(1), i + 1), F.lit(0), lambda a, b: a + b)
    ordered = F.array_sort(F.transform(down, lambda b, i: F.struct(row(i).alias("r"), b["x"].alias("x"), b["text"].alias("text"))))
    return receipts.select(key, F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))


def file_receipts(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, sha256, sha1`` of files."""
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", "length", F.sha2("content", 256).alias("sha256"), F.sha1("content").alias("sha1"))


def file_rule_errors(spark: SparkSession, path: str, most_bytes: int, suffixes: list[str], name: str) -> DataFrame:
    """``path, error``: files that are too large (size), have another suffix, or a name that doesn't match the pattern. Only what the file system tells is read, no content."""
    f = spark.read.format("binaryFile").load(path).select("path", "length")
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    fits = F.lit(False)
    for s in suffixes:
        fits = fits | base.endswith(s)
    errors = F.array_compact(F.array(F.when(F.col("length") > most_bytes, "size"), F.when(~fits, "suffix"), F.when(~base.rlike(name), "name")))
    return f.select("path", F.explode(errors).alias("error"))


def receipt_check(found: DataFrame, expected: DataFrame) -> DataFrame:
    """``path, state``: files against their receipts (``path, length, sha256``): ok, missing, unknown, size or hash."""
    f = found.select("path", F.col("length").alias("l"), F.col("sha256").alias("s"))
    e = expected.select("path", F.col("length").alias("el"), F.col("sha256").alias("es"))
    state = F.when(F.col("l").isNull(), "missing").when(F.col("el").isNull(), "unknown").when(F.col("l") != F.col("el"), "size").when(F.col("s") != F.col("es"), "hash").otherwise("ok")
    return f.join(e, "path", "full_outer").select("path", state.alias("state"))


def fenced_json(text: Column, schema: str) -> Column:
    """The JSON object in a text around it, from the first brace to the last; null if it doesn't parse."""
    return F.from_json(F.regexp_extract(text, r"(?s)(\{.*\})", 1), schema, {"mode": "PERMISSIVE"})


def page_ranges(text: Column) -> Column:
    """Pages of a list of ranges such as ``30-32,48``, each once, in order of appearance."""
    parts = F.split(F.regexp_replace(text, r"\s+", ""), ",")
    ends = lambda p: F.split(p, "-")
    return F.array_distinct(F.flatten(F.transform(parts, lambda p: F.sequence(ends(p)[0].cast("int"), F.coalesce(F.get(ends(p), F.lit(1)), ends(p)[0]).cast("int")))))


def sample_pages(sources: DataFrame, key: str, pages: str) -> DataFrame:
    """``key, page``: the pages by which a source is inspected: 1, 10, a quarter, half, and ten before the last."""
    n = F.col(pages)
    at = F.array(F.lit(1), F.lit(10), F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int"), (n - 10).cast("int"))
    return sources.select(key, F.explode(F.array_distinct(F.filter(at, lambda p: (p >= 1) & (p <= n)))).alias("page"))
