"""Page text: statistics, quality, kind, recognition queue, lane choice."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as tx


METRICS = ("n_characters", "n_words", "n_lines", "short_lines", "letters")


def with_metrics(pages: DataFrame, text: str = "best_text") -> DataFrame:
    """Counts and ratios of a page text: one pass, no shuffle. Null texts count as empty.

    The metrics come through a generator: a filter on what is made of them isn't pushed below it, where each use would measure the text again."""
    keep = [c for c in pages.columns if c not in METRICS]
    df = pages.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(tx.stripped(F.col(text)))).alias("__t")).withColumn("__l", tx.lines(F.col("__t")))
    n = F.size("__l")
    made = (F.length("__t").cast("long"), tx.word_count(F.col("__t")), n.cast("long"), tx.ratio(F.size(F.filter("__l", lambda x: F.length(F.trim(x)) <= 4)), n, 4, 1.0), tx.alpha_ratio(F.col("__t")))
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(*[c.alias(m) for m, c in zip(METRICS, made)]))))


def quality() -> Column:
    """Quality by the metrics: the first rule that holds."""
    return (
        F.when(F.col("n_characters") < 8, "empty").when((F.col("n_characters") < 120) | (F.col("n_words") < 18), "low_text").when(F.col("short_lines") > 0.38, "fragmented").otherwise("usable")
    )


# Marks of front matter and of indexes.
FRONT_MARKS = ("inhalt", "verzeichnis", "register", "band ")
INDEX_MARKS = ("sachregister", "namenregister", "literatur-verzeichnis")


def page_kind(text: Column, characters: Column, page: Column) -> Column:
    """Kind of a page: blank, plate or caption, front matter, index or text, by the first rule that holds."""
    t = tx.stripped(text)
    low = F.lower(t)
    plate = low.rlike(r"\btafel\s+[ivxlcdm0-9]+\b") | (characters < 320) & t.rlike(r"\b[A-Z][a-z]{3,}\s+[a-z][a-z-]{2,}\b")
    has = lambda marks: reduce(or_, [F.contains(low, F.lit(m)) for m in marks])
    front = (page <= 12) & has(FRONT_MARKS)
    return F.when(characters < 8, "blank_or_image").when(plate, "plate_or_caption").when(front, "frontmatter_or_index").when(has(INDEX_MARKS), "index").otherwise("text")


def with_kind(pages: DataFrame, text: str = "best_text", page: str = "pdf_page") -> DataFrame:
    """Metrics, quality class and kind of every page, each computed once per row."""
    p = with_metrics(pages, text).withColumn("quality_class", quality())
    return p.select("*", F.explode(F.array(page_kind(F.col(text), F.col("n_characters"), F.col(page)))).alias("kind"))


def recognition_need(pages: DataFrame) -> DataFrame:
    """Reason, strategy and priority of a new recognition for pages whose text isn't usable.

    Needs ``with_metrics`` and a ``kind`` and ``quality_class`` column; empty pages among the last ten of their source come last."""
    # the last page per source is one small aggregate, sent back by a join on the source
    last = pages.groupBy("source_id").agg(F.max("pdf_page").alias("last_page"))
    q, kind = F.col("quality_class"), F.col("kind")
    reason = F.when(q == "fragmented", "layout_fragmentation").when(q == "low_text", "insufficient_embedded_text").when(kind == "plate_or_caption", "plate_caption").when(q == "empty", "blank_or_image_check")
    strategy = F.when(q == "fragmented", "full_page_layout_ocr").when(q == "low_text", "full_page_ocr").when(kind == "plate_or_caption", "caption_ocr").when(q == "empty", "visual_text_check")
    priority = F.when(q == "fragmented", 1).when(q == "low_text", 2).when(kind == "plate_or_caption", 3).when(q == "empty", F.when(F.col("pdf_page") < F.col("last_page") - 10, 4).otherwise(5))
    return pages.join(last, "source_id").withColumn("reason", reason).withColumn("strategy", strategy).withColumn("priority", priority).drop("last_page")


def has_tokens(text: Column, tokens: list[str]) -> Column:
    """Whether a reading holds all the tokens that a known page must show, whatever their case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(and_, [F.contains(low, F.lit(t.lower())) for t in tokens], F.lit(True))


def quality_gain(embedded: Column, other: Column, factor: float = 1.2) -> Column:
    """Whether a second reading is better: much longer and not poorer in letters."""
    e, o = F.coalesce(embedded, F.lit("")), F.coalesce(other, F.lit(""))
    return F.when(F.length(F.trim(o)) == 0, "no_text_detected").when((F.length(o) > factor * F.length(e)) & (tx.alpha_ratio(o) >= tx.alpha_ratio(e)), "candidate_quality_gain").otherwise("no_quality_gain")


def chosen_text(lanes: list[str], preferred: Column) -> Column:
    """The text of the preferred lane, else of the first lane that has one."""
    have = [F.when(F.length(F.trim(F.col(c))) > 0, F.col(c)) for c in lanes]
    first = F.coalesce(*[F.when(preferred == c, h) for c, h in zip(lanes, have)], *have)
    return F.coalesce(first, F.lit(""))


def form_feed_pages(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Pages of texts that hold one page after another, parted by form feeds; numbers from 1."""
    body = F.regexp_replace(F.col(text), "\f$", "")
    return texts.select(key, F.posexplode(F.split(body, "\f")).alias("pos", "page_text")).select(key, (F.col("pos") + 1).alias("pdf_page"), "page_text")


def unique_pages(pages: DataFrame) -> DataFrame:
    """The latest delivery of every page of a source, ties to the larger page_id. Partial aggregation goes before the shuffle."""
    value = [c for c in pages.columns if c not in ("source_id", "pdf_page")]
    return pages.groupBy("source_id", "pdf_page").agg(F.max_by(F.struct(*value), F.struct("ingested_at", "page_id")).alias("r")).select("source_id", "pdf_page", *[f"r.{c}" for c in value])
