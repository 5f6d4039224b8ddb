"""Boundaries between entries: headings of pages, evidence for them, spans and their disposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Letters of a name in a heading, words that open other sections, and words that no species is called.
_LETTER = "A-Za-zÄÖÜäöüßÀ-ÖØ-öø-ÿ"
HEADING = rf"^\s*([A-ZÄÖÜ][{_LETTER}]{{2,}})\s+([{_LETTER}][{_LETTER}-]{{2,}})\b"
OPENING_WORDS = "Abbildung Anatomisches Anhang Anwendung Bestandtheile Bestandteile Blüthezeit Beschreibung Familie Goldene Köhler Litteratur Name Tafelbeschreibung Verbreitung Vorkommen".split()
PARTICLES = "der des die ein eine für mit nach und von".split()
SIGNALS = {"beschreibung": r"(?i)\bBeschreibung\b", "familie": r"(?i)\bFamilie\b", "gattung": r"(?i)\bGattung\b", "synonym": r"(?i)\bSyn\.?\s*[:.]?"}


def canonical_taxon(c: Column) -> Column:
    """The binomial that a text begins with in small letters, null if there is none."""
    t = F.regexp_replace(c, r"\s+", " ")
    genus, species = F.regexp_extract(t, HEADING, 1), F.regexp_extract(t, HEADING, 2)
    return F.when(F.length(genus) > 0, F.lower(F.concat_ws(" ", genus, species)))


def heading_candidates(pages: DataFrame, key: str, text: str, lines: int = 12, context: int = 24) -> DataFrame:
    """``key, taxon, line_order, heading_line, signals``: the first of a page's first ``lines`` lines that aren't blank and that begins with a binomial whose words open no other section, and
    the structural signals of its first ``context`` lines. Pages without one don't come out. All in expressions over a page's own lines."""
    every = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    full = F.slice(F.filter(F.transform(every, lambda x: F.trim(x)), lambda x: x != ""), 1, lines)
    fits = lambda x: x.rlike(HEADING) & ~F.regexp_extract(x, HEADING, 1).isin(*OPENING_WORDS) & ~F.lower(F.regexp_extract(x, HEADING, 2)).isin(*PARTICLES)
    found = F.filter(F.transform(full, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: fits(s["x"]))
    head = F.array_join(F.slice(every, 1, context), "\n")
    signals = F.array_compact(F.array(*[F.when(head.rlike(p), F.lit(n)) for n, p in SIGNALS.items()]))
    p = pages.select(F.col(key), F.explode_outer(F.slice(found, 1, 1)).alias("h"), signals.alias("signals")).filter("h IS NOT NULL")
    line = F.col("h")["x"]
    return p.select(key, F.concat_ws(" ", F.regexp_extract(line, HEADING, 1), F.regexp_extract(line, HEADING, 2)).alias("taxon"), F.col("h")["i"].alias("line_order"), line.alias("heading_line"), "signals")


def name_score(match: Column, words: Column, exact: Column) -> Column:
    """3 for a species found exactly by both sides, 2 for an exact match of a verifier alone, 1 for a fuzzy one, else 0; matches of less than two words count nothing."""
    two = words >= 2
    return F.when(F.coalesce(exact, F.lit(False)), 3).when((match == "Exact") & two, 2).when((match == "Fuzzy") & two, 1).otherwise(0)


def page_offset(headings: DataFrame, names: DataFrame, reach: int = 2) -> DataFrame:
    """``source_id, shift, score, winners``: by how many pages another count of a source's pages is shifted. A heading (``source_id, page, taxon``) scores 2 where its name stands on the
    shifted page of ``names`` (``source_id, page, taxon``) and not on the one before, 1 where it stands on both. ``shift`` is null unless one shift alone has the best score above zero.

    Headings meet names by an equi-join on the shifted page: 2 x ``reach`` + 1 rows a heading, never all pairs."""
    n = names.select("source_id", F.col("page").alias("at"), "taxon").distinct().withColumn("here", F.lit(1))
    moved = headings.select("source_id", "page", "taxon", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("shift")).withColumn("at", F.col("page") + F.col("shift"))
    hit = moved.join(n, ["source_id", "at", "taxon"]).join(n.select("source_id", (F.col("at") + 1).alias("at"), "taxon", F.col("here").alias("before")), ["source_id", "at", "taxon"], "left")
    s = hit.groupBy("source_id", "shift").agg(F.sum(F.when(F.col("before").isNull(), 2).otherwise(1)).alias("score"))
    best = s.groupBy("source_id").agg(F.max("score").alias("score"))
    won = s.join(best, ["source_id", "score"]).groupBy("source_id").agg(F.min("shift").alias("m"), F.max("score").alias("score"), F.count("*").alias("winners"))
    every = headings.select("source_id").distinct().join(won, "source_id", "left")
    return every.select("source_id", F.when(F.col("winners") == 1, F.col("m")).alias("shift"), F.coalesce("score", F.lit(0)).cast("long").alias("score"), F.coalesce("winners", F.lit(0)).alias("winners"))


def boundary_decision(rows: DataFrame) -> DataFrame:
    """Adds ``decision`` to pages with two readings of their heading: ``local_taxon, external_taxon, local_order, external_order, local_score, external_score`` (of ``name_score``), ``fuzzy`` (the
    preferred name's match), ``on_page`` (whether an index names it on the page), ``structural`` and ``is_start``.

    The reading with the higher score is preferred, the external one if equal. A heading is confirmed where there is structure, and an exact species that both readings, the index or a clear
    lead in the first lines support, or a fuzzy one that the index bridges."""
    c = F.col
    prefer_local = c("local_score") > c("external_score")
    score, other = F.when(prefer_local, c("local_score")).otherwise(F.greatest("external_score", F.lit(0))), F.when(prefer_local, c("external_score")).otherwise(c("local_score"))
    both = c("local_taxon").isNotNull() & c("external_taxon").isNotNull()
    agree = F.coalesce(both & (c("local_taxon") == c("external_taxon")), F.lit(False))
    first = F.least(F.coalesce("local_order", F.lit(99)), F.coalesce("external_order", F.lit(99))) <= 1
    order = F.coalesce(F.when(prefer_local | c("external_taxon").isNull(), c("local_order")).otherwise(c("external_order")), F.lit(99))
    resolved = F.coalesce(both & (c("local_taxon") != c("external_taxon")), F.lit(False)) & (score == 3) & (other < 3) & first
    exact = (score == 3) & (agree | c("on_page") | resolved)
    bridge = (score == 1) & c("fuzzy") & c("on_page") & (order <= 1)
    decision = F.when(c("structural") & (exact | bridge), F.when(c("is_start"), "confirmed_parent_heading").otherwise("confirmed_hidden_heading")).when(
        c("local_taxon").isNotNull() | c("external_taxon").isNotNull(), "candidate_needs_secondary_evidence"
    )
    return rows.withColumn("decision", decision.otherwise("no_page_heading_detected"))


def entry_dispositions(spans: DataFrame, pages: DataFrame, approved: DataFrame, most_pages: int) -> DataFrame:
    """``source_id, start_page, end_page, n_pages, qualities, overlap_pages, disposition, needs_review`` of spans (``source_id, start_page, end_page, next_start``).

    The first rule that holds: no next heading, pages that are approved already (``source_id, pdf_page``), too long, a page that isn't clean or usable, else eligible. ``pages`` has one row a page:
    ``source_id, pdf_page, quality, needs_ocr``. Pages meet their span by an equi-join on the pages of the span."""
    p = spans.withColumn("pdf_page", F.explode(F.sequence("start_page", "end_page"))).join(pages, ["source_id", "pdf_page"]).join(approved.select("source_id", "pdf_page", F.lit(True).alias("a")).distinct(), ["source_id", "pdf_page"], "left")
    key = ["source_id", "start_page", "end_page", "next_start"]
    per = p.groupBy(*key, "quality").agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("a"), F.col("pdf_page"))).alias("over"), F.bool_or("needs_ocr").alias("ocr"))
    g = per.groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.coalesce("quality", F.lit("unknown")), F.col("n").cast("string")))), ",").alias("qualities"), F.array_sort(F.flatten(F.collect_list("over"))).alias("overlap_pages"),
        F.bool_or(~F.coalesce(F.col("quality").isin("clean", "usable"), F.lit(False))).alias("poor"), F.bool_or("ocr").alias("ocr"),
    )
    n = F.col("end_page") - F.col("start_page") + 1
    disposition = F.when(F.col("next_start").isNull(), "hold_terminal_no_next_heading").when(F.size("overlap_pages") > 0, "already_approved_overlap").when(n > most_pages, "hold_span_over_limit").when(F.col("poor"), "hold_page_quality").otherwise("eligible_local_structure")
    g = g.withColumn("n_pages", n).withColumn("disposition", disposition)
    return g.select("source_id", "start_page", "end_page", "n_pages", "qualities", "overlap_pages", "disposition", (F.coalesce("ocr", F.lit(False)) | F.col("disposition").isin("hold_terminal_no_next_heading", "hold_page_quality")).alias("needs_review"))


def overlay_plan(parents: DataFrame, hidden: DataFrame, review: DataFrame) -> DataFrame:
    """``parent, child, taxon, start_page, end_page, n_pages, needs_split, exact_coverage, safe``: segments of parents (``parent, taxon, start_page, end_page``) cut at hidden headings
    (``parent, page, taxon``) inside them. A parent may replace the old plan if its segments cover it exactly and none of its pages is in ``review`` (``parent, page``)."""
    inside = hidden.join(parents.select("parent", "start_page", "end_page"), "parent").filter("page > start_page AND page <= end_page").select("parent", "page", "taxon").distinct()
    cuts = parents.select("parent", F.col("start_page").alias("page"), "taxon").unionByName(inside).groupBy("parent", "page").agg(F.min("taxon").alias("taxon"))
    w = Window.partitionBy("parent").orderBy("page")  # the headings within one entry
    s = cuts.withColumn("next", F.lead("page").over(w)).withColumn("child", F.row_number().over(w)).join(parents.select("parent", F.col("end_page").alias("last")), "parent")
    s = s.withColumn("end_page", F.coalesce(F.col("next") - 1, F.col("last"))).withColumn("n_pages", F.col("end_page") - F.col("page") + 1)
    open_ = review.groupBy("parent").agg(F.count("*").alias("open"))
    whole = s.groupBy("parent").agg(F.sum("n_pages").alias("covered")).join(parents.select("parent", (F.col("end_page") - F.col("start_page") + 1).alias("pages")), "parent").select("parent", (F.col("covered") == F.col("pages")).alias("exact_coverage"))
    j = s.join(whole, "parent").join(open_, "parent", "left")
    return j.select("parent", F.concat(F.col("parent"), F.lit(":child-"), F.lpad(F.col("child").cast("string"), 2, "0")).alias("child"), "taxon", F.col("page").alias("start_page"), "end_page", "n_pages", (F.col("n_pages") > 6).alias("needs_split"), "exact_coverage", (F.col("exact_coverage") & F.col("open").isNull()).alias("safe"))


def candidate_scores(spans: DataFrame, pages: DataFrame, marks: tuple[str, ...]) -> DataFrame:
    """``source_id, start_page, score``: 100 + 24 x share of letters - 28 x share of short lines - 2.5 x |pages - 3| + 5 for a closing section + up to 3 for length, means over a span's pages.

    Only spans whose pages are all there and clean or usable are scored. ``pages`` has one row a page: ``source_id, pdf_page, quality, alpha_ratio, short_line_ratio, character_count, text``; the closing
    section is looked for in the last 1,200 characters of the last page."""
    p = spans.select("source_id", "start_page", "end_page", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page")).join(pages, ["source_id", "pdf_page"])
    tail = F.max_by(F.right("text", F.lit(1200)), "pdf_page")
    g = p.groupBy("source_id", "start_page", "end_page").agg(F.count("*").alias("n"), F.bool_and(F.coalesce(F.col("quality").isin("clean", "usable"), F.lit(False))).alias("fine"), F.avg("alpha_ratio").alias("a"), F.avg("short_line_ratio").alias("s"), F.avg("character_count").alias("c"), tail.alias("tail"))
    closing = F.when(F.col("tail").rlike("|".join(marks)), 5).otherwise(0)
    score = 100 + 24 * F.col("a") - 28 * F.col("s") - 2.5 * F.abs(F.col("n") - 3) + closing + F.least(F.col("c") / 2500, F.lit(3.0))
    return g.filter("fine AND n = end_page - start_page + 1").select("source_id", "start_page", F.round(score, 4).alias("score"))
