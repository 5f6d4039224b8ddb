"""The engine as one object: load, measure, cut, index, search, evaluate, validate, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import chunks as ch
from foliant.operators import gates
from foliant.operators import pages as pg
from foliant.operators import retrieval as rt
from foliant.operators import spans
from foliant.operators import tables as tb
from foliant.sources.writers import VersionedTable


class EvidenceEngine:
    """DataFrames in, DataFrames out; nothing runs until a result is used."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def load(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def classify_pages(self, pages: DataFrame, text: str = "best_text") -> DataFrame:
        return pg.with_kind(pages, text)

    def segment(self, pages: DataFrame, marker: str = "Familie:") -> DataFrame:
        """Entries from heading to heading: source, start, end, taxon."""
        ends = pages.groupBy("source_id").agg(F.max("pdf_page").alias("last_page"))
        h = spans.headings(pages, marker=marker).select("source_id", F.col("pdf_page").alias("start_page"), "taxon", "heading_excerpt")
        return spans.spans_to_next(h, "source_id", "start_page", ends, "last_page")

    def chunk(self, texts: DataFrame, key: str, text: str, target: int = 512, overlap: int = 100, heading_aware: bool = False) -> DataFrame:
        return ch.chunks(texts, key, text, target, overlap, heading_aware)

    def build_index(self, chunks: DataFrame, key: str = "chunk_id", text: str = "source_text") -> DataFrame:
        return rt.inverted_index(chunks, key, text)

    def search(self, chunks: DataFrame, index: DataFrame, questions: DataFrame, k: int = 5, weight: float = 0.08, depth: int = 80) -> DataFrame:
        """Hybrid retrieval for a batch of questions: lexical and vector hits fused, the best ``k`` parents of each.

        ``chunks``: ``chunk_id, parent, record, vec, vector_space_id`` (``record`` may lack); ``questions``: ``query_id, question, vec, vector_space_id``."""
        lexical = rt.bm25(index, questions, "query_id", "question", depth)
        name = lambda df, key: df.select(F.col(key).alias("item" if key == "chunk_id" else "query"), F.col("vector_space_id").alias("space"), F.col("vec").alias("v"), *(["parent", "record"] if key == "chunk_id" else []))
        base = chunks if "record" in chunks.columns else chunks.withColumn("record", F.lit(None).cast("string"))
        return rt.hybrid_parents(name(base, "chunk_id"), name(questions, "query_id"), lexical, k, weight)

    def health(self, chunks: DataFrame) -> DataFrame:
        """``space, chunks, vectors, ready`` of an index: whether every chunk of a space has a vector of one length."""
        size = F.size("vec")
        g = chunks.groupBy(F.col("vector_space_id").alias("space")).agg(F.count("*").alias("chunks"), F.count_if(size > 0).alias("vectors"), F.countDistinct(F.when(size > 0, size)).alias("lengths"))
        return g.select("space", "chunks", "vectors", ((F.col("chunks") == F.col("vectors")) & (F.col("lengths") == 1)).alias("ready"))

    def retrieve(self, chunks: DataFrame, index: DataFrame, questions: DataFrame, settings: DataFrame, k: int = 5, broad: Column | None = None) -> DataFrame:
        """``search`` among the active rows only (``review_status`` and ``profile_id`` as the settings ``active_review_statuses`` and ``active_chunk_profile`` list them). Where ``broad`` (on ``questions``)
        holds, 3 k parents are asked for, 18 at least, of which at most two of a record and twelve of a question stay."""
        active = gates.active_rows(gates.active_rows(chunks, settings, "review_status", "active_review_statuses"), settings, "profile_id", "active_chunk_profile")
        wide = F.lit(False) if broad is None else broad
        hits = self.search(active, index, questions, max(3 * k, 18) if broad is not None else k)
        flags = questions.select(F.col("query_id").alias("query"), F.coalesce(wide, F.lit(False)).alias("broad"))
        h = hits.join(flags, "query")
        narrow = h.filter(~F.col("broad") & (F.col("rank") <= k)).withColumn("final_rank", F.col("rank"))
        if broad is None:
            return narrow.drop("broad")
        return narrow.drop("broad").unionByName(rt.diversify(h.filter("broad"), "record").select(*narrow.drop("broad").columns))

    def respond(self, hits: DataFrame, texts: DataFrame, required: DataFrame) -> DataFrame:
        """``query, status, evidence``: of each question whether its hits hold a required term (``query, terms``), and the hits as labelled evidence in order of rank."""
        gate = gates.evidence_gate(hits.select("query", "parent"), texts, required).groupBy("query").agg(F.max("answer_gate").alias("gate"))
        listed = hits.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("E"), F.col("rank").cast("string")).alias("label"), "item", "parent"))).alias("evidence"))
        status = F.when(F.col("gate") == "supporting_book_terms_found", "answerable").otherwise("hold_for_evidence")
        return listed.join(gate, "query").select("query", status.alias("status"), "evidence")

    def evaluate(self, hits: DataFrame, relevant: DataFrame) -> DataFrame:
        """Ranking metrics of hits (``query, item, cosine, rank``) against relevant pairs (``query, item``)."""
        r = relevant.select("query", "item", F.lit(True).alias("relevant")).distinct()
        return rt.ranking_metrics(hits.join(r, ["query", "item"], "left").na.fill(False, ["relevant"]))

    def validate(self, df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
        return tb.checks(df, key, rules)

    def promote(self, df: DataFrame, path: str, checks: dict[str, Column] | None = None) -> str:
        return VersionedTable(self.spark, path).publish(df, checks)
