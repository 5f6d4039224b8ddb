"""Sources mixed to target shares of tokens, with capped repetition (problem 8).

Tokens are counted once per different text, summed per source, turned into repetition rates by filling up
sources that meet their cap, and every text is emitted floor(rate) times plus once more with the remaining
probability, decided by a seeded hash: the same mixture on every run, at any partitioning.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = DEFAULT_VOCABULARY, folder: str = "/opt/tokenizers") -> str:
    """File of a public tokenizer; the folder is a parameter of the installation."""
    return str(Path(folder) / name)


# Fixed value: how the public byte-level vocabularies cut a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def with_token_counts(df: DataFrame, text: str = "text", vocabulary: str | None = None, out: str = "tokens", pattern: str = PATTERN) -> DataFrame:
    """``df`` with the number of tokens of ``text``; null and empty texts have none. Special tokens count as ordinary text.

    The vocabulary's file is read by the driver and sent along, so executors need no copy of it."""
    file = df.sparkSession.sparkContext.broadcast(Path(vocabulary or tokenizer_path()).read_bytes())  # some hundred kB

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.value.splitlines() if line)}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], out])

    keep = [c for c in df.columns if c not in (text, out)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(keep).schema] + [f"`{out}` bigint"])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("__text")).mapInArrow(count, schema)


def repetition_rates(sizes: dict[str, int], targets: list[tuple[str, float, int]], total: float) -> dict[str, float]:
    """Rate per source so that tokens follow the shares, none above its cap; what capped or empty sources
    leave open goes to the others in proportion to their shares, so the total is met where the caps allow it."""
    rates = {s: 0.0 for s, _, _ in targets}
    open_ = {s: share for s, share, _ in targets if share and share > 0 and sizes.get(s, 0) > 0}
    caps = {s: float(max(0, cap or 0)) for s, _, cap in targets}
    left = float(total)
    while open_ and left > 0:
        whole = sum(open_.values())
        full = [s for s, share in open_.items() if left * share / whole >= caps[s] * sizes[s]]
        if not full:
            rates.update({s: left * share / whole / sizes[s] for s, share in open_.items()})
            break
        for s in full:
            rates[s] = caps[s]
            left -= caps[s] * sizes[s]
            del open_[s]
    return rates


def mixture(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, seed: int = 7, max_sources: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(members, report). Members: ``doc_id, source, copy, tokens``, one row per use of a text. Report: per source
    of ``targets`` its ``target_share``, rate, tokens and ``actual_share`` in the mixture, and of the whole.

    Equal texts count as one, under the smallest ``doc_id`` and its source, so no text is used more than its
    source's ``max_repeats`` times. The total is that of all documents, copies included. Sources without
    target (a null source too) have share 0; targets without documents stay empty and are reported so. Null
    and empty texts have no tokens and aren't used. ``targets`` is a table of settings, checked to have at most ``max_sources`` rows.
    """
    rows = targets.select("source", F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} mixture targets")
    wanted = [tuple(r) for r in rows if r[0] is not None]
    # texts are counted where they lie; only their hash and count are shuffled to find equal ones
    each = with_token_counts(documents.filter(F.length("text") > 0).select("doc_id", "source", F.sha2("text", 256).alias("h"), "text"), vocabulary=vocabulary)
    one = each.groupBy("h").agg(F.min(F.struct("doc_id", "source")).alias("r"), F.count("*").alias("rows_"), F.min("tokens").alias("tokens"))
    counted = cut_lineage(one.select(F.col("r.doc_id").alias("doc_id"), F.col("r.source").alias("source"), "rows_", "tokens"))
    per = counted.groupBy("source").agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("rows_")).alias("all"))
    named = {s: i for i, (s, _, _) in enumerate(wanted)}
    sums = per.groupBy(F.when(F.col("source").isin(*named) if named else F.lit(False), F.col("source")).alias("source")).agg(F.sum("t").alias("t"), F.sum("all").alias("all")).collect()
    sizes = {r["source"]: r["t"] for r in sums if r["source"] is not None}
    total = sum(r["all"] for r in sums)
    rates = repetition_rates(sizes, wanted, total)
    spark = documents.sparkSession
    table = spark.createDataFrame([(s, float(share or 0), rates[s]) for s, share, _ in wanted], "source string, target_share double, rate double")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    # the table of rates has at most max_sources rows
    members = counted.join(F.broadcast(table), "source").withColumn("n", copies).filter("n > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"), "tokens")
    got = members.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("uses"), F.max("copy").alias("most_uses"))
    report = table.join(got, "source", "left").na.fill(0, ["tokens", "uses", "most_uses"])
    whole = got.agg(F.sum("tokens").alias("mixture_tokens"))
    report = report.crossJoin(whole).select(
        "source", "target_share", F.round("rate", 6).alias("rate"), "uses", "most_uses", "tokens", F.round(F.col("tokens") / F.col("mixture_tokens"), 6).alias("actual_share"), "mixture_tokens", F.lit(int(total)).alias("target_tokens")
    )
    return members, report
