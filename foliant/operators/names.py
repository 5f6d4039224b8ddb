"""Scientific names: extraction, resolution, classification of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as tx


def binomial(c: Column) -> Column:
    """First binomial of a text in its normal form, '' if there is none."""
    found = F.regexp_extract(c, r"([A-Z][a-zA-Zë]{2,}) (?:× )?([A-Za-z]{3,})", 0)
    parts = F.split(F.replace(found, F.lit(" × "), F.lit(" ")), " ")
    return F.when(F.length(found) > 0, F.concat_ws(" ", F.initcap(parts[0]), F.lower(parts[1]))).otherwise(F.lit(""))


def resolve(entries: DataFrame, matches: DataFrame, key: str, name: str) -> DataFrame:
    """``key, status, accepted``: accepted beats alias, an alias of another genus is blocked, else unresolved.

    ``matches`` has ``name, accepted, kind`` (accepted or alias); ties go to the smaller accepted name."""
    e = entries.select(F.col(key), tx.fold(F.col(name)).alias("__n"))
    m = matches.select(tx.fold(F.col("name")).alias("__n"), "accepted", F.when(F.col("kind") == "accepted", 0).otherwise(1).alias("p"), F.split(tx.fold(F.col("name")), " ")[0].alias("g1"), F.split(tx.fold(F.col("accepted")), " ")[0].alias("g2"))
    m = m.filter((F.col("p") == 0) | (F.col("g1") == F.col("g2"))).groupBy("__n").agg(F.min(F.struct("p", "accepted")).alias("m"))
    return e.join(m, "__n", "left").select(key, F.when(F.col("m").isNull(), "unresolved").when(F.col("m.p") == 0, "accepted").otherwise("alias").alias("status"), F.col("m.accepted").alias("accepted"))


def resolve_synonyms(entries: DataFrame, table: DataFrame, key: str, name: str, rank: str = "species", words: int = 2) -> DataFrame:
    """``resolve`` against a table (``accepted, synonyms, rank``) whose synonyms are listed in one text, parted by semicolons. Only rows of ``rank`` and names of ``words`` words count."""
    of_rank = table.filter(F.col("rank") == rank)
    names = of_rank.select(F.col("accepted").alias("name"), "accepted", F.lit("accepted").alias("kind")).unionByName(of_rank.select(F.explode(F.transform(F.split("synonyms", ";"), lambda x: F.trim(x))).alias("name"), "accepted", F.lit("alias").alias("kind")))
    return resolve(entries, names.filter(F.size(F.split("name", " ")) == words), key, name)


def cascade(base: DataFrame, steps: list[DataFrame], key: str) -> DataFrame:
    """The first step that resolves a key, with its number from 1; null where none does."""
    out = base.select(key)
    names = []
    for i, s in enumerate(steps, 1):
        names.append(f"__s{i}")
        out = out.join(s.filter("accepted IS NOT NULL").groupBy(key).agg(F.min("accepted").alias(names[-1])), key, "left")
    step = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(i)) for i, n in enumerate(names, 1)])
    return out.select(key, F.coalesce(*names).alias("accepted"), step.alias("step"))
