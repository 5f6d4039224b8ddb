"""Oversized texts cut at natural boundaries, by lexical cohesion (problem 5).

Units are counted by Catalyst; only oversized rows reach Python. There a text's candidate
boundaries are scored by the cohesion of the blocks on both sides, and each size window is cut at
the deepest valley. No shuffle but the one that removes repeated deliveries.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = re.compile(r"\w+|[^\w\s]")
#: the same unit for Catalyst: (?U) makes white space mean what it does in Python
UNIT_SQL = r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1C-\x1F]"
_STOP = set(".!?。！？؟।॥")
_CLOSE = set("\"'”“»)]」』’")
PIECE_SCHEMA = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("parent_chunk_id", T.StringType()),
        T.StructField("piece_index", T.IntegerType()),
        T.StructField("unit_start", T.IntegerType()),
        T.StructField("unit_end", T.IntegerType()),
        T.StructField("char_from", T.IntegerType()),
        T.StructField("char_to", T.IntegerType()),
        T.StructField("overlap_units", T.IntegerType()),
        T.StructField("boundary", T.StringType()),
        T.StructField("piece_text", T.StringType()),
    ]
)


def token_units(text: Column) -> Column:
    """Number of token units of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(UNIT_SQL)), F.lit(0))


def _cohesion_valleys(units: list[str], cuts: list[int], block: int) -> dict[int, float]:
    """Depth of the similarity valley at each cut: how far the word overlap of the blocks on both
    sides lies below the peaks around it."""
    words = [u.lower() if u[0].isalpha() else "" for u in units]
    sims = []
    for c in cuts:
        a = Counter(w for w in words[max(0, c - block) : c] if w)
        b = Counter(w for w in words[c : c + block] if w)
        norm = (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
        sims.append(sum(n * b[w] for w, n in a.items() if w in b) / norm if norm else 0.0)
    n = len(sims)
    left, right = [0.0] * n, [0.0] * n
    for i in range(n):  # climb to the nearest peak on each side
        left[i] = left[i - 1] if i and sims[i - 1] >= sims[i] else sims[i]
        if i and sims[i - 1] >= sims[i]:
            left[i] = max(left[i - 1], sims[i - 1])
    for i in range(n - 1, -1, -1):
        right[i] = max(right[i + 1], sims[i + 1]) if i + 1 < n and sims[i + 1] >= sims[i] else sims[i]
    return {c: left[i] + right[i] - 2 * sims[i] for i, c in enumerate(cuts)}


def _ends_sentence(units: list[str], dot: int, after: int, gap: str) -> bool:
    """Whether a full stop can end a sentence: no short word before it (mostly an abbreviation), no
    figure or small letter after it; a line end settles it."""
    if "\n" in gap:
        return True
    return len(units[dot - 1]) > 4 and not units[after][0].islower() and not units[after][0].isdigit()


def split_text(text: str, limit: int, overlap: int, block: int = 24) -> list[tuple[int, int, int, int, int, str]]:
    """Pieces (unit start, unit end, char from, char to, shared units, boundary) of at most ``limit`` units.

    Consecutive pieces share exactly ``overlap`` units, but never more than ``limit - 1``. The first cut of
    each window that exists wins by kind: paragraph or sentence (deepest valley), line, comma, else a hard cut.
    """
    spans = [m.span() for m in UNIT.finditer(text)]
    n = len(spans)
    if n <= limit:
        return [(0, n, spans[0][0] if n else 0, spans[-1][1] if n else 0, 0, "end")]
    overlap = max(0, min(overlap, limit - 1))
    units = [text[a:b] for a, b in spans]
    strong, line, weak = [], [], []
    for i in range(1, n):
        gap = text[spans[i - 1][1] : spans[i][0]]
        prev = units[i - 1]
        j = i - 1
        while j > 0 and units[j] in _CLOSE:
            j -= 1
        if "\n\n" in gap:
            strong.append(i)
        elif units[j] in _STOP and (gap or units[j] in "。！？") and (units[j] != "." or _ends_sentence(units, j, i, gap)) and units[i] not in _CLOSE and units[i] not in _STOP:
            strong.append(i)
        elif "\n" in gap:
            line.append(i)
        elif prev in ",;:，；、：":
            weak.append(i)
    depth = _cohesion_valleys(units, strong, block)
    pieces, start = [], 0
    while True:
        end, kind = n, "end"
        if n - start > limit:
            low, high = start + overlap + 1, start + limit
            floor = max(low, start + limit // 2)
            for name, cuts in (("sentence", strong), ("line", line), ("clause", weak)):
                inside = cuts[bisect_left(cuts, floor) : bisect_right(cuts, high)] or cuts[bisect_left(cuts, low) : bisect_right(cuts, high)]
                if inside:
                    end = max(inside, key=lambda c: (depth[c], c)) if name == "sentence" else inside[-1]
                    kind = name
                    break
            else:
                end, kind = high, "hard"
        shared = 0 if not pieces else overlap
        pieces.append((start, end, spans[start][0], spans[end - 1][1], shared, kind))
        if end == n:
            return pieces
        start = end - overlap


def split_oversized(
    chunks: DataFrame,
    key: str = "chunk_id",
    text: str = "source_text",
    limit: str = "target_token_units",
    overlap: str = "overlap_token_units",
    parent: str = "parent_chunk_id",
    default_overlap: float = 0.2,
    block: int = 24,
) -> DataFrame:
    """Pieces of every row whose text has more units than its limit.

    Each key counts once (of repeated deliveries any, as they're equal but for their arrival; the one
    with the smallest text if not). Rows with a null key, text or limit, or a limit under 1, aren't cut. A null overlap
    means ``default_overlap`` of the limit, one of the limit or more is lowered to limit - 1. The given
    parent is kept; where it is missing the key without its last ``:`` part groups the pieces, so that
    pieces of sibling chunks share it. Other columns don't come out. Whole texts are cut, of any length.
    """
    lim = F.col(limit).cast("int")
    over = (
        chunks.select(F.col(key).alias("k"), F.col(parent).alias("p"), F.col(text).alias("t"), lim.alias("l"), F.col(overlap).cast("int").alias("o"))
        .filter(F.col("k").isNotNull() & (F.col("l") >= 1) & (F.length("t") > F.col("l")))
        .filter(token_units(F.col("t")) > F.col("l"))
        .groupBy("k")
        .agg(F.min_by(F.struct("p", "t", "l", "o"), F.struct("t", "l", "o", "p")).alias("r"))
        .select("k", F.coalesce("r.p", F.regexp_replace("k", r":[^:]*$", "")).alias("p"), "r.t", "r.l", F.coalesce("r.o", (F.col("r.l") * default_overlap).cast("int")).alias("o"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in PIECE_SCHEMA]
            for k, p, t, size, o in zip(*(c.to_pylist() for c in b.columns)):
                for i, (us, ue, cs, ce, shared, kind) in enumerate(split_text(t, size, o, block)):
                    for c, x in zip(cols, (k, p, i, us, ue, cs, ce, shared, kind, t[cs:ce])):
                        c.append(x)
            kinds = [pa.string(), pa.string(), *[pa.int32()] * 6, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=PIECE_SCHEMA.names)

    return over.mapInArrow(run, PIECE_SCHEMA)


def piece_checks(chunks: DataFrame, pieces: DataFrame | None = None) -> DataFrame:
    """Per text that was cut, whether its pieces keep what is asked of them: ``units`` covered without a gap from the first to the last, the largest piece, the number
    of units that consecutive pieces share (the smallest and the largest), the parent, and ``rebuilt_md5`` of the text put together from the pieces."""
    pieces = split_oversized(chunks) if pieces is None else pieces
    w = Window.partitionBy("chunk_id").orderBy("piece_index")  # a text's own pieces
    p = pieces.withColumn("before", F.lag("unit_end").over(w)).withColumn("till", F.lag("char_to").over(w))
    new = F.substring("piece_text", F.coalesce(F.col("till") - F.col("char_from"), F.lit(0)) + 1, F.length("piece_text"))
    shared = F.col("before") - F.col("unit_start")
    g = p.withColumn("new", new).withColumn("shared", shared).groupBy("chunk_id").agg(
        F.min("unit_start").alias("first_unit"), F.max("unit_end").cast("long").alias("units"), F.max(F.col("unit_end") - F.col("unit_start")).alias("largest"), F.min("shared").alias("least_shared"), F.max("shared").alias("most_shared"),
        F.countDistinct("parent_chunk_id").alias("parents"), F.min("parent_chunk_id").alias("parent_chunk_id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_index", "new"))), lambda x: x["new"]), "").alias("text"),
    )
    limits = chunks.groupBy("chunk_id").agg(F.max("target_token_units").alias("l"), F.max("overlap_token_units").alias("o"))
    j = g.join(limits, "chunk_id")
    overlap = F.least(F.coalesce("o", (F.col("l") * 0.2).cast("int")), F.col("l") - 1)
    return j.select("chunk_id", "units", ((F.col("first_unit") == 0) & (F.col("parents") == 1)).alias("whole"), (F.col("largest") <= F.col("l")).alias("within_limit"), ((F.col("least_shared") == overlap) & (F.col("most_shared") == overlap)).alias("exact_overlap"), "parent_chunk_id", F.md5("text").alias("rebuilt_md5"))


def oversized_keys(chunks: DataFrame) -> DataFrame:
    """Keys of the rows that the splitter had to cut, each once."""
    return split_oversized(chunks).filter((F.col("piece_index") == 0)).select("chunk_id")
