"""Gates on retrieved evidence: statuses, required terms, selections, names in pairs, citations, requests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators.retrieval import SLICE, cosines, places_of, rough, whole_batches


def active_rows(rows: DataFrame, settings: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose ``column`` is one of the values that the setting ``key`` lists, parted by commas (``key, value``; a handful of values)."""
    allowed = settings.filter(F.col("key") == key).select(F.explode(F.split("value", ",")).alias(column)).distinct()
    return rows.join(F.broadcast(allowed), column, "left_semi")


def any_of(text: Column, marks: list[str]) -> Column:
    """Whether a text holds any of the marks, whatever their case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [F.contains(low, F.lit(m.lower())) for m in marks], F.lit(False))


def expanded_terms(question: Column, rules: list[tuple[list[str], list[str] | None, list[str]]]) -> Column:
    """Terms that rules (any of these, and any of those if given, terms) add to a question, in the order of the rules.

    Rules are settings: they become one expression, so questions and rules never meet pair by pair. Marks may be phrases and are found inside words."""
    parts = [F.when(any_of(question, a) & (any_of(question, b) if b else F.lit(True)), F.array(*[F.lit(t) for t in terms])).otherwise(F.array().cast("array<string>")) for a, b, terms in rules]
    return F.concat(*parts)


def holds_any(text: Column, terms: Column) -> Column:
    """Whether a text, folded, contains any of an array of folded terms."""
    folded = tx.fold(F.coalesce(text, F.lit("")))
    return F.coalesce(F.exists(terms, lambda t: F.contains(folded, t)), F.lit(False))


def evidence_gate(parents: DataFrame, children: DataFrame, required: DataFrame) -> DataFrame:
    """``query, parent, has_required, answer_gate``: whether any child of a retrieved parent holds a required term of the question, and whether any parent does.

    ``parents`` has ``query, parent``; ``children`` ``parent, text``; ``required`` ``query, terms``."""
    j = parents.join(required, "query", "left").join(children, "parent")
    per = j.groupBy("query", "parent").agg(F.bool_or(holds_any(F.col("text"), F.coalesce("terms", F.array().cast("array<string>")))).alias("has_required"))
    found = F.max("has_required").over(Window.partitionBy("query"))  # the parents of a question are a top-k list
    return per.withColumn("answer_gate", F.when(found, "supporting_book_terms_found").otherwise("no_supporting_book_relation"))


class TermFinder:
    """Which texts hold which terms, as parts of words too. A term of Latin letters and figures, or of ideographs, lies inside one run of such characters, so it is
    looked for in each different run once; other terms are looked for in each text."""

    RUN = re.compile("[a-z0-9]+|[\u3400-\u9fff]+")

    def __init__(self, terms: list[str], most: int = 500_000) -> None:
        self.inside: dict[bool, dict[int, dict[str, int]]] = {False: {}, True: {}}  # ideographs or not, by length
        for i, t in enumerate(terms):
            if self.RUN.fullmatch(t):
                self.inside[t[0] > "z"].setdefault(len(t), {})[t] = i
        self.others = [(i, t) for i, t in enumerate(terms) if not self.RUN.fullmatch(t)]
        self.most, self.known, self.holding = most, set(), {}

    def learn(self, runs: list[str]) -> None:
        """Note the terms inside of runs: the parts of a run are looked up among the terms of their length, however many terms there are."""
        for x in runs:
            found = [i for n, terms in self.inside[x[0] > "z"].items() for at in range(len(x) - n + 1) if (i := terms.get(x[at : at + n])) is not None]
            if found:
                self.holding[x] = found
        self.known.update(runs)

    def holders(self, texts: list[str]) -> dict[int, np.ndarray]:
        """For each term that any of the texts holds the places of those that do, in order."""
        runs = [set(self.RUN.findall(x)) for x in texts]
        every = set().union(*runs)
        new = [x for x in every if x not in self.known]
        if len(self.known) + len(new) > self.most:  # runs are kept in mind for later batches, as far as there is room
            self.known.clear()
            self.holding.clear()
            new = list(every)
        if new:
            self.learn(new)
        out: dict[int, list[int]] = {}
        for n, own in enumerate(runs):
            for i in {i for x in own & self.holding.keys() for i in self.holding[x]}:
                out.setdefault(i, []).append(n)
        for i, t in self.others:
            if held := [n for n, x in enumerate(texts) if t in x]:
                out[i] = held
        return {i: np.array(x) for i, x in out.items()}


def ranked_evidence(base: DataFrame, questions: DataFrame, bare: DataFrame | None = None) -> DataFrame:
    """``profile, query, chunks, relevant, first_relevant_rank, top_relevant, top_other``: where the first chunk with a required term stands among all chunks of a profile, by
    cosine rounded to six digits, ties to the smaller item.

    ``base``: ``profile, item, space, v, text``; ``questions``, a stated set that is held by the driver and shared: ``query, space, v, terms``, and ``ranked``, if given, whether a rank is asked for
    (else it is null). Two passes over ``base``, each summed per task: the best relevant and other chunks first, then how many chunks stand before the best relevant one. The second reads
    no texts (``bare``, if given, has the same rows without them) and meets only questions whose best other chunk isn't below the best relevant one, as that is first otherwise. Each term is looked for once in the different words of a batch,
    not in each text for each question."""
    spark = base.sparkSession
    groups: dict[tuple, tuple[list, list, list, list]] = {}
    number: dict[str, int] = {}
    flag = F.col("ranked") if "ranked" in questions.columns else F.lit(True)
    for q, space, v, terms, ranked in questions.select("query", "space", F.col("v").cast("array<double>"), "terms", flag).collect():
        ids, vs, ts, wanted = groups.setdefault((space, len(v)), ([], [], [], []))
        wanted.append(bool(ranked))
        x = np.array(v, dtype=np.float64)
        ids.append(q)
        vs.append(x / np.linalg.norm(x))
        ts.append(tuple(sorted({number.setdefault(t, len(number)) for t in terms or []})))
    names = {g: ids for g, (ids, *_) in groups.items()}
    place = {g: n for n, g in enumerate(groups)}
    shared = spark.sparkContext.broadcast((list(number), {g: (np.stack(vs), ts) for g, (_, vs, ts, _) in groups.items()}))
    plain = [F.col("profile").cast("string"), F.col("item").cast("string"), F.col("space").cast("string"), F.col("v").cast("array<double>")]
    picked = base.select(*plain, tx.fold(F.coalesce("text", F.lit(""))).alias("text"))

    def parts_of(batches: Iterator[pa.RecordBatch], some: dict[tuple, np.ndarray] | None = None) -> Iterator[tuple[str, tuple, np.ndarray, pa.RecordBatch, Iterator[tuple[int, np.ndarray, np.ndarray]]]]:
        """(profile, space and length, unit vectors, rows in order of their items, slices of cosines in single precision) of each profile and space of a batch; with all questions or ``some``."""
        for b in whole_batches(batches, 10_000):
            b = b.take(pc.sort_indices(b.column(1)))
            rows: dict[tuple, list[int]] = {}
            for j, (p, s, n) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), pc.list_value_length(b.column(3)).to_pylist())):
                if (s, n) in shared.value[1] and (some is None or (p, (s, n)) in some):
                    rows.setdefault((p, s, n), []).append(j)
            for (p, s, n), at in rows.items():
                own = b.take(pa.array(at))
                x = own.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                qm = shared.value[1][s, n][0]
                qm = qm if some is None else qm[some[p, (s, n)]]
                low, low_q = x.astype(np.float32).T, qm.astype(np.float32)
                yield p, (s, n), x, own, ((lo, qm[lo : lo + SLICE], low_q[lo : lo + SLICE] @ low) for lo in range(0, len(qm), SLICE))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from best_evidence(parts_of(batches), shared.value[0], {g: ts for g, (_, ts) in shared.value[1].items()}, place)

    found = picked.mapInArrow(best, "profile string, g int, q int, chunks long, relevant long, cosine double, item string, other double")
    first = F.min_by(F.struct("cosine", "item"), F.when(F.col("item").isNotNull(), F.struct(-F.col("cosine"), F.col("item"))))
    per = found.groupBy("profile", "g", "q").agg(F.sum("chunks").alias("chunks"), F.sum("relevant").alias("relevant"), first.alias("b"), F.max("other").alias("top_other"))
    per = per.select("profile", "g", "q", "chunks", "relevant", F.col("b.cosine").alias("top_relevant"), F.col("b.item").alias("item"), "top_other").toArrow()
    of = list(groups)
    bar: dict[tuple, tuple[list, list, list]] = {}  # of each profile and space the questions to be ranked, the levels and items of their best relevant chunks
    rows = []
    for p, g, q, chunks, relevant, cosine, item, other in zip(*(c.to_pylist() for c in per.columns)):
        ranked = item is not None and groups[of[g]][3][q]
        ahead_of_all = ranked and (other is None or cosine > other)
        rows.append((p, names[of[g]][q], chunks, relevant, cosine, other, 1 if ahead_of_all else None))
        if ranked and not ahead_of_all:
            for held, x in zip(bar.setdefault((p, of[g]), ([], [], [])), (q, cosine, item)):
                held.append(x)
    bars = spark.sparkContext.broadcast({k: (np.array(q), np.array(level), np.array(items, dtype=object)) for k, (q, level, items) in bar.items()})

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for p, g, x, own, slices in parts_of(batches, {k: q for k, (q, _, _) in bars.value.items()}):
            _, level, items = bars.value[p, g]
            n = total.setdefault((p, g), np.zeros(len(level), dtype=np.int64))
            here = np.searchsorted(np.array(own.column(1).to_pylist(), dtype=object), items)  # where a question's item stands, or would
            near = rough(x.shape[1])
            for lo, qm, cos in slices:
                least, most = ((level[lo : lo + SLICE] + d).astype(np.float32) for d in (-near, near))
                above = np.array([np.count_nonzero(c > m) for c, m in zip(cos, most)])
                all_ = np.array([np.count_nonzero(c >= m) for c, m in zip(cos, least)])
                # cosines next to the bar are compared in double precision and rounded figures
                if len(some := np.flatnonzero(all_ != above)):
                    r, c = places_of((cos[some] >= least[some, None]) & (cos[some] <= most[some, None]))
                    r = some[r]
                    value, bar = np.round(cosines(qm, x, r, c), 6), level[lo + r]
                    np.add.at(above, r, (value > bar) | (value == bar) & (c < here[lo + r]))
                n[lo : lo + SLICE] += above
        for (p, g), n in total.items():
            q = bars.value[p, g][0]
            yield pa.RecordBatch.from_arrays([pa.array([p] * len(q), pa.string()), pa.array(np.full(len(q), place[g]), pa.int32()), pa.array(q, pa.int32()), pa.array(n)], names=["profile", "g", "q", "n"])

    ahead = (base if bare is None else bare).select(*plain).mapInArrow(before, "profile string, g int, q int, n long").groupBy("profile", "g", "q").agg((F.sum("n") + 1).alias("counted"))
    ids = spark.createDataFrame(pa.table({"g": pa.array([place[g] for g, x in names.items() for _ in x], pa.int32()), "q": pa.array([q for x in names.values() for q in range(len(x))], pa.int32()), "query": pa.array([q for x in names.values() for q in x], pa.string())}))
    table = spark.createDataFrame(rows, "profile string, query string, chunks long, relevant long, top_relevant double, top_other double, known long")
    joined = table.join(ahead.join(ids, ["g", "q"]).select("profile", "query", "counted"), ["profile", "query"], "left")
    return joined.withColumn("first_relevant_rank", F.coalesce("known", "counted")).drop("known", "counted")


def best_evidence(parts: Iterator[tuple], terms: list[str], wanted: dict[tuple, list[tuple[int, ...]]], place: dict[tuple, int]) -> Iterator[pa.RecordBatch]:
    """``profile, g, q, chunks, relevant, cosine, item, other``: of a task's rows, a row per profile and question, whatever the number of batches: how many hold a required term, the best that does, and
    the best cosine of those that don't. Single precision tells which may be the best, double precision and rounded figures decide."""
    finder, held = TermFinder(terms), {}
    none = np.zeros(0, dtype=np.int64)
    for p, g, x, own, slices in parts:
        many, near = len(wanted[g]), 2 * rough(x.shape[1])
        state = held.setdefault((p, g), [0, np.zeros(many, np.int64), np.full(many, -np.inf), np.full(many, None, dtype=object), np.full(many, -np.inf)])
        state[0] += len(own)
        _, relevant, top, item, other = state
        items = own.column(1).to_pylist()
        holders = finder.holders(own.column(4).to_pylist())
        sets: dict[tuple, np.ndarray] = {}
        for lo, qm, cos in slices:
            rel = []
            for key in wanted[g][lo : lo + SLICE]:
                if key not in sets:
                    with_ = [holders[t] for t in key if t in holders]
                    sets[key] = np.unique(np.concatenate(with_)) if len(with_) > 1 else with_[0] if with_ else none
                rel.append(sets[key])
            size = np.array([len(c) for c in rel])
            relevant[lo : lo + SLICE] += size
            r, c = np.repeat(np.arange(len(rel)), size), np.concatenate(rel)
            if len(c):
                value, cos[r, c] = cos[r, c], -np.inf
                most = np.full(len(rel), -np.inf)
                most[size > 0] = np.maximum.reduceat(value, (np.cumsum(size) - size)[size > 0])
                fine = np.flatnonzero(value >= np.maximum(most, top[lo : lo + SLICE])[r] - near)
                r, c = r[fine], c[fine]
                value = np.round(cosines(qm, x, r, c), 6)
                order = np.lexsort((c, -value, r))  # rows are in order of their items
                for j in order[np.r_[True, r[order][1:] != r[order][:-1]]].tolist() if len(order) else []:
                    q = lo + r[j]
                    if value[j] > top[q] or value[j] == top[q] and items[c[j]] < item[q]:
                        top[q], item[q] = value[j], items[c[j]]
            most = cos.max(axis=1)
            some = np.flatnonzero((most > -np.inf) & (most >= other[lo : lo + SLICE] - near))
            if len(some):
                r, c = places_of(cos[some] >= (most[some] - near)[:, None])
                np.maximum.at(other, lo + some[r], np.round(cosines(qm, x, some[r], c), 6))
    for (p, g), (n, relevant, top, item, other) in held.items():
        q = np.arange(len(top))
        columns = [pa.array([p] * len(q), pa.string()), pa.array(np.full(len(q), place[g]), pa.int32()), pa.array(q, pa.int32()), pa.array(np.full(len(q), n)), pa.array(relevant), pa.array(top, mask=top == -np.inf), pa.array(item, pa.string()), pa.array(other, mask=other == -np.inf)]
        yield pa.RecordBatch.from_arrays(columns, names=["profile", "g", "q", "chunks", "relevant", "cosine", "item", "other"])


def query_metrics(ranked: DataFrame, expected: DataFrame) -> DataFrame:
    """Per profile and question: gate, reciprocal rank, recall at 1 and 3 and margin of answerable questions; of the others whether the refusal is right."""
    m = ranked.join(expected, "query")
    answer = F.col("expected_status") == "answerable"
    rank = F.col("first_relevant_rank")
    of = lambda c: F.when(answer, c)
    return m.select(
        "profile", "query", "expected_status", F.col("relevant").alias("relevant_chunk_count"), F.when(F.col("relevant") > 0, "supporting_book_terms_found").otherwise("no_supporting_book_relation").alias("answer_gate"), of(rank).alias("first_relevant_rank"),
        of(F.round(F.coalesce(1 / rank, F.lit(0.0)), 6)).alias("mrr"), of(F.coalesce(rank == 1, F.lit(False)).cast("int")).alias("recall_at_1"), of(F.coalesce(rank <= 3, F.lit(False)).cast("int")).alias("recall_at_3"),
        of(F.round(F.coalesce("top_relevant", F.lit(-1.0)) - F.coalesce("top_other", F.lit(-1.0)), 6)).alias("margin"), F.when(~answer, (F.col("relevant") == 0).cast("int")).alias("refusal_correct"),
    )


def profile_metrics(metrics: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per profile the means of ``query_metrics``, the number of chunks and whether each has a source and a page to cite."""
    mean = lambda c, n, d: F.round(F.avg(c), d).alias(n)
    g = metrics.groupBy("profile").agg(mean("mrr", "mean_mrr", 6), mean("recall_at_1", "answer_recall_at_1", 6), mean("recall_at_3", "answer_recall_at_3", 6), mean("margin", "mean_evidence_margin", 4), mean("refusal_correct", "refusal_precision", 6))
    c = chunks.groupBy("profile").agg(F.count("*").alias("chunk_count"), F.when(F.bool_and((F.length("source_id") > 0) & (F.col("pdf_page") > 0)), 1.0).otherwise(0.0).alias("citation_completeness"))
    return g.join(c, "profile")


def select_profile(profiles: DataFrame) -> DataFrame:
    """One row ``selected, verdict``: of the profiles with all four metrics at 1 the one with the best reciprocal rank, recall, margin and then the fewest chunks, ties to the smaller
    name; no profile and ``hold_for_evidence`` if there is none."""
    ok = (F.col("mean_mrr") == 1) & (F.col("answer_recall_at_1") == 1) & (F.col("refusal_precision") == 1) & (F.col("citation_completeness") == 1)
    order = F.struct(-F.col("mean_mrr"), -F.col("answer_recall_at_1"), -F.col("mean_evidence_margin"), F.col("chunk_count"), F.col("profile"))
    one = profiles.agg(F.min_by("profile", F.when(ok, order)).alias("selected"), F.count_if(ok).alias("n"))
    return one.select(F.when(F.col("n") > 0, F.col("selected")).alias("selected"), F.when(F.col("n") > 0, "promote").otherwise("hold_for_evidence").alias("verdict"))


SELECTION = "struct<items:array<struct<evidence_ids:array<int>,support_quote:string>>>"


def valid_selections(payloads: DataFrame, evidence: DataFrame, most: int = 6, least_quote: int = 20) -> DataFrame:
    """``query, place, record_id, evidence_ids, support_quote``: the items of a selection (``query, payload`` as JSON) that hold: all ids name evidence of one record, the quotation has
    ``least_quote`` characters and stands in one of the texts; one item a record, the first ``most`` of a question. ``evidence`` has ``query, ordinal, record_id, text``."""
    items = payloads.select("query", F.posexplode(F.from_json("payload", SELECTION)["items"]).alias("at", "i")).select("query", "at", "i.evidence_ids", tx.joined_quote(F.col("i.support_quote")).alias("quote"))
    items = items.filter((F.size("evidence_ids") > 0) & (F.length("quote") >= least_quote))
    cited = items.select("query", "at", "quote", F.size("evidence_ids").alias("asked"), F.explode("evidence_ids").alias("ordinal")).join(evidence, ["query", "ordinal"])
    g = cited.groupBy("query", "at").agg(F.count("*").alias("got"), F.max("asked").alias("asked"), F.min("record_id").alias("record_id"), F.countDistinct("record_id").alias("records"), F.bool_or(F.contains(tx.joined_quote(F.col("text")), F.col("quote"))).alias("stands"))
    good = g.filter("got = asked AND records = 1 AND stands").groupBy("query", "record_id").agg(F.min("at").alias("at"))
    good = good.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("at"))).filter(F.col("place") <= most)
    return good.join(items, ["query", "at"]).select("query", "place", "record_id", F.array_distinct("evidence_ids").alias("evidence_ids"), F.col("quote").alias("support_quote"))


PAIR = r"([\x{3400}-\x{9fff}]{1,16})[（(]([A-Z][A-Za-z.-]*(?:\s+[A-Za-z.-]+){0,5})[）)]"


def entity_pairs(texts: DataFrame, key: str, text: str, allowed: DataFrame) -> DataFrame:
    """``key, display, latin, authorized``: names in ideographs followed by a Latin one in brackets. A pair is authorized if ``allowed`` (``display, scientific``) has it, the Latin names
    compared by their first two words."""
    pairs = F.explode(F.array_distinct(F.arrays_zip(F.regexp_extract_all(text, F.lit(PAIR), F.lit(1)).alias("display"), F.regexp_extract_all(text, F.lit(PAIR), F.lit(2)).alias("latin"))))
    two = lambda c: F.slice(F.regexp_extract_all(F.lower(c), F.lit("[a-z][a-z.-]*"), F.lit(0)), 1, 2)
    p = texts.select(F.col(key), pairs.alias("p")).select(key, F.col("p")["display"].alias("display"), F.col("p")["latin"].alias("latin")).withColumn("two", two(F.col("latin")))
    a = allowed.select("display", two(F.col("scientific")).alias("two")).filter(F.size("two") == 2).distinct().withColumn("ok", F.lit(True))
    return p.join(a, ["display", "two"], "left").select(key, "display", "latin", F.coalesce("ok", F.lit(False)).alias("authorized"))


MARK = r"\[E\d+(?:\s*,\s*E\d+)*\]"


def rendered_citations(texts: DataFrame, key: str, text: str, record: str, evidence: DataFrame) -> DataFrame:
    """``key, rendered``: texts whose citation marks are replaced by the labels of the evidence they name; numbers that name none are left out, and a mark that names none stays.

    ``evidence`` has ``record, ordinal, label``. Texts without marks come out as they are."""
    marks = texts.select(key, record, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(MARK), F.lit(0)))).alias("mark"))
    numbers = marks.select(key, record, "mark", F.posexplode(F.regexp_extract_all("mark", F.lit(r"E(\d+)"), F.lit(1))).alias("at", "n")).withColumn("ordinal", F.col("n").cast("int"))
    named = numbers.join(evidence.withColumnRenamed("record", record), [record, "ordinal"]).groupBy(key, "mark").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "label"))), lambda x: x["label"]), "; ").alias("labels"))
    swaps = named.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("mark", F.concat(F.lit("["), "labels", F.lit("]")).alias("to")))).alias("swaps"))  # the marks of one text
    j = texts.select(key, F.col(text).alias("t")).join(swaps, key, "left")
    done = F.aggregate(F.coalesce("swaps", F.array().cast("array<struct<mark:string,to:string>>")), F.col("t"), lambda t, s: F.replace(t, s["mark"], s["to"]))
    return j.select(key, done.alias("rendered"))
