"""Filter interaction audit by failing-id relations.

What a chain of filters removes depends on the order of the chain.  The audit
looks at all orders at once:

1. ``measure`` reads every text once and keeps numbers and a digest only.
2. ``failing_tables`` stores one id table per filter: the rows that fail it,
   whatever other filters say.
3. ``lattice`` walks the sets of filters that may stand before a filter.  A
   filter's removals behind the set ``S + g`` are its removals behind ``S``
   left-anti the ids that fail ``g``; those that left-semi finds there are newly
   redundant.  Each set is reached once, by adding its largest letter last, so
   all sets of one size are one anti join and one semi join over ids, and only
   failing rows take part.  Losses of labelled rows are the same walk begun
   with the failing ids left-semi the labelled ones.
4. ``report`` looks up each prefix of each order.  A row is removed at one
   step exactly, so survivors are the rows less the removals so far.

Rows are told apart by a number given when they are measured (``_row``), so ids
may be null or repeated.  Tables are shuffled on (letter, row), which is unique
in an id table: no key is hot.  Equal texts meet as (digest, smallest id) after
partial aggregation, and the written result joins back in a sort-merge join
whose hot partitions Spark may split.

Defined results: null text is empty text, a null source is the part ``''``;
repeated rows count as often as they stand there; a null id has no smaller id,
is nobody's smaller id and has no labels; a row with several label rows is
good (toxic) if one of them says so; an empty table gives no rows; other
columns are not read, whatever their names.  A text is cut into windows of
``WINDOW`` bytes at white space, so a very long one needs memory for its
distinct words only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import materialise, prepare, read_table, spread_small

WINDOW = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def production_filters() -> dict[str, Column]:
    """The five filters' failure conditions, by letter; ``E`` needs the table
    and is the flag that ``with_copies`` adds."""
    return {"A": F.col("n_words") < 50,
            "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
            "C": 100 * F.col("n_upper") > 5 * F.col("n_points"),
            "D": F.col("n_marks") > 0,
            "E": F.col("is_copy")}


MEASURES = ("n_words long, n_distinct long, n_upper long, n_points long, n_marks long, digest binary")


def text_measures(data: bytes) -> tuple[int, int, int, int, int, bytes]:
    """Words, distinct words, A-Z, code points, special marks and SHA-256."""
    words, upper, points, marks, at = 0, 0, 0, 0, 0
    seen: set[bytes] = set()
    digest = hashlib.sha256()
    while at < len(data):
        cut = _SPACE.search(data, at + WINDOW)
        end = cut.start() if cut else len(data)
        piece = data[at:end] if at or end < len(data) else data
        digest.update(piece)
        # bytes.split() parts at the white space of ASCII: \x20 and \x09-\x0D
        found = piece.split()
        words += len(found)
        seen.update(found)
        upper += len(piece) - len(piece.translate(None, _UPPER))
        marks += len(piece) - len(piece.translate(None, _MARKS))
        points += len(piece.decode("utf-8", "replace"))
        at = end
    return words, len(seen), upper, points, marks, digest.digest()


def measure(docs: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per document: ``_row, _id, part`` and the measures; no text."""
    src = spread_small(docs.select(F.col(id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                                   F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text")))
    src = src.withColumn("_row", F.monotonically_increasing_id())
    id_type = dict(src.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MEASURES.split(", ")]
        for rb in batches:
            if not rb.num_rows:
                continue
            text_at = rb.schema.get_field_index("_text")
            found = list(zip(*(text_measures(v.as_py()) for v in rb.column(text_at)), strict=True))
            yield pa.RecordBatch.from_arrays(
                [rb.column("_row"), rb.column("_id"), rb.column("part"),
                 *(pa.array(v, pa.int64()) for v in found[:-1]), pa.array(found[-1], pa.binary())],
                names=["_row", "_id", "part", *names])

    return materialise(src.select("_row", "_id", "part", "_text")
                       .mapInArrow(run, f"_row long, _id {id_type}, part string, {MEASURES}"))


def with_copies(measured: DataFrame) -> DataFrame:
    """Adds ``is_copy``: the text of a row with a smaller id is the same."""
    first = materialise(measured.where(F.col("_id").isNotNull()).groupBy("digest")
                        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
                        .where(F.col("_last") > F.col("_first")).select("digest", "_first"))
    later = F.col("_id") > F.col("_first")
    return measured.join(first, "digest", "left").withColumn("is_copy", F.coalesce(later, F.lit(False)))


def failing_tables(measured: DataFrame, filters: dict[str, Column]) -> dict[str, DataFrame]:
    """One stored id table ``(_row, _id, part)`` per filter."""
    flagged = materialise(measured.select("_row", "_id", "part", *[cond.alias(k) for k, cond in filters.items()]))
    return {k: materialise(flagged.where(F.col(k)).select("_row", "_id", "part")) for k in filters}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def lattice(failing: dict[str, DataFrame], marks: dict[str, DataFrame]) -> DataFrame:
    """Counts ``(part, kind, filter, before, n)`` over all sets ``before`` (bit k:
    the k-th filter) that may stand before a filter.

    ``kind``: ``removed``; each name of ``marks`` (tables of ids): those of the
    removed that are in it; ``newly``: rows that fail the filter and that
    the largest letter of ``before`` removes, none of the smaller ones.
    """
    letters = list(failing)
    bit = {k: 1 << n for n, k in enumerate(letters)}
    ids = _union([t.withColumn("filter", F.lit(k)) for k, t in failing.items()])
    start = ids.withColumn("kind", F.lit("removed"))
    for name, table in marks.items():
        labelled = table.select(F.col(table.columns[0]).alias("_id"))
        start = start.unionByName(ids.join(labelled, "_id", "left_semi").withColumn("kind", F.lit(name)))
    level = materialise(start.select("_row", "part", "filter", "kind", F.lit(0).alias("before")))
    by = ["part", "kind", "filter", "before"]
    counts = [level.groupBy(by).agg(F.count(F.lit(1)).alias("n"))]
    fails = ids.select(F.col("filter").alias("_next"), "_row")
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(bit[k]).alias("b")) for k in letters])
    for _ in letters[1:]:
        larger = F.filter(steps, lambda s: (s["b"] > F.col("before")) & (s["k"] != F.col("filter")))
        wider = level.select("_row", "part", "filter", "kind", "before", F.explode(larger).alias("_g")).select(
            "_row", "part", "filter", "kind", (F.col("before") + F.col("_g.b")).alias("before"), F.col("_g.k").alias("_next"))
        stays = wider.join(fails, ["_next", "_row"], "left_anti").drop("_next")
        goes = (wider.join(fails, ["_next", "_row"], "left_semi").drop("_next")
                .where(F.col("kind") == "removed").withColumn("kind", F.lit("newly")))
        both = materialise(stays.unionByName(goes))
        counts.append(both.groupBy(by).agg(F.count(F.lit(1)).alias("n")))
        level = both.where(F.col("kind") != "newly")
    return materialise(_union(counts))


def _mask(letters: Sequence[str], chosen: Sequence[str]) -> int:
    return sum(1 << letters.index(k) for k in chosen)


def report(measured: DataFrame, counts: DataFrame, letters: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """Every prefix of every order, per part; zeros included."""
    spark = measured.sparkSession
    n = len(letters)
    full = (1 << n) - 1
    # tables over sets and orders of filters: their size depends on the number of filters only
    behind = [(f, _mask(letters, s)) for f in letters for r in range(n)
              for s in combinations([k for k in letters if k != f], r)]
    heads = [(f, _mask(letters, s), _mask(letters, s[:i])) for f in letters for r in range(1, n)
             for s in combinations([k for k in letters if k != f], r) for i in range(1, r + 1)]
    orders = [("".join(p), i + 1, p[i], _mask(letters, p[:i])) for p in permutations(letters) for i in range(n)]
    heads_table = spark.createDataFrame(heads, "filter string, before int, head int")
    orders_table = spark.createDataFrame(orders, "filter_order string, step int, filter string, before int")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")))
    here = counts.where(F.col("kind") != "newly").groupBy("part", "filter", "before").agg(
        of("removed").alias("removed"), *[of(m).alias(m) for m in marks])
    redundant = (counts.where(F.col("kind") == "newly").withColumnRenamed("before", "head")
                 .join(F.broadcast(heads_table), ["filter", "head"])
                 .groupBy("part", "filter", "before").agg(F.sum("n").alias("redundant")))
    size = F.bit_count(F.col("before"))
    weight = F.element_at(F.array(*[F.lit(factorial(r) * factorial(n - 1 - r)) for r in range(n)]), size + 1)
    bits = F.element_at(F.create_map(*[x for k in letters for x in (F.lit(k), F.lit(full ^ (1 << letters.index(k))))]), F.col("filter"))
    whole = here.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weight).alias("shapley"),
        F.sum(F.when(F.col("before") == bits, F.col("removed"))).alias("unique_fails"))
    parts = measured.groupBy("part").agg(F.count(F.lit(1)).alias("_total"))
    prefixes = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(s).alias("before")) for f, s in behind])
    told = (parts.select("part", "_total", F.explode(prefixes).alias("_s")).select("part", "_total", "_s.filter", "_s.before")
            .join(here, ["part", "filter", "before"], "left").join(redundant, ["part", "filter", "before"], "left")
            .join(whole, ["part", "filter"], "left")
            .select("part", "filter", "before", "_total", *[zero(c) for c in ("removed", "redundant", *marks, "shapley", "unique_fails")]))
    rows = told.join(F.broadcast(orders_table), ["filter", "before"])
    so_far = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    return rows.select("part", "filter_order", "step", (F.col("_total") - so_far).cast("bigint").alias("kept"),
                       "removed", "redundant", "unique_fails", *marks, "shapley")


def audit(docs: DataFrame, labels: DataFrame, *, filters: dict[str, Column] | None = None, id: str = "doc_id",
          text: str = "text", part: str = "source", label_id: str = "doc_id", good: str = "quality",
          toxic: str = "toxic") -> DataFrame:
    """All orders of ``filters`` (conditions over the measures and ``is_copy``)
    over ``docs``; see the contract columns in ``report``."""
    filters = filters or production_filters()
    measured = measure(docs, id=id, text=text, part=part)
    failing = failing_tables(with_copies(measured), filters)
    marks = {"good_lost": labels.where(F.col(good) == 1).select(label_id),
             "toxic_lost": labels.where(F.col(toxic) == 1).select(label_id)}
    counts = lattice(failing, marks)
    return report(measured, counts, list(filters), list(marks))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
d AS (
  SELECT doc_id, part,
    len(words) < 50 AS fa,
    100 * len(list_distinct(words)) < 65 * len(words) AS fb,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS fc,
    regexp_matches(text, '[#$%&*|]') AS fd,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS fe,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic
  FROM w),
m AS (
  SELECT part, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS fails,
         count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM d GROUP BY ALL),
f(letter, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT f1.letter || f2.letter || f3.letter || f4.letter || f5.letter AS filter_order,
         [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31
    AND len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5),
s AS (
  SELECT filter_order, step, bits[step] AS b, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
r AS (
  SELECT part, filter_order, step, b,
    sum(n) FILTER (WHERE fails & before = 0 AND fails & b = 0) AS kept,
    sum(n) FILTER (WHERE fails & before = 0 AND fails & b > 0) AS removed,
    sum(n) FILTER (WHERE fails & before > 0 AND fails & b > 0) AS redundant,
    sum(n) FILTER (WHERE fails = b) AS unique_fails,
    sum(n_good) FILTER (WHERE fails & before = 0 AND fails & b > 0) AS good_lost,
    sum(n_toxic) FILTER (WHERE fails & before = 0 AND fails & b > 0) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, b), 0)::BIGINT AS shapley
FROM r
"""
