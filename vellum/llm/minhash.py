"""MinHash near-duplicate removal with HyperMinHash registers.

A text's distinct word shingles are dealt to ``BUCKETS`` buckets; a bucket keeps
the smallest hash in it in compressed form: the number of leading zeros (6
bits) and the next ``MANTISSA`` bits, 16 bits together.  A bucket that no
shingle falls into takes the register of another one, in an order of its own
that is the same for all texts (so a short text fills all registers, and two
texts' registers still agree with the probability of their Jaccard
similarity).

``BANDS`` bands of ``ROWS`` registers give keys: texts with similarity 0.8
share none with probability (1 - 0.8^4)^32 = 5e-8.  Pairs under a key are
first estimated from all registers, corrected for registers that agree by
chance, and dropped only if the estimate is ``SLACK`` standard deviations under
the threshold; what remains is counted on the full sets (``near``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, frugal, materialise, prepare, read_table, slices, spread_small, unused
from vellum.llm.near import link_components
from vellum.llm.words import Words, mix64, not_space

WIDTH, SHARE = 5, 80          # words of a shingle, similarity in 100ths
QUERY_WIDTH = 4               # the contract's width for the registered query
BUCKETS, MANTISSA, ROWS = 128, 10, 4
BANDS = BUCKETS // ROWS
SLACK = 5.0
_PLACE_BITS = BUCKETS.bit_length() - 1
_ORDER = np.stack([np.random.default_rng(90_001 + b).permutation(BUCKETS) for b in range(BUCKETS)])
_TURN = np.random.default_rng(77).integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted distinct shingle hashes (at least one)."""
    edges = (np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - _PLACE_BITS))
    at = np.searchsorted(shingles, edges)
    filled = np.diff(np.append(at, len(shingles))) > 0
    low = shingles[np.minimum(at, len(shingles) - 1)] << np.uint64(_PLACE_BITS)
    # leading zeros: 64 less the bit length, which frexp gives for the upper half
    upper = (low >> np.uint64(32)).astype(np.float64)
    lower = (low & np.uint64(0xFFFF_FFFF)).astype(np.float64)
    zeros = np.where(upper > 0, 32 - np.frexp(upper)[1], 64 - np.frexp(lower)[1]).astype(np.uint64)
    zeros = np.minimum(zeros, np.uint64(62))
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    own = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if filled.all():
        return own
    take = _ORDER[np.arange(BUCKETS), np.argmax(filled[_ORDER], axis=1)]
    return np.where(filled, own, own[take])


def band_keys(regs: np.ndarray) -> np.ndarray:
    parts = regs.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64((key ^ parts[:, k]) * _TURN[k])
    return key


def chance(size_a, size_b) -> np.ndarray:
    """Probability that the registers of two disjoint sets agree."""
    a, b = np.asarray(size_a) / BUCKETS, np.asarray(size_b) / BUCKETS
    level = np.arange(63)[:, None] * 1.0
    rate = a + b
    inside = np.exp(-rate * 2.0 ** (-level - 1)) - np.exp(-rate * 2.0 ** -level)
    return (2.0 ** (-level - 1 - MANTISSA) * a * b / rate * inside).sum(axis=0)


def may_be_similar(agree: np.ndarray, size_a, size_b, share: int = SHARE) -> np.ndarray:
    """False only where sizes or the corrected estimate rule the similarity out."""
    size_a, size_b = np.broadcast_arrays(np.atleast_1d(size_a).astype(np.float64), np.atleast_1d(size_b).astype(np.float64))
    low, high = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    by_chance = BUCKETS * chance(low, high)
    estimate = (agree - by_chance) / (BUCKETS - by_chance)
    t = share / 100
    slack = SLACK * np.sqrt(t * (1 - t) / np.minimum(low, BUCKETS))
    return (100 * low >= share * high) & (estimate >= t - slack)


def similar_in_band(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray, band: int) -> np.ndarray:
    """For units: also only in the first band that the two share."""
    same = others == one
    ok = may_be_similar(same.sum(axis=1), size, sizes)
    shared = same.reshape(len(others), BANDS, ROWS).all(axis=2)
    return ok & (np.argmax(shared, axis=1) == band) & shared[:, band]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Rows (id, doc_id, text) -> (id, doc_id, size, sketch, keys); a text without
    words has size 0, no sketch and no keys."""
    def run(batches):
        for rb in slices(batches, "text"):
            w = Words(rb.column(2), not_space())
            hashes, offs = w.shingles(width)
            sizes, regs, keys = [], [], []
            for lo, hi in zip(offs[:-1], offs[1:]):
                own = np.unique(hashes[lo:hi])
                sizes.append(len(own))
                r = registers(own) if len(own) else None
                regs.append(None if r is None else r.tobytes())
                keys.append([] if r is None else band_keys(r).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "doc_id", "size", "sketch", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("id", "doc_id", "text").mapInArrow(
        frugal(run), f"id bigint, doc_id {kind}, size bigint, sketch binary, keys array<bigint>")


def shingle_sets(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """(id, members) per row: the sorted distinct shingles."""
    def run(batches):
        for rb in slices(batches, text):
            w = Words(rb.column(1), not_space())
            hashes, offs = w.shingles(width)
            sets = [np.unique(hashes[lo:hi]).tobytes() for lo, hi in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(sets, pa.binary())], ["id", "members"])

    return docs.select("id", text).mapInArrow(frugal(run), "id bigint, members binary")


def drop_unlike_stars(sizes: DataFrame, share: int):
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                a, b = (np.frombuffer(b"".join(rb.column(k).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for k in (2, 4))
                ok = may_be_similar((a == b).sum(axis=1), np.asarray(rb.column(3)), np.asarray(rb.column(5)), share)
                yield rb.select([0, 1]).filter(pa.array(ok))

    def keep(stars: DataFrame) -> DataFrame:
        one = sizes.select(F.col("id").alias("a"), F.col("sketch").alias("_sa"), F.col("size").alias("_na"))
        two = sizes.select(F.col("id").alias("b"), F.col("sketch").alias("_sb"), F.col("size").alias("_nb"))
        return (stars.join(two, "b").join(one, "a").select("a", "b", "_sa", "_na", "_sb", "_nb")
                .mapInArrow(run, "a bigint, b bigint"))

    return keep


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    share: int = SHARE) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id, kept.

    Texts are linked if their sets of word shingles (A-Z as a-z) have a
    Jaccard similarity of ``share`` hundredths or more; the component's id is
    the smallest id among its rows.  A text without words, null or empty, is
    linked with nothing and has its own id as component; rows with a null id
    take part, and a component of such rows alone has a null id and is kept.
    Repeated rows are copies of each other.  Other columns are not read; an
    empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = _rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    groups = duplicate_groups(rows, width, share)
    # without words: a component of its own
    own = F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id"))
    out = rows.select("id", "doc_id").join(groups, "id").select(
        "doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _rows(docs: DataFrame) -> DataFrame:
    """Equal texts are one node of the graph."""
    return docs.withColumn("id", F.xxhash64(F.coalesce("text", F.lit(""))))


def duplicate_groups(rows: DataFrame, width: int, share: int) -> DataFrame:
    """Rows (id, doc_id, text) -> per distinct text: id, size, least (smallest
    doc_id of its component) and leader (the text's id that has it)."""
    spread, scratch = spread_small(rows.select("id", "doc_id", "text")), Scratch()
    nodes = scratch.write(sketches(spread, width).groupBy("id").agg(
        F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("sketch").alias("sketch"),
        F.first("keys").alias("keys")))
    bands = nodes.select(F.posexplode("keys").alias("band", "key"), "id").select("key", "band", "id")

    def sets_of(ids: DataFrame) -> DataFrame:
        # one row for each text: the one with the smallest doc_id
        want = nodes.select("id", "least").join(ids, "id", "left_semi").withColumnRenamed("id", "_id")
        texts = rows.join(want, (F.col("id") == F.col("_id")) & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
        return shingle_sets(texts, width).groupBy("id").agg(F.first("members").alias("members"))

    found = link_components(bands, nodes.select("id", "size", "sketch"), sets_of, share,
                            drop_unlike_stars(nodes, share), similar_in_band)
    named = nodes.select("id", "least", "size").join(found, F.col("id") == F.col("node"), "left").select(
        "id", "least", "size", F.coalesce("component", "id").alias("component"))
    # a null id comes after all others
    first = F.min(F.struct(F.col("least").isNull(), "least", "id"))
    best = named.groupBy("component").agg(first.alias("_first"))
    out = materialise(named.join(best, "component").select("id", "size", F.col("_first.least").alias("least"),
                                                           F.col("_first.id").alias("leader")))
    scratch.drop()
    return out


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=QUERY_WIDTH)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, the one with the smallest id (of
    repeated rows, one); texts without words, null or empty, stay as they are, repeated rows of
    them once.  A null id comes after all others.  Other columns, whatever their names, go
    through; of repeated rows that differ in them, any one stays.  An empty table
    stays empty."""
    text_id, of, least, size, nth = unused(docs, "_text_id", "_chosen", "_least", "_size", "_nth")
    rows = docs.withColumn(text_id, F.xxhash64(F.coalesce("text", F.lit(""))))
    groups = duplicate_groups(rows.select(F.col(text_id).alias("id"), "doc_id", "text"), WIDTH, SHARE)
    chosen = groups.where((F.col("size") == 0) | (F.col("id") == F.col("leader"))).select(
        F.col("id").alias(of), F.col("least").alias(least), F.col("size").alias(size))
    kept = rows.join(chosen, (F.col(text_id) == F.col(of)) & (
        (F.col(size) == 0) | F.col("doc_id").eqNullSafe(F.col(least))))
    number = F.row_number().over(Window.partitionBy(text_id, "doc_id").orderBy(text_id))
    return kept.withColumn(nth, number).where(F.col(nth) == 1).select(*docs.columns)


#: Every pair that shares a shingle, counted; components by reachability.
ORACLE_SQL = r"""
WITH RECURSIVE
t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, least(t.doc_id, coalesce(b, t.doc_id)) AS component_id,
       t.doc_id <= coalesce(b, t.doc_id) AS kept
FROM t LEFT JOIN n ON t.doc_id = n.doc_id LEFT JOIN least ON least.a = t.doc_id
"""
