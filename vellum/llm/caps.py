"""Embedding near-duplicates by spherical-cap filters.

A vector (turned by a fixed random rotation and cut into blocks) falls into
every cap whose direction it is close to.  The directions are a product
code: one of ``words`` random codewords in each block, so their number is
words ** blocks while a vector is compared with words * blocks codewords only;
list decoding grows the combinations block by block and drops those that
cannot reach the threshold any more.  Vectors are joined on (label,
dimension, cap) and verified by the cosine in double precision.

The codes are chosen for the number of vectors with the same label: a cap
holds about ``PER_CAP`` vectors by chance (within bounds), and there are so many
that two vectors at the threshold have ``COMMON`` caps in common on average.
They are dealt over ``CODES`` independent codes, as the scores of one product
code vary too much from vector to vector, the more so the fewer codewords a
block has to choose from; so there are two blocks as long as words allow.  Of
2,000 random pairs at the threshold (64 dimensions) the worst had 20 caps in
common at 2,000 vectors, 17 at 100,000, 10 at 1 million, 14 at 3 million and 13
at 10 and at 100 million.

A cap that many vectors fall into is cut into blocks of members, and each
pair of blocks is a unit of work of its own.  Vectors travel to the units as
8-bit integers with the length of their rounding error, which bounds the
error of a product: members without a partner in reach go no further.  The
others follow with all components; a unit multiplies two small matrices and
returns one row for each member that has links: their number and the
smallest member it is connected with.  A pair that meets in several
caps is counted in the first of them only.  Equal vectors are one node.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import materialise, prepare, read_table, spread_small
from vellum.llm.graph import components
from vellum.llm.near import blocks, by_unit, units

COSINE = 0.93
PER_CAP, COMMON, CODES = 64, 60.0, 60
LEAST_SHARE, MOST_SHARE = 1e-5, 1e-2     # of all vectors in a cap
MOST_WORDS = 1 << 11                     # of a block: few blocks, as scores of few words vary together
SEED = 4_242


@functools.lru_cache(64)
def _both_above(z: float, rho: float) -> float:
    """Probability that two standard normal values with correlation rho exceed z."""
    x = np.linspace(z, z + 12, 20_001)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    tail = np.array([math.erfc(v) / 2 for v in (z - rho * x) / math.sqrt(2 * (1 - rho * rho))])
    return float(np.trapezoid(density * tail, x))


class Code:
    """One product code for vectors of one dimension: ``z`` is the threshold in
    standard deviations of a random direction's score."""

    def __init__(self, dim: int, n_vectors: int, cosine: float, nth: int = 0):
        share = min(MOST_SHARE, max(LEAST_SHARE, PER_CAP / max(n_vectors, 1)))
        lo, hi = 0.0, 8.0
        for _ in range(60):                       # z with tail probability ``share``
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if math.erfc(mid / math.sqrt(2)) / 2 > share else (lo, mid)
        self.dim, self.z, self.nth = dim, lo, nth
        caps = COMMON / CODES / _both_above(round(lo, 6), cosine)
        self.blocks = min(dim, 2 if caps <= MOST_WORDS ** 2 else 3 if caps <= MOST_WORDS ** 3 else 4)
        self.words = max(2, math.ceil(caps ** (1 / self.blocks)))
        rng = np.random.default_rng([SEED, dim, self.words, nth])
        turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        self.turn = turn
        self.cuts = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.code = [rng.standard_normal((b - a, self.words)) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def caps_of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cap) of all caps that each unit vector falls into."""
        x = unit @ self.turn
        scores = [x[:, a:b] @ c for a, b, c in zip(self.cuts[:-1], self.cuts[1:], self.code)]
        best_after = [sum(s.max(axis=1) for s in scores[k + 1:]) if k + 1 < self.blocks else np.zeros(len(x))
                      for k in range(self.blocks)]
        row, cap, reached = np.arange(len(x)), np.full(len(x), self.nth, dtype=np.int64), np.zeros(len(x))
        for k, s in enumerate(scores):
            total = reached[:, None] + s[row]
            at, word = np.nonzero(total + best_after[k][row][:, None] >= self.z)
            row, cap, reached = row[at], cap[at] * self.words + word, total[at, word]      # the code's number leads
        return row, cap


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)          # keeps squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@functools.lru_cache(8)
def _codes(dim: int, n_vectors: int, cosine: float) -> list[Code]:
    return [Code(dim, n_vectors, cosine, nth) for nth in range(CODES)]


def with_caps(nodes: DataFrame, counts: dict[int, int], cosine: float) -> DataFrame:
    """``nodes`` (id, label, copies, vector, least_id) with ``caps`` (sorted), ``small`` (the unit
    vector in 8 bits) and ``error`` (length of what the 8 bits leave out)."""
    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            vectors = rb.column(rb.schema.get_field_index("vector"))
            dims = np.asarray(pa.compute.list_value_length(vectors))
            caps, small, error = [None] * rb.num_rows, [None] * rb.num_rows, np.zeros(rb.num_rows)
            for dim in np.unique(dims):
                codes = _codes(int(dim), counts[int(dim)], cosine)
                at = np.nonzero(dims == dim)[0]
                for lo in range(0, len(at), 128):
                    part = at[lo:lo + 128]
                    x = unit_rows(vectors.take(pa.array(part)), int(dim))
                    pairs = [c.caps_of(x) for c in codes]
                    row, cap = np.concatenate([r for r, _ in pairs]), np.concatenate([c for _, c in pairs])
                    order = np.lexsort((cap, row))
                    ends = np.searchsorted(row[order], np.arange(len(part) + 1))
                    step = np.abs(x).max(axis=1, keepdims=True) / 127
                    rounded = np.rint(x / step).astype(np.int8)
                    error[part] = np.linalg.norm(x - rounded * step, axis=1)
                    for k, r in enumerate(part):
                        caps[r] = cap[order[ends[k]:ends[k + 1]]]
                        small[r] = rounded[k].tobytes()
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(caps, pa.list_(pa.int64())), pa.array(small, pa.binary()),
                                              pa.array(error)], [*rb.schema.names, "caps", "small", "error"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return spread_small(nodes).mapInArrow(run, f"{fields}, caps array<bigint>, small binary, error double")


def sides(t: pa.Table, p: int, q: int, hit: np.ndarray) -> np.ndarray:
    """Pairs of a unit: any two members of one block, or one of either block."""
    np.fill_diagonal(hit, False)
    if p != q:
        first = np.asarray(t["first"].combine_chunks().cast(pa.int8())).astype(bool)
        hit &= first[:, None] != first[None, :]
    return hit


def in_reach(rows: DataFrame, cosine: float) -> DataFrame:
    """(key, p, q, first, cap, id, small, error) -> those members that may have a link."""
    def run(batches):
        for (_, p, q), t in units(batches, 3):
            if t.num_rows < 2:
                continue
            small = np.stack([np.frombuffer(x.as_buffer(), dtype=np.int8) for x in t["small"]]).astype(np.float32)
            small /= np.linalg.norm(small, axis=1, keepdims=True)
            # |x - unit(rounded)| is at most twice the error, as x is a unit vector
            e = 2 * np.asarray(t["error"].combine_chunks()) + 1e-6
            hit = sides(t, p, q, small @ small.T >= cosine - (e[:, None] + e[None, :] + e[:, None] * e[None, :]))
            at = np.nonzero(hit.any(axis=1))[0]
            if len(at):
                yield from t.select(["key", "p", "q", "first", "cap", "id"]).take(pa.array(at)).combine_chunks().to_batches()

    return by_unit(rows).mapInArrow(run, "key bigint, p bigint, q bigint, first boolean, cap bigint, id bigint")


def links_in_units(rows: DataFrame, cosine: float) -> DataFrame:
    """(key, p, q, first, cap, id, copies, vector, caps) -> (id, links, least)."""
    def run(batches):
        for (_, p, q), t in units(batches, 3):
            ids, copies = (np.asarray(t[c].combine_chunks()) for c in ("id", "copies"))
            if len(ids) < 2:
                continue
            vectors = t["vector"].combine_chunks()
            x = unit_rows(vectors, len(vectors[0]))
            hit = sides(t, p, q, x @ x.T >= cosine)
            if not hit.any():
                continue
            caps = t["caps"].combine_chunks()
            offs, every = np.asarray(caps.offsets) - caps.offsets[0].as_py(), np.asarray(caps.flatten())
            owner = np.repeat(np.arange(len(ids)), np.diff(offs))
            before = every < t["cap"][0].as_py()
            column = np.unique(every[before], return_inverse=True)[1]
            earlier = np.zeros((len(ids), int(column.max()) + 1 if len(column) else 1), dtype=np.float32)
            earlier[owner[before], column] = 1
            here = hit & (earlier @ earlier.T == 0)       # the first cap that the pair shares
            links = here @ copies
            least = ids.copy()
            while True:
                lower = np.minimum(least, np.where(hit, least[None, :], np.iinfo(np.int64).max).min(axis=1))
                if (lower == least).all():
                    break
                least = lower
            at = np.nonzero(hit.any(axis=1))[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(least[at])],
                                             ["id", "links", "least"])

    return by_unit(rows).mapInArrow(run, "id bigint, links bigint, least bigint")


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null and their
    dimensions are equal.  Vectors that are null, empty, zero, or hold null
    or non-finite components link with nothing; their component is their own
    id.  Repeated rows are vectors of their own, linked with each other.
    Null ids take part; a component without any id has a null id.  Other
    columns are not read; an empty table gives an empty result.
    """
    prepare(vectors.sparkSession)
    v = F.col("vector")
    fit = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                     & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull(), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vector"))
    rows = rows.withColumn("node", F.when(fit, F.xxhash64("label", F.size(v), "vector")))
    nodes = rows.where("node is not null").groupBy(F.col("node").alias("id")).agg(
        F.first("label").alias("label"), F.count("*").alias("copies"), F.first("vector").alias("vector"),
        F.min("vec_id").alias("least_id"))
    nodes = materialise(nodes)
    counts = nodes.groupBy("label", F.size("vector").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n"))
    # one number for each dimension
    nodes = materialise(with_caps(nodes, {r["dim"]: r["n"] for r in counts.collect()}, cosine))
    entries = nodes.select("id", "label", F.size("vector").alias("size"), F.explode("caps").alias("band"))
    entries = entries.select(F.xxhash64("label", "size", "band").alias("key"), "band", "id", F.col("id").alias("component"), "size")
    # Spark takes an array for one value when it sizes a table, so what was exploded, and rows with their
    # caps and vectors, look small enough to be broadcast: these joins are asked to shuffle
    some = entries.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key").hint("merge")
    work = blocks(entries.join(some, "key", "left_semi")).select("key", "p", "q", "first", F.col("band").alias("cap"), "id")
    work = in_reach(work.join(nodes.select("id", "small", "error").hint("merge"), "id").select(
        "key", "p", "q", "first", "cap", "id", "small", "error"), cosine)
    found = materialise(links_in_units(work.join(nodes.select("id", "copies", "vector", "caps").hint("merge"), "id").select(
        "key", "p", "q", "first", "cap", "id", "copies", "vector", "caps"), cosine))
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    named = (nodes.select("id", "copies", "least_id").join(linked, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
             .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least_id",
                     F.coalesce("component", "id").alias("group")))
    best = named.groupBy("group").agg(F.min("least_id").alias("component_id"))
    facts = named.join(best, "group").select(F.col("id").alias("_node"), "n_links", "component_id")
    out = rows.select("vec_id", "node").join(facts, F.col("node") == F.col("_node"), "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id")).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


#: All pairs of a label; components by reachability.
ORACLE_SQL = r"""
WITH RECURSIVE
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(least.b, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(least.b, v.vec_id) AS kept
FROM v LEFT JOIN least ON least.a = v.vec_id LEFT JOIN many ON many.a = v.vec_id
"""
