"""Verified links between texts that share MinHash band keys.

``bands`` has a row (key, band, id) for each band key of each distinct text.  The
links found join any two texts that share a key and whose sets of shingles
have a Jaccard similarity of at least ``share`` (in 100ths), up to what
earlier links join already; so their components are those of all such pairs.

* Stars: under every key each text is compared with the smallest id.  The
  smallest id per key is a minimum that is aggregated before its shuffle; the
  pairs are as many as the rows.
* Rest: keys under which texts of several components still meet are cut into
  blocks of members, and every pair of blocks is one unit of work.  A unit
  compares members of different components inside its task and returns only
  members worth a full comparison, then only links that join something new.
  No pairs of a group are written out.

Every comparison is first an estimate from the sketches, where there are
any, and then an exact count on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, frugal, materialise, release
from vellum.llm.graph import Forest, components

BLOCK = 1024                # members of a block
BLOCK_BYTES = 16 << 20      # or bytes of their sets


def u64(binary) -> np.ndarray:
    return np.frombuffer(binary, dtype=np.uint64)


def enough(common, a, b, share: int):
    """100 * intersection >= share * union, in whole numbers."""
    return 100 * common >= share * (a + b - common)


def exact_links(pairs: DataFrame, share: int) -> DataFrame:
    """Rows (a, b, set_a, set_b) -> (a, b) where the sets are similar enough."""
    def run(batches):
        for rb in batches:
            keep, last, mine = [], None, None
            for i, (sa, sb) in enumerate(zip(rb.column(2), rb.column(3))):
                raw = sa.as_buffer()
                if last is None or raw != last:
                    last, mine = raw, u64(raw)
                other = u64(sb.as_buffer())
                at = np.searchsorted(mine, other)
                at[at == len(mine)] = 0
                common = int((mine[at] == other).sum()) if len(mine) else 0
                if enough(common, len(mine), len(other), share):
                    keep.append(i)
            yield rb.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.mapInArrow(frugal(run), "a bigint, b bigint")


def units(rows: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal values in the first ``n_keys`` columns."""
    held: list[pa.RecordBatch] = []
    current = None
    for rb in rows:
        if not rb.num_rows:
            continue
        keys = np.stack([np.asarray(rb.column(k)) for k in range(n_keys)], axis=1)
        cuts = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, [len(keys)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            key = tuple(int(x) for x in keys[lo])
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(rb.slice(lo, hi - lo))
    if held:
        yield current, pa.Table.from_batches(held)


def blocks(members: DataFrame) -> DataFrame:
    """Rows (key, band, id, component, size) -> one row (key, p, q, ...) for each pair of
    blocks p <= q of its key that the member belongs to.

    There may be nearly as many keys as members, however small Spark takes their totals to be
    (members may come from an explode), so they are not broadcast."""
    totals = members.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).alias("_n")).hint("merge")
    rows = members.join(totals, "key").withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_n")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1))
    rows = rows.withColumn("_o", other)
    return rows.select("key", F.least("_b", "_o").alias("p"), F.greatest("_b", "_o").alias("q"),
                       (F.col("_b") <= F.col("_o")).alias("first"), "band", "id", "component", "size")


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "id")


def candidates_in_units(rows: DataFrame, similar: Callable) -> DataFrame:
    """Members (key, p, q, band, id, component, size) that have, in their unit, a partner of
    another component which ``similar`` (sketches, sizes, band) does not rule out."""
    def run(batches):
        for (key, p, q), t in units(batches, 3):
            ids, comp, size = (np.asarray(t[c].combine_chunks()) for c in ("id", "component", "size"))
            sketch = np.stack([np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in t["sketch"]])
            band = int(t["band"][0].as_py())
            first = np.asarray(t["first"].combine_chunks().cast(pa.int8())).astype(bool)
            hit = np.zeros(len(ids), dtype=bool)
            for i in range(len(ids)):
                apart = comp != comp[i]
                if p != q:
                    apart &= first != first[i]
                others = np.nonzero(apart)[0]
                others = others[others > i]
                if len(others):
                    ok = similar(sketch[i], sketch[others], size[i], size[others], band)
                    hit[others[ok]] = True
                    hit[i] |= bool(ok.any())
            if hit.any():
                at = pa.array(np.nonzero(hit)[0])
                yield from t.select(["key", "p", "q", "first", "band", "id", "component", "size"]).take(at).combine_chunks().to_batches()

    schema = "key bigint, p bigint, q bigint, first boolean, band int, id bigint, component bigint, size bigint"
    return by_unit(rows).mapInArrow(frugal(run), schema)


def links_in_units(rows: DataFrame, share: int) -> DataFrame:
    """Members with their sets -> links between different components, those that
    join something new in their unit."""
    def run(batches):
        for (_, p, q), t in units(batches, 3):
            ids, comp = (np.asarray(t[c].combine_chunks()) for c in ("id", "component"))
            first = np.asarray(t["first"].combine_chunks().cast(pa.int8())).astype(bool)
            sets = [u64(x.as_buffer()) for x in t["members"]]
            size = np.array([len(s) for s in sets])
            offs = np.concatenate([[0], np.cumsum(size)])
            every, column = np.unique(np.concatenate(sets), return_inverse=True)
            forest, got = Forest(), []
            here = np.zeros(len(every), dtype=bool)
            for i in range(len(ids) - 1):
                apart = comp[i + 1:] != comp[i]
                if p != q:
                    apart &= first[i + 1:] != first[i]
                if not apart.any():
                    continue
                mine = column[offs[i]:offs[i + 1]]
                here[mine] = True
                common = np.add.reduceat(here[column[offs[i + 1]:]].astype(np.int64), offs[i + 1:-1] - offs[i + 1])
                here[mine] = False
                for j in np.nonzero(apart & enough(common, size[i], size[i + 1:], share))[0] + i + 1:
                    if forest.join(int(comp[i]), int(comp[j])):
                        got.append((ids[i], ids[j]))
            if got:
                a = np.array(got, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    return by_unit(rows).mapInArrow(frugal(run), "a bigint, b bigint")


def link_components(bands: DataFrame, sizes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], share: int,
                    star_filter: Callable[[DataFrame], DataFrame], similar: Callable | None) -> DataFrame:
    """``node, component`` over the texts that have links.

    ``bands``: (key, band, id), repeated rows allowed; ``sizes``: (id, size[, sketch]), one row per id;
    ``sets_of``: (id) -> (id, members: the sorted distinct 64-bit shingles);
    ``star_filter``: drops pairs (a, b) that cannot be similar enough.
    """
    scratch = Scratch()
    tops = bands.groupBy("key").agg(F.min("id").alias("top"), F.max("id").alias("_last")).where("top <> _last")
    # both sides of this join are plain shuffles, and nothing after it needs its
    # partitioning: Spark can split the partition of a hot key
    tops = materialise(tops.select("key", "top"))
    repeated = materialise(bands.join(tops, "key"))
    shared = scratch.write(repeated.distinct())
    release(repeated, tops)
    stars = shared.where("id <> top").select(F.col("top").alias("a"), F.col("id").alias("b")).distinct()
    stars = materialise(star_filter(stars))
    ids = stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id"))).distinct()
    sets = materialise(sets_of(ids))
    with_sets = (stars.join(sets.select(F.col("id").alias("b"), F.col("members").alias("set_b")), "b")
                 .join(sets.select(F.col("id").alias("a"), F.col("members").alias("set_a")), "a")
                 .select("a", "b", "set_a", "set_b"))
    links = scratch.write(exact_links(with_sets, share))
    release(sets, stars)
    found = components(links)
    more = shared.join(found, shared["id"] == found["node"], "left").select(
        "key", "band", "id", F.coalesce("component", "id").alias("component"))
    # keys with two members are done; others may hold pairs that no star has compared
    open_keys = more.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"),
                                        F.count("*").alias("_n")).where("_n > 2 and _lo <> _hi").select("key")
    members = scratch.write(more.join(open_keys, "key", "left_semi").join(sizes.select("id", "size"), "id"))
    if members.isEmpty():
        scratch.drop()
        return found
    rows = blocks(members)
    if similar is not None:
        rows = candidates_in_units(rows.join(sizes.select("id", "sketch"), "id").select(
            "key", "p", "q", "first", "band", "id", "component", "size", "sketch"), similar)
    rows = scratch.write(rows)
    sets = sets_of(rows.select("id").distinct())
    extra = links_in_units(rows.join(sets, "id").select(
        "key", "p", "q", "first", "id", "component", "members"), share)
    extra = scratch.write(extra)
    if not extra.isEmpty():
        found = components(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
                           .unionByName(extra))
    scratch.drop()
    return found
