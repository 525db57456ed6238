"""Substring deduplication by paragraph MinHash banding.

Paragraphs are the lines of a text.  A line of more than ``LONG`` words is cut
further, before each word whose hash is the smallest among the ``REACH`` words
on either side; such cuts depend on the words near them only, so a passage
inside two different long lines is cut alike.  Paragraphs of fewer than
``MIN_WORDS`` words, which have no shingle, are compared only as part of the
passages below.

Each distinct paragraph gets ``BANDS`` keys of ``ROWS`` minimum hashes of its
five-word shingles.  Paragraphs that share a key are compared on their full
sets (exact Jaccard similarity of 0.8 or more, see ``near``); links make
components; of all occurrences of a component's paragraphs the first, by
document id and place, stays, and the others are removed.

Recall of a pair with similarity s: 1 - (1 - s^3)^8, that is 0.997 at 0.8,
0.9996 at 0.85, 0.99997 at 0.9, and 1 for equal paragraphs.

Besides, every run of ``PASSAGE`` words (a window, over line ends too) that
occurred before, in the order of document id and place, goes: passages inside
lines that differ otherwise, or wrapped at other places, are found whole and to
their ends.  A window belongs to its run of ``SEED`` words with the smallest
hash, its anchor; so equal windows have equal anchors.  Only anchors that
repeat are looked at.  The windows of one anchor are compared as a whole first
(their extent), then one by one for one copy of each extent.  Each word that
goes has a copy at an earlier place, so the earliest copy of every word stays.
A window whose earlier copy lies in a paragraph that goes for one that is not
equal to it stays, and so does one that overlaps its earlier copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import Scratch, frugal, materialise, prepare, read_table, release, slices, spread_small, unused
from vellum.llm.near import link_components
from vellum.llm.repeats import smallest_of_next
from vellum.llm.words import _STEP, Words, _powers, _room, mix64, not_space, window_hashes

WIDTH, SHARE = 5, 80
MIN_WORDS = WIDTH
LONG, REACH = 150, 12
BANDS, ROWS = 8, 3
PASSAGE, SEED = 50, 13
_PLACE = np.uint64(32)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_turn = np.random.default_rng(515)
_TURN = [(np.uint64(a) | np.uint64(1), np.uint64(b)) for a, b in
         _turn.integers(1, 2**63, (BANDS * ROWS, 2), dtype=np.uint64)]
_FOLD = _turn.integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


class Paragraphs:
    """The paragraphs of a string column: word offsets ``first`` (paragraph p has
    the words first[p] .. first[p + 1]), ``row``, ``index`` in its row, ``begin``
    (byte place in the column's data; a paragraph reaches to the next one's
    begin or the end of its text)."""

    def __init__(self, column: pa.Array):
        w = self.words = Words(column, not_space())
        n = len(w.hash)
        lines = np.unique(np.concatenate([w.offs[:-1], np.nonzero(w.data == 10)[0] + 1]))
        lines = lines[lines < len(w.data)]
        line = np.searchsorted(lines, w.start, side="right") - 1
        opens = np.ones(n, dtype=bool)
        opens[1:] = line[1:] != line[:-1]
        begin = np.where(opens, lines[line], w.start) if n else w.start
        at = np.nonzero(opens)[0]
        length = np.diff(np.append(at, n))
        for i in np.nonzero(length > LONG)[0]:
            opens[at[i]:at[i] + length[i]] |= content_cuts(w.hash[at[i]:at[i] + length[i]])
        self.first = np.append(np.nonzero(opens)[0], n)
        self.begin = begin[self.first[:-1]]
        self.row = np.searchsorted(w.first, self.first[:-1], side="right") - 1
        per_row = np.searchsorted(self.row, np.arange(len(w.offs)))
        self.index = np.arange(len(self.row)) - per_row[self.row]
        self.n_words = np.diff(self.first)

    def ids(self) -> np.ndarray:
        """64-bit hash of each paragraph's sequence of words."""
        return sequence_hash(word_sums(self.words.hash), self.first[:-1], self.first[1:])

    def of_words(self, at: np.ndarray) -> np.ndarray:
        """Index, in its row, of the paragraph that holds each word."""
        return self.index[np.searchsorted(self.first, at, side="right") - 1]


def word_sums(h: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * _powers(_room(len(h)), int(_STEP))[:len(h)], out=sums[1:], dtype=np.uint64)
    return sums


def sequence_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    back = _powers(_room(len(sums) - 1), int(_STEP_BACK))
    return mix64((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64))


def anchored_windows(w: Words) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: row, first and last start (words of the
    column), hash of the anchor, hash of the extent."""
    n = len(w.hash)
    if n < PASSAGE:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums, at = word_sums(w.hash), np.arange(n - SEED + 1)
    seeds = sequence_hash(sums, at, at + SEED)
    packed = (seeds >> _PLACE << _PLACE) | at.astype(np.uint64)
    place = (smallest_of_next(packed, PASSAGE - SEED + 1) & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[:len(place)]
    starts = np.nonzero(np.arange(len(place)) + PASSAGE <= w.first[row + 1])[0]
    place = place[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    lo, hi = starts[new], starts[np.append(new[1:], True)] if len(starts) else starts
    return row[lo], lo, hi, seeds[place[new]], sequence_hash(sums, lo, hi + PASSAGE)


def content_cuts(h: np.ndarray) -> np.ndarray:
    low = np.ones(len(h), dtype=bool)
    low[0] = False
    for k in range(1, REACH + 1):
        low[k:] &= h[k:] < h[:-k]
        low[:-k] &= h[:-k] <= h[k:]
    # a cut keeps its distance from the line's ends, as from other cuts
    low[:REACH] = low[len(h) - REACH + 1:] = False
    return low


def chosen_words(p: Paragraphs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some paragraphs, one after the other, and their offsets."""
    n = p.n_words[which]
    offs = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(p.first[:-1][which], n) + np.arange(offs[-1]) - np.repeat(offs[:-1], n)
    return p.words.hash[at], offs


def keys_of(shingles: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Band keys of paragraphs, one row each."""
    out = np.empty((len(offs) - 1, BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(offs) - 1, band + 1, dtype=np.uint64)
        for k in range(ROWS):
            a, b = _TURN[band * ROWS + k]
            lowest = np.minimum.reduceat(mix64(shingles * a + b), offs[:-1])
            key = mix64((key ^ lowest) * _FOLD[k])
        out[:, band] = key
    return out


def paragraph_table(rows: DataFrame) -> DataFrame:
    """(doc_id, tid, text) -> (doc_id, tid, place, pid, size, keys) per paragraph that is
    long enough; ``size`` in words."""
    def run(batches):
        for rb in slices(batches, "text"):
            p = Paragraphs(rb.column(2))
            which = np.nonzero(p.n_words >= MIN_WORDS)[0]
            if not len(which):
                continue
            words, offs = chosen_words(p, which)
            shingles, at = window_hashes(words, offs, WIDTH)
            keys = keys_of(shingles, at).view(np.int64)
            # up to three shingles: only equal sets are similar enough, and these agree in every key
            n_keys = np.where(np.diff(at) <= 3, 1, BANDS)
            keys, ends = keys[np.arange(BANDS) < n_keys[:, None]], np.concatenate([[0], np.cumsum(n_keys)])
            row = pa.array(p.row[which])
            yield pa.RecordBatch.from_arrays(
                [rb.column(0).take(row), rb.column(1).take(row), pa.array(p.index[which]),
                 pa.array(p.ids()[which].view(np.int64)), pa.array(p.n_words[which]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))],
                ["doc_id", "tid", "place", "pid", "size", "keys"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "tid", "text").mapInArrow(
        frugal(run), f"doc_id {kind}, tid bigint, place bigint, pid bigint, size bigint, keys array<bigint>")


def paragraph_sets(rows: DataFrame) -> DataFrame:
    """(text, places) -> (id, members) of the paragraphs at these places."""
    def run(batches):
        for rb in slices(batches, "text"):
            p = Paragraphs(rb.column(0))
            places = rb.column(1)
            row, place = np.asarray(pa.compute.list_parent_indices(places)), np.asarray(places.flatten())
            per_row = np.searchsorted(p.row, np.arange(rb.num_rows + 1))
            which = per_row[row] + place
            if not len(which):
                continue
            words, offs = chosen_words(p, which)
            shingles, at = window_hashes(words, offs, WIDTH)
            sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(p.ids()[which].view(np.int64)), pa.array(sets, pa.binary())],
                                             ["id", "members"])

    return rows.select("text", "places").mapInArrow(frugal(run), "id bigint, members binary")


def anchor_table(rows: DataFrame) -> DataFrame:
    """(doc_id, tid, text) -> (doc_id, tid, lo, n, p_lo, p_hi, anchor, extent) per run of ``n``
    windows from word ``lo`` on; ``p_lo`` and ``p_hi`` are the outer paragraphs."""
    def run(batches):
        for rb in slices(batches, "text"):
            p = Paragraphs(rb.column(2))
            row, lo, hi, anchor, extent = anchored_windows(p.words)
            if len(row):
                yield window_batch(rb, p, row, lo, hi, [anchor, extent], ["anchor", "extent"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "tid", "text").mapInArrow(
        frugal(run), f"doc_id {kind}, tid bigint, lo bigint, n bigint, p_lo bigint, p_hi bigint, anchor bigint, extent bigint")


def window_batch(rb: pa.RecordBatch, p: Paragraphs, row, lo, hi, hashes, names) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [rb.column(0).take(at), rb.column(1).take(at), pa.array(lo - p.words.first[row]), pa.array(hi - lo + 1),
         pa.array(p.of_words(lo)), pa.array(p.of_words(hi + PASSAGE - 1)), *(pa.array(h.view(np.int64)) for h in hashes)],
        ["doc_id", "tid", "lo", "n", "p_lo", "p_hi", *names])


def single_windows(rows: DataFrame) -> DataFrame:
    """(doc_id, tid, text, runs) -> one row like those of ``anchor_table``, with the hash
    ``window``, for each window of these runs (structs of lo, n)."""
    def run(batches):
        for rb in slices(batches, "text"):
            p, runs = Paragraphs(rb.column(2)), rb.column(3)
            own, parts = np.asarray(pa.compute.list_parent_indices(runs)), runs.flatten()
            lo, n = (np.asarray(parts.field(k)) for k in (0, 1))
            lo = lo + p.words.first[own]
            offs = np.cumsum(n) - n
            at = np.repeat(lo - offs, n) + np.arange(n.sum())
            if len(at):
                yield window_batch(rb, p, np.repeat(own, n), at, at,
                                   [sequence_hash(word_sums(p.words.hash), at, at + PASSAGE)], ["window"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "tid", "text", "runs").mapInArrow(
        frugal(run), f"doc_id {kind}, tid bigint, lo bigint, n bigint, p_lo bigint, p_hi bigint, window bigint")


def merged_passages(runs: DataFrame) -> DataFrame:
    """(doc_id, tid, runs: structs of lo, n, first) -> (doc_id, tid, passages): runs of
    windows that overlap or touch are one passage."""
    kind = runs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for rb in batches:
            out = []
            for own in rb.column(2).to_pylist():
                got = []
                for r in own:
                    end = r["lo"] + r["n"] + PASSAGE - 1
                    if got and r["lo"] <= got[-1]["begin"] + got[-1]["words"]:
                        got[-1]["words"] = max(got[-1]["words"], end - got[-1]["begin"])
                    else:
                        got.append({"begin": r["lo"], "words": end - r["lo"], "first_doc_id": r["first"]["doc_id"],
                                    "first_begin": r["first"]["lo"]})
                out.append(got)
            kinds = pa.struct([("begin", pa.int64()), ("words", pa.int64()),
                               ("first_doc_id", rb.schema.types[0]), ("first_begin", pa.int64())])
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(out, pa.list_(kinds))],
                                             ["doc_id", "tid", "passages"])

    return runs.select("doc_id", "tid", "runs").mapInArrow(
        run, f"doc_id {kind}, tid bigint, passages {_passages(kind)}")


def _passages(kind: str) -> str:
    return f"array<struct<begin:bigint,words:bigint,first_doc_id:{kind},first_begin:bigint>>"


def repeated_passages(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, tid, passages) of the documents that have repeated passages; ``gone`` as
    from ``removals``."""
    at, scratch = F.struct("doc_id", "tid", "lo", "p_lo", "p_hi"), Scratch()
    every = materialise(anchor_table(spread_small(rows)))
    again = materialise(every.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor"))
    table = scratch.write(every.join(again, "anchor"))
    release(every, again)
    firsts = scratch.write(table.groupBy("extent").agg(
        F.min(at).alias("first"), F.min("anchor").alias("anchor"), F.min("n").alias("n"), F.count("*").alias("_n")))
    same = table.join(scratch.write(firsts.where("_n > 1").select("extent", "first")), "extent")
    # anchors with several extents: their windows one by one, of the first copy of each
    several = firsts.groupBy("anchor").agg(F.count("*").alias("_k")).where("_k > 1").select("anchor")
    want = firsts.join(several, "anchor").groupBy(F.col("first.doc_id").alias("_d"), F.col("first.tid").alias("_t")).agg(
        F.collect_list(F.struct(F.col("first.lo").alias("lo"), "n")).alias("runs"))
    texts = rows.join(want, (F.col("tid") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    windows = scratch.write(single_windows(texts))
    first = windows.groupBy("window").agg(F.min(at).alias("first"), F.count("*").alias("_n")).where("_n > 1")
    each = windows.join(scratch.write(first.select("window", "first")), "window")
    columns = ["doc_id", "tid", "lo", "n", "first"]
    late = same.select(*columns).unionByName(each.select(*columns))
    within = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tid") == F.col("first.tid"))
    late = late.where(~within | (F.col("lo") >= F.col("first.lo") + F.col("n") + PASSAGE - 1))
    near = gone.where("not equal").groupBy(F.col("doc_id").alias("_d"), F.col("tid").alias("_t")).agg(
        F.collect_set("place").alias("_near"))
    late = late.join(near, (F.col("first.tid") == F.col("_t")) & F.col("first.doc_id").eqNullSafe(F.col("_d")), "left").where(
        F.col("_near").isNull() | ~F.exists("_near", lambda x: x.between(F.col("first.p_lo"), F.col("first.p_hi"))))
    runs = late.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_set(F.struct("lo", "n", "first"))).alias("runs"))
    out = materialise(merged_passages(runs))
    scratch.drop()
    return out


def removals(docs: DataFrame, share: int = SHARE, counted: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """``(doc_id, tid, n_paragraphs)`` (None unless ``counted``) and ``(doc_id, tid, place, size, component, first, equal)`` of
    all paragraphs that go; ``tid`` is a hash of the text, ``first`` the occurrence that stays,
    ``equal`` if it has the same words."""
    rows, scratch = text_rows(docs), Scratch()
    table = scratch.write(paragraph_table(spread_small(rows)))
    where = F.struct("doc_id", "tid", "place")
    nodes = scratch.write(table.groupBy("pid").agg(
        F.min(where).alias("at"), F.max(where).alias("last"), F.min("size").alias("size")))
    bands = table.select(F.posexplode("keys").alias("band", "key"), F.col("pid").alias("id")).select("key", "band", "id")

    def sets_of(ids: DataFrame) -> DataFrame:
        want = nodes.join(ids, nodes["pid"] == ids["id"], "left_semi").select("at.*")
        want = want.groupBy(F.col("doc_id").alias("_d"), F.col("tid").alias("_t")).agg(
            F.array_sort(F.collect_set("place")).alias("places"))
        texts = rows.join(want, (F.col("tid") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")))
        return paragraph_sets(texts).groupBy("id").agg(F.first("members").alias("members"))

    found = link_components(bands, nodes.select(F.col("pid").alias("id"), "size"), sets_of, share, lambda s: s, None)
    named = nodes.join(found, F.col("pid") == F.col("node"), "left").where(
        "component is not null or at <> last").select("pid", "at", F.coalesce("component", "pid").alias("component"))
    best = named.groupBy("component").agg(F.min("at").alias("first"))
    gone = named.join(best, "component").select("pid", "component", "first", F.col("at").eqNullSafe(F.col("first")).alias("equal"))
    out = table.select("doc_id", "tid", "place", "size", "pid").join(gone, "pid").where(
        ~F.struct("doc_id", "tid", "place").eqNullSafe(F.col("first")))
    counts = materialise(table.groupBy("doc_id", "tid").agg(F.count_distinct("place").alias("n_paragraphs"))) if counted else None
    out = materialise(out.select("doc_id", "tid", "place", "size", "component", "first", "equal").distinct())
    scratch.drop()
    return counts, out


def text_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("tid"), "text").where("text is not null")


def per_document(gone: DataFrame) -> DataFrame:
    """One row per (doc_id, tid): the removed places in order, with what stays for each."""
    item = F.struct("place", F.col("first.doc_id").alias("first_doc_id"), F.col("first.place").alias("first_place"), "size")
    return gone.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_list(item)).alias("removed"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_paragraphs (of those long enough),
    n_removed, removed_words, removed (places, each with the document and place of
    the occurrence that stays), kept_in (ids of the documents that keep them), and
    passages (first word and number of words of each repeated passage, which may
    take in words of removed paragraphs, with the document and word where an
    earlier copy begins).

    Null, empty and short texts have no paragraphs; rows that agree in id and
    text are one document given twice and get the same result; null ids come
    first in order; other columns are not read; an empty table gives an empty
    result.
    """
    prepare(docs.sparkSession)
    counts, gone = removals(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("tid")).alias("r")
    same = lambda other: (F.col("r.tid") == F.col(f"{other}.tid")) & F.col("r.doc_id").eqNullSafe(F.col(f"{other}.doc_id"))
    found = repeated_passages(text_rows(docs), gone)
    out = rows.join(counts.alias("c"), same("c"), "left").join(per_document(gone).alias("g"), same("g"), "left")
    out = out.join(found.alias("f"), same("f"), "left")
    passages = F.coalesce("passages", F.array().cast(found.schema["passages"].dataType))
    removed = F.coalesce("removed", F.array().cast("array<struct<place:bigint,first_doc_id:bigint,first_place:bigint,size:bigint>>"))
    return out.select("r.doc_id", F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), removed.alias("removed"),
                      passages.alias("passages")).select(
        "doc_id", "n_paragraphs", F.size("removed").cast("bigint").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, x: a + x["size"]).alias("removed_words"), "removed",
        F.array_sort(F.array_distinct(F.transform("removed", lambda x: x["first_doc_id"]))).alias("kept_in"),
        "passages")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts removed paragraphs and repeated passages out of the texts (``n_chars``
    follows); a document of which no word is left goes.  Null and empty texts have no
    paragraphs and stay; rows that agree in id and text are one document and are cut alike; null
    ids come first in order; other columns, whatever their names, go through; an empty
    table stays empty."""
    prepare(spark)
    names = docs.columns
    tid, places_, passages_, left_, d_, t_ = unused(docs, "_tid", "_places", "_passages", "_left", "_d", "_t")
    _, gone = removals(docs, counted=False)
    places = gone.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_set("place")).alias(places_))
    found = repeated_passages(text_rows(docs), gone).select(
        F.col("doc_id").alias(d_), F.col("tid").alias(t_), F.transform(
            "passages", lambda x: F.struct(x["begin"].alias("begin"), x["words"].alias("words"))).alias(passages_))
    both = places.join(found, (F.col("tid") == F.col(t_)) & F.col("doc_id").eqNullSafe(F.col(d_)), "full").select(
        F.coalesce("doc_id", d_).alias(d_), F.coalesce("tid", t_).alias(t_), places_, passages_)
    rows = docs.withColumn(tid, F.xxhash64("text"))
    src = rows.join(both, (F.col(tid) == F.col(t_)) & F.col("doc_id").eqNullSafe(F.col(d_)), "left").select(
        *names, places_, passages_)
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for rb in slices(batches, "text"):
            columns = list(rb.columns[:-2])
            cut = np.nonzero(np.asarray(pa.compute.or_(rb.column(rb.num_columns - 2).is_valid(),
                                                       rb.column(rb.num_columns - 1).is_valid())))[0]
            left = np.ones(rb.num_rows, dtype=bool)
            if len(cut):
                texts = columns[text_at].to_pylist()
                chars = columns[chars_at].to_pylist() if chars_at is not None else None
                some = rb.take(pa.array(cut))
                p = Paragraphs(some.column(text_at))
                w = p.words
                per_row = np.searchsorted(p.row, np.arange(len(cut) + 1))
                parts = zip(cut, some.column(some.num_columns - 2).to_pylist(), some.column(some.num_columns - 1).to_pylist())
                stays = np.ones(len(w.data), dtype=bool)
                for k, (r, gone_here, passages) in enumerate(parts):
                    ends = np.append(p.begin[per_row[k]:per_row[k + 1]], w.offs[k + 1])
                    for i in gone_here or []:
                        stays[ends[i]:ends[i + 1]] = False
                    for x in passages or []:
                        at = w.first[k] + x["begin"]
                        stays[w.start[at]:w.end[at + x["words"] - 1]] = False
                    own = slice(w.offs[k], w.offs[k + 1])
                    texts[r] = w.data[own][stays[own]].tobytes().decode()
                    left[r] = stays[w.start[w.first[k]:w.first[k + 1]]].any()
                    if chars is not None:
                        chars[r] = len(texts[r])
                columns[text_at] = pa.array(texts, pa.string())
                if chars is not None:
                    columns[chars_at] = pa.array(chars, rb.schema.types[chars_at])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(left)], [*names, left_])

    schema = T.StructType(list(docs.schema.fields)).add(left_, "boolean")
    return src.mapInArrow(frugal(run), schema).where(F.col(left_)).drop(left_)
