"""Repeated byte strings by prefix-free parsing.

A rolling hash over ``SEED`` bytes triggers phrases: a string of ``LENGTH`` bytes is
dealt to the place, among its first ``SPAN`` places, with the smallest hash (the
first of equal ones).  That depends on the string alone, so all copies of a
string are dealt to places at the same distance from their starts, and a
place owns the strings of one run of starts.

* Dictionary: all strings that a place owns begin with the same bytes after
  it, the phrase of ``LENGTH - SPAN + 1`` bytes.  A phrase that occurs once
  settles its strings: none repeats.  This takes one aggregate over phrase
  hashes and leaves the repetitive part of the corpus.
* Where all strings of a place occur together again (their whole extent and
  the place in it are equal, compared by 128 bits of hashes), all repeat.
* The others are put in suffix order, phrase by phrase: the suffixes of the
  parse that begin with the phrase are sorted, as are the reversed bytes
  before it, each with the lengths of common prefixes.  Together they give
  the order of every owned string: strings with the same distance to the
  phrase are equal if both parts fall into one run of long enough common
  prefixes.  One copy of each settled extent stands in as a witness.

Suffixes are compared up to ``LENGTH`` bytes, all that the question needs.  A
phrase with more than ``GROUP`` different surroundings is not put into one task:
its strings are counted by hash in an aggregate instead.

Passages of ``PASSAGE`` words may have fewer than ``LENGTH`` bytes, so their bytes
stay; the column ``shared`` tells which documents hold one.  Every run of so many
words holds the phrase of ``PHRASE`` words that begins at the smallest hash among
its first places.  A document is shared if such a phrase also occurs in another:
no repeated run of ``PASSAGE`` words is missed, runs of ``PHRASE`` words and more may count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import frugal, materialise, prepare, read_table, slices, spread_small, utf8
from vellum.llm.near import units
from vellum.llm.words import _BASE, _BYTE, _INVERSE, Words, _powers, _room, mix64, not_space, window_hashes

LENGTH, SPAN, SEED = 400, 192, 16
GROUP = 4096
PASSAGE, PHRASE, WORD_SEED = 50, 30, 5
PART = 1 << 19             # words of a long text that are taken at a time
CHUNK = 2 << 20            # bytes that are held as arrays at a time
_PLACE_BITS = 24


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_room(len(data)), int(_BASE))[:len(data)], out=sums[1:], dtype=np.uint64)
    return sums


def substring_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = _powers(_room(len(sums) - 1), int(_INVERSE))
    return mix64((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def smallest_of_next(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of values[i:i + span] for every i with so many values."""
    n = len(values)
    whole = -(-n // span) * span
    grid = np.full(whole, np.iinfo(values.dtype).max, dtype=values.dtype)
    grid[:n] = values
    grid = grid.reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - span + 1], ahead[span - 1:n])


def owned_runs(data: np.ndarray, starts: np.ndarray, length: int, span: int):
    """Phrase places and the runs of the given starts (sorted) that they own:
    place, first start, last start, hash of the phrase, hash of the extent."""
    sums = prefix_sums(data)
    at = np.arange(len(data) - SEED + 1)
    seed = (sums[SEED:] - sums[:-SEED]) * _powers(_room(len(data)), int(_INVERSE))[:len(at)]
    packed = (mix64(seed) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    place = (smallest_of_next(packed, span) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    lo, hi, place = starts[new], starts[np.append(new[1:], True)], place[new]
    phrase = substring_hash(sums, place, place + length - span + 1)
    extent = mix64(substring_hash(sums, lo, hi + length) + (place - lo).astype(np.uint64))
    return place, lo, hi, phrase, extent


def pieces(batches, length: int):
    """(rows' ids, data, row offsets, offset of the first row's part): rows of a few
    megabytes together; a longer text in parts that overlap by length - 1 bytes."""
    for rb in slices(batches, "text", CHUNK):
        rids = np.asarray(rb.column(0))
        data, offs = utf8(rb.column(1))
        if len(data) <= 2 * CHUNK:
            yield rids, data, offs, 0
            continue
        for r in range(len(rids)):
            own = data[offs[r]:offs[r + 1]]
            for x in range(0, max(1, len(own) - length + 1), CHUNK):
                part = own[x:x + CHUNK + length - 1]
                yield rids[r:r + 1], part, np.array([0, len(part)]), x


def phrases(rows: DataFrame, length: int, span: int) -> DataFrame:
    """(rid, text) -> (phrase, extent, rid, place, left, right): the strings that a place
    owns start ``left`` to ``right`` bytes before it."""
    def run(batches):
        for rids, data, offs, base in pieces(batches, length):
            n = np.maximum(np.diff(offs) - length + 1, 0)
            if not n.any():
                continue
            starts = np.repeat(offs[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            place, lo, hi, phrase, extent = owned_runs(data, starts, length, span)
            row = np.searchsorted(offs, lo, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrase.view(np.int64)), pa.array(extent.view(np.int64)), pa.array(rids[row]),
                 pa.array(place - offs[row] + base), pa.array((place - lo).astype(np.int16)), pa.array((place - hi).astype(np.int16))],
                ["phrase", "extent", "rid", "place", "left", "right"])

    return spread_small(rows.select("rid", "text")).mapInArrow(
        run, "phrase bigint, extent bigint, rid bigint, place bigint, left smallint, right smallint")


def with_bytes(rows: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """Members (phrase, rid, place, left, right, open) with the bytes of their extent."""
    kind = "array<struct<place:bigint,left:smallint,right:smallint,phrase:bigint,open:boolean>>"
    wanted = members.groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("place", "left", "right", "phrase", "open"))).cast(kind).alias("wanted"))
    # repeated rows would give a member more than once
    found = rows.select("rid", "text").join(wanted, "rid")

    def run(batches):
        for rb in slices(batches, "text"):
            data, offs = utf8(rb.column(1))
            lists = rb.column(2)
            row = np.asarray(pa.compute.list_parent_indices(lists))
            got = {f.name: np.asarray(x) for f, x in zip(lists.type.value_type, lists.flatten().flatten())}
            lo = offs[row] + got["place"] - got["left"]
            hi = offs[row] + got["place"] - got["right"] + length
            raw = [data[a:b].tobytes() for a, b in zip(lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["phrase"]), pa.array(np.asarray(rb.column(0))[row]), pa.array(got["place"]), pa.array(got["left"]),
                 pa.array(got["right"]), pa.array(got["open"].astype(bool)), pa.array(raw, pa.binary())],
                ["phrase", "rid", "place", "left", "right", "open", "bytes"])

    return found.select("rid", "text", "wanted").mapInArrow(
        run, "phrase bigint, rid bigint, place bigint, left smallint, right smallint, open boolean, bytes binary")


def runs_of_prefixes(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the parts and the common prefix of each with the one before."""
    order = np.array(sorted(range(len(parts)), key=parts.__getitem__))
    grid = np.zeros((len(parts), width), dtype=np.uint8)
    size = np.array([len(parts[i]) for i in order])
    flat = np.frombuffer(b"".join(parts[i] for i in order), dtype=np.uint8)
    grid[np.arange(width) < size[:, None]] = flat
    differ = grid[1:] != grid[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.minimum(common, np.minimum(size[1:], size[:-1]))


def repeated_strings(extents: list[bytes], left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """For members of one phrase: [distance, member] is True where the member's
    string that starts so far (from right.min()) before the phrase equals another's."""
    low, high = int(right.min()), int(left.max())
    distance = np.arange(low, high + 1)[:, None]
    code = np.empty((len(distance), len(extents)), dtype=np.int64)
    after, common = runs_of_prefixes([e[n:] for e, n in zip(extents, left)], length)
    code[:, after] = np.concatenate([np.zeros_like(distance), np.cumsum(common < length - distance, axis=1)], axis=1)
    before, common = runs_of_prefixes([e[:n][::-1] for e, n in zip(extents, left)], max(high, 1))
    classes = np.empty_like(code)
    classes[:, before] = np.concatenate([np.zeros_like(distance), np.cumsum(common < distance, axis=1)], axis=1)
    code = code * len(extents) + classes
    owns = (distance >= right) & (distance <= left)
    code[~owns] = -1 - np.broadcast_to(np.arange(len(extents)), code.shape)[~owns]
    order = np.argsort(code, axis=1, kind="stable")
    ranked = np.take_along_axis(code, order, axis=1)
    same = ranked[:, 1:] == ranked[:, :-1]
    hit = np.zeros(code.shape, dtype=bool)
    hit[:, 1:] |= same
    hit[:, :-1] |= same
    out = np.empty_like(hit)
    np.put_along_axis(out, order, hit, axis=1)
    return out


def spans_in_groups(members: DataFrame, length: int) -> DataFrame:
    """Members with bytes -> (rid, start, stop) covered by their repeated strings."""
    def run(batches):
        for _, t in units(batches, 1):
            if t.num_rows < 2:
                continue
            left, right, place, rid = (np.asarray(t[c].combine_chunks()).astype(np.int64) for c in ("left", "right", "place", "rid"))
            hit = repeated_strings([x.as_py() for x in t["bytes"]], left, right, length)
            hit &= np.asarray(t["open"].combine_chunks().cast(pa.int8())).astype(bool)
            edge = np.diff(np.pad(hit, ((1, 1), (0, 0))).astype(np.int8), axis=0)
            who, first = np.nonzero(edge.T == 1)
            _, after = np.nonzero(edge.T == -1)
            if len(who):
                base = place[who] - right.min()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[who]), pa.array(base - (after - 1)), pa.array(base - first + length)], ["rid", "start", "stop"])

    rows = members.select("phrase", "rid", "place", "left", "right", "open", "bytes")
    return rows.repartition("phrase").sortWithinPartitions("phrase").mapInArrow(run, "rid bigint, start bigint, stop bigint")


def spans_by_count(members: DataFrame, length: int) -> DataFrame:
    """The same by counting the hashes of all owned strings, for phrases with very
    many surroundings."""
    def run(batches):
        for rb in batches:
            for phrase, rid, place, left, right, is_open, raw in zip(*(rb.column(k).to_pylist() for k in range(7))):
                sums = prefix_sums(np.frombuffer(raw, dtype=np.uint8))
                at = np.arange(left - right + 1)
                h = substring_hash(sums, at, at + length)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, phrase)), pa.array(left - at), pa.array(h.view(np.int64)), pa.array(np.full(n, rid)),
                     pa.array(place - left + at), pa.array(np.full(n, is_open))], ["phrase", "distance", "string", "rid", "start", "open"])

    strings = members.select("phrase", "rid", "place", "left", "right", "open", "bytes").mapInArrow(
        run, "phrase bigint, distance bigint, string bigint, rid bigint, start bigint, open boolean")
    key = ["phrase", "distance", "string"]
    twice = strings.groupBy(*key).count().where("count > 1").select(*key)
    return strings.where("open").join(twice, key, "left_semi").select("rid", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, span: int = SPAN, group: int = GROUP) -> DataFrame:
    """(rid, text) -> (rid, spans): byte spans [start, stop) covered by strings of ``length``
    bytes that also start elsewhere.  Rows with equal rids have equal texts."""
    found = phrases(rows, length, span)
    # written first, so that the join reads two plain shuffles and a hot phrase's
    # partition can be split (an aggregate below a join forbids that)
    twice = materialise(found.groupBy("phrase").count().where("count > 1").select("phrase"))
    found = materialise(found.join(twice, "phrase"))
    # equal extents are settled; of each one copy stays as a witness
    extents = materialise(found.groupBy("phrase", "extent").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "place", "left", "right")).alias("one")))
    settled = found.join(extents.where("n > 1").select("phrase", "extent"), ["phrase", "extent"], "left_semi").select(
        "rid", (F.col("place") - F.col("left")).alias("start"), (F.col("place") - F.col("right") + length).alias("stop"))
    open_phrases = extents.groupBy("phrase").agg(F.count("*").alias("members"), F.min("n").alias("_least")).where(
        "members > 1 and _least = 1").select("phrase", "members")
    members = extents.join(open_phrases, "phrase").select("phrase", "one.*", (F.col("n") == 1).alias("open"), "members")
    small = with_bytes(rows, members.where(F.col("members") <= group), length)
    out = settled.unionByName(spans_in_groups(small, length))
    many = materialise(members.where(F.col("members") > group))
    if not many.isEmpty():
        out = out.unionByName(spans_by_count(with_bytes(rows, many, length), length))
    return out.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def word_phrases(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the phrases of a string column, each once a row."""
    w = Words(column, not_space())
    seeds, offs = window_hashes(w.hash, w.first, WORD_SEED)
    n, span = np.maximum(np.diff(w.first) - PASSAGE + 1, 0), PASSAGE - PHRASE + 1
    if not n.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    starts = np.repeat(offs[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    low = np.uint64(32)
    packed = (mix64(seeds) >> low << low) | np.arange(len(seeds), dtype=np.uint64)
    place = np.unique((smallest_of_next(packed, span)[starts] & np.uint64((1 << 32) - 1)).astype(np.int64))
    row = np.searchsorted(offs, place, side="right") - 1
    words = w.hash[(place - offs[row] + w.first[row])[:, None] + np.arange(PHRASE)].reshape(-1)
    phrase, _ = window_hashes(words, np.arange(len(place) + 1) * PHRASE, PHRASE)
    pairs = np.unique(np.rec.fromarrays([row, phrase], names="row,phrase"))
    return pairs["row"], pairs["phrase"]


def word_pieces(batches):
    """(rows' ids, string column): rows of a few megabytes together; a longer text in
    parts that overlap by PASSAGE - 1 words."""
    for rb in slices(batches, "text", CHUNK):
        data, _ = utf8(rb.column(1))
        if len(data) <= 2 * CHUNK:
            yield np.asarray(rb.column(0)), rb.column(1)
            continue
        for r in range(rb.num_rows):
            own, _ = utf8(rb.column(1).slice(r, 1))
            inside = not_space()[own]
            inside[1:] &= ~inside[:-1]
            first = np.append(np.nonzero(inside)[0], len(own))
            for x in range(0, max(1, len(first) - PASSAGE), PART):
                part = own[first[x]:first[min(x + PART + PASSAGE - 1, len(first) - 1)]]
                yield np.asarray(rb.column(0).slice(r, 1)), pa.array([part.tobytes()], pa.binary())


def shared_rows(rows: DataFrame) -> DataFrame:
    """(rid, text) -> (rid, shared): rows with a phrase of words that another rid has too."""
    def run(batches):
        for rids, column in word_pieces(batches):
            row, phrase = word_phrases(column)
            if not len(row):
                continue
            # phrases of several rids here are known to be shared: one line for each, and one for each of
            # the rids, so that a phrase of very many texts is few lines in its group
            pairs = np.unique(np.rec.fromarrays([phrase.view(np.int64), rids[row]], names="phrase,rid"))
            new = np.append(True, pairs["phrase"][1:] != pairs["phrase"][:-1])
            size = np.diff(np.append(np.nonzero(new)[0], len(pairs)))
            sure = np.unique(pairs["rid"][np.repeat(size > 1, size)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs["phrase"][new], sure])), pa.array(np.concatenate([pairs["rid"][new], sure])),
                 pa.array(np.concatenate([size > 1, np.ones(len(sure), dtype=bool)]))], ["phrase", "rid", "known"])

    found = spread_small(rows.select("rid", "text")).mapInArrow(frugal(run), "phrase bigint, rid bigint, known boolean")
    group = Window.partitionBy("phrase")
    both = found.select("rid", (F.max("known").over(group) | (F.min("rid").over(group) != F.max("rid").over(group))).alias("shared"))
    return both.where("shared").groupBy("rid").agg(F.first("shared").alias("shared"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   span: int = SPAN, group: int = GROUP) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed, in bytes), shared
    (true for every text with a run of ``PASSAGE`` words that another document has too,
    whatever its bytes, spaces and case of A-Z; runs from ``PHRASE`` words on may count).

    Every byte covered by a ``length``-byte string that starts anywhere else,
    in this text or another, is removed.  Null and empty texts have no bytes;
    shorter texts keep all of theirs; repeated rows are copies of each other;
    null ids take part; other columns are not read; an empty table gives an
    empty result.  For ``shared``, rows that agree in id and text are one document.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("rid"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # written first: its tasks hold no memory beside those of the phrases of bytes
    shared = materialise(shared_rows(rows))
    found = repeated_spans(rows, length, span, group).join(shared, "rid", "full")
    src = rows.join(found, "rid", "left").select("doc_id", "text", "spans", F.coalesce("shared", F.lit(False)).alias("shared"))

    def run(batches):
        for rb in slices(batches, "text"):
            data, offs = utf8(rb.column(1))
            cuts = [merged(s or []) for s in rb.column(2).to_pylist()]
            sha, gone = [], []
            for r, cut in enumerate(cuts):
                digest, at = hashlib.sha256(), int(offs[r])
                for a, b in cut:
                    digest.update(data[at:offs[r] + a])
                    at = int(offs[r]) + b
                digest.update(data[at:offs[r + 1]])
                sha.append(digest.hexdigest())
                gone.append(sum(b - a for a, b in cut))
            spans = [[{"start": a, "stop": b} for a, b in cut] for cut in cuts]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(np.diff(offs)), pa.array(gone, pa.int64()), pa.array([len(c) for c in cuts], pa.int64()),
                 pa.array(sha), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), rb.column(3)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "shared"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                              "spans array<struct<start:bigint,stop:bigint>>, shared boolean")
    return out.withColumnRenamed("doc_id", id_col)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
