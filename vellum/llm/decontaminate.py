"""Benchmark decontamination by an FM-index per training shard.

A shard is a few megabytes of texts.  Words become symbols: the words of the
benchmark are numbered, every other word (and the end of a text) is one
separator.  A stretch of benchmark words that is shorter than the shortest
window cannot hold one, so it is folded into the separator; this loses
nothing.  Over the remaining symbols the shard gets an FM-index: a suffix
order, the Burrows-Wheeler transform in a wavelet matrix (rank in one step
per bit), and sampled suffix places.

All windows of the benchmark are searched backwards together, symbol by
symbol, through ranks; the rows of the found intervals are walked back to
sampled suffixes to locate the occurrences; occurrences are merged into
spans per text.

The benchmark is a stated query set: tasks write it to the shared folder in
blocks of about ``BLOCK_BYTES`` of text, and the tasks that read the documents
hold one block at a time, in one pass over the rows.  Nothing of it goes through the
driver, and no document is shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import SLICE_BYTES, frugal, prepare, read_table, slices, spread_small, unused
from vellum.llm.words import Words, alphanumeric
from vellum.session import ensure_checkpoint_dir
from vellum.sources.shared_files import files_of, open_input

WINDOW = 10
BLOCK_BYTES = 4 << 20     # benchmark text that a task holds at a time
MANY_BLOCKS_BYTES = 8 << 20   # text that is taken through several blocks at a time
SAMPLE = 8                 # every so many places of a shard, a suffix is sampled
FOUND = T.ArrayType(T.StructType([*(T.StructField(c, T.LongType()) for c in ("start", "end", "from", "to")),
                                  T.StructField("item", T.StringType())]))


class WaveletMatrix:
    """Rank of any symbol before any place, one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            ones = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[i] before place[i]."""
        low = np.zeros_like(place)
        for level in range(self.bits):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            low = np.where(one, zeros + ones[low], low - ones[low])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - low


class FmIndex:
    """FM-index of stretches of symbols 1.., set apart by the separator 0.

    Every separator counts as a symbol of its own, in text order, so a
    suffix is compared up to the end of its stretch only.  The start of every
    stretch is sampled besides every SAMPLE-th place: a walk back from an
    occurrence ends before it would leave its stretch.
    """

    def __init__(self, text: np.ndarray, n_symbols: int):
        # text begins and ends with a separator
        n, apart = len(text), text == 0
        rank = np.where(apart, np.cumsum(apart) - 1, apart.sum() + text).astype(np.int64)
        done = 1
        while True:                                       # prefix doubling
            order = np.argsort(rank, kind="stable")
            ranked = rank[order]
            new = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            after = np.full(n, -1, dtype=np.int64)
            after[:n - done] = rank[done:]
            rank = rank * (n + 1) + after + 1
            done *= 2
        self.bwt = text[order - 1]                        # what stands before; the text's first place: a separator
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(n_symbols).bit_length()))
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]
        self.n = n

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of the suffixes that begin with each pattern."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for back in range(patterns.shape[1]):
            at = lengths - 1 - back
            live = np.nonzero((at >= 0) & (low < high))[0]
            c = patterns[live, at[live]].astype(np.int64)
            low[live] = self.before[c] + self.wavelet.rank(c, low[live])
            high[live] = self.before[c] + self.wavelet.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows: walk back until a sampled suffix is met."""
        rows, out, steps = rows.copy(), np.empty(len(rows), dtype=np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            hit = self.sampled[rows[live]]
            out[live[hit]] = self.samples[self.sample_rank[rows[live[hit]]]] + steps
            live = live[~hit]
            c = self.bwt[rows[live]].astype(np.int64)
            rows[live] = self.before[c] + self.wavelet.rank(c, rows[live])
            steps += 1
        return out


class QueryBlock:
    """The windows of some benchmark items, in the form the tasks search."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        w = Words(pa.array(texts, pa.string()), alphanumeric())
        self.ids = ids
        self.vocabulary, symbols = np.unique(w.hash, return_inverse=True)
        rows, lengths, owners = [], [], []
        for item in range(len(texts)):
            own = (symbols[w.first[item]:w.first[item + 1]] + 1).astype(np.int32)
            if len(own) >= window:
                found = np.lib.stride_tricks.sliding_window_view(own, window)
            elif len(own):
                found = np.zeros((1, window), dtype=np.int32)
                found[0, :len(own)] = own
            else:
                continue
            rows.append(found)
            lengths.append(np.full(len(found), min(len(own), window)))
            owners.append(np.full(len(found), item))
        empty = not rows
        rows = np.zeros((0, window), dtype=np.int32) if empty else np.concatenate(rows)
        lengths, owners = (np.zeros(0, dtype=np.int64),) * 2 if empty else (np.concatenate(lengths), np.concatenate(owners))
        self.patterns, which = np.unique(rows, axis=0, return_inverse=True)
        self.lengths = (self.patterns > 0).sum(axis=1)
        pairs = np.unique(np.stack([which.reshape(-1), owners], axis=1), axis=0) if len(rows) else np.zeros((0, 2), dtype=np.int64)
        self.owners = pairs[:, 1]                         # items of pattern p: owners[first[p]:first[p + 1]]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.patterns) + 1))
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        self.maybe = np.zeros(1 << 20, dtype=bool)        # quick test on 20 bits before the search in the vocabulary
        self.maybe[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def symbols(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        some = np.nonzero(self.maybe[(words >> np.uint64(44)).astype(np.int64)])[0]
        at = np.searchsorted(self.vocabulary, words[some])
        at[at == len(self.vocabulary)] = 0
        out[some] = np.where(self.vocabulary[at] == words[some], at + 1, 0)
        return out

    def spans(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, word after the last, item) of every occurrence of a window
        of an item, merged per item; words are numbered through the shard."""
        none = (np.zeros(0, dtype=np.int64),) * 3
        if not len(self.patterns) or not len(w.hash):
            return none
        symbol = self.symbols(w.hash)
        # stretches of benchmark words within a text
        cut = np.zeros(len(symbol) + 1, dtype=bool)
        cut[w.first] = True
        inside = symbol > 0
        opens = np.nonzero(inside & (cut[:-1] | np.append(True, ~inside[:-1])))[0]
        closes = np.nonzero(inside & (cut[1:] | np.append(~inside[1:], True)))[0] + 1
        long = closes - opens >= self.shortest
        opens, closes = opens[long], closes[long]
        if not len(opens):
            return none
        length = closes - opens
        at = np.cumsum(length + 1) - length               # place of each stretch; one separator before it
        text = np.zeros(int(length.sum()) + len(length) + 1, dtype=np.int64)
        word = np.zeros(len(text), dtype=np.int64)
        inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        place = np.repeat(at, length) + inner
        word[place] = np.repeat(opens, length) + inner
        text[place] = symbol[word[place]]
        index = FmIndex(text, len(self.vocabulary))
        low, high = index.search(self.patterns, self.lengths)
        hit = np.nonzero(low < high)[0]
        many = high[hit] - low[hit]
        rows = np.repeat(low[hit], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        pattern = np.repeat(hit, many)
        begin = word[index.locate(rows)]
        # one row per occurrence and item, then overlapping ones merged
        n_own = (self.first[1:] - self.first[:-1])[pattern]
        begin_, pattern_ = np.repeat(begin, n_own), np.repeat(pattern, n_own)
        nth = np.arange(len(pattern_)) - np.repeat(np.cumsum(n_own) - n_own, n_own)
        item = self.owners[self.first[pattern_] + nth]
        end_ = begin_ + self.lengths[pattern_]
        return merged(begin_, end_, item, np.searchsorted(w.first, begin_, side="right"))


def merged(begin, end, item, row):
    """Overlapping or touching spans of one item in one row become one."""
    order = np.lexsort((end, begin, item, row))
    begin, end, item, row = begin[order], end[order], item[order], row[order]
    group = np.concatenate([[0], np.cumsum((item[1:] != item[:-1]) | (row[1:] != row[:-1]))]) if len(begin) else begin
    reach = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    new = np.ones(len(begin), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (begin[1:] > reach[:-1])
    last = np.append(new[1:], True)[:len(begin)]
    return begin[new], reach[last], item[new]


def write_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[str]:
    """The benchmark as files of about ``block_bytes`` of text on the shared folder,
    written by tasks; the driver knows their number and names only."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    path = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "vellum-llm", uuid.uuid4().hex])
    blocks = max(1, -(-size // block_bytes))
    rows.repartitionByRange(int(blocks), F.xxhash64("id", "text")).write.parquet(path)
    return sorted(files_of(spark.read.schema(rows.schema).parquet(path)))


@functools.lru_cache(1)
def read_block(name: str) -> QueryBlock:
    import pyarrow.parquet as pq
    with open_input(name) as f:
        table = pq.ParquetFile(f).read(columns=["id", "text"])
    return QueryBlock(table["id"].to_pylist(), table["text"].to_pylist())


def find_spans(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", id_col: str = "item_id",
               item_text: str = "text", block_bytes: int = BLOCK_BYTES, found: str = "_found",
               n_words: str = "_n_words") -> DataFrame:
    """``docs`` with its number of words and the spans that windows of
    benchmark items cover: (start, end) in words, (from, to) in bytes, item.

    Null and empty texts have no words and no spans; items without words
    match nothing; an item without an id has the id ''; rows with the same
    item id are one item; repeated documents are searched each; an empty
    benchmark or table gives no spans; all other columns are kept, but for those
    called ``found`` or ``n_words``.
    """
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in (found, n_words)]
    src = spread_small(docs.select(*[F.col(c) for c in names]))
    files = write_blocks(benchmark, id_col, item_text, block_bytes)
    schema = T.StructType(list(src.schema.fields)).add(n_words, "long").add(found, FOUND)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("from", pa.int64()), ("to", pa.int64()),
                               ("item", pa.string())]))
    text_at = names.index(text_col)
    # with several blocks, more text for each block that is read
    limit = SLICE_BYTES if len(files) < 2 else MANY_BLOCKS_BYTES

    def run(batches):
        for rb in slices(batches, text_col, limit):
            w = Words(rb.column(text_at), alphanumeric())
            lists = [[] for _ in range(rb.num_rows)]
            for name in files:
                block = read_block(name)
                begin, end, item = block.spans(w)
                row = np.searchsorted(w.first, begin, side="right") - 1
                lows, highs = w.start[begin] - w.offs[row], w.end[end - 1] - w.offs[row]
                for r, b, e, lo, hi, i in zip(row, begin - w.first[row], end - w.first[row], lows, highs, item):
                    lists[r].append({"start": b, "end": e, "from": lo, "to": hi, "item": block.ids[i]})
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(np.diff(w.first)), pa.array(lists, kind)],
                                             [*names, n_words, found])

    return src.mapInArrow(frugal(run, read_block), schema)


def union_length(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def report(marked: DataFrame, keep: list[str], *, found: str = "_found", n_words: str = "_n_words") -> DataFrame:
    """Per row: ``keep``, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    src = marked.select(*keep, F.col(n_words).alias("n_words"), F.col(found).alias(found))
    schema = T.StructType(list(src.schema.fields)[:-1]).add("n_hit", "long").add("n_items", "long").add(
        "items_sha256", "string").add("items", T.ArrayType(T.StringType()))

    def run(batches):
        for rb in batches:
            hits, items = [], []
            for spans in rb.column(rb.num_columns - 1).to_pylist():
                hits.append(union_length([(s["start"], s["end"]) for s in spans]) if spans else 0)
                items.append(sorted({s["item"] for s in spans}) if spans else [])
            sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            new = [pa.array(hits, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(sha),
                   pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], *new], [*rb.schema.names[:-1], "n_hit", "n_items", "items_sha256", "items"])

    return src.mapInArrow(run, schema).withColumn("contaminated", F.col("n_hit") > 0)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return report(find_spans(docs, read_table(spark, sf_dir, "benchmark")), ["doc_id"]).drop("items")


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the merged spans out of the texts (``n_chars`` follows); a document of
    which no word is left goes.  Null, empty and wordless texts hold nothing and stay; repeated rows are
    cut alike; other columns, whatever their names, go through; an empty table stays empty."""
    names = docs.columns
    found, n_words, cuts_, hits_, left_ = unused(docs, "_found", "_n_words", "_cuts", "_hits", "_left")
    marked = find_spans(docs, read_table(spark, sf_dir, "benchmark"), found=found, n_words=n_words)
    spans = F.transform(found, lambda s: F.struct(s["from"], s["to"]))
    schema = T.StructType(list(docs.schema.fields)).add(left_, "long")
    src = marked.select(*names, n_words, spans.alias(cuts_),
                        F.transform(found, lambda s: F.struct(s["start"], s["end"])).alias(hits_))
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for rb in batches:
            columns = list(rb.columns)
            words, cuts, hits = (columns.pop(len(names)).to_pylist() for _ in range(3))
            left = [n - union_length([tuple(h.values()) for h in hs]) for n, hs in zip(words, hits)]
            if any(cuts):
                texts = columns[text_at].to_pylist()
                chars = columns[chars_at].to_pylist() if chars_at is not None else None
                for r, spans_ in enumerate(cuts):
                    if spans_:
                        texts[r] = without(texts[r], [tuple(c.values()) for c in spans_])
                        if chars is not None:
                            chars[r] = len(texts[r])
                columns[text_at] = pa.array(texts, pa.string())
                if chars is not None:
                    columns[chars_at] = pa.array(chars, rb.schema.types[chars_at])
            cut = np.array([bool(c) for c in cuts])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.where(cut, left, 1))], [*names, left_])

    return src.mapInArrow(frugal(run), schema).where(F.col(left_) > 0).drop(left_)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without byte spans."""
    raw, out, reach = text.encode(), [], 0
    for a, b in sorted(spans):
        out.append(raw[reach:max(a, reach)])
        reach = max(reach, b)
    return (b"".join(out) + raw[reach:]).decode()


#: All runs of words of all texts that are as long as a window, met with the windows.
ORACLE_SQL = r"""
WITH
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
runs AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, k, runs.n, item FROM runs JOIN windows ON runs.n = windows.n AND runs.run = windows.run),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS told FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(told, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
