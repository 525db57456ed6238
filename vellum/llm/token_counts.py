"""Token counts by the whole-token shortcut.

The vocabulary is examined once on the driver.  Two facts about its pieces
make it sound to count a text segment by segment:

* no piece holds a word-start mark after another character, so no merge ever
  crosses the place where a run of spaces begins;
* a line feed is in no piece, so no merge touches one.

A segment is a run of spaces with the non-space characters that follow it,
or a single line feed.  The merges inside a segment do not depend on its
neighbours, hence the token count of a text is the sum over its segments.
``proven_whole`` lists the segments that the tokenizer itself, run on each
vocabulary string alone, turns into exactly one token: those are counted by
a dictionary lookup, and only the remaining segments are merged (by the
tokenizer library, the results kept in a bounded per-worker dictionary).
If a vocabulary lacks one of the two properties, ``proven_whole`` refuses
and every text is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import prepare, read_table, slices, spread_small

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
#: Distinct merged segments that a worker remembers, and the longest it remembers.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64
#: Characters of a text that are cut into segments at a time.
CHUNK = 1 << 20
#: Bytes of text whose segments are made distinct together.
SLICE = 16 << 20

MARK = "▁"
SEGMENT = re.compile(r" *[^ \n]+| +|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load(proto: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def proven_whole(proto: bytes) -> frozenset[str] | None:
    """Segments that alone encode as one token; None if segments of this
    vocabulary do not encode independently."""
    sp = load(proto)
    pieces = [(i, sp.id_to_piece(i)) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    if any("\n" in p or " " in p or MARK in p.lstrip(MARK) for _, p in pieces):
        return None
    # neutral context: the prefix mark and a line feed, then the segment
    context = sp.encode("\n")
    if sp.encode("\n\n") != context + context[1:]:
        return None
    texts = [p.replace(MARK, " ") for _, p in pieces]
    out = sp.encode(["\n" + t for t in texts], num_threads=1)
    return frozenset(t for (i, _), t, ids in zip(pieces, texts, out) if ids == context + [i]) | {"\n"} \
        if len(context) == 2 else None


def _chunks(text: str) -> Iterator[str]:
    """Pieces of about CHUNK characters, cut only where a segment begins."""
    start = 0
    while len(text) - start > CHUNK:
        cut = re.compile(r"\n|(?<=[^ ]) ").search(text, start + CHUNK)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class SegmentCounter:
    """Token counts of texts for one model; lives in a worker."""

    def __init__(self, proto: bytes, whole: frozenset[str] | None):
        self.sp, self.whole = load(proto), whole
        self.known = dict.fromkeys(whole or (), 1)

    def count(self, text: str) -> int:
        """Tokens of one text of any shape."""
        if not text:
            return 0
        if self.whole is None:
            return len(self.sp.encode(text, num_threads=1))
        # the tokenizer puts one word-start mark before a text
        return sum(sum(self._lookup(SEGMENT.findall(chunk)))
                   for chunk in _chunks(" " + text.replace(MARK, " ")))

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text (null: 0).  Where words are set apart by single
        spaces, a segment is what stands between two spaces: those texts are
        split and their segments made distinct by Arrow; others go one by one."""
        texts = pc.fill_null(texts, "")
        out = np.zeros(len(texts), dtype=np.int64)
        plain = pc.and_(pc.invert(pc.match_substring_regex(texts, f"^ | $|  |{MARK}")),
                        pc.and_(pc.greater(pc.binary_length(texts), 0), pc.less(pc.binary_length(texts), CHUNK)))
        if self.whole is None:
            plain = pa.array(np.zeros(len(texts), dtype=bool))
        plain = np.asarray(plain)
        for i in np.nonzero(~plain)[0]:
            out[i] = self.count(texts[int(i)].as_py())
        if plain.any():
            parts = pc.split_pattern(texts.filter(pa.array(plain)), " ")
            seen = parts.flatten().dictionary_encode()
            n = np.fromiter(self._lookup([" " + s for s in seen.dictionary.to_pylist()]), dtype=np.int64,
                            count=len(seen.dictionary))
            starts = np.asarray(parts.offsets)[:-1] - parts.offsets[0].as_py()
            out[plain] = np.add.reduceat(n[np.asarray(seen.indices)], starts)
        return out

    def _lookup(self, segments: list[str]) -> list[int]:
        """Counts of segments: known ones directly, the rest merged together."""
        if len(self.known) > REMEMBERED + len(self.whole):
            self.known = dict.fromkeys(self.whole, 1)
        counts = list(map(self.known.get, segments))
        fresh = list({s for s, n in zip(segments, counts) if n is None})
        if fresh:
            merged = dict(zip(fresh, (len(x) - 2 for x in self.sp.encode(["\n" + s for s in fresh], num_threads=1))))
            self.known.update((s, n) for s, n in merged.items() if len(s) <= REMEMBERED_CHARS)
            counts = [merged[s] if n is None else n for s, n in zip(segments, counts)]
        return counts


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 model: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null
    ids are counted like any other row; other columns are not read.  An
    empty table gives an empty result.  Nothing is shuffled.
    """
    spark = prepare(docs.sparkSession)
    with open(model or model_path(), "rb") as f:
        proto = f.read()
    shared = spark.sparkContext.broadcast((proto, proven_whole(proto)))

    def run(batches):
        counter = SegmentCounter(*shared.value)
        for rb in slices(batches, "_text", SLICE):
            texts = rb.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = pa.array(counter.count_all(texts))
            yield pa.RecordBatch.from_arrays([rb.column(0), n_bytes, tokens], ["_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    out = spread_small(src).mapInArrow(run, f"_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
