"""Recursive character chunking as one native fold per document.

Semantics (size and overlap counted in characters, separators tried in the
order paragraph, line, space, character).  Whitespace normalisation runs
before chunking, so only the space and the character level matter:

* the text is cut into *pieces* at every space, the space opening the next
  piece; every chunk is one window ``[s, e)`` of the text, then stripped;
  empty chunks are dropped;
* pieces shorter than ``size`` are merged greedily; when the next piece
  ``[e, e2)`` would make the window longer than ``size`` the window
  ``[s, e)`` is emitted and the next one starts at the first piece boundary
  at or after ``max(s, e - overlap, e2 - size)``;
* a piece of length >= ``size`` ends the current run, and is itself cut
  into windows of ``size`` characters advancing by ``max(1, size-overlap)``
  (the tail always emitted); a new run starts after it;
* with ``size == 1`` every character is its own chunk, unstripped.

The fold runs once per emitted chunk (``aggregate`` over a bounded step
sequence) inside the JVM; no row leaves it.  The text is cut into blocks of
``2*size+2`` characters first and every step works on two blocks, so the
cost per document is linear in its length (string positions in Spark are
code-point offsets that would otherwise be re-walked from the start).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import py_strip
from vellum.functions.vectors import let

SPAN_TYPE = "array<struct<start:int,end:int>>"


def check_chunk_params(size: int, overlap: int) -> None:
    if size < 1 or overlap < 1:
        raise ValueError("chunk_size and overlap_size must be greater than 0.")
    if overlap > size:
        raise ValueError(f"Got a larger chunk overlap ({overlap}) than chunk size ({size}), should be smaller.")


def _fn(name: str, *args) -> Column:
    return F.call_function(name, *args)


def _span(a: Column, b: Column) -> Column:
    return F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))


def _blocks(x: Column, block: int) -> Column:
    """The text cut into consecutive blocks of ``block`` code points."""
    return F.regexp_extract_all(x, F.lit(f"(?s).{{1,{block}}}"), 0)


def _window(blocks: Column, b: Column) -> Column:
    """Blocks ``b`` and ``b+1`` (0-based) concatenated; missing blocks are empty."""
    return F.concat(F.coalesce(F.get(blocks, b), F.lit("")), F.coalesce(F.get(blocks, b + 1), F.lit("")))


def chunk_spans(text, size: int, overlap: int) -> Column:
    """``array<struct<start,end>>`` of 0-based windows (before stripping)."""
    check_chunk_params(size, overlap)
    x = F.col(text) if isinstance(text, str) else text
    return let(_blocks(x, 2 * size + 2), lambda bl: _spans_with(x, bl, size, overlap))


def _spans_with(x: Column, blocks: Column, size: int, overlap: int) -> Column:
    """The fold.  Positions are absolute, but every lookup runs inside a
    window of two blocks of ``2*size+2`` characters around the current start,
    so one step costs O(size) whatever the document length; only the end of
    a piece longer than the window is searched in the whole text."""
    return let(F.length(x), lambda n: _fold(x, n, blocks, size, overlap))


def _emit(start: Column, end: Column) -> Column:
    return F.concat(start.cast("string"), F.lit(":"), end.cast("string"), F.lit(","))


def _parse_spans(out: Column) -> Column:
    pairs = F.filter(F.split(out, ","), lambda p: p != "")
    return F.transform(pairs, lambda p: _span(F.substring_index(p, ":", 1).cast("int"),
                                               F.substring_index(p, ":", -1).cast("int")))


def _fold(x: Column, n: Column, blocks: Column, size: int, overlap: int) -> Column:
    """The emitted windows accumulate as a ``start:end,`` string: Spark copies
    the fold state on every iteration, and a string copies as one memcpy
    where an array of structs copies row by row."""
    st = max(1, size - overlap)
    B = 2 * size + 2
    empty = F.lit("")

    def state(s, done, out) -> Column:
        return F.struct(s.cast("int").alias("s"), done.alias("done"), out.alias("out"))

    def step(acc: Column, _i: Column) -> Column:
        s = acc["s"]
        out = acc["out"]
        b = F.floor(s / F.lit(B)).cast("int")
        o = b * B

        def in_window(win: Column) -> Column:
            def at_e(e: Column) -> Column:
                p = _fn("locate", F.lit(" "), win, e - o + 2)
                global_p = _fn("locate", F.lit(" "), x, e + 2)
                e2_expr = (F.when(p > 0, o + p - 1)
                           .when(o + F.length(win) >= n, n)
                           .when(global_p > 0, global_p - 1)
                           .otherwise(n))

                def at_e2(e2: Column) -> Column:
                    long_piece = (e2 - e) >= size
                    extra = F.ceil(F.greatest(F.lit(0), e2 - e - size) / F.lit(st)).cast("int")
                    windows = F.array_join(F.transform(
                        F.sequence(F.lit(0), extra),
                        lambda k: _emit(e + k * st, F.least(e + k * st + size, e2))), "")
                    head = F.when(e > s, _emit(s, e)).otherwise(empty)
                    lo = F.greatest(s, e - overlap, e2 - size)
                    s_next = o + _fn("locate", F.lit(" "), win, lo - o + 1) - 1
                    return (F.when(long_piece, state(e2, e2 >= n, F.concat(out, head, windows)))
                            .otherwise(state(s_next, F.lit(False), F.concat(out, _emit(s, e)))))

                return let(e2_expr, at_e2)

            last_space = _fn("instr", F.reverse(win.substr(s - o + 2, F.lit(size))), F.lit(" "))
            return let(let(last_space, lambda r: F.when(r > 0, s + size - r + 1).otherwise(s)), at_e)

        tail = state(n, F.lit(True), F.concat(out, _emit(s, n)))
        return (F.when(acc["done"], acc)
                .when(n - s <= size, tail)
                .otherwise(let(_window(blocks, b), in_window)))

    # At most one step per piece boundary is needed.  The steps run as an
    # outer fold over rounds of about sqrt(2 * bound) inner steps, so the
    # inner state holds only its round's output and finished rounds are
    # skipped cheaply.
    def run(bound: Column) -> Column:
        def with_sizes(cfg: Column) -> Column:
            def one_round(acc: Column, _j: Column) -> Column:
                inner = F.aggregate(F.sequence(F.lit(1), cfg["per_round"]),
                                    state(acc["s"], acc["done"], empty), step)
                return F.when(acc["done"], acc).otherwise(
                    let(inner, lambda r: state(r["s"], r["done"], F.concat(acc["out"], r["out"]))))

            return F.aggregate(F.sequence(F.lit(1), cfg["rounds"]), state(F.lit(0), n == 0, empty), one_round)

        # loop sizes are computed once per document, not once per round
        per_round = F.greatest(F.lit(16), F.ceil(F.sqrt(bound * 2)).cast("int"))
        return let(F.struct(per_round.alias("per_round"),
                            F.ceil(bound / per_round).cast("int").alias("rounds")), with_sizes)

    out = run(n - F.length(F.regexp_replace(x, " ", "")) + 2)["out"]
    return _parse_spans(out)


def chunk_array(text, size: int, overlap: int) -> Column:
    """``array<struct<start,end,content>>`` of the final (stripped, non-empty) chunks.

    Chunk text is cut from the two blocks around its start, so extracting a
    chunk costs O(size), not O(position).
    """
    check_chunk_params(size, overlap)
    x = F.col(text) if isinstance(text, str) else text
    B = 2 * size + 2

    def with_blocks(blocks: Column) -> Column:
        spans = _spans_with(x, blocks, size, overlap)

        def piece(c: Column) -> Column:
            b = F.floor(c["start"] / F.lit(B)).cast("int")
            win = _window(blocks, b)
            raw = win.substr(c["start"] - b * B + 1, c["end"] - c["start"])
            content = raw if size == 1 else py_strip(raw)
            return F.struct(c["start"].alias("char_start"), c["end"].alias("char_end"), content.alias("content"))

        return F.filter(F.transform(spans, piece), lambda c: F.length(c["content"]) > 0)

    return let(_blocks(x, B), with_blocks)


def split_documents(df: DataFrame, text_col: str = "page_content", size: int = 512,
                    overlap: int = 64, min_length: int = 0,
                    keep_text: bool = False) -> DataFrame:
    """One row per chunk; every parent column (metadata included) is kept.

    Adds ``chunk_index`` (0-based, per document), ``char_start``/``char_end``
    (window in the normalised text) and ``content``; keeps chunks with
    ``length(content) >= min_length``.
    """
    parent = [c for c in df.columns if keep_text or c != text_col]
    exploded = df.select(*parent, F.posexplode(chunk_array(text_col, size, overlap)).alias("chunk_index", "chunk"))
    out = exploded.select(*parent, "chunk_index",
                          F.col("chunk.char_start").alias("char_start"),
                          F.col("chunk.char_end").alias("char_end"),
                          F.col("chunk.content").alias("content"))
    if min_length > 0:
        out = out.where(F.length("content") >= F.lit(min_length))
    return out
