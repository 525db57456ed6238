"""Chunks of a text as windows, by the window rules of SURVEY section 2.9.

The text is cut before every space into pieces.  A chunk is a window [s, e)
over whole pieces, or, inside a piece that fills a window alone, over
characters.  Windows are stripped (Unicode white space) and empty ones left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


def character_windows(begin: int, end: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Rule 4: windows of ``size`` that advance by size - overlap (1 at least)."""
    step = max(1, size - overlap)
    at = begin
    while at + size < end:
        yield at, at + size
        at += step
    yield at, end


def run_windows(bounds: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Rule 3 over a run of short pieces; ``bounds`` are their starts and the last end."""
    s = bounds[0]
    for e, after in zip(bounds[1:], bounds[2:] + [None]):
        if after is None:
            yield s, e
        elif after - s > size:
            yield s, e
            s = min(e, bounds[bisect_left(bounds, max(s, e - overlap, after - size))])


def windows(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    cuts = sorted({0, len(text), *(i for i, c in enumerate(text) if c == " ")})
    run: list[int] = []
    for begin, end in zip(cuts, cuts[1:]):
        if end - begin < size:
            run = (run or [begin]) + [end]
            continue
        if run:
            yield from run_windows(run, size, overlap)
            run = []
        yield from character_windows(begin, end, size, overlap)
    if run:
        yield from run_windows(run, size, overlap)


def split_text(text: str, size: int, overlap: int) -> list[str]:
    if size == 1:                                   # rule 5
        return list(text)
    stripped = (text[s:e].strip() for s, e in windows(text, size, overlap))
    return [c for c in stripped if c]
