import random
import time

import numpy as np
import pyarrow as pa
from helpers import ALNUM, WORDS, words

from vellum.llm.words import LONG_WORD, Words, alphanumeric, not_space


def thue_morse(n, a, b):
    out = [a, b]
    while len(out) < n:
        out += [b if x == a else a for x in out]
    return "".join(out[:n])


def hashes(texts, table=None):
    w = Words(pa.array(texts, pa.string()), not_space() if table is None else table)
    return [w.hash[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:])]


def test_equal_words_and_no_others_have_equal_hashes():
    rng = random.Random(1)
    letters = "aAbBzZ09é😀ß\x00\x1c_-"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 40, LONG_WORD, LONG_WORD + 1, 700])))
                      for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", " \t", "x" * 300_000, "X" * 300_000 + " x"]
    for table, pattern in ((not_space(), WORDS), (alphanumeric(), ALNUM)):
        seen = {}
        for text, got in zip(texts, hashes(texts, table)):
            want = words(text, pattern)
            assert len(got) == len(want)
            for w, h in zip(want, got):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_thue_morse_words_differ():
    """Sums of letters times powers of one odd number modulo 2^64 are equal for these."""
    for n in (512, 1024, 2048, 4096):
        for a, b in (("i", "u"), ("a", "b"), ("x", "é")):
            one, two = hashes([thue_morse(n, a, b), thue_morse(n, b, a)])
            assert one != two
    rows = [thue_morse(1024, "i ", "u "), thue_morse(1024, "u ", "i ")]        # as words of a text
    w = Words(pa.array(rows), not_space())
    got, offs = w.shingles(10_000)
    assert len(got) == 2 and got[0] != got[1]


def test_small_changes_anywhere_change_the_hash():
    rng = random.Random(2)
    for n in (3, 8, 9, 31, 32, 33, 255, 256, 257):
        word = "".join(rng.choice("abc") for _ in range(n))
        others = {word[:k] + c + word[k + 1:] for k in range(n) for c in "abcd"} | {word + "a", word[:-1], word[1:] + word[0]}
        assert len({h[0] for h in hashes(sorted(others | {word}))}) == len(others | {word})


def test_memory_per_byte_is_small():
    import tracemalloc
    text = pa.array(["some words of an ordinary length here " * 50_000])
    hashes(["warm up"])
    tracemalloc.start()
    began = time.time()
    Words(text, not_space())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * 38 * 50_000 and time.time() - began < 20
    assert np.dtype("<u8") == np.uint64
