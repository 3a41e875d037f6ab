"""Word positions, hashes and counts over whole Arrow batches of text.

Words are maximal runs without the ASCII space, tab, line feed, vertical tab,
form feed or carriage return.  Work is done on the UTF-8 bytes of many texts
at once; slices keep the arrays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The symbol characters of the quality rules.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(b: int) -> int:
    return pow(b, -1, 1 << 64)


class Spans:
    """Texts as one byte buffer with the spans of their words."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        arr = pc.fill_null(texts.cast(pa.large_string()), "")
        off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
        data = arr.buffers()[2]
        buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        self.buf = _LOWER[buf] if lower else buf
        self.off = off - off[0]
        ink = ~_SPACE[self.buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[self.off] = True
        before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
        before[1:], after[:-1] = ink[:-1], ink[1:]
        self.start = np.flatnonzero(ink & (~before | edge[:-1]))
        self.end = np.flatnonzero(ink & (~after | edge[1:])) + 1
        self.ink = ink
        #: words before each text
        self.first = np.searchsorted(self.start, self.off)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges by one pass of prefix sums."""
        n = len(self.buf)
        if not hasattr(self, "_prefix"):
            base, back = int(_ODD), _inverse(int(_ODD))
            powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
            self._prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.buf] * powers[:-1], dtype=np.uint64)])
            self._back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, back, np.uint64)]))
        return mix((self._prefix[end] - self._prefix[start]) * self._back[start] + (end - start).astype(np.uint64) * _ODD)

    def words(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of k words; of the whole sequence if shorter."""
    if not len(words):
        return words
    k = min(k, len(words))
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = mix(h * _ODD + words[i:len(words) - k + 1 + i] + np.uint64(k))
    return h


def slices(texts: pa.Array, most: int = 1_000_000, rows: int = 2_000) -> Iterator[tuple[int, int]]:
    """``(first row, rows)`` of slices of about ``most`` bytes and at most
    ``rows`` rows, which bounds arrays over bytes and arrays over rows."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(size):
        end, total = at + 1, size[at]
        while end < len(size) and end - at < rows and total + size[end] <= most:
            total += size[end]
            end += 1
        yield at, end - at
        at = end


#: Columns of ``counts``: the base counts, then what the model reads besides.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_chars", "n_lines", "n_upper", "n_letters", "n_digits", "n_exclaim", "n_distinct", "n_pipe", "n_long", "n_last_mark", "n_top"]


def counts(texts: pa.Array) -> np.ndarray:
    """A row of counts (columns ``BASE`` + ``MORE``) per text."""
    s = Spans(texts)
    n = len(s.off) - 1
    out = np.zeros((n, len(BASE) + len(MORE)), np.int64)

    def per(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return c[s.off[1:]] - c[s.off[:-1]]

    b = s.buf
    lead = (b & 0xC0) != 0x80
    words = s.words()
    nw = np.diff(s.first)
    out[:, 0], out[:, 1], out[:, 2] = nw, per(lead & s.ink), per(_SYMBOL[b])
    upper = (b >= 65) & (b <= 90)
    low = (b >= 97) & (b <= 122)
    out[:, 5], out[:, 7], out[:, 8] = per(lead), per(upper), per(upper | low)
    out[:, 9], out[:, 10], out[:, 12] = per((b >= 48) & (b <= 57)), per(b == 33), per(b == 124)
    size = s.end - s.start
    wc = np.concatenate([[0], np.cumsum(size > 20)])
    out[:, 13] = wc[s.first[1:]] - wc[s.first[:-1]]
    last = np.isin(b[s.end - 1], np.frombuffer(b".!?:;", np.uint8)) if len(size) else np.zeros(0, bool)
    lc = np.concatenate([[0], np.cumsum(last)])
    out[:, 14] = lc[s.first[1:]] - lc[s.first[:-1]]
    nl = np.flatnonzero(b == 10)
    line_start = np.unique(np.concatenate([s.off[:-1], nl + 1]))
    line_start = line_start[line_start <= len(b)]
    for i in range(n):
        lo, hi = s.off[i], s.off[i + 1]
        w = words[s.first[i]:s.first[i + 1]]
        if not len(w):
            continue
        uniq, freq = np.unique(w, return_counts=True)
        out[i, 11], out[i, 15] = len(uniq), freq.max()
        if len(w) >= 3:
            g = shingles(w, 3)
            _, inv, times = np.unique(g, return_inverse=True, return_counts=True)
            twice = times[inv] > 1
            cover = np.zeros(len(w), bool)
            for j in range(3):
                cover[j:len(w) - 2 + j] |= twice
            out[i, 4] = cover.sum()
        a = line_start[np.searchsorted(line_start, lo):np.searchsorted(line_start, hi, "left")]
        # a line ends before its newline, the last one of the text too
        z = np.append(a[1:] - 1, hi - (b[hi - 1] == 10))
        has = np.searchsorted(s.start, z) > np.searchsorted(s.start, a)
        out[i, 6] = has.sum()
        h = s.hashes(a[has], z[has])
        out[i, 3] = len(h) - len(np.unique(h))
    return out
