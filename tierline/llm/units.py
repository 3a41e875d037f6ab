"""Encoding whole texts by the public ``tokenizers`` library, each distinct
space-delimited unit once.

A cut before a space that follows a non-space is always a boundary of the
byte-level pattern: no alternative of it holds a space except as first
character or in a run of white space.  So the ids of a text are the ids of
its units one after the other.  Where white space stands before a space that
argument fails for the cut, and the text is cut only at the safe places.
Batches are split, dictionary-encoded and put together with Arrow and numpy;
the library sees only units that the worker has not met lately.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that may stand before a space (RE2 syntax).
_UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: A space and then neither white space nor control characters.
_PLAIN = re.compile(r" [^\s\x00-\x1f\x7f-\xa0]+")
#: Characters that keep their number of bytes when a word tokenizer normalises them.
_PLAIN_WORD = re.compile(r"[!-~\xc0-\xff]+")
#: Letters that both patterns take as one piece, and the run of marks after them that is a piece of its own: no
#: apostrophe, which may start a contraction, and nothing that special tokens are made of (RE2 syntax).
_LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+"
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_MARK = "[" + re.escape(_MARKS) + "]"
_NONE, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")
#: A line end that byte level takes as a piece of its own.
_LINE = re.compile(r"(?<=\S)(\n)(?=\S)")


def gather_runs(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i]:starts[i]+lens[i]]`` one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(total)]


def strings(arr: pa.Array) -> list[str]:
    """The strings of an array without nulls, without a scalar object for each."""
    return arr.to_numpy(zero_copy_only=False).tolist()


class UnitEncoder:
    """``spaces`` tells whether a leading space is part of a unit's ids (byte
    level) or dropped by the tokenizer (word ends)."""

    def __init__(self, path: str, spaces: bool, cache_units: int = 250_000, unit_chars: int = 64):
        # Spark already runs a task per core; the library's own threads only add to the CPU time
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.tok = Tokenizer.from_file(path)
        #: what the library does with a word of letters, which the normaliser and the pattern leave whole
        self.as_bytes, self.model = normalizers.ByteLevel(), self.tok.model
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.spaces, self.cache_units, self.unit_chars = spaces, cache_units, unit_chars
        #: units met lately and those met before them; a unit met again moves up
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: the vocabulary's special tokens, which the library finds in the text; none holds a space
        added = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        #: bytes of text that each id stands for, by which the ids of joined units are told apart
        self.id_bytes = self._id_bytes()
        self.plain = _PLAIN if spaces else _PLAIN_WORD
        #: whether letters in upper case have the ids of those in lower case
        self.lowers = self.tok.normalizer is not None and self.tok.normalizer.normalize_str("AÉ b") == "aé b"

    def _id_bytes(self) -> np.ndarray:
        """A token has one character per byte it stands for, and the mark of a
        word's end where it ends one."""
        end = getattr(self.tok.model, "end_of_word_suffix", None) or ""
        out = np.zeros(self.vocab, np.int64)
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            out[i] = len(token.removesuffix(end))
        return out

    def _keep(self, units: list[str], runs: list[bytes]) -> None:
        if len(self.cache) >= self.cache_units:
            self.cache, self.older = {}, self.cache
        self.cache.update((u, r) for u, r in zip(units, runs) if len(u) <= self.unit_chars)

    def release(self) -> None:
        """Give back what the next task of this worker need not find."""
        self.cache, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def _joined(self, units: list[str]) -> list[bytes] | None:
        """Ids of units without white space, but for the space that a unit of
        byte level starts with, encoded as one text and parted where the bytes
        of a unit end; None where the ids do not end with the units."""
        text = ("" if self.spaces else " ").join(units)
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum([len(u) if u.isascii() else len(u.encode()) for u in units])
        done = np.cumsum(self.id_bytes[ids])
        cut = np.searchsorted(done, ends)
        if not len(ids) or done[-1] != ends[-1] or (done[cut] != ends).any():
            return None
        raw, at = ids.tobytes(), [0, *(4 * (cut + 1)).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _fresh(self, units: list[str]) -> list[bytes]:
        """Ids of units that no cache holds."""
        out: list[bytes | None] = [None] * len(units)
        # byte counts need not hold for units with a special token
        plain = [i for i, u in enumerate(units) if self.plain.fullmatch(u) and not (self.added and self.added.search(u))]
        for k in range(0, len(plain), 2000):
            part = plain[k:k + 2000]
            for i, r in zip(part, self._joined([units[j] for j in part]) or ()):
                out[i] = r
        rest = [i for i, r in enumerate(out) if r is None]
        for k in range(0, len(rest), 20_000):
            part = rest[k:k + 20_000]
            for i, enc in zip(part, self.tok.encode_batch_fast([units[j] for j in part], add_special_tokens=False)):
                out[i] = array("I", enc.ids).tobytes()
        return out

    def _letters(self, units: list[str]) -> list[bytes]:
        """Ids of units of letters alone, or a space and letters, that no cache
        holds: each is one piece, given to the model as it is."""
        out: list[bytes] = []
        tokenize, end = self.model.tokenize, self.as_bytes.normalize_str("\n")
        for k in range(0, len(units), 4000):
            words = self.as_bytes.normalize_str("\n".join(units[k:k + 4000])).split(end)
            out += [array("I", [t.id for t in tokenize(w)]).tobytes() for w in words]
        return out

    def _cached(self, units: list[str], fresh: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        got = list(map(self.cache.get, units))
        miss = [i for i, r in enumerate(got) if r is None]
        if miss and self.older:
            old = list(map(self.older.get, [units[i] for i in miss]))
            again = [i for i, r in zip(miss, old) if r is not None]
            old = [r for r in old if r is not None]
            for i, r in zip(again, old):
                got[i] = r
            self._keep([units[i] for i in again], old)
            miss = [i for i in miss if got[i] is None]
        names = [units[i] for i in miss]
        runs = fresh(names)
        for i, r in zip(miss, runs):
            got[i] = r
        self._keep(names, runs)
        return got

    def _table(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first id, ids) per unit.  A unit of letters with or
        without marks after them is taken apart in Arrow, and where the
        tokenizer lowers words, so are its letters; letters, marks and the
        other units go to the library by way of the cache."""
        n = len(units)
        lead = "^ ?" if self.spaces else "^"
        plain = pc.match_substring_regex(units, f"{lead}{_LETTERS}{_MARK}*$").to_numpy(zero_copy_only=False)
        which, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        part = units.take(pa.array(which))
        marked = pc.match_substring_regex(part, f"{_MARK}$").to_numpy(zero_copy_only=False)
        stems = pc.utf8_rtrim(part, _MARKS)
        stems = (pc.utf8_lower(stems) if self.lowers else stems).dictionary_encode()
        tails = pc.replace_substring_regex(part.filter(pa.array(marked)), lead + _LETTERS, "").dictionary_encode()
        letters, marks = strings(stems.dictionary), strings(tails.dictionary)
        others = units.take(pa.array(rest)).dictionary_encode()
        runs = self._cached(letters, self._letters) + self._cached(marks + strings(others.dictionary), self._fresh)
        size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        flat = np.frombuffer(b"".join(runs), np.uint32)
        at = np.cumsum(size) - size
        # two runs a unit: its letters or all of it, and its mark or nothing
        first, count = np.zeros((n, 2), np.int64), np.zeros((n, 2), np.int64)
        code = stems.indices.to_numpy(zero_copy_only=False)
        first[which, 0], count[which, 0] = at[code], size[code]
        last = len(letters) + tails.indices.to_numpy(zero_copy_only=False)
        first[which[marked], 1], count[which[marked], 1] = at[last], size[last]
        whole = len(letters) + len(marks) + others.indices.to_numpy(zero_copy_only=False)
        first[rest, 0], count[rest, 0] = at[whole], size[whole]
        lens = count.sum(1)
        return gather_runs(flat, first.ravel(), count.ravel()), np.cumsum(lens) - lens, lens

    def _lines(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_table``, with units of byte level cut before and after a line
        end between other characters than white space."""
        some = pc.match_substring(units, "\n")
        cut = np.flatnonzero(some.to_numpy(zero_copy_only=False))
        if not len(cut):
            return self._table(units)
        parts = [_LINE.split(u) for u in strings(units.take(pa.array(cut)))]
        sizes = np.array([len(p) for p in parts])
        n = len(units) - len(cut)
        flat, starts, lens = self._table(pa.concat_arrays([units.filter(pc.invert(some)), pa.array([u for p in parts for u in p], units.type)]))
        # the parts of a unit have their ids one after the other
        first, count = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        whole = np.setdiff1d(np.arange(len(units)), cut, assume_unique=True)
        at = n + np.cumsum(sizes) - sizes
        first[whole], count[whole] = starts[:n], lens[:n]
        first[cut], count[cut] = starts[at], np.add.reduceat(lens, at)
        return flat, first, count

    def _split(self, texts: pa.Array):
        """(flat ids, ids per text) of texts that may be cut at every space;
        where spaces are dropped, a line end is as good as one."""
        lists = pc.split_pattern(texts if self.spaces else pc.replace_substring(texts, "\n", " "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        dic = lists.values.dictionary_encode()
        code = dic.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = dic.dictionary
        offsets, code = offsets - offsets[0], code[offsets[0]:offsets[-1]]
        if self.spaces:
            first = np.zeros(len(code), bool)
            first[offsets[:-1]] = True
            code = code + len(words) * first
            used = np.zeros(2 * len(words), bool)
            used[code] = True
            keys = np.flatnonzero(used)
            units = pa.chunked_array([pc.binary_join_element_wise(_NONE, words, _SPACE), words]).combine_chunks().take(pa.array(keys))
            code = (np.cumsum(used) - 1)[code]
        else:
            units = words
        flat, starts, lens = self._lines(units) if self.spaces else self._table(units)
        per = lens[code]
        ids = gather_runs(flat, starts[code], per)
        total = np.concatenate([[0], np.cumsum(per)])
        return ids, np.diff(total[offsets])

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as unsigned 32-bit, ids per text) in the order given; a
        null text counts as empty."""
        # nothing here makes reference cycles, and looking for them among so many units costs a fifth of the time
        on = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if on:
                gc.enable()

    def _encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        arr = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        arr = pc.fill_null(arr.cast(pa.large_string()), "")
        if not len(arr):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(arr, _UNSAFE).to_numpy(zero_copy_only=False) if self.spaces else np.zeros(len(arr), bool)
        if not odd.any():
            return self._split(arr)
        parts, counts = [], np.zeros(len(arr), np.int64)
        plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
        if len(plain):
            ids, counts[plain] = self._split(arr.take(pa.array(plain)))
            parts.append(ids)
        cut = [_SAFE_CUT.split(t) for t in arr.take(pa.array(rest)).to_pylist()]
        flat, starts, lens = self._table(pa.array([u for c in cut for u in c], pa.large_string()))
        sizes = np.array([len(c) for c in cut])
        counts[rest] = np.diff(np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(sizes)])])
        parts.append(flat)
        order = np.concatenate([plain, rest])
        run = counts[order]
        at = np.empty(len(arr), np.int64)
        at[order] = np.cumsum(run) - run
        return gather_runs(np.concatenate(parts), at, counts), counts

    def pieces(self, text: str, most: int) -> Iterator[str]:
        """``text`` cut at safe places into pieces of about ``most`` characters."""
        at = 0
        while len(text) - at > most:
            m = _SAFE_CUT.search(text, at + most)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:]

    def encode_rows(self, texts: pa.Array, most: int = 12_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(first row, rows, ids, ids per row)`` over slices of about
        ``most`` bytes; a longer text is encoded in pieces."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(texts):
            if size[at] > most:
                got = [self.encode([p])[0] for p in self.pieces(texts[at].as_py(), most)]
                ids = np.concatenate(got)
                yield at, 1, ids, np.array([len(ids)])
                at += 1
                continue
            end, total = at, 0
            while end < len(texts) and (end == at or total + size[end] <= most):
                total += size[end]
                end += 1
            ids, counts = self.encode(texts.slice(at, end - at))
            yield at, end - at, ids, counts
            at = end


_LOADED: dict[tuple, UnitEncoder] = {}


def encoder(path: str, spaces: bool) -> UnitEncoder:
    """One encoder, with its cache, per worker process and vocabulary."""
    key = (path, spaces)
    if key not in _LOADED:
        _LOADED[key] = UnitEncoder(path, spaces)
    return _LOADED[key]
