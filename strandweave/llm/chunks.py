"""Encoding of texts by remembered chunks, shared by the tokenising operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A chunk of these letters and then these signs is two pre-tokens: the letters, and the signs.
LETTERS = "".join(c for c in map(chr, range(ord("A"), 0x2B0)) if c.isalpha())
SIGNS = '.,;:!?#*$%&)"'


def byte_letters() -> list[str]:
    """One printable character for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def slices(texts: pa.Array, at_once: int) -> Iterator[pa.Array]:
    """Runs of whole texts of about ``at_once`` bytes; a longer text is a run of its own."""
    if not len(texts):
        return
    group = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // at_once
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield texts.slice(a, b - a)


class ChunkEncoder:
    """Encodes a text as the ids of its blank-separated chunks, remembering what it met before.

    A cut before a single blank that stands between two characters that are not white space is always a boundary of
    the pre-tokenising pattern, and what the pattern finds on either side does not depend on the other. Texts with a
    blank next to other white space are encoded whole.

    ``whole(texts)`` gives the id bytes of any texts, ``pieces(pre_tokens)`` those of single pre-tokens, and
    ``split(text)`` the pre-tokens of a text, or None where only ``whole`` may judge it. ``end`` is appended to every
    text. Arrow tells chunks apart, finds those met before and puts their ids together for some ``at_once`` bytes of
    text at a time, so that Python sees each new one once. About ``limit`` chunks and as many pre-tokens are remembered; what is forgotten is encoded again, which changes no result.
    """

    def __init__(self, whole: Callable, pieces: Callable, split: Callable, end: bytes = b"", limit: int = 1_000_000, at_once: int = 16_000_000):
        self.whole, self.pieces, self.split, self.end, self.limit, self.at_once = whole, pieces, split, end, limit, at_once
        self.keys, self.values = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.pre: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def _new(self, units: pa.Array) -> pa.Array:
        """Ids of words or chunks that stand behind a blank."""
        plain = pc.equal(pc.binary_length(pc.utf8_ltrim(units, LETTERS)), 0)
        words, others = ([" " + u for u in units.filter(mask).to_pylist()] for mask in (plain, pc.invert(plain)))
        cut = list(map(self.split, others))
        unseen = {p for own in cut if own for p in own}
        if len(self.pre) + len(unseen) > self.limit:
            self.pre = {}
        unseen = list(unseen.difference(self.pre))
        self.pre.update(zip(unseen, self.pieces(unseen), strict=True))
        hard = [t for t, own in zip(others, cut, strict=True) if own is None]
        judged, known = iter(self.whole(hard) if hard else ()), self.pre
        ids = self.pieces(words) + [next(judged) if own is None else b"".join([known[p] for p in own]) for own in cut]
        order = np.argsort(np.concatenate([np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (plain, pc.invert(plain))]))
        return pa.array(ids, pa.large_binary()).take(pa.array(order))

    def _chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of chunks that stand behind a blank; signs behind a word are looked up apart from it."""
        rest = pc.utf8_ltrim(chunks, LETTERS)
        plain = pc.and_(pc.equal(pc.binary_length(pc.utf8_rtrim(rest, SIGNS)), 0), pc.less(pc.binary_length(rest), pc.binary_length(chunks)))
        heads = pc.if_else(plain, pc.utf8_rtrim(chunks, SIGNS), chunks).dictionary_encode()
        tails = pc.if_else(plain, rest, "").dictionary_encode()
        signs = [t for t in tails.dictionary.to_pylist() if t and t not in self.signs]
        if len(self.signs) > self.limit:
            self.signs = {}
            signs = [t for t in tails.dictionary.to_pylist() if t]
        self.signs.update(zip(signs, self.pieces(signs), strict=True))
        table = pa.concat_arrays([self._known(heads.dictionary), pa.array([self.signs[t] if t else b"" for t in tails.dictionary.to_pylist()], pa.large_binary())])
        both = np.stack([heads.indices.to_numpy(), tails.indices.to_numpy() + len(heads.dictionary)], axis=1).ravel()
        pairs = table.take(pa.array(both))
        ends = np.frombuffer(pairs.buffers()[1], np.int64)[: len(both) + 1 : 2].copy()
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(ends), pairs.buffers()[2]])

    def _known(self, chunks: pa.Array) -> pa.Array:
        """Ids of different words or chunks, remembered or new."""
        place = pc.index_in(chunks, value_set=self.keys)
        fresh = place.is_null()
        new = chunks.filter(fresh)
        if not len(new):
            return self.values.take(place)
        if len(self.keys) + len(new) > self.limit:
            seen = place.drop_null()
            self.keys, self.values = self.keys.take(seen), self.values.take(seen)
            place = pc.index_in(chunks, value_set=self.keys)
        mask = fresh.to_numpy(zero_copy_only=False)
        at = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        at[mask] = len(self.keys) + np.arange(len(new))
        self.keys = pa.concat_arrays([self.keys, new])
        self.values = pa.concat_arrays([self.values, self._new(new)])
        return self.values.take(pa.array(at))

    def runs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of some texts in a row, where each text ends among them); a null text has no ids but ``end``."""
        for part in slices(texts, self.at_once):
            was = gc.isenabled()
            gc.disable()  # the many small tuples of a run form no cycles
            try:
                found = self._run(pc.fill_null(part, ""))
            finally:
                if was:
                    gc.enable()
            yield found

    def ids(self, texts: pa.Array) -> Iterator[memoryview]:
        """The id bytes of each text."""
        for ids, ends in self.runs(texts):
            view = memoryview(ids).cast("B")
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                yield view[4 * a : 4 * b]

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy()
        first, sizes = starts[:-1], np.diff(starts)
        cut = split.values.dictionary_encode()
        codes, chunks = cut.indices.to_numpy(), cut.dictionary
        width, bare = pc.binary_length(chunks).to_numpy(), pc.binary_length(pc.utf8_trim_whitespace(chunks)).to_numpy()
        odd = ((width == 0) | (width != bare))[codes]
        heads = chunks.take(pa.array(codes[first]))
        odd[first] = pc.binary_length(pc.utf8_rtrim_whitespace(heads)).to_numpy() != pc.binary_length(heads).to_numpy()
        whole = (sizes == 1) | np.logical_or.reduceat(odd, first)
        asked = pc.if_else(pa.array(whole), texts, heads).to_pylist()
        inner = ~np.repeat(whole, sizes)
        inner[first] = False
        used = np.zeros(len(chunks), np.bool_)
        used[codes[inner]] = True
        used = np.flatnonzero(used)
        # the place of each chunk among those used, then the heads, the end and one empty entry
        place = np.zeros(len(chunks), np.int64)
        place[used] = np.arange(len(used))
        at = np.where(inner, place[codes], len(used) + len(asked) + 1)
        at[first] = len(used) + np.arange(len(asked))
        if self.end:
            at = np.insert(at, starts[1:], len(used) + len(asked))
            starts = starts + np.arange(len(starts))
        table = pa.concat_arrays([self._chunks(chunks.take(pa.array(used))), pa.array([*self.whole(asked), self.end, b""], pa.large_binary())]).take(pa.array(at))
        ends = np.frombuffer(table.buffers()[1], np.int64)[starts] // 4
        data = table.buffers()[2]
        return np.frombuffer(data if data is not None else b"", "<u4")[: ends[-1]], ends[1:]
