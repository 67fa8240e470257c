"""Unigram segmentation into the pieces of a public vocabulary, and back.

The vocabulary file gives the pieces. Its scores are ranks of merges, not log probabilities, so
``fitted`` learns log probabilities from the documents: Spark counts the words of all of them,
and each round of EM goes over all counted words and sums the expected counts of the pieces.

A text is normalised as the file says (a leading marker, spaces as markers), and cut into the pieces of
highest total score by Viterbi over a double-array trie of their bytes. A character that no piece covers
costs ten less than the least score and becomes byte pieces. Decoding joins pieces, takes byte
pieces as UTF-8, and turns markers into spaces.

If no piece goes on past a space, the best path of a text is the best paths of its words one after
another; a word is then segmented once and remembered. Texts are taken many together, so a word is
looked up once for all of them. Words of equal size are segmented side by side. The trie is a few
megabytes and goes with the function; the file is read by the driver alone.
"""

from __future__ import annotations

import copy
import math
import re
import struct
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 250_000  # words of each of two generations whose pieces are kept
COUNTED = 300_000  # distinct words that a task counts before it hands them on
ROUNDS = 4
PRIOR = 0.5  # count of a piece before any is seen
LONG = 64  # bytes of a word above which it goes through its lattice alone, with the same sums
FEW = 64  # words of one size below which they are segmented alone
TOGETHER = 1_000_000  # characters of texts whose words are taken together
UNITS = 1 << 16  # expected counts are summed in whole parts of this size
PLAIN = 600.0  # words that cannot be less likely than exp(-PLAIN) are summed without logarithms

# Field numbers and piece types of the vocabulary file.
PIECES, NORMALIZER = 1, 3
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class DoubleArray:
    """A trie in two arrays: from state s, byte b leads to t = base[s] + b if check[t] is s."""

    SPAN = 512  # bases tried at once

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size = 1 << 16
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        self.check[0] = 0  # the root is taken
        todo, lowest = [(0, 0, len(keys), 0)], 256
        while todo:
            state, low, high, depth = todo.pop()
            if low < high and len(keys[low]) == depth:
                self.value[state] = values[low]
                low += 1
            if low == high:
                continue
            firsts = [k[depth] for k in keys[low:high]]
            edges = [i for i in range(len(firsts)) if i == 0 or firsts[i] != firsts[i - 1]]
            codes = np.array([firsts[i] for i in edges])
            base, lowest = self._fit(codes, lowest)
            self.base[state] = base
            self.check[base + codes] = state
            for i, edge in enumerate(edges):
                end = low + (edges[i + 1] if i + 1 < len(edges) else len(firsts))
                todo.append((base + int(codes[i]), low + edge, end, depth + 1))

    def _fit(self, codes: np.ndarray, lowest: int) -> tuple[int, int]:
        """The first base whose places for ``codes`` are free, and where the next search starts."""
        base = lowest - int(codes[0])
        while True:
            self._room(base + self.SPAN + 256)
            free = np.ones(self.SPAN, bool)
            for code in codes:
                free &= self.check[base + code:base + code + self.SPAN] < 0
            at = int(free.argmax())
            if free[at]:
                break
            base += self.SPAN
        # full stretches are not searched again
        taken = self.check[lowest:lowest + 64] >= 0
        return base + at, lowest + 64 if taken.mean() > 0.9 else lowest

    def _room(self, size: int) -> None:
        if size >= len(self.check):
            for name, fill in (("base", 0), ("check", -1), ("value", -1)):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.full(len(old), fill, np.int32)]))


class Vocabulary:
    """Pieces, scores and normalisation of a vocabulary file."""

    def __init__(self, data: bytes) -> None:
        self.pieces, self.scores, self.kinds = [], [], []
        self.prefix, self.squeeze, self.escape, rules = True, True, True, b""
        for number, value in _fields(data):
            if number == PIECES:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == NORMALIZER:
                own = dict(_fields(value))
                rules = own.get(2, b"")
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
                self.escape = bool(own.get(5, 1))
        if rules or not self.escape:
            raise ValueError("only vocabularies without character rules and with markers are read")
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(
            self.pieces, self.kinds, strict=True)) if k == BYTE}
        usual = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        self._settle()
        self.trie = DoubleArray([self.pieces[i].encode() for i in usual], usual)
        inner = any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in usual)
        lines = self.lines = any("\n" in self.pieces[i] for i in usual)
        self.words = None if inner else re.compile(
            f"{MARK}+[^{MARK}]*|[^{MARK}]+" if lines else f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def _settle(self) -> None:
        """Scores that follow from those of the normal pieces."""
        plain = [s for s, k in zip(self.scores, self.kinds, strict=True) if k == NORMAL]
        self.least = min(plain, default=0.0) - UNKNOWN_PENALTY
        for i, kind in enumerate(self.kinds):  # pieces a user defined always win
            if kind == USER:
                self.scores[i] = len(self.pieces[i]) * max(plain, default=0.0) - 0.1

    def rescored(self, counts: np.ndarray) -> Vocabulary:
        """The same pieces, with the logarithms of their shares of ``counts`` as scores."""
        normal = np.array(self.kinds) == NORMAL
        weights = np.where(normal, counts + PRIOR, 0.0)
        logs = np.log(np.where(normal, weights / weights.sum(), 1.0))
        other = copy.copy(self)
        other.scores = [float(x) if n else s for x, n, s in zip(logs, normal, self.scores, strict=True)]
        other._settle()
        return other

    def units(self, text: str) -> list[str]:
        """The parts of a normalised text that are segmented by themselves."""
        return [text] * bool(text) if self.words is None else self.words.findall(text)

    def spaced(self, text: str) -> str:
        """The units of a normalised text, which has no spaces, with spaces between them."""
        if self.words is None:
            return text
        if self.lines or MARK * 2 in text:
            return " ".join(self.units(text))
        return text.replace(MARK, " " + MARK).replace("\n", " \n ")

    def unit_table(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of normalised texts, the number of each unit in order, and where texts end.

        The empty unit may be among them.
        """
        lists = pc.split_pattern(pa.array([self.spaced(text) for text in texts], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        return (coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(),
                lists.offsets.to_numpy()[1:])

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)


class Lattice:
    """All ways to cut words of equal size, side by side.

    Places are numbered by their offset in the word, then by word, so the next byte of a word is ``n`` on.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        trie = vocabulary.trie
        self.base, self.check, self.value = (x.astype(np.int64) for x in (trie.base, trie.check, trie.value))
        self.scores = np.array([*vocabulary.scores, vocabulary.least])  # the last for an unknown character

    def ways(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[slice]]:
        """(from, to, piece) of every piece in the words, and the ways from each offset.

        ``data`` has a row of bytes per word; piece -1 is an unknown character. The ways from one
        offset come by their length and lead to different places.
        """
        n, size = data.shape
        flat = data.T.ravel()
        start = np.flatnonzero((flat & 0xC0) != 0x80)
        lead = flat[start]
        after = start + n * (1 + (lead >= 0x80) + (lead >= 0xE0) + (lead >= 0xF0)).astype(np.int64)
        single = np.zeros(len(flat), bool)
        froms, tos, pieces = [], [], []
        origin, own_after, place, state = start, after, start, np.zeros(len(start), np.int64)
        while len(place):
            go = self.base[state] + flat[place]
            on = np.flatnonzero((self.check[go] == state) & (go != 0))
            origin, own_after, place, state = origin[on], own_after[on], place[on] + n, go[on]
            found = self.value[state]
            hit = np.flatnonzero(found >= 0)
            froms.append(origin[hit])
            tos.append(place[hit])
            pieces.append(found[hit])
            single[froms[-1][tos[-1] == own_after[hit]]] = True
            on = np.flatnonzero(place < len(flat))
            origin, own_after, place, state = origin[on], own_after[on], place[on], state[on]
        lost = ~single[start]
        froms.append(start[lost])
        tos.append(after[lost])
        pieces.append(np.full(len(froms[-1]), -1))
        froms, tos, pieces = np.concatenate(froms), np.concatenate(tos), np.concatenate(pieces)
        offset = (froms // n).astype(np.min_scalar_type(size))
        order = np.argsort(offset, kind="stable")
        stops = np.cumsum(np.bincount(offset, minlength=size)).tolist()
        return froms[order], tos[order], pieces[order], list(map(slice, [0, *stops], stops))

    def best(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``Coder.segment`` of each row: all pieces, and where those of each row end.

        The end is negative where a character is unknown.
        """
        n, size = data.shape
        froms, tos, pieces, offsets = self.ways(data)
        scores = self.scores[pieces]
        best = np.full(n * (size + 1), -np.inf)
        best[:n] = 0.0
        way = np.zeros(n * (size + 1), np.int64)
        for own in offsets:
            to, total = tos[own], best[froms[own]] + scores[own]
            more = np.flatnonzero(total > best[to])
            to = to[more]
            best[to], way[to] = total[more], more + own.start
        rows, at = np.arange(n), np.arange(n) + n * size
        owners, found = [], []
        while len(rows):
            last = way[at]
            owners.append(rows)
            found.append(pieces[last])
            at = froms[last]
            on = np.flatnonzero(at >= n)
            rows, at = rows[on], at[on]
        owners, found = np.concatenate(owners[::-1]), np.concatenate(found[::-1])
        order = np.argsort(owners.astype(np.min_scalar_type(n)), kind="stable")
        unknown = np.zeros(n, bool)
        unknown[owners[found < 0]] = True
        stops = np.cumsum(np.bincount(owners, minlength=n))
        return found[order], np.where(unknown, -stops, stops)

    def expected(self, data: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Adds how often each piece is expected in the words (forward and backward sums)."""
        n, size = data.shape
        froms, tos, pieces, offsets = self.ways(data)
        scores = self.scores[pieces]
        # a word has at least the weight of its characters one by one, none below the unknown one
        if size * -self.scores[-1] <= PLAIN:
            weights = np.exp(scores)
            ahead, back = np.zeros((2, n * (size + 1)))
            ahead[:n] = back[n * size:] = 1.0
            for own in offsets:
                ahead[tos[own]] += ahead[froms[own]] * weights[own]
            for at in range(size - 1, -1, -1):
                own = offsets[at]
                back[at * n:at * n + n] = np.bincount(froms[own] - at * n, back[tos[own]] * weights[own], n)
            share = ahead[froms] * weights * back[tos] * (counts / ahead[n * size:])[froms % n]
        else:
            ahead, back = np.full((2, n * (size + 1)), -np.inf)
            ahead[:n] = back[n * size:] = 0.0
            for own in offsets:
                to = tos[own]
                ahead[to] = np.logaddexp(ahead[to], ahead[froms[own]] + scores[own])
            for own in reversed(offsets):
                np.logaddexp.at(back, froms[own], back[tos[own]] + scores[own])
            share = np.exp(ahead[froms] + scores + back[tos] - ahead[n * size:][froms % n]) * counts[froms % n]
        known = pieces >= 0
        np.add.at(into, pieces[known], np.rint(share[known] * UNITS).astype(np.int64))


def by_size(units: Iterable[tuple[bytes, int]], most: int = 4096) -> Iterator[
        tuple[list[int], np.ndarray]]:
    """(values, bytes by row) of units of equal size, ``most`` at once; ``units`` are (bytes, value)."""
    groups: dict[int, tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
    for data, value in units:
        parts, values = groups[len(data)]
        parts.append(data)
        values.append(value)
        if len(parts) == most:
            yield values, _rows(parts)
            del groups[len(data)]
    for parts, values in groups.values():
        yield values, _rows(parts)


def _rows(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), -1)


def counted_by_size(batches: Iterable[pa.RecordBatch], alone: Callable[[str, int], None],
                    most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n, bytes by row) of units of equal size from (unit, n), some ``most`` at once.

    Units of more than ``LONG`` bytes go to ``alone``.
    """
    groups: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    for batch in batches:
        units, counts = batch["unit"].cast(pa.large_binary()), batch["n"].to_numpy()
        places = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
        data, sizes = np.frombuffer(units.buffers()[2] or b"", np.uint8), np.diff(places)
        for i in np.flatnonzero(sizes > LONG).tolist():
            alone(units[i].as_py().decode(), int(counts[i]))
        for size in np.unique(sizes[(sizes > 0) & (sizes <= LONG)]).tolist():
            own = np.flatnonzero(sizes == size)
            groups[size].append((counts[own], data[places[own][:, None] + np.arange(size)]))
            if sum(len(n) for n, _ in groups[size]) >= most:
                yield _stacked(groups.pop(size))
    yield from map(_stacked, groups.values())


def _stacked(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    counts, rows = zip(*parts, strict=True)
    return np.concatenate(counts), np.concatenate(rows)


def _log_sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class Coder:
    """Encodes and decodes; made in each worker from a vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = self.v = vocabulary
        self.base, self.check = v.trie.base.tolist(), v.trie.check.tolist()
        self.value = v.trie.value.tolist()
        self.known: dict[str, bytes] = {}  # pieces as 32-bit numbers
        self.before: dict[str, bytes] = {}  # the generation before
        self.misspelt: set[str] = set()  # words whose pieces do not spell them
        self.lattice = Lattice(v)
        self.spoken = [b"" if k in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if k == BYTE
                       else p.encode() for p, k in zip(v.pieces, v.kinds, strict=True)]
        self.spoken_data = np.frombuffer(b"".join(self.spoken), np.uint8)
        self.spoken_sizes = np.array([len(x) for x in self.spoken])
        self.spoken_ends = np.cumsum(self.spoken_sizes)

    def normalised(self, text: str) -> str:
        return self.v.normalised(text)

    def remember(self, texts: list[list[str]]) -> None:
        """Segments the words of ``texts`` that are not known yet, many side by side."""
        self._make_room()
        known, before = self.known, self.before
        fresh = []
        for unit in {u for units in texts for u in units if u not in known}:
            old = before.get(unit)
            if old is None:
                fresh.append(unit)
            else:
                known[unit] = old
        short = ((data, i) for i, u in enumerate(fresh) if len(data := u.encode()) <= LONG)
        for places, rows in by_size(short):
            if len(places) >= FEW:
                flat, stops = self.lattice.best(rows)
                right = self._spelt(flat, stops, rows)
                flat, first = flat.astype("<i4").tobytes(), 0
                for i, stop, spelt in zip(places, (4 * stops).tolist(), right, strict=True):
                    if stop > 0:
                        known[fresh[i]] = flat[first:stop]
                        if not spelt:
                            self.misspelt.add(fresh[i])
                    first = abs(stop)

    def _spelt(self, flat: np.ndarray, stops: np.ndarray, rows: np.ndarray) -> list[bool]:
        """Per row whether its pieces spell its bytes; rows with unknown characters count as misspelt."""
        n, size = rows.shape
        owner = np.repeat(np.arange(n), np.diff(np.abs(stops), prepend=0))
        right = (np.bincount(owner, self.spoken_sizes[flat], n) == size) & (stops > 0)
        flat = flat[right[owner]]
        sizes = self.spoken_sizes[flat]
        places = np.repeat(self.spoken_ends[flat] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
        data = self.spoken_data[places]
        right[right] = (data.reshape(-1, size) == rows[right]).all(axis=1)
        return right.tolist()

    def _make_room(self) -> None:
        """Frequent words live on: they are taken over from the generation before."""
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {}
            self.misspelt.intersection_update(self.before)

    def segment(self, unit: str) -> list[int]:
        """The pieces of highest total score (Viterbi); ties go to the earlier start."""
        data = unit.encode()
        n, scores, least = len(data), self.v.scores, self.v.least
        base, check, value = self.base, self.check, self.value
        best, start, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            so_far = best[at]
            if so_far is None:
                continue
            lead = data[at]
            after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            state, to, single = 0, at, False
            while to < n:
                go = base[state] + data[to]
                if check[go] != state or go == 0:
                    break
                state, to = go, to + 1
                found = value[state]
                if found >= 0:
                    total = so_far + scores[found]
                    single = single or to == after
                    if best[to] is None or total > best[to]:
                        best[to], start[to], piece[to] = total, at, found
            if not single:
                total = so_far + least
                if best[after] is None or total > best[after]:
                    best[after], start[after], piece[after] = total, at, -1
        out, end = [], n
        while end > 0:
            if piece[end] >= 0:
                out.append(piece[end])
            elif self.v.bytes:
                out += [self.v.bytes[b] for b in reversed(data[start[end]:end])]
            elif not out or out[-1] != self.v.unknown:
                out.append(self.v.unknown)  # neighbouring unknown characters are one piece
            end = start[end]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        return self.joined(self.v.units(self.normalised(text))).tolist()

    def joined(self, units: list[str]) -> np.ndarray:
        """The pieces of units one after another."""
        return np.frombuffer(b"".join(self.looked_up(units)), "<i4")

    def strung(self, units: list[str], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of ``units`` in an order one after another, and where those of each end."""
        packed = self.looked_up(units)
        flat = np.frombuffer(b"".join(packed), "<i4")
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(sizes)
        return flat[np.repeat(first - ends + sizes, sizes) + np.arange(sizes.sum())], ends

    def looked_up(self, units: list[str]) -> list[bytes]:
        """The pieces of each unit, segmented here if they are not known."""
        known, before = self.known, self.before
        out = list(map(known.get, units))
        if None in out:
            for i, unit in enumerate(units):
                if out[i] is None:
                    out[i] = known.get(unit) or before.get(unit) or self._learnt(unit)
                    if len(unit) <= LONG:
                        known[unit] = out[i]
        return out

    def _learnt(self, unit: str) -> bytes:
        ids = self.segment(unit)
        if b"".join(map(self.spoken.__getitem__, ids)) != unit.encode():
            self.misspelt.add(unit)
        return np.array(ids, "<i4").tobytes()

    def lossless(self, text: str, normal: str, units: list[str]) -> bool:
        """Whether decoding the pieces of ``units``, which make up ``normal``, gives ``text`` back.

        Pieces are decoded once per word, when it is learnt; a text of words that are spelt right
        decodes to ``normal``.
        """
        if self.misspelt and not self.misspelt.isdisjoint(units):
            return self.decode(self.joined(units).tolist()) == self._wanted(text)
        return self._spaced(normal) == self._wanted(text)

    def _wanted(self, text: str) -> str:
        return re.sub(" +", " ", text).strip(" ") if self.v.squeeze else text

    def _spaced(self, normal: str) -> str:
        if self.v.prefix and normal.startswith(MARK):
            normal = normal[1:]
        return normal.replace(MARK, " ")

    def expected(self, unit: str, count: int, into: np.ndarray) -> None:
        """As ``Lattice.expected`` of one word of any size; only the sums are kept, not the ways."""
        data, scores = unit.encode(), self.v.scores
        n = len(data)
        ahead, back = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        ahead[0] = back[n] = 0.0
        for at in range(n):
            if ahead[at] > -math.inf:
                for to, found in self._ways(data, at):
                    ahead[to] = _log_sum(ahead[to], ahead[at] + (scores[found] if found >= 0 else self.v.least))
        for at in range(n - 1, -1, -1):
            if ahead[at] == -math.inf:
                continue
            for to, found in self._ways(data, at):
                rest = back[to] + (scores[found] if found >= 0 else self.v.least)
                back[at] = _log_sum(back[at], rest)
                if found >= 0:
                    into[found] += round(math.exp(ahead[at] + rest - ahead[n]) * count * UNITS)

    def _ways(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of the pieces from a place on; -1 for a character that is none."""
        lead = data[at]
        after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
        state, to, single = 0, at, False
        while to < len(data):
            go = self.base[state] + data[to]
            if self.check[go] != state or go == 0:
                break
            state, to = go, to + 1
            if self.value[state] >= 0:
                single = single or to == after
                yield to, self.value[state]
        if not single:
            yield after, -1

    def decode(self, ids: Iterable[int]) -> str:
        return self._spaced(b"".join(map(self.spoken.__getitem__, ids)).decode("utf-8", "replace"))


def load(path: str = VOCABULARY) -> Vocabulary:
    return Vocabulary(Path(path).read_bytes())


def parted(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows of a batch whose texts are taken together, and those texts."""
    first, size, texts = 0, 0, []
    for i, value in enumerate(batch["_text"], 1):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER or i == len(batch):
            yield batch.slice(first, i - first), texts
            first, size, texts = i, 0, []


def word_counts(docs: DataFrame, text: Column, vocabulary: Vocabulary) -> DataFrame:
    """(unit, n): how often each word occurs in all texts."""
    schema = pa.schema([("unit", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_arrays([pa.array(list(counts), pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], schema=schema)
            counts.clear()
            yield from whole.to_batches(max_chunksize=10_000)

        for batch in batches:
            for _, texts in parted(batch):
                units, order, _ = vocabulary.unit_table([vocabulary.normalised(text) for text in texts])
                for unit, n in zip(units, np.bincount(order, minlength=len(units)).tolist(), strict=True):
                    if unit:
                        counts[unit] += n
                if len(counts) >= COUNTED:
                    yield from flush()
        yield from flush()

    each = docs.select(text.cast("string").alias("_text")).mapInArrow(run, "unit string, n long")
    return each.groupBy("unit").agg(F.sum("n").alias("n"))


def expected_counts(words: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each piece is expected in ``words`` (unit, n) by the scores of ``vocabulary``."""
    schema = pa.schema([("piece", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, into = Coder(vocabulary), np.zeros(len(vocabulary.pieces), np.int64)
        for n, rows in counted_by_size(batches, lambda unit, n: coder.expected(unit, n, into)):
            coder.lattice.expected(rows, n, into)
        some = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(into[some])], schema=schema)

    out = np.zeros(len(vocabulary.pieces))
    # one row per piece
    for row in words.mapInArrow(run, "piece int, n long").groupBy("piece").agg(
            F.sum("n").alias("n")).collect():
        out[row["piece"]] = row["n"] / UNITS
    return out


def fitted(docs: DataFrame, text: Column, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Vocabulary:
    """``vocabulary`` with log probabilities learnt from all texts by EM, from equal ones on."""
    words = stored(word_counts(docs, text, vocabulary), "piece-words")
    vocabulary = vocabulary.rescored(np.zeros(len(vocabulary.pieces)))
    for _ in range(rounds):
        vocabulary = vocabulary.rescored(expected_counts(words, vocabulary))
    return vocabulary


ENCODED_DDL = "ids array<int>, n_pieces long, n_byte_pieces long, lossless boolean"


def encoded(docs: DataFrame, doc_id: Column, text: Column, vocabulary: Vocabulary | None = None
            ) -> DataFrame:
    """Per row of ``docs``: _id, ids, n_pieces, n_byte_pieces, lossless.

    ``lossless`` says whether decoding gives the text back (as normalised where the vocabulary drops
    spaces); a text that itself holds the marker comes back with a space. Null and empty texts have
    no piece. Repeated rows and null ids each give a row. Without a ``vocabulary`` that of the file
    is fitted to the texts.
    """
    vocabulary = vocabulary or fitted(docs, text, load())
    schema = pa.schema([("_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()),
                        ("n_byte_pieces", pa.int64()), ("lossless", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        is_byte = np.zeros(len(vocabulary.pieces), bool)
        is_byte[list(vocabulary.bytes.values())] = True
        for batch in batches:
            for part, texts in parted(batch):
                normal = [vocabulary.normalised(text) for text in texts]
                units, order, ends = vocabulary.unit_table(normal)
                coder.remember([units])
                flat, stops = coder.strung(units, order)
                rough = not coder.misspelt.isdisjoint(units)
                whole = [coder.lossless(text, own, vocabulary.units(own) if rough else [])
                         for text, own in zip(texts, normal, strict=True)]
                bounds = np.concatenate([[0], stops[ends - 1]])
                n_bytes = np.diff(np.concatenate([[0], np.cumsum(is_byte[flat])])[bounds])
                yield pa.RecordBatch.from_arrays(
                    [part["_id"], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)),
                     pa.array(np.diff(bounds)), pa.array(n_bytes), pa.array(whole)], schema=schema)

    return docs.select(doc_id.cast("long").alias("_id"), text.cast("string").alias("_text")).mapInArrow(
        run, f"_id long, {ENCODED_DDL}")


def decoded(rows: DataFrame, ids: str = "ids", name: str = "text",
            vocabulary: Vocabulary | None = None) -> DataFrame:
    """``rows`` with the text of their pieces; a null list gives null, an id out of range an error."""
    vocabulary = vocabulary or load()
    kept = [c for c in rows.columns if c != name]
    schema = rows.select(*kept).schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            text = pa.array([None if x is None else coder.decode(x) for x in batch[ids].to_pylist()],
                            pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, name])

    return rows.select(*kept).mapInArrow(run, schema)
