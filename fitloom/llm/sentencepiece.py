"""SentencePiece encoding and decoding by a max-plus scan.

The model file is of the BPE kind: a segmentation is the library's if and only if any two
neighbouring pieces, encoded by merges alone, come out as these two pieces. So the lattice of
pieces has one path, and its weights are 0 for a fitting pair and minus infinity for others.

Positions that no piece crosses cut a text into short stretches, whose encodings are kept.
Stretches met for the first time go over the lattice together, one step for all of them at a
time: pieces come from a trie, fitting pairs from a table, both in arrays. A giant text is split into chunks anywhere: a chunk's matrix says which state at its end (the
piece over the border, and how far it reaches) each state at its start leads to. Matrices
combine associatively by max-plus products; the states on the one finite path are then known
at every border, and each chunk is traced back on its own.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.session import materialise

#: Characters of a chunk; longer texts are encoded by several tasks.
CHUNK = 1 << 16
#: Stretches and pairs that a worker keeps; a memory bound, as workers live on when their
#: task is done.
KEPT_STRETCHES, KEPT_PAIRS = 160_000, 400_000
#: Characters of the longest stretch that is kept, and of the longest run of joined characters
#: that goes over the lattice with others.
SHORT = 64
#: Rows whose ids are handed on together, and the characters from which fewer rows are.
ROWS, TOGETHER = 500, 1 << 20
#: A chunk border is moved back up to so far to a position that no piece crosses.
SEARCH = 512

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6

State = tuple[int, int, int]  # characters before and after the border that a piece covers, and its id


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


class Lookup:
    """Whole numbers by keys from 0 on, open addressing in arrays, for many keys at once."""

    def __init__(self, most: int) -> None:
        bits = max(4, (2 * most).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        self.size = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Takes in distinct keys that it doesn't hold, ``most`` in all."""
        self.size += len(keys)
        slots = self._slots(keys)
        while len(keys):
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] < 0]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, -1 for those it doesn't hold."""
        slots = self._slots(keys)
        met = self.keys[slots]
        out = np.where(met == keys, self.values[slots], -1)
        open_ = np.flatnonzero((met != keys) & (met >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            met = self.keys[slots[open_]]
            hit = met == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (met >= 0)]
        return out


class Model:
    """Pieces and scores of a model file, its lattice and its encodings."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        self.pieces: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        trainer = dict(_fields(next((v for k, v in top if k == 2), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model is not of the BPE kind")
        normalizer = dict(_fields(next((v for k, v in top if k == 3), b"")))
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("the model changes its texts, so they could not be decoded again")
        self.prefix = bool(normalizer.get(3, 1))
        for number, value in top:
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if kinds[i] == BYTE}
        self.spelled = [
            bytes([int(p[3:5], 16)]) if kinds[i] == BYTE else b"" if kinds[i] == CONTROL else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.longest = max(map(len, self.ids))
        alphabet = set("".join(self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or len(self.bytes) < 256:
            raise ValueError("pieces cross word starts, or bytes are missing")
        own = "".join(c for c in "\n\r\t" if c not in alphabet)
        self._alone = np.zeros(256, bool)
        self._alone[list(own.encode())] = True
        def short(tail: str) -> set[int]:
            return {1} | {n for n in (2, 3) if tail[-n:] in self.ids and n <= len(tail)}

        tails: dict[str, set[int]] = {p[-3:]: short(p[-3:]) for p in self.ids if len(p) > 2}
        for p in self.ids:
            if len(p) > 3:
                tails.setdefault(p[-4:], short(p[-4:])).add(len(p))
        #: Sizes of the pieces that may end with four characters, or up to three with three,
        #: longest first.
        self._tails = {k: tuple(sorted(v, reverse=True)) for k, v in tails.items()}
        #: Neighbouring characters within pieces; no piece crosses between any others.
        self._joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: One object for each piece, so that what is kept shares them.
        self._same = {p: p for p in self.ids}
        self._kept: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self.kept = KEPT_STRETCHES
        self._spelled = pa.array(self.spelled, pa.binary())
        self._arrays()

    def _arrays(self) -> None:
        """What the lattice needs of many stretches: a character's piece, or its code point
        behind all pieces; the trie of the pieces; joined characters; known pairs."""
        n = len(self.pieces)
        self._single = np.arange(n, n + 0x110000, dtype=np.int32)
        nodes, keys = {"": 0}, []
        for p in self.ids:
            if len(p) == 1:
                self._single[ord(p)] = self.ids[p]
            for i in range(1, len(p) + 1):
                if p[:i] not in nodes:
                    nodes[p[:i]] = len(nodes)
                    keys.append(nodes[p[: i - 1]] << 21 | ord(p[i - 1]))
        self._trie = Lookup(len(keys))
        self._trie.add(np.array(keys, np.int64), np.arange(1, len(nodes), dtype=np.int32))
        self._at_node = np.array([self.ids.get(p, -1) for p in nodes], np.int32)
        joined = np.array([ord(a) << 21 | ord(b) for a, b in self._joined], np.int64)
        self._joins = Lookup(len(joined))
        self._joins.add(joined, np.ones(len(joined), np.int32))
        self._fitting = Lookup(KEPT_PAIRS)

    # pieces and pairs

    def merged(self, text: str) -> list[str]:
        """Pieces by merges alone: again and again the best-scored pair, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                number = self.ids.get(parts[i] + parts[i + 1])
                if number is not None and (best is None or self.scores[number] > best):
                    best, at = self.scores[number], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether ``right`` may follow ``left``; no left piece asks whether ``right`` is one at all."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            known = (not left or self.fits("", right)) and self.merged(left + right) == ([left, right] if left else [right])
            self._pairs[self._same.get(left, left), self._same.get(right, right)] = known
        return known

    def path(self, text: str, start: int, left: str, end: int) -> list[str | None]:
        """For every position of ``text[start:end]`` the last piece of the path that begins
        after ``left``, or None where no path ends."""
        return self._onward(text, start, [left], end)

    def _onward(self, text: str, start: int, known: list[str | None], end: int) -> list[str | None]:
        """The same from a known beginning."""
        pairs, tails, ids, last = self._pairs, self._tails, self.ids, list(known)
        for i in range(len(known), end - start + 1):
            stop, found = start + i, None
            sizes = (tails.get(text[stop - 4 : stop]) if i > 3 else None) or (tails.get(text[stop - 3 : stop]) if i > 2 else None)
            for size in sizes or (_TWO if i > 1 and text[stop - 2 : stop] in ids else _ONE):
                before = last[i - size] if size <= i else None
                if before is not None:
                    piece = text[stop - size : stop]
                    fits = pairs.get((before, piece))
                    if fits or fits is None and (size < 4 or piece in ids) and self.fits(before, piece):
                        found = piece
                        break
            last.append(found)
        return last

    def trace(self, last: list[str | None], at: int) -> list[str]:
        """The pieces of the path that ends ``at`` characters after its start."""
        pieces: list[str] = []
        while at > 0:
            pieces.append(last[at])
            at -= len(last[at])
        return pieces[::-1]

    def numbers(self, pieces: list[str]) -> bytes:
        """Ids of pieces as packed 32-bit integers; characters without a piece as their bytes."""
        out: list[int] = []
        for p in pieces:
            number = self.ids.get(p)
            if number is None:
                out += [self.bytes[b] for b in p.replace(_OWN, SPACE).encode("utf-8", "surrogatepass")]
            else:
                out.append(number)
        return array("i", out).tobytes()

    # whole texts

    def prepared(self, text: str) -> str:
        """Spaces as word starts; one that the text itself contains stands as a character of its own."""
        marked = self._marked(text)
        return SPACE + marked if self.prefix and text else marked

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`fits` for arrays of numbers; -1 is no left piece. A number from the count of
        pieces on is a character without one."""
        keys = (left.astype(np.int64) + 1) << 32 | right
        out = self._fitting.get(keys)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            n = len(self.pieces)
            told = lambda i: self.pieces[i] if i < n else chr(i - n)
            known = np.empty(len(fresh), np.int32)
            for k, key in enumerate(fresh.tolist()):
                a, b = told((key >> 32) - 1) if key >> 32 else "", told(key & 0xFFFFFFFF)
                known[k] = self.merged(a + b) == ([a, b] if a else [b])
            if len(fresh) <= KEPT_PAIRS:
                if self._fitting.size + len(fresh) > KEPT_PAIRS:
                    self._fitting = Lookup(KEPT_PAIRS)
                self._fitting.add(fresh, known)
            out[new] = known[back]
        return out == 1

    def _together(self, stretches: list[bytes]) -> list[bytes]:
        """Packed ids of every stretch, by one walk over the lattice of all of them."""
        raw = b"".join(stretches)
        text = self._marked(raw.decode("utf-8", "surrogatepass"))
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        chars = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        n, stops = len(codes), chars[np.cumsum([len(s) for s in stretches]) - 1]
        first = np.ones(n, bool)
        first[1:] = self._joins.get(codes[:-1] << 21 | codes[1:]) < 0
        first[stops[:-1]] = True
        begins = np.flatnonzero(first).astype(np.int32)
        ends = np.append(begins[1:], np.int32(n))
        begin, end = np.repeat(begins, ends - begins), np.repeat(ends, ends - begins)

        # pieces by where they start, their sizes and numbers
        at = np.flatnonzero(end - begin <= SHORT).astype(np.int32)
        room, node, size = end[at] - at, self._trie.get(codes[at]), 1
        starts, sizes, numbers = [at], [np.ones(len(at), np.uint8)], [self._single[codes[at]]]
        while True:
            on = (node >= 0) & (room > size)
            at, room, node, size = at[on], room[on], node[on], size + 1
            if not len(at):
                break
            node = self._trie.get(node.astype(np.int64) << 21 | codes[at + (size - 1)])
            number = self._at_node[node]
            found = np.flatnonzero((node >= 0) & (number >= 0))
            starts.append(at[found])
            sizes.append(np.full(len(found), size, np.uint8))
            numbers.append(number[found])
        start, wide, number = np.concatenate(starts), np.concatenate(sizes), np.concatenate(numbers)

        # the piece of the path that ends at every position, by distance from the beginning: of
        # pieces that end there the longest is tried first, and at most one fits
        last, width = np.full(n + 1, -1, np.int32), np.zeros(n + 1, np.uint8)
        step = ((start + wide - begin[start]) * (size + 1) + size - wide).astype(np.int16)
        order = np.argsort(step, kind="stable")
        start, wide, number = start[order], wide[order], number[order]
        groups = np.cumsum(np.bincount(step, minlength=1)).tolist()
        for lo, hi in zip([0, *groups], groups, strict=False):
            if lo == hi:
                continue
            w = int(wide[lo])
            stop = start[lo:hi] + w
            open_ = np.flatnonzero(last[stop] < 0)
            a, stop, own = start[lo:hi][open_], stop[open_], number[lo:hi][open_]
            head = a == begin[a]
            left = np.where(head, -1, last[a])
            fits = self._fit(left, own) & (head | (left >= 0))
            last[stop[fits]], width[stop[fits]] = own[fits], w

        path = np.zeros(n + 1, bool)
        short = ends - begins <= SHORT
        for a, b in zip(begins[~short].tolist(), ends[~short].tolist(), strict=True):
            for p in self.trace(self.path(text[a:b], 0, "", b - a), b - a):
                a += len(p)
                path[a], last[a] = True, self.ids.get(p, len(self.pieces) + ord(p[0]))
        at, begin = ends[short], begins[short]
        if (last[at] < 0).any():
            raise ValueError("no path through the lattice")
        while len(at):
            path[at] = True
            at = at - width[at]
            on = at > begin
            at, begin = at[on], begin[on]

        ids, bounds = last[path], np.concatenate(([0], np.cumsum(path)[stops]))
        packed, cuts = ids.tobytes(), (4 * bounds).tolist()
        out = [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        odd = np.unique(np.searchsorted(bounds, np.flatnonzero(ids >= len(self.pieces)), "right") - 1)
        for i in odd.tolist():
            own = ids[bounds[i] : bounds[i + 1]].tolist()
            out[i] = self.numbers([self.pieces[x] if x < len(self.pieces) else chr(x - len(self.pieces)) for x in own])
        return out

    def _marked(self, text: str) -> str:
        return text.replace(SPACE, _OWN).replace(" ", SPACE)

    def _ids(self, stretches: list[bytes]) -> list[bytes]:
        """Packed ids of distinct stretches. What was asked since the last generation but one is kept."""
        kept, older = self._kept, self._older
        found = list(map(kept.get, stretches))
        for i in [i for i, f in enumerate(found) if f is None]:
            if (old := older.get(stretches[i])) is not None:
                found[i] = kept[stretches[i]] = old
        fresh = [i for i, f in enumerate(found) if f is None]
        if fresh:
            for i, new in zip(fresh, self._together([stretches[i] for i in fresh]), strict=True):
                found[i] = new
                if len(stretches[i]) <= SHORT:
                    kept[stretches[i]] = new
        if len(kept) >= self.kept:
            self._older, self._kept = kept, {}
        return found

    def encode_rows(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, texts in UTF-8 with a space before them if the model has one; where
        those of every row begin, and the last end.

        A stretch begins with a space behind another character; line ends are on their own.
        """
        raw = b"".join(rows)
        if not raw:
            return np.empty(0, np.int32), np.zeros(len(rows) + 1, np.int64)
        data, row_at = np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, rows)])
        space, alone = data == 32, self._alone[data]
        first = np.ones(len(data) + 1, bool)
        first[1:-1] = space[1:] & ~space[:-1] | alone[1:] | alone[:-1]
        first[row_at] = True
        places = np.flatnonzero(first)
        parts = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(raw)])
        parts = parts.dictionary_encode()
        found, which = self._ids(parts.dictionary.to_pylist()), parts.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins, counts = (np.cumsum(sizes) - sizes)[which], sizes[which]
        stops = np.concatenate(([0], np.cumsum(counts)))
        ids = np.frombuffer(b"".join(found), np.int32)[np.repeat(begins - stops[:-1], counts) + np.arange(stops[-1])]
        return ids, stops[np.searchsorted(places, row_at)]

    def rows(self, texts: list[str]) -> list[bytes]:
        return [(" " + t if self.prefix and t else t).encode("utf-8", "surrogatepass") for t in texts]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        return self.encode_rows(self.rows([text or ""]))[0]

    def decodes(self, ids: np.ndarray, bounds: np.ndarray, rows: list[bytes]) -> list[bool]:
        """Whether the ids between the bounds spell each row."""
        spelled = self._spelled.take(pa.array(ids))
        at = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1)[bounds].tolist()
        told = spelled.buffers()[2].to_pybytes() if len(ids) else b""
        return [told[a:b] == row for a, b, row in zip(at, at[1:], rows, strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    # chunks of giant texts

    def cut(self, text: str, at: int) -> bool:
        """Whether no piece can cross the position."""
        return at <= 0 or at >= len(text) or text[at - 1 : at + 1] not in self._joined

    def border(self, text: str, at: int) -> int:
        """``at``, or the nearest position before it that no piece can cross."""
        for i in range(at, max(at - SEARCH, 0), -1):
            if self.cut(text, i):
                return i
        return at

    def states(self, text: str, at: int) -> list[State]:
        """Pieces over the position: those that cover the character before it. One state where
        no piece crosses."""
        if self.cut(text, at):
            return [(0, 0, -1)]
        found = []
        for start in range(max(0, at - self.longest), at):
            for end in range(at, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                if (piece in self.ids or end - start == 1) and self.fits("", piece):
                    found.append((at - start, end - at, self.ids.get(piece, -2)))
        return found

    def _walk(self, text: str, begin: int, end: int, entry: State) -> tuple[int, list[str | None]]:
        """Where the path after an entry state starts, and its last pieces up to beyond ``end``."""
        start = begin + entry[1]
        left = text[begin - entry[0] : start] if entry[2] != -1 else ""
        return start, self.path(text, start, left, min(len(text), end + self.longest)) if start <= end + self.longest else []

    def transfer(self, text: str, begin: int, end: int) -> np.ndarray:
        """Max-plus matrix of ``text[begin:end]`` from its entry to its exit states; the text
        around it tells the states.

        If a position inside can't be crossed, only the way to the first such and from the
        last such depend on the states.
        """
        entries, exits = self.states(text, begin), self.states(text, end)
        inner = [i for i in range(begin + 1, end) if self.cut(text, i)] if len(entries) * len(exits) > 1 else []
        if len(entries) == len(exits) == 1 and entries[0][2] == exits[0][2] == -1:
            return np.zeros((1, 1))
        if inner:
            into = np.array([[self._reaches(text, begin, inner[0], e, (0, 0, -1))] for e in entries])
            out = np.array([[self._reaches(text, inner[-1], end, (0, 0, -1), x) for x in exits]])
            return into + out
        return np.array([self._reached(text, begin, end, e, exits) for e in entries])

    def _reaches(self, text: str, begin: int, end: int, entry: State, exit_: State) -> float:
        return self._reached(text, begin, end, entry, [exit_])[0]

    def _reached(self, text: str, begin: int, end: int, entry: State, exits: list[State]) -> list[float]:
        start, last = self._walk(text, begin, end, entry)
        return [0.0 if self._ends(last, start, end, entry, x) else float("-inf") for x in exits]

    @staticmethod
    def _ends(last: list[str | None], start: int, end: int, entry: State, exit_: State) -> bool:
        at = end + exit_[1] - start
        if at == 0:  # the piece over the start also ends the chunk
            return exit_[2] in (-1, entry[2])
        if not 0 < at < len(last) or not last[at]:
            return False
        return exit_[2] == -1 or len(last[at]) == exit_[0] + exit_[1]

    def traced(self, text: str, begin: int, end: int, entry: State, exit_: State) -> bytes:
        """Ids of the pieces after the entry state's piece up to the exit state's, inclusive."""
        if entry[2] == exit_[2] == -1:
            raw = text[begin:end].replace(SPACE, " ").replace(_OWN, SPACE).encode("utf-8", "surrogatepass")
            return self.encode_rows([raw])[0].tobytes()
        start, last = self._walk(text, begin, end, entry)
        return self.numbers(self.trace(last, end + exit_[1] - start))


#: Stands for a word-start mark of the text itself while it is encoded; never in a text, as
#: Spark's strings are valid UTF-8.
_OWN = "\udc81"
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: One character stands for itself, with a piece or as bytes.
_ONE, _TWO = (1,), (2, 1)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best sums over the middle state; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every border, first and last included, on the one path of finite weight."""
    ahead = [np.zeros((1, matrices[0].shape[0]))]
    for m in matrices:
        ahead.append(max_plus(ahead[-1], m))
    behind = [np.zeros((matrices[-1].shape[1], 1))]
    for m in reversed(matrices):
        behind.append(max_plus(m, behind[-1]))
    return [int(np.argmax(a[0] + b[:, 0])) for a, b in zip(ahead, reversed(behind), strict=True)]


@cache
def load(path: str) -> Model:
    """The model of a worker."""
    return Model(path)


def _keeping(path: str, kept: int) -> Model:
    model = load(path)
    model.kept = kept
    return model


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))


def _whole(path: str, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _keeping(path, kept)
        for batch in batches:
            texts, size, begun = [], 0, 0
            for i, value in enumerate(batch.column(1), 1):
                texts.append(value.as_py() or "")
                size += len(texts[-1])
                if i == batch.num_rows or len(texts) == ROWS or size >= TOGETHER:
                    rows = model.rows(texts)
                    ids, bounds = model.encode_rows(rows)
                    exact = pa.array(model.decodes(ids, bounds, rows), pa.bool_())
                    ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, len(texts)), ids, exact], ["doc_id", "ids", "exact"])
                    texts, size, begun = [], 0, i

    return run


def decoded(ids: Column, path: str) -> Column:
    """Texts of arrays of ids; an empty array is the empty text, a null one null."""

    @F.arrow_udf("string")
    def told(values: pa.Array) -> pa.Array:
        model = load(path)
        return pa.array([model.decode(v.values.to_numpy()) if v.is_valid else None for v in values], pa.string())

    return told(ids)


_CHUNK = "row long, doc_id long, digest string, chunk int, part string, head boolean, first int, size int"


def _split(path: str):
    """Chunks of giant texts, each with enough of the text around it to tell its border states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        around = 2 * model.longest
        for batch in batches:
            for row, doc_id, digest, value in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = value.as_py()
                text, begin, chunk = model.prepared(raw), 0, 0
                shift = len(text) - len(raw)
                while begin < len(text):
                    end = len(text) if len(text) - begin <= CHUNK else max(model.border(text, begin + CHUNK), begin + CHUNK // 2)
                    low = max(0, begin - around)
                    part = raw[max(0, low - shift) : end + around - shift]
                    cells = [row.as_py(), doc_id.as_py(), digest.as_py(), chunk, part, low == 0, begin - low, end - begin]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32()]
                    names = [x.split()[0] for x in _CHUNK.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names)
                    begin, chunk = end, chunk + 1

    return run


def _part(model: Model, part: str, head: bool) -> str:
    """The prepared text of a chunk and its surroundings."""
    return model.prepared(part) if head else model.prepared(part)[model.prefix :]


def _transfers(path: str):
    @F.arrow_udf("struct<width:int,weights:array<double>>")
    def told(parts: pa.Array, heads: pa.Array, firsts: pa.Array, sizes: pa.Array) -> pa.Array:
        model, rows = load(path), []
        for part, head, first, size in zip(*(x.to_pylist() for x in (parts, heads, firsts, sizes)), strict=True):
            m = model.transfer(_part(model, part, head), first, first + size)
            rows.append({"width": m.shape[1], "weights": m.ravel().tolist()})
        return pa.array(rows, pa.struct([("width", pa.int32()), ("weights", pa.list_(pa.float64()))]))

    return told


def _scan(matrices: pa.Array) -> pa.Array:
    """Entry and exit state of every chunk of a text, from its matrices in order."""
    rows = []
    for text in matrices.to_pylist():
        found = border_states([np.array(m["m"]["weights"]).reshape(-1, m["m"]["width"]) for m in text])
        rows.append([{"chunk": m["chunk"], "entry": a, "exit": b} for m, a, b in zip(text, found, found[1:], strict=False)])
    return pa.array(rows, pa.list_(pa.struct([("chunk", pa.int32()), ("entry", pa.int32()), ("exit", pa.int32())])))


def _traces(path: str, kept: int):
    @F.arrow_udf("array<int>")
    def told(parts: pa.Array, heads: pa.Array, firsts: pa.Array, sizes: pa.Array, entries: pa.Array, exits: pa.Array) -> pa.Array:
        model, rows = _keeping(path, kept), []
        for part, head, first, size, entry, exit_ in zip(*(x.to_pylist() for x in (parts, heads, firsts, sizes, entries, exits)), strict=True):
            text, end = _part(model, part, head), first + size
            ids = model.traced(text, first, end, model.states(text, first)[entry], model.states(text, end)[exit_])
            rows.append(np.frombuffer(ids, np.int32))
        return _lists(rows)

    return told


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT_STRETCHES) -> DataFrame:
    """``(doc_id, ids, n_tokens, exact)`` for every row of ``docs``.

    ``ids`` are those of the SentencePiece library for the model at ``path``, a file that all
    executors have; only a word-start mark in the text itself is spelled in bytes, so that
    every text decodes to itself again, which ``exact`` states. Null texts are empty, empty
    ones have no ids. Texts above ``CHUNK`` characters are encoded chunk by chunk: what one
    task holds of them are matrices, until the ids of a text meet in its row. A worker keeps up to
    twice ``kept`` encoded stretches and those of rows encoded together, and lives on: fewer
    take time, not results.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    giant = F.coalesce(F.char_length("text") > CHUNK, F.lit(False))
    whole = rows.where(~giant).mapInArrow(_whole(path, kept), "doc_id long, ids array<int>, exact boolean")

    large = rows.where(giant).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")
    chunks = materialise(large.mapInArrow(_split(path), _CHUNK), "sentencepiece-chunks").repartition("row", "chunk")
    matrices = chunks.select("row", "chunk", _transfers(path)("part", "head", "first", "size").alias("m"))
    scan = F.arrow_udf(_scan, "array<struct<chunk:int,entry:int,exit:int>>")
    ordered = matrices.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "m"))).alias("m"))
    borders = ordered.select("row", F.explode(scan("m")).alias("b")).select("row", "b.*")
    traced = chunks.join(borders, ["row", "chunk"]).select(
        "row", "doc_id", "digest", "chunk", _traces(path, kept)("part", "head", "first", "size", "entry", "exit").alias("ids")
    )
    whole_again = traced.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("p")
    )
    joined = whole_again.select("doc_id", "digest", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
    exact = F.sha2(decoded(F.col("ids"), path).cast("binary"), 256) == F.col("digest")
    out = whole.unionByName(joined.select("doc_id", "ids", exact.alias("exact")))
    return out.select("doc_id", "ids", F.size("ids").alias("n_tokens"), "exact")
