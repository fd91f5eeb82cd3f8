"""SentencePiece models: the model file, and the weights of the lattice of pieces."""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from functools import cached_property, lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .tables import IntTable, gathered

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
#: Bits of a character's code point, and of a piece's number (an id, or a code point beyond the ids).
CHAR, NUMBER = 21, 22
START = (1 << NUMBER) - 1


def fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = raw[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


#: Blanks with what follows them, or what stands before any.
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of the first ``many[0]`` values, of the next ``many[1]`` ones, and so on."""
    ends = np.cumsum(many)
    upto = np.append(0, np.cumsum(values))
    return upto[ends] - upto[ends - many]


class Units(dict):
    """Places of units, whose ids are kept for the life of a worker: those of unit i are ``count[i]`` of ``ids``, after those of
    the units before it. ``new`` ones have a place and no ids yet."""

    def __init__(self, most: int = 100_000, longest: int = 64):
        super().__init__()
        self.most, self.longest, self.chars, self.new = most, longest, 0, []
        self.ids, self.count, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, unit: str) -> int:
        self[unit] = place = len(self)
        self.new.append(unit)
        return place

    def places(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, units), np.int64, len(units))

    def learn(self, ids: np.ndarray, count: np.ndarray) -> None:
        """The ids of the new units, and how many each has."""
        self.chars += sum(map(len, self.new))
        self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        self.used = np.append(self.used, np.zeros(len(self.new), np.int64))
        self.new = []

    def thin(self) -> None:
        """Where there are more than ``most``, or more characters than half of them may have, the half used most stays, without long ones."""
        if len(self) <= self.most and self.chars <= self.most * self.longest // 2:
            return
        names = list(self)
        size = np.fromiter(map(len, names), np.int64, len(names))
        first = np.argsort(-self.used, kind="stable")[: self.most // 2]
        kept = np.sort(first[size[first] <= self.longest])
        self.clear()
        self.update((names[i], k) for k, i in enumerate(kept.tolist()))
        self.ids, self.count, self.used = gathered(self.ids, self.count, kept), self.count[kept], self.used[kept] // 2
        self.chars = int(size[kept].sum())


class Pieces:
    """A model's pieces and the rule by which two neighbours may stand side by side.

    The best segmentation is the best path through the lattice of pieces. Unigram models add up piece scores. BPE models
    have one valid path: a sequence is what merging by score yields if and only if each pair of neighbours, merged
    alone, stays that pair. So their weights are 0 for such pairs and minus infinity for others, and the same max-plus
    algebra finds the path.
    """

    def __init__(self, raw: bytes):
        self.pieces, self.scores, self.kinds, self.kind = [], [], [], UNIGRAM
        self.prefix, self.fallback, self.unknown = True, False, 0
        for number, value in fields(raw):
            if number == 1:
                got = dict(fields(value))
                self.kinds.append(got.get(3, NORMAL))
                self.pieces.append(got[1].decode())
                self.scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
            elif number == 2:
                got = dict(fields(value))
                self.kind, self.fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
            elif number == 3:
                got = dict(fields(value))
                self.prefix = bool(got.get(3, 1))
                if got.get(2) or got.get(4, 1) or not got.get(5, 1):
                    raise ValueError("only models with identity normalisation and kept, escaped white space are supported")
        if self.kind not in (UNIGRAM, BPE) or USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("only unigram and BPE models without user-defined or unused pieces are supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.id = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.longest = max(map(len, self.id), default=1)
        self.low = min((self.scores[i] for i in self.id.values()), default=0.0) - 10.0  # a character without piece
        self._links: dict[tuple[str, str], bool] = {}
        self.units = Units()

    @cached_property
    def tails(self) -> dict[str, bool]:
        """Ends of pieces, and whether they are pieces themselves."""
        return {p[i:]: p[i:] in self.id for p in self.id for i in range(len(p))}

    @cached_property
    def pairs(self) -> set[str]:
        """Characters that stand side by side in some piece."""
        return {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}

    @cached_property
    def segment(self) -> re.Pattern:
        """Segments between which no piece reaches: blanks with a word or with signs and what follows them, runs of
        blanks, and characters of no longer piece."""
        some = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]" if chars else r"(?!)"
        inner = {c for p in self.id if len(p) > 1 for c in p} - {SPACE}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            return re.compile(f"(?:{SPACE}|{some(inner)})+|[\\s\\S]")
        #: Signs that no piece has right after a letter or digit: no piece reaches from a word into them.
        signs = {c for c in inner if not c.isalnum() and not any(c == y and x.isalnum() for x, y in self.pairs)}
        signs -= {y for x, y in self.pairs if x in inner - signs}
        words = inner - signs
        return re.compile(f"{SPACE}*{some(words)}+|{SPACE}*{some(signs)}+{some(words)}*|{SPACE}+|[\\s\\S]")

    def merge(self, text: str) -> list[str]:
        """What merging by score makes of a short text: the best neighbours first, ties from the left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                got = self.id.get(parts[i] + parts[i + 1])
                if got is not None and (best is None or self.scores[got] > best):
                    best, at = self.scores[got], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def linked(self, a: str, b: str) -> bool:
        """Whether b may follow a; an empty a stands for a place that no piece crosses."""
        if self.kind == UNIGRAM:
            return True
        key = (a, b)
        found = self._links.get(key)
        if found is None:
            if len(self._links) >= 50_000:
                self._links.clear()
            found = self._links[key] = self.merge(a + b) == ([a, b] if a else [b])
        return found

    def weight(self, piece: str) -> float:
        if self.kind == BPE:
            return 0.0
        got = self.id.get(piece)
        return self.low if got is None else self.scores[got]

    def ids(self, piece: str) -> tuple[int, ...]:
        """The piece's id; without one, those of its bytes or the unknown one."""
        got = self.id.get(piece)
        if got is not None:
            return (got,)
        return tuple(self.byte[b] for b in piece.encode("utf-8", "surrogatepass")) if self.fallback else (self.unknown,)

    def forward(self, text: str, start: int, stop: int, before: str):
        """Best paths from ``start`` to each place up to ``stop``: (weight, last piece) by place, None where there is none.

        ``before`` is the piece that ends at ``start``. Ties go to the longer last piece.
        """
        get, linked, longest = self.id.get, self.linked, self.longest
        best: list = [None] * (stop - start + 1)
        best[0] = (0.0, before)
        if self.kind == BPE:  # at most one last piece is valid at each place
            tails, links = self.tails, self._links
            for i in range(1, len(best)):
                end, found, size = start + i, [], 1
                while size <= i and (whole := tails.get(piece := text[end - size : end])) is not None:
                    if size == 1 or whole:
                        found.append(piece)
                    size += 1
                for piece in reversed(found) if found else (text[end - 1 : end],):
                    last = best[i - len(piece)]
                    if last is not None:
                        ok = links.get((last[1], piece))
                        if ok or (ok is None and linked(last[1], piece)):
                            best[i] = (0.0, piece)
                            break
            return best
        for i in range(1, len(best)):
            end, top = start + i, None
            for size in range(min(i, longest), 0, -1):
                last = best[i - size]
                piece = text[end - size : end]
                if last is not None and (size == 1 or get(piece) is not None):
                    w = last[0] + self.weight(piece)
                    if top is None or w > top[0]:
                        top = (w, piece)
            best[i] = top
        return best

    @staticmethod
    def back(best, i: int) -> list[str]:
        """The pieces of the best path to place i, in order."""
        out = []
        while i > 0:
            out.append(best[i][1])
            i -= len(best[i][1])
        return out[::-1]

    @cached_property
    def trie(self) -> tuple[IntTable, np.ndarray]:
        """Steps (node, character) to the next node, the root being 0, and the piece that each node is (-1: none)."""
        nodes, ends, steps = {"": 0}, {0: -1}, []
        for piece, number in self.id.items():
            for i in range(1, len(piece) + 1):
                if piece[:i] not in nodes:
                    nodes[piece[:i]] = at = len(nodes)
                    ends[at] = -1
                    steps.append(nodes[piece[: i - 1]] << CHAR | ord(piece[i - 1]))
            ends[nodes[piece]] = number
        table = IntTable(len(steps))
        table.add(np.array(steps, np.uint64), np.arange(1, len(nodes), dtype=np.int32))
        return table, np.array([ends[i] for i in range(len(nodes))], np.int32)

    @cached_property
    def known_links(self) -> IntTable:
        """``linked`` of pairs of numbers (see ``number``) met so far, up to a bound."""
        return IntTable(500_000)

    def spelled(self, number: int) -> str:
        """The piece of a number: its id, or beyond these a character's code point; and none for the start."""
        n = len(self.pieces)
        return "" if number == START else self.pieces[number] if number < n else chr(number - n)

    def number(self, piece: str) -> int | None:
        """The number of a piece or character; None for other strings."""
        got = self.id.get(piece)
        return got if got is not None else len(self.pieces) + ord(piece) if len(piece) == 1 else None

    @cached_property
    def unions(self) -> IntTable:
        """The piece that two neighbours make when they merge, by their numbers."""
        found = {}
        for piece, made in self.id.items():
            for i in range(1, len(piece)):
                a, b = self.number(piece[:i]), self.number(piece[i:])
                if a is not None and b is not None:
                    found[a << NUMBER | b] = made
        table = IntTable(max(len(found), 1))
        table.add(np.fromiter(found, np.uint64, len(found)), np.fromiter(found.values(), np.int32, len(found)))
        return table

    def merging(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces that neighbours would make, and their scores (minus infinity: none)."""
        made = self.unions.get(a.astype(np.uint64) << np.uint64(NUMBER) | b.astype(np.uint64))
        made[(a < 0) | (b < 0)] = -1
        return made, np.where(made >= 0, self._score[made], -np.inf)

    @cached_property
    def _score(self) -> np.ndarray:
        return np.array(self.scores)

    def stay(self, pairs: list[int]) -> np.ndarray:
        """Whether merging by score leaves these pairs of numbers as they are, all merged side by side."""
        strings = [self.spelled(x >> NUMBER) + self.spelled(x & START) for x in pairs]
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        wide, n = int(size.max(initial=1)), len(pairs)
        code = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        steps, piece = self.trie
        node = steps.get(code)
        one = np.where((node >= 0) & (piece[node] >= 0), piece[node], code.astype(np.int64) + len(self.pieces))
        part = np.full((n, wide + 1), -1, np.int64)
        part[:, :wide][np.arange(wide) < size[:, None]] = one
        _, score = self.merging(part[:, :-1].ravel(), part[:, 1:].ravel())
        score, rows, places = score.reshape(n, wide), np.arange(n), np.arange(wide + 1)
        while True:
            at = score[rows].argmax(1)  # of equal scores the first
            more = score[rows, at] > -np.inf
            rows, at = rows[more], at[more]
            if not len(rows):
                break
            made, _ = self.merging(part[rows, at], part[rows, at + 1])
            shift = np.minimum(places + (places > at[:, None]), wide)
            part[rows] = np.take_along_axis(part[rows], shift, 1)
            part[rows, at] = made
            score[rows] = np.take_along_axis(score[rows], shift[:, :-1].clip(max=wide - 1), 1)
            score[rows, wide - 1] = -np.inf
            score[rows, at] = self.merging(made, part[rows, at + 1])[1]
            left = at > 0
            score[rows[left], at[left] - 1] = self.merging(part[rows[left], at[left] - 1], made[left])[1]
        want = np.array([[y, -1, -1] if (y := x >> NUMBER) == START else [y, x & START, -1] for x in pairs], np.int64)
        want[want[:, 0] == START, 0] = [x & START for x in pairs if x >> NUMBER == START]
        part = np.pad(part, ((0, 0), (0, 2)), constant_values=-1)
        return (part[:, :3] == want).all(1)

    def links(self, key: np.ndarray) -> np.ndarray:
        """Whether pairs of numbers may stand side by side; pairs not met before are merged, each once."""
        found = self.known_links.get(key)
        new = found < 0
        if new.any():
            pairs, where = np.unique(key[new], return_inverse=True)
            ok = self.stay(pairs.tolist()).astype(np.int32)
            self.known_links.add(pairs, ok)
            found[new] = ok[where]
        return found > 0

    def numbers(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The best paths of segments that no piece crosses at either end, as numbers of their pieces one segment after
        the other, and how many each has.

        All segments are walked at once: pieces come from the trie, and at each distance from the segments' starts the
        one that may follow the last piece before it is the last one there.
        """
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        code = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        steps, piece = self.trie
        first = np.cumsum(size) - size
        place = (np.arange(len(code)) - np.repeat(first, size)).astype(np.int32)  # in its segment
        room = np.repeat(size, size).astype(np.int32) - place
        node = steps.get(code)
        single = np.where(node >= 0, piece[node], -1)
        found = [(np.arange(len(code), dtype=np.int32), np.where(single >= 0, single, code.astype(np.int32) + len(self.pieces)), 1)]
        at = np.flatnonzero((node >= 0) & (room > 1)).astype(np.int32)
        node, long = node[at], 1
        while len(at):
            node = steps.get(node.astype(np.uint64) << np.uint64(CHAR) | code[at + long])
            long += 1
            at, node = at[node >= 0], node[node >= 0]
            whole = piece[node] >= 0
            found.append((at[whole], piece[node[whole]], long))
            at, node = at[(open_ := room[at] > long)], node[open_]
        begin, number, length = (np.concatenate(x) for x in zip(*((b, n.astype(np.int32), np.full(len(b), k, np.int8)) for b, n, k in found)))
        ends = place[begin] + length
        by = np.argsort(ends.astype(np.uint8), kind="stable")  # segments have 64 characters at most
        begin, number, length = begin[by], number[by], length[by]
        # Boundaries: one before each character and one after each segment's last.
        cut = begin + np.repeat(np.arange(len(segments), dtype=np.int32), size)[begin]
        bounds = np.searchsorted(ends[by], np.arange(1, int(size.max(initial=0)) + 2))
        last, back = np.full(len(code) + len(segments), START, np.int32), np.zeros(len(code) + len(segments), np.int8)
        for a, b in zip(bounds, bounds[1:]):
            ok = self.links(last[cut[a:b]].astype(np.uint64) << np.uint64(NUMBER) | number[a:b].astype(np.uint64))
            to = cut[a:b][ok] + length[a:b][ok]
            last[to], back[to] = number[a:b][ok], length[a:b][ok]
        place = first + np.arange(len(segments)) + size
        start, who, parts = place - size, np.arange(len(segments)), []
        many = np.zeros(len(segments), np.int64)
        while len(who := who[place[who] > start[who]]):
            parts.append((who, last[place[who]]))
            many[who] += 1
            place[who] -= back[place[who]]
        out, after = np.zeros(int(many.sum()), np.int64), np.cumsum(many)
        for k, (who, n) in enumerate(parts):
            out[after[who] - 1 - k] = n
        return out, many

    def traced(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments that no piece crosses at either end, one segment after the other, and how many each has."""
        long = [i for i, s in enumerate(segments) if self.kind != BPE or len(s) > 64]
        paths = {i: np.array([x for p in self.back(self.forward(segments[i], 0, len(segments[i]), ""), len(segments[i])) for x in self.ids(p)], np.int32) for i in long}
        out, many = self.numbers([s for i, s in enumerate(segments) if i not in paths] if paths else segments)
        if (odd := out >= len(self.pieces)).any():  # characters without piece: several ids each
            values, where = np.unique(out, return_inverse=True)
            each = [np.array(self.ids(self.spelled(v)), np.int32) for v in values.tolist()]
            length = np.array([len(x) for x in each])
            owner = np.repeat(np.arange(len(many)), many)
            many = np.bincount(owner, length[where], len(many)).astype(np.int64)
            out = gathered(np.concatenate(each), length, where)
        if not paths:
            return out.astype(np.int32), many
        rest = iter(np.split(out, np.cumsum(many)[:-1]) if len(many) else [])
        every = [paths[i] if i in paths else next(rest) for i in range(len(segments))]
        return np.concatenate(every).astype(np.int32), np.array([len(x) for x in every])

    def segmented(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that no piece crosses at either end, one text after the other, and how many each has."""
        at: dict[str, int] = defaultdict(count().__next__)
        cuts, many = [], []
        for t in texts:
            cut = self.segment.findall(t)
            many.append(len(cut))
            cuts += cut
        where = np.fromiter(map(at.__getitem__, cuts), np.int64, len(cuts))
        ids, length = self.traced(list(at))
        return gathered(ids, length, where), sums(length[where], np.array(many, np.int64))

    @cached_property
    def by_units(self) -> bool:
        """Whether no piece reaches from another character to a blank, so that texts may be cut before blanks."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.id)

    def learnt(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``segmented``, of distinct units; short ones needn't be cut further."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        long = np.flatnonzero(size > 64)
        if not len(long):
            return self.traced(units)
        short = np.flatnonzero(size <= 64)
        parts = self.traced([units[i] for i in short]), self.segmented([units[i] for i in long])
        ids, length = (np.concatenate(x) for x in zip(*parts))
        back = np.argsort(np.concatenate([short, long]))
        return gathered(ids, length, back), length[back]

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``segmented``. Texts are cut into units, blanks with what follows them, in Arrow columns, so that Python sees each once
        in a batch, and only units not met before are traced."""
        if not self.by_units:
            return self.segmented(texts)
        whole, known = pa.array(texts, pa.string()), self.units
        odd = pc.match_substring(whole, 2 * SPACE)  # several blanks make one unit
        words = pc.split_pattern(pc.if_else(odd, "", whole), SPACE)
        flat, start = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        spaced = pc.binary_join_element_wise(SPACE, flat.dictionary, "")
        after_blank = known.places(spaced.to_numpy(zero_copy_only=False).tolist())[flat.indices.to_numpy()]
        # What a text begins with has no blank before it; texts of several blanks are dealt with as such beginnings.
        begins = [_UNIT.findall(t) if o else [w] for t, o, w in zip(texts, odd.to_pylist(), flat.dictionary.take(flat.indices.take(pa.array(start[:-1]))).to_pylist())]
        first = np.array([len(x) for x in begins], np.int64)
        rest = np.diff(start) - 1
        where = np.insert(np.delete(after_blank, start[:-1]), np.repeat(np.cumsum(rest) - rest, first), known.places([u for x in begins for u in x]))
        if known.new:
            known.learn(*self.learnt(known.new))
        known.used += np.bincount(where, minlength=len(known))
        out = gathered(known.ids, known.count, where), sums(known.count[where], first + rest)
        known.thin()
        return out

    def cost(self, segment: str) -> float:
        return self.forward(segment, 0, len(segment), "")[-1][0] if self.kind == UNIGRAM else 0.0

    def escaped(self, text: str) -> str:
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    @cached_property
    def surfaces(self) -> list[bytes]:
        """What each id decodes to."""
        out = []
        for i, p in enumerate(self.pieces):
            kind = self.kinds[i]
            out.append(bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode())
        return out


@lru_cache(maxsize=4)
def load(raw: bytes) -> Pieces:
    return Pieces(raw)
