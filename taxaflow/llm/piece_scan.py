"""SentencePiece encoding and decoding; giant texts by a max-plus parallel scan over chunks."""

from __future__ import annotations

import pickle
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns, materialize, tidy
from .pieces import UNIGRAM, Pieces, load


class Chunk:
    """Part [a, b) of an escaped text, with what pieces across its ends need of its neighbours.

    A state at a cut is a piece that starts before it and ends ``k`` characters after it (or at it: 0). Where no piece
    can cross the cut, as at both ends of a text, there is one state, ("", 0).
    """

    def __init__(self, model: Pieces, left: str, body: str, right: str):
        self.model, self.a, self.b = model, len(left), len(left) + len(body)
        self.text = left + body + right
        self.into = [("", 0)] if self.free(self.a) else self.states(self.a)
        self.out = [("", 0)] if self.free(self.b) else self.states(self.b)

    def free(self, i: int) -> bool:
        """Whether no piece crosses place i."""
        return i == 0 or i == len(self.text) or self.text[i - 1 : i + 1] not in self.model.pairs

    def last_cut(self, end: int) -> int:
        """The last place in the chunk, up to ``end``, that no piece crosses (there is one)."""
        return next(i for i in range(end, self.a - 1, -1) if self.free(i))

    def states(self, cut: int) -> list[tuple[str, int]]:
        found = []
        for start in range(max(0, cut - self.model.longest), cut):
            for end in range(cut, min(len(self.text), start + self.model.longest) + 1):
                piece = self.text[start:end]
                if len(piece) == 1 or piece in self.model.id:
                    found.append((piece, end - cut))
        return found

    def leave(self, best, start: int, state: tuple[str, int]) -> float:
        """Weight of the paths from ``start`` that go out by ``state``."""
        piece, k = state
        at = self.b + k - len(piece) - start
        if at < 0 or best[at] is None or (piece and not self.model.linked(best[at][1], piece)):
            return -np.inf
        return best[at][0] + (self.model.weight(piece) if piece else 0.0)

    def cut_in(self, state: tuple[str, int]) -> int | None:
        return next((i for i in range(self.a + state[1], self.b + 1) if self.free(i)), None)

    def matrix(self) -> np.ndarray:
        """The transfer matrix: the best weight from each state at the start to each one at the end."""
        out, model = np.full((len(self.into), len(self.out)), -np.inf), self.model
        tails = {}  # by first cut: what follows doesn't depend on the state at the start
        for i, (before, k) in enumerate(self.into):
            start, cut = self.a + k, self.cut_in((before, k))
            if start > self.b:  # the piece that came in goes out
                out[i] = [0.0 if s == (before, start - self.b) else -np.inf for s in self.out]
            elif cut is None:
                best = model.forward(self.text, start, self.b, before)
                out[i] = [self.leave(best, start, s) for s in self.out]
                out[i, [s == (before, start - self.b) for s in self.out]] = 0.0
            elif (head := model.forward(self.text, start, cut, before)[-1]) is not None:
                if cut not in tails:
                    last = self.last_cut(self.b)
                    middle = sum(map(model.cost, model.segment.findall(self.text[cut:last]))) if model.kind == UNIGRAM else 0.0
                    best = model.forward(self.text, last, self.b, "")
                    tails[cut] = middle + np.array([self.leave(best, last, s) for s in self.out])
                out[i] = head[0] + tails[cut]
        return out

    def around(self, state: tuple[str, int], leave: tuple[str, int]) -> tuple[list[int], str, list[int]]:
        """The pieces that start in the chunk on the best path from one state to the other: the first and last ones' ids, and
        between them a text that no piece crosses at either end."""
        model, (before, k), (piece, after) = self.model, state, leave
        start, end = self.a + k, self.b + after - len(piece)
        if end < start:  # the piece that goes out came in
            return [], "", []
        head, middle = [], ""
        cut = self.cut_in(state)
        if cut is not None and cut <= end:
            best = model.forward(self.text, start, cut, before)
            head += chain.from_iterable(map(model.ids, model.back(best, cut - start)))
            last = self.last_cut(end)
            middle, start, before = self.text[cut:last], last, ""
        best = model.forward(self.text, start, end, before)
        tail = list(chain.from_iterable(map(model.ids, model.back(best, end - start))))
        return head, middle, [*tail, *model.ids(piece)] if piece else tail

    def pieces(self, state: tuple[str, int], leave: tuple[str, int]) -> list[int]:
        """Ids of the pieces that start in the chunk on the best path from one state to the other."""
        return chunk_ids(self.model, [self.around(state, leave)])[0].as_py()


def chunk_ids(model: Pieces, around: list[tuple[list[int], str, list[int]]]) -> pa.Array:
    """Ids of chunks, whose middles are encoded all at once."""
    ids, sizes = model.encoded([middle for _, middle, _ in around])
    upto, parts = np.append(0, sizes.cumsum()), []
    for i, (head, _, tail) in enumerate(around):
        parts += [np.array(head, np.int32), ids[upto[i] : upto[i + 1]], np.array(tail, np.int32)]
    ends = np.cumsum([0, *(len(head) + n + len(tail) for (head, _, tail), n in zip(around, sizes.tolist()))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def suffixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """The products of each matrix with all that follow it, by combining neighbours (the product is associative)."""
    if len(matrices) <= 1:
        return list(matrices)
    pairs = [times(matrices[i], matrices[i + 1]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    over = suffixes(pairs)
    out = []
    for i, m in enumerate(matrices):
        out.append(over[i // 2] if i % 2 == 0 else times(m, over[i // 2 + 1]) if i // 2 + 1 < len(over) else m)
    return out


def route(matrices: list[np.ndarray]) -> list[int]:
    """The state at each chunk's end on the best path through all chunks."""
    rest = [m.max(1) for m in suffixes(matrices)]
    at, out = 0, []
    for c, m in enumerate(matrices):
        w = m[at] + (rest[c + 1] if c + 1 < len(matrices) else 0.0)
        at = int(w.argmax())
        if w[at] == -np.inf:
            raise ValueError("no path through the chunks")
        out.append(at)
    return out


def encode_texts(model: Pieces, texts: list) -> pa.Array:
    """Ids of texts of one chunk each, whose one way from end to end needs no matrix to be settled. Null gives null."""
    ids, sizes = model.encoded(["" if t is None else model.escaped(t) for t in texts])
    return pa.ListArray.from_arrays(pa.array(np.append(0, sizes.cumsum()).astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in texts], pa.bool_()))


def encode(docs: DataFrame, model: bytes, *, text: str = "text", ids: str = "ids", chunk_chars: int = 32_768) -> DataFrame:
    """Adds ``ids``: the SentencePiece ids of each whole text, as the model's own encoder gives them.

    Texts up to ``chunk_chars`` characters are one chunk: it has one state at either end, nothing to settle, and is traced
    at once. Longer ones are cut into chunks of that many characters,
    wherever the cuts fall. Each chunk yields the transfer matrix between the states at its ends; a text's matrices are
    combined associatively, which settles the state at each cut; then every chunk traces its own part back. Equal giant
    texts are encoded once. Only matrices (a small share of a text) meet in one task.

    ``model`` is the content of a model file. Null texts have null ids, empty ones none; repeated rows are encoded
    alike; an empty table gives an empty result; other columns stay and one named like ``ids`` is replaced.
    """
    docs = tidy(docs, [text], [ids, "_fp", "_ids"])
    longest, columns = load(model).longest, docs.columns

    def direct(texts):
        return [encode_texts(load(model), texts)]

    small = map_columns(docs.where(F.coalesce(F.length(text), F.lit(0)) <= chunk_chars), columns, [text], f"`{ids}` array<int>", direct)
    giant = docs.where(F.length(text) > chunk_chars).withColumn("_fp", F.md5(text))

    def cut(texts):
        m = load(model)
        out = []
        for t in map(m.escaped, texts):
            ends = [*range(0, len(t), chunk_chars), len(t)]
            out.append([{"c": c, "left": t[max(0, a - longest) : a], "body": t[a:b], "right": t[b : b + longest]} for c, (a, b) in enumerate(zip(ends, ends[1:]))])
        return [out]

    chunks = map_columns(giant.select("_fp", text).dropDuplicates(["_fp"]), ["_fp"], [text], "chunks array<struct<c:int,left:string,body:string,right:string>>", cut)
    chunks = materialize(chunks.select("_fp", F.explode("chunks").alias("x")).select("_fp", "x.*"), "chunks")
    spread = chunks.repartition("_fp", "c")
    parts = ["left", "body", "right"]

    def measure(left, body, right):
        m = load(model)
        return [[pickle.dumps(Chunk(m, *x).matrix(), 5) for x in zip(left, body, right)]]

    def settle(matrices):
        out = []
        for one in matrices:
            one = sorted(one, key=lambda x: x["c"])
            ends = route([pickle.loads(x["m"]) for x in one])
            out.append([{"c": x["c"], "from": s, "to": e} for x, s, e in zip(one, [0, *ends], ends)])
        return [out]

    def trace(left, body, right, start, stop):
        m = load(model)
        chunks = [Chunk(m, *x) for x in zip(left, body, right)]
        return [chunk_ids(m, [c.around(c.into[s], c.out[e]) for c, s, e in zip(chunks, start, stop)])]

    matrices = map_columns(spread, ["_fp", "c"], parts, "m binary", measure).groupBy("_fp").agg(F.collect_list(F.struct("c", "m")).alias("ms"))
    states = map_columns(matrices, ["_fp"], ["ms"], "s array<struct<c:int,from:int,to:int>>", settle).select("_fp", F.explode("s").alias("s")).select("_fp", "s.*")
    traced = map_columns(chunks.join(states, ["_fp", "c"]), ["_fp", "c"], [*parts, "from", "to"], "_ids array<int>", trace)
    whole = traced.groupBy("_fp").agg(F.sort_array(F.collect_list(F.struct("c", "_ids"))).alias("all"))
    whole = whole.select("_fp", F.flatten(F.transform("all", lambda x: x["_ids"])).alias(ids))
    return small.unionByName(giant.join(whole, "_fp").select(*[F.col(f"`{c}`") for c in columns], ids))


def decode(docs: DataFrame, model: bytes, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds ``text``: what the ids spell. Bytes that aren't UTF-8 become U+FFFD; null ids give null, empty lists an empty
    text, long lists one text, repeated rows the same; an empty table gives an empty result; other columns stay and one
    named like ``text`` is replaced.

    Encoding and decoding give back every text that has no U+2581 of its own (it reads as a blank).
    """
    docs = tidy(docs, [ids], [text])

    def spell(rows):
        m = load(model)
        surface = m.surfaces
        out = []
        for r in rows:
            t = None if r is None else b"".join(map(surface.__getitem__, r.tolist())).decode("utf-8", "replace")
            out.append(t[1:] if t and m.prefix and t[0] == " " else t)
        return [out]

    return map_columns(docs, docs.columns, [ids], f"`{text}` string", spell)
