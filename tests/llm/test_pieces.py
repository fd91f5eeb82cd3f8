import random
import struct

import numpy as np
import pytest
import sentencepiece

from taxaflow.llm import piece_scan, pieces, queries
from taxaflow.llm.tables import IntTable

RAW = queries.piece_model()
MODEL = pieces.load(RAW)
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=RAW)
BITS = [" ", "  ", "a", "the", "\n", "\t", "é", "你", "好", "▁", "xyz", "ing", "tion", "1", "2", "0", "    ", "\U0001f600", "ß", "!!", "%", "Lor"]


def texts(n, size):
    rng = random.Random(n)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, size))) for _ in range(n)] + ["", " ", "x" * 700, "".join(rng.choice("abcdeiou") for _ in range(900))]


def encode_text(model, text):
    return piece_scan.encode_texts(model, [text])[0].as_py()


def test_bpe_equals_the_library():
    every = texts(500, 30)
    assert piece_scan.encode_texts(MODEL, every).to_pylist() == LIBRARY.encode(every)
    assert piece_scan.encode_texts(MODEL, [None, "a", None]).to_pylist() == [None, LIBRARY.encode("a"), None]
    assert piece_scan.encode_texts(MODEL, []).to_pylist() == []


def test_pairs_stay_as_merging_says():
    rng = random.Random(3)
    numbers = [rng.randrange(len(MODEL.pieces)) for _ in range(400)] + [MODEL.number(c) for c in "aé你😀\ue000"]
    numbers = [n for n in numbers if n >= len(MODEL.pieces) or MODEL.spelled(n) in MODEL.id]
    pairs = [a << pieces.NUMBER | rng.choice(numbers) for a in numbers + [pieces.START] * 50]
    spelled = [(MODEL.spelled(x >> pieces.NUMBER), MODEL.spelled(x & pieces.START)) for x in pairs]
    assert MODEL.stay(pairs).tolist() == [MODEL.merge(a + b) == ([a, b] if a else [b]) for a, b in spelled]


def test_tables_of_integers():
    table, rng = IntTable(300), random.Random(1)
    keys = np.array(rng.sample(range(2**60), 300), np.uint64)
    table.add(keys[:200], np.arange(200, dtype=np.int32))
    assert table.get(keys).tolist() == [*range(200), *[-1] * 100]
    table.add(keys[200:], np.arange(200, 300, dtype=np.int32))
    assert table.get(keys).tolist() == [*range(300)]
    table.add(np.array([7], np.uint64), np.array([5], np.int32))  # no room: emptied first
    assert table.get(np.array([7, keys[0]], np.uint64)).tolist() == [5, -1]


def by_chunks(model, text, size):
    t, longest = model.escaped(text), model.longest
    ends = [*range(0, len(t), size), len(t)]
    chunks = [piece_scan.Chunk(model, t[max(0, a - longest) : a], t[a:b], t[b : b + longest]) for a, b in zip(ends, ends[1:])]
    way, out = piece_scan.route([c.matrix() for c in chunks]), []
    for c, s, e in zip(chunks, [0, *way], way):
        out += c.pieces(c.into[s], c.out[e])
    return out


@pytest.mark.parametrize("size", [17, 29, 64])
def test_chunks_equal_the_whole(size):
    for t in texts(200, 60):
        if t:
            assert by_chunks(MODEL, t, size) == LIBRARY.encode(t)


def proto(number, value):
    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model():
    rng = random.Random(8)
    found = {"▁", "▁the", "▁a", *"abcdefgh"} | {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(150)}
    raw = proto(1, proto(1, b"<unk>") + proto(3, 2)) + b"".join(
        proto(1, proto(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", -2 - rng.random() * 8) + proto(3, 1)) for p in sorted(found))
    return raw + proto(2, proto(3, 1)) + proto(3, proto(1, b"identity") + proto(3, 1) + proto(4, 0) + proto(5, 1))


def test_unigram_equals_the_library():
    raw = unigram_model()
    model, library = pieces.Pieces(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    rng = random.Random(5)
    for n in range(200):
        t = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 120)))
        best = sum(model.scores[i] for i in library.encode(t))  # paths may differ where two are equally good
        for got in (encode_text(model, t), by_chunks(model, t, 13)):
            assert library.decode(got) == t and abs(sum(model.scores[i] for i in got) - best) < 1e-3


def test_suffix_products_are_products():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in range(1, 9):
        shape = rng.integers(1, 4, n + 1)
        ms = [rng.normal(size=(shape[i], shape[i + 1])) for i in range(n)]
        got = piece_scan.suffixes(ms)
        want = ms[-1]
        for i in range(n - 1, -1, -1):
            want = ms[i] if i == n - 1 else piece_scan.times(ms[i], want)
            assert np.allclose(got[i], want)


def test_encode_and_decode(spark):
    rows = [(i, t) for i, t in enumerate(texts(60, 300))] + [(None, None), (-1, "y" * 900), (-2, "y" * 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "IDS")
    got = piece_scan.encode(df.withColumnRenamed("IDS", "doc_id"), RAW, chunk_chars=200)
    out = piece_scan.decode(got, RAW, text="back").collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == (None if r.text is None else LIBRARY.encode(r.text))
        assert r.back == (None if r.text is None else r.text.replace("▁", " "))
    assert piece_scan.encode(df, RAW).columns == ["text", "ids"]  # a clashing column is replaced
    assert piece_scan.encode(df.where("false"), RAW).count() == 0


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Pieces(proto(1, proto(1, b"<unk>") + proto(3, 2)) + proto(3, proto(2, b"map")))


def test_units_met_before_are_not_traced_again(monkeypatch):
    model, seen = pieces.Pieces(RAW), []
    walk = model.traced
    monkeypatch.setattr(model, "traced", lambda units: seen.append(list(units)) or walk(units))
    first, again = ["the cat  sat\non", "", "▁the cat", "x" * 70 + " the"], ["cat the", " sat the cat", "the  the", "x" * 70]
    for some in (first, again):
        assert piece_scan.encode_texts(model, some).to_pylist() == LIBRARY.encode(some)
    units = [u for part in seen for u in part]
    assert len(set(units)) == len(units) and "▁cat" in units and len(seen) > 1


def test_units_kept_stay_within_bounds():
    model, every = pieces.Pieces(RAW), texts(300, 30)
    model.units = pieces.Units(most=60, longest=8)
    for i in range(0, len(every), 20):
        some = every[i : i + 20]
        assert piece_scan.encode_texts(model, [*some, "the the the"]).to_pylist() == LIBRARY.encode([*some, "the the the"])
        assert len(model.units) <= 60 and model.units.chars == sum(map(len, model.units)) <= 240 and len(model.units.count) == len(model.units)
    assert "▁the" in model.units and model.units.count.sum() == len(model.units.ids)


def test_chunks_traced_together_share_their_units(monkeypatch):
    model, calls = pieces.Pieces(RAW), []
    text = model.escaped("".join(texts(80, 60)))
    ends = [*range(0, len(text), 97), len(text)]
    chunks = [piece_scan.Chunk(model, text[max(0, a - model.longest) : a], text[a:b], text[b : b + model.longest]) for a, b in zip(ends, ends[1:])]
    way = piece_scan.route([c.matrix() for c in chunks])
    encoded = model.encoded
    monkeypatch.setattr(model, "encoded", lambda x: calls.append(len(x)) or encoded(x))
    got = piece_scan.chunk_ids(model, [c.around(c.into[s], c.out[e]) for c, s, e in zip(chunks, [0, *way], way)])
    assert sum(got.to_pylist(), []) == LIBRARY.encode("".join(texts(80, 60))) and calls == [len(chunks)] and piece_scan.chunk_ids(model, []).to_pylist() == []
