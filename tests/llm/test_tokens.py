import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sabermill.llm import byte_bpe
from sabermill.llm.byte_bpe import ByteBpe, encoder
from sabermill.llm.huffman import BLOCK, CHECKPOINT, Codec, canonical, code_lengths
from sabermill.llm.token_counts import count_tokens
from sabermill.llm.token_files import read_tokens, write_tokens
from sabermill.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "  b", "x  y \n z\t", "a  b", " \nfoo bar", "foo\n\n", "foo\n\n bar", "à la «b» c", "é " * 70, "I'll don't 12 345",
    "<|endoftext|> a <|endoftext|>", "tail ", "  em 　 wide", "one two\none two\r\n", "日本 語 🙂 🙂x", "word " * 20_000, "\x85 next \x1c x",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_whole_text(library):
    ids, counts = [], []
    for _, some, n in encoder(PATH).encode(TEXTS * 2):
        ids.extend(some.tolist())
        counts.extend(n.tolist())
    assert ids == [i for t in TEXTS * 2 for i in library(t)]
    assert counts == [len(library(t)) for t in TEXTS * 2]


def test_pieces_are_cut_finely_and_encoded_once_for_many_batches(library, monkeypatch):
    texts = ["one word, two.\nword\n \nWord's it'sword 12ab a<|endoftext|>b\x1c\nx é.\ny", "word. (word) word! one\n\ntwo", "|>a<|endoftext|>.\n"]
    for special in (False, True):
        plain = Tokenizer.from_file(PATH)
        plain.encode_special_tokens = not special
        bpe, asked = ByteBpe(PATH, special), []
        through = bpe._library
        monkeypatch.setattr(bpe, "_library", lambda some: asked.extend(some) or through(some))
        wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        for _ in range(3):
            assert [ids.tolist() for _, some, n in bpe.encode(texts) for ids in np.split(some, np.cumsum(n)[:-1])] == wanted
        assert "".join(asked).count(" word") == 1
        assert "".join(asked).count("two") == 2  # " two", and "two" after a line feed
        monkeypatch.setattr(byte_bpe, "_KNOWN_BYTES", 0)  # no room: what is seen is forgotten after each batch
        for _ in range(2):
            assert [ids.tolist() for _, some, n in bpe.encode(texts[::-1]) for ids in np.split(some, np.cumsum(n)[:-1])] == wanted[::-1]
            assert len(bpe.known) == 0
        monkeypatch.undo()


def test_code_is_optimal_and_limited():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89])
    free, tight = code_lengths(counts, 20), code_lengths(counts, 4)
    assert free.max() == 10 and tight.max() == 4 and free[0] == tight[0] == 0
    for lengths in (free, tight):
        assert sum(2.0 ** -int(n) for n in lengths if n) == 1
        codes = canonical(lengths)
        words = [format(int(c), f"0{n}b") for c, n in zip(codes, lengths, strict=True) if n]
        assert len(set(words)) == 11 and not any(a != b and b.startswith(a) for a in words for b in words)
    import heapq

    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert cost == int((free * counts).sum())
    with pytest.raises(ValueError):
        code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("n_symbols", [1, 2, 300])
def test_streams_round_trip(n_symbols):
    draw = np.random.default_rng(1)
    counts = np.array([0, 1, CHECKPOINT, CHECKPOINT + 1, BLOCK, 3 * BLOCK + 7])
    symbols = np.minimum(draw.geometric(0.05, counts.sum()) - 1, n_symbols - 1)
    codec = Codec(code_lengths(np.bincount(symbols, minlength=n_symbols), 12))
    data, sizes, marks = codec.write(symbols, counts)
    starts = np.cumsum(sizes) - sizes
    assert (codec.read(data, starts, counts, marks.astype(np.int64)) == symbols).all()
    # One stream, and one block of it, can be read alone.
    last = data[starts[-1] :]
    own = marks[-(-(-counts[-1] // CHECKPOINT)) :].astype(np.int64)
    assert (codec.read(last, np.array([0]), counts[-1:], own) == symbols[-counts[-1] :]).all()
    block = own[BLOCK // CHECKPOINT : 2 * BLOCK // CHECKPOINT]
    assert block[0] % 8 == 0
    assert (codec.read(last, np.array([0]), np.array([BLOCK]), block) == symbols[-counts[-1] :][BLOCK : 2 * BLOCK]).all()


def test_files_round_trip(spark, library):
    docs = [(7 * i % 23 if i != 5 else None, t, "x") for i, t in enumerate(TEXTS)] + [(3, "same id", "y")] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string, start string").repartition(3)
    path = fresh_path(spark, "test-tokens")
    write_tokens(df, path, PATH, part_tokens=2000)
    rows = read_tokens(spark, path).orderBy("start", "n_tokens").collect()
    want = [(i, library(t) + [0]) for i, t, _ in docs]
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [i for i, _ in got] == sorted((i for i, _ in want), key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in rows] == [sum(len(ids) for _, ids in got[:k]) for k in range(len(got))]
    assert len(list(spark.read.parquet(f"{path}/data").select("part").distinct().collect())) > 3
    assert zlib.crc32(bytes(rows[0]["ids"])) >= 0


def test_no_documents(spark):
    path = fresh_path(spark, "test-tokens")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert read_tokens(spark, path).collect() == []
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def expected(text, spans):
    text = text or ""
    offsets = Tokenizer.from_file(PATH)
    offsets.encode_special_tokens = True
    tokens, at = [], 0
    pieces = offsets.encode(text, add_special_tokens=False).ids
    raw = text.encode()
    for i in pieces:
        size = len(offsets.id_to_token(i))
        first = len(raw[: at + 1].decode(errors="ignore")) if raw[at : at + 1] and (raw[at] & 0xC0) != 0x80 and len(raw[at : at + 1].decode(errors="ignore")) else len(raw[:at].decode(errors="ignore")) + 1
        begin = first - 1 if (raw[at] & 0xC0) != 0x80 and raw[at] < 0x80 else len(raw[:at].decode(errors="ignore"))
        at += size
        tokens.append((begin, sum((b & 0xC0) != 0x80 for b in raw[:at])))
    out = []
    for k, (a, b) in enumerate(spans):
        inside = [t for t in tokens if a <= t[0] < min(b, len(text))]
        out.append((k, a, b, len(inside), int(bool(inside) and inside[-1][1] > b)))
    return out


def lines(text):
    spans, at = [], 0
    for part in (text or "").splitlines(keepends=True) if "\x85" not in (text or "") else [text]:
        spans.append((at, at + len(part)))
        at += len(part)
    return spans or [(0, 0)]


def test_line_counts_add_up_and_follow_the_rule(spark):
    texts = [t for t in TEXTS if t is None or not ({"\x85", "\x1c", "\r"} & set(t))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in count_tokens(df, PATH).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, text in enumerate(texts):
        assert sorted(got[i]) == expected(text, lines(text)), text


def test_given_sections(spark):
    text = "Title here\nBody of étude 🙂🙂 text"
    spans = [(0, 10), (11, 35), (5, 18), (-3, 4), (30, 900), (9, 2), None]
    df = spark.createDataFrame([(1, text, spans), (2, text, None), (3, text, []), (4, None, [(0, 5)])], "doc_id long, text string, parts array<struct<begin:int,end:int>>")
    got = sorted(tuple(r) for r in count_tokens(df, PATH, spans_col="parts").collect())
    want = expected(text, [(a, b) for a, b in (s or (0, 0) for s in spans)])
    assert [g[1:4] + g[4:] for g in got if g[0] == 1] == [w for w in want]
    assert [g for g in got if g[0] != 1] == [(4, 0, 0, 5, 0, 0)]
