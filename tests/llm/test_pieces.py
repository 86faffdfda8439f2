import public_tokenizers
import pytest
import sentencepiece

from sabermill.llm.pieces import decode_documents, encode_documents, model

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", "a  b", " a", "a ", "\n", "a\nb\n\n c", "\t", "é日🙂", "▁", "a▁b", "<s>", "</s> x", "a\x00b", "xxxxxxxxxx", "0x41 <0x41>",
    "  　x", "    def f(x):\n        return  1", "the " * 20_000, "x" * 5_000, "internationalization internationally international",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_are_those_of_the_library(spark, library):
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, n_pieces string, ids int").repartition(3)
    done = decode_documents(encode_documents(docs, PATH), PATH)
    assert done.columns == ["doc_id", "text", "n_pieces", "ids", "piece_ids", "decoded"]
    rows = done.collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        ids = library.encode(r["text"] or "")
        assert list(r["piece_ids"]) == ids and r["n_pieces"] == len(ids)
        assert r["decoded"] == library.decode(ids) == (r["text"] or "").replace("▁", " ")


def test_given_texts(spark, library):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    ids, counts = model(PATH).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == library.encode(text)
        at += n


def test_shared_prefixes_change_nothing():
    own = model(PATH)
    words = sorted({f"▁{a}{b}{c}" for a in ("inter", "interest", "in", "zz🙂") for b in ("", "nation", "ed", "日") for c in ("s", "al", "")})
    assert own.segment(words) == [own.segment([w])[0] for w in words]


def test_odd_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None,), ([],), ([264, None, 99999, -1],)], "piece_ids array<int>")
    assert [r["decoded"] for r in decode_documents(df, PATH).collect()] == ["", "", "a"]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decode_documents(encode_documents(empty, PATH), PATH).collect() == []
