import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sabermill.llm import queries
from sabermill.llm.byte_bpe import encoder

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>\nz", "one two <|endoftext|> <|endoftext|>three", "no such string", "<|endoftext |> <|end", None, " <|endoftext|> "]
TEXTS += [f"{a}<|endoftext|>{b}" for a in ("w ", "w", " ", "\u3000", "é ") for b in (" w", "w", "  ", "\u00a0x", " é")]


@pytest.fixture(scope="module")
def plain():
    found = Tokenizer.from_file(queries.BYTE_BPE)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_plain_call(plain):
    assert 50256 in plain(TEXTS[0])
    got = [(ids.tolist(), counts.tolist()) for _, ids, counts in encoder(queries.BYTE_BPE, special_tokens=True).encode(TEXTS * 2)]
    assert [i for ids, _ in got for i in ids] == [i for t in TEXTS * 2 for i in plain(t)]
    assert [n for _, counts in got for n in counts] == [len(plain(t)) for t in TEXTS * 2]


def test_registered_queries_use_the_plain_call(spark, plain, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for row in queries.op3_token_files(spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = np.array([*plain(TEXTS[row["doc_id"]]), 0], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    counts = queries.op8_token_counts(spark, str(tmp_path)).groupBy("doc_id").sum("n_tokens").collect()
    assert dict(map(tuple, counts)) == {i: len(plain(t)) for i, t in enumerate(TEXTS)}
