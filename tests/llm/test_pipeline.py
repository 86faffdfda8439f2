import random

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from test_decontaminate import brute as decontaminated
from test_near_duplicates import brute as classes
from test_substrings import brute as without_repeats

from sabermill.llm.quality import classify
from sabermill.llm.tables import table
from sabermill.session import fresh_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    """A small corpus with planted cases, and where it lies."""
    draw = random.Random(4)

    def prose(n):
        return " ".join("".join(draw.choice("aeiourstlnm") for _ in range(draw.randint(2, 9))) for _ in range(n)) + "."

    texts = {i: prose(draw.randint(40, 90)) for i in range(60)}
    passage, item = prose(55), prose(20)
    texts[60] = texts[3]
    texts[61] = texts[4].replace(texts[4].split()[20], "changed", 1)
    texts |= {62 + i: f"{prose(60)} {passage} {prose(60)}" for i in range(3)}
    texts[65] = f"{prose(30)} {item} {prose(30)}"
    junk = {100 + i: " ".join(w.upper() + "!!" for w in prose(40).split()) for i in range(30)}
    rows = [(i, t, "en", "s", len(t)) for i, t in {**texts, **junk}.items()]
    folder = fresh_path(spark, "corpus")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i, *_ in rows if i % 3 or i >= 100]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, item), (8, prose(15))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, item


def test_stages_match_brute_force_one_after_another(spark, corpus):
    folder, texts, item = corpus
    docs = table(spark, folder, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "pieces"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = fresh_path(spark, name)
        out.write.parquet(path)
        if name != "pieces":
            assert out.columns == docs.columns
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    scored = classify(table(spark, folder, "documents"), table(spark, folder, "labels")).collect()
    assert set(kept["quality"]) == {r["doc_id"] for r in scored if r["predicted"]} == set(texts)
    pairs = sorted((i, r["text"]) for i, r in kept["quality"].items())
    assert set(kept["near_duplicates"]) == set(classes(pairs)) and not {60, 61} & set(kept["near_duplicates"])
    pairs = sorted((i, r["text"]) for i, r in kept["near_duplicates"].items())
    assert {i: r["text"] for i, r in kept["substrings"].items()} == {i: t for i, _, _, t in without_repeats(pairs, 20)}
    assert all(r["n_chars"] == len(r["text"]) for r in kept["substrings"].values())
    clean = {i for i, r in kept["substrings"].items() if not decontaminated(r["text"], [(7, item)], 10)[1]}
    assert set(kept["decontamination"]) == clean and 65 not in clean
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in kept["pieces"].items():
        assert list(r["piece_ids"]) == library.encode(kept["decontamination"][i]["text"]) and r["round_trip"]
    # Clean documents are as they were.
    for i in range(60):
        assert kept["decontamination"][i]["text"] == texts[i]


def test_run_applies_the_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus[0]).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({*range(60), 62, 63, 64})


def test_empty_and_null_documents_pass_through(spark, corpus):
    folder = fresh_path(spark, "corpus")
    for name in ("labels", "benchmark"):
        table(spark, corpus[0], name).write.parquet(f"{folder}/{name}.parquet")
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words of no id", None, None, 3), (3, "plain words here", "en", "s", 16)]
    spark.createDataFrame(odd, DOCS).write.parquet(f"{folder}/documents.parquet")
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, DOCS)
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, folder)
            assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted((r[0] for r in rows), key=str), name
        assert corpus_pipeline.good_quality(spark, docs, folder).columns == docs.columns


def test_a_text_that_shares_its_id_with_a_copy_stays(spark):
    a, b = "one two three four five six seven", "nothing in common with the other text at all"
    rows = [(i, t, "en", "s", len(t)) for i, t in ((1, a), (5, a), (5, b))]
    out = corpus_pipeline.without_near_duplicates(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, a), (5, b)]
