"""The stages against their operators, one after the other, and the decisions they take."""

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from moraine.llm import bpe, decontaminate, pii, simhash, toxicity
from tests.llm import messy

SF_DIR = "/root/testdata/sf0.001"


def test_the_stages_and_their_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]


def components(texts):
    """Brute force over all pairs: ids to the smallest id of their component."""
    ids = list(texts)
    points = np.array([simhash.fingerprint(texts[i]) for i in ids], dtype=np.uint64)
    sets = simhash.Forest(len(ids))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3):
            sets.link(i, int(j))
    least = {}
    for i, doc_id in enumerate(ids):
        least[sets.root(i)] = min(least.get(sets.root(i), doc_id), doc_id)
    return {doc_id: least[sets.root(i)] for i, doc_id in enumerate(ids)}


def contaminated(text, windows):
    words, hit = decontaminate.words_of(text), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score_documents(docs, labels).collect()
    texts = {r.doc_id: r.text for r in scored if r.score < 0.3}
    assert 0 < len(texts) < len(scored)
    least = components(texts)
    texts = {i: t for i, t in texts.items() if least[i] == i}
    windows = set()
    for item in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        words = decontaminate.words_of(item.text)
        n = min(13, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    texts = {i: t for i, t in texts.items() if not contaminated(t, windows)}
    kept = docs.where(docs.doc_id.isin(*texts))
    network = pii.learn_network(kept)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    expected = {}
    for doc_id, text in texts.items():
        ((_, spans),) = pii.search_texts([text], network)
        expected[doc_id] = bpe.encode_text(pii.masked(text, spans), path, pattern).tolist()
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: np.frombuffer(r.token_ids, "<u4").tolist() for r in found} == expected
    assert len(found) == len(expected) and all(r.n_tokens == len(expected[r.doc_id]) for r in found)


@pytest.fixture
def folder(spark, tmp_path):
    messy.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, messy.PLAIN), (2, None), (None, "a")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = messy.documents(spark, "score", "found", "spans", "items", "base", "predicted")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_takes_messy_and_no_documents(spark, folder, name, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stage(spark, docs, folder)
    if name != "byte_bpe":
        assert kept.columns == docs.columns
    assert 0 < kept.count() <= len(messy.ROWS)
    assert stage(spark, messy.none(docs), folder).count() == 0


def test_what_each_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, docs, folder)
    assert [r[0] for r in messy.rows(kept, "doc_id")] == [1, 2, 5, 6, 7, 8, 9]
    kept = stages["decontamination"](spark, docs, folder)
    texts = [r.text for r in kept.collect()]
    # Four rows are an item's text, and one holds the word of the item without an id.
    assert messy.PLAIN not in texts and messy.ROWS[12][1] not in texts
    assert len(texts) == len(messy.ROWS) - 5
    masked = {r.doc_id: r for r in stages["personal_data"](spark, docs, folder).collect()}
    assert masked[8].text == "mail [EMAIL] or [PHONE]" and masked[8].n_chars == len(masked[8].text)
    assert masked[5].text == messy.LONG and masked[5].n_chars == len(messy.LONG)


CLASHES = ("score", "spans", "items", "masked", "predicted", "held_out", "n_hit", "n_words", "component_id",
           "fingerprint", "base", "found", "n_tokens")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_documents_keep_their_own_columns(spark, folder, name, stage):
    docs = messy.documents(spark, *CLASHES)
    for i, column in enumerate(CLASHES):
        docs = docs.withColumn(column, F.concat(F.lit(f"own {i} "), F.coalesce("doc_id", F.lit(-1))))
    kept = stage(spark, docs, folder)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    given = [r.asDict() for r in docs.collect()]
    if name == "personal_data":
        for row in given:
            if row["doc_id"] == 8:
                row["text"] = "mail [EMAIL] or [PHONE]"
                row["n_chars"] = len(row["text"])
    rows = [r.asDict() for r in kept.collect()]
    assert rows and all(row in given for row in rows)


def test_columns_that_are_not_there(spark, folder):
    docs = messy.documents(spark).select("text", "doc_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == ["text", "doc_id"]


def test_personal_data_is_masked_whatever_the_network_marks(spark, monkeypatch):
    """A network that takes every text for one address, so that all windows cut it."""

    def train(windows, tags):
        network = pii.new_network(np.random.default_rng(0))
        network = {name: np.zeros_like(own) for name, own in network.items()}
        network["tag"][[3, 4]] = 1, 2
        return network

    monkeypatch.setattr(pii, "train", train)
    text = "see 10.0.0.1 sntg.11 or erst.ing " + "thon.ea " * 40 + "mail ann@example.org. "
    docs = spark.createDataFrame([(1, text), (2, "in. 4 erly. es " * 30), (3, None)], "doc_id long, text string")
    masked = corpus_pipeline.mask_personal_data(spark, docs, "")
    wanted = text.replace("10.0.0.1", "[IP]").replace("ann@example.org", "[EMAIL]")
    assert {r.doc_id: r.text for r in masked.collect()} == {1: wanted, 2: "in. 4 erly. es " * 30, 3: None}
