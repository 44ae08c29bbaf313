"""Every stage on a table of edge cases, on an empty one, and in sequence; packing under all three limits; keyed reads."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from civiclake.llm import packing, token_store  # noqa: E402
from civiclake.llm.common import scratch  # noqa: E402
from civiclake.llm.wordids import encoder  # noqa: E402

SF = "/root/testdata/sf0.001"
WORDS = public.path("word_bpe_49k.json")
EXTRA = ["__k", "__id", "__row", "entities", "marked", "row_key", "h", "node", "key"]


@pytest.fixture(scope="module")
def documents(spark):
    """The small documents with nulls, repeats, ties, a very long text and clashing columns."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(900_001, None), (900_002, ""), (900_003, " \t "), (None, "a text without an id, call (212) 555-1234"), (900_004, "word " * 60_000), (900_005, "Tied text here."), (900_005, "Tied text here."), (900_006, "Tied  text\nhere.")]
    odd = spark.createDataFrame(more, "doc_id long, text string")
    d = d.unionByName(odd, allowMissingColumns=True).unionByName(d.limit(3))
    return d.withColumns({c: F.lit(c) for c in EXTRA})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_edge_cases(spark, documents, name, stage):
    out = stage(spark, documents, SF)
    empty = stage(spark, documents.limit(0), SF)
    assert empty.count() == 0 and empty.columns == out.columns
    if name == "packing":
        assert out.agg(F.sum("length")).first()[0] == sum(len(encoder(WORDS).text(r.text)) + 1 for r in documents.collect())
        return
    assert out.columns == documents.columns
    rows, given = out.collect(), documents.collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    assert all(r[c] == c for r in rows for c in EXTRA)
    if name == "exact_dedup":
        assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in given})
    elif name == "pii":
        assert len(rows) == len(given) and not any("(212) 555-1234" in t for t in texts)
        assert {r.doc_id: r.n_chars for r in rows if r.text} == {r.doc_id: len(r.text) for r in rows if r.text}
    else:
        assert {r.doc_id for r in rows} <= {r.doc_id for r in given}
    if name == "near_dedup":
        assert {None, 900_001, 900_002, 900_003, 900_005} <= {r.doc_id for r in rows} and 900_006 not in {r.doc_id for r in rows}


def test_run(spark):
    """Packed ids are those of the documents that all earlier stages left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    left = {r.doc_id: np.append(encoder(WORDS).text(r.text), 1) for r in docs.collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(left) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {r.doc_id: r.doc_tokens for r in got} == {i: len(x) for i, x in left.items()}
    assert sum(r.length for r in got) == sum(map(len, left.values()))


def test_packing_of_conversations(spark):
    """Answers of conversations with their prompts: the limit on loss-bearing tokens binds where that on tokens doesn't."""
    t = spark.read.parquet(f"{SF}/conversations.parquet")
    turns = t.select("conv_id", "turn", "role", F.col("text").alias("answer"))
    ask = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    pairs = turns.where("role = 'assistant'").join(ask, ["conv_id", "turn"]).select(F.col("conv_id").alias("doc_id"), "prompt", "answer")
    got = packing.pack_documents(pairs, WORDS, 1, max_tokens=512, max_segments=6, max_loss=100, text_col="answer", prompt_col="prompt").collect()
    enc = encoder(WORDS)
    want = sum(len(enc.text(r.prompt)) + len(enc.text(r.answer)) + 1 for r in pairs.collect())
    assert sum(r.length for r in got) == want and sum(r.loss_tokens for r in got) == sum(len(enc.text(r.answer)) + 1 for r in pairs.collect())
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    sums = [(sum(r.length for r in x), sum(r.loss_tokens for r in x), len(x)) for x in by.values()]
    assert all(a <= 512 and b <= 100 and c <= 6 for a, b, c in sums)
    assert any(b == 100 and a < 512 for a, b, _ in sums)
    for bad in ({"max_loss": 0}, {"max_tokens": 0}, {"max_segments": 0}):
        with pytest.raises(ValueError):
            packing.pack_documents(pairs, WORDS, 1, **bad)


def test_keyed_reads(spark):
    rows = [(i * 3, f"text number {i}") for i in range(400)] + [(30, "another of thirty"), (None, "no key")]
    shards = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), f"{scratch(spark)}/k", WORDS, 2, shard_ids=200)
    assert shards.count() > 5
    want = lambda keys: sorted((k, [*encoder(WORDS).text(t).tolist(), 2]) for k, t in rows if k in keys)
    for keys in ([30], [0, 1, 30, 1197, 5000, -4], list(range(0, 1200)), [], [7]):
        assert sorted((r.doc_id, list(r.ids)) for r in token_store.lookup(shards, keys).collect()) == want(set(keys))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = token_store.lookup(shards, [30])._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "LessThanOrEqual(first_key,30)" in plan
