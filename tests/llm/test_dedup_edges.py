"""Columns that clash with temporary names, words with equal polynomial hashes, recall of links at the threshold."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import exact_dedup, near_dedup, pii, substring_dedup
from civiclake.llm.shingles import word_hashes

CLASH = ["__k", "__id", "__row", "__ents", "__map", "row_key", "kept_key", "dropped_id", "row_number", "entities", "marked", "K", "H", "S"]


@pytest.fixture(scope="module")
def clash(spark):
    rows = [(i, t, *[f"{c}{i}" for c in CLASH]) for i, t in enumerate(["same words here", "same  words here", "mail ab.1@mail2.example.com now", None, ""])]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH))


@pytest.mark.parametrize("stage, left", [(exact_dedup.exact_unique, {0, 2, 3}), (near_dedup.near_unique, {0, 2, 3, 4}), (lambda df: pii.replace_entities(df, "corpus"), {0, 1, 2, 3, 4})])
def test_clashing_columns(clash, stage, left):
    out = stage(clash)
    assert out.columns == clash.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == left
    assert all(r[c] == f"{c}{i}" for i, r in rows.items() for c in CLASH)


def thue_morse(n: int) -> tuple[str, str]:
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def test_words_of_equal_polynomials(spark):
    a, b = thue_morse(1024)
    h = word_hashes([a.encode(), b.encode()])[0]
    assert h[0] != h[1]
    got = near_dedup.near_duplicates(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 2, True)}


def test_word_hashes_tell_words_apart():
    rnd = random.Random(4)
    words = {bytes(rnd.choices(b"ab", k=rnd.randint(1, 130))) for _ in range(20_000)} | {b"a" * n for n in range(1, 200)}
    raw = sorted(words)
    h, starts, ends, first, joined = word_hashes(raw)
    assert [joined[a:b] for a, b in zip(starts, ends, strict=True)] == raw and first.tolist() == list(range(len(raw) + 1))
    assert len(np.unique(h)) == len(raw)
    # The same word hashes alike wherever it stands.
    again = dict(zip(raw, h.tolist(), strict=True))
    mixed = [b" ".join(rnd.sample(raw, 50)) for _ in range(20)]
    h, starts, ends, _, joined = word_hashes(mixed)
    assert all(again[joined[a:b]] == x for a, b, x in zip(starts, ends, h.tolist(), strict=True))


def test_recall_of_links(spark):
    """Pairs at and little above the threshold, against comparing all pairs."""
    rnd = random.Random(9)
    texts, n = [], 240
    for g in range(n):
        base = [f"g{g}w{i}" for i in range(rnd.randint(40, 200))]
        other = list(base)
        for k in rnd.sample(range(len(base)), max(1, len(base) // rnd.randint(25, 60))):
            other[k] = f"x{rnd.random()}"
        texts += [" ".join(base), " ".join(other)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    want = {k for k in range(n) if 100 * len(sets[2 * k] & sets[2 * k + 1]) >= 75 * len(sets[2 * k] | sets[2 * k + 1])}
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = {k for k in range(n) if got[2 * k + 1] == 2 * k}
    assert 20 < len(want) < n - 20 and found == want


def test_hot_bucket_and_gram(spark, monkeypatch):
    """A third of all rows in one group of near copies: small blocks, so that it is dealt to many cells."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rnd = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    hot = [" ".join([*base[:-2], f"t{i}", f"u{i}"]) for i in range(60)]
    rest = [" ".join(rnd.choices([f"r{i}" for i in range(5000)], k=60)) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(hot + rest)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert all(got[i] == (0 if i < 60 else i) for i in got)
    gone = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()}
    assert all(gone[i] == (118 if i < 60 else 0) for i in gone)


def test_uses_of_stored_tables_end(spark, monkeypatch):
    """Tables that are dropped on the way aren't read by the result."""
    df = spark.createDataFrame([(i, "one two three four five six " + "x" * (i % 3)) for i in range(9)], "doc_id long, text string")
    out = near_dedup.near_duplicates(df)
    assert out.count() == 9 and out.where("kept").count() == out.select(F.col("component_id")).distinct().count()
