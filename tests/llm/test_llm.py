"""Each operator on a small table of edge cases: nulls, empty and long texts, repeated rows, clashing columns, no rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public = pytest.importorskip("public_tokenizers")

from civiclake.llm import bpe, exact_dedup, near_dedup, packing, pii, quality, substring_dedup, token_store, topk, toxicity  # noqa: E402
from civiclake.llm.common import scratch  # noqa: E402
from civiclake.llm.fm_index import repeated_windows  # noqa: E402
from civiclake.llm.mph import MinimalPerfectHash, mix  # noqa: E402
from civiclake.llm.wordids import encoder  # noqa: E402

WORDS = public.path("word_bpe_49k.json")
BYTES = public.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id0 string, node int, kept string, h string"


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["Élan", "it's", "x.", "(y)"]
    base = [" ".join(rnd.choices(vocab, k=n)) for n in (60, 80, 120, 300, 3, 4, 5, 34, 35, 36)]
    near = [base[2].replace(" ", "  ", 3) + " tail", " ".join(base[3].split()[:-4] + ["a", "b"]), base[3] + " end"]
    shared = " ".join(f"s{i}" for i in range(50))
    texts = base + near + [base[0], base[0].replace(" ", "\n"), f"{base[1]} {shared} z", f"q {shared} {base[2]}", "", None, "  \t", "ab " * 120, "long " + " ".join(rnd.choices(vocab, k=6000)), "\x1c odd 　 space"]
    rows = [(i, t, "en", "s", 1, "x", 1, "k", "h") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "no id here", "en", "s", 1, "x", 1, "k", "h")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_exact(docs, empty):
    norm = [(r[0], re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")) for r in corpus()]
    want = []
    for i, t in norm:
        same = [a for a, b in norm if b == t]
        keep = min((a for a in same if a is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert rows_of(exact_dedup.exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)
    kept = exact_dedup.exact_unique(docs)
    assert kept.columns == docs.columns and kept.count() == len({t for _, t in norm})
    assert exact_dedup.exact_dedup(empty).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near(docs, empty):
    ids = {r[0]: shingles(r[1]) for r in corpus() if r[0] is not None}
    root = {i: i for i in ids}
    for a in ids:
        for b in ids:
            n = len(ids[a] & ids[b])
            if a < b and n and 100 * n >= 75 * len(ids[a] | ids[b]):
                x, y = sorted((root[a], root[b]))
                root = {k: x if v == y else v for k, v in root.items()}
    got = rows_of(near_dedup.near_duplicates(docs).where("doc_id IS NOT NULL").distinct(), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(((i, len(s), root[i], root[i] == i) for i, s in ids.items()), key=str)
    assert near_dedup.near_unique(docs).columns == docs.columns
    assert near_dedup.near_duplicates(empty).count() == 0


def test_open_buckets(spark):
    """Copies that resemble a middle text, but not one another or the first of their bucket."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        w = list(base)
        for k in rnd.sample(range(400), 9):
            w[k] = f"x{rnd.random()}"
        texts.append(" ".join(w))
    texts.insert(6, " ".join(base))
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}


def test_substring(docs, empty):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in corpus()]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - 34):
            seen.setdefault(tuple(w[i : i + 35]), []).append((d, i))
    gone = [set() for _ in words]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + 35))
    want = [(r[0], len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest()) for r, w, g in zip(corpus(), words, gone, strict=True)]
    assert rows_of(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_hot_gram(docs, monkeypatch):
    plain = rows_of(substring_dedup.remove_repeats(docs), "doc_id", "n_removed", "kept_sha256")
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 200)
    assert rows_of(substring_dedup.remove_repeats(docs), "doc_id", "n_removed", "kept_sha256") == plain


def test_fm_index_against_counting():
    rnd = np.random.default_rng(1)
    pieces = [rnd.integers(2, 4, n) for n in rnd.integers(6, 30, 40)]
    weights = rnd.integers(1, 3, 40)
    counts = {}
    for p, w in zip(pieces, weights, strict=True):
        for i in range(len(p) - 5):
            counts[tuple(p[i : i + 6])] = counts.get(tuple(p[i : i + 6]), 0) + w
    for p, m in zip(pieces, repeated_windows(pieces, weights, 4, 6).tolist(), strict=True):
        assert [bool(m >> i & 1) for i in range(len(p) - 5)] == [counts[tuple(p[i : i + 6])] > 1 for i in range(len(p) - 5)]


def test_word_ids():
    from tokenizers import Tokenizer

    e, fresh = encoder(WORDS), Tokenizer.from_file(WORDS)
    for t in [r[1] or "" for r in corpus()] + ["I'm 3.5% <|endoftext|> ΣΑΣ é \x00 ok", "a.b,c. .d", "..x,,", "É" * 50]:
        assert e.text(t).tolist() == fresh.encode(t, add_special_tokens=False).ids


def test_token_store(docs, empty, spark):
    got = rows_of(token_store.read_tokens(token_store.write_tokens(docs, f"{scratch(spark)}/t", WORDS, 2, shard_ids=300)), "doc_id", "start", "n_tokens", "ids_crc32")
    assert len(got) == len(corpus())
    ids = {r[0]: np.append(encoder(WORDS).text(r[1]), 2).astype("<u4") for r in corpus()}
    assert all(n == len(ids[i]) and c == zlib.crc32(ids[i].tobytes()) for i, _, n, c in got)
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        assert start == at
        at += n
    assert token_store.read_tokens(token_store.write_tokens(empty, f"{scratch(spark)}/e", WORDS, 2)).count() == 0


def test_packing(docs, empty):
    got = packing.pack_documents(docs, WORDS, 1, max_tokens=256, max_segments=8).collect()
    ids = {r[0]: np.append(encoder(WORDS).text(r[1]), 1).astype("<u4") for r in corpus()}
    assert sum(r.length for r in got) == sum(len(ids[r[0]]) for r in corpus())
    by = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 256 and len(pieces) <= 8
    assert packing.pack_documents(empty, WORDS, 1).count() == 0


def test_packing_loss_limit():
    tokens, loss = np.array([50, 60, 70, 30, 90]), np.array([40, 10, 70, 30, 5])
    seen = np.zeros(5, int)
    for bin_ in packing.pack_pool(tokens, loss, (100, 3, 50)):
        used = sum(sum(1 for k in range(s, s + n) if k >= tokens[i] - loss[i]) for i, s, n in bin_)
        assert used <= 50 and sum(n for *_, n in bin_) <= 100 and len(bin_) <= 3
        for i, _, n in bin_:
            seen[i] += n
    assert seen.tolist() == tokens.tolist()


def test_bpe(docs, empty):
    import tiktoken

    c = bpe.codec(BYTES, public.PATTERN)
    t = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    want = []
    for r in corpus():
        ids = np.array(t.encode_ordinary(r[1] or ""), "<u4")
        want.append((r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert rows_of(bpe.digest_documents(docs, BYTES, public.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    back = bpe.decode_column(bpe.encode_documents(docs, BYTES, public.PATTERN), BYTES, public.PATTERN)
    assert sorted(bytes(r.text) for r in back.collect()) == sorted((r[1] or "").encode() for r in corpus())
    assert bpe.encode_documents(empty, BYTES, public.PATTERN).count() == 0


def test_bpe_with_full_tables(monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "CACHE", 8)
    c = bpe.ByteBpe(BYTES, public.PATTERN)
    t = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    texts = [r[1] or "" for r in corpus()]
    for _ in range(3):
        for part in (texts[:9], texts[9:], texts):
            assert [np.frombuffer(x, "<u4").tolist() for x in c.encode(part)] == [t.encode_ordinary(x) for x in part]


def test_perfect_hash():
    for n in (0, 1, 2, 1000):
        h = mix(np.arange(n, dtype=np.uint64))
        m = MinimalPerfectHash.load(MinimalPerfectHash.build(h).dump())
        assert sorted(m.slots(h).tolist()) == list(range(n))


def test_topk(spark):
    rnd = np.random.default_rng(2)
    vec = [(i, rnd.normal(size=6).tolist() if i % 3 else [0.5] * 6) for i in range(200)] + [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (350, [float("nan")] * 6), (400, [float("inf")] * 6), (None, [0.1] * 6)]
    got = topk.exact_topk(spark.createDataFrame(vec, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 5)
    ok = {i: np.floor(256 * np.float32(v).astype(float)).astype(int) for i, v in vec[:200]}
    want = []
    for q in range(0, 200, 50):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=str)
    assert topk.exact_topk(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_topk_over_many_blocks_and_groups(spark, monkeypatch):
    """Blocks of 16 and groups of 7 queries, with ties across blocks, give what one block gives: the plain ranking."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP", 7)
    rnd = np.random.default_rng(9)
    v = rnd.integers(-3, 4, size=(300, 8)) / 256
    got = topk.exact_topk(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 5)
    whole = np.floor(256 * v).astype(int)
    want = []
    for q in range(0, 300, 20):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(300) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=str)


def test_topk_repeated_rows(spark):
    """Copies of one candidate, and vectors of one id with one score, take one place of the k."""
    vec = [(0, [1.0, 0.0])] + [(1, [0.9, 0.0])] * 6 + [(2, [0.8, 0.1 * j]) for j in range(6)] + [(i, [1.0 / i, 0.0]) for i in range(3, 9)]
    got = topk.exact_topk(spark.createDataFrame(vec, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5)
    assert [(r.rank, r.vec_id) for r in got.orderBy("rank").collect()] == [(k, k) for k in range(1, 6)]


def test_surrogates(spark, empty):
    texts = ["Mail ab.12@mail8.example.com or AB.12@MAIL8.EXAMPLE.COM, +1 (988) 555-2485. Mr. Smith and Mrs Jones met Mr Smith", "4111 1111 1111 1111 ip 8.8.8.8 and 8.8.4.4", None, "", "clean 4.0. text", "call +1 (988) 555-2485"]
    out = [r.text for r in pii.surrogate_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "corpus").orderBy("doc_id").collect()]
    assert out[2:5] == texts[2:5]
    mails = re.findall(r"\S+@[\w.]+\w", out[0])
    assert mails[0] != "ab.12@mail8.example.com" and mails[1] == mails[0].upper()
    phone = re.search(r"\+1 \(\d{3}\) 555-\d{4}", out[0])[0]
    assert phone in out[5] and phone not in texts[0]
    a, b = re.findall(r"Mr\.? (\w+)", out[0])
    assert a == b != "Smith"
    card = re.search(r"\d{4}( \d{4}){3}", out[1])[0].replace(" ", "")
    assert card[0] == "4" and sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(card)) % 10 == 0
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", out[1])
    assert len(set(ips)) == 2 and not {"8.8.8.8", "8.8.4.4"} & set(ips)
    assert pii.surrogate_documents(empty, "corpus").count() == 0


def test_surrogates_stay_distinct(spark):
    """More entities than a first draw keeps apart: every replacement is still its own."""
    texts = [(i, f"+1 (212) 555-{i:04d}") for i in range(3000)]
    out = pii.surrogate_documents(spark.createDataFrame(texts, "doc_id long, text string"), "corpus")
    assert out.select("text").distinct().count() == 3000
    assert out.join(spark.createDataFrame(texts, "n long, text string"), "text").count() == 0


def test_surrogates_of_full_pools(spark, monkeypatch):
    """More entities than their own format has replacements for: addresses, mail boxes of one letter, names."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", (["ba", "be"], ["n"], ["na"], ["k"]))
    names = [f"Mr {a}{b}" for a in "BCDF" for b in ("oxo", "uxu", "ixi")]
    found = [f"192.168.{a}.{b}" for a in range(1, 132) for b in range(1, 255)] + [f"{c}@ab.com" for c in "abcdefghijklmnopqrstuvwxyz"] + names
    out = [r.text for r in pii.surrogate_documents(spark.createDataFrame(list(enumerate(found)), "doc_id long, text string"), "corpus").collect()]
    assert len(out) == len(set(out)) == len(found) and not set(out) & set(found)


def test_classifiers(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, held = labels.where("doc_id % 4 != 0"), labels.where("doc_id % 4 = 0")
    q = quality.score_quality(d, quality.train_quality(d, train, quality.label_grade(), quality.GRADES))
    right = q.join(held, "doc_id").agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.9
    r = q.first()
    assert r.p_ge_1 >= r.p_ge_2 and abs(r.expected_grade - r.p_ge_1 - r.p_ge_2) < 1e-9
    found = toxicity.score_toxicity(d, toxicity.train_toxicity(d, train)).select("doc_id", F.col("toxic").alias("said")).join(held, "doc_id")
    assert found.agg(F.avg((F.col("said").cast("int") == F.col("toxic")).cast("double"))).first()[0] > 0.9


def test_classifiers_edge(docs, empty, spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    m = quality.train_quality(docs, labels, quality.label_grade(), quality.GRADES)
    assert quality.score_quality(docs, m).count() == len(corpus())
    assert quality.keep_quality(docs, m).columns == docs.columns
    assert toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).count() == len(corpus())
    m = quality.train_quality(empty, labels, quality.label_grade(), quality.GRADES)
    assert quality.score_quality(empty, m).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.train_toxicity(empty, labels)).count() == 0


def test_toxicity_of_a_small_language(spark):
    """Toxic words that few labelled rows hold, as in a language with few of them, are learned all the same."""
    rnd = random.Random(8)
    rows = []
    for lang, n, share in (("a", 900, 10), ("b", 160, 4)):
        plain, bad = [f"{lang}{i}" for i in range(300)], [f"{lang}bad{i}" for i in range(16)]
        for i in range(n):
            words = rnd.choices(plain, k=30) + ([bad[(i // share * 3 + j) % 16] for j in range(3)] if i % share == 0 else [])
            rows.append((len(rows), " ".join(words), int(i % share == 0), lang))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int, lang string")
    train = d.where("lang = 'a' OR doc_id % 3 > 0")
    seen = train.where("lang = 'b'").select(F.explode(F.split("text", " ")).alias("w")).where("w LIKE '%bad%'").groupBy("w").count()
    assert seen.agg(F.max("count")).first()[0] < 10
    said = {r.doc_id: r.toxic for r in toxicity.score_toxicity(d, toxicity.train_toxicity(d, train)).collect()}
    held = [(r[2], said[r[0]]) for r in rows if r[3] == "b" and r[0] % 3 == 0]
    caught = sum(s for y, s in held if y)
    assert caught >= 0.8 * sum(y for y, _ in held) > 0 and sum(s for y, s in held if not y) == 0


def test_toxic_categories_of_any_language():
    """A toxic document is graded by words that the labels of others tell to be toxic, in whatever language."""
    from civiclake.llm.hashed_text import Sample, features

    grade = [0 if i % 4 else (1, 2, 4)[i // 4 % 3] for i in range(240)]
    texts = [f"mot{i % 7} autre{i % 5} " + " ".join(f"sale{(i // 12 + j) % 5}" for j in range(g)) for i, g in enumerate(grade)]
    made = [features(t, False) for t in texts]
    sample = Sample([(i.astype(np.int32).tobytes(), v.astype(np.float32).tobytes()) for i, v in made], least=2)
    fold = np.arange(len(grade)) % toxicity.FOLDS
    got = toxicity.graded_targets(sample, np.array([g > 0 for g in grade], np.int64), fold)
    assert got.tolist() == [[int(g >= n) for n in (1, 2, 4)] for g in grade]
    model = toxicity.fit_chain(sample, got, fold)
    p = model.predict(np.array([v @ model.weights[i] for i, v in made]))
    assert ((p[:, 0] > 0.5) == (np.array(grade) > 0)).all() and (p[np.array(grade) == 4, 2].min() > p[np.array(grade) == 1, 2].max())


def test_word_ids_of_added_tokens():
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(WORDS)
    for t in ("a <|endoftext|> b <|startoftext|>", "x<|endoftext|>É", "a <|ENDOFTEXT|> b", "<| a |>"):
        assert encoder(WORDS).text(t).tolist() == fresh.encode(t, add_special_tokens=False).ids
    assert 49407 in encoder(WORDS).text("a <|endoftext|> b")
