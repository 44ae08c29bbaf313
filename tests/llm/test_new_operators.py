"""Spelling variants, tokenizer alignment and source mixing against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from civiclake.llm import alignment, mixing, spelling

COLUMNS = "doc_id long, text string, source string, word string, n long, rate double, cell string"


def rows(spark, items):
    return spark.createDataFrame([(*x, "clash", 1, 0.5, "c") for x in items], COLUMNS)


# --- spelling variants ---


def plain_words(docs, slip=97):
    count = Counter()
    for id_, text in docs:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def plain_one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [v for v in n if plain_one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def got_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def many_texts(seed=3, docs=300):
    rnd = random.Random(seed)
    parts = ["er", "ing", "the", "tion", "ón", "ÀÉ", "an", "st", "o", "e"]
    vocabulary = ["".join(rnd.choice(parts) for _ in range(rnd.randint(2, 4))) for _ in range(250)]
    return [(k, " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", ".", "'s", "s"]) for _ in range(rnd.randint(0, 120)))) for k in range(docs)]


@pytest.mark.parametrize("block", [2048, 5])
def test_spelling_against_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    docs = many_texts() + [(None, "Orange orange ORANGE"), (7, None), (8, ""), (9, "日本 orangé orangé orangé ×÷×÷× ×÷×÷× ×÷×÷×")]
    docs += docs[:40]
    want = plain_variants(docs)
    assert got_variants(spelling.spelling_variants(rows(spark, [(*d, "s") for d in docs]))) == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[1] != v[0] and v[0] for v in want.values())


def test_spelling_ties_long_words_and_empty_tables(spark):
    docs = [(1, "planet " * 4 + "plane " * 9 + "plant " * 9 + "x" * 300 + " " + "x" * 301)] * 3 + [(2, "planeta " * 2)] * 2
    assert got_variants(spelling.spelling_variants(rows(spark, [(*d, "s") for d in docs]))) == plain_variants(docs)
    assert spelling.spelling_variants(rows(spark, [])).count() == 0
    assert spelling.spelling_variants(rows(spark, [(1, "a bc", "s"), (2, None, None)])).count() == 0


def test_products_report_every_pair_once():
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(5, 7))) for _ in range(400)})
    raw = [w.encode("latin-1") for w in words]
    found = Counter()
    for size in (5, 6, 7):
        for front in (True, False):
            k, groups = size // 2, defaultdict(list)
            for n, w in enumerate(raw):
                if len(w) in (size, size + 1):
                    groups[w[:k] if front else w[-k:]].append(n)
            for g in groups.values():
                i, j = spelling.near_pairs([raw[x] for x in g], size, front)
                found.update(frozenset((words[g[a]], words[g[b]])) for a, b in zip(i, j, strict=True))
    want = {frozenset((a, b)) for a in words for b in words if a < b and plain_one_edit(a, b)}
    assert set(found) == want and set(found.values()) == {1}


# --- tokenizer alignment ---


def vocabularies():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = vocabularies()
    a_tok, b_tok = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_tok.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    docs, held = [], Counter()
    for text in texts:
        a, b, links, groups = [], [], [], []
        if text:
            raw = f" {text}".encode()
            a, b = a_tok.encode(f" {text}", add_special_tokens=False).ids, b_tok.encode(text)
            ab, bb = [bytes(byte[c] for c in a_tok.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
            if b"".join(ab) != raw or b"".join(bb) != raw:
                a, b = [], []
            else:
                ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
                ea, eb = ends(ab), ends(bb)
                links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ea[i] - len(ab[i]), eb[j] - len(bb[j])) < min(ea[i], eb[j])]
                at = 0
                for cut in sorted(set(ea) & set(eb)):
                    groups.append(([x for x, e in zip(a, ea, strict=True) if at < e <= cut], [x for x, e in zip(b, eb, strict=True) if at < e <= cut]))
                    at = cut
        held.update(set(links))
        docs.append((a, b, groups, links))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for a, b, groups, links in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        shared = sum(len(x) * len(y) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), shared, sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), digest))
    return out


TEXTS = ["Hello world", " two  spaces ", "", None, "naïve café 東京 😀 ﬁ", "a▁b", "tabs\tand\nlines\r\n", "<|endoftext|> </s> <0x0A>", "the the the", "Hello world", "\u0000\u007f x", "l'été, d'où? It's 1234567", "ㅤ ẞ͸ end", "ab" * 3000]


@pytest.mark.parametrize("common", [1 << 20, 60, 0])
def test_alignment_against_plain_version(spark, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    docs = [(k if k != 4 else None, t, "s") for k, t in enumerate(TEXTS)] + [(0, "Hello world", "s")]
    got = alignment.align_tokenizers(rows(spark, docs), *vocabularies()).collect()
    want = Counter((d[0], *x) for d, x in zip(docs, plain_alignment([d[1] for d in docs]), strict=True))
    assert Counter(map(tuple, got)) == want
    assert alignment.align_tokenizers(rows(spark, []), *vocabularies()).count() == 0


def test_fast_ids_are_the_library_s():
    both, rnd = alignment.pair(*vocabularies()), random.Random(1)
    signs = [chr(c) for c in [*range(0x300), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20B6)]] + [" "] * 200 + list("'sdtremvl") * 20
    for _ in range(3000):
        t = "".join(rnd.choice(signs) for _ in range(rnd.randint(1, 40)))
        assert both.encode_a(t) == both.lib.encode(t, add_special_tokens=False).ids


def test_products_of_incidence_matrices():
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(0, 2, (7, 9)), rnd.integers(0, 2, (9, 5))
    csr = lambda m: alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1])
    made = np.zeros((7, 5), int)
    for at, part in alignment.blocks(csr(a), csr(b), 6):
        for r, c, v in zip(part.rows(), part.columns, part.values, strict=True):
            made[at + r, c] = v
    assert (made == a @ b).all() and (alignment.row_bounds(csr(a), csr(b)) == (a @ b).sum(axis=1)).all()


def test_links_and_partners_of_a_text(spark):
    text = "naïve cafés cost 1234567"
    got = alignment.token_links(rows(spark, [(1, text, "s"), (2, None, "s")]), *vocabularies()).orderBy("a_at").collect()
    n_a, _, n_groups, n_links, shared, *_ = plain_alignment([text])[0]
    assert len(got) == n_a and got[-1].group == n_groups - 1
    assert sum(r.b_last - r.b_first + 1 for r in got) == n_links
    assert sum(r.group_b_last - r.group_b_first + 1 for r in got) == shared
    both = alignment.pair(*vocabularies())
    a, b = both.encode([text])[0]
    al = alignment.Aligned(np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]))
    pairs = {(x, y) for i, j in al.partners() for x, y in zip(i.tolist(), j.tolist(), strict=True)}
    assert pairs == {(r.a_at, j) for r in got for j in range(r.group_b_first, r.group_b_last + 1)}


# --- mixing ---


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        heavy = sum(weight[s] for s in sizes if s not in full)
        above = {s for s in sizes if s not in full and most * sizes[s] < weight[s] * rest / heavy} if heavy else set()
        if not above:
            return {s: float(most * sizes[s]) if s in full else (weight[s] * rest / heavy if heavy else 0.0) for s in sizes}
        full |= above


def mixed_docs(seed=4, n=400):
    rnd = random.Random(seed)
    names = ["b", "a", "é", "z", "Z", None, "", "tiny", "none"]
    docs = [(k, " ".join(["w"] * rnd.randint(0, 60)), rnd.choices(names[:7], [300, 5, 3, 10, 60, 9, 4])[0]) for k in range(n)]
    return docs + [(n, "one", "tiny"), (n + 1, None, "none"), (n + 2, "", "none"), (None, "x\x0by z", "a"), (n + 3, "w " * 30000, "b"), (n, "one", "tiny")]


def test_mix_against_plain_version_and_sql(spark, tmp_path):
    docs = mixed_docs()
    df = rows(spark, docs)
    got = mixing.mixing_plan(df).collect()
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(dict(sizes))
    assert {r.source: r.source_size for r in got} == dict(sizes) and len(got) == len(docs)
    assert {r.source: r.target for r in got} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values())) and any(want[s] == 3 * sizes[s] > 0 for s in want)
    assert all(r.taken <= 3 * r.size and int(r.rate) <= r.copies <= int(r.rate) + 1 for r in got)
    df.drop("n", "word", "rate", "cell").write.parquet(str(tmp_path / "documents"))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    cols = "doc_id, source, size, source_size, weight, target, rate, copies, taken"
    sql = duckdb.sql(f"SELECT {cols} FROM ({mixing.ORACLE})").fetchall()
    assert Counter(sql) == Counter(tuple(r[c] for c in cols.split(", ")) for r in got)
    again = mixing.mixing_plan(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(8)
    docs = [(k, "w " * rnd.randint(1, 40), f"s{rnd.randint(0, 3)}") for k in range(6000)]
    plan = mixing.mixing_plan(rows(spark, docs)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.05 for r in plan)


def test_mixed_rows_and_edge_cases(spark):
    df = rows(spark, mixed_docs(n=60)).withColumnRenamed("cell", "copy")
    plan = {(r.doc_id, r.source): r.copies for r in mixing.mixing_plan(df).collect()}
    out = mixing.mix_documents(df)
    assert out.columns == [*df.columns, "copy_"]
    taken = Counter((r.doc_id, r.source) for r in out.where("copy_ = 1 OR copy_ > 1").collect())
    times = Counter((r.doc_id, r.source) for r in df.collect())
    assert taken == Counter({k: plan[k] * n for k, n in times.items() if plan[k]})
    assert mixing.mixing_plan(rows(spark, [])).count() == 0 and mixing.mix_documents(rows(spark, [])).count() == 0
    assert [r.taken for r in mixing.mixing_plan(rows(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


# --- odd rows of earlier operators ---


def test_decoding_of_null_ids(spark):
    from civiclake.llm import bpe

    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode_documents(rows(spark, [(1, "a b", "s"), (None, None, "s")]), path, public.PATTERN)
    odd = ids.unionByName(spark.createDataFrame([(2, None)], "doc_id long, ids binary"))
    got = {r.doc_id: None if r.text is None else bytes(r.text) for r in bpe.decode_column(odd, path, public.PATTERN).collect()}
    assert got == {1: b"a b", None: b"", 2: None}


def test_links_with_null_and_itself(spark):
    from civiclake.llm.common import scratch
    from civiclake.llm.components import components

    links = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 3), (4, None), (None, 5), (7, 8), (7, 8)], "a long, b long")
    roots = {r.node: r.root for r in components(links, scratch(spark)).collect()}
    assert set(roots) == {1, 2, 3, 7, 8} and roots[1] == roots[2] == roots[3] != roots[7] == roots[8]
    assert components(links.where("a = b"), scratch(spark)) is None
