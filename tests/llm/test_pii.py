"""Surrogates against a plain version: what is found, what stays, one replacement an entity, forms and check digits kept."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from civiclake.llm import pii

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PLAIN = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9-])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])(?<![0-9] )[0-9]{3}(?:-[0-9]{2}-| [0-9]{2} )[0-9]{4}(?![0-9-]| [0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z+])(?<![0-9] )[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9]| [0-9])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
}


def plain_entities(text):
    """(start, end, kind) of all matches from left to right, the first kind at a place first."""
    out, at = [], 0
    found = {k: regex.compile(p) for k, p in PLAIN.items()}
    while at <= len(text):
        best = None
        for kind, p in found.items():
            m = p.search(text, at)
            if m and (best is None or m.start() < best[0]):
                best = (m.start(), m.end(), kind)
        if not best:
            return out
        out.append(best)
        at = best[1]
    return out


def same(kind, entity):
    return regex.sub("[^0-9]", "", entity) if kind in ("phone", "card", "ssn") else entity.lower()


def luhn_sum(digits):
    return sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(digits)) % 10


def test_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    old = {r.doc_id: r.text or "" for r in docs.collect()}
    new = {r.doc_id: r for r in pii.surrogate_documents(docs, "corpus").collect()}
    table, back, n = {}, {}, 0
    for i, text in old.items():
        out, at, left = new[i].text or "", 0, 0
        spans = plain_entities(text)
        for a, b, kind in spans:
            gap = text[left:a]
            assert out[at : at + len(gap)] == gap
            at += len(gap)
            m = regex.compile(PLAIN[kind]).match(out, at)
            assert m, (kind, text[a:b], out[at : at + 60])
            here = m[0]
            e, r = (kind, same(kind, text[a:b])), (kind, same(kind, here))
            assert table.setdefault(e, r) == r and back.setdefault(r, e) == e and e != r
            if kind in ("phone", "card", "ssn"):
                assert regex.sub("[0-9]", "9", here) == regex.sub("[0-9]", "9", text[a:b])
            if kind == "card":
                assert luhn_sum(r[1]) == luhn_sum(e[1])
            at, left, n = at + len(here), b, n + 1
        assert out[at:] == text[left:] and new[i].n_entities == len(spans)
    assert n > 10 and not set(table) & set(back)


def one(spark, *texts):
    return [r.text for r in pii.surrogate_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "corpus").orderBy("doc_id").collect()]


def test_whole_names(spark):
    a, b, c = one(
        spark,
        "Mr. John Smith met Mrs. Smith-Jones, Dr. Adams, Mr. O'Brien, Ms. de Souza and Mr. SMITH. Smith's car; smith, Smithson. John left, Mr. J. R. Smith stayed.",
        "Herr Dr. Jürgen von der Heide traf Frau Heide. Господин Иванов и Госпожа Иванова.",
        "Smith without a title, Mr. Smith's and Mr Smith",
    )
    m = regex.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+)-(\w+), Dr\. (\w+), Mr\. O'(\w+), Ms\. de (\w+) and Mr\. (\w+)\. (\w+)'s car; smith, Smithson\. (\w+) left, Mr\. (\w)\. (\w)\. (\w+) stayed\.", a)
    assert m, a
    john, smith, f_smith, jones, adams, brien, souza, upper, bare, bare_john, j, r, last = m.groups()
    assert smith == bare == last and upper == smith.upper() and john == bare_john and f_smith != smith
    assert not {"John", "Smith", "Jones", "Adams", "Brien", "Souza"} & set(m.groups()) and (j, r) != ("J", "R")
    assert len({john, smith, f_smith, jones, adams, brien, souza}) == 7
    assert smith[-1] in "nlrs" and f_smith[-2:] in ("na", "la", "ra", "sa") and adams[-1] in "kmtx"
    g = regex.fullmatch(r"Herr Dr\. (\w+) von der (\w+) traf Frau (\w+)\. Господин (\w+) и Госпожа (\w+)\.", b)
    assert g and g[2] != g[3] and regex.fullmatch(r"\p{Cyrillic}+", g[4] + g[5]) and g[5][-1] == "а" and "Heide" not in b
    assert c == f"{smith} without a title, Mr. {smith}'s and Mr {smith}"


def mod97(account):
    moved = account[4:] + account[:4]
    return int("".join(str(int(x, 36)) for x in moved)) % 97


def test_accounts_and_addresses(spark):
    a, b, c = one(spark, "pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432", "from fe80:0:0:0:1:2:3:4 or 2001:db8::8a2e:370:7334", "no account DE88 3704 0044 0532 0130 00, no address 12:30:45 a::b std::bad")
    x, y = regex.fullmatch(r"pay (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) or (GB\d\d[A-Z]{4}\d{14})", a).groups()
    assert mod97(x.replace(" ", "")) == mod97(y) == 1 and "3704" not in x and "WEST" not in y
    m = regex.fullmatch(r"from ([0-9a-f:]+) or ([0-9a-f:]+)", b)
    assert m and m[1].count(":") == 7 and "::" in m[2] and "8a2e" not in b
    assert c == "no account DE88 3704 0044 0532 0130 00, no address 12:30:45 a::b std::bad"


def test_every_private_address(spark):
    """All 65,536 addresses of a closed range: more than the range has replacements for."""
    df = spark.range(65_536).select(F.col("id").alias("doc_id"), F.concat(F.lit("host 192.168."), F.floor(F.col("id") / 256), F.lit("."), F.col("id") % 256).alias("text"))
    out = pii.surrogate_documents(df, "corpus")
    assert out.select("text").distinct().count() == 65_536 and out.join(df.select("text"), "text").isEmpty()


@pytest.mark.parametrize("n", [60_000])
def test_many_names(spark, n):
    rnd = random.Random(2)
    names = sorted({"".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)).capitalize() for _ in range(n)})
    df = spark.createDataFrame([(i, f"Mr. {x}") for i, x in enumerate(names)], "doc_id long, text string")
    out = pii.surrogate_documents(df, "corpus")
    assert out.select("text").distinct().count() == len(names) and out.join(df.select("text"), "text").isEmpty()


def test_short_forms_of_address(spark):
    texts = ["M. Dupont et Mme Curie.", "El Sr. García y la Srta. López.", "Mit Herrn Müller, Fr. Weber und Hr. Braun.", "J. M. Barrie. Fr. Is no name. Sra de la Torre", "Sir Newton, Mlle Lenoir, Госпоже Ивановой"]
    out = one(spark, *texts)
    for gone in ("Dupont", "Curie", "García", "López", "Müller", "Weber", "Braun", "Torre", "Newton", "Lenoir", "Ивановой"):
        assert not any(gone in t for t in out), gone
    for stays in ("M. ", " et Mme ", "El Sr. ", "Srta. ", "Mit Herrn ", "Fr. ", "Hr. ", "J. M. Barrie", "Sra de la "):
        assert any(stays in t for t in out), stays
    assert out[4].startswith("Sir ") and regex.search("Госпоже [А-Я][а-я]+а$", out[4])


def test_numbers_with_spaces_and_country_codes(spark):
    texts = ["SSN 123 45 6789", "call 555 123 4567", "+33 1 23 45 67 89 or 01 23 45 67 89", "+49 (30) 1234567, +34 912 345 678, +353 1 234 5678", "in 2020 12 3456 78 rows 1 234 567 of 100 200 3000 400; +1 2", "+33123456789"]
    out = one(spark, *texts)
    shape = lambda t: regex.sub("[0-9]", "9", t)
    assert [shape(t) for t in out] == [shape(t) for t in texts]
    assert out[4] == texts[4] and all(a != b for k, (a, b) in enumerate(zip(texts, out, strict=True)) if k != 4)
    assert out[2].startswith("+33 ") and " or 01 " in out[2] and out[3].startswith("+49 (") and "+34 9" not in out[3][:0] and ", +34 " in out[3] and ", +353 " in out[3]
    assert regex.sub("[^0-9]", "", out[2].split(" or ")[0]) == out[5][1:]


def test_the_key_is_the_session_s(spark):
    df = spark.createDataFrame([(1, "Mr Brown, 555-123-4567")], "doc_id long, text string")
    a, b, c = (pii.surrogate_documents(df, k).first().text for k in ("one", "two", "one"))
    assert a == c != b
    key = pii.session_key(spark)
    assert len(key) >= 32 and pii.session_key(spark) == key
