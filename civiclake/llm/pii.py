"""Personal data: keyed surrogates of the same type, format, script and gender, distinct and the same everywhere (native)."""

from __future__ import annotations

import secrets
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, scratch, store, text_of

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Forms of address, which names are found after, by gender.
MALE = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин", "Господина", "Господину")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta", "Doña", "Госпожа", "Госпожи", "Госпоже")
EITHER = ("Dr", "Dra", "Prof", "Professor", "Mx", "Доктор")
#: Those that are a form of address with a full stop only; behind a single capital they are an initial.
DOTTED_MALE, DOTTED_FEMALE = ("M", "Hr"), ("Fr",)
TITLES = tuple(sorted(MALE + FEMALE + EITHER, key=len, reverse=True))
#: Small words inside a name, which stay.
PARTICLES = ("de", "la", "le", "del", "della", "di", "da", "do", "dos", "du", "van", "von", "der", "den", "ter", "zu", "zur", "af", "al", "bin", "ibn", "y")
_DOTTED = rf"(?<!\p{{Lu}}\. )(?:{'|'.join(DOTTED_MALE + DOTTED_FEMALE)})\. (?=\p{{Lu}}[\p{{L}}'’]{{2}})"
_ADDRESS = rf"(?:(?:{'|'.join(TITLES)})\.? |{_DOTTED})+"
#: Country codes of one and two digits; all others have three.
_COUNTRY = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_INNER = rf"(?:\p{{Lu}}\. ?|(?:{'|'.join(PARTICLES)}) |[dDlL]['’])*"
#: A form of address behind a name begins the next one.
_NAME_WORD = rf"(?!(?:{'|'.join(TITLES + DOTTED_MALE + DOTTED_FEMALE)})\.? )" + r"\p{Lu}[\p{L}\p{M}]*+(?:['’]\p{Lu}[\p{L}\p{M}]+|-[\p{L}\p{M}]+)*+"
#: What is found, in order of precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "ipv6": rf"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,6}}|{_HEX}:(?::{_HEX}){{2,6}}|(?:{_HEX}:){{3,7}}:)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9-])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])(?<![0-9] )[0-9]{3}(?:-[0-9]{2}-| [0-9]{2} )[0-9]{4}(?![0-9-]| [0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z+])(?<![0-9] )[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9]| [0-9])",
    "intl": r"(?<![0-9A-Za-z+])(?<![0-9] )(?:\+[1-9][0-9]{0,2}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,6}|0[1-9](?:[ .-][0-9]{2}){4})(?![0-9]|[ .-][0-9])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}}){_ADDRESS}{_INNER}{_NAME_WORD}(?: {_INNER}{_NAME_WORD}){{0,3}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: In texts with a titled name, words with a capital are looked up too: they may repeat the name.
ANY_OR_WORD = ANY + r"|(?<![\p{L}\p{M}@._%+-])\p{Lu}[\p{L}\p{M}]+(?![\p{L}\p{M}])"
#: The words of a name; a letter with its apostrophe goes by itself.
LETTERS = r"\p{L}['’](?=\p{Lu})|[\p{L}\p{M}]+"
#: A text without any of these holds no entity; a plain scan for them is cheap.
HINT = "[0-9@]|" + "|".join(TITLES + tuple(rf"{t}\." for t in DOTTED_MALE + DOTTED_FEMALE)) + "|[a-fA-F]{32}"
#: Syllables that surrogate names are made of, by script; the last one tells the gender: male, female, either.
SYLLABLES = {
    "latin": ("ba be bo da de di fa fe ga go ha ho ja jo ka ke ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te to va ve vi wa we".split(), "n l r s".split(), "na la ra sa".split(), "k m t x".split()),
    "cyrillic": ("ба бе бо ва ве ви га го да де ди жа за зе ка ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се та те то".split(), "н л р с".split(), "на ла ра са".split(), "к м т х".split()),
}
#: After so many draws the pool of a replacement grows: names and mail boxes get longer, closed formats wider.
DRAWS = 2


def kind_of(entity: Column) -> Column:
    """The kind of an entity; null where an account number's check digits, or the length of a number with a country code, don't fit."""
    out = F.when(entity.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    for kind, pattern in list(PATTERNS.items())[1:]:
        out = out.when(entity.rlike(f"^(?:{pattern})$"), kind)
    account = F.regexp_replace(entity, " ", "")
    n_digits = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    out = F.when((out == "intl") & ~n_digits.between(8, 15), None).otherwise(out)
    return F.when((out == "iban") & (_mod97(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))) != 1), None).otherwise(out)


def is_name(entity: Column) -> Column:
    return entity.rlike(f"^{_ADDRESS}")


def name_class(entity: Column) -> Column:
    """m, f or n by the forms of address in front of a name."""
    title = F.regexp_extract(entity, f"^{_ADDRESS}", 0)
    has = lambda names: title.rlike(rf"(?<!\p{{L}})(?:{'|'.join(names)})(?!\p{{L}})")
    return F.when(has(MALE + DOTTED_MALE), "m").when(has(FEMALE + DOTTED_FEMALE), "f").otherwise("n")


def _stays(word: Column) -> Column:
    """Words of a name that are no names: forms of address, particles, O' and d', and single small letters."""
    return word.isin(*TITLES, *DOTTED_MALE, *DOTTED_FEMALE, *PARTICLES) | word.rlike("['’]$") | ((F.length(word) == 1) & (word == F.lower(word)))


def canonical(kind: Column, entity: Column) -> Column:
    """What is the same number or key in all its written forms."""
    return F.when(kind.isin("phone", "intl", "card", "ssn"), F.regexp_replace(entity, "[^0-9]", "")).when(kind == "iban", F.regexp_replace(entity, " ", "")).otherwise(F.lower(entity))


def _chars(s: Column, change) -> Column:
    """``s`` with each character changed by change(character, its number from 1)."""
    return F.when(F.length(s) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: change(F.substring(s, i, F.lit(1)), i)), "")).otherwise("")


def _byte(h: Column, i) -> Column:
    """Byte i of a hex digest, taken around in a ring."""
    return F.conv(F.substring(h, (i * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")


def _reshape(s: Column, h: Column) -> Column:
    """Small letters, capitals and digits redrawn, all else kept."""

    def change(c: Column, i: Column) -> Column:
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _byte(h, i) % 26 + 1, F.lit(1))
        return F.when(c.rlike("[a-z]"), letter).when(c.rlike("[A-Z]"), F.upper(letter)).when(c.rlike("[0-9]"), (_byte(h, i) % 10).cast("string")).otherwise(c)

    return _chars(s, change)


def luhn(digits: Column) -> Column:
    """The check digit that belongs behind 15 digits."""
    at = lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(15)), at), F.lit(0), lambda a, x: a + F.floor(x / 10).cast("int") + x % 10)
    return (10 - total % 10) % 10


def _mod97(s: Column) -> Column:
    """Remainder by 97 of digits and capitals, a capital as two digits from A = 10."""
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.substring(s, i, F.lit(1))), F.lit(0), step)


def surrogate(kind: Column, canon: Column, key: str, attempt: int) -> Column:
    """The keyed replacement of a canonical entity: the same for the same key, entity and attempt.

    Later attempts draw from larger pools: one syllable or three letters more every DRAWS attempts, 192.168.x.y from
    10.x.y.z and that from any address, a 555 number and a social security number from all of its length.
    """
    grown = attempt // DRAWS
    h = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, F.lit(str(attempt))), 256)
    digits = F.translate(h, "abcdef", "012345")
    n = F.length(canon)
    lead = lambda at: (_byte(h, F.lit(at)) % 8 + 2).cast("string")
    middle = F.when((F.substring(canon, n - 6, F.lit(3)) == "555") & F.lit(not grown), F.lit("555")).otherwise(F.concat(lead(20), F.substring(digits, 5, 2)))
    phone = F.concat(F.substring(canon, F.lit(1), n - 10), lead(10), F.substring(digits, 3, 2), middle, F.substring(digits, 7, 4))
    country = F.regexp_extract(canon, f"^(0[1-9]|{_COUNTRY})", 1) if grown < 4 else F.substring(canon, 1, 1)
    intl = F.substring(F.concat(country, lead(12), F.substring(digits, 17, 15)), F.lit(1), n)
    body = F.concat(F.substring(canon, 1, 1), F.substring(digits, 1, 14))
    offset = F.substring(canon, 16, 1).cast("int") - luhn(F.substring(canon, 1, 15)) + 10
    card = F.concat(body, ((luhn(body) + offset) % 10).cast("string"))
    ssn = F.substring(digits, 1, 9) if grown else F.concat(F.lit("9"), F.substring(digits, 1, 8))
    near = F.regexp_extract(canon, r"^(10\.|127\.|192\.168\.)", 1)
    if grown:
        near = F.when((near == "192.168.") & F.lit(grown < 8), "10.").when(F.lit(grown < 8), near).otherwise("")
    octet = lambda at: (_byte(h, F.lit(at)) % 254 + 1).cast("string")
    far = F.concat_ws(".", (_byte(h, F.lit(0)) % 100 + 11).cast("string"), octet(1), octet(2), octet(3))
    ip = F.when(near == "", far).when(near == "192.168.", F.concat(near, octet(2), F.lit("."), octet(3))).otherwise(F.concat(near, octet(1), F.lit("."), octet(2), F.lit("."), octet(3)))
    if grown:
        ipv6 = F.concat(F.lit("fd"), F.substring(h, 1, 2), *(x for k in range(7) for x in (F.lit(":"), F.substring(h, 4 * k + 5, 4))))
    else:
        ipv6 = _chars(canon, lambda c, i: F.when(c == ":", c).otherwise(F.substring(h, (i * 3) % 63 + 1, F.lit(1))))
    domain = F.substring_index(canon, "@", -1)
    of_domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    email = F.concat(_reshape(F.substring_index(canon, "@", 1), h), F.translate(F.substring(F.sha2(h, 256), 1, 3 * grown), "0123456789", "ghijklmnop"), F.lit("@"), _reshape(F.substring_index(domain, ".", 1), of_domain), F.lit(".example."), F.substring_index(domain, ".", -1))
    secret = F.substring(F.concat(h, F.sha2(h, 256)), F.lit(1), n)
    account = _reshape(F.substring(canon, F.lit(5), n), h)
    check = 98 - _mod97(F.concat(account, F.substring(canon, 1, 2), F.lit("00")))
    iban = F.concat(F.substring(canon, 1, 2), F.lpad(check.cast("string"), 2, "0"), account)

    def name(script: str) -> Column:
        lists = [F.array(*map(F.lit, x)) for x in SYLLABLES[script]]
        sizes = [len(x) for x in SYLLABLES[script]]
        pick = lambda j, at: F.element_at(lists[j], _byte(h, F.lit(at)) % sizes[j] + 1)
        longer = [pick(0, 9 + j) for j in range(grown)]
        return F.concat(pick(0, 1), pick(0, 2), *longer, F.when(canon.startswith("m:"), pick(1, 3)).when(canon.startswith("f:"), pick(2, 3)).otherwise(pick(3, 3)))

    person = F.when(canon.rlike(r"[Ѐ-ӿ]"), name("cyrillic")).otherwise(name("latin"))
    out = F.when(kind == "phone", phone).when(kind == "intl", intl).when(kind == "card", card).when(kind == "ssn", ssn).when(kind == "ip", ip).when(kind == "ipv6", ipv6)
    return out.when(kind == "email", email).when(kind == "secret", secret).when(kind == "iban", iban).otherwise(person)


def render(kind: Column, entity: Column, new: Column) -> Column:
    """A canonical surrogate in the written form of ``entity``: its grouping, its case."""

    def spread(sign: str) -> Column:
        return _chars(entity, lambda c, i: F.when(c.rlike(sign), F.substring(new, F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), f"[^{sign[1:]}", "")), F.lit(1))).otherwise(c))

    cased = F.when((entity == F.upper(entity)) & (entity != F.lower(entity)), F.upper(new)).otherwise(new)
    return F.when(kind.isin("phone", "intl", "card", "ssn"), spread("[0-9]")).when(kind == "iban", spread("[0-9A-Z]")).when(kind.isin("ip", "name"), new).otherwise(cased)


def surrogate_table(entities: DataFrame, key: str, folder: str) -> DataFrame:
    """(kind, canon, new) for distinct (kind, canon): replacements are distinct and none is an entity of the input.

    Candidates are drawn together; of those that share a replacement the first entity keeps it, and these losers, and
    candidates equal to an entity or to a replacement given before, draw again, from pools that grow until all are
    served. Each round is one grouped pass over the entities still open.
    """
    known = store(entities.distinct(), folder, "entities")
    open_, done = known, None
    for attempt in count():
        drawn = open_.select("kind", "canon", surrogate(F.col("kind"), F.col("canon"), key, attempt).alias("new"))
        first = Window.partitionBy("kind", "new").orderBy("canon")
        taken = known.select("kind", F.when(F.col("kind") == "name", F.substring("canon", F.lit(3), F.length("canon"))).otherwise(F.col("canon")).alias("new"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "new"))
        drawn = drawn.withColumn("n", F.row_number().over(first)).join(taken.withColumn("taken", F.lit(True)).distinct(), ["kind", "new"], "left")
        drawn = store(drawn.select("kind", "canon", "new", ((F.col("n") == 1) & F.col("taken").isNull()).alias("good")), folder, f"draw{attempt}")
        good = drawn.where("good").drop("good")
        done = good if done is None else done.unionByName(good)
        open_ = drawn.where("NOT good").select("kind", "canon")
        if open_.isEmpty():
            return done


def _initial(letter: Column, key: str) -> Column:
    """A capital moved on in its alphabet by a keyed number of places, never none."""
    import hashlib

    at = hashlib.sha256(key.encode()).digest()[0]
    alphabets = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")
    moved = [a[(k := at % (len(a) - 1) + 1) :] + a[:k] for a in alphabets]
    return F.translate(letter, "".join(alphabets), "".join(moved))


def session_key(spark: SparkSession) -> str:
    """The secret that replacements depend on: the session's setting ``spark.civiclake.pii.key``.

    Who has it can redo the table of replacements, so it is in no source. A session without it gets a random one, which
    it keeps: its replacements agree with one another and with those of no other session.
    """
    key = spark.conf.get("spark.civiclake.pii.key", None)
    if not key:
        key = secrets.token_hex(16)
        spark.conf.set("spark.civiclake.pii.key", key)
    return key


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with each detected entity of ``text_col`` replaced; ``count_col`` adds the number of replacements.

    Same entity, same replacement, in all documents and written forms; different entities, different replacements.
    A name is all that follows a form of address: given names, initials, particles, compound names; each of its words
    has its own replacement of the form of address's gender, and words with a capital that repeat one elsewhere in the
    document follow it. Other entities are addresses, numbers and keys, as PATTERNS lists them; account numbers count
    only with right check digits.

    Texts are matched once and stored with what was found. Those without an entity, null and empty ones are read back
    unchanged; the others are exploded to their distinct entities, joined to the table of replacements and put together
    again. A very frequent entity is a skewed key of a join that adaptive execution splits. Repeated rows are kept
    apart by a row number; null ids and other columns, whatever their names, ride along; an empty table stays empty.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    row, ents, has, map_ = fresh(docs, "row_number", "entities", "marked", "replacements")
    text = F.col(text_col)
    marked = docs.withColumn(ents, F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    marked = marked.withColumn(has, F.coalesce(F.size(ents), F.lit(0)) > 0).withColumn(row, F.monotonically_increasing_id())
    marked = store(marked, folder, "marked")
    found, clean = marked.where(F.col(has)), marked.where(~F.col(has)).select(*docs.columns)

    each = found.select(F.col(row).alias("row"), F.explode(F.array_distinct(ents)).alias("entity")).withColumn("kind", kind_of(F.col("entity"))).where("kind IS NOT NULL")
    named = F.col("kind") == "name"
    words = F.filter(F.regexp_extract_all("entity", F.lit(LETTERS), F.lit(0)), lambda w: (F.length(w) > 1) & ~_stays(w))
    person = F.transform(words, lambda w: F.concat(name_class(F.col("entity")), F.lit(":"), F.lower(w)))
    each = each.withColumn("canon", F.explode(F.when(named, person).otherwise(F.array(canonical(F.col("kind"), F.col("entity"))))))
    table = surrogate_table(each.select("kind", "canon"), key, folder)
    pairs = each.join(table, ["kind", "canon"]).select("row", F.when(named, F.col("canon")).otherwise(F.col("entity")).alias("entity"), render(F.col("kind"), F.col("entity"), F.col("new")).alias("new"))
    maps = pairs.groupBy(F.col("row").alias(row)).agg(F.map_from_entries(F.collect_set(F.struct("entity", "new"))).alias(map_))

    known = F.col(map_)
    case = lambda w, new: F.when((w == F.upper(w)) & (F.length(w) > 1), F.upper(new)).when(w == F.lower(w), new).otherwise(F.initcap(new))
    look = lambda c, w: F.try_element_at(known, F.concat(c, F.lit(":"), F.lower(w)))
    part = lambda c, w: F.when(_stays(w), w).when(F.length(w) == 1, _initial(w, key)).otherwise(F.coalesce(case(w, look(c, w)), w))
    glue = lambda pieces, kept: F.array_join(F.zip_with(pieces, kept, lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), "")
    whole = lambda e: glue(F.split(e, LETTERS, -1), F.transform(F.regexp_extract_all(e, F.lit(LETTERS), F.lit(0)), lambda w: part(name_class(e), w)))
    bare = lambda w: case(w, F.coalesce(*(look(F.lit(c), w) for c in "mfn")))
    new = lambda e: F.when(is_name(e), whole(e)).otherwise(F.coalesce(F.try_element_at(known, e), bare(e), e))
    people = F.exists(ents, is_name)
    tokens = F.when(people, F.regexp_extract_all(text, F.lit(ANY_OR_WORD), F.lit(0))).otherwise(F.col(ents))
    pieces = F.when(people, F.split(text, ANY_OR_WORD, -1)).otherwise(F.split(text, ANY, -1))
    changed = found.join(maps, row, "left").withColumn(map_, F.coalesce(map_, F.create_map().cast("map<string,string>")))
    # Both at once: the texts' pieces take the place of the mark.
    changed = changed.withColumns({ents: F.transform(tokens, lambda e: F.struct(e.alias("old"), new(e).alias("new"))), has: pieces})
    changed = changed.withColumn(text_col, glue(F.col(has), F.col(f"{ents}.new")))
    if count_col:
        changed = changed.withColumn(count_col, F.size(F.filter(ents, lambda e: e["old"] != e["new"])).cast("long"))
        clean = clean.withColumn(count_col, F.lit(0).cast("long"))
    return clean.unionByName(changed.drop(row, ents, has, map_))


def surrogate_documents(docs: DataFrame, key: str) -> DataFrame:
    """Per document: doc_id, text with replacements, n_entities, text_sha256. Rows as in ``replace_entities``."""
    out = replace_entities(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key, count_col="n_entities")
    return out.withColumn("text_sha256", F.sha2(text_of(), 256))
