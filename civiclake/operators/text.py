"""Text and page jobs with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.scalars import safe_bool
from civiclake.sources.scratch import materialize

#: Lines that open a section (capitals, numbered, SECTION, ARTICLE, PART), shorter than HEADING characters.
HEADINGS = (r"[A-Z][A-Z\s]{2,50}", r"\d+\.?\s+[A-Z][A-Za-z\s]+", r"SECTION\s+\d+[:\s].+", r"ARTICLE\s+\d+[:\s].+", r"PART\s+[A-Z0-9]+[:\s].+")
HEADING = 100
#: Characters of a stored body, sections of a stored document.
SECTION_BODY, SECTIONS = 5000, 100
#: Fixed value: one floor plan in a listing page's embedded data.
FLOOR_PLAN = r'(?s)"floorplanName":\[0,"([^"]+)"\].*?"maximumRent":\[0,(\d+)\].*?"minimumRent":\[0,(\d+)\].*?"sqft":\[0,(\d+)\].*?"unitStatus":\[0,"([^"]+)"'


#: Pages whose parts a task holds at once.
PAGES = 64


def clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"[^\P{C}]", ""))


def tokens(c: Column, stopwords: tuple[str, ...] = (), least: int = 2) -> Column:
    """Lower-case words of a letter or digit at least, without punctuation at their edges."""
    words = F.transform(F.split(F.lower(c), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    keep = lambda w: (F.length(w) >= least) & (~w.isin(*stopwords) if stopwords else F.lit(True))
    return F.filter(words, keep)


def sentences(c: Column) -> Column:
    return F.filter(F.split(c, r"(?<=[.!?])\s+"), lambda s: s != "")


def ngrams(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def top_ngrams(docs: DataFrame, n: int, top: int) -> DataFrame:
    """doc_id, gram, uses: the most frequent n-grams of each document.

    A document's n-grams are sorted and counted within its row, so only ids are shuffled; the texts of an id that several
    rows share count together, n-grams shuffled. Runs a job when called, which stores those ids.
    """
    several = materialize(docs.groupBy(F.col("doc_id").alias("_several")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_several"))
    grams = lambda df: df.select("doc_id", tokens(F.col("text")).alias("t")).select("doc_id", ngrams(F.col("t"), n).alias("g"))
    if several.isEmpty():
        return _row_ngrams(grams(docs), top)
    same = F.col("doc_id").eqNullSafe(F.col("_several"))
    rows = grams(docs.join(several, same, "left_semi")).select("doc_id", F.explode("g").alias("gram")).groupBy("doc_id", "gram").agg(F.count(F.lit(1)).alias("uses"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("uses"), "gram"))).where(F.col("place") <= top).drop("place")
    return _row_ngrams(grams(docs.join(several, same, "left_anti")), top).unionByName(rows)


def _row_ngrams(rows: DataFrame, top: int) -> DataFrame:
    """The most frequent of each row's n-grams ``g``: runs of the sorted array, by their lengths."""
    before = lambda x, i: F.when(~x.eqNullSafe(F.get("g", i - 1)), i)
    rows = rows.select("doc_id", F.array_sort("g").alias("g"))
    rows = rows.select("doc_id", "g", F.array_compact(F.transform("g", before)).alias("at"))
    run = lambda i, k: F.struct((i - F.coalesce(F.get("at", k + 1), F.size("g"))).alias("less"), F.get("g", i).alias("gram"))
    rows = rows.select("doc_id", F.inline(F.slice(F.array_sort(F.transform("at", run)), 1, top)))
    return rows.select("doc_id", "gram", (-F.col("less")).cast("long").alias("uses"))


def token_stats(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, tokens, distinct tokens, sentences, mean token length, mean tokens a sentence, and ``more`` over the document."""
    t = F.col("t")
    letters = F.aggregate(t, F.lit(0), lambda a, w: a + F.length(w))
    rows = docs.select("doc_id", tokens(F.col("text")).alias("t"), F.size(sentences(F.col("text"))).alias("n_sentences"), *more)
    return rows.select(*(c for c in rows.columns if c not in ("t", "n_sentences")), F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_unique"), "n_sentences", F.round(F.coalesce(F.try_divide(letters, F.size(t)), F.lit(0.0)), 4).alias("mean_length"), F.round(F.coalesce(F.try_divide(F.size(t), F.nullif("n_sentences", F.lit(0))), F.lit(0.0)), 4).alias("mean_sentence"))


def canonical_url(c: Column) -> Column:
    """Scheme and host in lower case, no fragment."""
    base = F.regexp_replace(c, r"#.*$", "")
    head = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.concat(F.lower(head), F.substring(base, F.length(head) + 1, F.length(base)))


def page_batches(batches):
    """Arrow batches of page_id, url and html to batches of their parts, ``PAGES`` pages each."""
    import pyarrow as pa

    from civiclake.functions.markup import page

    link = pa.list_(pa.struct([("href", pa.string()), ("told", pa.string())]))
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), link]
    for whole in batches:
        for at in range(0, whole.num_rows, PAGES):
            b = whole.slice(at, PAGES)
            found = [page(h) or (None,) * 5 for h in b.column("html").to_pylist()]
            cols = [pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *cols], ["page_id", "url", "title", "description", "headings", "text", "links"])


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, title, description, headings, visible text, links (array of href and told, the text within, in page order).

    Pages are cut into tokens in Arrow batches (``functions.markup``), one pass over each; a null page has nulls. A task
    holds the parts of ``PAGES`` pages beside the batch that it was given.
    """
    kind = dict(pages.dtypes)["page_id"]

    rows = pages.select("page_id", canonical_url(F.col("url")).alias("url"), "html")
    out = rows.mapInArrow(page_batches, f"page_id {kind}, url string, title string, description string, headings array<string>, text string, links array<struct<href: string, told: string>>")
    return out.withColumn("text", clean(F.col("text")))


def resolve(base: Column, link: Column) -> Column:
    """An address on a page made absolute: against its scheme, host or folder, without dot segments."""
    scheme, origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substring(page, F.length(origin) + 1, F.length(page))
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^.*/", 0), F.lit("")), F.lit("/"))
    full = F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.startswith("/"), F.concat(origin, link)).when(link.startswith("?"), F.concat(page, link)).otherwise(F.concat(origin, folder, link))
    head = F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    rest = F.substring(full, F.length(head) + 1, F.length(full))
    where, tail = F.regexp_extract(rest, r"^[^?#]*", 0), F.regexp_extract(rest, r"[?#].*$", 0)
    step = lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    flat = F.array_join(F.aggregate(F.split(where, "/"), F.array().cast("array<string>"), step), "/")
    flat = F.concat(flat, F.when(where.rlike(r"/\.{1,2}$") & ~flat.endswith("/"), "/").otherwise(""))
    return F.when((head != "") & where.rlike(r"(?:^|/)\.{1,2}(?:/|$)"), F.concat(head, flat, tail)).otherwise(full)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_links(pages: DataFrame) -> DataFrame:
    """page_id, url, place (from 0, on the page), link (absolute), kind (internal: the same host, external or pdf), told (its text).

    Anchors, scripts and mail are left out; of one address the first link stays. Narrow: a page's links stay in its row
    until they are unnested.
    """
    other = r"^(#|javascript:|mailto:|tel:|data:)|^$"
    given = F.filter(F.transform("links", lambda x: F.struct(F.trim(x["href"]).alias("raw"), x["told"].alias("told"))), lambda x: ~F.lower(x["raw"]).rlike(other))
    made = F.transform("given", lambda x: F.struct(canonical_url(resolve(F.col("url"), x["raw"])).alias("link"), x["told"].alias("told")))
    rows = page_parts(pages).select("page_id", "url", given.alias("given")).select("page_id", "url", made.alias("made")).withColumn("all", F.col("made.link"))
    first = F.filter("made", lambda x, i: F.array_position("all", x["link"]) == i + 1)
    rows = rows.select("page_id", "url", F.posexplode(first).alias("place", "x"))
    kind = F.when(F.lower("x.link").rlike(r"\.pdf($|\?)"), "pdf").when(host_of(F.col("x.link")) == host_of(F.col("url")), "internal").otherwise("external")
    return rows.select("page_id", "url", "place", "x.link", kind.alias("kind"), "x.told")


def capped_links(links: DataFrame, caps: dict[str, int]) -> DataFrame:
    """The first links of each page and kind, by their place on the page, up to the stored number of the kind."""
    limit = F.create_map(*(F.lit(x) for kv in caps.items() for x in kv))
    nth = F.row_number().over(Window.partitionBy("page_id", "kind").orderBy("place", "link"))
    return links.withColumn("nth", nth).where(F.col("nth") <= F.coalesce(F.try_element_at(limit, F.col("kind")), F.lit(1 << 30))).drop("nth")


def allowed(links: DataFrame, own: str, link: str, hosts: DataFrame, prefix: str = "/") -> DataFrame:
    """Links on the page's own host, or between two hosts of the list (column ``host``), whose path begins with ``prefix``."""
    a, b = (hosts.select(F.lower("host").alias(f"{n}_host")).distinct().withColumn(f"{n}_listed", F.lit(True)) for n in ("own", "link"))
    rows = links.withColumns({"own_host": host_of(F.col(own)), "link_host": host_of(F.col(link))}).join(a, "own_host", "left").join(b, "link_host", "left")
    path = F.regexp_extract(link, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    near = (F.col("own_host") == F.col("link_host")) | (F.coalesce("own_listed", F.lit(False)) & F.coalesce("link_listed", F.lit(False)))
    return rows.where(near & F.when(path == "", F.lit("/")).otherwise(path).startswith(prefix)).select(*links.columns)


def attachment_name(url: Column, text: Column) -> Column:
    """The PDF name at the end of the address's path, else one in the link's text, else a name from the address's hash."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    own = F.when(path.endswith(".pdf"), F.substring_index(path, "/", -1))
    told = F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?i)[\w-]+\.pdf", 0), F.lit(""))
    return F.coalesce(own, told, F.concat(F.lit("attachment_"), F.substring(F.md5(url), 1, 8), F.lit(".pdf")))


#: Patterns that tell drawings from other files by name or link text.
DRAWINGS = (
    r"drawing", r"dwg", r"cad", r"plan[s]?\s*(sheet|set)", r"architectural\s*plan", r"structural\s*plan", r"mep\s*plan", r"civil\s*plan",
    r"floor\s*plan", r"site\s*plan", r"elevation", r"section\s*view", r"detail\s*sheet", r"[A-Z]\d{3}",
)


def is_drawing(name: Column, text: Column | None = None) -> Column:
    """Whether a file's name or its link's text tells a drawing."""
    both = F.concat_ws(" ", name, text if text is not None else F.lit(""))
    return both.rlike("(?i)" + "|".join(f"(?:{p})" for p in DRAWINGS))


def service_metadata(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with name, layer_id, geometry_type, n_fields, feature_count and limited of a service's JSON description; null where it has none."""
    at = lambda k: F.get_json_object(column, f"$.{k}")
    return rows.withColumns({
        "name": at("name"), "layer_id": at("id").try_cast("int"), "geometry_type": at("geometryType"), "n_fields": F.coalesce(F.json_array_length(at("fields")), F.lit(0)),
        "feature_count": F.coalesce(F.json_array_length(at("features")).cast("bigint"), at("count").try_cast("bigint")), "limited": F.coalesce(safe_bool(at("exceededTransferLimit")), F.lit(False)),
    })


#: English words that search tokens leave out.
STOPWORDS = (
    "a", "an", "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "as", "is",
    "was", "are", "were", "been", "be", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should",
    "may", "might", "must", "shall", "can", "need", "this", "that", "these", "those", "it", "its", "they", "them",
    "their", "we", "us", "our", "you", "your", "he", "she", "his", "her", "not", "no", "all", "any", "some", "each",
    "every", "both", "few", "more", "most", "other", "into", "through", "during", "before", "after", "above", "below",
    "between", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "what",
    "which", "who", "whom", "if", "because", "until", "while", "about", "against", "over", "such", "only", "own",
    "same", "so", "than", "too", "very", "just", "also", "now", "per",
)


def search_tokens(docs: DataFrame, stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    """doc_id, token, uses: tokens without stop words, for an inverted index."""
    return docs.select("doc_id", F.explode(tokens(F.col("text"), stopwords)).alias("token")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("uses"))


def document_table(docs: DataFrame, parent: str | None = None, most_tokens: int | None = 10_000, most_sentences: int | None = 1000) -> DataFrame:
    """One row a document: its id and parent's, digest, sizes, and its first tokens and sentences, as stored; None keeps all."""
    t, s = tokens(F.col("text")), sentences(F.col("text"))
    rows = docs.select("doc_id", (F.col(parent) if parent else F.lit(None).cast("string")).alias("parent_id"), F.sha2("text", 256).alias("content_hash"), F.length("text").alias("n_chars"), t.alias("t"), s.alias("s"))
    return rows.select("doc_id", "parent_id", "content_hash", "n_chars", F.size("t").alias("n_tokens"), F.size("s").alias("n_sentences"), (F.slice("t", 1, most_tokens) if most_tokens else F.col("t")).alias("tokens"), (F.slice("s", 1, most_sentences) if most_sentences else F.col("s")).alias("sentences"))


def file_type(content: Column) -> Column:
    """pdf, office (a zip with office parts), zip, ole or unknown, by the leading bytes."""
    head = F.hex(F.substring(content, 1, 8))
    office = F.contains(F.hex(F.substring(content, 1, 4096)), F.hex(F.lit("[Content_Types]")))
    return F.when(head.startswith("25504446"), "pdf").when(head.startswith("504B0304"), F.when(office, "office").otherwise("zip")).when(head.startswith("D0CF11E0"), "ole").otherwise("unknown")


def sections(docs: DataFrame, body: int | None = SECTION_BODY, most: int | None = SECTIONS) -> DataFrame:
    """doc_id, place (from 0), heading, content: text under heading lines; sections without content and text before the first heading are left out.

    Narrow: each document's lines stay in one array. ``body`` and ``most`` bound what is stored; None keeps all.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    opens = lambda x: (F.length(x) < HEADING) & x.rlike("^(?:" + "|".join(HEADINGS) + r")\z")
    heads = F.filter(F.transform("lines", lambda x, i: F.when(opens(x), i + 1)), lambda i: i.isNotNull())
    end = lambda k: F.coalesce(F.get("heads", k + 1), F.size("lines") + 1)
    part = lambda i, k: F.struct(F.element_at("lines", i).alias("heading"), F.array_join(F.slice("lines", i + 1, end(k) - i - 1), "\n").alias("content"))
    found = F.filter(F.transform("heads", part), lambda s: s["content"] != "")
    rows = docs.select("doc_id", lines.alias("lines")).withColumn("heads", heads).select("doc_id", (F.slice(found, 1, most) if most else found).alias("s"))
    rows = rows.select("doc_id", F.posexplode("s").alias("place", "s"))
    return rows.select("doc_id", "place", "s.heading", (F.substring("s.content", 1, body) if body else F.col("s.content")).alias("content"))


def reach(links: DataFrame, seeds: DataFrame, depth: int = 3) -> DataFrame:
    """url, depth: pages within ``depth`` links (source, target) of the seeds (url), each once at its smallest depth.

    Every page also links to itself at no cost, so a step is one join and one grouped minimum and the plan grows by
    the same amount a step. Link tables are grouped by target before the next join, which folds hubs early.
    """
    hops = links.select("source", "target", F.lit(1).alias("cost")).where("source <> target").distinct()
    known = seeds.select("url").unionByName(links.select(F.col("source").alias("url"))).unionByName(links.select(F.col("target").alias("url"))).distinct()
    # Stored, as every step reads them.
    hops = materialize(hops.unionByName(known.select(F.col("url").alias("source"), F.col("url").alias("target"), F.lit(0).alias("cost"))))
    out = seeds.select("url", F.lit(0).alias("depth")).where("url IS NOT NULL").distinct()
    for _ in range(depth):
        out = out.join(hops, F.col("url") == F.col("source")).groupBy(F.col("target").alias("url")).agg(F.min(F.col("depth") + F.col("cost")).alias("depth"))
    return out


def floor_plans(pages: DataFrame) -> DataFrame:
    """page_id, unit_number, floor_plan_name, price, max_price, sqft, status, bedrooms of embedded listing data."""
    html = F.replace(F.replace("html", F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    names = ("name", "high", "low", "sqft", "status")
    groups = [F.regexp_extract_all("html", F.lit(FLOOR_PLAN), F.lit(k + 1)).alias(n) for k, n in enumerate(names)]
    rows = pages.select("page_id", html.alias("html")).select("page_id", *groups).select("page_id", F.posexplode(F.arrays_zip(*names)).alias("i", "p"))
    first = F.upper(F.substring("p.name", 1, 1))
    bedrooms = F.when(first == "S", 0).when(first == "A", 1).when(first == "B", 2).when(first == "C", 3)
    whole = lambda c: F.col(c).try_cast("bigint")
    return rows.select("page_id", F.concat_ws("-", "p.name", F.col("i") + 1).alias("unit_number"), F.col("p.name").alias("floor_plan_name"), whole("p.low").alias("price"), whole("p.high").alias("max_price"), whole("p.sqft").alias("sqft"), F.col("p.status").alias("status"), bedrooms.alias("bedrooms"))
