"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts, grouped by their commoner forms."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, store

#: Words of fewer code points, or seen less often, are left out.
SHORTEST, RAREST = 5, 3
#: A form must be so many times as common as its variant.
COMMONER = 2
#: One occurrence in so many, by hash, loses a code point.
SLIP = 97
#: Words of one block of a key; larger keys become a grid of such blocks.
BLOCK = 2048
#: Distinct words that a task holds before it hands on their counts.
HELD = 400_000
#: Pairs of one product that are held at a time.
PRODUCT = 1 << 22

#: Latin-1 bytes, in which a letter of the words is one byte with its code point's value; everything else is a space.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC0:] = True
_TABLE = bytes(b if _LETTER[b] else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF in Latin-1, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_TABLE).lower().split()


def slipped(word: bytes, doc: int, slip: int) -> bytes:
    """The word as this document spells it: without one code point where the hash of both says so. ``doc`` is the crc of what comes before the word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), doc)
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = SHORTEST, slip: int = SLIP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n for all words of at least ``shortest`` code points; counts are summed in the tasks before they are shuffled."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def run(batches):
        import pyarrow as pa

        held: Counter[bytes] = Counter()

        def out():
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for id_, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                doc = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for w, n in Counter(words_of(text)).items():
                    if len(w) >= shortest:
                        w = slipped(w, doc, slip)
                        if len(w) >= shortest:
                            held[w] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _cells(words: DataFrame, shortest: int, folder: str) -> DataFrame:
    """cell, word, n, own: the words that one product compares, a cell of two blocks at most.

    Two words one edit apart share their first or their last half: of the shorter one's l letters all but the edited one
    stand before or behind the edit. So a key is the shorter length, the side and l // 2 letters, and holds the words of
    l and of l + 1 letters, the adjacent length blocks. Keys of more than BLOCK words are dealt to blocks by hash, and
    every two blocks are a cell.
    """
    size = F.char_length("word")
    both = words.withColumn("l", F.explode(F.array(size, size - 1))).where(F.col("l") >= shortest)
    half = F.floor(F.col("l") / 2).cast("int")
    sides = F.array(F.concat(F.lit("<"), F.substring("word", F.lit(1), half)), F.concat(F.lit(">"), F.substring("word", F.col("l") * 0 - half, half)))
    keyed = both.withColumn("side", F.explode(sides)).select(F.concat(F.col("l").cast("string"), F.col("side")).alias("key"), "word", "n", "l")
    # Keys without a word of the shorter length have no pairs.
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    keys = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words"), F.max((F.char_length("word") == F.col("l")).cast("int")).alias("short"), blocks)
    keys = store(keys.where("words > 1 AND short = 1").select("key", "blocks"), folder, "keys")
    dealt = keyed.join(keys, "key").withColumn("own", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    grid = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.concat_ws(":", F.col("key"), F.least("own", "other"), F.greatest("own", "other"))
    return grid.select(cell.alias("cell"), "word", "n", "own")


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each word (a row of code points, 0 behind its end) holds each letter that occurs at all."""
    row, at = np.nonzero(codes)
    letter = codes[row, at].astype(np.int64)
    counts = np.bincount(row * 256 + letter, minlength=256 * len(codes)).reshape(-1, 256)
    return counts[:, counts.any(axis=0)].astype(np.float32)


def one_edit(short: np.ndarray, other: np.ndarray, size: int, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of words of ``size`` and, where ``longer``, size + 1 letters: whether one edit makes them equal, and their common first letters."""
    other = np.pad(other, ((0, 0), (0, max(0, size + 1 - other.shape[1]))))
    unlike = short[:, :size] != other[:, :size]
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), size)
    shifted = short[:, size - 1 :: -1] != other[:, size:0:-1]
    last = np.where(shifted.any(axis=1), shifted.argmax(axis=1), size)
    return np.where(longer, first + last >= size, unlike.sum(axis=1) == 1), first


def near_pairs(words: list[bytes], size: int, front: bool, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of one cell's words that are one edit apart, i of ``size`` letters.

    Products of the letter counts give all squared distances; one replaced letter makes it two, one more letter one.
    Pairs at two at most are verified. Of a pair that shares both halves the cell of the first half reports it; with ``own``,
    the block of each word, pairs across blocks alone count.
    """
    codes = np.array(words, "S").view(np.uint8).reshape(len(words), -1)
    length = np.count_nonzero(codes, axis=1)
    left = np.flatnonzero(length == size)
    c = letter_counts(codes)
    squares = (c * c).sum(axis=1)
    step = max(1, PRODUCT // len(words))
    out_i, out_j = [], []
    for k in range(0, len(left), step):
        i = left[k : k + step]
        # |a - b|^2 <= 2, as the product alone.
        near = 2 * (c[i] @ c.T) >= squares[i][:, None] + (squares - 2)
        a, j = np.nonzero(near)
        a = i[a]
        longer = length[j] > size
        fit = longer | (a < j)
        if own is not None:
            fit &= own[a] != own[j]
        a, j, longer = a[fit], j[fit], longer[fit]
        edit, first = one_edit(codes[a], codes[j], size, longer)
        if not front:
            edit &= first < size // 2
        out_i.append(a[edit])
        out_j.append(j[edit])
    return np.concatenate(out_i or [left]), np.concatenate(out_j or [left])


def _nearest(cells: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: for each word of a cell its near words there, counted, and the commonest of them."""

    def cell_rows(cell: str, words: list[bytes], n: np.ndarray, own: np.ndarray):
        key, one, two = cell.rsplit(":", 2)
        front = "<" in key
        i, j = near_pairs(words, int(key.split("<" if front else ">", 1)[0]), front, own if one != two else None)
        if not len(i):
            return None
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        # By falling n, ties by code points.
        order = np.array(sorted(range(len(words)), key=lambda k: (-int(n[k]), words[k])), np.int64)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        best = np.full(len(words), len(words), np.int64)
        np.minimum.at(best, a, place[b])
        count = np.bincount(a, minlength=len(words))
        hit = np.flatnonzero(count)
        form = order[best[hit]]
        return hit, count[hit], form

    def run(batches):
        import pyarrow as pa

        def whole(rows: list[list]):
            cells_, words, n, own = rows
            at = [k for k in range(len(cells_)) if not k or cells_[k] != cells_[k - 1]] + [len(cells_)]
            raw = [w.encode("latin-1") for w in words]
            n_, own_ = np.array(n, np.int64), np.array(own, np.int64)
            cols: list[list] = [[], [], [], []]
            for s, e in zip(at[:-1], at[1:], strict=True):
                if e - s > 1 and (found := cell_rows(cells_[s], raw[s:e], n_[s:e], own_[s:e])):
                    hit, count, form = found
                    cols[0] += [words[s + k] for k in hit.tolist()]
                    cols[1] += count.tolist()
                    cols[2] += n_[s + form].tolist()
                    cols[3] += [words[s + k] for k in form.tolist()]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], ["word", "n_near", "form_n", "form"])

        # Rows come sorted by cell: all but the last cell of what has come are whole.
        held: list[list] = [[], [], [], []]
        for b in batches:
            held = [x + b.column(k).to_pylist() for k, x in enumerate(held)]
            if held[0] and (cut := held[0].index(held[0][-1])):
                yield whole([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held[0]:
            yield whole(held)

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "word string, n_near long, form_n long, form string")


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root: the end of the chain of forms. Each round doubles the steps; as n at least doubles a step, a chain has log2(n) steps and few rounds suffice."""
    roots, k = store(forms.select("word", F.col("form").alias("root")), folder, "roots0"), 0
    while True:
        on = roots.toDF("root", "next")
        nxt = roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        nxt = store(nxt, folder, f"roots{k + 1}")
        discard(forms.sparkSession, folder, f"roots{k}")
        roots, k = nxt.drop("moved"), k + 1
        if nxt.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, commoner: int = COMMONER, slip: int = SLIP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, form, root, n (occurrences), n_near (words one edit away), form_n.

    Words are runs of Latin letters (to U+00FF), A-Z lower-cased, with the slips that ``slipped`` makes. A word's form is
    its commonest near word (ties: the first by code points) if that is ``commoner`` times as common at least; its root
    is where the forms lead. All words of the corpus are compared with all, through keys that no pair can miss; a cell
    of the grid holds 2 * BLOCK words at most, and pairs are folded to one row a word in the cell. Null texts have no
    words; texts and words of any length are read in whole; a null id counts as the empty string; repeated rows and
    repeated ids count each time; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    words = store(word_counts(docs, shortest, slip, id_col, text_col).where(F.col("n") >= rarest), folder, "words")
    found = _nearest(_cells(words, shortest, folder)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    joined = words.join(found, "word", "left")
    is_form = -F.col("best.less") >= commoner * F.col("n")
    named = store(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), folder, "named")
    roots = _roots(named.where("form IS NOT NULL").select("word", "form"), folder)
    discard(spark, folder, "words", "keys")
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
