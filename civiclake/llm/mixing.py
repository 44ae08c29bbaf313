"""Mixing sources to target weights: repetition rates by source, whole repeats and one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, discard, fresh, partitions, scratch, store, text_of

WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MOST = 3
#: Bits of the hash that a coin takes.
COIN_BITS = 52
SEED = "mix"


def text_words(text: Column) -> Column:
    """Runs of other characters than ASCII white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def weighted(sources: DataFrame, weights: tuple[int, ...], folder: str) -> DataFrame:
    """``sources`` (source, n) with a weight each: the given ones in turn by the source's code points, null last.

    A range shuffle sorts the sources; the place of a row is its place in its partition plus the rows of all partitions
    before, so only one count a partition reaches the driver and no task sees all sources.
    """
    spark = sources.sparkSession
    last = F.col("source").isNull()
    dealt = sources.repartitionByRange(partitions(spark), last, F.col("source")).sortWithinPartitions(last, "source")
    dealt = dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    dealt = store(dealt, folder, "ordered")
    before, total = [], 0
    for part, n in sorted(map(tuple, dealt.groupBy("part").count().collect())):
        before.append((part, total % len(weights)))
        total += n
    starts = spark.createDataFrame(before, "part int, start int")
    turn = F.pmod(F.col("at") + F.col("start"), F.lit(len(weights))).cast("int")
    return dealt.join(F.broadcast(starts), "part").select("source", "n", F.element_at(F.array(*(F.lit(w) for w in weights)), turn + 1).cast("long").alias("weight"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (source, n, weight) with the words that each is to give: shares of all words by weight, ``most`` times n at most.

    What a capped source can't take is shared out again by weight. Each round is one aggregate of one row: the sources
    above their cap give it up to the rest, whose common level rises, until no further source is above. The level is a
    quotient of whole numbers, so the targets don't depend on the order of rows.
    """
    cap = F.col("n") * most
    total = sources.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    spent, level = -1, (total, 0)
    full = F.lit(False)
    while True:
        row = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if row[0] == spent or not row[1]:
            break
        spent, level = row[0], (total - row[0], row[1])
        # Whole numbers: cap < weight * level.
        full = cap.cast("decimal(38,0)") * level[1] < F.col("weight").cast("decimal(38,0)") * level[0]
    share = F.col("weight").cast("double") * F.lit(float(level[0])) / F.lit(float(level[1] or 1))
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(share))


def coin(identity: Column, seed: str) -> Column:
    """A number in [0, 1) by the hash of a seed and a row's identity, the same on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")), 1, COIN_BITS // 4)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(1 << COIN_BITS)


def mixing_rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, size) to one row a source: source, source_size, weight, target and rate (target by size).

    A source without words, as of null texts alone, has target and rate 0. An empty table has no sources.
    """
    spark, folder = sizes.sparkSession, scratch(sizes.sparkSession)
    sums = store(sizes.groupBy("source").agg(F.sum("size").alias("n")), folder, "sources")
    out = targets(store(weighted(sums, weights, folder), folder, "weights"), most)
    rate = F.when(F.col("n") > 0, F.col("target") / F.col("n")).otherwise(F.lit(0.0))
    rates = store(out.select("source", F.col("n").alias("source_size"), "weight", "target", rate.alias("rate")), folder, "rates")
    discard(spark, folder, "sources", "ordered", "weights")
    return rates


def times(rate: Column, identity: Column, seed: str) -> Column:
    """How often a row is taken: floor(rate) times, and once more where its coin falls below the fraction."""
    whole = F.floor(rate)
    return whole + F.when(coin(F.coalesce(identity.cast("string"), F.lit("")), seed) < rate - whole, 1).otherwise(0)


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, source, size (words), source_size, weight, target and rate of its source, copies, taken (size * copies).

    As no rate is above ``most``, no document is taken more often. Texts are read once and never shuffled; their sizes
    are stored. The join with the sources is left to size estimates; where it shuffles, a hot source, null included, is
    a key that adaptive execution splits. Null and empty texts have size 0, long ones count in whole; rows with a null
    id share one coin, as repeated rows of an id do; other columns, whatever their names, are ignored; an empty table
    gives no rows.
    """
    folder = scratch(docs.sparkSession)
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), text_words(text_of(text_col)).alias("size"))
    sizes = store(sizes, folder, "sizes")
    # Renamed, as a join on a null-safe key keeps both sides.
    rates = mixing_rates(sizes.select("source", "size"), weights, most).withColumnRenamed("source", "its_source")
    copies = times(F.col("rate"), F.col("doc_id"), seed).cast("long")
    planned = sizes.join(rates, F.col("source").eqNullSafe(F.col("its_source")), "left").withColumn("copies", copies)
    return planned.select("doc_id", "source", "size", "source_size", "weight", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", copy_col: str = "copy") -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as ``mixing_plan`` takes it, and the number of the copy from 1.

    The edge cases are those of ``mixing_plan``; ``copy_col`` gets another name where ``docs`` has it.
    """
    its_source, rate, copy = fresh(docs, "its_source", "rate", copy_col)
    sizes = docs.select(F.col(source_col).cast("string").alias("source"), text_words(text_of(text_col)).alias("size"))
    rates = mixing_rates(sizes, weights, most).select(F.col("source").alias(its_source), F.col("rate").alias(rate))
    n = times(F.col(rate), F.col(id_col), seed).cast("int")
    joined = docs.join(rates, F.col(source_col).cast("string").eqNullSafe(F.col(its_source)), "left").where(n > 0)
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), n)).alias(copy))


#: DuckDB: the same rows. The level is that of the first sources by cap and weight that leaves the next one below its cap.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, coalesce(sum(3 * n) OVER before, 0) AS spent, sum(w) OVER whole - coalesce(sum(w) OVER before, 0) AS heavy, sum(n) OVER whole AS total FROM s
  WINDOW before AS (ORDER BY 3 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), whole AS (ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min(total - spent, spent) AS up, arg_min(heavy, spent) AS down FROM o WHERE 3 * n * heavy >= w * (total - spent)),
t AS (SELECT s.*, CASE WHEN CAST(3 * n AS HUGEINT) * down < CAST(w AS HUGEINT) * up THEN CAST(3 * n AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(up AS DOUBLE) / CAST(down AS DOUBLE) END AS target FROM s, l),
r AS (SELECT *, CASE WHEN n > 0 THEN target / n ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.source, d.size, r.n AS source_size, CAST(r.w AS BIGINT) AS weight, r.target, r.rate, c.copies, d.size * c.copies AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source,
LATERAL (SELECT CAST(floor(r.rate) AS BIGINT) + CASE WHEN CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies) c
"""
