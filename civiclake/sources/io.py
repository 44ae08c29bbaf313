"""Reading and writing the layers: partitioned scans, schema-checked appends, swaps, quarantine, raw files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from civiclake.operators.validate import pending, requeue
from civiclake.sources.scratch import materialize


def scan(spark: SparkSession, base: str, source: str, start: dt.date | None = None, end: dt.date | None = None, limit: int | None = None) -> DataFrame:
    """One source of a layer partitioned by source and date; both ends count, schemas merge, partitions are pruned.

    Unreadable files are left out; ``unreadable_files`` names them, so that none goes unseen.
    """
    df = spark.read.options(mergeSchema="true", ignoreCorruptFiles="true").parquet(base).where(F.col("source") == source)
    if start:
        df = df.where(F.col("date") >= F.lit(start))
    if end:
        df = df.where(F.col("date") <= F.lit(end))
    return df.limit(limit) if limit else df


#: Bytes of an unreadable file that are looked at for the reason; of longer ones only that they can't be read is said.
LOOK = 64 << 20


def unreadable_files(spark: SparkSession, base: str) -> DataFrame:
    """path, n_bytes, reason of the files of a Parquet layer that a scan leaves out.

    All files are listed, and their footers are read in tasks by a scan without columns. Those that gave no rows are
    opened for the reason; sound files without rows are no failure. Files of no bytes, which readers skip, are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    listed = files.select(F.col("path"), F.col("length").alias("n_bytes"))
    footers = spark.read.schema(StructType([])).options(ignoreCorruptFiles="true", recursiveFileLookup="true").parquet(base)
    sound = footers.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    # One form of each address, as the two readers write it.
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    odd = listed.join(sound.select(plain(F.col("path")).alias("_sound")), plain(F.col("path")) == F.col("_sound"), "left_anti")
    content = F.when(F.col("length") <= LOOK, F.col("content"))
    opened = files.select(F.col("path").alias("_path"), content.alias("content")).join(odd, F.col("_path") == F.col("path")).select("path", "n_bytes", "content")

    def reasons(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for b in batches:
            out = []
            for c in b.column("content"):
                try:
                    out.append("too long to look at" if not c.is_valid else None if pq.read_metadata(pa.BufferReader(c.as_buffer())).num_rows == 0 else "no row could be read")
                except Exception as e:
                    out.append(str(e).split(".")[0][:200])
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("n_bytes"), pa.array(out, pa.string())], ["path", "n_bytes", "reason"])

    return opened.mapInArrow(reasons, "path string, n_bytes long, reason string").where("reason IS NOT NULL")


def append(df: DataFrame, base: str, rows_per_file: int = 10_000, schema: StructType | None = None) -> None:
    """Add rows to a layer; with ``schema`` its fields are enforced by safe casts first."""
    df = conform(df, schema) if schema else df
    df.write.partitionBy("source", "date").option("maxRecordsPerFile", rows_per_file).mode("append").parquet(base)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The fields of ``schema`` by safe cast, missing ones as typed nulls; other columns stay, last."""
    have = set(df.columns)
    fields = [(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name, metadata=f.metadata) for f in schema]
    return df.select(*fields, *[c for c in df.columns if c not in set(schema.names)])


QUARANTINE = "quarantine_id string, original string, error_type string, error_message string, source string"


def write_quarantine(bad: DataFrame, base: str) -> None:
    bad.write.partitionBy("source").mode("append").json(f"{base}/rows")


def read_quarantine(spark: SparkSession, base: str, error_type: str | None = None, requeued: bool = False) -> DataFrame:
    """Stored quarantine rows that wait, of one kind of error or all; with ``requeued`` those too that were sent back."""
    df = spark.read.schema(QUARANTINE).json(f"{base}/rows")
    done = _requeued(spark, base)
    df = df if requeued or done is None else pending(df, done)
    return df.where(F.col("error_type") == error_type) if error_type else df


def _requeued(spark: SparkSession, base: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/requeued")
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema("quarantine_id string").json(f"{base}/requeued") if there else None


def requeue_stored(spark: SparkSession, base: str, ids: DataFrame, schema: str) -> DataFrame:
    """The originals of stored quarantine rows that wait, by id; from then on they wait no more.

    Stored rows stay as they are: the ids are noted beside them. The originals are stored before that, so nothing is
    lost on the way; a run that is repeated gives none.
    """
    chosen = ids.select("quarantine_id").distinct()
    rows = materialize(requeue(read_quarantine(spark, base), chosen, schema))
    chosen.write.mode("append").json(f"{base}/requeued")
    return rows


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Any files as payload rows: path, size, digest, records of a JSON array."""
    df = spark.read.format("binaryFile").load(path)
    text = F.col("content").cast("string")
    return df.select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("content_hash"), F.coalesce(F.json_array_length(text), F.lit(1)).alias("records"), "content")


def json_array(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def series_csv(spark: SparkSession, path: str, ids: list[str], newest: int = 12) -> DataFrame:
    """A CSV with one column a date, as rows (ids, metric_date, metric_value) of the newest dates."""
    return unpivot_dates(spark.read.csv(path, header=True), ids, newest)


def unpivot_dates(df: DataFrame, ids: list[str], newest: int = 12) -> DataFrame:
    import re

    dates = sorted(c for c in df.columns if re.fullmatch(r"\d{4}-\d{2}(-\d{2})?", c))[-newest:]
    typed = df.select(*ids, *(F.col(f"`{d}`").try_cast("double").alias(d) for d in dates))
    return typed.unpivot(ids, dates, "metric_date", "metric_value").where("metric_value IS NOT NULL")


def swap(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Overwrite a dataset: the latest run only, or one folder a run."""
    df.write.mode("overwrite").parquet(f"{path}/run={run_id}" if run_id else path)


#: Declared schemas by record type; others register theirs.
SCHEMAS: dict[str, str] = {
    "contract": "record_id string, contract_number string, title string, description string, agency_name string, agency_code string, supplier_name string, contract_amount decimal(18,2), contract_status string, contract_type string, procurement_method string, fiscal_year int, start_date date, end_date date, contract_url string, nigp_codes array<string>, naics_codes array<string>, latitude double, longitude double, lineage_source string, lineage_run_id string, lineage_raw_hash string",
    "payment": "record_id string, supplier_name string, agency_name string, payment_amount decimal(18,2), payment_date date, fiscal_year int, contract_number string, lineage_source string, lineage_run_id string, lineage_raw_hash string",
    "purchase_order": "record_id string, agency_name string, supplier_name string, amount_min decimal(18,2), amount_max decimal(18,2), order_date date, fiscal_year int",
    "property": "record_id string, ssl string, ward int, price decimal(18,2), sqft double, bedrooms int, bathrooms double, year_built int, property_type string, sold_date date",
    "rental": "record_id string, unit_number string, rent_price decimal(18,2), bedrooms int, bathrooms double, sqft int, status string",
    "market_stat": "record_id string, region_name string, metric_name string, metric_date date, metric_value double",
    "business": "record_id string, business_name string, license string, ward int, latitude double, longitude double",
    "demographic": "record_id string, region_name string, metric_name string, category string, metric_value double",
}


def register_schema(record_type: str, ddl: str) -> None:
    SCHEMAS[record_type] = ddl


def conform_to(df: DataFrame, record_type: str) -> DataFrame:
    """``conform`` to the registered schema of a record type."""
    return conform(df, StructType.fromDDL(SCHEMAS[record_type]))


def metrics_json(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def null_rates_csv(rates: DataFrame, path: str) -> None:
    """Null rates as CSV, the highest first."""
    rates.orderBy(F.desc("rate"), "dataset", "column").write.mode("overwrite").option("header", True).csv(path)


def metrics_text(metrics: DataFrame, path: str) -> None:
    prometheus_lines(metrics).write.mode("overwrite").text(path)


def prometheus_lines(metrics: DataFrame) -> DataFrame:
    """One line of text a metric (name, source, value); backslashes, quotes and line ends of the label are escaped."""
    label = F.col("source")
    for sign, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        label = F.replace(label, F.lit(sign), F.lit(escaped))
    return metrics.select(F.format_string("%s{source=\"%s\"} %s", "name", label, F.col("value").cast("string")).alias("value"))


def features_of(payload: Column, schema: str) -> Column:
    """The rows of a feature-collection JSON: attributes and geometry."""
    return F.from_json(payload, f"features array<struct<attributes: struct<{schema}>, geometry: struct<x: double, y: double>>>")["features"]


def parse_features(payloads: DataFrame, column: str, schema: str) -> DataFrame:
    """One row a feature: attribute columns, longitude, latitude."""
    rows = payloads.select(F.explode(features_of(F.col(column), schema)).alias("f"))
    return rows.select("f.attributes.*", F.col("f.geometry.x").alias("longitude"), F.col("f.geometry.y").alias("latitude"))


def location_reply(payload: Column, tags: tuple[str, ...]) -> list[Column]:
    """Columns of an XML reply, one a tag."""
    return [F.xpath_string(payload, F.lit(f"//{t}")).alias(t.lower()) for t in tags]


def location_rows(replies: DataFrame, payload: str, tags: tuple[str, ...]) -> DataFrame:
    """A row a reply with the columns of ``location_reply``. Replies are dealt out, and each is parsed once, in Arrow batches, not once a tag and use."""
    names = [t.lower() for t in tags]

    def run(batches):
        import pyarrow as pa

        from civiclake.functions.markup import first_texts

        for b in batches:
            found = [first_texts(x, tags) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in range(len(tags))], names)

    return dealt(replies.select(payload)).mapInArrow(run, ", ".join(f"`{n}` string" for n in names))


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many parts as a shuffle has. For costly work on each row: a compressed file of a few MB holds a million rows that one task would read."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def warehouse_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that ``df`` has, in their order; arrays, maps and structs as JSON text."""
    nested = {f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    return df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in columns if c in df.columns))


def reload_table(df: DataFrame, columns: list[str], url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Truncate a warehouse table and load it again by JDBC; the partitions of ``df`` write in parallel."""
    warehouse_rows(df, columns).write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=properties or {})
