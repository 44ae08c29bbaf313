"""Semantic layer: declared dimensions, measures and many-to-one relations become joins, views and queries."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators.order import group_places
from civiclake.sources.scratch import materialize


@dataclass(frozen=True)
class Measure:
    """A figure over the rows of a group, by its kind.

    count: rows (where ``value`` is not null); count_distinct, sum, average and median of ``value``, SQL over a row;
    percent: the sum of ``value`` where ``where`` holds, in percent of its whole sum. Sums and averages add decimals, so
    they do not depend on the order of rows. ``where`` bounds the rows of any kind.
    """

    kind: str
    value: str = "1"
    where: str | None = None

    def column(self) -> Column:
        chosen = F.expr(self.value) if self.where is None else F.when(F.expr(self.where), F.expr(self.value))
        exact = lambda c: F.sum(c.cast("decimal(28,8)")).cast("double")
        if self.kind == "count":
            return F.count(chosen)
        if self.kind == "count_distinct":
            return F.count_distinct(chosen)
        if self.kind == "sum":
            return exact(chosen)
        if self.kind == "average":
            return F.round(F.try_divide(exact(chosen), F.count(chosen)), 4)
        if self.kind == "percent":
            return F.round(F.coalesce(F.try_divide(F.coalesce(exact(chosen), F.lit(0.0)) * 100, exact(F.expr(self.value))), F.lit(0.0)), 4)
        raise ValueError(f"no measure of the kind {self.kind}")

    def texts(self) -> list[str]:
        return [self.value] + ([self.where] if self.where else [])


def columns_of(spark: SparkSession, text: str) -> set[str]:
    """The columns that a SQL expression names, by Spark's own parser."""
    found, left = set(), [spark._jsparkSession.sessionState().sqlParser().parseExpression(text)]
    while left:
        e = left.pop()
        if e.getClass().getSimpleName() == "UnresolvedAttribute":
            found.add(e.nameParts().apply(e.nameParts().size() - 1).lower())
        children = e.children()
        left += [children.apply(k) for k in range(children.size())]
    return found


def one_a_key(dimension: DataFrame, name: str, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of a dimension by its key. A key of several rows would multiply facts: it fails the query.

    The shuffle by key is the one that the join with the facts needs.
    """
    rows = dimension.groupBy(key).agg(F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    several = F.raise_error(F.concat(F.lit(f"{name} has several rows of {key} "), F.col(key).cast("string")))
    checked = F.when((F.col("_n") > 1) & F.col(key).isNotNull(), several.cast(rows.schema["_row"].dataType)).otherwise(F.col("_row"))
    return rows.select(key, checked.alias("_row")).select(key, "_row.*")


@dataclass(frozen=True)
class Model:
    """A fact with its dimensions (name -> table, column), measures and many-to-one relations (table -> key of fact and table)."""

    name: str
    fact: str
    dimensions: dict[str, tuple[str, str]]
    measures: dict[str, Measure]
    relations: dict[str, str] = field(default_factory=dict)

    def needed(self, tables: dict[str, DataFrame], measures: list[str], dimensions: list[str], where: str | None = None) -> dict[str, list[str]]:
        """The columns that a query takes from each related table; tables that it needs nothing of are not there."""
        spark = tables[self.fact].sparkSession
        own = {c.lower() for c in tables[self.fact].columns}
        named = set().union(*(columns_of(spark, t) for m in measures for t in self.measures[m].texts()), columns_of(spark, where) if where else set())
        asked = [self.dimensions[d] for d in dimensions]
        out = {}
        for table, key in self.relations.items():
            if table in tables:
                used = [c for c in tables[table].columns if c != key and ((table, c) in asked or (c.lower() in named and c.lower() not in own))]
                if used:
                    out[table] = used
        return out

    def rows(self, tables: dict[str, DataFrame], measures: list[str], dimensions: list[str], where: str | None = None) -> DataFrame:
        """The facts with the columns of related tables that the query needs, as many rows as facts hold ``where``."""
        rows = tables[self.fact]
        for table, used in self.needed(tables, measures, dimensions, where).items():
            key = self.relations[table]
            rows = rows.drop(*(c for c in used if c in rows.columns)).join(one_a_key(tables[table], table, key, used), key, "left")
        return rows.where(where) if where else rows

    def query(self, tables: dict[str, DataFrame], measures: list[str], dimensions: list[str], where: str | None = None) -> DataFrame:
        """The measures by the dimensions. Medians come from ``order.group_places``, which stores folded values when called."""
        rows = self.rows(tables, measures, dimensions, where)
        keyed = rows.withColumns({f"_d{i}": F.col(self.dimensions[d][1]) for i, d in enumerate(dimensions)})
        keys = [f"_d{i}" for i in range(len(dimensions))]
        out = keyed.groupBy(*keys).agg(*(self.measures[m].column().alias(m) for m in measures if self.measures[m].kind != "median") or [F.count(F.lit(1)).alias("_n")])
        for m in measures:
            if self.measures[m].kind == "median":
                one = self.measures[m]
                values = keyed.where(one.where) if one.where else keyed
                middle = group_places(values.select(*keys, F.expr(one.value).alias("_v")), keys, "_v", between={m: 0.5}).toDF(*(f"_m{k}" for k in keys), m)
                alike = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_m{k}")) for k in keys), F.lit(True))
                out = out.join(middle, alike, "left")
        return out.select(*(F.col(k).alias(d) for k, d in zip(keys, dimensions, strict=True)), *measures)

    def create_views(self, tables: dict[str, DataFrame]) -> list[str]:
        """A view of distinct values per dimension and one of all measures; gives their names."""
        made = []
        for d, (table, column) in self.dimensions.items():
            made.append(f"v_{self.name}_{d}")
            tables[table].select(F.col(column).alias(d)).where(F.col(d).isNotNull()).distinct().createOrReplaceTempView(made[-1])
        made.append(f"v_{self.name}_measures")
        self.query(tables, list(self.measures), []).createOrReplaceTempView(made[-1])
        return made


PROCUREMENT = Model(
    "procurement",
    "fact_spend",
    {
        "vendor": ("dim_supplier", "supplier_name"),
        "agency": ("fact_spend", "agency_name"),
        "fiscal_year": ("fact_spend", "fiscal_year"),
        "fiscal_quarter": ("fact_spend", "fiscal_quarter"),
        "contract_type": ("dim_contract", "contract_type"),
        "is_cbe": ("dim_supplier", "is_cbe"),
    },
    {
        "total_spend": Measure("sum", "spend_amount"),
        "payment_count": Measure("count"),
        "contract_count": Measure("count_distinct", "contract_key"),
        "vendor_count": Measure("count_distinct", "supplier_id"),
        "average_payment": Measure("average", "spend_amount"),
        "median_payment": Measure("median", "spend_amount"),
        "cbe_spend": Measure("sum", "CASE WHEN is_cbe THEN spend_amount ELSE 0 END"),
        "cbe_share": Measure("percent", "spend_amount", "is_cbe"),
    },
    {"dim_supplier": "supplier_id", "dim_contract": "contract_key"},
)


def real_estate(as_of: dt.date) -> Model:
    """Properties by ward, type, year and bedrooms; ages are those of the year of ``as_of``."""
    at = {"ward": "ward", "property_type": "property_type", "year_built": "year_built", "bedroom_count": "bedrooms"}
    return Model(
        "real_estate",
        "properties",
        {d: ("properties", c) for d, c in at.items()},
        {
            "property_count": Measure("count"),
            "total_assessed_value": Measure("sum", "price"),
            "avg_assessed_value": Measure("average", "price"),
            "median_assessed_value": Measure("median", "price"),
            "avg_price_per_sqft": Measure("average", "price / nullif(sqft, 0)"),
            "total_square_footage": Measure("sum", "sqft"),
            "avg_property_age": Measure("average", f"{as_of.year} - year_built"),
        },
    )


def dashboard(tables: dict[str, DataFrame], top: int = 10) -> DataFrame:
    """section, label, value: key figures, spend by year, agency and certification, top suppliers; the payload as one long table.

    The facts are read once, into spend by year, agency and supplier, which is stored; all sections come from it. Names
    and certification join its suppliers alone, which are stored too. Runs those jobs when called.
    """
    fact = tables["fact_spend"]
    base = materialize(fact.groupBy("fiscal_year", "agency_name", "supplier_id").agg(F.sum("spend_amount").alias("s"), F.count(F.lit(1)).alias("n"), F.count("spend_amount").alias("paid")))
    row = lambda section, label, value: F.struct(F.lit(section).alias("section"), label.cast("string").alias("label"), value.cast("double").alias("value"))
    total = F.sum("s").cast("double")
    kpis = base.agg(
        F.array(
            row("kpi", F.lit("total_spend"), total), row("kpi", F.lit("payment_count"), F.sum("n")), row("kpi", F.lit("vendor_count"), F.count_distinct("supplier_id")), row("kpi", F.lit("average_payment"), F.round(F.try_divide(total, F.sum("paid")), 4)),
        ).alias("rows")
    ).select(F.inline("rows"))
    by = lambda section, c: base.groupBy(c).agg(total.alias("v")).select(row(section, F.coalesce(F.col(c).cast("string"), F.lit("Unknown")), F.col("v")).alias("r")).select("r.*")
    named = one_a_key(tables["dim_supplier"], "dim_supplier", "supplier_id", ["supplier_name", "is_cbe"])
    # Stored, as two sections read it and a dimension may be dear to make.
    suppliers = materialize(base.groupBy("supplier_id").agg(F.sum("s").alias("s")).join(named, "supplier_id", "left"))
    names = suppliers.where("supplier_name IS NOT NULL").groupBy("supplier_name").agg(total.alias("v"))
    best = names.orderBy(F.desc("v"), "supplier_name").limit(top).select(row("supplier", F.col("supplier_name"), F.col("v")).alias("r")).select("r.*")
    cbe = suppliers.groupBy(F.coalesce("is_cbe", F.lit(False)).alias("c")).agg(total.alias("v")).select(row("cbe", F.col("c"), F.col("v")).alias("r")).select("r.*")
    return reduce(DataFrame.unionByName, (kpis, by("year", "fiscal_year"), by("agency", "agency_name"), cbe, best))
