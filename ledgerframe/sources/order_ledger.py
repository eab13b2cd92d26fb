"""Order-management tables (orders, lineitem, ...) seen as ledger facts.

An order line is both a sale and a cost: it yields one revenue posting and one
expense posting. The mapping:

* period: month of ``o_orderdate``
* revenue: segment ``p_type``, company = customer's region, account by return flag
* expense: cost centre ``o_orderpriority``, company = supplier's region, account by
  line status and return flag

Every reader takes the columns it is asked for and joins only the tables that feed
them. Period bounds go to the raw order date, so they reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY, cents, dbl, div_half_up, from_cents, safe_div
from ..functions.periods import month_start, quarter_key
from .dimensions import literal_table
from .schemas import COST_CENTERS, SEGMENTS, _schema

REVENUE_ACCOUNTS = {"A": "400000", "N": "400100", "R": "400200"}
EXPENSE_ACCOUNTS = {"A": "600000", "N": "600100", "R": "610000"}
COGS_ACCOUNT = "500000"
COST_PERCENT = 70
# lines of an order key range that one task numbers, and ranges that one task adds up
ORDER_RANGE = 1 << 12
RANGE_GROUP = 1 << 12
FIRST_YEAR = 1995
FIRST_QUARTER = date(1995, 1, 1)
COMMENTARY_QUARTERS = 26

SEGMENT_ROWS = (
    ("ECONOMY", "Economy range", "Subscription"),
    ("STANDARD", "Standard range", "Subscription"),
    ("SMALL", "Small range", "Product"),
    ("MEDIUM", "Medium range", "Product"),
    ("LARGE", "Large range", "Product"),
    ("PROMO", "Promotions", "Services"),
)
COST_CENTER_ROWS = (
    ("1-URGENT", "Urgent desk", "S&M"),
    ("2-HIGH", "High desk", "R&D"),
    ("3-MEDIUM", "Medium desk", "G&A"),
    ("4-NOT SPECIFIED", "Open desk", "S&M"),
    ("5-LOW", "Low desk", "COGS"),
)
# loaded yearly cost per head in the first year
LOADED_COST_ROWS = (
    ("1-URGENT", 90000.0),
    ("2-HIGH", 84000.0),
    ("3-MEDIUM", 76000.0),
    ("4-NOT SPECIFIED", 70000.0),
    ("5-LOW", 64000.0),
)
# non-payroll cost as a share of payroll
COST_RATIO_ROWS = tuple(
    (centre, account, ratio)
    for centre, scale in (
        ("1-URGENT", 3), ("2-HIGH", 2), ("3-MEDIUM", 2), ("4-NOT SPECIFIED", 1), ("5-LOW", 1),
    )
    for account, ratio in (
        ("500000", 0.5 * scale), ("620000", 0.02 * scale), ("630000", 0.04), ("640000", 0.05),
    )
)

LINE_COLUMNS = frozenset({"profit_center", "revenue_company", "expense_company"})


# declared, so that building a query opens no data file
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


@dataclass(frozen=True)
class OrderTables:
    """The Parquet tables below one directory, each listed once."""

    spark: SparkSession
    path: str
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read
            if name in SOURCE_SCHEMAS:
                reader = reader.schema(SOURCE_SCHEMAS[name])
            self._frames[name] = reader.parquet(f"{self.path}/{name}.parquet")
        return self._frames[name]


# ---------------------------------------------------------------- dimensions

def entities(t: OrderTables) -> DataFrame:
    return t["region"].select(
        F.col("r_name").alias("company_code"),
        F.concat(F.initcap(F.lower("r_name")), F.lit(" entity")).alias("entity_name"),
        F.col("r_name").alias("region"),
        F.lit("USD").alias("currency"),
    )


def segments(t: OrderTables) -> DataFrame:
    return literal_table(t.spark, SEGMENT_ROWS, SEGMENTS)


def cost_centers(t: OrderTables) -> DataFrame:
    return literal_table(t.spark, COST_CENTER_ROWS, COST_CENTERS)


def loaded_costs(t: OrderTables) -> DataFrame:
    return literal_table(t.spark, LOADED_COST_ROWS, _schema("cost_center:str base_cost:dbl"))


def cost_ratios(t: OrderTables) -> DataFrame:
    return literal_table(
        t.spark, COST_RATIO_ROWS, _schema("cost_center:str gl_account:str ratio:dbl")
    )


def _region_of_nation(t: OrderTables) -> DataFrame:
    return (
        t["nation"]
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )


# ---------------------------------------------------------------- order lines

def _in_range(day: Column, since: date | Column | None, until: date | None) -> Column:
    """``since <= day < until`` on the stored column; ``since`` may be a scalar subquery."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (day >= F.lit(since))
    if until is not None:
        cond = cond & (day < F.lit(until))
    return cond


def order_headers(
    t: OrderTables, company: bool = False, since: date | Column | None = None,
    until: date | None = None
) -> DataFrame:
    """Order key with period, cost centre, customer and, if asked, the customer's region."""
    headers = t["orders"].filter(_in_range(F.col("o_orderdate"), since, until)).select(
        "o_orderkey",
        month_start("o_orderdate").alias("period"),
        F.col("o_orderpriority").alias("cost_center"),
        F.col("o_custkey").alias("customer"),
    )
    if not company:
        return headers
    home = (
        t["customer"]
        .join(_region_of_nation(t), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("r_name").alias("revenue_company"))
    )
    return headers.join(home, F.col("customer") == F.col("c_custkey"), "left").drop("c_custkey")


def _account(flag: str, accounts: dict[str, str]) -> Column:
    out = None
    for value, account in accounts.items():
        cond = F.col(flag) == value
        out = F.when(cond, account) if out is None else out.when(cond, account)
    return out


def order_lines(
    t: OrderTables,
    columns: Collection[str] = LINE_COLUMNS,
    since: date | Column | None = None,
    until: date | None = None,
) -> DataFrame:
    """One row per order line with both amounts (in cents), both accounts and the asked
    dimensions.

    Orders, lines, parts, customers and suppliers all grow with the data, so no side is
    hinted: the planner broadcasts a side only under its size threshold, and splits a
    hot key of a sort-merge join at run time.
    """
    unknown = set(columns) - LINE_COLUMNS
    if unknown:
        raise ValueError(f"unknown line columns: {sorted(unknown)}")
    price = cents("l_extendedprice")
    lines = t["lineitem"].select(
        "l_orderkey",
        "l_partkey",
        F.col("l_suppkey").alias("supplier"),
        "l_linenumber",
        div_half_up(price * (100 - cents("l_discount")), 100).alias("revenue_cents"),
        div_half_up(price * (COST_PERCENT + cents("l_tax")), 100).alias("expense_cents"),
        _account("l_returnflag", REVENUE_ACCOUNTS).alias("revenue_account"),
        F.when(F.col("l_linestatus") == "F", COGS_ACCOUNT)
        .otherwise(_account("l_returnflag", EXPENSE_ACCOUNTS))
        .alias("expense_account"),
    )
    headers = order_headers(t, "revenue_company" in columns, since, until)
    out = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    if "profit_center" in columns:
        kinds = t["part"].select("p_partkey", F.col("p_type").alias("profit_center"))
        out = out.join(kinds, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "expense_company" in columns:
        home = (
            t["supplier"]
            .join(_region_of_nation(t), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("r_name").alias("expense_company"))
        )
        out = out.join(home, F.col("supplier") == F.col("s_suppkey"), "left")
    return out


# ---------------------------------------------------------------- ledger facts

_SALE = {"line_type": "Revenue", "dim1": "profit_center", "dim2": "revenue_company",
         "gl_account": "revenue_account", "cents": "revenue_cents"}
_COST = {"line_type": "Opex", "dim1": "cost_center", "dim2": "expense_company",
         "gl_account": "expense_account", "cents": "expense_cents"}


def _both_sides(lines: DataFrame, keep: Collection[str], fields: Collection[str]) -> DataFrame:
    """Unfold each row into its revenue and its expense posting."""

    def side(source: dict[str, str]) -> Column:
        return F.struct(
            F.lit(source["line_type"]).alias("line_type"),
            *[F.col(source[f]).alias(f) for f in fields],
        )

    both = F.explode(F.array(side(_SALE), side(_COST))).alias("p")
    return lines.select(*keep, both).select(*keep, "p.*")


def postings(
    t: OrderTables,
    dims: bool = True,
    since: date | Column | None = None,
    until: date | None = None,
) -> DataFrame:
    """Monthly revenue and expense postings, from one pass over the lines.

    Each line is unfolded into its two postings, instead of joining the line table twice
    and taking the union. ``dims=False`` leaves ``dim1`` and ``dim2`` out and with them
    three joins; the lines are then summed per month and account pair before they are
    unfolded. Cents are summed as whole numbers and become DECIMAL at month grain.
    """
    if dims:
        lines = order_lines(t, LINE_COLUMNS, since, until)
        fields = ["dim1", "dim2", "gl_account", "cents"]
    else:
        lines = order_lines(t, (), since, until).groupBy(
            "period", "revenue_account", "expense_account"
        ).agg(
            F.sum("revenue_cents").alias("revenue_cents"),
            F.sum("expense_cents").alias("expense_cents"),
        )
        fields = ["gl_account", "cents"]
    keys = ["period", *fields[:-1], "line_type"]
    return (
        _both_sides(lines, ["period"], fields)
        .groupBy(*keys)
        .agg(F.sum("cents").alias("cents"))
        .select(*keys, from_cents("cents").alias("amount"))
    )


def line_postings(t: OrderTables) -> DataFrame:
    """Postings of single order lines with a unique document number, line and date.

    Documents are numbered from 1 in the order of their keys, the sale of a line before
    its cost. Numbers are counted within ranges of order keys, the ranges' sizes added up
    within groups of ranges, and those of the groups at last, so the widest window sees
    one row for millions of orders.
    """
    lines = order_lines(t).select(
        "*",
        F.col("l_linenumber").alias("document_line"),
        F.date_add("period", (F.col("l_partkey") % 28).cast("int")).alias("posting_date"),
        F.floor(F.col("l_orderkey") / ORDER_RANGE).alias("range"),
    )
    natural = ["l_orderkey", "l_linenumber", "l_partkey", "supplier", "revenue_cents",
               "expense_cents", "revenue_account", "expense_account"]
    nth = F.row_number().over(Window.partitionBy("range").orderBy(*natural)) - 1

    def before(df: DataFrame, keys: list[str], order: str, size: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(w), F.lit(0))

    group = F.floor(F.col("range") / RANGE_GROUP).alias("group")
    # the ranges' sizes need the line keys alone, none of the dimensions
    keys = order_lines(t, ()).select(F.floor(F.col("l_orderkey") / ORDER_RANGE).alias("range"))
    ranges = keys.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", group, "n")
    groups = ranges.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", before(groups, [], "group", "n").alias("g"))
    ranges = ranges.select("range", "group", before(ranges, ["group"], "range", "n").alias("r"))
    bases = ranges.join(groups, "group").select("range", (F.col("r") + F.col("g")).alias("base"))
    numbered = lines.withColumn("nth", nth).join(bases, "range")
    first = 2 * (F.col("base") + F.col("nth")) + 1
    kept = ["sale_number", "document_line", "posting_date", "period"]
    rows = _both_sides(
        numbered.withColumn("sale_number", first), kept, ["dim1", "dim2", "gl_account", "cents"]
    )
    number = F.col("sale_number") + F.when(F.col("line_type") == "Revenue", 0).otherwise(1)
    return rows.select(
        number.alias("document_number"), *kept[1:], "line_type", "dim1", "dim2", "gl_account",
        from_cents("cents").cast(MONEY).alias("amount"),
    )


def account_postings(t: OrderTables) -> DataFrame:
    """Postings of single order lines without dimensions and documents."""
    rows = _both_sides(order_lines(t, ()), ["period"], ["gl_account", "cents"])
    return rows.withColumn("amount", from_cents("cents").cast(MONEY)).drop("cents")


def revenue_monthly(
    t: OrderTables,
    by: Collection[str] = ("profit_center",),
    since: date | Column | None = None,
    until: date | None = None,
) -> DataFrame:
    """Revenue per month and the asked keys among profit_center, company_code, gl_account."""
    source = {"profit_center": "profit_center", "company_code": "revenue_company",
              "gl_account": "revenue_account"}
    columns = {source[k] for k in by} & LINE_COLUMNS
    lines = order_lines(t, columns, since, until)
    sums = lines.groupBy("period", *[F.col(source[k]).alias(k) for k in by]).agg(
        F.sum("revenue_cents").alias("cents")
    )
    return sums.select("period", *by, from_cents("cents").alias("revenue"))


GRAIN = ("profit_center", "company_code", "gl_account")


def revenue_fact(t: OrderTables, grain: Collection[str] = GRAIN) -> DataFrame:
    """Monthly revenue with customer counts, by segment, company and account or by fewer.

    A customer is new in the first month they buy in a cell of the grain and churned in
    the last one, unless that is the last month on record: who buys in it has not left.
    Customers are counted once per cell, so counts of a finer grain don't add up to those
    of a coarser one. Lines are first reduced to one row per customer and month; the look
    at a customer's own months is bounded by the number of months.
    """
    grain = list(grain)
    names = {"company_code": "revenue_company", "gl_account": "revenue_account"}
    monthly = (
        order_lines(t, {names.get(k, k) for k in grain} & LINE_COLUMNS)
        .groupBy("customer", *[F.col(names.get(k, k)).alias(k) for k in grain], "period")
        .agg(F.sum("revenue_cents").alias("cents"))
    )
    end = t["orders"].agg(F.max(month_start("o_orderdate")).alias("end")).scalar()
    own = Window.partitionBy("customer", *grain)
    first, last = F.min("period").over(own), F.max("period").over(own)
    flagged = monthly.select(
        *grain,
        "period",
        "cents",
        (F.col("period") == first).cast("int").alias("is_new"),
        (F.col("period") == last).cast("int").alias("is_last"),
    )
    fact = flagged.groupBy("period", *grain).agg(
        dbl(F.count(F.lit(1))).alias("customers"),
        from_cents(F.sum("cents")).alias("revenue"),
        dbl(F.sum("is_new")).alias("new_logos"),
        dbl(F.sum("is_last")).alias("n_last"),
    )
    return fact.select(
        "period", *grain, "customers", safe_div("revenue", "customers").alias("arpu"),
        "revenue", "new_logos",
        F.when(F.col("period") < end, F.col("n_last")).otherwise(0.0).alias("churned_customers"),
    )


def _expense_lines(t: OrderTables) -> DataFrame:
    return order_lines(t, {"expense_company"}).withColumnsRenamed(
        {"expense_company": "company_code", "expense_account": "gl_account"}
    )


def opex_fact(t: OrderTables) -> DataFrame:
    """Monthly expense by cost centre, company and account."""
    return _expense_lines(t).groupBy("period", "cost_center", "company_code", "gl_account").agg(
        from_cents(F.sum("expense_cents")).alias("amount")
    )


def cost_and_heads(t: OrderTables) -> DataFrame:
    """Monthly expense and heads by cost centre and company, from one pass: lines are
    summed per supplier first, and a supplier is a head."""
    per_supplier = _expense_lines(t).groupBy(
        "period", "cost_center", "company_code", "supplier"
    ).agg(F.sum("expense_cents").alias("cents"))
    return per_supplier.groupBy("period", "cost_center", "company_code").agg(
        dbl(F.count("supplier")).alias("headcount"), from_cents(F.sum("cents")).alias("amount")
    )


def line_gaps(t: OrderTables) -> DataFrame:
    """One row of counts: lines without a cost centre, without a segment, without an order.

    One pass over the lines; order_lines leaves those without an order out of every fact.
    """
    headers = t["orders"].select("o_orderkey", F.col("o_orderpriority").alias("cost_center"))
    kinds = t["part"].select("p_partkey", F.col("p_type").alias("profit_center"))
    lines = (
        t["lineitem"].select("l_orderkey", "l_partkey")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(kinds, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    known = F.col("o_orderkey").isNotNull()
    return lines.agg(
        F.count_if(known & F.col("cost_center").isNull()).alias("opex"),
        F.count_if(known & F.col("profit_center").isNull()).alias("revenue"),
        F.count_if(~known).alias("line_without_order"),
    )


def opex_total(t: OrderTables) -> DataFrame:
    """Monthly expense of the company."""
    return order_lines(t, ()).groupBy("period").agg(
        from_cents(F.sum("expense_cents")).alias("amount")
    )


def headcount_fact(t: OrderTables) -> DataFrame:
    """Heads = suppliers with a line in the month; cost escalates from a base per centre."""
    heads = _expense_lines(t).groupBy("period", "cost_center", "company_code").agg(
        dbl(F.countDistinct("supplier")).alias("headcount")
    )
    years = (F.year("period") - FIRST_YEAR) + F.month("period") / F.lit(12.0)
    return heads.join(loaded_costs(t), "cost_center").select(
        "period", "cost_center", "company_code", "headcount",
        F.round(F.col("base_cost") * (1 + F.lit(0.028) * years), 2).alias("avg_fully_loaded_cost"),
    )


def commentary(t: OrderTables) -> DataFrame:
    """Documents as quarterly commentary of a cost centre."""
    centres = [r[0] for r in COST_CENTER_ROWS]
    pick = F.element_at(
        F.array(*[F.lit(c) for c in centres]), (F.col("doc_id") % len(centres) + 1).cast("int")
    )
    months = (F.col("doc_id") % COMMENTARY_QUARTERS * 3).cast("int")
    return t["documents"].select(
        "doc_id",
        quarter_key(F.add_months(F.lit(FIRST_QUARTER), months)).alias("fiscal_quarter"),
        pick.alias("cost_center"),
        F.col("text").alias("commentary_text"),
    )


def authored_labels(t: OrderTables) -> DataFrame:
    """Labels by document; kept apart so that they meet scores, not whole texts."""
    label = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
    return t["labels"].select("doc_id", label.alias("authored_tone_label"))
