"""Market frames from the order tables.

States are nations under two-letter codes. Three reports with different grains come from
different tables: customer segments by order month (category), part brands by ship month
(fuel), suppliers by ship month (manufacturer). The manufacturer report counts order lines
where the fuel report sums quantities, so that their totals differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymark.functions.reports import month_name
from tallymark.plans.bronze import find_heads
from tallymark.plans.gold import Gold, build_gold, fact
from tallymark.plans.silver import silver_columns
from tallymark.schemas import CATEGORY, FUEL, GRAINS, MEASURE, SILVER_SCHEMA, Grain
from tallymark.sources.report_files import LINE_SCHEMA, scan_lines, write_reports
from tallymark.sources.workspace import TableStore, digest, table_path

_STORE = TableStore()
_VERSIONS: dict[tuple[str, str], str] = {}
_YEARS: dict[str, tuple[int, int]] = {}

TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]
_REPORT = {"category": "vehicle_category", "fuel": "fuel", "manufacturer": "manufacturer"}
#: A report that was delivered without a byte; its state code stands for no state.
EMPTY_REPORT = "fuel/market_fuel_zz_monthwise_1990_1990.csv"


def _month(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")


def _letter(number: Column) -> Column:
    return F.substring(F.lit("abcde"), (number + 1).cast("int"), F.lit(1))


def states(nation: DataFrame) -> DataFrame:
    """Two-letter code and name per nation."""
    key = F.col("n_nationkey")
    return nation.select(
        key.alias("nation_key"),
        F.concat(_letter(F.floor(key / 5)), _letter(key % 5)).alias("state_code"),
        F.col("n_name").alias("state"))


def source_name(report: str, code: Column, year: Column) -> Column:
    """``<folder>/market_<report>_<code>_monthwise_<year>_<year>.csv``."""
    folder = report.rsplit("_", 1)[-1]
    y = year.cast("string")
    return F.concat(
        F.lit(f"{folder}/market_{report}_"), code, F.lit("_monthwise_"), y, F.lit("_"), y,
        F.lit(".csv"))


def category_cells(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Counted by customer key first, as for suppliers."""
    by_key = orders.groupBy("o_custkey", _month("o_orderdate").alias("date")).agg(
        F.count("*").alias("orders"))
    return (
        by_key.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("c_nationkey").alias("nation_key"),
            F.col("c_mktsegment").alias("dimension_value"), "date")
        .agg(F.sum("orders").alias(MEASURE))
    )


def fuel_cells(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame) -> DataFrame:
    """Lines meet their orders once; nation and brand are all that is carried on."""
    placed = orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_nationkey")
    shipped = lineitem.select("l_orderkey", "l_partkey", "l_quantity", _month("l_shipdate").alias("date"))
    branded = shipped.join(
        part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    ).select("l_orderkey", "p_brand", "l_quantity", "date")
    return (
        branded.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("c_nationkey").alias("nation_key"), F.col("p_brand").alias("dimension_value"),
            "date")
        .agg(F.sum("l_quantity").cast("bigint").alias(MEASURE))
    )


def manufacturer_cells(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Counted by supplier key first: the join then meets counts, and a supplier with a great
    part of all lines has become one row per month."""
    by_key = lineitem.groupBy("l_suppkey", _month("l_shipdate").alias("date")).agg(
        F.count("*").alias("lines"))
    return (
        by_key.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("s_nationkey").alias("nation_key"), F.col("s_name").alias("dimension_value"),
            "date")
        .agg(F.sum("lines").alias(MEASURE))
    )


def to_silver(cells: DataFrame, nation: DataFrame, grain: Grain) -> DataFrame:
    # Nations are a fixed short list: Spark sees their size and broadcasts them.
    year = F.year("date")
    return silver_columns(
        cells.join(states(nation), "nation_key").select(
            F.lit(grain.dataset_type).alias("dataset_type"),
            "dimension_value",
            F.date_format("date", "yyyy-MM-dd").alias("period"),
            year.alias("year"),
            F.month("date").alias("month"),
            month_name("date").alias("month_name"),
            MEASURE,
            source_name(_REPORT[grain.name], F.col("state_code"), year).alias("source_file"),
            "state_code", "state", "date"))


def row_hash(*columns) -> Column:
    """A number in 0..2^28 from the text of the columns, the same in any engine."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def soil(clean: DataFrame) -> DataFrame:
    """Silver rows with known faults and copies.

    Which rows are spoilt follows from a hash of their key, so no order over all rows
    and no shuffle is needed.
    """
    h = F.col("_h")
    def listed(*numbers):
        return F.array(*[F.lit(n) for n in numbers])

    second, third = h % 131 == 0, h % 137 == 0
    copies = (
        F.when(second & third, listed(0, 1, 2)).when(second, listed(0, 1))
        .when(third, listed(0, 2)).otherwise(listed(0)))
    rows = clean.withColumn(
        "_h", row_hash("dataset_type", "state_code", "dimension_value", "period")
    ).withColumn("_copy", F.explode_outer(copies))
    # The outer form: a list that is never empty needs no test, which would draw the
    # hash again for every row.
    no_state = h % 127 == 0
    return rows.select(
        "dataset_type",
        F.when(h % 113 == 0, "").when(h % 139 == 0, "Total").when(h % 149 == 0, "GRAND TOTAL")
        .otherwise(F.col("dimension_value")).alias("dimension_value"),
        "period",
        F.when(h % 109 == 0, 1900).otherwise(F.col("year")).alias("year"),
        F.when(h % 107 == 0, 13).otherwise(F.col("month")).alias("month"),
        "month_name",
        F.when(h % 103 == 0, F.lit(None)).when(h % 101 == 0, -F.col(MEASURE))
        .when(h % 97 == 0, 0)
        # Half of the copies from a second source disagree with the first.
        .when((F.col("_copy") == 2) & (h % 2 == 0), F.col(MEASURE) + 1)
        .otherwise(F.col(MEASURE)).alias(MEASURE),
        F.when(F.col("_copy") == 2, F.concat("source_file", F.lit(".copy")))
        .otherwise(F.col("source_file")).alias("source_file"),
        F.when(~no_state, F.col("state_code")).alias("state_code"),
        F.when(~no_state, F.col("state")).alias("state"),
        "date")


class Market:
    """The market frames of one folder of order tables.

    The frame of each grain is written once per application as a partition of a Silver
    table; every analysis reads the partitions it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, store: TableStore = _STORE) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.store = store

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def states(self) -> DataFrame:
        return states(self.source("nation")).drop("nation_key")

    def compute(self, grain: Grain) -> DataFrame:
        """The grain's Silver rows straight from the order tables."""
        t = self.source
        if grain == CATEGORY:
            cells = category_cells(t("orders"), t("customer"))
        elif grain == FUEL:
            cells = fuel_cells(t("lineitem"), t("orders"), t("customer"), t("part"))
        else:
            cells = manufacturer_cells(t("lineitem"), t("supplier"))
        return to_silver(cells, t("nation"), grain)

    def version(self) -> str:
        """Changes with the files that the tables consist of: names, sizes and times.

        Reads no contents. Files are listed once per application and folder.
        """
        place = (self.spark.sparkContext.applicationId, self.sf_dir)
        if place not in _VERSIONS:
            files = (
                self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .load([f"{self.sf_dir}/{name}.parquet" for name in TABLES])
            )
            mark = files.agg(
                F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")))
            _VERSIONS[place] = digest(*mark.first())
        return _VERSIONS[place]

    def _silver_path(self, *parts: str) -> str:
        return table_path(self.spark, f"silver-{self.version()}", *parts)

    def _write(self, grain: Grain) -> str:
        """Make sure that the grain's partition of the Silver table is there."""
        path = self._silver_path(f"dataset_type={grain.dataset_type}")
        self.store.ensure(path, lambda: self.compute(grain).drop("dataset_type"))
        return path

    def silver_part(self, grain: Grain) -> DataFrame:
        """One report; builds no other."""
        path = self._write(grain)
        reader = self.spark.read.schema(SILVER_SCHEMA).option("basePath", self._silver_path())
        return silver_columns(reader.parquet(path))

    def silver(self) -> DataFrame:
        """The whole Silver table, partitioned by dataset type."""
        for grain in GRAINS:
            self._write(grain)
        return silver_columns(self.spark.read.schema(SILVER_SCHEMA).parquet(self._silver_path()))

    def stage(self, name: str, build) -> DataFrame:
        """A Silver-shaped frame, kept as a table."""
        path = table_path(self.spark, f"{name}-{self.version()}")
        self.store.ensure(path, build)
        return silver_columns(self.spark.read.schema(SILVER_SCHEMA).parquet(path))

    def years(self) -> tuple[int, int]:
        """First and last year of the clean market: the years in scope."""
        path = self._silver_path()
        if path not in _YEARS:
            row = self.silver().agg(F.min("year"), F.max("year")).first()
            _YEARS[path] = (row[0] or 0, row[1] or 0)
        return _YEARS[path]

    def fact(self, grain: Grain) -> DataFrame:
        return fact(self.silver_part(grain), grain)

    def dirty(self) -> DataFrame:
        """The market with known faults, as the stage table that the checks read."""
        return self.stage("silver-soiled", lambda: soil(self.silver()))

    def report_lines(self) -> DataFrame:
        """The Bronze table: the market as lines of report text."""
        from tallymark.sources.rendered import report_lines

        path = table_path(self.spark, f"bronze-{self.version()}")
        self.store.ensure(path, lambda: report_lines(self.silver()))
        return self.spark.read.schema(LINE_SCHEMA).parquet(path)

    def report_heads(self) -> DataFrame:
        """The heads of the reports, stored beside their lines."""
        path = table_path(self.spark, f"bronze-heads-{self.version()}")
        heads = find_heads(self.report_lines())
        self.store.ensure(path, lambda: heads)
        return self.spark.read.schema(heads.schema).parquet(path)

    def scanned_lines(self) -> DataFrame:
        """The Bronze table from report files: the market written as CSV files and scanned.

        One more report lies among them without a byte, a delivery that broke off.
        """
        root = table_path(self.spark, f"reports-{self.version()}")
        broken_off = self.spark.range(1).select(F.lit(EMPTY_REPORT).alias("source_file"))
        self.store.once(root, lambda: write_reports(
            self.report_lines().unionByName(broken_off, allowMissingColumns=True), root))
        return scan_lines(self.spark, root, self.fresh_path("scanned"))

    def fresh_path(self, name: str) -> str:
        """A path of its own for every call: an earlier frame may still read its table."""
        return table_path(self.spark, f"{name}-{self.version()}-{self.store.next_number()}")

    def gold(self) -> Gold:
        """The eight Gold tables, written once and read back."""
        planned = build_gold(self.silver())
        written = {}
        for name, df in planned.tables().items():
            path = table_path(self.spark, f"gold-{self.version()}", name)
            self.store.ensure(path, lambda df=df: df)
            written[name] = self.spark.read.schema(df.schema).parquet(path)
        return Gold(**written)
