"""The five retail source tables, derived from order-processing tables.

Gives the rows a flat-file delivery would hold, in the columns and types of `schemas`, from
tables `customer nation region part supplier orders lineitem` kept as Parquet in one folder.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillwright.functions.dates import date_key
from tillwright.functions.money import cents, line_amounts, rate
from tillwright.operators.joins import attach
from tillwright.plans import silver
from tillwright.schemas import (
    CALENDAR,
    CUSTOMER,
    ITEM,
    MONEY,
    RATE,
    SOURCES,
    STORE,
    TRANSACTION,
    UNIT_PRICE,
)
from tillwright.sources.calendar import calendar_over

# Columns of the order tables, so that opening one does not read its files.
TABLES = {
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
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

# Labels given to codes of the order tables.
GENDERS = ("Male", "Female", "Other")
STORE_TYPES = ("Flagship", "Express", "Standard", "Premium")
CHANNELS = ("In-Store", "Online", "Mobile App")
TIER_OF_SEGMENT = {
    "AUTOMOBILE": "Bronze",
    "BUILDING": "Silver",
    "MACHINERY": "Gold",
    "HOUSEHOLD": "Platinum",
    "FURNITURE": "Unclassified",
}
STATUS_OF_ORDER = {"F": "Completed", "O": "Pending", "P": "Refunded"}


def _pick(number: Column, labels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (number % len(labels) + 1).cast("int"))


def _translate(code: Column, labels: dict[str, str]) -> Column:
    translated = F.lit(None).cast("string")
    for key, label in labels.items():
        translated = F.when(code == key, label).otherwise(translated)
    return translated


def _hundredths(value: Column) -> Column:
    """A double written with at most two decimals, in whole hundredths."""
    return F.rint(value * 100).cast("bigint")


def _scaled(units: Column, kind: DecimalType, places: int) -> Column:
    """Whole units of the given decimal place as a decimal; a cast from double would go through
    text and take several times as long."""
    unit = F.lit(f"1e-{places}").cast(f"decimal({places},{places})")
    return (units.cast("decimal(16,0)") * unit).cast(kind)


def _exact(value: Column, kind: DecimalType) -> Column:
    return _scaled(_hundredths(value), kind, 2)


def _price_per_unit(line_price: Column, quantity: Column) -> Column:
    """Half-up to four decimals, in whole numbers throughout."""
    ten_thousandths = F.floor((_hundredths(line_price) * 200 + quantity) / (quantity * 2))
    return _scaled(ten_thousandths, UNIT_PRICE, 4)


def _day_offset(first: str, number: Column, days: int) -> Column:
    return F.date_add(F.lit(first).cast("date"), (number % days).cast("int"))


_repeated: dict[tuple[str, ...], tuple[str, ...]] = {}


class Star:
    """Source-shaped ("raw") and silver tables over one folder of order tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(TABLES[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _stamp(self, name: str) -> str:
        """Size, number of files and time of a table's folder: another one when it was written anew."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        held = files.getContentSummary(path)
        return f"{held.getLength()}:{held.getFileCount()}:{files.getFileStatus(path).getModificationTime()}"

    def silver(self, as_of=None) -> "SilverStar":
        return SilverStar(self, as_of)

    def _places(self, prefix: str) -> DataFrame:
        """Nation and region names, keyed by the nation key of the table to enrich."""
        nation, region = self.table("nation"), self.table("region")
        named = attach(
            nation.withColumnRenamed("n_regionkey", "r_regionkey"), region, "r_regionkey", "inner"
        )
        return named.select(F.col("n_nationkey").alias(f"{prefix}_nationkey"), "n_name", "r_name")

    @cached_property
    def customers(self) -> DataFrame:
        rows = attach(self.table("customer"), self._places("c"), "c_nationkey", "inner")
        key, name = F.col("c_custkey"), F.col("c_name")
        digits = F.substring_index(name, "#", -1)
        return rows.select(
            key.alias("customer_id"),
            F.substring_index(name, "#", 1).alias("first_name"),
            digits.alias("last_name"),
            F.concat(F.lit(" "), F.lower(F.translate(name, "#", " ")), F.lit(" ")).alias("full_name"),
            F.concat(F.lit("  "), F.upper(name), F.lit("@EMAIL.com ")).alias("email"),
            F.concat(F.lit("+1-"), digits).alias("phone"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("country"),
            (18 + key % 58).cast("int").alias("age"),
            _pick(key, GENDERS).alias("gender"),
            _translate(F.col("c_mktsegment"), TIER_OF_SEGMENT).alias("loyalty_tier"),
            _day_offset("1995-01-01", key, 2191).alias("join_date"),
            F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N").alias("is_active"),
        ).to(CUSTOMER)

    @cached_property
    def items(self) -> DataFrame:
        key = F.col("p_partkey")
        price = ((_exact(F.col("p_retailprice"), MONEY) - 900) * 4 + 10).cast(MONEY)
        cost = cents(price * (rate("0.45") + F.col("p_size") * rate("0.012")))
        return self.table("part").select(
            key.alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            F.col("p_brand").alias("brand"),
            price.alias("unit_price"),
            cost.alias("cost_price"),
            F.col("p_size").cast("double").alias("weight_kg"),
            F.lit("Y").alias("is_available"),
            _day_offset("1995-01-01", key, 1827).alias("launch_date"),
            (1 + key % 20).alias("supplier_id"),
        ).to(ITEM)

    @cached_property
    def stores(self) -> DataFrame:
        rows = attach(self.table("supplier"), self._places("s"), "s_nationkey", "inner")
        key, digits = F.col("s_suppkey"), F.substring_index("s_name", "#", -1)
        return rows.select(
            key.alias("store_id"),
            F.col("s_name").alias("store_name"),
            _pick(key, STORE_TYPES).alias("store_type"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.upper("n_name").alias("country"),
            F.col("r_name").alias("region"),
            (2000 + (key * 37) % 18001).cast("int").alias("sq_footage"),
            _day_offset("1990-01-01", key, 3653).alias("open_date"),
            F.concat(F.lit("Manager "), digits).alias("manager_name"),
            F.concat(F.lit("+1-"), digits).alias("phone"),
            F.lit("Y").alias("is_active"),
        ).to(STORE)

    @cached_property
    def calendar(self) -> DataFrame:
        """Every day from the first to the last order; the two are read when it is asked for."""
        day = F.col("o_orderdate").cast("date")
        bounds = self.table("orders").agg(F.min(day).alias("start"), F.max(day).alias("end"))
        return calendar_over(bounds).to(CALENDAR)

    @cached_property
    def key_tables(self) -> dict[str, DataFrame]:
        """Per key of a sales line the table that holds it before any join."""
        lines = self.table("lineitem").select(
            F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("store_id")
        )
        orders = self.table("orders").select(
            F.col("o_custkey").alias("customer_id"),
            date_key(F.col("o_orderdate").cast("date")).alias("date_id"),
        )
        return {"item_id": lines, "store_id": lines, "customer_id": orders, "date_id": orders}

    @cached_property
    def repeated_keys(self) -> tuple[str, ...]:
        """Keys that some dimension holds more than once; looked for once per session and state of the tables."""
        stamps = [self._stamp(t) for t in ("customer", "nation", "region", "part", "supplier", "orders")]
        known = (self.spark.sparkContext.applicationId, self.folder, *stamps)
        if known not in _repeated:
            tables = {
                "customer_id": self.customers, "item_id": self.items, "store_id": self.stores,
                "date_id": self.calendar,
            }
            _repeated[known] = tuple(
                key for key, df in tables.items()
                if not df.groupBy(key).count().where("count > 1").isEmpty()
            )
        return _repeated[known]

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with their order, in retail types."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus",
            F.col("o_orderdate").cast("date").alias("order_date"), "o_orderpriority",
        )
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
            F.col("l_quantity").cast("int").alias("quantity"),
            _exact(F.col("l_extendedprice"), MONEY).alias("line_price"),
            _price_per_unit(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
            _exact(F.col("l_discount"), RATE).alias("discount_pct"),
            _exact(F.col("l_tax"), RATE).alias("tax_rate"),
        )
        return attach(lines, orders, "l_orderkey", "inner")

    @cached_property
    def transactions(self) -> DataFrame:
        amounts = line_amounts(F.col("line_price"), F.col("discount_pct"), F.col("tax_rate"))
        return self.order_lines.select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("store_id"),
            date_key(F.col("order_date")).alias("date_id"),
            "quantity",
            "unit_price",
            "discount_pct",
            *[amount.alias(name) for name, amount in amounts.items()],
            F.col("o_orderpriority").alias("payment_method"),
            _pick(F.col("l_linenumber"), CHANNELS).alias("channel"),
            F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("return_flag"),
            _translate(F.col("o_orderstatus"), STATUS_OF_ORDER).alias("transaction_status"),
        ).to(TRANSACTION)

    def raw(self) -> dict[str, DataFrame]:
        """The source tables by their source names."""
        frames = (self.customers, self.items, self.stores, self.calendar, self.transactions)
        return dict(zip(SOURCES, frames, strict=True))


class SilverStar(Mapping):
    """Silver tables over a star, under the names the quality rules use; built when asked for."""

    def __init__(self, star: Star, as_of=None):
        self._make = {
            "customers": lambda: silver.silver_customer(star.customers, as_of),
            "items": lambda: silver.silver_item(star.items),
            "stores": lambda: silver.silver_store(star.stores, as_of),
            "calendar": lambda: silver.silver_calendar(star.calendar),
            "txns": lambda: silver.silver_transactions(star.transactions),
        }
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)
