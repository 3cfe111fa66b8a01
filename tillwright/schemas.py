"""Column types of the five source files, stated once so that no read has to infer them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Money is decimal: sums come out the same whatever the order of tasks, retries included.
MONEY = DecimalType(18, 2)
UNIT_PRICE = DecimalType(18, 4)
RATE = DecimalType(9, 4)
KEY = LongType()

_INT, _DOUBLE, _TEXT, _DATE = IntegerType(), DoubleType(), StringType(), DateType()


def _struct(columns: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Columns of the source files.
CUSTOMER = _struct({
    "customer_id": KEY, "first_name": _TEXT, "last_name": _TEXT, "full_name": _TEXT,
    "email": _TEXT, "phone": _TEXT, "city": _TEXT, "state": _TEXT, "country": _TEXT,
    "age": _INT, "gender": _TEXT, "loyalty_tier": _TEXT, "join_date": _DATE,
    "is_active": _TEXT,
})
ITEM = _struct({
    "item_id": KEY, "item_name": _TEXT, "category": _TEXT, "sub_category": _TEXT,
    "brand": _TEXT, "unit_price": MONEY, "cost_price": MONEY, "weight_kg": _DOUBLE,
    "is_available": _TEXT, "launch_date": _DATE, "supplier_id": KEY,
})
STORE = _struct({
    "store_id": KEY, "store_name": _TEXT, "store_type": _TEXT, "city": _TEXT,
    "state": _TEXT, "country": _TEXT, "region": _TEXT, "sq_footage": _INT,
    "open_date": _DATE, "manager_name": _TEXT, "phone": _TEXT, "is_active": _TEXT,
})
CALENDAR = _struct({
    "date_id": _INT, "full_date": _DATE, "day": _INT, "month": _INT, "month_name": _TEXT,
    "quarter": _INT, "year": _INT, "week_of_year": _INT, "day_of_week": _INT,
    "day_name": _TEXT, "is_weekend": _TEXT, "is_holiday": _TEXT, "fiscal_quarter": _TEXT,
})
TRANSACTION = _struct({
    "transaction_id": KEY, "customer_id": KEY, "item_id": KEY, "store_id": KEY,
    "date_id": _INT, "quantity": _INT, "unit_price": UNIT_PRICE, "discount_pct": RATE,
    "discount_amount": MONEY, "gross_amount": MONEY, "net_amount": MONEY,
    "tax_amount": MONEY, "total_amount": MONEY, "payment_method": _TEXT, "channel": _TEXT,
    "return_flag": _TEXT, "transaction_status": _TEXT,
})

#: Columns a flat file spells "Y"/"N" and silver holds as booleans.
FLAGS = {
    "customer_dim": ("is_active",),
    "item_dim": ("is_available",),
    "store_dim": ("is_active",),
    "time_dim": ("is_weekend", "is_holiday"),
    "transactions": ("return_flag",),
}

SOURCES = {
    "customer_dim": CUSTOMER,
    "item_dim": ITEM,
    "store_dim": STORE,
    "time_dim": CALENDAR,
    "transactions": TRANSACTION,
}

# The file each source table is delivered in.
FILE_NAMES = {
    "customer_dim": "customer_dim.csv",
    "item_dim": "item_dim.csv",
    "store_dim": "store_dim.csv",
    "time_dim": "time_dim.csv",
    "transactions": "Trans_dim.csv",
}


def silver_types(table: str) -> dict:
    """Column types of a silver table: the source types with its flags as booleans."""
    flags = FLAGS[table]
    return {
        field.name: BooleanType() if field.name in flags else field.dataType
        for field in SOURCES[table]
    }
