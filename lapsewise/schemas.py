"""Typed table definitions of the warehouse (star schema) and its inputs.

Column metadata carries the privacy tags (``pii``) and declared string
lengths (``max_length``) that the quality checks read back.  Identifier
columns are 64-bit: at warehouse scale policy and client keys exceed the
32-bit range.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name, dtype, nullable=True, *, pii=False, max_length=None, comment=None):
    meta = {}
    if pii:
        meta["pii"] = True
    if max_length is not None:
        meta["max_length"] = max_length
    if comment:
        meta["comment"] = comment
    return T.StructField(name, dtype, nullable, metadata=meta)


MONEY_12_2 = T.DecimalType(12, 2)
MONEY_10_2 = T.DecimalType(10, 2)

DIM_CLIENTS = T.StructType([
    _f("client_id", T.LongType(), False),
    _f("name", T.StringType(), False, pii=True, max_length=100,
       comment="PII: full name, kept out of analytical models"),
    _f("income", MONEY_12_2, True, pii=True,
       comment="PII: income; missing values imputed downstream"),
    _f("province", T.StringType(), False, max_length=50),
])

DIM_PRODUCTS = T.StructType([
    _f("product_id", T.StringType(), False, max_length=10),
    _f("product_name", T.StringType(), False, max_length=100),
    _f("tier", T.StringType(), False, max_length=20),
    _f("status", T.StringType(), False, max_length=20),
])

DIM_DATE = T.StructType([
    _f("date_key", T.IntegerType(), False),
    _f("full_date", T.DateType(), False),
    _f("year", T.IntegerType(), False),
    _f("quarter", T.IntegerType(), False),
    _f("month", T.IntegerType(), False),
    _f("month_name", T.StringType(), False, max_length=20),
    _f("day", T.IntegerType(), False),
    _f("day_of_week", T.IntegerType(), False),
    _f("day_name", T.StringType(), False, max_length=20),
    _f("is_weekend", T.BooleanType(), False),
    _f("is_month_start", T.BooleanType(), False),
    _f("is_month_end", T.BooleanType(), False),
])

DIM_POLICY = T.StructType([
    _f("policy_id", T.LongType(), False),
    _f("client_id", T.LongType(), False),
    _f("product_id", T.StringType(), False, max_length=10),
])

FCT_HEALTH_LAPSES = T.StructType([
    _f("lapse_id", T.LongType(), False),
    _f("policy_id", T.LongType(), False),
    _f("lapse_date", T.DateType(), False),
    _f("date_key", T.IntegerType(), False),
    _f("premium_amount", MONEY_10_2, False),
    _f("status", T.StringType(), False, max_length=20),
])

# Raw inputs.  The client file is read with an explicit schema: inference
# would need an extra pass over the data.
RAW_CLIENTS_CSV = T.StructType([
    _f("client_id", T.StringType()),
    _f("name", T.StringType(), pii=True),
    _f("income", T.StringType(), pii=True),
    _f("province", T.StringType()),
])

PRODUCTS_CSV = T.StructType([
    _f("product_id", T.StringType()),
    _f("product_name", T.StringType()),
    _f("tier", T.StringType()),
    _f("status", T.StringType()),
])

# Primary keys, unique keys and foreign keys of the star schema; the data
# quality module turns these into checks.
PRIMARY_KEYS = {
    "dim_clients": ["client_id"],
    "dim_products": ["product_id"],
    "dim_date": ["date_key"],
    "dim_policy": ["policy_id"],
    "fct_health_lapses": ["lapse_id"],
}
UNIQUE_KEYS = {"dim_date": [["full_date"]]}
FOREIGN_KEYS = [
    # (child table, child column, parent table, parent column)
    ("dim_policy", "client_id", "dim_clients", "client_id"),
    ("dim_policy", "product_id", "dim_products", "product_id"),
    ("fct_health_lapses", "policy_id", "dim_policy", "policy_id"),
    ("fct_health_lapses", "date_key", "dim_date", "date_key"),
]

TABLES = {
    "dim_clients": DIM_CLIENTS,
    "dim_products": DIM_PRODUCTS,
    "dim_date": DIM_DATE,
    "dim_policy": DIM_POLICY,
    "fct_health_lapses": FCT_HEALTH_LAPSES,
}


def pii_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("pii")]


def length_limits(schema: T.StructType) -> dict[str, int]:
    return {
        f.name: f.metadata["max_length"]
        for f in schema.fields
        if "max_length" in f.metadata
    }


def not_null_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
