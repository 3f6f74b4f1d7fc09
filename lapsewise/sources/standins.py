"""Warehouse inputs derived from the driver's TPC-H-style tables.

Mapping (every row of the source tables is used):

* raw client feed  <- ``customer`` + ``nation``: client_id = c_custkey,
  name = c_name, income = c_acctbal (missing when negative), province =
  n_name.  The feed arrives twice (two deliveries of the same extract), so
  every client has an exact duplicate; ``_file``/``_line`` give file order.
* products         <- ``part``: product_id = 'prod_' + zero-padded
  (p_partkey + 1), product_name = p_name, tier = p_type, status = p_brand.
* policy bridge    <- ``orders``: policy_id = o_orderkey, client_id =
  o_custkey, product by the modulo rule over the number of parts.
* lapse events     <- ``lineitem``: policy_id = l_orderkey, lapse_date =
  l_shipdate, premium_amount = l_extendedprice, status from l_returnflag;
  the order (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  l_extendedprice, l_returnflag) stands in for insertion order (rows tied on
  all of these produce identical fact rows).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import schemas
from lapsewise.functions.text import pad_key

# Lapse status for each return flag of the stand-in fact.
STATUS_BY_FLAG = {"R": "Lapsed", "A": "Active", "N": "Pending"}

CLIENT_ORDER = ["_file", "_line"]
LAPSE_ORDER = ["_k1", "_k2", "_k3", "_k4", "_k5", "_k6", "_k7"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def client_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per customer (a single delivery of the client extract)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
        .cast(schemas.MONEY_12_2)
        .alias("income"),
        F.col("n_name").alias("province"),
    )


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client feed as delivered: two deliveries, in file order."""
    base = client_records(spark, sf_dir)
    first = base.withColumn("_file", F.lit(0))
    second = base.withColumn("_file", F.lit(1))
    return first.unionByName(second).withColumn("_line", F.col("client_id"))


class KeyRange(NamedTuple):
    """The keys of a table: its rows, its least key, and whether the keys are not ``rows`` in a row from there."""

    rows: int
    first: int
    gaps: bool


def key_range(spark: SparkSession, sf_dir: str, name: str, key: str) -> KeyRange:
    got = table(spark, sf_dir, name).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.count_distinct(key).alias("d")).first()
    return KeyRange(got.n, got.lo, got.n != got.d or (got.n > 0 and got.n != got.hi - got.lo + 1))


_PRODUCT_COUNTS: dict[str, int] = {}


def product_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of products (Parquet footer metadata; no data scan).

    The input tables are read-only, so the count is remembered per folder.
    """
    key = sf_dir.rstrip("/")
    if key not in _PRODUCT_COUNTS:
        _PRODUCT_COUNTS[key] = table(spark, sf_dir, "part").count()
    return _PRODUCT_COUNTS[key]


# Product ids are padded to at least this many digits, whatever their number.
PRODUCT_KEY_WIDTH = 3


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("prod_"), pad_key(F.col("p_partkey") + 1, PRODUCT_KEY_WIDTH)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("tier"),
        F.col("p_brand").alias("status"),
    )


def policy(spark: SparkSession, sf_dir: str, n_products: int | None = None) -> DataFrame:
    n = n_products or product_count(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    product = F.concat(
        F.lit("prod_"), pad_key(F.pmod(F.col("o_orderkey"), F.lit(n)) + 1, PRODUCT_KEY_WIDTH)
    )
    return o.select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("o_custkey").alias("client_id"),
        product.alias("product_id"),
    )


def raw_lapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lapse events as they arrive (date still a timestamp, price a double)."""
    li = table(spark, sf_dir, "lineitem")
    status = F.create_map(*[F.lit(x) for kv in STATUS_BY_FLAG.items() for x in kv])
    return li.select(
        F.col("l_orderkey").alias("policy_id"),
        F.col("l_shipdate").alias("lapse_date"),
        F.col("l_extendedprice").alias("premium_amount"),
        status[F.col("l_returnflag")].alias("status"),
        F.col("l_orderkey").alias("_k1"),
        F.col("l_linenumber").alias("_k2"),
        F.col("l_partkey").alias("_k3"),
        F.col("l_suppkey").alias("_k4"),
        F.col("l_shipdate").alias("_k5"),
        F.col("l_extendedprice").alias("_k6"),
        F.col("l_returnflag").alias("_k7"),
    )


# ----------------------------------------------------------- text exports
# Header-less delimited exports derived from the tables, one text file per
# scan partition, each starting with its dataset's preamble.

# Preamble lines and extra field of the derived exports.
PRODUCT_PREAMBLE = ["--- PRODUCT CATALOGUE EXPORT ---", ""]
CUSTOMER_PREAMBLE = ["# customer extract", "# fields are positional", ""]
RAGGED_SUFFIX = "|discontinued"


def _prepend(preamble: list[str]):
    def run(batches):
        import pandas as pd

        started = False
        for batch in batches:
            if len(batch) == 0:
                continue
            if not started and preamble:
                yield pd.DataFrame({"value": preamble})
            started = True
            yield batch[["value"]]

    return run


def _write_lines(lines: DataFrame, order: list[str], preamble: list[str], path: str) -> None:
    from lapsewise.session import ship_package

    ship_package(lines.sparkSession)
    (
        lines.sortWithinPartitions(*order)
        .select("value")
        .mapInPandas(_prepend(preamble), "value string")
        .write.mode("overwrite")
        .text(path)
    )


def write_text_exports(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    datasets: tuple[str, ...] = ("products", "suppliers", "customers"),
    ragged_lines: bool = True,
) -> dict[str, str]:
    """Write the exports named in ``datasets`` under ``root``; returns their folders.

    With ``ragged_lines`` some product lines have a field too many.
    """
    part = table(spark, sf_dir, "part")
    pid = F.concat(F.lit("prod_"), pad_key(F.col("p_partkey") + 1, PRODUCT_KEY_WIDTH))
    shown_id = F.when(F.col("p_size") > 25, F.upper(pid)).otherwise(pid)
    body = F.concat_ws(
        "|",
        F.concat(shown_id, F.lit(" ")),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("\t")),
        F.concat(F.lit(" "), F.col("p_type")),
        F.concat(F.col("p_brand"), F.lit(" ")),
    )
    ragged = (F.col("p_size") > 45) & F.lit(ragged_lines)
    products_lines = part.select(
        F.when(ragged, F.concat(body, F.lit(RAGGED_SUFFIX))).otherwise(body).alias("value"),
        ragged.alias("_ragged"),
        "p_partkey",
    )
    supplier = table(spark, sf_dir, "supplier")
    supplier_lines = supplier.select(
        F.concat_ws(
            ",",
            F.concat(F.lit("SUP-"), F.col("s_suppkey").cast("string")),
            F.col("s_name"),
            F.col("s_nationkey").cast("string"),
        ).alias("value"),
        "s_suppkey",
    )
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    customer_lines = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        F.concat_ws(
            "\t",
            F.col("c_custkey").cast("string"),
            F.col("c_name"),
            F.col("c_nationkey").cast("string"),
            F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
            F.col("c_mktsegment"),
            F.col("n_name"),
        ).alias("value"),
        "c_custkey",
    )
    root = root.rstrip("/")
    out = {
        "products": f"{root}/products",
        "suppliers": f"{root}/suppliers",
        "customers": f"{root}/customers",
    }
    from lapsewise.session import run_concurrently

    jobs = {
        "products": lambda: _write_lines(
            products_lines, ["_ragged", "p_partkey"], PRODUCT_PREAMBLE, out["products"]
        ),
        "suppliers": lambda: _write_lines(supplier_lines, ["s_suppkey"], [], out["suppliers"]),
        "customers": lambda: _write_lines(
            customer_lines, ["c_custkey"], CUSTOMER_PREAMBLE, out["customers"]
        ),
    }
    run_concurrently(*[jobs[d] for d in datasets])
    return {k: v for k, v in out.items() if k in datasets}
