"""The travel tables read out of an order database (lineitem, orders, customer, ...).

An order is a trip, its lines are flight legs, its returned lines are hotel stays and its
customer is the traveller. Each reader joins only the tables that the asked columns need:
the lookups are left joins on unique keys, so leaving one out never changes the rows.
Join sides are not hinted; Catalyst and AQE broadcast a side only below the size threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# The categories of the driver tables.
CLASSES = ("F", "O", "P")
AGENCIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FLIGHT_COLUMNS = ["travelCode", "userCode", "from", "to", "flightType", "price", "time",
                  "distance", "agency", "date"]
HOTEL_COLUMNS = ["travelCode", "userCode", "name", "place", "days", "price", "total", "date"]
USER_COLUMNS = ["code", "company", "name", "gender", "age"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nation(spark: SparkSession, sf_dir: str, key: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


def _supplier_city(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (supplier.join(_nation(spark, sf_dir, "s_nationkey", name), "s_nationkey", "left")
            .select("l_suppkey", name))


def flights(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Flight legs: one row per order line."""
    want = list(columns or FLIGHT_COLUMNS)
    df = table(spark, sf_dir, "lineitem").withColumnsRenamed({
        "l_orderkey": "travelCode", "l_extendedprice": "price", "l_quantity": "distance"})
    df = df.withColumn("date", F.col("l_shipdate").cast("date"))
    if "from" in want:
        df = df.join(_supplier_city(spark, sf_dir, "from"), "l_suppkey", "left")
    if {"userCode", "to", "flightType", "agency", "time"} & set(want):
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("travelCode"), F.col("o_custkey").alias("userCode"),
            F.col("o_orderstatus").alias("flightType"), F.col("o_orderpriority").alias("agency"),
            F.col("o_orderdate").cast("date").alias("_ordered"))
        if "to" in want:
            city = (table(spark, sf_dir, "customer")
                    .select(F.col("c_custkey").alias("userCode"), "c_nationkey")
                    .join(_nation(spark, sf_dir, "c_nationkey", "to"), "c_nationkey", "left")
                    .select("userCode", "to"))
            orders = orders.join(city, "userCode", "left")
        df = df.join(orders, "travelCode", "left")
        df = df.withColumn("time", F.datediff("date", "_ordered").cast("double"))
    return df.select(*want)


def hotels(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Hotel stays: the returned order lines, the brand being the hotel."""
    want = list(columns or HOTEL_COLUMNS)
    df = (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
          .withColumnsRenamed({"l_orderkey": "travelCode", "l_extendedprice": "total"})
          .withColumns({"days": F.col("l_quantity").cast("int"), "date": F.col("l_shipdate").cast("date")}))
    if {"name", "price"} & set(want):
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("name"),
            F.col("p_retailprice").alias("price"))
        df = df.join(part, "l_partkey", "left")
    if "place" in want:
        df = df.join(_supplier_city(spark, sf_dir, "place"), "l_suppkey", "left")
    if "userCode" in want:
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("travelCode"), F.col("o_custkey").alias("userCode"))
        df = df.join(orders, "travelCode", "left")
    return df.select(*want)


def users(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Travellers: the customers. The label column stands in from the region of their nation."""
    want = list(columns or USER_COLUMNS)
    df = table(spark, sf_dir, "customer").withColumnsRenamed({
        "c_custkey": "code", "c_mktsegment": "company", "c_name": "name"})
    df = df.withColumn("age", F.floor(F.col("c_acctbal") / 100).cast("int"))
    if "gender" in want:
        region = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        label = (F.when(F.col("n_regionkey") <= 1, "Male").when(F.col("n_regionkey") <= 3, " FEMALE ")
                 .otherwise("none"))
        df = df.join(region, "c_nationkey", "left").withColumn("gender", label)
    return df.select(*want)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread by key if their files give fewer splits than there are cores:
    cutting texts into n-grams costs far more than moving them."""
    docs = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores, "doc_id") if docs.rdd.getNumPartitions() < cores else docs


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their label where one is known: the text classification pool."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return (documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
            .join(labels, "doc_id", "left")
            .withColumn("known", F.col("label").isNotNull()))


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as a file stream."""
    schema = table(spark, sf_dir, "orders").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def requests(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Scoring requests: one per order. Some lack an origin, a date or a valid destination."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("_o"), F.col("n_name").alias("from"))
    home = (table(spark, sf_dir, "customer")
            .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("to")),
                  "c_nationkey", "left")
            .select(F.col("c_custkey").alias("o_custkey"), "to", "c_mktsegment", F.col("c_name").alias("name")))
    key = F.month("o_orderdate") * 2 + F.when(F.col("o_orderstatus") == "P", 3).otherwise(0)
    rich = F.col("o_totalprice") >= 100_000
    return (orders.withColumn("_o", key)
            .join(origin, "_o", "left").join(home, "o_custkey", "left")
            .select(F.col("o_orderkey").alias("request_id"), "from", "to", F.col("o_orderstatus").alias("flightType"),
                    F.col("o_orderpriority").alias("agency"),
                    F.when(rich, F.col("o_orderdate").cast("date")).alias("date"), "name",
                    F.when(F.col("o_orderpriority") == "5-LOW", F.col("c_mktsegment"))
                    .when(rich, F.col("to")).alias("destination"),
                    F.floor(F.col("o_totalprice") / 50_000).cast("int").alias("top_k")))
