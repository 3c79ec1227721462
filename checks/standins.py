"""The benchmark tables seen as flights, links, titles and lists of names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.sources.flights import COMPACT, FULL_POSITIONS, FULL_WIDTH
from tallywing.sources.names import last_named

# Fixed values.
DELIMITERS = " \t\r\n,.;:!?\"'()[]{}-_/*@"
STOP_WORDS = ["the", "and", "of", "in", "on", "die", "der", "und", "le", "la", "les", "el", "de", "en", "que"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def flights(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as parsed flights: supplier = airline, nations of customer and supplier = origin and destination.

    The joins are plain ones: Spark chooses their kind by size, and adaptive execution splits a hot key.
    """
    slot = ((F.col("l_partkey") * 37 + F.col("l_linenumber") * 401) % 2400).cast("int")
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    shipped = F.col("l_shipdate").cast("date")
    line = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_suppkey").alias("airline_id"),
        # Four digits, as flight numbers have: one may fly several legs a day.
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 10000).cast("int").alias("flight_num"),
        F.year(shipped).alias("year"),
        F.month(shipped).alias("month"),
        F.dayofmonth(shipped).alias("day"),
        shipped.cast("string").alias("flight_date"),
        shipped.alias("flight_day"),
        slot.alias("crs_dep_time"),
        slot.alias("dep_time"),
        ((slot + 131) % 2400).alias("crs_arr_time"),
        ((slot + 131) % 2400).alias("arr_time"),
        F.when(~cancelled, F.col("l_quantity").cast("int") - 20).alias("arr_delay"),
        F.when(~cancelled, (F.col("l_discount") > 0.05).cast("double")).alias("dep_del15"),
        F.when(~cancelled, (F.col("l_quantity") >= 35).cast("double")).alias("arr_del15"),
        cancelled.cast("double").alias("cancelled"),
    )
    # Orders meet customers first, so that the far larger lines are shuffled for their orders only.
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("origin"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    homes = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "origin")
    bases = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dest"))
    line = line.join(homes, F.col("l_orderkey") == F.col("o_orderkey")).join(bases, F.col("airline_id") == F.col("s_suppkey"))
    return line.drop("l_orderkey", "o_orderkey", "s_suppkey")


def airports(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def carriers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


def some_airports(spark: SparkSession, sf: str) -> DataFrame:
    """A list of names that lacks some ids and has others twice, the last being the one that counts."""
    nation = table(spark, sf, "nation").filter("n_regionkey <> 2")
    old = nation.filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("id"), F.lit("old").alias("name"), F.lit(1).alias("line"))
    return last_named(old.unionAll(nation.select("n_nationkey", "n_name", F.lit(2))), "line")


def some_carriers(spark: SparkSession, sf: str) -> DataFrame:
    """As ``some_airports``: airlines are named where their balance is positive."""
    supplier = table(spark, sf, "supplier").filter("s_acctbal > 0")
    old = supplier.filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.lit("old").alias("name"), F.lit(1).alias("line"))
    return last_named(old.unionAll(supplier.select("s_suppkey", "s_name", F.lit(2))), "line")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item links its order to its part and its supplier; orders and parts have lines of their own."""
    line = table(spark, sf, "lineitem")
    links = line.select(F.col("l_orderkey").alias("src"), F.explode(F.array("l_partkey", "l_suppkey")).alias("dst"))
    for name, key in (("orders", "o_orderkey"), ("part", "p_partkey")):
        links = links.unionAll(table(spark, sf, name).select(key, key))
    return links


def adjacency(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as adjacency text: each order links to its part and supplier, some with odd separators."""
    c = F.col
    usual = F.concat(c("l_orderkey"), F.lit(": "), c("l_partkey"), F.lit(" "), c("l_suppkey"))
    odd = F.concat(c("l_orderkey"), F.lit(":\t"), c("l_partkey"), F.lit("  x "), c("l_suppkey"), F.lit(" "))
    line = table(spark, sf, "lineitem")
    return line.select(F.when(c("l_linenumber") % 2 == 0, odd).otherwise(usual).alias("value"))


def league(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter("p_size = 7").select(F.col("p_partkey").alias("page"))


def titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("text").alias("value"))


def stop_words(spark: SparkSession) -> DataFrame:
    return spark.sql("values " + ", ".join(f"('{w}')" for w in STOP_WORDS)).toDF("word")


def flight_lines(flights: DataFrame, fields: list[str]) -> DataFrame:
    """Flights written out as comma-separated text, blank where NULL."""
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return flights.select(F.concat_ws(",", *values).alias("value"))


def full_lines(flights: DataFrame) -> DataFrame:
    """Flights written out in the 55-column layout: a quoted city with a comma, and cancellation blank where it is 0."""
    at = {position: name for name, position in FULL_POSITIONS.items()}

    def value(i: int) -> Column:
        if i == 12:
            return F.concat(F.lit('"City, '), F.col("origin").cast("string"), F.lit('"'))
        value = F.nullif(F.col("cancelled"), F.lit(0.0)) if at[i] == "cancelled" else F.col(at[i])
        return F.coalesce(value.cast("string"), F.lit(""))

    # Fields without a value are the commas between those that have one.
    filled = [i for i in range(FULL_WIDTH) if i == 12 or i in at]
    pieces = [x for i, before in zip(filled, [0, *filled]) for x in (F.lit("," * (i - before)), value(i))]
    return flights.select(F.concat(*pieces, F.lit("," * (FULL_WIDTH - 1 - filled[-1]))).alias("value"))


def gappy_lines(flights: DataFrame) -> DataFrame:
    """Flights as 16-column text in which some numbers and times are blank and delays have decimals."""
    blank = {"flight_num": 11, "dep_time": 13, "arr_time": 17}
    gappy = flights.withColumns({c: F.when((F.col("dep_time") + F.col("flight_num")) % m != 0, F.col(c)) for c, m in blank.items()})
    delay = F.concat(F.col("arr_delay").cast("string"), F.lit(".75"))
    return flight_lines(gappy.withColumn("arr_delay", delay), COMPACT)


def name_lines(names: DataFrame, name_at: int) -> DataFrame:
    """A list of names as the lines of a quoted CSV file: each name breaks its line, and lines lie in several splits."""
    quoted = [F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('"')), *[F.lit('""')] * (name_at - 1)]
    name = F.concat(F.lit('"'), F.col("name"), F.lit(', ""the\n'), F.col("name"), F.lit('"""\r'))
    text = names.select("id", F.concat_ws(",", *quoted, name).alias("text"))
    lines = text.select("id", F.posexplode(F.split("text", "\n")).alias("at", "value"))
    place = F.col("id").cast("bigint") * 2 + F.col("at")
    # A split ends within a record as often as between two.
    return lines.select("value", F.lit("file").alias("file"), F.floor(place / 7).alias("split"), place.alias("line"))


def league_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Page ids as text: blanks around some, some twice, and lines that are no number."""
    part = table(spark, sf, "part")
    ids = part.filter("p_size = 7").select(F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit("  ")).alias("value"))
    again = part.filter("p_size = 7 and p_partkey % 2 = 0").select(F.col("p_partkey").cast("string"))
    return ids.unionAll(again).unionAll(part.select("p_name"))


def scratch(spark: SparkSession) -> str:
    """A folder of its own for tables that a query stores, in the shared folder, gone when the session's process ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/checks-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
