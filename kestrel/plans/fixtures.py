"""The reference's inputs, derived by Spark from the test tables.

The reference reads tweets, movie ratings, taxi trips and HDFS log lines;
none ship with it. Each function here builds a table with the same columns
and meaning from the given Parquet tables, so every query's work grows with
them. The same derivations are written in SQL in ``kestrel.plans.oracle``.

- tweets: one per event; 14-digit packed timestamp from ``ts``; longitude
  from the user (none for every 37th user), latitude from the event type.
- ratings: one per line item; user = ordering customer, movie = part,
  rating = quantity / 10 plus 0.00 to 0.03, time = order date in epoch seconds.
- movies: one per part; genres = the words of the part name and its type,
  joined by pipes.
- trips: one per line item; pickup area = the customer's nation, dropoff
  area = the supplier's nation; miles = quantity, fare = extended price /
  1000, seconds = part key, start = ship date plus ``orderkey % 24`` hours.
  Every 97th customer starts in area 100, which nobody goes to, and every
  7th supplier is in area 200, where nobody starts. Some values are
  missing: pickup area (every 53rd order), dropoff tract (every 41st part),
  fare (every 59th part), miles (every 61st part).
- log lines: one per event, rendered as an HDFS-style line whose shape
  depends on the event type; arrival time = event time.
- supply graph: suppliers and parts as vertices, an edge each way per line
  item (a sparse bipartite graph where shortest paths run over two hops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.tables import read_table


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type"])
    return ev.select(
        F.date_format("ts", "yyyyMMddHHmmss").cast("long").alias("timestamp"),
        F.when(F.col("user_id") % 37 != 0, F.lit(-125.0) + F.col("user_id") * F.lit(0.5)).alias("longitude"),
        (F.lit(24.0) + F.length("event_type")).cast("double").alias("latitude"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("userId"),
                    F.col("l_partkey").alias("movieId"),
                    ((F.col("l_quantity") * 10 + F.col("l_orderkey") % 4) / 100).alias("rating"),
                    F.unix_timestamp("o_orderdate").alias("timestamp")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"), F.col("p_type"))
        .alias("genres"))


# Genres counted as valid on the test tables: part-name words and part types,
# some deliberately left out so the membership filter drops rows.
TEST_GENRES = ("small", "large", "hot", "cold", "red", "blue", "widget", "gear",
               "bolt", "plate", "ECONOMY", "PROMO", "STANDARD")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_shipdate"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    su = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    joined = (li.join(od, li.l_orderkey == od.o_orderkey)
              .join(cu, F.col("o_custkey") == cu.c_custkey)
              .join(su, F.col("l_suppkey") == su.s_suppkey))
    joined = joined.withColumns({
        "_pickup": F.when(F.col("l_orderkey") % 53 != 0,
                          F.when(F.col("c_custkey") % 97 == 0, F.lit(100)).otherwise(F.col("c_nationkey"))),
        "_dropoff": F.when(F.col("s_suppkey") % 7 == 0, F.lit(200)).otherwise(F.col("s_nationkey"))})
    return joined.select(
        (F.col("l_shipdate")
         + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"))).alias("trip_start"),
        F.col("l_partkey").alias("trip_seconds"),
        F.when(F.col("l_partkey") % 61 != 0, F.col("l_quantity")).alias("trip_miles"),
        F.when(F.col("l_partkey") % 59 != 0, F.col("l_extendedprice") / 1000).alias("fare"),
        F.col("_pickup").alias("pickup_area"),
        (F.lit(41.0) + F.col("_pickup") * F.lit(0.01)).alias("pickup_lat"),
        (F.lit(-87.0) - F.col("_pickup") * F.lit(0.01)).alias("pickup_lon"),
        (F.col("c_custkey") % 2).alias("pickup_tract"),
        F.col("_dropoff").alias("dropoff_area"),
        (F.lit(41.0) + F.col("_dropoff") * F.lit(0.01)).alias("dropoff_lat"),
        (F.lit(-87.0) - F.col("_dropoff") * F.lit(0.01)).alias("dropoff_lon"),
        F.when(F.col("l_partkey") % 41 != 0, F.col("s_suppkey") % 2).alias("dropoff_tract"),
    )


def tagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts whose words in ``a`` are hashtags."""
    docs = read_table(spark, sf_dir, "documents", ["text"])
    return docs.select(F.replace("text", F.lit(" a"), F.lit(" #a")).alias("text"))


def log_lines(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``(value, timestamp)`` like the socket source with arrival time.

    Shapes by event type: click is a DataNode receive line with a source
    host and a trailing size; view has a source host but no DataNode;
    purchase has no ``src:`` and ends in a port number; signup has no
    ``src:`` and trailing blanks after the size; error is a lower-case
    ``datanode`` line with no trailing number and no INFO."""
    ev = events if events is not None else read_table(
        spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    eid = F.col("event_id").cast("string")
    uid = F.col("user_id").cast("string")
    size = F.round(F.col("value") * 100).cast("long").cast("string")
    line = (F.when(F.col("event_type") == "click",
                   F.concat(F.lit("INFO dfs.DataNode$DataXceiver: Receiving block blk_"), eid,
                            F.lit(" src: /10.0.0."), uid,
                            F.lit(":50010 dest: /10.0.1.1:50010 of size "), size))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit("INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blk_"),
                           eid, F.lit(" src: /10.0.0."), uid, F.lit(":50010 stored, size "), size))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.lit("INFO dfs.DataNode$PacketResponder: Received block blk_"), eid,
                           F.lit(" of size "), size, F.lit(" from /10.0.0."), uid, F.lit(":50010")))
            .when(F.col("event_type") == "signup",
                  F.concat(F.lit("INFO dfs.DataNode$DataXceiver: Served block blk_"), eid,
                           F.lit(" to /10.0.0."), uid, F.lit(" of size "), size, F.lit("   ")))
            .otherwise(F.concat(F.lit("ERROR dfs.datanode: blk_"), eid, F.lit(" src: /10.0.0."),
                                uid, F.lit(":50010 checksum mismatch"))))
    return ev.select(line.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def _both_ways(df: DataFrame, miles: str) -> DataFrame:
    """Supplier-part rows (``l_suppkey``, ``l_partkey``, ``miles``) as one
    edge in each direction, from a single scan (an exploded pair)."""
    s_id = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    p_id = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    both = F.array(F.struct(s_id.alias("src"), p_id.alias("dst"), F.col(miles).alias("TripMiles")),
                   F.struct(p_id.alias("src"), s_id.alias("dst"), F.col(miles).alias("TripMiles")))
    return df.select(F.explode(both).alias("_e")).select("_e.*")


def supply_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supply graph's edges collapsed to one per (src, dst), carrying the
    pair's smallest quantity: the same rows as ``graph.min_per_pair`` over
    ``supply_graph``'s edges. The collapse runs on the numeric key pair
    (combined map-side, a fixed-width hash key) before the text ids are
    built, so half as many rows are grouped and no strings are hashed; both
    directions of a pair carry the same minimum."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_quantity"])
    pairs = li.groupBy("l_suppkey", "l_partkey").agg(F.min("l_quantity").alias("_min_qty"))
    return _both_ways(pairs, "_min_qty")


def supply_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vertices ``(id, kind)`` and edges ``(src, dst, TripMiles)`` of the
    supplier-part graph; ids are ``S<suppkey>`` and ``P<partkey>``."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_quantity"])
    edges = _both_ways(li, "l_quantity")
    su = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    pa = read_table(spark, sf_dir, "part", ["p_partkey"])
    vertices = (su.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
                          F.lit("supplier").alias("kind"))
                .unionByName(pa.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"),
                                       F.lit("part").alias("kind"))))
    return vertices, edges
