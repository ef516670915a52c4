"""Queries of streams and of files that are read by several tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundplan.queries import query, table
from groundplan.scratch import Scratch
from groundplan.sources import csv_split
from groundplan.streaming import schedule
from groundplan.streaming.ingest import file_stream, ingest


@query("""SELECT p_partkey::VARCHAR AS part, p_name || chr(10) || 'is "' || p_type || '", ' || p_brand AS note, CASE WHEN p_partkey % 3 <> 0 THEN chr(10) || p_size::VARCHAR END AS size FROM part""")
def split_csv(spark, sf):
    """Fields with quoted line breaks, commas and quotes, read by the tasks of a file's splits."""
    note = F.concat("p_name", F.lit('\nis "'), "p_type", F.lit('", '), "p_brand")
    size = F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("\n"), F.col("p_size").cast("string")))
    made = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("part"), note.alias("note"), size.alias("size"))
    path = f"{Scratch(spark, 'split').root}/notes"
    made.coalesce(2).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(path)
    return csv_split.read(spark, path)


@query("SELECT event_type, count_if(event_id % 50 <> 0) AS taken, count_if(event_id % 50 = 0) AS given_up FROM events GROUP BY 1")
def retried_ingest(spark, sf):
    """Events of which every fifth fails at its first fetch and every fiftieth always: three runs, two tries."""
    scratch = Scratch(spark, "retried")
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    scratch.save(spark.read.parquet(path), "arrived")
    k = F.col("event_id")
    fails = (k % 50 == 0) | ((k % 5 == 0) & (F.col("_try") == 0))
    parse = lambda b: b.withColumn("parsed", F.when(~fails, F.lit(True)))
    for _ in range(3):
        ingest(
            file_stream(spark, f"{scratch.root}/arrived", "parquet", schema), "event_id", parse, f"{scratch.root}/out", f"{scratch.root}/dead", f"{scratch.root}/checkpoint",
            retry=f"{scratch.root}/retry", tries=2,
        ).awaitTermination()
    of = lambda name: spark.read.parquet(f"{scratch.root}/{name}").select("event_type", F.lit(name).alias("place"))
    places = of("out").union(of("dead"))
    return places.groupBy("event_type").agg(F.count_if(F.col("place") == "out").alias("taken"), F.count_if(F.col("place") == "dead").alias("given_up"))


@query("""SELECT o_orderstatus AS source, count(*) AS taken, false AS failed FROM orders GROUP BY 1 UNION ALL SELECT 'down', 0, true UNION ALL SELECT 'unknown', 0, true""")
def scheduled_sources(spark, sf):
    """One query for each order status under one lease; two sources that fail stop none of them."""
    scratch = Scratch(spark, "scheduled")
    orders = table(spark, sf, "orders")
    names = [r[0] for r in orders.select("o_orderstatus").distinct().collect()]
    orders.write.partitionBy("o_orderstatus").parquet(f"{scratch.root}/in")
    schema = spark.read.parquet(f"{scratch.root}/in").drop("o_orderstatus").schema

    def source(name: str, parse):
        def start(spark):
            there = name if name in names else names[0]
            stream = file_stream(spark, f"{scratch.root}/in/o_orderstatus={there}", "parquet", schema)
            return ingest(stream, "o_orderkey", parse, *[f"{scratch.root}/{name}/{x}" for x in ("out", "dead", "checkpoint")])

        return start

    def down(batch):
        raise RuntimeError("the site is down")

    def unknown(spark):
        raise ValueError("no such site")

    sources = {n: source(n, lambda b: b.withColumn("parsed", F.lit(True))) for n in names}
    out = schedule.run_once(spark, sources | {"down": source("down", down), "unknown": unknown}, schedule.Lease(spark, f"{scratch.root}/lease"))
    count = lambda n: spark.read.parquet(f"{scratch.root}/{n}/out").count() if out.errors[n] is None else 0
    return spark.createDataFrame([(n, count(n), out.errors[n] is not None) for n in out.errors], "source string, taken long, failed boolean")
