"""Queries that write rows of the raw tables in a foreign layout and read them back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.money import total
from millrace.functions.text import blank, words
from millrace.operators.relational import match
from millrace.registry import Tables, query
from millrace.session import scratch
from millrace.sinks import folders
from millrace.sources import files, keyed_logs

col = F.col


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


# positions of the values in one row of the names document (fixed values)
NAME_FIELDS = [("sid", "bigint"), ("id", "string"), ("position", "bigint"), ("created_at", "bigint"),
               ("created_meta", "string"), ("updated_at", "bigint"), ("updated_meta", "string"), ("meta", "string"),
               ("year", "int"), ("first_name", "string"), ("county", "string"), ("sex", "string"), ("count", "bigint")]


@query
def s1_positional_json(t: Tables):
    """Documents of a thousand orders each; values by position."""
    n = F.lit(None).cast("string")
    values = [text_of("o_orderkey"), F.concat(F.lit("row-"), text_of("o_orderkey")), F.lit("0"),
              F.unix_timestamp(col("o_orderdate").cast("timestamp")).cast("string"), n,
              F.unix_timestamp(col("o_orderdate").cast("timestamp")).cast("string"), n, F.lit("{ }"),
              F.year("o_orderdate").cast("string"), col("o_orderstatus"), col("o_orderpriority"),
              F.when(col("o_custkey") % 2 == 0, "F").otherwise("M"), text_of("o_custkey")]
    docs = t.orders.groupBy((F.floor(col("o_orderkey") / 1000)).alias("doc")).agg(
        F.to_json(F.struct(F.collect_list(F.array(*values)).alias("data"))).alias("value"))
    path = scratch(t.spark, "names")
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)  # a file is one document
    rows = files.positional_json(t.spark, path, NAME_FIELDS)
    return rows.groupBy("year", "first_name", "sex").agg(F.count("*").alias("n"), F.sum("count").alias("total"))


@query
def s2_json_lines(t: Tables):
    path = scratch(t.spark, "events")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(path)
    return files.json_lines(t.spark, path).groupBy("event_type").agg(F.count("*").alias("n"), total("value").alias("value"))


@query
def s3_schema_append(t: Tables):
    """Two loads of JSON lines into the same table."""
    path, target = scratch(t.spark, "lines"), scratch(t.spark, "loaded")
    schema = "event_id bigint, event_type string, value double"
    t.events.where("event_id % 2 = 0").select("event_id", "event_type", "value").write.json(path + "/a")
    t.events.where("event_id % 2 = 1").select("event_id", "event_type", "value").write.json(path + "/b")
    for part in ("a", "b"):
        files.append_json(t.spark, f"{path}/{part}", schema, target)
    return t.spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query
def s4_csv_header(t: Tables):
    path = scratch(t.spark, "parts")
    t.part.write.csv(path, header=True)
    return files.csv_with_header(t.spark, path).groupBy("p_type").agg(
        F.count("*").alias("n"), F.sum("p_size").alias("size"), total("p_retailprice").alias("worth"))


@query
def s5_csv_schema(t: Tables):
    path = scratch(t.spark, "suppliers")
    t.supplier.write.csv(path)
    return files.csv_plain(t.spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@query
def s6_pipe_delimited(t: Tables):
    """Lines end with a separator, as table generators write them."""
    path = scratch(t.spark, "orders")
    line = F.concat_ws("|", *[text_of(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")], F.lit(""))
    t.orders.select(line).write.text(path)
    rows = files.pipe_delimited(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"))


@query
def s7_stacked_csv(t: Tables):
    path = scratch(t.spark, "wine")
    part = t.part.select("p_size", col("p_retailprice").alias("retail price"), "p_type")
    for i, kind in enumerate((col("p_type") != "LARGE", col("p_type") == "LARGE")):
        part.where(kind).drop("p_type").write.csv(f"{path}/{i}", header=True, sep=";")
    rows = files.stacked_csv(t.spark, [f"{path}/0", f"{path}/1"], "is_large")
    return rows.groupBy("is_large").agg(F.count("*").alias("n"), total("retail_price").alias("worth"))


@query
def s8_text_lines(t: Tables):
    path = scratch(t.spark, "text")
    t.documents.select(F.concat("text", F.lit("\n\n  "))).write.text(path)
    lines = files.text_lines(t.spark, path)
    return lines.agg(F.count("*").alias("lines"), F.count_if(blank(col("value"))).alias("empty"),
                     F.sum(F.size(words(col("value"), True))).alias("words"))


@query
def s9_table_folders(t: Tables):
    """Partitioned Parquet folders found by name, with partition discovery."""
    path = scratch(t.spark, "tables")
    t.orders.withColumn("year", F.year("o_orderdate")).write.partitionBy("year").parquet(f"{path}/orders")
    t.customer.write.parquet(f"{path}/customer")
    for name in ("orders", "customer"):
        t.spark.read.parquet(f"{path}/{name}").createOrReplaceTempView(f"stored_{name}")
    return t.spark.sql("""select c_mktsegment, count(*) as n from stored_orders join stored_customer on c_custkey = o_custkey
                          where year = 1998 group by c_mktsegment""")


@query
def s10_daily_logs(t: Tables):
    """Grouped blocks read by a pattern of file names; the day is in the name."""
    return grant_blocks(t).groupBy("dt").agg(F.count("*").alias("n"))


def keyed_lines(t: Tables, name: str, body) -> str:
    """Write ``{user: payload}`` lines to files of one folder that are named ``<name>_<day>_<number>.json``."""
    path = scratch(t.spark, name)
    line = F.to_json(F.create_map(F.col("user_id").cast("string"), body))
    e = t.events.select(F.date_format("ts", "yyyyMMdd").alias("day"), line.alias("value"))
    e.hint("rebalance", "day").write.partitionBy("day").text(path + "/parts")
    e.select("value").limit(0).write.text(path + "/logs")
    for day in folders.children(t.spark, path + "/parts"):  # names of files, no rows
        if day.startswith("day="):
            parts = [f for f in folders.children(t.spark, f"{path}/parts/{day}") if f.startswith("part-")]
            for i, part in enumerate(parts):
                folders.move(t.spark, f"{path}/parts/{day}/{part}", f"{path}/logs/{name}_{day[4:]}_{i}.json")
    return f"{path}/logs/{name}_*.json"


def record(fields: tuple[str, ...], i) -> Column:
    made = {"username": F.col("user_id").cast("string"), "ip": F.concat(F.lit("10.0.0."), i.cast("string")),
            "target": F.col("event_type")}
    return F.struct(*[made.get(f, F.concat(F.lit(f + "-"), i.cast("string"))).alias(f) for f in fields])


def repeated(fields: tuple[str, ...]) -> Column:
    n = (F.col("event_id") % 3 + 1).cast("int")
    return F.transform(F.sequence(F.lit(1), n), lambda i: record(fields, i))


def repeated_rows(t: Tables, name: str, fields: tuple[str, ...]):
    path = keyed_lines(t, name, repeated(fields))
    return keyed_logs.repeated_records(files.daily_logs(t.spark, path), fields)


def grant_blocks(t: Tables):
    return repeated_rows(t, "grant", keyed_logs.GRANT_BLOCK)


def per_user(rows):
    return rows.groupBy("userkey").agg(F.count("*").alias("n"), F.sum(F.size("rec")).alias("items"),
                                       F.max(F.element_at("rec", -1)["ip"]).alias("last_ip"))


@query
def n1_grant_blocks(t: Tables):
    return per_user(grant_blocks(t))


@query
def n2_sso_access(t: Tables):
    return per_user(repeated_rows(t, "sso", keyed_logs.SSO_ACCESS))


@query
def n3_tunnel_blocks(t: Tables):
    return per_user(repeated_rows(t, "tunnel", keyed_logs.TUNNEL_BLOCK))


@query
def n4_app_access(t: Tables):
    """Lists per user, some of them null in the input."""
    odd = col("event_id") % 2 == 1
    body = F.struct(
        F.when(odd, F.array(col("event_type"))).alias("target"),
        F.array((col("event_id") % 5).cast("int"), F.lit(7)).alias("authLevel"),
        F.array(F.lit("north")).alias("geolocation"), F.array(F.lit("agent")).alias("userAgent"),
        F.when(~odd, F.array(F.lit("a"), F.lit("b"))).alias("appflag"), F.array(F.lit("10.0.0.1")).alias("ip"),
        F.when(odd, "high").alias("hitDictLevel"))
    path = keyed_lines(t, "access", body)
    rows = keyed_logs.list_records(files.daily_logs(t.spark, path))
    return rows.groupBy("user_name").agg(
        F.count("*").alias("n"), F.sum(F.size("target")).alias("targets"), F.sum(F.size("appflag")).alias("flags"),
        F.sum(F.aggregate("authLevel", F.lit(0), lambda a, x: a + x)).alias("levels"),
        F.count_if(col("hitDictLevel") == "").alias("without_level"))


@query
def s11_projected_read(t: Tables):
    kept = files.projected(t.events, ["event_type", "user_id"], "value > 5")
    return kept.agg(F.count_distinct("event_type").alias("types"), F.count_distinct("user_id").alias("users"))


@query
def s14_numbered_rows(t: Tables):
    """Numbered test rows matched with the orders of the same number."""
    last = t.orders.agg(F.max("o_orderkey").alias("m")).first()["m"]
    rows = files.numbered_rows(t.spark, 0, last + 1)
    return match(rows, t.orders, num="o_orderkey").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.max(F.length("text")).cast("bigint").alias("longest"))


@query
def s15_table_format(t: Tables):
    path = scratch(t.spark, "orc")
    t.customer.write.orc(path)
    return files.table(t.spark, path, "orc").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query
def s16_job_config(t: Tables):
    """Sheet of many files under one header, some rows shorter than the header; missing fields are empty."""
    path = scratch(t.spark, "sheet")
    short = F.when(col("s_suppkey") % 3 == 0, F.concat_ws(",", "s_suppkey", "s_name")).otherwise(
        F.concat_ws(",", "s_suppkey", "s_name", F.concat(F.lit("nation "), col("s_nationkey")), F.lit("yes")))
    t.supplier.select(short.alias("value")).write.text(path)
    return files.job_config(t.spark, path, ["key", "name", "nation", "active"])


@query
def s17_struct_parameter(t: Tables):
    wanted = files.struct_rows(t.spark, [{"status": "F", "least": 100000.0}, {"status": "O", "least": 200000.0}])
    s = match(t.orders, wanted, o_orderstatus="status").where("o_totalprice >= least")
    return s.groupBy("status").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"))
