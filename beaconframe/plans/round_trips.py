"""Queries that write a table by a sink into the shared folder and read it back by a source, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconframe.operators import detector, discovery, editor, lineage, logs, normalize
from beaconframe.session import scratch, table
from beaconframe.sources import files, formats, packets
from beaconframe.streaming import flows, outbox

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: table(spark, sf_dir, name), scratch(spark, f.__name__))
        SQL[f.__name__] = sql
        return f

    return register


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name || ', "' || c_mktsegment || '"' END AS note, c_acctbal FROM customer""")
def delimited_files(spark, t, folder):
    """A2, A3, B1: quotes, delimiters within fields and empty fields come back."""
    note = F.when(F.col("c_custkey") % 7 != 0, F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')))
    files.write_delimited(t("customer").select("c_custkey", note.alias("note"), "c_acctbal"), f"{folder}/customer.csv")
    return formats.read(spark, f"{folder}/customer.csv").select(F.col("c_custkey").cast("bigint"), "note", F.col("c_acctbal").cast("double"))


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 5 <> 0")
def malformed_rows(spark, t, folder):
    """A3: rows of too many fields go."""
    fields = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", F.col("p_size").cast("string"))
    lines = t("part").select(F.when(F.col("p_partkey") % 5 == 0, F.concat(fields, F.lit("\ta\tb"))).otherwise(fields).alias("value"))
    head = spark.createDataFrame([("p_partkey\tp_name\tp_size",)], "value string")
    # the header is the one file's first line
    head.union(lines).coalesce(1).write.text(f"{folder}/part.tsv")
    return formats.read(spark, f"{folder}/part.tsv").select(F.col("p_partkey").cast("bigint"), "p_name", F.col("p_size").cast("int"))


@query("SELECT event_id, user_id AS who_id, event_type AS who_kind, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events")
def json_files(spark, t, folder):
    """Objects a line, nested ones by dotted names, nulls kept."""
    files.write_json(t("events").select("event_id", F.struct("user_id", F.col("event_type").alias("kind")).alias("who"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value")), f"{folder}/events.json")
    return formats.read(spark, f"{folder}/events.json").select("event_id", F.col("`who.user_id`").alias("who_id"), F.col("`who.kind`").alias("who_kind"), "value")


@query("""SELECT epoch_us(ts) * 1000 AS timestamp_ns, user_id % 4 AS cpu_id, user_id AS thread_id, 'proc' || (user_id % 7) AS process_name, event_id AS process_id, event_type AS syscall, CASE WHEN value > 50 THEN '>' ELSE '<' END AS direction,
strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, 'proc' || (user_id % 7) || ':' || event_id AS entity_id, 'res=' || event_id || ' name=a b ' || event_type AS raw_args, CAST(event_id AS VARCHAR) AS res, 'a b ' || event_type AS name FROM events WHERE event_id % 10 <> 0""")
def trace_files(spark, t, folder):
    """Typed fields and pairs of system-call traces; short lines go."""
    e = t("events").withColumn("ns", F.unix_micros(F.col("ts").cast("timestamp")) * 1000)
    text = lambda c: F.col(c).cast("string")
    whole = F.concat_ws(" ", text("ns"), (F.col("user_id") % 4).cast("string"), text("user_id"), F.concat(F.lit("proc"), (F.col("user_id") % 7).cast("string")), text("event_id"), "event_type", F.when(F.col("value") > 50, ">").otherwise("<"), F.concat(F.lit("res="), text("event_id"), F.lit(" name=a b "), "event_type"))
    e.select(F.when(F.col("event_id") % 10 == 0, F.concat_ws(" ", text("ns"), F.lit("0"), F.lit("cut"))).otherwise(whole).alias("value")).write.text(f"{folder}/calls.sc")
    return formats.read(spark, f"{folder}/calls.sc").select("timestamp_ns", "cpu_id", "thread_id", "process_name", "process_id", "syscall", "direction", "event_ts", "entity_id", "raw_args", "res", "name")


@query("SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain, count(*) AS n FROM pages WHERE regexp_extract(url, '^https?://([^/?#]+)', 1) <> '' GROUP BY ALL")
def domain_list_files(spark, t, folder):
    """The first token of each line that isn't empty."""
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    t("pages").select(F.concat(F.lit(" ,, "), host, F.when(host != "", " ,later").otherwise("")).alias("value")).write.text(f"{folder}/seen_domains.csv")
    return formats.read(spark, f"{folder}/seen_domains.csv").groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def parquet_files(spark, t, folder):
    """A4: any format's reader on Parquet."""
    t("part").write.parquet(f"{folder}/part.parquet")
    return formats.read(spark, f"{folder}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query("SELECT n_nationkey, 'a <' || n_name || '> & ' AS name, n_regionkey FROM nation")
def spreadsheet_file(spark, t, folder):
    """A session's rows saved as a spreadsheet and read."""
    t("nation").select("n_nationkey", F.concat(F.lit("a <"), "n_name", F.lit("> & ")).alias("name"), "n_regionkey").write.parquet(f"{folder}/nation.parquet")
    editor.save(editor.Session.of(editor.open_rows(spark, f"{folder}/nation.parquet")), f"{folder}/nation.xlsx", "xlsx")
    return formats.read(spark, f"{folder}/nation.xlsx").select(F.col("n_nationkey").cast("int"), "name", F.col("n_regionkey").cast("int"))


@query("""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, event_type AS service, 'INFO' AS level, 'seen' AS function, CAST(event_id AS VARCHAR) AS message, '{"k": ' || user_id || ', "token": "***REDACTED***"}' AS request, true AS is_valid
FROM events WHERE event_type IN ('view', 'error') AND CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) FROM events)""")
def log_store(spark, t, folder):
    """What the sink wrote, of two services and the first day, without secrets."""
    e = t("events")
    request = F.concat(F.lit('{"token": "abc", "k": '), F.col("user_id").cast("string"), F.lit("}"))
    logs.write_logs(e.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("event_type").alias("service"), F.lit("INFO").alias("level"), F.lit("seen").alias("function"), F.col("event_id").cast("string").alias("message"), request.alias("request")), folder)
    first = str(e.agg(F.min(F.to_date("ts"))).first()[0])
    return logs.read_logs(spark, folder, ["view", "error"], date_to=first).select("timestamp", "service", "level", "function", "message", "request", "is_valid")


@query("SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END AS event_ts, 'u-' || user_id AS entity_id FROM events")
def normalized_files(spark, t, folder):
    """Events with times as text, read with times; what is no time is null."""
    time = F.when(F.col("event_id") % 11 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    normalize.write_normalized(t("events").select("event_id", time.alias("event_ts"), F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("entity_id")), {"rows": 0}, folder)
    return normalize.read_normalized(spark, folder).select("event_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "entity_id")


@query("""WITH p AS (SELECT '10.0.0.' || (l_suppkey % 5) AS src, '8.8.8.' || (l_orderkey % 3) AS dst, epoch_us(l_shipdate) + (l_linenumber % 4) * 250000 + (l_linenumber // 4) * 1000000 AS ts_us, CAST(l_quantity AS BIGINT) + 60 AS size, l_returnflag || l_linestatus || '.example.com' AS q, l_linenumber AS n FROM lineitem),
g AS (SELECT *, ts_us // 1000000 AS second, (ts_us - lag(ts_us) OVER (PARTITION BY src, dst, ts_us // 1000000 ORDER BY ts_us)) / 1000.0 AS gap FROM p)
SELECT src, dst, CAST(second AS BIGINT) AS second, count(*) AS packet_count, CAST(sum(size) AS BIGINT) AS byte_total, round(avg(size), 6) AS mean_packet_size, round(coalesce(avg(gap), 0.0), 6) AS mean_inter_arrival_ms, count(*) AS communication_frequency,
count(*) AS query_rr_count, CAST(sum(CASE WHEN n % 2 = 0 THEN 2 ELSE 0 END) AS BIGINT) AS answer_rr_count, count(*) FILTER (WHERE n % 2 = 0) AS rr_type_a, count(*) FILTER (WHERE n % 2 = 0) AS rr_type_aaaa, CAST(0 AS BIGINT) AS rr_type_other,
round(coalesce(sum(CASE WHEN n % 2 = 0 THEN n * 60 + 30 ELSE 0 END) / nullif(sum(CASE WHEN n % 2 = 0 THEN 2 ELSE 0 END), 0), 0.0), 6) AS ttl_mean, CAST(coalesce(max(CASE WHEN n % 2 = 0 THEN n * 60 END), 0) AS BIGINT) AS ttl_max, count(DISTINCT q) AS unique_qnames FROM g GROUP BY src, dst, second""")
def flow_measures(spark, t, folder):
    """Measures of each source, destination and second."""
    n = F.col("l_linenumber")
    answer = lambda code, ttl: F.struct(F.lit(code).alias("code"), ttl.cast("bigint").alias("ttl"))
    made = t("lineitem").select(
        (F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (n % 4) * 250_000 + F.floor(n / 4) * 1_000_000).cast("bigint").alias("ts_us"),
        F.concat(F.lit("10.0.0."), (F.col("l_suppkey") % 5).cast("string")).alias("src"),
        F.concat(F.lit("8.8.8."), (F.col("l_orderkey") % 3).cast("string")).alias("dst"),
        (F.col("l_quantity").cast("bigint") + 60).alias("size"),
        F.array(F.concat("l_returnflag", "l_linestatus", F.lit(".example.com")), F.lit("")).alias("qnames"),
        F.when(n % 2 == 0, F.array(answer(1, n * 60), answer(28, F.lit(30)))).otherwise(F.array().cast("array<struct<code:int,ttl:bigint>>")).alias("answers"),
    )
    out = packets.flows(made)
    return out.select("src", "dst", "second", "packet_count", "byte_total", F.round("mean_packet_size", 6).alias("mean_packet_size"), F.round("mean_inter_arrival_ms", 6).alias("mean_inter_arrival_ms"), "communication_frequency", "query_rr_count", "answer_rr_count", "rr_type_a", "rr_type_aaaa", "rr_type_other", F.round("ttl_mean", 6).alias("ttl_mean"), "ttl_max", "unique_qnames")


@query("""SELECT 'job-' || k AS job, event_id AS row_index, CAST(user_id AS VARCHAR) AS entity_id, value / 200 AS score, CAST(value / 200 >= 0.5 AS INTEGER) AS predicted FROM events, (SELECT unnest([1, 2]) AS k)""")
def detection_rows(spark, t, folder):
    """Two jobs' detections, appended."""
    score = F.col("value") / 200
    scored = t("events").select(F.col("event_id").alias("row_index"), F.col("user_id").cast("string").alias("entity_id"), score.alias("fusion"), (score >= 0.5).cast("int").alias("predicted"), *[F.lit(0.5).alias(b) for b in detector.BRANCHES])
    for k in (1, 2):
        detector.write_detections(scored, folder, f"job-{k}")
    return spark.read.parquet(folder).select("job", "row_index", "entity_id", "score", "predicted")


@query("SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate AS created_at FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 6")
def newest_runs(spark, t, folder):
    """The six newest."""
    return lineage.newest(t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at")))


@query("SELECT o_custkey % 20 AS member_of, 'x/' || o_orderkey || CASE o_orderkey % 3 WHEN 0 THEN '.RES' WHEN 1 THEN '.tar.gz' ELSE '.sc' END AS path, CASE o_orderkey % 3 WHEN 0 THEN '.res' WHEN 1 THEN '.gz' ELSE '.sc' END AS suffix FROM orders")
def path_suffixes(spark, t, folder):
    """The last suffix of a path, in lower case."""
    kind = F.when(F.col("o_orderkey") % 3 == 0, ".RES").when(F.col("o_orderkey") % 3 == 1, ".tar.gz").otherwise(".sc")
    paths = t("orders").select((F.col("o_custkey") % 20).alias("member_of"), F.concat(F.lit("x/"), F.col("o_orderkey").cast("string"), kind).alias("path"))
    return paths.withColumn("suffix", discovery.suffix(F.col("path")))


@query("SELECT p_brand AS brand, p_size AS size, count(*) AS n FROM part GROUP BY ALL")
def archived_files(spark, t, folder):
    """Members of packed files, and their lines."""
    t("part").select(F.concat_ws(";", "p_brand", F.col("p_size").cast("string")).alias("value")).write.text(f"{folder}/in", compression="gzip")
    found = formats.read_archives(spark, f"{folder}/in").where(F.endswith("member", F.lit(".txt")))
    line = F.explode(F.split(F.rtrim(F.decode("content", "UTF-8"), F.lit("\n")), "\n")).alias("line")
    fields = found.select(line).select(F.split("line", ";").alias("f"))
    return fields.groupBy(F.col("f")[0].alias("brand"), F.col("f")[1].cast("int").alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(row_number() OVER (ORDER BY CAST(user_id AS VARCHAR), ts, event_id) AS BIGINT) AS number, event_id, CAST(user_id AS VARCHAR) AS entity_id, CAST(value > 50 AS INTEGER) AS label, coalesce(CASE WHEN event_id % 4 <> 0 THEN value END, 0.0) AS value,
CAST(event_type = 'view' AS DOUBLE) AS kind_view, CAST(event_type = 'click' AS DOUBLE) AS kind_click FROM events""")
def training_rows(spark, t, folder):
    """Features as numbers, indicators of categories, rows numbered by entity and time."""
    e = t("events").select(F.col("user_id").cast("string").alias("entity_id"), F.col("ts").alias("event_ts"), F.lit("network").alias("source_type"), (F.col("value") > 50).cast("int").alias("label"), F.lit(None).cast("string").alias("attack_stage"), F.lit(None).cast("string").alias("mitre_tactic"), "event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"), F.col("event_type").alias("kind"))
    rows, _ = detector.training_frame(e, normalize.FeatureSchema("events", ["event_id", "value", "kind"], source_type="network"))
    return rows.select(F.col(detector.KEY).alias("number"), F.col("event_id").cast("bigint").alias("event_id"), "entity_id", "label", "value", "kind_view", "kind_click")


@query("SELECT DISTINCT event_type AS consumer, user_id AS message_id FROM events")
def streaming_outbox(spark, t, folder):
    """L3, L4: messages that come in several batches are published once."""
    t("events").select(F.col("event_type").alias("consumer"), F.col("user_id").alias("message_id")).repartition(4).write.parquet(f"{folder}/out")
    stream = spark.readStream.schema("consumer string, message_id bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/out")
    outbox.publish(spark, stream, f"{folder}/sent", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/sent").select("consumer", "message_id")


@query("SELECT DISTINCT event_type AS consumer, user_id AS message_id FROM events")
def streaming_inbox(spark, t, folder):
    """L4: each message of a stream once."""
    t("events").select(F.col("event_type").alias("consumer"), F.col("user_id").alias("message_id"), F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("at")).write.parquet(f"{folder}/out")
    stream = spark.readStream.schema("consumer string, message_id bigint, at timestamp").parquet(f"{folder}/out")
    return flows.drain(spark, flows.undelivered_stream(stream, "at"), complete=False).select("consumer", "message_id")
