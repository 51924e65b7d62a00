"""All queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from beaconframe.functions import columns as C
from beaconframe.operators import core as O
from beaconframe.operators import detector, discovery, editor, lineage, logs, normalize, ordered
from beaconframe.session import table
from beaconframe.streaming import flows

QUERIES: dict = {}
SQL: dict[str, str] = {}
KINDS = ["click", "error", "purchase", "signup", "view"]


def _us():
    return F.unix_micros(F.col("ts").cast("timestamp"))


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"""WITH e AS (SELECT *, date_trunc('hour', ts) AS bucket, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts)) / 1000.0 AS gap FROM events)
SELECT user_id, CAST(bucket AS TIMESTAMP) AS bucket, count(*) AS packet_count, round(sum(value), 4) AS bytes_sum, round(avg(value), 4) AS bytes_mean, round(coalesce(avg(gap), 0.0), 4) AS mean_gap_ms, count(DISTINCT event_type) AS kinds,
{', '.join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}_count" for k in KINDS)} FROM e GROUP BY user_id, bucket""")
def flow_aggregate(t):
    return O.flow_aggregate(t("events"), "user_id", "ts", "value", "event_type", KINDS)


@query("SELECT event_id, user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1000.0 AS gap_ms FROM events")
def inter_arrival(t):
    return t("events").select("event_id", "user_id", ((_us() - F.lag(_us()).over(W.partitionBy("user_id").orderBy("ts", "event_id"))) / 1000).alias("gap_ms"))


@query("""WITH c AS (SELECT p_partkey, unnest(string_split(p_name, '')) AS ch, length(p_name) AS n FROM part WHERE p_name <> ''), s AS (SELECT p_partkey, ch, count(*) / any_value(n) AS p FROM c GROUP BY p_partkey, ch)
SELECT p_partkey, round(sum(-p * log2(p)), 6) AS entropy FROM s GROUP BY p_partkey""")
def entropy_chars(t):
    return t("part").where("p_name <> ''").select("p_partkey", F.round(C.shannon_entropy(F.col("p_name")), 6).alias("entropy"))


@query("""WITH h AS (SELECT page_id, lower(trim(regexp_extract(url, '^https?://([^/?#]+)', 1))) AS d FROM pages), c AS (SELECT page_id, unnest(string_split(d, '')) AS ch, length(d) AS n FROM h WHERE d <> ''), s AS (SELECT page_id, ch, count(*) / any_value(n) AS p FROM c GROUP BY page_id, ch), e AS (SELECT page_id, sum(-p * log2(p)) AS entropy FROM s GROUP BY page_id)
SELECT page_id, d AS domain, CAST(length(d) AS BIGINT) AS length, round(length(regexp_replace(d, '[^0-9]', '', 'g')) / length(d), 6) AS numeric_ratio, CAST(greatest(len(list_filter(string_split(d, '.'), lambda x: x <> '')) - 2, 0) AS BIGINT) AS depth, round(entropy, 6) AS entropy, CAST(length(d) - length(replace(d, '-', '')) AS BIGINT) AS hyphens FROM h JOIN e USING (page_id)""")
def domain_features(t):
    d = t("pages").select("page_id", C.clean_domain(F.regexp_extract("url", "^https?://([^/?#]+)", 1)).alias("domain")).where("domain <> ''")
    return d.select("page_id", "domain", *[F.round(c, 6).alias(k) if k in ("numeric_ratio", "entropy") else c.alias(k) for k, c in C.domain_features(F.col("domain")).items()])


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS status, o_orderpriority AS prio FROM orders")
def kv_extract(t):
    m = C.key_values(F.concat_ws("", F.lit("cust="), F.col("o_custkey").cast("string"), F.lit(" status="), "o_orderstatus", F.lit(" prio="), "o_orderpriority"))
    return t("orders").select("o_orderkey", m.alias("m")).select("o_orderkey", *[F.col("m")[k].alias(k) for k in ("cust", "status", "prio")])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field_extract(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT event_id, ts AS from_s, ts AS from_ms, ts AS from_us FROM (SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events)")
def epoch_unit_coerce(t):
    e = t("events").select("event_id", F.floor(_us() / 1_000_000).cast("bigint").alias("s"))
    e = e.select("event_id", "s", (F.col("s") * 1000).alias("ms"), (F.col("s") * 1_000_000).alias("us"))
    top = e.agg(*[C.epoch_divisor(F.max(F.abs(c))).alias(f"d_{c}") for c in ("s", "ms", "us")])  # one row
    return e.crossJoin(F.broadcast(top)).select("event_id", *[F.timestamp_seconds((F.col(c) / F.col(f"d_{c}")).cast("bigint")).cast("timestamp_ntz").alias(f"from_{c}") for c in ("s", "ms", "us")])


@query("""SELECT count(*) AS n_rows, count(k) AS non_null, count(TRY_CAST(k AS DOUBLE)) AS numeric_values, count(k) - count(TRY_CAST(k AS DOUBLE)) AS invalid_values, count(TRY_CAST(k AS DOUBLE)) >= greatest(1, CAST(floor(0.6 * count(*)) AS BIGINT)) AS is_numeric FROM (SELECT json_extract_string(props, '$.k') AS k FROM events UNION ALL SELECT p_type FROM part)""")
def numeric_coercion_profile(t):
    k = t("events").select(F.get_json_object("props", "$.k").alias("k")).unionAll(t("part").select("p_type"))
    n = F.count(F.try_cast(F.col("k"), "double")) if hasattr(F, "try_cast") else F.count(F.expr("try_cast(k as double)"))
    return k.agg(F.count(F.lit(1)).alias("n_rows"), F.count("k").alias("non_null"), n.alias("numeric_values"), (F.count("k") - n).alias("invalid_values"), (n >= F.greatest(F.lit(1), F.floor(0.6 * F.count(F.lit(1))))).alias("is_numeric"))


@query("SELECT event_type, CASE WHEN lower(event_type) LIKE '%benign%' THEN 0 ELSE 1 END AS label, count(*) AS n FROM events GROUP BY event_type")
def label_from_name(t):
    return t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select("event_type", C.label_from_name(F.col("event_type")).alias("label"), "n")


@query("SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entity FROM events")
def entity_fallback_fill(t):
    rows = t("events").select("event_id", "event_type", "ts", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("entity"))
    return ordered.fill(rows, "entity", ["event_type"], ["ts", "event_id"]).select("event_id", "entity")


@query("SELECT count(*) AS n_rows, CAST(sum((text IS NULL)::INT + (quality IS NULL)::INT + (toxic IS NULL)::INT) AS BIGINT) AS missing_values FROM (SELECT d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))")
def missing_cell_profile(t):
    return O.missing_cells(t("documents").join(t("labels"), "doc_id", "left").select("text", "quality", "toxic"))


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)")
def duplicate_profile(t):
    return O.duplicate_rows(t("events").select("user_id", "event_type"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t):
    return t("events").select("user_id", "event_type").distinct()


@query("SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name FROM customer UNION ALL SELECT NULL, NULL, s_suppkey, s_name FROM supplier")
def union_missing_columns(t):
    return t("customer").select("c_custkey", "c_name").unionByName(t("supplier").select("s_suppkey", "s_name"), allowMissingColumns=True)


@query("SELECT toxic, quality, count(*) AS n FROM labels GROUP BY toxic, quality")
def label_distribution(t):
    return t("labels").groupBy("toxic", "quality").agg(F.count(F.lit(1)).alias("n"))


_PROFILED = ["p_brand", "p_type", "p_size", "p_name"]
_PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {'true' if c == 'p_size' else 'false'} AS is_numeric, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS max_length, count({c}) + least(count(DISTINCT {c}), 10) * {100 if c == 'p_size' else 50} AS score FROM part" for c in _PROFILED)


@query(_PROFILE)
def column_profile(t):
    return O.column_profile(t("part").select(*_PROFILED))


@query(f"SELECT * FROM ({_PROFILE}) WHERE non_null > 0 AND \"column\" NOT IN ('p_type') AND (is_numeric OR NOT (n_distinct > 64 OR n_distinct > 0.8 * non_null OR max_length > 96)) ORDER BY score DESC, \"column\" LIMIT 128")
def feature_select(t):
    return O.select_features(O.column_profile(t("part").select(*_PROFILED)), ["p_type"])


@query("SELECT max_by(source, struct_pack(n := n, s := source)) AS winner, CAST(max(n) AS BIGINT) AS files FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def source_type_vote(t):
    return t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("source", F.struct("n", "source")).alias("winner"), F.max("n").alias("files"))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


@query("SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"o_orderpriority_{v}\"" for v in _PRIORITIES) + ", CASE WHEN o_orderpriority IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderpriority_nan FROM orders")
def one_hot_align(t):
    o = t("orders")
    return o.select("o_orderkey", *O.one_hot(o, "o_orderpriority", _PRIORITIES))


_WINDOWS = """WITH e AS (SELECT user_id, event_id, value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events),
s AS (SELECT *, unnest(range(0, CAST(floor(greatest(n - 50, 0) / 10) * 10 AS BIGINT) + 1, 10)) AS window_start FROM e),
w AS (SELECT *, CASE WHEN n < 50 AND r = n - 1 THEN 50 - n + 1 ELSE 1 END AS k FROM s WHERE r >= window_start AND r < window_start + 50)"""


@query(_WINDOWS + " SELECT user_id, window_start, max(label) AS label, max_by(event_id, r) AS rep FROM w GROUP BY user_id, window_start")
def sequence_windows(t):
    return _windows(t).select("user_id", "window_start", "label", "rep")


@query(_WINDOWS + " SELECT user_id, window_start, round(sum(value * k) / sum(k), 4) AS mean_value FROM w GROUP BY user_id, window_start")
def window_mean_pool(t):
    return _windows(t).select("user_id", "window_start", F.round("mean_value", 4).alias("mean_value"))


def _windows(t):
    e = t("events").withColumn("label", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    return O.sequence_windows(e, "user_id", ["ts", "event_id"], "label", "event_id", 50, 10, ["value"])


@query(_WINDOWS + """, p AS (SELECT max_by(event_id, r) AS event_id, round(sum(value * k) / sum(k) / 1000, 6) AS prob FROM w GROUP BY user_id, window_start)
SELECT e.event_id, coalesce(last_value(p.prob IGNORE NULLS) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.5) AS prob FROM events e LEFT JOIN p USING (event_id)""")
def probability_ffill(t):
    p = _windows(t).select(F.col("rep").alias("event_id"), F.round(F.col("mean_value") / 1000, 6).alias("p"))
    return t("events").join(p, "event_id", "left").select("event_id", O.forward_fill(F.col("p"), ["user_id"], ["ts", "event_id"], 0.5).alias("prob"))


_SPLIT = "SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r, count(*) OVER (PARTITION BY toxic) AS n FROM labels"


def _ranked(t):
    rows = t("labels").select("doc_id", "toxic", F.md5(F.col("doc_id").cast("string")).alias("h"))
    return ordered.rank(rows, ["toxic"], ["h", "doc_id"], "r", "n")


@query(f"SELECT doc_id, toxic, CASE WHEN r <= floor(0.75 * n) THEN 'train' ELSE 'test' END AS part FROM ({_SPLIT})")
def stratified_split(t):
    return _ranked(t).select("doc_id", "toxic", F.when(F.col("r") <= F.floor(0.75 * F.col("n")), "train").otherwise("test").alias("part"))


@query(f"SELECT doc_id, toxic, CAST((r - 1) % 3 AS INTEGER) AS fold FROM ({_SPLIT})")
def cv_folds(t):
    return _ranked(t).select("doc_id", "toxic", ((F.col("r") - 1) % 3).cast("int").alias("fold"))


_SCORED = """WITH f AS (SELECT d.doc_id, l.quality AS label, d.n_chars / 1000.0 AS a, (length(d.text) - length(replace(d.text, ' ', ''))) / 1000.0 AS b FROM documents d JOIN labels l USING (doc_id)),
m AS (SELECT avg(a) FILTER (WHERE label = 1) AS a1, avg(a) FILTER (WHERE label = 0) AS a0, avg(b) FILTER (WHERE label = 1) AS b1, avg(b) FILTER (WHERE label = 0) AS b0 FROM f),
z AS (SELECT doc_id, label, a, b, a1 - a0 AS wa, b1 - b0 AS wb, (a1 - a0) * a + (b1 - b0) * b - ((a1 - a0) * (a1 + a0) + (b1 - b0) * (b1 + b0)) / 2 AS z FROM f, m),
s AS (SELECT *, 1.0 / (1.0 + exp(-least(30.0, greatest(-30.0, z)))) AS score FROM z)"""


def _scored(t):
    f = t("documents").join(t("labels"), "doc_id").select("doc_id", F.col("quality").alias("label"), (F.col("n_chars") / 1000).alias("a"), ((F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))) / 1000).alias("b"))
    return f.crossJoin(F.broadcast(O.centroids(f, "label", ["a", "b"]))).withColumn("score", C.sigmoid(F.col("w_a") * F.col("a") + F.col("w_b") * F.col("b") + F.col("bias")))  # one row of weights


@query(_SCORED + " SELECT doc_id, round(score, 5) AS score FROM s")
def centroid_score(t):
    return _scored(t).select("doc_id", F.round("score", 5).alias("score"))


@query(_SCORED + " SELECT doc_id, round((round(score, 5) + 0.5 + (doc_id % 10) / 10.0 + (doc_id % 7) / 7.0) / 4, 4) AS score FROM s")
def late_fusion(t):
    return _scored(t).select("doc_id", F.round(C.late_fusion(F.round("score", 5), F.lit(0.5), (F.col("doc_id") % 10) / 10, (F.col("doc_id") % 7) / 7), 4).alias("score"))


_COUNTED = _SCORED + ", c AS (SELECT count(*) FILTER (WHERE label = 1 AND p) AS tp, count(*) FILTER (WHERE label <> 1 AND p) AS fp, count(*) FILTER (WHERE label = 1 AND NOT p) AS fn, count(*) FILTER (WHERE label <> 1 AND NOT p) AS tn FROM (SELECT label, round(score, 5) >= 0.5 AS p FROM s))"


@query(_COUNTED + " SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS fpr FROM c")
def binary_metrics(t):
    return O.binary_metrics(_scored(t).withColumn("score", F.round("score", 5)), "label", "score")


@query(_SCORED + ", r AS (SELECT label, rank() OVER (ORDER BY round(score, 5)) + (count(*) OVER (PARTITION BY round(score, 5)) - 1) / 2.0 AS r FROM s) SELECT round((sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0) / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)), 6) AS auc FROM r")
def roc_auc(t):
    return O.roc_auc(_scored(t).withColumn("score", F.round("score", 5)), "label", "score")


_EXPLAINED = """WITH f AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice / 1000) - 150 AS DOUBLE) AS q, CAST(o_custkey % 7 - 3 AS DOUBLE) AS d, CAST(o_orderkey % 5 AS DOUBLE) AS x, CAST(o_custkey % 11 - 4 AS DOUBLE) AS n FROM orders),
c AS (SELECT k, 'q' AS f, q * 0.01::DOUBLE AS c FROM f UNION ALL SELECT k, 'd', d * 2.0::DOUBLE FROM f UNION ALL SELECT k, 'x', x * (-1.5)::DOUBLE FROM f UNION ALL SELECT k, 'n', n * 0.03::DOUBLE FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY k, c >= 0 ORDER BY -abs(c), f) AS r FROM c)"""


@query(_EXPLAINED + " SELECT k, coalesce(string_agg(f, ',' ORDER BY r) FILTER (WHERE c >= 0 AND r <= 2), '') AS positive, coalesce(string_agg(f, ',' ORDER BY r) FILTER (WHERE c < 0 AND r <= 2), '') AS negative, CAST(round(sum(c) FILTER (WHERE r <= 2) * 10000) AS BIGINT) AS total FROM r GROUP BY k")
def explain_topk(t):
    rows = t("orders").select(F.col("o_orderkey").alias("k"), (F.floor(F.col("o_totalprice") / 1000) - 150).cast("double").alias("q"), (F.col("o_custkey") % 7 - 3).cast("double").alias("d"), (F.col("o_orderkey") % 5).cast("double").alias("x"), (F.col("o_custkey") % 11 - 4).cast("double").alias("n"))
    e = detector.contributions(rows, {"q": 0.01, "d": 2.0, "x": -1.5, "n": 0.03}, "k", 2)
    names = lambda c: F.array_join(F.transform(c, lambda x: x["feature"]), ",")
    total = F.aggregate(F.concat("positive", "negative"), F.lit(0.0), lambda a, x: a + x["contribution"])
    return e.select("k", names("positive").alias("positive"), names("negative").alias("negative"), F.round(total * 10000).cast("bigint").alias("total"))


def _logs(t):
    e = t("events")
    error = F.when(F.col("value") > 100, F.concat(F.lit('{"code": '), F.get_json_object("props", "$.k"), F.lit("}")))
    return e.select(F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp"), F.col("event_type").alias("service"), F.when(F.col("value") > 100, "ERROR").otherwise("info").alias("level"), F.concat(F.lit("Handle_"), "event_type").alias("function"), F.col("props").alias("message"), error.alias("error"), F.concat(F.lit("f"), F.col("user_id") % 3).alias("source_file"), F.col("event_id").alias("line_number"), F.lit(True).alias("is_valid"))


_LOGS = """(SELECT CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp, event_type AS service, CASE WHEN value > 100 THEN 'ERROR' ELSE 'info' END AS level, 'Handle_' || event_type AS function, props AS message,
CASE WHEN value > 100 THEN '{"code": ' || json_extract_string(props, '$.k') || '}' END AS error, 'f' || (user_id % 3) AS source_file, event_id AS line_number FROM events)"""


@query(f"SELECT service, level, line_number FROM {_LOGS} WHERE service IN ('click', 'view') AND lower(level) = 'error' AND contains(lower(concat_ws(' ', service, level, function, message, coalesce(error, ''))), '\"k\": 1') AND substr(timestamp, 12) >= '06:00:00' AND substr(timestamp, 12) <= '20:30:00'")
def log_search(t):
    return logs.matching(_logs(t), logs.Search(services=["click", "view"], level="Error", search='"K": 1', time_from="06:00", time_to="20:30:00")).select("service", "level", "line_number")


@query(f"SELECT line_number FROM {_LOGS} WHERE contains(lower(function), 'handle_') AND contains(lower(coalesce(error, '')), 'code\": 2') AND (timestamp IS NULL OR (substr(timestamp, 1, 10) >= '2024-01-02' AND substr(timestamp, 1, 10) <= '2024-01-20'))")
def log_search_fields(t):
    return logs.matching(_logs(t), logs.Search(function="HANDLE_", error_text='code": 2', date_from="2024-01-02", date_to="2024-01-20")).select("line_number")


def _log_page(t, descending):
    keys = [F.coalesce("timestamp", F.lit("")), F.col("service"), F.col("source_file"), F.col("line_number")]
    rows = logs.after(_logs(t), ["2024-01-10T12:00:00", "login", "f1", 500], descending)
    return rows.orderBy(*[k.desc() if descending else k.asc() for k in keys]).limit(51).select("timestamp", "service", "source_file", "line_number")


def _log_page_sql(sign, order):
    return f"SELECT timestamp, service, source_file, line_number FROM {_LOGS} WHERE (coalesce(timestamp, ''), service, source_file, line_number) {sign} ('2024-01-10T12:00:00', 'login', 'f1', 500) ORDER BY coalesce(timestamp, '') {order}, service {order}, source_file {order}, line_number {order} LIMIT 51"


@query(_log_page_sql(">", "ASC"))
def log_page_after_cursor(t):
    return _log_page(t, False)


@query(_log_page_sql("<", "DESC"))
def log_page_descending(t):
    return _log_page(t, True)


@query(f"SELECT timestamp, service, source_file, line_number FROM {_LOGS} WHERE (coalesce(timestamp, ''), service) < ('', 'purchase') ORDER BY service DESC, source_file DESC, line_number DESC LIMIT 51")
def log_page_of_null_times(t):
    keys = [F.coalesce("timestamp", F.lit("")), F.col("service"), F.col("source_file"), F.col("line_number")]
    return logs.after(_logs(t), ["", "purchase", "", 0], True).orderBy(*[k.desc() for k in keys]).limit(51).select("timestamp", "service", "source_file", "line_number")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'WARNING' ELSE 'INFO' END AS level, CASE WHEN event_id % 5 = 0 THEN '{}' ELSE '{"Token": "***REDACTED***", "list": [{"PASSWORD": "***REDACTED***", "k": ' || json_extract_string(props, '$.k') || '}]}' END AS context, event_id % 5 <> 0 AS is_valid FROM events""")
def log_redaction(t):
    line = F.when(F.col("event_id") % 5 == 0, F.lit("not json {")).otherwise(F.concat(F.lit('{"message": "m", "context": {"Token": "x", "list": [{"PASSWORD": [1], "k": '), F.get_json_object("props", "$.k"), F.lit("}]}}")))
    lines = t("events").select(line.alias("line"), F.lit("s").alias("service"), "event_id")
    kinds = "timestamp string, service string, level string, function string, message string, request string, error string, context string, is_valid boolean, raw_line string, event_id bigint"
    logs.ship(lines.sparkSession)
    return lines.mapInArrow(logs._entries, kinds).select("event_id", "level", "context", "is_valid")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100")
def page_offset(t):
    return t("customer").select("c_custkey", "c_name").orderBy("c_custkey").offset(100).limit(50)


@query("SELECT c_custkey, CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'patched' ELSE c_name END AS c_name FROM customer WHERE c_custkey % 5 <> 0")
def overlay_patches(t):
    c = t("customer").select("c_custkey", "c_name")
    patches = c.where("c_custkey % 7 = 0").select("c_custkey", F.lit("c_name").alias("column"), F.when(F.col("c_custkey") % 14 != 0, "patched").alias("value"), F.lit(1).alias("seq"))
    return O.overlay(c, "c_custkey", patches, c.where("c_custkey % 5 = 0"), ["c_name"])


@query("SELECT o_custkey, max_by(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def latest_per_key(t):
    return O.latest_per_key(t("orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query("SELECT c_nationkey, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE p_size > 25 GROUP BY c_nationkey")
def lineage_join(t):
    o, l, p = t("orders").select("o_orderkey", "o_custkey"), t("lineitem").select("l_orderkey", "l_partkey"), t("part").where("p_size > 25").select("p_partkey")
    joined = l.join(p, l.l_partkey == p.p_partkey).join(o, l.l_orderkey == o.o_orderkey).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) AND o_orderstatus = 'O' THEN 'deprecated' ELSE o_orderstatus END AS status FROM orders")
def promote_semi_join(t):
    hit = t("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    return t("orders").join(hit, "o_orderkey", "left").select("o_orderkey", F.when(F.col("hit") & (F.col("o_orderstatus") == "O"), "deprecated").otherwise(F.col("o_orderstatus")).alias("status"))


@query("""SELECT coalesce(f.k, k.k) AS c_custkey, CASE WHEN k.k IS NULL THEN 'insert' WHEN f.k IS NOT NULL THEN 'update' WHEN r.k IS NOT NULL THEN 'keep' ELSE 'delete' END AS action
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) f FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) k ON f.k = k.k LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) r ON r.k = coalesce(f.k, k.k)""")
def catalog_sync_full_outer(t):
    c = t("customer").select("c_custkey")
    return O.catalog_sync(c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0"), "c_custkey", t("orders").select(F.col("o_custkey").alias("c_custkey")))


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def lookup_join(t):
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0)")
def not_referenced_anti(t):
    urgent = t("orders").where("o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0")
    return t("customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND l.toxic = 0 AND d.lang IN ('en', 'de')")
def eligibility_filter(t):
    return t("documents").where(F.col("lang").isin("en", "de")).join(t("labels").where("quality = 1 AND toxic = 0"), "doc_id").select("doc_id")


@query("SELECT conv_id, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM conversations GROUP BY conv_id")
def distinct_tags_sorted(t):
    return t("conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS entity, count(*) AS n FROM {n}" for n in ("customer", "orders", "events", "documents", "labels")))
def dashboard_counts(t):
    parts = [t(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("entity"), "n") for n in ("customer", "orders", "events", "documents", "labels")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("SELECT c_custkey, TIMESTAMP '2026-01-01 00:00:00' + to_seconds(CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT)) AS event_ts FROM customer")
def synthetic_timestamps(t):
    rows = ordered.rank(t("customer").select("c_custkey"), [], ["c_custkey"], "r")
    return rows.select("c_custkey", C.synthetic_time(F.col("r") - 1).cast("timestamp_ntz").alias("event_ts"))


_NAMED = "(SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Benign_' WHEN 1 THEN 'heavy-' WHEN 2 THEN 'DNS_EXF_' WHEN 3 THEN 'host/' ELSE '' END || event_type || CASE event_id % 7 WHEN 0 THEN '.sc' WHEN 1 THEN '.csv' WHEN 2 THEN '_domains.tsv' WHEN 3 THEN '.json' WHEN 4 THEN '.PCAPNG' WHEN 5 THEN '.txt' ELSE '' END AS name FROM events)"


def _names(t):
    pick = lambda n, *options: F.get(F.array(*[F.lit(o) for o in options]), (F.col("event_id") % n).cast("int"))
    return t("events").select("event_id", F.concat(pick(5, "Benign_", "heavy-", "DNS_EXF_", "host/", ""), "event_type", pick(7, ".sc", ".csv", "_domains.tsv", ".json", ".PCAPNG", ".txt", "")).alias("name"))


@query(f"SELECT event_id, CASE WHEN contains(lower(name), 'benign') THEN NULL WHEN regexp_matches(lower(name), 'phishing|malware|spam|heavy|light|attack|exf') THEN 'exfiltration' ELSE 'suspicious_activity' END AS stage, CASE WHEN event_id % 2 = 0 THEN 'TA0011' ELSE 'TA0006' END AS tactic FROM {_NAMED}")
def stage_from_name(t):
    return _names(t).select("event_id", C.stage_from_name(F.col("name")).alias("stage"), C.default_tactic(F.when(F.col("event_id") % 2 == 0, "network").otherwise("host")).alias("tactic"))


@query(f"SELECT event_id, CASE WHEN regexp_matches(lower(name), '[.](sc|res)$') THEN 'host' WHEN regexp_matches(lower(name), '[.](csv|tsv|parquet|xlsx|pcap|pcapng)$') THEN 'network' WHEN contains(lower(name), 'host') THEN 'host' WHEN regexp_matches(lower(name), 'dns|network|pcap|flow') THEN 'network' END AS source_type FROM {_NAMED}")
def source_type_inference(t):
    return _names(t).select("event_id", F.coalesce(discovery.type_from_suffix(F.col("name")), discovery.type_from_path(F.col("name"))).alias("source_type"))


_FAMILY_SQL = ", ".join("CASE WHEN regexp_matches(lower(n), '" + "|".join(words) + f"') THEN '{f}' END" for f, words in C.FAMILIES.items())


@query(f"SELECT n AS name, array_to_string(list_sort(list_filter([{_FAMILY_SQL}], lambda x: x IS NOT NULL)), ',') AS families FROM (SELECT DISTINCT event_type || ['_pid', '_File_mode', '_euid', '_dst_port', '_session', '_x'][1 + event_id % 6] AS n FROM events)")
def feature_family_tags(t):
    tails = F.array(*[F.lit(x) for x in ("_pid", "_File_mode", "_euid", "_dst_port", "_session", "_x")])
    names = t("events").select(F.concat("event_type", F.get(tails, (F.col("event_id") % 6).cast("int"))).alias("name")).distinct()
    return names.select("name", F.array_join(C.feature_families(F.col("name")), ",").alias("families"))


@query("SELECT o_orderkey, TRY_CAST(a AS DOUBLE) AS a, b FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS a, CASE WHEN o_orderkey % 2 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS b FROM orders)")
def numeric_coercion(t):
    text = F.col("o_custkey").cast("string")
    rows = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, text).otherwise("n/a").alias("a"), F.when(F.col("o_orderkey") % 2 != 0, text).otherwise("n/a").alias("b"))
    return normalize.coerce_numbers(rows, ["a", "b"])[0]


@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) WHEN 1 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) ELSE CAST(date_trunc('millisecond', ts) AS TIMESTAMP) END AS parsed FROM events")
def datetime_parse(t):
    us = _us()
    text = F.get(F.array(F.floor(us / 1000).cast("string"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("ts", "yyyy-MM-dd"), F.lit("not a time")), (F.col("event_id") % 4).cast("int"))
    rows = t("events").select("event_id", text.alias("text"))
    return rows.select("event_id", normalize.parsed_time(rows, "text").cast("timestamp_ntz").alias("parsed"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def trace_times(t):
    unit = F.get(F.array(F.lit(1000), F.lit(1), F.lit(1)), (F.col("event_id") % 3).cast("int"))
    text = F.when(F.col("event_id") % 3 == 2, F.floor(_us() / 1_000_000)).otherwise(_us() * unit).cast("string")
    return t("events").select("event_id", C.trace_time(text).alias("at"))


@query("""SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, 'host' AS source_type, CAST(event_type = 'purchase' AS INTEGER) AS label, 'exfiltration' AS attack_stage, 'TA0006' AS mitre_tactic, event_type AS kind, value, CAST(event_id % 10 AS DOUBLE) AS score FROM events""")
def canonical_events(t):
    raw = t("events").select(F.col("user_id").alias("User ID"), F.col("ts").alias("TS"), (F.col("event_type") == "purchase").cast("int").alias("Is-Purchase"), F.col("event_type").alias("kind"), "value", (F.col("event_id") % 10).cast("string").alias(" score "))
    manifest = normalize.Manifest("host", "ts", "user id", "is purchase")
    return normalize.normalize_table(raw, "heavy_attack.csv", manifest)[0].distinct()


@query("SELECT entity_id, label, kind, size_, value FROM (SELECT 'e:' || CAST(user_id AS VARCHAR) AS entity_id, 1 AS label, event_type AS kind, NULL::DOUBLE AS size_, value FROM events UNION ALL SELECT CAST(p_partkey AS VARCHAR), 0, NULL, CAST(p_size AS DOUBLE), NULL FROM part)")
def combined_frame(t):
    a = normalize.prefix_entities(t("events").select(F.col("user_id").cast("string").alias("entity_id"), F.lit(1).alias("label"), F.col("event_type").alias("kind"), "value"), "e")
    b = t("part").select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit(0).alias("label"), F.col("p_size").alias("size_"))
    return normalize.combine([a, b])


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'a' WHEN 2 THEN 'ns' WHEN 5 THEN 'cname' ELSE 'other' END AS rr FROM lineitem")
def rr_type_names(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", C.rr_type_name(F.col("l_linenumber")).alias("rr"))


@query("SELECT o_orderkey, least(60.0::DOUBLE, pow(2.0, least(o_orderkey % 9, 6))) AS pause, least(100.0::DOUBLE, greatest(0.0, coalesce((o_custkey - 100) * 100.0::DOUBLE / nullif(o_orderkey % 400, 0), 0.0))) AS progress FROM orders")
def backoff_and_progress(t):
    return t("orders").select("o_orderkey", C.backoff_seconds(F.col("o_orderkey") % 9).alias("pause"), C.progress(F.col("o_custkey") - 100, F.col("o_orderkey") % 400).alias("progress"))


@query("SELECT o_orderkey, 'w ' || CAST(o_custkey AS VARCHAR) || '  -x' AS a, CAST(o_orderkey AS VARCHAR) AS b_2, CASE WHEN o_orderkey % 2 = 0 THEN 'u=v' END AS c FROM orders")
def trace_key_values(t):
    text = F.concat(F.lit("lead -x=1 b_2=0 a=w "), F.col("o_custkey").cast("string"), F.lit("  -x b_2="), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " c=u=v").otherwise(""))
    m = C.key_values(text)
    return t("orders").select("o_orderkey", m.alias("m")).select("o_orderkey", *[F.col("m")[k].alias(k) for k in ("a", "b_2", "c")])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 5 <> 0")
def anti_deleted_rows(t):
    c = t("customer").select("c_custkey", "c_name")
    session = editor.Session(c.withColumnRenamed("c_custkey", editor.INDEX), editor.Session.of(c).patches, c.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias(editor.INDEX)))
    return session.rows().withColumnRenamed(editor.INDEX, "c_custkey")


@query("SELECT count(*) FILTER (WHERE c_custkey % 5 <> 0) AS n_rows, count(*) FILTER (WHERE c_custkey % 7 = 0) AS pending_cells, count(*) FILTER (WHERE c_custkey % 5 = 0) AS deleted_rows, CAST(ceil(count(*) FILTER (WHERE c_custkey % 5 <> 0) / 50.0) AS BIGINT) AS pages FROM customer")
def session_state(t):
    c = t("customer").select(F.col("c_custkey").alias(editor.INDEX), "c_name")
    patches = c.where("row_index % 7 = 0").select(editor.INDEX, F.lit("c_name").alias("column"), F.lit("x").alias("value"), F.lit(1).cast("bigint").alias("seq"))
    state = editor.Session(c, patches, c.where("row_index % 5 = 0").select(editor.INDEX)).state(50)
    return c.sparkSession.createDataFrame([(state["rows"], state["pending_cells"], state["deleted_rows"], state["pages"])], "n_rows bigint, pending_cells bigint, deleted_rows bigint, pages bigint")


@query("""SELECT o_orderkey, TRY_CAST(v AS BIGINT) AS as_int, TRY_CAST(v AS DOUBLE) AS as_float, CASE WHEN lower(v) IN ('true', '1', 'yes') THEN true WHEN lower(v) IN ('false', '0', 'no') THEN false END AS as_bool, coalesce(CAST(TRY_CAST(v AS BIGINT) AS VARCHAR), v) AS lenient_int
FROM (SELECT o_orderkey, nullif(CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN '' WHEN 3 THEN 'x' || o_orderkey WHEN 4 THEN '1' ELSE 'FALSE' END, '') AS v FROM orders)""")
def typed_cells(t):
    text = F.get(F.array(F.lit("Yes"), F.col("o_custkey").cast("string"), F.lit(""), F.concat(F.lit("x"), "o_orderkey"), F.lit("1"), F.lit("FALSE")), (F.col("o_orderkey") % 6).cast("int"))
    return t("orders").select("o_orderkey", editor.coerced(text, "int").alias("as_int"), editor.coerced(text, "float").alias("as_float"), editor.coerced(text, "bool").alias("as_bool"), editor.lenient(text, "int").alias("lenient_int"))


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN doc_id % 2 WHEN 3 THEN 1 WHEN 4 THEN NULL ELSE NULL END AS label, CASE WHEN doc_id % 6 = 1 THEN 'early' WHEN doc_id % 6 IN (0, 3) THEN 'exfiltration' END AS stage FROM labels""")
def label_from_metadata(t):
    texts = [F.lit('{"exploit": true, "label": 0}'), F.lit('{"exploit": false, "attack_stage": " early "}'), F.concat(F.lit('{"label": '), (F.col("doc_id") % 2).cast("string"), F.lit("}")), F.lit('{"exploit": "yes", "is_malicious": true}'), F.lit('{"label": "1"}'), F.lit("{}")]
    rows = t("labels").select("doc_id", F.get(F.array(*texts), (F.col("doc_id") % 6).cast("int")).alias("d"))
    label = discovery.label_of(F.col("d"))
    return rows.select("doc_id", label.alias("label"), discovery.stage_of(F.col("d"), label).alias("stage"))


_MEMBERS = "(SELECT source AS archive, lang || '/' || doc_id || ['.csv', '.sc', '.txt', '_domains.csv', '.json'][1 + doc_id % 5] AS member, doc_id FROM documents WHERE doc_id % 5 <> 1 OR lang = 'en')"


@query(f"""WITH m AS {_MEMBERS}, h AS (SELECT archive, bool_or(member LIKE '%.sc') AS host FROM m GROUP BY archive)
SELECT archive, count(*) AS extracted, count(*) FILTER (WHERE reason IS NULL) AS trainable, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM (SELECT m.archive, CASE WHEN member LIKE '%.txt' THEN 'unsupported' WHEN host AND member LIKE '%.csv' THEN 'type' WHEN regexp_matches(member, '_domains[.]csv$') THEN 'supporting' END AS reason FROM m JOIN h USING (archive)) GROUP BY archive""")
def discovery_summary(t):
    tails = F.array(*[F.lit(x) for x in (".csv", ".sc", ".txt", "_domains.csv", ".json")])
    rows = t("documents").where("doc_id % 5 <> 1 OR lang = 'en'").select(F.col("source").alias("archive"), F.concat_ws("", "lang", F.lit("/"), F.col("doc_id").cast("string"), F.get(tails, (F.col("doc_id") % 5).cast("int"))).alias("member"), F.lit("{}").cast("binary").alias("content"))
    return discovery.summary(discovery.discover(rows))


@query("SELECT coalesce(f.k, k.k) AS k, CASE WHEN k.k IS NULL THEN 'insert' WHEN f.k IS NOT NULL THEN 'update' ELSE 'delete' END AS action FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) f FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) k ON f.k = k.k")
def archive_sync(t):
    c = t("customer").select(F.col("c_custkey").alias("k"))
    return lineage.sync(c.where("k % 3 <> 0"), c.where("k % 2 = 0"), "k")


@query("SELECT a.o_orderkey AS i, a.o_custkey AS record, b.o_totalprice AS prediction FROM orders a JOIN orders b USING (o_orderkey)")
def zip_predictions(t):
    o = t("orders")
    return lineage.zipped(o.select(F.col("o_orderkey").alias("i"), F.col("o_custkey").alias("record")), o.select(F.col("o_orderkey").alias("i"), F.col("o_totalprice").alias("prediction")), "i")


@query("SELECT o_orderkey, coalesce(x, o_custkey) AS artifact FROM orders LEFT JOIN (SELECT l_orderkey, max(l_partkey) AS x FROM lineitem WHERE l_quantity > 48 GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def fallback_lookup(t):
    best = t("lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("artifact"))
    return lineage.with_fallback(t("orders").select("o_orderkey", "o_custkey"), "o_orderkey", best, "artifact", "o_custkey").select("o_orderkey", "artifact")


@query("SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) THEN 'pending' ELSE o_orderstatus END AS status FROM orders")
def invalidate_changed(t):
    changed = t("customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("raw"))
    return lineage.invalidated(t("orders").select("o_orderkey", F.col("o_custkey").alias("raw"), F.col("o_orderstatus").alias("status")), changed, "raw").select("o_orderkey", "status")


@query("SELECT c_custkey, count(o_orderkey) AS \"references\" FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def reference_counts(t):
    return lineage.references(t("customer"), t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT n_nationkey FROM nation WHERE lower(n_name) = lower((SELECT min(n_name) FROM nation)) OR n_nationkey IN (3, 5) OR n_regionkey IN (2)")
def named_or_listed(t):
    n = t("nation")
    first = n.agg(F.min("n_name").alias("m")).first()["m"]
    return lineage.named(n, "n_name", f" {first.upper()} ").unionAll(lineage.either(n, "n_nationkey", [3, 5], "n_regionkey", [2])).select("n_nationkey").distinct()


@query("SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS available_at FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS TIMESTAMP) <= TIMESTAMP '1997-06-01' ORDER BY o_orderdate, o_orderkey LIMIT 10")
def due_messages(t):
    m = t("orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("sent").alias("status"), F.col("o_orderdate").cast("timestamp").alias("available_at"), F.col("o_orderdate").alias("created_at"))
    return lineage.due(m, "1997-06-01").select("id", F.col("available_at").cast("timestamp_ntz").alias("available_at"))


@query("SELECT DISTINCT event_type AS consumer, user_id AS message_id FROM events WHERE (event_type, user_id) NOT IN (SELECT event_type, user_id FROM events WHERE event_id % 10 = 0)")
def undelivered_messages(t):
    m = t("events").select(F.col("event_type").alias("consumer"), F.col("user_id").alias("message_id"), "event_id")
    return lineage.undelivered(m.drop("event_id"), m.where("event_id % 10 = 0"))


@query("WITH r AS (SELECT event_id, event_type = 'purchase' AS y, row_number() OVER (PARTITION BY event_type = 'purchase' ORDER BY md5('sample:' || event_id), event_id) AS r, count(*) OVER (PARTITION BY event_type = 'purchase') AS n FROM events), c AS (SELECT count(*) AS n, least(2500, min(n)) AS m FROM r) SELECT event_id, CAST(y AS INTEGER) AS label FROM r, c WHERE c.n <= 500 OR r <= c.m")
def balanced_sample(t):
    return detector.balanced(t("events").select(F.col("event_id").alias(detector.KEY), (F.col("event_type") == "purchase").cast("int").alias("label")), 500).select(F.col(detector.KEY).alias("event_id"), "label")


def _branch(t, name):
    rows = t("events").select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("entity_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"), F.lit("network").alias("source_type"), (F.col("value") > 60).cast("int").alias("label"), F.lit(None).cast("string").alias("attack_stage"), F.lit("TA0011").alias("mitre_tactic"), "event_type", (F.col("value") + F.col("event_id") % 17).alias("value"), (F.col("event_id") % 7).cast("double").alias("seen"))
    schema = normalize.FeatureSchema("events", ["event_type", "value", "seen"])
    bundle = detector.train(rows, schema, trees=20, rounds=10, depth=5)
    scored = detector.predict(bundle, rows.select("entity_id", "event_ts", "event_type", "value", "seen"))
    return scored.select("row_index", F.round(name, 6).alias("score"))


@query()
def rf_scores(t):
    return _branch(t, "random_forest")


@query()
def gbt_scores(t):
    return _branch(t, "boosted_trees")


@query(f"SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket, count(*) AS packet_count, round(sum(value), 4) AS bytes_sum, round(avg(value), 4) AS bytes_mean, {', '.join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}_count" for k in KINDS)} FROM events GROUP BY ALL")
def streaming_flow(t):
    events = t("events")
    source = events.sparkSession.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(events.inputFiles()[0].rsplit("/", 1)[0] + "/events.parque*")
    out = flows.drain(events.sparkSession, flows.flow_stream(source, "user_id", "ts", "value", "event_type", KINDS))
    return out.withColumn("bytes_sum", F.round("bytes_sum", 4)).withColumn("bytes_mean", F.round("bytes_mean", 4))
