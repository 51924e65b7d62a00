"""From a file to canonical events and a quality report."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NumericType, StringType, StructType

from beaconframe.functions import columns as C
from beaconframe.operators import core, ordered
from beaconframe.session import cut
from beaconframe.sources import formats, packets

# fixed values: the canonical columns, the columns of known feeds in their order, measures, and profiles with their schemas
CORE = ["entity_id", "event_ts", "source_type", "label", "attack_stage", "mitre_tactic"]
DOMAIN_MEASURES = ["domain_length", "numeric_ratio", "subdomain_depth", "domain_entropy", "hyphen_count"]
FLOW_MEASURES = ["packet_count", "byte_total", "mean_packet_size", "mean_inter_arrival_ms", "dns_query_entropy_mean", "communication_frequency", "query_rr_count", "answer_rr_count", "unique_qnames", "rr_type_a", "rr_type_ns", "rr_type_cname", "rr_type_mx", "rr_type_txt", "rr_type_aaaa", "rr_type_ptr", "rr_type_other", "ttl_mean", "ttl_max"]
STATEFUL = "rr a_frequency ns_frequency cname_frequency soa_frequency null_frequency ptr_frequency hinfo_frequency mx_frequency txt_frequency aaaa_frequency srv_frequency opt_frequency rr_type rr_count rr_name_entropy rr_name_length distinct_ns distinct_ip unique_country unique_asn distinct_domains reverse_dns a_records unique_ttl ttl_mean ttl_variance".split()
STATELESS = "timestamp fqdn_count subdomain_length upper lower numeric entropy special labels labels_max labels_average longest_word sld len subdomain".split()
SCHEMAS = {
    "dns2021_tabular_features": ["dns-domain-tabular"],
    "dns2021_domain_lists": ["dns-domain-intel"],
    "dns_exf_stateful": ["dns-network-stateful"],
    "dns_exf_stateless": ["dns-network-stateless"],
    "dns_pcap_dns_flow": ["dns-pcap-flow"],
    "generic_tabular": ["host-simulated"],
    "generic_json": ["host-simulated"],
}
# fixed values: texts of warnings
NO_TIMES = "Synthetic timestamps were used for rows without a parseable event timestamp."
NO_LABELS = "Labels were derived deterministically from the file name."
DOMAINS_ONLY = "Domain lists are treated as auxiliary supporting_only inputs."
TABULAR_FEED = {"domain", "ttl", "asn", "ip", "entropy"}
#: Columns that name an entity where the manifest's isn't there, the first one counts.
ENTITIES = ["domain", "domain_name", "rr"]
#: Share of a text column's rows that must be numbers for it to be a numeric column.
NUMERIC_SHARE = 0.6


class ContractError(ValueError):
    """Data that isn't as its contract says."""


@dataclass
class Manifest:
    """The roles of a file's columns, and what holds where they are missing."""

    source_type: str = "network"
    timestamp_column: str = "event_ts"
    entity_id_column: str = "entity_id"
    label_column: str = "label"
    attack_stage_column: str | None = None
    default_label: int | None = None
    default_attack_stage: str | None = None


@dataclass
class FeatureSchema:
    """The columns that a model asks for."""

    name: str
    required_columns: list[str]
    source_type: str = "network"
    version: str = "1.0.0"
    feature_families: list[str] = field(default_factory=list)
    mitre_tactics: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if len(set(self.required_columns)) != len(self.required_columns):  # I6
            raise ContractError("required columns repeat")


def column_name(raw: str) -> str:
    """Lower-case letters, digits and single underscores between them."""
    return "_".join(re.findall(r"[0-9a-zA-Z]+", raw)).lower() or "unnamed"


def with_clean_names(df: DataFrame) -> DataFrame:
    """Normalized column names, repeated ones numbered."""
    return df.toDF(*formats.dedup_headers([column_name(c) for c in df.columns]))


def as_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON, so that all rows can be compared; other columns as they are."""
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f"`{f.name}`") for f in df.schema])


def require(columns: list[str], asked: list[str]) -> None:
    """An error that names what is missing."""
    if missing := [c for c in asked if c not in columns]:
        raise ContractError(f"missing columns: {missing}")


def project(df: DataFrame, schema: FeatureSchema) -> DataFrame:
    """The canonical columns and those of the schema, in its order."""
    require(df.columns, schema.required_columns)
    return df.select(*CORE, *schema.required_columns)


def profile_of(path: str, format_: str, columns: list[str]) -> str:
    """What kind of feed a file is; the first rule that fits counts."""
    names = [column_name(c) for c in columns]
    rules = [
        (format_ == "pcap", "dns_pcap_dns_flow"),
        (formats.is_domain_list(path), "dns2021_domain_lists"),
        (format_ == "json", "generic_json"),
        (names == STATEFUL, "dns_exf_stateful"),
        (names == STATELESS, "dns_exf_stateless"),
        (set(names) >= TABULAR_FEED or formats.name_of(path).lower().startswith("csv_"), "dns2021_tabular_features"),
    ]
    return next((p for fits, p in rules if fits), "generic_tabular")


def target_columns(profile: str) -> list[str]:
    """The columns that a profile's events are meant to have."""
    more = {"dns_exf_stateful": STATEFUL, "dns_exf_stateless": STATELESS[1:], "dns2021_domain_lists": DOMAIN_MEASURES, "dns_pcap_dns_flow": FLOW_MEASURES}
    return CORE + more.get(profile, [])


def inspect(spark: SparkSession, path: str) -> dict:
    """Format, columns, profile, warnings and fitting schemas of a file."""
    format_ = formats.detect_format(spark, path)
    columns = target_columns("dns_pcap_dns_flow") if format_ == "pcap" else formats.headers(spark, path)
    profile = profile_of(path, format_, columns)
    notes = {
        "Domain lists only support other data; they are not trained on.": profile == "dns2021_domain_lists",
        "Packet captures are aggregated to flows, which may take long.": format_ == "pcap",
        "Malformed trace lines are left out.": format_ == "sc",
        "Malformed rows of this feed are left out and counted.": profile == "dns2021_tabular_features",
    }
    return {
        "path": formats.name_of(path),
        "format": format_,
        "profile": profile,
        "columns": columns,
        "name": f"{formats.stem_of(path)}-dataset",
        "target_columns": target_columns(profile),
        "warnings": [n for n, holds in notes.items() if holds],
        "supporting_only": profile == "dns2021_domain_lists",
        "schemas": SCHEMAS[profile],
    }


def parsed_time(df: DataFrame, column: str) -> Column:
    """A column as times: numbers in the unit of the column's largest one, other text as it says, else null. Reads the column once."""
    value = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return value.cast("timestamp")
    number = value.cast("string").try_cast("decimal(38,6)")
    top = df.agg(C.epoch_divisor(F.max(F.abs(number))).alias("d")).first()["d"]
    return F.coalesce(C.epoch_time(number, F.lit(top)), value.cast("string").try_cast("timestamp"))


def coerce_numbers(df: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """Text columns of mostly numbers become numeric, what isn't a number there is null and counted. One pass over the data."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    if not texts:
        return df, 0
    number = {c: F.col(f"`{c}`").try_cast("double") for c in texts}
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(number[c]).alias(f"n{k}") for k, c in enumerate(texts)], *[F.count(F.col(f"`{c}`")).alias(f"v{k}") for k, c in enumerate(texts)]).first()
    chosen = {c: k for k, c in enumerate(texts) if counts[f"n{k}"] >= max(1, int(counts["n"] * NUMERIC_SHARE))}
    out = df.select(*[number[c].alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])
    return out, sum(counts[f"v{k}"] - counts[f"n{k}"] for k in chosen.values())


def first_of_equal(rows: DataFrame, index: str) -> DataFrame:
    """Of equal rows (but for the index) that of the least index."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns if c != index]).agg(F.min(index).alias(index))


def _defaults(path: str, manifest: Manifest) -> tuple[Column, Column, Column]:
    """Label, stage and tactic where the data has none."""
    name = F.lit(formats.name_of(path))
    label = F.lit(manifest.default_label) if manifest.default_label is not None else C.label_from_name(name)
    stage = F.lit(manifest.default_attack_stage) if manifest.default_attack_stage is not None else C.stage_from_name(name)
    return label.cast("int"), stage.cast("string"), C.default_tactic(F.lit(manifest.source_type))


def normalize_table(raw: DataFrame, path: str, manifest: Manifest) -> tuple[DataFrame, dict]:
    """Canonical events of a table, and what was found on the way.

    Rows are taken in the order in which they are read. Equal rows are taken once. A row
    without an entity has that of the row before, the first ones that of the file. A row
    without a time gets one by its place.
    """
    frame = with_clean_names(as_text(raw))
    index = "__index"
    read = ordered.ordinal(frame, index)
    once = first_of_equal(read, index)
    rows = ordered.rank(once, [], [index], "__place").withColumn("__place", F.col("__place") - 1).drop(index)
    total, kept = read.count(), once.count()
    names, stem = frame.columns, formats.stem_of(path)
    label, stage, tactic = _defaults(path, manifest)
    time_column, entity_column, label_column, stage_column = (column_name(c) for c in (manifest.timestamp_column, manifest.entity_id_column, manifest.label_column, manifest.attack_stage_column or "attack_stage"))

    entity = next((c for c in [entity_column, *ENTITIES] if c in names), None)
    rows = rows.withColumn("__entity", F.col(f"`{entity}`").cast("string") if entity else F.concat(F.lit(f"{stem}-"), F.col("__place")))
    if entity:
        rows = ordered.fill(rows, "__entity", [], ["__place"], f"{stem}-entity")
    times = next((c for c in (time_column, "timestamp") if c in names), None)
    parsed = parsed_time(rows, times) if times else F.lit(None).cast("timestamp")
    rows = cut(rows.withColumn("__time", parsed))
    lost = rows.where("__time IS NULL").count()
    features = [c for c in names if c not in {entity_column, time_column, label_column, stage_column, *CORE}]
    rows, invalid = coerce_numbers(rows, features)
    column = lambda name, otherwise: F.col(f"`{name}`").cast("string") if name in names else otherwise
    events = rows.select(
        F.col("__entity").alias("entity_id"),
        C.iso_seconds(F.coalesce("__time", C.synthetic_time(F.col("__place")))).alias("event_ts"),
        F.lit(manifest.source_type).alias("source_type"),
        (F.coalesce(F.col(f"`{label_column}`").cast("string").try_cast("double").cast("int"), label) if label_column in names else label).alias("label"),
        column(stage_column, stage).alias("attack_stage"),
        column("mitre_tactic", tactic).alias("mitre_tactic"),
        *[F.col(f"`{c}`") for c in features],
    )
    notes = []
    if lost or time_column not in names:
        notes.append(NO_TIMES)
    if label_column not in names:
        notes.append(NO_LABELS)
    return events, {"duplicate_rows": total - kept, "invalid_values": invalid, "warnings": notes, "supporting_only": False, "details": {"original_columns": names, "synthetic_timestamps_used": lost}}


def normalize_domains(domains: DataFrame, path: str, manifest: Manifest) -> tuple[DataFrame, dict]:
    """Canonical events of a list of domains; a list without any is an error."""
    label, stage, tactic = _defaults(path, manifest)
    cleaned = ordered.ordinal(domains.select(C.clean_domain(F.col("domain")).alias("d")).where("d <> ''"), "__place")
    measured = [m.alias(n) for n, m in zip(DOMAIN_MEASURES, C.domain_features(F.col("d")).values(), strict=True)]
    events = cleaned.select(F.col("d").alias("entity_id"), C.iso_seconds(C.synthetic_time(F.col("__place"))).alias("event_ts"), F.lit(manifest.source_type).alias("source_type"), label.alias("label"), stage.alias("attack_stage"), tactic.alias("mitre_tactic"), *measured)
    n = events.count()
    if not n:
        raise ContractError("the list has no domains")
    return events, {"duplicate_rows": 0, "invalid_values": 0, "warnings": [DOMAINS_ONLY], "supporting_only": True, "details": {"domain_count": n}}


def normalize_flows(rows: DataFrame, path: str, manifest: Manifest) -> tuple[DataFrame, dict]:
    """canonical events of DNS packets, one for each flow of a second; a capture without any is an error."""
    label, stage, tactic = _defaults(path, manifest)
    flows = packets.flows(rows)
    events = cut(flows.select(F.concat_ws("->", "src", "dst").alias("entity_id"), C.iso_seconds(F.timestamp_seconds("second")).alias("event_ts"), F.lit(manifest.source_type).alias("source_type"), label.alias("label"), stage.alias("attack_stage"), tactic.alias("mitre_tactic"), *FLOW_MEASURES))
    n = events.count()
    if not n:
        raise ContractError("the capture has no DNS packets")
    return events, {"duplicate_rows": 0, "invalid_values": 0, "warnings": ["Packets were aggregated to DNS flows."], "supporting_only": False, "details": {"bucket_count": n}}


def normalize(spark: SparkSession, path: str, manifest: Manifest | None = None, schema: FeatureSchema | None = None) -> tuple[DataFrame, dict]:
    """A file's canonical events and its quality report (B2). With a feature schema, only its columns."""
    manifest = manifest or Manifest()
    format_ = formats.detect_format(spark, path)
    raw = formats.read(spark, path)
    profile = profile_of(path, format_, raw.columns)
    skipped = 0
    if format_ == "pcap":
        events, found = normalize_flows(raw, path, manifest)
    elif profile == "dns2021_domain_lists":
        events, found = normalize_domains(raw, path, manifest)
    else:
        if format_ in ("csv", "tsv", "res"):
            skipped = formats.skipped_rows(spark, path, raw.count())
        events, found = normalize_table(raw, path, manifest)
    events = cut(events)
    counted = core.missing_cells(events).first()
    rows = cut(events.distinct())
    n = rows.count()
    if schema is not None:
        rows = project(rows, schema)
    report = {
        "path": path,
        "format": format_,
        "profile": profile,
        "columns": rows.columns,
        "row_count": n,
        "dropped_rows": skipped,
        "duplicate_rows": found["duplicate_rows"] + counted["n_rows"] - n,
        "missing_values": counted["missing_values"],
        "invalid_values": found["invalid_values"],
        "supporting_only": found["supporting_only"],
        "warnings": list(dict.fromkeys(found["warnings"])),  # I5
        "details": found["details"] | ({"schema_name": schema.name, "schema_version": schema.version, "selected_features": schema.required_columns} if schema else {}),
        "manifest": asdict(manifest),
    }
    return rows, report


def write_normalized(rows: DataFrame, report: dict, path: str) -> None:
    """B1, B2: events as Parquet at path/events, the report as JSON at path/report."""
    rows.write.mode("overwrite").parquet(f"{path}/events")
    rows.sparkSession.createDataFrame([(json.dumps(report, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/report")


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Events as write_normalized wrote them, event_ts as a time; null where it is no time."""
    rows = spark.read.parquet(f"{path}/events")
    return rows.withColumn("event_ts", F.col("event_ts").try_cast("timestamp"))


def combine(frames: list[DataFrame]) -> DataFrame:
    """All events together, canonical columns first, the others by name, missing ones null. Columns that are text anywhere are text."""
    kinds: dict[str, set[bool]] = {}
    for df in frames:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(isinstance(f.dataType, NumericType))
    order = [c for c in CORE if c in kinds] + sorted(c for c in kinds if c not in CORE)
    alike = [df.select(*[F.col(f"`{c}`").cast("double" if kinds[c] == {True} and c != "label" else "int" if c == "label" else "string").alias(c) for c in df.columns]) for df in frames]
    out = alike[0]
    for df in alike[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select(*order)


def prefix_entities(events: DataFrame, stem: str) -> DataFrame:
    """Entities of an archive, told apart from those of others."""
    return events.withColumn("entity_id", F.concat(F.lit(f"{stem}:"), F.col("entity_id")))


def training_table(frames: list[DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """the combined events, and the rows of each label; fewer than two labels are an error."""
    rows = combine(frames)
    counts = {str(r["label"]): r["count"] for r in rows.groupBy("label").count().orderBy("label").collect()}
    if len(counts) < 2:
        raise ContractError(f"two labels are needed, found {counts}")
    return rows, counts
