"""What archives hold: labels, source types, files to train on, and a schema for them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconframe.functions import columns as C
from beaconframe.operators import core
from beaconframe.operators.normalize import CORE, ContractError, FeatureSchema
from beaconframe.sources import formats

# fixed values: suffixes of host and network data, keys of an archive's own description, and columns that are like ids
HOST, NETWORK = [".sc", ".res"], [".csv", ".tsv", ".parquet", ".xlsx", ".pcap", ".pcapng"]
DESCRIPTION_KEYS = ["container", "exploit", "exploit_name", "image", "recording_time", "time"]
ID_LIKE = ["args", "cgroups", "cmd", "cwd", "data", "filename", "name", "path", "raw_args", "request", "tuple", "val"]


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def type_from_path(path: Column) -> Column:
    """What a path's words say."""
    return F.when(C.name_has(path, ["host"]), "host").when(C.name_has(path, ["dns", "network", "pcap", "flow"]), "network")


def type_from_suffix(path: Column) -> Column:
    """What a file's suffix says."""
    return F.when(suffix(path).isin(HOST), "host").when(suffix(path).isin(NETWORK), "network")


def label_of(text: Column) -> Column:
    """The label that a description (JSON) tells: exploit, label, is_malicious or is_attack, the first that is one."""
    flag = lambda key, number=False: F.when(F.get_json_object(text, f"$.{key}") == "true", 1).when(F.get_json_object(text, f"$.{key}") == "false", 0).otherwise(F.get_json_object(text, f"$.{key}").try_cast("int") if number else F.lit(None))
    plain = lambda key: ~F.coalesce(F.contains(text, F.lit(f'"{key}": "')) | F.contains(text, F.lit(f'"{key}":"')), F.lit(False))  # noqa: E731  a text is no flag
    return F.coalesce(*[F.when(plain(k), flag(k, k == "label")) for k in ("exploit", "label", "is_malicious", "is_attack")])


def stage_of(text: Column, label: Column) -> Column:
    """The stage that a description tells; exfiltration for a positive label without one."""
    return F.coalesce(C.blank_to_null(F.get_json_object(text, "$.attack_stage")), F.when(label == 1, "exfiltration"))


def describing(members: DataFrame) -> DataFrame:
    """Of each archive the first member in the order of paths that describes it: a JSON object with `exploit`, or three of the known keys."""
    text = F.decode("content", "UTF-8")
    keys = F.json_object_keys(text)
    known = F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in DESCRIPTION_KEYS])))
    found = members.where(suffix(F.col("member")) == ".json").withColumn("text", text).where(F.array_contains(keys, "exploit") | (known >= 3))
    return found.groupBy("archive").agg(F.min(F.struct("member", "text")).alias("d")).select("archive", F.col("d.member").alias("described_by"), F.col("d.text").alias("description"))


def discover(members: DataFrame) -> DataFrame:
    """Each member with source_type, label, stage and reason, which is null for a file to train on.

    members: archive, member, content, as read_archives gives them.
    """
    votes = members.groupBy("archive").agg(F.max(suffix(F.col("member")).isin(HOST)).alias("host"), F.max(suffix(F.col("member")).isin(NETWORK)).alias("network"))
    preferred = votes.select("archive", F.coalesce(F.when(F.col("host"), "host").when(F.col("network"), "network"), type_from_path(F.col("archive"))).alias("preferred"))
    rows = members.select("archive", "member", F.octet_length("content").alias("length")).join(preferred, "archive").join(describing(members), "archive", "left")
    member = F.col("member")
    kind = F.coalesce(type_from_suffix(member), F.col("preferred"), type_from_path(F.col("archive")), F.lit("host"))
    known = suffix(member).isin(list(formats.FORMATS))
    reason = (
        F.when(~known, "unsupported_dataset_format")
        .when(member.eqNullSafe(F.col("described_by")), "archive_metadata")
        .when(F.col("preferred").isNotNull() & (kind != F.col("preferred")), F.concat(F.lit("ignored_for_"), F.col("preferred")))
        .when(F.lower(member).rlike(r"_domains\.(csv|tsv)$"), "supporting_only")
    )
    label = label_of(F.col("description"))
    return rows.select("archive", "member", "length", kind.alias("source_type"), label.alias("label"), stage_of(F.col("description"), label).alias("attack_stage"), reason.alias("reason"))


def summary(found: DataFrame) -> DataFrame:
    """of each archive the files found, to train on and left out."""
    return found.groupBy("archive").agg(F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("reason").isNull()).alias("trainable"), F.count_if(F.col("reason").isNotNull()).alias("skipped"))


def voted_type(found: DataFrame) -> str | None:
    """The source type of most files to train on; of equal ones the last by name."""
    best = found.where("reason IS NULL").groupBy("source_type").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("source_type", F.struct("n", "source_type")).alias("t")).first()
    return best["t"]


def families_of(columns: list[str], source_type: str) -> list[str]:
    """Sorted families of column names; process or network_flow if none tells, and sequence for hosts."""
    found = {f for c in columns for f, words in C.FAMILIES.items() if any(w in c.lower() for w in words)}
    found = found or {"process" if source_type == "host" else "network_flow"}
    return sorted(found | ({"sequence"} if source_type == "host" else set()))


def auto_schema(events: DataFrame, source_type: str, name: str, limit: int = 128) -> FeatureSchema:
    """A schema of the columns that tell most; an error if there is none."""
    profile = core.column_profile(events.drop(*CORE)) if len(events.columns) > len(CORE) else None
    chosen = [r["column"] for r in core.select_features(profile, ID_LIKE, limit).collect()] if profile is not None else []  # names of columns
    if not chosen:
        raise ContractError("no column can be used")
    return FeatureSchema(name, chosen, source_type, feature_families=families_of(chosen, source_type))


def schema_json(schema: FeatureSchema) -> str:
    return json.dumps(schema.__dict__, sort_keys=True)
