"""Column expressions shared by the operators; built-in functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def shannon_entropy(s: Column) -> Column:
    """Bits per character; 0 for an empty text, null for null."""
    chars = F.array_distinct(F.split(s, ""))
    share = lambda c: (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / F.length(s)
    sum_ = F.aggregate(chars, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    return F.when(s == "", F.lit(0.0)).otherwise(sum_)


def domain_features(s: Column) -> dict[str, Column]:
    """Features of a trimmed, lower-cased domain."""
    n = F.length(s)
    labels = F.size(F.filter(F.split(s, r"\."), lambda x: x != ""))
    return {
        "length": n.cast("bigint"),
        "numeric_ratio": F.when(n > 0, F.regexp_count(s, F.lit("[0-9]")) / n).otherwise(0.0),
        "depth": F.greatest(labels - 2, F.lit(0)).cast("bigint"),
        "entropy": shannon_entropy(s),
        "hyphens": F.regexp_count(s, F.lit("-")).cast("bigint"),
    }


def clean_domain(s: Column) -> Column:
    """Trimmed, without quotes, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.trim(s), "^[\"']+|[\"']+$", "")))


def key_values(s: Column) -> Column:
    """Map of key=value pairs; a value runs to the next key, words without a key belong to the value before; of equal keys the last counts.

    Keys are letters, digits and underscores, not led by a digit, at the start or after a space.
    """
    word = "[A-Za-z_][A-Za-z0-9_]*="
    parts = F.filter(F.split(s, rf"\s+(?={word})"), lambda x: x.rlike(f"^{word}"))
    keys, values = F.transform(parts, lambda x: F.substring_index(x, "=", 1)), F.transform(parts, lambda x: F.substring(x, F.instr(x, "=") + 1, F.length(x)))
    # the last of equal keys: the reversed lists are searched from their start
    return F.element_at(
        F.transform(F.array(F.struct(F.reverse(keys).alias("k"), F.reverse(values).alias("v"))), lambda kv: F.map_from_arrays(F.array_distinct(kv["k"]), F.transform(F.array_distinct(kv["k"]), lambda k: F.get(kv["v"], (F.array_position(kv["k"], k) - 1).cast("int"))))), 1
    )


def epoch_divisor(largest: Column) -> Column:
    """C4: units per second by the column's largest magnitude."""
    return F.when(largest >= 1e17, F.lit(1_000_000_000)).when(largest >= 1e14, F.lit(1_000_000)).when(largest >= 1e11, F.lit(1000)).otherwise(F.lit(1)).cast("bigint")


def sigmoid(x: Column) -> Column:
    """Clipped at 30."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), x))))


def linear_score(weights: dict[str, float], bias: float = 0.0) -> Column:
    """J8."""
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in weights.items()], F.lit(bias))


def late_fusion(*scores: Column) -> Column:
    """row mean."""
    return reduce(lambda a, b: a + b, scores) / F.lit(float(len(scores)))


def label_from_name(name: Column) -> Column:
    """Benign names are 0, all others 1."""
    return F.when(F.lower(name).contains("benign"), 0).otherwise(1)


def backoff_seconds(attempts: Column) -> Column:
    """J20."""
    return F.least(F.lit(60.0), F.pow(F.lit(2.0), F.least(attempts, F.lit(6))))


def rr_type_name(code: Column) -> Column:
    """DNS record type of a code; `other` for the rest, null too."""
    # fixed values: DNS record type codes
    names = {1: "a", 2: "ns", 5: "cname", 12: "ptr", 15: "mx", 16: "txt", 28: "aaaa"}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[code.cast("int")], F.lit("other"))


def epoch_time(value: Column, divisor: Column) -> Column:
    """The time of a number of units since 1970, to the microsecond."""
    whole = F.floor(value / divisor)
    return F.timestamp_micros((whole * 1_000_000 + F.floor((value - whole * divisor) * 1_000_000 / divisor)).cast("bigint"))


def iso_seconds(t: Column) -> Column:
    """ISO text of a time, to the second."""
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def trace_time(value: Column) -> Column:
    """ISO text of an epoch given as text, each in the unit of its own magnitude; null for what is no number."""
    n = value.try_cast("decimal(30,6)")
    return iso_seconds(epoch_time(n, epoch_divisor(F.abs(n))))


def synthetic_time(ordinal: Column, base: str = "2026-01-01 00:00:00") -> Column:
    """Base and a second for each row before."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(base).cast("timestamp")) + ordinal)


def blank_to_null(s: Column) -> Column:
    """Trimmed; null if nothing is left."""
    return F.nullif(F.trim(s), F.lit(""))


def trace_number(s: Column) -> Column:
    """The number that a field spells as an integer or with a point; null for the rest."""
    return F.when(F.trim(s).rlike(r"^-?\d+(\.\d+)?$"), F.trim(s).try_cast("double"))


def name_has(name: Column, words: list[str]) -> Column:
    """Whether the lower-cased name has one of the words in it."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(name), F.lit(w)) for w in words])


def stage_from_name(name: Column) -> Column:
    """Attack stage that a file name tells; null for a benign one."""
    # fixed values: words of file names
    words = ["phishing", "malware", "spam", "heavy", "light", "attack", "exf"]
    return F.when(name_has(name, ["benign"]), F.lit(None)).when(name_has(name, words), "exfiltration").otherwise("suspicious_activity")


def default_tactic(source_type: Column) -> Column:
    """Tactic of a source type."""
    return F.when(source_type == "network", "TA0011").otherwise("TA0006")


#: J12, fixed values: words of column names and the family that each tells.
FAMILIES = {
    "process": ["process", "syscall", "thread", "pid", "exec", "comm"],
    "file_system": ["file", "path", "storage", "fd", "dir", "mode", "dev"],
    "privilege": ["uid", "gid", "euid", "privilege"],
    "network_flow": ["network", "socket", "proto", "port", "ip", "dns", "packet"],
    "user_activity": ["user", "session", "login"],
    "sequence": ["sequence", "timestamp", "event_ts"],
}


def feature_families(name: Column) -> Column:
    """Sorted families of one column name."""
    return F.array_sort(F.array_compact(F.array(*[F.when(name_has(name, words), f) for f, words in FAMILIES.items()])))


def progress(done: Column, total: Column) -> Column:
    """Share done in percent, kept within 0 to 100; 0 of nothing."""
    return F.coalesce(F.least(F.lit(100.0), F.greatest(F.lit(0.0), done * 100.0 / F.nullif(total, F.lit(0)))), F.lit(0.0))
