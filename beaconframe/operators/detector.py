"""The detector: forest, boosted trees and two linear branches, fused; its metrics, scores and explanations."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from beaconframe.functions import columns as C
from beaconframe.operators import core, ordered
from beaconframe.operators.normalize import CORE, ContractError, FeatureSchema, require
from beaconframe.session import cut

BRANCHES = ["random_forest", "boosted_trees", "event_linear", "sequence_linear"]
#: Categories of a text column that become columns; more are an error, as feature selection leaves such columns out.
MOST_CATEGORIES = 1000
SEED, FOLDS, BALANCED_ABOVE, PER_CLASS = 42, 3, 5000, 2500
KEY = "__row"


def _expanded(df: DataFrame, schema: FeatureSchema, expanded: list[str] | None) -> tuple[DataFrame, list[str]]:
    """Numeric columns, an indicator for each category and for null; or exactly the given columns, missing ones 0."""
    made: dict[str, Column] = {}
    for c in schema.required_columns:
        kind = df.schema[c].dataType
        if isinstance(kind, (NumericType, BooleanType)):
            made[c] = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
            continue
        if expanded is None:
            values = sorted(r[0] for r in df.select(c).where(F.col(f"`{c}`").isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect())
            if len(values) > MOST_CATEGORIES:
                raise ContractError(f"{c} has over {MOST_CATEGORIES} categories")
        else:
            values = [e[len(c) + 1 :] for e in expanded if e.startswith(f"{c}_") and e != f"{c}_nan"]
        for v in values:
            made[f"{c}_{v}"] = F.when(F.col(f"`{c}`") == v, 1.0).otherwise(0.0)
        made[f"{c}_nan"] = F.when(F.col(f"`{c}`").isNull(), 1.0).otherwise(0.0)
    columns = expanded if expanded is not None else list(made)
    return df.select(*[c for c in (*CORE, KEY) if c in df.columns], *[made.get(c, F.lit(0.0)).alias(c) for c in columns]), columns


def training_frame(events: DataFrame, schema: FeatureSchema, expanded: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """K1, H1: canonical columns, features as numbers, integer labels (0 where null) and a number of the row in the order of entity and time."""
    require(events.columns, CORE + schema.required_columns)
    types = [r[0] for r in events.select("source_type").where("source_type IS NOT NULL").distinct().limit(3).collect()]
    if len(types) > 1:
        raise ContractError("events of one source type are needed")
    if types and types[0] != schema.source_type:
        raise ContractError(f"the schema is for {schema.source_type}, the events are of {types[0]}")
    rows, columns = _expanded(events, schema, expanded)
    rows = rows.withColumn("event_ts", F.col("event_ts").try_cast("timestamp") if dict(rows.dtypes)["event_ts"] == "string" else F.col("event_ts")).withColumn("label", F.coalesce(F.col("label").cast("string").try_cast("double").cast("int"), F.lit(0)))
    return cut(ordered.rank(rows, [], ["entity_id", "event_ts", *columns[:1]], KEY)), columns


def split(rows: DataFrame, share: float = 0.75, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """K2, Q2: of each label the share of rows with the least hash, and the rest."""
    ranked = cut(ordered.rank(rows.withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), KEY))), ["label"], ["__h", KEY], "__r", "__n"))
    first = F.col("__r") <= F.floor(share * F.col("__n"))
    return ranked.where(first).drop("__h", "__r", "__n"), ranked.where(~first).drop("__h", "__r", "__n")


@dataclass
class Linear:
    """K7: weights and bias of the class means."""

    weights: dict[str, float]
    bias: float

    @staticmethod
    def of(rows: DataFrame, columns: list[str]) -> Linear:
        safe = rows.select("label", *[F.col(f"`{c}`").alias(f"x{k}") for k, c in enumerate(columns)])
        r = core.centroids(safe, "label", [f"x{k}" for k in range(len(columns))]).first()
        return Linear({c: float(r[f"w_x{k}"]) for k, c in enumerate(columns)}, float(r["bias"]))

    def score(self, prefix: str = "") -> Column:
        return C.sigmoid(C.linear_score({f"`{prefix}{c}`": w for c, w in self.weights.items()}, self.bias))


@dataclass
class Bundle:
    """The branches of a trained detector and what they need."""

    forest: RandomForestClassificationModel
    boosted: GBTClassificationModel
    event: Linear
    sequence: Linear
    columns: list[str]
    schema: FeatureSchema
    length: int = 50
    stride: int = 10
    metrics: dict = field(default_factory=dict)


def _vectors(rows: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=[f"x{k}" for k in range(len(columns))], outputCol="features").transform(rows.select("*", *[F.col(f"`{c}`").alias(f"x{k}") for k, c in enumerate(columns)])).drop(*[f"x{k}" for k in range(len(columns))])


def _windows(rows: DataFrame, columns: list[str], length: int, stride: int) -> DataFrame:
    safe = rows.select("entity_id", KEY, "label", *[F.col(f"`{c}`").alias(f"x{k}") for k, c in enumerate(columns)])
    pooled = core.sequence_windows(safe, "entity_id", [KEY], "label", KEY, length, stride, [f"x{k}" for k in range(len(columns))])
    return pooled.select("rep", "label", *[F.col(f"mean_x{k}").alias(c) for k, c in enumerate(columns)])


def scores(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """The rows with the probability of each branch, their mean (K8) and the label at 0.5.

    A window's probability holds for its last row and the entity's later ones up to the next; 0.5 before the first.
    """
    p = lambda c: vector_to_array(F.col(c)).getItem(1)
    v = _vectors(rows, bundle.columns)
    v = bundle.forest.transform(v).withColumn(BRANCHES[0], p("probability")).drop("probability", "rawPrediction", "prediction")
    v = bundle.boosted.transform(v).withColumn(BRANCHES[1], p("probability")).drop("probability", "rawPrediction", "prediction", "features")
    v = v.withColumn(BRANCHES[2], bundle.event.score())
    seen = _windows(rows, bundle.columns, bundle.length, bundle.stride).select(F.col("rep").alias("__rep"), bundle.sequence.score().alias(BRANCHES[3])).groupBy("__rep").agg(F.max(BRANCHES[3]).alias(BRANCHES[3]))
    joined = v.join(seen, F.col(KEY) == F.col("__rep"), "left").drop("__rep")
    filled = ordered.fill(joined, BRANCHES[3], ["entity_id"], [KEY], 0.5)
    fused = C.late_fusion(*[F.col(b) for b in BRANCHES])
    return filled.withColumn("fusion", fused).withColumn("predicted", (F.col("fusion") >= 0.5).cast("int"))


def metrics(scored: DataFrame, branches: list[str] | None = None) -> dict[str, dict]:
    """K9: counts, ratios and area under the curve of each branch and of the fusion."""
    out = {}
    for b in branches or [*BRANCHES, "fusion"]:
        m = core.binary_metrics(scored, "label", b).first().asDict()
        out[b] = m | {"roc_auc": core.roc_auc(scored, "label", b).first()["auc"]}
    return out


def train(events: DataFrame, schema: FeatureSchema, length: int = 50, stride: int = 10, trees: int = 120, rounds: int = 60, depth: int = 10) -> Bundle:
    """K1 to K9: a detector of all branches and its metrics on a quarter of the rows that it wasn't fitted on.

    The two linear branches stand for the neural ones, as the reference's do where no such
    library is there. Two labels are needed.
    """
    if not 1 <= stride <= length:
        raise ValueError("the stride is 1 to the length")
    rows, columns = training_frame(events, schema)
    if rows.select("label").distinct().count() < 2:
        raise ContractError("two labels are needed")
    fitted, held = split(rows)
    v = cut(_vectors(fitted, columns))
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED).fit(v)
    boosted = GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=4, stepSize=0.1, seed=SEED).fit(v)
    bundle = Bundle(forest, boosted, Linear.of(fitted, columns), Linear.of(_windows(fitted, columns, length, stride), columns), columns, schema, length, stride)
    bundle.metrics = metrics(cut(scores(bundle, held)))
    return bundle


def balanced(rows: DataFrame, above: int = BALANCED_ABOVE, most: int = PER_CLASS) -> DataFrame:
    """beyond `above` rows, equally many of each label, `most` at most, those of the least hash."""
    counts = [r["count"] for r in rows.groupBy("label").count().collect()]
    if sum(counts) <= above:
        return rows
    ranked = ordered.rank(rows.withColumn("__h", F.md5(F.concat_ws(":", F.lit("sample"), KEY))), ["label"], ["__h", KEY], "__r")
    return ranked.where(F.col("__r") <= min(most, *counts)).drop("__h", "__r")


def cross_validation(rows: DataFrame, columns: list[str], folds: int = FOLDS, trees: int = 80, rounds: int = 30) -> dict:
    """Metrics of each fold for the mean of forest and boosted trees; none if a label has fewer than two rows."""
    least = [r["count"] for r in rows.groupBy("label").count().collect()]
    if len(least) < 2 or min(least) < 2:
        return {"folds": [], "n_splits": 0, "notes": "a label has too few rows"}
    n = min(folds, *least)
    ranked = ordered.rank(balanced(rows).withColumn("__h", F.md5(F.concat_ws(":", F.lit(SEED), KEY))), ["label"], ["__h", KEY], "__r")
    v = cut(_vectors(ranked.withColumn("fold", (F.col("__r") - 1) % n), columns))
    out = []
    for k in range(n):
        fitted, held = v.where(F.col("fold") != k), v.where(F.col("fold") == k)
        p = F.lit(0.0)
        for number, model in enumerate((RandomForestClassifier(labelCol="label", numTrees=trees, seed=SEED), GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=4, stepSize=0.1, seed=SEED))):
            held = model.fit(fitted).transform(held).withColumn(f"p{number}", vector_to_array("probability").getItem(1)).drop("probability", "rawPrediction", "prediction")
            p = p + F.col(f"p{number}") / 2
        out.append({"fold": k + 1} | metrics(cut(held.withColumn("fusion", p)), ["fusion"])["fusion"])
    return {"folds": out, "n_splits": n, "notes": "the mean of forest and boosted trees"}


def predict(bundle: Bundle, records: DataFrame) -> DataFrame:
    """Scores of records with the required columns, in the order in which they are read; H10: the first five columns asked for."""
    require(records.columns, bundle.schema.required_columns)
    given = ordered.ordinal(records, KEY)
    for c, value in (("entity_id", "record"), ("event_ts", None), ("source_type", bundle.schema.source_type), ("label", None), ("attack_stage", None), ("mitre_tactic", None)):
        if c not in given.columns:
            given = given.withColumn(c, F.lit(value).cast("int" if c == "label" else "string"))
    rows, _ = _expanded(given, bundle.schema, bundle.columns)
    rows = cut(rows.withColumn("label", F.coalesce(F.col("label").cast("string").try_cast("int"), F.lit(0))))
    return scores(bundle, rows).select(F.col(KEY).alias("row_index"), "entity_id", *BRANCHES, "fusion", "predicted", F.array(*[F.lit(c) for c in bundle.schema.required_columns[:5]]).alias("top_features")).orderBy("row_index")


def write_detections(scored: DataFrame, path: str, job: str) -> None:
    """A row for each scored record, appended: job, row_index, entity_id, score, predicted and each branch's score."""
    scored.select(F.lit(job).alias("job"), "row_index", "entity_id", F.col("fusion").alias("score"), "predicted", *BRANCHES).write.mode("append").parquet(path)


def contributions(rows: DataFrame, weights: dict[str, float], key: str, k: int = 10) -> DataFrame:
    """Of each row the k greatest contributions (value times weight) of either sign, by their size, then the column's name.

    Columns: key, positive and negative (arrays of feature, contribution). All of it is within a row.
    """
    each = F.array(*[F.struct((-F.abs(F.col(f"`{c}`") * w)).alias("size"), F.lit(c).alias("feature"), (F.col(f"`{c}`") * w).alias("contribution")) for c, w in weights.items()])
    of = lambda keep: F.transform(F.slice(F.filter(F.array_sort(each), lambda x: keep(x["contribution"])), 1, k), lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution")))
    return rows.select(key, of(lambda c: c >= 0).alias("positive"), of(lambda c: c < 0).alias("negative"))


def explain(bundle: Bundle, records: DataFrame, k: int = 10) -> DataFrame:
    """Contributions of the forest's columns by importance for each record, with the schema's families and tactics."""
    require(records.columns, bundle.schema.required_columns)
    rows, _ = _expanded(ordered.ordinal(records, KEY), bundle.schema, bundle.columns)
    weights = dict(zip(bundle.columns, (float(x) for x in bundle.forest.featureImportances.toArray()), strict=True))
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    return contributions(rows, weights, KEY, k).withColumnRenamed(KEY, "row_index").withColumn("feature_families", texts(bundle.schema.feature_families)).withColumn("tactics", texts(sorted(set(bundle.schema.mitre_tactics.values()))))


def save(bundle: Bundle, path: str) -> None:
    """The models as Spark writes them, the rest as JSON."""
    bundle.forest.write().overwrite().save(f"{path}/forest")
    bundle.boosted.write().overwrite().save(f"{path}/boosted")
    rest = {"event": asdict(bundle.event), "sequence": asdict(bundle.sequence), "columns": bundle.columns, "schema": asdict(bundle.schema), "length": bundle.length, "stride": bundle.stride, "metrics": bundle.metrics}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(rest, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/rest")


def load(spark: SparkSession, path: str) -> Bundle:
    rest = json.loads(spark.read.text(f"{path}/rest").first()["value"])
    return Bundle(RandomForestClassificationModel.load(f"{path}/forest"), GBTClassificationModel.load(f"{path}/boosted"), Linear(**rest["event"]), Linear(**rest["sequence"]), rest["columns"], FeatureSchema(**rest["schema"]), rest["length"], rest["stride"], rest["metrics"])
