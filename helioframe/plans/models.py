"""Fitted models: named Spark ML parts, a description, and how they combine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.scalars import clamp_negative, hurdle_value
from helioframe.operators.columns import assemble
from helioframe.plans.prepare import GROUP_INDEX
from helioframe.plans.tree_tables import forest_rows
from helioframe.session import broadcast_if_small
from helioframe.sources.artifacts import finite, load_description, new_version, save_description

X, RAW, PROB, CLASS, SIZE = "_x", "_raw", "_prob", "_class", "_size"
WITH_GROUP = "_xg"


@dataclass
class FittedModel:
    """``parts`` holds ``classifier`` and/or ``regressor``.

    With a classifier the prediction is probability times clamped size (0 if no
    regressor could be fitted); with a regressor alone it is the clamped size.
    ``nominal`` is a feature that is read as one of ``codes`` categories. ``levels``
    (the group column and ``level``) is the dictionary of the groups that the model was
    fitted with and belongs to the model, so codes do not depend on the rows that are
    scored later: a group's category is its level modulo ``codes``, and a group that the
    dictionary does not hold has one extra category.
    """

    kind: str
    features: list[str]
    parts: dict[str, PipelineModel]
    threshold: float = 0.0
    nominal: str | None = None
    codes: int = 0
    metrics: dict[str, float] = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    levels: DataFrame | None = None

    def with_level(self, df: DataFrame) -> DataFrame:
        """``_level`` beside the input columns, null where the dictionary does not hold the group.

        Without a dictionary the level is the group index of the rows.
        """
        if self.levels is None:
            return df.withColumn("_level", F.col(self.nominal or GROUP_INDEX))
        group = next(c for c in self.levels.columns if c != "level")
        known = self.levels.select(F.col(group).alias("_group_id"), F.col("level").alias("_level"))
        return df.join(broadcast_if_small(known), F.col(group) == F.col("_group_id"), "left").drop("_group_id")

    def encode(self, df: DataFrame) -> DataFrame:
        """Feature vector beside the input columns."""
        if self.nominal is None:
            return assemble(df, self.features, X, "keep")
        return assemble_with_code(self.with_level(df), self.features, self.nominal, self.codes).drop("_level")

    def heads(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``probability``, ``logit`` and ``magnitude`` where they exist."""
        out = self.encode(df)
        drop = [X]
        if "classifier" in self.parts:
            out = self.parts["classifier"].transform(out)
            out = out.withColumn("probability", vector_to_array(PROB)[1])
            # A boosted margin m stands for the probability 1 / (1 + exp(-2 m)).
            out = out.withColumn("logit", vector_to_array(RAW)[1] * 2.0)
            drop += [RAW, PROB, CLASS]
        if "regressor" in self.parts:
            out = self.parts["regressor"].transform(out).withColumn(
                "magnitude", F.col(SIZE) * F.lit(float(self.info.get("size_scale", 1.0)))
            )
            drop.append(SIZE)
        return out.drop(*drop)

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Input columns plus the non-negative prediction."""
        out = self.heads(df)
        size = F.col("magnitude") if "regressor" in self.parts else None
        if "classifier" in self.parts:
            value = hurdle_value(F.col("probability"), size)
        else:
            value = clamp_negative(size)
        return out.withColumn(name, value).drop("probability", "logit", "magnitude")

    def save(self, path: str, spark: SparkSession, epoch: int = 0) -> str | None:
        """Write parts, levels, trees and description; a model without a finite MAE is not saved.

        Everything goes to a new folder below ``path``; the description, written last,
        names it. A save that is cut short leaves what was saved before.
        """
        if not finite(self.metrics.get("mae")):
            return None
        version = new_version()
        for name, part in self.parts.items():
            part.write().overwrite().save(f"{path}/{version}/{name}")
            if hasattr(part.stages[-1], "treeWeights"):
                forest_rows(spark, part.stages[-1]).write.parquet(f"{path}/{version}/{name}_trees")
        if self.levels is not None:
            self.levels.write.parquet(f"{path}/{version}/levels")
        save_description(
            spark,
            path,
            {
                "version": version,
                "kind": self.kind,
                "features": self.features,
                "parts": sorted(self.parts),
                "threshold": self.threshold,
                "nominal": self.nominal,
                "codes": self.codes,
                "levels": self.levels is not None,
                "metrics": self.metrics,
                "info": self.info,
                "epoch": epoch,
            },
        )
        return path


class TwoHeadModel(FittedModel):
    """Hurdle model whose heads also see a one-hot group index."""

    def encode(self, df: DataFrame) -> DataFrame:
        coded = assemble(self.with_level(df), self.features, X, "keep")
        return coded.withColumn("_group", group_code("_level", self.codes, "_group")).drop("_level")

    def heads(self, df: DataFrame) -> DataFrame:
        out = self.encode(df)
        for name, made in (("classifier", [RAW, PROB, CLASS]), ("regressor", [SIZE])):
            if name not in self.parts:
                continue
            out = self.parts[name].transform(out)
            if name == "classifier":
                out = out.withColumn("logit", vector_to_array(RAW)[1])
                out = out.withColumn("probability", vector_to_array(PROB)[1])
            else:
                out = out.withColumn("magnitude", F.col(SIZE))
            out = out.drop(*made, "_onehot", WITH_GROUP)
        return out.drop(X, "_group")


def load_model(spark: SparkSession, path: str, need_classifier: bool = False) -> FittedModel:
    """Read a saved model; a missing folder or missing classifier is an error."""
    d = load_description(spark, path)
    if need_classifier and "classifier" not in d["parts"]:
        raise ValueError(f"saved model {path} has no classifier")
    make = TwoHeadModel if d["kind"] == "two_head" else FittedModel
    folder = f"{path}/{d['version']}"
    return make(
        kind=d["kind"],
        features=d["features"],
        parts={name: PipelineModel.load(f"{folder}/{name}") for name in d["parts"]},
        threshold=d["threshold"],
        nominal=d["nominal"],
        codes=d["codes"],
        metrics=d["metrics"],
        info=d["info"],
        levels=spark.read.parquet(f"{folder}/levels") if d["levels"] else None,
    )


def saved_trees(spark: SparkSession, path: str, part: str) -> DataFrame:
    """Node rows of a part of a saved model (see ``tree_tables``)."""
    return spark.read.parquet(f"{path}/{load_description(spark, path)['version']}/{part}_trees")


def group_levels(vocabulary: DataFrame, group: str) -> DataFrame:
    """A model's dictionary from the vocabulary of the rows that it is fitted with."""
    return vocabulary.select(group, F.col(GROUP_INDEX).alias("level"))


def group_code(level: str, codes: int, name: str) -> Column:
    """The level modulo ``codes``; a missing one has the extra code after those."""
    meta = {"ml_attr": {"type": "nominal", "name": name, "num_vals": codes + 1}}
    code = F.coalesce(F.pmod(F.col(level), F.lit(codes)).cast("double"), F.lit(float(codes)))
    return code.alias(name, metadata=meta)


def assemble_with_code(df: DataFrame, features: list[str], nominal: str, codes: int) -> DataFrame:
    """Feature vector whose ``nominal`` entry is the category code of ``_level``."""
    coded = df.withColumn("_code", group_code("_level", codes, "_code"))
    cols = ["_code" if c == nominal else c for c in features]
    return assemble(coded, cols, X, "keep").drop("_code")
