"""A folder of saved models that keeps the best ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.operators.runs import best_runs
from helioframe.plans.models import FittedModel, load_model
from helioframe.sources.artifacts import add_entry, delete_folder, entries, finite, new_version


@dataclass(frozen=True)
class ModelStore:
    """The ``keep`` models of least MAE below ``root``, the earlier one of equal ones.

    A model is written to a folder of its own and then published by one line of the
    manifest; what is not in the manifest does not exist for readers. Models that fall
    out of the best are first struck from the manifest, then deleted.
    """

    spark: SparkSession
    root: str
    keep: int = 3

    def save(self, model: FittedModel, epoch: int) -> str | None:
        """Path of the saved model, or None without a finite MAE or when it is not among the best."""
        mae = model.metrics.get("mae")
        if not finite(mae):
            return None
        version = new_version()
        model.save(f"{self.root}/{version}", self.spark, epoch)
        add_entry(self.spark, self.root, version, epoch, float(mae))
        self.prune()
        kept = self.ranked().where(F.col("version") == version)
        return None if kept.isEmpty() else f"{self.root}/{version}"

    def ranked(self) -> DataFrame:
        """``place``, ``epoch``, ``mae`` and ``version`` of the published models, best first."""
        listed = entries(self.spark, self.root).withColumn("run", F.lit(0))
        total = listed.count()
        best = best_runs(listed, "run", "serial", "mae", max(1, total)).select("serial", "place")
        return listed.join(best, "serial").select("place", "epoch", "mae", "version").orderBy("place")

    def prune(self) -> None:
        for r in self.ranked().where(F.col("place") > max(1, self.keep)).collect():  # one row a published model
            add_entry(self.spark, self.root, r["version"], r["epoch"], r["mae"], removed=True)
            delete_folder(self.spark, f"{self.root}/{r['version']}")

    def best(self, need_classifier: bool = False) -> FittedModel:
        """The model of least MAE."""
        first = self.ranked().first()
        if first is None:
            raise FileNotFoundError(f"no saved model at {self.root}")
        return load_model(self.spark, f"{self.root}/{first['version']}", need_classifier)
