"""Parameters of a training or scoring run."""

from __future__ import annotations

from dataclasses import dataclass, replace

MODELS = ("feedforward", "two_head", "hist_gbdt", "lightgbm")
TREE_MODELS = ("hist_gbdt", "lightgbm")


@dataclass(frozen=True)
class BoostParams:
    """Settings shared by the boosted classifier and regressor."""

    rounds: int
    step_size: float
    max_depth: int
    min_leaf_rows: int
    row_fraction: float
    feature_fraction: float
    max_bins: int
    patience: int
    loss: str = "absolute"


# The defaults below are fixed values: the documented settings of a run.
@dataclass(frozen=True)
class RunParams:
    # columns
    target: str = "nins"
    group: str = "pv_id"
    time: str = "time"
    tie_break: tuple[str, ...] = ()
    type_col: str = "type"
    # data and splits
    model: str = "feedforward"
    val_ratio: float = 0.2
    seed: int = 42
    scale_features: bool = True
    fill_before_filter: bool = False
    means_from_train: bool = False
    time_zone: str | None = None
    # Codes for the group index as a category, whatever the number of groups: groups
    # share a code when their indexes are equal modulo this width.
    group_codes: int = 254
    # two-head loss
    positive_threshold: float = 0.0
    label_smoothing: float = 0.0
    # training runs
    max_epochs: int = 50
    weight_decay: float = 1e-4
    # plain tree knobs (hist_gbdt)
    tree_rounds: int = 800
    tree_step_size: float = 0.05
    tree_max_depth: int | None = None
    tree_row_fraction: float = 1.0
    tree_min_leaf_rows: int = 20
    tree_max_bins: int = 255
    # leaf-wise knobs (lightgbm)
    boost_rounds: int = 800
    boost_step_size: float = 0.05
    boost_leaves: int = 128
    boost_feature_fraction: float = 0.8
    boost_row_fraction: float = 0.7
    boost_min_leaf_rows: int = 80
    boost_max_depth: int = -1
    boost_sample_fraction: float = 0.4
    boost_patience: int = 50
    boost_loss: str = "absolute"
    # scoring only
    inference_only: bool = False
    model_paths: tuple[str, ...] = ()

    @property
    def is_tree(self) -> bool:
        return self.model in TREE_MODELS

    def checked(self) -> RunParams:
        """Validated copy; scaling is switched off for trees."""
        if self.model not in MODELS:
            raise ValueError(f"unknown model {self.model!r}; expected one of {MODELS}")
        if self.inference_only:
            if self.model != "lightgbm":
                raise ValueError("inference_only is supported for the lightgbm model only")
            if not self.model_paths:
                raise ValueError("inference_only needs at least one saved model")
        return replace(self, scale_features=False) if self.is_tree else self

    def boosting(self) -> BoostParams:
        """Knobs of the selected boosted variant in Spark ML terms.

        Spark trees grow by level: a leaf budget L becomes depth log2(L). Depth
        is limited to 30 by Spark ML; an unlimited tree is bounded by its leaf
        budget, or for the plain variant by 31 leaves (depth 5).
        """
        if self.model == "hist_gbdt":
            return BoostParams(
                rounds=self.tree_rounds,
                step_size=self.tree_step_size,
                max_depth=5 if self.tree_max_depth is None else min(self.tree_max_depth, 30),
                min_leaf_rows=self.tree_min_leaf_rows,
                row_fraction=self.tree_row_fraction,
                feature_fraction=1.0,
                max_bins=self.tree_max_bins,
                patience=self.boost_patience,
                loss=self.boost_loss,
            )
        by_leaves = max(1, (max(2, self.boost_leaves) - 1).bit_length())
        depth = by_leaves if self.boost_max_depth <= 0 else min(by_leaves, self.boost_max_depth)
        return BoostParams(
            rounds=self.boost_rounds,
            step_size=self.boost_step_size,
            max_depth=min(depth, 30),
            min_leaf_rows=self.boost_min_leaf_rows,
            row_fraction=self.boost_row_fraction,
            feature_fraction=self.boost_feature_fraction,
            max_bins=255,
            patience=self.boost_patience,
            loss=self.boost_loss,
        )
