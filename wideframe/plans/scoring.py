"""Batch scoring with frozen training statistics.

``fit_scoring_plan`` runs the statistics passes once on the training table and
freezes the numbers (family medians, sleep median) together with the
predictors; ``score`` applies them to any batch as projections only — a new
upload is never re-profiled. Each target may have its own preparation: feature
set, interactions, trained column list and scaler (``TargetModel``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import families as FAM
from ..functions import features as FE
from ..functions.sqltext import lit, plus, q
from ..operators.impute import FillModel, MedianImputer
from ..operators.models import SeedEnsemble, fit_linear
from ..operators.quantile import medians
from ..operators.scale import QuantileNormalizer, RobustScaler
from ..sources.schema import align_to
from .prepare import coerce_families, guard_ranges, materialize, null_skips


@dataclass
class TargetModel:
    """One target's own preparation and linear predictor: feature set (1, 2 or
    3), products ``a_X_b``, the trained column list, scaler, coefficients."""
    target: str
    feature_set: int
    columns: list
    interactions: list = field(default_factory=list)
    scaler: object = None
    intercept: float = 0.0
    coefs: dict = field(default_factory=dict)
    quantiles: int = 1000    # of a quantile scaler

    def prepared(self, df: DataFrame, sleep_median: float | None, keep=()) -> DataFrame:
        """The trained columns of a cleaned table: features, products, missing
        columns as 0, extras dropped, scaled."""
        if self.feature_set == 1:
            df = FE.target1_features(df, sleep_median)
        elif self.feature_set == 2:
            df = FE.target2_features(df)
        else:
            df = FE.target3_features(df)
        have = [n for n in self.interactions if all(p in df.columns for p in n.split("_X_"))]
        df = align_to(FE.add_interactions(df, have), self.columns, keep=keep)
        return self.scaler.transform(df) if self.scaler else df

    def predict(self, df: DataFrame, sleep_median: float | None, out: str) -> DataFrame:
        """``df`` with the prediction; its other columns stay as they are."""
        packed = df.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        value = plus([lit(float(self.intercept))] + [f"{lit(float(w))} * {q(c)}" for c, w in self.coefs.items()])
        return self.prepared(packed, sleep_median, keep=["__row"]).select("__row.*", F.expr(value).alias(out))


@dataclass
class ScoringPlan:
    fill: FillModel
    sleep_median: float | None
    linear: dict = field(default_factory=dict)      # target -> (intercept, {feature: coef}) over the target-1 features
    ensemble_scale: tuple = (1.0,)
    pipelines: dict = field(default_factory=dict)   # target -> fitted PipelineModel / SeedEnsemble
    numeric_columns: list = field(default_factory=list)  # frozen from the training schema
    targets: dict = field(default_factory=dict)     # target -> TargetModel

    def clean(self, df: DataFrame) -> DataFrame:
        # uploads arrive as text: coerce every column that was numeric in training
        num = [c for c in self.numeric_columns if c in df.columns]
        df = C.coerce_columns(df, num)
        df = coerce_families(df)
        df = guard_ranges(df)
        df = null_skips(df, FAM.all_family_columns(df.columns))
        return self.fill.transform(df)

    def features(self, df: DataFrame) -> DataFrame:
        return FE.target1_features(self.clean(df), self.sleep_median)


def fit_scoring_plan(train: DataFrame, linear: dict | None = None, ensemble_scale=(1.0,),
                     pipelines: dict | None = None, targets=()) -> ScoringPlan:
    """``targets`` are unfitted ``TargetModel``s: their scaler and predictor
    are fitted on the cleaned training rows where the target is present."""
    df = guard_ranges(coerce_families(train))
    fam = FAM.all_family_columns(df.columns)
    df = materialize(null_skips(df, fam))
    extra = [c for c in ("QtdHorasDormi",) if c in df.columns and c not in fam]
    values = medians(df, fam + extra)
    fill = FillModel({c: values[c] for c in fam})
    sleep = values[extra[0]] if extra else None
    numeric = FAM.numeric_columns(train, exclude=FAM.TARGET_COLUMNS + ("player_id", FAM.ID_COLUMN))
    plan = ScoringPlan(fill, sleep, linear or {}, tuple(ensemble_scale), pipelines or {}, numeric)
    cleaned = fill.transform(df)
    for t in targets:
        plan.targets[t.target] = fit_target(cleaned, t, sleep)
    df.unpersist()
    return plan


def fit_target(cleaned: DataFrame, model: TargetModel, sleep_median: float | None, scaler: str = "") -> TargetModel:
    """Fit the scaler (robust for targets 1 and 3, quantile-normal for target
    2 unless named) and least squares in the target's own prepared space."""
    rows = cleaned.filter(F.col(model.target).isNotNull()).withColumn("__y", F.col(model.target).cast("double"))
    raw = materialize(model.prepared(rows, sleep_median, keep=["__y"]))
    kind = scaler or ("quantile" if model.feature_set == 2 else "robust")
    fitted = QuantileNormalizer(model.columns, n_quantiles=model.quantiles).fit(raw) if kind == "quantile" else RobustScaler(model.columns).fit(raw)
    lm = fit_linear(fitted.transform(raw), model.columns, "__y")
    raw.unpersist()
    return TargetModel(model.target, model.feature_set, list(model.columns), list(model.interactions), fitted,
                       float(lm.intercept), {c: float(w) for c, w in zip(model.columns, lm.coefficients)}, model.quantiles)


def score(df: DataFrame, plan: ScoringPlan, id_col: str) -> DataFrame:
    """Output records: id as string and one prediction per target, named after
    the target and rounded half-even; NULL for a target without a model."""
    cleaned = plan.clean(df)
    preds = {}
    for i, (t, m) in enumerate(plan.targets.items()):
        preds[t] = f"__own{i}"
        cleaned = m.predict(cleaned, plan.sleep_median, preds[t])
    out = FE.target1_features(cleaned, plan.sleep_median) if plan.linear or plan.pipelines else cleaned
    for i, (t, (b, coefs)) in enumerate(plan.linear.items()):
        members = [plus([lit(float(b * s))] + [f"{lit(float(w * s))} * {q(c)}" for c, w in coefs.items()])
                   for s in plan.ensemble_scale]
        preds[t] = f"__lin{i}"
        out = out.withColumn(preds[t], F.expr(f"({' + '.join(f'({m})' for m in members)}) / {len(members)}"))
    for i, (t, m) in enumerate(plan.pipelines.items()):
        preds[t] = f"__pm{i}"
        if isinstance(m, SeedEnsemble):
            out = m.transform(out, preds[t])
        else:
            out = m.transform(out).withColumnRenamed("prediction", preds[t]).drop("__features")
    cols = [C.id_string(id_col).alias("Código de Acesso")]
    for i, t in enumerate(FAM.TARGET_COLUMNS[:3]):
        value = C.round_half_even(preds[t], 2) if t in preds else F.lit(None).cast("double")
        cols.append(value.alias(f"Previsão T{i + 1}"))
    return out.select(*cols)
