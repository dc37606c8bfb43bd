"""Saved state (S7): every fitted object as one JSON text in a folder.

Numbers keep their exact binary value (JSON writes the shortest text that
reads back equal). Fitted MLlib pipelines inside an object are written beside
the text by their own writer.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.cluster import ClusterModel
from ..operators.encode import OneHotModel
from ..operators.impute import FillModel, OutlierModel
from ..operators.models import SeedEnsemble
from ..operators.scale import AffineModel, QuantileNormalModel
from .scoring import ScoringPlan, TargetModel

KINDS = {k.__name__: k for k in (FillModel, OutlierModel, OneHotModel, AffineModel, QuantileNormalModel, ClusterModel,
                                 SeedEnsemble, TargetModel, ScoringPlan)}


def save_state(spark: SparkSession, obj, path: str) -> None:
    pipelines = []

    def plain(x):
        if isinstance(x, PipelineModel):
            pipelines.append(x)
            return {"pipeline": len(pipelines) - 1}
        if dataclasses.is_dataclass(x):
            return {"kind": type(x).__name__, "fields": {f.name: plain(getattr(x, f.name)) for f in dataclasses.fields(x)}}
        if isinstance(x, dict):
            return {"items": [[plain(k), plain(v)] for k, v in x.items()]}
        if isinstance(x, tuple):
            return {"tuple": [plain(v) for v in x]}
        return [plain(v) for v in x] if isinstance(x, list) else x

    text = json.dumps(plain(obj), ensure_ascii=False)
    for i, p in enumerate(pipelines):
        p.write().overwrite().save(f"{path.rstrip('/')}/pipeline-{i}")
    spark.createDataFrame([(text,)], "state string").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/state")


def load_state(spark: SparkSession, path: str):
    def built(x):
        if isinstance(x, list):
            return [built(v) for v in x]
        if not isinstance(x, dict):
            return x
        if "pipeline" in x:
            return PipelineModel.load(f"{path.rstrip('/')}/pipeline-{x['pipeline']}")
        if "kind" in x:
            return KINDS[x["kind"]](**{k: built(v) for k, v in x["fields"].items()})
        return tuple(map(built, x["tuple"])) if "tuple" in x else {built(k): built(v) for k, v in x["items"]}

    return built(json.loads(spark.read.parquet(f"{path.rstrip('/')}/state").first()["state"]))
