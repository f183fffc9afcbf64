"""Scoring bid requests with a model loaded from its folder (H5 -> F10 -> P7 -> H1 -> H3 -> H6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.operators import bayes as B
from goalcast.operators import requests as RQ
from goalcast.operators import serving as SV
from goalcast.sources.readers import read_bayes_model


def agent_features(spec: list[dict], agent: F.Column) -> F.Column:
    """``name + value`` of every field that an agent's JSON object has."""
    return F.array_compact(F.array(*[F.concat(F.lit(e["name"]), F.get_json_object(agent, f"$.{e['field']}")) for e in spec]))


@dataclass
class LoadedModel:
    """A Bayes model folder as scoring takes it."""

    counts: B.BayesCounts
    names: DataFrame
    n_names: int


def load_model(spark, model_path: str, goal: str) -> LoadedModel:
    model = read_bayes_model(spark, model_path)
    if model is None:
        raise ValueError(f"no model in {model_path}")
    return LoadedModel(B.counts_from_model(model, goal), model["index"], model["index"].count())


def score_requests(requests: DataFrame, model: str | LoadedModel, goal: str, key: str, json_col: str, ts_col: str,
                   agents_col: str | None, request_spec: list[dict], agent_spec: list[dict],
                   thresholds: list[float] | None, rates: list[float] | None) -> DataFrame:
    """``(key, agent, prob, cr)``: the best agent of each request (first on ties). ``model`` is a
    loaded model or the folder to load it from. Without agents a request is one agent, number 0."""
    model = load_model(requests.sparkSession, model, goal) if isinstance(model, str) else model
    parsed = RQ.parse_requests(requests, json_col, request_spec)
    own = RQ.request_feature_array(request_spec, F.col("_req"), F.col(ts_col)).alias("_own")
    if agents_col is None:
        rows = parsed.select(key, F.lit(0).alias("agent"), own).withColumnRenamed("_own", "names")
    else:
        rows = (parsed.select(key, own, F.posexplode_outer(agents_col).alias("agent", "_agent"))
                .select(key, F.coalesce("agent", F.lit(0)).alias("agent"),
                        F.concat("_own", agent_features(agent_spec, F.col("_agent"))).alias("names")))
    idx = SV.names_to_indices(rows, [key, "agent"], "names", model.names, model.n_names)
    spec = B.ModelSpec("m", "model", goal, 1)                  # the folder holds only keys over the threshold
    scored = B.score_models(idx, model.counts, [spec], [key, "agent"]).scores
    scored = scored.withColumn("cr", SV.cr_step(F.col("prob"), thresholds, rates))
    return SV.best_agent(scored, key, "agent", "cr", ["prob"]).select(key, "agent", "prob", "cr")
