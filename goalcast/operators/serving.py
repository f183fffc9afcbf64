"""Request-time scoring helpers: CR step function (H3), confusion-rate scoring (H4),
agent fan-out (H5), best agent per request (H6), scoring by feature name (H2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalcast.operators import bayes as B
from goalcast.operators.features import repeats
from goalcast.plans.indexing import broadcast_rows, lookup_join


def cr_step(prob: Column, thresholds: list[float] | None, crs: list[float] | None) -> Column:
    """H3: thresholds in descending order; the first t with p >= t gives its rate; below
    all thresholds the last rate (one more rate than thresholds). No thresholds ->
    identity. The step table is a handful of model constants, folded into one
    ``CASE`` (no join)."""
    if not thresholds or crs is None:
        return prob
    expr = F.lit(float(crs[len(thresholds)]))
    for t, cr in reversed(list(zip(thresholds, crs))):
        expr = F.when(prob >= F.lit(float(t)), F.lit(float(cr))).otherwise(expr)
    return expr


def cr_step_table(df: DataFrame, prob_col: str, steps: DataFrame) -> DataFrame:
    """H3 as a range join with a step table (ord, lower, upper, cr) for step tables
    read from files; the table has one row per threshold (broadcast)."""
    s = F.broadcast(steps)
    cond = (F.col(prob_col) >= s.lower) & (F.col(prob_col) < s.upper)
    return df.join(s, cond, "left").drop("ord", "lower", "upper")


def confusion_score(pred: Column, true_positive: Column, false_negative: Column) -> Column:
    """H4: predicted class 1 -> the test ``true_positive`` rate, else ``false_negative``."""
    return F.when(pred == 1, true_positive).otherwise(false_negative)


def agent_groups(props: Column, width: int) -> Column:
    """H5: a flat agent-property list cut into equal groups of ``width``; width 0 -> one
    agent with the whole list. Each group starts at (agent number x width)."""
    if width <= 0:
        return F.array(props)
    n = F.floor(F.size(props) / F.lit(width)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(props, k * width + 1, width))


def fan_out(requests: DataFrame, key: str, agent_props: str, request_props: str, width: int) -> DataFrame:
    """(key, agent, props): one row per agent; props = request props + agent group."""
    g = requests.select(key, request_props, F.posexplode(agent_groups(F.col(agent_props), width)).alias("agent", "_ap"))
    return g.select(key, "agent", F.concat(F.col(request_props), F.col("_ap")).alias("props"))


def best_agent(scored: DataFrame, key: str, agent: str = "agent", score: str = "prediction",
               extra: list[str] | None = None) -> DataFrame:
    """H6: arg max of the prediction per request, first agent on ties."""
    cols = [agent, score, *(extra or [])]
    best = F.min_by(F.struct(*cols), F.struct((-F.col(score)).alias("_n"), F.col(agent).alias("_a")))
    return scored.groupBy(key).agg(best.alias("_b")).select(key, *[F.col(f"_b.{c}").alias(c) for c in cols])


def names_to_indices(rows: DataFrame, key: str | list[str], names_col: str, dictionary: DataFrame, n_dict: int,
                     freq_col: str | None = None, total_rows: int | None = None) -> DataFrame:
    """P7 + H2: feature names -> sorted distinct known indices ``features`` and their names
    ``known`` in the same order (unknown names dropped, rows without a known name kept with
    empty arrays). A dictionary within the broadcast bound is looked up row by row in the tasks.
    With ``freq_col`` (how often a name occurs) a dictionary beyond it is joined with its frequent
    names split off. Rows of one key are folded into one."""
    keys = [key] if isinstance(key, str) else key
    table = dictionary.select("name", F.col("idx").cast("int").alias("idx"))
    if n_dict <= broadcast_rows(table) and not repeats(rows, keys):
        table = table.where(F.col("name").isNotNull() & F.col("idx").isNotNull()).toArrow().combine_chunks()
        if len(table["name"].unique()) == len(table):          # a name with several indices takes the join
            return _lookup_in_place(rows.select(*keys, F.col(names_col).alias("_names")), keys, table)
    ex = rows.select(*keys, F.explode_outer(names_col).alias("name"))
    d = dictionary.select("name", "idx", *([freq_col] if freq_col else []))
    j = lookup_join(ex, d, ["name"], n_dict, freq_col, total_rows, "left")
    pairs = F.array_sort(F.collect_set(F.when(F.col("idx").isNotNull(), F.struct("idx", "name"))))
    return (j.groupBy(*keys).agg(pairs.alias("_p"))
            .select(*keys, F.transform("_p", lambda p: p["idx"]).alias("features"),
                    F.transform("_p", lambda p: p["name"]).alias("known")))


def _lookup_in_place(rows: DataFrame, keys: list[str], table: pa.Table) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, idx = sent.value["name"].combine_chunks(), sent.value["idx"].to_numpy()
        for batch in batches:
            names = batch.column("_names")
            size = np.nan_to_num(pc.list_value_length(names).to_numpy(zero_copy_only=False)).astype(np.int64)
            at = pc.index_in(names.flatten(), value_set=name)  # null lists are left out
            row = np.repeat(np.arange(len(size)), size)[at.is_valid().to_numpy(zero_copy_only=False)]
            at = at.drop_null().to_numpy()
            order = np.lexsort((idx[at], row))
            row, at = row[order], at[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
            row, at = row[new], at[new]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(idx[at], pa.int32()), name.take(pa.array(at)))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], *lists], names=[*keys, "features", "known"])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keys)
    return rows.mapInArrow(run, f"{kept}, features array<int>, known array<string>")


def indices_to_names(rows: DataFrame, key: str, dictionary: DataFrame, n_dict: int) -> DataFrame:
    """(key, names): the names of each row's ``features`` (indices outside the dictionary left out)."""
    table = dictionary.select("idx", "name")
    if n_dict > broadcast_rows(table):
        ex = rows.select(key, F.explode_outer("features").alias("idx")).join(table, "idx", "left")
        return ex.groupBy(key).agg(F.collect_list("name").alias("names"))
    sent = rows.sparkSession.sparkContext.broadcast(table.toArrow().combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, name = sent.value["idx"].combine_chunks(), sent.value["name"].combine_chunks()
        for batch in batches:
            features = batch.column("features")
            size = np.nan_to_num(pc.list_value_length(features).to_numpy(zero_copy_only=False)).astype(np.int64)
            at = pc.index_in(features.flatten(), value_set=idx)
            row = np.repeat(np.arange(len(size)), size)[at.is_valid().to_numpy(zero_copy_only=False)]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(ends, name.take(at.drop_null()))], names=[key, "names"])
    rows = rows.select(key, "features")
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, names array<string>")


def used_combinations(features: Column, names_by_idx: Column) -> Column:
    """Names ``a&b`` of every key (i <= j) of the row; ``names_by_idx`` is an
    array<string> column aligned with ``features``."""
    pairs = B.key_array(F.sequence(F.lit(0), F.size(features) - 1), True)
    return F.when(F.size(features) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(pairs, lambda p: F.concat(F.element_at(names_by_idx, p["i"] + 1), F.lit("&"),
                                              F.element_at(names_by_idx, p["j"] + 1))))
