"""One-hot feature construction: level counts, rarity merge, dictionary, row encoding.

F4 attribute one-hot, F5 list one-hot, F6 concatenation, F7 location patch,
F8 constant feature, P5 constant-column drop, P6 ``OTHER`` drop.

Data flow (two passes over the rows, whatever the number of columns):

1. ``feature_cells``: one narrow ``explode`` of every (column, value) of a row.
2. ``level_counts``: ``groupBy(grp, col, value).count()`` with map-side partial
   aggregation; the result has one row per distinct level (small).
3. ``build_dictionary``: rarity merge, constant-column and ``OTHER`` drop, name
   building, location patch and a dense index, all on the small level table.
4. ``encode_columns``: one broadcast join per column gives each row its indices in place;
   a list value is encoded once per distinct value. No row is exploded. Rows whose key
   occurs more than once are folded into one.
5. ``encode_rows``, for a dictionary beyond the broadcast bound: cells joined to the
   dictionary by a shuffle join (frequent levels split off) and folded back per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalcast.constants import DUMMY_FEATURE, LOCATION_FAMILIES_OBSERVED, OTHER
from goalcast.plans.indexing import broadcast_rows, dense_index, lookup_join, maybe_broadcast
from goalcast.session import cut_lineage, cut_lineage_observed


def list_tokens(c) -> Column:
    """Tokens of a dot-separated list value; null -> ['OTHER']; repeated tokens once."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_distinct(F.split(F.coalesce(col.cast("string"), F.lit(OTHER)), "[.]", -1))


def feature_cells(df: DataFrame, attribute_cols: list[str], list_cols: list[str],
                  carry: list[str]) -> DataFrame:
    """(carry..., grp, col, value): one row per attribute value and per distinct list token.

    ``grp`` is 0 for attribute columns and 1 + position for list columns.
    """
    parts = []
    if attribute_cols:
        parts.append(F.array(*[
            F.struct(F.lit(0).alias("grp"), F.lit(c).alias("col"),
                     F.coalesce(F.col(c).cast("string"), F.lit(OTHER)).alias("value"))
            for c in attribute_cols]))
    def token_cell(grp: int, name: str):
        return lambda t: F.struct(F.lit(grp).alias("grp"), F.lit(name).alias("col"), t.alias("value"))
    for j, c in enumerate(list_cols):
        parts.append(F.transform(list_tokens(c), token_cell(j + 1, c)))
    cells = parts[0] if len(parts) == 1 else F.flatten(F.array(*parts))
    return df.select(*carry, F.explode(cells).alias("_cell")).select(*carry, "_cell.*")


def level_counts(cells: DataFrame) -> DataFrame:
    """(grp, col, value, n): rows per level (list tokens count once per row)."""
    return cells.groupBy("grp", "col", "value").agg(F.count(F.lit(1)).cast("long").alias("n"))


def rare_levels(levels: DataFrame, threshold: int) -> DataFrame:
    """F4 rarity merge on attribute levels: (col, value, n, merged, column_kept)."""
    a = levels.where(F.col("grp") == 0)
    merged = F.when(F.col("n") < threshold, F.lit(OTHER)).otherwise(F.col("value"))
    a = a.withColumn("merged", merged)
    kept = (a.groupBy("col").agg(F.count_distinct("merged").alias("_levels"))
            .select("col", (F.col("_levels") > 1).alias("column_kept")))
    return a.join(F.broadcast(kept), "col").select("col", "value", "n", "merged", "column_kept")


def rename_families(name: Column, families: list[str]) -> Column:
    out = name
    for fam in families:
        out = F.replace(out, F.lit(fam), F.lit("location"))
    return out


@dataclass
class FeatureDictionary:
    """``names``: (idx, name) final dictionary; ``entries``: (grp, col, value, idx) lookup;
    ``n_entries`` is an upper bound of the lookup size (the level count)."""
    names: DataFrame
    entries: DataFrame
    size: int
    n_entries: int
    n_rows: int = 0


def dictionary_slots(levels: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Candidate features before the location patch.

    Returns ``entries`` (grp, col, value, name) and ``slots`` (grp, name): attribute
    names are one vectorizer, so equal names from different attribute columns merge
    into one slot; list names are one slot per (list column, name).
    """
    a = rare_levels(levels, threshold)
    a_entries = (a.where(F.col("column_kept") & (F.col("n") >= threshold))
                 .select(F.lit(0).alias("grp"), "col", "value",
                         F.concat("col", "value").alias("name"), "n"))
    l_entries = (levels.where((F.col("grp") > 0) & (F.col("n") >= threshold))
                 .select("grp", "col", "value", F.concat("col", "value").alias("name"), "n"))
    entries = a_entries.unionByName(l_entries).where(~F.col("name").endswith(OTHER))
    slots = entries.select("grp", "name").distinct()
    return entries, slots


def build_dictionary(levels: DataFrame, threshold: int,
                     families: list[str] | None = None,
                     constant_feature: bool = False, level_stats: dict | None = None) -> FeatureDictionary:
    """F4-F7 (+F8): final (idx, name) and the (col, value) -> idx lookup."""
    fams = LOCATION_FAMILIES_OBSERVED if families is None else families
    entries, slots = dictionary_slots(levels, threshold)
    slots = slots.withColumn("final_name", rename_families(F.col("name"), fams))
    dup = F.count(F.lit(1)).over(Window.partitionBy("final_name"))
    slots = slots.withColumn("_dup", dup).where(F.col("_dup") == 1).drop("_dup")
    # the level table bounds both the feature count and the lookup size
    if level_stats is None:
        level_stats = levels.agg(F.count(F.lit(1)).alias("n_levels"),
                                 F.sum(F.when(F.col("grp") == 0, F.col("n"))).alias("n_cells")).collect()[0].asDict()
    n_levels = int(level_stats["n_levels"])
    indexed = dense_index(slots, [F.col("grp"), F.col("name")])
    indexed, istats = cut_lineage_observed(indexed, "dictionary", {"size": F.count(F.lit(1))})
    size = int(istats["size"])
    lookup = entries.join(maybe_broadcast(indexed.select("grp", "name", "idx"), n_levels), ["grp", "name"]) \
                    .select("grp", "col", "value", "idx", "n")
    # both inputs are written tables; the lookup is small and read once by the encoder
    names = indexed.select("idx", F.col("final_name").alias("name"))
    if constant_feature:
        spark = levels.sparkSession
        names = names.unionByName(spark.createDataFrame([(size, DUMMY_FEATURE)], "idx int, name string"))
    # rows of the input: every row has one cell per attribute column
    n_attr = max(1, int(level_stats.get("n_attr_cols") or 1))
    n_rows = int(level_stats.get("n_cells") or 0) // n_attr
    return FeatureDictionary(names=names, entries=lookup, size=size, n_entries=n_levels, n_rows=n_rows)


def encode_rows(cells: DataFrame, dictionary: FeatureDictionary, carry: list[str],
                constant_feature: bool = False, row_key: str = "row_id") -> DataFrame:
    """(carry..., features array<int>) with sorted distinct indices; every row is kept
    (a row whose values are all rare gets an empty array).

    Grouped by ``row_key`` alone (other carried columns are constant per row), so the
    output is hash-partitioned by the row key and later groupings that contain it
    need no further exchange."""
    joined = lookup_join(cells, dictionary.entries, ["grp", "col", "value"], dictionary.n_entries,
                         "n", dictionary.n_rows, "left")
    feats = F.array_sort(F.collect_set("idx"))
    others = [F.first(c).alias(c) for c in carry if c != row_key]
    out = joined.groupBy(row_key).agg(*others, feats.alias("features")).select(*carry, "features")
    if constant_feature:
        out = out.withColumn("features", F.array_append("features", F.lit(dictionary.size)))
    return out


#: Index of a value outside the dictionary while a row is encoded.
NO_INDEX = -1


def list_indices(df: DataFrame, list_col: str, grp: int, entries: DataFrame) -> tuple[DataFrame, int]:
    """(_list, _n, _ids) of every distinct non-null value of a list column: its rows and the
    indices of its tokens; and the number of values."""
    lists = df.select(F.col(list_col).cast("string").alias("_list")).where(F.col("_list").isNotNull()) \
        .groupBy("_list").agg(F.count(F.lit(1)).alias("_n"))
    own = entries.where(F.col("grp") == grp).select(F.col("value").alias("_token"), "idx")
    tokens = lists.select("_list", "_n", F.explode(list_tokens("_list")).alias("_token"))
    ids = tokens.join(F.broadcast(own), "_token").groupBy("_list", "_n").agg(F.collect_set("idx").alias("_ids"))
    table, stats = cut_lineage_observed(ids, "list-indices", {"n": F.count(F.lit(1))})
    return table, int(stats["n"])


def encode_columns(df: DataFrame, attribute_cols: list[str], list_cols: list[str], dictionary: FeatureDictionary,
                   carry: list[str], constant_feature: bool = False, row_key: str = "row_id") -> DataFrame:
    """``encode_rows`` without cells, for a dictionary within the broadcast bound: each attribute
    column is joined to its own levels, each list column to its distinct values."""
    def ints(c):
        return F.coalesce(c, F.lit(NO_INDEX))
    entries = cut_lineage(dictionary.entries, "lookup")         # read once a column
    out, parts = df, []
    for k, c in enumerate(attribute_cols):
        own = entries.where((F.col("grp") == 0) & (F.col("col") == c))
        own = own.select(F.col("value").alias(f"_v{k}"), F.col("idx").alias(f"_i{k}"))
        out = out.withColumn(f"_v{k}", F.coalesce(F.col(c).cast("string"), F.lit(OTHER))).join(F.broadcast(own), f"_v{k}", "left").drop(f"_v{k}")
    if attribute_cols:
        parts.append(F.array(*[ints(F.col(f"_i{k}")) for k in range(len(attribute_cols))]))
    for k, c in enumerate(list_cols):
        table, n = list_indices(df, c, k + 1, entries)
        out = lookup_join(out.withColumn("_list", F.col(c).cast("string")), table, ["_list"], n, "_n", dictionary.n_rows, "left")
        out = out.withColumnRenamed("_ids", f"_ids{k}").drop("_list", "_n")
        # a null list is the token OTHER, which no dictionary holds
        parts.append(F.coalesce(F.col(f"_ids{k}"), F.array().cast("array<int>")))
    every = parts[0] if len(parts) == 1 else F.concat(*parts)
    out = out.select(*carry, F.sort_array(F.array_remove(F.array_distinct(every), NO_INDEX)).alias("features"))
    if repeats(df, [row_key]):
        others = [F.first(c).alias(c) for c in carry if c != row_key]
        folded = F.sort_array(F.array_distinct(F.flatten(F.collect_list("features")))).alias("features")
        out = out.groupBy(row_key).agg(*others, folded).select(*carry, "features")
    if constant_feature:
        out = out.withColumn("features", F.array_append("features", F.lit(dictionary.size)))
    return out


def repeats(df: DataFrame, keys: list[str]) -> bool:
    """Whether some key stands in more than one row: counts of the keys alone."""
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).isEmpty()


def one_hot(df: DataFrame, attribute_cols: list[str], list_cols: list[str], carry: list[str],
            threshold: int, families: list[str] | None = None,
            constant_feature: bool = False) -> tuple[DataFrame, FeatureDictionary]:
    """Full feature build: dictionary from the level counts, then the encoded rows. The derived
    columns are written once, as both steps read them."""
    df = cut_lineage(df.select(*dict.fromkeys([*carry, *attribute_cols, *list_cols])), "derived")
    dictionary = feature_dictionary(df, attribute_cols, list_cols, threshold, families, constant_feature)
    if dictionary.n_entries <= broadcast_rows(dictionary.entries):
        return encode_columns(df, attribute_cols, list_cols, dictionary, carry, constant_feature), dictionary
    cells = feature_cells(df, attribute_cols, list_cols, carry)
    return encode_rows(cells, dictionary, carry, constant_feature), dictionary


def feature_dictionary(df: DataFrame, attribute_cols: list[str], list_cols: list[str], threshold: int,
                       families: list[str] | None = None, constant_feature: bool = False) -> FeatureDictionary:
    """The dictionary alone: one aggregation over the rows, nothing is encoded."""
    cells = feature_cells(df, attribute_cols, list_cols, [])
    levels, stats = cut_lineage_observed(level_counts(cells), "levels", {
        "n_levels": F.count(F.lit(1)), "n_cells": F.sum(F.when(F.col("grp") == 0, F.col("n")))})
    stats["n_attr_cols"] = len(attribute_cols)
    return build_dictionary(levels, threshold, families, constant_feature, stats)
