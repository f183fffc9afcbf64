"""Consistent-hash sharding with bounded loads, in DataFrame operations only.

The ring is cut into a fixed number of cells. A text's hash gives its cell, so equal texts stand
together on the ring; every shard has virtual nodes at fixed cells, and a cell belongs to the
next node clockwise (its arc). Law ``rows``: each shard takes exactly its share of the rows
(shares differ by at most one). A shard first takes rows of its own arcs in ring order; rows
over its share continue clockwise, first come first served, to the next node whose shard has
room. A node stands where its shard and its number put it, so one more shard only adds nodes; the
rows that then move are those of the new arcs and what the smaller shares push on. What overflows
and where it lands is decided on one row per arc (shards x nodes, a
parameter); rows only look up their arc. Ranks within an arc come from small (cell, salt)
groups, so a text that a third of all rows share is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalcast.session import cut_lineage, read_table

CELL_BITS, SALTS = 14, 256


def _ring(spark, shards: int, nodes: int) -> DataFrame:
    """``(cell, arc, owner)`` of all cells; an arc is named by the cell of its node."""
    cells = 1 << CELL_BITS
    node = (spark.range(shards * nodes)
            .select((F.col("id") % shards).cast("int").alias("owner"), F.expr(f"id div {shards}").alias("replica"))
            # a node's place depends on its owner and number alone, so another shard count moves no node
            .select("owner", F.shiftrightunsigned(F.xxhash64(F.lit("node"), "owner", "replica"), 64 - CELL_BITS).alias("arc"))
            .groupBy("arc").agg(F.min("owner").alias("owner")))
    one = Window.orderBy("arc")                                # shards x nodes rows
    gaps = node.select("arc", "owner", F.lag("arc").over(one).alias("before"), F.max("arc").over(Window.partitionBy()).alias("top"))
    low = F.coalesce(F.col("before") + 1, F.lit(0))
    own = gaps.select("arc", "owner", F.explode(F.sequence(low, "arc")).alias("cell"))
    # past the last node the ring goes on at the first
    wrap = (gaps.where("before is null and top < %d" % (cells - 1))
            .select("arc", "owner", F.explode(F.sequence(F.col("top") + 1, F.lit(cells - 1).cast("long"))).alias("cell")))
    return own.unionByName(wrap)


def _plan(counts: DataFrame, ring: DataFrame, shards: int) -> DataFrame:
    """Per arc: rows its owner keeps, and the ranges of overflow ordinals with shard and first slot."""
    arcs = (ring.select("arc", "owner").distinct().join(counts, "arc", "left")
            .select("arc", "owner", F.coalesce("cnt", F.lit(0)).alias("cnt"))
            .withColumn("n", F.sum("cnt").over(Window.partitionBy()))
            .withColumn("quota", F.expr(f"n div {shards} + if(owner < n % {shards}, 1, 0)"))
            .withColumn("before", F.sum("cnt").over(Window.partitionBy("owner").orderBy("arc")) - F.col("cnt"))
            .withColumn("kept", F.expr("greatest(0L, least(cnt, quota - before))"))
            .withColumn("over", F.col("cnt") - F.col("kept")))
    free = arcs.groupBy("owner").agg((F.max("quota") - F.sum("kept")).alias("free"), F.max("quota").alias("quota"))
    shard = (arcs.sparkSession.range(shards).select(F.col("id").cast("int").alias("owner")).join(free, "owner", "left")
             .agg(F.sort_array(F.collect_list(F.struct("owner", F.coalesce("free", F.lit(0)).alias("free"),
                                                       F.coalesce("quota", F.lit(0)).alias("quota")))).alias("shards")))
    row = (arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "owner", "before", "kept", "over"))).alias("arcs"))
           .withColumn("one", F.lit(1)).join(shard.withColumn("one", F.lit(1)), "one"))
    # one walk clockwise and a second for what wraps around: ordinals leave in the order they came
    walk = """
      aggregate(concat(arcs, transform(arcs, a -> named_struct('arc', a.arc, 'owner', a.owner, 'before', a.before,
                                                               'kept', a.kept, 'over', 0L))),
        named_struct('free', transform(shards, s -> s.free), 'carry', 0L, 'taken', 0L,
                     'out', array_remove(array(named_struct('lo', 0L, 'hi', 0L, 'shard', 0, 'slot', 0L)),
                                         named_struct('lo', 0L, 'hi', 0L, 'shard', 0, 'slot', 0L))),
        (s, a) -> named_struct(
          'free', transform(s.free, (f, i) -> if(i = a.owner, f - least(s.carry + a.over, f), f)),
          'carry', s.carry + a.over - least(s.carry + a.over, s.free[a.owner]),
          'taken', s.taken + least(s.carry + a.over, s.free[a.owner]),
          'out', if(least(s.carry + a.over, s.free[a.owner]) > 0,
                    concat(s.out, array(named_struct('lo', s.taken, 'hi', s.taken + least(s.carry + a.over, s.free[a.owner]),
                                                     'shard', a.owner, 'slot', shards[a.owner].quota - s.free[a.owner]))),
                    s.out)),
        s -> s.out)"""
    first = Window.orderBy("arc")                              # shards x nodes rows
    return (row.withColumn("out", F.expr(walk)).select(F.explode("arcs").alias("a"), "out").select("a.*", "out")
            .withColumn("first", F.sum("over").over(first) - F.col("over"))
            .withColumn("ranges", F.expr("filter(out, x -> x.hi > first and x.lo < first + over)"))
            .drop("out", "over"))


def shard_documents(docs: DataFrame, shards: int = 24, nodes: int = 64) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``
    (doc_id, text; other columns are ignored). Shards get floor or ceil of their equal share of
    the rows; slots number the rows of a shard from 0 without gaps.

    Defined cases: a null text has size 8 and the CRC of no bytes (0) and stands with empty
    texts; null doc_ids rank last among the rows of their place; repeated rows are placed one by one; an empty table gives
    no rows. Which of several equal rows gets which slot does not matter: they are alike.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.when(F.col("text").isNull(), F.lit(8)).otherwise(F.octet_length(raw) + 8).cast("long").alias("size"),
                    F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("pos"))
        .withColumn("cell", F.shiftrightunsigned("pos", 64 - CELL_BITS))
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        # rows without an id come last in their cell, text by text, spread by their place in the
        # input: equal ones are alike, and the table is written, so salts stay
        .withColumn("salt", F.when(F.col("doc_id").isNull(), F.expr(
            f"{SALTS} * (1 + shiftrightunsigned(shiftleft(pos, {CELL_BITS}), 34)) + pmod(xxhash64(monotonically_increasing_id()), {SALTS})"))
            .otherwise(F.col("salt"))),
        "shard-rows")
    ring = F.broadcast(_ring(spark, shards, nodes))            # 2 ** CELL_BITS rows
    groups = base.groupBy("cell", "salt").agg(F.count(F.lit(1)).alias("cnt")).join(ring, "cell")
    groups = cut_lineage(
        groups.withColumn("offset", F.sum("cnt").over(Window.partitionBy("arc").orderBy("cell", "salt")) - F.col("cnt")),
        "shard-groups")
    plan = _plan(groups.groupBy("arc").agg(F.sum("cnt").alias("cnt")), ring, shards)

    rank = F.row_number().over(Window.partitionBy("cell", "salt").orderBy("pos", "doc_id", "text_crc32", "size")) - 1
    placed = (base.withColumn("rank", rank).join(groups.select("cell", "salt", "arc", "offset"), ["cell", "salt"])
              .join(F.broadcast(plan), "arc")                  # shards x nodes rows
              .withColumn("rank", F.col("offset") + F.col("rank"))
              .withColumn("ordinal", F.expr("first + rank - kept"))
              .withColumn("range", F.expr("if(rank < kept, null, filter(ranges, x -> x.lo <= ordinal and ordinal < x.hi)[0])")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.coalesce("range.shard", "owner").alias("shard"),
        F.expr("if(rank < kept, before + rank, range.slot + ordinal - range.lo)").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """Shards 0 to 23, 64 virtual nodes each."""
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=24, nodes=64)


QUERIES = {"op2_sharding": op2_sharding}
