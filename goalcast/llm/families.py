"""Links inside families of rows that may match, without the square of a family's size.

A family ``leader`` holds rows that must be compared with one another as far as the *components*
of all links ask for it. Families of at most one chunk are compared whole. Of a larger one a
bounded chunk of pivots meets all other members first (rows dealt: about twice the members); the
links found label the components of all rows. Members outside the family's largest component
are then the next pivots, and pairs inside one component are never compared again. A dense family
is one component after the first round. After ``PIVOT_ROUNDS`` rounds whatever is left outside
meets everything that is left, in pairs of chunks, so the result is exact for any family.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm.components import joined_components
from goalcast.session import cut_lineage

#: Rounds of one more pivot chunk a family before all that is left is dealt.
PIVOT_ROUNDS = 1
#: Rows of a side table (large families, places in blocks) that is broadcast at most.
SIDE_ROWS = 500_000
EDGES = "a long, b long"


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest (root, member) of a symmetric link matrix."""
    left, edges = np.ones(len(links), dtype=bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        front = np.flatnonzero(links[root] & left)
        while len(front):
            left[front] = False
            edges += [(root, int(x)) for x in front]
            front = np.flatnonzero(links[front].any(axis=0) & left)
    return edges


def overlaps(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all rows with all columns (sorted token arrays)."""
    sizes = [len(x) for x in rows + cols]
    tokens = np.concatenate(rows + cols)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    known, index = np.unique(tokens, return_inverse=True)
    shared = np.bincount(index) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[index]
    index, owner, width = rank[index[keep]], owner[keep], int(shared.sum())
    out = np.zeros((len(rows), len(cols)), dtype=np.float32)
    for lo in range(0, width, 4096):                           # bounded slabs of tokens
        here = (index >= lo) & (index < lo + 4096)
        slab = np.zeros((len(sizes), min(4096, width - lo)), dtype=np.float32)
        slab[owner[here], index[here] - lo] = 1
        out += slab[:len(rows)] @ slab[len(rows):].T
    return out.astype(np.int64)


def linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, cand: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which candidates (``cand[i, j]``: row ``a[i]`` with row ``b[j]``) have
    ``den * intersection >= num * union`` on their full sets."""
    n = np.array([len(x) for x in sets], dtype=np.int64)
    total = n[a][:, None] + n[b][None, :]
    link = np.zeros_like(cand)
    if cand.sum() > 4 * len(sets):
        r, c = np.flatnonzero(cand.any(axis=1)), np.flatnonzero(cand.any(axis=0))
        both = overlaps([sets[a[x]] for x in r], [sets[b[x]] for x in c])
        link[np.ix_(r, c)] = both * (num + den) >= num * total[np.ix_(r, c)]
        return link & cand
    for i, j in zip(*np.nonzero(cand)):
        both = len(np.intersect1d(sets[a[i]], sets[b[j]], assume_unique=True))
        link[i, j] = both * (num + den) >= num * total[i, j]
    return link


def compare(check: Callable) -> Callable:
    """A block of a family: ``check(table, a, b, cand)`` says which candidate pairs of the rows
    ``a`` with the rows ``b`` are links. Returns a spanning forest of the links."""
    def run(table: pa.Table) -> pa.Table:
        rid, label, side = (table[c].to_numpy() for c in ("rid", "label", "side"))
        one = table["ci"][0] == table["cj"][0]
        a = np.arange(len(rid)) if one else np.flatnonzero(side == 0)
        b = a if one else np.flatnonzero(side == 1)
        edges = []
        if len(a) and len(b) and len(rid) > 1:
            cand = label[a][:, None] != label[b][None, :]
            if one:
                cand = np.triu(cand, 1)
            full = np.zeros((len(rid), len(rid)), dtype=bool)
            if cand.any():
                full[np.ix_(a, b)] = check(table, a, b, cand)
            edges = forest(full | full.T)
        return pa.table({"a": pa.array([int(rid[x]) for x, _ in edges], pa.int64()),
                         "b": pa.array([int(rid[x]) for _, x in edges], pa.int64())})
    return run


def _side(df: DataFrame) -> DataFrame:
    """Broadcast up to ``SIDE_ROWS`` rows of numbers (about 60 bytes each)."""
    return F.broadcast(df) if df.count() <= SIDE_ROWS else df


def family_components(member: DataFrame, payload: Callable[[DataFrame], DataFrame], check: Callable, chunk: int,
                      name: str, roots: DataFrame | None = None, first_only: bool = False) -> DataFrame:
    """``(node, root)`` of the components of all links inside the families of ``member``
    (leader, rid; distinct longs), on top of the components ``roots`` known before, whose members
    are not compared with one another. ``payload`` adds to rows with a ``rid`` what ``check``
    reads; rows that it does not know leave. Rows without a link are absent. With ``first_only``
    large families meet their first pivots only (to be completed by a later call)."""
    def run(dealt: DataFrame, step: int) -> DataFrame:
        # up to SIDE_ROWS rows of six numbers are sent to where their sets are, more are shuffled to them
        blocks = payload(_side(dealt.select("leader", "rid", "label", "ci", "cj", "side")))
        return cut_lineage(blocks.groupBy("leader", "ci", "cj").applyInArrow(compare(check), EDGES), f"{name}-edges-{step}")

    def labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
        return rows.join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left") \
                   .withColumn("label", F.coalesce("root", "rid")).drop("root")

    sizes = cut_lineage(member.groupBy("leader").agg(F.ceil(F.count("rid") / chunk).cast("int").alias("chunks"))
                        .where("chunks > 1"), f"{name}-large")
    chunks = F.coalesce("chunks", F.lit(1))
    member = (member.join(_side(sizes), "leader", "left").withColumn("chunks", chunks)
              .withColumn("c", F.expr("pmod(xxhash64(rid), chunks)").cast("int")))
    member = cut_lineage(labelled(member, roots) if roots is not None else member.withColumn("label", F.col("rid")), f"{name}-families")
    # chunk 0 meets every chunk; a family of one chunk meets itself
    dealt = (member.withColumn("cj", F.explode(F.expr("if(c = 0, sequence(0, chunks - 1), array(c))")))
             .withColumn("ci", F.lit(0)).withColumn("side", F.when(F.col("c") == 0, 0).otherwise(1)))
    roots = joined_components(roots, run(dealt, 0))
    rest = member.where("c > 0").select("leader", "rid")
    step = 0
    while True:
        step += 1
        if first_only or not rest.limit(1).count():
            return roots
        known = labelled(rest, roots)
        parts = known.groupBy("leader", "label").agg(F.count("rid").alias("cnt"))
        open_ = (parts.groupBy("leader").agg(F.max(F.struct("cnt", "label")).alias("top"), F.sum("cnt").alias("total"))
                 .where("total > top.cnt")
                 .select("leader", F.col("top.label").alias("giant"),
                         F.expr(f"int(ceil((total - top.cnt) / {chunk}))").alias("oc"),
                         F.expr(f"int(ceil(top.cnt / {chunk}))").alias("gc"),
                         F.expr(f"int(ceil(total / {chunk}))").alias("mc")))
        open_ = cut_lineage(open_, f"{name}-open")
        rest = cut_lineage(known.join(_side(open_), "leader")
                           .withColumn("outside", F.col("label") != F.col("giant"))
                           .withColumn("c", F.expr(f"if(outside, pmod(xxhash64(rid, {step}), oc), pmod(xxhash64(rid), gc))").cast("int")),
                           f"{name}-rest")
        if not rest.limit(1).count():
            return roots
        if step <= PIVOT_ROUNDS:
            pivot = "outside and c = 0"
            dealt = (rest.withColumn("cj", F.explode(F.expr(f"if({pivot}, sequence(0, mc), array(int(1 + pmod(xxhash64(rid), mc))))")))
                     .withColumn("ci", F.lit(0)).withColumn("side", F.expr(f"if({pivot}, 0, 1)")))
            rest = rest.where(f"not ({pivot})").select("leader", "rid")
        else:
            # everything outside the largest component meets everything that is left
            dealt = (rest.withColumn("o", F.explode(F.expr("if(outside, sequence(0, oc + gc - 1), sequence(0, oc - 1))")))
                     .withColumn("ci", F.expr("if(outside, if(o < oc, least(c, o), c), o)"))
                     .withColumn("cj", F.expr("if(outside, if(o < oc, greatest(c, o), o), oc + c)"))
                     .withColumn("side", F.expr("if(outside and (c <= o or o >= oc), 0, 1)")))
            rest = rest.where("false").select("leader", "rid")
        roots = joined_components(roots, run(dealt, step))
