"""Links of an inverted join whose lists are not expanded into pairs: leaders, confirmation on texts, and what is left.

Every member of a list meets the leader of the list only, so there are as many meetings as list entries at most. A family,
all nodes under one leader, is settled once its links make it one component. Where they do not, only the nodes outside
the leader's component are outstanding; they meet all nodes of the family in tiles of bounded size. So the work grows
with the family times its outstanding nodes, and no link between different components is missed.

Texts travel once per leader they meet, a leader's own text once for ``MEET`` of its nodes. Joins that move texts or
lists are merge joins at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.tables import Stored, components

#: Nodes that meet one copy of their leader's text, and sets of a tile.
MEET, TILE = 256, 400
#: Words of 64 bits of the bitmap in ``narrowed``; as a broadcast table it has no more rows than that.
WORDS = 2**18

Shingles = Callable[[str | None], np.ndarray]
#: (nodes, sets, components, sides) to the links that join components; side 0 meets side 1, side 2 meets all.
Joining = Callable[[list[int], list[np.ndarray], list[int], list[int]], list[tuple[int, int]]]


def narrowed(rows: DataFrame, column: str, wanted: DataFrame, other: bool = False) -> DataFrame:
    """The rows whose key may be among the wanted ones, told by a bitmap of fixed size; no wanted row is lost.

    With ``other`` the rest: rows whose key is surely not wanted. It saves the shuffle of most rows ahead of an exact join, as long as the wanted keys are few for the bitmap.
    """
    at = F.pmod(F.xxhash64(column), F.lit(WORDS * 64))
    bits = wanted.select(at.alias("_at")).select(
        F.shiftright("_at", 6).alias("_word"), F.expr("shiftleft(1L, cast(_at & 63 as int))").alias("_bit"))
    bitmap = bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    hit = F.expr("coalesce(bit_get(_bits, cast(_at & 63 as int)) = 1, false)")
    met = rows.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6)).join(F.broadcast(bitmap), "_word", "left")
    return met.where(~hit if other else hit).drop("_at", "_word", "_bits")


def confirmed(
    pairs: DataFrame, texts: DataFrame, shingles: Shingles, linked: Callable[[np.ndarray, np.ndarray], bool]
) -> DataFrame:
    """(leader, node) of the pairs (leader, node, n) whose sets are linked; n is the number of nodes of the leader."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / MEET)).cast("int"))
    follows = dealt.join(texts.hint("merge"), "node").select("leader", "part", F.lit(1).alias("side"), "node", "text")
    leads = dealt.select("leader", "part").distinct().join(
        texts.select(F.col("node").alias("leader"), "text").hint("merge"), "leader").select(
        "leader", "part", F.lit(0).alias("side"), F.col("leader").alias("node"), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for side, text in zip(batch.column("side").to_pylist(), batch.column("text")):
                own = shingles(text.as_py())
                if side == 0:
                    lead = own
                keep.append(side == 1 and linked(lead, own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("leader"), batch.column("node")], names=["leader", "node"]).filter(pa.array(keep, pa.bool_()))

    together = leads.unionByName(follows).repartition("leader", "part").sortWithinPartitions("leader", "part", "side", "node")
    return together.mapInArrow(task, "leader long, node long")


def outstanding_links(family: DataFrame, texts: DataFrame, shingles: Shingles, joining: Joining) -> DataFrame:
    """Links (a, b) between the outstanding nodes of (leader, node, component, out, n, n_out) and all of their family."""
    rows, columns = (F.greatest(F.ceil(F.col(c) / TILE), F.lit(1)).cast("int") for c in ("n_out", "n"))
    own = F.pmod(F.xxhash64("node"), columns).cast("int")
    row = F.pmod(F.xxhash64("node", F.lit(1)), rows).cast("int")
    cells = family.select(
        "leader", "node", "component", "out", columns.alias("columns"), rows.alias("rows"), own.alias("column"), row.alias("row"))
    as_column = cells.select(
        "leader", "node", "component", "column", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"))
    as_row = cells.where("out").select(
        "leader", "node", "component", "row", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"))
    dealt = as_column.unionByName(as_row).join(texts.hint("merge"), "node")

    def task(table: pa.Table) -> pa.Table:
        sets = [shingles(x) for x in table.column("text").to_pylist()]
        found = joining(
            table.column("node").to_pylist(), sets, table.column("component").to_pylist(), table.column("side").to_pylist())
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = dealt.select("leader", "row", "column", "node", "component", "side", "text")
    return columns.groupBy("leader", "row", "column").applyInArrow(task, "a long, b long")


def family_links(
    stored: Stored, met: DataFrame, pairs: DataFrame, texts: DataFrame, shingles: Shingles,
    linked: Callable[[np.ndarray, np.ndarray], bool], joining: Joining,
) -> DataFrame:
    """Links (a, b) that make the components of the linked nodes.

    ``met`` has every (leader, node) of the lists, ``pairs`` those of them that can be linked at all, ``texts`` the text of
    every node that is met.
    """
    sizes = met.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    first = stored.keep(confirmed(pairs.join(sizes, "leader"), texts, shingles, linked).select(
        F.col("leader").alias("a"), F.col("node").alias("b")), "first")
    label = components(stored, first)
    family = met.unionByName(met.select("leader", F.col("leader").alias("node")).distinct()).join(
        label, "node", "left").select("leader", "node", F.coalesce("component", "node").alias("component"))
    leads = family.where("leader = node").select("leader", F.col("component").alias("lead"))
    marked = stored.keep(family.join(leads, "leader").withColumn("out", F.col("component") != F.col("lead")), "marked")
    counts = marked.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.count_if("out").alias("n_out")).where("n_out > 0")
    more = outstanding_links(marked.join(counts, "leader"), texts, shingles, joining)
    links = stored.keep(first.unionByName(more), "links")
    stored.drop(first, label, marked)
    return links


def named_components(stored: Stored, known: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, placed): the smallest id reachable from a set, by links (a, b) of nodes and by ids that have several sets.

    ``known`` has (doc_id, digest) of all rows with a set, ``nodes`` the smallest id of each set as (node, name).
    """
    spread = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high")
    names = nodes.select(F.col("node").alias("a"), F.col("name").alias("x"))
    repeated = known.join(spread.select("doc_id"), "doc_id").select("doc_id", F.col("digest").alias("a")).distinct().join(
        names, "a").select(F.col("doc_id").alias("a"), F.col("x").alias("b"))
    by_name = links.join(names.hint("merge"), "a").join(names.withColumnsRenamed({"a": "b", "x": "y"}).hint("merge"), "b").select(
        F.col("x").alias("a"), F.col("y").alias("b")).unionByName(repeated)
    final = components(stored, by_name)
    placed = nodes.join(final.withColumnRenamed("node", "name").hint("merge"), "name", "left").select(
        F.col("node").alias("digest"), F.coalesce("component", "name").alias("placed"))
    out = stored.keep(placed, "placed")
    stored.drop(final)
    return out


def with_component(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """(row, doc_id, n_shingles, component_id) of every row. Rows without an id have no component; rows without a set
    have that of the other rows of their id, and stand alone if there are none."""
    rows = sets.select("row", "doc_id", "size", "digest")
    full = rows.where("size > 0").join(placed.hint("merge"), "digest", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.col("placed")))
    blank = rows.where("size = 0")
    others = rows.where("size > 0").select("doc_id", "digest").join(blank.select("doc_id").distinct(), "doc_id", "left_semi").join(
        placed, "digest").groupBy("doc_id").agg(F.min("placed").alias("placed"))
    alone = blank.join(others, "doc_id", "left").withColumn("component_id", F.coalesce("placed", "doc_id"))
    columns = ["row", "doc_id", F.col("size").alias("n_shingles"), "component_id"]
    return full.select(*columns).unionByName(alone.select(*columns))
