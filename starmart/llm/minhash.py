"""MinHash near-dedup by an inverted join of signature coordinates.

A document's set of word shingles has one smallest hash per coordinate. A document is posted under (coordinate, value)
pairs, rarest first: values that no other document has are no postings at all, and a document with too few others cannot
reach the match threshold and leaves. Two documents with ``MATCHES`` equal coordinates share a posting among all but the
last ``MATCHES - 1`` of each in the common order, so only this prefix is posted and the longest lists are skipped. Pairs
from the lists are kept if their signatures agree in ``MATCHES`` coordinates and are then confirmed on the full sets. Sets
of 0.8 similarity fail the threshold with a probability of 3.4e-11, more similar ones with less.

No list is expanded into pairs. Each list has a leader, the document whose values occur most often (in a family of edited
copies that is the unedited one), and every other document of the list meets the leader only: as many pairs as postings
at most. A family, all documents under one leader, is settled once its links make it one component. Where it is not,
only the documents outside the leader's component are outstanding; they meet all documents of the family in tiles of
bounded size, where collisions are counted by a matrix product and only sets of different components are confirmed. So
the work grows with the family times its outstanding documents, and no link between different components is missed.

Equal sets are one node, named by its smallest id. A posting list holds at most the share 1 / ``COORDINATES`` of all
postings. Everything passes through tables in the shared folder, nothing through the driver.

Defined cases: null and empty texts have empty sets, stand alone and are kept; texts shorter than the shingle are one
shingle; rows that repeat an id are one document that has the links of all; rows without an id stand alone, with a null
component, and are kept; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.families import family_links, named_components, narrowed, with_component
from starmart.llm.tables import Stored
from starmart.llm.text import WordHashes, lower_words, mix, window_hashes

#: Coordinates of a signature, and how many of them two documents must share to be confirmed.
COORDINATES, MATCHES = 64, 28
#: Shingles hashed at once.
CHUNK = 512
_HASHES = WordHashes(11)
_DIGEST = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_SEEDS, _FACTORS = _SEEDS[:, None], (mix(_SEEDS) | np.uint64(1))[:, None]


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence if there are fewer words."""
    h = _HASHES.of(lower_words(text))
    return np.unique(window_hashes(h, min(width, len(h)))) if len(h) else np.empty(0, np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """Smallest hash per coordinate, 32 bits each; empty for an empty set."""
    if not len(s):
        return np.empty(0, np.int32)
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), CHUNK):
        low = np.minimum(low, ((s[None, at:at + CHUNK] ^ _SEEDS) * _FACTORS).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if not len(s) or not len(t) or 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    common = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
    return 100 * common >= percent * (len(s) + len(t) - common)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(row, doc_id, size, digest, sig) of every row; ``row`` tells it from others of the same id."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, sigs = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), width)
                size.append(len(s))
                digest.append(mix(s * _DIGEST).sum(dtype=np.uint64))
                sigs.append(signature(s))
            edges = np.concatenate([[0], np.cumsum([len(x) for x in sigs])]).astype(np.int32)
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(size, pa.int64()),
                 pa.array(np.array(digest, np.uint64).view(np.int64)), pa.ListArray.from_arrays(edges, flat)],
                names=["row", "doc_id", "size", "digest", "sig"])

    return docs.mapInArrow(task, "row long, doc_id long, size long, digest long, sig array<int>")


def _postings(stored: Stored, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, node, rank) of the prefixes, and (node, tokens) of the documents that can reach the threshold."""
    token = (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value")).alias("token")
    tokens = nodes.select("node", F.posexplode("sig").alias("at", "value")).select("node", token)
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = tokens.join(often.hint("merge"), "token").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("n", "token"))).alias("by_n"))
    able = stored.keep(found.where(F.size("by_n") >= MATCHES), "able")
    rank = F.expr("aggregate(by_n, 0D, (sum, x) -> sum - ln(x.n))")
    prefix = F.expr(f"slice(by_n, 1, size(by_n) - {MATCHES} + 1)")
    posted = able.select("node", rank.alias("rank"), F.explode(prefix).alias("p")).select(F.col("p.token").alias("token"), "node", "rank")
    return posted, able.select("node", F.expr("transform(by_n, x -> x.token)").alias("tokens"))


def _meetings(stored: Stored, posted: DataFrame) -> DataFrame:
    """Distinct (leader, node) pairs of the posting lists."""
    lists = stored.keep(posted, "lists")
    leaders = stored.keep(lists.groupBy("token").agg(
        F.min(F.struct("rank", "node")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "token", F.col("first.node").alias("leader")), "leaders")
    met = stored.keep(lists.join(leaders.hint("merge"), "token").where("leader != node").select("leader", "node").distinct(), "met")
    stored.drop(lists, leaders)
    return met


def joining_links(
    nodes: list[int], sets: list[np.ndarray], component: list[int], side: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links that join components, of sets on side 0 with all others (side 2 takes part on both sides)."""
    sigs = [signature(s) for s in sets]
    rows = [i for i in range(len(nodes)) if side[i] != 1 and len(sigs[i])]
    columns = [i for i in range(len(nodes)) if side[i] != 0 and len(sigs[i])]
    if not rows or not columns:
        return []
    common = np.zeros((len(rows), len(columns)), np.int16)
    left, right = np.array([sigs[i] for i in rows]), np.array([sigs[i] for i in columns])
    for k in range(COORDINATES):
        common += left[:, k][:, None] == right[:, k][None, :]
    of = np.array(component)
    hit = (common >= MATCHES) & (of[rows][:, None] != of[columns][None, :])
    parent = {c: c for c in component}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found = []
    for r, c in np.argwhere(hit).tolist():
        i, j = rows[r], columns[c]
        x, y = root(component[i]), root(component[j])
        if x != y and linked(sets[i], sets[j], percent):
            parent[max(x, y)] = min(x, y)
            found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links), kept."""
    stored = Stored(docs.sparkSession, "minhash")
    docs = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored.keep(_sets(docs, width), "sets")
    known = sets.where("doc_id is not null and size > 0")
    # One node per set, which is its digest; its name is the smallest id that has it, and its text that of one row.
    nodes = stored.keep(known.groupBy("digest").agg(
        F.min(F.struct("doc_id", "row")).alias("head"), F.first("sig").alias("sig")).select(
        F.col("digest").alias("node"), F.col("head.doc_id").alias("name"), F.col("head.row").alias("row"), "sig"), "nodes")

    posted, able = _postings(stored, nodes.select("node", "sig"))
    met = _meetings(stored, posted)
    a, b = able.withColumnsRenamed({"node": "leader", "tokens": "x"}), able.withColumnRenamed("tokens", "y")
    agree = F.size(F.array_intersect("x", "y")) >= MATCHES
    pairs = stored.keep(met.join(b.hint("merge"), "node").join(a.hint("merge"), "leader").where(agree).select("leader", "node"), "pairs")
    needed = stored.keep(met.select(F.explode(F.array("leader", "node")).alias("node")).distinct().join(
        nodes.select("node", "row"), "node"), "needed")
    texts = stored.keep(narrowed(docs, "row", needed).join(needed.hint("merge"), "row").dropDuplicates(["row"]).select(
        "node", "text"), "texts")
    links = family_links(
        stored, met, pairs, texts, lambda text: shingles(text, width), lambda s, t: linked(s, t, percent),
        lambda *tile: joining_links(*tile, percent))
    stored.drop(met, pairs, needed, texts)
    placed = named_components(stored, known, nodes, links)
    stored.drop(nodes, links)
    return with_component(sets, placed).select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
