"""N-gram Jaccard join: documents linked by the Jaccard similarity of their word shingles, exactly, with set relations.

A set is the sorted 64-bit hashes of its shingles. The index lists do not hold single shingles: the hash range is cut
into position blocks, more of them than two linked sets of the size class can differ in, so two linked sets agree in at
least one whole block. A list holds the sets that agree in one block; all other blocks, and with them all other lists,
are skipped. Blocks hold several shingles, so a shingle shared by many unlike documents makes no long list. A set enters
only the lists of its fullest blocks, one more than it and a partner can differ in: in an order that both share, the
first common block stands among them, so the rest is skipped too.

All lists are read in one pass, sorted by key and id. Every set is compared with the leader of each of its lists, the set
of the smallest id. Sets linked with it have their answer (the leader's component), so a family of copies has one
component after as many comparisons as it has sets. Only the sets that are then outside their leader's component are
compared with all sets of its family, in tiles of bounded size, where only sets of different components are looked at (see
``families``). A task returns no pairs but the links that join components. So no link between different components is
missed; the work grows with the family times its outstanding sets. Equal sets are one node, told by a digest.

A list holds one entry of each of its sets' many, so that no key has a large share of the rows. Everything passes
through tables in the shared folder, nothing through the driver.

Defined cases: null and empty texts have empty sets and stand alone; texts shorter than the shingle are one shingle;
rows that repeat an id are one document that has the links of both; rows without an id stand alone, with a null
component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.families import family_links, named_components, narrowed, with_component
from starmart.llm.tables import Stored, components
from starmart.llm.text import WordHashes, lower_words, mix, window_hashes

#: Sizes of a class grow by this ratio.
RATIO = 2
#: More blocks than needed, so that the empty ones can be left out.
SLACK = 1.17
#: Columns of the matrix by which the sets of a tile are compared.
COLUMNS = 8192
_HASHES = WordHashes(5)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence if there are fewer words."""
    h = _HASHES.of(lower_words(text))
    return np.unique(window_hashes(h, min(width, len(h)))) if len(h) else np.empty(0, np.uint64)


def _bounds(k: int) -> tuple[int, int]:
    """Smallest and largest size of class ``k``."""
    return int(np.ceil(RATIO**k)), int(np.ceil(RATIO ** (k + 1))) - 1


def size_class(n: int) -> int:
    k = int(np.log(n) / np.log(RATIO))
    while _bounds(k)[1] < n:
        k += 1
    while _bounds(k)[0] > n:
        k -= 1
    return k


def _block_keys(s: np.ndarray, k: int, percent: int) -> np.ndarray:
    largest = _bounds(k)[1]
    differ = (100 - percent) * 2 * largest // (100 + percent)
    p = 1 if differ == 0 else int(np.ceil(SLACK * differ)) + 1
    block = ((s >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
    edge = np.searchsorted(block, np.arange(p + 1, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s))])
    sums, held = total[edge[1:]] - total[edge[:-1]], edge[1:] - edge[:-1]
    keys = mix(sums + np.arange(p, dtype=np.uint64) * _A + np.uint64((k + 1) * int(_B) % 2**64))
    # How many shingles, and so blocks, this set and any partner in the class can differ in. If more blocks than that are
    # filled, the first ones by size and key are enough: at most that many differ, so the first common one is among them
    # on both sides. Else the empty blocks count too, and there are more blocks than differences.
    n = len(s)
    enough = (100 - percent) * (n + min(largest, n * 100 // percent)) // (100 + percent) + 1
    filled = np.flatnonzero(held)
    if len(filled) >= enough:
        keys = keys[filled[np.lexsort((keys[filled], -held[filled]))[:enough]]]
    return keys


def block_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the lists of a set: its blocks in its own size class, and in the next one if it has partners there."""
    n = len(s)
    if not n:
        return np.empty(0, np.int64)
    k = size_class(n)
    keys = [_block_keys(s, k, percent)]
    up = k + 1
    while n * 100 >= percent * _bounds(up)[0]:
        if _bounds(up)[0] <= _bounds(up)[1]:
            keys.append(_block_keys(s, up, percent))
        up += 1
    return np.concatenate(keys).view(np.int64) >> np.int64(16)  # false matches of 48 bits are compared away


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(row, doc_id, size, digest, keys of its lists) of every row, so that texts are cut into shingles once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, keys = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), width)
                size.append(len(s))
                digest.append(mix(s * _A).sum(dtype=np.uint64))
                keys.append(block_keys(s, percent))
            edges = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(edges, np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(size, pa.int64()),
                 pa.array(np.array(digest, np.uint64).view(np.int64)), lists], names=["row", "doc_id", "size", "digest", "keys"])

    return docs.mapInArrow(task, "row long, doc_id long, size long, digest long, keys array<long>")


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if not len(s) or not len(t):
        return False
    common = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
    return 100 * common >= percent * (len(s) + len(t) - common)


def joining_links(
    ids: list[int], sets: list[np.ndarray], component: list[int], side: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links that join the components of sets of two tiles (sides 0 and 1; side 2 is a tile that meets itself)."""
    n = len(ids)
    rows = [i for i in range(n) if side[i] != 1]
    columns = [i for i in range(n) if side[i] != 0]
    sizes = np.array([len(s) for s in sets], np.int64)
    value, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, token, often = np.unique(value, return_inverse=True, return_counts=True)
    shared = often[token] > 1
    token, owner = np.unique(token[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    common = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        lo, hi = np.searchsorted(token, [low, low + COLUMNS])
        slab = np.zeros((n, COLUMNS), np.float32)
        slab[owner[lo:hi], token[lo:hi] - low] = 1.0
        common += slab[rows] @ slab[columns].T
    union = sizes[rows][:, None] + sizes[columns][None, :] - common
    of = np.array(component)
    hit = (common > 0) & (100 * common >= percent * union) & (of[rows][:, None] != of[columns][None, :])
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
        if x != y:
            parent[max(x, y)] = min(x, y)
            found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return found


def _set_links(stored: Stored, docs: DataFrame, known: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that make the components of the sets, named by their digests.

    The lists are read in one pass, sorted by key and id: the first set of a list is its leader, and every other one
    meets it.
    """
    lists = known.select(F.explode("keys").alias("key"), "doc_id", "digest")
    order = Window.partitionBy("key").orderBy(F.asc_nulls_last("doc_id"), "digest").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = stored.keep(lists.select(F.first("digest").over(order).alias("leader"), F.col("digest").alias("node")).where(
        "leader != node").distinct(), "met")
    needed = stored.keep(met.select(F.explode(F.array("leader", "node")).alias("node")).distinct().join(
        nodes.select("node", "row").hint("merge"), "node"), "needed")
    texts = stored.keep(narrowed(docs, "row", needed).join(needed.hint("merge"), "row").dropDuplicates(["row"]).select(
        "node", "text"), "texts")
    links = family_links(
        stored, met, met, texts, lambda text: shingles(text, width), lambda s, t: _linked(s, t, percent),
        lambda *tile: joining_links(*tile, percent))
    stored.drop(met, needed, texts)
    return links


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _nodes(known: DataFrame) -> DataFrame:
    """One node per set, which is its digest: the smallest id that has it (no id last) and one row with its text."""
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("head")
    return known.groupBy("digest").agg(head).select(
        F.col("digest").alias("node"), F.col("head.doc_id").alias("name"), F.col("head.row").alias("row"), "head")


def linked(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per input row: doc_id, n_shingles, and the smallest id reachable by links of at least ``percent``."""
    stored = Stored(docs.sparkSession, "jaccard")
    docs = _prepared(docs)
    sets = stored.keep(_sets(docs, width, percent), "sets")
    known = sets.where("doc_id is not null and size > 0")
    nodes = stored.keep(_nodes(known).drop("head"), "nodes")
    links = _set_links(stored, docs, known, nodes, width, percent)
    placed = named_components(stored, known, nodes, links)
    stored.drop(nodes, links)
    return with_component(sets, placed).drop("row")


def first_of_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, with one kept of each linked group.

    Every distinct (id, text) is judged for itself: of a group the one with the smallest id stays (those without an id
    come last; among unlike texts under one id that with the smallest hash), and of rows that repeat its id and text one
    stays. Texts without words stay, one of each repeated row. Unlike texts stay, whatever their ids.
    """
    stored = Stored(docs.sparkSession, "first-of-groups")
    keyed = _prepared(docs)
    sets = stored.keep(_sets(keyed, width, percent), "sets")
    known = sets.where("size > 0")
    nodes = stored.keep(_nodes(known), "nodes")
    links = _set_links(stored, keyed, known, nodes, width, percent)
    label = components(stored, links)
    grouped = nodes.join(label.hint("merge"), "node", "left").select(F.coalesce("component", "node").alias("component"), "head", "node")
    heads = stored.keep(grouped.groupBy("component").agg(F.min("head").alias("first")).select("component", "first.row"), "heads")
    # Rows that go are those of other sets of the group, or of the same set under another id or text; rows that repeat a
    # kept one are told apart by their number. All others stay without being moved.
    staying = grouped.join(heads.hint("merge"), "component").select(F.col("node").alias("digest"), F.col("row").alias("stays"))
    rows = known.join(staying.hint("merge"), "digest").groupBy("row").agg(
        F.max(F.col("row") == F.col("stays")).alias("stays"), F.count(F.lit(1)).alias("n"))
    blank = sets.where("size = 0").groupBy("row").agg(F.lit(True).alias("stays"), F.count(F.lit(1)).alias("n"))
    judged = stored.keep(rows.unionByName(blank).where("n > 1 or not stays").select(F.col("row").alias("judged_row"), "stays"), "judged")
    columns = docs.columns
    key = _unused(columns, "row_key")
    with_key = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    wanted = judged.select(F.col("judged_row").alias(key))
    moved = narrowed(with_key, key, wanted).join(judged.hint("merge"), F.col(key) == F.col("judged_row"), "left")
    others = [F.col(c) for c in columns if c not in ("doc_id", "text")]
    one = F.min_by(F.struct(*columns), F.xxhash64(*others) if others else F.lit(0)).alias("one")
    once = moved.where("stays").groupBy(key).agg(one).select("one.*")
    stored.drop(nodes, links, label, heads)
    return narrowed(with_key, key, wanted, other=True).select(*columns).unionByName(
        moved.where("judged_row is null").select(*columns)).unionByName(once)


def _unused(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name
