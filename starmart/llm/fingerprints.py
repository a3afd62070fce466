"""Document fingerprints: a digest of the quartiles of hashed byte-triplet counts, and a bounded difference of digests.

Byte triplets (bytes 0, 5 and 11 of every position, the text being read as a ring) are hashed into 256 buckets. The
digest has the length of the text on a logarithmic scale, the quartile ratios, and for each bucket the quartile that
its count falls into. The difference of two digests adds up the distances of the bucket codes, with a surcharge for
opposite quartiles, and those of length and ratios; likeness is one minus the difference, cut at its bound.

``with_next`` pairs each document with the next one in descending order of ids. Documents are dealt into id ranges,
only the first document of every range is copied to the range before it, and each task walks through its ranges with one
earlier document in memory: one shuffle of the texts, no window over all rows.

Defined cases: null and empty texts have no triplets and equal digests; repeated ids are ordered by text, descending;
null ids come last; a single document is its own next one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS, OFFSETS = 256, (0, 5, 11)
BOUND = 2.0 * BUCKETS
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double")
_ODD = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 22


def _counts(data: bytes) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    if not data:
        return total
    ring = data + (data * (1 + OFFSETS[2] // len(data)))[:OFFSETS[2]]
    values = np.frombuffer(ring, np.uint8)
    for at in range(0, len(data), PIECE):
        n = min(PIECE, len(data) - at)
        x = np.zeros(n, np.uint64)
        for k, off in enumerate(OFFSETS):
            x |= values[at + off:at + off + n].astype(np.uint64) << np.uint64(8 * k)
        x = (x + np.uint64(1 << 24)) * _ODD
        x ^= x >> np.uint64(29)
        total += np.bincount(((x * _ODD) >> np.uint64(56)).astype(np.int64), minlength=BUCKETS)
    return total


def digest(text: str | None) -> bytes:
    """Length byte, byte of quartile ratios, then two bits per bucket."""
    data = (text or "").encode("utf-8", "replace")
    counts = _counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    length = min(255, int(8 * np.log2(len(data) + 1)))
    ratios = (int(16 * q1 / q3) % 16, int(16 * q2 / q3) % 16) if q3 else (0, 0)
    return bytes((length, ratios[0] << 4 | ratios[1])) + body.astype(np.uint8).tobytes()


def difference(a: bytes, b: bytes) -> float:
    """Bounded difference of two digests, 0 to ``BOUND``."""
    x, y = (np.frombuffer(d[2:], np.uint8) for d in (a, b))
    total = 0
    for shift in (0, 2, 4, 6):
        d = np.abs((x >> shift & 3).astype(np.int64) - (y >> shift & 3))
        total += int(d.sum()) + 3 * int((d == 3).sum())
    ring = [min(abs(p - q), 16 - abs(p - q)) for p, q in ((a[1] >> 4, b[1] >> 4), (a[1] & 15, b[1] & 15))]
    return min(BOUND, total + abs(a[0] - b[0]) + sum(ring))


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / BOUND


def edited(text: str, following: str) -> str:
    """The last third replaced by the first as many code points of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _ranges(docs: DataFrame, n: int) -> list[float]:
    """Increasing inner bounds of about ``n`` id ranges of like size; the ids alone are read."""
    ids = docs.select(F.col("doc_id").cast("double").alias("id")).where("id is not null")
    cuts = ids.approxQuantile("id", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    return sorted(set(cuts))


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per document: digests of its text and its edited text, and their likeness, and that to the next one."""
    spark: SparkSession = docs.sparkSession
    n = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = [float("-inf"), *(_ranges(docs, n) or [0.0]), float("inf")]
    keyed = docs.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    keyed = Bucketizer(splits=cuts, inputCol="at", outputCol="part").transform(keyed)
    keyed = keyed.select("doc_id", "text", F.col("part").cast("int").alias("part"))
    # The highest id of each range: one row per range, and the range above it that needs it.
    tops = sorted(tuple(r) for r in keyed.groupBy("part").agg(F.max("doc_id")).collect())
    above = [(p, top, tops[(i + 1) % len(tops)][0]) for i, (p, top) in enumerate(tops)]
    heads = spark.createDataFrame(above, "part int, top long, above int")
    lead = (
        keyed.join(F.broadcast(heads), "part").where(F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("above").agg(F.max(F.struct("doc_id", "text")).alias("first"))
        .select("first.doc_id", "first.text", F.col("above").alias("part"), F.lit(1).alias("copy"))
    )
    dealt = (
        keyed.withColumn("copy", F.lit(0)).unionByName(lead)
        .repartition(n, "part")
        .sortWithinPartitions("part", "copy", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text"))
    )
    return dealt.mapInArrow(_walk, SCHEMA)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result of each document once the one after it, or the copy that ends its range, has been read."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    before = None
    for batch in batches:
        out = []
        columns = (batch.column(c) for c in ("doc_id", "text", "part", "copy"))
        for key, text, part, copy in zip(*columns):
            here, copied = text.as_py() or "", copy.as_py()
            own = digest(here)
            if before is not None and before[3] == part.as_py():
                last, last_text, last_digest, _ = before
                changed = edited(last_text, here)
                other = digest(changed)
                out.append((
                    last, len(last_text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                    last_digest.hex(), other.hex(), likeness(last_digest, other), likeness(last_digest, own)))
            before = None if copied else (key.as_py(), here, own, part.as_py())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
