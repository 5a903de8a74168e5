"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (one and two words) are fitted: one of target texts (labelled as good),
one of all raw texts.  A text's log ratio is that of the two probabilities: the sum over its n-grams.  The log weight it is
drawn by is the log ratio itself if `scale` is None, else its mean over the n-grams times `scale` (as if every text had
that many n-grams), since plain sums sort texts by their length.  Adding Gumbel noise, which a hash of doc_id gives, and
keeping the k largest keys draws k texts without replacement, in proportion to their weights.

The target model is fitted on at most `most_targets` labelled texts, by order of a hash of doc_id; the raw model counts
every text.  k is the share of target texts among all labels, times the number of rows, unless `share` is given.  The
k-th key is found exactly by counting keys by their leading bits, 16 at a time.

Nulls and edges: null and blank texts have no n-grams and weight 0 (ratio one); without labels the target is the raw
text and all weights are 0; rows that tie with the k-th in key and doc_id are all kept; texts are read whole; an empty
table gives an empty result; only doc_id and text are read, so other columns cannot clash."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shelf, arrow_schema, chunks, signed, utf8
from .words import Words, combine

BUCKETS, MOST_TARGETS, SCALE = 10_000, 20_000, 200.0


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each n-gram."""
    w = Words(texts, lower=False)
    doc = w.doc()
    pair = doc[1:] == doc[:-1]
    two = combine([w.hash[:-1], w.hash[1:]])[pair]
    return np.concatenate([doc, doc[1:][pair]]), (np.concatenate([w.hash, two]) % np.uint64(BUCKETS)).astype(np.int64)


def targets(labels: DataFrame, most: int = MOST_TARGETS) -> DataFrame:
    """doc_id of at most `most` target texts."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def counts(docs: DataFrame, chosen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts by bucket, of the chosen texts and of all."""

    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            texts, is_target = utf8(b.column(0)), np.array(b.column(1).to_pylist(), bool)
            for i, j in chunks([len(t) for t in texts]):
                doc, bucket = ngrams(texts[i:j])
                total[1] += np.bincount(bucket, minlength=BUCKETS)
                total[0] += np.bincount(bucket[is_target[i:j][doc]], minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(BUCKETS), "target": total[0], "raw": total[1]})

    # at most MOST_TARGETS rows, so the chosen side is broadcast
    marked = docs.join(F.broadcast(chosen.withColumn("is_target", F.lit(True))), "doc_id", "left").select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    rows = marked.mapInArrow(run, arrow_schema("bucket bigint, target bigint, raw bigint")).groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect()
    out = np.zeros((2, BUCKETS), np.int64)
    for bucket, target, raw in rows:
        out[:, bucket] = target, raw
    return out[0], out[1]


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, both models smoothed by one."""
    if not target.sum():
        return np.zeros(BUCKETS)
    p, q = raw + 1.0, target + 1.0
    return np.log(q / q.sum()) - np.log(p / p.sum())


def weights(docs: DataFrame, ratio: np.ndarray, scale: float | None = SCALE) -> DataFrame:
    """doc_id, log_ratio, log_weight, key, and place (a long that sorts as key does)."""
    names = ["doc_id", "log_ratio", "log_weight", "key", "place"]

    def run(batches):
        for b in batches:
            texts = utf8(b.column(1))
            sums, out = np.zeros(len(texts)), np.zeros(len(texts))
            for i, j in chunks([len(t) for t in texts]):
                doc, bucket = ngrams(texts[i:j])
                n = np.bincount(doc, minlength=j - i)
                sums[i:j] = np.bincount(doc, ratio[bucket], minlength=j - i)
                out[i:j] = sums[i:j] if scale is None else sums[i:j] / np.maximum(n, 1) * scale
            u = (np.array(b.column(2).to_pylist(), np.int64).view(np.uint64) >> np.uint64(11)).astype(np.float64)
            key = out - np.log(-np.log((u + 0.5) / 2.0**53))
            bits = (key + 0.0).view(np.uint64)
            place = signed(np.where(bits >> np.uint64(63), bits ^ np.uint64(0x7FFFFFFFFFFFFFFF), bits))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums), pa.array(out), pa.array(key), pa.array(place)], names=names)

    at = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return at.withColumn("noise", F.xxhash64("doc_id", F.lit("gumbel"))).mapInArrow(run, arrow_schema("doc_id bigint, log_ratio double, log_weight double, key double, place bigint"))


def kth(weighed: DataFrame, k: int) -> tuple[int, int | None]:
    """place and doc_id of the k-th row by place (descending) and doc_id; each step collects 65,536 counts at most."""
    low, rows = -(1 << 63), weighed
    value, left = F.col("place"), k
    for shift in (48, 32, 16, 0):
        found = rows.groupBy(F.shiftright(value, shift).alias("head")).count().collect()
        for head, n in sorted(((r[0], r[1]) for r in found), reverse=True):
            if left <= n:
                break
            left -= n
        low = head << shift
        rows = rows.filter(value.between(low, low + (1 << shift) - 1))
    value = F.col("doc_id")
    for shift in (48, 32, 16, 0):
        found = rows.filter("doc_id is not null").groupBy(F.shiftright(value, shift).alias("head")).count().collect()
        head = None
        for head, n in sorted((r[0], r[1]) for r in found):
            if left <= n:
                break
            left -= n
        if head is None or left > n:
            return low, None
        rows = rows.filter(value.between(head << shift, (head << shift) + (1 << shift) - 1))
    return low, head


def resample(spark: SparkSession, docs: DataFrame, labels: DataFrame, share: float | None = None, scale: float | None = SCALE, most_targets: int = MOST_TARGETS) -> DataFrame:
    """doc_id, log_ratio, log_weight, key, kept, for every row."""
    shelf = Shelf(spark, "resampling")
    if share is None:
        share = labels.filter("quality is not null").agg(F.avg("quality")).first()[0]
        share = 1.0 if share is None else share
    chosen = shelf.put(targets(labels, most_targets), "targets")
    ratio = log_ratio(*counts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), chosen))
    weighed = shelf.put(weights(docs, ratio, scale), "weights")
    k = math.ceil(share * weighed.count())
    if not k:
        kept = F.lit(False)
    else:
        place, last = kth(weighed, k)
        tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
        kept = (F.col("place") > place) | ((F.col("place") == place) & tied)
    return weighed.select("doc_id", "log_ratio", "log_weight", "key", kept.alias("kept"))
