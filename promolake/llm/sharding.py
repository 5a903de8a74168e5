"""Shards of near equal bytes by the differencing method of Karmarkar and Karp, with groups that are never split.

A partial partition is a vector of k sums, lightest first.  The two with the largest spread are combined again and again, the
lightest place of one with the heaviest of the other, until one is left; its places are the shards.

The heaviest groups come first, as in the method, but bin by bin.  Groups of 1/BIN of all bytes or more (fewer than BIN) are differenced in one
task.  What is left of spread there is dealt out evenly over FAN bins of the next round as an initial partial partition of each; these take
the groups from 1/(BIN * FAN) on, by hash, and deal on to FAN bins each; and so forth until the rest of the groups fits.  Each round levels what the
heavier ones left, no task sees more than about BIN groups, and a group is small beside the share of its bin.  Ties: spreads that
are equal go by the order in which the partitions came (what was dealt out, then groups by weight, heaviest first, then by digest), equal
sums by place; equal places of what was dealt out stand in an order drawn by the bin's number.

A group that is larger than a shard's share stays whole and fills a shard; the others are level with each other.  Rows: a null text is a group
of its own (of size 0 before the charge a row), apart from the empty text; repeated rows are equal texts and stay together; empty tables
give empty results; with fewer groups than shards some shards are empty."""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shelf
from .numbering import numbered

SHARDS = 40
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Groups of a bin, about.
BIN = 8192
#: Bins of the next round that a bin deals its spread out to.
FAN = 32


def difference(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """weights (m, k), each row ascending: the sums of the last partition, ascending, and for each row the place of its every entry.

    A merge of two partitions is kept as the places of their entries in the new one; they are followed back from the last one."""
    m, k = weights.shape
    sums = list(weights)
    heap = [(-int(w[-1] - w[0]), i) for i, w in enumerate(sums)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        order = np.argsort(both, kind="stable")
        to = np.empty(k, np.int16)
        to[order] = np.arange(k, dtype=np.int16)
        merges.append((a, b, to))
        sums[a] = sums[b] = None
        new = both[order]
        heapq.heappush(heap, (-int(new[-1] - new[0]), len(sums)))
        sums.append(new)
    last = heap[0][1]
    place: list[np.ndarray | None] = [None] * len(sums)
    place[last] = np.arange(k, dtype=np.int16)
    for node in range(len(sums) - 1, m - 1, -1):
        a, b, to = merges[node - m]
        own = place[node][to]
        place[node] = None
        place[a], place[b] = own, own[::-1]
    return sums[last], np.stack(place[:m])


def levelled(start: np.ndarray, weights: np.ndarray, bin_: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the shards after start (k sums) and single weights are differenced, and each weight's shard."""
    k = len(start)
    order = np.lexsort((np.random.default_rng(bin_).permutation(k), start))
    all_ = np.zeros((len(weights) + 1, k), np.int64)
    all_[0], all_[1:, -1] = start[order], weights
    sums, places = difference(all_)
    shard = np.empty(k, np.int64)
    shard[places[0]] = order
    out = np.empty(k, np.int64)
    out[shard] = sums
    return out, shard[places[1:, -1]]


def _assigned(shelf: Shelf, groups: DataFrame, k: int, size: int, fan: int) -> DataFrame:
    """groups (digest, weight): digest, shard."""
    n, total = groups.agg(F.count("*"), F.sum("weight")).first()
    rounds = 0
    while n > size * fan**rounds:
        rounds += 1
    of = F.lit(rounds)
    for r in reversed(range(rounds)):
        of = F.when(F.col("weight") >= -(-total // (size * fan**r)), F.lit(r)).otherwise(of)
    groups = shelf.put(groups.withColumn("round", of), "rounds")

    def one(bin_: pd.DataFrame) -> pd.DataFrame:
        number = int(bin_["bin"].iloc[0])
        own = bin_[bin_["digest"].notna()].sort_values(["weight", "digest"], ascending=[False, True])
        sums, shard = levelled(np.array(bin_.loc[bin_["digest"].isna(), "start"].iloc[0], np.int64), own["weight"].to_numpy(np.int64), number)
        rows = pd.DataFrame({"bin": number, "digest": own["digest"], "shard": shard, "sums": None})
        return pd.concat([rows, pd.DataFrame({"bin": [number], "digest": [None], "shard": [None], "sums": [sums.tolist()]})])

    start = groups.sparkSession.range(1).select(F.lit(0).cast("long").alias("bin"), F.array_repeat(F.lit(0).cast("long"), k).alias("start"))
    made = []
    for r in range(rounds + 1):
        own = groups.where(F.col("round") == r).select(F.pmod(F.crc32("digest"), F.lit(fan**r)).alias("bin"), "digest", "weight")
        both = own.unionByName(start, allowMissingColumns=True)
        done = shelf.put(both.groupBy("bin").applyInPandas(one, "bin long, digest binary, shard int, sums array<long>"), "levelled")
        made.append(done.where("digest is not null").select("digest", "shard"))
        below = done.where("digest is null").select("bin", "sums", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))).alias("child"))
        start = below.select((F.col("bin") * fan + F.col("child")).alias("bin"), F.transform("sums", lambda x: F.floor(x / F.lit(fan)) + F.when(F.pmod(x, F.lit(fan)) > F.col("child"), 1).otherwise(0)).alias("start"))
    return reduce(DataFrame.unionByName, made)


def shards(spark: SparkSession, rows: DataFrame, k: int = SHARDS, size: int = BIN, fan: int = FAN) -> DataFrame:
    """rows (digest binary, size long, ...): the rows with shard (0 to k - 1) and slot (long, 0, 1, ... within the shard).

    Rows of one digest are a group and share a shard.  Slots follow the rows' other columns in their order."""
    if k < 1 or size < 2 or fan < 2:
        raise ValueError("there is a shard at least, a bin of two groups and two bins to deal out to")
    shelf = Shelf(spark, "sharding")
    given = shelf.put(rows, "rows")
    groups = shelf.put(given.groupBy("digest").agg(F.sum("size").alias("weight")), "groups")
    if k == 1 or groups.limit(1).count() == 0:
        to = groups.select("digest", F.lit(0).alias("shard"))
    else:
        to = _assigned(shelf, groups, k, size, fan)
    to = shelf.put(to.select("digest", F.col("shard").cast("int").alias("shard")), "to")
    dealt = shelf.put(given.join(to, "digest"), "dealt_rows")
    others = [c for c in rows.columns if c not in ("digest", "size")]
    placed = numbered(shelf, dealt, "shard", *others)
    return placed.select(*rows.columns, "shard", F.col("pos").alias("slot"))


def documents_shards(spark: SparkSession, docs: DataFrame, k: int = SHARDS, size: int = BIN, fan: int = FAN) -> DataFrame:
    """Every document in a shard: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law holds for one number of shards)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.unhex(F.sha2(F.when(F.col("text").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "text")), 256)).alias("digest"),
    )
    out = shards(spark, rows, k, size, fan)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
