"""Suffix-array deduplication with a run-length index.

Every byte goes that a string of LENGTH bytes covers which also starts anywhere else; texts are UTF-8 bytes and matches
stay within documents.

Which strings to compare: each window of LENGTH bytes picks the least hash among its GRAM-byte runs (the leftmost of
equal ones).  Equal windows pick the same run at the same place, so only occurrences of one picked run (an anchor) can
match.  The windows that pick an occurrence form its fragment.  Anchors that occur once are done.  Of the others,
occurrences with equal fragments repeat as a whole.  A fragment that is alone, but whose anchor is not, goes with one
copy of each other fragment of that anchor to an index: a run-compressed Burrows-Wheeler transform of these fragments
with samples at run heads and run ends.  The samples hold suffix positions and the lengths of their matches with the
neighbouring suffixes; matching statistics of all positions are streamed from the nearest sample before them, and
positions with LENGTH or more are marked.

A group of more than GROUP fragments (a passage before ever new text) would make one task large, so it is dealt on.
Each fragment is split by where its anchor stands in the window, into two halves of these offsets; the bytes that all
windows of a half have in common, which are more than the anchor, tell the new groups apart.  Equal halves repeat as a
whole, groups that are small enough go to the index, others are split again; at a single offset the group is the window.

Nulls and edges: a null text counts as empty; texts shorter than LENGTH lose nothing; texts of any length are read in
parts of bounded size; periodic text repeats within its own document and goes; rows that repeat are further occurrences,
also with one doc_id; null ids are allowed; an empty table gives an empty result; only doc_id and text are read, so
other columns cannot clash."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Shelf, arrow_schema, chunks, signed, small_enough, utf8
from .words import byte_sums, mix, span_hash

LENGTH, GRAM, GROUP = 200, 100, 2000
#: Bytes of fragments that one index is built over, and of a text that are looked at together.
INDEX_BYTES, PART_BYTES = 1_000_000, 4_000_000
#: Occurrences of one key that are taken out of a join; such keys are few.
HOT = 20_000
_PLACE = np.uint64((1 << 28) - 1)


class Anchors:
    """Of some texts: text, hash, fragment hash, fragment start and end (in the text) and place in it of each anchor."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        buf = np.frombuffer(b"".join(texts), np.uint8)
        windows = np.maximum(sizes - length + 1, 0)
        empty = np.empty(0, np.int64)
        self.doc, self.hash, self.fragment, self.start, self.end, self.place = empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
        if not windows.sum():
            return
        sums = byte_sums(buf)
        at = np.arange(len(buf) - gram + 1)
        h = span_hash(sums, at, at + gram)
        span = length - gram + 1
        packed = (h & ~_PLACE) | at.astype(np.uint64)
        pad = -len(packed) % span
        blocks = np.concatenate([packed, np.full(pad, ~np.uint64(0))]).reshape(-1, span)
        left = np.minimum.accumulate(blocks, 1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(right[: len(buf) - length + 1], left[span - 1 : span - 1 + len(buf) - length + 1])
        doc = np.repeat(np.arange(len(texts)), windows)
        w = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[:-1][doc]
        place = (least[w] & _PLACE).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
        last = np.append(heads[1:], len(w)) - 1
        start, end, anchor = w[heads], w[last] + length, place[heads]
        self.doc, self.hash = doc[heads], h[anchor]
        self.fragment = mix(span_hash(sums, start, end) ^ (anchor - start).astype(np.uint64))
        self.start, self.end, self.place = start - offsets[:-1][self.doc], end - offsets[:-1][self.doc], anchor - start


class RunIndex:
    """Run-compressed transform of some fragments: samples at run heads and run ends.

    A suffix position that is no run head has a match with its predecessor that is one shorter than that of the position
    before it, and likewise for run ends and successors; so the samples determine the matches of all positions."""

    def __init__(self, fragments: list[bytes]):
        sizes = np.array([len(f) for f in fragments])
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8).astype(np.int64) + len(fragments) + 1
        text[self.first[1:] - 1] = np.arange(len(fragments))  # ends of fragments differ
        n, top = len(text), int(sizes.max(initial=0)) + 1
        # ranks by prefixes of doubling length, until all differ
        order = np.argsort(text, kind="stable")
        rank = np.empty(n, np.int64)
        same = np.concatenate([[0], np.cumsum(text[order][1:] != text[order][:-1])])
        rank[order] = same
        k, ranks = 1, [rank]
        while same[-1] < n - 1 and k < 2 * top:
            key = rank << 32
            key[:-k] |= rank[k:] + 1
            order = np.argsort(key)
            same = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = same
            k *= 2
            ranks.append(rank)
        bwt = text[order - 1]
        head = np.concatenate([[True], bwt[1:] != bwt[:-1]])
        end = np.concatenate([head[1:], [True]])
        self.runs = int(head.sum())
        self.n = n

        def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """Length of the common prefix of suffixes, from the ranks by doubling lengths."""
            out = np.zeros(len(x), np.int64)
            for j in range(len(ranks) - 1, -1, -1):
                a, b = np.minimum(x + out, n - 1), np.minimum(y + out, n - 1)
                out += (ranks[j][a] == ranks[j][b]) * (1 << j)
            return out

        heads, ends = np.flatnonzero(head), np.flatnonzero(end)
        self.heads = self._samples(order[heads], np.where(heads > 0, common(order[heads], order[heads - 1]), 0))
        self.ends = self._samples(order[ends], np.where(ends < n - 1, common(order[ends], order[np.minimum(ends + 1, n - 1)]), 0))

    @staticmethod
    def _samples(place: np.ndarray, match: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(place)
        return place[by], match[by]

    def statistics(self) -> np.ndarray:
        """Of each position, the longest match of the text from there with text from any other position."""
        at = np.arange(self.n)
        out = np.zeros(self.n, np.int64)
        for place, match in (self.heads, self.ends):
            k = np.searchsorted(place, at, "right") - 1
            out = np.maximum(out, np.where(k >= 0, match[k] - (at - place[k]), 0))
        return out

    def marked(self, length: int) -> list[np.ndarray]:
        """Of each fragment, the positions from which `length` bytes also stand elsewhere."""
        hit = np.flatnonzero(self.statistics() >= length)
        cut = np.searchsorted(hit, self.first)
        return [hit[a:b] - f for a, b, f in zip(cut[:-1].tolist(), cut[1:].tolist(), self.first.tolist(), strict=False)]


def anchors_of(texts: list[bytes]) -> list[np.ndarray]:
    """text, hash, fragment hash, start, end, place of all anchors; a long text part by part, each window in one part."""
    out = []
    for first in range(0, max(1, max(map(len, texts), default=0) - LENGTH + 1), PART_BYTES):
        x = Anchors([t[first : first + PART_BYTES + LENGTH - 1] for t in texts] if first or len(texts) == 1 else texts)
        out.append([x.doc, x.hash, x.fragment, x.start + first, x.end + first, x.place])
        if len(texts) > 1:  # texts are together only if they are short
            break
    return [np.concatenate([o[k] for o in out]) for k in range(6)]


_MEASURED = "uid bigint, k bigint, doc_id bigint, n_bytes bigint, sha string, a array<bigint>, f array<bigint>, s array<int>, e array<int>, p array<int>"


def measured(docs: DataFrame) -> DataFrame:
    """A row for each document, with its anchors; docs: doc_id, text, k."""

    def run(batches):
        names = [x.split()[0] for x in _MEASURED.split(", ")]
        uid = TaskContext.get().partitionId() << 36
        for b in batches:
            texts = utf8(b.column(1))
            for i, j in chunks([len(t) for t in texts]):
                n = j - i
                doc, a, f, start, end, place = anchors_of(texts[i:j])
                cut = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(v)) for v in (signed(a), signed(f), start.astype(np.int32), end.astype(np.int32), place.astype(np.int32))]
                sha = pa.array([hashlib.sha256(t).hexdigest() for t in texts[i:j]])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + n)), b.column(2).slice(i, n), b.column(0).slice(i, n), pa.array([len(t) for t in texts[i:j]], pa.int64()), sha, *lists], names=names)
                uid += n

    return docs.select("doc_id", "text", "k").mapInArrow(run, arrow_schema(_MEASURED))


_PIECES = "g bigint, f bigint, uid bigint, s int, p int, lo int, hi int, body binary"
_PIECE_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _PIECE_KINDS, strict=True)], names=[x.split()[0] for x in _PIECES.split(", ")])


def fragments(texts: DataFrame) -> DataFrame:
    """The pieces that `want` (array of a, f, uid, s, e, p) names; texts: text, want."""
    last = LENGTH - GRAM

    def run(batches):
        for b in batches:
            for t, ws in zip(utf8(b.column(0)), b.column(1).to_pylist(), strict=True):
                yield _pieces([(w["a"], w["f"], w["uid"], w["s"], w["p"], 0, last, t[w["s"] : w["e"]]) for w in ws])

    return texts.mapInArrow(run, arrow_schema(_PIECES))


def halves(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Each piece as two: the windows with their anchor in the lower and in the upper half of the offsets lo to hi."""

    def of(g: int, uid: int, s: int, p: int, lo: int, hi: int, body: bytes):
        first, last = max(0, p - hi), min(len(body) - length, p - lo)
        if first > last:
            return
        sums = byte_sums(np.frombuffer(body, np.uint8))
        # all windows of the half have the bytes from p - lo on, up to where the earliest one may end
        at = np.array([p - lo, first])
        common, whole = span_hash(sums, at, np.array([p + length - hi, last + length]))
        with np.errstate(over="ignore"):
            new = mix(np.array([np.uint64(g & (1 << 64) - 1) * np.uint64(0x9E3779B97F4A7C15) + common + np.uint64(lo), whole ^ np.uint64(p - first)]))
        yield (*signed(new).tolist(), uid, s + first, p - first, lo, hi, body[first : last + length])

    def run(batches):
        for b in batches:
            rows = []
            for g, uid, s, p, lo, hi, body in zip(*(b.column(k).to_pylist() for k in range(7)), strict=True):
                mid = (lo + hi) // 2
                rows += of(g, uid, s, p, lo, mid, body)
                if hi > mid:
                    rows += of(g, uid, s, p, mid + 1, hi, body)
            yield _pieces(rows)

    return pieces.select("g", "uid", "s", "p", "lo", "hi", "body").mapInArrow(run, arrow_schema(_PIECES))


def indexed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """uid, s, e of the byte ranges that an index marks; pieces: sorted by g within partitions."""

    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        index = RunIndex([r[3] for r in rows])
        out: list[tuple[int, int, int]] = []
        for (_, uid, s, _), hit in zip(rows, index.marked(length), strict=True):
            if len(hit):
                breaks = np.flatnonzero(np.diff(hit) > 1)
                for x, y in zip(np.append(hit[0], hit[breaks + 1]), np.append(hit[breaks], hit[-1]), strict=True):
                    out.append((uid, s + int(x), s + int(y) + length))
        cols = list(zip(*out, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["uid", "s", "e"])

    def run(batches):
        held: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if size > INDEX_BYTES and row[0] != held[-1][0]:  # whole groups only
                    yield resolve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield resolve(held)

    return pieces.select("g", "uid", "s", "body").mapInArrow(run, arrow_schema("uid bigint, s int, e int"))


def those_with(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is among keys (with `times`, its number of rows).

    Keys with very many rows are looked up in a broadcast, if they are few, so that no task gets all rows of one key."""
    if small_enough(keys, BROADCAST_ROWS):
        return rows.join(F.broadcast(keys.select(*on)), on, "left_semi")
    hot = keys.filter(F.col("times") > HOT).select(*on)
    if not small_enough(hot, BROADCAST_ROWS):
        return rows.join(keys.select(*on), on, "left_semi")
    hot = F.broadcast(hot)
    return rows.join(hot, on, "left_semi").unionByName(rows.join(hot, on, "left_anti").join(keys.filter(F.col("times") <= HOT).select(*on), on, "left_semi"))


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _open_groups(kinds: DataFrame, g: str) -> DataFrame:
    """Groups that something is to be found in: several kinds of pieces, of which one at least is alone."""
    return kinds.groupBy(g).agg(F.count("*").alias("pieces"), F.min("times").alias("least")).filter("pieces > 1 and least = 1").select(g, "pieces")


def spans_of(spark: SparkSession, docs: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, text, k), their measures, and the removed byte ranges (uid, s, e); k stands for id and text."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("k", F.xxhash64("doc_id", F.xxhash64("text"), F.col("doc_id").isNull()))
    rows = shelf.put(measured(docs), "rows")
    all_ = rows.select("uid", F.explode(F.arrays_zip("a", "f", "s", "e", "p")).alias("x")).select("x.a", "x.f", "uid", "x.s", "x.e", "x.p")
    # anchors that occur more than once, then their occurrences
    repeated = shelf.put(all_.groupBy("a").agg(F.count("*").alias("times")).filter("times > 1"), "repeated")
    found = shelf.put(those_with(all_, repeated, ["a"]), "found")
    kinds = shelf.put(found.groupBy("a", "f").agg(F.count("*").alias("times"), F.min(F.struct("uid", "s", "e", "p")).alias("one")), "kinds")
    spans = those_with(found.select("a", "f", "uid", "s", "e"), kinds.filter("times > 1").select("a", "f", "times"), ["a", "f"]).select("uid", "s", "e")
    # anchors with a lone fragment: one copy of each of their fragments
    wanted = kinds.join(_open_groups(kinds, "a"), "a").select("a", "f", "one.*", F.col("pieces") > GROUP)
    wanted = shelf.put(wanted.toDF("a", "f", "uid", "s", "e", "p", "large"), "wanted")
    per = wanted.groupBy("uid").agg(F.collect_list(F.struct("a", "f", "uid", "s", "e", "p")).alias("want")).join(rows.select("uid", "k"), "uid")
    per = shelf.put(per.select("k", "want"), "per")
    pieces = shelf.put(fragments(docs.join(per, "k").select("text", "want")).dropDuplicates(["g", "f"]), "pieces")
    large = wanted.filter("large").select(F.col("a").alias("g")).distinct()
    while not large.isEmpty():
        some = F.broadcast(large) if small_enough(large, BROADCAST_ROWS) else large
        small = pieces.join(some, "g", "left_anti")
        split = shelf.put(halves(pieces.join(some, "g", "left_semi")), "halves")
        kinds = shelf.put(split.groupBy("g", "f").agg(F.count("*").alias("times")), "kinds")
        spans = spans.unionByName(those_with(split.select("g", "f", "uid", "s", (F.col("s") + F.length("body")).alias("e")), kinds.filter("times > 1"), ["g", "f"]).select("uid", "s", "e"))
        groups = shelf.put(_open_groups(kinds, "g"), "groups")
        some = F.broadcast(groups) if small_enough(groups, BROADCAST_ROWS) else groups
        pieces = shelf.put(small.unionByName(split.join(some.select("g"), "g", "left_semi").dropDuplicates(["g", "f"])), "pieces")
        large = groups.filter(F.col("pieces") > GROUP).select("g")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = shelf.put(indexed(pieces.select("g", "f", "uid", "s", "body").repartition(parts, "g").sortWithinPartitions("g", "f")), "marked")
    return docs, rows, spans.unionByName(marked)


def removed(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed byte ranges)."""
    shelf = Shelf(spark, "suffix_runs")
    docs, rows, spans = spans_of(spark, docs, shelf)
    runs = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def merge(batches):
        for b in batches:
            merged = [union_of([(x["s"], x["e"]) for x in xs]) for xs in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[{"s": s, "e": e} for s, e in m] for m in merged], runs)], names=["uid", "spans"])

    kind = "array<struct<s:int,e:int>>"
    per = spans.groupBy("uid").agg(F.collect_list(F.struct("s", "e")).alias("all")).mapInArrow(merge, arrow_schema("uid bigint, spans array<struct<s:int,e:int>>"))
    per = shelf.put(per.join(rows.select("uid", "k"), "uid"), "spans")

    def cut(batches):
        for b in batches:
            texts, out = utf8(b.column(1)), []
            for t, xs in zip(texts, b.column(2).to_pylist(), strict=True):
                kept, at = hashlib.sha256(), 0
                for x in xs:
                    kept.update(t[at : x["s"]])
                    at = x["e"]
                kept.update(t[at:])
                out.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["k", "kept_sha256"])

    # rows that repeat have the same ranges, so one of them speaks for all
    one = per.groupBy("k").agg(F.first("spans").alias("spans"))
    kept = docs.join(one, "k").select("k", "text", "spans").mapInArrow(cut, arrow_schema("k bigint, kept_sha256 string")).dropDuplicates(["k"])
    out = rows.select("uid", "k", "doc_id", "n_bytes", "sha").join(per.select("uid", "spans"), "uid", "left").join(kept, "k", "left")
    n_removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + x["e"] - x["s"])
    return out.select("doc_id", "n_bytes", F.coalesce(n_removed, F.lit(0)).alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "spans")
