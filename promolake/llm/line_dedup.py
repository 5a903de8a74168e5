"""Line deduplication by a segment-partition edit join.

Lines (parts of a text between line feeds, without white space at their ends) that are not empty are compared over all
documents; equal ones form one class, whatever their length.  Two classes link when their edit distance is within the
reach of the shorter one: no edit below 20 characters, where words and numbers that have nothing to do with each other are
as near, one below 40, two from there on (REACH).  Every line of 20 characters or more is split
into one segment more than the largest reach, and the index holds each segment by its content, number and the line's length: of that many edits
one segment at least is spared, so a line within reach has an equal substring at a fitting place.  A line probes the
index of its own and of smaller lengths within reach with the substrings that the positions of the remaining edits allow
on both sides.  Pairs whose characters or pairs of characters differ too much in number (parity in 24 and 64 groups,
lower bounds) fall out in the join; the others are verified by banded bit-parallel edit distance.  Of all lines that
links connect, in chains too, the first (by doc_id and line number) stays; the others go from their texts.

Nulls and edges: null and blank texts have no lines and come back as they are; blank lines stay; a null doc_id comes
before all others; rows that repeat doc_id and text are one document that appears more than once; texts are read whole;
an empty table gives an empty result; all columns are kept under their names, but for n_lines and n_removed, which give
way to the result's.  No number of partners is capped: a group of m like lines is joined pair by pair."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, Rows, Shelf, arrow_schema, chunks, signed, small_enough
from .components import components
from .words import mix, running, span_hash

#: The least characters of a line for one edit, for two, and so on.
REACH = (20, 40)
_SPACE = " \t\n\x0b\x0c\r"
_CODE = np.random.default_rng(41).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_GROUP = (_CODE >> np.uint64(20)).astype(np.int64) % 24
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _of_point(points: np.ndarray, table: np.ndarray, of_rare) -> np.ndarray:
    """Table values of characters; those beyond the table by their mixed number."""
    out = table[np.minimum(points, len(table) - 1)]
    rare = np.flatnonzero(points >= len(table))
    if len(rare):
        out[rare] = of_rare(mix(points[rare].astype(np.uint64)))
    return out


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Number and content of each line that is compared."""
    return [(k, s) for k, x in enumerate(text.split("\n")) if (s := x.strip(_SPACE))] if text else []


def segments(n: np.ndarray, edits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Starts and lengths of the segments of lines of n characters; the last ones are longer where n does not divide."""
    short, k = n // (edits + 1), n % (edits + 1)
    sizes = [short + (i >= edits + 1 - k) for i in range(edits + 1)]
    starts = [sum(sizes[:i], np.zeros_like(n)) for i in range(edits + 1)]
    return starts, sizes


class Lines:
    """Hash of each line, keys of its segments and of its probes: 40 bits of the content's hash, 24 of parity."""

    def __init__(self, lines: list[str], reach: tuple[int, ...] = REACH, keys: bool = True):
        edits, least = len(reach), max(reach[0], len(reach) + 1)
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = np.fromiter(map(len, lines), np.int64, len(lines))
        first = np.concatenate([[0], np.cumsum(n)])
        weight = _of_point(points, _CODE, lambda p: p)
        sums = running(weight)
        self.hash = span_hash(sums, first[:-1], first[1:])
        if not keys or not len(lines):
            self.index, self.probes, self.pairs = np.zeros((len(lines), 0), np.uint64), np.zeros((len(lines), 0), np.uint64), np.zeros(len(lines), np.uint64)
            return
        owner = np.repeat(np.arange(len(n)), n)
        group = _of_point(points, _GROUP, lambda p: (p % np.uint64(24)).astype(np.int64))
        odd = np.bincount(owner * 24 + group, minlength=24 * len(n)).reshape(-1, 24) & 1
        parity = (odd << np.arange(24)).sum(1).astype(np.uint64)
        #: Parity of the pairs of neighbouring characters, of which an edit changes four at most.
        within_line = owner[1:] == owner[:-1]
        group = ((weight[:-1] * _LEFT + weight[1:] * _RIGHT) >> np.uint64(58)).astype(np.int64)
        odd = np.bincount((owner[:-1] * 64 + group)[within_line], minlength=64 * len(n)).reshape(-1, 64) & 1
        self.pairs = (odd.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)

        def key(start: np.ndarray, size: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
            h = mix(span_hash(sums, start, start + size) ^ (length.astype(np.uint64) * np.uint64(0x9E3779B1) + np.uint64(i)))
            return (h & ~np.uint64(0xFFFFFF)) | parity

        # lines without an edit within reach have no keys (0)
        starts, sizes = segments(n, edits)
        self.index = np.stack([np.where(n >= least, key(first[:-1] + s, m, n, i), np.uint64(0)) for i, (s, m) in enumerate(zip(starts, sizes, strict=True))], 1)
        probes = []
        for less in range(edits + 1):
            length = np.maximum(n - less, 0)
            starts, sizes = segments(length, edits)
            for i, (s, m) in enumerate(zip(starts, sizes, strict=True)):
                low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
                for shift in range(low, high + 1):
                    at = s + shift
                    k = key(first[:-1] + np.clip(at, 0, n - m), m, length, i)
                    probes.append(np.where((length >= least) & (at >= 0) & (at + m <= n), k, np.uint64(0)))
        self.probes = np.stack(probes, 1)


def _batches_of_lines(texts: list[str | None]):
    """Document index, line number and content of the lines of some texts, in parts of bounded size."""
    for i, j in chunks([max(4 * len(t), 160 * t.count("\n")) if t else 0 for t in texts]):
        yield [(d, k, s) for d in range(i, j) for k, s in lines_of(texts[d])]


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, th, line, h of each line."""

    def run(batches):
        for b in batches:
            for rows in _batches_of_lines(b.column(1).to_pylist()):
                own = pa.array([r[0] for r in rows], pa.int64())
                h = Lines([r[2] for r in rows], keys=False).hash
                yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(2).take(own), pa.array([r[1] for r in rows], pa.int32()), pa.array(signed(h))], names=["doc_id", "th", "line", "h"])

    return docs.mapInArrow(run, arrow_schema("doc_id bigint, th bigint, line int, h bigint"))


def keyed(docs: DataFrame, reach: tuple[int, ...]) -> DataFrame:
    """h, parity of pairs, index and probe keys of the lines, each line once in a batch."""

    def run(batches):
        for b in batches:
            for rows in _batches_of_lines(b.column(0).to_pylist()):
                distinct = list(dict.fromkeys(r[2] for r in rows))
                x = Lines(distinct, reach)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(signed(k.ravel())), k.shape[1]).cast(pa.list_(pa.int64())) if len(distinct) else pa.array([], pa.list_(pa.int64())) for k in (x.index, x.probes)]
                yield pa.RecordBatch.from_arrays([pa.array(signed(x.hash)), pa.array(signed(x.pairs)), *lists], names=["h", "pairs", "index", "probes"])

    return docs.select("text").mapInArrow(run, arrow_schema("h bigint, pairs bigint, index array<bigint>, probes array<bigint>"))


def edits_of(n: int, reach: tuple[int, ...] = REACH) -> int:
    """The edits within the reach of a line of n characters."""
    return sum(n >= least for least in reach)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most `edits`: common ends off, then a band of 2 * edits + 1 diagonals as bits."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    low, most = 0, min(len(a), len(b))
    while low < most and a[low] == b[low]:
        low += 1
    high = 0
    while high < most - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) <= edits
    if len(a) == 1:
        return len(b) - (a in b) <= edits
    # bit d of the band stands for the row j + d - edits of column j; vp and vn are its vertical differences
    width = 2 * edits + 1
    full = (1 << width) - 1
    m, n = len(a), len(b)
    # `here` is the distance on the lowest row of the band, or on a's last row where the band reaches below it
    vp, vn, here = full & ~((1 << edits) - 1), 0, min(edits, m)
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    for j, c in enumerate(b):
        at = places.get(c, 0)
        shift = j - edits
        match = (at >> shift if shift >= 0 else at << -shift) & full
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if j + edits < m:  # the lowest row moves along the diagonal
            here += not (d0 >> (width - 1)) & 1
            least = here - (n - m + edits)
        else:  # the lowest row is the last one of a; it moves to the right
            row = m - 1 - shift
            if row < 0:
                return False
            here += (hp >> row) & 1
            here -= (hn >> row) & 1
            least = here - (n - 1 - j)
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
        if least > edits:  # a column lowers it by one at most
            return False
    return here <= edits


def _verified(shelf: Shelf, docs: DataFrame, found: DataFrame, pairs: DataFrame, reach: tuple[int, ...]) -> DataFrame:
    """The pairs (a, b) of line hashes whose lines are within the reach of the shorter one."""
    needed = shelf.put(pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct(), "needed")
    where = found.join(needed, "h", "left_semi").groupBy("h").agg(F.min(F.struct("doc_id", "th")).alias("at")).select("at.*").distinct()
    where = shelf.put(where.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "where")
    side = F.broadcast(where) if small_enough(where, BROADCAST_ROWS) else where
    texts = docs.join(side, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def run(batches):
        for b in batches:
            for rows in _batches_of_lines(b.column(0).to_pylist()):
                distinct = list(dict.fromkeys(r[2] for r in rows))
                yield pa.RecordBatch.from_arrays([pa.array(signed(Lines(distinct, keys=False).hash)), pa.array(distinct, pa.string())], names=["h", "content"])

    content = texts.mapInArrow(run, arrow_schema("h bigint, content string")).join(needed, "h", "left_semi").dropDuplicates(["h"])
    content = shelf.put(content, "content")
    both = pairs.join(content.select(F.col("h").alias("a"), F.col("content").alias("x")), "a").join(content.select(F.col("h").alias("b"), F.col("content").alias("y")), "b")

    def check(batches):
        for b in batches:
            ok = pa.array([within(x, y, edits_of(min(len(x), len(y)), reach)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(ok)

    return both.select("a", "b", "x", "y").mapInArrow(check, arrow_schema("a bigint, b bigint"))


def pairs_of(shelf: Shelf, docs: DataFrame, reach: tuple[int, ...]) -> DataFrame:
    """Candidate pairs (a < b) of line hashes."""
    edits = len(reach)
    keys = shelf.put(keyed(docs, reach), "keys")
    part = lambda c: keys.select("h", "pairs", F.explode(c).alias("k"))
    index, probe = part("index").filter("k <> 0").distinct(), part("probes").filter("k <> 0")
    differ = F.bit_count(F.col("l.k").bitwiseXOR(F.col("r.k")).bitwiseAND(F.lit(0xFFFFFF))) <= 2 * edits
    differ &= F.bit_count(F.col("l.pairs").bitwiseXOR(F.col("r.pairs"))) <= 4 * edits
    # the key is part of k and not a column of its own, as that would be shuffled too
    same = F.shiftrightunsigned("l.k", 24) == F.shiftrightunsigned("r.k", 24)
    found = index.alias("l").join(probe.alias("r"), same & (F.col("l.h") != F.col("r.h")) & differ)
    out = shelf.put(found.select(F.least("l.h", "r.h").alias("a"), F.greatest("l.h", "r.h").alias("b")).distinct(), "pairs")
    shelf.drop(keys)
    return out


def removals(spark: SparkSession, docs: DataFrame, reach: tuple[int, ...] = REACH) -> DataFrame:
    """docs: doc_id (long), text, th (hash of the text).  For each (doc_id, th) the numbers of the lines that go."""
    shelf = Shelf(spark, "line_dedup")
    found = shelf.put(occurrences(docs.select("doc_id", "text", "th")), "lines")
    pairs = pairs_of(shelf, docs, reach)
    links = shelf.put(_verified(shelf, docs, found, pairs, reach), "links")
    roots = components(shelf, links).withColumnRenamed("node", "h")
    # equal lines are one class; only classes with more than one occurrence or a link matter from here on
    classes = found.groupBy("h").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("times")).join(roots, "h", "left")
    classes = shelf.put(classes.filter("times > 1 or root is not null").withColumn("root", F.coalesce("root", "h")), "classes")
    firsts = classes.groupBy("root").agg(F.min("first").alias("keep"))
    of_line = shelf.put(classes.select("h", "root").join(firsts, "root").select("h", F.col("keep.doc_id").alias("k_id"), F.col("keep.line").alias("k_line")), "firsts")
    gone = found.join(of_line, "h").filter(~(F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("line") == F.col("k_line"))))
    return gone.groupBy("doc_id", "th").agg(F.collect_set("line").alias("gone"))


def deduplicated(spark: SparkSession, docs: DataFrame, reach: tuple[int, ...] = REACH) -> DataFrame:
    """All columns of docs with n_lines, n_removed (of the lines compared), and the text that is left."""
    rows = Rows(docs, "n_lines", "n_removed")
    doc_id, text = rows.at("doc_id"), rows.at("text")
    key = rows.df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    gone = removals(spark, key, reach)
    same = (F.xxhash64(F.col(text).cast("string")) == F.col("th")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("doc_id"))
    joined = rows.df.join(gone, same, "left").select(*rows.df.columns, "gone")
    at = rows.df.columns.index(text)
    schema = T.StructType([T.StructField(f.name, T.StringType() if k == at else f.dataType) for k, f in enumerate(rows.df.schema)])
    schema = schema.add("n_lines", T.LongType()).add("n_removed", T.LongType())

    def run(batches):
        for b in batches:
            texts, counts, sizes = [], [], []
            for t, g in zip(b.column(at).to_pylist(), b.column(len(b.columns) - 1).to_pylist(), strict=True):
                drop = set(g or ())
                counts.append(len(lines_of(t)))
                sizes.append(len(drop))
                texts.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop) if drop else t)
            cols = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=schema.names)

    return rows.back(joined.mapInArrow(run, schema), "n_lines", "n_removed")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text that is left; null as empty)."""
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
