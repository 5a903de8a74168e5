"""N-gram Jaccard join, size-aware: subsets for light sets, inverted lists for heavy ones.

A document's set holds hashes of its distinct runs of SHINGLE words.  Documents with equal sets form one class, which
stands for them from then on.  Two classes link when 100 * intersection >= percent * union (PERCENT unless given).

Light sets (fewer than `boundary` shingles, by `light_sizes` 17 at most at 90 percent and 7 at 80): such a set can only
link with one that has one shingle more or less, so each enumerates its subsets of size n - 1 and itself, and equal
subsets are links.  Heavy sets: each enters the inverted lists of its n - ceil(percent / 100 * n) + 1 rarest shingles, of
which linked sets share one at least; lists are scanned for pairs.  The boundary is where enumerating gets dearer than scanning and verifying (`boundary_of`).

Rarity is by a sketch of fixed size that counts every shingle of every document, so passages that many documents share
do not make long lists; among shingles that the sketch does not tell apart, longer ones come first.  Pairs in a list must be of fitting size, and the parity of their shingles in 256 groups, which
bounds their difference from below, must allow a link; that test is exact in what it drops.  First each list's pairs
with one member (and lists of two) are verified and components built; then all other pairs of different components.
What is left is tested by parity in more groups than shingles, and then set by set.  No list
and no group is ever collected.

Nulls and edges: null and blank texts have an empty set and link with nothing; fewer words than SHINGLE make one
shingle; equal texts always share a class; rows with null doc_id have their class's component; a class of null ids only
has a null component; repeated rows are one class; texts are read whole; an empty table gives an empty result.  Only
doc_id and text are read; `keep_one` returns all columns under their names.  Set identity rests on 64-bit sums of mixed
hashes and the size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Rows, Shelf, arrow_schema, chunks, signed, small_enough, utf8
from .components import components
from .words import Words, mix, shingle_sizes, shingles

SHINGLE, PERCENT = 3, 90
SLOTS, BLOCK = 1 << 18, 1 << 12
_SALT, _SUBSET = np.uint64(0x632BE59BD9B4E019), np.uint64(0x2545F4914F6CDD1D)


class Sets:
    """Distinct shingles of some texts, in order of text and hash."""

    def __init__(self, texts: list[bytes], k: int):
        words = Words(texts)
        doc, h = shingles(words, k)
        order = np.lexsort((h, doc))
        self.length = shingle_sizes(words, k)[order]
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.doc, self.hash, self.length = doc[new], h[new], self.length[new]
        self.size = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.mixed = mix(self.hash ^ _SALT)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.mixed)])
        self.id = sums[self.first[1:]] - sums[self.first[:-1]]

    def parity(self) -> list[np.ndarray]:
        """256 bits for each text: whether its shingles in a group are odd in number."""
        group = (self.mixed >> np.uint64(56)).astype(np.int64)
        odd = np.bincount(self.doc * 256 + group, minlength=len(self.size) * 256).reshape(-1, 4, 64) & 1
        return [(odd[:, k].astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64) for k in range(4)]

    def fine_parity(self) -> list[bytes]:
        """The same in the least power of two of groups that is twice the size; halves of groups add up to coarser ones."""
        out = []
        for m, a, b in zip(self.size.tolist(), self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            bits = max(8, (2 * m - 1).bit_length())
            group = (self.mixed[a:b] >> np.uint64(64 - bits)).astype(np.int64)
            out.append(np.packbits((np.bincount(group, minlength=1 << bits) & 1).astype(np.uint8)).tobytes())
        return out


def differ_by(x: bytes, y: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has."""
    while len(x) != len(y):
        long = np.unpackbits(np.frombuffer(max(x, y, key=len), np.uint8)).reshape(-1, 2)
        folded = np.packbits(long[:, 0] ^ long[:, 1]).tobytes()
        x, y = min(x, y, key=len), folded
    return (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_count()


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 18)).astype(np.int64)


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def light_sizes(percent: int = PERCENT) -> tuple[int, int]:
    """The least size that links with a set of one shingle more (n / (n + 1) allows it), and the least that links with a
    set that differs otherwise (n / (n + 2) does, which it does before (n - 1) / (n + 1))."""
    return -(-percent // (100 - percent)), -(-2 * percent // (100 - percent))


_MEASURED = "doc_id bigint, th bigint, n bigint, id bigint, p0 bigint, p1 bigint, p2 bigint, p3 bigint, fine binary, block int, part int, counts binary"


def measured(docs: DataFrame, k: int) -> DataFrame:
    """A row for each document (n, id, parity), and for each task rows with its part of the sketch."""

    def run(batches):
        names = [x.split()[0] for x in _MEASURED.split(", ")]
        sketch = np.zeros(SLOTS, np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            texts = utf8(b.column(1))
            for i, j in chunks([len(t) for t in texts]):
                s = Sets(texts[i:j], k)
                sketch += np.bincount(slot(s.hash), minlength=SLOTS)
                null = [pa.nulls(j - i, t) for t in (pa.int32(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(s.size), pa.array(signed(s.id)), *[pa.array(signed(p)) for p in s.parity()], pa.array(s.fine_parity(), pa.binary()), *null], names=names)
        blocks = range(SLOTS // BLOCK)
        cols = [pa.nulls(len(blocks), pa.int64()) for _ in range(8)] + [pa.nulls(len(blocks), pa.binary()), pa.array(list(blocks), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array([sketch[x * BLOCK : (x + 1) * BLOCK].tobytes() for x in blocks], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, arrow_schema(_MEASURED))


def add_up(shelf: Shelf, parts: DataFrame, fan: int = 64) -> np.ndarray:
    """Sum of the tasks' sketches: 64 parts of a block at a time, in as many levels as there are tasks for."""

    def add(key, pdf):
        import pandas as pd

        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pd.DataFrame({"block": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})

    tasks = parts.agg(F.max("part")).first()[0]
    now = parts.select("block", "part", "counts")
    while tasks is not None:
        tasks //= fan
        now = shelf.put(now.withColumn("part", F.floor(F.col("part") / fan).cast("int")).groupBy("block", "part").applyInPandas(add, "block int, part int, counts binary"), "sketch")
        if not tasks:
            break
    out = np.zeros(SLOTS, np.int64)
    for r in now.collect():  # SLOTS numbers
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.counts, np.int64)
    return out


def boundary_of(copies: float, verify: float = 8.0, percent: int = PERCENT) -> int:
    """Sizes below it are light.  A light set costs n + 1 subsets; a heavy one its prefix, each entry with the members of
    its list that have to be verified, estimated by the copies a class has."""
    out, most = light_sizes(percent)
    for n in range(out, most):
        if n + 1 <= int(prefix_size(np.array([n]), percent)[0]) * (1 + verify * copies):
            out = n + 1
    return out


_KEYED = "id bigint, n bigint, keys array<bigint>, subsets array<bigint>"


def keyed(docs: DataFrame, k: int, sketch, boundary: int, percent: int) -> DataFrame:
    """Of each document with enough shingles to link: the keys of its inverted lists, or its subsets' hashes."""
    least = light_sizes(percent)[0]

    def run(batches):
        freq = sketch.value
        for b in batches:
            texts = utf8(b.column(0))
            for i, j in chunks([len(t) for t in texts]):
                s = Sets(texts[i:j], k)
                order = np.lexsort((s.hash, -s.length, freq[slot(s.hash)], s.doc))
                rank = np.arange(len(order)) - s.first[:-1][s.doc]
                take = (rank < prefix_size(s.size, percent)[s.doc]) & (s.size[s.doc] >= boundary)
                keys, owner = signed(s.hash[order][take]), s.doc[take]
                some = (s.size[s.doc] >= least + 1) & (s.size[s.doc] <= boundary)
                whole = np.flatnonzero((s.size >= least) & (s.size < boundary))
                sub_doc = np.concatenate([s.doc[some], whole])
                sub = signed(mix(np.concatenate([s.id[s.doc[some]] - s.mixed[some], s.id[whole]]) ^ _SUBSET))
                by = np.argsort(sub_doc, kind="stable")
                split = lambda values, own: pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(j - i + 1)).astype(np.int32)), pa.array(values))
                rows = pa.RecordBatch.from_arrays([pa.array(signed(s.id)), pa.array(s.size), split(keys, owner), split(sub[by], sub_doc[by])], names=["id", "n", "keys", "subsets"])
                yield rows.filter(pa.array(s.size >= least))

    return docs.mapInArrow(run, arrow_schema(_KEYED))


def with_sets(docs: DataFrame, k: int) -> DataFrame:
    """id and shingles, ascending."""

    def run(batches):
        for b in batches:
            texts = utf8(b.column(0))
            for i, j in chunks([len(t) for t in texts]):
                s = Sets(texts[i:j], k)
                yield pa.RecordBatch.from_arrays([pa.array(signed(s.id)), pa.ListArray.from_arrays(pa.array(s.first.astype(np.int32)), pa.array(signed(s.hash)))], names=["id", "items"])

    return docs.mapInArrow(run, arrow_schema("id bigint, items array<bigint>"))


def _verified(shelf: Shelf, docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    # merge joins at every size: sent to all executors, the classes would grow with the documents
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("fine").alias(f"f{c}")).hint("merge")
    wide = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "fa", "fb")

    def near(batches):
        for b in batches:
            ok = [differ_by(x, y) * (100 + percent) <= (n + m) * (100 - percent) for n, m, x, y in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    pairs = shelf.put(wide.mapInArrow(near, arrow_schema("a bigint, b bigint")), "near")
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids = shelf.put(classes.join(needed, "id", "left_semi").select(F.col("doc_id")), "needed")
    at = ids.filter("doc_id is not null")
    few = F.broadcast(at) if small_enough(at, BROADCAST_ROWS) else at
    texts = docs.join(few, "doc_id", "left_semi").select("text").unionByName(docs.filter("doc_id is null").select("text"))
    sets = shelf.put(with_sets(texts, k).join(needed, "id", "left_semi").dropDuplicates(["id"]), "sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    out = shelf.put(both.filter(common * 100 >= union * percent).select("a", "b"), "verified")
    shelf.drop(sets, ids)
    return out


def _fits(l: str, r: str, percent: int) -> F.Column:
    """Sizes allow a link, and so does the parity of the groups."""
    n, m = F.col(f"{l}.n"), F.col(f"{r}.n")
    differ = sum((F.bit_count(F.col(f"{l}.p{k}").bitwiseXOR(F.col(f"{r}.p{k}"))) for k in range(4)), F.lit(0))
    # a link has intersection >= percent of union, so difference <= (n + m) * (100 - percent) / (100 + percent)
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def classes_of(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of each row.  Only components are given: links within a component are not all sought."""
    return found_classes(spark, docs, k, percent).select("doc_id", "n_shingles", "component_id")


def found_classes(spark: SparkSession, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The same with th (hash of the text) and root (what all rows of a component share)."""
    shelf = Shelf(spark, "jaccard_join")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = shelf.put(measured(docs, k), "rows")
    counts = add_up(shelf, rows.filter("block is not null"))
    # slots near the mean tell nothing about a single shingle; there the longer one counts as the rarer
    sketch = spark.sparkContext.broadcast(np.where(counts > 2 * counts.mean(), counts, 0))
    rows = rows.filter("block is null")
    classes = shelf.put(rows.filter("n > 0").groupBy("id", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), *[F.first(f"p{x}").alias(f"p{x}") for x in range(4)], F.first("fine").alias("fine")), "classes")
    mean = classes.agg(F.avg("copies")).first()[0]
    lists = shelf.put(keyed(docs.select("text"), k, sketch, boundary_of(mean or 1.0, percent=percent), percent), "keyed")
    # light: a set and a subset of a larger one, or two equal ones, have equal hashes; sizes must differ by one
    subset = lists.select("id", "n", F.explode("subsets").alias("key")).distinct()
    both = subset.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).filter("x <> y").select("key")
    few = subset.join(both, "key", "left_semi")
    own = few.filter(F.col("n") < light_sizes(percent)[1]).alias("l").join(few.alias("r"), F.expr(f"l.key = r.key and r.n = l.n + 1 and 100 * l.n >= {percent} * r.n"))
    light = own.select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
    # heavy: keys that two classes share; a list of two entries is one pair, without scanning
    listed = lists.select("id", F.explode("keys").alias("key"))
    shared = listed.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count("*").alias("times"))
    shared = shelf.put(shared.filter("x <> y"), "shared")
    twos = shared.filter("times = 2").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    entries = listed.select("id", "key").join(shared.filter("times > 2").select("key"), "key", "left_semi").distinct()
    attributes = classes.select("id", "n", "p0", "p1", "p2", "p3")
    side = lambda c: attributes.select(*[F.col(x).alias(c if x == "id" else x) for x in attributes.columns]).hint("merge")
    twos = twos.join(side("a").alias("l"), "a").join(side("b").alias("r"), "b").filter(_fits("l", "r", percent)).select("a", "b")
    entries_n = shelf.put(entries.join(attributes.hint("merge"), "id"), "entries")
    centre = entries_n.groupBy("key").agg(F.min_by(F.struct("id", "n", "p0", "p1", "p2", "p3"), F.xxhash64("id")).alias("c")).select("key", "c.*")
    star = entries_n.alias("l").join(centre.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.id") != F.col("r.id")) & _fits("l", "r", percent))
    star = star.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))
    pairs = shelf.put(star.unionByName(twos).distinct(), "pairs")
    links = shelf.put(light.unionByName(_verified(shelf, docs, classes, pairs, k, percent)).distinct(), "links")
    first = shelf.put(components(shelf, links), "components")
    # all pairs of different components that fit, at their first shared key; pairs that the stars have tried are known
    rest = entries_n.join(first, F.col("id") == F.col("node"), "left").select("id", "n", "p0", "p1", "p2", "p3", "key", F.coalesce("root", "id").alias("root"))
    mixed = rest.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    rest = shelf.put(rest.join(mixed, "key"), "rest")
    apart = (F.col("l.key") == F.col("r.key")) & (F.col("l.id") < F.col("r.id")) & (F.col("l.root") != F.col("r.root")) & _fits("l", "r", percent)
    # few pairs are left by now, so those of several lists are not told apart before they are made
    more = rest.alias("l").join(rest.alias("r"), apart).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
    more = shelf.put(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
    shelf.drop(lists)
    links = shelf.put(links.unionByName(_verified(shelf, docs, classes, more, k, percent)), "links")
    roots = components(shelf, links)
    named = classes.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    named = named.select("id", "n", "doc_id", "root")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    each = named.join(least, "root").select("id", "n", "root", "component_id")
    out = rows.select("doc_id", "th", F.col("n").alias("n_shingles"), "id", "n").join(each, ["id", "n"], "left")
    return out.select("doc_id", "th", "root", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component: of its rows with the least doc_id (rows without one come last) one; rows with an empty
    set all stay."""
    shelf = Shelf(spark, "keep_one")
    rows = Rows(docs)
    doc_id, text = rows.at("doc_id"), rows.at("text")
    found = shelf.put(found_classes(spark, rows.df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), k, percent), "found")
    linked = found.filter("n_shingles > 0")
    first = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")).alias("x")).select("x.doc_id", "x.th")
    times = linked.groupBy("doc_id", "th").agg(F.count("*").alias("times"))
    same = lambda a, b: (a.th == b.th) & a.doc_id.eqNullSafe(b.doc_id)
    f, t = first.alias("f"), times.alias("t")
    keep = shelf.put(f.join(t, (F.col("f.th") == F.col("t.th")) & F.col("f.doc_id").eqNullSafe(F.col("t.doc_id"))).select("f.doc_id", "f.th", "times"), "keep")
    once, often = keep.filter("times = 1"), keep.filter("times > 1")
    blank = found.filter("n_shingles = 0").select("th").distinct()
    own = rows.df.withColumn("th", F.xxhash64(F.col(text).cast("string"))).withColumn("doc_id", F.col(doc_id).cast("bigint"))
    whole = own.join(once, same(own, once), "left_semi")
    # of rows that repeat one stays; only those are dealt by their key
    repeated = own.join(F.broadcast(often) if small_enough(often, BROADCAST_ROWS) else often, same(own, often), "left_semi").dropDuplicates(["doc_id", "th"])
    empty = own.join(F.broadcast(blank) if small_enough(blank, BROADCAST_ROWS) else blank, "th", "left_semi")
    names = rows.df.columns
    return rows.back(whole.select(*names).unionByName(repeated.select(*names)).unionByName(empty.select(*names)))
