"""Sharding, compaction and the manifest against plain versions, on tables with nulls, ties, repeated rows and hot keys."""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import random
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pyarrow.parquet as pq
import pytest

from promolake.llm import compaction, manifest, sharding
from promolake.llm.common import Shelf
from promolake.llm.numbering import numbered


def nulls_first(values):
    return tuple((v is not None, v) for v in values)


def in_order(rows):
    return sorted(map(tuple, rows), key=nulls_first)


def test_numbered(spark):
    rows = [(["a", "b", "hot"][min(i % 5, 2)], None if i % 7 == 0 else i % 11, i) for i in range(200)] + [("hot", 3, -1)] * 40
    shelf = Shelf(spark, "numbering")
    df = shelf.put(spark.createDataFrame(rows, "g string, k long, n_row long").repartition(5), "rows")
    got = numbered(shelf, df.withColumnRenamed("n_row", "x"), "g", "k", "x").collect()
    assert Counter((r.g, r.k, r.x) for r in got) == Counter(rows)
    for g in ("a", "b", "hot"):
        own = sorted((r for r in got if r.g == g), key=lambda r: r.pos)
        assert [r.pos for r in own] == list(range(len(own))) and {r.n for r in own} == {len(own)}
        assert [(r.k is not None, r.k, r.x) for r in own] == sorted((r.k is not None, r.k, r.x) for r in own)


# --- sharding --------------------------------------------------------------------------------------------------


def digest_of(text):
    return hashlib.sha256(b"-" if text is None else b"=" + text.encode()).digest()


def plain_shards(groups, k, size, fan):
    """groups {text: bytes} to {text: shard}: differencing with lists of (sum, label of the initial place, texts) and a heap."""
    total, rounds = sum(groups.values()), 0
    while len(groups) > size * fan**rounds:
        rounds += 1
    of = {t: next((r for r in range(rounds) if w * size * fan**r >= total), rounds) for t, w in groups.items()}
    starts, out = {0: [0] * k}, {}
    for r in range(rounds + 1):
        below = {}
        for b, start in starts.items():
            drawn = np.random.default_rng(b).permutation(k)
            own = sorted((t for t in groups if of[t] == r and zlib.crc32(digest_of(t)) % fan**r == b), key=lambda t: (-groups[t], digest_of(t)))
            parts = [[(start[j], j, []) for j in sorted(range(k), key=lambda j: (start[j], drawn[j]))]]
            parts += [[(0, None, [])] * (k - 1) + [(groups[t], None, [t])] for t in own]
            heap = [(p[0][0] - p[-1][0], n, p) for n, p in enumerate(parts)]
            heapq.heapify(heap)
            n = len(heap)
            while len(heap) > 1:
                x, y = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
                both = sorted(((p[0] + q[0], q[1] if p[1] is None else p[1], p[2] + q[2]) for p, q in zip(x, reversed(y), strict=True)), key=lambda e: e[0])
                heapq.heappush(heap, (both[0][0] - both[-1][0], n, both))
                n += 1
            sums = {j: w for w, j, _ in heap[0][2]}
            out |= {t: j for _, j, texts in heap[0][2] for t in texts}
            below |= {b * fan + c: [sums[j] // fan + (sums[j] % fan > c) for j in range(k)] for c in range(fan)}
        starts = below
    return out


@pytest.mark.parametrize(("n", "k", "size", "fan"), [(0, 4, 8, 2), (1, 4, 8, 2), (3, 4, 8192, 32), (90, 1, 8, 2), (200, 40, 8192, 32), (200, 5, 16, 3), (300, 3, 2, 2)])
def test_shards(spark, n, k, size, fan):
    rng = random.Random(4)
    texts = [rng.choice([None, "", "é" * rng.randrange(50), "a" * rng.randrange(300), "hot" * 40, "漢" * rng.randrange(9)]) for _ in range(n)]
    rows = [(i if i % 50 else None, t, 5) for i, t in enumerate(texts)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.documents_shards(spark, df, k, size, fan).collect()
    groups = Counter()
    for _, t, _ in rows:
        groups[t] += len((t or "").encode()) + 16
    to = plain_shards(groups, k, size, fan) if k > 1 else dict.fromkeys(groups, 0)
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", to[t], None) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_balance():
    """Closer than the lightest shard first, by far; a group over a shard's share is alone."""
    rng = random.Random(1)
    weights = sorted((int(rng.lognormvariate(7, 1.2)) for _ in range(4000)), reverse=True)
    sums, shard = sharding.levelled(np.zeros(40, np.int64), np.array(weights), 0)
    assert np.bincount(shard, weights=weights, minlength=40).astype(int).tolist() == sums.tolist()
    greedy = [0] * 40
    for w in weights:
        heapq.heapreplace(greedy, greedy[0] + w)
    assert sums.max() - sums.min() <= (max(greedy) - min(greedy)) / 4
    sums, shard = sharding.levelled(np.zeros(40, np.int64), np.array([sum(weights), *weights]), 0)
    assert (shard == shard[0]).sum() == 1


# --- compaction ------------------------------------------------------------------------------------------------


def plain_files(rows):
    """rows (click_id, arrived_at, value): what each final file holds, by first fit file by file."""
    bound = {x: 1 + len(rows) // x for x in (150, 600, 400)}
    days = defaultdict(list)
    for r in rows:
        days[None if r[1] is None else (r[1] - datetime(1970, 1, 1)).days].append(r)
    out = []
    for day, own in days.items():
        lots, files = 1 + len(own) // bound[150], defaultdict(list)
        for r in own:
            h = zlib.crc32(("" if r[0] is None else str(r[0])).encode())
            files[h // 16 % lots, min(h % 4, h // 4 % 4)].append(r)
        groups = []
        for k, f in sorted(files.items(), key=lambda x: (-len(x[1]), x[0])):
            f.sort(key=lambda r: nulls_first((r[1], r[0])))
            fits = [g for g in groups if not g[0] and sum(len(files[x]) for x in g[1]) + len(f) <= bound[400]]
            if len(f) >= bound[600]:
                groups.append((True, [k]))
            elif fits:
                fits[0][1].append(k)
            else:
                groups.append((False, [k]))
        for _, g in groups:
            f = [r for x in g for r in files[x]]
            ids = [r[0] for r in f if r[0] is not None]
            sha = hashlib.sha256(",".join("" if r[0] is None else str(r[0]) for r in f).encode()).hexdigest()
            cents = sum(0 if r[2] is None else math.floor(100 * r[2] + 0.5) for r in f)
            out.append((day, *g[0], len(f), min(ids, default=None), max(ids, default=None), cents, ",".join(f"{a}-{b}" for a, b in g), sha, len(g) > 1))
    return in_order(out)


CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, day string, at_ long"


def clicks(spark, n):
    rng = random.Random(n)
    first = datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        at = None if rng.random() < 0.02 else first + timedelta(days=0 if rng.random() < 0.33 else rng.randrange(-3, 30), seconds=rng.randrange(86400))
        rows.append((rng.randrange(n) if rng.random() > 0.01 else None, None, at, 1, "x", rng.choice([None, 1.005, 2.675, 3.0, -4.115]), "{}", "d", 7))
    rows += rows[: n // 20]
    return rows, spark.createDataFrame(rows, CLICKS).repartition(3)


def local(path):
    return "/" + path.removeprefix("file:").lstrip("/")


@pytest.mark.parametrize("n", [0, 1, 50, 2000])
def test_compaction(spark, n):
    rows, df = clicks(spark, n)
    got = compaction.clicks_compacted(spark, df).collect()
    names = ["day", "lot", "piece", "n_rows", "min_click_id", "max_click_id", "cents", "sources", "ids_sha256", "rewritten"]
    assert in_order([r[c] for c in names] for r in got) == plain_files([(r[0], r[2], r[5]) for r in rows])
    for r in got:
        assert pq.read_schema(local(r["path"])).names == r["columns"].split(",") == df.columns
    if got:
        root = local(got[0]["path"]).split("/day")[0]
        assert {f"{d}/{f}" for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")} == {local(r["path"]) for r in got}


def test_compaction_in_steps(spark, tmp_path):
    """Files that are not rewritten keep their bytes; the last step, called anew after it broke off midway, ends in the same folder."""
    df = spark.createDataFrame([(day, lot, 0, i) for day in (1, None) for lot in range(9) for i in range(3 + lot)], "k1 long, k2 long, k3 long, x long")
    folder = compaction.write_files(df, f"{tmp_path}/a", ("k1", "k2", "k3"), ["x"])
    before = {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder.root) for f in fs if f.endswith(".parquet")}
    kept = compaction.finish
    try:
        compaction.finish = lambda folder: None
        made = compaction.compact(folder, 10, 13).collect()
    finally:
        compaction.finish = kept
    source = next(r for r in made if r.n_files > 1 and r.place > 0)
    os.remove(local(source.file))
    compaction.finish(folder)
    compaction.finish(folder)
    after = {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder.root) for f in fs if f.endswith(".parquet")}
    alone = {local(r.file) for r in made if r.n_files == 1}
    assert alone and {p: b for p, b in after.items() if p in alone} == {p: before[p] for p in alone}
    assert len(after) == len({(r.day, r.grp if r.n_files > 1 else r.file) for r in made}) and not os.path.exists(folder.merged)
    assert sorted(r.x for r in folder.read().collect()) == sorted(r.x for r in df.collect())


def test_pack():
    """Runs against first fit file by file."""
    rng = random.Random(8)
    for _ in range(200):
        most = rng.randrange(1, 60)
        sizes = sorted((rng.randrange(1, most + 1) for _ in range(rng.randrange(40))), reverse=True)
        runs = sorted(Counter(sizes).items(), reverse=True)
        got = {}
        for size, first, behind, g, place in compaction.pack(runs, most):
            for k in range(first, behind):
                got[size, k] = (g, place + k - first)
        groups, expected = [], {}
        seen = Counter()
        for s in sizes:
            g = next((i for i, x in enumerate(groups) if sum(x) + s <= most), len(groups))
            if g == len(groups):
                groups.append([])
            expected[s, seen[s]] = (g, len(groups[g]))
            groups[g].append(s)
            seen[s] += 1
        assert got == expected


# --- manifest --------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def plain_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text): whole trees in memory."""

    def of(r):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = defaultdict(list)
    for r in rows:
        changed = list(r)
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0 and r[3] is not None:
            changed[3] += 1
        groups[r[2]].append((nulls_first((r[0],)), of(r), r[0], of(changed)))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([x[1] for x in sorted(groups[k])]) for k in keys}
    top = levels([trees[k][-1][0] for k in keys])
    out = []
    for i, k in enumerate(keys):
        for p, x in enumerate(sorted(groups[k])):
            siblings, f = [], x[3]
            for tree, at in ((trees[k], p), (top, i)):
                for level in tree[:-1]:
                    pair = level[at // 2 * 2 : at // 2 * 2 + 2]
                    siblings += [pair[1 - at % 2]] if len(pair) == 2 else []
                    pair[at % 2] = f
                    f = sha(*pair)
                    at //= 2
            out.append((x[2], x[1], trees[k][-1][0], top[-1][0], sha(*siblings), f, f == top[-1][0]))
    return in_order(out)


@pytest.mark.parametrize(("n", "size"), [(0, 4), (1, 4096), (2, 2), (7, 4), (300, 4), (300, 16), (150, 4096)])
def test_manifest(spark, n, size):
    rng = random.Random(n + size)
    rows = []
    for i in range(n):
        lang = rng.choice(["en"] * 6 + ["de", None, "", "fr", "é"])
        rows.append((i if rng.random() > 0.02 else None, rng.choice(["a", None]), lang, rng.choice([None, 3, 10]), rng.choice(["x é漢", None, "", "q" * 5000])))
    rows += rows[:2]
    df = spark.createDataFrame([(*r, "more") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string")
    assert in_order(manifest.documents_manifest(spark, df, size).collect()) == plain_manifest(rows)


def test_traverse():
    """Roots and paths of every number of leaves against whole trees; no layer holds more than two subtrees."""
    for m in range(1, 40):
        leaves = [sha(str(i)).encode() for i in range(m)]
        tree = levels([x.decode() for x in leaves])
        for step in (1, 2, 3):
            root, paths = manifest.traverse(leaves, len(tree) - 1, step)
            assert root.decode() == tree[-1][0]
            for p, path in enumerate(paths):
                assert [x.decode() for x in path] == [level[p >> h ^ 1] if p >> h ^ 1 < len(level) else "" for h, level in enumerate(tree[:-1])]
                assert manifest.folded(leaves[p], p, path) == root
