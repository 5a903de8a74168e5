"""Versioned tables of keyed rows: parts in folders of their own, and a manifest a version that commits by one rename.

A version is a base (the whole state) and deltas on top of it, each a folder of Parquet by bucket of the key.  `<root>/manifest/<number>.json` names
them; it is written beside and renamed, so it is there whole or not at all, and a second writer of the same number fails.  A reader takes
the newest version whose manifest parses and whose parts were all written to the end, so a write that broke off leaves the version before it in force.
The state is merged on read: of a key's rows the last by the order columns, then by commit; it is gone if that one says so.  Buckets keep a
merge within the folders of equal names, and compaction writes the state as a new base.

Nulls in a key are a key like others.  A folder without a whole version reads as None."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
_GONE, _COMMIT, _BUCKET = "gone__", "commit__", "bucket__"


@dataclass(frozen=True)
class Manifest:
    """What a version consists of."""

    number: int
    label: str
    keys: list[str]
    order: list[str]
    schema: str
    parts: list[dict] = field(default_factory=list)


def _files(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _read_text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def history(spark: SparkSession, root: str) -> list[Manifest]:
    """The whole versions, newest first; torn ones are passed over."""
    fs, path = _files(spark, root)
    found = []
    for f in fs.globStatus(path(f"{root}/manifest/*.json")) or []:
        try:
            m = Manifest(**json.loads(_read_text(spark, fs, f.getPath())))
        except (ValueError, TypeError):
            continue
        if all(fs.exists(path(f"{root}/{p['path']}/_SUCCESS")) for p in m.parts):
            found.append(m)
    return sorted(found, key=lambda m: -m.number)


def _next(spark: SparkSession, root: str) -> int:
    """Behind every number in use, torn ones too."""
    fs, path = _files(spark, root)
    return max([0, *(int(f.getPath().getName().split(".")[0]) for f in fs.globStatus(path(f"{root}/manifest/*.json")) or [])]) + 1


def _publish(spark: SparkSession, root: str, m: Manifest) -> None:
    fs, path = _files(spark, root)
    fs.mkdirs(path(f"{root}/manifest"))
    beside, to = path(f"{root}/manifest/{uuid.uuid4().hex}.tmp"), path(f"{root}/manifest/{m.number:012d}.json")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(asdict(m)).encode()))
    out.close()
    if fs.exists(to) or not fs.rename(beside, to):
        fs.delete(beside, False)
        raise RuntimeError(f"version {m.number} was committed by another writer")


def _write(rows: DataFrame, root: str, keys: list[str], number: int, dealt: bool = False) -> str:
    at = f"data/{number:012d}-{uuid.uuid4().hex}"
    own = rows.withColumns({_COMMIT: F.lit(number), _BUCKET: F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")})
    (own if dealt else own.repartition(_BUCKET, *keys)).write.partitionBy(_BUCKET).parquet(f"{root}/{at}")
    return at


def commit(rows: DataFrame, root: str, keys: list[str], order: list[str] | None = None, gone=None, whole: bool = False, label: str = "", dealt: bool = False) -> Manifest:
    """A new version: rows on top of the newest one, or instead of it if `whole`.  gone: a condition under which a row says that its key is gone.
    dealt: rows are in partitions by their keys already, as after a window over them, and are written from there without another shuffle."""
    spark = rows.sparkSession
    last = None if whole else next(iter(history(spark, root)), None)
    if last and (last.keys, T.StructType.fromJson(json.loads(last.schema)).simpleString()) != (keys, rows.schema.simpleString()):
        raise ValueError("rows of other keys or columns than the table's")
    number = _next(spark, root)
    at = _write(rows.withColumn(_GONE, F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)), root, keys, number, dealt)
    m = Manifest(number, label, keys, list(order or []), rows.schema.json(), [*(last.parts if last else []), {"path": at, "kind": "delta" if last else "base"}])
    _publish(spark, root, m)
    return m


def _merged(spark: SparkSession, root: str, m: Manifest) -> DataFrame:
    """The last row of each key, those that say it is gone among them."""
    schema = T.StructType.fromJson(json.loads(m.schema))
    stored = T.StructType([*schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_COMMIT, T.IntegerType()), T.StructField(_BUCKET, T.IntegerType())])
    every = reduce(DataFrame.unionByName, [spark.read.schema(stored).parquet(f"{root}/{p['path']}") for p in m.parts])
    if len(m.parts) > 1 or m.order:
        rest = [c for c in schema.names if c not in m.order]
        last = Window.partitionBy(_BUCKET, *m.keys).orderBy(*[F.col(c).desc() for c in [*m.order, _COMMIT]], *[F.to_json(F.struct(*rest)).desc()] * bool(rest))
        every = every.withColumn("n__", F.row_number().over(last)).filter("n__ = 1")
    return every.select(*schema.names, _GONE)


def state(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The rows in force in the newest whole version, or in the one of that number."""
    m = next((m for m in history(spark, root) if number in (None, m.number)), None)
    return None if m is None else _merged(spark, root, m).filter(~F.col(_GONE)).drop(_GONE)


def compact(spark: SparkSession, root: str) -> Manifest | None:
    """The newest state as a base by itself.  Where rows have an order, keys that are gone keep their last row, so that a late row
    from before does not bring them back."""
    m = next(iter(history(spark, root)), None)
    if m is None or len(m.parts) == 1:
        return m
    number = _next(spark, root)
    rows = _merged(spark, root, m)
    at = _write(rows if m.order else rows.filter(~F.col(_GONE)), root, m.keys, number)
    new = Manifest(number, m.label, m.keys, m.order, m.schema, [{"path": at, "kind": "base"}])
    _publish(spark, root, new)
    return new


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Deletes manifests but the newest `keep` whole ones, and parts that none of these names; not while a writer is at work."""
    fs, path = _files(spark, root)
    kept = history(spark, root)[:keep]
    named = {p["path"].split("/")[-1] for m in kept for p in m.parts}
    for f in fs.globStatus(path(f"{root}/data/*")) or []:
        if f.getPath().getName() not in named:
            fs.delete(f.getPath(), True)
    for f in fs.globStatus(path(f"{root}/manifest/*")) or []:
        if f.getPath().getName() not in {f"{m.number:012d}.json" for m in kept}:
            fs.delete(f.getPath(), False)
