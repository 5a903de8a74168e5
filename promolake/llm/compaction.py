"""Bin-packed compaction of Parquet folders, planned on run lengths of file sizes and carried out by Spark's readers and writers.

Files of a partition that are smaller than a bound are packed by first fit, largest first, into groups of bounded size.  Only a table
of (partition, size, number of files) goes to the packing: files of equal size are a run, and each earliest group takes floor(rest /
size) of them at once.  The plan comes back as ordinal ranges of a run with the group and the first place there, and is joined to the files
by rank to say which file goes where.  A partition's runs are in one task: first fit is sequential, and r rows make at most sqrt(2 r) different
sizes.  Groups of one file stay as they are; the others are read back, and one file, written by one task out of Spark's sort
(which spills), replaces each in the order of joining.

Layout: `<root>/<day>/<lot>/<piece>/*.parquet`.  The plan is written to `<root>-plan`, the new files to `<root>-merged`, and only
then they are moved and the old files deleted, by paths that stream through the driver as in Spark's own commit.  `finish` carries that
last step out and can be called again after a crash, as each of its moves and deletions is skipped where it is done already.  During that step a
reader may see both a new file and its sources.

Rows: all columns are kept in their order whatever their names, repeated rows too; a null key of a partition is a partition; ties in size go by
lot, then piece; an empty table leaves an empty folder and an empty result."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, shared_dir

KEYS = ("day", "lot", "piece")


def _free(name: str, taken: list[str]) -> str:
    while name in {c.lower() for c in taken}:
        name += "_"
    return name


@dataclass
class Folder:
    """A folder of Parquet files by three keys (day, lot and piece, whatever their names) and the folders of its compaction beside it."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    schema: T.StructType

    @property
    def plan(self) -> str:
        return f"{self.root}-plan"

    @property
    def merged(self) -> str:
        return f"{self.root}-merged"

    def partition(self, *values: int | None) -> str:
        return "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(self.keys, values, strict=True))

    def read(self) -> DataFrame:
        """The rows, and behind them a struct of file (path), row (place in the file), day, lot and piece."""
        df = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.root)
        key = [F.expr(f"try_cast(regexp_extract(_metadata.file_path, '/{k}=([^/]*)/', 1) AS long)").alias(name) for k, name in zip(self.keys, KEYS, strict=True)]
        return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), *key).alias(_free("at_", df.columns)))


def write_files(df: DataFrame, root: str, keys: tuple[str, ...], order: list[str]) -> Folder:
    """Writes a file for every combination of the three keys that occurs, its rows by `order` (then by all others, so that the order is
    one), with the other columns of df in their order."""
    columns = [c for c in df.columns if c not in keys]
    rest = [c for c in columns if c not in order]
    df.repartition(*keys).sortWithinPartitions(*keys, *order, *rest).write.partitionBy(*keys).parquet(root)
    return Folder(df.sparkSession, root, keys, df.select(*columns).schema)


def pack(runs: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int, int, int, int]]:
    """runs: (size, number of files), largest size first.  Gives size, first ordinal, ordinal behind the last, group and place of the first
    there, as first fit does file by file; a file over `most` is a group by itself."""
    room: list[int] = []
    held: list[int] = []
    for size, files in runs:
        done = 0
        for g in range(len(room)):
            if done == files:
                break
            took = min(files - done, room[g] // size)
            if took:
                yield size, done, done + took, g, held[g]
                room[g] -= took * size
                held[g] += took
                done += took
        while done < files:
            took = min(files - done, max(1, most // size))
            yield size, done, done + took, len(room), 0
            room.append(max(0, most - took * size))
            held.append(took)
            done += took


def plan(files: DataFrame, small: int, most: int) -> DataFrame:
    """files (file, day, lot, piece, n_rows): the columns with grp (number of the group in its day; null: the file is not small), place
    in the group and n_files of the group."""

    def runs_of(day: pd.DataFrame) -> pd.DataFrame:
        day = day.sort_values("n_rows", ascending=False)
        out = list(pack(list(zip(day["n_rows"].tolist(), day["files"].tolist(), strict=True)), most))
        got = pd.DataFrame(out, columns=["n_rows", "first", "behind", "grp", "place0"])
        got.insert(0, "day_key", day["day_key"].iloc[0])
        return got

    day = F.coalesce(F.col("day").cast("string"), F.lit(""))
    own = files.withColumn("day_key", day)
    light = own.where(F.col("n_rows") < small)
    runs = light.groupBy("day_key", "n_rows").agg(F.count("*").alias("files"))
    ranges = runs.groupBy("day_key").applyInPandas(runs_of, "day_key string, n_rows long, first long, behind long, grp long, place0 long")
    ranked = light.withColumn("ordinal", F.row_number().over(Window.partitionBy("day_key", "n_rows").orderBy("lot", "piece", "file")) - 1)
    within = (F.col("ordinal") >= F.col("first")) & (F.col("ordinal") < F.col("behind"))
    placed = ranked.join(ranges, ["day_key", "n_rows"]).where(within).withColumn("place", F.col("place0") + F.col("ordinal") - F.col("first"))
    sized = placed.withColumn("n_files", F.count("*").over(Window.partitionBy("day_key", "grp")))
    cols = ["day_key", "file", "day", "lot", "piece", "n_rows"]
    heavy = own.where(F.col("n_rows") >= small)
    return sized.select(*cols, "grp", "place", "n_files").unionByName(heavy.select(*cols, F.lit(None).cast("long").alias("grp"), F.lit(0).cast("long").alias("place"), F.lit(1).cast("long").alias("n_files")))


def compact(folder: Folder, small: int, most: int) -> DataFrame:
    """Compacts the folder and gives its plan, as written beside it: file, day, lot, piece, n_rows, grp, place, n_files and to_ (day, lot and
    piece of the group's first file)."""
    spark = folder.spark
    rows = folder.read()
    at, columns = rows.columns[-1], rows.columns[:-1]
    files = rows.groupBy(f"{at}.file").agg(*(F.first(f"{at}.{k}").alias(k) for k in KEYS), F.count("*").alias("n_rows"))
    own = F.struct(*KEYS)
    first = F.first(F.when(F.col("place") == 0, own), ignorenulls=True).over(Window.partitionBy("day_key", "grp"))
    made = plan(files, small, most).withColumn("to_", F.when(F.col("n_files") > 1, first).otherwise(own)).drop("day_key")
    made.write.parquet(folder.plan)
    made = spark.read.schema(made.schema).parquet(folder.plan)

    moved = made.where("n_files > 1").select("file", "place", "to_")
    inner = rows.toDF(*[f"c{k}" for k in range(len(columns))], "at_").withColumn("file", F.col("at_.file")).join(moved.hint("merge"), "file")
    to = [F.col(f"to_.{k}").alias(name) for k, name in zip(KEYS, folder.keys, strict=True)]
    inner = inner.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(columns)), *to, F.struct("place", "at_.row").alias(_free("order_", columns)))
    order = inner.columns[-1]
    inner.repartition(*folder.keys).sortWithinPartitions(*folder.keys, order).drop(order).write.partitionBy(*folder.keys).parquet(folder.merged)
    finish(folder)
    return made


def finish(folder: Folder) -> None:
    """Moves the merged files to their places and deletes their sources; does nothing where that is done."""
    spark, merged = folder.spark, folder.merged
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(merged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(f"{merged}/_SUCCESS")):
        return
    groups = spark.read.parquet(folder.plan).where("n_files > 1").groupBy("to_").agg(F.collect_list(F.struct("file", F.struct(*KEYS).alias("own"))).alias("sources"))
    for row in groups.toLocalIterator():
        to = folder.partition(*row["to_"])
        for found in fs.globStatus(path(f"{merged}/{to}/*.parquet")) or []:
            fs.rename(found.getPath(), path(f"{folder.root}/{to}/merged-{found.getPath().getName()}"))
        for source in row["sources"]:
            fs.delete(path(source["file"]), False)
            own = folder.partition(*source["own"])
            if own != to:
                fs.delete(path(f"{folder.root}/{own}"), True)
    fs.delete(path(merged), True)


def digest(folder: Folder, made: DataFrame, id_: str, value: str) -> DataFrame:
    """A row for every file of the compacted folder: what its rows hold, read back from it, and which files it came from."""
    rows = folder.read()
    at = rows.columns[-1]
    columns = rows.columns[:-1]
    own = rows.select(F.col(f"{at}.file").alias("file"), F.col(f"{at}.row").alias("row"), *(F.col(f"{at}.{k}").alias(k) for k in KEYS), F.col(id_).cast("long").alias("id"), F.coalesce(F.floor(F.lit(100) * F.col(value) + F.lit(0.5)), F.lit(0)).alias("cents"))
    bounded_batches(folder.spark)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of several files, file by file: a digest goes on from batch to batch."""
        state: dict = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": state["file"], "ids_sha256": state["sha"].hexdigest()}], schema=pa.schema([("file", pa.string()), ("ids_sha256", pa.string())]))

        for b in batches:
            files, ids = b.column("file"), pc.fill_null(b.column("id").cast(pa.string()), "")
            runs = pc.run_end_encode(files)
            start = 0
            for end, file in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if state.get("file") != file:
                    if state:
                        yield out()
                    state = {"file": file, "sha": hashlib.sha256()}
                else:
                    state["sha"].update(b",")
                state["sha"].update(",".join(ids.slice(start, end - start).to_pylist()).encode())
                start = end
        if state:
            yield out()

    sha = own.select("file", "row", "id").repartition("file").sortWithinPartitions("file", "row").select("file", "id").mapInArrow(one, "file string, ids_sha256 string")
    sums = own.groupBy("file").agg(*(F.first(k).alias(k) for k in KEYS), F.count("*").alias("n_rows"), F.min("id").alias("min_click_id"), F.max("id").alias("max_click_id"), F.sum("cents").alias("cents"))
    name = F.concat_ws("-", "lot", "piece")
    sources = made.groupBy(F.col("to_.day").alias("day"), F.col("to_.lot").alias("lot"), F.col("to_.piece").alias("piece")).agg(
        F.max("n_files").alias("n_files"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", name.alias("name")))), lambda x: x["name"]), ",").alias("sources"),
    )
    key = F.coalesce(F.col("day").cast("string"), F.lit(""))
    sources = sources.select(key.alias("day_key"), "lot", "piece", "n_files", "sources")
    whole = sums.join(sha, "file").withColumn("day_key", key).join(sources, ["day_key", "lot", "piece"])
    return whole.select(*KEYS, "n_rows", "min_click_id", "max_click_id", "cents", "sources", "ids_sha256", F.lit(",".join(columns)).alias("columns"), F.col("file").alias("path"), (F.col("n_files") > 1).alias("rewritten"))


def clicks_compacted(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """Clicks as files by day, lot and piece in a new folder, compacted there; a row for every file that is left.

    With R rows let S(x) = 1 + floor(R / x).  A day of r rows has 1 + floor(r / S(150)) lots; files under S(600) rows are packed to at most S(400)
    rows.  So a file holds about a 150th of the rows at most however they lie, and a day has 151 lots of 4 pieces at most."""
    root = f"{shared_dir(spark)}/compaction-{uuid.uuid4().hex}"
    total = clicks.count()
    bound = {x: 1 + total // x for x in (150, 600, 400)}
    names = clicks.columns
    own = clicks.toDF(*[f"c{k}" for k in range(len(names))])
    at, id_ = (F.col(f"c{names.index(c)}") for c in ("arrived_at", "click_id"))
    own = own.withColumns({"day_": F.unix_date(F.to_date(at)).cast("long"), "h_": F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary"))})
    # A third of all rows may have one day: each day's count is written once for each of 16 salts, and rows meet it by day and salt.
    key = F.coalesce(F.col("day_").cast("string"), F.lit(""))
    own = own.withColumns({"key_": key, "salt_": F.pmod(F.col("h_"), F.lit(16))})
    days = own.groupBy("key_").agg(F.count("*").alias("r_")).select("key_", "r_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))).alias("salt_"))
    own = own.join(days.hint("merge"), ["key_", "salt_"])
    lot = F.pmod(F.floor(F.col("h_") / 16), 1 + F.floor(F.col("r_") / bound[150]))
    piece = F.least(F.pmod(F.col("h_"), F.lit(4)), F.pmod(F.floor(F.col("h_") / 4), F.lit(4)))
    own = own.withColumns({"lot_": lot, "piece_": piece})
    keys: list[str] = []
    for k in KEYS:
        keys.append(_free(k, names + keys))
    own = own.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)), *(F.col(f"{k}_").alias(name) for k, name in zip(KEYS, keys, strict=True)))
    folder = write_files(own, root, tuple(keys), ["arrived_at", "click_id"])
    made = compact(folder, bound[600], bound[400])
    return digest(folder, made, "click_id", "value")
