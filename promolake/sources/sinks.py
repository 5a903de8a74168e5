"""Sinks: JSON and CSV exports, one folder a city, tabs as tables, snapshot versions.

Every sink writes with Spark's writers into folders, so that it scales with the rows; presentation is left to readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R
from promolake.sources import versions


def as_text(rows: DataFrame, preferred: list[str], extras: bool = True) -> DataFrame:
    """Preferred columns that exist, the others by name; nested values as JSON, nulls as nothing."""
    kinds = dict(rows.dtypes)
    names = [c for c in dict.fromkeys(preferred) if c in kinds] + (sorted(c for c in kinds if c not in preferred and not c.startswith("_")) if extras else [])
    return rows.select(*[E.cell(c, kinds[c]).alias(c) for c in names])


def write_csv(rows: DataFrame, path: str, preferred: list[str] | None = None) -> None:
    as_text(rows, preferred or R.SHEET_COLUMNS).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_merged_json(rows: DataFrame, path: str, merged_at: str) -> None:
    """Rows as JSON lines, and beside them their number and time."""
    rows.write.mode("overwrite").json(f"{path}/rows")
    rows.agg(F.count("*").alias("total_rows")).withColumn("merged_at", F.lit(merged_at)).write.mode("overwrite").json(f"{path}/meta")


def write_city_csv(rows: DataFrame, path: str) -> None:
    """A folder for each city, named by its slug."""
    slug = E.slug(F.trim(F.coalesce(E.first_of("city"), F.lit("Unknown"))))
    as_text(rows, R.SHEET_COLUMNS).withColumn("city_slug", slug).write.mode("overwrite").partitionBy("city_slug").option("header", True).csv(path)


def write_city_tabs(rows: DataFrame, path: str, tabs: dict[str, str | None]) -> dict[str, str]:
    """Fourteen columns for each tab, of its city or (None) of all; a tab that fails is reported, the others go on."""
    failed = {}
    for tab, city in tabs.items():
        try:
            own = rows if city is None else rows.filter(F.trim(E.text("city")) == city)
            as_text(own, R.SHEET_COLUMNS, extras=False).write.mode("overwrite").option("header", True).csv(f"{path}/{tab.strip()}")
        except Exception as e:  # noqa: BLE001 - the caller gets it back
            failed[tab] = str(e)[:300]
    return failed


def coverage_report(url_log: DataFrame, row_counts: DataFrame, excluded: DataFrame) -> DataFrame:
    """The log with rows written and reasons of exclusion (a JSON map) by address."""
    reasons = excluded.groupBy("url", "reason").agg(F.count("*").alias("n")).groupBy("url").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n"))))).alias("excluded_reasons"))
    return url_log.join(row_counts, "url", "left").join(reasons, "url", "left").na.fill(0, ["row_count_written"]).na.fill("{}", ["excluded_reasons"])


def exclusions_report(excluded: DataFrame, url_log: DataFrame, order: str = "_row_ord") -> DataFrame:
    """Excluded rows with store and city of their address (of several log rows the last)."""
    from promolake.operators.relational import keep_first

    last = keep_first(url_log, [F.col("url")], [F.col(order).desc()]).select("url", "city", "store_name")
    return excluded.join(last, "url", "left").withColumn("raw_text", F.substring(F.coalesce("raw_text", "snippet"), 1, 1000))


def data_tab(rows: DataFrame) -> DataFrame:
    """Thirty columns and the change status as text, with a style by rule for whoever shows them."""
    style = F.when(F.col("change_status") == "new", "green").when(F.col("change_status") == "updated", "yellow").when(F.col("change_status") == "needs_review", "orange").otherwise("")
    kinds = dict(rows.dtypes)
    return rows.select(*[(E.cell(c, kinds[c]) if c in kinds else F.lit("")).alias(c) for c in [*R.SCHEMA_COLUMNS, "change_status"]], style.alias("row_style"))


def preview(tabs: dict[str, DataFrame], most: int = 200) -> dict[str, list[dict]]:
    """The first rows of each tab for a look; a report, so it is limited."""
    return {name: [r.asDict(recursive=True) for r in df.limit(most).collect()] for name, df in tabs.items()}


def save_snapshot(snapshot: DataFrame, root: str, version: str) -> None:
    """A new version of the snapshot (of snapshot_of, which deals rows by key) under its label; it is there whole or not at all."""
    if any(m.label == version for m in versions.history(snapshot.sparkSession, root)):
        raise ValueError(f"there is a snapshot {version} already")
    versions.commit(snapshot, root, ["row_key"], whole=True, label=version, dealt=True)


def ads_csv(ads: DataFrame, path: str) -> None:
    ads.select(*[E.text(c).alias(c) for c in R.AD_COLUMNS]).write.mode("overwrite").option("header", True).csv(path)


def dashboard_html(tables: dict[str, DataFrame], path: str, title: str = "Promotions", most: int = 1000) -> None:
    """One page with a table for each of some small results, as one text file; a result of over `most` rows is an error, none is cut."""
    from html import escape

    parts = [f"<!doctype html><meta charset='utf-8'><title>{escape(title)}</title><h1>{escape(title)}</h1>"]
    for name, df in tables.items():
        head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has over {most} rows: too many for one page")
        body = "".join("<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in row) + "</tr>" for row in rows)
        parts.append(f"<h2>{escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([("".join(parts).replace("\n", " "),)], "value string").coalesce(1).write.mode("overwrite").text(path)
