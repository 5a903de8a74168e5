"""Quality rules with host-level verdicts.

Each document is measured by its own words and lines; failures are then counted by host (`source`), and a host's
failure rate is shrunk towards all hosts' by a beta prior that is fitted to them by the method of moments.  Documents
of a host whose shrunk rate is over `most` are rejected with it.

Nulls and edges: a null or blank text has no words and fails; a null host is no host, so the document's own rules, all
of them, decide; repeated rows are measured one by one; texts are read whole; an empty table gives an empty result; only
doc_id, text and the host column are read, so other columns cannot clash."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shelf, arrow_schema, utf8

#: Fixed values of the result's contract.
MIN_WORDS, SYMBOLS, REPEAT_PERCENT = 50, b"#*$%&|<>", 50
#: Host rules: symbols per word, share of lines that repeat.
MOST_SYMBOLS, MOST_DUP_LINES, MOST_FAILING = 0.5, 0.5, 0.5

MEASURES = "doc_id bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
_SPACES = bytes([32, 9, 10, 11, 12, 13])
_DROP = bytes(set(range(256)) - set(SYMBOLS))


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, lines with a word, n_dup_lines, n_repeat_words."""
    words = text.split()  # bytes.split() parts at \x20 and \x09-\x0D alone
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    chars = len(text.translate(None, _SPACES).decode("utf-8", "surrogatepass"))
    repeated = 0
    if n > 2:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        distinct = set(windows)
        if len(distinct) < len(windows):
            seen = Counter(windows)
            often = np.zeros(n + 2, np.int64)
            at = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
            for k in range(3):
                often[k : k + len(windows)] += at
            repeated = int(np.count_nonzero(often))
    return n, chars, len(text.translate(None, _DROP)), len(lines), len(lines) - len(set(lines)), repeated


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    def run(batches):
        for b in batches:
            rows = [measure(t) for t in utf8(b.column(1))]
            n, chars, symbols, lines, dup, repeated = (np.array([r[k] for r in rows], np.int64) for k in range(6))
            failed = (n < MIN_WORDS) | (100 * repeated > REPEAT_PERCENT * n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *map(pa.array, (n, chars, symbols, lines, dup, repeated, failed))], names=re.findall(r"(\w+) \w+", MEASURES))

    at = docs.select(F.col("doc_id").cast("bigint"), F.col("text"), F.col(host).cast("string").alias("host"))
    return at.mapInArrow(run, arrow_schema(MEASURES))


def rule_failed() -> F.Column:
    symbols = F.col("n_symbols") > F.lit(MOST_SYMBOLS) * F.col("n_words")
    return F.col("base_failed") | symbols | (F.col("n_dup_lines") > F.lit(MOST_DUP_LINES) * F.col("n_lines"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """a, b of the prior: mean of all documents, precision from how far hosts' rates spread beyond chance."""
    total = F.sum("n")
    m = hosts.agg((F.sum("failed") / total).alias("m"), F.count("*").alias("hosts")).first()
    if not m.hosts or m.m is None:
        return 0.5, 0.5
    mean = min(max(m.m, 1e-6), 1 - 1e-6)
    spread = hosts.agg(F.avg(F.pow(F.col("failed") / F.col("n") - F.lit(mean), 2) - F.lit(mean * (1 - mean)) / F.col("n"))).first()[0]
    size = min(max(mean * (1 - mean) / spread - 1, 1.0), 10_000.0) if spread > 0 else 10_000.0
    return mean * size, (1 - mean) * size


def host_verdicts(measured: DataFrame, most: float = MOST_FAILING) -> DataFrame:
    """host, n, failed, rate (shrunk), host_ok."""
    hosts = measured.filter("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(rule_failed().cast("bigint")).alias("failed"))
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn("host_ok", F.col("rate") <= most)


def host_rules(spark: SparkSession, docs: DataFrame, host: str = "source", most: float = MOST_FAILING) -> DataFrame:
    """The measures of each document, its host's shrunk failure rate, and kept.  Texts are never shuffled."""
    shelf = Shelf(spark, "host_rules")
    measured = shelf.put(measures(docs, host), "measures")
    verdicts = host_verdicts(measured, most).select("host", "rate", "host_ok")
    joined = measured.join(verdicts, "host", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce("host_ok", ~rule_failed()))
