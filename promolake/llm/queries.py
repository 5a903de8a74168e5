"""The queries opN_<name>: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import compaction, decontamination, host_rules, jaccard_join, line_dedup, manifest, pii, resampling, sentencepieces, sharding, suffix_runs, suffix_tree, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digest(spark, table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(spark, table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(spark, table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.deduplicated(spark, table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_runs.removed(spark, table(spark, sf_dir, "documents")).drop("spans")


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_rules.host_rules(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes_of(spark, table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents_shards(spark, table(spark, sf_dir, "documents"))


def op12_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.clicks_compacted(spark, table(spark, sf_dir, "clicks"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.documents_manifest(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (
        op1_decontamination, op2_sentencepiece, op3_pii, op4_toxicity, op5_suffix_tree, op6_line_dedup,
        op7_resampling, op8_suffix_runs, op9_host_rules, op10_jaccard_join, op11_sharding, op12_compaction, op13_manifest,
    )
    return {f.__name__: f for f in own}


#: The measures, the beta prior by moments and the verdicts of op9 in SQL.
_HOST_RULES = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
x AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS gram FROM x WINDOW p AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g WHERE gram IS NOT NULL) WHERE c > 1) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.doc_id, w.source, CAST(len(w.words) AS BIGINT) AS n_words, CAST(length(regexp_replace(w.t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
 CAST(length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > 0.5 * n_words OR n_dup_lines > 0.5 * n_lines AS failed FROM m),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT least(greatest(sum(k) / sum(n), 1e-6), 1 - 1e-6) AS mean FROM h),
s AS (SELECT any_value(mean) AS mean, avg(power(k / n - mean, 2) - mean * (1 - mean) / n) AS spread FROM h, p),
z AS (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 10000) ELSE 10000 END AS size FROM s),
v AS (SELECT source, (k + mean * size) / (n + size) <= 0.5 AS ok FROM h, z)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed, NOT f.base_failed AND coalesce(v.ok, NOT f.failed) AS kept FROM f LEFT JOIN v ON f.source = v.source"""


#: The trees of op13 level by level, and every row's proof folded step by step; crc32 bit by bit.
_MANIFEST = r"""WITH RECURSIVE base AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, n_chars, coalesce('=' || lang, '') AS grp,
 coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
 list_reduce([xor(CAST(ord(c) AS BIGINT), 0) FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), ''), '')], lambda a, b:
  list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384)), CAST(4294967295 AS BIGINT)) AS crc FROM documents),
leaf AS MATERIALIZED (SELECT r, doc_id, grp, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
 CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) ELSE sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) END AS seen FROM base),
pos AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf),
tree AS (SELECT grp, 0 AS lvl, pos AS k, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM pos
 UNION ALL
 SELECT grp, lvl + 1, k >> 1, sha256(string_agg(h, '' ORDER BY k)), any_value((n + 1) >> 1) FROM tree WHERE n > 1 GROUP BY grp, lvl, k >> 1),
nodes AS MATERIALIZED (SELECT * FROM tree),
sub AS MATERIALIZED (SELECT grp, h AS subroot, lvl AS height, row_number() OVER (ORDER BY grp) - 1 AS pos FROM nodes WHERE n = 1),
top AS (SELECT 0 AS lvl, pos AS k, subroot AS h, count(*) OVER () AS n FROM sub
 UNION ALL
 SELECT lvl + 1, k >> 1, sha256(string_agg(h, '' ORDER BY k)), any_value((n + 1) >> 1) FROM top WHERE n > 1 GROUP BY lvl, k >> 1),
tops AS MATERIALIZED (SELECT * FROM top),
steps AS MATERIALIZED (SELECT p.r, l.lvl AS step, (p.pos >> l.lvl) & 1 AS odd, s.h AS sib FROM pos p JOIN sub b USING (grp) JOIN (SELECT DISTINCT grp, lvl FROM nodes WHERE n > 1) l USING (grp)
  LEFT JOIN nodes s ON s.grp = p.grp AND s.lvl = l.lvl AND s.k = xor(p.pos >> l.lvl, 1)
 UNION ALL
 SELECT p.r, b.height + l.lvl, (b.pos >> l.lvl) & 1, s.h FROM pos p JOIN sub b USING (grp) JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) l ON true LEFT JOIN tops s ON s.lvl = l.lvl AND s.k = xor(b.pos >> l.lvl, 1)),
proof AS MATERIALIZED (SELECT r, sha256(coalesce(string_agg(coalesce(sib, ''), '' ORDER BY step), '')) AS proof_sha256 FROM pos LEFT JOIN steps USING (r) GROUP BY r),
fold AS (SELECT r, 0 AS step, seen AS h FROM pos
 UNION ALL
 SELECT f.r, f.step + 1, sha256(CASE WHEN s.sib IS NULL THEN f.h WHEN s.odd = 1 THEN s.sib || f.h ELSE f.h || s.sib END) FROM fold f JOIN steps s ON s.r = f.r AND s.step = f.step),
ended AS (SELECT r, arg_max(h, step) AS folded_root FROM fold GROUP BY r),
root AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM pos JOIN sub USING (grp) JOIN proof USING (r) JOIN ended USING (r), root"""


def oracle_sql() -> dict[str, str]:
    return {"op9_host_rules": _HOST_RULES, "op13_manifest": _MANIFEST}
