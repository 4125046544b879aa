"""The operators of this subpackage as registered queries, and checking SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearledger.llm import (
    kmeans_tree,
    line_dedup,
    line_rules,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    pii,
    quality,
    spelling,
    substring_dedup,
    topk,
    url_rules,
)
from gearledger.llm.common import table

QUERY_STEP = 100
TOP = 10
NEAR_STEP = 50
NEAR_TOP = 5
#: One in so many (document, run) pairs loses a letter in op11.
NOISE_EVERY = 97


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.dedup_substrings(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op3_private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_private(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
                        _listed("spans").alias("spans"))


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), TOP)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.clean_lines(table(spark, folder, "documents")).drop("clean_text")


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"))


def op11_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.word_counts(table(spark, folder, "documents"), noise_every=NOISE_EVERY)
    return spelling.spelling_groups(words)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.with_planted_runs(table(spark, folder, "documents")))
    found = found.withColumn("best", periodic_runs.strongest("runs"))
    listed = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = {c: F.col(f"best.{c}") for c in ("start", "length", "period")}
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[column.alias(c) for c, column in best.items()],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return kmeans_tree.nearest(vectors, vectors.where(F.col("vec_id") % NEAR_STEP == 0), NEAR_TOP)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    known = (op1_substring_dedup, op2_best_fit_packing, op3_private_data, op4_near_dedup, op5_exact_topk,
             op6_line_dedup, op7_line_rules, op8_source_mixing, op9_quality_classifier, op10_url_rules,
             op11_spelling_groups, op12_periodic_runs, op13_nearest_neighbours)
    return {f.__name__: f for f in known}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM w),
g AS (SELECT doc_id, place, count(*) OVER win AS n, md5(array_to_string(list(word) OVER win, ' ')) AS gram FROM x
      WINDOW win AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
full_g AS (SELECT * FROM g WHERE n = 35),
d AS (SELECT gram FROM full_g GROUP BY gram HAVING count(*) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(place, place + 35)) AS place FROM full_g JOIN d USING (gram)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
      FROM x ANTI JOIN r USING (doc_id, place) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

OP4_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM w),
g AS (SELECT doc_id, n, place, array_to_string(list(word) OVER win, ' ') AS shingle FROM x
      WINDOW win AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
s AS (SELECT DISTINCT doc_id, shingle FROM g WHERE place <= greatest(n - 5, 0)),
c AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b
      ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b
      WHERE 100 * common >= 85 * (ca.size + cb.size - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(c.size, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN m ON m.a = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""

OP5_SQL = f"""
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = list_count(embedding)
           AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
v AS (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS place FROM u),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.place = c.place AND q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
       vec_id, score FROM s
QUALIFY "rank" <= {TOP}
"""

_PHRASES = "|".join(line_rules.BOILERPLATE)
OP7_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM d),
g AS (SELECT doc_id, place, count(*) OVER win AS n, array_to_string(list(word) OVER win, ' ') AS gram FROM x
      WINDOW win AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
h AS (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM g WHERE n = 5),
r AS (SELECT doc_id, count(DISTINCT place) AS n FROM
      (SELECT doc_id, unnest(range(place, place + 5)) AS place FROM h WHERE times > 1) GROUP BY doc_id),
l AS (SELECT doc_id, line,
        len(regexp_extract_all(line, '{line_rules.SYMBOLS}')) * {line_rules.SYMBOL_SHARE} > length(line)
        OR len(regexp_extract_all(line, '{line_rules.MENU}')) >= {line_rules.MENU_SIGNS}
        OR (length(line) < {line_rules.BOILERPLATE_CHARS} AND regexp_matches(lower(line), '{_PHRASES}')) AS fails
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{line_rules.HAS_WORD}')),
t AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (fails) AS failed,
        coalesce(sum(length(line)) FILTER (fails), 0) AS lost, sum(length(line)) AS held FROM l GROUP BY doc_id),
b AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        len(regexp_extract_all(text, '{line_rules.SYMBOLS}')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, coalesce(failed, 0) AS failed, coalesce(lost, 0) AS lost,
        coalesce(held, 0) AS held FROM d LEFT JOIN r USING (doc_id) LEFT JOIN t USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND lost <= {line_rules.MAX_LOST} * held AS kept, CAST(failed AS BIGINT) AS n_lines_removed
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
"""


def _choose(values: tuple) -> str:
    return "CASE (rank - 1) % {} {} END".format(
        len(values), " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)))


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
c AS (SELECT source, source_size, 3 * source_size AS cap, {_choose(mixing.WEIGHTS)} AS weight,
        CAST({_choose(mixing.SLOPES)} AS DOUBLE) AS slope FROM n),
v AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM c),
t AS (SELECT source, source_size, slope,
        least(max(level) OVER () * weight, CAST(cap AS DOUBLE)) AS target FROM v),
p AS (SELECT doc_id, size, source_size, target, slope, CAST(coalesce(sum(size) OVER (PARTITION BY d.source
          ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE
        CAST(start + size / 2 < target AS INTEGER) + CAST(start + size / 2 + source_size < target AS INTEGER)
        + CAST(start + size / 2 + 2 * source_size < target AS INTEGER) END AS passes FROM p),
f AS (SELECT *, least(start / target, 1.0) AS share FROM q)
SELECT doc_id, size, source_size, target, CAST(size * passes AS BIGINT) AS taken,
  CASE WHEN passes > 0 THEN CAST(floor(1000000 * CASE WHEN slope = 0 THEN share ELSE
    (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END) AS BIGINT) END AS first_step
FROM f
"""


def _checksum_steps() -> list[int]:
    """What four bits do to the checksum's register, by the reflected polynomial of crc32."""
    steps = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return steps


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of an SQL text, half a byte at a time, the lower half first."""
    digits = f"hex(encode({text}))"
    halves = (f"list_transform(range(length({digits})), lambda i: CAST(instr('0123456789ABCDEF', "
              f"substr({digits}, CAST(xor(i, 1) + 1 AS BIGINT), 1)) - 1 AS BIGINT))")
    return (f"xor(list_reduce({halves}, lambda c, x: xor({_checksum_steps()}[(xor(c, x) & 15) + 1], c >> 4), "
            f"CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))")


OP11_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+') AS runs FROM documents),
x AS (SELECT doc_id, unnest(runs) AS run FROM d),
u AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, run, count(*) AS n FROM x GROUP BY ALL),
h AS (SELECT run, n, {_crc32("name || ':' || run")} AS h FROM u),
k AS (SELECT CASE WHEN h % {NOISE_EVERY} = 0
        THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
        ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM k WHERE length(word) >= {spelling.LEAST_CHARS}
      GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
c AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM c a JOIN c b ON a.i = b.i AND a.rest = b.rest
        AND a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM w a JOIN c b ON a.word = b.rest
      UNION SELECT a.word, a.n, b.word, b.n FROM c a JOIN w b ON a.rest = b.word),
f AS MATERIALIZED (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near,
        max(near_n) AS near_n, max(n) AS n FROM p GROUP BY word),
g AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= {spelling.RATIO} * w.n THEN near END AS form,
        CASE WHEN near_n >= {spelling.RATIO} * w.n THEN near_n END AS form_n FROM w LEFT JOIN f USING (word)),
r AS (SELECT word, word AS root, form FROM g UNION ALL SELECT r.word, g.word, g.form FROM r JOIN g ON r.form = g.word)
SELECT g.word, g.n, CAST(n_near AS BIGINT) AS n_near, g.form, CAST(form_n AS BIGINT) AS form_n, r.root
FROM g JOIN r ON r.word = g.word AND r.form IS NULL
"""

OP12_SQL = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS ws, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
e AS (SELECT *, h // 10 AS g, len(ws) AS n FROM d),
o AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
m AS MATERIALIZED (SELECT doc_id, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n), lambda i:
        ws[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1 AS BIGINT)]) END AS ws
      FROM o),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM m),
s AS MATERIALIZED (SELECT doc_id, place, count(*) OVER win AS n, md5(array_to_string(list(word) OVER win, ' ')) AS gram
      FROM x WINDOW win AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
p AS (SELECT a.doc_id, a.place, b.place - a.place AS lag FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.gram = b.gram
      AND b.place > a.place JOIN m ON m.doc_id = a.doc_id AND 4 * (b.place - a.place) <= len(m.ws)
      WHERE a.n = 5 AND b.n = 5),
i AS (SELECT doc_id, lag, place, place - row_number() OVER (PARTITION BY doc_id, lag ORDER BY place) AS island FROM p),
t AS MATERIALIZED (SELECT doc_id, lag AS period, min(place) AS start, count(*) + 4 + lag AS length FROM i
      GROUP BY doc_id, lag, island HAVING count(*) + 4 + lag >= greatest({periodic_runs.LEAST_WORDS},
      {periodic_runs.EXPONENT} * lag)),
r AS MATERIALIZED (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.doc_id = t.doc_id
      AND u.period < t.period AND u.start <= t.start AND u.start + u.length >= t.start + t.length)),
z AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM x ANTI JOIN z USING (doc_id, place)
      GROUP BY doc_id),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period)
      AS turn FROM r),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
      ORDER BY start, period) AS listed FROM r GROUP BY doc_id)
SELECT m.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start,
       CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
       CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM m LEFT JOIN l USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN b ON b.doc_id = m.doc_id AND turn = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op4_near_dedup": OP4_SQL, "op5_exact_topk": OP5_SQL,
            "op7_line_rules": OP7_SQL, "op8_source_mixing": OP8_SQL, "op11_spelling_groups": OP11_SQL,
            "op12_periodic_runs": OP12_SQL}
