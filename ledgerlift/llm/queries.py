"""One query per operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlift.llm.bpe import bpe
from ledgerlift.llm.common import crc_mod, table
from ledgerlift.llm.decontamination import leaks
from ledgerlift.llm.language_id import language_id
from ledgerlift.llm.line_dedup import line_dedup
from ledgerlift.llm.lm_scoring import lm_scores
from ledgerlift.llm.near_dedup import near_duplicates
from ledgerlift.llm.pii import personal_data_digest
from ledgerlift.llm.spelling import spelling_variants
from ledgerlift.llm.substring_dedup import substring_dedup
from ledgerlift.llm.token_counts import token_counts
from ledgerlift.llm.topk_search import exact_top_k
from ledgerlift.llm.toxicity import toxicity_scores
from ledgerlift.llm.vector_codes import vector_codes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=13, digest=True)


def vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern)."""
    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(table(spark, sf_dir, "documents"), *vocabulary(), form="digest")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1, digest=True)


@query
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), crc_mod(4) != 2)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of one third of the documents are held out."""
    return toxicity_scores(docs, labels, crc_mod(3) != 1)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(crc_mod(3) == 1, F.lit(True)).alias("held_out"), "score", "predicted")


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_mod(7) != 2)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = bpe(table(spark, sf_dir, "documents"), *vocabulary(), form="count")
    return token_counts(lengths)


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), min_letters=6, min_count=5, factor=5, slip_every=199)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0)


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
    FROM d, unnest(range(1, len(words) - 11)) AS r(i)
), first_seen AS (
    SELECT win, min(doc_id) AS low FROM windows GROUP BY win
), gone AS (
    SELECT DISTINCT w.doc_id, p
    FROM windows w JOIN first_seen f ON w.win = f.win AND f.low < w.doc_id, unnest(range(w.i, w.i + 13)) AS r(p)
), marks AS (
    SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id
), kept AS (
    SELECT d.doc_id, len(words) AS n_words, len(coalesce(gone, [])) AS n_removed,
        list_filter(words, lambda w, i: NOT list_contains(coalesce(gone, []), i)) AS rest
    FROM d LEFT JOIN marks USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
    sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept
"""

ORACLES["op3_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, i, line,
        translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        unnest(lines) WITH ORDINALITY AS u(line, i)
), often AS (
    SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN often o ON l.key = o.key
GROUP BY doc_id
"""

ORACLES["op4_topk_search"] = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""


def _vector_codes_sql(rounds: int = 2) -> str:
    """Integer k-means by part as plain SQL: start entries c0, then assignments a1, c1, a2, ..., and the last codes."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (
            SELECT x.vec_id, x.part, e.entry,
                CAST(list_sum(list_transform(range(1, width + 1), lambda j: (x.x[j] - e.c[j]) * (x.x[j] - e.c[j]))) AS BIGINT) AS d
            FROM x JOIN c{i} e USING (part)
        ), a{i} AS (
            SELECT vec_id, part, entry, d
            FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS r FROM d{i}) WHERE r = 1
        )""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS (
            SELECT part, entry, coalesce(m.c, o.c) AS c
            FROM c{i} o LEFT JOIN (
                SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS c
                FROM (SELECT part, entry, j, sum(x[j]) AS total, count(*) AS n
                      FROM a{i} JOIN x USING (vec_id, part), unnest(range(1, width + 1)) AS u(j) GROUP BY part, entry, j)
                GROUP BY part, entry
            ) m USING (part, entry)
        )""")
    last = rounds
    return f"""
WITH v AS (
    SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = len(embedding)
), x AS (
    SELECT vec_id, part, len(v) // 16 AS width, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x
    FROM v, unnest(range(16)) AS u(part)
), c0 AS (
    SELECT part, place - 1 AS entry, x AS c
    FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS place FROM v) USING (vec_id) WHERE place <= 64
), {", ".join(steps)}, coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM a{last} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(c[j], ',' ORDER BY part, entry, j)) FROM c{last}, unnest(range(1, len(c) + 1)) AS u(j)) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""


ORACLES["op13_vector_codes"] = _vector_codes_sql()


def _crc32_sql(letters: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a string whose characters are all below U+0800."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    byte_list = (
        f"flatten(list_transform(string_split({letters}, ''), lambda c: CASE WHEN unicode(c) < 128 "
        f"THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"
    )
    step = f"lambda a, b: xor(a >> 8, CAST({table} AS BIGINT[])[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce({byte_list}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


ORACLES["op12_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS raw FROM documents),
        (SELECT 1), unnest([translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')]) AS u(run)
    GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {_crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
          FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
    SELECT word, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), pairs AS (
    SELECT DISTINCT a.word AS a, b.word AS b FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
    UNION
    SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS form, max(w.n) AS form_n FROM pairs JOIN words w ON b = w.word GROUP BY a
), named AS (
    SELECT w.word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS at FROM named
    UNION ALL
    SELECT c.word, n.form FROM chain c JOIN named n ON c.at = n.word WHERE n.form IS NOT NULL
), roots AS (
    SELECT c.word, c.at AS root FROM chain c JOIN named n ON c.at = n.word WHERE n.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM named JOIN roots USING (word)
"""
