"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chanpulse.llm import (ann, bpe, fingerprint, langid, mixing, neardup, periodic, quality,
                           sharding, tokenfile, toxicity, variants, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op1(table(spark, sf_dir, "embeddings"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op2(table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op3(table(spark, sf_dir, "documents"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op4(table(spark, sf_dir, "pages"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op6(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op7(table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op8(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op9(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op10(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op11(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.op12(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op13(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": _op1,
    "op2_bpe": _op2,
    "op3_langid": _op3,
    "op4_warc": _op4,
    "op5_quality": _op5,
    "op6_toxicity": _op6,
    "op7_fingerprints": _op7,
    "op8_sharding": _op8,
    "op9_mixing": _op9,
    "op10_neardup": _op10,
    "op11_variants": _op11,
    "op12_tokenfile": _op12,
    "op13_periodic": _op13,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CRC_TABLE = """tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(codes: str) -> str:
    """crc32 of a list of bytes, by the table ``t``."""
    return f"""xor(list_reduce(list_prepend(4294967295, {codes}),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


#: The archives' records, near copies by all pairs with a common shingle, spelling variants by
#: masked words, and periodic runs by all pairs of equal words.  The others have no SQL form:
#: curves, sketches, keyed samples, token tables and models.
ORACLE: dict[str, str] = {
    "op4_warc": """WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS latest FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM r""",
    "op10_neardup": f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION
                SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id,
       s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id""",
    "op11_variants": f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                  '[a-zÀ-ÿ]+')) AS w FROM documents),
occ AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY doc_id, w),
codes AS (SELECT w, n, list_transform(string_split(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', w), ''),
                                      lambda c: CAST(unicode(c) AS BIGINT)) AS c FROM occ),
hashed AS (SELECT w, n, {_crc("flatten(list_transform(c, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END))")} AS h
  FROM codes, tab),
taken AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT))
                 || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, n FROM hashed),
words AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM taken WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
places AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) || '*' || substr(w, i + 1) AS masked,
               substr(w, 1, i - 1) || substr(w, i + 1) AS short FROM places),
pairs AS (SELECT a.w AS a, b.w AS b, b.n AS n FROM cut a JOIN cut b ON a.masked = b.masked AND a.w <> b.w
  UNION SELECT c.w, s.w, s.n FROM cut c JOIN words s ON c.short = s.w
  UNION SELECT s.w, c.w, c.n FROM cut c JOIN words s ON c.short = s.w),
best AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS b, max(n) AS n FROM pairs GROUP BY a),
forms AS (SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * words.n THEN b END AS form,
                 CASE WHEN best.n >= 2 * words.n THEN best.n END AS form_n FROM words LEFT JOIN best ON a = words.w),
walk(w, z) AS (SELECT w, w FROM forms UNION ALL
  SELECT walk.w, forms.form FROM walk JOIN forms ON walk.z = forms.w WHERE forms.form IS NOT NULL)
SELECT f.w AS word, f.form, walk.z AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN walk ON walk.w = f.w JOIN forms g ON g.w = walk.z AND g.form IS NULL""",
    "op13_periodic": f"""WITH {_CRC_TABLE},
d AS (SELECT doc_id, row_number() OVER () AS k,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, k, w, len(w) AS n, CASE WHEN doc_id IS NULL THEN 1 ELSE {_crc("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))")} END AS h
  FROM d, tab),
p AS (SELECT doc_id, k, w, n, h % 10 = 0 AND n > 0 AS changed, CASE WHEN n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS times FROM h),
m AS (SELECT doc_id, k, n, CASE WHEN changed THEN list_transform(range(n),
        lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // times) END + 1]) ELSE w END AS w FROM p),
e AS (SELECT k, n, unnest(w) AS w, unnest(range(n)) AS i FROM m),
same AS (SELECT x.k, y.i - x.i AS q, x.i AS i FROM e x JOIN e y ON x.k = y.k AND x.w = y.w AND y.i > x.i
         WHERE 3 * (y.i - x.i) <= x.n),
isle AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM same),
stretch AS (SELECT k, q, min(i) AS s, count(*) + q AS l FROM isle GROUP BY k, q, g
            HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT * FROM stretch a WHERE NOT EXISTS (SELECT 1 FROM stretch b WHERE b.k = a.k AND b.q < a.q
           AND b.s <= a.s AND b.s + b.l >= a.s + a.l)),
per AS (SELECT k, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
               arg_min({{'s': s, 'l': l, 'q': q}}, (-CAST(l AS DOUBLE) / q, s, q)) AS b FROM runs GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT e.k, string_agg(e.w, ' ' ORDER BY e.i) AS t FROM e ANTI JOIN gone ON e.k = gone.k AND e.i = gone.i GROUP BY e.k)
SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length,
       CAST(b.q AS BIGINT) AS period, CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM m LEFT JOIN per ON per.k = m.k LEFT JOIN kept ON kept.k = m.k""",
}
