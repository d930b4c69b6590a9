"""The queries of the operators, with production parameters, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityframe.llm import (
    decontaminate,
    html,
    licenses,
    line_dedup,
    mixing,
    near_copies,
    pieces,
    quality,
    resample,
    secrets,
    spelling,
    tokens,
    urls,
)
from parityframe.workspace import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
END_ID = 2


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_copies(spark, sf_dir):
    return near_copies.find(table(spark, sf_dir, "documents")).drop("fp")


@query
def op2_mix_sources(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op3_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).selectExpr(
        "doc_id", "n_assign", "n_access", "n_hex", "sha2(base, 256) AS base_sha256", "spans"
    )


@query
def op4_main_text(spark, sf_dir):
    texts = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op5_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicate(docs).selectExpr(
        "doc_id",
        "n_lines",
        "n_deleted",
        "CAST(length(text) AS BIGINT) AS n_chars",
        "sha2(coalesce(text, ''), 256) AS text_sha256",
    )


@query
def op6_token_files(spark, sf_dir):
    folder = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return tokens.digest(spark, folder)


@query
def op7_licenses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text")


@query
def op8_url_filter(spark, sf_dir):
    """The block list holds the pages that some link leads to with a campaign mark."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    marked = pages.filter(F.col("url").contains("utm_source="))
    listed = marked.selectExpr(f"concat({urls.host_sql('url')}, {urls.path_sql('url')}) AS key")
    return urls.judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "CAST(size(items) AS BIGINT) AS n_items",
        "sha2(concat_ws(',', array_sort(items)), 256) AS items_sha256",
        "n_hit > 0 AS contaminated",
    )


@query
def op10_quality_bands(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = quality.measure(docs, bands=quality.FITTED)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio", "n_chunks", "n_low_chunks", "n_high_chunks",
    )


@query
def op11_sentence_pieces(spark, sf_dir):
    """``n_covered`` is the number of bytes that the spans of the pieces cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.encode(docs, model, decoded="decoded").selectExpr(
        "doc_id",
        "CAST(size(ids) AS BIGINT) AS n_tokens",
        "sha2(concat_ws(',', CAST(ids AS ARRAY<STRING>)), 256) AS ids_sha256",
        "sha2(decoded, 256) AS decoded_sha256",
        "CAST(IF(size(ids) = 0, 0, ends[size(ids) - 1] - starts[0]) AS BIGINT) AS n_covered",
    )


@query
def op12_spelling_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(docs, slip=199)


@query
def op13_resample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    drawn = resample.resample(docs, target, percent=10, min_words=20, keep_text=False)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_HOST = (
    "translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"


def _url_cases(pick: Callable[[tuple[str, str, str]], str]) -> str:
    longest = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    return " ".join(f"WHEN {_FITS.format(h=r[1], p=r[2])} THEN '{pick(r)}'" for r in longest)


ORACLES["op8_url_filter"] = f"""
WITH u AS (SELECT page_id, url, {_HOST} AS host, {_PATH} AS path FROM pages),
listed AS (SELECT DISTINCT host || path AS key FROM u WHERE contains(url, 'utm_source='))
SELECT page_id, host, path,
  CASE {_url_cases(lambda r: r[1] + r[2])} END AS rule,
  CASE {_url_cases(lambda r: r[0])}
    WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM u
"""

ORACLES["op9_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b
        WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes
        WHERE len(w) >= n)),
found AS (SELECT doc_id, grams.n, i, item_id FROM grams JOIN windows USING (n, g)),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op2_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
k AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
    md5(concat('mix-1', '|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', t)) AS tie,
    coalesce(greatest(0.05, length(regexp_replace(t, '[\x00-@\[-`{-\x7F]+', '', 'g'))::DOUBLE
      / nullif(length(t), 0)), 0.05) AS quality
  FROM d),
e AS (
  SELECT *, -ln(((('0x' || substr(tie, 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)
    / quality AS key FROM k),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM e GROUP BY source),
w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w,
    3 * source_size AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / w AS r FROM w),
f AS (
  SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER before, 0))::DOUBLE
    / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER before, 0)) AS share
  FROM r WINDOW before AS (ORDER BY r, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT r AS r0, share AS level FROM f WHERE share <= r ORDER BY r, share LIMIT 1),
t AS (
  SELECT source, source_size,
    CASE WHEN r < r0 THEN cap::DOUBLE ELSE least(cap::DOUBLE, level * w) END AS target
  FROM f, level),
g AS (
  SELECT e.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((epochs + CASE WHEN sum(size) OVER (PARTITION BY source ORDER BY key, tie
      ROWS UNBOUNDED PRECEDING) - size / 2.0 <= target - epochs * source_size
      AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM g
"""

#: CRC-32 of a text in a column ``x`` of a relation ``{from_}``: its bytes go one by one through a
#: table of 256 steps, which is made from the polynomial.
_CRC = """
crc_steps AS (
  SELECT list(list_reduce([i::BIGINT] || range(8), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS steps
  FROM range(256) r(i)),
crc AS (
  SELECT x, xor(list_reduce([4294967295] || [('0x' || substr(hex(x), 2 * k + 1, 2))::BIGINT
      for k in range(length(hex(x)) // 2)],
    lambda a, b: xor(a // 256, steps[xor(a % 256, b) + 1])), 4294967295) AS h
  FROM (SELECT DISTINCT x FROM {from_}), crc_steps)"""

_LOWERED = """translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

ORACLES["op12_spelling_variants"] = rf"""
WITH runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWERED.format("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
keyed AS (SELECT concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run) AS x, run FROM runs
          WHERE length(run) >= 6),
{_CRC.format(from_="keyed")},
made AS (
  SELECT CASE WHEN h % 199 = 0
    THEN concat(substr(run, 1, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2))
    ELSE run END AS word
  FROM keyed JOIN crc USING (x)),
words AS (SELECT word, count(*) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
cuts AS (
  SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n, a.n FROM cuts a JOIN cuts b USING (i, cut)
  WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n, c.n FROM cuts c JOIN words w ON c.cut = w.word
  UNION SELECT w.word, c.word, c.n, w.n FROM cuts c JOIN words w ON c.cut = w.word),
best AS (
  SELECT word, count(*) AS n_near,
    first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n
  FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 5 * n THEN form END AS form,
    CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS depth FROM forms
  UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN forms f ON f.word = c.root
  WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, last(root ORDER BY depth) AS root FROM chain GROUP BY word) USING (word)
""".replace("WITH runs", "WITH RECURSIVE runs", 1)

_WORDS = rf"regexp_extract_all({_LOWERED.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op13_resample"] = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
features AS (SELECT r, unnest(w) AS x FROM docs),
wanted AS (SELECT unnest({_WORDS}) AS x FROM benchmark),
pooled AS (SELECT x FROM features UNION ALL SELECT x FROM wanted),
{_CRC.format(from_="pooled")},
s AS (SELECT h % 10000 AS bucket, count(*) AS s FROM features JOIN crc USING (x) GROUP BY bucket),
t AS (SELECT h % 10000 AS bucket, count(*) AS t FROM wanted JOIN crc USING (x) GROUP BY bucket),
gains AS (
  SELECT b AS bucket, floor(1000 * ln(
    ((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000))
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain
  FROM range(10000) every(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
sums AS (
  SELECT r, count(*) AS n, sum(gain)::BIGINT AS total
  FROM features JOIN crc USING (x) JOIN gains ON gains.bucket = h % 10000 GROUP BY r),
scored AS (
  SELECT doc_id, r, coalesce(n, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256(concat('2024:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM docs LEFT JOIN sums USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id, r) AS rank
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
