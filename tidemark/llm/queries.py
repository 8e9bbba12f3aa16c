"""The registered queries of these operators and their SQL."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    conversations,
    decontaminate,
    huffman,
    language,
    licenses,
    line_dedup,
    packing,
    quality,
    secrets,
    simhash,
    toxicity,
    warc,
)
from tidemark.llm.shared import load, ready

TOKENIZER = "word_bpe_49k.json"
END = 1


def remainder(rows: DataFrame, base: int) -> Column:
    return F.crc32(F.coalesce(rows["doc_id"].cast("string"), F.lit("")).cast("binary")) % base


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    found = decontaminate.contamination(
        load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents = load(spark, sf_dir, "documents")
    return packing.pack_documents(documents, public_tokenizers.path(TOKENIZER), END)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    records = warc.read(warc.write(load(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.learn(documents, labels, where=remainder(labels, 5) != 0)
    score = toxicity.scored(documents["text"], model, spark)
    return documents.select(
        "doc_id", (remainder(documents, 5) == 0).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents = load(spark, sf_dir, "documents")
    model = quality.learn(documents, load(spark, sf_dir, "labels"))
    found = quality.assessed(documents["text"], model, spark)
    counted = documents.select("doc_id", found.alias("found")).select("doc_id", "found.*")
    failed = quality.base_failed()
    content = F.col("content_share") >= quality.CONTENT_SHARE
    return counted.select(
        "doc_id", *quality.BASE, failed.alias("base_failed"), (~failed & content).alias("kept"),
        "content_share",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents = load(spark, sf_dir, "documents")
    return huffman.read(huffman.write(documents, public_tokenizers.path(TOKENIZER), END))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents = load(spark, sf_dir, "documents")
    held_out = remainder(documents, 4) == 2
    model = language.learn(documents, where=~held_out)
    found = language.identified(documents["text"], model, spark)
    return documents.select(
        "doc_id", held_out.alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.*")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(documents, counted=("n_lines", "n_removed"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    found = simhash.groups(load(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return licenses.scan(load(spark, sf_dir, "documents"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    found = secrets.scan(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[secrets.count_of("base", kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.listed("base"), 256).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    frequent, totals = collocations.frequent_phrases(load(spark, sf_dir, "documents"))
    return collocations.ranked(collocations.collocations(frequent), totals)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return conversations.audited(load(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pack": op2_pack,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_token_files": op6_token_files,
    "op7_language": op7_language,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash": op9_simhash,
    "op10_licenses": op10_licenses,
    "op11_secrets": op11_secrets,
    "op12_collocations": op12_collocations,
    "op13_conversations": op13_conversations,
}

OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size, words[i : i + least(13, len(words)) - 1] AS part
  FROM b, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS t(i) WHERE len(words) > 0),
g AS (
  SELECT r, i, size, words[i : i + size - 1] AS part
  FROM d, (SELECT DISTINCT size FROM w), unnest(range(1, len(words) - size + 2)) AS t(i)),
h AS (SELECT r, i, g.size, item_id FROM g JOIN w ON g.size = w.size AND g.part = w.part),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + size)) AS t(p) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM h) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""

OP3_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, list_transform(string_split(regexp_replace(hex, '(.)', '\1 ', 'g'), ' ')[1:40],
    lambda c: strpos('0123456789abcdef', c) - 1) AS n FROM p),
e AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((n[5 * i // 4 + 1] * 16 + coalesce(n[5 * i // 4 + 2], 0)) >> (3 - 5 * i % 4)) & 31)::INT, 1)),
    'string_agg', '') AS digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM e)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM f
"""

OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line, regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    unnest(range(1, len(lines) + 1)) AS t(i)),
c AS (
  SELECT *, sum(len(words)) OVER (PARTITION BY doc_id ORDER BY i) AS upto,
    array_to_string(words, ' ') AS content FROM l),
e AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + len(a.words) >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i) AS first, b.i AS last FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + len(a.words) >= 50 GROUP BY ALL),
w AS (
  SELECT e.doc_id, first, last, string_agg(content, chr(10) ORDER BY i) AS part
  FROM e JOIN c ON e.doc_id = c.doc_id AND c.i BETWEEN first AND last GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id, first) AS nth FROM w),
g AS (SELECT DISTINCT doc_id, i FROM r, unnest(range(first, last + 1)) AS t(i) WHERE nth > 1),
k AS (
  SELECT c.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    string_agg(line, chr(10) ORDER BY c.i) FILTER (WHERE g.i IS NULL) AS text
  FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.i = g.i GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, n_lines, n_removed
FROM documents d JOIN k USING (doc_id)
"""

def _any_case(pattern: str) -> str:
    """The pattern with both cases of each letter outside brackets and groups' marks."""
    classes = re.split(r"(\[[^\]]*\]|\\.|\(\?:)", pattern)
    return "".join(
        x if i % 2 else re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", x)
        for i, x in enumerate(classes)
    )


def _places(kind: str, pattern: str, where: str = "true") -> str:
    """SQL for the matches of a pattern: ``r, kind, m, b, e``."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT r, '{kind}' AS kind, m, upto - len(m) AS b, upto AS e FROM (
    SELECT r, m, sum(len(m) + len(gap)) OVER (PARTITION BY r ORDER BY i) AS upto FROM (
      SELECT r, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i FROM (
        SELECT r, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS gaps FROM d)))
  WHERE {where}"""


def _secrets_sql() -> str:
    assign, inside = _any_case(secrets.ASSIGN), _any_case(secrets.ASSIGN).replace("'", "''")
    value = f"len(regexp_extract(m, '{inside}', 2))"
    user = secrets.USERINFO.replace("'", "''")
    mixed = " AND ".join(f"regexp_matches(m, '{c}')" for c in ("[0-9]", "[a-z]", "[A-Z]"))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
a AS MATERIALIZED ({_places("assign", assign)}),
base AS MATERIALIZED (
  SELECT * FROM a WHERE {value} >= 12
  UNION ALL {_places("access", secrets.ACCESS, "len(m) >= 18")}
  UNION ALL {_places("hex", secrets.HEX, "len(m) >= 16")}),
u AS MATERIALIZED ({_places("user", secrets.USERINFO)}),
weak AS MATERIALIZED (
  SELECT DISTINCT r, kind, b, e FROM (
    SELECT r, 'secret' AS kind, b, e FROM a WHERE {value} BETWEEN 4 AND 11
    UNION ALL SELECT r, kind, b, e FROM ({_places("secret", _any_case(secrets.LABELLED))})
    UNION ALL SELECT r, kind, b, e FROM ({_places("secret", secrets.MIXED, mixed)})
    UNION ALL SELECT r, kind, b, e FROM ({_places("identifier", _any_case(secrets.NAMED))})
    UNION ALL SELECT r, 'identifier', b + 3, b + 3 + len(regexp_extract(m, '{user}', 1)) FROM u
    UNION ALL SELECT r, 'secret', e - 1 - len(regexp_extract(m, '{user}', 2)), e - 1 FROM u) AS w
  WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.r = w.r AND x.b < w.e AND x.e > w.b)
  UNION SELECT r, kind, b, e FROM ({_places("endpoint", secrets.URL)})
  UNION SELECT r, kind, b, e FROM ({_places("endpoint", _any_case(secrets.HOST))})),
parts AS (
  SELECT r, kind, b, e, CASE WHEN kind = 'assign' THEN 'secret' WHEN kind = 'access' THEN 'identifier'
    WHEN len(m) >= 32 THEN 'secret' ELSE '' END AS role FROM base
  UNION ALL SELECT r, kind, b, e, kind FROM weak),
breaks AS MATERIALIZED ({_places("blank", secrets.BLANK_LINE)}),
scoped AS MATERIALIZED (
  SELECT p.r, p.kind, p.b, p.e, p.role, count(k.r) AS scope FROM parts p LEFT JOIN breaks k ON k.r = p.r AND k.b <= p.b
  GROUP BY ALL),
near AS MATERIALIZED (
  SELECT x.r, x.kind, x.b, x.e, x.role, y.role AS other FROM scoped x JOIN scoped y
  ON x.r = y.r AND x.scope = y.scope AND x.role <> y.role AND x.role <> '' AND y.role <> ''
    AND x.b - y.e <= 200 AND y.b - x.e <= 200 AND (x.b <> y.b OR x.e <> y.e)),
told AS (
  SELECT DISTINCT r, kind, b, e FROM near
  WHERE kind = 'identifier' AND other = 'secret' OR kind = 'secret' AND other = 'identifier'
  UNION SELECT r, kind, b, e FROM near WHERE kind = 'endpoint' GROUP BY ALL HAVING count(DISTINCT other) = 2),
every AS (
  SELECT r, kind, b, e, true AS own FROM base UNION ALL SELECT r, kind, b, e, false FROM told),
t AS (
  SELECT r, concat(kind, ':', b, ':', e) AS span, kind, own, row_number() OVER (PARTITION BY r ORDER BY b,
    list_position(['assign', 'access', 'hex', 'identifier', 'secret', 'endpoint'], kind), e) AS nth FROM every),
l AS (
  SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY nth) FILTER (WHERE own) AS base,
    string_agg(span, ',' ORDER BY nth) AS spans FROM t GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l USING (r)
"""


OP12_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS r, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase FROM (
      SELECT *, unnest(range(1, len(words) - size + 2)) AS i
      FROM w, (SELECT unnest([1, 2, 3]) AS size)))
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM g WHERE size > 1 AND f >= 10),
e AS MATERIALIZED (
  SELECT lang, phrase, f AS a, k, array_to_string(words[1 : k], ' ') AS head,
    array_to_string(words[k + 1 : size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
k AS (
  SELECT e.lang, e.phrase, a, k, x.f AS l, y.f AS r,
    (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM e JOIN g x ON x.lang = e.lang AND x.phrase = head JOIN g y ON y.lang = e.lang AND y.phrase = tail),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM k),
o AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(words[1 : 2], ' '), array_to_string(words[2 : 3], ' ')]) AS part
    FROM c WHERE size = 3) GROUP BY ALL),
z AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM s LEFT JOIN o ON o.lang = s.lang AND o.part = s.phrase
  WHERE nth = 1 AND (o.f IS NULL OR 100 * o.f < 50 * a))
SELECT z.lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM z JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_decontaminate": OP1_SQL,
    "op3_warc": OP3_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_secrets": _secrets_sql(),
    "op12_collocations": OP12_SQL,
}
