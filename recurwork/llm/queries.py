"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurwork.llm import ann, bpe, chat, fim, html_text, langid, line_dedup, mixing, ngram_join, secrets, spelling, syncmers, warc
from recurwork.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.through_archives(spark, table(spark, sf_dir, "pages"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


# The conversation that the contract adds.
EXTRA_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, table(spark, sf_dir, "embeddings"))


# The targets of the mixture.  A source's domain follows from its number.
DOMAINS = ("web", "books", "forum")
WEIGHTS = (mixing.Weights({"web": 50, "books": 35, "forum": 15}, 5), mixing.Weights({"en": 45, "de": 20, "fr": 20, "es": 15}, 5), mixing.Weights({}, 1))
MIX_SEED = 2024


def domain_of_source() -> Column:
    number = F.regexp_extract("source", "([0-9]{1,6})$", 1)
    names = F.array(*map(F.lit, DOMAINS))
    return F.when(number != "", F.element_at(names, F.try_to_number(number, F.lit("999999")).cast("int") % len(DOMAINS) + 1)).otherwise("other")


def share_of_all(percent: int) -> Column:
    """A budget of so many hundredths of all tokens, rounded down."""
    return F.expr(f"(sum(tokens) * {percent}) div 100")


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), domain_of_source(), WEIGHTS, share_of_all(90), max_epochs=3, seed=MIX_SEED)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents"))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_html_text": op2_html_text,
    "op3_warc": op3_warc,
    "op4_language": op4_language,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_chat_format": op6_chat_format,
    "op7_nearest": op7_nearest,
    "op8_mixture": op8_mixture,
    "op9_ngram_join": op9_ngram_join,
    "op10_syncmers": op10_syncmers,
    "op11_fim": op11_fim,
    "op12_spelling": op12_spelling,
    "op13_line_dedup": op13_line_dedup,
}

SQL = {}

SQL["op6_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w IS DISTINCT FROM role AS opens,
    length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|SEP\])', '\1\\\2\3', 'g')) AS role_chars,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|SEP\])', '\1\\\2\3', 'g')) AS text_chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN opens THEN length('<s>[INST]') + role_chars + length('[/INST]') + length('</s>')
                ELSE length('[SEP]') END + text_chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

SQL["op8_mixture"] = r"""
WITH counted AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN regexp_extract(source, '([0-9]{1,6})$', 1) <> ''
         THEN ['web', 'books', 'forum'][CAST(regexp_extract(source, '([0-9]{1,6})$', 1) AS INT) % 3 + 1] ELSE 'other' END AS domain,
    coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, 3 * sum(n_tokens)::HUGEINT AS room,
    CASE domain WHEN 'web' THEN 50 WHEN 'books' THEN 35 WHEN 'forum' THEN 15 ELSE 5 END::HUGEINT AS w_domain,
    CASE lang WHEN 'en' THEN 45 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 15 ELSE 5 END::HUGEINT AS w_lang, 1::HUGEINT AS w_source
  FROM counted WHERE n_tokens > 0 GROUP BY ALL
), d1 AS (
  SELECT domain, w_domain AS w, sum(room)::HUGEINT AS room, (SELECT (sum(tokens) * 90)::HUGEINT // 100 FROM leaves)::HUGEINT AS total FROM leaves GROUP BY domain, w_domain
), d2 AS (  -- the level of the water: the first child that is not filled sets it
  SELECT *, total - coalesce(sum(room) OVER (ORDER BY room::DOUBLE / w::DOUBLE, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS remains,
    sum(w) OVER (ORDER BY room::DOUBLE / w::DOUBLE, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weight_left FROM d1
), d3 AS (
  SELECT *, (SELECT min_by(ROW(remains, weight_left), room::DOUBLE / w::DOUBLE) FROM d2 WHERE room * weight_left > w * remains) AS lvl FROM d2
), domains AS (
  SELECT domain, CASE WHEN room * weight_left <= w * remains THEN room ELSE least(room, greatest(0, (w * lvl[1]) // lvl[2])) END AS budget FROM d3
), l1 AS (
  SELECT domain, lang, w_lang AS w, sum(room)::HUGEINT AS room, any_value(budget) AS total FROM leaves JOIN domains USING (domain) GROUP BY domain, lang, w_lang
), l2 AS (
  SELECT *, total - coalesce(sum(room) OVER (PARTITION BY domain ORDER BY room::DOUBLE / w::DOUBLE, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS remains,
    sum(w) OVER (PARTITION BY domain ORDER BY room::DOUBLE / w::DOUBLE, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weight_left FROM l1
), l3 AS (
  SELECT domain, min_by(ROW(remains, weight_left), ROW(room::DOUBLE / w::DOUBLE, lang)) AS lvl FROM l2 WHERE room * weight_left > w * remains GROUP BY domain
), langs AS (
  SELECT domain, lang, CASE WHEN room * weight_left <= w * remains THEN room ELSE least(room, greatest(0, (w * lvl[1]) // lvl[2])) END AS budget
  FROM l2 LEFT JOIN l3 USING (domain)
), s2 AS (
  SELECT leaves.*, budget AS total, budget - coalesce(sum(room) OVER (PARTITION BY domain, lang ORDER BY room::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS remains,
    count(*) OVER (PARTITION BY domain, lang ORDER BY room::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weight_left
  FROM leaves JOIN langs USING (domain, lang)
), s3 AS (
  SELECT domain, lang, min_by(ROW(remains, weight_left), ROW(room::DOUBLE, source)) AS lvl FROM s2 WHERE room * weight_left > remains GROUP BY domain, lang
), plan AS (
  SELECT domain, lang, source, tokens, CASE WHEN room * weight_left <= remains THEN room ELSE least(room, greatest(0, lvl[1] // lvl[2])) END AS budget
  FROM s2 LEFT JOIN s3 USING (domain, lang)
), keyed AS (
  SELECT c.*, budget, budget // tokens AS epochs, budget % tokens AS rest,
    ('0x' || substr(md5('2024:' || CAST(budget // tokens AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS k
  FROM counted c JOIN plan USING (domain, lang, source) WHERE n_tokens > 0
), chosen AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM keyed
)
SELECT doc_id, domain, lang, source, n_tokens, CAST(budget AS BIGINT) AS leaf_budget, CAST(epochs + CASE WHEN until <= rest THEN 1 ELSE 0 END AS BIGINT) AS times FROM chosen
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, CAST(coalesce(budget, 0) AS BIGINT), 0 FROM counted LEFT JOIN plan USING (domain, lang, source) WHERE n_tokens = 0
"""

SQL["op9_ngram_join"] = r"""
WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM numbered
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r
  JOIN sizes p ON p.r = a.r JOIN sizes q ON q.r = b.r
  GROUP BY a.r, b.r, p.n, q.n HAVING 9 * count(*) >= 4 * (p.n + q.n)
), reached(x, y) AS (
  SELECT r, r FROM numbered UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
)
SELECT doc_id, class_id, n_links FROM numbered
JOIN (SELECT x AS r, min(doc_id) AS class_id FROM reached JOIN numbered ON numbered.r = reached.y GROUP BY x) USING (r)
JOIN (SELECT numbered.r, count(links.y) AS n_links FROM numbered LEFT JOIN links ON links.x = numbered.r GROUP BY numbered.r) USING (r)
"""

SQL["op11_fim"] = r"""
WITH dealt AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), units AS (
  SELECT *, CASE WHEN t = '' THEN 0 ELSE len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END END AS n FROM dealt
), cuts AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units
), pieces AS (
  SELECT doc_id, t, n, form, least(c1, c2) AS a, greatest(c1, c2) AS b, parts,
    array_to_string(parts[1:least(c1, c2)], chr(10)) || CASE WHEN least(c1, c2) BETWEEN 1 AND len(parts) - 1 THEN chr(10) ELSE '' END AS prefix,
    array_to_string(parts[greatest(c1, c2) + 1:], chr(10)) AS suffix FROM cuts
), dealt_out AS (
  SELECT *, array_to_string(parts[a + 1:b], chr(10)) || CASE WHEN b > a AND b < len(parts) THEN chr(10) ELSE '' END AS middle FROM pieces
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
         ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM dealt_out
"""

SQL["op13_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k, max(doc_id) AS owner FROM (SELECT DISTINCT r, doc_id, k FROM keyed WHERE length(k) >= 40) GROUP BY k HAVING count(*) >= 5
), marked AS (
  SELECT r, keyed.doc_id, line, i, often.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM owner AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
