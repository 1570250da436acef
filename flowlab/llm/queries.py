"""The registered queries of these operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlab.llm import (chat_format, decontaminate, embedding_dedup, jaccard_join, licence_scan, line_dedup,
                         mixing, pii, pii_lines, quality_rules, sharding, spelling, token_alignment, url_filter)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS place,
    '<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' AS line,
    md5(to_json([role, text])) AS h
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT conv_id, place, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM r),
c AS (SELECT conv_id, max(place) AS n_turns, max_by(prefix, place) AS whole FROM p GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_equal, whole FROM c GROUP BY n_turns, whole),
inner_ AS (SELECT DISTINCT prefix FROM p JOIN c USING (conv_id) WHERE place < n_turns)
SELECT k.conv_id, k.n_turns, k.n_equal, string_agg(r.line, chr(10) ORDER BY r.place) AS text
FROM k JOIN r USING (conv_id) WHERE k.whole NOT IN (SELECT prefix FROM inner_)
GROUP BY k.conv_id, k.n_turns, k.n_equal""")
def op1_chat_format(spark, sf_dir):
    """Maximal conversations, rendered."""
    return chat_format.maximal_conversations(table(spark, sf_dir, "conversations"))


# The rules of this query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
# Names of sites that are listed as unwanted, under each of these ends.
LISTED = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_HOSTS = [f"{name}.example.{end}" for name in LISTED for end in ("com", "net", "org")]
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_LISTED = ", ".join(f"'{h}'" for h in LISTED_HOSTS)


@query(f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(r, '') AS r FROM u)),
f AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM h JOIN (VALUES {_RULES}) AS rules(h, p, v)
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
l AS (SELECT DISTINCT page_id FROM h JOIN (SELECT unnest([{_LISTED}]) AS listed_host)
    ON host = listed_host OR ends_with(host, '.' || listed_host))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN l.page_id IS NULL THEN 'allow' ELSE 'block' END)
    AS verdict, verdict IS NULL AND l.page_id IS NOT NULL AS listed
FROM h LEFT JOIN f USING (page_id) LEFT JOIN l USING (page_id)""")
def op2_url_filter(spark, sf_dir):
    """Rules, then listed sites, looked up for every url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([(h, "", url_filter.BLOCK) for h in LISTED_HOSTS],
                                   "host string, path string, verdict string")
    return url_filter.judge_urls(
        table(spark, sf_dir, "pages"),
        url_filter.rule_table(rules).union(url_filter.rule_table(listed, listed=True)))


@query()
def op3_pii(spark, sf_dir):
    """Personal data by fixed patterns and by the trained tagger."""
    model = pii.fit(spark.createDataFrame(pii_lines.labelled_lines(), "text string, spans string"))
    return pii.find_personal_data(table(spark, sf_dir, "documents"), model)


@query()
def op4_line_dedup(spark, sf_dir):
    """Documents without the blocks of lines that an earlier one has."""
    return line_dedup.drop_shared_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "row.text", "n_lines", "n_deleted")


@query()
def op5_decontaminate(spark, sf_dir):
    """Benchmark items found in whole documents, with up to 6 % of edits."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op7_shard(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query()
def op8_jaccard_join(spark, sf_dir):
    """Documents joined where their 3-word shingle sets are 90 % alike."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@query()
def op9_licence_scan(spark, sf_dir):
    """Licence phrases and notices in whole documents."""
    return licence_scan.scan_licences(table(spark, sf_dir, "documents"))


# Base rules, and lines that more than a tenth (and 10 or more) of a source's texts have.
QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest(range(8)) AS o) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM raw
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
even AS (SELECT rid, source, t, unnest(string_split(regexp_replace(regexp_replace(lower(t),
  '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), chr(10))) AS l FROM d),
lines AS (SELECT rid, source, t, trim(l, ' ') AS l FROM even WHERE trim(l, ' ') <> ''),
total AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
often AS (SELECT l.source, l.l FROM lines l JOIN total ON l.source IS NOT DISTINCT FROM total.source
  GROUP BY l.source, l.l, total.n HAVING count(DISTINCT l.t) >= 10 AND count(DISTINCT l.t) > total.n * 0.1::DOUBLE),
gone AS (SELECT x.rid, sum(len(x.l) - len(replace(x.l, ' ', '')) + 1) AS n
  FROM lines x JOIN often o ON x.source IS NOT DISTINCT FROM o.source AND x.l = o.l GROUP BY x.rid),
s AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, (len(ws) - coalesce(gone.n, 0))::BIGINT AS n_kept_words
  FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND n_kept_words >= 20 AND 100 * n_kept_words >= 30 * n_words AS kept FROM f"""


@query(QUALITY_SQL)
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("row")


@query("""
WITH RECURSIVE ok AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98::DOUBLE),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""")
def op11_embedding_dedup(spark, sf_dir):
    """Vectors of one label with a cosine of 0.98 or more."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


# CRC-32 by its table of 256 remainders, a byte at a time; near words by their texts less a letter.
SPELLING_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(r ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r FROM (SELECT unnest(range(256)) AS i))),
runs AS MATERIALIZED (SELECT id, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(
    regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
    regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
words AS MATERIALIZED (SELECT w AS word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS w FROM hashed)
  WHERE len(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS k
  FROM (SELECT word, unnest(range(len(word))) AS i FROM words)),
near AS MATERIALIZED (SELECT DISTINCT a, b FROM (
  SELECT x.word AS a, y.word AS b FROM less x JOIN less y USING (i, k) WHERE x.word <> y.word
  UNION ALL SELECT l.word, k FROM less l JOIN words w ON w.word = l.k
  UNION ALL SELECT k, l.word FROM less l JOIN words w ON w.word = l.k)),
best AS (SELECT a, count(*) AS n_near, min((-n, b)) AS m FROM near JOIN words ON word = b GROUP BY a),
forms AS MATERIALIZED (SELECT word, n, n_near, CASE WHEN -m[1] >= 5 * n THEN m[2] END AS form,
    CASE WHEN -m[1] >= 5 * n THEN -m[1] END AS form_n FROM words LEFT JOIN best ON a = word),
chain AS (SELECT word, word AS root, 0 AS step FROM words
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.n, coalesce(n_near, 0)::BIGINT AS n_near, form, form_n::BIGINT AS form_n, r.root
FROM forms f JOIN (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word) r USING (word)"""


@query(SPELLING_SQL)
def op12_spelling_variants(spark, sf_dir):
    """Words one edit apart, each with its far more frequent form."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


TOKENIZERS = "/opt/tokenizers"


@query()
def op13_token_alignment(spark, sf_dir):
    """Tokens of a byte-level and of a piece vocabulary over the same bytes."""
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json",
                                        f"{TOKENIZERS}/piece_bpe_32k.model")
