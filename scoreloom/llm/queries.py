"""The text operators as named queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import (conversation_trie, decontaminate, embedding_dups, lexical_search, licenses, mixing, near_dups, ngram_lm, quality,
                           suffix_dedup, token_counts, token_files, toxicity)
from scoreloom.llm.common import crc_of, documents, ready

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def _quality_sql() -> str:
    """The rules of operator 1 with windows: each n-gram is the list of n words from a place on."""
    top, dup = quality.TOP_LIMITS, quality.DUPLICATE_LIMITS
    space = r"[\x20\x09-\x0D]"
    parts = [rf"""d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM x),
n AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
sp AS (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d),
l0 AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM sp),
l AS (SELECT doc_id, length(regexp_replace(line, '{space}', '', 'g')) AS chars,
        row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS rn FROM l0 WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ln AS (SELECT doc_id, count(*) FILTER (rn > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (rn > 1), 0) AS dup_line_chars
       FROM l GROUP BY doc_id)"""]
    for k in sorted({*top, *dup}):
        parts.append(f"""g{k} AS (SELECT doc_id, pos, word, list(word) OVER p AS g, count(*) OVER p AS size, sum(length(word)) OVER p AS chars
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)),
c{k} AS (SELECT doc_id, pos, word, chars, size = {k} AS whole, count(*) OVER (PARTITION BY doc_id, size, g) AS times,
  row_number() OVER (PARTITION BY doc_id, size, g ORDER BY pos) AS rn FROM g{k})""")
        if k in top:
            parts.append(f"""r{k} AS (SELECT doc_id, coalesce(max(times * chars) FILTER (whole AND times > 1), 0) AS top{k} FROM c{k} GROUP BY doc_id)""")
        else:
            cover = f"OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
            parts.append(f"""i{k} AS (SELECT doc_id, word, bool_or(whole AND rn > 1) {cover} AS later, bool_or(whole AND times > 1) {cover} AS any_
  FROM c{k}),
r{k} AS (SELECT doc_id, coalesce(sum(length(word)) FILTER (later), 0) AS dup{k}, count(*) FILTER (any_) AS rep{k} FROM i{k} GROUP BY doc_id)""")
    chars = "greatest(coalesce(word_chars, 0), 1)"
    rules = [f"coalesce(top{k}, 0) > {v!r}::DOUBLE * {chars}" for k, v in top.items()]
    rules += [f"coalesce(dup{k}, 0) > {v!r}::DOUBLE * {chars}" for k, v in dup.items()]
    rules.append(f"coalesce(dup_line_chars, 0) > {quality.LINE_CHARACTER_LIMIT!r}::DOUBLE * {chars}")
    joins = " ".join(f"LEFT JOIN {t} USING (doc_id)" for t in ("n", "ln", *(f"r{k}" for k in sorted({*top, *dup}))))
    failed = f"(n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words)"
    return f"""WITH {", ".join(parts)}, a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(rep{quality.BASE_WINDOW}, 0) AS n_repeat_words, {" OR ".join(rules)} AS rejected FROM d {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
  NOT {failed} AND NOT rejected AS kept FROM a"""


@query("op1_quality_rules", _quality_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quality.verdicts(documents(spark, sf_dir).select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return df.select("doc_id", *[f"repetition.{c}" for c in counts], "base_failed", "kept")


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_files.token_digest(docs, token_files.corpus_folder(docs), WORD_VOCABULARY)


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    _, decided = mixing.copies(docs)
    return decided.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
                          (F.col("copies") * F.col("_size")).alias("taken"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(documents(spark, sf_dir).select("doc_id", "text"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = (F.pmod(crc_of(F.col("doc_id")), F.lit(5)) == 0).alias("held_out")
    return toxicity.score(docs.select("doc_id", held_out, "text"), lexicon)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(documents(spark, sf_dir).select("doc_id", "text"), PIECE_VOCABULARY)
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"))


@query("op10_language_model")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    df = ngram_lm.scores(docs, F.pmod(crc_of(F.col("doc_id")), F.lit(5)) == 1)
    return df.withColumnRenamed("id", "doc_id")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir).select("doc_id", "text"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.found_licenses(documents(spark, sf_dir).select("doc_id", "text"))


_TRIE_SQL = r"""WITH RECURSIVE t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, count(*) AS own FROM t GROUP BY c),
crc(c, i, v) AS (  -- eight steps of one bit for each character of the decimal id
  SELECT c, 0, 4294967295::BIGINT FROM ids UNION ALL
  SELECT c, i + 1, xor(x >> 1, 3988292384 * (x & 1)) FROM (
    SELECT c, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(c::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE v END AS x FROM crc WHERE i < 8 * length(c::VARCHAR))),
h AS (SELECT c, xor(max_by(v, i), 4294967295::BIGINT) % 4 AS h FROM crc GROUP BY c),
p AS (SELECT ids.c, h, least(h, coalesce(d.own, 0)) AS shift, ids.c - ids.c % 20 AS donor
  FROM ids JOIN h USING (c) LEFT JOIN ids d ON d.c = ids.c - ids.c % 20),
r AS (SELECT p.c, t.pos, role, text FROM p JOIN t ON t.c = donor AND t.pos < shift
  UNION ALL SELECT p.c, t.pos - h + shift, role, text FROM p JOIN t USING (c) WHERE t.pos >= h),
whole AS (SELECT c, list({'r': role, 't': text} ORDER BY pos) AS turns FROM r GROUP BY c),
seq AS (SELECT c, coalesce(turns, []) AS turns FROM ids LEFT JOIN whole USING (c)),
pre AS (SELECT c, d, turns[1:d] AS node, len(turns) = d AS ends FROM seq, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)),
node AS (SELECT d, node, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS e,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) END AS w FROM pre GROUP BY d, node),
kids AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS k FROM node WHERE d > 0 GROUP BY 1, 2),
n AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids ON kids.d = node.d AND kids.node = node.node),
below AS (SELECT a.d, a.node, sum((b.n_convs - 1) * b.w) AS saved, count(*) FILTER (b.k = 0) AS leaves
  FROM n b, LATERAL (SELECT unnest(range(0, b.d + 1)) AS upto) JOIN n a ON a.d = upto AND a.node = b.node[1:upto] GROUP BY 1, 2)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.k AS n_children, leaves AS n_leaves,
  saved::BIGINT AS saved_tokens, n.e AS ends_sha256
FROM n JOIN below ON below.d = n.d AND below.node = n.node LEFT JOIN n up ON up.d = n.d - 1 AND up.node = n.node[1:n.d - 1]"""


@query("op11_conversation_trie", _TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = ready(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.turns(conversations)))


_SEARCH_SQL = rf"""WITH dt AS (SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, ts, len(ts) AS n FROM dt WHERE len(ts) > 0),
st AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, st GROUP BY term, docs),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
s AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), st GROUP BY item_id, doc_id, r)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= {lexical_search.TOP}"""


@query("op12_lexical_search", _SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lexical_search.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_EMBEDDING_SQL = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS MATERIALIZED (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dups.COSINE!r}::DOUBLE),
walk AS (SELECT r AS a, r AS b FROM v UNION SELECT walk.a, link.b FROM walk JOIN link ON link.a = walk.b),
comp AS (SELECT walk.a AS r, min(v.vec_id) AS component_id FROM walk JOIN v ON v.r = walk.b GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN comp USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n FROM link GROUP BY a) USING (r)"""


@query("op13_embedding_dups", _EMBEDDING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.classes(ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))
