"""The queries of this subpackage, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm import (
    chat,
    collocations,
    exact_dedup,
    hidden_markov,
    html_extract,
    language_id,
    mixing,
    ngram_join,
    pii,
    quality,
    sentencepiece_codec,
    source_audit,
    warc,
)
from peerbench.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_exact_dedup",
    f"""WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.DigestIndex(spark).add(read(spark, sf_dir, "documents"))


SQL_RATES = f"""sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
  [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sized GROUP BY source),
held AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
  sum(3 * source_size) OVER w AS cap, sum(weight) OVER w AS cap_weight
  FROM sources WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST)),
level AS (SELECT greatest(max(CASE WHEN weights > cap_weight THEN (total - cap)::DOUBLE / (weights - cap_weight) END),
  max(total::DOUBLE / weights)) AS level FROM held),
rates AS (SELECT source, source_size, least(weight * level, 3.0::DOUBLE * source_size) AS target FROM sources, level)"""
SQL_COPIES = """floor(rate)::BIGINT + CASE WHEN ('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT
    / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END"""


@query(
    "op5_mixing",
    f"""WITH {SQL_RATES},
rated AS (SELECT s.doc_id, s.source, s.size, r.source_size, r.target,
  CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
drawn AS (SELECT *, {SQL_COPIES} AS copies FROM rated)
SELECT doc_id, source, size::BIGINT AS size, source_size, target, copies, copies * size AS taken FROM drawn""",
)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents"))


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
_LISTED = ", ".join(f"'{x}'" for x in quality.LISTED)
#: Counts and verdict of the quality rules over `{source}`, a table with doc_id and text.
SQL_QUALITY = f"""texts AS (SELECT doc_id, coalesce(lang IN ({_LISTED}), false) AS is_listed, coalesce(text, '') AS t FROM {{source}}),
split AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM texts),
windows AS (SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows)
  WHERE n > 1),
covered AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM repeated) GROUP BY doc_id),
counts AS (SELECT s.doc_id, s.is_listed, len(w)::BIGINT AS n_words,
  length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words
  FROM split s LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  list_filter([
    CASE WHEN n_words < 10 THEN 'words' END,
    CASE WHEN word_chars / nullif(n_words, 0) < 2 OR word_chars / nullif(n_words, 0) > 20 THEN 'mean_word_length' END,
    CASE WHEN n_symbols / nullif(n_words, 0) > 0.2 THEN 'symbols_per_word' END,
    CASE WHEN is_listed AND n_words >= 30 AND n_stop_words / n_words < 0.02 THEN 'stop_words' END,
    CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.4 THEN 'repeated_lines' END,
    CASE WHEN 100 * n_repeat_words / nullif(n_words, 0) > 20 THEN 'repeated_words' END], lambda x: x IS NOT NULL) AS failed
  FROM counts)"""


@query(
    "op9_quality_rules",
    f"""WITH {SQL_QUALITY.format(source="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words,
  base_failed, array_to_string(failed, ',') AS failed, NOT base_failed AND len(failed) = 0 AS kept FROM judged""",
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(read(spark, sf_dir, "documents"))
    return found.selectExpr(*[c if c != "failed" else "array_join(failed, ',') AS failed" for c in found.columns])


@query("op2_ngram_jaccard_join")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.NgramJoin(read(spark, sf_dir, "documents")).components()


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    prototypes = language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict(docs, prototypes)
    return found.withColumn("held_out", language_id.held_out(F.col("doc_id")))


@query(
    "op4_warc",
    """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
q AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM q""",
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("payload", "url")


#: The key of the pseudonyms in the query; a user passes their own.
PII_KEY = "catalogue"


#: The model that the query encodes with; a user names their own file.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(read(spark, sf_dir, "documents"), sentencepiece_codec.Model.load(MODEL_FILE))


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(read(spark, sf_dir, "documents"), PII_KEY)
    return found.selectExpr("doc_id", "text", "n_found", "array_join(kinds, ',') AS kinds")


_CONTROL = r"<\\*(?:/?s>|<TURN |</TURN>>)|\[\\*/?INST\]"


@query(
    "op10_chat_formatting",
    f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')) v),
u AS (SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + CASE role WHEN 'user' THEN 15
  WHEN 'assistant' THEN 6 ELSE 20 + length(url_encode(role)) END AS n FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, 3 + sum(n) AS formatted_chars
  FROM u GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars FROM g""",
)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], chats.schema)
    return chat.digests(chat.format_chats(chats.unionByName(probe)))


_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op11_collocations",
    rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w[i:i + m - 1] AS words, m FROM spans, (SELECT unnest(range(1, 6)) AS m) ms WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, array_to_string(words, ' ') AS phrase, words, m, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, phrase, m, f, unnest(range(1, m)) AS k, words FROM f WHERE m > 1),
scored AS (SELECT c.lang, c.phrase, c.m, c.f AS a, k, l.f AS l, r.f AS r, n, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ') JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.m > b.m AND f.f >= b.a
  AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query("op12_hidden_markov")
def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.HiddenMarkov(read(spark, sf_dir, "documents")).score()


@query(
    "op13_source_audit",
    rf"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT i) AS docs
  FROM (SELECT i, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 3),
grid AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
shares AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g)::HUGEINT AS p,
  1 + (1000000000::HUGEINT * (total + 1)) // (sum(total) OVER g + count(*) OVER g)::HUGEINT AS q
  FROM grid WINDOW g AS (PARTITION BY lang, source)),
pairs AS (SELECT lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
)
def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.SourceAudit(read(spark, sf_dir, "documents")).report()
