"""The registered queries: each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagloom.llm.bpe import map_tokens
from lagloom.llm.chat import format_conversations, read_back
from lagloom.llm.dac import read_tokens, write_tokens
from lagloom.llm.decontaminate import find_contamination
from lagloom.llm.hamming import top_k
from lagloom.llm.jaccard import jaccard_components
from lagloom.llm.prefix_trie import prefix_trie
from lagloom.llm.pseudo_likelihood import pseudo_likelihood
from lagloom.llm.secret_scan import BASE_KINDS, find_secrets
from lagloom.llm.staging import table
from lagloom.llm.substrings import kept_digest, remove_repeats
from lagloom.llm.token_alignment import align_tokenizers
from lagloom.llm.toxicity import THRESHOLD, fit, score
from lagloom.llm.url_rules import judge_urls
from lagloom.session import work_path

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


# Distinct 3-word shingles, all pairs that share one, and the smallest doc_id reachable over their links.
ORACLES["op1_ngram_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT w.doc_id, CAST(coalesce((SELECT n FROM sizes s WHERE s.doc_id = w.doc_id), 0) AS BIGINT) AS n_shingles,
  least(w.doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = w.doc_id), w.doc_id)) AS component_id,
  CAST(coalesce((SELECT count(*) FROM links l WHERE l.a = w.doc_id), 0) AS BIGINT) AS n_links
FROM w
"""


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors, by the Hamming distance of their signs, of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLES["op2_exact_top_k"] = """
WITH c AS (SELECT DISTINCT vec_id, [x >= 0 for x in embedding] AS code FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, n.vec_id AS neighbor_id,
    CAST(list_sum([CASE WHEN q.code[i] = n.code[i] THEN 0 ELSE 1 END for i in range(1, len(q.code) + 1)]) AS INTEGER) AS distance
  FROM c q, c n WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS k FROM d)
SELECT query_id, CAST(k AS INTEGER) AS rank, neighbor_id, distance FROM r WHERE k <= 10
"""


@query
def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def held_out() -> Column:
    """True for documents whose labels no model may learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1


def learning_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out())


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, learning_labels(table(spark, sf_dir, "labels"))))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "op5-token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return read_tokens(spark, folder)


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "n_words long, n_removed long, kept_sha256 string"
    return remove_repeats(table(spark, sf_dir, "documents"), finish=kept_digest, schema=schema)


# Words by white space, every 20-word window with the place it first starts at, and the words that later starts cover.
ORACLES["op6_substring_dedup"] = """
WITH w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
), kept AS (
  SELECT o.doc_id, string_agg(o.word, ' ' ORDER BY o.i) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) o
  ANTI JOIN gone g ON o.doc_id = g.doc_id AND o.i = g.i
  GROUP BY o.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


def token_digest(code, ids) -> tuple[int, str, str]:
    """Number of tokens, digest of the decimal ids, digest of the decoded text."""
    own = ids.tolist()
    decimals = b" ".join(map(code.decimals.__getitem__, own))
    return len(own), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(code.decode(own).encode("utf-8")).hexdigest()


TOKEN_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


@query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_tokens(table(spark, sf_dir, "documents"), TOKENIZER, ["doc_id"], token_digest, TOKEN_DIGEST)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = f"filter(spans, s -> s.kind in {BASE_KINDS})"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in BASE_KINDS]
    digest = F.expr(f"sha2({joined.format(base)}, 256)").alias("base_sha256")
    return found.select("doc_id", *counts, digest, F.expr(joined.format("spans")).alias("spans"))


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold control strings of the template."""
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json")))


#: The rules of the query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


# Every rule against every URL, the longest that fits.
ORACLES["op12_url_filters"] = """
WITH rules(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id, url, row_number() OVER () AS row, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), best AS (
  SELECT row, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM parsed LEFT JOIN best ON parsed.row = best.row
"""


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *paths)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# Every prefix of every rebuilt conversation as a list of turns; a subtree is what the owners of its nodes pass through.
ORACLES["op13_prefix_trie"] = """
WITH RECURSIVE crc(b, r) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT) FROM range(256)
), step(b, r, k) AS (
  SELECT b, r, 0 FROM crc UNION ALL
  SELECT b, CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, k + 1 FROM step WHERE k < 8
), tab AS (SELECT list(r ORDER BY b) AS t FROM step WHERE k = 8
), own AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), digits AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS d FROM own
), crcs(conv_id, d, c, i) AS (
  SELECT conv_id, d, 4294967295, 1 FROM digits UNION ALL
  SELECT conv_id, d, xor(c // 256, t[xor(c % 256, ascii(d[i])) + 1]), i + 1 FROM crcs, tab WHERE i <= length(d)
), h AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM crcs WHERE i = length(d) + 1
), built AS (
  SELECT o.conv_id, list_concat(coalesce(l.turns, [])[:h], o.turns[h + 1:]) AS turns
  FROM own o JOIN h ON h.conv_id = o.conv_id LEFT JOIN own l ON l.conv_id = o.conv_id - o.conv_id % 100
), pairs AS (
  SELECT conv_id, d, turns[:d] AS p, d = len(turns) AS at_end
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends
  FROM pairs GROUP BY p, d
), tree AS (
  SELECT c.*, u.conv_id AS up, CASE WHEN c.d > 0 THEN (c.n - 1) * length(c.p[c.d][2]) ELSE 0 END AS saved,
    (SELECT count(*) FROM nodes k WHERE k.d = c.d + 1 AND k.p[:c.d] = c.p) AS children
  FROM nodes c LEFT JOIN nodes u ON u.d = c.d - 1 AND u.p = c.p[:c.d - 1]
)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, t.up AS parent_conv_id, t.n AS n_convs, t.children AS n_children,
  CAST(count(*) FILTER (s.children = 0) AS BIGINT) AS n_leaves, CAST(sum(s.saved) AS BIGINT) AS saved_tokens, t.ends AS ends_sha256
FROM tree t JOIN pairs q ON q.d = t.d AND q.p = t.p JOIN tree s ON s.conv_id = q.conv_id AND s.d >= t.d
GROUP BY ALL
"""
