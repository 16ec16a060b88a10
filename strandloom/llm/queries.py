"""The registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, decontamination, embeddings, lexical, mixing, neardup, pii, quality, substrings, terms, trie, urls
from .common import table

#: Where the tokenizers' package keeps the file; operators take it as a parameter.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

URL_RULES = (
    urls.HostRule("block", "net", "/"),
    urls.HostRule("allow", "example.net", "/en/"),
    urls.HostRule("block", "example.com", "/de/"),
    urls.HostRule("allow", "org", "/fr/"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, host rule and verdict."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, urls.BLOCK_PATTERNS, URL_RULES).drop("url")


_SEP = "(?:[^a-z0-9]|^|$)"
_OP5_PATTERN = " ".join(f"WHEN regexp_matches(lower(coalesce(url, '')), '{''.join(_SEP if c == '^' else c for c in p)}') THEN '{p}'" for p in urls.BLOCK_PATTERNS)
OP5_SQL = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         CASE {_OP5_PATTERN} END AS pattern
  FROM pages),
q AS (
  SELECT page_id, pattern,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
r AS (
  SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM q)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       pattern
FROM r
"""


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and near-duplicate component at a similarity of 0.85."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated unit that goes, with its offsets and where its first occurrence stays."""
    return substrings.repeated_units(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, site posteriors, quality and decision."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component at a cosine of 0.9."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def long_patterns() -> tuple[str, ...]:
    """Some hundred pattern rules of every kind: with tokens of very different frequency, with ``*``, and without any token."""
    languages = ("en", "de", "fr", "es")
    pages = [f"/{lang}/{n}^" for lang in languages for n in range(100, 1000, 7)]
    wild = [f"^blog.*.example.{end}^{lang}^{d}*0" for end in ("org", "net") for lang in languages for d in range(1, 10)]
    return (*pages, *wild, "utm_source=*f*d", "^www.th*e.", "ththt*on", "*shly*", "erin.e")


def url_rules_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's first fitting rule of a long list, joined as tables."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, long_patterns(), URL_RULES, literal_rules=0).select("page_id", "pattern", "rule", "verdict")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, slot and place in the mix of all sources."""
    return mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, VOCABULARY)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation (and one that is hostile to the template), formatted and read back."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(hostile))
    return chat.read_back(chat.format_conversations(talks.union(extra)))


def chat_typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with an image, an audio, a document or an unknown part before each text: placeholders in order, and expanded tokens."""
    kind = F.element_at(F.array(*map(F.lit, ("image", "audio", "document", "video"))), (F.pmod("conv_id", F.lit(4)) + 1).cast("int"))
    part = lambda kind, text, ref, units: F.struct(kind.alias("kind"), text.alias("text"), ref.alias("ref"), units.cast("bigint").alias("units"))
    none = F.lit(None).cast("string")
    parts = F.array(part(kind, none, F.col("turn").cast("string"), F.col("turn")), part(F.lit("text"), F.col("text"), none, F.lit(None)))
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", parts.cast(chat.PART_TYPE).alias("parts"))
    pieces = chat.format_conversations(talks, piece_chars=2000)
    found = F.regexp_extract_all("formatted", F.lit(r"(?<!\\)<\|(\w+:\d+)\|>"), F.lit(1))
    refs = F.transform("attachments", lambda a: F.concat_ws(":", a["kind"], a["ref"], a["tokens"].cast("string")))
    lines = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", found.alias("p"), refs.alias("r")))).alias("x"), F.sum("tokens_expanded").alias("tokens_expanded"), F.sum("n_turns").alias("n_turns"))
    joined = lambda k: F.array_join(F.flatten(F.transform("x", lambda x: x[k])), ",")
    return lines.select("conv_id", "n_turns", joined("p").alias("placeholders"), joined("r").alias("attachments"), "tokens_expanded")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    found = pii.find_spans(table(spark, sf_dir, "documents"), ["doc_id"])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.filter("base", pii.is_kind(k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie.prefix_trie(trie.rebuilt(trie.turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, those that occur in benchmark items, and the items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.matches(docs, table(spark, sf_dir, "benchmark"), only=("doc_id",))
    n = F.size("items").cast("bigint").alias("n_items")
    return found.select("row.doc_id", "n_words", "n_hit", n, F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# Escapes of the template: a backslash before \\, ###, </turn> and <|; a line break in a role is written \\n.
_ESC = r"regexp_replace({0}, '(\\\\|###|</turn>|<\\|)', '\\\\\\1', 'g')".replace("\\\\", "\\")
OP8_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(replace({_ESC.format("role")}, chr(10), '\n')) + 1 + length({_ESC.format("text")}) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


CHAT_PARTS_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text, ['image', 'audio', 'document', 'video'][conv_id % 4 + 1] AS kind, ['image', 'audio', 'document', 'other'][conv_id % 4 + 1] AS shown, [256, 25, 512, 0][conv_id % 4 + 1] * greatest(turn, 1) AS tokens
  FROM conversations)
SELECT conv_id, count(*) AS n_turns, string_agg(shown || ':0', ',' ORDER BY turn, role, text) AS placeholders,
       string_agg(kind || ':' || turn || ':' || tokens, ',' ORDER BY turn, role, text) AS attachments, CAST(sum(tokens) AS BIGINT) AS tokens_expanded
FROM t GROUP BY conv_id
"""


# Smallest id that links (a, b), in both directions, reach from each node.
_WALK = """walk AS (SELECT a AS node, a AS r FROM links UNION SELECT l.b, w.r FROM walk w JOIN links l ON l.a = w.node),
comp AS (SELECT node, min(r) AS component FROM walk GROUP BY node)"""
OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
one AS (SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
{_WALK}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id, coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp c ON c.node = d.doc_id
"""
OP4_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9),
{_WALK},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component, d.vec_id) AS component_id, coalesce(c.component, d.vec_id) = d.vec_id AS kept
FROM embeddings d LEFT JOIN n ON n.a = d.vec_id LEFT JOIN comp c ON c.node = d.vec_id
"""
# Squares are added up in the order of the components, as the operator does.
OP6_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


# CRC-32 of the decimal number, bit by bit.
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), CAST(4294967295 AS BIGINT))"""
OP11_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
len AS (SELECT c, count(*) AS len FROM t GROUP BY c),
plan AS (SELECT l.c, l.c - l.c % 5 AS base, l.h, least(l.h, coalesce(b.len, 0)) AS head, l.len
         FROM (SELECT *, {_CRC} % 9 AS h FROM len) l LEFT JOIN len b ON b.c = l.c - l.c % 5),
path AS (
  SELECT p.c, pos - h + head + 1 AS d, role, text FROM plan p JOIN t ON t.c = p.c WHERE pos >= h
  UNION ALL SELECT p.c, pos + 1, role, text FROM plan p JOIN t ON t.c = p.base WHERE pos < head),
keyed AS (
  SELECT c, d, strlen(text) AS bytes, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d) AS k FROM path
  UNION ALL SELECT c, 0, 0, '' FROM plan),
node AS (SELECT d, k, min(c) AS conv, count(*) AS n, any_value(bytes) AS bytes FROM keyed GROUP BY ALL),
up AS (SELECT n.d, n.k, n.conv, p.conv AS parent FROM node n LEFT JOIN keyed x ON x.c = n.conv AND x.d = n.d - 1 LEFT JOIN node p ON p.d = x.d AND p.k = x.k),
kids AS (SELECT up.d - 1 AS d, parent, x.k, count(*) AS n FROM up JOIN keyed x ON x.c = up.conv AND x.d = up.d - 1 WHERE up.d > 0 GROUP BY up.d, parent, x.k),
below AS (
  SELECT x.d, x.k, u.n, u.bytes, coalesce(kids.n, 0) = 0 AS leaf
  FROM node u JOIN keyed x ON x.c = u.conv AND x.d <= u.d LEFT JOIN kids ON kids.d = u.d AND kids.k = u.k),
sums AS (SELECT d, k, CAST(count(*) FILTER (leaf) AS BIGINT) AS n_leaves, CAST(sum((n - 1) * bytes) AS BIGINT) AS saved_tokens FROM below GROUP BY d, k),
ends AS (SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM keyed x WHERE d = (SELECT max(y.d) FROM keyed y WHERE y.c = x.c) GROUP BY d, k)
SELECT n.conv AS conv_id, CAST(n.d AS BIGINT) AS depth, up.parent AS parent_conv_id, n.n AS n_convs, coalesce(kids.n, 0) AS n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n JOIN up ON up.d = n.d AND up.k = n.k JOIN sums s ON s.d = n.d AND s.k = n.k LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k LEFT JOIN ends e ON e.d = n.d AND e.k = n.k
"""
_LONG = ", ".join(f"({i}, '{p}', '{urls.rule_regex(p)}')" for i, p in enumerate(long_patterns()))
URL_RULES_LONG_SQL = OP5_SQL.replace("CASE " + _OP5_PATTERN + " END AS pattern\n  FROM pages)", "pattern FROM pages LEFT JOIN best USING (page_id))").replace("WITH p AS", f"""WITH rules(i, p, re) AS (VALUES {_LONG}),
hit AS (SELECT page_id, min(i) AS i FROM pages JOIN rules ON regexp_matches(lower(coalesce(url, '')), re) GROUP BY page_id),
best AS (SELECT page_id, p AS pattern FROM hit JOIN rules ON rules.i = hit.i),
p AS""", 1)
URL_RULES_LONG_SQL = f"SELECT page_id, pattern, rule, verdict FROM ({URL_RULES_LONG_SQL})"
_WORDS = f"regexp_extract_all(translate(text, '{terms.UPPER}', '{terms.LOWER}'), '{terms.WORD}')"
OP12_SQL = rf"""
WITH dt AS (SELECT doc_id, unnest({_WORDS}) AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM dt GROUP BY ALL),
nd AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM nd),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN s GROUP BY t, n_docs),
m AS (SELECT doc_id, 100 - 90 + (90 * n * n_docs) // total AS m FROM nd CROSS JOIN s),
sc AS (
  SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf ON q.t = tf.t JOIN w ON w.t = q.t JOIN m ON m.doc_id = tf.doc_id GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
_GRAM = "array_to_string(ws[i:i + {0} - 1], ' ')"
OP13_SQL = rf"""
WITH iw AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2), lambda i: {_GRAM.format("least(len(ws), 10)")})) AS g
  FROM iw WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
gram AS (SELECT doc_id, k, i, {_GRAM.format("k")} AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw CROSS JOIN ks)),
hit AS (SELECT DISTINCT a.doc_id, a.k, a.i, w.item_id FROM gram a JOIN win w ON w.k = a.k AND w.g = a.g),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for name, q in globals().items() if name.startswith("op") and name[2].isdigit()} | {"chat_typed_parts": chat_typed_parts, "url_rules_long": url_rules_long}


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": OP1_SQL, "op4_embedding_dedup": OP4_SQL, "op5_url_filter": OP5_SQL, "op6_ann": OP6_SQL, "op8_chat_format": OP8_SQL, "chat_typed_parts": CHAT_PARTS_SQL, "url_rules_long": URL_RULES_LONG_SQL, "op11_prefix_trie": OP11_SQL, "op12_lexical_search": OP12_SQL, "op13_decontaminate": OP13_SQL}
