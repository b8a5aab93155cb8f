"""The training-data queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.ann import nearest
from gridweave.llm.bpe import encoding_digests
from gridweave.llm.conversation_repair import repair_damaged
from gridweave.llm.decontamination import WIDTH, contamination_digests
from gridweave.llm.filter_audit import filter_audit
from gridweave.llm.langid import language_ids
from gridweave.llm.ngram_join import NGRAM, OVER, UNDER, ngram_components
from gridweave.llm.online_packing import pack_online
from gridweave.llm.pii import span_digests
from gridweave.llm.quality import LINE_DOCS, MAX_REMOVED, MAX_REPEAT_PERCENT, MIN_WORDS, quality_rules
from gridweave.llm.sharding import balanced_shards
from gridweave.llm.spark_util import importable
from gridweave.llm.token_packing import pack_documents
from gridweave.llm.url_filter import filter_urls, url_host

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


#: Dated entries of the filter list: host, day from which the action holds, action.
URL_LIST = (
    ("spam-farm.example.org", "2024-01-10", "block"),
    ("spam-farm.example.org", "2024-06-01", "remove"),
    ("spam-farm.example.org", "2024-09-15", "block"),
    ("cheap-pills.example.com", "2024-03-01", "block"),
    ("cheap-pills.example.com", "2024-11-01", "allow"),
    ("tionsh.example.net", "2024-02-01", "block"),
    ("tionsh.example.net", "2024-02-20", "remove"),
    ("tionsh.example.net", "2024-07-04", "block"),
    ("tionsh.example.net", "2024-07-05", "remove"),
    ("example.org", "2024-04-01", "block"),
    ("example.org", "2024-04-08", "remove"),
    ("blog.tionble.example.com", "2024-01-01", "allow"),
    ("tionble.example.com", "2024-05-05", "block"),
    ("m.tiontion.example.com", "2024-08-01", "block"),
)

#: Of the page host whose least page is p: the action that starts on day (p * number) mod 366.
HOST_ENTRIES = ((1, "block"), (7, "allow"), (13, "remove"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry no fetch time: page p counts as fetched 4099 * p minutes into 2024, wrapped after 366 days. The list is the
    fixed entries and three for every host of the pages, on days that follow from its least page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(pmod(page_id * 4099, 527040)), 0)").alias("fetched_at"))
    fixed = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(h).alias("host"), F.to_timestamp_ntz(F.lit(d), F.lit("yyyy-MM-dd")).alias("at"), F.lit(a).alias("action")) for h, d, a in URL_LIST))))
    least = pages.groupBy(url_host(F.col("url")).alias("host")).agg(F.min("page_id").alias("p")).where("host IS NOT NULL")
    days = F.array(*(F.struct(F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(pmod(p * {k}, 366)))").alias("at"), F.lit(a).alias("action")) for k, a in HOST_ENTRIES))
    return filter_urls(pages, fixed.unionByName(least.select("host", F.inline(days))))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(_table(spark, sf_dir, "documents"))


def op6_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_online(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("n_removed_words"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_packing, op2_url_filter, op3_ngram_jaccard_join, op4_pii, op5_language_id, op6_online_packing, op7_quality_rules, op8_ann, op9_bpe, op10_sharding, op11_conversation_repair, op12_decontamination, op13_filter_audit)}


_URL_ORACLE = f"""WITH caught AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes(CAST((page_id * 4099) % 527040 AS BIGINT)) AS fetched_at,
  nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '[.]$', ''), '') AS url_host FROM pages),
least_page AS (SELECT url_host AS host, min(page_id) AS p FROM caught WHERE url_host IS NOT NULL GROUP BY url_host),
listed(host, since, action) AS (VALUES {", ".join(f"('{h}', TIMESTAMP '{d}', '{a}')" for h, d, a in URL_LIST)} {" ".join(f"UNION ALL SELECT host, TIMESTAMP '2024-01-01' + to_days(CAST((p * {k}) % 366 AS INT)), '{a}' FROM least_page" for k, a in HOST_ENTRIES)}),
entries AS (SELECT host, since, arg_max(action, CASE action WHEN 'remove' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS action FROM listed GROUP BY host, since),
labels AS (SELECT DISTINCT url_host, fetched_at, string_split(url_host, '.') AS parts FROM caught WHERE url_host IS NOT NULL AND fetched_at IS NOT NULL),
above AS (SELECT url_host, fetched_at, array_to_string(parts[k:], '.') AS name FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM labels)),
latest AS (SELECT url_host, fetched_at, name, max(since) AS listed_from, arg_max(action, since) AS action FROM above JOIN entries ON name = host AND since <= fetched_at GROUP BY ALL),
best AS (SELECT url_host, fetched_at, arg_max({{'n': name, 'a': action, 'f': listed_from}}, length(name)) AS v FROM latest WHERE action <> 'remove' GROUP BY ALL)
SELECT page_id, url, caught.fetched_at, caught.url_host, v.n AS listed_host, v.a AS list_action, v.f AS listed_from FROM caught LEFT JOIN best ON caught.url_host = best.url_host AND caught.fetched_at = best.fetched_at"""

_WORD = r"[^\x20\x09-\x0D]+"
_QUALITY_ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words FROM d),
win AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
raw AS (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT r, host, line, array_to_string(regexp_extract_all(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '{_WORD}'), ' ') AS norm, len(regexp_extract_all(line, '{_WORD}')) AS n FROM raw WHERE regexp_matches(line, '{_WORD}')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
limited AS (SELECT host, norm FROM lines GROUP BY host, norm HAVING count(DISTINCT r) > {LINE_DOCS}),
gone AS (SELECT r, sum(n) AS n FROM lines l JOIN limited m ON l.host = m.host AND l.norm = m.norm GROUP BY r),
c AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words FROM w LEFT JOIN dups USING (r) LEFT JOIN cover USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND n_removed_words <= {MAX_REMOVED} * n_words AS kept FROM c"""


#: All links by brute force, from all pairs that share a shingle; then their closure.
_JACCARD_ORACLE = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words FROM documents),
grams AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < {NGRAM} THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + {NGRAM - 1}], ' ') END AS gram FROM (SELECT *, unnest(range(1, greatest(len(words) - {NGRAM - 2}, 2))) AS i FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE {UNDER} * common >= {OVER} * (p.n + q.n - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) AS component_id FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON w.doc_id = least.x"""


_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: All windows of documents, of every length that items have, joined with those of items.
_LEAKS_ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_TERM}') AS words FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_TERM}') AS words FROM benchmark),
win AS (SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS win FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM (SELECT *, least(len(words), {WIDTH}) AS k FROM b WHERE len(words) > 0))),
spots AS (SELECT r, k, i, array_to_string(words[i:i + k - 1], ' ') AS win FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(words) >= k)),
hits AS (SELECT r, k, i, item FROM spots JOIN win USING (k, win)),
words_hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
held AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(words_hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(held.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(words_hit.n, 0) > 0 AS contaminated FROM d LEFT JOIN words_hit USING (r) LEFT JOIN held USING (r)"""

#: Every document through every order: each filter's failures, then all prefixes of all orders.
_AUDIT_ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id),
f AS (SELECT d.*, coalesce(good, false) AS good, coalesce(bad, false) AS bad, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN len(words) < 100 WHEN 'B' THEN 100 * len(list_distinct(words)) < 80 * len(words)
  WHEN 'C' THEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) WHEN 'D' THEN regexp_matches(text, '[#$%&*|]') ELSE coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) END) AS fails FROM d LEFT JOIN l USING (doc_id)),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(k AS INT) AS step, filter_order[k] AS x, string_split(filter_order[1:k - 1], '') AS before FROM orders, range(1, 6) AS t(k)),
kinds AS (SELECT part, fails, good, bad, count(*) AS n FROM f GROUP BY ALL),
told AS (SELECT part, filter_order, step, x, n, good, bad, list_contains(fails, x) AS failing, list_has_any(fails, before) AS gone, fails = [x] AS alone FROM kinds, steps),
rows_of AS (SELECT part, filter_order, step, x, CAST(sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN failing AND NOT gone AND bad THEN n ELSE 0 END) AS BIGINT) AS toxic_lost FROM told GROUP BY part, filter_order, step, x)
SELECT * EXCLUDE (x), CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM rows_of"""


#: The dynamic programme by recursion over places, with the edits as texts; all conversations on their own.
_REPAIR_ORACLE = r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM keyed),
placed AS (SELECT conv_id, turn, role, text, left(role, 1) AS ini, row_number() OVER w AS place, lag(left(role, 1)) OVER w AS before, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN place > min(place) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
nexts(a, b) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
ins(st, onto, extra, pre) AS (SELECT a, a, 0, '' FROM nexts UNION ALL SELECT a, b, 2, 'I' FROM nexts UNION ALL SELECT x.a, y.b, 4, 'II' FROM nexts x JOIN nexts y ON x.b = y.a),
keeps(onto, ini, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
moves AS (SELECT st, onto, CAST(NULL AS VARCHAR) AS ini, extra + 3 AS cost, pre || 'D' AS edits FROM ins UNION ALL SELECT st, b, NULL, extra + 2, pre || 'R' FROM ins JOIN nexts ON onto = a UNION ALL SELECT st, b, ini, extra, pre || 'K' FROM ins JOIN keeps USING (onto)),
layers AS (SELECT conv_id, 0 AS place, 0 AS st, 0 AS cost, '' AS audit FROM (SELECT DISTINCT conv_id FROM faults) UNION ALL
  SELECT l.conv_id, f.place, onto, min(l.cost + m.cost + CASE WHEN fault = 'truncated' AND edits NOT LIKE '%D' THEN 1 ELSE 0 END), arg_min(audit || edits, (l.cost + m.cost + CASE WHEN fault = 'truncated' AND edits NOT LIKE '%D' THEN 1 ELSE 0 END, audit || edits))
  FROM layers l JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.place = l.place + 1 JOIN moves m ON m.st = l.st AND (m.ini IS NULL OR m.ini = f.ini) AND (edits LIKE '%D' OR fault NOT IN ('blank', 'duplicate')) GROUP BY l.conv_id, f.place, onto),
ends(st, extra, post) AS (VALUES (0, 0, ''), (3, 0, ''), (2, 2, 'I'), (1, 4, 'II')),
best AS (SELECT l.conv_id, min(cost + extra) AS cost, arg_min(audit || post, (cost + extra, audit || post)) AS audit FROM layers l JOIN ends USING (st) JOIN (SELECT conv_id, max(place) AS n FROM faults GROUP BY conv_id) t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND n = l.place GROUP BY l.conv_id),
edits AS (SELECT conv_id, audit, j, audit[j] AS edit, len(replace(audit[1:j], 'I', '')) AS place, len(replace(audit[1:j], 'D', '')) AS m FROM best, unnest(range(1, len(audit) + 1)) AS t(j)),
lines AS (SELECT e.conv_id, j, edit, m, f.role, CASE edit WHEN 'I' THEN '' ELSE f.text END AS text, max(CASE WHEN m = 1 AND edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.place = e.place WHERE edit <> 'D'),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS whole FROM lines GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _URL_ORACLE, "op3_ngram_jaccard_join": _JACCARD_ORACLE, "op7_quality_rules": _QUALITY_ORACLE, "op11_conversation_repair": _REPAIR_ORACLE, "op12_decontamination": _LEAKS_ORACLE, "op13_filter_audit": _AUDIT_ORACLE}
