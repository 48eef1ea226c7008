"""The registered queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, collocations, decontamination, exact_dedup, language_id, line_dedup, packing, periodic_runs, personal_data, quality_rules, secret_scan, simhash_dedup, suffix_dedup
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.score_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), n_lines="n_lines", n_dropped="n_dropped")
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.find_personal_data(docs).drop("text")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    calls, results = chat_format.conversation_calls(turns)
    return chat_format.link_calls(calls, results, chat_format.TOOLS, chat_format.other_turns(turns))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.find_runs(docs)
    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    best = [F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli")
    written = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent, F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_suffix_dedup, op2_quality_rules, op3_curve_packing, op4_line_dedup, op5_language_id, op6_secret_scan, op7_personal_data, op8_simhash_dedup, op9_decontamination, op10_chat_format, op11_periodic_runs, op12_phrase_collocations, op13_exact_dedup)}


def _personal_data_sql() -> str:
    """Matches at the sums of the lengths before them, context from the text, checks and scores kind by kind."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INT) ELSE (2 * CAST(x AS INT)) // 10 + (2 * CAST(x AS INT)) % 10 END)) % 10 = 0"
    mod97 = "list_reduce(list_transform(string_split(substr(m, 5) || m[1:4], ''), lambda x: CASE WHEN x <= '9' THEN CAST(x AS INT) ELSE ascii(x) - 55 END), lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END) = 1"
    account = " OR ".join(f"(m[1:2] = '{c}' AND length(m) = {n})" for c, n in personal_data.ACCOUNT_LENGTHS.items())
    valid = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(m, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0"),
        "card": (r"[0-9](?:[ -]?[0-9])+", f"length({digits}) BETWEEN 16 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][ ().0-9-]+[0-9]", f"length({digits}) BETWEEN 8 AND 15"),
        "iban": (r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", f"({account}) AND {mod97}"),
        "card15": (r"\b3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}\b", luhn),
        "person_fr": (r"\b[12][0-9]{14}\b", "CAST(m[4:5] AS INT) BETWEEN 1 AND 12 AND 97 - CAST(m[1:13] AS BIGINT) % 97 = CAST(m[14:15] AS INT)"),
        "person_es": (r"\b[0-9]{8}-?[A-Z]\b", f"m[-1] = '{personal_data.CHECK_LETTERS}'[CAST(m[1:8] AS INT) % 23 + 1]"),
        "person_us": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "m[1:3] NOT IN ('000', '666') AND m[1] <> '9' AND m[5:6] <> '00' AND m[8:11] <> '0000'"),
        "phone_local": (r"\b0[0-9]{1,4}[ /.-][0-9]{3,4}[ .-]?[0-9]{3,5}\b", f"length({digits}) BETWEEN 9 AND 12"),
        "birth": (r"\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})\b", "coalesce(try_cast(m AS DATE), try_strptime(replace(m, '/', '.'), '%d.%m.%Y')::DATE) IS NOT NULL"),
    }
    parts = []
    for n, k in enumerate(personal_data.KINDS):
        pattern, check = valid[k.name]
        parts.append(f"""SELECT r, {n} AS o, '{k.name}' AS kind, {str(k.base).lower()} AS base, s, s + length(m) AS e, {k.score} + CASE WHEN regexp_matches(near, '{k.context}') THEN 20 ELSE 0 END - CASE WHEN regexp_matches(near, '{personal_data.OTHER_NUMBERS}') THEN 30 ELSE 0 END AS score
  FROM (SELECT r, m, s, lower(substr(t, CAST(greatest(s - 47, 1) AS BIGINT), CAST(least(s, 48) AS BIGINT)) || ' ' || substr(t, CAST(s + length(m) + 1 AS BIGINT), 48)) AS near
        FROM (SELECT r, t, ms[i] AS m, coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) + list_sum(list_transform(ps[1:i], lambda x: length(x))) AS s
              FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT r, t, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d))))
  WHERE {check}""")
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in ("email", "ip", "card", "phone"))
    union = "\n  UNION ALL ".join(parts)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS (
  {union}
), kept AS (
  SELECT * FROM f WHERE base OR (score >= 50 AND NOT EXISTS (SELECT 1 FROM f g WHERE g.base AND g.r = f.r AND f.s < g.e AND g.s < f.e))
), j AS (
  SELECT r, {counts}, string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY o, s) FILTER (base) AS b,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY o, s) AS spans, string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) || '=' || CAST(score / 100.0 AS DOUBLE), ',' ORDER BY o, s) AS scores
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN j USING (r)"""


WORD, STOP = r"[^\x20\x09-\x0D]+", ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

ORACLES: dict[str, str] = {
    "op2_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, w[i:i + 4] AS five FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
  SELECT r, five FROM windows GROUP BY r, five HAVING count(*) > 1
), places AS (
  SELECT DISTINCT r, i + k AS place FROM (SELECT r, i, unnest(range(5)) AS k FROM windows JOIN again USING (r, five))
), covered AS (
  SELECT r, count(*) AS n FROM places GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(w, lambda x: lower(trim(x, '.,;:!?"''()')) IN ({STOP}))) AS n_stop
  FROM d LEFT JOIN covered USING (r)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words::DOUBLE BETWEEN 2 AND 12 AND n_symbols / n_words::DOUBLE <= 0.1
       AND (n_stop + 1) / (n_words + 1)::DOUBLE >= 0.02 AND n_dup_lines / n_lines::DOUBLE <= 0.5 AND n_words / n_lines::DOUBLE >= 2 AS kept
FROM b""",
    "op10_chat_format": """
WITH RECURSIVE asked AS (
  SELECT conv_id, conv_id || '-' || turn AS call_id, conv_id || '-' || (turn - 2) AS p2, conv_id || '-' || (turn - 4) AS p4, turn, text,
         coalesce(contains(text, chr(10)), false) AS several, CASE WHEN length(text) < 200 THEN 'short' WHEN length(text) < 600 THEN 'middle' ELSE 'long' END AS size
  FROM conversations WHERE role = 'user'
), told AS (
  SELECT conv_id AS answer_conv, conv_id || '-' || (turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'assistant'
), edges AS (
  SELECT c.call_id, p.call_id AS parent FROM asked c JOIN asked p ON p.call_id IN (c.p2, c.p4)
), chains AS (
  SELECT call_id, 0 AS far FROM asked UNION SELECT edges.call_id, far + 1 FROM chains JOIN edges ON edges.parent = chains.call_id
), levels AS (
  SELECT call_id, max(far)::BIGINT AS level FROM chains GROUP BY call_id
), linked AS (
  SELECT coalesce(c.call_id, r.call_id) AS call_id, coalesce(conv_id, answer_conv) AS conv_id, level, CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'pending' ELSE 'linked' END AS status,
         c.call_id IS NOT NULL AND text IS NOT NULL AND CASE WHEN several THEN size <> 'long' ELSE length(text) >= 1 END AS valid,
         CASE WHEN c.call_id IS NULL THEN 0 ELSE 1 END::BIGINT AS copies, CASE WHEN several THEN 'recite' WHEN c.call_id IS NOT NULL THEN 'ask' END AS name, content,
         CASE WHEN c.call_id IS NULL THEN 'null' WHEN several THEN json_object('at', json_object('size', size, 'turn', turn), 'lines', string_split(text, chr(10)))::VARCHAR
              WHEN text IS NULL THEN json_object('turn', turn)::VARCHAR ELSE json_object('prompt', text, 'turn', turn)::VARCHAR END AS arguments
  FROM asked c FULL JOIN told r ON c.call_id = r.call_id LEFT JOIN levels ON levels.call_id = c.call_id
  UNION ALL SELECT conv_id || '-' || turn, conv_id, NULL, 'other', false, 0, role, text, 'null' FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
)
SELECT call_id, conv_id, level, status, valid, copies,
       '{"arguments":' || arguments || ',' || substr(json_object('id', call_id, 'level', level, 'name', name, 'result', content, 'status', status, 'valid', valid)::VARCHAR, 2) AS json
FROM linked""",
    "op9_decontamination": r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
i AS (
  SELECT *, len(w) AS n, least(5, len(w)) AS q, len(w) - least(5, len(w)) + 1 AS span
  FROM (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x20\x09-\x0D]+') AS w FROM benchmark, fold) WHERE len(w) > 0
), ish AS (
  SELECT item, q, sh, count(*) AS c FROM (SELECT item, q, array_to_string(w[p:p + q - 1], ' ') AS sh FROM (SELECT *, unnest(range(1, span + 1)) AS p FROM i)) GROUP BY ALL
), d AS (
  SELECT *, len(w) AS m FROM (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x20\x09-\x0D]+') AS w FROM documents, fold)
), dsh AS (
  SELECT doc, q, p, array_to_string(w[p:p + q - 1], ' ') AS sh FROM (SELECT doc, w, q, unnest(range(1, m - q + 2)) AS p FROM d, (SELECT DISTINCT q FROM i) WHERE m >= q)
), hit AS (
  SELECT doc, item, p, q FROM dsh JOIN ish USING (q, sh)
), win AS (
  SELECT DISTINCT doc, item, q, n, span, k, unnest(range(greatest(1, p - (k - q)), least(p, m - k + 1) + 1)) AS s
  FROM (SELECT hit.doc, hit.item, hit.q, p, n, span, m, least(n, m) AS k FROM hit JOIN i USING (item) JOIN d USING (doc))
), shared AS (
  SELECT doc, item, s, span, k, x.q AS q, sum(least(c, t)) AS common
  FROM (SELECT win.doc, win.item, s, span, k, win.q, sh, count(*) AS t FROM win JOIN dsh ON win.doc = dsh.doc AND win.q = dsh.q AND dsh.p BETWEEN s AND s + k - win.q GROUP BY ALL) AS x JOIN ish USING (item, sh) GROUP BY doc, item, s, span, k, x.q
), best AS (
  SELECT *, common / (span + k - q + 1 - common)::DOUBLE AS similarity FROM shared
)
SELECT doc_id, item_id, similarity, CAST(s - 1 AS BIGINT) AS start, CAST(k AS BIGINT) AS n_words
FROM (SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY similarity DESC, s) AS place FROM best WHERE similarity >= 0.8) JOIN i USING (item) JOIN d USING (doc) WHERE place = 1""",
    "op7_personal_data": _personal_data_sql(),
    "op4_line_dedup": r"""
WITH texts AS (SELECT row_number() OVER () AS r, text FROM (SELECT DISTINCT text FROM documents)),
d AS (SELECT r, string_split(text, chr(10)) AS arr FROM texts WHERE text IS NOT NULL),
t AS (
  SELECT r, i, arr[i] AS line, list_transform(string_split(regexp_replace(trim(arr[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tokens
  FROM (SELECT *, unnest(range(1, len(arr) + 1)) AS i FROM d)
), m AS (
  SELECT r, i, line, array_to_string(tokens, ' ') AS mask, len(tokens) AS n, len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf, len(list_filter(tokens, lambda x: x NOT IN ('<*>', ''))) AS solid FROM t
), seen AS (
  SELECT DISTINCT leaf, mask, n, r FROM m WHERE solid > 0
), big AS (
  SELECT leaf FROM seen GROUP BY leaf HAVING count(DISTINCT mask) >= 5
), tok AS (
  SELECT leaf, mask, n, p, string_split(mask, ' ')[p] AS token FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM (SELECT DISTINCT leaf, mask, n FROM seen SEMI JOIN big USING (leaf)))
), con AS (
  SELECT leaf, p, token FROM tok WHERE token <> '<*>' GROUP BY ALL HAVING count(*) >= 5
), shape AS (
  SELECT leaf, mask, string_agg(p || ' ' || token, ' / ' ORDER BY p) AS s FROM tok JOIN con USING (leaf, p, token) GROUP BY leaf, mask, n HAVING count(*) >= 0.6::DOUBLE * n AND max(p) > 3
), placed AS (
  SELECT r, seen.leaf, seen.mask, s FROM seen LEFT JOIN shape ON seen.leaf = shape.leaf AND seen.mask = shape.mask
), spread AS (
  SELECT leaf, s FROM placed WHERE s IS NOT NULL GROUP BY ALL HAVING count(DISTINCT r) >= 5
), alone AS (
  SELECT leaf, mask FROM placed GROUP BY ALL HAVING count(DISTINCT r) >= 5
), gone AS (
  SELECT DISTINCT r, mask, true AS goes FROM placed WHERE (leaf, mask) IN (SELECT (leaf, mask) FROM alone) OR (leaf, s) IN (SELECT (leaf, s) FROM spread)
), cut AS (
  SELECT m.r, count(*) AS n_lines, count(goes) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (goes IS NULL), '')) AS kept_sha256
  FROM m LEFT JOIN gone ON m.r = gone.r AND m.mask = gone.mask GROUP BY m.r
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, kept_sha256
FROM documents LEFT JOIN texts ON documents.text = texts.text LEFT JOIN cut USING (r)""",
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), t AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM pieces)
), n AS (
  SELECT lang, count(*) AS n FROM t GROUP BY lang
), one AS (
  SELECT lang, x, count(*) AS f FROM t GROUP BY ALL
), two AS (
  SELECT lang, x, y, count(*) AS a FROM t WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), three AS (
  SELECT lang, x, y, z, count(*) AS a FROM t WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.a, 1 AS k, p.f AS l, q.a AS r FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.a, 2, q.a, p.f FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.z JOIN two q ON q.lang = t.lang AND q.x = t.x AND q.y = t.y
  UNION ALL SELECT t.lang, t.x || ' ' || t.y, t.a, 1, p.f, q.f FROM two t JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN one q ON q.lang = t.lang AND q.x = t.y
  WHERE NOT EXISTS (SELECT 1 FROM three u WHERE u.lang = t.lang AND u.x = t.x AND u.y = t.y AND 100 * u.a >= 50 * t.a) AND NOT EXISTS (SELECT 1 FROM three u WHERE u.lang = t.lang AND u.y = t.x AND u.z = t.y AND 100 * u.a >= 50 * t.a)
), scored AS (
  SELECT *, (1000000 * a::HUGEINT * a) // (l::HUGEINT * r) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)""",
}
