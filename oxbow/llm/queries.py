"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oxbow.llm import (bpe, collocations, conversations, exact_dedup, licenses, line_dedup, mixing, quality_rules,
                       simhash, token_counts, topk, toxicity, warc)
from oxbow.llm.common import documents, table


#: Fixed value: the date given to response records made from ``pages``, which has none.
PAGE_DATE = "2024-01-01T00:00:00Z"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_counts.token_counts(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_report(documents(spark, sf_dir), shingle=3, radius=3)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.responses(table(spark, sf_dir, "pages"), "page_id", PAGE_DATE)
    derived = warc.derive(records, keep=("page_id",))
    return derived.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "concurrent_to",
                          "source_digest", "block_digest", F.octet_length("block").cast("long").alias("block_bytes"),
                          F.sha2("record", 256).alias("record_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir), words=line_dedup.WORDS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(documents(spark, sf_dir)), "standard.1")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(turns), turns, stable_input=True)


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), longest=3, least=10, top=2000)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_line_dedup": op6_line_dedup,
    "op6_passage_dedup": op6_passage_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_exact_topk": op12_exact_topk,
    "op13_phrase_collocations": op13_phrase_collocations,
}

def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


#: The text extraction of the oracle, apart from the operator's own.
_SQL_HTML_RULES = (
    (r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)", ""),
    (r"(?i)</?(a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|u)\b[^>]*>", ""),
    (r"<[^>]*>", "\n"),
    (r"[ \t\r\x0B\f]{2,}|[\t\r\x0B\f]", " "),
    (r" ?\n[ \n]*", "\n"),
)
_SQL_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
                 ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def _sql_html_text(html: str) -> str:
    """A text extraction as DuckDB SQL."""
    for pattern, to in _SQL_HTML_RULES:
        html = f"regexp_replace({html}, {_sql_text(pattern)}, E{_sql_text(to).replace(chr(10), chr(92) + 'n')}, 'g')"
    html = f"trim({html}, E' \\n')"
    for entity, char in _SQL_ENTITIES:
        html = f"replace({html}, {_sql_text(entity)}, {_sql_text(char)})"
    return html


def _sql_uuid(kind: str, seed: str) -> str:
    h = f"md5({_sql_text(kind)} || chr(31) || {seed})"
    parts = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {parts} || '>'"


_WARC_SQL = f"""
    WITH s AS (
      SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html, E'\\r\\n' AS nl FROM pages),
    p AS (
      SELECT *, {_sql_uuid('response', "CAST(page_id AS VARCHAR) || chr(31) || uri")} AS id,
             nullif(trim(html, ''), '') IS NULL AS nothing,
             'sha256:' || sha256(html) AS source_digest,
             {_sql_html_text("html")} AS plain,
             {_sql_html_text("regexp_extract(html, '(?is)<title[^>]*(?:>|\\z)(.*?)(?:</title|\\z)', 1)")} AS title
      FROM s),
    q AS (
      SELECT *, {_sql_uuid('conversion', 'id')} AS conv, {_sql_uuid('metadata', 'id')} AS meta,
             'sha256:' || sha256(plain) AS plain_digest FROM p),
    r AS (
      SELECT page_id, 'conversion' AS warc_type, conv AS record_id, id, uri, nl, NULL AS concurrent_to,
             source_digest, 'text/plain; charset=utf-8' AS mime, plain AS block FROM q
      UNION ALL
      SELECT page_id, 'metadata', meta, id, uri, nl, conv, source_digest, 'application/warc-fields',
             CASE WHEN title <> '' THEN 'title: ' || title || nl ELSE '' END
             || 'http-status: 200' || nl || 'source-payload-digest: ' || source_digest || nl
             || 'source-block-digest: sha256:' || sha256('HTTP/1.1 200 OK' || nl
               || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || strlen(html) || nl || nl
               || html) || nl
             || 'text-digest: ' || plain_digest || nl || 'text-length: ' || strlen(plain) || nl
             || 'digest-match: true' || nl || 'http-header: Content-Type: text/html; charset=utf-8' || nl
             || 'http-header: Content-Length: ' || strlen(html) FROM q)
    SELECT page_id, warc_type, record_id, id AS refers_to, nullif(uri, '') AS target_uri, concurrent_to,
           source_digest, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS block_bytes,
           sha256('WARC/1.1' || nl || 'WARC-Type: ' || warc_type || nl || 'WARC-Record-ID: ' || record_id || nl
             || CASE WHEN uri <> '' THEN 'WARC-Target-URI: ' || uri || nl ELSE '' END
             || 'WARC-Date: {PAGE_DATE}' || nl || 'WARC-Refers-To: ' || id || nl
             || CASE WHEN uri <> '' THEN 'WARC-Refers-To-Target-URI: ' || uri || nl ELSE '' END
             || 'WARC-Refers-To-Date: {PAGE_DATE}' || nl
             || CASE WHEN concurrent_to IS NULL THEN '' ELSE 'WARC-Concurrent-To: ' || concurrent_to || nl END
             || 'Content-Type: ' || mime || nl || 'WARC-Block-Digest: sha256:' || sha256(block) || nl
             || 'Content-Length: ' || strlen(block) || nl || nl || block) AS record_sha256
    FROM r"""

_LICENSE_SQL = f"""
    WITH known(sentence, id) AS (VALUES {', '.join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in licenses.KNOWN.items())}),
    rules(n, name, ids) AS (VALUES {', '.join(f"({i}, {_sql_text(name)}, {_sql_text('|' + '|'.join(ids) + '|')})" for i, (name, ids) in enumerate(licenses.EVERY_RULE))}),
    s AS (
      SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
      FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?;:])[ \t\r]+', E'\\1\n', 'g'),
                                        chr(10)) AS l FROM documents)),
    f AS (
      SELECT doc_id, list(id ORDER BY i) AS ids
      FROM s JOIN known ON sentence = trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) GROUP BY doc_id),
    m AS (
      SELECT doc_id, string_agg(name, ',' ORDER BY n) AS licenses
      FROM (SELECT f.doc_id, name, min(n) AS n FROM f, rules
            WHERE contains('|' || array_to_string(f.ids, '|') || '|', rules.ids) GROUP BY f.doc_id, name)
      GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(f.ids), 0)::BIGINT AS n_sentences,
           coalesce(array_to_string(f.ids, ','), '') AS sentence_ids, coalesce(m.licenses, '') AS licenses
    FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id"""

#: A state is the best {cost, edits, repaired lines} from here on, as a struct, so the
#: least struct is the cheapest, then the ASCII-least.
_REPAIR_SQL = r"""
    WITH RECURSIVE src AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
    crc AS (
      SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
                      lambda h, c: list_reduce(list_concat([xor(h, c)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
                    4294967295) % 20 AS kind
      FROM src),
    dam AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM crc),
    num AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             rtrim(text, E' \t\n\x0b\x0c\r') AS bare FROM dam),
    bad AS (
      SELECT *, left(role, 1) AS c,
             CASE WHEN bare = '' THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
    stats AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
             count(*) FILTER (WHERE fault = 3) AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
      FROM bad GROUP BY conv_id),
    dp AS (
      SELECT conv_id, n + 1 AS i,
             {'c': 0::BIGINT, 'e': '', 'l': []::VARCHAR[]} AS o,
             {'c': 10::BIGINT, 'e': 'II', 'l': ['user:', 'assistant:']} AS s,
             {'c': 5::BIGINT, 'e': 'I', 'l': ['assistant:']} AS u,
             {'c': 0::BIGINT, 'e': '', 'l': []::VARCHAR[]} AS a FROM stats
      UNION ALL
      SELECT conv_id, i,
             list_min([o, {'c': u.c + 5, 'e': 'I' || u.e, 'l': list_concat(['user:'], u.l)},
                          {'c': a.c + 10, 'e': 'II' || a.e, 'l': list_concat(['user:', 'assistant:'], a.l)}]),
             list_min([s, {'c': u.c + 5, 'e': 'I' || u.e, 'l': list_concat(['user:'], u.l)},
                          {'c': a.c + 10, 'e': 'II' || a.e, 'l': list_concat(['user:', 'assistant:'], a.l)}]),
             list_min([u, {'c': a.c + 5, 'e': 'I' || a.e, 'l': list_concat(['assistant:'], a.l)}]),
             list_min([a, {'c': u.c + 5, 'e': 'I' || u.e, 'l': list_concat(['user:'], u.l)}])
      FROM (
        SELECT conv_id, i,
               list_min(list_filter([del_o, ku, ru, CASE WHEN c = 's' THEN ks END], lambda x: x IS NOT NULL)) AS o,
               list_min(list_filter([del_s, ku, ru], lambda x: x IS NOT NULL)) AS s,
               list_min(list_filter([del_u, ka, ra], lambda x: x IS NOT NULL)) AS u,
               list_min(list_filter([del_a, ku, ru], lambda x: x IS NOT NULL)) AS a
        FROM (
          SELECT d.conv_id, b.i, b.c,
                 {'c': d.o.c + 2, 'e': 'D' || d.o.e, 'l': d.o.l} AS del_o, {'c': d.s.c + 2, 'e': 'D' || d.s.e, 'l': d.s.l} AS del_s,
                 {'c': d.u.c + 2, 'e': 'D' || d.u.e, 'l': d.u.l} AS del_u, {'c': d.a.c + 2, 'e': 'D' || d.a.e, 'l': d.a.l} AS del_a,
                 CASE WHEN fault IN (0, 3) AND b.c = 'u' THEN
                   {'c': d.u.c + 5 * (fault = 3)::INT, 'e': 'K' || d.u.e, 'l': list_concat([b.role || ':' || b.text], d.u.l)} END AS ku,
                 CASE WHEN fault IN (0, 3) AND b.c = 'a' THEN
                   {'c': d.a.c + 5 * (fault = 3)::INT, 'e': 'K' || d.a.e, 'l': list_concat([b.role || ':' || b.text], d.a.l)} END AS ka,
                 CASE WHEN fault IN (0, 3) THEN
                   {'c': d.s.c + 5 * (fault = 3)::INT, 'e': 'K' || d.s.e, 'l': list_concat([b.role || ':' || b.text], d.s.l)} END AS ks,
                 CASE WHEN fault IN (0, 3) THEN
                   {'c': d.u.c + 1 + 5 * (fault = 3)::INT, 'e': 'R' || d.u.e, 'l': list_concat(['user:' || b.text], d.u.l)} END AS ru,
                 CASE WHEN fault IN (0, 3) THEN
                   {'c': d.a.c + 1 + 5 * (fault = 3)::INT, 'e': 'R' || d.a.e, 'l': list_concat(['assistant:' || b.text], d.a.l)} END AS ra
          FROM dp d JOIN bad b ON b.conv_id IS NOT DISTINCT FROM d.conv_id AND b.i = d.i - 1)))
    SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(dp.o.c, 0) AS cost,
           coalesce(dp.o.e, '') AS audit, sha256(coalesce(array_to_string(dp.o.l, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) k
    LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM k.conv_id
    LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM k.conv_id AND dp.i = 1"""

ORACLE_SQL = {
    "op5_warc_derivatives": _WARC_SQL,
    "op6_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
          FROM documents),
        k AS (
          SELECT doc_id, i, trim(line, E' \t\r\x0b\x0c') AS x,
                 row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
          FROM l WHERE trim(line, E' \t\r\x0b\x0c') <> ''),
        w AS (
          SELECT doc_id, j, x AS a, lead(x) OVER o AS b, lead(x, 2) OVER o AS c
          FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY j)),
        u AS (
          SELECT doc_id, j, j + 2 AS e, '3' AS kind, concat(a, chr(10), b, chr(10), c) AS x FROM w WHERE c IS NOT NULL
          UNION ALL SELECT doc_id, 1, max(j), 'whole', string_agg(x, chr(10) ORDER BY j)
          FROM k GROUP BY doc_id HAVING count(*) < 3),
        r AS (
          SELECT doc_id, j, e, row_number() OVER (PARTITION BY kind, x ORDER BY doc_id, j) > 1 AS later FROM u),
        gone AS (
          SELECT DISTINCT k.doc_id, k.i FROM k JOIN r ON r.doc_id = k.doc_id AND r.later
           AND k.j BETWEEN r.j AND r.e)
        SELECT l.doc_id, count(*) FILTER (WHERE k.x IS NOT NULL) AS n_lines, count(gone.i) AS n_removed,
               sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), ''))
                 AS text_sha256
        FROM l LEFT JOIN k USING (doc_id, i) LEFT JOIN gone USING (doc_id, i) GROUP BY l.doc_id""",
    "op6_passage_dedup": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
          FROM documents),
        k AS (
          SELECT doc_id, i, trim(line, E' \t\r\x0b\x0c') AS x,
                 len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                 row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
          FROM l WHERE trim(line, E' \t\r\x0b\x0c') <> ''),
        w AS (
          SELECT doc_id, j, x AS a, lead(x) OVER o AS b, lead(x, 2) OVER o AS c, n, n + lead(n) OVER o AS n2
          FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY j)),
        u AS (
          SELECT doc_id, j, j + 2 AS e, '3' AS kind, concat(a, chr(10), b, chr(10), c) AS x FROM w WHERE c IS NOT NULL
          UNION ALL SELECT doc_id, j, j + 1, '2', concat(a, chr(10), b) FROM w WHERE n2 >= 50
          UNION ALL SELECT doc_id, j, j, '1', a FROM w WHERE n >= 50
          UNION ALL SELECT doc_id, 1, max(j), 'whole', string_agg(x, chr(10) ORDER BY j)
          FROM k GROUP BY doc_id HAVING count(*) < 3),
        r AS (
          SELECT doc_id, j, e, row_number() OVER (PARTITION BY kind, x ORDER BY doc_id, j) > 1 AS later FROM u),
        gone AS (
          SELECT DISTINCT k.doc_id, k.i FROM k JOIN r ON r.doc_id = k.doc_id AND r.later
           AND k.j BETWEEN r.j AND r.e)
        SELECT l.doc_id, count(*) FILTER (WHERE k.x IS NOT NULL) AS n_lines, count(gone.i) AS n_removed,
               sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), ''))
                 AS text_sha256
        FROM l LEFT JOIN k USING (doc_id, i) LEFT JOIN gone USING (doc_id, i) GROUP BY l.doc_id""",
    "op8_license_scan": _LICENSE_SQL,
    "op7_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
          FROM documents),
        g AS (
          SELECT norm, count(*) AS group_size,
                 arg_min(doc_id, (-points, doc_id)) AS keep_id
          FROM t GROUP BY norm)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
               sha256(t.norm) AS text_sha256
        FROM t JOIN g USING (norm)""",
    "op10_quality_rules": r"""
        WITH t AS (
          SELECT doc_id, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
          FROM documents),
        w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
        win AS (
          SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        rep AS (
          SELECT doc_id, i,
                 c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS r
          FROM win),
        cov AS (
          SELECT doc_id, bool_or(r) OVER (PARTITION BY doc_id ORDER BY i
                                          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered
          FROM rep),
        n AS (SELECT doc_id, count(*) FILTER (WHERE covered) AS n FROM cov GROUP BY doc_id),
        m AS (
          SELECT t.doc_id, len(words)::BIGINT AS n_words,
                 length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(n.n, 0) AS n_repeat_words, len(lines)::BIGINT AS n_lines,
                 length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaims
          FROM t LEFT JOIN n USING (doc_id)),
        f AS (
          SELECT *,
                 (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
                 + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
                 + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
                 + 32 * (10 * n_exclaims > 3 * n_words)::INT AS fail_bits
          FROM m)
        SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept FROM f""",
    "op11_conversation_repair": _REPAIR_SQL,
    "op12_exact_topk": r"""
        WITH v AS (
          SELECT row_number() OVER () AS i, vec_id,
                 list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
          FROM embeddings
          WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(64 * x::DOUBLE))) = len(embedding)),
        s AS (
          SELECT q.i, q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
          FROM v q JOIN v d ON d.i <> q.i WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_phrase_collocations": r"""
        WITH p AS (
          SELECT row_number() OVER () AS p, lang, piece FROM (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        l AS (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        w AS (SELECT p, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM l),
        g AS (
          SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY p ORDER BY i)),
        f AS (
          SELECT lang, phrase, k, count(*) AS f FROM (
            SELECT lang, a AS phrase, 1 AS k FROM g
            UNION ALL SELECT lang, a || ' ' || b, 2 FROM g WHERE b IS NOT NULL
            UNION ALL SELECT lang, a || ' ' || b || ' ' || c, 3 FROM g WHERE c IS NOT NULL)
          GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND f >= 10),
        cut AS (
          SELECT lang, phrase, k, f, i, array_to_string(s[1:i], ' ') AS x, array_to_string(s[i+1:], ' ') AS y
          FROM (SELECT *, unnest(range(1, k)) AS i FROM cand)),
        sc AS (
          SELECT c.lang, c.phrase, c.f, c.i, x.f AS l, y.f AS r,
                 (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
          FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
        low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
        inside AS (
          SELECT lang, phrase, max(f) AS f FROM (
            SELECT lang, f, s[1] || ' ' || s[2] AS phrase FROM cand WHERE k = 3
            UNION ALL SELECT lang, f, s[2] || ' ' || s[3] FROM cand WHERE k = 3) GROUP BY ALL),
        kept AS (
          SELECT low.* FROM low LEFT JOIN inside ON inside.lang = low.lang AND inside.phrase = low.phrase
          WHERE inside.f IS NULL OR 100 * inside.f < 50 * low.f)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a,
               l, r, n, score::BIGINT AS score
        FROM kept JOIN n USING (lang)
        QUALIFY rank <= 2000""",
}
