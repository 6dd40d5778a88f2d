"""The operators and the pipeline as registered queries, over whole tables."""

from __future__ import annotations

import os

from .common import table


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """Path of a public tokenizer file; LLM_TOKENIZERS names another folder."""
    if folder := os.environ.get("LLM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark, sf_dir):
    from .secrets import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    from .mixing import mix_counts

    return mix_counts(table(spark, sf_dir, "documents"))


def op3_embeddings(spark, sf_dir):
    from .embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_html_text(spark, sf_dir):
    from .html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op5_language_id(spark, sf_dir):
    from .langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op6_repeats(spark, sf_dir):
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_decontaminate(spark, sf_dir):
    from .decontaminate import find_contamination

    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op8_token_counts(spark, sf_dir):
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer())


def op9_toxicity(spark, sf_dir):
    from .toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_groups(spark, sf_dir):
    from .simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark, sf_dir):
    from .vector_codes import compress

    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def op12_url_filter(spark, sf_dir):
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages")).drop("alias")


def op13_source_divergence(spark, sf_dir):
    from .divergence import audit_sources

    return audit_sources(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_mix_sources, op3_embeddings, op4_html_text, op5_language_id, op6_repeats, op7_decontaminate, op8_token_counts, op9_toxicity, op10_simhash_groups,
        op11_vector_codes, op12_url_filter, op13_source_divergence,
    )
}



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """SQL of op11: a pair of tables, assignments and codebooks, for every round."""
    steps = [
        rf"""
        kept AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, len(embedding) // {parts} AS size,
                   list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT row, part, list_slice(v, part * size + 1, (part + 1) * size) AS x
            FROM kept CROSS JOIN range({parts}) AS t(part)),
        book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM parts WHERE row <= {entries})"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""
        near{k} AS MATERIALIZED (
            SELECT row, part, min(d) AS d, arg_min(entry, d * 256 + entry) AS entry
            FROM (SELECT p.row, p.part, b.entry,
                         list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                  FROM parts p JOIN book{k} b USING (part))
            GROUP BY row, part)"""
        )
        if k < rounds:
            steps.append(
                f"""
        mean{k} AS (
            SELECT part, entry, list(m ORDER BY place) AS x
            FROM (SELECT part, entry, place, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS m
                  FROM (SELECT n.part, n.entry, unnest(p.x) AS c, generate_subscripts(p.x, 1) AS place
                        FROM near{k} n JOIN parts p USING (row, part))
                  GROUP BY part, entry, place)
            GROUP BY part, entry),
        book{k + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(CAST(m.x AS BIGINT[]), b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (part, entry))"""
            )
    return (
        "WITH "
        + ",".join(steps)
        + f""",
        coded AS (
            SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM near{rounds} GROUP BY row),
        digest AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (row), digest"""
    )


ORACLE: dict[str, str] = {
    "op2_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(concat('mix-1|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(text, ''))) AS digest
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (
            SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s),
        -- the sources that stop are the first in order of size by weight
        o AS (
            SELECT *, row_number() OVER r AS k, coalesce(sum(3 * source_size) OVER before, 0) AS stopped,
                   sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest, sum(source_size) OVER () AS total
            FROM w WINDOW r AS (ORDER BY source_size / weight, source),
                before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT arg_min((total - stopped) / rest, k) AS level FROM o
              WHERE (total - stopped) / rest * weight <= 3 * source_size),
        t AS (SELECT source, source_size, CAST(least(level * weight, 3 * source_size) AS DOUBLE) AS target FROM w, l),
        u AS (SELECT DISTINCT source, size, digest FROM d),
        p AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY size, digest) - 1) // 32 AS stratum FROM u),
        q AS (
            SELECT source, size, digest,
                   (row_number() OVER (PARTITION BY source, stratum ORDER BY CAST('0x' || substr(digest, 14, 13) AS BIGINT), size, digest) - 1
                    + CAST('0x' || substr(digest, 27, 6) AS BIGINT) / 16777216.0) / count(*) OVER (PARTITION BY source, stratum) AS u
            FROM p),
        c AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, q.u,
                   CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
            JOIN q ON d.source IS NOT DISTINCT FROM q.source AND d.size = q.size AND d.digest = q.digest)
        SELECT doc_id, size, source_size, target,
               CAST(floor(rate) AS INTEGER) + CAST(u < rate - floor(rate) AS INTEGER) AS copies,
               size * (CAST(floor(rate) AS INTEGER) + CAST(u < rate - floor(rate) AS INTEGER)) AS taken
        FROM c""",
    "op11_vector_codes": _codes_sql(),
    # the pages' own links by patterns, absolute addresses only; a class by the smallest address that can be reached
    "op12_url_filter": r"""
        WITH RECURSIVE p AS (
            SELECT page_id, url, html,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        rules(host, path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        links AS (
            SELECT DISTINCT regexp_replace(url, '#.*$', '', 's') AS a, regexp_replace(unnest(
                       regexp_extract_all(html, '(?is)<link\b[^>]*\brel="?canonical"?[^>]*\bhref="([^"]*)"', 1)
                       || regexp_extract_all(html, '(?is)<meta\b[^>]*\brefresh\b[^>]*\burl=([^"'' >]+)', 1)), '#.*$', '', 's') AS b
            FROM p),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
        judged AS (
            SELECT u, arg_max(r.verdict, length(r.host) + length(r.path)) AS verdict, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule
            FROM (SELECT DISTINCT url AS u, host, path FROM p
                  UNION SELECT b, lower(regexp_extract(b, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)),
                               regexp_extract(b, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) FROM links) n
            JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
            GROUP BY u),
        classes AS (
            SELECT node, bool_or(j.verdict = 'allow') AS allowed, bool_or(j.verdict = 'block') AS blocked
            FROM reach JOIN judged j ON regexp_replace(j.u, '#.*$', '', 's') = reach.other GROUP BY node)
        SELECT p.page_id, p.host, p.path, j.rule,
               coalesce(j.verdict, CASE WHEN c.blocked AND NOT c.allowed THEN 'block' ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN judged j ON j.u = p.url LEFT JOIN classes c ON c.node = regexp_replace(p.url, '#.*$', '', 's')""",
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        o AS (SELECT lang, source, doc, unnest(terms) AS term FROM d),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM o GROUP BY ALL),
        k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
        l AS (SELECT lang, sum(n) AS size, count(*) AS v FROM k GROUP BY lang),
        g AS (
            SELECT s.lang, s.source, coalesce(l.v, 0) AS v, coalesce(l.size, 0) AS of_lang, coalesce(t.size, 0) AS size
            FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang)
            LEFT JOIN (SELECT c.lang, c.source, sum(c.n) AS size FROM c JOIN k USING (lang, term) GROUP BY ALL) t USING (lang, source)),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   CAST(1 + 1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT // (g.size + g.v) AS BIGINT) AS p,
                   CAST(1 + 1000000000 * (k.n + 1)::HUGEINT // (g.of_lang + g.v) AS BIGINT) AS q
            FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
            FROM p WHERE n > 0 AND p > q),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200""",
}
