"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (bpe, collocations, decontaminate, exact_dedup, lexical_search, lm_scoring, near_dedup, quality, secret_scan, token_counts, toxicity,
                            url_filter, warc)
from ledgerline.llm.storage import documents, table
from ledgerline.session import scratch_path


def op1_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and their decoding of every whole text."""
    return bpe.encode_documents(documents(spark, sf_dir), bpe.default_tokenizer(spark, "word_bpe_49k.json"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups at 85 % and the document that stays."""
    return near_dedup.near_groups(documents(spark, sf_dir), percent=85)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return decontaminate.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row that stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every whole text."""
    return toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of good documents against all."""
    return lm_scoring.score_documents(documents(spark, sf_dir), lm_scoring.good_ids(table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts through a digest cache. Each call has a cache of its own,
    so a result never depends on earlier calls."""
    return token_counts.count_tokens(documents(spark, sf_dir),
                                     bpe.default_tokenizer(spark, "byte_bpe_50k.json"),
                                     scratch_path(spark, "token-counts"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return lexical_search.rank_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases."""
    return collocations.collocations(documents(spark, sf_dir))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules and by the link graph."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe_transducer, op2_minhash_near_dedup, op3_quality_classifier, op4_decontamination,
                              op5_exact_dedup, op6_warc, op7_secret_scan,
                              op8_toxicity, op9_lm_scoring, op10_token_counts, op11_lexical_search,
                              op12_collocations, op13_url_filter)}



def _url_filter_sql() -> str:
    """The rules, the host graph and the two propagations, a step a CTE."""
    u = url_filter
    lower = f"translate({{}}, '{u.UPPER}', '{u.LOWER}')"
    fits = [(r, f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')")
            for r in sorted(u.RULES, key=lambda r: (-len(r.name), r.name))]
    name, verdict = ("CASE " + " ".join(f"WHEN {f} THEN '{getattr(r, of)}'" for r, f in fits) + " END"
                     for of in ("name", "verdict"))
    link = u.LINK.replace("'", "''")
    steps, before = [], "start"
    for n in range(1, u.STEPS + 1):
        steps.append(f"""s{n} AS MATERIALIZED (SELECT kind, host, sum(score)::BIGINT AS score FROM (
              SELECT w.kind, w.dst AS host, {u.DAMPING} * s.score // (100 * w.degree) AS score
              FROM ways w JOIN {before} s ON w.kind = s.kind AND w.src = s.host
              UNION ALL SELECT kind, host, {100 - u.DAMPING} * score // 100 FROM start)
              GROUP BY kind, host HAVING sum(score) > 0)""")
        before = f"s{n}"
    return f"""
        WITH parts AS (
               SELECT page_id, {lower.format(f"regexp_extract(coalesce(url, ''), '{u.HOST}', 1)")} AS host,
                      regexp_extract(coalesce(url, ''), '{u.PATH}', 1) AS path,
                      regexp_extract_all(coalesce(html, ''), '{link}', 1) AS links FROM pages),
             found AS MATERIALIZED (SELECT *, {name} AS rule, {verdict} AS verdict FROM parts),
             hosts AS (SELECT DISTINCT host FROM found WHERE host <> ''),
             edges AS MATERIALIZED (SELECT DISTINCT src, dst FROM (
               SELECT host AS src, {lower.format("unnest(links)")} AS dst FROM found WHERE host <> ''
               UNION ALL SELECT host, regexp_extract(host, '^[^.]*[.](.+)$', 1) FROM hosts
                 WHERE regexp_extract(host, '^[^.]*[.](.+)$', 1) IN (SELECT host FROM hosts))
               WHERE src <> dst AND dst <> ''),
             both_ways AS (SELECT 'allow' AS kind, src, dst FROM edges UNION ALL SELECT 'block', dst, src FROM edges),
             ways AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, src) AS degree FROM both_ways),
             seeds AS (SELECT verdict AS kind, host, count(*) AS n FROM found
                       WHERE host <> '' AND verdict IS NOT NULL GROUP BY 1, 2),
             start AS MATERIALIZED (SELECT kind, host,
               ({u.MASS}::HUGEINT * n // sum(n) OVER (PARTITION BY kind))::BIGINT AS score FROM seeds),
             {", ".join(steps)},
             scores AS (SELECT host, coalesce(sum(score) FILTER (kind = 'allow'), 0)::BIGINT AS trust,
                               coalesce(sum(score) FILTER (kind = 'block'), 0)::BIGINT AS distrust
                        FROM {before} GROUP BY host)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN 100 * distrust > {u.BLOCK_PERCENT} * (trust + distrust) THEN 'block' ELSE 'allow' END)
                 AS verdict,
               coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
        FROM found LEFT JOIN scores USING (host)"""


_LOWER_TEXT = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

ORACLE: dict[str, str] = {
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER_TEXT}) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
             g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100
                   GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN p.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN p.page_id <> g.first THEN g.first END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest)""",
    "op11_lexical_search": f"""
        WITH t AS (SELECT row, doc_id, unnest(regexp_extract_all({_LOWER_TEXT}, '{_TERM}')) AS term
                   FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
             p AS MATERIALIZED (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
             d AS MATERIALIZED (SELECT row, sum(tf)::BIGINT AS n FROM p GROUP BY row),
             c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
             df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
             i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_TEXT}, '{_TERM}')) AS term FROM benchmark),
             s AS (SELECT i.item_id, p.doc_id, sum(floor(1000 * ln((2 * c.docs + 2) / (2 * df.df + 1)))::BIGINT
                          * (1000000000 * p.tf // (1000 * p.tf + 20 * (50 + 50 * d.n * c.docs // c.terms))))::BIGINT AS score
                   FROM i JOIN p USING (term) JOIN df USING (term) JOIN d ON d.row = p.row, c GROUP BY i.item_id, p.row, p.doc_id),
             r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
                          doc_id, score FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 50""",
    "op12_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER_TEXT}, '[.,;:!?\\x0A-\\x0D]')) AS piece
                   FROM documents),
             w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
             g AS (SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
                   UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) FROM w
                   UNION ALL SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)])
                             FROM w),
             c AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL
                                HAVING count(*) >= 10),
             n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
             cuts AS (
               SELECT c.lang, c.k, c.phrase, c.f AS a, j.j, x.f AS l, y.f AS r,
                      (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
               FROM c JOIN (VALUES (1), (2)) j(j) ON j.j < c.k
               JOIN c x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:j.j], ' ')
               JOIN c y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j.j + 1:], ' ')),
             best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
             longer AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, f
                        FROM c WHERE k = 3),
             inside AS (SELECT lang, phrase, max(f) AS f FROM longer GROUP BY ALL),
             ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
                               b.phrase, a, l, r, score
                        FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
                        WHERE i.f IS NULL OR b.k = 3 OR 100 * i.f < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_url_filter": _url_filter_sql(),
}
