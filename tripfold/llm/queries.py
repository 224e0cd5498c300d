"""The registered corpus queries over the given tables, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm import (
    decontaminate,
    filter_audit,
    fingerprints,
    html_text,
    language_id,
    language_model,
    lines,
    packing,
    secret_scan,
    simhash,
    source_audit,
    token_files,
    url_filter,
)
from tripfold.llm.common import read_table
from tripfold.sources.staging import new_folder


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs (doc_id, item_id) where the document holds 80 % of the item's shingles or more."""
    pairs = decontaminate.contained_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return pairs.select(
        F.col("doc.id").alias("doc_id"),
        F.col("item.id").alias("item_id"),
        "item_shingles",
        "shared",
        "containment",
    )


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of those it does not call held out."""
    documents = read_table(spark, sf_dir, "documents")
    out = language_id.held_out(10, 0)
    scored = language_model.score_corpus(documents, documents.where(~out))
    return scored.withColumn("held_out", out)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the documents as an ORC token corpus, read it back and sum the ids up."""
    path = new_folder(spark, "token-files")
    token_files.write_corpus(read_table(spark, sf_dir, "documents"), path)
    return token_files.with_crc32(token_files.read_corpus(spark, path))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned without the documents it calls held out."""
    documents = read_table(spark, sf_dir, "documents")
    out = language_id.held_out(4, 2)
    model = language_id.fitted(documents.where(~out))
    return language_id.identify(documents, model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash of every document and the component of near duplicates it is in."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return fingerprints.edit_report(read_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their place in sequences of at most 1024 ids."""
    return packing.with_crc32(packing.pack(read_table(spark, sf_dir, "documents")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document as spans."""
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that three sources or more share."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.without_boilerplate(documents).drop("source")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in all orders of them, per source."""
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


# Host, beginning of the path and verdict of the rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and the verdict of every page's URL."""
    rules = url_filter.rule_frame(spark, URL_RULES)
    return url_filter.judge(read_table(spark, sf_dir, "pages"), rules)


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences between the sources of a language, and the terms each stands out by."""
    return source_audit.divergences(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_model": op2_language_model,
    "op3_token_files": op3_token_files,
    "op4_language_id": op4_language_id,
    "op5_simhash": op5_simhash,
    "op6_fingerprints": op6_fingerprints,
    "op7_packing": op7_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_url_filter": op12_url_filter,
    "op13_source_audit": op13_source_audit,
}

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_SHINGLES = """
    CASE WHEN len(words) >= 5
         THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
         ELSE [] END"""

ORACLE = {
    "op1_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL),
             i AS (SELECT item_id, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL),
             short AS (SELECT DISTINCT len(words) AS n FROM i WHERE len(words) BETWEEN 1 AND 4),
             ds AS (SELECT doc_id, unnest({_SHINGLES}) AS shingle FROM d
                    UNION
                    SELECT doc_id, unnest(list_transform(range(1, len(words) - n + 2),
                                                         lambda i: array_to_string(words[i:i + n - 1], ' ')))
                    FROM d JOIN short ON n <= len(words)),
             its AS (SELECT DISTINCT item_id, unnest({_SHINGLES}) AS shingle FROM i),
             sized AS (SELECT item_id, count(*) AS item_shingles FROM its GROUP BY item_id),
             hits AS (SELECT doc_id, item_id, count(*) AS shared
                      FROM ds JOIN its USING (shingle) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
        FROM hits JOIN sized USING (item_id)
        WHERE shared >= ceil(0.8 * item_shingles - 1e-9)
    """,
    "op9_line_dedup": r"""
        WITH raw AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
             split AS (SELECT doc_id, source, unnest(parts) AS part,
                              unnest(range(len(parts))) AS position
                       FROM raw WHERE text IS NOT NULL),
             l AS (SELECT *, trim(part, E' \t\r') AS line FROM split),
             spread AS (SELECT line FROM l WHERE line <> '' GROUP BY line
                        HAVING count(DISTINCT coalesce(source, 'no source')) >= 3),
             marked AS (SELECT l.*, spread.line IS NOT NULL AND row_number() OVER (
                                   PARTITION BY l.line ORDER BY doc_id NULLS FIRST, position) > 1 AS cut
                        FROM l LEFT JOIN spread USING (line)),
             joined AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed,
                               string_agg(part, chr(10) ORDER BY position) FILTER (WHERE NOT cut) AS text
                        FROM marked GROUP BY doc_id)
        SELECT doc_id, CASE WHEN raw.text IS NULL THEN NULL ELSE coalesce(joined.text, '') END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
        FROM raw LEFT JOIN joined USING (doc_id)
    """,
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
             w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                          min(doc_id) OVER (PARTITION BY t) AS first_id
                   FROM d),
             f AS (SELECT doc_id, part,
                          (len(words) < 50)::INT
                          + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
                          + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
                          + 8 * regexp_matches(t, '[#$%&*|]')::INT
                          + 16 * coalesce(doc_id > first_id, false)::INT AS fails
                   FROM w),
             l AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
                   FROM labels GROUP BY doc_id),
             c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
                   FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
             x(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
             o AS (SELECT a.letter || b.letter || e.letter || g.letter || h.letter AS filter_order,
                          [a.bit, b.bit, e.bit, g.bit, h.bit] AS bits
                   FROM x a JOIN x b ON b.bit <> a.bit JOIN x e ON e.bit NOT IN (a.bit, b.bit)
                   JOIN x g ON g.bit NOT IN (a.bit, b.bit, e.bit) JOIN x h ON h.bit NOT IN (a.bit, b.bit, e.bit, g.bit)),
             s AS (SELECT filter_order, step::INT AS step, bits[step] AS own,
                          list_sum(list_slice(bits, 1, step)) - bits[step] AS earlier
                   FROM o, range(1, 6) r(step)),
             t AS (SELECT part, filter_order, step, own,
                          sum(n) FILTER ((fails & (own + earlier)::INT) = 0) AS kept,
                          sum(n) FILTER ((fails & earlier::INT) = 0 AND (fails & own) > 0) AS removed,
                          sum(n) FILTER ((fails & earlier::INT) > 0 AND (fails & own) > 0) AS redundant,
                          sum(n) FILTER (fails = own) AS unique_fails,
                          sum(good) FILTER ((fails & earlier::INT) = 0 AND (fails & own) > 0) AS good_lost,
                          sum(toxic) FILTER ((fails & earlier::INT) = 0 AND (fails & own) > 0) AS toxic_lost
                   FROM c, s GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM t
    """,
    "op12_url_filter": r"""
        WITH u AS (SELECT row_number() OVER () AS row_no, page_id,
                          CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
             h AS (SELECT row_no, page_id, regexp_extract(rest, '^[^/?#]*') AS given, rest FROM u),
             p AS (SELECT row_no, page_id,
                          translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(substr(rest, length(given) + 1), '^[^?#]*') AS path
                   FROM h),
             r(rule_host, rule_path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                          ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
             fits AS (SELECT row_no, rule_host || rule_path AS rule, verdict
                      FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
                      QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (row_no)
    """,
    "op13_source_audit": r"""
        WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
             occ AS (SELECT row_no, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x60\x7B-\x7F]+')) AS term FROM d),
             kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10),
             v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
             g AS (SELECT DISTINCT lang, source FROM d),
             n AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
             c AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n
                   FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
             p AS (SELECT lang, source, term, n,
                          1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
                   FROM c JOIN v USING (lang)),
             w AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
             q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
                   FROM w JOIN v USING (lang)),
             apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
                       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                       LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
                       UNION ALL
                       SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
                       FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
             ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
                        FROM every)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
}
