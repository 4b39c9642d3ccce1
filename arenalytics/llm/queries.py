"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import mine
from .common import read_table, small_batches
from .decontaminate import contaminated
from .divergence import audit
from .language_model import score_documents
from .minhash import near_duplicates
from .packing import pack_documents
from .quality import judge_quality
from .sanitize import scan_personal_data
from .secrets import scan_secrets
from .sharding import assign_shards
from .suffix_dedup import remove_repeats
from .toxicity import classify
from .url_filter import judge_urls

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the overlap found."""
    return contaminated(read_table(spark, sf_dir, "documents"),
                        read_table(spark, sf_dir, "benchmark"))


def op2_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document (classifier chain)."""
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat an earlier one's 50-byte strings."""
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes (histogram sort)."""
    out = assign_shards(read_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens (Karmarkar-Karp)."""
    return pack_documents(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return score_documents(read_table(spark, sf_dir, "documents"))


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (b-bit MinHash)."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    return judge_quality(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "labels"))


def op10_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(read_table(spark, sf_dir, "pages")) \
        .select("page_id", "host", "path", "rule", "verdict")


def op11_branch_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return mine(read_table(spark, sf_dir, "documents"))


def op12_cube_partitioning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, and their outstanding terms."""
    return audit(read_table(spark, sf_dir, "documents"))


def op13_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that disclose it."""
    return scan_personal_data(read_table(spark, sf_dir, "documents"))


def queries() -> dict:
    def prepared(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return f(spark, sf_dir)
        run.__doc__ = f.__doc__
        return run

    return {f.__name__: prepared(f) for f in (
        op1_spaced_seeds, op2_classifier_chain, op3_prefix_doubling,
        op4_histogram_shards, op5_differencing, op6_markov_secrets,
        op7_deleted_interpolation, op8_bbit_minhash, op9_ngram_ratio,
        op10_redirect_equivalence, op11_branch_bound, op12_cube_partitioning,
        op13_disclosure)}


# The test pages hold no redirects or canonical links, so their components are
# the addresses that differ in what never changes the document.
OP10_SQL = r"""
WITH rest_of AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id, coalesce(rest, '') AS rest,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_replace(
           regexp_extract(coalesce(rest, ''), '^[^?#]*\?([^#]*)', 1),
           '(?:^|&)(?:utm_[a-z]+|fbclid|gclid)=[^&#]*', '', 'g'), '^&', '') AS query
  FROM rest_of
),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
      THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
    CASE WHEN rest <> '' THEN host || regexp_replace(path, '/$', '')
              || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS address
  FROM parts
),
judged AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                 WHEN rule IS NOT NULL THEN 'block' END AS verdict_of_rule
  FROM ruled
),
passed AS (
  SELECT address, bool_or(verdict_of_rule = 'allow') AS has_allow,
         bool_or(verdict_of_rule = 'block') AS has_block
  FROM judged WHERE address IS NOT NULL GROUP BY address
)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.verdict_of_rule, CASE WHEN p.has_allow THEN 'allow' WHEN p.has_block THEN 'block' END,
                'allow') AS verdict
FROM judged j LEFT JOIN passed p ON p.address = j.address"""


# Counts all phrases of up to three words, without the search.
OP11_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (
  SELECT doc, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
                                        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
parts AS (
  SELECT *, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND a >= 10
),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.p, c.a, cut, array_to_string(c.p[1:cut], ' ') AS head,
         array_to_string(c.p[cut + 1:], ' ') AS rest
  FROM parts c, range(1, 3) places(cut) WHERE cut < c.k
),
scored AS (
  SELECT c.*, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.k = cut AND x.phrase = head
              JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = rest
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1
),
dropped AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM best s JOIN parts t ON t.lang = s.lang AND t.k = 3 AND s.k = 2 AND 100 * t.a >= 50 * s.a
   AND (s.phrase = t.p[1] || ' ' || t.p[2] OR s.phrase = t.p[2] || ' ' || t.p[3])
),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b ANTI JOIN dropped d ON d.lang = b.lang AND d.phrase = b.phrase
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
occurring AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM texts
),
vocabulary AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM occurring
  GROUP BY ALL HAVING count(DISTINCT doc) >= 30
),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM vocabulary GROUP BY lang),
grouped AS (
  SELECT o.lang, o.source, o.term, CAST(count(*) AS HUGEINT) AS n
  FROM occurring o SEMI JOIN vocabulary k ON k.lang = o.lang AND k.term = o.term GROUP BY ALL
),
totals AS (SELECT lang, source, sum(n) AS total FROM grouped GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN totals t USING (lang, source)
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
         1 + (1000000000 * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN vocabulary k USING (lang) JOIN langs l USING (lang)
       LEFT JOIN grouped c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(s.value, 0) AS value
  FROM groups x JOIN groups y ON y.lang = x.lang AND y.source <> x.source
       LEFT JOIN (SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p)) AS value
                  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
                  GROUP BY ALL) s
              ON s.lang = x.lang AND s.source = x.source AND s.other = y.source
),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM both_parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""


def oracle_sql() -> dict[str, str]:
    return {"op10_redirect_equivalence": OP10_SQL, "op11_branch_bound": OP11_SQL,
            "op12_cube_partitioning": OP12_SQL}
