"""The corpus operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import (
    common,
    decontaminate,
    fingerprints,
    hard_negatives,
    id_files,
    line_dedup,
    packing,
    phrases,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

QUERIES: dict[str, "CorpusQuery"] = {}


@dataclass(frozen=True)
class CorpusQuery:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def query(name: str, sql: str | None = None):
    def register(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = CorpusQuery(build, sql)
        return fn

    return register


ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, {ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")}
    AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS home FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, line, pos, home IS NOT NULL AND home <> doc_id AS gone
  FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op1_line_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate_lines(spark, common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP4_WORDS = (
    f"coalesce(regexp_extract_all({ASCII_LOWER.format('text')}, "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)

OP4_SQL = f"""
WITH dw AS (
  SELECT doc_id, {OP4_WORDS} AS w FROM documents
), iw AS (
  SELECT item_id, w, least(len(w), 10) AS l FROM (SELECT item_id, {OP4_WORDS} AS w FROM benchmark)
  WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, l, array_to_string(w[s : s + l - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS s FROM iw)
), lens AS (SELECT DISTINCT l FROM win), starts AS (
  SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM dw CROSS JOIN lens
), hits AS (
  SELECT doc_id, s, l, item_id
  FROM (SELECT doc_id, s, l, array_to_string(w[s : s + l - 1], ' ') AS t FROM starts)
  JOIN win USING (l, t)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query("op4_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        spark, common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, common.read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    lexicon = toxicity.learn(spark, docs, common.read(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold_of(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    return toxicity.score(spark, docs, lexicon, ["doc_id"]).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, common.read(spark, sf_dir, "documents"))


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(spark, common.read(spark, sf_dir, "documents"))


NAMED_RULES = [
    url_filter.host_rule("net", "/", "block"),
    url_filter.host_rule("example.net", "/en/", "allow"),
    url_filter.host_rule("example.com", "/de/", "block"),
    url_filter.host_rule("org", "/fr/", "allow"),
]

OP5_SQL = f"""
WITH rest AS (
  SELECT page_id, row_number() OVER () AS r, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM rest
), parts AS (
  SELECT page_id, r, {ASCII_LOWER.format("h")} AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM cut
), rules(rh, rp, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS verdict
  FROM parts JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host,
  '(^|[.-])({"|".join(url_filter.BLOCKED_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (r)
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = NAMED_RULES + url_filter.DEFAULT_RULES
    judged = url_filter.judge(spark, common.read(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha,
    max(page_id) OVER (PARTITION BY html) AS keeper FROM p
), bits AS (
  SELECT *, list_aggregate(list_transform(range(1, 41),
    lambda i: lpad(bin(strpos('0123456789abcdef', sha[i]) - 1), 4, '0')), 'string_agg', '') AS b FROM d
)
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32),
    lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      1 + list_sum(list_transform(range(1, 6), lambda j: b[5 * i + j]::BIGINT << (5 - j)))::BIGINT]),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM bits
"""


@query("op8_warc", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.scratch_path(spark, "warc")
    warc.write_archives(spark, common.read(spark, sf_dir, "pages"), folder)
    found = warc.read_archives(spark, folder, with_payload=False).where("kind <> 'gap'")
    return found.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        "refers_to",
    )


@query("op9_token_ids")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.scratch_path(spark, "ids")
    manifest = id_files.write_ids(spark, common.read(spark, sf_dir, "documents"), folder)
    return id_files.read_ids(spark, folder, manifest, with_ids=False).drop("ids")


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return suffix_dedup.remove_repeats(spark, docs, with_kept=False).drop("kept")


OP11_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({ASCII_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), known AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
      FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k))
  GROUP BY ALL HAVING count(*) >= {phrases.THRESHOLD}
), longer AS (
  SELECT lang, phrase, max(f) AS around FROM (
    SELECT lang, f, array_to_string(w[s : s + m - 1], ' ') AS phrase FROM (
      SELECT lang, f, k, w, m, unnest(range(1, k - m + 2)) AS s FROM (
        SELECT lang, f, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM known WHERE k > 2)))
  GROUP BY ALL
), standing AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w
  FROM known LEFT JOIN longer USING (lang, phrase)
  WHERE k > 1 AND (around IS NULL OR 100 * around < 100 * f)
), cuts AS (
  SELECT lang, phrase, k, a, cut, array_to_string(w[: cut], ' ') AS head,
    array_to_string(w[cut + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM standing)
), scored AS (
  SELECT c.lang, c.phrase, a, cut, h.f AS l, t.f AS r, n,
    (1000::HUGEINT * a * n // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN known h ON c.lang = h.lang AND c.head = h.phrase
    JOIN known t ON c.lang = t.lang AND c.tail = t.phrase JOIN totals ON c.lang = totals.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {phrases.TOP}
"""


@query("op11_phrases", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, common.read(spark, sf_dir, "documents"))


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, common.read(spark, sf_dir, "documents"))


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id,
  row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INTEGER AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT same
  AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = common.read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_rows(table.withColumn("label", moved))
    return hard_negatives.mine(spark, rows, rows.where("vec_id % 100 = 0"))
