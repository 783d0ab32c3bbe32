"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.llm import (
    byte_bpe,
    decontamination,
    exact_dedup,
    filter_audit,
    language_id,
    ngram_join,
    packing,
    sharding,
    source_divergence,
    substring_dedup,
    token_counts,
    token_files,
    url_filters,
)
from lakesales.llm.common import cut, read_table
from lakesales.llm.tokens import tokenizer_path
from lakesales.session import scratch_path

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


# --- 1 URL filters ---------------------------------------------------------------------------------

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]

_SQL_URLS = """
WITH rules(rhost, rpath, rverdict) AS (VALUES {rules}),
u AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT u.*, rhost || rpath AS r, rverdict FROM u LEFT JOIN rules
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(r) DESC NULLS LAST) AS k FROM m)
SELECT page_id, host, path, r AS rule, coalesce(rverdict, 'allow') AS verdict FROM n WHERE k = 1
""".replace("{rules}", ", ".join(repr(r) for r in URL_RULES))


@query("op1_url_filters", _SQL_URLS)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in URL_RULES])))
    return url_filters.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


# --- 6 Sharding ------------------------------------------------------------------------------------

SHARDS = 8


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.assign_shards(sized, "doc_id", [1.0] * SHARDS)
    placed = sharding.assign_shards(placed, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    slots = sharding.number_slots(placed, "shard", "doc_id", ["size", "text_crc32", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# --- 8 Exact dedup ---------------------------------------------------------------------------------


@query("op8_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


# --- 3, 9, 10 Tokens -------------------------------------------------------------------------------

CAPACITY = 4096


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_files.token_index(spark, path)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents went in, were revised to count an end id each, the revision was delivered
    twice, and documents labelled toxic were taken down."""
    docs = read_table(spark, sf_dir, "documents")
    first = cut(token_counts.count_tokens(docs, tokenizer_path(), "word_bpe_49k"), "counts")
    ended = first.withColumn("n_tokens", F.col("n_tokens") + 1)
    toxic = read_table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("1-arrived", token_counts.inserts(first))
    for _ in range(2):
        rollup.commit("2-ended", token_counts.revisions(first, ended))
    rollup.commit("3-taken-down", token_counts.deletes(ended.join(toxic, "doc_id", "left_semi")))
    return rollup.totals()


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), 1, CAPACITY)


# --- 7 Language ID ---------------------------------------------------------------------------------


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    profiles = language_id.learn_profiles(docs.filter(~held_out))
    found = language_id.identify(docs, profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# --- 5 Substring dedup -----------------------------------------------------------------------------


@query("op5_substring_dedup", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')
             AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM p),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS gone FROM h JOIN r USING (k)),
g AS (SELECT doc_id, list(gone) AS gone FROM c GROUP BY doc_id),
k AS (SELECT doc_id, w, CASE WHEN gone IS NULL THEN w ELSE
        list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


# --- 4 N-gram Jaccard join -------------------------------------------------------------------------


@query("op4_ngram_jaccard", r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a),
k AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
  (SELECT count(*) FROM l WHERE a = d.doc_id)::BIGINT AS n_links
FROM d JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


# --- 2 Benchmark decontamination -------------------------------------------------------------------


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# --- 11 Source divergence audit --------------------------------------------------------------------


@query("op11_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, row, term, count(*) AS n FROM (SELECT lang, source, row, unnest(w) AS term FROM d)
  GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM t GROUP BY ALL HAVING count(*) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, sum(t.n) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT DISTINCT lang, source FROM d),
lt AS (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY lang),
st AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(st.total, 0) + 2 * lt.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 2) // (lt.total + 2 * lt.v) AS q
  FROM s JOIN k ON s.lang = k.lang JOIN lt ON lt.lang = s.lang LEFT JOIN st ON st.lang = s.lang AND st.source = s.source
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(read_table(spark, sf_dir, "documents"))


# --- 12 Byte-level BPE -----------------------------------------------------------------------------


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = byte_bpe.ranks_path(), byte_bpe.piece_pattern()
    tokens = byte_bpe.encode(read_table(spark, sf_dir, "documents"), path, pattern)
    return byte_bpe.decode(tokens, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# --- 13 Filter interaction audit -------------------------------------------------------------------


@query("op13_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w FROM d),
e AS (SELECT x, min(doc_id) AS least FROM d GROUP BY x),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS MATERIALIZED (SELECT part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
    100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x), regexp_matches(x, '[#$%&*|]'),
    coalesce(w.doc_id > least, false)] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    count(*) AS n
  FROM w JOIN e USING (x) LEFT JOIN l ON w.doc_id = l.doc_id GROUP BY ALL),
o AS (SELECT [a, b, c, d, e] AS o FROM range(1, 6) ta(a), range(1, 6) tb(b), range(1, 6) tc(c), range(1, 6) td(d),
    range(1, 6) te(e) WHERE len(list_distinct([a, b, c, d, e])) = 5),
s AS (SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step,
    o[step] AS filter, fails[o[step]] AS hit, list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])) AS before,
    len(list_filter(fails, lambda y: y)) AS failed, good, toxic, n FROM f, o, range(1, 6) ts(step)),
r AS (SELECT part, filter_order, step, filter,
    sum(CASE WHEN NOT hit AND NOT coalesce(before, false) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT coalesce(before, false) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND coalesce(before, false) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN hit AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND good AND NOT coalesce(before, false) THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND toxic AND NOT coalesce(before, false) THEN n ELSE 0 END) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.fail_masks(read_table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.with_labels(masks, read_table(spark, sf_dir, "labels")))
