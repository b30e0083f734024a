"""The registered queries of the operators, with SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.llm import sharding, toxicity
from levyflow.llm.caps import cap_components
from levyflow.llm.filter_audit import filter_audit
from levyflow.llm.lexical import search
from levyflow.llm.multi_index import nearest
from levyflow.llm.packing import pack
from levyflow.llm.sampling import sample_segmentations
from levyflow.llm.secret_scan import find_secrets, span_report
from levyflow.llm.simhash import simhash_components
from levyflow.llm.substrings import without_repeats
from levyflow.llm.token_counts import edited_counts, spread_edits
from levyflow.llm.warc import archive_round_trip

# Shards of the registered query. Small ones, so that small tables split too.
SHARD_BYTES = 1024**2
# Edits that every document of the registered query goes through.
EDITS = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes
  FROM documents),
levels AS (SELECT doc_id, h, bytes, CAST(d AS INT) AS depth, h >> (60 - d) AS prefix
           FROM sized, range(0, 61) AS t(d)),
buckets AS (SELECT depth, prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows,
                   sum(bytes) <= {SHARD_BYTES} OR min(h) = max(h) AS done
            FROM levels GROUP BY ALL)
SELECT doc_id, bytes, 'b' || CASE depth WHEN 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
       depth, shard_bytes, shard_rows, '0' AS page
FROM levels JOIN buckets USING (depth, prefix)
WHERE done QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


def op2_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_components(_table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_round_trip(spark, _table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH payloads AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                         sha256(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM ranked
"""


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op6_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(_table(spark, sf_dir, "documents"))


def _held_out(key: str) -> Column:
    """A third of the documents by their key; their labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """The classifier of a set of tables, from the labels that are not held out."""
    labels = _table(spark, sf_dir, "labels").where(~_held_out("doc_id"))
    return toxicity.train(_table(spark, sf_dir, "documents"), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), train_toxicity(spark, sf_dir))
    return scored.select("doc_id", _held_out("doc_id").alias("held_out"), "score", "predicted", "sentences")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = spread_edits(F.col("doc_id"), F.col("text"), EDITS)
    return edited_counts(_table(spark, sf_dir, "documents"), edits)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(find_secrets(_table(spark, sf_dir, "documents")))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM texts),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i:i + 19], ' ') ORDER BY doc_id, i) AS nth
           FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM ranked WHERE nth > 1),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS rest, count(*) AS n
         FROM placed ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failing AS (
  SELECT doc_id, part, [
    len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM texts),
named AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels GROUP BY doc_id),
counts AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
           FROM failing LEFT JOIN named USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
           FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, CAST(step AS INT) AS step,
                 list_transform(string_split(filter_order, ''), lambda l: CAST(ascii(l) - 64 AS INT)) AS places
          FROM orders, range(1, 6) AS t(step)),
judged AS (SELECT part, filter_order, step, n, good, toxic, fails[places[step]] AS here,
                  list_bool_or(list_transform(places[1:step - 1], lambda p: fails[p])) AS before,
                  list_sum(list_transform(fails, lambda f: CAST(f AS INT))) AS failed
           FROM counts, steps),
summed AS (
  SELECT part, filter_order, step,
         CAST(sum(CASE WHEN here OR coalesce(before, false) THEN 0 ELSE n END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN here AND NOT coalesce(before, false) THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN here AND coalesce(before, false) THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN here AND failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN here AND NOT coalesce(before, false) THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN here AND NOT coalesce(before, false) THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM summed
"""


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = r"list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), " \
    "lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
OP13_SQL = f"""
WITH texts AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, CAST(sum(c * CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN dfs USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_caps": op2_caps,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_best_fit": op5_best_fit,
    "op6_segmentations": op6_segmentations,
    "op7_toxicity": op7_toxicity,
    "op8_multi_index": op8_multi_index,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_substrings": op11_substrings,
    "op12_filter_audit": op12_filter_audit,
    "op13_lexical": op13_lexical,
}

ORACLES = {
    "op1_sharding": OP1_SQL,
    "op4_warc": OP4_SQL,
    "op11_substrings": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_lexical": OP13_SQL,
}
