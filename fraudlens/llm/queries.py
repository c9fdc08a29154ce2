"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import ann, bond, chat, kdtree, mixing, packing, periodic_runs, quality, secret_scan, simhash, suffix_dedup, token_counts, token_files
from fraudlens.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql.strip()
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sum_of_squares_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 4096: one row per piece, with its ids."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@query("op2_simhash_bk_trees")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query("op3_wavelet_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"))
    return token_files.read_documents(manifest, with_ids=False)


@query("op4_suffix_array_repeats")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its 400-byte strings that also start elsewhere, and its repeated passages of over 50 words."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_bytes=False, with_text=True, words=51)


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1
    + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op5_columnar_chat", _CHAT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", marked), (-1, 1, "assistant", marked)], turns.schema)
    return chat.read_chats(chat.format_chats(turns.unionByName(more)))


def _every(n: int):
    return F.col("id") % n == 0


@query("op6_multiprobe_lsh")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of largest cosine found for every 50th vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), _every(50))


_TOP_K_SQL = """
WITH rows AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([q.v[i] * c.v[i] for i in generate_series(1, len(q.v))]) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) r
WHERE rank <= 5
"""


@query("op7_kd_tree_top_k", _TOP_K_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of highest integer inner product for every 50th vector."""
    return kdtree.top_k(_table(spark, sf_dir, "embeddings"), _every(50))


@query("op8_boosted_tree_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; one in five is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op9_prefix_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 512 tokens, from the stored counts of its prefixes."""
    counts = token_counts.prefix_counts(_table(spark, sf_dir, "documents"))
    answers = token_counts.answer_budgets(stage(counts.select("doc_id", "prefixes"), "prefix-counts"), 512)
    return answers.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "budget_bytes")


@query("op10_raked_mixing", mixing.mix_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and fate of every document under raked source, language and topic weights."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mixed.select("doc_id", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept")


_MOVED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@query("op11_bond_hard_negatives", bond.hard_negatives_sql(_MOVED_LABEL, "a.vec_id % 50 = 0"))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every 50th vector."""
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.expr(_MOVED_LABEL))
    return bond.hard_negatives(rows, _every(50))


@query("op12_confirmed_secrets")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: by pattern, and by the structure of what they decode to."""
    return secret_scan.secret_digests(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


@query("op13_block_convolution_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, one in ten of which is made periodic first."""
    docs = periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))
