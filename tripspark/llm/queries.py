"""The registered queries of the llm operators: thin digests of what the operators return."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm import decontaminate, language_id, license_scan, ngram_join, oracles, pii, prefix_trie, quality_classifier, quality_rules, reply_trees, sentence_pieces, substring_dedup, token_alignment, toxicity
from tripspark.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def _bucket(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct("matches.license"))
    return out.select("doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), F.concat_ws(",", names).alias("licenses"), "matches")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(_bucket(3) != 1))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(_bucket(3) == 1, F.lit(False)).alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"), "margin")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    count = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(count, pii.BASE), F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language_id.train(docs.filter(F.coalesce(_bucket(4) != 2, F.lit(True))))
    held = docs.select("text", F.struct("doc_id", F.coalesce(_bucket(4) == 2, F.lit(False)).alias("held_out")).alias("key"))
    return language_id.predict(held, filters, "key").select("doc_id.doc_id", "doc_id.held_out", "lang_pred", "score")


#: The public vocabulary file of the piece encoder.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentence_pieces.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), sentence_pieces.read_model(PIECES))
    return out.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "exact")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.stored_index(table(spark, sf_dir, "documents"), new_path(spark, "index"))
    out = decontaminate.search(index, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.filter("matches.item", lambda x: x.isNotNull())))
    return out.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("rid", "root")


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = pii.literal_rows(spark, [{"conv_id": -7, "turn": k, "role": role, "text": "\\### Assistant: </turn> ok"}
                                       for k, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = reply_trees.format_paths(reply_trees.chains(rows))
    turns = reply_trees.read_turns("formatted")
    loss = reply_trees.read_loss("formatted", "mask")
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return (out.withColumn("turns", turns).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    out = prefix_trie.summary(*prefix_trie.with_shared_heads(turns, 5, F.crc32(F.col("conv").cast("string")) % 9))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.train(docs, labels.filter(_bucket(5) != 0))
    return quality_classifier.score(docs, model).select("doc_id", F.coalesce(_bucket(5) == 0, F.lit(False)).alias("held_out"), "score",
                                                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The public byte-level vocabulary file that is compared with ``PIECES``.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(BYTE_LEVEL, encoding="utf-8") as f:
        return token_alignment.align_corpus(table(spark, sf_dir, "documents"), f.read(), sentence_pieces.read_model(PIECES))


QUERIES = {"op1_license_scan": op1_license_scan, "op2_toxicity": op2_toxicity, "op3_substring_dedup": op3_substring_dedup, "op4_pii": op4_pii, "op5_quality_rules": op5_quality_rules, "op6_language_id": op6_language_id,
           "op7_sentence_pieces": op7_sentence_pieces, "op8_decontaminate": op8_decontaminate, "op9_ngram_join": op9_ngram_join,
           "op10_reply_trees": op10_reply_trees, "op11_prefix_trie": op11_prefix_trie,
           "op12_quality_classifier": op12_quality_classifier, "op13_token_alignment": op13_token_alignment}
_ESCAPED = r"""length(replace(replace(replace({x}, '\', '\b'), '#', '\h'), '<', '\l'))"""

OP10_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sums AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(15 + ROLE_CHARS + (length(role) - length(replace(role, ':', ''))) + TEXT_CHARS) AS BIGINT) AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM sums
""".replace("'\\\\###", "'\\###").replace("ROLE_CHARS", _ESCAPED.format(x="role")).replace("TEXT_CHARS", _ESCAPED.format(x="text"))

ORACLES: dict[str, str] = {**oracles.ORACLES, "op10_reply_trees": OP10_SQL}
