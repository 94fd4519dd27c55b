"""The registered queries of this package, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tickweave.llm import ann, byte_bpe, chat, hard_negatives, langid, line_dedup, ngram_join, pack, perplexity, shard, spelling, suffix_dedup, toxicity
from tickweave.llm.oracles import OP11, OP12, OP13

#: Byte limit of a shard in op9.
SHARD_BYTES = 2 << 20


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the perplexity verdict of each document."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    return perplexity.judge(docs).drop("lang", "n_chars_scored")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return pack.pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3-word shingle set of each document and its component at Jaccard 0.9."""
    return ngram_join.link_classes(_documents(spark, sf_dir).select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's byte-level BPE ids and of the bytes that they decode to."""
    return byte_bpe.digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document under 50-byte strings that start in smaller documents, and what is left."""
    return suffix_dedup.digests(_documents(spark, sf_dir))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20."""
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of each document; remainder 1 of 3 is held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels.where(langid.fold("doc_id", 3) != 1))
    return toxicity.score(docs, model).drop("text").withColumn("held_out", langid.fold("doc_id", 3) == 1)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of each document; remainder 2 of 4 is held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = langid.fold("doc_id", 4) == 2
    found = langid.identify(docs, docs.where(~held_out))
    return found.withColumn("held_out", held_out)


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document under the byte limit."""
    return shard.shards(_documents(spark, sf_dir).select("doc_id", "text"), SHARD_BYTES).drop("text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from each document, and the digest of its remaining text."""
    out = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive of the embeddings."""
    rows = hard_negatives.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", hard_negatives.scaled(F.col("vec"), 256).alias("vec"), label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with the near word and the root that each is a variant of."""
    return spelling.group_variants(_documents(spark, sf_dir))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in the chat template, read back from what was written."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    written = chat.format_turns(chat.canonical_turns(given.unionByName(probe), "conv_id"))
    turns, loss = chat.read_back(F.col("formatted")), chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    read = written.select("record_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(F.col("record_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


QUERIES = {f.__name__: f for f in (op1_perplexity, op2_pack, op3_ngram_join, op4_byte_bpe, op5_suffix_dedup, op6_ann, op7_toxicity, op8_langid, op9_shard, op10_line_dedup,
                              op11_hard_negatives, op12_spelling, op13_chat)}

ORACLE = {
    "op9_shard": f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) & 2147483647 AS h
  FROM documents),
levels AS (SELECT unnest(range(0, 32)) AS depth),
nodes AS (
  SELECT depth, h >> (31 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
  FROM d, levels GROUP BY ALL),
placed AS (
  SELECT d.doc_id, d.h, d.n_bytes, n.depth, n.shard_bytes,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY n.depth) AS r
  FROM d JOIN nodes n ON n.prefix = d.h >> (31 - n.depth)
  WHERE n.shard_bytes <= {SHARD_BYTES} OR n.depth = 31)
SELECT doc_id, left(right(bin(h + 2147483648), 31), CAST(depth AS INTEGER)) AS shard,
       CAST(0 AS BIGINT) AS part, CAST(depth AS INTEGER) AS depth, CAST(n_bytes AS BIGINT) AS n_bytes, shard_bytes
FROM placed WHERE r = 1""",
    "op10_line_dedup": """
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
rows_ AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
three AS (
  SELECT doc_id, pos, line AS a,
         lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM rows_ WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM three WHERE c IS NOT NULL AND trim(a || b || c, ' ') <> ''),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.pos) AS text
  FROM rows_ r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos GROUP BY r.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN removed r ON d.doc_id = r.doc_id""",
    "op11_hard_negatives": OP11,
    "op12_spelling": OP12,
    "op13_chat": OP13,
}
