"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.llm import chat, decontaminate, embeddings, lines, lm_score, packing, pages, prefix_trie, quality, sharding, simhash, spelling, toxicity
from chronolode.llm.common import table, text_of


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn int, role string, text string")
    return chat.read_back(chat.prefix_target_examples(given.unionByName(more)))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.main_text(given, pages.learn_pages(given))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.tag_documents(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.expr("transform(toxic_spans, s -> s.start)").alias("span_starts"),
        F.expr("transform(toxic_spans, s -> s.`end`)").alias("span_ends"),
    )


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    placed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removed_lines(table(spark, sf_dir, "documents"))


#: Candidates share their first or last half; two lines are within one edit if they differ at one place at most, or if
#: the longer without one code point is the shorter.
OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(a))) AS line_no, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
r AS (SELECT *, CAST(doc_id AS HUGEINT) * 4294967296 + line_no AS pos, length(line) AS n FROM l
      WHERE length(line) >= 10 OR regexp_matches(line, '\S')),
c AS (SELECT line, n, min(pos) AS pos FROM r GROUP BY ALL),
h AS (SELECT *, unnest(list_distinct([n // 2, (n - 1) // 2])) AS p FROM c WHERE n >= 10),
k AS (SELECT *, 'first' AS side, left(line, p) AS part FROM h UNION ALL SELECT *, 'last', right(line, p) FROM h),
pairs AS (
  SELECT DISTINCT a.line, a.n, b.line AS to_line, b.n AS to_n, b.pos AS to_pos
  FROM k a JOIN k b ON a.p = b.p AND a.side = b.side AND a.part = b.part AND b.pos < a.pos AND abs(a.n - b.n) <= 1),
sides AS (
  SELECT line, to_pos, n = to_n AS even,
         CASE WHEN n >= to_n THEN line ELSE to_line END AS x, CASE WHEN n >= to_n THEN to_line ELSE line END AS y
  FROM pairs),
near AS (
  SELECT line, min(to_pos) AS to_pos FROM sides
  WHERE CASE WHEN even THEN len(list_filter(range(1, length(x) + 1), lambda i: substr(x, i, 1) <> substr(y, i, 1))) <= 1
             ELSE len(list_filter(range(length(x)), lambda i: left(x, i) || substr(x, i + 2) = y)) > 0 END
  GROUP BY line),
s AS (SELECT c.line, coalesce(to_pos, pos) AS seen, CASE WHEN to_pos IS NULL THEN 0 ELSE 1 END AS edits FROM c LEFT JOIN near USING (line))
SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(seen // 4294967296 AS BIGINT) AS seen_doc_id,
       CAST(seen % 4294967296 AS INT) AS seen_line_no, edits
FROM r JOIN s USING (line) WHERE pos > seen
"""


def op10_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.external_shuffle(docs, 40).select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    scored = quality.score_documents(docs, quality.learn(docs, labels))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= 0.7).cast("int").alias("predicted"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.vocabulary(table(spark, sf_dir, "documents"), spelling.SLIPS))


QUERIES = {
    "op1_decontaminate": (op1_decontaminate, None),
    "op2_chat_format": (op2_chat_format, None),
    "op3_main_text": (op3_main_text, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_near_vectors": (op5_near_vectors, None),
    "op6_pack": (op6_pack, None),
    "op7_lm_score": (op7_lm_score, None),
    "op8_simhash": (op8_simhash, None),
    "op9_line_dedup": (op9_line_dedup, OP9_SQL),
    "op10_shuffle_shards": (op10_shuffle_shards, None),
    "op11_prefix_trie": (op11_prefix_trie, None),
    "op12_quality": (op12_quality, None),
    "op13_spelling": (op13_spelling, None),
}


def llm_queries() -> dict:
    return {name: run for name, (run, _) in QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
