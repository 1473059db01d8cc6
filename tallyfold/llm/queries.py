"""One query per operator of this package, over the whole of its table, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import chat, decontamination, line_dedup, mixing, pieces, prefix_trie, sharding, topk
from tallyfold.llm import quality_classifier as classifier
from tallyfold.llm import quality_rules as rules
from tallyfold.llm import simhash, spelling, url_filters
from tallyfold.llm.common import LOWER, UPPER, cut, table, text_of
from tallyfold.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = classifier.score(docs, classifier.train(docs, labels))
    return scored.select(
        "doc_id",
        classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_domain(table(spark, sf_dir, "documents"), mixing.DOMAINS)
    taken = mixing.mix(docs, mixing.WEIGHTS)
    return taken.select("doc_id", *mixing.PATH, "n_tokens", "epoch", "place")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation -7 says control strings; it must come back as it went in."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest_conversations(chat.format_turns(chats.unionByName(added)))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is the quality label of the same number; whole paths, merged at every level."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad")
    )
    judged = url_filters.filter_urls(table(spark, sf_dir, "pages"), labels, depth=None, inner=True)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    proto = pieces.read_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.encode(docs, proto, check=True)
    return both.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("pieces").cast("array<string>"), ",").cast("binary"), 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, benchmark, window=10, carry=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 7 letters or more that occur twice; some runs lose a letter first, by a hash
    of document and run. Shorter runs cannot give such words."""
    runs = F.split(text_of(), r"[^A-Za-z\u00C0-\u00FF]+")
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(runs).alias("run"))
    found = found.filter(F.length("run") >= 7).withColumn("run", F.translate("run", UPPER, LOWER))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run")
    found = found.withColumn("h", F.crc32(key.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = found.select(F.when(F.col("h") % 31 == 0, without).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= 7).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")
    return spelling.group_variants(counts, ratio=10)


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin like the first of their hundred: its
    first h turns, then their own after h, where h comes from a hash of the id."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("h")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    first = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    begun = own.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    shaped = begun.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    shaped = cut(shaped.withColumn("n_turns", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt")
    lent = turns.filter("place <= 5").withColumnRenamed("conv_id", "base")
    start = shaped.filter("m > 0").join(lent, "base").filter("place <= m").select("conv_id", "place", "x", "y", "chars")
    blocks = F.explode(F.expr(f"sequence(0, (n - 1) div {prefix_trie.BLOCK})"))
    shifts = shaped.select("conv_id", "h", "m", blocks.alias("block"))
    rest = turns.withColumn("block", F.expr(f"(place - 1) div {prefix_trie.BLOCK}")).join(shifts, ["conv_id", "block"])
    rest = rest.filter("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("m"))
    return start.unionByName(rest.select(*start.columns)), shaped.select("conv_id", "n_turns")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(prefix_trie.number_turns(table(spark, sf_dir, "conversations")), "numbered")
    return prefix_trie.prefix_trie(*_rebuilt(turns))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_chat": op6_chat,
    "op7_sharding": op7_sharding,
    "op8_topk": op8_topk,
    "op9_url_filters": op9_url_filters,
    "op10_pieces": op10_pieces,
    "op11_decontamination": op11_decontamination,
    "op12_spelling": op12_spelling,
    "op13_prefix_trie": op13_prefix_trie,
}
