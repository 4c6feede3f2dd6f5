"""The queries of this package over the driver's tables, by name."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import chats, exact_search, hash_forest, infill, language, licences, mixing, ngram_join, packing, phrases, sharding, token_files, warc
from quotemill.llm.blocks import usable
from quotemill.llm.staging import read_table, shared_folder

SHARDS = [f"shard-{n:03d}" for n in range(64)]


def tokenizer_config(path: str = public_tokenizers.path("word_bpe_49k.json")) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def pieces(docs: DataFrame) -> DataFrame:
    """The digest columns of packed documents."""
    packed = packing.pack(docs, tokenizer_config())
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    return packed.select(*columns, F.crc32("ids").alias("ids_crc32"))


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(read_table(spark, sf_dir, "documents"))


def op2_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_search.whole_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_search.search(rows.filter(F.col("id") % 50 == 0), rows, k=5)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs = docs.select("*", mixing.words(F.col("text")).alias("size"))
    chosen = mixing.decide(docs).select("row.doc_id", "row.size", "source_size", "target", "copies")
    return chosen.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op4_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sharding.place(docs, ["doc_id"], SHARDS)


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hash_forest.search(rows.filter(F.col("id") % 20 == 0), rows, k=20)


def op6_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/quotemill-llm/token-files-{uuid.uuid4().hex}"
    token_files.write(read_table(spark, sf_dir, "documents"), path, tokenizer_config(), end_id=1)
    read = token_files.read(spark, path)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(read_table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents"), licences.known_licences(spark)).select(
        "doc_id", "digest", "licence", F.array_join("notices", ";").alias("notices")
    )


def learned_language(docs: DataFrame) -> language.Network:
    """Learned from the folds that are not held out."""
    return language.fit(docs.filter(language.remainder(F.col("doc_id")) != 0))


def op9_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    read = language.predict(docs.select("doc_id", "text"), learned_language(docs))
    held_out = language.remainder(F.col("doc_id")) == 0
    return read.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chats.read_back(chats.format_chats(chats.as_events(turns)))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/quotemill-llm/warc-{uuid.uuid4().hex}"
    warc.write(read_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(read_table(spark, sf_dir, "documents"))
    return made.select(
        F.col("key").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_retrieval_packing,
        op2_threshold_search,
        op3_source_mix,
        op4_lookup_sharding,
        op5_prefix_forest,
        op6_huffman_tokens,
        op7_ngram_join,
        op8_licence_scan,
        op9_byte_language,
        op10_chat_format,
        op11_warc_files,
        op12_infill,
        op13_phrase_mining,
    )
}
