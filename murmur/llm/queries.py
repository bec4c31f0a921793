"""The numbered operators as queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import archives, bpe, codebooks, decontaminate, fertility, languages, licenses, lines, repair, secrets, sequences, simhash, token_counts
from murmur.llm.common import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", fertility.measure(spark, F.col("text")).alias("m"))
    docs = fertility.fenced(settled(docs, "measures"), "m", "fence")
    v = fertility.judge(F.col("m"), F.col("fence"))
    return docs.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                       v["base_failed"].alias("base_failed"), v["kept"].alias("kept"), "m.n_tokens", "m.n_bytes_spelt",
                       "m.token_entropy", v["chars_per_token"].alias("chars_per_token"), "m.script")


def op2_licence_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.array(*[F.lit(r.kind) for r in secrets.BASE_RULES])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(r.kind) for r in secrets.BASE_RULES],
                        F.sha2(listed(F.filter("spans", lambda s: F.array_contains(base, s["kind"]))), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def bpe_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    coded = docs.select("doc_id", bpe.code(spark, F.col("text")).alias("e"))
    return coded.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("e.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("e.decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(spark, table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.group_near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.read_documents(sequences.write_sequences(table(spark, sf_dir, "documents")))


def op7_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          token_counts.count_tokens(spark, F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A document without an id is none of those held out.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = languages.train(docs.where(~held_out))
    told = docs.select("doc_id", held_out.alias("held_out"), languages.predict(docs, model, F.col("text")).alias("p"))
    return told.select("doc_id", "held_out", "p.lang_pred", "p.score", F.array_join("p.languages", ",").alias("languages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codebooks.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.read_archives(archives.write_archives(table(spark, sf_dir, "pages")), payloads=False)
    refers_to = F.regexp_extract("refers_to", "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), refers_to.alias("refers_to"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_tokeniser_fertility, op2_licence_diagonals, op3_secret_ledger, op4_byte_bpe, op5_simhash, op6_arrow_sequences,
    op7_line_bitmaps, op8_token_counts, op9_language_mixture, op10_decontamination, op11_vector_codes,
    op12_zip_warc, op13_conversation_repair)}
