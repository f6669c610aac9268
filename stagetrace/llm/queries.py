"""The registered queries of this package: each takes a session and a data folder and gives a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace.llm import embeddings, language, manifest, mixing, packing, pages, personal, quality, rules, sharding, simhash, spelling, substrings
from stagetrace.llm.store import keep


def _table(spark, d, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{d}/{name}.parquet")


def _part(modulus: int) -> Column:
    """Which of ``modulus`` parts a document falls into."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark, d):
    found = simhash.within_radius(_table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_quality(spark, d):
    docs = _table(spark, d, "documents")
    machine = quality.learn(docs, _table(spark, d, "labels"), _part(5) != 0)
    found = quality.score(docs.select("doc_id", "text", "n_chars"), machine)
    return found.select("doc_id", F.coalesce(_part(5) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_language(spark, d):
    docs = _table(spark, d, "documents")
    model = language.learn(docs, _part(3) != 1)
    return (language.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(_part(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"))


def op4_rules(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    measures = keep(rules.measured(docs).drop("text"), "measures")
    found = rules.judged(measures, rules.thresholds(keep(rules.sketches(measures), "sketches")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_embeddings(spark, d):
    return embeddings.near_vectors(_table(spark, d, "embeddings"))


def op6_substrings(spark, d):
    return (substrings.remove_repeats(_table(spark, d, "documents").select("doc_id", "text"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op7_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"), tokenizer_path())


def op8_sharding(spark, d):
    root = sharding.tree(24)
    found = sharding.assign(_table(spark, d, "documents"), root, sharding.grown(root, 24))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_mixing(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_pages(spark, d):
    return pages.extract(_table(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


def op11_spelling(spark, d):
    found = spelling.words(_table(spark, d, "documents").select("doc_id", "text"), every=31)
    return spelling.forms(found)


def op12_personal(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    found = personal.find(docs, personal.learn(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op13_manifest(spark, d):
    docs = _table(spark, d, "documents")
    longer = F.coalesce(F.try_add("n_chars", F.lit(1)), F.col("n_chars"))
    tampered = F.when(F.coalesce(_part(7) == 0, F.lit(False)), longer).otherwise(F.col("n_chars"))
    return manifest.manifest(docs, altered={"n_chars": tampered}).drop("path")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_rules": op4_rules,
    "op5_embeddings": op5_embeddings,
    "op6_substrings": op6_substrings,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_pages": op10_pages,
    "op11_spelling": op11_spelling,
    "op12_personal": op12_personal,
    "op13_manifest": op13_manifest,
}
