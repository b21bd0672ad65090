"""The operators as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, decontaminate, html, language, minhash, mixing, packing, phrases, pii, quality, secrets, spelling, substrings
from .common import table


def op1_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text")


def op3_substring_dedup(spark, sf_dir):
    return substrings.remove_repeated(table(spark, sf_dir, "documents"), window=35, digest=True).withColumnRenamed("kept_text", "kept_sha256")


def op4_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_preference_pairs(spark, sf_dir):
    return chat.preference_pairs(chat.neighbours(table(spark, sf_dir, "conversations")))


def op6_language_model(spark, sf_dir):
    return language.score(table(spark, sf_dir, "documents"))


def op7_sanitise(spark, sf_dir):
    return pii.find_spans(table(spark, sf_dir, "documents")).drop("key", "cuts")


def op8_main_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op9_mixing(spark, sf_dir):
    return mixing.calibrated(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("repo", F.concat_ws("/", "source", "lang"))
    return secrets.scan(docs, owner="source", repo="repo")


def op11_packing(spark, sf_dir):
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality": op2_quality,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_preference_pairs": op5_preference_pairs,
    "op6_language_model": op6_language_model,
    "op7_sanitise": op7_sanitise,
    "op8_main_text": op8_main_text,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_packing": op11_packing,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}
SQL: dict[str, str] = {
    "op5_preference_pairs": chat.NEIGHBOURS_SQL,
    "op9_mixing": mixing.calibrated_sql(),
    "op12_collocations": phrases.COLLOCATIONS_SQL,
}
