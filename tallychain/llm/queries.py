"""The registered queries of the operators, each over its whole table."""

from pyspark.sql import functions as F

from tallychain.llm import (byte_pairs, decontaminate, html_text, language_model, licenses, manifest, mixing, neighbours, packing, quality, simhash,
                            spelling, substrings)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def op1_quality(spark, sf_dir):
    scored = quality.classify(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_language_model(spark, sf_dir):
    return language_model.score(_documents(spark, sf_dir))


def op3_mixing(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir)).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def op4_decontamination(spark, sf_dir):
    found = decontaminate.occurrences(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir))


def op6_licenses(spark, sf_dir):
    return licenses.scan(_documents(spark, sf_dir))


def op7_html(spark, sf_dir):
    found = html_text.main_texts(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_substrings(spark, sf_dir):
    return substrings.dedup(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_neighbours(spark, sf_dir):
    vectors = neighbours.usable(_table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(vectors.where("vec_id % 20 = 0"), vectors)


def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_manifest(spark, sf_dir):
    tampering = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    tampered = {"n_chars": F.when(tampering, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = manifest.documents_manifest(_documents(spark, sf_dir), tampered)
    proof = F.sha2(F.array_join(F.transform("path", lambda step: step["digest"]), ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def op12_spelling(spark, sf_dir):
    return spelling.variants(_documents(spark, sf_dir))


def op13_byte_pairs(spark, sf_dir):
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_pairs.decode(byte_pairs.encode(_documents(spark, sf_dir), vocabulary), vocabulary)
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("content", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_language_model": op2_language_model,
    "op3_mixing": op3_mixing,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_html": op7_html,
    "op8_substrings": op8_substrings,
    "op9_neighbours": op9_neighbours,
    "op10_simhash": op10_simhash,
    "op11_manifest": op11_manifest,
    "op12_spelling": op12_spelling,
    "op13_byte_pairs": op13_byte_pairs,
}
