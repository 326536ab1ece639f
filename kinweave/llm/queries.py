"""The registered queries of this subpackage: each applies one operator to its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinweave.llm import alignment, bpe, extract, langid, licenses, neardup, packing, quality, shortestpack, sql, topk, toxicity, urls, variants
from kinweave.llm.tables import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document by the byte-level vocabulary."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by listed and mined rules."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and short notices of every document."""
    found = licenses.scan_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                        F.size("notices").cast("long").alias("n_notices"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.8 or more on shingles of four words."""
    return neardup.find_components(table(spark, sf_dir, "documents"), words_each=4, percent=80)


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules of every document and of its host."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a lexicon learned from the labels."""
    documents = table(spark, sf_dir, "documents")
    scores = toxicity.score_documents(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    documents = table(spark, sf_dir, "documents")
    found = langid.predict(documents, langid.fit(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens without padding."""
    return shortestpack.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words and the frequent forms they may stand for."""
    return variants.group_variants(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie over each other in every document."""
    return alignment.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return {
        "op1_top_k": op1_top_k,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_url_filter": op3_url_filter,
        "op4_license_scan": op4_license_scan,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_host_quality": op6_host_quality,
        "op7_toxicity": op7_toxicity,
        "op8_main_text": op8_main_text,
        "op9_language_id": op9_language_id,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_shortest_pack_first": op11_shortest_pack_first,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
