"""The registered queries of this package: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.align import align_documents
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.fill_in_middle import fill_in_middle
from quarry.llm.fill_in_middle import with_digests as fim_digests
from quarry.llm.fingerprint import neighbour_fingerprints
from quarry.llm.hmm_score import score_documents
from quarry.llm.language import identify_languages
from quarry.llm.license_scan import scan_licenses
from quarry.llm.mixing import mix_sources
from quarry.llm.ngram_join import near_duplicates
from quarry.llm.packing import pack_documents
from quarry.llm.packing import with_checksum as packed_checksum
from quarry.llm.token_file import read_tokens, write_tokens
from quarry.llm.token_file import with_checksum as token_checksum
from quarry.llm.toxicity import classify
from quarry.llm.url_filter import filter_urls
from quarry.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

# Fixed values of the URL query.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_checksum(pack_documents(_table(spark, sf_dir, "documents"), BYTE_BPE, 2048))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), WORD_BPE, folder)
    return token_checksum(read_tokens(spark, folder))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op8_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"), folds=3, fold=1).drop("spans")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(fill_in_middle(_table(spark, sf_dir, "documents"), salt="7:", rate=100, spm=50))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_token_file": op4_token_file,
    "op5_license_scan": op5_license_scan,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity": op7_toxicity,
    "op8_hmm_score": op8_hmm_score,
    "op9_fingerprint": op9_fingerprint,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_language": op11_language,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_align": op13_align,
}
