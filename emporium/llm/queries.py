"""The queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitplanes as P
from . import boundaries as B
from . import exact_dedup as X
from . import topk as K
from . import warc as W
from .common import read_table
from .lm import score_texts
from .packing import pack
from .pieces import encode_decode
from .quality import scores
from .quotes import linked_conversations
from .simhash import simhash_groups
from .substring import remove_repeated
from .suffix import remove_repeated_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.exact_dedup(read_table(spark, sf_dir, "documents")).drop("locator")


ORACLE["op5_exact_dedup"] = X.ORACLE


@query
def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op8_simhash_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents")).drop("first", "text_key")


@query
def op3_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(read_table(spark, sf_dir, "documents"))


@query
def op1_nnpu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op6_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.top_inner_products(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op6_norm_sorted_topk"] = K.ORACLE


@query
def op7_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


@query
def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_conversations(read_table(spark, sf_dir, "conversations"))


@query
def op10_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(read_table(spark, sf_dir, "documents"))


@query
def op11_roaring_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.fill_in_middle(read_table(spark, sf_dir, "documents"), with_output=False)


ORACLE["op11_roaring_fill_in_middle"] = B.ORACLE


@query
def op13_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


ORACLE["op13_bit_plane_clusters"] = P.oracle()


@query
def op12_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.archived_pages(read_table(spark, sf_dir, "pages")).drop("url", "problem")


ORACLE["op12_warc_segments"] = W.ORACLE
