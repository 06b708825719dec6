"""The numbered queries: each operator over its whole table, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.simhash import hex_of, simhash_groups

    g = simhash_groups(_table(spark, sf_dir, "documents"))
    return g.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from carelake.llm.byte_bpe import encode_documents

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = encode_documents(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False, with_decoded=False
    )
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.quality_rules import judge_documents

    return judge_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    import pyarrow as pa

    from carelake.llm.line_dedup import kept_text, with_bitmaps

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")

    def digest(batches):
        for b in batches:
            got = [kept_text(t.as_py(), k.as_py()) for t, k in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([x[1] for x in got], pa.int64()),
                    pa.array([x[2] for x in got], pa.int64()),
                    pa.array([hashlib.sha256(x[0].encode("utf-8", "surrogatepass")).hexdigest() for x in got], pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return with_bitmaps(docs).mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.pseudo_likelihood import code, corpus_words, score_coded, train_on

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    words = corpus_words(docs)
    coded = code(docs, words)
    return score_coded(coded, words, train_on(coded, words))


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.quality_gam import score, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(docs.where(~held_out), _table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.vp_tree import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from carelake.llm.language_id import predict, train, vocabulary

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    pieces = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    langs, p = train(docs.where(~held_out), pieces)
    return predict(docs, pieces, langs, p).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.pii import KINDS, find, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = lambda c: F.concat_ws(
        ",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find(docs, train(docs)).select(
        "doc_id",
        *(count(k) for k in KINDS),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from carelake.llm.packing import pack, pieces_of

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pieces_of(_table(spark, sf_dir, "documents"), path, with_ids=False).drop("ids")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    from carelake.llm.alignment import align

    out = align(
        _table(spark, sf_dir, "documents"),
        public.path("byte_bpe_50k.json"),
        public.path("piece_bpe_32k.model"),
        ranks_a=public.path("byte_bpe_50k.tiktoken"),
        pattern_a=public.PATTERN,
    )
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
