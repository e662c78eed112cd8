"""One query per operator, with production parameters, over whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.llm.alignment import align_tokenizers
from retail_strata.llm.common import whole_text
from retail_strata.llm.embedding_links import embedding_links
from retail_strata.llm.hard_negatives import hard_negatives
from retail_strata.llm.language import held_out, predict_languages, train_languages
from retail_strata.llm.mixing import mix
from retail_strata.llm.ngram_join import ngram_join
from retail_strata.llm.packing import pack
from retail_strata.llm.secrets import find_secrets, span_text, train_secrets
from retail_strata.llm.spot_signatures import common_words, fingerprint, likeness, signatures, with_next
from retail_strata.llm.suffix_dedup import deduplicated
from retail_strata.llm.token_counts import count_tokens
from retail_strata.llm.token_files import read_tokens, write_tokens
from retail_strata.llm.word_bpe import encode_decode
from retail_strata.sources.scratch import scratch_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_secrets(docs, train_secrets(docs))
    base = span_text(F.array_sort(F.concat("assign", "access", "hex")))
    return found.select(
        "doc_id", *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), BYTE_BPE)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "llm-token-files")
    write_tokens(table(spark, folder, "documents"), path, BYTE_BPE)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = train_languages(docs.filter(~held_out(F.col("doc_id"))), PIECES)
    predicted = predict_languages(docs, model)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"), BYTE_BPE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(table(spark, folder, "documents"), words=4, percent=85)


def op7_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", whole_text().alias("text"))
    anchors = common_words(docs)
    own = docs.withColumn("sigs", signatures(F.col("text"), anchors))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut),
        F.substring(F.col("next.text"), F.lit(1), cut),
    )
    pairs = with_next(own, "doc_id", ["text", "sigs"], "text")
    pairs = pairs.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("edited", edited)
    pairs = pairs.withColumn("edited_sigs", signatures(F.col("edited"), anchors))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next.sigs")).alias("near_next"),
    )


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a repeated passage, with what is left of their texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return deduplicated(docs).filter("repeats IS NOT NULL")


def op9_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_decode(table(spark, folder, "documents"), WORD_BPE)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    linked = embedding_links(table(spark, folder, "embeddings"))
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder, "documents"), BYTE_BPE, PIECES)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Components become whole numbers; those of 2^22 and more leave their row out."""
    rows = table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>"))
    small = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float(1 << 22)))
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (bigint(label) + 1) % 10 ELSE bigint(label) END")
    return hard_negatives(rows.filter(small).select(
        "vec_id", label.alias("label"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)).alias("anchor"),
        F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x)).alias("vector"),
    ))


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_counts": op2_token_counts,
    "op3_token_files": op3_token_files,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_ngram_join": op6_ngram_join,
    "op7_spot_signatures": op7_spot_signatures,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_word_bpe": op9_word_bpe,
    "op10_embedding_links": op10_embedding_links,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_mix": op13_source_mix,
}
ORACLES: dict[str, str] = {
    "op12_hard_negatives": """
        with rows as (
          select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
          from embeddings
          where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
            cast(list_dot_product(a.v, b.v) as bigint) as score
          from rows a, rows b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
        positives as (
          select anchor_id, other_id as positive_id, score as positive_score from (
            select *, row_number() over (partition by anchor_id order by score desc, other_id) as place
            from scored where same)
          where place <= 5)
        select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score
        from (
          select p.*, n.other_id as negative_id, n.score as negative_score,
            row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as place
          from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
            and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score)
        where place <= 3""",
}
