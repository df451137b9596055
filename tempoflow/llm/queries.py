"""Registered queries of the corpus operators and the digests that they report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow.functions.hashing import let
from tempoflow.llm import chat, covertree, crf, debruijn, kmtree, licenses, packing, periodic, prefixbpe, runlength, simhash, viterbi, whitening
from tempoflow.llm.common import read


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmtree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


#: A conversation that every run formats beside those of the table.
PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], turns.schema)
    return chat.digest(chat.render(turns.union(probe)))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.decoded(viterbi.encode(read(spark, sf_dir, "documents")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return crf.identify(docs, crf.train(docs))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).select(F.col("*")).drop("spans")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlength.remove_repeats(read(spark, sf_dir, "documents"))


def _looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: from word a on, the texts of a tenth of the documents go round in p of their words.

    h = crc32 of the decimal id, g = h // 10; if h % 10 = 0 and there are n > 0 words, a = g % n and
    p = 1 + (n - a) // (3 + g % 8). A null id leaves the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def turn(words: Column) -> Column:
        n = F.size(words)

        def loop(span: Column) -> Column:
            place = lambda i: F.when(i < span["a"], i).otherwise(span["a"] + (i - span["a"]) % span["p"])
            return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i).cast("int"))), " ")

        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return F.when(n > 0, let(F.struct(a.alias("a"), p.alias("p")), loop)).otherwise(F.lit(""))

    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, turn)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the runs of every text, and of the text without their repeats."""
    found = periodic.find_runs(_looped(read(spark, sf_dir, "documents"))).withColumn("best", periodic.strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids are counted and digested, and the bytes that they decode to are."""
    coded = prefixbpe.decode(prefixbpe.encode(read(spark, sf_dir, "documents")))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_nearest_neighbours": op1_nearest_neighbours,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_chat_format": op3_chat_format,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_language_id": op6_language_id,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_license_scan": op8_license_scan,
        "op9_packing": op9_packing,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_byte_bpe": op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {}
