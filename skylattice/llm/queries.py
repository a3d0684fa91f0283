"""The registered queries of this subpackage, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import clusters, line_dedup, mixing, negatives, pii, quality, topk, url_filter
from skylattice.llm.ans import pack, unpack
from skylattice.llm.chosen_path import chosen_path_components
from skylattice.llm.decontaminate import matched
from skylattice.llm.jaccard import jaccard_components
from skylattice.llm.language import fit, held_out, predict


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and a classifier that learns from the URLs they decide."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.train(url_filter.by_rule(pages)))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; the counts and the digest are those of the base spans."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(documents, pii.fit(documents))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.top_k(embeddings, embeddings.where("vec_id % 50 = 0"), k=5)
    return found.withColumn("score", F.col("score").try_cast("long"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(documents, fit(documents.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels by co-training."""
    documents = table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token ids, written and read back."""
    return unpack(*pack(table(spark, sf_dir, "documents"), tokenizer_file()))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat runs of 50 words or more."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(documents)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that fill a token budget at the target weights."""
    taken = mixing.select_prefixes(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "mix_domain", "mix_lang", "mix_source", "mix_epoch", "mix_tokens", "mix_share")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word matches of every document with the benchmark."""
    found = matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "longest", "spans",
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more, and which one to keep."""
    return chosen_path_components(table(spark, sf_dir, "documents"), words=3, percent=85)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all vectors after three rounds."""
    found = clusters.described(*clusters.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score a little below the positives of every fiftieth vector."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    found = negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))
    scores = [F.col(c).try_cast("long").alias(c) for c in ("positive_score", "negative_score")]
    return found.select("anchor_id", "positive_id", "rank", "negative_id", *scores)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op4_exact_top_k": op4_exact_top_k,
    "op5_language_id": op5_language_id,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_output": op7_token_output,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_decontaminate": op10_decontaminate,
    "op1_url_filter": op1_url_filter,
    "op2_pii": op2_pii,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Equivalent SQL, where SQL can say it.
ORACLE_SQL: dict[str, str] = {
    "op4_exact_top_k": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
                and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        scored as (
            select q.vec_id query_id, x.vec_id, list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]))::bigint score
            from vectors q join vectors x on q.vec_id % 50 = 0 and q.vec_id <> x.vec_id and len(q.v) = len(x.v)),
        ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op8_line_dedup": line_dedup.plain_sql(),
    "op9_mixing": mixing.plain_sql(),
    "op12_centroid_clustering": clusters.plain_sql(),
    "op13_hard_negatives": """
        with rows as (
            select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
            where vec_id is not null and label is not null and len(embedding) > 0
                and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        scored as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
            from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank,
            vec_id as negative_id, positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3""",
}
