"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chroma, filter_audit, langid, license_scan, merkle, mixing, packing, pivot_topk, secret_scan, simhash, text_sketch, toxicity, warc
from .support import bucket, load, picked, tune, written


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op2_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = load(spark, sf_dir, "documents")
    model = langid.fit(docs.where(bucket("doc_id", 4) != 2))
    return langid.predict(docs, model).select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_chroma_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` played as a recording, and an excerpt of those whose id is divisible by 20 as queries.

    A row for each vector: its class, the number of queries that align with the class, and for a query the number of
    classes that it aligns with and the one with the least bit error.
    """
    tune(spark)
    vectors = load(spark, sf_dir, "embeddings")
    prints = written(chroma.fingerprints(chroma.record(vectors), "vec_id"), "fingerprints")
    heard = written(chroma.fingerprints(chroma.excerpts(chroma.record(vectors.where("vec_id % 20 = 0")), "vec_id"), "vec_id"), "excerpts")
    found = written(chroma.align(prints, heard, "vec_id"), "alignments")
    links = found.groupBy(F.col("match_class").alias("class_id")).agg(F.count("*").alias("links"))
    best = F.min(F.struct("bit_error", "match_class", "offset", "votes")).alias("best")
    asked = chroma.classes(heard, "vec_id").distinct().withColumnRenamed("class_id", "query_class")
    asked = asked.join(found.groupBy("query_class").agg(F.count("*").alias("matches"), best), "query_class", "left").select("vec_id", F.coalesce("matches", F.lit(0)).alias("matches"), "best")
    rows = chroma.classes(prints, "vec_id").join(links, "class_id", "left").join(asked, "vec_id", "left")
    return rows.select("vec_id", "class_id", F.coalesce("links", F.lit(0)).alias("links"), "matches", "best.match_class", "best.offset", "best.votes", "best.bit_error")


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return secret_scan.scan(load(spark, sf_dir, "documents"), secret_scan.fit())


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return license_scan.scan(load(spark, sf_dir, "documents")).drop("spans")


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    vectors = load(spark, sf_dir, "embeddings")
    return pivot_topk.search(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.taken(load(spark, sf_dir, "documents"))


def op8_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(bucket("doc_id", 5) != 0))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op11_text_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return text_sketch.edited_versions(load(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's leaf, roots and proof, and what its path says of the document as a careless copy would have it."""
    tune(spark)
    names = ("doc_id", "source", "lang", "n_chars", "text")
    docs = picked(load(spark, sf_dir, "documents"), **{n: n for n in names})
    whole = merkle.leaf(*map(F.col, names))
    careless = merkle.leaf(*map(F.col, names[:-1]), F.replace("text", F.lit("\n"), F.lit("")))
    seen = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, careless)
    found = merkle.manifest(docs.select(F.col("source").alias("group_by"), F.col("doc_id").alias("id"), whole.alias("leaf"), seen.alias("carried")))
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("carried", "leaf"), F.col("path")))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def queries() -> dict:
    own = (op1_warc_dictionary, op2_byte_cnn_language, op3_chroma_alignment, op4_secret_forest, op5_license_templates, op6_pivot_topk, op7_source_mix, op8_simhash_popcount, op9_lexicon_toxicity, op10_nnls_packing)
    return {f.__name__: f for f in (*own, op11_text_sketch, op12_merkle_manifest, op13_filter_audit)}


OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
top AS (SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN top.top IS NOT NULL AND top.top <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top.top <> p.page_id THEN top.top END AS refers_to
FROM p LEFT JOIN top ON p.payload_digest = top.payload_digest AND p.payload_bytes = top.payload_bytes
"""

OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_dictionary": OP1_SQL, "op6_pivot_topk": OP6_SQL, "op12_merkle_manifest": merkle.SQL, "op13_filter_audit": filter_audit.SQL}
