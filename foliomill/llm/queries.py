"""The registered queries of the numbered operators: thin digests of their whole results."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bound_arrow_batches, cut, read_table
from . import ann, fim, language_id, media, ngram_join, packing, quality, sharding, substring_dedup, token_planes, topk, trie_bpe, vector_codes


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text that stays, and what was removed, for every document."""
    bound_arrow_batches(spark)
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_units", "removed_chars")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    found = ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "links")


def crc_mod(n: int) -> Column:
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs, learn=F.coalesce(crc_mod(4) != 2, F.lit(False)))
    found = language_id.predict(docs, model)
    return found.select("doc_id", F.coalesce(crc_mod(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    files = cut(token_planes.write_token_files(docs, tokenizer_path("word_bpe_49k.json"), end_id=1), "token-files")
    return token_planes.read_token_files(files, with_ids=False)


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    stored = cut(media.encode_media(read_table(spark, sf_dir, "documents")), "media", compression="zstd")
    read = media.read_media(stored)
    frames = F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"], k["size"]))
    facts = [F.col("codec"), F.concat_ws("x", "width", "height"), F.concat_ws("/", "duration", "timescale"), F.col("n_samples"), F.size("keyframes"), F.crc32(F.concat_ws(",", frames).cast("binary"))]
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(" ", *facts).alias("feature"),
    )


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, learn=crc_mod(5) != 0)
    found = quality.score(docs, model)
    held = F.coalesce(crc_mod(5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    coded = trie_bpe.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    made = fim.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    hashed = made.withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256))
    back = fim.restore(hashed)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    codes = vector_codes.compress(read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    digest = hashlib.sha256(",".join(map(str, codes.books.ravel().tolist())).encode()).hexdigest()
    labels = cut(codes.rows.groupBy(F.col("label").alias("label_")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    found = codes.rows.join(labels, F.col("label").eqNullSafe(F.col("label_")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def queries() -> dict:
    named = (
        op1_substring_dedup, op2_ngram_jaccard_join, op3_language_id, op4_token_planes, op5_media_columns,
        op6_exact_topk, op7_packing, op8_sharding, op9_quality_classifier, op10_trie_bpe,
        op11_fill_in_middle, op12_vector_codes, op13_posting_lists,
    )
    return {f.__name__: f for f in named}


TOP_K = """WITH v AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
 SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


FILL_IN_MIDDLE = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents),
 g AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
 c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
 p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """A pair of tables for each round: the parts' nearest entries, and the entries that follow from them."""
    steps = [
        """v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rn, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"x AS MATERIALIZED (SELECT rn, p, list_slice(e, p * (len(e) // {parts}) + 1, (p + 1) * (len(e) // {parts})) AS y FROM v, range({parts}) AS r(p))",
        f"c0 AS MATERIALIZED (SELECT p, rn - 1 AS j, y AS z FROM x WHERE rn <= {entries})",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT rn, p, any_value(y) AS y, min({{'d': list_sum(list_transform(range(1, len(y) + 1), lambda k: (y[k] - z[k]) * (y[k] - z[k])))::BIGINT, 'j': j}}) AS near
 FROM x JOIN c{i} USING (p) GROUP BY rn, p)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.p, c.j, coalesce(m.z, c.z) AS z FROM c{i} c LEFT JOIN (SELECT p, j, list(CAST(floor(s / n) AS BIGINT) ORDER BY k) AS z
 FROM (SELECT p, near.j AS j, k, sum(y[k]) AS s, count(*) AS n FROM a{i}, LATERAL (SELECT unnest(range(1, len(y) + 1)) AS k) GROUP BY ALL) GROUP BY p, j) m ON c.p = m.p AND c.j = m.j)""")
    return f"""WITH {", ".join(steps)},
 f AS (SELECT rn, string_agg(printf('%02x', near.j), '' ORDER BY p) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rn),
 b AS (SELECT sha256(string_agg(array_to_string(z, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{rounds})
 SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN f USING (rn), b"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL; the other operators rest on hashes, tokenizers or models that SQL lacks."""
    return {"op6_exact_topk": TOP_K, "op11_fill_in_middle": FILL_IN_MIDDLE, "op12_vector_codes": _vector_codes_sql()}
