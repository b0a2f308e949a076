"""Registered queries of the training-data operators, and DuckDB texts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS width,
    array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, i, width, array_to_string(list_slice(ws, i, i + width - 1), ' ') AS win
  FROM (SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i
        FROM w, (SELECT DISTINCT width FROM bw) WHERE len(ws) >= width)),
hit AS (SELECT dw.doc_id, dw.i, dw.width, bw.item_id FROM dw JOIN bw USING (width, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(its.ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(its.ids, ','), '')) AS items_sha256,
  coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(w.ws) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@register("op8_decontaminate", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document against the benchmark."""
    from helioframe.llm.decontaminate import contaminated, decontaminate

    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


@register("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, posterior quality and verdict of every document."""
    from helioframe.llm.quality_rules import assess

    judged = assess(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


@register("op1_vector_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    import public_tokenizers

    from helioframe.llm.vector_packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pieces.withColumnRenamed("id", "doc_id")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + least(len(ws), 4) - 1), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(len(ws), 4) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (sh)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.c >= 80 * (na.n + nb.n - p.c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  least(w.doc_id, coalesce(m.c, w.doc_id)) AS component_id, w.doc_id <= coalesce(m.c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) m USING (doc_id)
"""


@register("op7_tensor_minhash", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 0.8 similarity of 4-word shingles."""
    from helioframe.llm.tensor_minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id",
        (F.col("component_id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"),
    )


@register("op10_run_length_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 100 bytes of an earlier place."""
    from helioframe.llm.run_length_index import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return cut.select(
        "row.doc_id", "n_bytes",
        F.expr("CAST(aggregate(spans, 0L, (n, x) -> n + x.end - x.start) AS BIGINT)").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op2_suffix_tree_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under the suffix tree and under word counts."""
    from helioframe.llm.suffix_tree_lm import score_texts

    return score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op4_piece_langid")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the labelled training documents."""
    import public_tokenizers

    from helioframe.llm.piece_langid import identify

    found = identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


@register("op3_pu_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, from trusted positives and unlabelled text."""
    from helioframe.llm.pu_quality import classify

    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@register("op9_host_suffix_array")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from helioframe.llm.host_suffix_array import main_text

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text(pages, keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


@register("op6_collinear_chains")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, with edits, an earlier document's."""
    from helioframe.llm.collinear_chains import fuzzy_passages

    found = fuzzy_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("source").alias("source_doc_id"), F.col("start").alias("start_word"),
        F.col("end").alias("end_word"), F.col("source_start").alias("source_start_word"),
        F.col("source_end").alias("source_end_word"), (F.col("equal") / F.col("columns")).alias("similarity"),
    )


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """Every round is three CTEs: all distances, the nearest centroid, the new centroids."""
    near = """
near{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) AS m FROM (
  SELECT v.r, c.c, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM v, cent{i} c) GROUP BY r)"""
    move = """
mean{i} AS (SELECT c, list(m ORDER BY j) AS x FROM (
  SELECT c, j, (s - ((s % n) + n) % n) // n AS m FROM (
    SELECT near{h}.m.c AS c, j, CAST(sum(v.x[j]) AS BIGINT) AS s, count(*) AS n
    FROM near{h} JOIN v USING (r), (SELECT unnest(range(1, 65)) AS j) GROUP BY ALL)) GROUP BY c),
cent{i} AS MATERIALIZED (SELECT c, coalesce(mean{i}.x, cent{h}.x) AS x FROM cent{h} LEFT JOIN mean{i} USING (c))"""
    steps = [near.format(i=0)]
    for i in range(1, rounds + 1):
        steps += [move.format(i=i, h=i - 1), near.format(i=i)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
cent0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
  FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {k})),
{", ".join(steps)}
SELECT v.vec_id, CAST(f.m.c AS INTEGER) AS cluster, f.m.d AS distance,
  CAST(sum(f.m.d) OVER (PARTITION BY f.m.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM near{rounds} f JOIN v USING (r) JOIN cent{rounds} c ON c.c = f.m.c
"""


@register("op11_lookup_clusters", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds."""
    from helioframe.llm.lookup_clusters import cluster_vectors

    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    known = [(c, i, sum(found.inertia), found.digest(c)) for c, i in enumerate(found.inertia)]
    known = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = found.assigned.join(F.broadcast(known), "cluster")  # one row a centroid
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@register("op12_refined_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 16 whitened components of every embedding."""
    from helioframe.llm.whitening import whiten

    found = whiten(table(spark, sf_dir, "embeddings"))
    shares = F.array(*[F.lit(e) for e in found.explained]) if found.explained else F.array(F.lit(0.0))
    cells = found.rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return cells.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(found.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(found.identity_error).alias("identity_error"),
    )


OP13_SQL = OP7_SQL.replace("len(ws), 4)", "len(ws), 5)").replace(", w.doc_id <= coalesce(m.c, w.doc_id) AS kept", "")


@register("op13_grouped_join", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 0.8 similarity of 5-word shingles."""
    from helioframe.llm.grouped_join import similar_documents

    found = similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
