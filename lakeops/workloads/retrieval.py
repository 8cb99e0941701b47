"""Retrieval queries on `embeddings`, `documents` and `benchmark`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions.text import hash_embedder
from lakeops.operators import vectors
from lakeops.session import spread, table, work_path


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        "embedding",
        F.col("label").cast("bigint").alias("label"),
        F.concat(F.lit("group"), (F.col("vec_id") % 6).cast("string")).alias("platform"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("vec_id") % 5 + 1).cast("string"), 2, "0")).alias("date"),
    )


def _centroids(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean vector per group; sums merge before the shuffle, one group row per dimension."""
    long = df.select(*by, F.posexplode("embedding").alias("dim", "v"))
    mean = long.groupBy(*by, "dim").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", "v")))
    return mean.groupBy(*by).agg(F.transform(ordered, lambda e: e["v"]).alias("embedding"))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return _centroids(_embeddings(spark, sf), ["label"]).withColumnRenamed("label", "query_id")


def _shown(results: DataFrame) -> DataFrame:
    return results.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


def knn(spark: SparkSession, sf: str, metric: str = "cosine") -> DataFrame:
    return _shown(vectors.knn(_labels(spark, sf), _embeddings(spark, sf), 10, metric))


def knn_offset(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(vectors.cosine_plus_one(vectors.knn(_labels(spark, sf), _embeddings(spark, sf), 10)))


def knn_self(spark: SparkSession, sf: str) -> DataFrame:
    docs = _embeddings(spark, sf)
    return _shown(vectors.knn(docs, docs, 10, query_id="doc_id", exclude_self=True))


def knn_filtered(spark: SparkSession, sf: str) -> DataFrame:
    docs = _embeddings(spark, sf)
    queries = _centroids(docs, ["platform", "date"]).withColumn("query_id", F.concat_ws("/", "platform", "date"))
    return _shown(vectors.knn(queries, docs, 5, "dot", filters=[("platform", "platform"), ("date", "date")]))


def _doc_terms(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.sparse_vectors(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text")


def sparse(spark: SparkSession, sf: str) -> DataFrame:
    queries = vectors.sparse_vectors(table(spark, sf, "benchmark"), "item_id", "text")
    return _shown(vectors.sparse_topk(queries, _doc_terms(spark, sf), 10, query_id="item_id"))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    terms = vectors.vocabulary(_doc_terms(spark, sf))
    return terms.agg(F.count("*").alias("terms"), F.sum(F.length("term")).alias("letters"))


def _hybrid_parts(spark: SparkSession, sf: str):
    """Per label: its mean vector and the eight terms found in most of its documents."""
    docs = _embeddings(spark, sf)
    # The term table is read twice, so it is written once.
    path = work_path(spark, "terms")
    _doc_terms(spark, sf).write.parquet(path)
    terms = spark.read.parquet(path)
    labelled = terms.select("doc_id", F.map_keys("terms").alias("words")).join(docs.select("doc_id", "label"), "doc_id")
    spread = labelled.select("label", F.explode("words").alias("term")).groupBy("label", "term").agg(F.count("*").alias("n"))
    top = spread.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "term"))).filter("r <= 8")
    entry = F.struct("term", (F.lit(5.0) - F.col("r") * 0.5).alias("w"))
    queries = top.groupBy(F.col("label").alias("query_id")).agg(F.map_from_entries(F.collect_list(entry)).alias("terms"))
    dense = vectors.knn(_labels(spark, sf), docs, 20)
    return dense, vectors.sparse_topk(queries, terms, 20)


def hybrid(spark: SparkSession, sf: str, method: str = "minmax") -> DataFrame:
    dense, sparse_part = _hybrid_parts(spark, sf)
    return _shown(vectors.hybrid_topk(dense, sparse_part, 10, method))


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).withColumnRenamed("query_id", "cell")


def cell_knn(spark: SparkSession, sf: str) -> DataFrame:
    docs = _embeddings(spark, sf)
    return _shown(vectors.cell_knn(docs, docs, _cells(spark, sf), 10, probes=3, query_id="doc_id", exclude_self=True))


def recall(spark: SparkSession, sf: str) -> DataFrame:
    docs = _embeddings(spark, sf)
    truth = vectors.knn(docs, docs, 10, query_id="doc_id", exclude_self=True)
    found = vectors.cell_knn(docs, docs, _cells(spark, sf), 10, probes=3, query_id="doc_id", exclude_self=True)
    return vectors.recall_at_k(truth, found, 10).agg(
        F.count("*").alias("queries"), F.round(F.avg("recall"), 6).alias("recall")
    )


def embed_hash(spark: SparkSession, sf: str) -> DataFrame:
    texts = vectors.prepare_texts(spread(table(spark, sf, "documents").select("doc_id", "text")), "text")
    embedded = vectors.embed(texts.select("doc_id", "text"), "text", hash_embedder, "embedding")
    places = embedded.select("doc_id", F.posexplode("embedding").alias("dim", "weight"))
    return places.filter("weight <> 0").select("doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("weight", 6).alias("weight"))


def vector_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").join(_embeddings(spark, sf), "doc_id").join(_doc_terms(spark, sf), "doc_id", "left")
    built = docs.select(
        "doc_id",
        F.col("text").alias("content"),
        "platform",
        "date",
        F.array("lang", "source").alias("tag"),
        vectors.normalize("embedding").alias("content_vector"),
        F.col("terms").alias("content_sparse_vector"),
    )
    return built.select(
        "doc_id",
        "platform",
        "date",
        F.array_join("tag", ",").alias("tags"),
        F.length("content").cast("bigint").alias("chars"),
        F.round(F.get("content_vector", F.lit(0)), 6).alias("first_component"),
        F.coalesce(F.size("content_sparse_vector"), F.lit(0)).cast("bigint").alias("terms"),
    )


def rank_features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        F.round(vectors.saturation("n_chars", 500.0), 6).alias("saturation"),
        F.round(vectors.log_feature("n_chars", 2.0), 6).alias("log"),
        F.round(vectors.sigmoid("n_chars", 500.0, 0.6), 6).alias("sigmoid"),
    )


QUERIES = {
    "knn_cosine": knn,
    "knn_dot": lambda spark, sf: knn(spark, sf, "dot"),
    "knn_l2": lambda spark, sf: knn(spark, sf, "l2"),
    "knn_cosine_offset": knn_offset,
    "knn_self_excluded": knn_self,
    "knn_filtered": knn_filtered,
    "knn_cells": cell_knn,
    "recall_at_k": recall,
    "sparse_topk": sparse,
    "sparse_vocabulary": vocabulary,
    "hybrid_minmax": hybrid,
    "hybrid_rrf": lambda spark, sf: hybrid(spark, sf, "rrf"),
    "embed_hash": embed_hash,
    "vector_documents": vector_documents,
    "rank_features": rank_features,
}

_DOCS = """docs as (select vec_id as doc_id, cast(embedding as double[]) as v, cast(label as bigint) as label,
    'group' || (vec_id % 6) as platform,
    '2024-01-0' || (vec_id % 5 + 1) as date from embeddings)"""


def _mean(by: str, name: str) -> str:
    return f"""{name} as (select {by}, list(x order by i) as v from (
      select {by}, i, round(avg(v[i]), 6) as x from docs, range(1, 65) r(i) group by {by}, i) group by {by})"""


_SCORES = {
    "cosine": "list_cosine_similarity(q.v, d.v)",
    "dot": "list_dot_product(q.v, d.v)",
    "l2": "-list_sum(list_transform(list_zip(q.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))",
}


def _top(queries: str, query_id: str, score: str, k: int, condition: str = "true", shown: str = "score") -> str:
    return f"""select query_id, rank, doc_id, round({shown}, 6) as score from (
      select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
        select {query_id} as query_id, d.doc_id, round({score}, 9) as score from {queries} q, docs d where {condition}))
    where rank <= {k}"""


_LABELS = _mean("label", "labels_v")
_KNN = f"with {_DOCS}, {_LABELS} "
_SELF = _top("docs", "q.doc_id", _SCORES["cosine"], 10, "q.doc_id <> d.doc_id")
_TOKENS = "(select {key}, unnest(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+')) as t from {table})"
_TERMS = "(select {key}, t, round(1.0::double + ln(count(*)), 6) as w from " + _TOKENS + " where t <> '' group by all)"
_CELLS = f"""near as (select doc_id, v, cell, row_number() over (partition by doc_id order by d2, cell) as r from (
    select d.doc_id, d.v, l.label as cell, round(list_sum(list_transform(list_zip(d.v, l.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) as d2
    from docs d, labels_v l)),
  found as (select query_id, rank, doc_id, score from (
    select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
      select q.doc_id as query_id, d.doc_id, round({_SCORES['cosine']}, 9) as score from near q, near d
      where q.r <= 3 and d.r = 1 and q.cell = d.cell and q.doc_id <> d.doc_id)) where rank <= 10)"""


def _hybrid_sql(part: str) -> str:
    return f"""with {_DOCS}, {_LABELS},
      terms as {_TERMS.format(key='doc_id', table='documents')},
      spread as (select label, t, count(*) as n from terms join docs using (doc_id) group by 1, 2),
      qt as (select label, t, 5.0::double - r * 0.5::double as w from (
        select *, row_number() over (partition by label order by n desc, t) as r from spread) where r <= 8),
      dense as (select query_id, doc_id, score, rank from (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
          select q.label as query_id, d.doc_id, round({_SCORES['cosine']}, 9) as score from labels_v q, docs d)) where rank <= 20),
      sparse as (select query_id, doc_id, score, rank from (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
          select label as query_id, doc_id, round(sum(qt.w * terms.w), 9) as score from qt join terms using (t) group by 1, 2)) where rank <= 20),
      parts as ({part.format(t='dense')} union all {part.format(t='sparse')}),
      fused as (select query_id, doc_id, round(sum(part), 9) as score from parts group by 1, 2)
      select query_id, rank, doc_id, round(score, 6) as score from (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from fused) where rank <= 10"""


ORACLE = {
    "knn_cosine": _KNN + _top("labels_v", "q.label", _SCORES["cosine"], 10),
    "knn_dot": _KNN + _top("labels_v", "q.label", _SCORES["dot"], 10),
    "knn_l2": _KNN + _top("labels_v", "q.label", _SCORES["l2"], 10, shown="sqrt(-score)"),
    "knn_cosine_offset": _KNN + _top("labels_v", "q.label", _SCORES["cosine"], 10, shown="score + 1"),
    "knn_self_excluded": f"with {_DOCS} {_SELF}",
    "knn_filtered": f"with {_DOCS}, {_mean('platform, date', 'q_v')} "
    + _top("q_v", "q.platform || '/' || q.date", _SCORES["dot"], 5, "q.platform = d.platform and q.date = d.date"),
    "knn_cells": f"with {_DOCS}, {_LABELS}, {_CELLS} select query_id, rank, doc_id, round(score, 6) as score from found",
    "recall_at_k": f"""with {_DOCS}, {_LABELS}, {_CELLS}, truth as ({_SELF}),
      hits as (select t.query_id, count(f.doc_id) / count(*)::double as recall from truth t
        left join found f on f.query_id = t.query_id and f.doc_id = t.doc_id group by 1)
      select count(*) as queries, round(avg(recall), 6) as recall from hits""",
    "sparse_topk": f"""with q as {_TERMS.format(key='item_id', table='benchmark')}, d as {_TERMS.format(key='doc_id', table='documents')}
      select query_id, rank, doc_id, round(score, 6) as score from (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
          select item_id as query_id, doc_id, round(sum(q.w * d.w), 9) as score from q join d using (t) group by 1, 2)) where rank <= 10""",
    "sparse_vocabulary": f"""select count(*) as terms, cast(sum(length(t)) as bigint) as letters from (
      select distinct t from {_TOKENS.format(key='doc_id', table='documents')} where t <> '')""",
    "hybrid_minmax": _hybrid_sql(
        """select query_id, doc_id, coalesce((score - min(score) over w) / nullif(max(score) over w - min(score) over w, 0), 1) * 0.5::double as part
        from {t} window w as (partition by query_id)"""
    ),
    "hybrid_rrf": _hybrid_sql("select query_id, doc_id, 0.5::double / (60 + rank) as part from {t}"),
    "embed_hash": f"""with h as (select doc_id, md5(t) as m from {_TOKENS.format(key='doc_id', table='documents')} where t <> ''),
      c as (select doc_id, cast(('0x' || substr(m, 1, 8)) as bigint) % 64 as dim,
              sum(case when cast(('0x' || substr(m, 9, 1)) as bigint) % 2 = 0 then 1 else -1 end) as n from h group by 1, 2)
      select doc_id, dim, round(n / sqrt(sum(n * n) over (partition by doc_id)), 6) as weight from c qualify n <> 0""",
    "vector_documents": f"""with {_DOCS}, n as (select doc_id, count(*) as terms from {_TERMS.format(key='doc_id', table='documents')} group by 1)
      select docs.doc_id, platform, date, lang || ',' || source as tags, length(text) as chars,
        round(v[1] / sqrt(list_dot_product(v, v)), 6) as first_component, coalesce(terms, 0) as terms
      from docs join documents using (doc_id) left join n using (doc_id)""",
    "rank_features": """select doc_id, round(n_chars / (n_chars + 500.0::double), 6) as saturation, round(ln(2 + n_chars), 6) as log,
      round(pow(n_chars, 0.6::double) / (pow(n_chars, 0.6::double) + pow(500, 0.6::double)), 6) as sigmoid from documents""",
}
