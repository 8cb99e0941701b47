"""Embedding and nearest-neighbour retrieval: exact, filtered, sparse, hybrid and cell-probing, with recall.

Every search has the same shape. Queries of a checked size travel to the corpus partitions once; each task
scores its rows with numpy and forwards only its k best per query. Larger query sets are cut into blocks that
meet the corpus chunks in a co-grouped job, so nothing is collected and no pair of rows is ever shuffled.
Scores are rounded to nine decimals before ranking, so equal scores tie by id however the data is partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import text as words
from lakeops.session import parallelism, stored

QUERY_BYTES = 64 * 1024 * 1024
ROWS_PER_CHUNK = 200_000
ROWS_PER_CELL = 32_768
CHUNK_BYTES = 128 * 1024 * 1024
BLOCK_BYTES = 32 * 1024 * 1024
# A task keeps the k best of the queries of a block, this many in all.
KEPT_AT_ONCE = 1_000_000
_CELLS_AT_ONCE = 1_000_000
_DOCS_AT_ONCE = 1_000
_PAIRS_AT_ONCE = 100_000
_MARGIN = 1e-6


# --- embedding --------------------------------------------------------------------------------------------


def embed(
    df: DataFrame,
    text_col: str,
    embedder: Callable[[], Callable[[pd.Series], list]],
    out: str = "embedding",
    max_chars: int | None = None,
) -> DataFrame:
    """Add an embedding column. `embedder()` runs once per task, so it may open a model or a client.

    Texts go in whole; `max_chars` is for models that refuse longer input.
    """

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = embedder()
        for texts in batches:
            yield pd.Series(list(model(texts)))

    source = F.col(text_col) if max_chars is None else F.substring(text_col, 1, max_chars)
    # Marked as not repeatable, so that no filter on the result makes Spark call the model twice.
    return df.withColumn(out, run.asNondeterministic()(source))


def prepare_texts(
    df: DataFrame,
    text_col: str,
    max_length: int | None = None,
    pieces: int | None = None,
    limit: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Non-empty texts spread over `pieces` partitions for the model.

    Optionally only texts up to a length, and only the first `limit` by `order`.
    """
    kept = df.filter(F.length(F.trim(text_col)) > 0)
    if max_length is not None:
        kept = kept.filter(F.length(text_col) <= max_length)
    if limit is not None:
        kept = (kept.orderBy(*order) if order else kept).limit(limit)
    return kept.repartition(pieces) if pieces else kept


def normalize(vector: str | Column) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    column = F.col(vector) if isinstance(vector, str) else vector
    doubles = column.cast("array<double>")
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(doubles, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)))


def sparse_vectors(df: DataFrame, key: str, text_col: str, out: str = "terms") -> DataFrame:
    """Term weights 1 + ln(count) per document as a map; documents without a word drop out.

    Counting inside the row keeps the words out of a shuffle, which exploding and grouping them would need: words are sorted, and a term's count is the
    distance between the first places of it and of the next one.
    """
    rows = df.select(key, F.sort_array(F.array_remove(words.split_words(text_col), "")).alias("_words"))
    at = lambda i: F.get("_words", i)
    firsts = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: (i == 0) | (at(i) != at(i - 1)))
    rows = rows.withColumn("_first", F.when(F.size("_words") > 0, firsts))
    ends = F.concat(F.slice("_first", 2, F.size("_first")), F.array(F.size("_words")))
    weights = F.zip_with("_first", ends, lambda i, j: F.round(F.lit(1.0) + F.log((j - i).cast("double")), 6))
    terms = F.map_from_arrays(F.transform("_first", at), weights)
    # Behind a generator: Catalyst would move filters on the terms down and so sort the words once per word.
    return rows.select(key, F.explode_outer(F.array(terms)).alias(out)).filter(F.col(out).isNotNull())


# --- scoring kernels (numpy inside one task) --------------------------------------------------------------


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1
    return rows / norms


class _Dense:
    """Scores of vectors. `rough` may be off by `slack`: unit vectors are first multiplied in single precision."""

    def __init__(self, queries: pd.DataFrame, metric: str):
        self.metric, self.q = metric, _matrix(queries["_vec"])
        if metric == "cosine":
            self.q = _units(self.q)
        self.single = metric == "cosine"
        # The error of an inner product of unit vectors in single precision, rounding of its factors included, is below (n + 2) * 2^-24.
        self.slack = (self.q.shape[1] + 8) * 2.0**-22 if self.single else 0.0
        self.fast = self.q.astype(np.float32) if self.single else self.q

    def prepare(self, docs: pd.DataFrame):
        x = _matrix(docs["_vec"])
        x = _units(x) if self.metric == "cosine" else x
        return x, (x.astype(np.float32) if self.single else x)

    def rough(self, x, start: int, stop: int) -> np.ndarray:
        whole, fast = x
        products = self.fast[start:stop] @ fast.T
        if self.metric != "l2":
            return products
        q = self.q[start:stop]
        squared = (q * q).sum(axis=1)[:, None] + (whole * whole).sum(axis=1)[None, :] - 2 * products
        return -np.maximum(squared, 0)

    def exact(self, x, owner: np.ndarray, column: np.ndarray, rough: np.ndarray) -> np.ndarray:
        if not self.single:
            return rough
        out = np.empty(len(owner))
        for start in range(0, len(owner), _PAIRS_AT_ONCE):
            part = slice(start, start + _PAIRS_AT_ONCE)
            out[part] = np.einsum("ij,ij->i", self.q[owner[part]], x[0][column[part]])
        return out


def _best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best (score descending, id ascending) entries of each owner."""
    order = np.lexsort((ids, -scores, owner))
    owner, ids, scores = owner[order], ids[order], scores[order]
    starts = np.searchsorted(owner, owner, side="left")
    keep = np.arange(len(owner)) - starts < k
    return owner[keep], ids[keep], scores[keep]


def _scan(queries: pd.DataFrame, batches: Iterator[pd.DataFrame], k: int, metric: str, kernel, exclude_self: bool):
    """Best k documents per query over all batches of one task.

    Each query keeps the score that a document must reach, its k-th best so far. So of all pairs only the few above it are looked at again, and what is held
    between merges is in proportion to the k best of all queries.
    """
    scorer = kernel(queries, metric)
    n, qids = len(queries), queries["query_id"].to_numpy()
    if not n:
        batches = iter(())
    edge = np.full(n, -np.inf)
    best, held, limit = None, [], max(n * k, 100_000)

    def merge() -> None:
        nonlocal best
        parts = [*([best] if best is not None else []), *held]
        best = _best(*(np.concatenate(columns) for columns in zip(*parts)), k)
        held.clear()
        last = np.flatnonzero(np.append(best[0][1:] != best[0][:-1], True)) if len(best[0]) else np.zeros(0, int)
        full = last[np.diff(np.append(-1, last)) == k]
        edge[best[0][full]] = best[2][full]

    for batch in batches:
        for start in range(0, len(batch), _DOCS_AT_ONCE):
            docs = batch.iloc[start : start + _DOCS_AT_ONCE]
            ids, x = docs["doc_id"].to_numpy(), scorer.prepare(docs)
            step = max(1, _CELLS_AT_ONCE // len(docs))
            for low in range(0, n, step):
                high = min(low + step, n)
                rough = scorer.rough(x, low, high)
                floor = edge[low:high]
                fresh = np.flatnonzero(np.isneginf(floor))
                if len(fresh):
                    rows = np.where(np.isfinite(rough[fresh]), rough[fresh], -np.inf)
                    if exclude_self:
                        rows[qids[low + fresh][:, None] == ids[None, :]] = -np.inf
                    floor = floor.copy()
                    if len(docs) > k:
                        floor[fresh] = np.partition(rows, len(docs) - k, axis=1)[:, len(docs) - k] - scorer.slack
                # Half a unit of the ninth decimal, to which scores are rounded.
                least = (floor - scorer.slack - 1e-9).astype(rough.dtype)
                at = np.flatnonzero((rough >= least[:, None]).ravel())
                owner, column = np.divmod(at, len(docs))
                scores = np.round(scorer.exact(x, owner + low, column, rough.ravel()[at]), 9) + 0.0
                keep = np.isfinite(scores)
                if exclude_self:
                    keep &= qids[owner + low] != ids[column]
                held.append((owner[keep] + low, ids[column[keep]], scores[keep]))
            if sum(len(h[0]) for h in held) >= limit:
                merge()
    if held:
        merge()
    if best is None:
        return pd.DataFrame({"query_id": qids[:0], "doc_id": [], "score": np.array([], float)})
    owner, ids, scores = best
    return pd.DataFrame({"query_id": qids[owner], "doc_id": ids, "score": scores})


# --- distributed search -----------------------------------------------------------------------------------


def _result_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return partial.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _blocks(queries: DataFrame, corpus: DataFrame, on: list[str], k: int, metric: str, kernel, exclude_self: bool) -> DataFrame:
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
        return _scan(q.reset_index(drop=True), iter([d]), k, metric, kernel, exclude_self)

    grouped = queries.groupBy(*on).cogroup(corpus.groupBy(*on))
    return grouped.applyInPandas(run, _result_schema(queries, corpus))


def _search(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str, kernel, exclude_self: bool, width: Column, query_bytes: int, doc_width: Column | None = None
) -> DataFrame:
    queries = queries.persist()
    try:
        size = queries.agg(F.count("*").alias("n"), F.sum(width).alias("cells")).head()
        volume, kept = (size["cells"] or 0) * 16, size["n"] * k
        known = queries.toPandas() if volume <= query_bytes and kept <= KEPT_AT_ONCE // 10 else None
    finally:
        queries.unpersist()
    if known is not None:
        shared = queries.sparkSession.sparkContext.broadcast(known)

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield _scan(shared.value, batches, k, metric, kernel, exclude_self)

        return _ranked(corpus.mapInPandas(scan, _result_schema(queries, corpus)), k)
    # Too many queries to ship whole: blocks of queries meet chunks of the corpus.
    # Chunks hold bounded bytes, however long the vectors are, and blocks bounded results, too.
    cells = corpus.agg(F.sum(width if doc_width is None else doc_width)).head()[0] or 0
    chunks = max(1, math.ceil(cells * 16 / CHUNK_BYTES))
    blocks = max(math.ceil(volume / min(query_bytes, BLOCK_BYTES)), math.ceil(kept / KEPT_AT_ONCE), 1)
    # Some groups for each task: more blocks do not make more results, more chunks would.
    blocks = max(blocks, min(math.ceil(4 * parallelism(corpus.sparkSession) / chunks), math.ceil(size["n"] / 100)))
    left = queries.withColumns(
        {"_block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)), "_chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))}
    ).withColumn("_chunk", F.col("_chunk").cast("bigint"))
    right = corpus.withColumns(
        {"_chunk": F.pmod(F.xxhash64("doc_id"), F.lit(chunks)), "_block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))}
    ).withColumn("_block", F.col("_block").cast("bigint"))
    return _ranked(_blocks(left, right, ["_block", "_chunk"], k, metric, kernel, exclude_self), k)


def _search_groups(queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool, group_bytes: int) -> DataFrame:
    """Search within equal `_filter` values: both sides are grouped by the value first, so no query meets a document it may not return.

    A large group of documents is split by its measured bytes and its queries go to each part; many queries of one value are split as well.
    """
    spec = [(corpus, "d"), (queries, "q")]
    sizes = [x.groupBy("_filter").agg(F.ceil(F.sum(F.size("_vec")) * 16 / group_bytes).alias(f"_{n}n")) for x, n in spec]
    parts = stored(sizes[0].join(sizes[1], "_filter"), "filter-groups")
    part = parts.withColumnRenamed("_filter", "_f")
    q = queries.join(part, F.col("_filter") == F.col("_f")).withColumns(
        {"_qs": F.expr("pmod(xxhash64(query_id), _qn)"), "_ds": F.expr("explode(sequence(0L, _dn - 1))")}
    )
    d = corpus.join(part, F.col("_filter") == F.col("_f")).withColumns(
        {"_ds": F.expr("pmod(xxhash64(doc_id), _dn)"), "_qs": F.expr("explode(sequence(0L, _qn - 1))")}
    )
    keys = ["_filter", "_qs", "_ds"]
    q, d = q.select("query_id", "_vec", *keys), d.select("doc_id", "_vec", *keys)
    return _ranked(_blocks(q, d, keys, k, metric, _Dense, exclude_self), k)


def _keyed(df: DataFrame, key: str, vector: str, name: str, filters: Sequence[str] = ()) -> DataFrame:
    columns = [F.col(key).alias(name), F.col(vector).alias("_vec")]
    if filters:
        columns.append(F.to_json(F.struct(*(F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(filters)))).alias("_filter"))
    return df.select(*columns).filter(F.col("_vec").isNotNull())


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "cosine",
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    filters: Sequence[tuple[str, str]] = (),
    exclude_self: bool = False,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Exact k nearest documents per query: (query_id, rank, doc_id, score).

    `cosine` and `dot` rank by similarity, `l2` by distance (`score` is the distance). `filters` pairs a query
    column with a document column that must be equal, which groups both sides before anything is scored; `exclude_self` drops the document with the query's id.
    """
    q = _keyed(queries, query_id, query_vector, "query_id", [a for a, _ in filters])
    d = _keyed(corpus, doc_id, doc_vector, "doc_id", [b for _, b in filters])
    if filters:
        found = _search_groups(q, d, k, metric, exclude_self, query_bytes)
    else:
        found = _search(q, d, k, metric, _Dense, exclude_self, F.size("_vec"), query_bytes)
    score = F.sqrt(-F.col("score")) if metric == "l2" else F.col("score")
    return found.select("query_id", "rank", "doc_id", score.alias("score"))


def cosine_plus_one(results: DataFrame) -> DataFrame:
    """Cosine scores shifted to be non-negative."""
    return results.withColumn("score", F.col("score") + 1.0)


def sparse_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    query_terms: str = "terms",
    doc_terms: str = "terms",
    rows_per_salt: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Best k documents per query by the sum of query weight times document weight over common terms, exactly.

    A join on terms, cut by bounds. A term adds at most its largest document weight times the query's. The k-th best single product of a query is a score that
    k documents reach, so terms that cannot reach it even together bring no new document: only the other, rarer ones are joined with their postings. Documents that
    cannot reach the k-th best sum found so far go, the rest get their missing products from their own terms. Terms with many postings are salted.
    With a negative weight on either side nothing is cut.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.explode(query_terms).alias("term", "_qw")).filter("_qw <> 0")
    q = stored(q, "query-terms")
    d = corpus.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), F.col(doc_terms).alias("_terms")).filter(F.col("_terms").isNotNull())
    wanted = q.select("term").distinct()
    # The corpus is read once: all that comes later takes the terms of documents from here.
    postings = stored(d.select("doc_id", "_row", F.explode("_terms").alias("term", "_dw")).join(wanted, "term", "left_semi"), "postings")
    by_weight = Window.partitionBy("term").orderBy(F.desc("_dw"))
    best = postings.withColumn("_r", F.row_number().over(by_weight)).filter(F.col("_r") <= k)
    kth = best.groupBy("term").agg(F.max("_dw").alias("_most"), F.max("_r").alias("_n"), F.min("_dw").alias("_kth"))
    counts = postings.groupBy("term").agg(F.count("*").alias("_df"), F.min("_dw").alias("_least"))
    terms = stored(q.join(counts.join(kth, "term"), "term"), "query-terms")
    lowest = terms.agg(F.least(F.min("_qw"), F.min("_least"))).head()[0]
    if lowest is None:
        return _ranked(queries.sparkSession.createDataFrame([], _result_schema(q, d)), k).select("query_id", "rank", "doc_id", "score")
    mine = Window.partitionBy("query_id")  # the terms of one query
    reached = F.max(F.when(F.col("_n") >= k, F.col("_qw") * F.col("_kth"))).over(mine)
    below = F.sum(F.col("_qw") * F.col("_most")).over(mine.orderBy(F.col("_qw") * F.col("_most"), "term").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Scores are rounded to nine decimals before they are ranked: the margin keeps all that tie.
    needed = (F.coalesce(below + _MARGIN >= reached, F.lit(True))) if lowest >= 0 else F.lit(True)
    terms = stored(terms.withColumn("_needed", needed), "query-terms")
    salts = F.ceil(F.col("_df") / rows_per_salt)
    left = terms.filter("_needed").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    heavy = terms.filter(F.col("_df") > rows_per_salt).select("term", salts.alias("_salts")).distinct()
    right = postings.join(heavy, "term", "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_salts")), F.lit(0)))
    met = left.select("query_id", "term", "_qw", "_salt").join(right.select("term", "doc_id", "_dw", "_salt"), ["term", "_salt"])
    sums = stored(met.groupBy("query_id", "doc_id").agg(F.sum(F.col("_qw") * F.col("_dw")).alias("_sum")), "sums")
    rest = terms.filter("not _needed").groupBy("query_id").agg(
        F.collect_list(F.struct("term", "_qw")).alias("_rest"), F.sum(F.col("_qw") * F.col("_most")).alias("_more")
    )
    ranked = sums.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("_sum")))).filter(F.col("_r") <= k)
    edge = ranked.groupBy("query_id").agg(F.max("_r").alias("_n"), F.min("_sum").alias("_edge"))
    limits = edge.join(rest, "query_id", "left").select("query_id", "_rest", F.coalesce("_more", F.lit(0.0)).alias("_more"), F.when(F.col("_n") >= k, F.col("_edge")).alias("_edge"))
    open_ = sums.join(limits, "query_id").filter(F.coalesce(F.col("_sum") + F.col("_more") + _MARGIN >= F.col("_edge"), F.lit(True)))
    done = open_.filter(F.col("_rest").isNull()).select("query_id", "doc_id", "_sum")
    spared = postings.join(terms.filter("not _needed").select("term", F.lit(True).alias("_spared")).distinct(), "term", "left")
    own = spared.groupBy("doc_id", "_row").agg(F.map_from_entries(F.collect_list(F.when(F.col("_spared"), F.struct("term", "_dw")))).alias("_terms"))
    late = open_.filter(F.col("_rest").isNotNull()).join(own, "doc_id")
    added = F.aggregate("_rest", F.lit(0.0), lambda acc, x: acc + x["_qw"] * F.coalesce(F.try_element_at("_terms", x["term"]), F.lit(0.0)))
    found = done.unionByName(late.select("query_id", "doc_id", (F.col("_sum") + added).alias("_sum")))
    return _ranked(found.select("query_id", "doc_id", F.round("_sum", 9).alias("score")), k).select("query_id", "rank", "doc_id", "score")


def vocabulary(corpus: DataFrame, terms: str = "terms", fallback: int = 0) -> DataFrame:
    """Distinct terms of the corpus; with `fallback`, `term1..termN` if there are none."""
    found = corpus.select(F.explode(F.map_keys(terms)).alias("term")).distinct()
    if fallback and found.isEmpty():
        spark = corpus.sparkSession
        return spark.range(1, fallback + 1).select(F.concat(F.lit("term"), F.col("id").cast("string")).alias("term"))
    return found


def hybrid_topk(
    dense: DataFrame,
    sparse: DataFrame,
    k: int,
    method: str = "minmax",
    weights: tuple[float, float] = (0.5, 0.5),
    rrf_constant: int = 60,
) -> DataFrame:
    """Fuse two result lists (query_id, rank, doc_id, score) into one.

    `minmax` scales each list to 0..1 per query (1 if all its scores are equal) and takes the weighted mean;
    `rrf` sums weight / (constant + rank). A document missing from a list adds nothing for it.
    """

    def part(results: DataFrame, weight: float) -> DataFrame:
        if method == "rrf":
            value = F.lit(weight) / (F.lit(rrf_constant) + F.col("rank"))
            return results.select("query_id", "doc_id", value.alias("part"))
        every = Window.partitionBy("query_id")  # at most k rows per query
        low, high = F.min("score").over(every), F.max("score").over(every)
        scaled = F.coalesce(F.try_divide(F.col("score") - low, high - low), F.lit(1.0))
        return results.select("query_id", "doc_id", (scaled * weight / sum(weights)).alias("part"))

    fused = part(dense, weights[0]).unionByName(part(sparse, weights[1]))
    summed = fused.groupBy("query_id", "doc_id").agg(F.round(F.sum("part"), 9).alias("score"))
    return _ranked(summed, k).select("query_id", "rank", "doc_id", "score")


def recall_at_k(truth: DataFrame, result: DataFrame, k: int) -> DataFrame:
    """Per query: share of the k true neighbours that the result found."""

    def lists(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("rank") <= k).groupBy("query_id").agg(F.collect_set("doc_id").alias(name))

    both = lists(truth, "true_ids").join(lists(result, "found_ids"), "query_id", "left")
    found = F.coalesce(F.size(F.array_intersect("true_ids", "found_ids")), F.lit(0))
    share = F.when(F.col("found_ids").isNull(), 0.0).otherwise(F.try_divide(found.cast("double"), F.size("true_ids").cast("double")))
    return both.select("query_id", share.alias("recall"))


# --- approximate search by cells --------------------------------------------------------------------------


def train_cells(corpus: DataFrame, cells: int, vector: str = "embedding", seed: int = 1, sample: float | None = None) -> DataFrame:
    """Cell centres (cell, embedding) by k-means. Only the centres depend on `sample`, never the result rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    points = corpus if sample is None else corpus.sample(sample, seed)
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(points.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")))
    rows = [(i, [float(v) for v in centre]) for i, centre in enumerate(model.clusterCenters())]
    return corpus.sparkSession.createDataFrame(rows, "cell bigint, embedding array<double>")


def nearest_cells(
    df: DataFrame, centres: DataFrame, probes: int = 1, vector: str = "embedding", centre_bytes: int = 4 * QUERY_BYTES
) -> DataFrame:
    """Each row once per nearest cell (`cell`, by Euclidean distance; ties by cell).

    The centres, a number the caller chose, go to every task and must fit `centre_bytes`.
    """
    volume = centres.agg(F.sum(F.size("embedding")) * 8).head()[0] or 0
    if volume > centre_bytes:
        raise ValueError(f"{volume} bytes of cell centres, at most {centre_bytes}: train fewer cells")
    known = centres.orderBy("cell").toPandas()
    shared = df.sparkSession.sparkContext.broadcast((known["cell"].to_numpy(), _matrix(known["embedding"])))

    @F.pandas_udf("array<bigint>")
    def closest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cells, points = shared.value
        for batch in batches:
            x = _matrix(batch)
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            squared = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
            order = np.argsort(np.round(squared, 9), axis=1, kind="stable")[:, :probes]
            yield pd.Series(list(cells[order]))

    return df.filter(F.col(vector).isNotNull()).withColumn("cell", F.explode(closest(vector)))


def cell_knn(
    queries: DataFrame,
    corpus: DataFrame,
    centres: DataFrame,
    k: int,
    probes: int = 4,
    metric: str = "cosine",
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    exclude_self: bool = False,
    rows_per_task: int = ROWS_PER_CELL,
) -> DataFrame:
    """Approximate k nearest documents: each query looks only into its `probes` nearest cells.

    A large cell is split over several tasks (its queries are copied to each) and a crowded query cell likewise,
    so the cell that holds a third of the corpus costs no more per task than the others.
    """
    centres = centres.persist()  # small, and read once per side
    q = nearest_cells(_keyed(queries, query_id, query_vector, "query_id"), centres, probes, "_vec")
    d = nearest_cells(_keyed(corpus, doc_id, doc_vector, "doc_id"), centres, 1, "_vec")

    centres.unpersist()
    # One row per cell, no more than there are centres.
    sizes = (
        d.select("cell", F.lit(1).alias("_d"), F.lit(0).alias("_q"))
        .unionByName(q.select("cell", F.lit(0).alias("_d"), F.lit(1).alias("_q")))
        .groupBy("cell")
        .agg(F.sum("_d").alias("d"), F.sum("_q").alias("q"))
        .filter("d > 0 and q > 0")
        .collect()
    )
    pieces = [(r["cell"], math.ceil(r["d"] / rows_per_task), math.ceil(r["q"] / rows_per_task)) for r in sizes]
    spark = corpus.sparkSession
    q = q.join(spark.createDataFrame(pieces, "cell bigint, _dn bigint, _qn bigint"), "cell").withColumns(
        {"_qs": F.expr("pmod(xxhash64(query_id), _qn)"), "_ds": F.expr("explode(sequence(0L, _dn - 1))")}
    )
    d = d.join(spark.createDataFrame(pieces, "cell bigint, _dn bigint, _qn bigint"), "cell").withColumns(
        {"_ds": F.expr("pmod(xxhash64(doc_id), _dn)"), "_qs": F.expr("explode(sequence(0L, _qn - 1))")}
    )
    partial = _blocks(q, d, ["cell", "_qs", "_ds"], k, metric, _Dense, exclude_self)
    score = F.sqrt(-F.col("score")) if metric == "l2" else F.col("score")
    return _ranked(partial, k).select("query_id", "rank", "doc_id", score.alias("score"))


# --- approximate search on compressed vectors -------------------------------------------------------------


def _lloyd(points: np.ndarray, centres: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres of a few thousand points; a centre without points stays."""
    known = np.unique(points, axis=0)
    if len(known) <= centres:
        return known
    middle = known[rng.choice(len(known), centres, replace=False)]
    for _ in range(rounds):
        near = ((middle * middle).sum(axis=1)[None, :] - 2 * (points @ middle.T)).argmin(axis=1)
        counts = np.bincount(near, minlength=centres)
        sums = np.zeros_like(middle)
        np.add.at(sums, near, points)
        middle = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], middle)
    return middle


def train_codebooks(
    corpus: DataFrame, parts: int = 16, centres: int = 256, vector: str = "embedding", doc_id: str = "doc_id", metric: str = "cosine", rows: int = 16_384, seed: int = 1
) -> list[np.ndarray]:
    """Centres of each of `parts` slices of the vectors, by k-means on at most `rows` rows, drawn by a hash of their id. At most 256 centres, so a code is a byte a slice.

    Only the centres depend on the drawn rows; every row is encoded.
    """
    if not 0 < centres <= 256:
        raise ValueError("a code is one byte: 1 to 256 centres")
    some = _keyed(corpus, doc_id, vector, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows).toPandas()
    points = _matrix(some["_vec"])
    if metric == "cosine":
        points = _units(points) if len(points) else points
    rng = np.random.default_rng(seed)
    return [_lloyd(part, centres, 12, rng) for part in np.array_split(points, min(parts, max(points.shape[1], 1)), axis=1)]


def encode(corpus: DataFrame, codebooks: Sequence[np.ndarray], vector: str = "embedding", doc_id: str = "doc_id", metric: str = "cosine", out: str = "code") -> DataFrame:
    """Each vector as the numbers of its slices' nearest centres, a byte each: (doc_id, code). Rows without a vector drop out."""
    books = list(codebooks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["_vec"])
            if not len(x):
                continue
            x = _units(x) if metric == "cosine" else x
            cuts = np.cumsum([0, *(b.shape[1] for b in books)])
            near = [((b * b).sum(axis=1)[None, :] - 2 * (x[:, i:j] @ b.T)).argmin(axis=1) for b, i, j in zip(books, cuts, cuts[1:])]
            codes = np.stack(near, axis=1).astype(np.uint8)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), out: [c.tobytes() for c in codes]})

    rows = _keyed(corpus, doc_id, vector, "doc_id")
    return rows.mapInPandas(run, T.StructType([rows.schema["doc_id"], T.StructField(out, T.BinaryType())]))


def _coded(codebooks: Sequence[np.ndarray]):
    """Scores of codes: a table of products (or distances) per query and slice, one look-up a byte."""

    class _Coded:
        slack = 0.0

        def __init__(self, queries: pd.DataFrame, metric: str):
            q = _matrix(queries["_vec"])
            q = _units(q) if metric == "cosine" else q
            cuts = np.cumsum([0, *(b.shape[1] for b in codebooks)])
            self.tables = []
            for b, i, j in zip(codebooks, cuts, cuts[1:]):
                dots = q[:, i:j] @ b.T
                table = 2 * dots - (b * b).sum(axis=1)[None, :] - (q[:, i:j] ** 2).sum(axis=1)[:, None] if metric == "l2" else dots
                self.tables.append(np.ascontiguousarray(table.T))

        def prepare(self, docs: pd.DataFrame) -> np.ndarray:
            return np.frombuffer(b"".join(docs["_vec"]), np.uint8).reshape(len(docs), len(self.tables))

        def rough(self, codes: np.ndarray, start: int, stop: int) -> np.ndarray:
            total = np.zeros((len(codes), stop - start))
            for part, table in enumerate(self.tables):
                total += np.take(table[:, start:stop], codes[:, part], axis=0)
            return np.ascontiguousarray(total.T)

        def exact(self, codes, owner, column, rough: np.ndarray) -> np.ndarray:
            return rough

    return _Coded


def coded_knn(
    queries: DataFrame,
    coded: DataFrame,
    corpus: DataFrame,
    codebooks: Sequence[np.ndarray],
    k: int,
    metric: str = "cosine",
    rerank: int = 20,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    exclude_self: bool = False,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Approximate k nearest documents: codes (see `encode`) name the `k * rerank` most promising ones of a query, whose vectors decide.

    Only codes are scanned; vectors are joined to the named documents alone.
    """
    width = F.lit(sum(b.shape[1] for b in codebooks))
    q = _keyed(queries, query_id, query_vector, "query_id")
    codes = coded.select("doc_id", F.col("code").alias("_vec"))
    named = _search(q, codes, k * rerank, metric, _coded(codebooks), exclude_self, width, query_bytes, F.length("_vec")).select("query_id", "doc_id")
    d = _keyed(corpus, doc_id, doc_vector, "doc_id")
    met = named.join(d.withColumnRenamed("_vec", "_d"), "doc_id").join(q.withColumnRenamed("_vec", "_q"), "query_id")

    def dot(a: str, b: str) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    if metric == "l2":
        gaps = F.zip_with("_q", "_d", lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
        score = -F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)
    else:
        score = dot("_q", "_d")
        if metric == "cosine":
            score = F.coalesce(F.try_divide(score, F.sqrt(dot("_q", "_q")) * F.sqrt(dot("_d", "_d"))), F.lit(0.0))
    found = _ranked(met.select("query_id", "doc_id", F.round(score, 9).alias("score")), k)
    shown = F.sqrt(-F.col("score")) if metric == "l2" else F.col("score")
    return found.select("query_id", "rank", "doc_id", shown.alias("score"))


# --- rank features ----------------------------------------------------------------------------------------


def saturation(value: str, pivot: float) -> Column:
    return F.try_divide(F.col(value), F.col(value) + F.lit(pivot))


def log_feature(value: str, scaling: float = 1.0) -> Column:
    return F.log(F.lit(scaling) + F.col(value))


def sigmoid(value: str, pivot: float, exponent: float) -> Column:
    powered = F.pow(F.col(value), F.lit(exponent))
    return F.try_divide(powered, powered + F.pow(F.lit(pivot), F.lit(exponent)))
