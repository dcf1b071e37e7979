"""Nearest neighbours by inner product: inverted lists of coarse centroids, product-quantized residuals,
asymmetric distance tables and exact reranking.

Equal vectors are one entry of the index with their smallest ids, so a very common vector costs no more than
any other. Neighbouring lists form regions, and large regions are split into blocks of entries and of queries. A query
goes once to each block of a region that has lists it probes, with the numbers of these lists. Within a block, tables of
inner products between a query's parts and the codebooks estimate all entries of the probed lists; those that may be among
the block's best, allowing for one deviation of the quantization error on either side, are scored exactly, in double
precision, on the original vectors. A block returns no more than the rows that a result can hold.

How many lists to probe is measured: a bounded sample of queries is compared with brute force over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mark, materialize, release

SEED = 11


@dataclass
class Index:
    """Centroids of the lists, the region of each, codebooks of residuals (one for each part), and the number of lists to probe."""

    centroids: np.ndarray
    regions: np.ndarray
    codebooks: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.codebooks)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([_nearest(x[i : i + 4096], self.centroids) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)

    def codes(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Code of each part of each residual."""
        rest, out = _padded(x - self.centroids[cells], self.parts), []
        for m, book in enumerate(self.codebooks):
            out.append(_nearest(rest[:, m], book))
        return np.stack(out, axis=1).astype(np.uint8)

    def errors(self, x: np.ndarray, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Length of what the codes leave out of each vector."""
        rest = _padded(x - self.centroids[cells], self.parts)
        kept = np.stack([book[codes[:, m]] for m, book in enumerate(self.codebooks)], axis=1)
        return np.sqrt(((rest - kept) ** 2).sum(axis=(1, 2)))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of each query's parts with the codebooks."""
        return np.einsum("qmd,mkd->qmk", _padded(q, self.parts), self.codebooks)

    def probed(self, q: np.ndarray) -> np.ndarray:
        """Lists of each query, best centroid first."""
        return np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")[:, : self.probes]

    def estimates(self, q: np.ndarray, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Inner products of queries with coded entries."""
        used, at = np.unique(cells, return_inverse=True)
        out = (q @ self.centroids[used].T)[:, at]
        tables = self.tables(q)
        for m in range(self.parts):
            out += tables[:, m][:, codes[:, m]]
        return out


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centers.T - 0.5 * (centers * centers).sum(axis=1), axis=1)


def _padded(x: np.ndarray, parts: int) -> np.ndarray:
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centers = x[np.sort(rng.permutation(len(x))[:k])].copy()
    for _ in range(rounds):
        owner = np.concatenate([_nearest(x[i : i + 8192], centers) for i in range(0, len(x), 8192)])
        sums = np.zeros_like(centers, dtype=np.float64)
        np.add.at(sums, owner, x)
        counts = np.bincount(owner, minlength=len(centers))
        filled = counts > 0
        centers[filled] = sums[filled] / counts[filled, None]
    return centers


def fit(sample: np.ndarray, lists: int, regions: int, parts: int = 16, codes: int = 256) -> Index:
    """Index of a sample of distinct vectors; regions group lists whose centroids are near each other."""
    centroids = _kmeans(sample, min(lists, len(sample)))
    rest = _padded(sample - centroids[_nearest(sample, centroids)], min(parts, sample.shape[1]))
    books = [_kmeans(np.ascontiguousarray(rest[:, m]), min(codes, len(sample)), 6) for m in range(rest.shape[1])]
    return Index(centroids, _nearest(centroids, _kmeans(centroids, min(regions, len(centroids)))), np.stack(books))


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float32).reshape(len(column), -1)


def usable(df: DataFrame, id_col: str, vector_col: str, length: int | None = None) -> DataFrame:
    """(id, vector, k1, k2) of rows that take part; repeated (id, vector) rows count once.

    Left out: null ids; vectors null, empty, all zero or with a null or non-finite component; vectors of another
    length, as they have no inner product with the rest (by default the most common one counts, of ties the larger).
    """
    v, lit = F.col("vector"), F.lit(float("inf")).cast("float")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vector")).where("id is not null and vector is not null")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == lit)) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    if length is None:
        size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
        length = size.n if size else 0
    rows = rows.where(F.size("vector") == length)
    return rows.select("id", "vector", F.xxhash64("vector").alias("k1"), F.xxhash64("vector", F.lit(1)).alias("k2"))


def packed(rows: DataFrame, *names: str) -> DataFrame:
    """The named columns of rows and vec, the bytes of the vector."""
    schema = T.StructType([*(rows.schema[n] for n in names), T.StructField("vec", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            data = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).astype("<f4").tobytes()
            ends = np.arange(n + 1, dtype=np.int32) * (len(data) // n if n else 0)
            vec = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], vec], names=schema.names)

    return rows.select(*names, "vector").mapInArrow(run, schema)


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors (rep, ids, vector) with their `keep` smallest ids, which is all that a search can return.

    The smallest ids of repeated vectors are found in steps with fewer salts each, so that no task gathers a large group.
    """
    counts = materialize(rows.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("id").alias("rep")), "ann-counts")
    best = rows.join(counts.where("n > 1").select("k1", "k2"), ["k1", "k2"], "left_semi").select("k1", "k2", "id")
    best = best.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(4096)))
    for salts in (4096, 64, 8, 1):
        best = best.withColumn("salt", F.col("salt") % salts)
        window = Window.partitionBy("k1", "k2", "salt").orderBy("id")
        best = best.dropDuplicates(["k1", "k2", "salt", "id"]) if salts == 4096 else best
        best = best.withColumn("place", F.row_number().over(window)).where(F.col("place") <= keep).drop("place")
    lists = best.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("rep", F.col("ids")[0])
    lists = lists.unionByName(counts.where("n = 1").select("k1", "k2", F.array("rep").alias("ids"), "rep"))
    lists = materialize(lists, "ann-lists")
    found = rows.select(F.col("id").alias("rep"), "k1", "k2", "vector").join(lists, ["k1", "k2", "rep"])
    return found.dropDuplicates(["k1", "k2"]).select("rep", "ids", "vector")


def best_of(index: Index, q: np.ndarray, x: np.ndarray, cells: np.ndarray, codes: np.ndarray, errors: np.ndarray, reps: np.ndarray, mine: np.ndarray, keep: int, deviations: float):
    """(query, entry, score) of each query's best entries of the lists that it probes, at most `keep` each.

    mine tells for each query and list whether it probes the list. Ties go to the smaller rep.
    """
    near = index.estimates(q, cells, codes)
    near[~mine[:, cells]] = -np.inf
    margin = deviations / np.sqrt(q.shape[1]) * np.sqrt((q * q).sum(axis=1))[:, None] * errors
    floor = np.partition(near - margin, -keep, axis=1)[:, -keep] if near.shape[1] > keep else np.full(len(q), -np.inf)
    row, col = np.nonzero((near + margin >= floor[:, None]) & (near > -np.inf))
    if len(row) * 16 > near.size:  # a product of the two matrices is cheaper than one by one
        exact = (q.astype(np.float64) @ x.T.astype(np.float64))[row, col]
    else:
        exact = np.einsum("nd,nd->n", q[row].astype(np.float64), x[col].astype(np.float64))
    order = np.lexsort((reps[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    good = np.arange(len(row)) - np.searchsorted(row, row) < keep
    return row[good], col[good], exact[good]


def search(
    base: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    target: float = 0.96,
    max_lists: int = 16_384,
    max_block: int = 65_536,
    blocks: int = 64,
    block_queries: int = 1024,
    deviations: float = 1.0,
    sample_rows: int = 8192,
    trial_queries: int = 64,
) -> DataFrame:
    """The k nearest rows of base for each query, by largest inner product; ties go to the smaller id.

    A query's own id is no candidate. Rows that can't take part (see :func:`usable`) are neither candidates
    nor queries; queries need the base's length. There are as many lists as the root of the number of distinct vectors, at
    most max_lists. The index is fitted on at most max(sample_rows, 32 * lists) distinct vectors, the first by
    a hash of the id; every row is indexed. `target` is the share of trial queries' true neighbours that the
    probed lists must hold; at most trial_queries queries are tried against all rows. Probes are added for queries whose
    lists hold too few rows. Blocks have about a `blocks`-th of the entries, at least 256 and at most max_block.

    Returns query_id, rank int, vec_id, score double. Empty tables give an empty result.
    """
    spark, keep, before = base.sparkSession, k + 1, mark()
    rows = usable(base, id_col, vector_col)
    index_rows = materialize(packed(entries(rows, keep), "rep", "ids"), "ann-entries")
    total = index_rows.count()
    shape = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], shape)
    lists = max(1, min(max_lists, isqrt(total)))
    block_rows = max(256, min(max_block, total // blocks))
    picked = index_rows.orderBy(F.xxhash64(F.lit(SEED), "rep"), "rep").limit(max(sample_rows, 32 * lists)).select("vec").toPandas()
    sample = _vectors(picked["vec"])
    index = fit(sample, lists, max(1, total // block_rows))

    asked = usable(queries, id_col, vector_col, sample.shape[1])
    ask = materialize(asked.select(F.col("id").alias("query_id"), "k1", "k2").distinct(), "ann-asked")
    first = ask.groupBy("k1", "k2").agg(F.min("query_id").alias("q"))
    one = asked.select(F.col("id").alias("q"), "k1", "k2", "vector").join(first, ["k1", "k2", "q"]).dropDuplicates(["k1", "k2"])
    distinct = materialize(packed(one, "q", "k1", "k2"), "ann-queries")
    trial = distinct.orderBy(F.xxhash64("q"), "q").limit(trial_queries).toPandas()
    if not len(trial):
        return spark.createDataFrame([], shape)
    index.probes = _probes_needed(index_rows, index, _vectors(trial["vec"]), keep, target)

    stored = materialize(_placed(index_rows, index), "ann-placed")
    per_list = np.zeros(len(index.centroids), dtype=np.int64)
    for r in stored.groupBy("cell").count().collect():  # at most max_lists rows
        per_list[r.cell] = r["count"]
    probe = materialize(_probing(distinct, index, per_list, min(keep, total)), "ann-probes")
    per_region = np.bincount(index.regions, per_list, index.regions.max() + 1).astype(int).tolist()
    per_asked = [0] * len(per_region)
    for r in probe.groupBy("region").count().collect():
        per_asked[r.region] = r["count"]
    parts = lambda counts, most: F.element_at(F.lit([max(1, -(-c // most)) for c in counts]), F.col("region") + 1)
    of_rows, of_queries = parts(per_region, block_rows), parts(per_asked, block_queries)
    left = stored.withColumn("ib", F.pmod(F.xxhash64("rep"), of_rows)).withColumn("qb", F.explode(F.sequence(F.lit(0), of_queries - 1)))
    right = probe.withColumn("qb", F.pmod(F.xxhash64("q"), of_queries)).withColumn("ib", F.explode(F.sequence(F.lit(0), of_rows - 1)))
    keys = [F.col(c).cast("long").alias(c) for c in ("region", "ib", "qb")]
    model = spark.sparkContext.broadcast(index)  # bounded by max_lists

    def met(items: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(items) and len(asks):
            own, x = model.value, _vectors(items["vec"])
            codes = np.frombuffer(b"".join(items["code"]), dtype=np.uint8).reshape(len(items), -1)
            cells, reps, errors = items["cell"].to_numpy(), items["rep"].to_numpy(), items["error"].to_numpy()
            step = max(1, (1 << 22) // len(items))
            for at in range(0, len(asks), step):
                part = asks.iloc[at : at + step]
                mine = np.zeros((len(part), len(own.centroids)), dtype=bool)
                for i, probed in enumerate(part["cells"]):
                    mine[i, probed] = True
                row, col, exact = best_of(own, _vectors(part["vec"]), x, cells, codes, errors, reps, mine, keep, deviations)
                out.append((part["q"].to_numpy()[row], reps[col], exact))
        q, rep, score = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"q": q.astype(np.int64), "rep": rep.astype(np.int64), "score": score.astype(np.float64)})

    hits = (
        left.select(*keys, "cell", "rep", "vec", "code", "error").groupBy("region", "ib", "qb")
        .cogroup(right.select(*keys, "q", "cells", "vec").groupBy("region", "ib", "qb"))
        .applyInPandas(met, "q long, rep long, score double")
    )
    # Any k + 1 best ids lie in the k + 1 best entries, as a tied entry's rep is its smallest id.
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))
    best = materialize(hits.withColumn("place", place).where(F.col("place") <= keep).drop("place"), "ann-hits")
    flat = best.join(index_rows.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    best = flat.withColumn("place", place).where(F.col("place") <= keep).groupBy("q").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("found"))
    best = materialize(best, "ann-best")
    named = materialize(ask.join(distinct.select("k1", "k2", "q"), ["k1", "k2"]).select("query_id", "q"), "ann-named")
    release(before, best, named)
    others = F.slice(F.filter(F.array_sort("found"), lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return named.join(best, "q").select("query_id", F.posexplode(others).alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "f.vec_id", "f.score"
    )


def _placed(index_rows: DataFrame, index: Index) -> DataFrame:
    """Entries with their region, list, codes and quantization error."""
    model = index_rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model.value
        for b in batches:
            x = _vectors(b["vec"])
            cells = own.cells(x)
            codes = own.codes(x, cells)
            yield pd.DataFrame({"region": own.regions[cells], "cell": cells, "rep": b["rep"], "vec": b["vec"], "code": [c.tobytes() for c in codes], "error": own.errors(x, cells, codes)})

    return index_rows.select("rep", "vec").mapInPandas(run, "region int, cell int, rep long, vec binary, code binary, error double")


def _probing(distinct: DataFrame, index: Index, per_list: np.ndarray, least: int) -> DataFrame:
    """One row for each query and region, with the lists that the query probes there: its nearest, until they hold enough rows."""
    model = distinct.sparkSession.sparkContext.broadcast((index, per_list))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, sizes = model.value
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                order = np.argsort(-(_vectors(part["vec"]) @ own.centroids.T), axis=1, kind="stable")
                enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
                rows = []
                for q, vec, lists, n in zip(part["q"], part["vec"], order, np.maximum(own.probes, enough)):
                    lists = lists[:n]
                    by = np.argsort(own.regions[lists], kind="stable")
                    found, starts = np.unique(own.regions[lists][by], return_index=True)
                    rows += [(int(r), int(q), cells.tolist(), vec) for r, cells in zip(found, np.split(lists[by], starts[1:]))]
                yield pd.DataFrame(rows, columns=["region", "q", "cells", "vec"])

    return distinct.select("q", "vec").mapInPandas(run, "region int, q long, cells array<int>, vec binary")


def _probes_needed(index_rows: DataFrame, index: Index, q: np.ndarray, keep: int, target: float) -> int:
    """Smallest number of probed lists that hold the target share of the trial queries' true neighbours."""
    shipped = index_rows.sparkSession.sparkContext.broadcast((index, q))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, asked = shipped.value
        best = np.full((len(asked), 0), 0.0)
        where = np.zeros((len(asked), 0), dtype=np.int64)
        for b in batches:
            x = _vectors(b["vec"])
            best = np.concatenate([best, asked.astype(np.float64) @ x.T.astype(np.float64)], axis=1)
            where = np.concatenate([where, np.tile(own.cells(x), (len(asked), 1))], axis=1)
            n = min(keep, best.shape[1])
            top = np.argpartition(-best, n - 1, axis=1)[:, :n]
            best, where = np.take_along_axis(best, top, axis=1), np.take_along_axis(where, top, axis=1)
        yield pd.DataFrame({"t": np.repeat(np.arange(len(asked)), best.shape[1]), "cell": where.ravel(), "score": best.ravel()})

    found = index_rows.select("vec").mapInPandas(exact, "t int, cell int, score double")
    place = F.row_number().over(Window.partitionBy("t").orderBy(F.desc("score")))
    rows = found.withColumn("place", place).where(F.col("place") <= keep).select("t", "cell").collect()  # trial_queries * keep rows
    order = np.argsort(-(q @ index.centroids.T), axis=1, kind="stable")
    ranks = np.argsort(order, axis=1)
    depth = np.sort([ranks[r.t, r.cell] for r in rows])
    return int(depth[min(len(depth) - 1, int(np.ceil(target * len(depth))) - 1)]) + 1
