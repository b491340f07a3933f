"""Approximate nearest neighbours for inner products by score-aware (anisotropic) quantisation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.llm.durable import settle, small_batches

#: Vectors that the codebooks are fitted on, at most: those of the least hash.
TRAIN_ROWS = 20_000
#: Dimensions of a subspace, codewords of it (four bits), rounds of fitting, sweeps of encoding.
SUB, WORDS, ROUNDS, SWEEPS = 2, 16, 8, 2
#: Share of the norm from which an inner product matters; it sets how much parallel error costs.
SCORE_SHARE = 0.2
NEIGHBOURS = 20
#: Distinct vectors of a chunk that are reranked exactly for each query before bounds decide which others can still be among the nearest.
RERANK = 256
#: Vectors scanned at once, queries scanned at once, queries whose bounds are held at once.
CHUNK, QUERY_BLOCK, BOUND_BLOCK = 8192, 256, 32
#: Rounding errors of scanned (single) and of multiplied (double precision) scores, as shares of the product of the norms, at most.
SCAN_ERROR, PRODUCT_ERROR = 1e-5, 1e-12
#: Queries that are sent to the tasks at once, at most.
ROUND_QUERIES = 50_000


class Codebooks:
    """Product codebooks of SUB dimensions each, for the loss |r|^2 + (eta - 1) (r . x / |x|)^2 of the residual r."""

    def __init__(self, x: np.ndarray) -> None:
        self.dims = x.shape[1]
        self.width = -(-self.dims // SUB) * SUB
        x = self.pad(x)
        self.parts = self.width // SUB
        share = SCORE_SHARE**2
        self.eta = max(1.0, (self.dims - 1) * share / (1 - share))
        rng = np.random.default_rng(7)
        pick = rng.choice(len(x), WORDS, replace=len(x) < WORDS)
        self.words = np.stack([x[pick, m * SUB : (m + 1) * SUB] for m in range(self.parts)])
        for _ in range(ROUNDS):
            self._refit(x, self.encode(x))

    def pad(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def _unit(self, x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes by coordinate descent: each subspace in turn takes the codeword of the least loss, given the others."""
        u = self._unit(x)
        codes = np.zeros((len(x), self.parts), np.uint8)
        along = np.zeros((len(x), self.parts))
        for sweep in range(SWEEPS):
            for m in range(self.parts):
                s = slice(m * SUB, (m + 1) * SUB)
                rest = along.sum(axis=1) - along[:, m]
                r = x[:, None, s] - self.words[m][None]
                par = np.einsum("nws,ns->nw", r, u[:, s])
                loss = (r * r).sum(axis=2) + (self.eta - 1) * ((rest[:, None] + par) ** 2 if sweep else par**2)
                codes[:, m] = loss.argmin(axis=1)
                along[:, m] = par[np.arange(len(x)), codes[:, m]]
        return codes

    def _refit(self, x: np.ndarray, codes: np.ndarray) -> None:
        """Least-squares codewords of one subspace after the other, given all codes."""
        u = self._unit(x)
        e = self.eta - 1
        along = np.stack([((x[:, m * SUB : (m + 1) * SUB] - self.words[m][codes[:, m]]) * u[:, m * SUB : (m + 1) * SUB]).sum(axis=1) for m in range(self.parts)], axis=1)
        for m in range(self.parts):
            s = slice(m * SUB, (m + 1) * SUB)
            um, xm = u[:, s], x[:, s]
            rest = along.sum(axis=1) - along[:, m]
            left = np.zeros((WORDS, SUB, SUB))
            right = np.zeros((WORDS, SUB))
            np.add.at(left, codes[:, m], np.eye(SUB) + e * um[:, :, None] * um[:, None, :])
            np.add.at(right, codes[:, m], xm + e * um * (rest + (xm * um).sum(axis=1))[:, None])
            used = np.bincount(codes[:, m], minlength=WORDS) > 0
            self.words[m][used] = np.linalg.solve(left[used], right[used][:, :, None])[:, :, 0]
            along[:, m] = ((xm - self.words[m][codes[:, m]]) * um).sum(axis=1)

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """Two codes in a byte."""
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return codes[:, ::2] | (codes[:, 1::2] << 4)

    def unpacked(self, packed: np.ndarray) -> np.ndarray:
        """The vectors that packed codes stand for."""
        codes = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(packed), -1)
        return np.concatenate([self.words[m][codes[:, m]] for m in range(self.parts)], axis=1)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(bytes, 256, queries): the inner product of each query with what each byte of a code stands for."""
        q = self.pad(q)
        single = np.stack([self.words[m] @ q[:, m * SUB : (m + 1) * SUB].T for m in range(self.parts)])
        if self.parts % 2:
            single = np.concatenate([single, np.zeros((1, *single.shape[1:]))])
        low, high = single[::2], single[1::2]
        return (high[:, :, None, :] + low[:, None, :, :]).reshape(len(low), 256, -1).astype(np.float32)


def _valid(vector: str) -> F.Column:
    """The vector as doubles; null if it, or a component, is null or not finite, or if all are zero."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    return F.when(~bad & F.exists(x, lambda v: v != 0), x)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def _encode(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), CHUNK):
                part = batch.slice(i, CHUNK)
                codes = books.packed(books.encode(books.pad(_matrix(part["x"], books.dims))))
                yield pa.record_batch([part["vec_id"], part["x"], pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "x", "code"])

    return run


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, in order."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= cut)
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the dimensions."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += q[d] * x[:, d]
    return out


class Bounds:
    """Which vectors can have a given inner product with a query, by their scanned scores and the residuals r of their codes.

    q . x = q . (x - r) + q . r, where |q . r| <= |q| |r|. Where q . x >= t > 0, the
    angle between q and x is bounded as well: with r = p x + o, o orthogonal to x,
    (1 - p) q . x = q . (x - r) + q . o, and |q . o| <= |o| sqrt(|q|^2 - (t / |x|)^2).
    """

    def __init__(self, x: np.ndarray, coded: np.ndarray) -> None:
        r = x - coded
        self.norm = np.linalg.norm(x, axis=1)
        self.residual = np.linalg.norm(r, axis=1)
        self.along = np.einsum("nd,nd->n", r, x / self.norm[:, None]) / self.norm
        self.across = np.linalg.norm(r - self.along[:, None] * x, axis=1)
        self.error = SCAN_ERROR * (2 * self.norm + self.residual)

    def reach(self, scan: np.ndarray, q_norm: np.ndarray, least: np.ndarray) -> np.ndarray:
        """(queries, vectors): whether the inner product can be at least the query's least."""
        q, t = q_norm[:, None], least[:, None]
        high = scan + q * self.error
        out = high + q * self.residual < t
        t0 = np.maximum(t, 0.0)
        out |= (t0 > 0) & (self.along < 1) & (high < (1 - self.along) * t0 - self.across * np.sqrt(np.maximum(q * q - (t0 / self.norm) ** 2, 0.0)))
        return ~(out & np.isfinite(scan))


def _search(books: Codebooks, ids: np.ndarray, queries: np.ndarray, k: int, rerank: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
        for batch in batches:
            for i in range(0, len(batch), CHUNK):
                part = batch.slice(i, CHUNK)
                vec, x = part["vec_id"].to_numpy(), _matrix(part["x"], books.dims)
                codes = np.frombuffer(b"".join(part["code"].to_pylist()), np.uint8).reshape(len(part), -1)
                # Equal vectors are scored once; the k + 1 least ids of each stand for the rest.
                order = np.argsort(vec, kind="stable")
                vec, x, codes = vec[order], np.ascontiguousarray(x[order] + 0.0), codes[order]
                _, first, same = np.unique(x.view(f"V{8 * books.dims}").ravel(), return_index=True, return_inverse=True)
                by = np.argsort(same, kind="stable")
                at = np.searchsorted(same[by], np.arange(len(first) + 1))
                block = x[first]
                bounds = Bounds(books.pad(block), books.unpacked(codes[first]))

                def offer(n: int, near: np.ndarray, exact: np.ndarray, vec=vec, first=first, by=by, at=at) -> None:
                    """Merge distinct vectors with their exact scores into query n's nearest."""
                    pick = best(exact, first[near], k + 1)
                    places = np.concatenate([by[at[c] : at[c + 1]][: k + 1] for c in near[pick]])
                    values = np.repeat(exact[pick], np.minimum(k + 1, at[near[pick] + 1] - at[near[pick]]))
                    own = vec[places] != ids[n]
                    s, v = np.concatenate([top[n][0], values[own]]), np.concatenate([top[n][1], vec[places][own]])
                    take = best(s, v, k)
                    top[n] = (s[take], v[take])

                for b in range(0, len(ids), QUERY_BLOCK):
                    tables = books.tables(queries[b : b + QUERY_BLOCK])
                    scan = np.zeros((len(first), tables.shape[2]), np.float32)
                    for m in range(len(tables)):
                        scan += tables[m][codes[first, m]]
                    scan = np.ascontiguousarray(scan.T)
                    keep = min(rerank, len(first))
                    near = np.argpartition(-scan, keep - 1, axis=1)[:, :keep] if keep < len(first) else np.broadcast_to(np.arange(len(first)), (len(scan), len(first)))
                    exact = np.zeros(near.shape)
                    q = queries[b : b + QUERY_BLOCK]
                    for d in range(books.dims):
                        exact += q[:, d : d + 1] * block[near, d]
                    for n in range(len(near)):
                        offer(b + n, near[n], exact[n])
                    if keep == len(first):
                        continue
                    # All others that can still be among the nearest are scored as well.
                    norm = np.linalg.norm(q, axis=1)
                    for c in range(0, len(near), BOUND_BLOCK):
                        some = slice(c, c + BOUND_BLOCK)
                        least = np.array([t[0][-1] if len(t[0]) == k else -np.inf for t in top[b : b + QUERY_BLOCK][some]])
                        reach = bounds.reach(scan[some], norm[some], least)
                        np.put_along_axis(reach, near[some], False, axis=1)
                        cols = np.flatnonzero(reach.any(axis=0))
                        if not len(cols):
                            continue
                        score = q[some] @ block[cols].T
                        rest = reach[:, cols] & ~(score + PRODUCT_ERROR * books.dims * norm[some, None] * bounds.norm[cols] < least[:, None])
                        for n in np.flatnonzero(rest.any(axis=1)):
                            more = cols[rest[n]]
                            offer(b + c + n, more, products(q[c + n], block[more]))
        for b in range(0, len(ids), 1024):
            rows = [(np.full(len(s), ids[b + n]), v, s) for n, (s, v) in enumerate(top[b : b + 1024])]
            yield pa.record_batch([np.concatenate([r[c] for r in rows]) for c in range(3)], names=["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of vectors for each row of queries, by inner product.

    Codebooks are fitted on a bounded sample, every vector is indexed by its four-bit
    codes, each task scans the codes of its vectors for all queries of a round and
    reranks the best by exact products, and then every other vector whose code,
    by its residual, leaves it a chance to be among the k nearest, so the k nearest
    are exact; tasks' results are merged by query. The
    queries are a stated set; rounds of ROUND_QUERIES keep what is sent bounded.

    Vectors that are null, zero or hold a null or non-finite component, vectors of
    another length than the most common one, and rows without an id take no part. A
    query's own id is no candidate. Ties go to smaller ids, and rows of one id count
    each. With fewer candidates than k all are returned; an empty table gives none.
    """
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), _valid(vector_col).alias("x")).where("vec_id is not null and x is not null")
    base = pick(small_batches(vectors))
    sizes = base.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    dims = int(sizes["dims"])
    base = base.where(F.size("x") == dims)
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRAIN_ROWS).select("x").toArrow()
    books = Codebooks(_matrix(sample["x"].combine_chunks(), dims))
    coded = settle(base.mapInArrow(_encode(books), "vec_id long, x array<double>, code binary"))
    asked = pick(queries).where(F.size("x") == dims)
    rounds = -(-asked.count() // ROUND_QUERIES)
    found = None
    for r in range(rounds):
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r).orderBy("vec_id").toArrow()
        if not block.num_rows:
            continue
        part = coded.mapInArrow(_search(books, block["vec_id"].to_numpy(), _matrix(block["x"].combine_chunks(), dims), k, rerank), "query_id long, vec_id long, score double")
        found = part if found is None else found.union(part)
    if found is None:
        return empty
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
