"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into parts of equal size with few cut edges (recursive
bisection, each refined by swaps); a small classifier learns which parts hold a vector's neighbours.  Every
vector of the table is entered in its most probable part; a query goes to its several most probable parts and is
ranked there against all members, by the inner product in double precision.

Equal vectors are one entry, with as many of their smallest ids as an answer could hold (k + 1): a vector that a
third of all rows share is one entry and one query.  Parts larger than ``block`` entries are searched block by
block, in different tasks; so are large batches of queries.  What goes through the driver is the sample, the
classifier and one count per part.

The sample has ``sample_size`` distinct vectors (those of smallest hash), about ``sqrt(n) / 8`` parts are made
(a power of two, of 16 sample vectors or more each), and the number of parts that a query visits is the smallest
that finds ``target_recall`` of those neighbours of held-out sample vectors that are held out too.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; nor do those
of another length than the commonest (the smallest such, on a tie); an id's repeated rows with equal vectors count
once; an id's own rows never answer its query; ties go to the smaller id; fewer candidates than k give fewer rows;
an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import stage


@dataclass(frozen=True)
class Fit:
    sample_size: int = 8192
    graph_neighbours: int = 10
    hidden: int = 128
    epochs: int = 12
    held_out: float = 0.2
    target_recall: float = 0.94
    block: int = 4096
    seed: int = 7


# ---- the fit, on the sample


def nearest(queries: np.ndarray, vectors: np.ndarray, k: int, same: bool = False) -> np.ndarray:
    """Row numbers of the k largest inner products; ``same``: a row is not its own neighbour."""
    out = np.empty((len(queries), k), np.int64)
    for a in range(0, len(queries), 1024):
        s = queries[a:a + 1024] @ vectors.T
        if same:
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(n: int, u: np.ndarray, v: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two sides of equal size (True: the second) with few of the edges u - v between them."""
    degree = np.maximum(np.bincount(u, minlength=n), 1)
    x = rng.standard_normal(n)
    for _ in range(40):                                  # towards the slowest mode of the walk, but the constant one
        x -= (x * degree).sum() / degree.sum()
        x = 0.5 * x + 0.5 * np.bincount(u, weights=x[v], minlength=n) / degree
        x /= max(np.abs(x).max(), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2:]] = True
    cut = int((side[u] != side[v]).sum())
    step = max(1, n // 50)
    for _ in range(40):                                  # swap the vertices that gain most, as long as it pays
        gain = np.bincount(u, weights=np.where(side[u] != side[v], 1.0, -1.0), minlength=n)
        ones, zeros = np.nonzero(side)[0], np.nonzero(~side)[0]
        ones = ones[np.argsort(-gain[ones], kind="stable")][:step]
        zeros = zeros[np.argsort(-gain[zeros], kind="stable")][:step]
        good = min(len(ones), len(zeros))
        good = int((gain[ones[:good]] + gain[zeros[:good]] > 0).sum())
        trial = side.copy()
        trial[ones[:good]], trial[zeros[:good]] = False, True
        now = int((trial[u] != trial[v]).sum())
        if good and now < cut:
            side, cut = trial, now
        elif step > 1:
            step //= 2
        else:
            break
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Parts (a power of two) of equal size, up to one vertex, for the vertices of a neighbour graph."""
    n, k = graph.shape
    u, v = np.repeat(np.arange(n), k), graph.ravel()
    u, v = np.r_[u, v], np.r_[v, u]
    label, rng = np.zeros(n, np.int64), np.random.default_rng(seed)
    for _ in range(parts.bit_length() - 1):
        new = 2 * label
        for part in range(int(label.max()) + 1):
            own = np.nonzero(label == part)[0]
            at = np.full(n, -1)
            at[own] = np.arange(len(own))
            inside = (at[u] >= 0) & (at[v] >= 0)
            new[own] += _bisect(len(own), at[u[inside]], at[v[inside]], rng)
        label = new
    return label


class Router:
    """A network of one hidden layer from a vector to probabilities of parts."""

    def __init__(self, x: np.ndarray, targets: np.ndarray, fit: Fit):
        rng = np.random.default_rng(fit.seed)
        self.scale = 1.0 / max(float(np.sqrt((x * x).mean())), 1e-30)
        d, m = x.shape[1], targets.shape[1]
        x = (x * self.scale).astype(np.float32)
        targets = targets.astype(np.float32)
        self.w = [rng.standard_normal((d, fit.hidden)).astype(np.float32) * np.float32((2 / d) ** 0.5), np.zeros(fit.hidden, np.float32),
                  rng.standard_normal((fit.hidden, m)).astype(np.float32) * np.float32((1 / fit.hidden) ** 0.5), np.zeros(m, np.float32)]
        first, second, t = [0 * w for w in self.w], [0 * w for w in self.w], 0
        for _ in range(fit.epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                b = order[a:a + 256]
                hidden = np.maximum(x[b] @ self.w[0] + self.w[1], 0)
                out = self._softmax(hidden @ self.w[2] + self.w[3])
                wrong = (out - targets[b]) / len(b)
                back = (wrong @ self.w[2].T) * (hidden > 0)
                t += 1
                for i, g in enumerate((x[b].T @ back, back.sum(0), hidden.T @ wrong, wrong.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - np.float32(0.004) * (first[i] / (1 - 0.9 ** t)) / (
                        np.sqrt(second[i] / (1 - 0.999 ** t)) + np.float32(1e-8))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n most probable parts of each vector, best first."""
        x = (x * self.scale).astype(np.float32)
        z = np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        return np.argsort(-z, axis=1, kind="stable")[:, :n]


def fit_router(sample: np.ndarray, parts: int, k: int, fit: Fit) -> tuple[Router | None, int, int]:
    """The router, its number of parts and how many of them a query should visit."""
    parts = min(parts, 1 << max(0, int(len(sample) * (1 - fit.held_out)) // 16).bit_length() - 1 if len(sample) >= 36 else 1)
    if parts <= 1:
        return None, 1, 1
    rng = np.random.default_rng(fit.seed)
    order = rng.permutation(len(sample))
    held = int(len(sample) * fit.held_out)
    train, test = sample[order[held:]], sample[order[:held]]
    graph = nearest(train, train, min(fit.graph_neighbours, len(train) - 1), same=True)
    label = balanced_parts(graph, parts, fit.seed)
    targets = np.zeros((len(train), parts))
    np.add.at(targets, (np.repeat(np.arange(len(train)), graph.shape[1]), label[graph].ravel()), 1.0)
    targets[np.arange(len(train)), label] += graph.shape[1] / 2
    router = Router(train, targets / targets.sum(axis=1, keepdims=True), fit)
    # neighbours of held-out queries that were not trained on either, as most of a large table isn't
    near = nearest(test, np.concatenate([test, train]), min(k, len(sample) - 1), same=True)
    query, unseen = np.nonzero(near < held)
    if not len(query):
        return router, parts, parts
    place = np.argsort(router.parts(test, parts), axis=1)                      # rank of each part for each query
    home = router.parts(test, 1)[:, 0]
    rank = place[query, home[near[query, unseen]]]
    visits = next(p for p in range(1, parts + 1) if (rank < p).mean() >= fit.target_recall)
    return router, parts, visits


# ---- the table


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, h1, h2, vec)`` of the vectors that take part, as doubles."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vec", lambda x: x != 0)).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))   # -0.0
    sizes = v.groupBy(F.size("vec").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    v = v.where(F.size("vec") == (common["size"] if common else 0))
    return v.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec")).dropDuplicates(
        ["vec_id", "h1", "h2"])


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: ``(h1, h2, vec, ids, asked)`` with its ``keep`` smallest ids."""
    least = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = rows.withColumn("_r", least).where(F.col("_r") <= keep)
    return few.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _routed(rows: DataFrame, router: Router | None, visits: int) -> DataFrame:
    """``(h1, h2, ids, vec as bytes, parts)``: the ``visits`` most probable parts of each vector."""
    schema = T.StructType([rows.schema["h1"], rows.schema["h2"], rows.schema["ids"],
                           T.StructField("vec", T.BinaryType()), T.StructField("parts", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(3))
            parts = router.parts(x, visits) if router else np.zeros((len(x), 1), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array(parts.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=schema.names)

    return rows.select("h1", "h2", "ids", "vec").mapInArrow(run, schema)


def _search(k: int):
    schema = "h1 long, h2 long, first long, score double, ids array<long>"

    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(queries):
            return pd.DataFrame({"h1": [], "h2": [], "first": [], "score": [], "ids": []})
        members = members.assign(first=[x[0] for x in members["ids"]]).sort_values("first", kind="stable")
        x = np.frombuffer(b"".join(members["vec"])).reshape(len(members), -1)
        q = np.frombuffer(b"".join(queries["q_vec"])).reshape(len(queries), -1)
        n, longest = min(k, len(x)), float(np.sqrt((x * x).sum(axis=1).max()))
        rows, cols, scores = [], [], []
        for a in range(0, len(q), 512):
            some = q[a:a + 512]
            near = some @ x.T
            # all that may reach the n-th best: a product's rounding is far below 1e-12 of the lengths' product
            border = -np.partition(-near, n - 1, axis=1)[:, n - 1] - 1e-12 * longest * np.sqrt((some * some).sum(axis=1))
            row, col = np.nonzero(near >= border[:, None])                                 # by smallest id
            exact = np.concatenate([np.einsum("pd,pd->p", x[col[i:i + 65536]], some[row[i:i + 65536]])
                                    for i in range(0, len(row), 65536)])
            order = np.lexsort((col, -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < n
            rows.append(row[best] + a)
            cols.append(col[best])
            scores.append(exact[best])
        row, col = np.concatenate(rows), np.concatenate(cols)
        return pd.DataFrame({
            "h1": queries["q_h1"].to_numpy()[row], "h2": queries["q_h2"].to_numpy()[row],
            "first": members["first"].to_numpy()[col], "score": np.concatenate(scores),
            "ids": members["ids"].to_numpy()[col]})

    return run, schema


def search(vectors: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           fit: Fit = Fit()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row that ``is_query`` (over ``vec_id``) picks."""
    rows = stage(usable(vectors, id_col, vec_col), "vectors")
    index = stage(entries(rows, k + 1), "entries")
    n = index.count()
    sample = index.select("vec", "h1").orderBy(F.xxhash64("h1", "h2")).limit(fit.sample_size).toPandas()
    x = np.array(sample.sort_values("h1")["vec"].tolist(), np.float64).reshape(len(sample), -1 if len(sample) else 0)
    parts = 1 << max(0, int(np.ceil(np.log2(max(1.0, np.sqrt(n) / 8)))))
    router, parts, visits = fit_router(x, parts, k, fit)

    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "h1", "h2")
    members = stage(_routed(index, router, visits).withColumn("part", F.col("parts")[0]), "routed")
    queries = members.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select(
        "h1", "h2", "vec", F.explode("parts").alias("part"))

    # Blocks of members and slices of queries, from one count per part.
    blocks = _pieces(members, parts, fit.block)
    slices = _pieces(queries, parts, fit.block)
    block, piece = F.element_at(blocks, F.col("part") + 1), F.element_at(slices, F.col("part") + 1)
    left = (members.withColumn("block", F.pmod("h2", block).cast("int"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), piece - 1))).select("part", "block", "slice", "ids", "vec"))
    right = (queries.withColumn("slice", F.pmod("h2", piece).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), block - 1)))
             .select(*(F.col(c).alias(f"q_{c}") for c in ("part", "block", "slice", "h1", "h2", "vec"))))
    run, schema = _search(k + 1)
    keys = ["part", "block", "slice"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*(f"q_{c}" for c in keys))).applyInPandas(run, schema)

    best = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "first"))
    found = found.withColumn("_r", best).where(F.col("_r") <= k + 1)
    answers = found.groupBy("h1", "h2").agg(F.flatten(F.collect_list(F.transform(
        "ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("vec_id"))))).alias("all"))
    answers = answers.select("h1", "h2", F.slice(F.sort_array("all"), 1, k + 1).alias("all"))
    own = asked.join(answers, ["h1", "h2"]).withColumn(
        "all", F.slice(F.filter("all", lambda a: a["vec_id"] != F.col("query_id")), 1, k))
    return own.select("query_id", F.posexplode("all").alias("pos", "a")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"),
        (-F.col("a.s")).alias("score"))


def _pieces(rows: DataFrame, parts: int, size: int) -> F.Column:
    """For each part, into how many pieces of about ``size`` its rows go (an array of one number per part)."""
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    return F.array(*(F.lit(max(1, -(-counts.get(p, 0) // size))) for p in range(parts)))
