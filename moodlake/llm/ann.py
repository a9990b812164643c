"""Nearest neighbours by inner product: lists of rotated vectors scanned in column blocks with early abandoning.

A vector gets one more dimension that makes all lengths equal, so that the
largest inner product is the smallest distance, and is rotated at random, so
that the first few dimensions estimate the whole distance. Vectors are dealt
into lists by their nearest centre. A query scans its nearest list first,
which gives it a bound; in its further lists a candidate is dropped as soon as
a hypothesis test on the distance over the columns read so far says that the
whole distance exceeds the bound. What is left is scored in double precision on
the original vectors, in one fixed order of addition, so equal vectors tie.

Equal vectors are one row of the index with their ``k + 1`` smallest ids: no
other copy can be among the nearest k. Lists are cut into blocks and their
queries likewise, so a task holds a bounded part of a list however large it is.

Centres are fitted on at most ``SAMPLE`` vectors, and the share of lists to
scan is the smallest that finds ``TARGET`` of the true neighbours of
``TRIALS`` of these within the sample; every vector is indexed.

Defined results: rows with a NULL id, and vectors that are NULL, zero, of
another length than most, or with a NULL or non-finite component, take no part;
rows repeated with the same id and vector count once; fewer candidates than
``k`` are all returned (as far as found); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import scratch_table

K = 20
SAMPLE = 20_000
TRIALS = 256
TARGET = 0.95
MOST_LISTS = 4096
# Lists per square root of the number of vectors: a scan of a short list is mostly overhead.
LISTS_PER_ROOT = 0.25
ROUNDS = 8
SEED = 7
# Columns read before each test, and the strictness of the test.
COLUMNS = 16
STRICT = 2.1
# Index rows and queries that meet in one task.
INDEX_BLOCK, QUERY_BLOCK = 8192, 1024
CHUNK = 512


class Space:
    """Extra dimension, rotation, centres and the number of lists to scan."""

    def __init__(self, sample: np.ndarray, n_rows: int, longest: float, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.longest, dim = longest, sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        points = self.place(sample)
        lists = max(1, min(MOST_LISTS, int(np.sqrt(n_rows) * LISTS_PER_ROOT), len(sample)))
        centres = points[rng.choice(len(points), lists, replace=False)]
        for _ in range(ROUNDS):
            near = self._nearest(points, centres, 1)[:, 0]
            size = np.bincount(near, minlength=lists)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        self.centres = centres
        self.probes = self._probes(sample, points, rng)

    def place(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.zeros(len(vectors)) if query else np.sqrt(rest)]) @ self.rotation

    @staticmethod
    def _nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        out = [np.empty((0, n), np.int64)]
        for i in range(0, len(points), 1024):
            gap = (centres**2).sum(axis=1) - 2 * points[i:i + 1024] @ centres.T
            out.append(np.argsort(gap, axis=1, kind="stable")[:, :n])
        return np.concatenate(out)

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        return self._nearest(self.place(vectors), self.centres, 1)[:, 0]

    def scanned(self, vectors: np.ndarray) -> np.ndarray:
        return self._nearest(self.place(vectors, True), self.centres, self.probes)

    def _probes(self, sample: np.ndarray, points: np.ndarray, rng: np.random.Generator) -> int:
        tried = rng.choice(len(sample), min(TRIALS, len(sample)), replace=False)
        own = self._nearest(points, self.centres, 1)[:, 0]
        order = self._nearest(self.place(sample[tried], True), self.centres, len(self.centres))
        best = np.argsort(-(sample[tried] @ sample.T), axis=1, kind="stable")[:, :K + 1]
        place = np.argsort(order, axis=1)
        needed = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))))]) + 1


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components."""
    total = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        total += vectors[:, j] * queries[..., j]
    return total


def _scan(vectors: np.ndarray, placed: np.ndarray, query: np.ndarray, aimed: np.ndarray, bound: float, longest: float, k: int) -> np.ndarray:
    """The best k rows (more, if scores tie) that no test drops, in chunks, with a bound that tightens."""
    rows, scores = np.empty(0, np.int64), np.empty(0)
    dim, base = placed.shape[1], longest**2 + float(query @ query)
    for at in range(0, len(vectors), CHUNK):
        left = np.arange(at, min(at + CHUNK, len(vectors)))
        if bound > -np.inf:
            reach, far = base - 2 * bound, np.zeros(len(left))
            for d in range(0, dim - COLUMNS, COLUMNS):
                far += ((placed[left, d:d + COLUMNS] - aimed[d:d + COLUMNS]) ** 2).sum(axis=1)
                read = d + COLUMNS
                stay = far * (dim / read) <= reach * (1 + STRICT / np.sqrt(read)) ** 2
                left, far = left[stay], far[stay]
                if not len(left):
                    break
        if len(left):
            rows = np.concatenate([rows, left])
            scores = np.concatenate([scores, vectors[left] @ query])
            if len(rows) >= k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= least - abs(least) * 1e-12
                rows, scores, bound = rows[near], scores[near], max(bound, float(least))
    return rows


def search(
    embeddings: DataFrame, is_query: str = "vec_id % 20 = 0", id_col: str = "vec_id", vector: str = "embedding", k: int = K,
    seed: int = SEED,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; ``is_query`` is a SQL condition on the rows."""
    spark = embeddings.sparkSession
    v = F.col("v")
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"), F.expr(is_query).alias("asks"))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & usable)
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("v") == common.dim).withColumn("h", F.xxhash64("v"))
    few = rows.select("h", "v", "id").distinct()
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).filter(f"r <= {k + 1}")
    vectors = few.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    # From here on a vector goes by its number, which the stored table keeps.
    vectors = scratch_table(vectors.select(F.monotonically_increasing_id().alias("num"), "h", "v", "ids"), "vectors")
    asking = rows.filter("asks").select("h", "v", F.col("id").alias("query_id")).distinct()
    asking = scratch_table(asking.join(vectors.select("num", "h", "v"), ["h", "v"]).select("query_id", F.col("num").alias("q")), "asking")

    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    about = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(squares)).alias("longest")).first()
    sample = vectors.orderBy(F.xxhash64(F.lit(seed), "h"), "num").limit(SAMPLE).select("v").toArrow()
    fitted = Space(_matrix(sample["v"]), about.n, about.longest * (1 + 1e-9), seed)
    space = spark.sparkContext.broadcast(vars(fitted))
    kind = vectors.schema["v"].dataType.simpleString()
    index = scratch_table(vectors.select("num", "v").mapInArrow(_dealer(space), f"num bigint, v {kind}, list int"), "lists")
    queries = vectors.select("num", "v").join(asking.select(F.col("q").alias("num")).distinct(), "num", "left_semi").select("num", "v")
    probes = scratch_table(queries.mapInArrow(_prober(space), f"num bigint, v {kind}, list int, turn int"), "probes")

    sizes = index.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    loads = probes.groupBy("list", (F.col("turn") > 0).alias("later")).agg(F.count(F.lit(1)).alias("m"))
    # Both tables have a row per list, of which there are at most MOST_LISTS.
    cells = F.broadcast(sizes.join(loads, "list").select(
        "list", "later", F.ceil(F.col("n") / INDEX_BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("parts")
    ))

    def scan(wanted: DataFrame, later: bool) -> DataFrame:
        cell = cells.filter(F.col("later") == later)
        left = index.join(cell, "list").withColumn("block", F.expr("pmod(hash(num), blocks)")).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        right = wanted.join(cell, "list").withColumn("part", F.expr("pmod(hash(num), parts)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        place = ["list", "block", "part"]
        return left.select(*place, "num", "v").groupBy(*place).cogroup(
            right.select(*place, "num", "v", "bound").groupBy(*place)
        ).applyInArrow(_scanner(space, k + 1), "q bigint, num bigint, score double")

    by_query = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    firsts = vectors.select("num", F.element_at("ids", 1).alias("first"))
    nearest = scan(probes.filter("turn = 0").withColumn("bound", F.lit(None).cast("double")), False)
    nearest = scratch_table(nearest, "nearest_list")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    bounds = nearest.withColumn("r", place).filter(f"r = {k + 1}").select(F.col("q").alias("num"), F.col("score").alias("bound"))
    rest = scan(probes.filter("turn > 0").join(bounds, "num", "left"), True)
    found = nearest.unionByName(rest).join(firsts, "num").withColumn("r", F.row_number().over(by_query)).filter(f"r <= {k + 1}")
    named = found.select("q", "num", "score").join(vectors.select("num", "ids"), "num")
    named = named.select("q", "score", F.explode("ids").alias("vec_id"))
    near = named.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(f"r <= {k + 1}")
    answer = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asking.join(answer, "q").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )


def _space(shared) -> Space:
    """The space from the plain values that were broadcast."""
    space = Space.__new__(Space)
    space.__dict__.update(shared.value)
    return space


def _dealer(space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                lists = _space(space).lists(_matrix(batch.column(1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=["num", "v", "list"])

    return run


def _prober(space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = _space(space).scanned(_matrix(batch.column(1)))
            for turn in range(lists.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lists[:, turn].astype(np.int32)), pa.array(np.full(len(batch), turn, np.int32))],
                    names=["num", "v", "list", "turn"],
                )

    return run


def _scanner(space, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        s = _space(space)
        rows, asked = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        scores = np.empty(0)
        if len(left) and len(right):
            vectors, queries = _matrix(left["v"]), _matrix(right["v"])
            placed, aimed = s.place(vectors), s.place(queries, True)
            for i, bound in enumerate(right["bound"].to_pylist()):
                rows.append(_scan(vectors, placed, queries[i], aimed[i], -np.inf if bound is None else bound, s.longest, k))
                asked.append(np.full(len(rows[-1]), i))
            scores = _scores(vectors[np.concatenate(rows)], queries[np.concatenate(asked)])
        return pa.table({
            "q": right["num"].take(pa.array(np.concatenate(asked))), "num": left["num"].take(pa.array(np.concatenate(rows))),
            "score": pa.array(scores, pa.float64()),
        })

    return run
