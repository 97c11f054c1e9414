"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one point; a point keeps the ``k`` + 1 smallest ids of its
vectors, which is exact, as no answer can hold more of them. Each of
``curves`` random rotations projects the points to ``dims`` numbers, shifts
them at random, and orders them by their Hilbert key. Spark range-partitions
the orderings; a point's place in one is its number there.

A query looks at the places up to ``window`` before and behind its own in
every ordering. The window is measured, not guessed: for ``probes`` queries
(those with the smallest hash of their id) the true neighbours are found by a
scan of all points, and the window is the distance in places that reaches
``recall`` of them on the best ordering. Data that lies near few dimensions
gets small windows; vectors without any structure get wide ones.

Windows are searched in blocks: ``block`` places make a block of points, and
queries of ``span`` such blocks meet each block that their windows touch, so a
task holds a bounded number of vectors whatever the data. A query's own
blocks come first; their results set the score that any other block's points
must reach. The blocks' results merge by score, then by id.

Vectors that are null, zero, of another length than most (the commonest,
ties to the longer), or that hold null or non-finite components take no
part. Ids may be any numbers; a null id is no candidate and no query; rows
that repeat an id and vector count once. A query's own id is never its
neighbour. Without points or queries the answer is empty. Only the columns
named are read, so other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roomtide.llm.text import one_column
from roomtide.session import scratch_path


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits in each of their dimensions.

    Gray-code form of the curve: from the highest bit down, a set bit
    mirrors the lower bits of the first dimension, an unset one swaps them
    with those of the dimension at hand; the bits are then undone of their
    Gray code and interleaved.
    """
    x = [c.astype(np.uint64) for c in cells.T]
    one, dims = np.uint64(1), len(x)
    for b in range(bits - 1, 0, -1):
        low = (one << np.uint64(b)) - one
        for i in range(dims):
            on = (x[i] >> np.uint64(b)) & one == one
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    parity = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        on = (x[-1] >> np.uint64(b)) & one == one
        parity = np.where(on, parity ^ ((one << np.uint64(b)) - one), parity)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | (((x[i] ^ parity) >> np.uint64(b)) & one)
    return key.astype(np.int64)


def projections(size: int, dims: int, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each curve the projection and its shift, in shares of a cell block."""
    out = []
    for c in range(curves):
        random = np.random.default_rng([seed, c])
        turned = np.linalg.qr(random.normal(size=(size, size)))[0]
        out.append((turned[:, :min(dims, size)], random.random(min(dims, size))))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


class Search:
    def __init__(
        self, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, curves: int = 8, dims: int = 8, bits: int = 7,
        probes: int = 100, recall: float = 0.95, block: int = 2048, span: int = 8, seed: int = 7,
    ):
        if dims * bits > 62:
            raise ValueError("a key has 62 bits at most")
        self.spark, self.k, self.curves, self.dims, self.bits = vectors.sparkSession, k, curves, dims, bits
        self.probes, self.recall, self.block, self.span, self.seed = probes, recall, block, span, seed
        rows = one_column(vectors, vec_id=vec_id, v=vector).where("vec_id is not null and v is not null")
        rows = rows.select("vec_id", F.col("v").cast("array<double>").alias("v"))
        rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
        self.rows = rows.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))  # -0.0 is 0.0
        self.id_type = vectors.schema[vec_id].dataType.simpleString()
        self.paths: dict[str, str] = {}

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def points(self) -> DataFrame:
        """``point``, its vector ``v`` and its smallest ids, for every distinct vector."""
        sizes = self.rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
        self.size = sizes["size"] if sizes else 0
        one = self.rows.where(F.size("v") == self.size).select(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "vec_id", "v")
        # the smallest ids of part of a point's rows, then of these: no group meets all the copies
        part = Window.partitionBy("h1", "h2", "part").orderBy("vec_id")
        whole = Window.partitionBy("h1", "h2").orderBy("vec_id")
        few = one.withColumn("part", F.spark_partition_id()).dropDuplicates(["h1", "h2", "vec_id"]).withColumn("r", F.row_number().over(part)).where(F.col("r") <= self.k + 1)
        few = few.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= self.k + 1)
        return few.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.struct("h1", "h2").alias("point"), "v", "ids")

    def ordered(self, points: DataFrame) -> DataFrame:
        """Every point once for each curve, with its place on it."""
        turned, bits, size = projections(self.size, self.dims, self.curves, self.seed), self.bits, self.size
        spread = points.select(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm")).agg(F.avg("norm")).first()[0] or 1.0
        scale = 4 * spread / max(1.0, size) ** 0.5  # projected numbers of two standard deviations fill the cells

        def run(batches):
            for batch in batches:
                v = _matrix(batch.column(1))
                for c, (matrix, shift) in enumerate(turned):
                    cells = ((v @ matrix) / scale + 0.25 + 0.5 * shift) * (1 << bits)
                    keys = hilbert_keys(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(keys), batch.column(0), batch.column(1), batch.column(2)], names=["curve", "key", "point", "v", "ids"])

        kinds = f"curve int, key bigint, point struct<h1: bigint, h2: bigint>, v array<double>, ids array<{self.id_type}>"
        spots = points.mapInArrow(run, kinds).repartitionByRange("curve", "key", "point").sortWithinPartitions("curve", "key", "point")
        # stored, as the numbers below hold for one run of the sort only
        numbered = self._stored(spots.withColumn("row", F.monotonically_increasing_id()), "curves")
        parts = numbered.groupBy(F.shiftright("row", 33).alias("part")).agg(F.count("*").alias("n"))
        before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
        low = F.col("row").bitwiseAND((1 << 33) - 1)
        return numbered.join(F.broadcast(before), F.shiftright("row", 33) == F.col("part")).select("curve", (F.col("before") + low).alias("place"), "point", "v", "ids")

    def window(self, points: DataFrame, ordered: DataFrame, queries: DataFrame) -> int:
        """Places to either side that reach ``recall`` of the probes' true neighbours."""
        k, probes = self.k, queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(self.probes).toArrow()
        if not probes.num_rows:
            return k + 1
        q = _matrix(probes.column("v").combine_chunks())

        def run(batches):
            for batch in batches:
                scores = q @ _matrix(batch.column(1)).T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
                probe = np.repeat(np.arange(len(q), dtype=np.int32), top.shape[1])
                at = top.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(probe), batch.column(0).take(pa.array(at)), pa.array(scores[probe, at])], names=["probe", "point", "score"])

        near = points.select("point", "v").mapInArrow(run, "probe int, point struct<h1: bigint, h2: bigint>, score double")
        best = near.withColumn("r", F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "point"))).where(F.col("r") <= k + 1)
        own = self.spark.createDataFrame([(i, (p["h1"], p["h2"])) for i, p in enumerate(probes.column("point").to_pylist())], "probe int, point struct<h1: bigint, h2: bigint>")
        places = ordered.select("curve", "place", "point")
        asked = places.join(F.broadcast(own), "point").select("probe", "curve", F.col("place").alias("at"))
        there = places.join(F.broadcast(best.select("probe", "point")), "point").join(F.broadcast(asked), ["probe", "curve"])
        gaps = there.groupBy("probe", "point").agg(F.min(F.abs(F.col("place") - F.col("at"))).alias("gap")).where("gap > 0")
        return max(k, int(gaps.agg(F.percentile("gap", F.lit(self.recall))).first()[0] or 1)) + 1

    def _searched(self, queries: DataFrame, points: DataFrame, keys: list[str], window: int) -> DataFrame:
        """Of the points with a query's ``keys`` and in its window, the best ``k`` + 1 that reach its ``floor``, with all ties."""
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        k, kinds = self.k, f"point struct<h1: bigint, h2: bigint>, ids array<{self.id_type}>, score double"
        schema = to_arrow_schema(_parse_datatype_string(kinds))

        def run(key, q: pa.Table, p: pa.Table) -> pa.Table:
            out = [schema.empty_table()]
            if q.num_rows and p.num_rows:
                pv, there = _matrix(p.column("v").combine_chunks()), p.column("place").to_numpy()
                for at in range(0, q.num_rows, 256):
                    some = q.slice(at, 256)
                    qv = _matrix(some.column("v").combine_chunks())
                    scores = qv @ pv.T
                    scores[np.abs(some.column("place").to_numpy()[:, None] - there[None, :]) > window] = -np.inf
                    n = min(k + 1, scores.shape[1])
                    least = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
                    # one part in 1e12 below: the two ways of summing may differ in the last digits
                    least = np.maximum(least, some.column("floor").to_numpy()) - 1e-12
                    i, j = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
                    exact = np.array([np.dot(qv[a], pv[b]) for a, b in zip(i, j)])
                    out.append(pa.Table.from_arrays([some.column("point").take(pa.array(i)), p.column("ids").take(pa.array(j)), pa.array(exact, pa.float64())], schema=schema))
            return pa.concat_tables(out)

        return queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(run, kinds)

    def neighbours(self, is_query) -> DataFrame:
        """``query_id``, ``rank``, ``vec_id`` and ``score`` for the rows that ``is_query`` (a condition on ``vec_id``) picks."""
        points = self._stored(self.points(), "points")
        found = f"query_id {self.id_type}, rank int, vec_id {self.id_type}, score double"
        if not self.size:
            return self.spark.createDataFrame([], found)
        asked = self.rows.where(F.size("v") == self.size).where(is_query).dropDuplicates(["vec_id", "v"]).select("vec_id", F.struct(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")).alias("point"), "v")
        queries = self._stored(asked, "queries")
        ordered = self._stored(self.ordered(points), "ordered")
        # queries with equal vectors share a search; k + 1 leaves room for their own ids
        distinct = queries.select("point").distinct()
        window, block, wide, k = self.window(points, ordered, queries), self.block, self.block * self.span, self.k
        place = F.col("place")
        theirs = ordered.join(distinct, "point").select("curve", "place", "point", "v")
        again = self.spark.read.parquet(self.paths["ordered"])  # the same rows for the other side of the joins below
        numbered = again.select("curve", F.floor(place / block).alias("block"), "place", "v", "ids")

        # first the own block of each query on every curve: what a neighbour must reach at least
        near = self._searched(theirs.withColumn("block", F.floor(place / block)).withColumn("floor", F.lit(-float("inf"))), numbered, ["curve", "block"], window)
        near = self._stored(near, "near")
        best = Window.partitionBy("point").orderBy(F.desc("score"), "found")
        floors = near.select("point", F.explode("ids").alias("found"), "score").distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") == k + 1).select("point", F.col("score").alias("floor"))

        # then every block that the windows of a span of places touch
        left = theirs.join(floors, "point", "left").select("curve", F.floor(place / wide).alias("span"), "place", "point", "v", F.coalesce("floor", F.lit(-float("inf"))).alias("floor"))
        touched = F.sequence(F.floor((place - window) / block), F.floor((place + window) / block))
        left_blocks = left.select("curve", "span", F.explode(touched).alias("block")).distinct()
        left = left.join(left_blocks, ["curve", "span"])
        spans = F.sequence(F.floor((place - window) / wide), F.floor((place + window) / wide))
        right = numbered.select("*", F.explode(spans).alias("span"))
        hits = near.unionByName(self._searched(left, right, ["curve", "span", "block"], window))
        one = hits.groupBy("point", F.get("ids", F.lit(0)).alias("first")).agg(F.max(F.struct("score", "ids")).alias("b")).select("point", "b.score", F.explode("b.ids").alias("vec_id"))
        best = Window.partitionBy("point").orderBy(F.desc("score"), "vec_id")
        shared = one.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("point", "vec_id", "score")
        answer = queries.select(F.col("vec_id").alias("query_id"), "point").join(shared, "point").where("vec_id != query_id")
        ranked = answer.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "point").orderBy(F.desc("score"), "vec_id")))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query, **options) -> DataFrame:
    return Search(vectors, **options).neighbours(is_query)
