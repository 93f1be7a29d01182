"""A persisted inverted-file index of vectors: cells of a coarse quantiser as partitions of a table.

``build_index`` fits the cells' centres on a bounded sample, assigns every vector to its nearest centre and writes
them partitioned by cell. A search reads the centres, picks the cells closest to each query and lists them in the
filter of the scan, so the other cells' files are never opened; each task keeps the best k of its part of a cell,
and these merge. An exact search also reads all cells that could hold a closer vector: by the triangle inequality
no member of a cell is closer than the distance to its centre less its radius.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .retrieval import TOP_K, squared_l2

SAMPLE = 50_000  # vectors that the centres are fitted on, at most
MOST_CELLS = 4096  # so the centres stay small
FILE_ROWS = 200_000  # of a cell in one write task
SLACK = 1e-9  # relative; bounds are rounded the safe way


def usable(embedding: str, dims: int | None = None) -> Column:
    """Vectors that can be compared: no missing component, none that is not finite, the right length."""
    c = F.col(embedding)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return c.isNotNull() & finite & ((F.size(c) == dims) if dims else (F.size(c) > 0))


def _assigner(centres: np.ndarray, names: tuple[str, str]):
    """Nearest centre and the distance to it, for batches of (id, vector)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = (centres**2).sum(axis=1)
        for batch in rows:
            x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            cell = np.empty(len(x), np.int32)
            for low in range(0, len(x), 1024):  # bounds the table of distances
                part = x[low : low + 1024]
                cell[low : low + 1024] = np.argmin(norm - 2 * part @ centres.T, axis=1)
            distance = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(distance)], [*names, "cell", "distance"])

    return batches


def _assigned(vectors: DataFrame, vec_id: str, embedding: str, centres: np.ndarray) -> DataFrame:
    rows = vectors.where(usable(embedding, centres.shape[1])).select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"))
    kind = rows.schema["vec_id"].dataType.simpleString(), rows.schema["v"].dataType.simpleString()
    return rows.mapInArrow(_assigner(centres, ("vec_id", "v")), f"vec_id {kind[0]}, v {kind[1]}, cell int, distance double")


def _append(assigned: DataFrame, path: str) -> None:
    """Write assigned vectors by cell, large cells in several tasks, and the number and radius of each cell."""
    assigned = cut_lineage(assigned)
    stats = cut_lineage(assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")))
    parts = stats.select(F.col("cell"), F.ceil(F.col("n") / FILE_ROWS).cast("int").alias("parts"))
    dealt = assigned.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    dealt.repartition("cell", "part").select("vec_id", "v", "cell").write.mode("append").partitionBy("cell").parquet(f"{path}/vectors")
    stats.coalesce(1).write.mode("append").parquet(f"{path}/stats")


@dataclass
class VectorIndex:
    """An index below ``path``; all it needs to be used again is there."""

    path: str
    centres: np.ndarray
    count: np.ndarray  # of vectors by cell
    radius: np.ndarray

    @staticmethod
    def load(spark: SparkSession, path: str) -> VectorIndex:
        centres = np.array([r["centre"] for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])
        count, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
        for r in spark.read.parquet(f"{path}/stats").groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():
            count[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
        return VectorIndex(path, centres, count, radius)

    def add(self, vectors: DataFrame, vec_id: str, embedding: str = "embedding") -> VectorIndex:
        """The index with more vectors, in the cells it has."""
        _append(_assigned(vectors, vec_id, embedding, self.centres), self.path)
        return VectorIndex.load(vectors.sparkSession, self.path)

    def _probes(self, queries: DataFrame, probes: int, k: int, within: bool) -> DataFrame:
        """(query_id, q, cell): the cells to read. ``within`` takes all that may hold a vector closer than ``reach``."""
        centres, count, radius = self.centres, self.count, self.radius
        kind, vector = (queries.schema[c].dataType.simpleString() for c in ("query_id", "q"))

        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filled = np.flatnonzero(count)
            for batch in rows:
                chosen = []
                reach = batch.column("reach").to_numpy(zero_copy_only=False)
                for i, q in enumerate(batch.column("q").to_pylist()):
                    distance = np.sqrt(((centres[filled] - np.array(q, np.float64)) ** 2).sum(axis=1))
                    order = np.argsort(distance, kind="stable")
                    if within:
                        near = filled[distance - radius[filled] <= reach[i] * (1 + SLACK) + SLACK]
                    else:
                        enough = np.searchsorted(np.cumsum(count[filled][order]), k) + 1
                        near = filled[order[: max(probes, int(enough))]]
                    chosen.append(near)
                at = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                cells = np.concatenate(chosen) if chosen else np.zeros(0, int)
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(taken), batch.column("q").take(taken), pa.array(cells.astype(np.int32))], ["query_id", "q", "cell"]
                )

        return queries.select("query_id", "q", "reach").mapInArrow(batches, f"query_id {kind}, q {vector}, cell int")

    def _best(self, probed: DataFrame, k: int) -> DataFrame:
        """Best k vectors of the probed cells per query. The scan is limited to these cells."""
        spark = probed.sparkSession
        probed = cut_lineage(probed)
        cells = [r["cell"] for r in probed.select("cell").distinct().collect()]  # at most MOST_CELLS
        vectors = spark.read.parquet(f"{self.path}/vectors").where(F.col("cell").isin(cells))
        pairs = vectors.join(probed, "cell").select("query_id", "vec_id", squared_l2(F.col("q"), F.col("v")).alias("distance"))
        best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
        return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def search(self, queries: DataFrame, query_id: str, embedding: str = "embedding", k: int = TOP_K, probes: int = 12, exact: bool = False) -> DataFrame:
        """``query_id``, ``vec_id``, ``distance`` (squared) and ``rank`` of the nearest vectors of the index.

        A query reads its ``probes`` nearest cells, and more until they hold k vectors. ``exact`` then reads the cells
        that may hold a vector closer than the k-th found, so the result is that of a full scan. Ties go to the
        smaller ``vec_id``. Queries that cannot be compared find nothing.
        """
        asked = queries.where(usable(embedding, self.centres.shape[1])).select(F.col(query_id).alias("query_id"), F.col(embedding).alias("q"))
        first = self._best(self._probes(asked.withColumn("reach", F.lit(0.0)), probes, k, False), k)
        if not exact:
            return first
        reach = cut_lineage(first.groupBy("query_id").agg(F.sqrt(F.max("distance")).alias("reach")))
        return self._best(self._probes(asked.join(reach, "query_id"), probes, k, True), k)

    def cells_read(self, queries: DataFrame, query_id: str, embedding: str = "embedding", k: int = TOP_K, probes: int = 12) -> float:
        """Mean share of the filled cells that a query reads."""
        asked = queries.where(usable(embedding, self.centres.shape[1])).select(F.col(query_id).alias("query_id"), F.col(embedding).alias("q"), F.lit(0.0).alias("reach"))
        per = self._probes(asked, probes, k, False).groupBy("query_id").count().agg(F.avg("count")).first()[0]
        return float(per or 0.0) / max(int((self.count > 0).sum()), 1)


def build_index(vectors: DataFrame, vec_id: str, path: str, embedding: str = "embedding", cells: int | None = None, sample: int = SAMPLE, seed: int = 42) -> VectorIndex:
    """Index all vectors that can be compared below ``path`` (which must be new).

    There are about as many cells as the root of the number of vectors, at most MOST_CELLS. The centres are
    fitted on at most ``sample`` vectors, those of the smallest seeded hashes; every vector is indexed.
    """
    spark = vectors.sparkSession
    good = vectors.where(usable(embedding))
    size = good.groupBy(F.size(embedding).alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    if size is None:
        raise ValueError("no vector to index")
    of_size = good.where(F.size(embedding) == size["dims"])
    cells = min(cells or math.ceil(math.sqrt(size["n"])), MOST_CELLS, size["n"])
    share = min(1.0, 1.2 * sample / size["n"])
    some = of_size.where(F.pmod(F.xxhash64(F.lit(seed), F.col(vec_id)), F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = cut_lineage(some.orderBy(F.xxhash64(F.lit(seed), F.col(vec_id)), vec_id).limit(sample).select(array_to_vector(F.col(embedding).cast("array<double>")).alias("x")))
    model = KMeans(featuresCol="x", k=cells, seed=seed, maxIter=10).fit(picked)
    centres = np.array(model.clusterCenters())
    rows = [(i, c.tolist()) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
    _append(_assigned(of_size, vec_id, embedding, centres), path)
    return VectorIndex.load(spark, path)
