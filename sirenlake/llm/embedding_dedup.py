"""Embedding near-dedup with randomised-rotation binary codes.

Unit vectors are rotated by seeded orthogonal matrices. The signs of the rotated coordinates are a binary
code; the stored factor f (inner product of a vector with its own code) corrects it: the inner product of
one vector's code with another rotated vector, divided by f, is an unbiased estimate of their cosine, with
a known deviation. Only pairs whose upper confidence bound reaches the threshold are recomputed exactly.

Pairs to be estimated share a band of code bits in one of several tables. Band length follows from the
number of vectors and the number of tables from the wanted chance to miss a pair, so work per vector grows
slowly. Equal vectors are one class; a pair is judged only in the first table in which it meets; large
buckets are dealt out as pairs of blocks; tasks return counts and spanning links, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .common import connected_components

BLOCK = 512  # rows of a bucket that are compared at once
BRIEF = 32
SIGMAS = 6.0
RUN = ["label", "dims", "table", "key", "low", "high"]


_ROTATIONS: dict[tuple[int, int, int], np.ndarray] = {}  # within a task


def rotations(dims: int, bits: int, seed: int = 7) -> np.ndarray:
    """Enough rows of seeded orthogonal matrices for ``bits`` code bits."""
    if (dims, bits, seed) not in _ROTATIONS:
        rng = np.random.default_rng([seed, dims])
        blocks = []
        for _ in range(math.ceil(bits / dims)):
            q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
            blocks.append(q * np.sign(np.diag(r)))
        _ROTATIONS[dims, bits, seed] = np.concatenate(blocks)
    return _ROTATIONS[dims, bits, seed]


def table_plan(vectors: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits per band and number of tables for a chance of at most ``miss`` to lose a pair at the threshold."""
    bits = min(max(10, math.ceil(math.log2(max(vectors, 2)))), 31)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def table_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Band of code bits per vector and table (int32)."""
    signs = unit @ rotations(unit.shape[1], bits * tables)[: bits * tables].T >= 0
    return signs.reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int32)).astype(np.int32)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in vectors), np.float64).reshape(-1, dims)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles with a digest; NULL for those that link with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("dims", pa.int32()), ("digest", pa.binary()), ("vector", pa.binary())])
    for batch in batches:
        lists, labels = batch.column("embedding"), batch.column("label")
        rows = []
        for i in range(batch.num_rows):
            values = lists[i].values if lists[i].is_valid and labels[i].is_valid else None
            v = np.zeros(0) if values is None or values.null_count else values.to_numpy(zero_copy_only=False).astype(np.float64)
            good = len(v) > 0 and np.isfinite(v).all() and v.any()
            rows.append((len(v), hashlib.blake2b(v.tobytes(), digest_size=16).digest(), v.tobytes()) if good else (None, None, None))
        dims, digest, vector = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), labels.cast(pa.int64()), pa.array(dims, pa.int32()), pa.array(digest, pa.binary()), pa.array(vector, pa.binary())], schema=schema)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(bits: int, tables: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dims", pa.int32()), ("keys", pa.list_(pa.int32()))])
        for batch in rows:
            dims = batch.column("dims").to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                keys = table_keys(unit_rows(_matrix(part.column("vector"), d)), bits, tables)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * tables, pa.int32()), pa.array(keys.reshape(-1), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), part.column("dims"), lists], schema=schema)

    return batches


def _judge(i: np.ndarray, j: np.ndarray, estimate: np.ndarray, spread: np.ndarray, unit: np.ndarray, keys: np.ndarray, table: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) among the estimated ones that meet in no earlier table."""
    maybe = estimate + SIGMAS * spread[i] >= threshold
    i, j = i[maybe], j[maybe]
    same = keys[i] == keys[j]
    fresh = same.argmax(axis=1) == table[i]
    i, j = i[fresh], j[fresh]
    exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
    return i[exact], j[exact]


def _forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join two components when taken in turn."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = top(a), top(b)
        if x != y:
            up[x] = y
            out.append((a, b))
    return out


def _runs(bits: int, tables: int, threshold: float):
    """Judge the sorted rows of a partition bucket by bucket; a bucket may go over several batches."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
        waiting: pa.Table | None = None
        names = [*RUN, "block", "id", "copies", "vector"]

        def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for d in np.unique(table.column("dims").to_numpy()):
                rows = table.filter(pa.array(table.column("dims").to_numpy() == d))
                marks = np.stack([rows.column(c).to_numpy() for c in RUN])
                ids, copies, block = (rows.column(c).to_numpy() for c in ("id", "copies", "block"))
                n = len(ids)
                unit = unit_rows(_matrix(rows.column("vector").combine_chunks(), int(d)))
                keys = table_keys(unit, bits, tables)
                turn = unit @ rotations(int(d), int(d)).T
                code = np.where(turn >= 0, 1.0, -1.0) / math.sqrt(d)
                factor = np.abs(turn).sum(axis=1) / math.sqrt(d)
                spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(d - 1, 1))
                cuts = np.concatenate([[0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, [n]])
                run, size = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), np.diff(cuts)
                brief = size[run] <= BRIEF
                found = []
                for step in range(1, BRIEF):  # rows of short runs, each with the one ``step`` further on
                    i = np.flatnonzero(brief[: n - step] & (run[: n - step] == run[step:]) & ((marks[4] == marks[5])[: n - step] | (block[: n - step] != block[step:])))
                    if not len(i) and not (size > step).any():
                        break
                    found.append(_judge(i, i + step, np.einsum("ij,ij->i", code[i], turn[i + step]) / factor[i], spread, unit, keys, marks[2], threshold))
                for k in np.flatnonzero(size > BRIEF):
                    at = np.arange(cuts[k], cuts[k + 1])
                    low, high = marks[4, cuts[k]], marks[5, cuts[k]]
                    left, right = at[block[at] == low], at[block[at] == high]
                    estimate = (code[left] @ turn[right].T) / factor[left, None]
                    i, j = np.nonzero((estimate + SIGMAS * spread[left, None] >= threshold) & ((left[:, None] < right[None, :]) | (low != high)))
                    found.append(_judge(left[i], right[j], estimate[i, j], spread, unit, keys, marks[2], threshold))
                if not found:
                    continue
                i, j = (np.concatenate(side) for side in zip(*found))
                links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
                out = [(int(ids[k]), None, int(links[k])) for k in np.flatnonzero(links)] + [(int(ids[x]), int(ids[y]), 0) for x, y in _forest(i, j)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], schema=schema)

        for batch in rows:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch]).select(names)
            waiting = fresh if waiting is None else pa.concat_tables([waiting, fresh])
            marks = np.stack([waiting.column(c).to_numpy() for c in RUN])
            ends = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0))
            if len(ends):
                yield from judged(waiting.slice(0, int(ends[-1]) + 1))
                waiting = waiting.slice(int(ends[-1]) + 1)
        if waiting is not None:
            yield from judged(waiting)

    return batches


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, miss: float = 1e-5) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` per vector.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; other columns are not read. Only vectors of
    one label and one length are compared, by cosine in double precision; NULL labels, NULL, empty or zero
    vectors and such with NULL or non-finite components link with nothing. ``n_links`` counts all other
    rows with a cosine of ``threshold`` or more, copies included. Repeated rows are copies of each other; rows of
    one id with different vectors or labels are vectors of their own, each with its own links and component.
    A pair at the threshold is missed with a chance of ``miss`` (it meets in no table), plus that of a
    deviation of 6 sigma. Empty tables give empty results.
    """
    given = vectors.select("vec_id", "embedding", "label")
    rows = cut_lineage(given.mapInArrow(_usable, "vec_id long, label long, dims int, digest binary, vector binary"))
    usable = rows.where(F.col("digest").isNotNull() & F.col("vec_id").isNotNull())
    content = ["label", "dims", "digest"]
    same = cut_lineage(usable.groupBy(*content).agg(F.min("vec_id").alias("low"), F.count("*").alias("copies")))
    # equal vectors are one class, numbered by the smallest id; further classes of that id get a negative hash
    first_of_id = same.groupBy("low").agg(F.min(F.struct(*content)).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    other = F.xxhash64(*content).bitwiseOR(F.lit(-(1 << 63)))
    named = same.join(first_of_id, "low", "left").withColumn("id", F.when(F.struct(*content) != F.col("first"), other).otherwise(F.col("low")))
    classes = cut_lineage(named.select(*content, "low", "copies", "id"))
    leads = usable.join(classes, content).where(F.col("vec_id") == F.col("low"))
    leads = cut_lineage(leads.dropDuplicates(["id"]).select("id", "label", "dims", "copies", "vector"))
    bits, tables = table_plan(leads.count(), threshold, miss)
    spots = leads.mapInArrow(_keys(bits, tables), "id long, label long, dims int, keys array<int>").select("id", "label", "dims", F.posexplode("keys").alias("table", "key"))
    bucket = ["label", "dims", "table", "key"]
    sizes = spots.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = spots.join(sizes, bucket).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id", "table"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", *bucket, "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    tasks = dealt.join(leads.select("id", "copies", "vector"), "id").repartition(*RUN).sortWithinPartitions(*RUN)
    found = cut_lineage(tasks.mapInArrow(_runs(bits, tables, threshold), "a long, b long, links long"))
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    components = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    of_class = classes.join(links, "id", "left").join(components, "id", "left")
    of_class = cut_lineage(of_class.select(*content, "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("class")))
    lowest = of_class.groupBy("class").agg(F.min("low").alias("component_id"))
    of_class = of_class.join(lowest, "class").drop("class", "low")
    component = F.coalesce("component_id", "vec_id")
    return rows.join(of_class, ["label", "dims", "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
