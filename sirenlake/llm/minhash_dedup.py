"""MinHash near-dedup by fast similarity sketching.

A sketch has ``COORDS`` coordinates. In round i every shingle falls into one coordinate with the value
(i, hash); a coordinate keeps its least value. The first COORDS rounds place by hash, the next COORDS
rounds place all shingles into coordinate i - COORDS, so every coordinate fills; a document stops as soon
as its sketch is full. Agreement of two sketches estimates Jaccard similarity with concentration bounds.

Documents with equal shingle sets form one class. Classes meet in bands of the sketch; pairs from bands
are confirmed on full shingle sets. Bands with many classes never emit all pairs: see ``linking``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .common import Words, connected_components, mix, pieces, shingle_hashes
from .linking import link, shared_bands

COORDS, ROWS = 128, 4
BANDS = COORDS // ROWS
ROUND = np.uint64(48)
LOW = np.uint64((1 << 48) - 1)

SKETCHED = "doc_id long, copy long, n_shingles long, set_key binary, bands array<long>"
SETS = "doc_id long, shingles binary"


def distinct_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, ascending, and where each document's begin."""
    h, doc = shingle_hashes(words)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(words.count) + 1))


def fast_sketch(h: np.ndarray, first: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Sketches (documents x coordinates) of the shingle sets; those of empty sets stay at the maximum."""
    docs = len(first) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full((docs, coords), empty, np.uint64)
    flat = sketch.reshape(-1)
    doc = np.repeat(np.arange(docs), np.diff(first))
    for i in range(2 * coords):
        if not len(h):
            break
        value = mix(h + np.uint64((0x632BE59BD9B4E019 * (i + 1)) & ((1 << 64) - 1)))
        if i < coords:
            place = doc * coords + (value >> ROUND).astype(np.int64) % coords
        else:
            place = doc * coords + (i - coords)
        np.minimum.at(flat, place, (np.uint64(i) << ROUND) | (value & LOW))
        if i < 4 or i % 8 == 0 or i >= coords:
            open_docs = (sketch == empty).any(axis=1)[doc]
            if not open_docs.all():
                h, doc = h[open_docs], doc[open_docs]
    return sketch


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (documents x bands)."""
    docs, coords = sketch.shape
    rows = sketch.reshape(docs, coords // ROWS, ROWS)
    key = np.arange(coords // ROWS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mix(key ^ rows[:, :, r])
    return key.view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])
    for batch in batches:
        ids, copies = batch.column("doc_id"), batch.column("copy")
        for row, end, data, offsets in pieces(batch):
            h, first = distinct_sets(Words(data, offsets))
            count = np.diff(first)
            bands = band_keys(fast_sketch(h, first))
            keys = [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:])]
            use = np.where(count > 0, BANDS, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(use)]), pa.int32()), pa.array(bands[count > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), copies.slice(row, end - row), pa.array(count, pa.int64()), pa.array(keys, pa.binary()), lists], schema=schema)


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        ids = batch.column("doc_id")
        for row, end, data, offsets in pieces(batch):
            h, first = distinct_sets(Words(data, offsets))
            sets = pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), sets], schema=schema)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of a set."""
    schema = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("band", pa.int64())])
    for batch in batches:
        for doc_id, shingles in zip(batch.column("doc_id").to_numpy(), batch.column("shingles")):
            h = np.frombuffer(shingles.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), doc_id)), pa.array(np.full(len(h), len(h))), pa.array(h)], schema=schema)


def _confirm(percent: int):
    """Keep the pairs whose full sets reach the similarity."""

    def batches(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pairs:
            left, right = batch.column("left_set"), batch.column("right_set")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(side[i].as_buffer(), np.uint64) for side in (left, right))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return batches


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right_set"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left_set", "right_set").mapInArrow(_confirm(percent), "a long, b long")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rarest shingles of every set, as many as two similar sets must have one in common of: ``band``, ``id``, ``size``, ``mark``."""
    schema = "id long, size long, band long"
    rows = sets.mapInArrow(_set_rows, schema)
    common = rows.groupBy("band").agg(F.count("*").alias("df"))
    mark = F.row_number().over(Window.partitionBy("id").orderBy("df", "band"))
    least = F.ceil(F.col("size") * percent / 100)
    return rows.join(common, "band").withColumn("mark", mark).where((F.col("mark") <= F.col("size") - least + 1) & (F.col("df") > 1)).select("band", "id", "size", "mark")


def same_id_edges(usable: DataFrame, of_class: DataFrame) -> DataFrame:
    """Pairs of components that hold different texts of one ``doc_id``."""
    placed = usable.join(of_class, "set_key").select("doc_id", "component").distinct()
    several = placed.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("doc_id", "a")
    return placed.join(several, "doc_id").where("a < component").select("a", F.col("component").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` per document.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Shingles are five consecutive words
    (whole sequence for fewer). Documents link at ``percent`` of shared shingles or more, confirmed on full
    sets; a component is kept as its smallest ``doc_id``. NULL, empty and blank texts have no shingles and
    link with nothing. Rows with one id are one document (the links of all its texts count together) but stay
    separate rows; a NULL id links with nothing and is kept. Empty tables give empty results. Bands miss a pair at
    the threshold with a chance of about 5 in a million, less above it.

    Equal sets are one class, numbered by its smallest ``doc_id``; if several classes have the same one (an id
    with different texts), all but the first of them get a negative hash of their set.
    """
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    sketched = cut_lineage(source.mapInArrow(_sketch_batches, SKETCHED))
    usable = sketched.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    of_set = cut_lineage(usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "copy")).alias("lead")))
    first_of_id = of_set.groupBy(F.col("lead.doc_id").alias("low")).agg(F.min("set_key").alias("first_key"), F.count("*").alias("n")).where("n > 1").drop("n")
    other = F.xxhash64("set_key").bitwiseOR(F.lit(-(1 << 63)))
    named = of_set.join(first_of_id, F.col("lead.doc_id") == F.col("low"), "left")
    classes = cut_lineage(named.select("set_key", "lead", F.when(F.col("set_key") != F.col("first_key"), other).otherwise(F.col("lead.doc_id")).alias("id")))
    leads = usable.join(classes, "set_key").where(F.struct("doc_id", "copy") == F.col("lead"))
    members = shared_bands(leads.select("id", F.col("n_shingles").alias("size"), F.lit(1).alias("mark"), F.explode("bands").alias("band")))
    wanted = members.select("id").distinct().join(classes, "id").select("id", "lead.*")
    texts = source.join(wanted, ["doc_id", "copy"]).select(F.col("id").alias("doc_id"), "text")
    sets = cut_lineage(texts.mapInArrow(_set_batches, SETS).dropDuplicates(["doc_id"]))
    # mark is the place of a shingle in its set: if it is the first that two sets share, only what follows can be shared too
    rest = F.least(F.col("size") - F.col("mark"), F.col("other_size") - F.col("other_mark")) + 1
    near = rest * (100 + percent) >= (F.col("size") + F.col("other_size")) * percent
    # large groups of half similar texts share bands, but few rare shingles
    refine = lambda members: _prefixes(sets.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), percent)
    components = link(members, lambda pairs: _confirmed(pairs, sets, percent), near, refine)
    of_class = cut_lineage(classes.join(components, "id", "left").select("set_key", F.col("lead.doc_id").alias("low"), F.coalesce("component_id", "id").alias("component")))
    merged = connected_components(same_id_edges(usable, of_class)).select(F.col("id").alias("component"), F.col("component_id").alias("root"))
    of_class = of_class.join(merged, "component", "left").select("set_key", "low", F.coalesce("root", "component").alias("component"))
    lowest = of_class.groupBy("component").agg(F.min("low").alias("id"))
    of_set = of_class.join(lowest, "component").select("set_key", "id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    return sketched.join(of_set, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
