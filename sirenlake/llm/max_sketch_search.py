"""Ranked lexical search: hashed max-sketches bound the scores, documents are rescored by falling bound.

The index holds the terms of every document as 64-bit hashes with their counts. For a block of queries each
task folds the impacts of its documents' terms into sketches: every term has one of WIDTH coordinates, which
keeps the largest impact of its terms. The weights of a query times the sketch at its terms' coordinates is an
upper bound of a document's score, looked up for all queries and documents at once. Documents are then scored
exactly in falling order of their bound, until it lies below the task's k-th best score. The best k of every task
merge to the exact best k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sirenlake.functions.session import cut_lineage

from .bm25_search import term_counts
from .common import NO_LETTER, Words, mix, pieces

WIDTH = 8192  # coordinates of a sketch
PAGE_DOCS = 512  # documents whose sketches a task holds at once
PAGE_BYTES = 4 << 20
BLOCK_TERMS = 1 << 17  # terms of the queries of a block, on average
CELLS = 1 << 21  # looked up at once
K, B = 8, 90  # weight of the length norm, and its percentage that follows the length
INDEX = "ids array<long>, lengths binary, sizes binary, terms binary, counts binary, n_docs long, n_terms long"
INDEX_SCHEMA = pa.schema(
    [("ids", pa.list_(pa.int64()))] + [(c, pa.binary()) for c in ("lengths", "sizes", "terms", "counts")] + [(c, pa.int64()) for c in ("n_docs", "n_terms")]
)


def _index_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").cast(pa.int64())
        for row, end, data, offsets in pieces(batch, limit=PAGE_BYTES):
            for low in range(0, end - row, PAGE_DOCS):
                high = min(low + PAGE_DOCS, end - row)
                a, b = offsets[low], offsets[high]
                doc, term, count, length = term_counts(data[a:b], offsets[low : high + 1] - a)
                packed = (length.astype(np.int64), np.bincount(doc, minlength=high - low).astype(np.int32), term, count.astype(np.int32))
                values = [ids.slice(row + low, high - low).to_pylist(), *(p.tobytes() for p in packed), int((length > 0).sum()), int(length.sum())]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, INDEX_SCHEMA)], schema=INDEX_SCHEMA)


def build_index(docs: DataFrame) -> DataFrame:
    """Pages of up to PAGE_DOCS documents (``doc_id``, ``text``): ids, lengths, and distinct terms with their counts."""
    return docs.select("doc_id", "text").mapInArrow(_index_pages, INDEX)


def _query_terms(kind: pa.DataType):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            items = batch.column("item_id")
            for row, end, data, offsets in pieces(batch):
                words = Words(data, offsets, gaps=NO_LETTER)
                yield pa.RecordBatch.from_arrays([items.take(pa.array(row + words.doc)).cast(kind), pa.array(words.hashes.view(np.int64))], ["item_id", "term"])

    return batches


class Page:
    """A page of the index with the impacts of its terms."""

    def __init__(self, page: dict, n: int, total: int):
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in page["ids"]], np.int64)
        self.missing = np.array([i is None for i in page["ids"]], bool)
        lengths, sizes = np.frombuffer(page["lengths"], np.int64), np.frombuffer(page["sizes"], np.int32)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.term = np.frombuffer(page["terms"], np.uint64)  # ascending in each document
        count = np.frombuffer(page["counts"], np.int32).astype(np.int64)
        norm = 100 - B + B * lengths * n // max(total, 1)
        self.impact = 1_000_000_000 * count // (1000 * count + K * norm[self.doc])

    def sketch(self) -> np.ndarray:
        """Largest impact by coordinate and document."""
        out = np.zeros(WIDTH * len(self.ids), np.int32)
        np.maximum.at(out, coordinate(self.term) * len(self.ids) + self.doc, self.impact.astype(np.int32))
        return out.reshape(WIDTH, -1)


def coordinate(term: np.ndarray) -> np.ndarray:
    return (mix(term) % np.uint64(WIDTH)).astype(np.int64)


class Queries:
    """Queries of a block: terms of each one after another, and weights of all distinct terms."""

    def __init__(self, items: list, terms: list[list[int]], weight: dict[int, int]):
        self.items = items
        self.known = np.sort(np.array(list(weight), np.int64).view(np.uint64))
        self.weight = np.array([weight[t] for t in self.known.view(np.int64).tolist()], np.int64)
        self.first = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        self.term = np.searchsorted(self.known, np.array([t for ts in terms for t in ts], np.int64).view(np.uint64))

    def bounds(self, sketch: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Number of every query and its upper bounds for all documents, looked up for many queries at once."""
        at, step = coordinate(self.known)[self.term], max(1, CELLS // max(sketch.shape[1], 1))
        q = 0
        while q < len(self.items):
            end = max(q + 1, int(np.searchsorted(self.first, self.first[q] + step, "right")) - 1)
            a, b = self.first[q], self.first[end]
            bound = np.zeros((end - q, sketch.shape[1]), np.int64)
            for low in range(a, b, step):  # one query of very many terms comes in parts
                span = np.arange(low, min(low + step, b))
                part = np.searchsorted(self.first, span, "right") - 1
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                bound[part[starts] - q] += np.add.reduceat(sketch[at[span]] * self.weight[self.term[span]][:, None], starts)
            yield from zip(range(q, end), bound)
            q = end


def _search(queries: Queries, n: int, total: int, k: int, kind: pa.DataType):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries.items]
        rescored = np.zeros(len(queries.items), np.int64)
        for batch in rows:
            for content in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                page = Page(content, n, total)
                if not len(page.ids):
                    continue
                # postings of the queries' terms, sorted by document and term
                at = np.searchsorted(queries.known, page.term)
                hit = np.flatnonzero(queries.known[np.minimum(at, len(queries.known) - 1)] == page.term)
                posting, impact = page.doc[hit] * len(queries.known) + at[hit], page.impact[hit]
                if not len(hit):
                    continue
                for q, bound in queries.bounds(page.sketch()):
                    terms = queries.term[queries.first[q] : queries.first[q + 1]]
                    score, ids, missing = best[q]
                    floor = score[-1] if len(score) == k else 1
                    near = np.flatnonzero(bound >= floor)
                    near = near[np.argsort(-bound[near], kind="stable")]
                    done, step, most = 0, k, max(1, CELLS // len(terms))
                    while done < len(near) and bound[near[done]] >= floor:
                        docs = near[done : done + min(step, most)]
                        done, step = done + len(docs), step * 2
                        wanted = docs[:, None] * len(queries.known) + terms
                        place = np.minimum(np.searchsorted(posting, wanted), len(posting) - 1)
                        exact = np.where(posting[place] == wanted, impact[place] * queries.weight[terms], 0).sum(axis=1)
                        score, ids, missing = np.append(score, exact), np.append(ids, page.ids[docs]), np.append(missing, page.missing[docs])
                        order = np.lexsort((missing, ids, -score))[:k]
                        order = order[score[order] > 0]
                        score, ids, missing = score[order], ids[order], missing[order]
                        floor = score[-1] if len(score) == k else 1
                    rescored[q] += done
                    best[q] = score, ids, missing
        of = np.repeat(np.arange(len(best)), [len(s) for s, _, _ in best])
        if len(of):
            score, ids, missing = (np.concatenate(c) for c in zip(*best))
            items = pa.array([queries.items[i] for i in of], kind)
            yield pa.RecordBatch.from_arrays([items, pa.array(ids, mask=missing), pa.array(score), pa.array(rescored[of])], ["item_id", "doc_id", "score", "rescored"])

    return batches


def _document_counts(known: np.ndarray):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(known), np.int64)
        for batch in rows:
            for terms in batch.column("terms"):
                term = np.frombuffer(terms.as_buffer(), np.int64)
                at = np.minimum(np.searchsorted(known, term), len(known) - 1)
                count += np.bincount(at[known[at] == term], minlength=len(known))
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(known[has]), pa.array(count[has])], ["term", "df"])

    return batches


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` (and ``rescored``, the documents its task scored for the item).

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``. Terms are runs of letters, digits and
    characters beyond ASCII, A-Z lower-cased, of the whole texts. Items with one id are one item with the terms of
    all their rows; a NULL id is an id, too. Every row of ``docs`` is a document of its own, so repeated ones
    take several ranks. Equal scores go by ascending ``doc_id``, NULL last. Documents without a common term of positive
    weight are not returned; NULL and empty texts neither find nor are found. Empty tables give empty results.

    Items are dealt to blocks by a hash, so that the terms of a block, which go to every task, average at most
    ``block_terms`` however many items there are. Every block searches all documents.
    """
    field = items.schema["item_id"]
    kind, ddl = to_arrow_type(field.dataType), field.dataType.simpleString()
    index = cut_lineage(build_index(docs))
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = size["n"] or 0, size["total"] or 0
    asked = cut_lineage(items.select("item_id", "text").mapInArrow(_query_terms(kind), f"item_id {ddl}, term long").distinct())
    blocks = max(1, math.ceil(asked.count() / block_terms))
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        if rows and n:
            found.append(_best_of_block(index, rows, n, total, k, kind, ddl))
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("rescored")).where(F.lit(False))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _best_of_block(index: DataFrame, rows: list[Row], n: int, total: int, k: int, kind: pa.DataType, ddl: str) -> DataFrame:
    known = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in rows]))
    df = dict.fromkeys(known.tolist(), 0)
    df |= {r["term"]: r["df"] for r in index.select("terms").mapInArrow(_document_counts(known), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    queries = Queries([r["item_id"] for r in rows], [r["terms"] for r in rows], weight)
    hits = index.mapInArrow(_search(queries, n, total, k, kind), f"item_id {ddl}, doc_id long, score long, rescored long")
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score", "rescored")
