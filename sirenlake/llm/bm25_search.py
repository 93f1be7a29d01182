"""Exact top-k search: BM25 over sharded inverted indexes with block-max pruning.

Document counts, lengths and frequencies of terms are global, so scores do not depend on the sharding.
Documents are dealt to shards by a hash. A task reads a shard's documents and writes its postings, sorted by
term and document, as a row of an index table. Queries are dealt to groups; a task reads the whole table, shard by
shard, for one group, so queries are never copied per shard. Per shard it takes the largest impact per term and block
of documents and searches some queries at a time: the sum of a query's block maxima bounds the scores in a block; blocks
are scored in falling order of their bound, in groups that grow, until the bound lies below the k-th best score so far,
which rises from group to group and from shard to shard.
WAND's pivoting document by document inside a block is replaced by scoring the block at once: the impacts of a
shard's most frequent terms are a matrix, multiplied by the weights of all queries that still want the block, and
rarer terms add their postings. These sums are rounded to single precision; every document whose sum could reach the
k-th best within the error of rounding is scored again in double precision, term by term. The best k of every shard
merge to the exact best k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage, scratch_path

from .common import NO_LETTER, Words, pieces
from .sentencepiece_scan import ragged

K1, B = 1.2, 0.75
SHARD_DOCS = 16384
BLOCK = 512
STEP = 1 << 15
CHUNK = 1 << 19  # postings sorted at once
PART = 64  # terms of a query in one row, which keeps batches of rows small
TEXT_BYTES = 1 << 18  # text parsed at once
HELD = 1 << 20  # terms whose documents a task counts at once
DENSE = 512  # most frequent terms of a shard that are held as a matrix at most
RARE = 32  # a term is frequent if more than one in so many documents has it
TOGETHER, TOGETHER_TERMS = 64, 1 << 18  # queries searched at once, and their terms
GROWTH = 8  # the first group has one in so many blocks, the next ones so many times as many
LOOKUP = 8  # looking a posting up costs as much as reading so many
PAIRS = 1 << 17  # postings looked up at once
MOST_DOCS, MOST_POSTINGS = 1 << 16, 1 << 23  # of an index
GROUPS, GROUP_TERMS = 64, (1 << 18, 1 << 20)  # groups of queries, unless a group then has fewer or more terms than these


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, term) pairs in order, their counts, and the terms of each document."""
    words = Words(data, offsets, gaps=NO_LETTER)
    order = np.lexsort((words.hashes, words.doc))
    term, doc = words.hashes[order].view(np.int64), words.doc[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], term[first], np.diff(np.append(first, len(term))), words.count


class Postings:
    """Postings of a shard in the making: chunks of documents, each sorted by term, so a term is held once per chunk."""

    def __init__(self):
        self.chunks: list[tuple[np.ndarray, ...]] = []
        self.open: list[tuple[np.ndarray, ...]] = []
        self.held = self.size = 0

    def add(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Postings of documents that follow those before."""
        self.open.append((doc.astype(np.int32), term, tf.astype(np.min_scalar_type(int(tf.max(initial=0))))))
        self.held += len(term)
        self.size += len(term)
        if self.held >= CHUNK:
            self.close()

    def close(self) -> None:
        if not self.held:
            return
        doc, term, tf = (np.concatenate(c) for c in zip(*self.open))
        self.open, self.held = [], 0
        order = np.argsort(term, kind="stable")
        term = term[order]
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.chunks.append((term[first], np.diff(np.append(first, len(term))), doc[order], tf[order]))

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms, postings per term, and documents and counts by term, then document; the chunks are freed on the way."""
        self.close()
        terms = np.zeros(0, np.int64)
        for part in self.chunks:
            terms = np.union1d(terms, part[0])
        count = np.zeros(len(terms), np.int64)
        for part in self.chunks:
            count[np.searchsorted(terms, part[0])] += part[1]
        to = np.cumsum(count) - count  # where a term's next posting goes
        doc = np.zeros(int(count.sum()), np.int32)
        tf = np.zeros(len(doc), np.result_type(np.uint8, *(part[3].dtype for part in self.chunks)))
        self.chunks.reverse()
        while self.chunks:
            term, n, docs, tfs = self.chunks.pop()
            rows = np.searchsorted(terms, term)
            at = ragged(to[rows], n)
            doc[at], tf[at] = docs, tfs
            to[rows] += n
        return terms, count, doc, tf


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Length-normalised impacts."""
    tf = tf.astype(np.float64)
    return tf * ((K1 + 1) / (tf + norm))


def norms(length: np.ndarray, average: float) -> np.ndarray:
    return K1 * (1 - B + B * length / average)


PACKED = {"ids": np.int64, "length": np.int64, "terms": np.int64, "count": np.int32, "doc": np.uint16, "tf": None}
RISING = ("ids", "terms", "doc")  # mostly, so their differences are kept


def packed(ids: np.ndarray, postings: Postings, length: np.ndarray) -> dict[str, bytes]:
    """What an index is made of, compressed: its row in a table is read for every group of queries."""
    terms, count, doc, tf = postings.merged()
    parts = {"ids": ids, "length": length, "terms": terms, "count": count, "doc": doc, "tf": tf}
    del terms, count, doc, tf
    codec, out = pa.Codec("zstd", compression_level=1), {}
    for name, kind in PACKED.items():
        values = parts.pop(name)
        values = values.astype(kind or values.dtype, copy=False)
        if name in RISING:
            values = np.diff(values, prepend=values.dtype.type(0))  # wraps around, as the sums do
        out[name] = np.array([values.itemsize, len(values)]).tobytes() + codec.compress(values.tobytes(), asbytes=True)
    return out


def unpack(row: dict[str, memoryview]) -> dict[str, np.ndarray]:
    codec, parts = pa.Codec("zstd"), {}
    for name, kind in PACKED.items():
        size, n = np.frombuffer(row[name][:16], np.int64).tolist()
        values = np.frombuffer(codec.decompress(row[name][16:], size * n), kind or f"u{size}")
        parts[name] = np.cumsum(values, dtype=values.dtype) if name in RISING else values
    return parts


class Query(NamedTuple):
    """What a shard has of a query."""

    rows: np.ndarray  # terms, in order
    weight: np.ndarray
    column: np.ndarray  # of frequent terms, else -1
    rare: np.ndarray  # places of the other terms in ``rows``
    cells: np.ndarray  # cells of the other terms
    cell_weight: np.ndarray


class ShardIndex:
    """Postings of a shard by term, then document: documents, counts and impacts in single precision.

    A cell is a term in a block of documents; only cells with a posting exist, with their largest impact.
    The most frequent terms have a column of impacts by document besides.
    """

    def __init__(self, ids: np.ndarray, postings: Postings, length: np.ndarray, average: float):
        self._index(ids, *postings.merged(), norms(length, average))

    @classmethod
    def unpacked(cls, parts: dict[str, np.ndarray], average: float) -> ShardIndex:
        """The index of what ``packed`` wrote."""
        self = cls.__new__(cls)
        self._index(*(parts[name] for name in ("ids", "terms", "count", "doc", "tf")), norms(parts["length"], average))
        return self

    def _index(self, ids: np.ndarray, terms: np.ndarray, count: np.ndarray, doc: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> None:
        self.ids, self.terms, self.doc, self.tf, self.norm = ids, terms, doc, tf, norm
        self.blocks = max(1, math.ceil(len(self.ids) / BLOCK))
        block = self.doc // BLOCK
        new = np.ones(len(block), bool)
        new[1:] = block[1:] != block[:-1]
        new[np.cumsum(count) - count] = True
        cell = np.flatnonzero(new).astype(np.int32 if len(new) < 1 << 31 else np.int64)
        self.start = np.append(cell, cell.dtype.type(len(new)))  # postings by cell
        self.block = block[cell]
        self.first = np.searchsorted(cell, np.append(0, np.cumsum(count)))  # cells by term
        del block, new, cell
        self.impact = np.zeros(len(tf), np.float32)
        for low in range(0, len(tf), STEP):  # keep the intermediate arrays small
            part = slice(low, low + STEP)
            self.impact[part] = impacts(tf[part], self.norm[self.doc[part]])
        cell = self.start[:-1]
        most = np.maximum.reduceat(self.impact, cell) if len(cell) else self.impact
        self.most = np.nextafter(most, np.float32(np.inf))
        self.place = np.full(len(ids), -1, np.int32)  # where a document is among those that are scored exactly
        self._fill(count)

    def _fill(self, count: np.ndarray) -> None:
        """Impacts of the most frequent terms by document."""
        often = np.flatnonzero(count * RARE > len(self.ids))
        if len(often) > DENSE:
            often = np.sort(often[np.argsort(-count[often], kind="stable")[:DENSE]])
        self.column = np.full(len(self.terms), -1, np.int16)
        self.column[often] = np.arange(len(often))
        self.matrix = np.zeros((len(self.ids), len(often)), np.float32)
        self.most_often = np.zeros((len(often), self.blocks))
        for column, row in enumerate(often):
            cells = slice(self.first[row], self.first[row + 1])
            at = slice(self.start[cells.start], self.start[cells.stop])
            self.matrix[self.doc[at], column] = self.impact[at]
            self.most_often[column, self.block[cells]] = self.most[cells]
        # single precision rounds an impact, a weight, their product and every sum
        self.error = (len(often) + 8) * 2.0**-23

    def _rare(self, query: Query, chosen: np.ndarray) -> np.ndarray:
        """What the terms that are not frequent add to the scores, by block, complete in the ``chosen`` blocks."""
        if 2 * chosen.sum() > self.blocks:  # whole terms are faster than many cells
            rows, weight = query.rows[query.rare], query.weight[query.rare]
            first = self.start[self.first[rows]]
            count = self.start[self.first[rows + 1]] - first
        else:
            some = chosen[self.block[query.cells]]
            cells, weight = query.cells[some], query.cell_weight[some]
            first = self.start[cells]
            count = self.start[cells + 1] - first
        at = ragged(first, count)
        return np.bincount(self.doc[at], self.impact[at] * np.repeat(weight, count), self.blocks * BLOCK).reshape(self.blocks, BLOCK)

    def _exact(self, asked: list[Query], docs: list[np.ndarray]) -> list[np.ndarray]:
        """Scores of some documents of each query in double precision, summed in the order of the terms."""
        out, some, pairs = [np.zeros(0)] * len(asked), [], 0
        for i, (query, doc) in enumerate(zip(asked, docs)):
            first = self.start[self.first[query.rows]]
            count = self.start[self.first[query.rows + 1]] - first
            if len(doc) * len(query.rows) * LOOKUP > count.sum():  # reading all postings of the terms is faster
                self.place[doc] = np.arange(len(doc))
                at = ragged(first, count)
                place = self.place[self.doc[at]]
                self.place[doc] = -1
                has = place >= 0
                at, place = at[has], place[has]
                out[i] = np.bincount(place, impacts(self.tf[at], self.norm[doc[place]]) * np.repeat(query.weight, count)[has], len(doc))
                continue
            some.append(i)
            pairs += len(doc) * len(query.rows)
            if pairs > PAIRS:
                self._look_up(asked, docs, some, out)
                some, pairs = [], 0
        self._look_up(asked, docs, some, out)
        return out

    def _look_up(self, asked: list[Query], docs: list[np.ndarray], some: list[int], out: list[np.ndarray]) -> None:
        """Exact scores of a few documents of ``some`` queries, each posting found by halving its term's list."""
        if not some:
            return
        doc = np.concatenate([np.repeat(docs[i], len(asked[i].rows)) for i in some])
        row, weight = (np.concatenate([np.tile(asked[i][part], len(docs[i])) for i in some]) for part in (0, 1))
        of = np.repeat(np.arange(sum(len(docs[i]) for i in some)), np.concatenate([np.full(len(docs[i]), len(asked[i].rows)) for i in some]))
        low, end = self.start[self.first[row]], self.start[self.first[row + 1]]
        high = end.copy()
        for _ in range(int((end - low).max(initial=0)).bit_length()):
            middle = low + ((high - low) >> 1)
            less = (low < high) & (self.doc[np.minimum(middle, end - 1)] < doc)
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        has = np.flatnonzero(low < end)
        has = has[self.doc[low[has]] == doc[has]]
        score = np.bincount(of[has], impacts(self.tf[low[has]], self.norm[doc[has]]) * weight[has], of[-1] + 1 if len(of) else 0)
        for i, part in zip(some, np.split(score, np.cumsum([len(docs[i]) for i in some])[:-1])):
            out[i] = part

    def _query(self, terms: np.ndarray, weight: np.ndarray) -> Query:
        """The query's terms that the shard has: rows, weights, columns of frequent ones, cells of the others."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        has = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        rows, weight = at[has], weight[has]
        column = self.column[rows]
        rare = np.flatnonzero(column < 0)
        count = self.first[rows[rare] + 1] - self.first[rows[rare]]
        return Query(rows, weight, column, rare, ragged(self.first[rows[rare]], count), np.repeat(weight[rare], count))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, least: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (its terms in order and their weights) ids and scores of the best k documents that share a term, ties to smaller ids.

        ``least`` has a score per query below which documents need not be returned.
        """
        asked = [self._query(*q) for q in queries]
        weight = np.zeros((len(asked), len(self.most_often)))
        bound = np.zeros((len(asked), self.blocks))
        for i, q in enumerate(asked):
            often = q.column >= 0
            weight[i, q.column[often]] = q.weight[often]
            bound[i] = np.bincount(self.block[q.cells], q.cell_weight * self.most[q.cells], self.blocks)
        bound = (bound + weight @ self.most_often) * (1 + 1e-6)
        weight = weight.astype(np.float32)
        score = np.zeros((len(asked), self.blocks, BLOCK), np.float32)  # stays 0 in blocks that are left out
        best = np.zeros((len(asked), k), np.float32)
        least = np.zeros(len(asked)) if least is None else least * (1 - self.error)
        floor = least  # at most the k-th best score
        order, done, step = np.argsort(-bound.sum(axis=0), kind="stable"), 0, max(1, self.blocks // GROWTH)
        while done < self.blocks:
            group = order[done : done + step]
            wanted = np.zeros(bound.shape, bool)  # the floor rises from group to group
            wanted[:, group] = (bound[:, group] > 0) & (bound[:, group] >= floor[:, None])
            for i in np.flatnonzero(wanted.any(axis=1)):
                score[i, wanted[i]] = self._rare(asked[i], wanted[i])[wanted[i]]
            done, step = done + step, step * GROWTH
            for block in group:
                has = np.flatnonzero(wanted[:, block])
                docs = self.matrix[block * BLOCK : (block + 1) * BLOCK]
                score[has, block, : len(docs)] += weight[has] @ docs.T
                if done < self.blocks:
                    both = np.concatenate([best[has], score[has, block]], axis=1)
                    best[has] = np.partition(both, BLOCK, axis=1)[:, BLOCK:]
            floor = np.maximum(least, best.min(axis=1, initial=np.inf).astype(np.float64) * (1 - self.error))
        score = score.reshape(len(asked), -1)[:, : len(self.ids)]
        docs = [self._reaching(score[i], floor[i], k) for i in range(len(asked))]
        return [self._best(doc, exact, k) for doc, exact in zip(docs, self._exact(asked, docs))]

    def _reaching(self, score: np.ndarray, floor: float, k: int) -> np.ndarray:
        """Documents whose rounded ``score`` lets them reach ``floor`` and the k-th best."""
        doc = np.flatnonzero((score > 0) & (score >= floor * (1 - 2 * self.error)))
        if len(doc) > k:
            near = score[doc].astype(np.float64)
            doc = doc[near * (1 + self.error) >= np.partition(near, len(doc) - k)[len(doc) - k] * (1 - self.error)]
        return doc

    def _best(self, doc: np.ndarray, exact: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(doc) > k:
            keep = exact >= np.partition(exact, len(exact) - k)[len(exact) - k]
            doc, exact = doc[keep], exact[keep]
        order = np.lexsort((self.ids[doc], -exact))[:k]
        return self.ids[doc[order]], exact[order]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, summed in the task for up to HELD terms at once, and the task's documents and words."""
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64()), ("docs", pa.int64()), ("length", pa.int64())])
    terms, df, docs, length = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0

    def rows() -> pa.RecordBatch:
        none = pa.nulls(len(terms), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df), none, none], schema=schema)

    for batch in batches:
        for row, end, data, offsets in pieces(batch, limit=TEXT_BYTES):
            _, term, _, count = term_counts(data, offsets)
            docs, length = docs + end - row, length + int(count.sum())
            new, times = np.unique(term, return_counts=True)
            terms, where = np.unique(np.concatenate([terms, new]), return_inverse=True)
            df = np.bincount(where, np.concatenate([df, times]), len(terms)).astype(np.int64)
            if len(terms) > HELD:
                yield rows()
                terms, df = terms[:0], df[:0]
    yield rows()
    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (None, None, docs, length)], schema=schema)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for row, _, data, offsets in pieces(batch, limit=TEXT_BYTES):
            doc, term, _, _ = term_counts(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row + doc]), pa.array(term)], ["query_id", "term"])


class Group:
    """Queries that are searched together in one shard after the other, and the best k documents of each so far."""

    def __init__(self, row: dict[str, memoryview], k: int):
        self.ids, count, terms, weights = (np.frombuffer(row[name], kind) for name, kind in ASKED.items())
        cuts = np.cumsum(count)[:-1]
        self.queries = list(zip(np.split(terms, cuts), np.split(weights, cuts)))
        self.k, self.least = k, np.zeros(len(self.ids))  # the k-th best score so far
        self.best = [(np.zeros(0, np.int64), np.zeros(0))] * len(self.ids)
        size = np.cumsum(count, dtype=np.int64) // TOGETHER_TERMS
        self.cuts = [0]
        for i in range(1, len(self.ids)):
            if i - self.cuts[-1] >= TOGETHER or size[i] != size[i - 1]:
                self.cuts.append(i)
        self.cuts.append(len(self.ids))

    def search(self, index: ShardIndex) -> None:
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            for i, (doc, score) in enumerate(index.search(self.queries[a:b], self.k, self.least[a:b]), a):
                if not len(doc):
                    continue
                doc, score = (np.concatenate(c) for c in zip(self.best[i], (doc, score)))
                order = np.lexsort((doc, -score))[: self.k]
                self.best[i] = doc[order], score[order]
                if len(order) == self.k:
                    self.least[i] = score[order[-1]]

    def found(self) -> pa.RecordBatch:
        count = np.array([len(doc) for doc, _ in self.best], np.int64)
        doc, score = (np.concatenate([b[i] for b in self.best]) for i in (0, 1))
        rank = (ragged(np.zeros_like(count), count) + 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (np.repeat(self.ids, count), rank, doc, score)], ["query_id", "rank", "doc_id", "score"])


ASKED = {"query_ids": np.int64, "sizes": np.int64, "query_terms": np.int64, "query_weights": np.float64}


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard; a shard of very many documents or postings gives several, each an index of its own."""
    ids, postings, lengths, held, shard = [], Postings(), [], 0, None

    def row() -> pa.RecordBatch:
        parts = packed(np.concatenate(ids), postings, np.concatenate(lengths))
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in parts.values()], list(parts))

    for batch in batches:
        shards, doc_ids = batch.column("shard").to_numpy(), batch.column("doc_id").to_numpy()
        for low, end, data, offsets in pieces(batch, limit=TEXT_BYTES):
            doc, term, tf, length = term_counts(data, offsets)
            cuts = [0, *(np.flatnonzero(np.diff(shards[low:end])) + 1), end - low]
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = slice(*np.searchsorted(doc, [a, b]))
                if ids and (shards[low + a] != shard or held + b - a > MOST_DOCS or postings.size + some.stop - some.start > MOST_POSTINGS):
                    yield row()
                    ids, postings, lengths, held = [], Postings(), [], 0
                shard = shards[low + a]
                ids.append(doc_ids[low + a : low + b])
                postings.add(doc[some] - a + held, term[some], tf[some])
                lengths.append(length[a:b])
                held += b - a
    if ids:
        yield row()


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with all queries of the task: their ids, how many terms each has, and terms and weights in order of the terms."""
    rows, group = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, terms, weights = batch.column("group")[:1], batch.column("terms"), batch.column("weights")
        rows.append((np.repeat(batch.column("query_id").to_numpy(), np.diff(terms.offsets.to_numpy())), terms.flatten().to_numpy(), weights.flatten().to_numpy()))
    if not rows:
        return
    query, term, weight = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((term, query))
    ids, count = np.unique(query, return_counts=True)
    values = [v.astype(kind, copy=False).tobytes() for v, kind in zip((ids, count, term[order], weight[order]), ASKED.values())]
    yield pa.RecordBatch.from_arrays([group, *(pa.array([v], pa.binary()) for v in values)], ["group", *ASKED])


def _searcher(average: float, k: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[bytes, Group] = {}  # one, as long as every group has its own task
        for batch in rows:
            for i in range(batch.num_rows):
                row = {name: memoryview(batch.column(name)[i].as_buffer()) for name in (*PACKED, *ASKED)}
                key = bytes(row["query_ids"][:8])
                if key not in groups:
                    groups[key] = Group({name: bytes(row[name]) for name in ASKED}, k)
                parts = unpack(row)
                del row
                groups[key].search(ShardIndex.unpacked(parts, average))
                del parts
            batch = None  # before the next one comes
        for group in groups.values():
            yield group.found()

    return batches


def top_documents(docs: DataFrame, queries: DataFrame, k: int = 10, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``query_id``, ``rank``, ``doc_id``, ``score``: the best k documents of every query.

    Both tables have ``doc_id`` and ``text``; a query is the set of words (letters and digits, A-Z
    lower-cased) of its whole text. Documents without a common word are not returned, so NULL and empty
    texts neither find nor are found. Ties go to smaller ids. NULL ids are left out. Repeated documents are
    documents of their own; repeated queries count once. Empty tables give empty results.
    """
    spark = docs.sparkSession
    docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    counts = cut_lineage(docs.mapInArrow(_frequencies, "term long, df long, docs long, length long"))
    total = counts.agg(F.sum("docs").alias("docs"), F.sum("length").alias("length")).first()
    n, average = total["docs"] or 0, (total["length"] or 0) / max(total["docs"] or 0, 1)
    df = counts.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"))
    wanted = queries.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(_query_terms, "query_id long, term long").distinct()
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    vectors = wanted.join(df, "term").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("w")))).alias("t"))
    parts = F.transform(F.sequence(F.lit(1), F.size("t"), F.lit(PART)), lambda i: F.slice("t", i, PART))
    vectors = vectors.select("query_id", F.explode(parts).alias("t"))
    vectors = cut_lineage(vectors.select("query_id", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")))
    terms = vectors.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, math.ceil(terms / min(max(terms / GROUPS, GROUP_TERMS[0]), GROUP_TERMS[1])))
    asked = vectors.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).repartitionById(groups, F.col("group"))
    asked = asked.mapInArrow(_grouped, ", ".join(["group int", *(f"{name} binary" for name in ASKED)]))
    asked_path, index_path, found_path = (scratch_path(spark, name) for name in ("queries", "index", "found"))
    asked.write.parquet(asked_path)
    shards = max(1, math.ceil(n / shard_docs))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), "doc_id", "text").repartitionById(shards, F.col("shard"))
    index = dealt.mapInArrow(_indexer, ", ".join(f"{name} binary" for name in PACKED))
    index.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(index_path)  # readers load all rows of a file at once
    # Every task reads the whole index from its table, shard by shard, for one group of queries; nothing is written for the pairs.
    # A session of its own hands the large rows to Python one by one and leaves the caller's settings alone.
    apart = spark.newSession()
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    every = apart.read.schema(index.schema).parquet(index_path).coalesce(1)
    alone = apart.read.schema(asked.schema).parquet(asked_path).repartitionById(groups, F.col("group")).drop("group")
    pairs = every.hint("shuffle_replicate_nl").crossJoin(alone)
    found = pairs.mapInArrow(_searcher(average, k), "query_id long, rank int, doc_id long, score double")
    found.write.parquet(found_path)
    return spark.read.schema(found.schema).parquet(found_path)
