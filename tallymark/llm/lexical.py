"""Ranked lexical search over range-maximum tables of posting lists.

Documents are counted once, into the occurrences of the terms that the items ask for. What a task holds of them is cut to
shards. In a shard every term has a posting list, in the order of the documents, and over it a sparse table that names
the posting of largest impact in any range with two looks. An item is searched best first: an interval of documents can
score no more than the sum of its terms' largest impacts there. The interval with the largest bound is split at the document
with the largest impact, that document is scored, and both sides get bounds of their own, until no bound beats the k-th
document found. Intervals of few postings are scored whole. Nothing is skipped that could be among the k best, so the
result is exact, ties included.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; A-Z are lower-cased.

Null and empty texts have no term. Every row of either table counts: repeated rows rank one after another, an item that
occurs twice is answered twice. Equal scores rank by ascending id, null ids last. Empty tables give no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymark.llm.frames import slices
from tallymark.sources.scope import checkpointed

#: Bytes of the items' texts, and items, that are searched in one go; more take further goes over the documents.
ITEM_BYTES, ITEMS = 1 << 24, 1 << 14
#: A shard ends at so many documents or postings.
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 20
#: Intervals of so few postings are scored whole.
LEAF = 1024

_LOWER = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time, so that a very long text is never a list as a whole."""
    at = 0
    while at < len(text):
        end = at + step
        while end < len(text) and _LOWER[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_LOWER).split()
        at = end


def counted(docs: DataFrame, ids: dict[bytes, int], *, key: str, text: str) -> DataFrame:
    """``id, n, terms, tfs`` of every row: all its terms counted, and those in ``ids`` with their occurrences."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(ids)  # bounded by ITEM_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in slices(batches, "text"):
            n, terms, tfs = [], [], []
            for body in batch.column("text").cast(pa.binary()).to_pylist():
                seen: Counter[bytes] = Counter()
                total = 0
                for part in terms_of(body or b""):
                    total += len(part)
                    seen.update(part)
                asked = [t for t in seen if t in number]
                n.append(total)
                terms.append([number[t] for t in asked])
                tfs.append([seen[t] for t in asked])
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, StructType([rows.schema["id"], *StructType.fromDDL("n long, terms array<int>, tfs array<int>")]))


class Shard:
    """Posting lists of some documents with their range-maximum tables.

    ``docs`` and ``lists`` name document and term of each posting, ``impacts`` is its impact without the term's weight.
    Lists lie one after another, the longest first, so that the levels of the tables that only long lists need are short.
    """

    def __init__(self, n_docs: int, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        sizes = np.bincount(terms, minlength=n_terms)
        longest = np.argsort(-sizes, kind="stable")
        self.list_of = np.empty(n_terms, np.int64)
        self.list_of[longest] = np.arange(n_terms)
        self.sizes = sizes
        keys = self.list_of[terms] * n_docs + docs
        order = np.argsort(keys, kind="stable")
        self._n_docs, self._keys = n_docs, keys[order]
        self._docs, self._impacts = docs[order], impacts[order]
        sizes = sizes[longest]
        self._ends = np.concatenate([[0], np.cumsum(sizes)])
        self._log = np.zeros(max(int(sizes[0]) if n_terms else 0, 1) + 1, np.int64)
        for i in range(1, int(self._log.size).bit_length()):
            self._log[1 << i :] = i
        levels, starts = [np.arange(len(order), dtype=np.int32)], [0]
        for level in range(1, int(self._log[-1]) + 1):
            half, below = 1 << (level - 1), levels[-1]
            covered = int(sizes[sizes >= 2 * half].sum())
            left = below[:covered]
            right = below[np.minimum(np.arange(half, half + covered), len(below) - 1)]
            starts.append(starts[-1] + len(below))
            levels.append(np.where(self._impacts[left] >= self._impacts[right], left, right))
        self._table, self._starts = np.concatenate(levels), np.array(starts)

    def peaks(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The posting of largest impact in each range of postings of one list (none is empty)."""
        level = self._log[end - start]
        at = self._starts[level]
        left, right = self._table[at + start], self._table[at + end - (1 << level)]
        return np.where(self._impacts[left] >= self._impacts[right], left, right)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, leaf: int = LEAF) -> list[tuple[int, int]]:
        """The ``k`` best documents (score above 0) as (score, document), best first, ties by the smaller document."""
        there = self.sizes[terms] > 0
        lists, weights = self.list_of[terms[there]], weights[there]
        found: list[tuple[int, int]] = []  # a heap of (score, -document), the worst first
        waiting: list[tuple] = []

        def offer(score: int, doc: int) -> None:
            if score > 0 and (len(found) < k or (score, -doc) > found[0]):
                (heapq.heappush if len(found) < k else heapq.heapreplace)(found, (score, -doc))

        def add(low: int, high: int, lists: np.ndarray, weights: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
            some = end > start
            if not some.all():
                lists, weights, start, end = lists[some], weights[some], start[some], end[some]
            if len(lists):
                peaks = self.peaks(start, end)
                most = weights * self._impacts[peaks]
                bound = int(most.sum())
                if bound > 0 and (len(found) < k or (bound, -low) > found[0]):
                    split = int(self._docs[peaks[int(most.argmax())]])
                    heapq.heappush(waiting, (-bound, low, high, split, lists, weights, start, end))

        add(0, self._n_docs, lists, weights, self._ends[lists], self._ends[lists + 1])
        while waiting and k > 0:
            bound, low, high, split, lists, weights, start, end = heapq.heappop(waiting)
            if len(found) == k and (-bound, -low) <= found[0]:
                break
            sizes = end - start
            total = int(sizes.sum())
            if total <= leaf:
                at = np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
                scores = np.bincount(self._docs[at] - low, np.repeat(weights, sizes) * self._impacts[at])  # below 2^53
                some = np.flatnonzero(scores >= (found[0][0] if len(found) == k else 1))
                if len(some) > k:
                    some = some[np.lexsort((some, -scores[some]))[:k]]
                for doc in some.tolist():
                    offer(int(scores[doc]), doc + low)
                continue
            middle = np.searchsorted(self._keys, lists * self._n_docs + split)
            holds = (middle < end) & (self._docs[np.minimum(middle, end - 1)] == split)
            offer(int((weights[holds] * self._impacts[middle[holds]]).sum()), split)
            add(low, split, lists, weights, start, middle)
            add(split + 1, high, lists, weights, middle + holds, end)
        return [(score, -doc) for score, doc in sorted(found, reverse=True)]


def _shards(batches: Iterator[pa.RecordBatch], docs: int, postings: int) -> Iterator[pa.Table]:
    """Rows of a task, put together to shards."""
    held, n_docs, n_postings = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        at, before = 0, 0
        while at < batch.num_rows:
            room = np.searchsorted(ends, before + postings - n_postings, "right")
            end = int(min(max(room, at + (not n_docs)), at + docs - n_docs, batch.num_rows))
            if end > at:
                held.append(batch.slice(at, end - at))
                n_docs, n_postings = n_docs + end - at, n_postings + int(ends[end - 1]) - before
                at, before = end, int(ends[end - 1])
            if at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, n_docs, n_postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _best(
    rows: DataFrame, items: Sequence[tuple[int, list[int]]], weights: Sequence[int], n: int, length: int, k: int,
    shard_docs: int, shard_postings: int,
) -> DataFrame:
    """``item, id, score``: the ``k`` best of each shard for each item."""
    about = rows.sparkSession.sparkContext.broadcast(
        ([(i, np.array(t, np.int64)) for i, t in items], np.array(weights, np.int64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = about.value
        for table in _shards(batches, shard_docs, shard_postings):
            table = table.take(pc.sort_indices(table, [("id", "ascending")], null_placement="at_end")).combine_chunks()
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            terms, tfs = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, tfs))
            spread = 10 + 90 * table.column("n").to_numpy().astype(np.int64) * n // length
            impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * spread[doc])
            shard = Shard(len(sizes), doc, terms, impacts, len(weight))
            found = [(i, *hit) for i, asked in items for hit in shard.search(asked, weight[asked], k)]
            if found:
                item, score, doc = (np.array(c, np.int64) for c in zip(*found, strict=True))
                ids = table.column("id").combine_chunks().take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(item), ids, pa.array(score)], ["item", "id", "score"])

    return rows.mapInArrow(run, StructType([StructField("item", LongType()), rows.schema["id"], StructField("score", LongType())]))


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that score highest for each item.

    A term held by ``df`` of the ``N`` documents with terms weighs ``floor(1000 ln((2N + 2) / (2df + 1)))``; times
    ``10^9 tf div (1000 tf + 8m)``, with ``m = 10 + 90 n N div L`` for a document of ``n`` terms where all have ``L``, summed
    over the terms of an item, once each. Documents of score 0 are not listed.
    """
    asked = items.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    asked = checkpointed(asked.withColumn("item", F.monotonically_increasing_id()))
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    goes = max(1, -(-size["n"] // ITEMS), -(-size["bytes"] // item_bytes))
    found = None
    for go in range(goes):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(goes)) == go)
        hits = _search(docs, part.select("item", "text").collect(), k, key, text, shard_docs, shard_postings)
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def _search(docs: DataFrame, asked: Sequence, k: int, key: str, text: str, shard_docs: int, shard_postings: int) -> DataFrame:
    """``item, id, score`` of the candidates for some items, whose size is bounded."""
    ids: dict[bytes, int] = {}
    numbered = []
    for row in asked:
        terms = {t: None for part in terms_of((row["text"] or "").encode()) for t in part}
        numbered.append((row["item"], [ids.setdefault(t, len(ids)) for t in terms]))
    rows = checkpointed(counted(docs, ids, key=key, text=text))
    total = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the items
    held = {r["term"]: r["count"] for r in held}
    weights = [math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(ids))]
    return _best(rows, numbered, weights, total["n"], max(total["length"], 1), k, shard_docs, shard_postings)
