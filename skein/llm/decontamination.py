"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

The test items are indexed, and every passage of every training document is a
query. A passage is two neighbouring segments of a text; segments are as long as
the longest item of the index, so an item that stands in a text stands whole in
some passage. BM25 weights are divided by the item's score against itself: 1
means that a passage has all of an item's terms, and one threshold fits items of
any length.

Items are numbered in blocks. Each posting list has its greatest weight in each
block, and

1. :meth:`Index.hopeful` bounds all passages of a batch at once: the block
   maxima of a passage's rare terms, plus all that frequent terms could add,
   must reach the threshold in some block, or no item of it can;
2. :meth:`Index.retrieve` walks the posting lists for the passages that are left
   (block-max WAND): the pivot is where the list maxima reach the threshold, the
   block maxima decide whether its block is worth a score, and lists move past
   blocks that are not;
3. what scores at least the threshold is verified on the words themselves: the
   share of the question's, and of the answer's, n-grams that the passage has.

The index is built in shards of ``SHARD_TERMS`` terms of items, and each shard is
broadcast and queried in turn, so what is sent to the executors has a fixed bound
whatever the benchmark's size. Document frequencies, mean length and the longest
item are those of the whole benchmark, counted before (on the driver, 16 bytes a
different term), so an item scores the same in any shard. Documents are never
shuffled.

Defined cases: null or empty texts match nothing; items without terms match
nothing; equal items are all reported; rows of equal id report the same pairs
once, the best passage of each (ties: the later one); texts and items of any length
are searched whole; an empty benchmark or table gives no rows.
"""

from __future__ import annotations


from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.textarrays import NOT_TERM, Texts, grams, owners, slices
from skein.llm.workers import map_batches, tidy

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
NGRAM = 5
#: Items in a block: small, as bounds over whole batches are cheap and walks are not.
BLOCK = 2
#: Cells of the table of bounds that is held at once.
BOUND_CELLS = 4_000_000
#: Terms of items in a shard, with repeats: about 100 MB of index at most.
SHARD_TERMS = 1_000_000
LEAST_SEGMENT = 32

_U = np.uint64


def terms(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of texts (runs of letters and digits, lower case), and bounds by text."""
    lowered = Texts(pc.utf8_lower(array.cast(pa.large_string())))
    starts, ends, bounds = lowered.spans(NOT_TERM)
    return lowered.span_hash(starts, ends), bounds


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's first line is its question, the rest its answer; with one line, its first and its other sentences.

    An item of one sentence is both.
    """
    for mark in ("\n", ". ", "? "):
        head, cut, tail = text.strip().partition(mark)
        if cut and tail.strip():
            return head, tail
    return text, text


class Statistics:
    """Of all items: ``n``, ``total`` and ``longest`` terms, and how many items have each of ``vocabulary``."""

    def __init__(self):
        self.n = self.total = self.longest = 0
        self.vocabulary, self.df = np.zeros(0, _U), np.zeros(0, np.int64)

    def add(self, items: list[tuple[int, str]]) -> None:
        hashes, bounds = terms(pa.array([t for _, t in items], pa.large_string()))
        size = np.diff(bounds)
        self.n, self.total = self.n + len(items), self.total + int(size.sum())
        self.longest = max(self.longest, int(size.max(initial=0)))
        vocabulary, code = np.unique(hashes, return_inverse=True)
        pair = np.unique(code.astype(np.int64) * max(1, len(items)) + owners(bounds))
        df = np.bincount(pair // max(1, len(items)), minlength=len(vocabulary))
        both, code = np.unique(np.concatenate([self.vocabulary, vocabulary]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, code, np.concatenate([self.df, df]))
        self.vocabulary, self.df = both, total


class Index:
    """An inverted index of one shard of items; ``whole``: the statistics of all shards, by default of this one."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, whole: Statistics | None = None):
        self.threshold = threshold
        if whole is None:
            whole = Statistics()
            whole.add(items)
        hashes, bounds = terms(pa.array([t for _, t in items], pa.large_string()))
        self.ids = [i for i, _ in items]
        size = np.diff(bounds)
        self.segment = max(LEAST_SEGMENT, whole.longest)
        owner = owners(bounds)
        self.vocabulary, code = np.unique(hashes, return_inverse=True)
        n, v = len(items), len(self.vocabulary)
        pair, tf = np.unique(code.astype(np.int64) * n + owner, return_counts=True)
        term, item = pair // n, pair % n
        df = whole.df[np.searchsorted(whole.vocabulary, self.vocabulary)]
        idf = np.log(1 + (whole.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size[item] / max(1.0, whole.total / whole.n if whole.n else 1.0))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        own = np.bincount(item, weights=weight, minlength=n)
        weight = weight / np.where(own > 0, own, 1)[item]
        # posting lists by term, items ascending
        self.begin = np.searchsorted(term, np.arange(v + 1))
        self.item, self.weight = item, weight
        self.n_blocks = max(1, -(-n // BLOCK))
        block = item // BLOCK
        self.greatest = np.maximum.reduceat(weight, self.begin[:-1]) if v else np.zeros(0)
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if v else np.zeros(0, np.int64)
        self.block, self.block_weight = block[first], np.maximum.reduceat(weight, first) if v else np.zeros(0)
        self.block_begin = np.searchsorted(term[first], np.arange(v + 1))
        # frequent terms: those in most blocks, while together they stay far below the threshold in every block
        spread = np.diff(self.block_begin)
        dense = np.zeros(self.n_blocks)
        self.frequent = np.zeros(v, bool)
        for t in np.argsort(-spread, kind="stable"):
            a, b = self.block_begin[t], self.block_begin[t + 1]
            if spread[t] < 2:
                break
            dense[self.block[a:b]] += self.block_weight[a:b]
            if dense.max() > threshold / 2:
                dense[self.block[a:b]] -= self.block_weight[a:b]
                break
            self.frequent[t] = True
        self.dense = dense
        # a small table that tells most words apart from the vocabulary at once
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary & _U((1 << 20) - 1)).astype(np.int64)] = True
        # n-grams of questions and answers
        self.parts = [tuple(self._grams(x) for x in question_and_answer(t)) for _, t in items]

    @staticmethod
    def _grams(text: str) -> tuple[int, np.ndarray]:
        h, bounds = terms(pa.array([text], pa.large_string()))
        n = min(NGRAM, len(h))
        return n, np.unique(grams(h, owners(bounds), n)[0]) if n else np.zeros(0, _U)

    def codes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are in the vocabulary, and their term numbers."""
        at = np.flatnonzero(self.maybe[(hashes & _U((1 << 20) - 1)).astype(np.int64)])
        k = np.searchsorted(self.vocabulary, hashes[at])
        k[k == len(self.vocabulary)] = 0
        ok = self.vocabulary[k] == hashes[at] if len(self.vocabulary) else np.zeros(0, bool)
        return at[ok], k[ok]

    def hopeful(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Passages some block of which can reach the threshold; ``passage, term``: different pairs, sorted."""
        rare = ~self.frequent[term]
        passage, term = passage[rare], term[rare]
        if not len(passage):
            return passage
        out, step = [], max(1, BOUND_CELLS // self.n_blocks)
        who = np.unique(passage)
        for low in range(0, len(who), step):
            some = who[low : low + step]
            a, b = np.searchsorted(passage, [some[0], some[-1] + 1])
            t = term[a:b]
            row = np.searchsorted(some, passage[a:b])
            times = self.block_begin[t + 1] - self.block_begin[t]
            at = np.repeat(self.block_begin[t] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            cell = np.repeat(row, times) * self.n_blocks + self.block[at]
            bound = np.bincount(cell, weights=self.block_weight[at], minlength=len(some) * self.n_blocks).reshape(len(some), self.n_blocks)
            out.append(some[(bound + self.dense >= self.threshold - 1e-9).any(axis=1)])
        return np.concatenate(out)

    def retrieve(self, query: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose score for the different terms of ``query`` reaches the threshold."""
        theta = self.threshold - 1e-9
        end = [int(self.begin[t + 1]) for t in query]
        at = [int(self.begin[t]) for t in query]
        b_end = [int(self.block_begin[t + 1]) for t in query]
        b_at = [int(self.block_begin[t]) for t in query]
        top = [float(self.greatest[t]) for t in query]
        item, weight, block, block_weight = self.item, self.weight, self.block, self.block_weight
        out = []
        live = [k for k in range(len(query)) if at[k] < end[k]]

        def skip(k: int, to: int) -> None:
            at[k] += int(np.searchsorted(item[at[k] : end[k]], to))

        while live:
            live.sort(key=lambda k: item[at[k]])
            # the pivot: the first list with which the maxima reach the threshold
            total, p = 0.0, -1
            for j, k in enumerate(live):
                total += top[k]
                if total >= theta:
                    p = j
                    break
            if p < 0:
                break
            pivot = int(item[at[live[p]]])
            while p + 1 < len(live) and item[at[live[p + 1]]] == pivot:
                p += 1
            # the block maxima at the pivot's block
            b = pivot // BLOCK
            bound = 0.0
            for k in live[: p + 1]:
                j = b_at[k]
                while j < b_end[k] and block[j] < b:
                    j += 1
                b_at[k] = j
                if j < b_end[k] and block[j] == b:
                    bound += block_weight[j]
            if bound < theta:
                # no item of this block up to the next list's item can do it
                to = (b + 1) * BLOCK
                if p + 1 < len(live):
                    to = min(to, int(item[at[live[p + 1]]]))
                to = max(to, pivot + 1)
                for k in live[: p + 1]:
                    skip(k, to)
            elif item[at[live[0]]] == pivot:
                score = 0.0
                for k in live[: p + 1]:
                    if item[at[k]] == pivot:
                        score += float(weight[at[k]])
                        at[k] += 1
                if score >= theta:
                    out.append((pivot, score))
            else:
                for k in live[:p]:
                    if item[at[k]] < pivot:
                        skip(k, pivot)
            live = [k for k in live if at[k] < end[k]]
        return out

    def overlap(self, item: int, words: np.ndarray) -> tuple[float, float]:
        """The shares of the question's and the answer's n-grams among the words of a passage."""
        out = []
        for n, g in self.parts[item]:
            have = grams(words, np.zeros(len(words), np.int64), n)[0] if n else np.zeros(0, _U)
            out.append(float(np.isin(g, have).mean()) if len(g) else 0.0)
        return out[0], out[1]

    def search(self, array: pa.Array) -> list[tuple[int, int, float, float, float, int]]:
        """(text, item, score, question overlap, answer overlap, first word) of verified finds; the best passage of each pair."""
        hashes, bounds = terms(array)
        at, term = self.codes(hashes)
        if not len(at):
            return []
        owner = np.searchsorted(bounds, at, "right") - 1
        # segments, numbered through all texts; passage s is segments s and s + 1 of one text
        count = np.maximum(1, -(-np.diff(bounds) // self.segment))
        base = np.cumsum(count) - count
        seg = base[owner] + (at - bounds[owner]) // self.segment
        v = len(self.vocabulary)
        pairs = np.unique(seg * v + term)
        s, t = pairs // v, pairs % v
        seg_owner = np.repeat(np.arange(len(count)), count)
        seg_last = base[seg_owner] + count[seg_owner] - 1
        one = np.where(count[seg_owner[s]] > 1, np.minimum(s, seg_last[s] - 1), s)  # the passage that begins here, or the last
        two = np.maximum(s - 1, base[seg_owner[s]])  # and the one that ends here
        pairs = np.unique(np.concatenate([one * v + t, two * v + t]))
        passage, term = pairs // v, pairs % v
        best: dict[tuple[int, int], tuple] = {}
        for p in self.hopeful(passage, term).tolist():
            a, b = np.searchsorted(passage, [p, p + 1])
            d = int(seg_owner[p])
            begin = int(bounds[d]) + (p - int(base[d])) * self.segment
            words = hashes[begin : min(begin + 2 * self.segment, int(bounds[d + 1]))]
            for item, score in self.retrieve(term[a:b].tolist()):
                q, r = self.overlap(item, words)
                if q >= OVERLAP and r >= OVERLAP:
                    found = (round(score, 6), q, r, begin - int(bounds[d]))
                    best[d, item] = max(best.get((d, item), (0.0, 0.0, 0.0, 0)), found)
        return [(d, item, *x) for (d, item), x in sorted(best.items())]


def shards(benchmark: DataFrame, limit: int = SHARD_TERMS) -> Iterator[list[tuple[int, str]]]:
    """Items (item_id, text) in shards of a bounded number of terms, in order of id; streamed to the driver one by one."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    shard, size = [], 0
    for r in rows.where("text IS NOT NULL AND item_id IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        shard.append((r.item_id, r.text))
        size += len(r.text.split())
        if size >= limit:
            yield shard
            shard, size = [], 0
    if shard:
        yield shard


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD) -> Iterator[Index]:
    """The indexes of all shards, one by one; the benchmark is read twice."""
    whole = Statistics()
    for shard in shards(benchmark):
        whole.add(shard)
    for shard in shards(benchmark):
        yield Index(shard, threshold, whole)


_SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs of documents and test items, with the best passage's score and place."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = []
    for index in indexes(benchmark, threshold):
        shared = spark.sparkContext.broadcast(index)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    found = shared.value.search(part.column(1))
                    if found:
                        d, item, score, q, r, first = zip(*found)
                        ids = [shared.value.ids[i] for i in item]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(d)), pa.array(ids, pa.int64()), pa.array(score), pa.array(q), pa.array(r), pa.array(first, pa.int64())],
                            names=[x.split()[0] for x in _SCHEMA.split(", ")],
                        )

        parts.append(rows.transform(map_batches, run, _SCHEMA))
    found = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _SCHEMA)
    # few rows: one for each document and item
    best = F.max(F.struct("score", "question_overlap", "answer_overlap", "first_word")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item, unchanged; no shuffle."""
    spark = docs.sparkSession
    kept, place = docs, docs.columns.index("text")
    for index in indexes(benchmark, threshold):
        shared = spark.sparkContext.broadcast(index)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    keep = np.ones(part.num_rows, bool)
                    keep[[f[0] for f in shared.value.search(part.column(place))]] = False
                    yield part.filter(pa.array(keep))

        kept = kept.transform(map_batches, run, docs.schema)
    return kept
