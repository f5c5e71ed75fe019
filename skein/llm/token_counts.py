"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a piece of text form a linked list; a heap holds the adjacent
pairs whose join is in the vocabulary, by rank. The pair of lowest rank is
popped, merged if both ends are still there, and its new neighbours are pushed.
The count is the number of initial symbols less the merges; no ids are made. A
symbol that is not in the vocabulary counts as its UTF-8 bytes (byte fallback).

A text is first cut where no merge can ever reach across: between two characters
that stand side by side in no vocabulary entry. Pieces recur, so a worker keeps
the counts of up to ``MEMO_PIECES`` of them.

Defined cases: a null text counts as empty and has 0 tokens; texts of any length are
counted whole; of pairs of equal rank the leftmost merges first; equal ids are
counted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.textarrays import Texts, slices
from skein.llm.workers import hold, map_batches

LIMIT = 4096
MEMO_PIECES = 800_000
_SPACE = "▁"


class BytePairCounter:
    """Counts tokens as a sentencepiece BPE model with byte fallback does."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        trainer, rules = model.trainer_spec, model.normalizer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with byte fallback and leading spaces is needed")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("a model without character rules is needed")
        self.prefix = _SPACE if rules.add_dummy_prefix else ""
        if any(p.type == 4 for p in model.pieces):
            raise ValueError("user-defined symbols are not supported")
        normal = [(p.piece, p.score) for p in model.pieces if p.type == 1]
        self.known = {p for p, _ in normal}
        #: Rank by score; lower goes first.
        self.rank = {p: -score for p, score in normal if len(p) > 1}
        self.joint = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        self.memo: dict[str, int] = {}
        # the quick cuts: before a space that follows another character, and around a line break
        if any(j[1] == _SPACE != j[0] or "\n" in j for j in self.joint):
            raise ValueError("this vocabulary joins what precedes a space, or line breaks")
        self.line_break = self.merges("\n")

    def merges(self, piece: str) -> int:
        """The number of tokens of a piece, by heap and linked list."""
        n = len(piece)
        rank = self.rank
        heap = []
        for i in range(n - 1):
            r = rank.get(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        if heap:
            heapq.heapify(heap)
            pop, push = heapq.heappop, heapq.heappush
            end = list(range(1, n + 1))  # of the symbol that begins at i; 0 once it has been merged away
            prev = list(range(-1, n - 1))  # where the symbol before it begins
            while heap:
                _, i, stop = pop(heap)
                mid = end[i]
                if not mid or mid >= n or end[mid] != stop:
                    continue  # one of the two is gone or has grown
                end[i], end[mid] = stop, 0
                if stop < n:
                    prev[stop] = i
                    r = rank.get(piece[i : end[stop]])
                    if r is not None:
                        push(heap, (r, i, end[stop]))
                k = prev[i]
                if k >= 0:
                    r = rank.get(piece[k:stop])
                    if r is not None:
                        push(heap, (r, k, stop))
            count = 0
            known = self.known
            for i in range(n):
                if end[i]:
                    count += 1 if end[i] > i + 1 or piece[i] in known else len(piece[i].encode())
            return count
        known = self.known
        return sum(1 if c in known else len(c.encode()) for c in piece)

    def _piece(self, piece: str) -> int:
        """A piece that may still hold hard cuts."""
        if len(piece) < 2:
            return self.merges(piece)
        joint, total, at = self.joint, 0, 0
        for k in range(1, len(piece)):
            if piece[k - 1 : k + 1] not in joint:
                total += self.merges(piece[at:k])
                at = k
        return total + self.merges(piece[at:])

    def count(self, text: str) -> int:
        """Tokens of a whole text.

        Cut at line breaks and before every space that follows something else; the
        constructor has checked that no vocabulary entry reaches across.
        """
        if not text:
            return 0
        text = (self.prefix + text).replace(_SPACE, " ")
        memo = self.memo
        total = 0
        for line in text.split("\n"):
            pieces = line.split(" ")
            if "" in pieces[1:]:
                total += self._runs(line)
                continue
            if pieces[0]:
                total += self._known_piece(pieces[0])
            for p in pieces[1:]:
                k = memo.get(p)
                total += self._learn(p) if k is None else k
        return total + text.count("\n") * self.line_break

    def _runs(self, line: str) -> int:
        total = 0
        for m in re.finditer(r" *[^ ]+| +", line):
            total += self._known_piece(m.group().replace(" ", _SPACE))
        return total

    def _known_piece(self, piece: str) -> int:
        key = "\n" + piece  # apart from the pieces that follow one space
        k = self.memo.get(key)
        if k is None:
            k = self._keep(key, self._piece(piece))
        return k

    def _learn(self, piece: str) -> int:
        return self._keep(piece, self._piece(_SPACE + piece))

    def _keep(self, key: str, count: int) -> int:
        if len(self.memo) >= MEMO_PIECES:
            self.memo.clear()
        if len(key) <= 64:
            self.memo[key] = count
        return count


def counter(model_path: str) -> BytePairCounter:
    return hold(("counter", model_path), lambda: BytePairCounter(model_path))


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        for batch in batches:
            for part in slices(batch):
                size = np.diff(Texts(part.column(1)).offsets)
                count = np.array([model.count(t or "") for t in part.column(1).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size), pa.array(count), pa.array(count > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, SCHEMA)
