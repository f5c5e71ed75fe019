"""Byte-level BPE over whole Arrow batches: the ids that the tokenizers library gives, without a Python loop over words.

The library cuts a text into pieces (a word with the space before it, digits,
punctuation, white space) and merges the bytes of each piece, lowest rank first;
pieces never join. Here all pieces of a batch are cut by a few passes over its
bytes, Arrow finds the different ones, and these are merged side by side: each
round merges every place of the lowest-ranked pair of each piece. Nothing is kept
between batches, so memory follows the batch.

Texts with characters whose class depends on the Unicode version, with white space
beyond ASCII, or with a special string go to the library itself, and so do pieces
over ``LONG`` bytes (to its model, whose time does not grow with their square).
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skein.llm.textarrays import Texts

#: Bytes of a piece beyond which the library's model merges it.
LONG = 256
_OTHER, _LETTER, _DIGIT, _SPACE, _HARD = range(5)
_NONE = np.uint32(0xFFFFFFFF)
_SLOTS = 19  # bits


def _class_of(c: str) -> int:
    kind = unicodedata.category(c)[0]
    if c in " \t\n\v\f\r":
        return _SPACE
    if kind == "Z" or unicodedata.ucd_3_2_0.category(c)[0] != kind or c < " " or "\x7f" <= c <= "\xa0":
        return _HARD
    return {"L": _LETTER, "N": _DIGIT}.get(kind, _HARD if kind == "C" else _OTHER)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    heads = np.cumsum(sizes) - sizes
    return np.repeat(starts - heads, sizes) + np.arange(int(sizes.sum()))


class Merges:
    """A table of pairs: rank and result of each."""

    def __init__(self, pairs: np.ndarray, results: np.ndarray):
        self.results = results.astype(np.uint32)
        keys = (pairs[:, 0].astype(np.uint64) << np.uint64(16)) | pairs[:, 1].astype(np.uint64)
        self.table = np.full((1 << _SLOTS) + 1024, np.uint64(0xFFFFFFFFFFFFFFFF))
        entries = (keys << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64)
        slot, left = self._slot(keys.astype(np.uint32)), np.arange(len(keys))
        while len(left):
            free = left[self.table[slot[left]] == np.uint64(0xFFFFFFFFFFFFFFFF)]
            _, one = np.unique(slot[free], return_index=True)
            self.table[slot[free[one]]] = entries[free[one]]
            left = left[self.table[slot[left]] != entries[left]]
            slot[left] += 1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; ``_NONE`` if it does not merge."""
        keys = (a << np.uint32(16)) | b
        slot = self._slot(keys)
        entry = self.table[slot]
        out = np.where((entry >> np.uint64(32)).astype(np.uint32) == keys, entry.astype(np.uint32), _NONE)
        empty = np.uint64(0xFFFFFFFFFFFFFFFF)
        more = np.flatnonzero((out == _NONE) & (entry != empty))
        while len(more):
            slot[more] += 1
            entry = self.table[slot[more]]
            hit = (entry >> np.uint64(32)).astype(np.uint32) == keys[more]
            out[more[hit]] = entry[hit].astype(np.uint32)
            more = more[~hit & (entry != empty)]
        return out

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pieces after all merges, and their number by piece."""
        n = len(sizes)
        counts = np.zeros(n, np.int64)
        kept, owners = [], []
        piece = np.flatnonzero(sizes > 0)
        size, sym = sizes[piece], symbols.astype(np.uint32)
        last = np.zeros(len(sym), bool)
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(sym), _NONE)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        while len(piece):
            heads = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, heads)
            done = best == _NONE
            if done.any():
                out = np.repeat(done, size)
                counts[piece[done]] = size[done]
                kept.append(sym[out]), owners.append(piece[done])
                going = ~done
                piece, size, best = piece[going], size[going], best[going]
                if not len(piece):
                    break
                stay = ~out
                sym, rank, last = sym[stay], rank[stay], last[stay]
            at = np.flatnonzero(rank == np.repeat(best, size))
            if len(at) > len(piece):  # of places that overlap every other one merges, from the left
                new = np.ones(len(at), bool)
                new[1:] = np.diff(at) != 1
                head = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - head) % 2 == 0]
            sym[at] = self.results[rank[at]]
            last[at] = last[at + 1]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            # which piece each place is in: pieces end where ``last`` holds
            ends = np.cumsum(size)
            size = size - np.bincount(np.searchsorted(ends, at, "right"), minlength=len(size))
            sym, rank, last = sym[stay], rank[stay], last[stay]
            at = at - np.arange(len(at))
            first = at[at > 0] - 1
            near = np.concatenate([at, first[~last[first]]])
            rank[at[last[at]]] = _NONE
            near = near[~last[near]]
            rank[near] = self.ranks(sym[near], sym[near + 1])
        total = np.zeros(n + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        result = np.zeros(int(total[-1]), np.uint32)
        for part, who in zip(kept, owners):
            result[ragged(total[who], counts[who])] = part
        return result, counts


class Encoder:
    """Whole texts to ids, by a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits here")
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None}
        self.known = (
            spec["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
            and all(model.get(k) == v for k, v in plain.items()) and not model.get("ignore_merges") and not model.get("byte_fallback")
        )
        if not self.known:
            return
        # the letters that stand for bytes: printable ones for themselves, the rest from U+0100 on
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in own]
        self.letter = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
        vocab = model["vocab"]
        self.byte = np.array([vocab[self.letter[b]] for b in range(256)], np.uint32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(np.array([(vocab[a], vocab[b]) for a, b in pairs]), np.array([vocab[a + b] for a, b in pairs]))
        self.tokenize = self.tokenizer.model.tokenize
        self.classes = np.full(1 << 16, _HARD, np.uint8)
        for k in [*range(0xD800), *range(0xE000, 0x10000)]:
            self.classes[k] = _class_of(chr(k))

    def _classes(self, data: np.ndarray) -> np.ndarray:
        """The class of the character that each byte belongs to."""
        out = self.classes[data]  # right for ASCII
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
            b = padded[lead]
            two, three = lead[b < 0xE0], lead[(b >= 0xE0) & (b < 0xF0)]
            kind = self.classes[((padded[two] & 0x1F) << 6) | (padded[two + 1] & 0x3F)]
            out[two], out[two + 1] = kind, kind
            kind = self.classes[((padded[three] & 0x0F) << 12) | ((padded[three + 1] & 0x3F) << 6) | (padded[three + 2] & 0x3F)]
            out[three], out[three + 1], out[three + 2] = kind, kind, kind
            out[lead[b >= 0xF0]] = _HARD
            four = lead[b >= 0xF0]
            for k in range(1, 4):
                out[four + k] = _OTHER  # the lead byte says that the text is hard
        return out

    def _pieces(self, texts: Texts, cls: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        data, n = texts.data, len(texts.data)
        heads = texts.offsets[:-1][texts.offsets[:-1] < n]
        start = np.empty(n, bool)
        start[:1] = True
        np.not_equal(cls[1:], cls[:-1], out=start[1:])
        start[heads] = True
        # the last of a run of white space goes with what follows if it is a space, and stands alone if not
        space = cls == _SPACE
        after = np.zeros(n, bool)
        after[1:] = space[:-1] & ~space[1:]
        after[heads] = False
        after = np.flatnonzero(after)
        start[after - 1] = True
        start[after[data[after - 1] == 0x20]] = False
        # 's 't 'm 'd 're 've 'll where a piece begins
        mark = np.flatnonzero((data == 0x27) & start)
        if len(mark):
            limit = texts.offsets[np.searchsorted(texts.offsets, mark, "right")]
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            one, two = padded[mark + 1], padded[mark + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (mark + 2 <= limit)
            long = (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)) & (mark + 3 <= limit)
            for where, size in ((mark[short], 2), (mark[long], 3)):
                start[where + 1] = False
                end = where + size
                start[end[end < n]] = True
        return np.flatnonzero(start)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(x.ids, np.uint16) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate([*got, np.zeros(0, np.uint16)]), np.array([len(x) for x in got], np.int64)

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; null is empty."""
        array = array.cast(pa.large_string()).fill_null("")
        if not self.known:
            return self._library(array.to_pylist())
        texts = Texts(array)
        cls = self._classes(texts.data)
        hard = np.zeros(texts.n, bool)
        hard[np.searchsorted(texts.offsets, np.flatnonzero(cls == _HARD), "right") - 1] = True
        for s in self.special:
            hard |= pc.match_substring(array, s).to_numpy(zero_copy_only=False)
        if hard.any():
            other, other_n = self._library(array.filter(pa.array(hard)).to_pylist())
            ids, ids_n = self.encode(array.filter(pa.array(~hard)))
            counts = np.zeros(texts.n, np.int64)
            counts[hard], counts[~hard] = other_n, ids_n
            out = np.empty(int(counts.sum()), np.uint16)
            from_library = np.repeat(hard, counts)
            out[from_library], out[~from_library] = other, ids
            return out, counts
        begin = self._pieces(texts, cls)
        offsets = np.append(begin, len(texts.data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(texts.data))])
        coded = pieces.dictionary_encode()
        ids, sizes = self._merge(coded.dictionary)
        which = coded.indices.to_numpy()
        places = np.cumsum(sizes) - sizes
        by_piece = sizes[which]
        out = ids[ragged(places[which], by_piece)]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(by_piece)])
        at = np.searchsorted(begin, texts.offsets)
        return out, total[at[1:]] - total[at[:-1]]

    def _merge(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, data = pieces.buffers()
        o = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if len(pieces) and data is not None else np.zeros(0, np.uint8)
        sizes = np.diff(o)
        long = np.flatnonzero(sizes > LONG)
        if not len(long):
            ids, counts = self.merges.merged(self.byte[d], sizes)
            return ids.astype(np.uint16), counts
        short = sizes <= LONG
        ids, few = self.merges.merged(self.byte[d[np.repeat(short, sizes)]], sizes[short])
        more = [np.array([x.id for x in self.tokenize("".join(self.letter[b] for b in pieces[int(k)].as_py()))], np.uint16) for k in long]
        counts = np.zeros(len(sizes), np.int64)
        counts[short], counts[long] = few, [len(x) for x in more]
        out = np.empty(int(counts.sum()), np.uint16)
        is_short = np.repeat(short, counts)
        out[is_short], out[~is_short] = ids, np.concatenate(more)
        return out, counts
