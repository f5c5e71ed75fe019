"""Near-duplicate classes: BagMinHash signatures, bands, exact multiset overlap.

The words of a text (runs without white space) give a multiset of shingles of
``SHINGLE`` words. Two texts are near duplicates if the weighted Jaccard
similarity of their multisets, sum of minima over sum of maxima, is at least
``THRESHOLD``; classes are the connected components of that relation.

* :func:`bag_minhash`: a weight c is cut into unit levels 0 to c - 1, and every
  level of every shingle has a Poisson process of rate 1. Levels are nested in
  dyadic intervals [0, 1), [1, 2), [2, 4), [4, 8) and so on; an interval has one
  process of the rate of its length, whose points are dealt down its halves by
  fair coins, so a weight costs its logarithm and not itself. Points at levels
  from c on are not followed. Each point falls on one of ``BANDS * ROWS``
  components, a component keeps the earliest point, and a process stops once its
  time exceeds all components. Two texts agree in a component with the
  probability of their weighted Jaccard similarity, without bias.
* Exact copies (equal words) are one text from there on.
* Bands of ``ROWS`` components give buckets. In each shared bucket all texts are
  compared with its hub, the text with the most company in its buckets. Buckets
  that still hold several classes are compared fully: pair by pair if they are
  small, else in blocks that keep the pairs inside a task (:func:`blockwise`).
  Texts of one class are not paired again. A pair is left out only where the
  sizes alone exclude the similarity.
* Every pair is verified on the whole multisets.

A pair of similarity exactly 0.8 shares no bucket with probability 3e-6, a more
similar one with less.

Defined cases: a text with fewer words than a shingle is one shingle of all its
words; null texts and texts without words are in no class but their own; rows of
equal id are the same document (their texts should agree); a null id has a null
class, and no other row is compared with it; texts of any length are compared whole;
of texts that tie for a bucket's hub the one of least id is it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.scratch import written
from skein.llm.textarrays import SPACE, Texts, grams, mix, owners, slices
from skein.llm.workers import map_batches, tidy, trim

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
#: Texts that are signed at once: each takes about 900 points.
SIGN_ROWS = 400
#: Up to so many texts, a bucket's pairs become rows; larger buckets are compared in blocks of
#: about BLOCK texts and BLOCK_WORDS shingles, or one text.
SMALL, BLOCK, BLOCK_WORDS = 12, 1024, 250_000
#: Ids that may be broadcast to select rows of the input: 8 bytes each.
BROADCAST_IDS = 4_000_000

_U = np.uint64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


# -- shingles and signatures ---------------------------------------------------


def shingles(texts: Texts, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) and the text of each, in order of texts."""
    starts, ends, bounds = texts.spans(SPACE)
    owner = owners(bounds)
    words = texts.span_hash(starts, ends)
    h, at = grams(words, owner, n)
    who = owner[at]
    count = np.diff(bounds)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([mix(np.bitwise_xor.reduce(mix(words[bounds[k] : bounds[k + 1]] + np.arange(count[k], dtype=_U)))[None] + _U(count[k]))[0] for k in short], _U)
        h, who = np.concatenate([h, extra]), np.concatenate([who, short])
        order = np.argsort(who, kind="stable")
        h, who = h[order], who[order]
    return h, who


def weighted(h: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles by text, with how often each occurs; sorted by text, then hash."""
    order = np.lexsort((h, who))
    h, who = h[order], who[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    at = np.flatnonzero(new)
    return h[at], who[at], np.diff(np.append(at, len(h)))


def _uniform(state: np.ndarray) -> np.ndarray:
    """From 64 bits to (0, 1]."""
    return ((state >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(h: np.ndarray, who: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n texts by m components) of weighted sets: digests of the earliest points.

    ``h, who, weight``: shingles of all texts, ``who`` ascending. The processes of
    all texts advance together; texts with few processes take more points a round.
    """
    first = np.full(n * m, np.inf)
    value = np.zeros(n * m, _U)
    if not len(h):
        return value.reshape(n, m)
    # the processes: interval k is [2**(k-1), 2**k), interval 0 is [0, 1)
    process, interval = [], []
    for k in range(int(weight.max()).bit_length() + 1):
        has = np.flatnonzero(weight > (1 << k >> 1) - (k == 0))
        process.append(has)
        interval.append(np.full(len(has), k))
    process, interval = np.concatenate(process), np.concatenate(interval)
    key = mix(h[process] ^ mix(interval.astype(_U) + _U(1)))
    limit, owner = weight[process], who[process]
    length = np.maximum(1, 1 << interval >> 1)
    begin = np.where(interval == 0, 0, length)
    time, count = np.zeros(len(process)), np.zeros(len(process), np.int64)
    # points that fill all components, on average, over the processes of a text
    need = int(m * (np.log(m) + 0.58)) + 1
    step = np.clip(need // np.maximum(1, np.bincount(owner, minlength=n)), 1, need)
    while len(key):
        times = step[owner]
        total = int(times.sum())
        at = np.repeat(np.arange(len(key)), times)
        head = np.cumsum(times) - times
        j = np.arange(total) - head[at] + count[at]
        point = mix(key[at] + (j + 1).astype(_U) * _GOLD)
        # to (0, 1], then exponential gaps
        gap = -np.log(((point >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / length[at]
        run = np.cumsum(gap)
        t = run - (run[head] - gap[head])[at] + time[at]
        place = mix(point ^ _GOLD)
        component = ((place >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
        # the coins: which half, which half of that, down to a level
        level = begin[at] + ((place & _U(0xFFFFFFFF)).astype(np.int64) & (length[at] - 1))
        below = level < limit[at]
        cell = owner[at[below]] * m + component[below]
        t_below = t[below]
        np.minimum.at(first, cell, t_below)
        won = t_below == first[cell]
        value[cell[won]] = place[below][won]
        time, count = t[head + times - 1], count + times
        go = time < first.reshape(n, m).max(axis=1)[owner]
        key, limit, owner, length, begin, time, count = (x[go] for x in (key, limit, owner, length, begin, time, count))
        step = np.maximum(1, step // 2)
    return value.reshape(n, m)


_SIGNED = "doc_id long, k1 long, k2 long, n long, bands array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, n, bands``: a digest of the words, the number of shingles, the band keys."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows=SIGN_ROWS):
                texts = Texts(part.column(1))
                starts, ends, bounds = texts.spans(SPACE)
                words = texts.span_hash(starts, ends)
                place = (np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds)) + 1).astype(_U)
                digest = []
                for x in (mix(words + place * _GOLD), mix(words ^ (place * _U(0xC2B2AE3D27D4EB4F)))):
                    c = np.concatenate([np.zeros(1, _U), np.cumsum(x, dtype=_U)])
                    digest.append(pa.array(mix(c[bounds[1:]] - c[bounds[:-1]]).view(np.int64)))
                h, who = shingles(texts)
                n = np.bincount(who, minlength=texts.n).astype(np.int64)
                sig = bag_minhash(*weighted(h, who), texts.n, BANDS * ROWS).reshape(texts.n, BANDS, ROWS)
                band = np.zeros((texts.n, BANDS), _U)
                for r in range(ROWS):
                    band = mix(band * _U(0xC2B2AE3D27D4EB4F) + sig[:, :, r])
                band = mix(band + np.arange(BANDS, dtype=_U)[None, :])
                bands = pa.ListArray.from_arrays(pa.array(np.arange(texts.n + 1, dtype=np.int32) * BANDS), pa.array(band.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), *digest, pa.array(n), bands], names=["doc_id", "k1", "k2", "n", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, _SIGNED)


# -- verification ----------------------------------------------------------------


def overlap(a: Texts, b: Texts) -> np.ndarray:
    """The weighted Jaccard similarity of each text of ``a`` with that of ``b`` in its place."""
    ha, oa, wa = weighted(*shingles(a))
    hb, ob, wb = weighted(*shingles(b))
    h, who, w = np.concatenate([ha, hb]), np.concatenate([oa, ob]), np.concatenate([wa, wb])
    order = np.lexsort((h, who))
    h, who, w = h[order], who[order], w[order]
    same = np.flatnonzero((h[1:] == h[:-1]) & (who[1:] == who[:-1]))
    both = np.bincount(who[same], weights=np.minimum(w[same], w[same + 1]), minlength=a.n)
    total = np.bincount(who, weights=w, minlength=a.n) - both
    return np.divide(both, total, out=np.zeros(a.n), where=total > 0)


def verified(pairs: DataFrame, pool: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b`` of those pairs whose texts in ``pool`` (doc_id, text) reach the threshold."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                for piece in slices(part, "text_b"):
                    ok = overlap(Texts(piece.column(2)), Texts(piece.column(3))) >= threshold - 1e-12
                    yield piece.select(["a", "b"]).filter(pa.array(ok))

    one = pool.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    two = pool.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(one, "b").join(two, "a").select("a", "b", "text_a", "text_b")
    return both.transform(map_batches, run, "a long, b long").distinct()


# -- connected components ----------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``doc, root`` for every node that is not its component's least: alternating stars.

    Every step is a group-by minimum and a join with one row a node on the other
    side; no list of neighbours is ever gathered. Rounds grow with the logarithm
    of the input; each is written to the shared folder.
    """
    edges = written(links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct(), "links")
    before = None
    while True:
        check = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if check.n == 0 or (check.n, check.x) == before:
            return edges.select(F.col("u").alias("doc"), F.col("v").alias("root"))
        before = (check.n, check.x)
        # large star: larger neighbours go to the least of the neighbourhood
        around = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node itself go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").where("u <> v").distinct(), "stars")


# -- the operator -------------------------------------------------------------------


def _pool(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of ``ids``; these are broadcast only if few, by count."""
    few = ids.count() <= BROADCAST_IDS
    chosen = (F.broadcast(ids) if few else ids).select(F.col("doc").alias("doc_id"))
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id", "left_semi"), "near-pool")


def _ordered(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def links(docs: DataFrame, signed: DataFrame, kinds: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified links that join every class; ``kinds``: one row (doc, n) for each different text."""
    apart = signed.join(kinds.select(F.col("doc").alias("doc_id"), F.lit(1).alias("one")), "doc_id", "left_semi")
    rows = apart.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("bucket"))
    company = rows.groupBy("bucket").agg(F.count("*").alias("company")).where("company > 1")
    shared = written(rows.join(company, "bucket"), "near-buckets")
    degree = shared.groupBy("doc").agg(F.sum("company").alias("degree"))
    pool = _pool(docs, degree.select("doc"))
    ranked = shared.join(degree, "doc").join(kinds, "doc").select("bucket", "doc", "n", "degree")
    ranked = written(ranked, "near-ranked")

    def hub(members: DataFrame) -> DataFrame:
        best = F.max(F.struct("degree", (-F.col("doc")).alias("minus"), "n")).alias("h")
        return members.groupBy("bucket").agg(best).select("bucket", (-F.col("h.minus")).alias("hub"), F.col("h.n").alias("hub_n"))

    def possible(n1: str, n2: str):
        # a smaller multiset cannot overlap more than it has
        return F.least(n1, n2) >= F.lit(threshold - 1e-12) * F.greatest(n1, n2)

    def star(members: DataFrame, hubs: DataFrame) -> DataFrame:
        joined = members.join(hubs, "bucket").where((F.col("doc") != F.col("hub")) & possible("n", "hub_n"))
        return joined.select(*_ordered("doc", "hub")).distinct()

    tried = written(star(ranked, hub(ranked)), "near-pairs")
    found = [written(verified(tried, pool, threshold), "near-links")]
    root = components(found[0])
    rooted = ranked.join(root, "doc", "left").select("bucket", "doc", "n", F.coalesce("root", "doc").alias("root"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("members"), F.sum("n").alias("words")).where("x <> y")
    members = written(rooted.join(open_.select("bucket", "members", "words"), "bucket"), "near-open")
    # small buckets: every pair of different classes, once; there are at most SMALL / 2 a member
    small = members.where(F.col("members") <= SMALL)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") < F.col("y.root")) & possible("x.n", "y.n"))
    pairs = pairs.select(*_ordered("x.doc", "y.doc")).distinct().join(tried, ["a", "b"], "left_anti")
    found.append(written(verified(pairs, pool, threshold), "near-links"))
    # large ones: whole blocks
    found.append(written(blockwise(members.where(F.col("members") > SMALL), pool, threshold), "near-links"))
    return reduce(DataFrame.unionByName, found)


def blockwise(members: DataFrame, pool: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between classes inside large buckets, without a row for each pair.

    A bucket is dealt into blocks of bounded size, and each task holds two
    of them (or the one there is), finds all overlaps of a text with the block by
    its shingles' posting lists, and returns only links that join classes.
    """
    n_blocks = F.ceil(F.greatest(F.col("members") / F.lit(BLOCK), F.col("words") / F.lit(BLOCK_WORDS))).cast("long")
    dealt = members.withColumn("n_blocks", n_blocks).withColumn("own", F.pmod(F.xxhash64("doc"), "n_blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    dealt = dealt.where("own <> other OR n_blocks = 1").select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc", "root")
    texts = dealt.join(pool.select(F.col("doc_id").alias("doc"), "text"), "doc")

    def run(table: pa.Table) -> pa.Table:
        docs, roots = table.column("doc").to_numpy(), table.column("root").to_numpy()
        found = pa.table(dict(zip(("a", "b"), block_links(docs, roots, table.column("text"), threshold))))
        trim()
        return found

    return texts.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long").distinct()


def block_links(docs: np.ndarray, roots: np.ndarray, texts: pa.ChunkedArray, threshold: float = THRESHOLD) -> tuple[pa.Array, pa.Array]:
    """Links of similarity ``threshold`` or more that join the classes ``roots`` of a block, exactly."""
    n = len(docs)
    shingle, who, weight = [], [], []
    base = 0
    for part in slices(pa.RecordBatch.from_arrays([texts.combine_chunks()], names=["text"])):
        h, w, k = weighted(*shingles(Texts(part.column(0))))
        shingle.append(h), who.append(w + base), weight.append(k)
        base += part.num_rows
    code = np.unique(np.concatenate(shingle), return_inverse=True)[1]
    who, weight = np.concatenate(who), np.concatenate(weight)
    total = np.bincount(who, weights=weight, minlength=n)
    bounds = np.searchsorted(who, np.arange(n + 1))
    # posting lists by shingle
    order = np.argsort(code, kind="stable")
    post_who, post_weight = who[order], weight[order]
    begin = np.searchsorted(code[order], np.arange(int(code.max(initial=-1)) + 2))
    parent = {r: r for r in set(roots.tolist())}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    kinds, size = np.unique(roots, return_counts=True)
    largest = kinds[np.argmax(size)]
    a, b = [], []
    for x in np.flatnonzero(roots != largest).tolist():
        own = code[bounds[x] : bounds[x + 1]]
        times = begin[own + 1] - begin[own]
        at = np.repeat(begin[own] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        least = np.minimum(np.repeat(weight[bounds[x] : bounds[x + 1]], times), post_weight[at])
        both = np.bincount(post_who[at], weights=least, minlength=n)
        for y in np.flatnonzero(both >= (threshold - 1e-12) * (total + total[x] - both)).tolist():
            r, q = top(int(roots[x])), top(int(roots[y]))
            if r != q and total[y] > 0:
                parent[r] = q
                a.append(min(docs[x], docs[y])), b.append(max(docs[x], docs[y]))
    return pa.array(a, pa.int64()), pa.array(b, pa.int64())


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, is_first`` for every row: the class's least id, and whether it is this one."""
    signed = written(signatures(docs), "near-signed")
    kinds = written(signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n")), "near-kinds")
    root = components(links(docs, signed, kinds.select("doc", "n"), threshold))
    named = kinds.join(root, "doc", "left").select("k1", "k2", F.coalesce("root", "doc").alias("class_id"))
    s, c = signed.select("doc_id", "k1", "k2", "n").alias("s"), named.alias("c")
    joined = s.join(c, (F.col("s.k1") == F.col("c.k1")) & (F.col("s.k2") == F.col("c.k2")) & (F.col("s.n") > 0) & F.col("s.doc_id").isNotNull(), "left")
    class_id = F.coalesce("class_id", "doc_id")
    return joined.select("s.doc_id", class_id.alias("class_id"), (class_id == F.col("doc_id")).alias("is_first"))


def first_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the least id; rows of null id stay."""
    found = written(classes(docs, threshold).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n")), "near-classes")
    gone = found.where("class_id <> doc_id").select(F.col("doc_id").alias("__id"))
    few = gone.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, docs["doc_id"].cast("long") == F.col("__id"), "left_anti")
    if found.where("n > 1").isEmpty():
        return kept
    # ids that occur more than once: one row each
    plain = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return plain.unionByName(kept.where("doc_id IS NULL"))
