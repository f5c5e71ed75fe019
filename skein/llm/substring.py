"""Substring dedup: repeated runs of whole sentences, lines and paragraphs.

A sentence ends with a line, or with a word that ends in one of ``. ! ?`` (a closing
quote or bracket may follow) or their full-width forms. A unit is a run of whole
sentences of at least ``min_words`` words, as short as it can be: one from each
sentence on, and one up to each sentence's end. So a long sentence is a unit
alone, and short lines count by the lines around them. Units may run over line
ends; their words are compared in lower case, with any white space between them.
Of equal units in the whole table the occurrence of lowest rank (doc_id, then
place in the text) stays, and the others are removed, as spans of character offsets in
the original text. Every run of whole sentences with ``min_words`` words or more
in all that stands in an earlier place, paragraphs and texts among them, goes as a whole: each of its sentences is in
a unit from it on, or in the one up to the run's end.

Units are cut once and written; only their 96-bit digests and places are grouped.
A text's own repeats are told apart where it is cut, so a digest needs only its least id.
A digest that holds a third of all units is summed before the shuffle, and the join
that finds its occurrences has one row a digest, read from files, on its other side, so Spark may
split the hot side.

Defined cases: null texts and texts of fewer than ``min_words`` words have no units;
texts of any length are worked on whole, and a line without white space is one
word; rows of one id have equal rank, so what they share stays or goes
together; a null id ranks as the least number; of a sentence over and over the first stays; the columns of
``docs`` may have any other names, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.scratch import written
from skein.llm.textarrays import SPACE, Texts, _power, mix, owners, slices
from skein.llm.workers import map_batches, tidy

#: Shorter runs of sentences recur by chance, or as single boilerplate lines.
MIN_WORDS = 16
_U = np.uint64
_STOP, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSE[list(b"\"')]")] = True
#: The full-width full stop, exclamation mark and question mark.
_WIDE = [int.from_bytes(c.encode(), "big") for c in "。！？"]


def sentence_ends(texts: Texts, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per word: whether a sentence ends with it. Every text's last word does."""
    data = np.concatenate([np.zeros(3, np.uint8), texts.data])  # so that three bytes can be read back
    last = ends + 2
    ending = _STOP[data[last]] | (_CLOSE[data[last]] & _STOP[data[last - 1]] & (ends - starts > 1))
    wide = (data[last - 2].astype(np.int32) << 16) | (data[last - 1].astype(np.int32) << 8) | data[last]
    ending |= np.isin(wide, _WIDE) & (ends - starts > 2)
    breaks = np.searchsorted(starts, np.flatnonzero(texts.data == 10))  # the first word after each line break
    ending[breaks[breaks > 0] - 1] = True
    ending[bounds[1:][bounds[1:] > 0] - 1] = True
    return ending


def runs(ending: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end (exclusive) and text of every unit, once each, in order."""
    stops = np.flatnonzero(ending) + 1
    if not len(stops):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.concatenate([[0], stops[:-1]])
    owner = np.searchsorted(bounds, begins, "right") - 1
    low, high = bounds[owner], bounds[owner + 1]
    # from each sentence on: the first end that is far enough, within the text
    at = np.searchsorted(stops, begins + min_words)
    ok = np.flatnonzero(begins + min_words <= high)
    first, end, who = begins[ok], stops[at[ok]], owner[ok]
    # up to each sentence's end: the last begin that is far enough
    at = np.searchsorted(begins, stops - min_words, "right") - 1
    ok = np.flatnonzero(stops - min_words >= low)
    pairs = np.concatenate([first, begins[at[ok]]]), np.concatenate([end, stops[ok]]), np.concatenate([who, owner[ok]])
    order = np.lexsort((pairs[1], pairs[0]))
    first, end, who = (x[order] for x in pairs)
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
    return first[new], end[new], who[new]


def _digest(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power(len(words) + 1)
    c = np.concatenate([np.zeros(1, _U), np.cumsum(words * up[: len(words)], dtype=_U)])
    return mix((c[end] - c[first]) * down[first] + (end - first).astype(_U))


_UNITS = "d long, t int, h1 long, h2 int, words long, chars long, again boolean"
#: The rank of a null id.
_LEAST = -(1 << 63)


def _key() -> list:
    """``d, t``: what ranks a row, and what tells rows of one id with other texts apart."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)), F.hash(F.col("text").cast("string"))]


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, t, h1, h2, words, chars, again`` of every unit.

    ``words`` and ``chars`` are its first place times 2**32, plus the place after its last;
    ``again``: the text has an equal unit before it.
    """
    names = [x.split()[0] for x in _UNITS.split(", ")]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text = Texts(part.column(2))
                starts, ends, bounds = text.spans(SPACE)
                lowered = Texts(pc.utf8_lower(part.column(2).cast(pa.large_string())))
                s, e, _ = lowered.spans(SPACE)
                words = lowered.span_hash(s, e)
                first, stop, owner = runs(sentence_ends(text, starts, ends, bounds), bounds, min_words)
                if not len(first):
                    continue
                one = _digest(words, first, stop)
                two = _digest(mix(words ^ _U(0xC2B2AE3D27D4EB4F)), first, stop)
                order = np.lexsort((first, one, owner))
                again = np.zeros(len(first), bool)
                again[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
                chars = np.concatenate([[0], np.cumsum(text.code_points())])
                begin, base = chars[text.offsets[owner]], bounds[owner]
                who = pa.array(owner)
                columns = [
                    part.column(0).take(who), part.column(1).take(who),
                    pa.array(one.view(np.int64)), pa.array((two >> _U(32)).astype(np.uint32).view(np.int32)),
                    pa.array((first - base) << 32 | (stop - base)), pa.array((chars[starts[first]] - begin) << 32 | (chars[ends[stop - 1]] - begin)),
                    pa.array(again),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    d, t = _key()
    return docs.select(d.alias("d"), t.alias("t"), F.col("text").cast("string").alias("text")).transform(map_batches, run, _UNITS)


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: all but the occurrence of lowest rank of each digest."""
    u = written(units(docs, min_words), "substring-units")
    once = u.where("NOT again")
    groups = once.groupBy("h1", "h2").agg(F.min("d").alias("keep"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "keep")
    groups = written(groups, "substring-groups")
    elsewhere = once.join(groups, ["h1", "h2"]).where("d <> keep").select("d", "t", "words", "chars")
    found = elsewhere.unionByName(u.where("again").select("d", "t", "words", "chars")).distinct()
    low = F.lit((1 << 32) - 1)
    places = [x for c, b, e in (("words", "first", "stop"), ("chars", "start", "end")) for x in (F.shiftright(c, 32).alias(b), F.col(c).bitwiseAND(low).alias(e))]
    return found.select("d", "t", *places)


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row a document that loses words: ``d, t, n_removed, removed_words, removed_chars, spans``.

    ``spans``: start and end of each removed passage (units that overlap or touch are one),
    in order. A document's own sentences bound the list.
    """
    order = Window.partitionBy("d", "t").orderBy("first", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        repeated_units(docs, min_words)
        .withColumn("new", (F.col("first") > F.coalesce(before, F.lit(-1))).cast("int"))
        .withColumn("passage", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("d", "t", "passage")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("stop") - F.min("first")).alias("n_words"))
        .groupBy("d", "t")
        .agg(
            F.count("*").alias("n_removed"),
            F.sum("n_words").alias("removed_words"),
            F.sum(F.col("end") - F.col("start")).alias("removed_chars"),
            F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
        )
    )


def with_removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the columns of :func:`removals` under ``__gone``, null where a row loses nothing."""
    gone = removals(docs, min_words).select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.struct("n_removed", "removed_words", "removed_chars", "spans").alias("__gone"))
    # hashed before the join, so that texts are not shuffled where no one reads them
    d, t = _key()
    return docs.withColumn("__d", d).withColumn("__t", t).join(gone, ["__d", "__t"], "left").drop("__d", "__t")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated units cut out of ``text``; other columns pass through."""
    joined = with_removals(docs, min_words)
    spans = F.col("__gone.spans")
    # the text between one removed span and the next
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length("text").cast("long")))
    pieces = F.zip_with(begins, ends, lambda b, e: F.col("text").substr((b + 1).cast("int"), (e - b).cast("int")))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("text", text).select(*docs.columns)


def oracle_sql(min_words: int = MIN_WORDS) -> str:
    """The same from DuckDB, which compares the units' words themselves."""
    return f"""
WITH line AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS k
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
placed AS (
  SELECT doc_id, text, k, line,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, text ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
  FROM line),
cut AS (
  SELECT doc_id, text, k, base, regexp_extract_all(line, '[\\x20\\x09-\\x0D]+|[^\\x20\\x09-\\x0D]+') AS pieces
  FROM placed),
piece AS (
  SELECT doc_id, text, k, base, unnest(pieces) AS piece, unnest(generate_series(1, len(pieces))) AS p, len(pieces) AS n FROM cut),
word AS (
  SELECT doc_id, text, piece AS w, base + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, text, k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, k, p
  FROM piece),
numbered AS (
  SELECT doc_id, text, w, start, row_number() OVER (PARTITION BY doc_id, text ORDER BY k, p) AS i, k, lead(k) OVER (PARTITION BY doc_id, text ORDER BY k, p) AS next_k
  FROM word WHERE NOT regexp_matches(w, '[\\x20\\x09-\\x0D]')),
doc AS (
  SELECT doc_id, text, list(lower(w) ORDER BY i) AS words, list(start ORDER BY i) AS starts, list(start + length(w) ORDER BY i) AS ends,
         list(i ORDER BY i) FILTER (WHERE next_k IS DISTINCT FROM k OR regexp_matches(w, '([.!?]["'')\\]]?|[。！？])$')) AS stops
  FROM numbered GROUP BY doc_id, text),
sentence AS (
  SELECT *, list_concat([0], list_slice(stops, 1, len(stops) - 1)) AS begins FROM doc),
span AS (
  SELECT * EXCLUDE (b), b AS first, list_min(list_filter(stops, lambda s: s >= b + {min_words})) AS stop FROM (SELECT *, unnest(begins) AS b FROM sentence)
  UNION
  SELECT * EXCLUDE (e), list_max(list_filter(begins, lambda b: b <= e - {min_words})) AS first, e AS stop FROM (SELECT *, unnest(stops) AS e FROM sentence)),
units AS (
  SELECT doc_id, text, first, stop, starts[first + 1] AS start, ends[stop] AS finish, array_to_string(list_slice(words, first + 1, stop), ' ') AS body
  FROM span WHERE first IS NOT NULL AND stop IS NOT NULL),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY doc_id NULLS FIRST) AS keep, row_number() OVER (PARTITION BY body, doc_id, text ORDER BY first) AS r
  FROM units),
gone AS (
  SELECT *, max(stop) OVER (PARTITION BY doc_id, text ORDER BY first, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ranked WHERE r > 1 OR doc_id IS DISTINCT FROM keep),
passage AS (
  SELECT *, sum((first > coalesce(before, -1))::INT) OVER (PARTITION BY doc_id, text ORDER BY first, stop ROWS UNBOUNDED PRECEDING) AS g FROM gone),
removed AS (
  SELECT doc_id, text, g, min(start) AS start, max(finish) AS finish, max(stop) - min(first) AS n FROM passage GROUP BY doc_id, text, g),
total AS (
  SELECT doc_id, text, count(*) AS n_removed, sum(n) AS removed_words, sum(finish - start) AS removed_chars,
         string_agg(start || ':' || finish, ',' ORDER BY start) AS spans
  FROM removed GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_words, 0)::BIGINT AS removed_words,
       coalesce(removed_chars, 0)::BIGINT AS removed_chars, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN total t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.text = t.text"""
