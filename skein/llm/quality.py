"""Quality rules, line first.

Every line is judged by rules of its own (punctuation, navigation, boilerplate)
and failing lines are removed. A document is rejected if too much of its text
goes that way, if too few words are left, or if the base rules on the whole
text fail. All of it is per document: no shuffle, and memory follows one slice
of a batch.

Defined cases: a null text counts as empty; texts of any length are judged whole; an empty text has zero counts and
fails the base rules; rows with equal ids are judged one by one; further columns
pass through :func:`clean` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.textarrays import SPACE, Texts, grams, mix, owners, per_text, slices
from skein.llm.workers import map_batches, tidy

#: Phrases and marks of page furniture in English, French, German and Spanish; ASCII letters match in either case.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "powered by",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
    "accepter les cookies",
    "cliquez ici",
    "conditions d'utilisation",
    "mentions légales",
    "politique de confidentialité",
    "tous droits réservés",
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "datenschutzerklärung",
    "hier klicken",
    "impressum",
    "nutzungsbedingungen",
    "aceptar cookies",
    "aviso legal",
    "haga clic aquí",
    "política de privacidad",
    "términos de uso",
    "todos los derechos reservados",
    "©",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?")] = True
_LINK = np.zeros(256, bool)
_LINK[list(b"|>/\\=~^")] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".!?:;\"')]}")] = True
#: Last bytes of closing marks beyond ASCII (ellipsis, quotes, full stops of other scripts).
_CLOSING_TAIL = ("…", "”", "’", "»", "。", "！", "？", "।", "؟")
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds; the base rules (20 words, 30 %, 8-word windows) are fixed by the contract."""

    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    #: A line without closing punctuation fails if it has fewer words than this.
    open_line_words: int = 5
    #: A line fails if symbols, or shouting marks, exceed this share of its words.
    max_symbols_per_word: float = 0.5
    max_shouts_per_word: float = 0.5
    #: A line fails as navigation with so many separators per word.
    max_links_per_word: float = 0.34
    #: A line fails as a list of keywords if so many words equal the word before.
    max_stutter: float = 0.3
    #: A line with a boilerplate phrase fails if it has no more words than this.
    boilerplate_words: int = 25
    #: A document is rejected if it keeps less than this share of its characters in words.
    min_kept: float = 0.5
    min_kept_words: int = 10


def _judge(texts: Texts, rules: QualityRules) -> dict[str, np.ndarray]:
    n = texts.n
    starts, ends, bounds = texts.spans(SPACE)
    owner = owners(bounds)
    n_words = np.diff(bounds).astype(np.int64)
    inside = ~SPACE[texts.data]
    chars = texts.total(texts.code_points() & inside, texts.offsets[:-1], texts.offsets[1:])
    symbols = texts.total(_SYMBOL[texts.data], texts.offsets[:-1], texts.offsets[1:])

    hashes = texts.span_hash(starts, ends)
    # words in windows found twice or more
    windows, at = grams(hashes, owner, rules.window)
    key = mix(windows + owner[at].astype(np.uint64) * _GOLD)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + rules.window, -1)
    repeated = per_text(n, owner[np.cumsum(cover[:-1]) > 0])

    # lines
    ls, le, lb = texts.lines()
    lo = owners(lb)
    first = np.searchsorted(starts, ls)
    words = np.searchsorted(starts, le) - first
    has = words > 0
    key = mix(texts.span_hash(ls, le) + lo.astype(np.uint64) * _GOLD)[has]
    seen = np.unique(key, return_index=True)[1]
    dup = per_text(n, lo[has]) - per_text(n, lo[has][seen])
    bad = _bad_lines(texts, ls, le, words, starts, ends, first, rules)
    stutter = np.zeros(len(starts) + 1, np.int64)
    np.cumsum((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]), out=stutter[2:])
    inner = np.minimum(first + 1, first + words)
    bad |= has & (words >= rules.open_line_words) & (stutter[first + words] - stutter[inner] > rules.max_stutter * words)
    kept_line = has & ~bad
    line_chars = texts.total(texts.code_points() & inside, ls, le)
    kept_chars = per_text(n, lo, np.where(kept_line, line_chars, 0))
    kept_words = per_text(n, lo, np.where(kept_line, words, 0))
    failed = (n_words < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n_words)
    kept = ~failed & (kept_chars >= rules.min_kept * chars) & (kept_words >= rules.min_kept_words)
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup.astype(np.int64),
        "n_repeat_words": repeated, "base_failed": failed, "kept": kept,
        "n_lines": per_text(n, lo[has]), "n_bad_lines": per_text(n, lo[has & bad]), "kept_words": kept_words,
        "_lines": (ls, le, lb, ~(has & bad)),
    }


def _bad_lines(texts, ls, le, words, starts, ends, first, rules) -> np.ndarray:
    data = texts.data
    some = words > 0
    last = ends[np.minimum(first + words - 1, max(len(ends) - 1, 0))] - 1 if len(ends) else np.zeros(len(ls), np.int64)
    closed = np.zeros(len(ls), bool)
    if len(data):
        closed = some & _CLOSING[data[np.where(some, last, 0)]]
    tail = np.flatnonzero(some & ~closed)
    for mark in _CLOSING_TAIL:
        b = mark.encode()
        k = tail[last[tail] - ls[tail] + 1 >= len(b)]
        hit = np.ones(len(k), bool)
        for j, x in enumerate(b):
            hit &= data[last[k] - len(b) + 1 + j] == x
        closed[k[hit]] = True
    bad = ~closed & (words < rules.open_line_words)
    bad |= texts.total(_SYMBOL[data], ls, le) > rules.max_symbols_per_word * words
    bad |= texts.total(_SHOUT[data], ls, le) > np.maximum(1, rules.max_shouts_per_word * words)
    links = texts.total(_LINK[data], ls, le)
    bad |= (links >= 3) & (links > rules.max_links_per_word * words)
    raw = data.tobytes().lower()
    for phrase in BOILERPLATE:
        p, at = phrase.encode(), raw.find(phrase.encode())
        while at >= 0:
            line = int(np.searchsorted(ls, at, "right")) - 1
            if at + len(p) <= le[line] and words[line] <= rules.boilerplate_words:
                bad[line] = True
            at = raw.find(p, at + 1)
    return bad & some


SCORE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_bad_lines long, kept_words long"
)
_NAMES = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]


def score(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row of measures and verdicts for every row of ``docs`` (doc_id, text)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = _judge(Texts(part.column(1)), rules)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[k]) for k in _NAMES[1:])], names=_NAMES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, SCORE_SCHEMA)


def kept_documents(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged, all columns."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(_judge(Texts(part.column(part.schema.get_field_index(text))), rules)["kept"]))

    return docs.transform(map_batches, run, docs.schema)


def clean(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """The kept rows with their failing lines removed from the text."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                i = part.schema.get_field_index(text)
                texts = Texts(part.column(i))
                got = _judge(texts, rules)
                ls, le, lb, good = got["_lines"]
                raw = texts.data.tobytes()
                new = [b"\n".join(raw[ls[k] : le[k]] for k in range(a, b) if good[k]).decode() for a, b in zip(lb[:-1], lb[1:])]
                yield part.set_column(i, part.schema.field(i), pa.array(new, part.schema.field(i).type)).filter(pa.array(got["kept"]))

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType, True) for f in docs.schema])
    return docs.transform(map_batches, run, schema)


def oracle_sql(rules: QualityRules = QualityRules()) -> str:
    """The rows of :func:`score` from DuckDB, the verdict of the line rules included."""
    phrases = " OR ".join("contains(low, '{}')".format(p.replace("'", "''")) for p in BOILERPLATE)
    tail = "".join(_CLOSING_TAIL)
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
words AS (SELECT r, text, regexp_extract_all(text, '{word}') AS w FROM docs),
windows AS (
  SELECT r, unnest(generate_series(1, len(w) - {rules.window - 1})) AS i, unnest(list_transform(generate_series(1, len(w) - {rules.window - 1}), lambda i: list_slice(w, i, i + {rules.window - 1}))) AS g
  FROM words WHERE len(w) >= {rules.window}),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + {rules.window - 1})) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
judged AS (
  SELECT *, len(w) AS n, list_sum(list_transform(w, lambda x: length(x))) AS chars,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(line, '[!?]')) AS shouts, len(regexp_extract_all(line, '[|>/\\\\=~^]')) AS links,
         regexp_matches(w[-1], '[].!?:;"'')}}{tail}]$') AS closed,
         translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) AS stutter
  FROM (SELECT r, line, regexp_extract_all(line, '{word}') AS w FROM lines) WHERE len(w) > 0),
marked AS (
  SELECT *, (NOT closed AND n < {rules.open_line_words}) OR symbols > {rules.max_symbols_per_word}::DOUBLE * n
            OR shouts > greatest(1, {rules.max_shouts_per_word}::DOUBLE * n) OR (links >= 3 AND links > {rules.max_links_per_word}::DOUBLE * n)
            OR (n <= {rules.boilerplate_words} AND ({phrases})) OR (n >= {rules.open_line_words} AND stutter > {rules.max_stutter}::DOUBLE * n) AS bad
  FROM judged),
by_doc AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (bad) AS n_bad,
         coalesce(sum(chars) FILTER (NOT bad), 0) AS kept_chars, coalesce(sum(n) FILTER (NOT bad), 0) AS kept_words
  FROM marked GROUP BY r),
base AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(b.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(b.n_lines, 0)::BIGINT AS n_lines, coalesce(b.n_bad, 0)::BIGINT AS n_bad_lines, coalesce(b.kept_chars, 0) AS kept_chars, coalesce(b.kept_words, 0)::BIGINT AS kept_words
  FROM docs d JOIN words w USING (r) LEFT JOIN covered c USING (r) LEFT JOIN by_doc b USING (r)),
failed AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND kept_chars >= {rules.min_kept}::DOUBLE * word_chars AND kept_words >= {rules.min_kept_words} AS kept, n_lines, n_bad_lines, kept_words
FROM failed"""
