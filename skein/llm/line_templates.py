"""Line dedup by a log-template tree, in DataFrame operations only.

A line goes down a tree of fixed depth: the number of its tokens, then its
leading tokens (a token with a digit counts as a variable field). Among the
different lines of a leaf, a token that enough of them share at its place is a
constant of the template, any other is a variable field. Lines of which too
little is constant keep their own tokens. A line of fewer than ``min_tokens``
tokens is a leaf of its own: only its tokens with a digit are fields, and a line
that has no others stays as it is. Templates that recur in ``min_docs`` documents
or more are dropped from all of them.

Plan: leaves are counted first, with partial sums, and only lines of leaves with
``min_docs`` lines or more go on (most prose stands alone in its leaf). They are
reduced to different lines with counts before tokens are exploded, so a line
that holds a third of all rows is one row from there on, and documents are
counted by (template, document) pairs, so a hot template is spread. Hot rows
meet only in joins with one row a key on the other side, read from files, which Spark may split.
A leaf's constants are a list by place, so the work on a line grows with its length.

Defined cases: a null or empty text has no lines; blank lines are never dropped; texts
and lines of any length are worked on whole;
rows of equal id count as one document in a template's count, and each row gets its own result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.scratch import written

FIELD = "<*>"
#: Keys of shared leaves that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_LEAVES = 2_000_000
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class TemplateRules:
    #: Leading tokens on the way down the tree.
    depth: int = 3
    #: Fewest tokens of a line that is generalised; shorter ones are literal but for digits.
    min_tokens: int = 4
    #: A token is constant if so large a share of the leaf's different lines have it at its place.
    constant_share: float = 0.2
    #: A line is generalised if so large a share of its tokens is constant.
    similarity: float = 0.6
    min_docs: int = 10


def _masked(text: Column) -> Column:
    """Tokens with a digit become the field's mark."""
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(text)


def _count(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1


def _text(line: Column, rules: TemplateRules) -> Column:
    """The line as it goes down the tree: masked, unless it is short and nothing would be left."""
    masked = _masked(line)
    nothing = F.replace(F.replace(masked, F.lit(FIELD), F.lit("")), F.lit(" "), F.lit("")) == ""
    return F.when((_count(line) < rules.min_tokens) & nothing, line).otherwise(masked)


def lines(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """``doc_id, line_no, line, leaf``: the lines that can have a template; numbers start at 1.

    ``line`` has single spaces and is not masked yet. Plain string functions do
    the work on all lines; regular expressions see odd white space and digits only.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("pos", "line"))
    odd = reduce(lambda a, b: a | b, (F.contains("line", F.lit(c)) for c in ("  ", "\t", "\x0b", "\x0c", "\r")))
    single = F.when(odd, F.regexp_replace("line", SPACES, " ")).otherwise(F.col("line"))
    cut = cut.select("doc_id", (F.col("pos") + 1).cast("long").alias("line_no"), F.btrim(single).alias("line")).where("line <> ''")
    cut = cut.withColumn("n", _count(F.col("line")))
    lead = F.when(F.col("n") < rules.min_tokens, _text(F.col("line"), rules)).otherwise(_masked(F.substring_index("line", " ", rules.depth)))
    return cut.select("doc_id", "line_no", "line", F.concat_ws(" ", F.col("n").cast("string"), lead).alias("leaf"))


def templates(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> tuple[DataFrame, DataFrame]:
    """The lines of shared leaves with their template's key; and the templates that recur.

    ``(doc_id, line_no, template)`` and ``(template, n_docs)``; a template is its text.
    """
    keyed = lines(docs, rules).withColumn("leaf_key", F.xxhash64("leaf"))
    shared = keyed.select("leaf_key").groupBy("leaf_key").agg(F.count("*").alias("n")).where(F.col("n") >= rules.min_docs).select("leaf_key")
    shared = written(shared, "template-leaves")
    few = shared.count() <= BROADCAST_LEAVES
    some = keyed.join(F.broadcast(shared) if few else shared, "leaf_key", "left_semi")
    hot = written(some.select("doc_id", "line_no", "leaf", _text(F.col("line"), rules).alias("line")), "template-lines")
    different = hot.groupBy("leaf", "line").agg(F.count("*").alias("n")).withColumn("tokens", F.split("line", " "))
    placed = different.select("leaf", F.posexplode("tokens").alias("pos", "token"))
    support = placed.groupBy("leaf", "pos", "token").agg(F.count("*").alias("n"))
    often = F.when(F.col("n") >= rules.constant_share * F.col("n_lines"), F.col("token"))
    sizes = placed.groupBy("leaf", "pos").agg(F.count("*").alias("n_lines"))  # each of a leaf's lines has one token at each place
    by_place = support.join(sizes, ["leaf", "pos"]).groupBy("leaf", "pos").agg(F.collect_set(often).alias("tokens"))  # at most 1 / constant_share
    constants = by_place.groupBy("leaf").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tokens"))), lambda x: x["tokens"]).alias("constants"))
    known = different.join(written(constants, "template-constants"), "leaf")
    fixed = F.transform("tokens", lambda t, k: F.array_contains(F.get("constants", k), t) & (t != FIELD))
    share = F.size(F.filter("fixed", lambda x: x))
    general = F.zip_with("tokens", "fixed", lambda t, f: F.when(f, t).otherwise(F.lit(FIELD)))
    template = F.when(share >= rules.similarity * F.size("tokens"), F.array_join(general, " ")).otherwise(F.col("line"))
    by_line = written(known.withColumn("fixed", fixed).select("leaf", "line", template.alias("template")), "template-of-line")
    matched = written(hot.join(by_line, ["leaf", "line"]).select("doc_id", "line_no", "template"), "template-matches")
    recurring = (
        matched.select("template", "doc_id").distinct().groupBy("template").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= rules.min_docs)
    )
    return matched, written(recurring, "template-recurring")


def dropped_lines(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """``doc_id, line_no, template`` of every line that goes."""
    matched, recurring = templates(docs, rules)
    return matched.join(recurring, "template", "left_semi").select("doc_id", "line_no", "template").distinct()


def per_document(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped`` for every row; ``dropped``: line numbers, comma-joined."""
    gone = dropped_lines(docs, rules).groupBy("doc_id").agg(F.sort_array(F.collect_list("line_no")).alias("gone"))
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("n_lines"))
    base = base.withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("long")).alias("d")
    joined = base.join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")), "left")
    return joined.select(
        "d.doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("dropped"),
    )


def without_templates(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """``docs`` with the lines of recurring templates removed from ``text``; other columns pass through."""
    gone = dropped_lines(docs, rules).groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone"))
    gone = gone.withColumnRenamed("doc_id", "__id")
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left")
    rest = F.filter(F.split("text", "\n"), lambda _, k: ~F.array_contains("__gone", (k + 1).cast("long")))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)


def oracle_sql(rules: TemplateRules = TemplateRules()) -> str:
    """The rows from DuckDB: templates are compared as texts there too."""
    return f"""
WITH cut AS (
  SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no,
         unnest(string_split(text, chr(10))) AS raw
  FROM documents WHERE text IS NOT NULL),
tokened AS (
  SELECT doc_id, line_no, string_split_regex(regexp_replace(raw, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '[\\x20\\x09-\\x0D]+') AS t FROM cut),
masked AS (
  SELECT doc_id, line_no, t, list_transform(t, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS m
  FROM tokened WHERE t <> ['']),
lines AS (
  SELECT doc_id, line_no,
         CASE WHEN len(t) < {rules.min_tokens} AND replace(replace(array_to_string(m, ' '), '{FIELD}', ''), ' ', '') = '' THEN t ELSE m END AS tokens
  FROM masked),
keyed AS (
  SELECT *, concat_ws(' ', len(tokens), array_to_string(tokens[1:CASE WHEN len(tokens) < {rules.min_tokens} THEN len(tokens) ELSE {rules.depth} END], ' ')) AS leaf,
         array_to_string(tokens, ' ') AS line
  FROM lines),
hot AS (SELECT * FROM keyed WHERE leaf IN (SELECT leaf FROM keyed GROUP BY leaf HAVING count(*) >= {rules.min_docs})),
different AS (SELECT leaf, line, any_value(tokens) AS tokens FROM hot GROUP BY leaf, line),
placed AS (SELECT leaf, line, unnest(tokens) AS token, unnest(generate_series(1, len(tokens))) AS pos FROM different),
support AS (SELECT leaf, pos, token, count(*) AS n FROM placed GROUP BY ALL),
sizes AS (SELECT leaf, count(*) AS n_lines FROM different GROUP BY leaf),
fixed AS (
  SELECT p.leaf, p.line, p.pos, p.token, s.n >= {rules.constant_share} * z.n_lines AND p.token <> '{FIELD}' AS fixed
  FROM placed p JOIN support s USING (leaf, pos, token) JOIN sizes z USING (leaf)),
templates AS (
  SELECT leaf, line, CASE WHEN count(*) FILTER (fixed) >= {rules.similarity} * count(*)
    THEN string_agg(CASE WHEN fixed THEN token ELSE '{FIELD}' END, ' ' ORDER BY pos) ELSE line END AS template
  FROM fixed GROUP BY leaf, line),
matched AS (SELECT doc_id, line_no, template FROM hot JOIN templates USING (leaf, line)),
gone AS (
  SELECT DISTINCT doc_id, line_no FROM matched
  WHERE template IN (SELECT template FROM matched GROUP BY template HAVING count(DISTINCT doc_id) >= {rules.min_docs})),
lists AS (SELECT doc_id, count(*) AS n, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS dropped FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(l.n, 0)::BIGINT AS n_dropped, coalesce(l.dropped, '') AS dropped
FROM documents d LEFT JOIN lists l ON d.doc_id IS NOT DISTINCT FROM l.doc_id"""
