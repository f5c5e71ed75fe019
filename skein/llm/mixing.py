"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents. A document finishes at the
virtual time (words its source has sent by then) / (its source's target), and
the documents of all queues go out in the order of their virtual finish times
until the next would pass the total budget, so the words left of it are fewer than
that document has. A source whose target exceeds its size goes
round its queue again, at most ``max_repeats`` times in all.

No source, however large, meets in one task: positions in a queue come from sums
over ranges of the shuffling hash (their number grows with the source) and a
window inside a range, and the cut by the budget from sums over bins of virtual
time and an order inside the one bin in which the budget runs out. Rows are counted
by id, source and text first, and copies of one row are dealt out by their number.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 are never taken, whole texts of any length are; rows of equal id,
source and text are as many documents, which :func:`mixed_documents` cannot tell
apart; rows of null id are shuffled by their texts; with no words at all every target is 0, and an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Rows that one bucket of a source holds on average, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 20_000, 32
#: Sources whose targets may be broadcast (about 60 bytes each), and that may stand on the driver (about 300 bytes each).
BROADCAST_SOURCES, MOST_SOURCES = 100_000, 2_000_000
#: Bins of virtual time: 2**20 over one unit.
TIME_BINS = 1 << 20


def words(text: Column) -> Column:
    """The number of words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], share: float, max_repeats: int, weights=WEIGHTS) -> dict:
    """Target words by source: by weight, capped at ``max_repeats`` sizes, the excess dealt again.

    ``sizes``: words by source; one row a source, so this is small and stays on the driver.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-8")))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(order)}
    cap = {s: float(max_repeats * n) for s, n in order}
    left, open_, out = share * sum(n for _, n in order), [s for s, _ in order], {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap[s]
        left -= sum(cap[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def _digits(text: Column) -> Column:
    """A number below 2**60 from the md5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _same(text: Column) -> Column:
    """Tells rows of one id and source with other texts apart; -1 for null."""
    return F.coalesce(_digits(text.cast("string")), F.lit(-1).cast("long"))


def mix(docs: DataFrame, share: float = 1.0, max_repeats: int = 3, seed: int = 0, weights=WEIGHTS) -> DataFrame:
    """``doc_id, size, source, t, source_size, target, n_taken``: one row for every row of ``docs``.

    ``n_taken`` is how often the mix takes the row; ``t`` stands for the text. Reruns agree: the shuffle is a
    hash of ``seed``, the id, the text, and the number of the copy.
    """
    spark = docs.sparkSession
    kinds = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words(F.col("text")).alias("size"), _same(F.col("text")).alias("t"))
    sized = written(kinds.groupBy("doc_id", "source", "size", "t").agg(F.count("*").alias("m")), "mix-sizes")
    by_source = written(sized.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("size"), F.sum("m").alias("n")), "mix-sources")
    n_sources = by_source.count()
    if n_sources > MOST_SOURCES:
        raise ValueError(f"{n_sources} sources; at most {MOST_SOURCES} can be mixed")
    per_source = [(r.source, r.size, r.n) for r in by_source.collect()]
    goal = targets([(s, n) for s, n, _ in per_source], share, max_repeats, weights)
    # one row a source: (source, its words, its target, its number of buckets)
    table = spark.createDataFrame(
        [(s, n, float(goal.get(s, 0.0)), max(LEAST_BUCKETS, -(-k // BUCKET_ROWS))) for s, n, k in per_source],
        "source string, source_size long, target double, n_buckets long",
    )
    key = F.col("d.source").eqNullSafe(F.col("t.source"))
    each = sized.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("t").cast("string"), F.col("copy").cast("string"))
    hashed = each.withColumn("h", _digits(named))
    joined = hashed.alias("d").join(F.broadcast(table.alias("t")) if n_sources <= BROADCAST_SOURCES else table.alias("t"), key)
    # ranges of the hash, so that a queue's order is that of the hash
    bucket = F.shiftright(F.shiftright("h", 30) * F.col("n_buckets"), 30)
    rows = joined.select("d.doc_id", "d.source", "size", "d.t", "source_size", "target", "h", bucket.alias("bucket"))
    # where every bucket of a queue begins: one row a bucket
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")).select(
        "source", "bucket", F.coalesce(F.sum("words").over(by_bucket), F.lit(0)).alias("begin")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "t").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("upto", F.sum("size").over(inside))
        .alias("a")
        .join(begin.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket")))
        .select("a.doc_id", "a.source", "size", "t", "source_size", "target", "h", (F.col("begin") + F.col("upto")).alias("sent"))
    )
    placed = written(placed, "mix-queues")
    budget = int(round(share * sum(n for _, n, _ in per_source)))
    # every time a document would go out: once a round
    finish = (F.col("round") * F.col("source_size") + F.col("sent")) / F.col("target")

    def sent(last_round: Column) -> DataFrame:
        return (
            placed.where("size > 0 AND target > 0")
            .withColumn("round", F.explode(F.sequence(F.lit(0), F.least(F.lit(max_repeats - 1), last_round))))
            .withColumn("finish", finish)
            .withColumn("bin", F.floor(F.col("finish") * TIME_BINS))
        )

    # the budget runs out about virtual time 1, unless long documents end far behind it
    soon = TIME_BINS + TIME_BINS // 64
    sends = sent(F.ceil(F.col("target") / F.col("source_size")).cast("int")).where(F.col("bin") <= soon)
    bound, spent = _last_bin(sends, budget, soon)
    if bound > soon:
        sends = sent(F.lit(max_repeats - 1))
        bound, spent = _last_bin(sends, budget, sends.agg(F.max("bin")).first()[0] or 0)
    # the bin in which the budget runs out is a 2**-20th of the mix
    order = Window.orderBy("finish", "source", "h", "doc_id", "round").rowsBetween(Window.unboundedPreceding, 0)
    edge = sends.where(F.col("bin") == bound).withColumn("upto", F.sum("size").over(order)).where(F.col("upto") <= budget - spent)
    taken = sends.where(F.col("bin") < bound).select("doc_id", "source", "sent").unionByName(edge.select("doc_id", "source", "sent"))
    counts = taken.groupBy("source", "sent", "doc_id").agg(F.count("*").alias("n_taken"))
    a, b = placed.alias("a"), counts.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.sent") == F.col("b.sent")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("size") > 0)
    return a.join(b, same, "left").select(
        "a.doc_id", "size", "a.source", "t", "source_size", "target", F.coalesce("n_taken", F.lit(0)).cast("int").alias("n_taken")
    )


def _last_bin(sends: DataFrame, budget: int, last: int) -> tuple[int, int]:
    """The bin of virtual time in which the budget runs out, and the words before it; beyond ``last`` if it does not.

    Coarse bins first, then finer ones of that coarse one: at most 2,048 rows, and
    1,024 a step after it, reach the driver, whatever the input.
    """
    spent, shift, some = 0, max(10, last.bit_length() - 11), sends
    while True:
        for c, w in sorted((r.c, r.w) for r in some.groupBy(F.shiftright("bin", shift).alias("c")).agg(F.sum("size").alias("w")).collect()):
            if spent + w > budget:
                break
            spent += w
        else:
            return last + 1, spent
        if shift == 0:
            return c, spent
        some, shift = sends.where(F.shiftright("bin", shift) == c), max(0, shift - 10)


def mixed_documents(docs: DataFrame, share: float = 1.0, max_repeats: int = 3, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, a row twice where it is taken twice.

    Of rows with equal id, source and text the first that is met stands for all, as often as the mix takes them together.
    """
    taken = mix(docs, share, max_repeats, seed).groupBy("doc_id", "source", "t").agg(F.sum("n_taken").alias("__n"), F.count("*").alias("__m")).where("__n > 0")
    taken = written(taken.select(F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("t").alias("__u"), "__n", "__m"), "mix-taken")
    keyed = docs.withColumn("__t", _same(F.col("text")))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__d")) & F.col("source").cast("string").eqNullSafe(F.col("__s")) & (F.col("__t") == F.col("__u"))
    rows = keyed.join(taken.hint("merge"), on)  # there is a row for most documents, so it is no side to broadcast
    if not taken.where("__m > 1").isEmpty():
        rows = rows.where("__m = 1").unionByName(rows.where("__m > 1").dropDuplicates(["__d", "__s", "__u"]))
    return rows.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*docs.columns)


def oracle_sql(max_repeats: int = 3, seed: int = 0, weights=WEIGHTS) -> str:
    """The query's rows from DuckDB: one order of all sends, for a table of unlike rows and the whole budget."""
    weight = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights))
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS t
  FROM documents),
queue AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size, t ROWS UNBOUNDED PRECEDING) AS sent
  FROM (SELECT *, ('0x' || substr(md5(concat_ws(':', '{seed}', coalesce(doc_id::VARCHAR, ''), t, '1')), 1, 15))::BIGINT AS h FROM docs)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, {max_repeats}.0::DOUBLE * sum(size) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END::DOUBLE AS w
  FROM docs GROUP BY source),
fill AS (
  SELECT *, 0 AS step, (sum(source_size) OVER ())::DOUBLE AS rest, false AS held FROM sources
  UNION ALL
  SELECT source, source_size, cap, w, step + 1, rest - sum(CASE WHEN over THEN cap ELSE 0 END) OVER (), held OR over
  FROM (
    SELECT *, bool_or(over) OVER () AS more
    FROM (SELECT *, NOT held AND rest * w / sum(CASE WHEN held THEN 0 ELSE w END) OVER () > cap AS over FROM fill))
  WHERE more),
goal AS (
  SELECT source, source_size, CASE WHEN held THEN cap ELSE rest * w / sum(CASE WHEN held THEN 0 ELSE w END) OVER () END AS target
  FROM fill WHERE step = (SELECT max(step) FROM fill)),
sends AS (
  SELECT q.*, g.source_size, g.target, r, (r * g.source_size + q.sent)::DOUBLE / g.target AS finish
  FROM queue q JOIN goal g ON q.source IS NOT DISTINCT FROM g.source, range({max_repeats}) x(r) WHERE size > 0 AND g.target > 0),
gone AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, h, doc_id NULLS FIRST, r ROWS UNBOUNDED PRECEDING) AS upto FROM sends),
taken AS (
  SELECT doc_id, source, t, count(*) AS n FROM gone WHERE upto <= (SELECT sum(size) FROM docs) GROUP BY ALL)
SELECT q.doc_id, q.size::BIGINT AS size, g.source_size, g.target, (q.size * coalesce(k.n, 0))::BIGINT AS taken
FROM queue q JOIN goal g ON q.source IS NOT DISTINCT FROM g.source
LEFT JOIN taken k ON q.doc_id IS NOT DISTINCT FROM k.doc_id AND q.source IS NOT DISTINCT FROM k.source AND q.t = k.t"""
