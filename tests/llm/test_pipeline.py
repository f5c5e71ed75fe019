"""The pipeline on planted rows."""

from collections import Counter

import corpus_pipeline
from skein.llm.scratch import cleared, written


def test_failing_lines_do_not_go_on(spark, frame, words):
    page = words(60, 10) + "\nPrivacy policy | Terms of use\n" + words(40, 12)
    (row,) = corpus_pipeline.quality_rules(spark, frame([(1, page), (2, "too short")]), "").collect()
    assert row.doc_id == 1 and "Privacy" not in row.text and row.text.startswith(words(60, 10)[:50])


def test_stages(spark, frame, words, tmp_path):
    items = [(k, words(14, k) + "\n" + words(20, k + 900)) for k in range(10)]
    clean = [(k, words(70, k + 50), f"s{k % 3}") for k in range(100, 160)]
    copies = [(300 + k, clean[k][1], "s0") for k in range(20)]
    near = [(400 + k, clean[k][1] + " tail", "s1") for k in range(10)]
    leaks = [(500 + k, words(60, k + 7000) + " " + items[k][1], "s2") for k in range(5)]
    junk = [(600 + k, "too short", "s0") for k in range(5)] + [(700, None, "s0"), (None, "", "s0")]
    frame(clean + copies + near + leaks + junk).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        docs = written(out, name)
        seen.append(Counter(r.doc_id for r in docs.collect()))
    ids = {i for i, *_ in clean}
    assert set(seen[0]) == ids | {i for x in (copies, near, leaks) for i, *_ in x}
    assert set(seen[1]) == ids | {i for i, *_ in leaks} and set(seen[2]) == ids
    assert set(seen[3]) <= ids and max(seen[3].values()) <= 3
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in result) == seen[3]
    assert sorted(r.start for r in result)[0] == 0


def test_odd_rows(spark, frame, words, edges, tmp_path):
    """Nulls, empty and very long texts, repeated rows and further columns of clashing names, through every stage."""
    long = "\n".join(words(40, k) for k in range(900))
    data = [(*e, "edge") for e in edges] + [(k, words(70, k + 50), f"s{k % 2}") for k in range(100, 130)] + [(800, long, "s0"), (900, words(80, 4), None), (900, words(80, 4), None)]
    frame(data, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (2, ""), (None, words(30, 8))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        docs = written(out, name)
        kept = Counter(r.doc_id for r in docs.collect())
    assert {*range(100, 130), 900} - set(kept) <= set(range(100, 130)) and set(kept) <= {*range(100, 130), 800, 900}
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in result) == kept


def test_empty_tables(spark, frame, tmp_path):
    frame([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_work_tables_go(spark, frame):
    import os

    with cleared(spark):
        t = written(frame([(1, "a")]), "gone")
        (path,) = {os.path.dirname(f).removeprefix("file://") for f in t.inputFiles()}
        assert os.path.isdir(path)
    assert not os.path.exists(path)
