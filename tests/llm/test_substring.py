"""Repeated runs of sentences (op10) against brute force and the SQL."""

import random
import re
from collections import defaultdict

import pytest

from skein.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STOP = re.compile(r"([.!?][\"')\]]?|[。！？])$")


def rows(df):
    return [r.asDict() for r in df.collect()]


def sentences(text):
    """Word spans, and begin and end of every sentence in words."""
    at = [(m.start(), m.end()) for m in WORD.finditer(text)]
    stops = [k + 1 for k, (s, e) in enumerate(at) if k + 1 == len(at) or "\n" in text[e : at[k + 1][0]] or STOP.search(text[s:e])]
    return at, list(zip([0, *stops[:-1]], stops))


def brute(data, n):
    """Words that go, by row: every run of sentences, tried one by one."""
    seen, gone = {}, defaultdict(set)
    for i, text in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        at, parts = sentences(text or "")
        found = set()
        for k in range(len(parts)):
            ends = [e for _, e in parts[k:] if e - parts[k][0] >= n]
            begins = [b for b, _ in parts[: k + 1] if parts[k][1] - b >= n]
            found |= {(parts[k][0], ends[0])} if ends else set()
            found |= {(begins[-1], parts[k][1])} if begins else set()
        for b, e in sorted(found):
            key = " ".join(text[x:y].lower() for x, y in at[b:e])
            if seen.setdefault(key, (i, b)) != (i, b):
                gone[i] |= set(range(b, e))
    return gone


def corpus(words):
    r = random.Random(11)
    passage, short = words(60, 2), "\n".join(words(5, 600 + 2 * k).replace("\n", " ") for k in range(12))
    data = [(1, short), (2, "Head.\n" + short + "\nTail."), (3, words(30, 20) + " " + passage + " " + words(30, 22)), (4, words(31, 24) + "\n" + passage.upper().replace(" ", "  "))]
    stock = [words(r.randint(3, 60), 700 + 2 * k) for k in range(30)]
    data += [(10 + k, r.choice([" ", "\n", "\n\n"]).join(r.choice(stock) if r.random() < 0.4 else words(r.randint(1, 30), 800 + 9 * k + j) for j in range(8))) for k in range(60)]
    data += [(100, (words(40, 30) + "\n") * 2), (101, "ha " * 90), (102, "y " * 30 + "\n" + "y " * 30), (103, "same words again. " * 20), (104, 'He said "no." ' * 9), (105, "日本語です。 " * 20 + "終"), (106, "a b. c d! e f? " * 9)]
    return data


@pytest.mark.parametrize("n", [1, 4, 16])
def test_substrings_against_brute_force(frame, words, edges, n):
    data = [(i and i + 1000, t) for i, t in edges] + corpus(words)
    want = {i: x for i, x in brute(data, n).items() if x}
    got = {r["doc_id"]: r["__gone"] for r in rows(substring.with_removals(frame(data, extra=True), n)) if r["__gone"]}
    assert {i: r["removed_words"] for i, r in got.items()} == {i: len(x) for i, x in want.items()}
    text = dict(data)
    for i, r in got.items():
        at, _ = sentences(text[i])
        assert {k for k, (s, e) in enumerate(at) for x in r["spans"] if x["start"] <= s and e <= x["end"]} == want[i]
        assert r["n_removed"] == len(r["spans"]) and r["removed_chars"] == sum(x["end"] - x["start"] for x in r["spans"])
    out = {r["doc_id"]: r["text"] for r in substring.deduplicated(frame(data, extra=True), n).collect()}
    for i, t in text.items():
        left = "".join(c for k, c in enumerate(t or "") if i not in got or not any(x["start"] <= k < x["end"] for x in got[i]["spans"]))
        assert (out[i] or "") == left


def test_passages_inside_lines_and_over_short_lines_go(frame, words):
    got = {r["d"]: r for r in rows(substring.removals(frame(corpus(words))))}
    assert got[2]["removed_words"] == 60 and got[4]["removed_words"] >= 60 and not {1, 3} & set(got)


def test_rows_of_one_id(frame, words):
    a, b = words(40, 31), words(50, 33)
    docs = frame([(1, a), (1, a), (1, b), (2, a), (2, b + "\n" + b)])
    got = sorted((r["d"], r["removed_words"]) for r in rows(substring.removals(docs)))
    assert got == [(2, 40), (2, 100)]
    assert sorted(len(WORD.findall(r.text)) for r in substring.deduplicated(docs).collect()) == [0, 0, 40, 40, 50]


def test_substrings_of_nothing(frame):
    assert substring.removals(frame([])).count() == 0
    assert substring.deduplicated(frame([(1, None), (2, "")])).count() == 2


def test_substrings_are_those_of_the_sql(spark, frame, words, edges, tmp_path):
    import duckdb

    docs = frame([e for e in edges if e[0] != 5] + corpus(words) + [(2, corpus(words)[1][1])])
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = con.execute(f"select doc_id, n_removed, removed_words, removed_chars, spans from ({substring.oracle_sql()})").fetchall()
    got = [(r["doc_id"], *((g["n_removed"], g["removed_words"], g["removed_chars"], ",".join(f"{x['start']}:{x['end']}" for x in g["spans"])) if (g := r["__gone"]) else (0, 0, 0, ""))) for r in substring.with_removals(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
