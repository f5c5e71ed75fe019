"""Each operator against brute force on small rows, and on odd rows and empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.llm import decontamination, line_templates, mixing, near_duplicates, pii, quality, token_counts, token_files, toxicity
from skein.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [r.asDict() for r in df.collect()]


# -- op1 -------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_number_coding_round_trip(seed):
    r = np.random.default_rng(seed)
    v = r.integers(0, 1 << r.choice([8, 16, 24, 32], size=r.integers(0, 999)).astype(np.int64)).astype(np.uint32)
    assert (token_files.unpack(*token_files.pack(v), len(v)) == v).all()


PIECES = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'", "''", "'ll", "don't", "é", "ß", "日本", "、", "—", "“", "1", "23", "½", "٣", ".", ",", "!!", "_", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "😀", "e\u0301", "'S", "'d", "'ve", "x'tis", "aaaaaaa", "<|endoftext|>", "ſ", "ǅ", "\ufeff", "Ⅷ", "²"]


@pytest.mark.parametrize("seed", range(4))
def test_encoder_is_the_library(words, seed):
    import random

    from tokenizers import Tokenizer

    r = random.Random(seed)
    path = tokenizer_path("byte_bpe_50k.json")
    texts = [words(n, n) for n in range(1, 40)] + ["", " a", "a  b", "a\n\nb ", "x<|endoftext|>y", "é日本　z", "it's 3.14,ok", "a \nb", "\n", "A.\nB, c", "x" * 5000, "ab" * 999 + "'", None]
    plain = [x for x in PIECES if all(c < "\x7f" for c in x) and "<" not in x and min(x) > "\x08"]
    texts += ["".join(r.choice(plain if k % 2 else PIECES) for _ in range(r.randint(0, 30))) for k in range(3000)]
    r.shuffle(texts)
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    ids, counts = token_files.Encoder(path).encode(pa.array(texts))
    ends = np.cumsum(counts)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, counts)]
    assert [t for t, x, y in zip(texts, got, want) if x != y] == []


def test_every_letter_is_cut_as_by_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    texts = [f"a{c}1 {c}{c}\n{c}'s" for k in [*range(0xD800), *range(0xE000, 0x10400)] if (c := chr(k))]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    ids, counts = token_files.Encoder(path).encode(pa.array(texts))
    assert counts.tolist() == [len(x.ids) for x in want] and ids.tolist() == [i for x in want for i in x.ids]


def test_token_files(spark, frame, edges, words):
    from tokenizers import Tokenizer

    data = edges + [(k, words(30, k)) for k in range(10, 40)]
    path = token_files.token_files(frame(data, extra=True), tokenizer_path("byte_bpe_50k.json"))
    got = sorted(rows(token_files.read(spark, path)), key=lambda r: r["start"])
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(got) == len(order)
    for g, (i, text) in zip(got, order):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        assert (g["doc_id"], g["start"], g["n_tokens"]) == (i, start, len(ids))
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_of_nothing(spark, frame):
    path = token_files.token_files(frame([]), tokenizer_path("byte_bpe_50k.json"))
    assert token_files.read(spark, path).collect() == []


# -- op2 -------------------------------------------------------------------------


def test_block_max_wand_is_exhaustive(words):
    items = [(k, words(12, k) + "\n" + words(15, k + 500)) for k in range(60)]
    index = decontamination.Index(items, 0.3)
    r = np.random.default_rng(1)
    for k in range(60):
        own = index.codes(decontamination.terms(pa.array([items[k][1]]))[0])[1].tolist()
        query = sorted({*r.choice(len(index.vocabulary), 40, replace=False).tolist(), *own[: int(r.integers(0, len(own)))]})
        score = defaultdict(float)
        for t in query:
            for j in range(index.begin[t], index.begin[t + 1]):
                score[int(index.item[j])] += index.weight[j]
        want = {i: s for i, s in score.items() if s >= 0.3 - 1e-9}
        assert dict(index.retrieve(query)) == pytest.approx(want)
        if want:
            assert len(index.hopeful(np.zeros(len(query), np.int64), np.array(query)))


def test_decontamination(spark, frame, edges, words):
    items = [(k, words(14, k) + "\n" + words(20, k + 900)) for k in range(20)]
    bench = spark.createDataFrame(items + [(98, None), (99, "")], "item_id long, text string")
    data = edges + [(100 + k, words(400, k + 2000)) for k in range(12)]
    planted = [(200 + k, words(150, k + 3000) + " " + items[k][1].replace("\n", " ") + " " + words(90, k + 4000)) for k in range(10)]
    docs = frame(data + planted, extra=True)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect()}
    assert {(200 + k, k) for k in range(10)} <= got and {d for d, _ in got} == {200 + k for k in range(10)}
    kept = decontamination.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in data)
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(frame([]), bench).count() == 0


def test_shards_do_not_change_what_is_found(frame, spark, words, monkeypatch):
    items = [(k, words(14, k) + "\n" + words(20, k + 900)) for k in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame([(k, words(50, k + 70) + " " + items[k][1]) for k in range(12)])
    assert [len(s) for s in decontamination.shards(bench, 100)] == [3, 3, 3, 3]
    monkeypatch.setattr(decontamination.shards, "__defaults__", (100,))
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} >= {(k, k) for k in range(12)}


def test_scores_are_those_of_the_whole_benchmark(frame, spark, words, monkeypatch):
    import random

    r = random.Random(6)
    items = [(k, words(10 + 3 * k, k) + "\n" + words(20, k + 900)) for k in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    data = []
    for k, text in items:  # altered copies: some words of each are replaced
        for share in (0.05, 0.1, 0.2, 0.3):
            data.append((len(data), words(50, k + 70) + " " + " ".join(w if r.random() > share else "other" for w in text.split())))

    def found():
        return {(x["doc_id"], x["item_id"]): (x["score"], x["first_word"]) for x in rows(decontamination.contaminated(frame(data), bench))}

    one = found()
    monkeypatch.setattr(decontamination.shards, "__defaults__", (100,))
    many = found()
    assert len(list(decontamination.shards(bench))) > 3 and any(0.6 <= s < 0.9 for s, _ in one.values())
    assert set(many) == set(one) and all(many[k] == pytest.approx(one[k], abs=2e-6) for k in one)


# -- op3 -------------------------------------------------------------------------


def _toxic_rows(words, n):
    bad = ["scumbagx", "vilezor", "vilekan", "trashity"]
    out = []
    for k in range(n):
        t = words(60, k + 10_000)
        if k % 4 == 0:
            t += " " + bad[k // 4 % 4] + " " + words(10, k) + " " + bad[k // 8 % 4] + "."
        out.append((k, t, int(k % 4 == 0)))
    return out


def test_toxicity_held_out(spark, frame, edges, words):
    data = _toxic_rows(words, 600)
    docs = frame([(i, t) for i, t, _ in data], extra=True)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in data] + [(None, 1, 1), (5, 0, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in rows(toxicity.scored(docs, model))}
    held = [(i, y) for i, _, y in data if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100
    right = sum(got[i]["predicted"] == y for i, y in held) / len(held)
    assert right > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    odd = rows(toxicity.scored(frame(edges), model))
    assert len(odd) == len(edges) and len({r["score"] for r in odd if r["doc_id"] in (1, 2, 3)}) == 1
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in rows(toxicity.scored(docs, none))} == {0}


def test_label_model_discounts_repeated_voters():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    good = (r.random(4000) < np.where(y, 0.7, 0.02)).astype(float)
    other = (r.random(4000) < np.where(y, 0.6, 0.03)).astype(float)
    fires = np.column_stack([good, good, good, other])
    m = toxicity.LabelModel(fires, np.ones(4), 0.3)
    assert m.share[:3].max() < 0.4 and m.share[:3].max() < m.share[3]


def test_scores_against_brute_force(words):
    model, _ = toxicity.train(pa.array([t for _, t, _ in _toxic_rows(words, 300)]), np.array([y for *_, y in _toxic_rows(words, 300)], float), 0.25)
    texts = [t for _, t, _ in _toxic_rows(words, 80)] + ["", None, "SCUMBAGX!", "scumb"]
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    for text, got in zip(texts, model.score(pa.array(texts))):
        _, found, _ = toxicity.evidence(pa.array([text]))
        z = model.intercept + sum(weight.get(f, 0.0) for f in set(found.tolist()))
        assert got == pytest.approx(1 / (1 + np.exp(-z)))


def test_folds_of_null_ids(spark, frame):
    got = frame([(None, "a"), (1, "b"), (6, "c")]).select("doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out")).collect()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


# -- op4 -------------------------------------------------------------------------


def _multiset(text):
    w = WORD.findall(text)
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def _classes(data):
    sets = [(i, _multiset(t or "")) for i, t in data]
    parent = {i: i for i, _ in sets}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 10 * sum((x & y).values()) >= 8 * sum((x | y).values()) and i != j:
                p, q = sorted((top(i), top(j)))
                parent[q] = p
    return {i: top(i) for i in parent}


def _near_rows(words, seed=0):
    import random

    r, out = random.Random(seed), []
    for k in range(25):
        base = words(80, k + 100).split(" ")
        for _ in range(r.choice([1, 1, 2, 12, 30])):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = "edit" + str(r.randrange(10_000))
            out.append((len(out) + 1000, " ".join(w)))
    out += [(len(out) + 5000, "again and " * 40 + f"end{k % 2}") for k in range(6)] + [(9000, "a b"), (9001, "a  b"), (9002, "a c")]
    return out


@pytest.mark.parametrize("small", [2, 12])
def test_near_duplicates_are_exact(frame, words, monkeypatch, small):
    monkeypatch.setattr(near_duplicates, "SMALL", small)
    data = _near_rows(words)
    got = {r["doc_id"]: r["class_id"] for r in rows(near_duplicates.classes(frame(data, extra=True)))}
    assert got == _classes(data)


def test_near_duplicates_of_odd_rows(frame, edges):
    got = [(r["doc_id"], r["class_id"]) for r in rows(near_duplicates.classes(frame(edges)))]
    assert Counter(got) == Counter((i, i) for i, _ in edges)
    assert near_duplicates.classes(frame([])).count() == 0
    assert Counter(r["doc_id"] for r in near_duplicates.first_documents(frame(edges, extra=True)).collect()) == Counter({i for i, _ in edges})


def test_signatures_are_unbiased():
    r = np.random.default_rng(2)
    error = []
    for _ in range(40):
        a, b = r.integers(1, 9, 40), r.integers(0, 9, 40)
        b = np.where(r.random(40) < 0.7, a, b)
        keys = r.integers(0, 1 << 62, 40).astype(np.uint64)
        h, who, w = np.concatenate([keys, keys]), np.repeat([0, 1], 40), np.concatenate([a, b])
        s = near_duplicates.bag_minhash(h[w > 0], who[w > 0], w[w > 0], 2, 256)
        error.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(error)) < 0.015


def test_block_links_join_all_classes(words):
    data = _near_rows(words, 3)
    docs = np.array([i for i, _ in data])
    a, b = near_duplicates.block_links(docs, docs.copy(), pa.chunked_array([[t for _, t in data]]))
    parent = {i: i for i in docs.tolist()}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for x, y in zip(a.to_pylist(), b.to_pylist()):
        p, q = sorted((top(x), top(y)))
        parent[q] = p
    assert {i: top(i) for i in parent} == _classes(data)


# -- op5 -------------------------------------------------------------------------


def _base(text):
    w = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    n = len(w)
    return {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(x in "#*$%&|<>" for x in text or ""), "n_dup_lines": dup,
        "n_repeat_words": len(cover), "base_failed": n < 20 or 100 * len(cover) > 30 * n,
    }


def test_quality(frame, edges, words):
    clean = [(k, words(60, k)) for k in range(10, 40)]
    junk = [(50, " ".join(f"{w}%%%" for w in words(60, 1).split())), (51, "HOME | NEWS > SPORT | ABOUT | MORE\n" * 20 + words(5, 2)), (52, (words(15, 3) + " ") * 9)]
    data = edges + clean + junk + [(60, "a b\x0bc\x0cd e\n" * 9)]
    docs = frame(data, extra=True)
    got = rows(quality.score(docs))
    assert sorted(str({k: r[k] for k in ("doc_id", *_base(""))}) for r in got) == sorted(str({"doc_id": i} | _base(t)) for i, t in data)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert {i for i, _ in clean} <= kept and not kept & {50, 51, 52}
    out = quality.kept_documents(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    page = words(60, 9) + "\nPrivacy policy | Terms of use\n" + words(40, 11)
    (cleaned,) = rows(quality.clean(frame([(1, page)])))
    assert "Privacy" not in cleaned["text"] and cleaned["text"].startswith(words(60, 9)[:50])
    assert quality.score(frame([])).count() == 0


def test_quality_is_that_of_the_sql(spark, frame, edges, words, tmp_path):
    import random

    import duckdb

    r = random.Random(4)
    odd = ["Home | About | Contact", "a > b > c / d", "BUY NOW!!! REALLY?? YES!!", "$$$ ### ||| %%%", "no closing mark", "key key key key word word.", "Tous droits réservés, ici et partout.", "© 2020 Ürün", "Impressum", "He said: “yes”", "終わり。", "See our PRIVACY POLICY.", "one two three four five six", "", " \t ", "it ends;"]
    data = [(k, "\n".join(r.choice(odd) if r.random() < q else words(r.randint(1, 30), 50 * k + j) for j in range(r.randint(1, 14)))) for k in range(300) for q in [k % 5 / 4]]
    data += [(400 + k, (words(8, k) + " ") * (k + 1)) for k in range(6)]
    docs = frame([e for e in edges if e[0] != 5] + data, extra=True)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    names = quality._NAMES
    want = con.execute(f"select {', '.join(names)} from ({quality.oracle_sql()})").fetchall()
    got = rows(quality.score(docs))
    assert {True, False} == {g["kept"] for g in got if not g["base_failed"]}
    assert sorted(str(tuple(g[k] for k in names)) for g in got) == sorted(map(str, want))


# -- op6 -------------------------------------------------------------------------


def test_token_counts(frame, edges, words):
    import random

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    r = random.Random(3)
    alphabet = list("ab the\n .,é日\t▁<s>0😀   ") + ["ing ", "<s>", "the"]
    data = edges + [(100 + k, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))) for k in range(400)] + [(900 + k, words(50, k)) for k in range(20)]
    got = rows(token_counts.token_counts(frame(data, extra=True), tokenizer_path("piece_bpe_32k.model")))
    want = [{"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": (n := len(sp.encode(t or ""))), "over_limit": n > 4096} for i, t in data]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert token_counts.token_counts(frame([]), tokenizer_path("piece_bpe_32k.model")).count() == 0


# -- op7 -------------------------------------------------------------------------

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m.group())
            if k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split(".")) or k == 2 and 14 <= len(d) <= 19 and pii.luhn(d) or k == 3 and 10 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    import random

    r = random.Random(4)
    alphabet = list("0123456789  --..++@@()ab%_é\n") + ["4111111111111111", "+1 (523) 555-6688", "1.2.3.4", "a@b.c", "0255"]
    for _ in range(5000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(30)))
        assert pii.base_spans(t) == _plain(t), t


def test_field_on_held_out_windows():
    field = pii.trained()
    rows_ = pii.examples(seed=99, n=400)
    assert sum(set(field.decode(t)) == truth for t, truth in rows_) > 0.97 * len(rows_)


def test_decoding_is_the_best_segmentation():
    import itertools

    field = pii.trained()
    for text, _ in pii.examples(seed=5, n=12):
        cuts, by_end = field.segments(text)
        options = [(i, j, field._score(k, f)) for j, x in by_end.items() for i, k, f in x]
        best = 0.0
        for n in range(1, 4):
            for chosen in itertools.combinations(options, n):
                s = sorted(chosen)
                if all(a[1] <= b[0] for a, b in zip(s, s[1:])):
                    best = max(best, sum(x[2] for x in chosen))
        got = sum(next(field._score(k, f) for i, k2, f in by_end[cuts.index(e)] if cuts[i] == s and k2 == k) for s, k, e in field.decode(text))
        if len(options) <= 40:
            assert got == pytest.approx(max(best, got)) and got >= best - 1e-9


def test_pii(frame, edges, words):
    data = edges + [(10, "mail a.b@c.example.com or 10.0.0.1 now"), (11, "call (523) 555-6688 today"), (12, "joe [at] host [dot] org"), (13, words(50, 1)), (14, "0" * 5000 + ".1.1.1")]
    docs = frame(data, extra=True)
    got = {r["doc_id"]: r for r in rows(pii.found(docs))}
    for i, t in data:
        base = _plain(t or "") if i != 14 else [(0, 1, 5006)]
        assert got[i]["base_sha256"] == hashlib.sha256(pii.spell(base).encode()).hexdigest()
        assert set(filter(None, pii.spell(base).split(","))) <= set(got[i]["spans"].split(","))
    assert got[11]["spans"] == "phone:5:19" and got[12]["spans"].startswith("email:0:") and got[13]["n_added"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert clean[10] == "mail <email> or <ip> now" and clean[1] is None


# -- op8 -------------------------------------------------------------------------


def test_line_templates(frame, edges, words):
    rules = line_templates.TemplateRules(min_docs=5)
    data = [(k, words(25, k).replace("\n", " ") + f"\nPage {k} of 99 in this book\n" + f"Signed and sealed by {words(1, k)} on a fine day\n" + words(25, k + 300).replace("\n", " ")) for k in range(40)]
    docs = frame(edges + data, extra=True)
    got = {r["doc_id"]: r for r in rows(line_templates.per_document(docs, rules))}
    assert all(got[i]["dropped"].startswith("2") and got[i]["n_lines"] == 4 for i, _ in data)
    assert sum(got[i]["dropped"] == "2,3" for i, _ in data) >= 30
    assert line_templates.per_document(docs, rules).count() == len(edges) + len(data)
    out = {r["doc_id"]: r["text"] for r in line_templates.without_templates(docs, rules).collect()}
    assert all("Page" not in out[i] for i, _ in data if i > 7)
    assert line_templates.per_document(frame([]), rules).count() == 0


def test_line_templates_match_sql(spark, frame, words, tmp_path):
    import duckdb

    data = [(k, "\n".join(words(6, (k * 7 + j) % 23).replace("\n", " ") + f" nr {j}" for j in range(5))) for k in range(60)] + [(100, None), (101, "")]
    docs = frame(data)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = sorted(con.execute(f"select doc_id, n_lines, n_dropped, dropped from ({line_templates.oracle_sql()})").fetchall())
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["dropped"]) for r in rows(line_templates.per_document(docs))) == want


def test_short_lines_recur_too(spark, frame, words, tmp_path):
    import duckdb

    data = []
    for k in range(40):
        own = f"own{'abcdefghij'[k % 10] * (k // 10 + 1)}"
        text = [words(12, 2 * k).replace("\n", " "), "All  rights reserved." if k < 10 else own, f"Page {k}", f"{1000 + k}", "", "Les." if k > 30 else own + "."]
        data.append((k, "\n".join([*text, f"Printed on day {k} of the year"])))
    docs = frame(data)
    want = {k: [2, 3, 7] if k < 10 else [3, 7] for k in range(40)}

    def dropped(df):
        return {r["doc_id"]: [int(x) for x in r["dropped"].split(",") if x] for r in rows(line_templates.per_document(df))}

    assert dropped(docs) == want  # 'Les.' is in 9 documents, and a number alone has no constant token
    assert dropped(frame([*data, (99, "\n Les. \n1001")])) == {k: [3, 6, 7] if k > 30 else x for k, x in want.items()} | {99: [2]}
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    assert dict(con.execute(f"select doc_id, dropped from ({line_templates.oracle_sql()})").fetchall()) == {k: ",".join(map(str, x)) for k, x in want.items()}


def test_long_lines_of_a_shared_leaf(frame):
    import time

    long = "one two three " + " ".join(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}" for k in range(60_000))
    docs = frame([(k, f"{long} end{'abcdefghijkl'[k]}") for k in range(12)])
    began = time.time()
    got = rows(line_templates.per_document(docs))
    assert {r["doc_id"]: r["dropped"] for r in got} == dict.fromkeys(range(12), "1") and time.time() - began < 60


# -- op9 -------------------------------------------------------------------------


def test_targets():
    # b and the null source are held at 3 times their size, one after the other, and the excess goes to the rest
    assert mixing.targets([("b", 50), ("a", 1000), (None, 50)], 1.0, 3) == {"a": pytest.approx(800), "b": 150, None: 150}
    assert mixing.targets([("a", 0)], 1.0, 3) == {"a": 0.0}


def digits(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def queued(data, max_repeats=3):
    """Every send of every document in one order, cut at the budget: how often each (id, source, text) is taken, and the targets."""
    kinds, size = Counter(), defaultdict(int)
    for i, text, source in data:
        kinds[i, source, -1 if text is None else digits(text), len(WORD.findall(text or ""))] += 1
        size[source] += len(WORD.findall(text or ""))
    goal = mixing.targets(list(size.items()), 1.0, max_repeats)
    queues = defaultdict(list)
    for (i, source, t, n), m in kinds.items():
        for k in range(1, m + 1):
            queues[source].append((digits(f"0:{'' if i is None else i}:{t}:{k}"), n, (i, source, t)))
    sends = []
    for source, queue in queues.items():
        sent = 0
        for h, n, key in sorted(queue, key=lambda x: x[0]):
            sent += n
            sends += [((r * size[source] + sent) / goal[source], source or "", h, r, n, key) for r in range(max_repeats) if n]
    left, taken = sum(size.values()), Counter()
    for *_, n, key in sorted(sends, key=lambda x: x[:4]):
        if n > left:
            break
        left -= n
        taken[key] += 1
    return taken, goal


def test_mixing(frame, edges, words):
    import random

    r = random.Random(8)
    data = [(k, words(r.randint(5, 40), k), r.choice(["s0"] * 6 + ["s1", "s2", "é", None])) for k in range(800)]
    # long rows, rows of null id, and repeated rows that are taken 2 and 3 times
    data += [(*e, "edge") for e in edges] + [(None, words(9, k), "s1") for k in range(5)] + [(900, words(25, 3), "s2")] * 2
    docs = frame(data, extra=True)
    got = rows(mixing.mix(docs))
    assert len(got) == len(data)
    taken, goal = queued(data)
    assert {g["source"]: g["target"] for g in got} == {s: pytest.approx(t) for s, t in goal.items()}
    sums = Counter()
    for g in got:
        sums[g["doc_id"], g["source"], g["t"]] += g["n_taken"]
        assert 0 <= g["n_taken"] <= 3 and (g["n_taken"] == 0 or g["size"] > 0)
    assert +sums == taken
    again = sorted(map(str, rows(mixing.mix(docs))))
    assert again == sorted(map(str, got))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter((o["doc_id"], o["source"], -1 if o["text"] is None else digits(o["text"])) for o in rows(out)) == taken
    assert mixing.mix(frame([])).count() == 0 and mixing.mixed_documents(frame([])).count() == 0


def test_mixing_is_that_of_the_sql(spark, frame, words, tmp_path):
    import duckdb
    import random

    r = random.Random(3)
    data = [(k, words(r.randint(1, 40), k), r.choice(["s0"] * 9 + ["s1", "s2", "é", None])) for k in range(400)] + [(None, None, "s1"), (None, "a b", "s0"), (950, "w " * 3000, "z")]
    docs = frame(data)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = con.execute(f"select doc_id, size, source_size, target, taken from ({mixing.oracle_sql()})").fetchall()
    got = [(g["doc_id"], g["size"], g["source_size"], g["target"], g["size"] * g["n_taken"]) for g in rows(mixing.mix(docs))]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("long", [100, 500, 5000])
def test_mixing_goes_on_until_the_budget(frame, long):
    # one long document ends far beyond virtual time 1, so the others go out further
    docs = frame([(k, "w " * 10, "a") for k in range(100)] + [(500, "w " * long, "b")])
    got = rows(mixing.mix(docs))
    goal = mixing.targets([("a", 1000), ("b", long)], 1.0, 3)
    sends = sorted([((10 * (k + 1)) / goal["a"], 10) for k in range(300)] + [(long * (k + 1) / goal["b"], long) for k in range(3)])
    want = 0
    for _, n in sends:
        if want + n > 1000 + long:
            break
        want += n
    assert sum(g["size"] * g["n_taken"] for g in got) == want and all(g["n_taken"] <= 3 for g in got)
