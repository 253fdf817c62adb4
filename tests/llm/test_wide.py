"""Repeated strings, tokenizer alignment and phrases against brute force; gaps, copies, odd and long texts."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from compare import database, difference, spark_table, sql_table
from ebbtide.llm import alignment, phrases, queries, repeats, suffixes
from ebbtide.llm.vocab import default_path
from ebbtide.session import materialise
from test_operators import DDL, LONG, TEXTS

RNG = random.Random(5)
#: A passage inside other texts, texts with a short period, one byte many times, near copies with other edges.
PASSAGE = " ".join(RNG.choice(LONG.split()) + str(RNG.randrange(90)) for _ in range(120))
REPEATED = [
    *TEXTS, PASSAGE, "before " + PASSAGE, PASSAGE + " after", "x" * 2000, "ab " * 700, "ab " * 300 + PASSAGE[:450], PASSAGE[3:500], PASSAGE[:399],
    PASSAGE[:400], "é" * 300, LONG * 30, "▁ a piece mark", "double  spaces \n\n and tabs\t\t x ", "<s> <unk> <|endoftext|> <0x41>", "a\x00b a\x00b",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "fr", None)[i % 3], 1, 2, 3, 4) for i, t in enumerate(REPEATED)]
    rows += [rows[7], rows[21], (None, LONG, None, None, None, None, None), (5, PASSAGE[5:480], "en", 1, 2, 3, 4)]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.mark.parametrize("build", [repeats.remove_repeats, alignment.align_documents, phrases.collocations])
def test_empty_table(empty, build):
    assert build(empty).collect() == []


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    for k in range(600):
        text = rng.integers(0, rng.choice([1, 2, 3, 255]), rng.integers(1, 60), dtype=np.uint8, endpoint=True)
        if k % 3 == 0:
            text = np.tile(text[:4], 12)
        raw = text.tobytes()
        order = sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = [0] * len(raw)
        for x, y in zip(order, order[1:]):
            a, b = raw[x:], raw[y:]
            shared[y] = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        got = suffixes.suffix_array(text)
        assert got.tolist() == order
        assert suffixes.common_prefixes(text, got).tolist() == shared


def removed(rows, span):
    count = collections.Counter(t[i : i + span] for _, t in rows for i in range(len(t) - span + 1))
    out = []
    for doc_id, t in rows:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - span + 1):
            if count[t[i : i + span]] > 1:
                gone[i] += 1
                gone[i + span] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"span": 64}, {"shard": 2000}, {"anchor": 100}, {"span": 40, "anchor": 900}])
def test_repeats(docs, options, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 700)  # long texts go in parts
    want = removed([(i, t.encode()) for i, t in texts(docs)], options.get("span", 400))
    got = [(*r[:5], bytes(r.kept)) for r in repeats.remove_repeats(docs, text=True, **options).collect()]
    assert sorted(got, key=str) == want
    assert sum(r[2] for r in want) > 1000


def test_repeats_of_a_very_long_text(spark):
    """Two texts above every buffer size, equal but for their first byte."""
    body = "".join(RNG.choices("abcdefgh ", k=1_300_000))
    docs = spark.createDataFrame([(1, "1" + body), (2, "2" + body), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs).collect()}
    assert got == {1: (1_300_000, 1), 2: (1_300_000, 1), 3: (0, 0)}


def test_repeats_deal_no_blocks_by_anchor(spark, monkeypatch):
    """A line inside many different texts: its blocks differ, have one anchor, and are told apart without meeting in one task."""
    words = LONG.split()
    rows = [(i, " ".join(RNG.choices(words, k=90)) + f" {i} " + PASSAGE[:380] + f" {i} " + " ".join(RNG.choices(words, k=90))) for i in range(400)]
    docs, plans = spark.createDataFrame(rows, "doc_id long, text string"), []

    def written(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df)

    monkeypatch.setattr(repeats, "materialise", written)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        got = [tuple(r[:5]) for r in repeats.remove_repeats(docs).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sorted(got, key=str) == [r[:5] for r in removed([(i, t.encode()) for i, t in rows], 400)]
    cut = [p for p in plans if "_cut_out" in p]
    assert len(cut) == 1 and "hashpartitioning(anchor" not in cut[0]


def test_repeats_need_room_for_an_anchor(docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs, span=20)


def aligned(both, text):
    """Token lists and links of a whole text, from byte ranges."""
    a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = both.b.encode(text) if text else []
    parts = [[both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]]
    if text and not b"".join(parts[0]) == b"".join(parts[1]) == (" " + text).encode():
        return [], [], [], ""
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    begins = [[0, *e[:-1]] for e in ends]
    links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if begins[0][i] < ends[1][j] and begins[1][j] < ends[0][i]] if len(a) < 600 else None
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        i, j = p, q
    return a, b, links, ";".join(groups)


def test_alignment(docs):
    small = docs.where("text is null or length(text) < 2000")
    both = alignment._Both(default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))
    made = [(i, *aligned(both, t)) for i, t in texts(small)]
    count = collections.Counter(x for m in made for x in m[3])
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = [
        (i, len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(g.encode()).hexdigest() if g else "", g)
        for i, a, b, links, g in made
    ]
    for chunk in (1, 1 << 20):
        got = [tuple(r) for r in alignment.align_documents(small, groups=True, chunk_text=chunk).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert any(m[1] == [] and t for m, (_, t) in zip(made, texts(small)))  # the text with a piece mark


def test_alignment_of_a_long_text_and_of_any_tokens():
    groups, links = alignment.align([1, 2, 3], [3, 1, 2])
    assert (groups.tolist(), links.tolist()) == ([[0, 2, 0, 1], [2, 3, 1, 3]], [[0, 0], [1, 0], [2, 1], [2, 2]])
    assert [len(x) for x in alignment.align([], [])] == [0, 0]


def test_alignment_keeps_long_texts(spark):
    text = "no spaces " + "abcdé" * 250_000
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    one, two = alignment.align_documents(docs).drop("doc_id").collect()
    assert one == two and one.n_links == one.n_a + one.n_b - one.n_groups and one.count_sum > one.n_links


def test_suffix_order_of_words():
    ids, words = phrases.words_of([b"A b. a b  a\tb c", b"", b"...", b"b a b"])
    assert words[ids[0] - 1] == b"a" and (ids == 0).sum() == 3
    order = phrases.suffix_order(ids)
    keys = [[(x, 0) if x else (0, i + k) for k, x in enumerate(ids[i:].tolist())] for i in range(len(ids))]
    assert order.tolist() == sorted(range(len(ids)), key=lambda i: keys[i])


def phrases_of(rows, least, replaced, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in often.items():
        around = (v for (x, y), v in often.items() if x == lang and len(y) > len(w) and any(y[i : i + len(w)] == w for i in range(len(y))))
        if any(100 * v >= replaced * a for v in around):
            continue
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


@pytest.mark.parametrize("options", [{}, {"least": 2}, {"least": 3, "replaced_from": 100, "top": 4}, {"least": 2, "shard_text": 1}])
def test_phrases(docs, options):
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = phrases_of(rows, options.get("least", 30), options.get("replaced_from", 80), options.get("top", 2000))
    assert sorted(tuple(r) for r in phrases.collocations(docs, **options).collect()) == want
    assert want


def test_phrases_are_told_without_a_join(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(phrases, "materialise", lambda df: (seen.append(df), materialise(df))[1])
    monkeypatch.setattr(phrases, "RANGE_WORDS", 7, raising=False)  # many hash ranges, some without a phrase
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=2, shard_text=500).collect()) == phrases_of(rows, 2, 80, 2000)
    assert not any("Join" in df._jdf.queryExecution().executedPlan().toString() for df in seen)


def test_phrases_against_sql(spark, folder):
    name = "op13_phrase_collocations"
    assert difference(spark_table(queries.QUERIES[name](spark, folder)), sql_table(database(folder), queries.SQL[name])) is None


@pytest.mark.parametrize("name, columns", [
    ("op11_repeated_spans", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    ("op12_token_alignment", ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]),
])
def test_registered_queries_return_every_document(spark, folder, name, columns):
    out = queries.QUERIES[name](spark, folder)
    assert out.columns == columns
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
