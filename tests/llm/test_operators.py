"""Every operator against a brute-force version, on small tables with gaps, copies and odd texts."""

import collections
import math
import re
import struct
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from compare import database, difference, spark_table, sql_table
from ebbtide.llm import alignment, chat, common, decontamination, grammar, jaccard, language_model, packing, phrases, quality, queries, sharding, token_counts, vectors, vocab
from ebbtide.session import materialise
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
TEXTS = [
    None, "", " ", "one", "Two words", "a b c d e", "A b C d e", LONG, LONG.upper(), LONG + " more", LONG + " more and other", "x " * 5000,
    "don't  stop　now\n\n\tend ", "a\x1c b!\x1c", "é É. ### $$$", "<|endoftext|> x", LONG, "no\nbreaks\nhere", "日本語のテキスト" * 40, LONG[20:],
]
#: Extra columns whose names the operators also use.
DDL = "doc_id long, text string, lang string, size long, shard int, component_id long, n long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 1, 2, 3, 4) for i, t in enumerate(TEXTS)]
    rows += [rows[7], (None, LONG, None, None, None, None, None)]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.mark.parametrize("build", [
    token_counts.count_tokens, language_model.score_texts, jaccard.jaccard_groups, packing.pack_documents,
    lambda d: sharding.contiguous_shards(d, [F.col("doc_id")], F.lit(1)), jaccard.one_of_each,
])
def test_empty_table(empty, build):
    assert build(empty).collect() == []


def test_token_counts(docs):
    model = token_counts.Unigram(vocab.default_path("piece_bpe_32k.model"))

    def least(word):
        text, best = token_counts.SPACE + word, [(0, 0)]
        for i in range(1, len(text) + 1):
            ways = [(best[k][0] + v // token_counts.STEP, best[k][1] + 1) for k in range(i) if (v := model.ends.get(text[k:i]))]
            if not model.ends.get(text[i - 1]):
                n = len(text[i - 1].encode())
                ways.append((best[i - 1][0] + model.byte // token_counts.STEP * n, best[i - 1][1] + n))
            best.append(min(ways))
        return best[-1]

    for r in token_counts.count_tokens(docs).collect():
        text = LONG if r.doc_id is None else TEXTS[r.doc_id]
        own = WORD.findall(text or "")
        each = {w: least(w) for w in set(own)}
        assert (r.n_words, r.n_tokens) == (len(own), sum(each[w][1] for w in own))
        assert r.log_prob == -sum(each[w][0] for w in own) / token_counts.UNIT


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", vocab.ByteLevel), ("word_bpe_49k.json", vocab.WordEnds)])
def test_cached_encoding_is_that_of_the_library(name, kind):
    from tokenizers import Tokenizer

    path = vocab.default_path(name)
    library, cache = Tokenizer.from_file(path), kind(path)
    for text in filter(None, TEXTS):
        assert np.frombuffer(cache.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_letters_go_to_the_merges(monkeypatch):
    from tokenizers import Tokenizer

    path = vocab.default_path("byte_bpe_50k.json")
    library, cache, asked = Tokenizer.from_file(path), vocab.ByteLevel(path), []
    monkeypatch.setattr(cache, "ids", lambda text: (asked.append(text), vocab.ByteLevel.ids(cache, text))[1])
    rng = np.random.default_rng(4)
    made = ["".join(rng.choice(list("aeinrstÉñüɏZ"), rng.integers(1, 12))) for _ in range(300)]
    text = "Start " + "".join(w + str(rng.choice(["", ".", "%%%"])) + str(rng.choice([" ", "\n"])) for w in made) + "end"
    assert np.frombuffer(cache.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(asked) <= 5  # the first word, the marks and the line's end
    # White space that parts no words, letters that not every library knows, numbers and the special token.
    pieces = [" ", "\n", "a", "The", "é", "ɐ", "ª", "²", "1", ".", "!!", "'s", "\t", "\xa0", "\x85", "\u200b", "\u3000", "日", "\u0301", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces, rng.integers(1, 12)))
        assert np.frombuffer(cache.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 20))
    rows = [(i, (base[i % 12] + 0.12 * (i // 12) * rng.standard_normal(20)).tolist(), i % 2) for i in range(120)]
    rows += [(200, rows[5][1], rows[5][2]), (201, None, 1), (202, [0.0] * 20, 1), (203, [float("nan")] * 20, 1), (204, [1.0, None], 1), (205, rows[5][1], None), (206, [], 1), (207, [3.0, 4.0], 1)]
    rows += [rows[5]]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    good = [r for r in dict((r[0], r) for r in rows).values() if r[1] and r[2] is not None and None not in r[1] and any(r[1]) and np.isfinite(r[1]).all()]
    link = {r[0]: {s[0] for s in good if s[0] != r[0] and s[2] == r[2] and len(s[1]) == len(r[1]) and np.dot(r[1], s[1]) / np.linalg.norm(r[1]) / np.linalg.norm(s[1]) >= 0.93} for r in good}
    assert sum(map(len, link.values())) > 100
    for v in {r[0] for r in rows}:
        reach, todo = {v}, [v]
        while todo:
            new = link.get(todo.pop(), set()) - reach
            reach |= new
            todo += new
        assert got[v] == (len(link.get(v, ())), min(reach), v == min(reach))


def test_crowded_cells_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, (np.ones(16) + 0.2 * rng.standard_normal(16)).tolist(), 0) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = sorted(vectors.near_vectors(frame).collect())
    monkeypatch.setattr(vectors, "CELL_ROWS", 7)
    assert sorted(vectors.near_vectors(frame).collect()) == whole


def vector_pair(dims, share, over, block):
    """Unit vectors whose squared distance is ``share + over`` in one rotated block, in its first coordinate
    from just below zero upwards, more than the share in all blocks before, and less in the last."""
    size, low, a, b = vectors.BLOCK_DIMS, -2e-7, np.zeros(dims), np.zeros(dims)
    for k in range(block):
        a[size * k + 1], b[size * k + 1] = -math.sqrt(share * 1.001 + 2e-6) / 2, math.sqrt(share * 1.001 + 2e-6) / 2
    a[size * block], b[size * block] = low, math.sqrt(share + over) + low
    a[-1], b[-1] = -math.sqrt(share * 0.8) / 2, math.sqrt(share * 0.8) / 2
    a[-2], b[-2] = math.sqrt(1 - a @ a), math.sqrt(1 - b @ b)
    turn = vectors._rotation(dims)
    return (turn @ a).tolist(), (turn @ b).tolist()


@pytest.mark.parametrize("dims", [16, 64])
def test_links_at_the_border_of_a_block(spark, dims):
    """Distances around a block's share of the budget: no pair is lost between two cells."""
    share, rows, want = (2 - 2 * 0.93) * 8 / dims, [], {}
    for k, over in enumerate([-1e-6, 0, 1e-7, 5e-7, 9e-7, 1e-6, 1.1e-6, 3e-6]):
        for block in range(dims // 8 - 1):
            pair = vector_pair(dims, share, over, block)
            for at, v in enumerate(pair):
                want[len(rows)] = len(rows) - at
                rows.append((len(rows), v, 100 * k + block))
    assert all(np.dot(a[1], b[1]) >= 0.93 for a, b in zip(rows[::2], rows[1::2]))
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (1, first) for i, first in want.items()}


def test_links_at_the_border_of_a_band(spark):
    """As above, for the share of a band of blocks and cells twice as wide as its radius."""
    dims, size = 70, vectors.BAND_DIMS
    share, rows = (2 - 2 * 0.93) * size / dims, []
    width, turn = 2 * math.sqrt(share + 1e-6), vectors._rotation(dims)
    for k, over in enumerate([-1e-6, 0, 5e-7, 1e-6, 1.1e-6, 3e-6]):
        for band in range(2):
            for start in (-2e-7, -width / 2, width - 2e-7):
                a, b = np.zeros(dims), np.zeros(dims)
                for x, at in ((a, start), (b, start + math.sqrt(share + over))):
                    x[0] = band * (-1 if x is a else 1) * math.sqrt(share * 1.001 + 2e-6) / 2
                    x[size * band] = at
                a[-1], b[-1] = -math.sqrt(share / 8) / 2, math.sqrt(share / 8) / 2
                short = [math.sqrt(1 - x @ x) for x in (a, b)]
                a[-2], b[-2] = short
                if np.dot(a, b) >= 0.93:
                    rows += [(len(rows), (turn @ a).tolist(), 100 * k + 10 * band), (len(rows) + 1, (turn @ b).tolist(), 100 * k + 10 * band)]
    cosine = lambda x, y: np.dot(x[1], y[1]) / np.linalg.norm(x[1]) / np.linalg.norm(y[1])
    want = {x[0]: sum(x[0] != y[0] and x[2] == y[2] and cosine(x, y) >= 0.93 for y in rows) for x in rows}
    assert len(rows) >= 12 and all(want.values())
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.n_links for r in got} == want


def test_vectors_are_sent_a_few_times(spark, monkeypatch):
    """Copies for the comparison: two per band of 32 coordinates at most, as given."""
    rng, sent = np.random.default_rng(3), []
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(rng.standard_normal((600, 64)).astype(np.float32))]
    make = vectors._compare

    def counted(least):
        sent.append(sum(spark.read.schema(d.schema).parquet(*d.inputFiles()).count() for d in written if "vector" in d.columns))
        return make(least)

    written, real = [], vectors.materialise
    monkeypatch.setattr(vectors, "materialise", lambda df: written.append(real(df)) or written[-1])
    monkeypatch.setattr(vectors, "_compare", counted)
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert out.count() == 600 and sent == [600]
    classes = next(d for d in written if "vector" in d.columns)
    cells = classes.mapInArrow(vectors._cells(0.93, ("class",)), "class long, dims int, band int, cell int, home boolean")
    assert classes.schema["vector"].dataType.simpleString() == "array<float>" and cells.count() <= 4 * 600


def test_vectors_of_any_length(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal(16)
    rows = [(k, (v * size).tolist(), 0, 5) for k, size in enumerate([1, 1e200, 1e-200, 3e307, 1e-307])] + [(9, (-v * 1e200).tolist(), 0, 5)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {**{k: (4, 0) for k in range(5)}, 9: (0, 9)}
    turned = vectors._turned(vectors._unit(pa.array([r[1] for r in rows])))
    assert all((turned[k : k + n] == vectors._turned(vectors._unit(pa.array([r[1] for r in rows[k : k + n]])))).all() for k in range(4) for n in (1, 2))


@pytest.mark.parametrize("work", ["chunks", "ranges"])
def test_workers_give_their_memory_back(work, monkeypatch):
    """After each chunk of ``op12`` and before each range of ``op13``."""
    calls = []
    module = alignment if work == "chunks" else phrases
    monkeypatch.setattr(module, "give_back", lambda: calls.append(1) or common.give_back())
    if work == "chunks":
        monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
        rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["one two", "two", "three two"]})
        run = alignment._chunked(alignment.default_path("byte_bpe_50k.json"), alignment.default_path("piece_bpe_32k.model"), False, 1)
        assert len(list(run(iter([rows])))) == 3 and len(calls) == 4
    else:
        asked = phrases._ask("en", 7, np.arange(3), pa.array(["a", "bc", "dé"]), np.array([5, 1, 9]), np.arange(3, dtype=np.uint64), 1)
        group = pa.concat_tables([asked, asked.slice(0, 1)])
        told = phrases._counted(10)(group)
        assert len(calls) == 1 and sorted(x for x in zip(told["phrase"].to_pylist(), told["n"].to_pylist()) if x[0]) == [("a", 10), ("dé", 18)]


def brute_scores(items):
    """BM25 score of the words of each of two items in the index of all, over that of the item itself."""
    own = [re.findall("[a-z0-9]+", t) for _, t in items]
    mean, n = np.mean([len(w) for w in own]), len(own)

    def weight(word, w):
        found, tf = sum(word in o for o in own), w.count(word)
        return math.log(1 + (n - found + 0.5) / (found + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(w) / mean))

    return lambda words, k: sum(weight(x, own[k]) for x in set(words) if x in own[k]) / sum(weight(x, own[k]) for x in set(own[k]))


def test_scores_are_those_of_the_whole_benchmark(spark, monkeypatch):
    rng = np.random.default_rng(12)
    some = ["".join(rng.choice(list("abcdefgh"), 3)) for _ in range(60)]
    items = [(k if k != 5 else None, " ".join(rng.choice(some, 20 + k))) for k in range(11)]
    docs = [(k, " ".join(rng.choice(some, 30)) + " " + t) for k, (_, t) in enumerate(items)]
    docs += [(100 + k, " ".join(x if j % 9 else "other" for j, x in enumerate(t.split()))) for k, (_, t) in enumerate(items)]
    schema = "long, text string, passage int, score int, row int"
    frames = [spark.createDataFrame([(*r, 1, 2, 3) for r in rows], f"{name} {schema}") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    whole = {(r.doc_id, r.item_id): r for r in decontamination.leaks(*frames).collect()}
    assert {(k, i) for k, (i, _) in enumerate(items)} <= set(whole) and (5, None) in whole and any(d >= 100 for d, _ in whole)
    brute = brute_scores(items)
    for (d, i), r in whole.items():
        k = next(k for k, (x, _) in enumerate(items) if x == i)
        words, step = docs[d if d < 100 else d - 89][1].split(), max(len(t.split()) for _, t in items)
        assert r.passage % step == 0 and r.score == pytest.approx(brute(words[r.passage : r.passage + 2 * step], k), abs=1e-6)
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 3)
    cut = {(r.doc_id, r.item_id): r for r in decontamination.leaks(*frames).collect()}
    assert set(cut) == set(whole) and all(cut[k].score == pytest.approx(whole[k].score, abs=1e-12) for k in cut)
    assert {r.doc_id for r in decontamination.decontaminated(*frames).collect()} == {d for d, _ in docs} - {d for d, _ in whole}


@pytest.mark.parametrize("side", [0, 1])
def test_leaks_of_empty_tables(spark, side):
    frames = [spark.createDataFrame([(1, LONG)], f"{name} long, text string") for name in ("doc_id", "item_id")]
    frames[side] = frames[side].limit(0)
    assert decontamination.leaks(*frames).collect() == []
    assert decontamination.decontaminated(*frames).count() == side


def test_leaks(spark):
    rng = np.random.default_rng(3)
    invent = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 4)) for _ in range(n))
    items = [(i, invent(30 + i)) for i in range(40)] + [(90, "too short"), (91, None), (None, invent(20))]
    rows = [(i, f"{invent(50 * i)} {items[i][1].upper() if i % 2 else items[i][1]}, {invent(20)}") for i in range(12)]
    rows += [(50, invent(400)), (51, None), (52, ""), (53, items[3][1][: len(items[3][1]) // 3]), (54, items[2][1] + " " + items[4][1])]
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == sorted([(i, i) for i in range(12)] + [(54, 2), (54, 4)])


def found_in(texts, items):
    index = decontamination.build_index([(i, t.encode()) for i, t in enumerate(items)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    return sorted((r["doc_id"], r["item_id"]) for b in decontamination._passages(index)([batch]) for r in b.to_pylist())


def test_leaks_with_one_edited_word():
    rng = np.random.default_rng(11)
    invent = lambda n: ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(n)]
    items, texts, want = [invent(n) for n in range(15, 61)], [], []
    for k, item in enumerate(items):
        for at in range(len(item)):
            for new in (["changed"], [], ["put", item[at]]):
                want.append((len(texts), k))
                texts.append(" ".join([*invent(30), *item[:at], *new, *item[at + 1 :], *invent(30)]))
    texts += [" ".join(invent(200)), *(" ".join(item[: len(item) // 2] + invent(30)) for item in items)]
    assert found_in(texts, [" ".join(i) for i in items]) == want


def test_leaks_of_short_items():
    texts = ["Two words.", "two", "words two words", None, "two other words", "one, two, three four five six seven", LONG]
    items = ["two words", "TWO words", "one", "one two three four five six seven", "", "upsilon more", LONG]
    assert found_in(texts, items) == [(0, 0), (0, 1), (2, 0), (2, 1), (5, 2), (5, 3), (6, 6)]
    assert found_in(texts, items[:1]) == [(0, 0), (2, 0)]


def test_language_model(docs):
    rows = [r for r in docs.collect()]
    fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    count, pairs = collections.Counter(), collections.Counter()
    for r in rows:
        if not fold(r.doc_id):
            own = [*words(r.text), 0]
            count.update(own)
            pairs.update(zip([None, *own[:-1]], own, strict=True))
    n, v = sum(count.values()), len(count)
    got = language_model.score_texts(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [*words(LONG if r.doc_id is None else TEXTS[r.doc_id]), 0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id), len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert r.base_score < 0 and r.score < 0


def test_scores_are_those_of_each_history(spark, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 4000)  # n-grams in many chunks
    rng = np.random.default_rng(6)
    known = [f"w{i}" for i in range(900)]  # far more histories than a pooled table of cells keeps apart
    weight = 1 / np.arange(1, 901)
    texts = [" ".join(rng.choice(known, rng.integers(0, 60), p=weight / weight.sum())) for _ in range(400)] + [None, "", "unseen words"]
    texts += texts[:40]
    got = language_model.score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    aside = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    lines = [["<", *words(t), ">"] for t in texts]
    count, pairs = collections.Counter(), collections.Counter()
    for own, out in zip(lines, aside, strict=True):
        if not out:
            count.update(own)
            pairs.update(zip(own[:-1], own[1:], strict=True))
    types = collections.Counter(h for h, _ in pairs)
    unigrams = {w: c for w, c in count.items() if w != "<"}
    n, v = sum(unigrams.values()), len(unigrams)
    once, twice = (sum(c == k for c in unigrams.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once and twice else 0.5

    def arc(h, w):
        root = (unigrams[w] - discount if w in unigrams else discount * v) / n
        if h not in types:
            return root
        fail = language_model.K * types[h] / (count[h] + language_model.K * types[h])
        return (1 - fail) * pairs[h, w] / count[h] + fail * root

    want = {i: sum(math.log10(arc(h, w)) for h, w in zip(own[:-1], own[1:], strict=True)) for i, own in enumerate(lines)}
    assert {r.doc_id: r.score for r in got} == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}


def test_model_sums_to_one():
    weights = language_model.Weights(100, 4, 1, 1, np.full(2 * language_model.CELLS, 3))
    known = np.array([50, 30, 15, 5])
    unigram = weights.unigram(np.append(known, 0))
    assert unigram.sum() == pytest.approx(1)
    pair = np.array([10, 0, 7, 3, 0])
    arcs = 10 ** weights.arc(np.full(5, 9, np.uint64), np.full(5, 20), pair, unigram)
    assert arcs.sum() == pytest.approx(1)


def test_quality_on_held_out_documents(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50 and np.mean([r.predicted == r.quality for r in scored]) > 0.95
    none = quality.classify_quality(docs.limit(20), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x " * 9)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in quality.classify_quality(odd, labels).collect())
    assert quality.classify_quality(docs.limit(0), labels).collect() == []


def test_accepted_rows_keep_clashing_columns(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r.doc_id: r.score for r in quality.classify_quality(docs, labels).collect()}
    odd = docs.selectExpr("1 as score", "2 as doc", "3 as quality_score_", "4 as label_", "*")
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {d for d, s in scores.items() if s >= quality.ACCEPT} and {(r.score, r.doc, r.quality_score_) for r in rows} == {(1, 2, 3)}
    assert quality.accepted(odd.limit(0), labels).collect() == []


def brute_groups(rows):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 75 * len(sets[i] | sets[j]) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    return sorted(((str(d), len(s), str(least[r])) for (d, _), s, r in zip(rows, sets, root, strict=True)))


def test_jaccard_groups(spark, docs):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    base = [f"w{i}" for i in range(60)]
    for i in range(150):
        own = list(base[: int(rng.integers(8, 60))]) if i % 3 else [f"u{int(x)}" for x in rng.integers(0, 40, 30)]
        for _ in range(int(rng.integers(0, 3))):
            own[int(rng.integers(len(own)))] = f"new{i}"
        rows.append((100 + i, " ".join(own)))
    got = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_groups(rows)


@pytest.mark.parametrize("name", [None, 7])
def test_groups_where_doc_id_is_no_key(spark, name):
    base = [f"w{i}" for i in range(60)]
    edited = lambda lo, hi: " ".join(f"{w}x" if lo <= i < hi else w for i, w in enumerate(base))
    # The middle text alone links the outer ones; its doc_id is null, or also that of another text.
    rows = [(1, edited(0, 6)), (name, " ".join(base)), (3, edited(54, 60)), (name, "quite another text of more than five words")]
    assert brute_groups(rows)[1][2] == "1" and brute_groups(rows[::2])[1][2] == "3"
    for some in (rows, rows[::-1]):
        got = jaccard.jaccard_groups(spark.createDataFrame(some, "doc_id long, text string").coalesce(1)).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_groups(some)


def test_stages_where_doc_id_is_no_key(spark):
    item = LONG.replace(" ", " item")
    rows = [(None, LONG), (None, LONG + " more"), (None, "a clean text without an id"), (7, LONG), (7, "another text under the same id"), (8, ""), (None, None)]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, rows[2:]))
    rows += [(None, item), (9, "before " + item), (9, "clean")]
    clean = decontamination.decontaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(map(str, map(tuple, clean))) == sorted(map(str, [*rows[:7], rows[9]]))


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(6)
    for n in (1, 5, 64, 65, 300, 1000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[n // 4 :], rng.integers(0, 1 << 63, n // 3, dtype=np.uint64))))
        differ = len(np.setxor1d(a, b))
        assert jaccard.differing_bits(jaccard.signature(a), jaccard.signature(b)) <= differ


def test_token_files(docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocab.default_path("byte_bpe_50k.json"))
    target = str(tmp_path / "ids")
    grammar.write_ids(docs, target)
    got = grammar.read_ids(docs.sparkSession, target).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d) and len(ids) == len(TEXTS) + 2
    start = 0
    for r in got:
        want = [*library.encode((LONG if r.doc_id is None else TEXTS[r.doc_id]) or "", add_special_tokens=False).ids, grammar.END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), crc(want)) and np.frombuffer(r.ids, "<u4").tolist() == want
        start += len(want)


def test_token_files_take_few_rows_at_a_time(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    name, held, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], DataFrameWriter.parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (held.append(int(spark.conf.get(name))), write(self, *a, **k))[1])
    docs = spark.range(2500, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    grammar.write_ids(docs, str(tmp_path / "ids"))
    assert held and max(held) <= 1000 and spark.conf.get(name) == before  # whole texts in a batch
    assert [r.doc_id for r in grammar.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()] == list(range(2500))


def test_row_groups_of_token_files_end_by_size(spark, docs, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    rng = np.random.default_rng(6)
    blocks = [(0, i, 0, 1, b"", b"", rng.bytes(3 << 20), b"", b"", b"", b"") for i in range(12)]
    made = spark.createDataFrame(blocks, grammar._BLOCK_DDL).coalesce(1)
    monkeypatch.setattr(type(made), "mapInArrow", lambda *a, **k: made)
    grammar.write_ids(docs, str(tmp_path / "ids"))
    (file,) = (tmp_path / "ids").glob("*.parquet")
    told = pq.ParquetFile(file).metadata
    assert told.num_rows == 12 and max(told.row_group(i).total_byte_size for i in range(told.num_row_groups)) < 20 << 20


def test_grammar_blocks_decode_anywhere():
    rng = np.random.default_rng(8)
    docs = [np.append(rng.choice([2, 5, 6, 7, 50_000], rng.integers(0, 400), p=[0.1, 0.4, 0.3, 0.1, 0.1]), 2).astype("<u4") for _ in range(60)]
    pieces = [d.tobytes() for d in docs]
    row = grammar._block_row(0, 0, 0, list(range(60)), pieces, 2).to_pylist()[0]
    block, whole = grammar.Block(row), b"".join(pieces)
    assert len(row["rules"]) and len(row["symbols"]) < len(whole) / 3
    assert [block.document(i) for i in range(60)] == pieces
    for a, b in ((0, 1), (17, 18), (100, 777), (0, len(whole) // 4), (len(whole) // 4 - 3, len(whole) // 4)):
        assert block.tokens(a, b) == whole[4 * a : 4 * b]


def test_shards(docs):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    rows = sharding.contiguous_shards(docs, [F.col("doc_id")], size, shards=4).withColumn("bytes", size).collect()
    assert len(rows) == len(TEXTS) + 2
    total, largest = sum(r.bytes for r in rows), max(r.bytes for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for shard, own in by.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.bytes for r in own) - total / 4) <= largest
    order = [(-1 if r.doc_id is None else r.doc_id) for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_shards_are_numbered_without_python(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(sharding, "materialise", lambda df: (seen.append(df), materialise(df))[1])
    rows = sharding.contiguous_shards(docs, [F.col("doc_id")], F.lit(1), shards=4)
    for df in (*seen, rows):
        assert not re.search("InArrow|InPandas|EvalPython", df._jdf.queryExecution().executedPlan().toString())


def test_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yes"), (4, 0, "user", "hi"), (4, 1, "bot", "no"),
             (4, 1, "bot", "no"), (5, 0, None, None), (6, None, "user", "<|im_end|>"), (None, 0, "user", "lost")]
    frame = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn long, role string, text string, n int, h1 int")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.maximal_conversations(frame).collect()}
    assert set(got) == {1, 4, 5, 6, None}
    assert got[1] == (2, 2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nyes<|im_end|>\n")
    assert got[4][:2] == (2, 1) and "<| im_end|>" in got[6][2]
    assert chat.maximal_conversations(frame.limit(0)).collect() == []


def test_turns_without_a_conversation(spark):
    """Each is a conversation of its own: never joined to others, a snapshot where one begins with it."""
    turns = [(None, 0, "user", "lost"), (None, 1, "bot", "found"), (None, 4, "bot", "found"), (None, 4, "bot", "found"), (None, 2, "user", "hi"), (None, 0, "user", "whole"),
             (None, None, None, None), (7, 0, "user", "hi"), (7, 1, "bot", "yes"), (8, 3, "user", "whole")]
    frame = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn long, role string, text string, alone int, first int")
    rows = chat.maximal_conversations(frame).collect()
    text = lambda role, said: f"<|im_start|>{role}\n{said}<|im_end|>\n"
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [
        (None, 1, 1, text("user", "lost")), (None, 1, 2, text("bot", "found")), (None, 1, 1, text("", "")),
        (7, 2, 1, text("user", "hi") + text("bot", "yes")), (8, 1, 2, text("user", "whole")),
    ]))
    import duckdb

    base = duckdb.connect()
    base.register("conversations", pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), t)) for t in turns]))
    assert sorted(map(str, base.execute(chat.OP9_SQL).fetchall())) == sorted(str(tuple(r)) for r in rows)


def test_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocab.default_path("word_bpe_49k.json"))
    rows = packing.pack_documents(docs, capacity=64, keep_ids=True).collect()
    own = collections.defaultdict(list)
    for r in rows:
        own[r.sequence_id].append(r)
        ids = [*library.encode((LONG if r.doc_id is None else TEXTS[r.doc_id]) or "", add_special_tokens=False).ids, packing.END_ID]
        piece = ids[r.start : r.start + 64]
        assert (r.length, r.ids_crc32, r.start) == (len(piece), crc(piece), 64 * r.piece) and np.frombuffer(r.ids, "<u4").tolist() == piece
    for placed in own.values():
        at = 0
        for r in sorted(placed, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(own) <= 1.1 * sum(r.length for r in rows) / 64 + 1


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, folder, name):
    assert difference(spark_table(queries.QUERIES[name](spark, folder)), sql_table(database(folder), queries.SQL[name])) is None


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(materialise(stage(spark, seen[-1], folder)))
    assert all(s.columns == docs.columns for s in seen[:-1])
    texts = [(r.doc_id, r.text) for r in seen[1].collect()]
    assert sorted(str(r.doc_id) for r in seen[2].collect()) == sorted({c for _, _, c in brute_groups(texts)})
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in seen[2].collect() if not any(i in (r.text or "") for i in items)}
    assert {r.doc_id for r in seen[3].collect()} == clean
    assert {r.doc_id for r in seen[4].collect()} == clean
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "ids_crc32").collect())) == sorted(map(tuple, seen[4].select("doc_id", "ids_crc32").collect()))
