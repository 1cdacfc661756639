"""The text and vector problems: brute force, exact round trips, held-out accuracy, and the edge cases that docstrings define."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import chunking, leaks, mixing, neighbours, queries, toxicity
from tidegrid.llm.forest import fit
from tidegrid.llm.passages import Reader, fold, tokens
from tidegrid.llm.wand import BlockMaxIndex, segments

NAN = float("nan")


# 3: neighbours

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 64))
    x[700:720] = x[:20] + rng.normal(size=(20, 64)) * 0.15  # near pairs
    rows = [(f"v{i:04d}", [float(v) for v in r]) for i, r in enumerate(x)]
    copies = [(f"w{i:04d}", [float(v) for v in x[5] * 2]) for i in range(40)]
    odd = [("null", None), ("short", [1.0] * 48), ("zero", [0.0] * 64), ("nan", [NAN] * 64), ("hole", [None] + [1.0] * 63), (None, [1.0] * 64), rows[3]]
    df = spark.createDataFrame(rows + copies + odd, "id string, e array<float>").withColumns({"leaf": F.lit(1), "v": F.lit("x"), "h": F.lit(0)})
    v = np.array([r[1] for r in rows + copies])
    return df, [r[0] for r in rows + copies], v / np.linalg.norm(v, axis=1, keepdims=True)


def test_near_pairs_are_all_found(vectors):
    df, ids, v = vectors
    got = neighbours.nearest(df, "id", "e", 10, 0.92, leaf_size=128).toPandas()
    s = v[:1500] @ v[:1500].T
    i, j = np.where(np.triu(s >= 0.92, 1))
    want = {(ids[a], ids[b]) for a, b in zip(i, j) if 5 not in (a, b)}
    mine = {tuple(sorted(p)) for p in zip(got.id_a, got.id_b)}
    assert want and want <= mine and not {x for p in mine for x in p} & {"null", "short", "zero", "nan", "hole"}
    assert all(x in p for p in zip(got.id_a, got.id_b) for x in p) and (got.id_a != got.id_b).all()


def test_copies_get_the_first_of_their_class(vectors):
    got = neighbours.nearest(vectors[0], "id", "e", 10, 0.92, leaf_size=128).toPandas()
    late = got[got.id_a == "w0030"]
    assert len(late) == 10 and set(late.id_b) == {"v0005", *(f"w{i:04d}" for i in range(9))} and np.allclose(late.cosine, 1)
    assert len(got[got.id_a == "v0005"]) == 10


def test_recall_of_all_neighbours(vectors):
    df, ids, v = vectors
    got = neighbours.nearest(df.where("id < 'w'"), "id", "e", 10, None, trees=2, visits=8, leaf_size=190, compact=False).toPandas()
    s = v[:1500] @ v[:1500].T
    np.fill_diagonal(s, -2)
    top = np.argsort(-s, axis=1)[:, :10]
    mine = got.groupby("id_a").id_b.apply(set)
    assert np.mean([len(mine[ids[i]] & {ids[j] for j in top[i]}) / 10 for i in range(1500)]) >= 0.9
    assert (got.groupby("id_a").size() == 10).all()


def test_tiles_change_nothing(vectors, monkeypatch):
    df = vectors[0].where("id < 'w'")  # without equal vectors
    ask = lambda: {(r.id_a, r.id_b) for r in neighbours.nearest(df, "id", "e", 5, None, trees=2, visits=3, leaf_size=400, compact=False).collect()}
    whole = ask()
    monkeypatch.setattr(neighbours, "TILE", 90)
    monkeypatch.setattr(neighbours, "VISITORS", 170)
    assert ask() == whole and len(whole) == 5 * 1500


@pytest.mark.parametrize("n", [2987, 29802])
def test_recall_of_the_query_on_clean_tables(spark, tmp_path, n):
    """No unusable row, and a number of rows that is no multiple of eight."""
    whole = pq.read_table("/root/testdata/sf0.1/rag_index.parquet", columns=["id", "embeddings"]).to_pandas().drop_duplicates("id")
    whole = whole[[e is not None and len(e) == 64 and 0 < np.linalg.norm(e) < np.inf for e in whole.embeddings]].head(n)
    assert len(whole) == n and n % 8
    whole.to_parquet(tmp_path / "rag_index.parquet")
    got = queries.p3_neighbours(spark, str(tmp_path)).toPandas().groupby("id_a").id_b.apply(set)
    v, ids = np.array(whole.embeddings.tolist(), np.float32), whole.id.to_numpy()
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ask = np.random.default_rng(0).choice(n, 1000, replace=False)
    s = v[ask] @ v.T
    s[np.arange(1000), ask] = -2
    top = np.argpartition(-s, 10, axis=1)[:, :10]
    recall = np.mean([len(got[ids[i]] & set(ids[t])) / 10 for i, t in zip(ask, top)])
    print(f"recall of {n}: {recall:.4f}")
    assert recall >= 0.9 and got.str.len().eq(10).all() and len(got) == n


def test_largest():
    x = np.random.default_rng(5).normal(size=(7, 5003)).astype(np.float32)
    got = neighbours.largest(x, 10)
    assert (np.sort(np.take_along_axis(x, got, 1), axis=1) == np.sort(x, axis=1)[:, -10:]).all() and neighbours.largest(x[:, :4], 10).shape == (7, 4)


def test_few_or_no_vectors(spark, vectors):
    df = vectors[0]
    assert neighbours.nearest(df.limit(0), "id", "e").count() == 0
    assert neighbours.nearest(df.where("id in ('v0001', 'zero')"), "id", "e").count() == 0
    assert neighbours.nearest(df.where("id in ('v0001', 'v0701', 'v0002')"), "id", "e", 10, 0.92).count() == 2


def test_forest_visits_own_leaves_first():
    x = np.random.default_rng(1).normal(size=(200, 8)).astype(np.float32)
    f = fit(x, 3, 3)
    leaf, own = f.visits(x, 24)
    assert own.tolist() == [True] * 3 + [False] * 21 and all(len(set(r)) == 24 for r in leaf)  # in the end every leaf of every tree
    assert [np.bincount(leaf[:, t] - t * 8, minlength=8).max() for t in range(3)] == [25] * 3
    assert fit(x[:0].reshape(0, 8), 1, 2).visits(x, 2)[0].shape == (200, 2)


# 6: chunking

def _code(seed, n=9000):
    r = random.Random(seed)
    out = ""
    while len(out) < n:
        out += " " * r.choice((0, 4)) + "".join(r.choice("abcdefgh ") for _ in range(r.randrange(0, 90))) + r.choice(("\n", "\r\n"))
    return out


@pytest.mark.parametrize("text", [_code(1), "x" * 5000, "é⚠ " * 1500, "a" * 1999 + "\r\n" + "b" * 3000, "\n" * 4500, _code(2, 2100)])
def test_pieces_cover_and_overlap(text):
    got, _ = chunking.pieces_of(text, 2000, 200, 1000)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (a, b, m, above, below), nxt in zip(got, got[1:] + [None]):
        assert 0 < b - a <= 2000 and above == text[:a].count("\n") and below == text[: b - 1].count("\n")
        if nxt:
            assert nxt[0] == b - 200 and text[b - 1 : b + 1] != "\r\n" and (m != "line" or text[b - 1] == "\n")


def test_edits_stay_local():
    text = _code(3, 60000)
    cut = {text[a:b] for a, b, *_ in chunking.pieces_of(text, 2000, 200, 1000)[0]}
    new = text[:30000] + "one more word" + text[30000:]
    changed = [p for p in ({new[a:b] for a, b, *_ in chunking.pieces_of(new, 2000, 200, 1000)[0]}) if p not in cut]
    assert len(changed) <= 8 < len(cut) / 3


def test_split_texts(spark):
    df = spark.createDataFrame([("a", 5, "x\ny\n"), ("b", 1, None), (None, 1, "z"), ("c", None, ""), ("d", 3, _code(4)), ("e", 1, "w" * 2001), ("f", 1, "q\r\n" + "k" * 1999)], "id string, l int, t string").withColumns({"text": F.lit(0), "line": F.lit(0), "piece": F.lit(0)})
    got = chunking.split_texts(df, "id", "t", "l").toPandas()
    one = got[got.method == "whole"].set_index("id")
    assert set(one.index) == {"a", "c"} and (one.loc["a"].start_line, one.loc["a"].end_line, one.loc["a"].longest_line) == (5, 6, 1)
    assert np.isnan(one.loc["c"].start_line) and set(got.id) == set("acdef")
    assert got[got.id == "e"].longest_line.iloc[0] == 2001 and got[got.id == "f"].longest_line.iloc[0] == 1999
    assert chunking.split_texts(df.limit(0), "id", "t").count() == 0
    with pytest.raises(ValueError):
        chunking.split_texts(df, "id", "t", max_chars=100, overlap=90)


# 8: leaks

ITEM = [f"w{i:02}x" for i in range(40)]


def _leak(doc, item=ITEM):
    return leaks.leaked(leaks.Stream([w for w in doc if w]), leaks.Item(item))


@pytest.mark.parametrize("doc, n", [
    (ITEM, 40), (["x"] * 9 + ITEM[5:29] + ["y"] * 9, 26), (ITEM[5:27], 24), (ITEM[5:26], 0), (ITEM[:23], 24), (ITEM[:22], 0), (ITEM[:10] + ITEM[11:30], 31), (ITEM[:10] + ["z"] + ITEM[11:26], 27),
    (ITEM[:10] + ["z"] + ITEM[11:14] + ["z"] + ITEM[15:24], 0), (ITEM[:16] + ["x"] * 50 + ITEM[16:32], 33), (ITEM[:15] + ["x"] * 50 + ITEM[15:39], 26), (ITEM[:14] + ["x"] * 50 + ITEM[14:28], 0),
    (ITEM[16:32] + ["x"] * 50 + ITEM[:16], 0), (ITEM[:8] + ["x"] * 3 + ITEM[8:16] + ["x"] * 3 + ITEM[16:24], 0), ([], 0), (ITEM[:1] + ["z"] + ITEM[2:22] + ["z"] + ITEM[23:24], 24),
    (ITEM[:9] + ["w0", "9x"] + ITEM[10:26], 27), (ITEM[:9] + ["w09xw10x"] + ITEM[11:26], 27), (list("".join(ITEM[:26])), 27), (["".join(ITEM[:26])], 27), (ITEM[:9] + ["other1word"] + ITEM[10:26], 27),
])
def test_alignment(doc, n):
    """Runs and parts, changed words, torn words and words run together. A changed word at an end counts."""
    assert _leak(doc) == n


def test_lone_marks_of_an_item():
    item = ITEM[:12] + [""] + ITEM[12:24] + [""] + ITEM[24:]
    assert _leak(ITEM[:24], item) == 26 and _leak(ITEM[:12] + ["old"] + ITEM[12:23], item) == 25  # a word stands in the mark's place
    assert _leak(ITEM[:13] + ["z"] + ITEM[14:23], item) == 25 and _leak(ITEM[:12] + ["z"] + ITEM[13:26], item) == 29


def _found(texts, items):
    known = leaks.Items([leaks.split(t) for t in items])
    return {(i, j) for i, j, _, _ in leaks.search(leaks.Reader(known), texts)}


def test_retrieval_of_torn_joined_and_hyphenated_words():
    """Passages of 26 words of an item, spelt in every way, are found by the index, beside other items of the same wording."""
    r = random.Random(4)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(300)]
    items = [" ".join(r.choice(vocab) for _ in range(45)) for _ in range(200)]
    for t in range(60):
        w = items[t].split()[5:31]
        k = r.randrange(3, 20)
        ways = [
            w, w[:k] + [w[k][:3], w[k][3:]] + w[k + 1 :], w[:k] + [w[k][:3] + "-" + w[k][3:]] + w[k + 1 :], w[:k] + [w[k] + w[k + 1]] + w[k + 2 :], w[:k] + [w[k] + "—" + w[k + 1]] + w[k + 2 :], w[:k] + ["well-known"] + w[k + 1 :],
            w[:k] + w[k + 1 :], [x[:3] + "\n" + x[3:] for x in w], [a + b for a, b in zip(w[::2], w[1::2])], [f"<i>{x.upper()}</i>" for x in w], [" ".join(x) for x in w[:1]] + w[1:],
        ]
        noise = lambda n: [r.choice(vocab) for _ in range(n)]
        texts = [" ".join(noise(30) + x + noise(30)) for x in ways]
        assert {i for i, j in _found(texts, items) if j == t} == set(range(len(ways)))


def test_retrieval_loses_nothing():
    """Random admissible pieces against brute force over all pairs."""
    r = random.Random(5)
    vocab = [f"v{i}" for i in range(60)]
    items = [" ".join(["-" if r.random() < 0.03 else r.choice(vocab) for _ in range(r.randrange(24, 60))]) for _ in range(120)]
    texts = []
    for _ in range(250):
        w = r.choice(items).split()
        a = r.randrange(0, len(w) - 23)
        w = w[a : a + r.randrange(14, 40)]
        for k in range(r.randrange(0, 9), len(w), r.randrange(7, 14)):
            w[k] = r.choice(("", "changed", "v1"))
        k = r.randrange(len(w))
        texts.append(" ".join([r.choice(vocab) for _ in range(r.randrange(60))] + w[:k] + [r.choice(vocab) for _ in range(r.choice((0, 0, 9)))] + w[k:]))
    split = [leaks.split(t) for t in items]
    want = {(i, j) for i, t in enumerate(texts) for j, w in enumerate(split) if _leak(leaks.split(t), w)}
    assert len(want) > 60 and _found(texts, items) == want


def _index(texts, block):
    term = {t: i for i, t in enumerate(sorted({t for x in texts for t in x}))}
    rows = [(term[t], i, x.count(t) / len(x) * (1 + term[t])) for i, x in enumerate(texts) for t in sorted(set(x))]
    return term, BlockMaxIndex(*map(np.array, zip(*rows)), len(term), len(texts), block)


def test_index_is_exact():
    r = random.Random(0)
    texts = [[r.choice("abcdefghijklmnop") for _ in range(r.randrange(1, 30))] for _ in range(150)]
    term, ix = _index(texts, 8)
    for _ in range(60):
        q = np.array(sorted({term[r.choice("abcdefghijklmnop")] for _ in range(6)}))
        least = np.full(150, r.uniform(0.1, 3))
        ids, score = ix.above(q, least, ix.least_by_block(least))
        full = np.zeros(150)
        at, border = segments(ix.post, q)
        np.add.at(full, ix.ids[at], ix.weights[at])
        assert sorted(ids.tolist()) == np.flatnonzero(full >= least).tolist() and np.allclose(score, full[ids])
        some, most = ix.largest(q, np.ones(len(q), np.float32), 7, 0.2, 3)
        assert np.allclose(most, np.sort(full[full >= 0.2])[::-1][:7]) and np.allclose(full[some], most)


def test_a_large_index_stays_small():
    """20,000 items of 45 words from 100,000: as large as its postings, not terms times blocks."""
    rng = np.random.default_rng(0)
    texts = [[f"t{i}" for i in x] for x in rng.integers(0, 100_000, (20_000, 45))]
    known = leaks.Items(texts)
    size = sum(a.nbytes for a in vars(known.index).values() if isinstance(a, np.ndarray))
    assert size < 40 * 20_000 * 45 and known.index.width * known.index.blocks > 5e7
    assert {j for _, j, _, _ in leaks.search(leaks.Reader(known), [" ".join(texts[777][10:36])])} == {777}


def test_find_leaks(spark):
    r = random.Random(2)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    items = {i: [r.choice(vocab) for _ in range(45)] for i in range(30)}
    text = lambda w: " ".join(w)
    noise = lambda n: [r.choice(vocab) for _ in range(n)]
    disguised = text(items[1][:30]).upper().replace("A", "А").replace(" ", "\n> ", 4).replace("E", "<b>E</b>")
    docs = [(1, text(noise(40) + items[0][5:40] + noise(9))), (2, disguised), (3, text(noise(60))), (4, None), (5, ""), (None, text(items[0])), (6, text(items[2][:20])), (7, text(items[3]) + " " + text(items[4])), (1, text(noise(40) + items[0][5:40])), (8, text(noise(9000) + items[5][10:40]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"k": F.lit(0), "item_id": F.lit("clash")})
    it = spark.createDataFrame([(i, text(w)) for i, w in items.items()] + [(99, None), (98, "too short"), (97, text(items[0])), (None, "x")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(df, it).collect()}
    assert got == {(1, 0), (1, 97), (2, 1), (7, 3), (7, 4), (8, 5)}
    # brute force over all pairs
    want = {(d, i) for d, t in docs if d for i, w in [*items.items(), (97, items[0])] if _leak(leaks.split(t), w)}
    assert got == want
    assert leaks.find_leaks(df.limit(0), it).count() == 0 and leaks.find_leaks(df, it.limit(0)).count() == 0


# 9: mixing

def test_water_fill():
    even = {p.source: p.wanted for p in mixing.water_fill([("a", 0.5, 1, 100), ("b", 0.5, 4, 10)])}
    assert even == {"a": 40.0, "b": 40.0}
    more = {p.source: p.wanted for p in mixing.water_fill([("a", 0.5, 1, 100), ("b", 0.3, 2, 10), ("c", 0.2, 1, 1000)], 100)}
    assert more == pytest.approx({"a": 80 * 5 / 7, "b": 20.0, "c": 80 * 2 / 7})
    assert sum(p.wanted for p in mixing.water_fill([("a", 0.5, 2, 100), ("b", 0.5, 1, 50)], 1e9)) == 250
    assert [p.epochs for p in mixing.water_fill([("a", 1.0, 3, 0)])] == [0.0] and mixing.water_fill([]) == []


def test_mix(spark):
    rows = [(i, "big" if i % 10 else "small", f"word number {i} " * (1 + i % 7)) for i in range(3000)] + [(9001, None, "x"), (9002, "other", "x"), (9003, "small", None), (9004, "small", "  "), (5, "big", "word number 5 " * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"key": F.lit(0), "src": F.lit("x"), "bucket": F.lit(1), "n_tokens": F.lit(-1)})
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    drawn, report = mixing.mix(docs, targets)
    p, r = drawn.toPandas(), report.toPandas().set_index("source")
    assert p.doc_id.is_unique and p[p.source == "big"].repeats.max() == 1 and p[p.source == "small"].repeats.max() <= 3 and p.n_tokens.min() > 0
    assert abs(r.loc["big"].actual_share - 0.6) < 0.005 and r.loc["absent"].drawn_tokens == 0
    again = mixing.mix(docs, targets)[0].toPandas()
    assert p.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert mixing.mix(docs, targets, total=1e9)[0].toPandas().groupby("source").repeats.min().to_dict() == {"big": 1, "small": 3}
    none, rep = mixing.mix(docs.limit(0), targets)
    assert none.count() == 0 and rep.toPandas().actual_share.isna().all()


def test_mix_cuts_the_border_again_and_again(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a" if i % 3 else "b", f"word number {i} " * (1 + i % 5)) for i in range(4000)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 2)], "source string, target_share double, max_repeats int")
    monkeypatch.setattr(mixing, "PARTS", (4, 4, 4))
    drawn, report = mixing.mix(docs, targets)
    p, r = drawn.toPandas(), report.toPandas().set_index("source")
    assert p.doc_id.is_unique and p.repeats.max() <= 2 and abs(r.actual_share["a"] - 0.7) < 0.002
    wanted = {x.source: x.wanted for x in mixing.water_fill([(s, r.target_share[s], int(r.max_repeats[s]), int(r.available_tokens[s])) for s in "ab"])}
    assert all(abs(r.drawn_tokens[s] - wanted[s]) <= p.n_tokens.max() for s in "ab")


def test_mix_of_the_tokens_at_hand(spark, tmp_path):
    rows = [(i, "scarce" if i < 10 else "big" if i % 2 else "wide", f"word number {i} ") for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("scarce", 0.1, 2), ("big", 0.6, 3), ("wide", 0.3, 3)], "source string, target_share double, max_repeats int").write.parquet(f"{tmp_path}/mix_targets.parquet")
    r = queries.queries()["p9_at_hand_shares"](spark, str(tmp_path)).toPandas().set_index("source")
    drawn = queries.queries()["p9_at_hand"](spark, str(tmp_path)).toPandas()
    assert abs(r.drawn_tokens.sum() / r.available_tokens.sum() - 1) < 0.005 and (drawn.n_tokens * drawn.repeats).sum() == r.drawn_tokens.sum()
    assert r.drawn_tokens["scarce"] == 2 * r.available_tokens["scarce"] and abs(r.drawn_tokens["big"] / r.drawn_tokens["wide"] - 2) < 0.02
    assert r.missed_share["scarce"] > 0.08 and r.missed_share["big"] < 0 and abs(r.missed_share.sum()) < 1e-9
    small = queries.p9_shares(spark, str(tmp_path)).toPandas()
    assert small.drawn_tokens.sum() < 0.2 * r.drawn_tokens.sum()  # the default total meets every target
    with pytest.raises(ValueError):
        mixing.mix(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/mix_targets.parquet"), total=1.0, of_hand=1.0)


# 10: toxicity

NICE = ["The forecast for {n} beats sales by {k} percent", "Please check the calendar of week {k}", "Stock in {n} was booked twice", "You can see the naked numbers of {n} on page {k}", "We lost {k} readings from {n}", "Kill the job before you restart {n}"]
FOUL = ["you are a worthless {x} and everyone knows it", "shut up you {x}, nobody asked you", "i will smash your ugly face in {n}", "send me naked pictures of yourself tonight", "all {x}s should be shot, they are vermin"]


def _docs(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = [r.choice(NICE).format(n=r.choice(("Alba", "Bergen", "Celle", "Dover")), k=r.randrange(90)) for _ in range(5)]
        bad = r.random() < 0.15
        if bad:
            f = r.choice(FOUL).format(x=r.choice(("moron", "idiot", "weasel")), n="Alba")
            f = r.choice((str, str.upper, lambda t: t.replace("o", "0").replace("i", "1").replace("e", "3"), lambda t: t.replace("a", "а"), lambda t: t.replace("you", "yoou")))(f)
            s.insert(r.randrange(5), f)
        out.append((i, ". ".join(s), int(bad)))
    return out


def _bad(model, texts):
    return model.scored(texts)[0] >= model.cut


def test_held_out_accuracy():
    model = toxicity.Model([(t, y ^ (i % 50 == 7)) for i, t, y in _docs(500, 1)])  # two percent of wrong labels
    test = _docs(300, 2)
    hit = list(zip(_bad(model, [t for _, t, _ in test]), [y for *_, y in test]))
    tp, fp, fn = sum(a and y for a, y in hit), sum(a and not y for a, y in hit), sum(y and not a for a, y in hit)
    assert tp / max(tp + fp, 1) > 0.9 and tp / max(tp + fn, 1) > 0.9


def test_harmless_copies_take_a_mark_back():
    """A sentence that occurs in many documents, by chance more often in positive ones, does not offend."""
    rows = [(t + (". Harder to seal when the lips of the machine are wet" if i % (3 if y else 12) == 0 else ""), y) for i, t, y in _docs(500, 6)]
    assert not _bad(toxicity.Model(rows), ["Harder to seal when the lips of the machine are wet"])[0]


def test_nearest_examples_are_exact():
    model = toxicity.Model([(t, y) for _, t, y in _docs(300, 3)])
    ex = model.examples
    dense = np.zeros((len(ex.label), ex.index.width))
    for t in range(ex.index.width):
        at = slice(ex.index.post[t], ex.index.post[t + 1])
        dense[ex.index.ids[at], t] = ex.index.weights[at]
    assert np.allclose(np.linalg.norm(dense, axis=1)[dense.any(axis=1)], 1, atol=1e-5)
    p = model.reader.batch([t for _, t, _ in _docs(150, 4)])
    border, term, w = ex.weighted(p.numbers, p.start)
    score = ex.score(p.numbers, p.start)
    some = 0
    for i in range(len(p)):
        q = np.zeros(ex.index.width)
        q[term[border[i] : border[i + 1]]] = w[border[i] : border[i + 1]]
        full = dense @ q
        order = [j for j in np.lexsort((np.arange(len(full)), -full)) if full[j] >= toxicity.FLOOR][:7]
        got = ex.nearest(term[border[i] : border[i + 1]], w[border[i] : border[i + 1]])[1]
        assert np.allclose(got, full[order], atol=1e-4)
        v = full[order] ** toxicity.POWER
        want = (v * ex.label[order]).sum() / (v.sum() + toxicity.PRIOR)
        if len(full) > 7 and len(order) == 7 and np.isclose(np.sort(full)[-8], full[order[-1]], atol=1e-6):
            continue  # a tie at the last place
        some += want > 0
        assert abs(score[i] - want) < 1e-3
    assert some > 5


def test_scores_do_not_depend_on_what_was_scored_before():
    model = toxicity.Model([(t, y) for _, t, y in _docs(300, 3)])
    texts = [t for _, t, _ in _docs(60, 4)] + ["you you you worthless moron", "you worthless moron", None, "", " "]
    first = model.scored(texts)[0]
    again = [model.scored([t])[0][0] for t in reversed(texts)][::-1]
    model.memo, toxicity.KEPT, kept = {}, 3, toxicity.KEPT
    few = np.concatenate([model.scored([t])[0] for t in texts])
    toxicity.KEPT = kept
    assert np.allclose(first, again) and np.allclose(first, few)


@pytest.mark.parametrize("raw, want", [("Y0U 4R3 4N 1D107", "you are an idiot"), ("i.d.i.o.t", "idiot"), ("I D I O T", "idiot"), ("id​iot", "idiot"), ("iiidiooot", "idiot"), ("іdіоt", "idiot"), ("on 24 May", "on may")])
def test_disguises(raw, want):
    assert tokens(raw) == [fold(w) for w in want.split()]


def test_passages():
    r = Reader()
    text = "A: one two. three :) i d i o t!\nB: y0u 4r3 45 b4d m4n - the end... 24 of May\n" + "word " * 40
    p = r.batch([text, None, "", "again"])
    name = {i: w for w, i in r.number.items()}
    got = [(int(p.text[i]), [name[n] for n in p.numbers[p.start[i] : p.start[i + 1]]]) for i in range(len(p))]
    fold_all = lambda t: [fold(w) for w in t.split()]
    assert sorted(x for t, x in got if t == 0 and len(x) < 14) == sorted(map(fold_all, ("one two", "three", "idiot", "you are as bad man", "the end", "of may", "word word word word word word word word word word word word")))
    assert (3, ["again"]) in got and max(len(x) for _, x in got) == 14 and p.written(0) == "one two."
    slipped = Reader(["whatever"]).batch(["whatevr whatever whhatever other"])
    assert slipped.numbers.tolist() == [1, 1, 1, 0]


def test_score_documents(spark):
    rows = _docs(300, 5)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(1000, None, None), (1001, " ", "s"), (None, rows[0][1], "s"), (0, rows[0][1], "s")], "doc_id long, text string, source string").withColumns({"score": F.lit("clash"), "_text": F.lit(1)})
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs.drop("score"), labels, keep=["source"]).toPandas()
    assert len(got) == 304 and not got[got.doc_id.isin([1000, 1001])].is_offending.any() and got.score.between(0, 1).all()
    assert toxicity.score_documents(docs.limit(0).drop("score"), labels).count() == 0
    blank = toxicity.score_documents(docs.drop("score"), labels.where("toxic = 0")).toPandas()
    assert not blank.is_offending.any() and (blank.score == 0).all()
