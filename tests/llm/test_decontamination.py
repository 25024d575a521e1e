from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstar.llm import bytewords, decontamination
from reelstar.llm.common import ship_package


def lcs(a, b, w):
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[x] if x == y else 0)
    return best[-1][-1]


def test_weighted_lcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(0, 20)), rng.integers(0, 5, rng.integers(0, 20))
        w = rng.random(5)
        assert np.isclose(decontamination.weighted_lcs(a, b, w), lcs(a.tolist(), b.tolist(), w))


def test_words_on_bytes():
    assert decontamination.words("The QUICK_1 brown-fox, ÉTÉ!\xd7漢字 ') É") == [
        "the", "quick_1", "brown", "fox", "été", "\xd7", "漢", "字", "é"]
    assert decontamination.words("今日は、Tokyo駅です。ไทย ลาว ខ្មែ 한국 मत") == [
        *"今日は", "tokyo", *"駅です", *"ไทย", *"ลาว", *"ខ្មែ", "한국", "मत"]
    assert decontamination.words("好，好！ 々〆") == ["好", "好"]
    assert decontamination.words(None) == decontamination.words(" .,") == []
    h = bytewords.hash_words(["a", "b", "ab", "a", "", "été"])
    assert h[0] == h[3] and len(set(h.tolist())) == 5
    assert bytewords.Lookup(["x", "y", "été"])(bytewords.hash_words(["été", "z", "x"])).tolist() == [2, -1, 0]


def world(seed=3):
    rnd = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    rare = [f"r{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(rare) for _ in range(n)]
    items = [(k, text(rnd.randint(12, 70))) for k in range(30)]
    docs, leaks, edits = [], set(), set()
    for i in range(400):
        words = text(rnd.randint(0, 300))
        if i % 8 == 0:
            k, item = items[rnd.randrange(30)]
            item = list(item)
            if i % 16 == 0:                              # a paraphrase: words dropped, swapped, put in
                for _ in range(len(item) // 8):
                    item[rnd.randrange(len(item))] = rnd.choice(rare)
                edits.add((i, k))
            else:
                leaks.add((i, k))
            at = rnd.randint(0, len(words))
            words[at:at] = item
        docs.append((i, " ".join(words).capitalize() if i % 3 else "\n".join(words)))
    return docs, [(k, " ".join(w)) for k, w in items], leaks, edits


def brute(docs, items):
    """All pairs of passages and sliding regions, checked by the operator's own rule."""
    words = {i: decontamination.words(t) for i, t in docs}
    df: dict = {}
    for w in words.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    n, out = len(docs), set()
    for k, t in items:
        for p in decontamination.cut(decontamination.words(t)):
            rarest = sorted(set(p), key=lambda w: (df.get(w, 0), w))
            kept = {w for w in p if df.get(w, 0) <= decontamination.COMMON * n} | set(rarest[:decontamination.KEPT])
            p = [w for w in p if w in kept]
            weight = {w: float(np.log((1 + n) / (1 + df.get(w, 0))) + 0.05) for w in kept}
            mass = sum(weight[w] for w in p)
            top = sorted(kept, key=lambda w: (-weight[w], w))[:decontamination.ANSWER]
            for i, ws in words.items():
                for a in range(0, max(1, len(ws)), decontamination.HALF):
                    region = [w for w in ws[max(0, a - 32):a + 96] if w in kept]
                    if sum(weight[w] for w in set(region)) < 0.3 * mass:
                        continue
                    share = lcs(p, region, weight) / mass
                    if decontamination.passes(share, np.mean([w in region for w in top])):
                        out.add((i, k))
    return out


def test_recall_against_brute_force(spark, documents):
    ship_package(spark)
    docs, items, leaks, edits = world()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(documents(docs), bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    want = brute(docs, items)
    assert leaks <= found and len(found & want) >= 0.9 * len(want) and found <= want | leaks | edits
    assert len(edits & found) >= 0.9 * len(edits)
    clean = decontamination.keep_clean(documents(docs), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in found}


@pytest.mark.parametrize("items", [2000, 7])
def test_odd_rows(spark, documents, items):
    ship_package(spark)
    docs, bench, leaks, _ = world(4)
    some = sorted(leaks)[0]
    text = dict(docs)[some[0]]
    rows = [*docs, (some[0], text), (None, text), (9001, None), (9002, ""), (9003, text + " x" * 50_000)]
    table = spark.createDataFrame([*bench, (None, bench[0][1]), (77, None), (78, ""), (79, " . ")], "item_id long, text string")
    df = documents(rows).withColumn("cosine", F.lit(1)).withColumn("_id", F.lit(1)).withColumn("item_id", F.lit(1))
    got = [(r.doc_id, r.item_id) for r in decontamination.contaminated(df, table, items=items).collect()]
    assert len(got) == len(set(got)) and leaks <= set(got)
    assert (None, some[1]) in got and (9003, some[1]) in got
    assert not {77, 78, 79} & {k for _, k in got} and not {9001, 9002} & {i for i, _ in got}
    assert decontamination.contaminated(documents([]), table).collect() == []
    assert decontamination.contaminated(df, table.limit(0)).collect() == []


def test_a_passage_in_a_third_of_all_documents(spark, documents):
    ship_package(spark)
    docs, items, leaks, _ = world(6)
    hot = items[0][1]
    rows = [(i, t + " " + hot if i % 3 == 0 else t) for i, t in docs]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(rows), bench).collect()}
    assert {(i, items[0][0]) for i, _ in rows if i % 3 == 0} | leaks <= found
    assert not {i for i, k in found if k == items[0][0] and i % 3 and i % 8}


def test_words_put_in_against_brute_force(spark, documents):
    """Passages spread over up to four halves by words put in between: all pairs that the check accepts are found."""
    ship_package(spark)
    rnd = random.Random(8)
    fill = [f"c{i}" for i in range(30)] + [f"f{i}" for i in range(4000)]
    rare = [f"r{i}" for i in range(3000)]
    items = [(k, [rnd.choice(rare) for _ in range(rnd.randint(24, 60))]) for k in range(40)]
    other = sorted({w for _, item in items for w in item})
    docs, spread = [], set()
    for i in range(300):
        words = [rnd.choice(fill if rnd.random() < 0.8 else other) for _ in range(rnd.randint(0, 200))]
        if i % 3 == 0:
            k, item = items[rnd.randrange(40)]
            share = (0.25, 0.6, 1.0, 1.5)[i // 3 % 4]
            item = [x for w in item for x in [w, *(rnd.choice(fill) for _ in range(int(share + rnd.random())))]]
            at = rnd.randint(0, len(words))
            words[at:at] = item
            spread.add((i, k))
        docs.append((i, " ".join(words)))
    items = [(k, " ".join(w)) for k, w in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(docs), bench).collect()}
    want = brute(docs, items)
    assert len(want & spread) > 80
    assert found == want


def test_short_items_and_clean_documents(spark, documents):
    """Items of two or three words match only in a row, items of one word nothing; clean documents stay."""
    ship_package(spark)
    rnd = random.Random(9)
    common = [f"c{i}" for i in range(30)]
    rare = [f"r{i}" for i in range(400)]
    items = [(k, [rnd.choice(rare) for _ in range(k // 10 + 1)]) for k in range(30)]
    items += [(30, items[25][1]), (31, ["c1", "c2"]), (32, ["c3", "c4", "c5"])]
    docs, leaks = [], set()
    for i in range(300):
        words = [rnd.choice(common if rnd.random() < 0.5 else rare) for _ in range(rnd.randint(20, 200))]
        if i % 10 == 0:
            k, item = items[rnd.randrange(10, len(items))]
            at = rnd.choice([0, 31, 20, len(words)])     # across the edge of a half, too
            words[at:at] = item
        elif i % 10 == 1:                                # all words in order, one put in
            item = items[20 + i // 10 % 10][1]
            words[5:5] = [item[0], item[1], "zz", item[2]]
        docs.append((i, words))
        for k, item in items:
            if len(item) > 1 and any(words[a:a + len(item)] == item for a in range(len(words))):
                leaks.add((i, k))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    table = documents([(i, " ".join(w)) for i, w in docs])
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(table, bench).collect()}
    assert found == leaks and len(leaks) > 30
    clean = decontamination.keep_clean(table, bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in leaks}
    single = bench.filter("item_id < 10")
    assert decontamination.contaminated(table, single).collect() == []
    assert decontamination.keep_clean(table, single).count() == len(docs)


def test_items_of_a_few_words_in_a_short_stretch(spark, documents):
    """Words of an item of six, one every fifteen words, mark no document; one word put in between does."""
    ship_package(spark)
    rnd = random.Random(10)
    fill = [f"f{i}" for i in range(500)]
    item = [f"r{i}" for i in range(6)]
    some = lambda n: [rnd.choice(fill) for _ in range(n)]
    docs = [(i, " ".join(some(100))) for i in range(100)]
    docs.append((100, " ".join(x for w in item for x in [w, *some(14)])))
    docs.append((101, " ".join([*some(29), *item[:3], *some(1), *item[3:], *some(30)])))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(documents(docs), bench).collect()] == [101]


CHINESE = "大熊猫主要栖息在中国西南部的竹林山区它们每天要吃很多竹子"
JAPANESE = "富士山は日本で最も高い山であり世界遺産に登録されています"
THAI = "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทยและเป็นเมืองที่ใหญ่ที่สุด"


def test_scripts_without_spaces(spark, documents):
    ship_package(spark)
    rnd = random.Random(4)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    prose = lambda n: "".join(rnd.choice(han) for _ in range(n))
    texts = [prose(rnd.randint(30, 300)) for _ in range(120)]
    items = [(1, CHINESE), (2, JAPANESE), (3, THAI), (4, "熊猫"), (5, "竹"), (6, None), (7, "...")]
    texts[5] = prose(40) + CHINESE + prose(60)
    texts[17] = "前文 " + JAPANESE + "。" + prose(80)
    texts[33] = "intro words " + THAI + " more words"
    texts[50] = prose(20) + "大熊猫" + prose(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(texts), bench).collect()}
    assert got == {(5, 1), (17, 2), (33, 3), (5, 4), (50, 4)}
    # what tells nothing is listed, not passed over in silence
    assert {(r.item_id, r.words) for r in decontamination.left_out(bench).collect()} == {(5, 1), (6, 0), (7, 0)}


def test_sample_does_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(200)}" for _ in range(200)) for _ in range(60)]
    lookup = bytewords.Lookup([f"w{i}" for i in range(200)])

    def sample(rows):
        df = spark.createDataFrame([(t,) for t in rows], "_t string").repartition(5)
        return sorted(str(r) for r in decontamination._sample(df, 60, lookup, np.ones(200), 40).collect())

    assert sample(texts) == sample(texts[::-1]) and 20 <= len(sample(texts)) <= 40


def test_the_latent_space_is_fitted_on_every_window(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "LISTED", 50)       # sums are handed on in many parts
    rnd = random.Random(9)
    size, half = 300, decontamination.HALF
    texts = [" ".join(f"w{rnd.randrange(size + 40)}" for _ in range(n)) for n in (0, 1, 31, 32, 33, 64, 65, 200, 900)]
    texts += [texts[-1], "", "nothing known"]
    lookup = bytewords.Lookup([f"w{i}" for i in range(size)])
    idf = np.array([rnd.uniform(0.1, 3) for _ in range(size)])
    rows = []
    for t in texts:
        own = [int(w[1:]) if w[0] == "w" and int(w[1:]) < size else -1 for w in t.split()]
        for s in range(0, max(1, len(own) - half), half):
            at, w = decontamination.tfidf(np.array(own[s:s + 2 * half], np.int64), idf)
            if len(at):
                rows.append(np.zeros(size))
                rows[-1][at] = w / np.sqrt(w @ w)
    every = np.array(rows)
    sums = decontamination.together(spark.createDataFrame([(t,) for t in texts], "_t string").repartition(5), lookup, idf)
    got = np.zeros((size, size))
    for r in sums.collect():
        got[r.a, r.b] = r.weight * decontamination.UNIT
    assert np.allclose(got, np.triu(every.T @ every), atol=1e-7)
    block = np.random.default_rng(1).standard_normal((size, 7))
    assert np.allclose(decontamination._product(sums, block), every.T @ (every @ block), atol=1e-5)
    # however the rows are dealt, the sums are the same to the bit
    again = decontamination.together(spark.createDataFrame([(t,) for t in texts[::-1]], "_t string").repartition(3), lookup, idf)
    assert sorted(sums.collect()) == sorted(again.collect())


def test_the_driver_gets_each_row_of_a_product_once(spark, monkeypatch):
    rnd = random.Random(12)
    size, rank = 3 * decontamination.STRIPE + 16, 8
    width = rank + decontamination.OVERSAMPLE
    texts = [" ".join(f"w{rnd.randrange(size)}" for _ in range(200)) for _ in range(30)]
    lookup = bytewords.Lookup([f"w{i}" for i in range(size)])
    sums = decontamination.together(spark.createDataFrame([(t,) for t in texts], "_t string"), lookup, np.ones(size))
    upper = np.zeros((size, size))
    for r in sums.collect():
        upper[r.a, r.b] = r.weight * decontamination.UNIT
    every = upper + upper.T - np.diag(np.diag(upper))
    own = np.random.default_rng(2).random((20, size))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    got, plain = [], type(sums).toLocalIterator

    def counted(self, *args, **options):
        for r in plain(self, *args, **options):
            got.append(len(r.part))
            yield r

    monkeypatch.setattr(type(sums), "toLocalIterator", counted)
    basis = decontamination.latent_basis(sums, own, rank)
    assert sum(got) == (decontamination.ROUNDS + 1) * size * width * 8
    assert max(got) <= decontamination.STRIPE * width * 8
    whole = every + own.T @ own * round(np.trace(every)) / len(own)
    q = np.random.default_rng(7).standard_normal((size, width))
    for _ in range(decontamination.ROUNDS):
        q = np.linalg.qr(whole @ q)[0]
    values, vectors = np.linalg.eigh(q.T @ whole @ q)
    want = q @ vectors[:, np.argsort(-values)[:rank]]
    assert np.allclose(basis @ basis.T, want @ want.T, atol=1e-6)


def test_nothing_is_fitted_on_a_sample(spark, documents, monkeypatch):
    def refuse(*_):
        raise AssertionError("a sample of the windows")

    monkeypatch.setattr(decontamination, "_sample", refuse)
    texts = [" ".join(f"w{(7 * i + k) % 90}" for k in range(50)) for i in range(20)]
    bench = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    found = decontamination.contaminated(documents(texts), bench).collect()
    assert (3, 1) in {(r.doc_id, r.item_id) for r in found}
