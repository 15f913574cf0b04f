"""Operators 1 and 8: held-out accuracy and defined edge cases."""

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import langid, quality


def test_language_of_held_out_rows(spark, sf_small):
    r = langid.op1(spark, sf_small).join(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = r[r.held_out]
    assert len(r) == 200 and (held.lang == held.lang_pred).mean() > 0.95
    assert r.score.between(0, 1).all() and r.rejected.sum() <= 2


def test_probabilities_of_a_language_sum_to_one():
    texts = ["abab abba baab", "bbab aaba"]
    padded, at, _, _ = langid.symbols(texts)
    g = np.stack([padded[at - j] for j in range(langid.ORDER - 1, -1, -1)], 1)
    u, n = np.unique(g, axis=0, return_counts=True)
    m = langid.Model(["x"], [(u, n)])
    alphabet = np.unique(padded)
    for ctx in ("ab", "ba ", "a"):
        lines = [ctx + chr(c) for c in (97, 98)]
        ce = [m.cross_entropy([t])[0][0, 0] * m.cross_entropy([t])[1][0] for t in lines]
        assert all(np.isfinite(ce))
    # over the whole alphabet and one unknown symbol, after a seen context
    total = 0.0
    ctx = np.array([97, 98, 97, 98], np.uint32)
    v = lambda x: langid.mix((np.asarray(x).astype(np.uint64) + langid.U64(1)) * langid.MIX)
    for c in [*alphabet.tolist(), 0x4E00]:
        gram = np.append(ctx, np.uint32(c))
        p, back = None, 1.0
        for k in range(langid.ORDER, 0, -1):
            col = [v(gram[-1 - j:len(gram) - j]) for j in range(k)]
            q = m.grams[k - 1].find(langid.gram_hash(col))[0]
            if q >= 0:
                p = back * np.exp(m.logp[k - 1][0, q])
                break
            h = m.contexts[k - 1].find(langid.gram_hash(col[1:]) if k > 1 else np.zeros(1, np.uint64))[0]
            back *= np.exp(m.logb[k - 1][0, h]) if h >= 0 else 1.0
        total += p if p is not None else back * np.exp(m.uniform)
    assert abs(total - 1) < 1e-5


def test_language_edge_cases(spark, make_docs):
    docs = make_docs([(1, "the house and the garden " * 20), (2, None), (3, ""), (4, "123 456 !!"), (None, "the garden"), (1, "the house and the garden " * 20), (5, "書" * 4000)])
    model = langid.train(docs, F.lit(True))
    r = langid.identify(docs, model).toPandas()
    assert len(r) == 7 and (r.lang_pred[[1, 2, 3]] == "und").all() and r.rejected[[1, 2, 3]].all()
    assert (r.lang_pred[[0, 4, 5]] == "en").all() and not r.rejected[[0, 4, 5]].any()
    assert r.columns[-4:].tolist() == ["lang_pred", "score_", "cross_entropy", "rejected"] and (r.score == "mine").all()
    empty = docs.limit(0)
    m = langid.train(empty, F.lit(True))
    assert langid.identify(empty, m).count() == 0 and langid.identify(docs, m).where("lang_pred != 'und'").count() == 0


def test_language_of_one_held_back_row_is_learned(spark, make_docs):
    rare = "qwx vyz kjq zzv wqk xyj " * 20
    ids = spark.range(1000).where(F.xxhash64(F.col("id").cast("string"), F.lit(rare)).bitwiseAND((1 << 63) - 1) % 5 == 0).limit(1).first().id
    rows = [(i, "the house and the garden of the old town " * 5, "en") for i in range(1000, 1030)] + [(ids, rare, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    r = langid.identify(docs, model).where("lang = 'xx'").first()
    assert model.langs == ["en", "xx"] and r.lang_pred == "xx" and not r.rejected


def test_foreign_text_is_rejected(spark, sf_small, make_docs):
    model = langid.train(spark.read.parquet(f"{sf_small}/documents.parquet"), F.lit(True))
    r = langid.identify(make_docs([(1, "ξζψωφ πρστυ ασδφγ ηξκλ " * 30)]), model).first()
    assert r.rejected


def test_wrong_labels_do_not_switch_rejection_off(spark, sf_small):
    """Two in a hundred labels stand on random letters or another language."""
    import random
    rnd = random.Random(4)
    known = [[("".join(rnd.choice(c) + rnd.choice(v) for _ in range(rnd.randint(1, 3)))) for _ in range(400)] for c, v in (("bdglm", "aeo"), ("prstk", "iou"))]
    foreign = ["".join(rnd.choice("fvjzhwx") + rnd.choice("yaeq") for _ in range(rnd.randint(1, 3))) for _ in range(400)]
    say = lambda words, n: " ".join(rnd.choice(words) for _ in range(n))
    noise = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    rows = []
    for k in range(3000):
        lang = k % 2
        words = rnd.choice((8, 30, 80))
        text = say(known[lang], words) if k % 50 > 0 else rnd.choice((noise(words), say(known[1 - lang], words)))
        rows.append((k, text, "ab"[lang]))
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    for make, least, most in ((lambda: say(known[0], rnd.choice((8, 60))), 0, 0.01), (lambda: say(known[1], 30) , 0, 0.01),
                              (lambda: say(known[0], 30) + " " + say(known[1], 30), 0, 0.01),
                              (lambda: noise(rnd.choice((8, 60))), 0.9, 1), (lambda: say(foreign, rnd.choice((8, 60))), 0.9, 1)):
        judged = model.judge([make() for _ in range(200)])
        assert least <= np.mean(judged[3]) <= most


def test_rows_without_id_keep_the_sample_bounded(spark):
    """A third of the ids null, and many copies of one row: the sample keeps its share."""
    import random
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12))
    rows = [(None if k % 3 == 0 else k, f"the house {word()}", "en") for k in range(3000)] + [(None, "one and the same text", "en")] * 3000
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), train_chars=3000)
    # about 150 rows of 12 random letters, not the 1,000 without an id
    assert model.langs == ["en"] and len(model.grams[langid.ORDER - 1].h) < 4000


def test_quality_of_held_out_rows(spark, sf_small):
    big = sf_small.replace("0.001", "0.01")
    r = quality.op8(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").toPandas()
    held = r[r.held_out]
    assert (held.predicted == held.quality).mean() > 0.9
    assert r.score.between(0, 1).all() and ((r.score >= 0.3) == (r.predicted == 1)).all()


def test_quality_edge_cases(spark, make_docs):
    docs = make_docs([(i, ("good words here " if i % 2 else "B@D!! ### ") * (i + 1)) for i in range(40)] + [(90, None), (91, ""), (None, "x"), (1, "x")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.train(docs, labels, F.lit(True))
    r = quality.score(docs, m).toPandas()
    assert len(r) == 44 and r["score_"].between(0, 1).all() and (r.score == "mine").all()
    assert r[r.doc_id == 21].score_.iloc[0] > 0.5 > r[r.doc_id == 20].score_.iloc[0]
    none = quality.train(docs, labels.limit(0), F.lit(True))
    assert quality.score(docs, none).where("score_ != 0.5").count() == 0
    assert quality.score(docs.limit(0), m).count() == 0


def test_long_texts_in_parts_have_the_same_entropy_and_features(monkeypatch):
    import random
    rnd = random.Random(2)
    words = ["the", "House", "über", "42", "a", "--", "garden", "x" * 50]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 5, 40, 400)] + [None, "the the the the the the end", "nothing", "w" * 300, " \n "]
    arr = langid.pa.array(texts, langid.pa.string())
    padded, at, _, _ = langid.symbols(["the house and the garden über alles " * 9])
    g = np.stack([padded[at - j] for j in range(langid.ORDER - 1, -1, -1)], 1)
    m = langid.Model(["x", "y"], [np.unique(g, axis=0, return_counts=True), np.unique(g[::2], axis=0, return_counts=True)])
    want = m.entropies(arr)
    counts = lambda: sorted((r["gram"], r["n"]) for b in langid._count([langid.pa.RecordBatch.from_arrays([langid.pa.array(["x"]), arr.slice(4, 1)], ["l", "t"])]) for r in b.to_pylist())
    whole = {}
    for k, n in counts():
        whole[k] = whole.get(k, 0) + n
    plain = set()
    for i, _, r, k in quality.row_features(arr):
        plain |= set(zip((r + i).tolist(), k.tolist(), strict=True))
    for limit in (7, 20, 64, 333):
        monkeypatch.setattr(langid, "CHUNK", limit)
        got = m.entropies(arr)
        assert np.allclose(got[0], want[0], atol=1e-5) and (got[1] == want[1]).all() and (got[2] == want[2]).all()
        parts = {}
        for k, n in counts():
            parts[k] = parts.get(k, 0) + n
        assert parts == whole
        cut = set()
        for i, _, r, k in quality.row_features(arr, limit):
            cut |= set(zip((r + i).tolist(), k.tolist(), strict=True))
        assert cut == plain
