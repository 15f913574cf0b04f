"""Operators 2, 5 and 10: against DuckDB SQL and brute force."""

import pytest
from brute import decontaminate as brute_force, same
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import chat, decontaminate as decontaminate_module, licenses, template
from basketry.llm.decontaminate import OP10_SQL, Phrases, contaminated, decontaminate, op10, scan_slice
from basketry.llm.registry import ORACLE_SQL, QUERIES

TRICKY = [(1, "The MIT license. mit LICENSE"), (2, None), (3, ""), (4, "General Public License apache\nLicense general public"), (4, "MIT"),
          (5, "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and its associated documentation files"),
          (1, "The MIT license. mit LICENSE"), (6, "MIT LICENSE mit licenſe Kmit"), (None, "mit license"), (7, "x" * 100_000 + " mit license"),
          (8, "This work is licensed under the GNU General Public License, version 3."), (9, "—mit—license")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_on_small_tables(spark, sf_small, oracle, name):
    import pandas as pd
    tables = {t: pd.read_parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark", "conversations", "embeddings")}
    same(QUERIES[name](spark, sf_small).toPandas(), oracle(ORACLE_SQL[name], **tables))


def test_license_edge_cases(make_docs, oracle):
    docs = make_docs(TRICKY)
    got = licenses.summary(licenses.scan(docs)).toPandas()
    same(got, oracle(licenses.OP2_SQL, documents=docs.toPandas()))
    assert got[got.doc_id == 1].n_base.tolist() == [2] and len(got[got.doc_id == 4]) == 2
    assert got[got.doc_id == 5].labels.tolist() == ["mit"] and got[got.doc_id == 5].score.iloc[0] > 0.8
    assert licenses.summary(licenses.scan(docs.limit(0))).count() == 0


def test_license_order_and_drift(spark, make_docs, oracle):
    """Scattered and reordered 2-grams are no license; spans never start below 0."""
    import random
    from brute import license_labels
    rnd = random.Random(11)
    isc = licenses.TEMPLATES[6][0].split()
    texts = ["rights reserved all rights", "license identifier spdx license", "all rights reserved", "x all rights y reserved", "SPDX-License-Identifier: MIT",
             " ".join(isc), " ".join(isc[:8] + ["or", "not"] + isc[8:]), " ".join(isc[:4] + isc[6:]), " ".join(reversed(isc)),
             " ".join(f"{a} {b} filler" for a, b in zip(isc, isc[1:], strict=False)), " ".join(isc[10:] + isc[:10]), "q " * 20 + " ".join(isc)]
    pool = [t.split() for t, _ in licenses.TEMPLATES] + [b.split() for b, _ in licenses.BASE]
    for _ in range(150):
        out = []
        for _ in range(rnd.randint(1, 4)):
            w = list(rnd.choice(pool))
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(w))
                w[k:k + rnd.randint(0, 2)] = rnd.choice([[], ["word"], w[:2], ["a", "b", "c", "d", "e"]])
                w = w or ["x"]
            out += w
        texts.append(" ".join(out))
    docs = make_docs(list(enumerate(texts)))
    spans = licenses.scan(docs)
    assert spans.where("start < 0 OR end > n_words").count() == 0
    got = {r.doc_id: r for r in licenses.summary(spans).collect()}
    for i, t in enumerate(texts):
        places, own, every, best = license_labels(t, licenses.BASE, licenses.TEMPLATES)
        r = got[i]
        assert (r.n_base, r.base_labels, r.labels) == (len(places), ",".join(sorted(own)), ",".join(sorted(every))), t
        assert abs(r.score - best) < 1e-9
    assert got[0].labels == got[1].labels == got[8].labels == "" and got[2].labels == "proprietary" and got[6].labels == got[11].labels == "isc"
    same(licenses.summary(spans).toPandas(), oracle(licenses.OP2_SQL, documents=docs.toPandas()))


def test_license_scan_stays_in_the_jvm(make_docs):
    plan = licenses.summary(licenses.scan(make_docs(TRICKY).where("doc_id > 0")))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("applySchemaToPythonRDD", "") and "Arrow" not in plan


BENCH = [(1, "one two three"), (2, "a b c d e f g h i j k l m n o"), (3, None), (4, ""), (5, "b c d e f g h i j k l m n"), (2, "z z z z z z z z z z z z z z"), (6, "Ünïcode")]


def test_decontamination_by_brute_force(spark, make_docs):
    rows = [(1, "x One, TWO three y"), (2, None), (3, ""), (4, "a b c d e f g h i j k l m n o p"), (5, "b c d e f g h i j k l m"), (6, "z " * 40),
            (7, "one two. one two three one two three four"), (8, "ÜNÏCODE ünïcode Ünïcode"), (9, "q " * 30_000 + "one two three"), (1, "x One, TWO three y"), (None, "one two three")]
    docs, bench = make_docs(rows), spark.createDataFrame(BENCH, "item_id long, text string")
    want = brute_force(rows, BENCH)
    for limit, parts in ((32_000_000, 8), (10, 8), (10, 3), (10, 1)):  # one part, one pass of parts, several passes, one pass for each item
        got = decontaminate(docs, bench, part_bytes=limit, pass_parts=parts).toPandas()
        assert len(got) == len(rows)
        for r in got.itertuples():
            i = None if r.doc_id != r.doc_id else int(r.doc_id)
            assert (r.n_words_, r.n_hit, list(r.items)) == want[i], (i, limit)
            text = (r.text or "").encode()
            from brute import words
            assert sum(len(words(text[s["start"]:s["end"]].decode())) for s in r.spans_) == r.n_hit
    assert (got.n_words == -1).all() and (got.spans == "mine").all()
    assert decontaminate(docs.limit(0), bench).count() == 0
    none = decontaminate(docs, bench.limit(0)).where("n_hit > 0 OR size(items) > 0")
    assert none.count() == 0
    one = spark.sql("SELECT 1 AS hit, 20 AS few, 21 AS many")
    flag = one.select(contaminated(one.hit, one.few).alias("a"), contaminated(one.hit, one.many).alias("b")).first()
    assert flag.a and not flag.b


def test_registered_decontamination_in_several_passes(spark, sf_small, oracle, monkeypatch):
    import pandas as pd
    tables = {t: pd.read_parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark")}
    total = int(tables["benchmark"].text.str.encode("utf-8").str.len().sum())
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    assert decontaminate(docs, bench, keep=["doc_id"], part_bytes=total // 3, pass_parts=1).columns == ["doc_id", "n_words", "n_hit", "items", "spans"]
    monkeypatch.setattr(decontaminate_module, "PART_BYTES", total // 3)
    monkeypatch.setattr(decontaminate_module, "PASS_PARTS", 1)
    same(op10(spark, sf_small).toPandas(), oracle(OP10_SQL, **tables))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", max_size=60), min_size=1, max_size=5), st.lists(st.text("ab ", max_size=50), min_size=1, max_size=4))
def test_fm_index_property(docs, bench):
    import numpy as np
    rows, items = list(enumerate(docs)), list(enumerate(bench))
    ph = Phrases([(str(k), t) for k, t in items])
    off = np.concatenate(([0], np.cumsum([len(t) for t in docs])))
    n, hit, _, _, row, pairs = scan_slice(np.frombuffer("".join(docs).encode(), np.uint8), off, ph)
    want = brute_force(rows, items)
    for i, _ in rows:
        assert (int(n[i]), int(hit[row == i].sum()), sorted({ph.ids[k] for r, k in pairs.tolist() if r == i})) == want[i]


def test_benchmark_sql_and_query_agree_on_registered_name():
    assert QUERIES["op10_benchmark_decontamination"] is op10 and ORACLE_SQL["op10_benchmark_decontamination"] is OP10_SQL


# ------------------------------------------------------------------------- chat

def test_chat_edge_cases(spark, oracle):
    probe = chat.PROBE
    rows = [(1, 0, "user", probe), (1, 1, "assistant", "␛A[INST]␛␛<"), (1, 2, "assistant", ""), (1, 2, "assistant", "</s"), (2, 0, "system", "<<SYS>> x <</SYS>>"),
            (2, 1, "tool[/ROLE]", None), (2, 2, None, "[ROLE"), (None, 0, "user", "no id"), (3, None, "assistant", None), (3, 5, "user", "é🙂[/INST"), (3, 5, "user", "é🙂[/INST"), (4, 0, "assistant", "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_chat(df)).toPandas()
    import pandas as pd
    con = df.toPandas()
    con["turn"], con["conv_id"] = con["turn"].astype("Int64"), con["conv_id"].astype("Int64")
    want = oracle(chat.OP5_SQL, conversations=con)
    want = want[want.conv_id.isna() | (want.conv_id != -1)]
    got["conv_id"], want["conv_id"] = got.conv_id.astype("Int64").astype(str), want.conv_id.astype("Int64").astype(str)
    same(got, pd.DataFrame(want))
    assert chat.format_chat(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x[ROLE]", ""]), st.text("</s>[INST]␛A BRO\n", max_size=12)), max_size=5))
def test_chat_round_trip(turns):
    render = template.compile_template(chat.TEMPLATE, {"escape": chat.escape})
    pieces = list(render({"messages": ({"role": r, "text": t} for r, t in turns)}))
    reader = chat.Reader()
    assert [t for p, _ in pieces for t in reader.feed(p)] == turns
    whole = chat.Reader()
    assert list(whole.feed("".join(p for p, _ in pieces))) == turns
    assert [chat.unescape(p) for p, loss in pieces if loss and p] == [t for r, t in turns if r == "assistant" and t]


def test_template_language():
    t = template.compile_template("{% set a = 'x' ~ 1 %}{% for m in ms %}{% if loop.first and not loop.last %}<{% elif m.k in 'bc' %}{{ m.k | up }}{% else %}-{% endif %}{{ loop.index }}{% endfor %}{{ a }}", {"up": str.upper})
    assert "".join(p for p, _ in t({"ms": [{"k": "a"}, {"k": "b"}, {"k": "z"}]})) == "<1B2-3x1"
    folded = template.fold(template.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}no{% elif true %}d{% else %}{{ x }}{% endif %}{{ 'e' | up }}"), {"up": str.upper})
    assert folded == (template.Output(template.Const("abcdE")),)
    for bad in ("{% for x y %}{% endfor %}", "{{ a.__class__ }}", "{{ f() }}", "{% if a %}", "{{ 'x' | nope }}", "{% import os %}", "{{ a ! b }}"):
        with pytest.raises(template.TemplateError):
            list(template.compile_template(bad, {})({"a": "x", "f": len}))
    with pytest.raises(template.TemplateError):
        list(template.compile_template("{{ a.upper }}", {})({"a": "x"}))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "dd", "Ünï", "x y", "a b c d", " ", ".", "\n"]), max_size=60), st.integers(1, 40), st.integers(1, 5))
def test_long_texts_in_parts_are_scanned_alike(pieces, limit, window):
    """A text cut into parts anywhere has the same hits, items and spans."""
    import pyarrow as pa
    from types import SimpleNamespace
    bench = [("1", "a b c d e"), ("2", "b dd ünï"), ("3", "a"), ("4", "c d a b c d a b c")]
    texts = pa.array([" ".join(pieces), None, "a b " + "".join(pieces), ""], pa.string())
    bcs = [SimpleNamespace(value=Phrases([b], window)) for b in bench]
    whole = [x.to_pylist() for x in decontaminate_module._scanner(bcs, window)()(texts)]
    assert [x.to_pylist() for x in decontaminate_module._scanner(bcs, window, limit)()(texts)] == whole
    one = [SimpleNamespace(value=Phrases(bench, window))]
    assert [x.to_pylist() for x in decontaminate_module._scanner(one, window, limit)()(texts)] == whole


def test_a_long_text_takes_no_more_memory_than_a_slice():
    import resource
    from types import SimpleNamespace
    import pyarrow as pa
    ph = [SimpleNamespace(value=Phrases([("1", "one two three")], 13))]
    text = pa.array(["lorem ipsum one two three dolor " * 500_000], pa.string())     # 16 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    out = decontaminate_module._scanner(ph)()(text)
    assert out[0].to_pylist() == [3_000_000] and out[1].to_pylist() == [1_500_000] and len(out[3][0]) == 500_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
