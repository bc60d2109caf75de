"""The character model of problem 10, its margins, its prunings, and restored texts against their originals."""

import os
import random
from collections import Counter

import pytest

from voxloom.llm import encoding

SF = "/root/testdata/sf0.01"


def test_pairs_are_counted_over_everything(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcdeé你好世界", k=rnd.randrange(1, 60))) for _ in range(200)] + [None, "", "bad \ufffd line\nok"]
    m = encoding.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), "text")
    pairs = Counter()
    for t in texts:
        for line in (t or "").split("\n") if t else ():
            if encoding.is_clean(line):
                pairs.update(map("".join, zip(line, line[1:])))
    for ab, n in pairs.items():
        assert min(c[k] for c, k in zip(m.counters, encoding._slots(*map(ord, ab)))) >= n  # a counter never counts too little
    assert sum(min(c[k] for c, k in zip(m.counters, encoding._slots(*map(ord, ab)))) == n for ab, n in pairs.items()) > 0.99 * len(pairs)
    assert m["zq"] < m["ab"] and "q" not in m.chars and len(m.counters[0]) == 1 << encoding.COUNTERS


def test_margins_rise_with_false_gains():
    assert encoding.raised([], 0) == encoding.BASE and encoding.raised([(True, 300, 2), (False, 900, 1)], 1000) == encoding.BASE
    sure, other = encoding.raised([(True, 300, 3), (True, 100, 50), (False, 900, 5)], 1000)
    assert sure == pytest.approx(3.01) and other == pytest.approx(9.01)


def test_higher_margins_find_less(spark):
    texts = ["naïve café 今天我们去公园看花", "El niño sueña con el pingüino"] * 60
    m = encoding.train(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    rnd = random.Random(2)
    for _ in range(200):
        t = "".join(rnd.choices(["今天", "Ã©", "Ã¯", "浠婂ぉ", " a ", "é", "锟斤拷", "â€œ", "公园"], k=6))
        found = [bool(encoding.repair(t, m, x)[1]) for x in ((0.0, 7.5), (2.0, 8.0), (4.0, 9.0))]
        assert found == sorted(found, reverse=True)


def test_pruned_chains_never_win(spark):
    texts = ["今天我们一起去公园看花", "老师告诉同学明天下雨"] * 60
    m = encoding.train(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    rnd = random.Random(3)
    for _ in range(200):
        s = "".join(rnd.choices("今天我们一起去公园看花老师é浠婂ぉ", k=5))
        own = m.score("", s, "")
        for chain, u in encoding.candidates(s):
            assert m.score("", u, "") - own <= -own and (chain.endswith(":utf-8") == ((chain, u) in set(encoding.candidates(s, sure=True))) or u in dict(map(reversed, encoding.candidates(s, sure=True))))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_restored_texts_equal_their_originals(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("text is not null").collect()]
    rnd = random.Random(4)
    clean = [(k, t) for k, t in rows if not t.isascii() and len(t) < 3000 and all(map(encoding.is_clean, t.split("\n"))) and "�" not in t]
    kinds = [("cp1252", "utf-8"), ("gb18030", "utf-8"), ("mac_roman", "utf-8"), ("cp1251", "utf-8")]
    true, bent = {}, []
    for k, t in rnd.sample(clean, 160):
        read, wrote = rnd.choice(kinds)
        raw = t.encode(wrote)
        table = {b: c for c, b in encoding._bytes_of(read).items()} if read in encoding.SINGLE else None
        try:
            bad = "".join(table[b] if b > 127 else chr(b) for b in raw) if table else raw.decode(read)
        except (UnicodeError, KeyError):
            continue
        if bad != t:
            true[10_000_000 + k] = t
            bent.append((10_000_000 + k, bad))
    got = {r["doc_id"]: r for r in encoding.restored(spark.createDataFrame(rows + bent, "doc_id bigint, text string"), "doc_id", "text").collect()}
    missed = [(b[1][:80], true[b[0]][:60]) for b in bent if not got[b[0]]["found"]]
    assert len(bent) > 80 and len(missed) <= 0.05 * len(bent), missed  # a lone sign such as × that reads as one common character
    assert sum(got[k]["restored"] == t for k, t in true.items()) > 0.9 * len(true)


def test_words_hidden_in_clean_runs(spark):
    texts = ["昨天下午我们在楼梯口把水放到阳台上，得赶紧告诉老师。", "弟が雨の日に古い傘を見つけて石を洗っていた。"] * 60
    m = encoding.train(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    for t, word in ((texts[0], "水放"), (texts[0], "赶紧告诉"), (texts[1], "古い傘を")):
        bad = t.replace(word, word.encode().decode("gb18030"))
        assert encoding.hidden(bad) and encoding.repair(bad, m, encoding.BASE)[0] == t
    assert all(encoding.hidden(t) == [] and encoding.repair(t, m, encoding.BASE)[1] == [] for t in texts[:2])
    assert encoding.hidden("") == [] and encoding.hidden("长" * 50_000) == []
