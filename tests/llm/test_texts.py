"""Repetition, languages, look-alikes, encoding of tokens and of characters on small inputs."""

import random
import unicodedata as ud

import pytest

from voxloom.llm import encoding, language, lookalike, repetition, tokens
from voxloom.llm.common import letters, units

# ---- units


def test_units_and_letters():
    assert units("你好 world, it is 2024 [sigh] 한국 かな") == 2 + 3 + 1 + 2 + 2
    assert letters("[sigh]Ａb-1 ！é") == "ａb1é" and letters(None) == "" and units(None) == 0


# ---- problem 2


def _share(t):
    s = letters(t)
    w = [s[i : i + 4] for i in range(len(s) - 3)]
    return (1 - len(set(w)) / len(w)) if w else 0.0


def test_no_repetitive_document_escapes():
    rnd = random.Random(1)
    for _ in range(400):
        parts = ["".join(rnd.choices("abcdefgh 。,!？\n", k=rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 4))]
        t = "".join(rnd.choices(parts, k=rnd.randrange(1, 12)))
        n, total, again, *_, bad, kept = repetition.judge(t)
        assert total == max(0, n - 3) and (again / total if total else 0) == pytest.approx(_share(t))
        assert bad or _share(t) < 0.4


def test_line_rules():
    *_, lines, failed, lost, bad, kept = repetition.judge("Home | About | Contact |\n-----\nA real sentence stands here.\nAll rights reserved\nwww.example.org\n第 3 页 共 9 页")
    assert lines == 6 and kept.strip() == "A real sentence stands here." and failed == {"repeated": 0, "marks": 1, "navigation": 3, "boilerplate": 1} and bad


def test_cases_depend_on_the_cleaning(spark, monkeypatch):
    loop = "a b c d e f g. " * 9
    assert repetition.judge(loop)[6]
    monkeypatch.setitem(repetition.RULES, "repeated", lambda line, bare, limit: False)
    n, total, again, *_, rejected, _ = repetition.judge(loop)
    assert again / total > 0.8 and not rejected  # with the rule broken no share rescues the case


def test_clean_lines_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "哈哈" * 5000, "x"), (3, "一句普通的话。", "x"), (4, "ab", "x")], "seq bigint, text string, rejected string")
    got = repetition.clean_lines(df, "seq", "text").collect()
    assert len(got) == 5 and [r["rejected"] for r in got if r["seq"] in (1, 2, 4)] == [False] * 3
    assert [r["seq"] for r in repetition.repetitive(df, "seq", "text").collect()] == [3]
    assert repetition.clean_lines(df.limit(0), "seq", "text").count() == 0


# ---- problem 3

TRAIN = {
    "en": "the cat sat on the table and the dog was in the garden with my sister while it rained ",
    "fr": "le chat est sur la table et le chien dans le jardin avec ma soeur pendant qu'il pleuvait ",
    "de": "die katze sitzt auf dem tisch und der hund war im garten mit meiner schwester als es regnete ",
    "es": "el gato está en la mesa y el perro estaba en el jardín con mi hermana cuando llovía ",
    "zh": "我们今天去公园放风筝然后和朋友一起吃饭", "ja": "私は今日公園で凧をあげました妹と魚を描いた", "ko": "오늘공원에서연을날렸어요",
}


def test_automaton_counts_longest_matches():
    a = language.Automaton("abcabd")
    parse = lambda s: a.phrases([ord(c) for c in s])
    assert parse("abc") == 1 and parse("abdabc") == 2 and parse("") == 0 and parse("z") == language.UNSEEN and parse("abzab") == 2 + language.UNSEEN
    rnd = random.Random(2)
    text = "".join(rnd.choices("abc", k=60))
    m = language.Automaton(text)
    for _ in range(50):
        s = "".join(rnd.choices("abc", k=20))
        n = at = 0
        while at < len(s):
            k = max(j for j in range(at, len(s) + 1) if s[at:j] in text)
            at, n = max(k, at + 1), n + 1
        assert m.phrases([ord(c) for c in s]) == n


def test_stretches_and_main():
    p = language.Parser(TRAIN)
    assert p.main("the dog was on the table.")[0] == "en" and p.main("der hund sitzt im garten.")[0] == "de"
    assert p.main("妹は今日、公園で凧を描いた。")[0] == "ja" and p.main("我们一起去公园。")[0] == "zh" and p.main("공원에서 연을")[0] == "ko"
    assert [s[1] for s in p.stretches("我们去公园，the cat sat on the table。오늘 연을")] == ["zh", "en", "ko"]
    assert p.main("我们去公园 the cat")[0] == "zh" and p.main("我们 the cat sat on the table")[0] == "en"
    assert p.main(None) == (None, 0.0, 0) and p.main("[sigh]！？") == (None, 0.0, 0) and p.main("Жили были")[0] is None


def test_labels(spark):
    rows = [("ZH ", "zh"), ("zh_Hans", "zh"), ("en-US", "en"), ("English", "en"), ("deu", "de"), ("unknown", None), ("", None), (None, None), ("n/a", None), ("Italian", "italian"), ("pt-BR", "pt")]
    df = spark.createDataFrame([(r[0],) for r in rows], "language string")
    assert [r[0] for r in df.select(language.label("language")).collect()] == [r[1] for r in rows]


def test_wrong_labels(spark):
    rows = [(1, "the cat sat on the table", "en"), (2, "the dog was in the garden", "fr"), (3, "我们去公园", None), (4, "", "und"), (5, None, None), (2, "the dog was in the garden", "fr"), (6, "le chat est dans le jardin avec ma soeur", "English")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "seq bigint, text string, language string, main string")
    got = sorted(map(tuple, language.wrong_labels(df, "seq", "text", "language", TRAIN).collect()))
    assert got == [(2, "en"), (2, "en"), (3, "zh"), (6, "fr")]
    assert language.segments(df, "seq", "text", "language", TRAIN).where("seq in (4, 5)").count() == 0
    assert language.languages(df.limit(0), "seq", "text", "language").count() == 0


def test_training_checks_its_labels(spark):
    rnd = random.Random(5)
    words = {k: TRAIN[k].split() for k in ("en", "fr", "de", "es")}
    rows = [(" ".join(rnd.choices(words[k], k=8)) + ".", k if rnd.random() > 0.1 else rnd.choice(["en", "fr", "de", "es"])) for k in words for _ in range(80)]
    learned = language.learn(spark.createDataFrame(rows, "t string, l string"), "t", "l")
    p = language.Parser(learned)
    fresh = [(" ".join(rnd.choices(words[k], k=8)), k) for k in words for _ in range(50)]
    assert sum(p.main(t)[0] == k for t, k in fresh) / len(fresh) > 0.97


# ---- problem 4

PAIRS = [("ｈｅｌｌｏ，ｗｏｒｌｄ", "hello,world"), ("caf\u00e9", "cafe\u0301"), ("ze​ro\xadpad", "zeropad"), ("a b　c", "a b c"), ("scоре", "scope"), ("ЅСОРЕ", "SCOPE"), ("人口八千", "人ロハ千"), ("⼩⾥", "小里"), ("了不", "了不"), ("ｱｶﾞ", "アガ"), ("한국", ud.normalize("NFD", "한국")), ("οne", "one"), ("。", "｡")]
APART = [("Hello", "hello"), ("cafe", "café"), ("国", "國"), ("m2", "m²"), ("1/2", "½"), ("wait...", "wait…"), ("a b", "ab"), ("да", "na"), ("コンロ", "コン口x"), ("a.", "a。"), ("", " ")]


@pytest.mark.parametrize("a, b", PAIRS)
def test_same_look(a, b):
    assert lookalike.unify(a) == lookalike.unify(b)


@pytest.mark.parametrize("a, b", APART)
def test_other_look(a, b):
    assert lookalike.unify(a) != lookalike.unify(b)


def test_script_resolution():
    assert lookalike.resolve("ѕcope") == ("scope", "mixed") and lookalike.resolve("соре") == ("cope", "whole")
    assert lookalike.resolve("дa") == ("да", "mixed") and lookalike.resolve("была")[1] == "single"
    assert lookalike.unify("Жили были") == "Жили были" and lookalike.unify("ロボット") == "ロボット" and lookalike.unify("カタカナ") == "カタカナ"
    for t in [p for x in PAIRS + APART for p in x]:
        assert lookalike.unify(lookalike.unify(t)) == lookalike.unify(t)


def test_lookalikes(spark):
    rows = [("w1", "scope", "scоpe"), ("w1", "scope", "scоpe"), ("w2", "a", None), ("w3", None, "b"), ("w4", "same", "same"), ("w5", "plain", "plane"), (None, "scope", "scоpe"), ("w6", "\u00e9" * 30000, "e\u0301" * 30000), ("w7", "", "​")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "wav string, g string, a string, text string")
    assert sorted(r[0] for r in lookalike.lookalikes(df, "wav", "g", "a").collect()) == ["w1", "w6", "w7"]
    assert lookalike.unified(df, "wav", "g", "a").count() == 9 and lookalike.lookalikes(df.limit(0), "wav", "g", "a").count() == 0


# ---- problem 8


def test_tokens_equal_the_public_library(spark):
    public = pytest.importorskip("public_tokenizers")
    lib = pytest.importorskip("tokenizers")
    ref = lib.Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    ref.encode_special_tokens = True
    rnd = random.Random(8)
    texts = ["", "<|endoftext|> and <|x|>", "a" * 3000, "中文没有空格" * 300, " \n\t  x　 y", "it's we'll I'M", "é🏫👩‍🏫", "١٢٣ 12345678901234567890"]
    texts += ["".join(rnd.choices("ab 1.,'\n中é😀<|>\t", k=rnd.randrange(80))) for _ in range(300)]
    e = tokens.encoder()
    want = [x.ids for x in ref.encode_batch(texts, add_special_tokens=False)]
    assert [e.encode(t) for t in texts] == want
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(-1, None, ""), (0, "", "")], "doc_id bigint, text string, ids string")
    got = {}
    for r in tokens.encode(df, "doc_id", "text").collect():
        got.setdefault(r["doc_id"], []).append(r["ids"])
    assert got[-1] == [[]] and got[0] == [[], []] and all(got[i] == [w] for i, w in enumerate(want) if i)
    assert {r["doc_id"]: r["tokens"] for r in tokens.count_tokens(df, "doc_id", "text").collect()}[2] == len(want[2])
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


def test_short_and_long_merges_agree():
    e = tokens.encoder()
    rnd = random.Random(9)
    for _ in range(300):
        w = bytes(rnd.choices(b"theinganrea \xe4\xb8\xad\xe6", k=rnd.randrange(1, 90)))
        assert tokens._merge_short(w, e.ranks) == tokens._merge_long(w, e.ranks)


# ---- problem 10

CLEAN = ["The café was full of naïve visitors — “really,” said José.", "El niño sueña con el pingüino en la habitación.", "今天我们一起去公园看花，妈妈说很好玩。", "老师告诉同学明天下雨，不要忘记带雨伞！", "Größe über alles, fand Jörg am Fluss.", "弟が雨の日に古い傘を見つけました。", "Le garçon a mangé une crème brûlée à côté de l’école."]


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame([(t,) for t in CLEAN * 40], "text string")
    return encoding.train(df, "text"), encoding.BASE


@pytest.mark.parametrize("read, wrote", [("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("cp1251", "utf-8"), ("cp437", "utf-8"), ("gb18030", "utf-8"), ("cp1252", "gb18030"), ("big5", "gb18030")])
def test_round_trip(model, read, wrote):
    m, margins = model
    table = {b: c for c, b in encoding._bytes_of(read).items()} if read in encoding.SINGLE else None
    done = 0
    for t in CLEAN:
        try:
            raw = t.encode(wrote)
            bad = "".join(table[b] if b > 127 else chr(b) for b in raw) if table else raw.decode(read)
        except UnicodeError:
            continue
        if bad == t or wrote == "gb18030" and not any("一" <= c <= "鿿" for c in t) or any("ぁ" <= c <= "ん" for c in t) and wrote != "utf-8":
            continue
        u, found, _ = encoding.repair(bad, m, margins)
        assert found, (t, bad)
        done += u == t
    assert done >= 1


def test_clean_texts_stay(model):
    m, margins = model
    for t in CLEAN + ["½ + ¼ = ¾", "SÃO JOÃO, ÂNCORA.", "Жили-были кот и лиса.", "It cost €38 at 17 °C.", "Smörgås på bordet."]:
        assert encoding.repair(t, m, margins)[:2] == (t, [])


def test_restored(spark):
    bad = CLEAN[0].encode().decode("cp1252", "replace")
    rows = [(i, t) for i, t in enumerate(CLEAN * 5)] + [(100, None), (101, ""), (102, "plain"), (103, "naÃ¯ve cafÃ©"), (103, "naÃ¯ve cafÃ©"), (104, "lost � here"), (105, bad)]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id bigint, text string, found boolean")
    got = {r["doc_id"]: r for r in encoding.restored(df, "doc_id", "text").collect()}
    assert {k for k, r in got.items() if r["found"]} == {103, 104, 105} and got[103]["restored"] == "naïve café" and got[104]["lost"]
    assert encoding.restored(df, "doc_id", "text").count() == len(rows) and encoding.restored(df.limit(0), "doc_id", "text").count() == 0
