"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

POOL = "llm_children_100k_asr_complete"
_LETTERS = r"regexp_replace(regexp_replace(lower(coalesce(text, '')), '\[[^\[\]]*\]', '', 'g'), '[^\p{L}\p{N}]', '', 'g')"
_FOLD = "replace(lower(trim({0})), '-', '_')"

_WINDOWS = f"""
WITH t AS (SELECT seq, {_LETTERS} AS s FROM {POOL}),
w AS (SELECT seq, length(s) AS n, CASE WHEN length(s) >= 4 THEN list_transform(range(1, length(s) - 2), lambda i: substr(s, i, 4)) ELSE [] END AS g FROM t),
r AS (SELECT seq, n, CASE WHEN len(g) > 0 THEN 1 - len(list_distinct(g))::DOUBLE / len(g) ELSE 0.0 END AS share,
             CASE WHEN len(g) > 0 THEN len(g) - len(list_distinct(g)) ELSE 0 END AS again, len(g) AS total FROM w)
"""

_P6 = f"""
WITH p AS (SELECT id, min(struct_pack(a := {_FOLD.format('age_tier')}, l := {_FOLD.format('length_type')}, g := {_FOLD.format('lang_type')})) AS f
           FROM {POOL} WHERE id IS NOT NULL GROUP BY id),
s AS (SELECT count(*) // 5 AS size FROM p),
c AS (SELECT f.a AS a, f.l AS l, f.g AS g, count(*) AS n FROM p GROUP BY ALL),
r AS (SELECT t.age_tier, t.length_type, t.lang_type, greatest(t.min_rows, (t.target_per_10000 * s.size + 9999) // 10000) AS need, coalesce(c.n, 0) AS available
      FROM sample_targets t CROSS JOIN s LEFT JOIN c ON c.a = {_FOLD.format('t.age_tier')} AND c.l = {_FOLD.format('t.length_type')} AND c.g = {_FOLD.format('t.lang_type')})
"""

_SCORES = """
WITH s AS (SELECT 'cer' AS metric, replace(lower(trim(dataset)), '-', '_') AS dataset, cer AS value FROM eval
UNION ALL SELECT 'similarity', replace(lower(trim(dataset)), '-', '_'), CASE WHEN score_version = 1 THEN similarity * 2 - 1 ELSE similarity END FROM sim
UNION ALL SELECT 'utmos', replace(lower(trim(dataset)), '-', '_'), utmos FROM mos)
"""


def _latest(table: str, key: str, value: str, name: str) -> str:
    return f"""(SELECT {key} AS wav, max(CASE WHEN isfinite({value}) THEN struct_pack(t := coalesce(epoch_us(arrived_at), -1), v := {value}) END).v AS {name} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1)"""


_CLIPS = f"""
WITH c AS (SELECT wav, a.cer, b.similarity, m.utmos FROM {_latest("eval", "wav", "cer", "cer")} a
FULL JOIN {_latest("sim", "cloned_audio", "(CASE WHEN score_version = 1 THEN similarity * 2 - 1 ELSE similarity END)", "similarity")} b USING (wav)
FULL JOIN {_latest("mos", "cloned_audio", "utmos", "utmos")} m USING (wav))
"""


def _rank(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (ORDER BY {c} NULLS LAST) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 END AS r_{c}"


# Looks, written down apart from the operator's tables: each character and, at the same place below it, what it looks like.
_ALIKE = "АВЕЅІЈКМНОРСТУХҮԌԚԜѴӀабеѕіјоpрсухһԁԛԝѵҽүӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧανοιρυσγϲϳβՕՍՏԼօսոհցզյգᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏚᏙᏢᏞᏟᏦᏴɡɑ"
_ALIKE_AS = "ABESIJKMHOPCTYXYGQWVlabesijoppcyxhdqwveylABEZHIKMNOPTYXavoipuoycjßOUSLounhgqjqDRTiAJEWMHGZRWSVPLCKBga"
_SIGNS = "ロニハカタエトミチオセーノメヘベペ"
_SIGNS_AS = "口二八力夕工卜彡千才七一丿〆へべぺ"
_PARTS = "⺠⺟⻁⻄⻅⻆⻉⻋⻑⻓⻔⻘⻙⻚⻛⻜⻝⻢⻣⻤⻥⻦⻧⻨⻩⻬⻭⻮⻯⻰⺁⺇⺌⺎⺒⺓⺙⺝⺞⺪⺬⺮⺯⺰⺱⺲⺳⺶⺷⺸⺹⺺⺻⺼⻀⻂⻃⻇⻈⻊⻌⻍⻎⻏⻐⻒⻖⻗⻞⻟⻠⻡⻪⻫"
_PARTS_AS = "民母虎西见角贝车镸长门青韦页风飞食马骨鬼鱼鸟卤麦黄齐歯齿竜龙厂几小兀巳幺攵月歺疋示竹糸纟罓罒罓羊羊羊耂肀聿月艹衤覀𧢲讠足辶辶辶阝钅镸阝雨飠飠饣𩠐黾斉"


def _looks() -> tuple[str, str]:
    """Characters and what they look like, one to one: the tables above, width forms, styled letters and radicals by their decompositions, spaces, and letters with one accent."""
    import unicodedata as ud

    pairs = dict(zip(_SIGNS + _PARTS, _SIGNS_AS + _PARTS_AS))
    for o in (*range(0x2E80, 0x2FE0), *range(0xFF01, 0xFFE7), *range(0x1D400, 0x1D800), 0x3000):
        kind, _, rest = ud.decomposition(chr(o)).partition(" ")
        if kind in ("<wide>", "<narrow>", "<font>", "<compat>") and len(rest.split()) == 1:
            one = chr(int(rest, 16))
            pairs[chr(o)] = pairs.get(one, one)
    pairs |= {chr(o): " " for o in range(0x21, 0x3001) if ud.category(chr(o)) == "Zs"}
    for c, b in zip(_ALIKE, _ALIKE_AS):
        pairs[c] = b
        for m in range(0x300, 0x345):
            x, y = ud.normalize("NFC", c + chr(m)), ud.normalize("NFC", b + chr(m))
            if len(x) == len(y) == 1:
                pairs[x] = y
    pairs = {a: pairs.get(b, b) for a, b in pairs.items() if a != b}
    return "".join(pairs).replace("'", "''"), "".join(pairs.values()).replace("'", "''")


def _look(c: str) -> str:
    a, b = _looks()
    bare = rf"regexp_replace({c}, '\p{{Cf}}|[\x{{fe00}}-\x{{fe0f}}\x{{34f}}\x{{115f}}\x{{1160}}\x{{3164}}\x{{ffa0}}\x{{180b}}-\x{{180f}}]', '', 'g')"
    return f"nfc_normalize(translate(nfc_normalize({bare}), '{a}', '{b}'))"


_LOADINGS = (
    _CLIPS.replace("WITH c AS", "WITH RECURSIVE c AS", 1)
    + f""", q AS (SELECT {_rank('cer')}, {_rank('similarity')}, {_rank('utmos')} FROM c),
m AS (SELECT -corr(r_cer, r_similarity) AS ab, -corr(r_cer, r_utmos) AS ac, corr(r_similarity, r_utmos) AS bc FROM q),
p(k, a, b, c) AS (SELECT 0, 0.5::DOUBLE, 0.6::DOUBLE, 0.7::DOUBLE UNION ALL SELECT k + 1, x / sqrt(x * x + y * y + z * z), y / sqrt(x * x + y * y + z * z), z / sqrt(x * x + y * y + z * z)
FROM (SELECT k, a + ab * b + ac * c AS x, ab * a + b + bc * c AS y, ac * a + bc * b + c AS z FROM p, m) WHERE k < 500)
SELECT score, round(abs(CASE score WHEN 'cer' THEN a WHEN 'similarity' THEN b ELSE c END), 5) AS loading FROM p, (SELECT unnest(['cer', 'similarity', 'utmos']) AS score) WHERE k = 500"""
)

ORACLES = {
    "p1_loadings": _LOADINGS,
    "p1_ranks": _CLIPS + f"SELECT wav, {_rank('cer')}, {_rank('similarity')}, {_rank('utmos')} FROM c",
    "p4_found": f"SELECT DISTINCT wav FROM eval WHERE wav IS NOT NULL AND gen_text <> asr_hypo AND {_look('gen_text')} = {_look('asr_hypo')}",
    "p5_held": _SCORES + """, n AS (SELECT metric, coalesce(dataset, '') AS dataset, count(*) AS n FROM s WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL)
SELECT metric, dataset, q, n, true AS held FROM n, (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS q)""",
    "p2_found": _WINDOWS + "SELECT seq FROM r WHERE n >= 12 AND again >= 0.4 * total",
    "p2_shares": _WINDOWS + "SELECT seq, n AS n_letters, round(share, 6) AS repeated_share FROM r",
    "p6_found": _P6 + "SELECT age_tier, length_type, lang_type FROM r WHERE available < need",
    "p7_found": rf"""
WITH t AS (SELECT id, min_by(text, seq) AS text FROM {POOL} WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id),
u AS (SELECT id, {_LETTERS} AS s FROM t WHERE len(regexp_extract_all(regexp_replace(text, '\[[^\[\]]*\]', '', 'g'),
      '[\x{{3041}}-\x{{3096}}\x{{309d}}-\x{{309f}}\x{{30a1}}-\x{{30fa}}\x{{30fc}}-\x{{30ff}}\x{{31f0}}-\x{{31ff}}\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}\x{{ac00}}-\x{{d7a3}}\x{{f900}}-\x{{faff}}\x{{ff66}}-\x{{ff9f}}\x{{20000}}-\x{{3ffff}}]|\p{{Nd}}+|[a-zA-Z\x{{aa}}-\x{{2c1}}\x{{370}}-\x{{1fff}}]+')) >= 30),
g AS (SELECT id, unnest(list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3)))) AS g FROM u WHERE length(s) >= 3),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
o AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
SELECT id_a, id_b FROM o JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE 2 * o >= x.n + y.n - o
""",
}
