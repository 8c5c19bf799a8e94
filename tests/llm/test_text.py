import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lookalikes, markup, mojibake, repetition, splitting

MD = "doc_id bigint, market string, md string, n_chars string, piece string"


def frame(spark, *mds, market="m"):
    return spark.createDataFrame([(i, market, m, "x", "y") for i, m in enumerate(mds)], MD)


# Repetition


def share(spark, *mds):
    return {r["doc_id"]: r["repeat_share"] for r in repetition.measured(frame(spark, *mds)).collect()}


def test_repeats_count_and_changes_do_not(spark):
    line = "The board proposes a dividend of 3 per share"
    other = "\n".join(f"The board proposes a dividend of {i} per share" for i in range(20))
    got = share(spark, f"{line}\n" * 4, other, f"1. {line}\n- {line.upper()}\n(3)  {line.replace(' ', '  ')}\n> {line}", "", "   \n", None, "wordy phrase here " * 30, "ab\nab\nab\nab\nab\nab\n")
    assert got[0] == pytest.approx(0.75) and got[1] == 0.0 and got[2] == pytest.approx(0.75)
    assert got[3] == 0.0 and got[4] == 0.0 and got[5] is None and got[6] > 0.8 and got[7] == 0.0


def test_short_lines_of_a_repeated_paragraph_count(spark):
    para = "\n".join(f"| item{i} | {i} |" for i in range(8))
    assert share(spark, f"{para}\n\n{para}\n\n{para}")[0] > 0.5


def brute_runs(t):
    """Characters after the first time of a phrase with a letter, run on often enough: every period from every character."""
    hit = set()
    for p in range(1, len(t) // 3 + 1):
        a = 0
        while a + p < len(t):
            b = a + p
            while b < len(t) and t[b] == t[b - p]:
                b += 1
            n = (b - a) // p
            if n >= next(x for least, x in repetition.MANY if p >= least) and any(c.isalpha() for c in t[a : a + p]):
                hit |= set(range(a + p, a + n * p))
            a = max(a + 1, b - p)
    return len(hit)


def test_runs_are_those_of_every_period_from_every_character():
    r = random.Random(3)
    texts = []
    for _ in range(150):
        parts = ["".join(r.choice("ab-字😀") for _ in range(r.choice([1, 3, 8, 20, 70, 130]))) * r.choice([1, 1, 2, 3, 4, 7, 15]) for _ in range(r.randint(0, 5))]
        texts.append("".join(parts))
    assert [m[1] for m in repetition._marks(texts)] == [brute_runs(t) for t in texts]


def test_runs_of_short_units_and_of_long_phrases_count(spark):
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = repetition.measured(frame(spark, "\n".join(word(7) * 13 for _ in range(60)), word(130) * 20, word(2500) * 4, word(3000))).collect()
    got = {x["doc_id"]: x["run_share"] for x in rows}
    assert got[0] == pytest.approx(12 / 13, abs=1e-6) and got[1] == pytest.approx(0.95) and got[2] == pytest.approx(0.75) and got[3] == 0.0


def test_short_units_run_on_and_paragraphs_and_lines_of_short_units_count(spark):
    para = "東京本社\n大阪支店\n京都工場\n札幌営業"
    apart = "\n\n".join(f"{para}\n\n{''.join(chr(0x4E00 + 40 * i + j) for j in range(13))}" for i in range(40))
    line = "はい。いいえ。そうです。違う。"
    lines = "\n".join(f"{line}\n{''.join(chr(0x4E00 + 40 * i + j) for j in range(13))}" for i in range(40))
    wrapped = "repeated phrase " * 60
    wrapped = "\n".join(wrapped[i : i + 37] for i in range(0, len(wrapped), 37))
    got = share(spark, "はい。" * 2000, "OK\n" * 2000, apart, lines, wrapped, "東京本社\n\n大阪支店\n\n東京本社\n\n大阪支店", "One sentence stands alone.", "One line stands alone\n")
    assert got[6] == 0.0 and got[7] == 0.0
    assert got[0] == pytest.approx(1999 / 2000, abs=1e-6) and got[1] == pytest.approx(1999 / 2000, abs=1e-6)
    assert got[2] == pytest.approx(39 * 16 / (40 * 29), abs=1e-6) and got[3] == pytest.approx(39 * 15 / (40 * 28), abs=1e-6)
    assert got[4] == pytest.approx(59 / 60, abs=1e-6) and got[5] == 0.0


def test_found_counts_a_row_once_and_reads_long_texts(spark):
    long = "".join(f"sentence number {i} says nothing new. " for i in range(20000))
    d = frame(spark, "same words again and again\n" * 9, long, None, "")
    assert [r[0] for r in repetition.found(d.unionByName(d)).collect()] == [0]
    assert repetition.found(d.limit(0)).count() == 0
    assert repetition.judged(d).where("doc_id = 0").first()["violated"][0] == "repeated"


# Splitting


def limits(spark, max_size, unit, overlap):
    return spark.createDataFrame([("m", max_size, unit, overlap)], "market string, max_size int, size_unit string, overlap_size int")


@pytest.mark.parametrize(("max_size", "unit", "overlap"), [(60, "chars", 7), (90, "bytes", 10), (40, "bytes", 0), (30, "chars", 29), (5, "bytes", 2), (1, "chars", 0)])
def test_pieces_join_to_the_text(spark, max_size, unit, overlap):
    r = random.Random(4)
    texts = ["".join(r.choice(["本日。", "é", "word ", "\n\n", "| a | b |\n", "😀", "\r\n", "## H\n", "x" * 30, "?! "]) for _ in range(r.randint(0, 60))) for _ in range(25)]
    size = (lambda s: len(s.encode())) if unit == "bytes" else len
    got = {}
    for x in splitting.pieces(frame(spark, *texts), limits(spark, max_size, unit, overlap)).collect():
        got.setdefault(x["doc_id"], []).append(x)
    for i, t in enumerate(texts):
        ps = sorted(got[i], key=lambda x: x["piece_no"])
        assert "".join(p["piece"][p["overlap"] :] for p in ps) == t
        assert all(size(p["piece"]) <= max(max_size, 4 if unit == "bytes" else 1) and p["size"] == size(p["piece"]) for p in ps)
        assert (len(ps) > 1) == (size(t) > max_size) or size(t) <= 4
        for a, b in zip(ps, ps[1:], strict=False):
            assert a["piece"].endswith(b["piece"][: b["overlap"]])


def test_cuts_at_the_strongest_boundary(spark):
    t = "A sentence ends here. " * 2 + "\n\n# Next\n" + "More words follow it. " * 2
    ps = [p["piece"] for p in splitting.pieces(frame(spark, t), limits(spark, 60, "chars", 0)).orderBy("piece_no").collect()]
    assert ps[1].startswith("# Next")
    exact = splitting.oversized(frame(spark, "a" * 60, "a" * 61, None, ""), limits(spark, 60, "chars", 0)).collect()
    assert [r[0] for r in exact] == [1]
    unknown = splitting.pieces(frame(spark, "a" * 99, market="?"), limits(spark, 60, "chars", 0)).collect()
    assert [p["piece"] for p in unknown] == ["a" * 99]
    assert splitting.pieces(frame(spark, "a").limit(0), limits(spark, 60, "chars", 0)).count() == 0


# Markup

PLAIN = ["C:\\new\\par and D:\\a_b\\text", "[1](注2)", "def __init__ of x", "< note > text", "R&D: a", "*8 text", "[39] text", "#43: text", "5 < 36; x", "A = B + C (50).", "US$653 and US$70", "name *", "9~10% rise", "rate = 4 / 8\nif rate < 1: keep(rate)", "a_b c_d", "AT&T & co", "-5 * 3 * 2", "", "price ` mark"]
MARKED = ["a <b>b</b>", "x</td>", "<br/>", "<!-- c -->", "a&amp;b", "&#12354;", "**bold**", "`code`", "```\nx\n```", "### head", "[t](https://a.example/b)", "| a |\n| --- |", "'''b'''", "== h ==", "[[a|b]]", "{{n|x}}", "{| class=\"w\"\n|}", "\\textbf{x}", "$\\frac{1}{2}$", "\\(x_{3}\\)", "5\\% x", "\\begin{tabular}", '<ix:nonNumeric name="a">', "<TE>"]


@pytest.mark.parametrize("text", PLAIN)
def test_ordinary_signs_are_no_markup(text):
    assert markup.constructs(text) == [] and markup.clean_text(text) == text


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_seen(text):
    assert markup.constructs(text) and re.search(markup.SIGNS, text)


def test_structure_stays():
    page = "<h2>T</h2><ul><li>a</li><li>b</li></ul><table><tr><th>x</th><td>1</td></tr></table><pre><code>k &lt; 1</code></pre><script>var t='</p>'</script><math><mi>a</mi></math><p>open"
    assert markup.written([(k, t) for _, k, t in markup.leaves(page)]) == "## T\n- a\n- b\n| x | 1 |\n```\nk < 1\n```\n$a$\nopen"
    assert markup.clean_text("\\section{S}\n'''b''' [[x|y]] 5\\% &lt;") == "# S\nb y 5% <"
    assert markup.clean_text(None) is None


def brute_tree(pages):
    """path -> (pages, importance, dull) by recursion over merged trees held whole."""
    nodes, on = {}, {}
    for at, page in enumerate(pages):
        w, seen = markup.walked(page), set()
        items = [(p, tuple(ls), tuple(ts)) for p, ls, ts in w.nodes] + [(p, x.strip(), ()) for p, _, x in w.leaves if x.strip()]
        for path, style, kids in items:
            n = nodes.setdefault(path, [0, {}])
            n[0] += path not in seen
            seen.add(path)
            n[1].setdefault(style, [0, kids])[0] += 1
            on.setdefault((path, style), set()).add(at)
    out = {}

    def judge(path):
        m, styles = nodes[path]
        total = sum(c for c, _ in styles.values())
        imp = 1.0 if m < 2 else min(1.0, -sum(c / total * math.log(c / total) for c, _ in styles.values()) / math.log(m))
        if m > 1 and path.endswith("#text"):
            imp = 1 - sum(math.log(len(on[path, s])) for s in styles) / len(styles) / math.log(m)
        kids = {k for _, ks in styles.values() for k in ks}
        below = {k: judge(f"{path}{markup.SEP}{k}") for k in kids}
        if not path.endswith("#text"):
            keep = markup.GAMMA ** len(styles)
            imp = (1 - keep) * imp + keep * sum(c / total * (sum(below[k][1] for k in ks) / len(ks) if ks else 0.0) for c, ks in styles.values())
        out[path] = (m, imp, m >= markup.MIN_PAGES and imp < markup.LEAST_IMPORTANCE and all(b[2] for b in below.values()))
        return out[path]

    judge("#")
    return out


def test_the_merged_tree_is_that_of_brute_force(spark):
    r = random.Random(6)

    def element(depth):
        tag = r.choice(["div", "p", "ul", "span"])
        inner = "".join(element(depth + 1) for _ in range(r.randint(0, 3))) if depth < 4 else ""
        return f"<{tag}{r.choice(['', ' class=a', ' class=b'])}>{r.choice(['', 'Same', 'Nav', str(r.random())])}{inner}</{tag}>"

    hosts = {h: ["<section><ol><dt>Home</dt><dt>Help</dt></ol></section>" + "".join(element(0) for _ in range(r.randint(0, 3))) for _ in range(40)] for h in ("a", "b")}
    d = spark.createDataFrame([(i + 100 * (h == "b"), h, p) for h, ps in hosts.items() for i, p in enumerate(ps)], "id bigint, host string, html string")
    got = {(x["host"], x["path"]): (x["pages"], x["importance"], x["dull"]) for x in markup.style_tree(d.repartition(5).mapInPandas(markup._trees, markup.TREE)).collect()}
    want = {(h, p): v for h, ps in hosts.items() for p, v in brute_tree(ps).items()}
    assert set(got) == set(want) and all(got[k] == (want[k][0], pytest.approx(want[k][1]), want[k][2]) for k in want)
    assert got["a", markup.SEP.join(["#", "section", "ol", "dt", "#text"])] == (40, 0.0, True) and got["a", markup.SEP.join(["#", "section"])][2] and not got["a", "#"][2]


def test_boilerplate_of_a_host_goes(spark):
    rows = [(i, "h", f"<div class='nav'><ul><li>Home</li><li>Help</li></ul></div><p>text {i}</p>") for i in range(30)] + [(99, "other", "<div>Home</div>"), (98, None, None), (97, "h", "")]
    rows += [(200, "one", "<table><tr>" + "<td>Nil</td>" * 12 + "</tr></table>")] + [(300 + i, "same", "<p>Same</p>") for i in range(20)]
    d = spark.createDataFrame(rows, "fact_id bigint, edinet_code string, html string").withColumn("text", F.lit("<b>x</b>"))
    got = {r[0]: r[1] for r in markup.clean_pages(d.unionByName(d)).collect()}
    assert got[3] == "text 3" and got[99] == "Home" and got[200].count("Nil") == 12
    tables = [(i, "h", f"<p>{i}</p><table><tr><th>Item</th><td>{i}</td></tr></table><math><mi>a</mi><mo>=</mo><mn>{i}</mn></math>", "") for i in range(20)]
    whole = markup.clean_pages(spark.createDataFrame(tables, "fact_id bigint, edinet_code string, html string, text string"))
    assert whole.where("fact_id = 7").first()["clean"] == "7\n| Item | 7 |\n$a = 7$"
    assert {got[300 + i] for i in range(20)} == {""} and len(got) == len(rows)
    assert markup.with_markup(d).count() == len(rows) and markup.with_markup(d.limit(0)).count() == 0
    assert markup.clean_pages(d.limit(0)).count() == 0


def test_pages_without_a_leaf_keep_their_row(spark):
    rows = [(i, "h", f"<div class='nav'>Home</div><p>text {i}</p>") for i in range(30)] + [(90, "h", "<div class='nav'>Home</div>"), (91, "h", ""), (92, "h", "<!-- c -->"), (93, "h", "<script>x</script>"), (94, "h", None), (95, None, None), (96, None, "<p>a</p>"), (None, "h", "<p>a</p>")]
    d = spark.createDataFrame(rows, "fact_id bigint, edinet_code string, html string")
    got = [tuple(r) for r in markup.clean_pages(d.unionByName(d)).collect()]
    assert len(got) == 37 and {k: v for k, v in got if k >= 90} == {90: "", 91: "", 92: "", 93: "", 94: None, 95: None, 96: "a"}


# Look-alikes


@pytest.mark.parametrize(("a", "b"), [("ＡＢＣ１２", "ABC12"), ("ﾎﾟﾝﾌﾟ", "ポンプ"), ("e\u0301te\u0301", "été"), ("a\u200bb\u00ad", "ab"), ("x\u2007y\u3000z", "x y z"), ("A‐1", "A-1"), ("ﬂow", "flow"), ("⽔⾒", "水見"), ("Ѕсоре", "Scope"), ("Сосоа", "Cocoa"), ("ΑВС", "ABC"), ("С\u0327a", "Ça"), ("\u1112\u1161\u11ab", "한"), ("豈", "豈"), ("カ", "力"), ("⼯場", "エ場"), ("⼒メラ", "ｶメラ"), ("力", "力"), ("Ꭺᴬ", "Aᴬ"), ("ⲞꓚR", "OCR"), ("νаг", "vаг"), ("a\r\nb", "a\nb")])
def test_same_looks_are_one_form(a, b):
    assert lookalikes.consistent(a) == lookalikes.consistent(b)


@pytest.mark.parametrize(("a", "b"), [("A1", "A2"), ("a", "A"), ("x²", "x2"), ("①", "1"), ("㈱", "(株)"), ("a.", "a"), ("a*", "a"), ("é", "e"), ("½", "1/2"), ("か", "が")])
def test_different_looks_stay_apart(a, b):
    assert lookalikes.consistent(a) != lookalikes.consistent(b)


def test_scripts():
    assert lookalikes.consistent("Пoлe") == "Поле"  # Latin o and e in a Cyrillic word
    assert lookalikes.consistent("Россия") == "Россия"
    assert lookalikes.consistent("ЅсоЗ") != lookalikes.consistent("Ѕсо3")
    assert lookalikes.consistent(None) is None and lookalikes.consistent("") == ""


ORDINARY = "能力 口座 工業 人口 夕方|東京へ行く。アメリカへ行く|カメラとヘリコプターとベンチ|東京エレクトロン、人口ピラミッド、プロ野球|クレジット口座|3カ所、二カ月、数カ国|アニメの第二四半期、ニッケル二次電池|プラスチック工業のデータ処理|Россия сор и все остальные|Ελλάδα και ΑΒΓ|Scope et été|한국 전력|八王子のハイテク工場".split("|")


@pytest.mark.parametrize("text", ORDINARY)
def test_ordinary_text_of_a_consistent_script_stays(text):
    assert lookalikes.consistent(text) == text


def test_forms_depend_on_shapes_only():
    r = random.Random(9)
    kin = [*lookalikes.KANA.items(), ("а", "a"), ("о", "o"), ("Ο", "O"), ("с", "c")]
    for _ in range(3000):
        a, b = [], []
        for _ in range(r.randint(1, 9)):
            x, y = r.choice(kin)
            c = r.choice("業月ラーのが3 я第b力")
            p = r.random()
            a.append(c if p < 0.5 else r.choice((x, y)))
            b.append(c if p < 0.5 else r.choice((x, y)))
        fa, fb = lookalikes.consistent("".join(a)), lookalikes.consistent("".join(b))
        assert fa == fb and lookalikes.consistent(fa) == fa
    assert all(lookalikes.REPLACED.search(v) is None for v in lookalikes.FORMS.values() if v)


def test_links_count_pairs(spark):
    d = spark.createDataFrame([(1, "d", "AB"), (2, "d", "ＡＢ"), (3, "d", "AB"), (4, "d", "А\u200bB"), (5, "e", "AB"), (2, "d", "ＡＢ")], "fact_id bigint, doc_id string, text string")
    m = lookalikes.classes(lookalikes.forms(d, "fact_id", ["doc_id"], "text", "text"))
    assert {(r["id"], r["links"]) for r in lookalikes.links(m).collect()} == {(1, 2), (2, 3), (3, 2), (4, 3)} and lookalikes.pairs(m).count() == 5


def test_pairs_of_forms(spark):
    rows = [(1, "d", "c", "AB", 0), (2, "d", "c", "ＡＢ", 0), (3, "d", "c", "AB", 0), (4, "d", "c", "А\u200bB", 0), (5, "e", "c", "ＡＢ", 0), (6, None, "c", "AB", 0), (7, "d", "c", None, 0), (8, "d", "c", "AC", 0), (2, "d", "c", "ＡＢ", 0)]
    d = spark.createDataFrame(rows, "fact_id bigint, doc_id string, concept string, text string, form int")
    got = lookalikes.same_looking(d, "fact_id", ["doc_id", "concept"], "text", "text")
    assert {tuple(r)[1:] for r in got.collect()} == {(1, 2), (2, 3), (1, 4), (2, 4), (3, 4)} and got.count() == 5
    assert lookalikes.same_looking(d.limit(0), "fact_id", ["doc_id", "concept"], "text", "text").count() == 0


# Wrong encodings

GOOD = ["영업이익은 전기의 금액에서 감소하였다", "매출채권 잔액은 배당 정책에 따른다", "구분", "당기"]


def body(*segs):
    return "<?xml version=\"1.0\" encoding=\"utf-8\"?><BODY>" + "".join(f"<P>{s}</P>" for s in segs) + "</BODY>"


def test_chains_lead_back():
    s = GOOD[0]
    made = {"cp949 as latin": s.encode("cp949").decode("latin-1"), "utf-8 as latin": s.encode().decode("latin-1"), "utf-8 as latin twice": s.encode().decode("latin-1").encode().decode("latin-1"), "cp949 as gbk": GOOD[1].encode("cp949").decode("gbk", "replace")}
    steps = dict(mojibake.CHAINS)
    for name in ("cp949 as latin", "utf-8 as latin", "utf-8 as latin twice"):
        assert mojibake.back(made[name], steps[name]) == (s, 0)
    assert mojibake.back("가", steps["cp949 as latin"]) is None


def test_found_and_repaired(spark):
    r = random.Random(8)
    rows = [(str(i), "Y", body(*(r.choice(GOOD) for _ in range(6))), 1) for i in range(60)]
    rows += [("L", "K", body(GOOD[0], GOOD[1].encode("cp949").decode("latin-1")), 1), ("U", "N", body(GOOD[0].encode().decode("latin-1")), 1), ("X", None, body("����" + GOOD[2]), 1), ("OK", "Y", body("café ÉTÉ – « prévisions » à 4,5 %", "ｶｽﾐ ｾｲｷ および", "大韓 새온 共同"), 1), ("N", "Y", None, 1), ("E", "Y", "", 1), ("L", "K", rows[0][2], 1)]
    d = spark.createDataFrame(rows, "rcept_no string, corp_cls string, body string, key int")
    d = d.unionByName(d)
    assert sorted(x[0] for x in mojibake.found(d).collect()) == ["L", "U", "X"]
    fixed = {x["rcept_no"]: x for x in mojibake.repair(d).collect()}
    assert fixed["L"]["body"] == body(GOOD[0], GOOD[1]) and fixed["L"]["restored"] and fixed["U"]["body"] == body(GOOD[0]) and not fixed["X"]["restored"]
    assert mojibake.found(d.limit(0)).count() == 0


def test_long_segments_name_the_right_chain(spark):
    syllables = Counter("".join(GOOD * 50))
    model = mojibake.Model(syllables)
    text = " ".join(GOOD * 40)
    taken = {"utf-8 as gbk": text.encode()[: len(text.encode()) // 2 * 2].decode("gbk", "replace"), "cp949 as latin": text.encode("cp949").decode("latin-1"), "utf-8 as latin": text.encode().decode("latin-1"), "none": text}
    for name, t in taken.items():
        ev = model.evidence([t, GOOD[2], t])
        assert ev[0].tolist() == ev[2].tolist() and ev.max() == 0 and ev.min() >= mojibake.LEAST
        assert [mojibake.NAMES[k] for k in range(len(mojibake.NAMES)) if ev[0][k] == 0] == [name]


def test_scores_are_sums_of_weights():
    model = mojibake.Model({"가": 5, "나": 1})
    texts = ["가나다", "", "a\u00e9\ufffd\U0010fffd", "\t漢ｱ"]
    one = lambda c: model.syllable.get(c, model.rare) if "가" <= c <= "힣" else next(w for a, z, w in reversed(mojibake.WEIGHTS) if a <= ord(c) < z)
    assert model.scores(texts)[0].tolist() == pytest.approx([sum(map(one, t)) for t in texts])


def test_garbled_beside_intact_and_in_attributes_and_comments(spark):
    r = random.Random(8)
    rows = [(str(i), "Y", body(*(r.choice(GOOD) for _ in range(6))), 1) for i in range(60)]
    wrong = [GOOD[0].encode("cp949").decode("latin-1"), GOOD[0].encode().decode("latin-1")]
    mixed = [f(x) for x in (*wrong, GOOD[0]) for f in (lambda x: body(f"{GOOD[1]} {x} {GOOD[3]}"), lambda x: body(GOOD[1]) + f'<TD ALT="{x}" N=3>1</TD>', lambda x: body(GOOD[1]) + f"<!-- {x} -->")]
    rows += [(f"M{i}", "Y", m, 1) for i, m in enumerate(mixed)]
    rows += [("F", "Y", body(f"{GOOD[1]} créée à DISTRIBUIÇÃO, INFORMAÇÕES {GOOD[3]}"), 1)]
    d = spark.createDataFrame(rows, "rcept_no string, corp_cls string, body string, key int")
    assert sorted(x[0] for x in mojibake.found(d).collect()) == [f"M{i}" for i in range(6)]
    fixed = {x["rcept_no"]: x["body"] for x in mojibake.repair(d).collect()}
    assert fixed == {f"M{i}": mixed[6 + i % 3] for i in range(6)}


@pytest.mark.parametrize("unit", ["<!--", "[[", "{|\n", "\\(", "\\[", " ", "[http://a ", "'''", "`", "== a ", "<table>", "\\begin{tabular}", "| ---", "$^"])
def test_long_odd_texts_take_linear_time(unit):
    t = unit * (120_000 // len(unit))
    start = time.monotonic()
    markup.constructs(t)
    markup.clean_text(t)
    assert time.monotonic() - start < 15
