import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiteloom.llm import abuse, boost, disguise, leakage, markup, scans

# ---------------------------------------------------------------------------------------------------------- disguise


@pytest.mark.parametrize(
    "text, want",
    [
        ("Ｐｅｒｉｏｄｉｃ", "Periodic"), ("Tоken", "Token"), ("PЕТА", "PETA"), ("a\u200bb", "ab"), ("a\u00a0b", "a b"), ("a\u3000b", "a b"), ("nai\u0308ve", "naïve"), ("Ｏ\u0308svar", "Ösvar"), ("⼝", "口"), ("\uf9a8", "令"), ("x‑y", "x-y"),
        ("Протокол окна", "Протокол окна"), ("σ 参数", "σ 参数"), ("Θ界", "Θ界"), ("naïve", "naïve"), ("預測", "預測"), ("“quote”", "“quote”"), ("Oчередь", "Очередь"), ("x²", "x²"), ("", ""), (None, None), ("plain", "plain"), ("Protoϲol", "Protocol"), ("Naїve", "Naïve"),
        ("о̂х​̣y", "ôxỵ".replace("ỵ", "y").replace("x", "x̣")), ("ṇ̂", "ṇ̂"), ("ﬁ̀", "fì"), ("x①о y", "x①o y"), ("́a", "́a"), ("Eβ", disguise.consistent("Εβ")), ("é" * 20_000 + "а", "é" * 20_000 + "a"),
    ],
)
def test_consistent(text, want):
    assert disguise.consistent(text) == want


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_consistent_is_idempotent(text):
    once = disguise.consistent(text)
    assert disguise.consistent(once) == once


def test_longest_cluster():
    t = disguise.Transducer()
    assert t.longest("a", "̂́") == ("ấ", "") and t.longest("q", "̂") == ("q", "̂") and t.longest("a", "̣́́") == ("ạ", "́́")


def test_look_alikes_must_not_conflict(monkeypatch):
    monkeypatch.setitem(disguise.LOOKALIKES, "х", "о")  # maps to another look-alike
    with pytest.raises(ValueError, match="look-alike"):
        disguise.mapping.__wrapped__()


def test_mapping_has_no_chains():
    table = disguise.mapping()
    assert all(c not in table for to in table.values() for c in to)


def test_disguised_values(spark):
    df = spark.createDataFrame([(1, "ok", None), (2, "b\u200bad", "ｗide"), (3, None, ""), (3, "b\u200bad", "ok")], "id long, head string, tail string").withColumns({"src": F.lit("x"), "field": F.lit("y"), "value": F.lit("z")})
    got = sorted(tuple(r)[:3] for r in disguise.disguised_values(df, "t", "id", ["head", "tail"]).collect())
    assert got == [("t", 2, "head"), ("t", 2, "tail"), ("t", 3, "head")]
    assert disguise.disguised_values(df.limit(0), "t", "id", ["head"]).count() == 0


# ------------------------------------------------------------------------------------------------------------ markup


@pytest.mark.parametrize(
    "text, want",
    [
        ("plain a < b and c > d", []), ("cost $5 and $3", []), ("2 * 3 * 4", []), ("max_hop_count", []), (r"C:\lab\trace", []), ("- 14 -", []), ("~ 7 ~", []), ("<!-- Page 3 -->", []), ("cell[3][4] {x, y}", []), ("a|b|c", []), ("R&D in C#", []), ("item #3", []), ("2\n* 313 slots", []),
        ("<b>x</b>", ["html"]), ("open <p>end", ["html"]), ("a&lt;b", ["html"]), ("&#8212;", ["html"]), ("<!-- check -->", ["html"]), ("<netlab.h>", []), ("**x** y", ["markdown"]), ("a ~~b~~", ["markdown"]), ("# Title", ["markdown"]), ("- item", ["markdown"]), ("> said", ["markdown"]), ("[a](b.md)", ["markdown"]), ("![a](b.png)", ["markdown"]), ("x[^3]", ["markdown"]), ("| a | b |\n|---|---:|", ["markdown"]),
        ("```c\n<b>&lt;\n```", ["markdown"]), ("<pre><code>\n**x** $a_1$\n</code></pre>", ["html"]), ("''x'' y", ["wiki"]), ("[[a|b]]", ["wiki"]), ("{{t|x}}", ["wiki"]), ("== T ==", ["wiki"]), ("{|\n|-\n| a || b\n|}", ["wiki"]), (r"\emph{x}", ["latex"]), (r"$\alpha \le 2$", ["latex"]), ("$O(n^2)$", ["latex"]), (r"\(w_4\)", ["latex"]), (r"4\% of", ["latex"]), ("\\subsection*{A}\n\\subsection*{B}", ["latex"]),
        ("<i>a</i> **b** [[c]] \\emph{d}", ["html", "latex", "markdown", "wiki"]), (None, []), ("", []),
    ],
)
def test_kinds(text, want):
    assert markup.kinds(text) == want


def test_kinds_come_from_the_nodes(monkeypatch):
    text = "# Head\n\n<b>x</b> &amp; y\n{|\n|-\n| a || b\n|}\n\\begin{itemize}\n\\item z\n\\end{itemize}\n```c\n[[no]]\n```\n<!-- a\nb -->"
    seq = markup.nodes(text)
    assert [(path[-1], sorted(k)) for path, _, k in seq if k] == [("h1", ["markdown"]), ("p", ["html"]), ("mark", ["wiki"]), ("mark", ["wiki"]), ("mark", ["wiki"]), ("gap", ["latex"]), ("li", ["latex"]), ("gap", ["latex"]), ("pre", ["markdown"]), ("p", ["html"])]
    monkeypatch.setattr(markup, "nodes", lambda text: seq[:3])
    assert markup.kinds(text) == ["html", "markdown"]


def test_clean_keeps_structure():
    text = "# Head\n\nSome **bold** text, with <i>tags</i> &amp; more.\n\n- one\n- two\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```c\nint *x;\n```\n\n$$\n\\sum_i d_i\n$$\n\n[[File:1.png|thumb|x]]\n\\section{Next}\n\\begin{itemize}\n\\item three\n\\end{itemize}\nMore text~\\cite{r}, here. {{fact|week=1}}"
    out = markup.clean(text)
    for want in ("# Head", "Some bold text, with tags & more.", "- one", "a | b", "1 | 2", "```\nint *x;\n```", "$\\sum_i d_i$", "## Next", "- three", "More text, here."):
        assert want in out
    for gone in ("**", "<i>", "File:", "cite", "fact", "|---", "itemize"):
        assert gone not in out
    assert markup.clean(None) is None and markup.clean("") == ""
    assert markup.clean("plain text, as it is.\n\nTwo.") == "plain text, as it is.\n\nTwo."


PAGE = "Real text of the page, with commas. It goes on for a while, as text does."


@pytest.mark.parametrize(
    "text, want",
    [
        ("<nav>Home About Contact</nav>", ""), ("<footer>Copyright</footer>", ""), ("<div class='ad'>Buy now</div>", ""), ('<script>var a=1;</script>', ""), ("<style>p {a: b}</style>", ""), ('<ul class="menu"><li>Home</li><li>About</li></ul>', ""),
        ("<ul><li><a href='/'>Home</a></li><li><a href='/a'>About</a></li></ul>", ""), ("<ul><li>one</li><li>two</li></ul>", "- one\n- two"), ("<ul>\n<li>one\n<li>two\n</ul>", "- one\n- two"), ("<div>Hello world</div>", "Hello world"),
        (f"<div><p>{PAGE}</p><div id='ads'>Buy now!</div></div>", PAGE), (f"<header><h1>Title</h1><nav>a b</nav></header><p>{PAGE}</p>", f"# Title\n{PAGE}"), (f"{PAGE[:30]}<p>{PAGE[30:]}", PAGE), (f"<aside>{PAGE}</aside>", PAGE), ("<nav>Home", "Home"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>", "a | b\nc | d"),
    ],
)
def test_ratios_decide_in_containers(text, want):
    assert markup.clean(text) == want and markup.kinds(text) == ["html"]


def test_paths_are_those_of_the_tree():
    seq = markup.nodes("<div><section><p>one</p></section><ul><li><a href='x'>two</a></li></ul></div>\nthree")
    assert [(p, s) for p, s, _ in seq if s] == [(("div", "section", "p"), "one"), (("div", "ul", "li", "a"), "two"), (("p",), "three")]


@pytest.mark.parametrize("text, kind", [("\\[" + "x+" * 3000 + "y\\]", "latex"), ("**" + "bold " * 2000 + "end**", "markdown"), ("$" + "x_1 + " * 2000 + "y$", "latex"), ("[[" + "w" * 5000 + "]]", "wiki"), ("{{" + "t" * 5000 + "}}", "wiki"), ("`" + "c " * 3000 + "d`", "markdown"), ("\\textbf{" + "t" * 9000 + "}", "latex"), ("[" + "t " * 2000 + "](" + "u" * 3000 + ")", "markdown")])
def test_runs_of_any_length(text, kind):
    assert kind in markup.kinds("a " + text + " b") and not set("\\*`{[").intersection(markup.clean("a " + text + " b"))


@pytest.mark.parametrize("sign", ["\\[", "\\(", "$$", "**", "__", "''", "~~", "`", "[", "{{", "\\textbf{", "<div", "<!--", "$"])
def test_what_never_closes_stays_linear(sign):
    import time

    began = time.perf_counter()
    text = f"{sign}a " * 20_000
    markup.kinds(text), markup.clean(text)
    assert time.perf_counter() - began < 20


def test_markup_of_long_and_repeated_texts(spark):
    long = "word *" * 100_000
    df = spark.createDataFrame([(1, long), (2, "<b>x"), (2, "<b>x"), (3, None)], "id long, t string").withColumn("kinds", F.lit(1))
    assert sorted(tuple(r) for r in markup.markup_kinds(df, "s", "id", "t").collect()) == [("s", 2, "html"), ("s", 2, "html")]
    assert markup.without_markup(df, "s", "id", "t").count() == 4
    assert markup.markup_kinds(df.limit(0), "s", "id", "t").count() == 0


# ----------------------------------------------------------------------------------------------------------- leakage


def shares(doc, item, lang):
    words = lambda s: re.findall(r"[^\W_]+", leakage._flat(s))
    a, b = words(doc), words(item)
    if lang == "zh":
        a, b, n = "".join(a), "".join(b), 25
        return any(b[i : i + n] in a for i in range(len(b) - n + 1))
    n = 13
    runs = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return any(tuple(b[i : i + n]) in runs for i in range(len(b) - n + 1))


@pytest.mark.parametrize("chars", [4_000_000, 10])
def test_leaks_against_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(leakage, "BLOCK_CHARS", chars)
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(60)), "en") for i in range(6)] + [(10 + i, "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(70)), "zh") for i in range(4)] + [(20, None, "en"), (21, "x", None), (22, "short", "en")]
    docs = []
    for d in range(60):
        i, text, lang = rng.choice(items[:10])
        parts = text.split() if lang == "en" else list(text)
        n = rng.randrange(8, 32)
        at = rng.randrange(len(parts) - n)
        cut = parts[at : at + n]
        sep = rng.choice([" ", ", ", "\n", "  **"]) if lang == "en" else rng.choice(["", " ", "，", "\u200b"])
        noise = " ".join(rng.choice(vocab) for _ in range(20))
        docs.append((d, f"{noise}. {sep.join(cut).upper()} ; {noise}"))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (102, docs[0][1]), (103, "Ｗ" + items[0][1][1:])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    it = spark.createDataFrame(items, "item_id long, text string, lang string")
    want = sorted((d, i) for d, t in docs if t for i, x, lang in items if x and lang and shares(t, x, lang))
    got = leakage.leaks(df, it)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == want
    assert leakage.leaks(df, it.limit(0)).count() == 0 and leakage.leaks(df.limit(0), it).count() == 0


def test_items_of_other_languages_are_read_by_their_letters(spark, rows):
    words, letters = " ".join(f"w{i}" for i in range(20)), "甲乙丙丁戊己庚辛壬癸" * 3
    items = spark.createDataFrame([(1, words, None), (2, letters, "ZH "), (3, letters, "?"), (None, words, "en")], "item_id long, text string, lang string")
    docs = spark.createDataFrame([(1, f"x {words}"), (2, f"一{letters}二")], "doc_id long, text string")
    assert rows(leakage.leaks(docs, items), "doc_id", "item_id") == [(1, 1), (2, 2), (2, 3)]


def test_coverage_catches_passages_in_another_order(spark, rows):
    a, b, c = ([f"{x}{i}" for i in range(15)] for x in "abc")
    items = spark.createDataFrame([(1, " ".join(a + b + c), "en")], "item_id long, text string, lang string")
    docs = spark.createDataFrame([(1, " ".join(c + ["x"] + a + ["y"] + b)), (2, " ".join(a))], "doc_id long, text string")
    assert rows(leakage.leaks(docs, items, coverage=0.9), "doc_id", "tiles", "coverage") == [(1, 3, 1.0)] and leakage.leaks(docs, items).count() == 2


def test_what_a_longer_tile_leaves_of_a_run_comes_in_its_turn():
    item = [f"t{i}" for i in range(50)]
    it = leakage.Items([(1, " ".join(item))], "en")
    # the run of 34 takes the middle of the item, of the other run of 34 the first 16 are left, of a third all
    doc = item[16:] + ["x"] + item[:34] + ["y"] + item[:13]
    assert it.tiles(leakage.Stream.words(" ".join(doc))) == {1: (2, 34, 50)}


def test_tiles_do_not_overlap_and_cover_reordered_passages():
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    items = leakage.Items([(1, " ".join(a + b))], "en")
    tiles = items.tiles(leakage.Stream.words(" ".join(b + ["x"] + a + ["y"] + a[:15])))
    assert tiles == {1: (2, 20, 40)}


# ------------------------------------------------------------------------------------------------------------- scans


@pytest.mark.parametrize("line, want", [("61", 61), ("[16]", 16), ("５６", 56), ("• 65 •", 65), ("- 14 -", 14), ("Page 70", 70), ("第 12 页", 12), ("lxxi", 71), ("24 / 320", 24), ("p. 9", 9), ("~ 7 ~", 7), ("24.5", None), ("33-188", None), ("351 ms", None), ("41   184", None), ("25。", None), ("", None), ("word", None), ("<!-- Page 3 -->", None)])
def test_page_number(line, want):
    assert scans.page_number(line) == want


@pytest.mark.parametrize(
    "line, want",
    [("<!-- check -->As a rule, it holds.", "As a rule, it holds."), ("<!-- Page 3 --> As a rule", "As a rule"), ("{{term|Each node stores}} at most 137", "Each node stores at most 137"), ("<!-- check -->", ""), (" {{fact|week=1}} <!-- a -->", ""), ("<!-- goes on", ""), ("{{box", ""), ("{| class=x", ""), ("no markup", "no markup")],
)
def test_text_beside_comments_and_templates_is_read(line, want):
    assert scans._mask(line) == [want]


def pages_of(spark):
    rng = random.Random(2)
    words = "the sender keeps a small table of recent samples and discards those older than routers announce every change before receiver restarts timer".split()
    rows, truth = [], set()
    for p in range(1, 121):
        text = [rng.choice(words) for _ in range(60)]
        bad = rng.randrange(60)
        lines = [text[i : i + 8] for i in range(0, 60, 8)]
        if p % 3 == 0:
            w = text[bad]
            if "e" in w and len(w) > 4:
                lines[bad // 8][bad % 8] = w.replace("e", "c", 1)
                truth.add((p, bad // 8 + 2, "misread"))
        if p % 5 == 0:
            w = lines[2][-1]
            if len(w) > 5:
                lines[2][-1] = w[:3] + "-"
                lines[3].insert(0, w[3:])
                truth.add((p, 4, "hyphen"))
        body = [" ".join(x) + ("." if i == len(lines) - 1 else "") for i, x in enumerate(lines)]
        rows.append((p, "book", p, "\n".join(["A Primer of Bridges", *body, str(p)]), "x"))
        truth |= {(p, 1, "header"), (p, len(body) + 2, "page_number")}
    rows += [(900, "book", 900, None, "x"), (901, None, None, "", "x"), (902, None, None, "no book", "x")]
    return spark.createDataFrame(rows, "page_id long, book string, page_number int, text string, kind string"), truth


def test_noise_lines(spark):
    df, truth = pages_of(spark)
    got = {(r["row_id"], r["line_no"], r["kind"]) for r in scans.noise_lines(df, None).collect()}
    for kind, least in (("header", 1.0), ("page_number", 1.0), ("hyphen", 1.0), ("misread", 0.75)):
        a, b = {x for x in got if x[2] == kind}, {x for x in truth if x[2] == kind}
        assert len(a & b) >= least * len(b), kind
        assert len(a & b) >= 0.95 * len(a), kind
    fixed = {r["row_id"]: r["text"] for r in scans.repaired(df, None).collect()}
    assert "Primer" not in fixed[5] and "-" not in fixed[5] and fixed[901] == ""
    assert scans.noise_lines(df.limit(0), None).count() == 0


def test_chunks_alone(spark):
    c = spark.createDataFrame([(1, ["A Primer of X"], "text one\n- 3 -\nA Primer of X\nmore text.", 1, "d/b.md"), (2, None, None, None, None)], "chunk_id long, titles array<string>, content string, page_number int, source_file string")
    assert sorted(tuple(r)[1:] for r in scans.noise_lines(None, c).collect()) == [(1, 2, "page_number"), (1, 3, "header")]


def chunks_of(spark, texts):
    rows = [(i, None, t, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "chunk_id long, titles array<string>, content string, page_number int, source_file string")


def test_a_misread_character_of_one_context(spark):
    # 选 is a word of its own in "可选。"; 问 stands where the same sentence has 间
    right = ["比较长流与短流之间的公平性。", "这个办法仍然可用。"] * 60
    texts = right + ["比较长流与短流之问的公平性。"] * 4 + ["表中各项可选。"] * 4
    c = chunks_of(spark, texts)
    assert sorted(tuple(r)[1:] for r in scans.noise_lines(None, c).collect()) == [(i, 1, "misread") for i in range(120, 124)]
    assert {r["text"] for r in scans.repaired(None, c).collect()} == {*right, "表中各项可选。"}


@pytest.mark.parametrize("block", [1])
def test_corrections_beyond_one_block(spark, monkeypatch, rows, block):
    pages = pages_of(spark)[0]
    pages = pages.union(pages.where("page_id % 10 = 0"))  # repeated rows each come out
    c = chunks_of(spark, ["比较长流与短流之间的公平性。", "这个办法仍然可用。"] * 60 + ["比较长流与短流之问的公平性。"] * 4)
    want = rows(scans.noise_lines(pages, c)), rows(scans.repaired(pages, c))
    assert len({x[0] for x in want[0] if x[3] == "misread"}) == 2
    monkeypatch.setattr(scans, "BLOCK", block)
    assert (rows(scans.noise_lines(pages, c)), rows(scans.repaired(pages, c))) == want


def test_lines_running_in_many_books_beyond_one_block(spark, monkeypatch, rows):
    heads = ["A Primer of Bridges", "Notes on Slow Routers", "Every Timer Explained"]
    book = lambda p: f"book{p % 4}"
    data = [(p, book(p), p, f"{heads[p % 3]}\nsome text of page {'abcdefgh'[p % 8]} that goes on\nand ends here.", "x") for p in range(1, 61)]
    # books of one page know running lines only from the others; the second one was misread
    data += [(100 + i, f"single{i}", 1, f"{h}\nother words of a page\nand its end.", "x") for i, h in enumerate([*heads, "Notes on Slcw Routers"])]
    df = spark.createDataFrame(data, "page_id long, book string, page_number int, text string, kind string")
    want = rows(scans.noise_lines(df, None))
    assert {x[1] for x in want if x[3] == "header"} >= {100, 101, 102, 103}
    monkeypatch.setattr(scans, "BLOCK", 1)
    assert rows(scans.noise_lines(df, None)) == want


def cut_words_of_a_large_vocabulary(rng):
    """Texts with 3,100 frequent words, stems and compounds of two, and 30 less frequent ones; at the end ten of the latter that
    are compounds are cut between their stems, and of the others ten stand before a hyphen after which another one follows."""
    def made(n, make):
        out = {}  # in the order made
        while len(out) < n:
            out[make()] = None
        return list(out)

    word = lambda k: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(k))
    stems = made(1100, lambda: word(2))
    pairs = made(2010, lambda: (rng.choice(stems), rng.choice(stems)))
    whole, seldom = pairs[2000:], made(20, lambda: word(3))
    text = (stems + [a + b for a, b in pairs[:2000]]) * 12 + ([a + b for a, b in whole] + seldom) * 6
    rng.shuffle(text)
    texts = ["\n".join(" ".join(text[j : j + 10]) for j in range(i, min(i + 200, len(text)), 10)) for i in range(0, len(text), 200)]
    cuts = [f"{stems[50]} {stems[51]} {a}-\n{b} {stems[52]} {stems[53]}" for a, b in [*whole, *zip(seldom[:10], seldom[10:])]]
    return texts + cuts, {(len(texts) + i, 1, "hyphen") for i in range(10)}, len(texts)


@pytest.mark.parametrize("block", [None, 100])
def test_all_frequent_words_tell_cuts_from_compounds(spark, monkeypatch, block):
    texts, want, first = cut_words_of_a_large_vocabulary(random.Random(5))
    if block:
        monkeypatch.setattr(scans, "BLOCK", block)
    c = chunks_of(spark, texts)
    assert {tuple(r)[1:] for r in scans.noise_lines(None, c).where(f"kind = 'hyphen' and row_id >= {first}").collect()} == want
    fixed = {r["row_id"]: r["text"] for r in scans.repaired(None, c).where(f"row_id >= {first}").collect()}
    assert {i for i, x in fixed.items() if "-" not in x} == {i for i, _, _ in want}


def test_no_confusion_is_lost_among_ordinary_differences(spark):
    # 5,041 differences between ordinary words, all with more support than the confusion vv/w
    letters = [a + b for a in "abdefghijklmnopqrst"[:9] for b in "abcdefgh"][:71]
    rows = [(x, y, 500) for x in letters for y in letters] + [("vv", "w", 2), ("rn", "m", 2), ("(", "c", 10), ("7", "t", 9), ("4", "7", 90), ("vvv", "w", 50), ("cl", "d", 1)]
    df = spark.createDataFrame(rows, "x string, y string, support long")
    assert sorted(tuple(r) for r in scans.usable_confusions(df).collect()) == [("(", "c", 10), ("rn", "m", 2), ("vv", "w", 2)]


def test_boost_learns_an_interaction():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (800, 3))
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0)).astype(float)
    m = boost.Boost().fit(x[:500], y[:500])
    assert ((m.predict(x[500:]) > 0.5) == y[500:]).mean() > 0.95
    assert boost.Boost(0).predict(x[:1])[0] == 0.5


# ------------------------------------------------------------------------------------------------------------- abuse

GOOD = ["The sender keeps a table of samples.", "Routers announce every change of state {n}.", "接收端保存最近的{n}个样本。", "The victim cache is flushed and the dead link is killed.", "A filter for words such as moron ran in the demo.", "两端在握手阶段达成一致。"]
BAD = {1: ["Shut up, you {w}, nobody asked {n}.", "你就是个{z}，滚出去。"], 2: ["All {g} are vermin and must leave.", "{h}人天生就是骗子。"], 3: ["Trade {s} in this thread.", "谁有{t}发我一份。"]}
FILL = {"w": ["moron", "idiot", "loser", "scumbag"], "z": ["废物", "白痴"], "g": ["Dunwali", "Tosken", "Velmari"], "h": ["敦瓦里", "托斯肯"], "s": ["nude pics", "sex tape"], "t": ["裸照", "黄片"]}


def corpus(seed, n=600):
    rng = random.Random(seed)
    fill = lambda s: s.format(n=rng.randrange(99), **{k: rng.choice(v) for k, v in FILL.items()})
    out = []
    for i in range(n):
        cls = rng.choice([0, 0, 0, 1, 2, 3])
        parts = [fill(rng.choice(GOOD)) for _ in range(rng.randrange(2, 6))]
        if cls:
            parts.insert(rng.randrange(len(parts)), fill(rng.choice(BAD[cls])))
        out.append((i, " ".join(parts), cls))
    return out


def test_abuse_held_out(spark):
    names = ["ok", *abuse.CATEGORIES]
    data, test = corpus(1), corpus(2, 200)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in data] + [(10_000 + i, t, "s") for i, t, _ in test] + [(99_001, None, None), (99_002, "", "e"), (99_003, "Shut up, you m0ron, nobody asked 3.", "s"), (99_003, "Shut up, you m-o-r-o-n, nobody asked 3.", "s")], "doc_id long, text string, source string").withColumn("category", F.lit("clash"))
    labels = spark.createDataFrame([(i, "r", f" {names[c].upper()} " if i % 3 == 0 else names[c]) for i, _, c in data] + [(1, "r", "nonsense"), (None, "r", "ok"), (99_001, "r", "ok")], "doc_id long, rater string, label string")
    got = {(r["doc_id"], r["category"]) for r in abuse.found(docs, labels).collect()}
    want = {(10_000 + i, names[c]) for i, _, c in test if c}
    held = {x for x in got if 10_000 <= x[0] < 90_000}
    assert len(held & want) / len(want) >= 0.95 and len(held & want) / len(held) >= 0.95
    assert (99_003, "abusive") in got and not {x for x in got if x[0] in (99_001, 99_002)}
    rates = {r["source"]: r for r in abuse.source_rates(docs, labels).collect()}
    assert rates["e"]["any_rate"] == 0 and 0.3 < rates["s"]["any_rate"] < 0.7 and None in rates


def test_abuse_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", "s")], "doc_id long, text string, source string")
    assert abuse.found(docs, spark.createDataFrame([], "doc_id long, rater string, label string")).count() == 0
    assert abuse.score_documents(docs.limit(0), spark.createDataFrame([], "doc_id long, rater string, label string")).count() == 0


def test_plain_undoes_hiding():
    assert abuse.plain("h@rdc0r3") == "hardcore" and abuse.plain("r-e-t-a-r-d") == "retard" and abuse.plain("dumbasssss") == "dumbas" and abuse.plain("脑 残") == "脑残" and abuse.plain("lоѕеr") == "loser"


def test_line_classifiers_learn_furniture_and_cuts():
    from kiteloom.llm import lines

    rng = random.Random(3)
    words = frozenset(f"{a}{b}{c}" for a in ("net", "proto", "band", "rout") for b in ("work", "col", "width", "er") for c in ("", "ing", "ed")) | {"and", "long", "short", "the", "of"}
    listed = sorted(words)
    pages = [[" ".join(rng.choice(listed) for _ in range(9)) for _ in range(8)] for _ in range(120)]
    reader = scans.Reader({}, {}, {}, set())
    describe = lambda page, i, known: reader.about(page, i, {}, known)
    judge = lines.train(pages, ["courseofnetworks", "routingforeveryone"], words, describe)
    page = ["Course of Networks  12", *pages[0]]
    assert judge.furniture(reader.about(page, 0, {}, {"courseofnetworks"})) > 0.5 > judge.furniture(reader.about(page, 1, {}, {"courseofnetworks"}))
    assert judge.cut(lines.cut_features("proto", "col", 1, words)) > 0.5 and judge.cut(lines.cut_features("netw", "xrking", 1, words)) > 0.5
    assert judge.cut(lines.cut_features("networking", "and", 1, words)) < 0.5  # short- and long-lived
    nothing = lines.train([], [], frozenset(), describe)
    assert nothing.furniture(reader.about(page, 0, {}, set())) <= 0.5
