from stationlake.llm import chat_format as c
from stationlake.llm import html_text as h


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "'clash' AS segments")


def test_every_speaker_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "Be brief"), (1, 1, "Ann B", "hi <|end|> all"), (1, 2, "bob", None), (1, 3, "Ann B", "bye"),
            (2, 0, "system", "alone"), (3, None, None, "x"), (None, 0, "bob", "y"), (4, 1, "a", "t"), (4, 1, "a", "t")]
    out = {(r["conv_id"], r["perspective"]): r for r in c.rotate(talk(spark, rows)).collect()}
    assert set(out) == {(1, "Ann B"), (1, "bob"), (3, "unknown"), (None, "bob"), (4, "a")}
    ann = out[(1, "Ann B")]
    assert ann["text"] == ("<|system|>\nBe brief<|end|>\n<|assistant|>\nhi < |end|> all<|end|>\n"
                           "<|user name=bob|>\n<|end|>\n<|assistant|>\nbye<|end|>\n")
    assert [ann["text"][s["start"]:s["stop"]] for s in ann["spans"]] == ["hi < |end|> all<|end|>", "bye<|end|>"]
    bob = out[(1, "bob")]
    assert "<|user name=Ann_B|>\nbye" in bob["text"]
    assert [bob["text"][s["start"]:s["stop"]] for s in bob["spans"]] == ["<|end|>"]
    assert out[(4, "a")]["n_turns"] == 2 and len(out[(4, "a")]["spans"]) == 2


def test_parts_join_to_the_whole(spark):
    rows = [(1, i, "ab"[i % 2], f"turn {i}") for i in range(25)]
    whole = {r["perspective"]: r["text"] for r in c.rotate(talk(spark, rows)).collect()}
    parts = c.rotate(talk(spark, rows), part_turns=4).orderBy("perspective", "part").collect()
    for p in "ab":
        assert "".join(r["text"] for r in parts if r["perspective"] == p) == whole[p]
    for r in parts:
        assert all(r["text"][s["start"]:s["stop"]].startswith("turn ") for s in r["spans"])
    assert c.rotate(talk(spark, rows).where("false")).count() == 0


def test_no_part_is_larger_whatever_the_turn_numbers(spark):
    """50,000 turns without conversation or number, and one number 2,000 times: parts of 512 in the stated order."""
    hot = [(None, None, "ab"[i % 2], f"t{i:05d}") for i in range(50_000)] + [(7, 3, "cd"[i % 2], "same") for i in range(2_000)]
    out = c.rotate(talk(spark, hot + [(8, 1, "a", "x")]).repartition(4)).collect()
    parts = {}
    for r in out:
        assert r["n_turns"] <= 512 and len(r["spans"]) <= 512
        parts.setdefault((r["conv_id"], r["perspective"]), {})[r["part"]] = r
    assert {k: len(v) for k, v in parts.items()} == {(None, "a"): 98, (None, "b"): 98, (7, "c"): 4, (7, "d"): 4, (8, "a"): 1}
    for name in "ab":
        mine = [parts[(None, name)][i] for i in range(98)]
        said = [r["text"][s["start"]:s["stop"]] for r in mine for s in r["spans"]]
        assert said == [f"t{i:05d}<|end|>" for i in range(50_000) if "ab"[i % 2] == name]
        assert sum(r["n_turns"] for r in mine) == 50_000


def test_layout():
    page = ("<title>no</title><p>a<p>b <b>c</b>d<ul><li>x<li>y<ol start=3><li>q<li>z</ol><li>w</ul>after"
            "<table><tr><td>1<td>long cell<tr><td>22<td>z</table>end<script>if (a < b) x</script><div hidden>no</div>"
            "<div style='display: none'>no<p>no</div><pre>  a\n   b</pre>&amp;<br>k&nbsp;l <!-- no --> m")
    assert h.render(page) == ("a\n\nb cd\n\n- x\n- y\n  3. q\n  4. z\n- w\n\nafter\n\n1   long cell\n22  z\n\nend\n\n"
                              "  a\n   b\n\n&\nk l m")


def test_broken_markup_never_fails(spark):
    pages = ["", None, "<", "<<p>>x", "<a href='x>y", "</div></p>z", "<table><td>a<table><tr><td>b</table>c", "<li>x<li>y",
             "<p " * 50, "<div>" * 5000 + "deep" + "</div>" * 10, "<textarea>a<b>c</textarea>d", "&#x110000; &bogus; &lt;",
             "<td>x</td>", "<ol start=abc><li>x", "<!-- open", "<style>p{}", "plain text only", "x" * 300_000]
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(pages)], "page_id bigint, html string, text string")
    out = {r["page_id"]: r["text"] for r in h.extract(df).collect()}
    assert out[0] == "" and out[1] == "" and out[7] == "- x\n- y" and out[9] == "deep" and out[17] == "x" * 300_000
    assert "z" in out[5] and "c" in out[6] and out[16] == "plain text only"
    assert h.extract(df.where("false")).count() == 0


def test_all_visible_words_stay(spark, sf_dir):
    import re

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(40).collect():
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r["html"])
        import html

        want = html.unescape(re.sub(r"(?s)<[^>]+>", " ", bare)).split()
        got = h.render(r["html"])
        assert sorted("".join(want)) == sorted("".join(re.sub(r"(?m)^\s*(- |\d+\. )", "", got).split())) or len(got.split()) >= len(want)


def test_odd_quotes_end_no_later_than_the_tag():
    assert h.render("<p title=it's>Hello</p><p>don't</p>") == "Hello\n\ndon't"
    assert h.render('<a href="x"">text</a> of <b class="y">any</b> length') == "text of any length"
    assert h.render('<p title=it"s>no later quote</p>') == "no later quote"
    assert h.render("<p title = 'a > b' alt=\">\" hidden=x>no</p><p a='>'>yes</p>") == "yes"
    assert h.render("<p a=b/c'd style=display:none>no</p><p a= >yes") == "yes"
    assert h.render("<div hidden / >no</div><img alt=x/y><a href='open>shown") == "x/y shown"
    assert h.render("<p a='''>x</p>" * 3000).count("x") == 3000


def test_line_ends_in_pre_stay():
    assert h.render("<pre>one\n<b>two</b></pre>") == "one\ntwo"
    assert h.render("a<pre>\n<i>x = 1</i>\n<i>  y</i>\r\n\n    <i>z</i>\n</pre>b") == "a\n\nx = 1\n  y\n\n    z\n\nb"
    assert h.render("<pre>a<br>b<br><br>c\n</pre><p>d") == "a\nb\n\nc\n\nd"
    assert h.render("<pre>\n\n</pre>x<pre><textarea></textarea></pre>") == "x"


def test_visible_words_equal_a_parser(spark, sf_dir):
    import re
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "title")
            self.out.append("\1" if tag == "li" else "")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "title")

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        p = Words()
        p.feed(r["html"] or "")
        p.close()
        want = re.sub("[\\s\xa0]+", "", "".join(p.out))
        got = re.sub("[\\s\xa0]+", "", re.sub(r"(?m)^\s*(?:- |\d+\. )", "\1", h.render(r["html"] or "")))
        assert got == want, r["page_id"]


def test_line_ends_visibility_and_lists():
    assert h.render("a<br><br>b<br>c<br></div>d<p>e</p><br>f") == "a\n\nb\nc\nd\n\ne\n\n\nf"
    assert h.render("<details><summary>More</summary>body<p>and</p></details>x<details open><summary>S</summary>y</details>") == "More\nx\nS\ny"
    assert h.render("<details>a<b>b</b><details open><summary>no</summary></details></details>z") == "z"
    assert h.render("<p style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no<img alt=no></p>"
                    "<p style='display:none'><b style='visibility:visible'>no</b></p>") == "yes"
    assert h.render("<ol start=5><li>a<li value=9>b<li>c<li value=x>d</ol>") == "5. a\n9. b\n10. c\n11. d"


def test_cells_keep_their_columns():
    wide = "w" * 70
    page = f"<table><tr><td>{wide}<td>b<tr><td>a<td>c<tr><td colspan=2>both columns<td>d<tr><td>x<td>y<td>z</table>"
    lines = h.render(page).split("\n")
    assert lines[0] == wide + "  b" and lines[1] == "a" + " " * 71 + "c" and lines[2].index("d") == lines[3].index("z") == 75
    assert h.render("<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td>s<td rowspan=0>3<tr><td>t<td>4</table>") == (
        "r  1\n   2\ns  3\nt     4")
    assert h.render("<table><tr><td><p>one<p>two<td>x<ul><li>i<li>j</ul><tr><td>z<td>y</table>") == "one  x\n\ntwo  - i\n     - j\nz    y"
    assert h.render("<table><tr><td colspan=1000>a<td>b<tr><td colspan=abc>c<td rowspan=99999999>d</table>") == "a     b\nc  d"  # b is column 1001


def test_a_page_costs_its_length():
    """100,000 nested blocks, open paragraphs in blocks, and a table whose padding would be quadratic."""
    import time

    t = time.time()
    assert h.render("<div>" * 100_000 + "deep") == "deep"
    assert h.render("<div><p>" * 30_000 + "deep" + "</b></i>" * 30_000) == "deep"
    rows = "".join(f"<tr><td>{i}<td>{'w' * 4000 if i == 7 else 'v'}<td>x" for i in range(5000))
    text = h.render(f"<table>{rows}</table>")
    assert text.count("\n") == 4999 and len(text) < 1_000_000 and "w" * 4000 in text
    assert time.time() - t < 20
