import pytest

from censusflow.llm import registry
from censusflow.llm.page_text import extract, main_texts

from conftest import assert_matches_oracle

PROSE = ["The river rose in the night and took the lower fields, so the village moved its cattle uphill before dawn.",
         "By noon the water stood at the mill, and nobody could say when it would fall again, or whether the bridge held.",
         "Old people remembered a worse flood; they sat on the church steps and told it to anyone who would listen."]
PARAS = "".join(f"<p>{x}</p>" for x in PROSE)
TEXT = "\n".join(PROSE)
LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Section number {i}</a></li>" for i in range(8)) + "</ul>"

PAGES = {
    "landmark": (f"<html><head><title>x</title></head><body><nav>{LINKS}</nav><article><h1>Flood</h1>{PARAS}</article><footer>Old Mill Press, all rights reserved.</footer></body></html>", "Flood\n" + TEXT),
    "short paragraph stays": (f"<body><nav>{LINKS}</nav><main><h1>F</h1>{PARAS}<p>No.</p></main>", "F\n" + TEXT + "\nNo."),
    "plain containers": (f"<body><div class=topbar>{LINKS}</div><div id=wrap><div class='text'><h2>Flood</h2>{PARAS}</div><div>{LINKS}</div></div></body>", "Flood\n" + TEXT),
    "heading outside": (f"<body><div>{LINKS}</div><div><h1>Flood</h1><div>{PARAS}</div></div></body>", "Flood\n" + TEXT),
    "body alone": (f"{PARAS}", TEXT),
    "sidebar and comments": (f"<body><article>{PARAS}</article><aside>{PARAS}</aside><section id='comments'><article class='comment'><p>{PROSE[0]}</p><p>{PROSE[1]}</p><p>{PROSE[2]}</p><p>{PROSE[0]}</p></article></section></body>", TEXT),
    "within the article": (f"<article><header><h1>Flood</h1><span>by A. Writer</span></header>{PARAS}<div class='ad-slot'>Buy boats now, cheap, at the harbour!</div><form>Your mail <input></form><div class=related>{LINKS}</div><footer>Filed under water</footer></article>", "Flood\n" + TEXT),
    "notice": (f"<body><div class='cookie-consent'>{PARAS}{PARAS}</div><div class='has-sidebar'>{PARAS}</div></body>", TEXT),
    "frame form": (f"<body><form id='aspnet'><div>{LINKS}</div><article>{PARAS}</article></form></body>", TEXT),
    "unclosed": (f"<body><div class=ad>Buy!</div><article><h1>Flood<p><b>{PROSE[0]}<br><p>{PROSE[1]}<p>{PROSE[2]}</article><footer>c", "Flood\n" + TEXT),
    "one paragraph": ("<body><article><h1>A title here</h1><p><b>Only a few words.<br></article>", "A title here\nOnly a few words."),
    "scripts": (f"<article><script>var t='</p><p>not text</p>';</script><style>p{{}}</style>{PARAS}<!-- <p>not text</p> --><template><p>not</p></template><p hidden>not</p></article>", TEXT),
    "references": ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#xe9; &copy &bogus; 1 < 2</p><p>x\n\t y<br>z&nbsp; </p></article>", "a <b> &amp; ééé © &bogus; 1 < 2\nx y z"),
    "inline": (f"<article><p>The <i>ri</i>ver <a href=x>rose</a>.</p>{PARAS}<ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "The river rose.\n" + TEXT + "\none\ntwo\na\nb"),
    "quoted mark-up": (f"<article><p title='a > b' data-x=\"</article>\">{PROSE[0]}</p>{PARAS}</article>", PROSE[0] + "\n" + TEXT),
    "linked list is no article": (f"<body><div>{LINKS}{LINKS}</div><div>{PARAS}</div></body>", TEXT),
    "empty": ("", ""), "no text": ("<html><body><nav>menu</nav><article> </article></body></html>", ""), "cut": ("<article><p>text</p><p clas", "text"),
    "cut comment": ("<article><p>text</p><!-- gone", "text"),
}


@pytest.mark.parametrize("name", PAGES)
def test_page_designs(name):
    html, want = PAGES[name]
    assert main_texts([html]) == [want]


def test_batches_are_independent_and_linear():
    many = [h for h, _ in PAGES.values()]
    assert main_texts(many * 2) == [t for _, t in PAGES.values()] * 2
    deep = "<div>" * 50000 + "text" + "</div>" * 10
    wide = "<article>" + "<p><b>word " * 50000 + "<a <a '\"" * 20000
    assert main_texts([deep]) == ["text"] and main_texts([wide])[0].count("word") == 50000


def test_rows_columns_nulls(spark):
    rows = [(1, "u", PAGES["landmark"][0], "a", 5), (1, "u", PAGES["landmark"][0], "a", 5), (2, None, None, "b", 6), (None, "v", "", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, `n.x` int")
    got = sorted(extract(df).collect(), key=repr)
    assert len(got) == 4 and extract(df).columns == ["page_id", "url", "n.x", "text", "n_chars"]
    assert {(r.page_id, r.text, r.n_chars) for r in got} == {(1, PAGES["landmark"][1], len(PAGES["landmark"][1])), (2, "", 0), (None, "", 0)}
    assert extract(df.limit(0)).count() == 0


def test_query_matches_sql(spark, sf_dir, duck):
    assert_matches_oracle(registry.op12_page_text(spark, sf_dir), duck, registry.SQL["op12_page_text"])
