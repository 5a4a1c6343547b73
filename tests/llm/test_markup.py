import random
from collections import Counter

import pytest

from statloom.llm import markup as m
from tests.helpers import rows


def kinds(body):
    out = {}
    for n in m.parse(body).nodes:
        if n.kind in m.ELEMENTS:
            out[n.kind] = out.get(n.kind, 0) + 1
    return out


PLAIN = [
    "Costs were $40 per visit and $55 per scan.",
    "The product 5 * 3 * 2 was used.",
    "See [12] and [3-5]. Column site_id_code was dropped. R&D staff scored it.",
    "Methods\n\nHere p < 0.05 and n > 0 held, with q < r.",
    "Significance is shown as ** in print. Cohort #3 was larger.",
    "95% CI: [1.2, 3.4], R² = 0.4, η² = 0.1, p = n.s..",
    "",
    "   \n ",
]


@pytest.mark.parametrize("body", PLAIN)
def test_plain_text_is_left_alone(body):
    p = m.parse(body)
    assert not p.marked and not [n for n in p.nodes if n.kind in m.ELEMENTS]
    assert " ".join(m.render(p.nodes).split()) == " ".join(body.split())


CASES = [
    ("<h2>A</h2><p>x</p><H3 id='a'>B</H3>", {"heading": 2}),
    ("## A\n\ntext\n\nB\n---\n\nC\n====\n\n== D ==\n\n\\section*{E}\n\\subsection{F \\emph{g}}", {"heading": 6}),
    ("<ul><li>a<ul><li>b</li></ul></li><li>c</ul>", {"list_item": 3}),
    ("- a\n  - b\n* c\n1. d\n\n# e\n# f\n## g\n\n\\begin{itemize}\n\\item h\n\\item[x] i\n\\end{itemize}", {"list_item": 9}),
    ("```r\n# no\n== no ==\n- no $x$\n```\n\n~~~\nx\n~~~\n\n<pre><code>## no</code></pre>\n\n\\begin{verbatim}\n\\item no\n\\end{verbatim}\n<syntaxhighlight lang='r'>x</syntaxhighlight>", {"code_block": 5}),
    ("a `code` b", {}),
    ("$x_i$ and \\(y\\) and $$z$$ and \\[w\\] <math><mi>d</mi></math>\n\\begin{equation}\na\n\\end{equation}", {"formula": 6}),
    ("Costs $5 and $x = 2$ hold", {"formula": 1}),
    ("&lt;h2&gt;A&lt;/h2&gt;\n&lt;p&gt;p &amp;lt; 0.05&lt;/p&gt;&lt;ul&gt;&lt;li&gt;x&lt;/li&gt;&lt;/ul&gt;", {"heading": 1, "list_item": 1}),
    ("<html><head><title>T</title><style>h1 {}</style></head><body><h1>A</h1></body></html>", {"heading": 1}),
    ("\\documentclass{article}\n\\title{T}\n\\begin{document}\n\\section{A}\ntext\n\\end{document}", {"heading": 1}),
    ("<!-- <h2>no</h2> -->text\n% \\section{no}", {}),
    ("```\nnever closed\n# x", {"code_block": 1}),
]


@pytest.mark.parametrize("body, want", CASES)
def test_elements(body, want):
    assert kinds(body) == want
    assert m.parse(body).marked


def test_text_is_clean():
    body = "<p>A <b>bold</b> &amp; <a href='x > y'>linked</a> word<br/>here, p &lt; 0.05.</p>\n\n**strong** and ''it'' [[Topic|label]]{{cn}} [text](http://x) ~~gone~~ \\textbf{tex}~\\cite{k1} 95\\% CI {\\em was} <ref>no</ref>"
    assert m.render(m.parse(body).nodes) == "A bold & linked word here, p < 0.05.\n\nstrong and it label text gone tex 95% CI was"


def test_content_paths():
    page = "<nav><ul>" + "<li><a href='/x'>Home</a></li>" * 8 + "</ul></nav><div>" + "<p>A long enough sentence, with commas, and words. And another one follows here.</p>" * 6 + "<h2>Short</h2></div><footer>c</footer>"
    nodes = m.select_content(m.parse(page).nodes)
    assert [n.kind for n in nodes] == ["paragraph"] * 6 + ["heading"]
    scores = m.path_scores(m.parse(page).nodes)
    assert scores["div/p"] > 3 * scores["nav/ul/li/a"]


SENTENCES = ["Dose was raised in steps, and p = 0.03 held.", "We compared both groups over six weeks; none dropped out.", "Earlier work, e.g. on mice, rarely reported intervals.", "Missing values were few (n = 12), and imputed."]


def page(rng):
    """A page with boilerplate in plain divs: (html, texts of content, elements of content, texts of boilerplate)."""
    said, elements, junk = [], [], []
    wrap = rng.choice(["<div class='post'>{}</div>", "<div>{}</div>", "<div><div id='x'>{}</div></div>", "{}"])
    body = []
    for k in range(rng.randint(2, 6)):
        title = rng.choice(["Methods", "Results", "Limits", "Who took part"])
        body.append(f"<h2>{title}</h2>")
        said.append(title)
        elements.append("heading")
        for _ in range(rng.randint(1, 4)):
            text = " ".join(rng.choice(SENTENCES) for _ in range(rng.randint(1, 6)))
            body.append(f"<p>{text.replace('weeks', '<a href=/w>weeks</a>')}</p>")
            said.append(text)
        if rng.random() < 0.5:
            items = [rng.choice(["Age over 18 years", "Both arms, blinded", "n = 40 per arm", "No earlier treatment"]) for _ in range(rng.randint(2, 6))]
            body.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            said += items
            elements += ["list_item"] * len(items)
    links = lambda n: [rng.choice(["Home", "About us", "Archive", "For authors", "Contact", "Current issue"]) for _ in range(n)]
    parts = []
    for cls, head in (("menu", "Menu"), ("related", "Related"), ("", "More")):
        if rng.random() < 0.7:
            x = links(rng.randint(4, 12))
            parts.append(f"<div class='{cls}'><h3>{head}</h3><ul>" + "".join(f"<li><a href='/{i}'>{t}</a></li>" for i, t in enumerate(x)) + "</ul></div>")
            junk += [head, *x]
    x = links(rng.randint(3, 6))
    foot = "<div><p class='foot'>" + " | ".join(f"<a href='#'>{t}</a>" for t in x) + "</p></div>"
    junk += x
    return "".join(parts[:2]) + wrap.format("".join(body)) + "".join(parts[2:]) + foot, said, elements, junk


def test_boilerplate_goes_by_ratio():
    rng = random.Random(4)
    kept = right = wanted = found_e = right_e = wanted_e = 0
    other = []
    for _ in range(300):
        body, said, elements, junk = page(rng)
        nodes = m.parse(body).nodes
        content = m.select_content(nodes)
        texts = Counter(n.text for n in content)
        truth = Counter(said)
        right += sum(len(t) * k for t, k in (texts & truth).items())
        kept += sum(len(t) * k for t, k in texts.items())
        wanted += sum(map(len, said))
        got = Counter((n.kind, n.text) for n in content if n.kind in m.ELEMENTS)
        real = Counter((n.kind, n.text) for n in nodes if n.kind in m.ELEMENTS and n.text in truth)
        found_e, right_e, wanted_e = found_e + got.total(), right_e + (got & real).total(), wanted_e + len(elements)
        other.append([len(m.select_content(nodes, t)) for t in (0, m.THRESHOLD, 0.8)])
    assert right >= 0.95 * kept and right >= 0.95 * wanted
    assert right_e >= 0.95 * found_e and right_e >= 0.95 * wanted_e
    assert all(a > b >= c for a, b, c in other) and any(b > c for _, b, c in other)


def test_nothing_is_capped():
    long = "$" + "x + " * 200 + "y$"
    deep = "\\textbf{\\emph{\\textit{\\underline{\\textsc{deep}}}}} {plain}"
    assert kinds("Here " + long + " holds.") == {"formula": 1}
    assert m.render(m.parse(deep).nodes) == "deep {plain}"
    assert kinds("998. a\n999. b\n1000. c\n1001. d") == {"list_item": 4}
    assert kinds("The study was done in\n2019. It went on.") == {}
    page = "<h2>A</h2><p>text</p>"
    for _ in range(6):
        page = page.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert kinds(page) == {"heading": 1}
    assert kinds("x $5 and " * 60_000) == {}


def test_long_code_drops_no_text():
    body = "<div><p>Short text here.</p></div><pre>" + "x = y ** 2, z;\n" * 5000 + "</pre>"
    assert [n.kind for n in m.select_content(m.parse(body).nodes)] == ["paragraph", "code_block"]


def test_long_document_is_parsed_whole():
    body = "\n\n".join(f"## H{i}\n\nText {i} with words.\n\n- item $x_{i}$" for i in range(20_000))
    assert kinds(body) == {"heading": 20_000, "list_item": 20_000, "formula": 20_000}


def test_rows(spark):
    df = spark.createDataFrame([(1, "## A\n\n- b", 9), (2, None, 9), (3, "plain", 9), (1, "## A\n\n- b", 9), (4, "", 9)], "id long, body string, seq int")
    want = [(1, "any", 0), (1, "heading", 1), (1, "list_item", 1)]
    assert rows(m.element_rows(m.cleaned(df))) == sorted(want * 2)
    clean = {r["id"]: r["clean_text"] for r in m.cleaned(df).collect()}
    assert clean == {1: "# A\n\n- b", 2: None, 3: "plain", 4: ""}
    assert m.element_rows(m.cleaned(df.limit(0))).count() == 0
