"""Result pages of every shape."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from citeweave.functions.html import (
    PORTION,
    ROW,
    Selector,
    _cut_rows,
    _unescape,
    element_text,
    expanded_text,
    page_rows,
    row_abstract,
    row_ident,
    row_title,
    start_tag,
)
from citeweave.plans.collect import collect_pages, result_rows
from citeweave.schemas import PAPERS

BUTTON = '<button class="more-toggle"><span class="cl-button__label">{}</span></button>'

PAGE = f"""<html><head><!-- <div class="cl-paper-row">no row</div> -->
<script>document.write('<div class="cl-paper-row"><h2 class="cl-paper-title" id="x-9">no</h2></div>')</script></head><body>
<div class="cl-paper-rows">not this one</div>
<div data-paper-id="1" class="search cl-paper-row serp"><h2 class='big cl-paper-title' id="paper-link-1"><span>Graphs &amp; <b>trees</b>
</span></h2><div><div class="tldr"><span>Short &lt;text&gt;.</span> <i>More</i></div>{BUTTON.format("Collapse")}</div></div>
<DIV class=cl-paper-row><div class="t"><span>Abstract</span><br><!-- c --><span> Long text. </span>{BUTTON.format("Collapse")}</div>
<h2 class="cl-paper-title" id="paper-2">Second</h2></DIV>
<div class="cl-paper-row"><h2 class="other">no title</h2>{BUTTON.format("Expand")}</div>
<div class="cl-paper-row"><h2 class="cl-paper-title" id="nodash">Bad id</h2></div>
<div class="cl-paper-row"><h2 class="cl-paper-title"></h2></div>
<footer>end</footer></body></html>"""


def test_rows_titles_and_abstracts(frame):
    pages = frame([("ai", 1, PAGE), ("ai", 2, "<html>nothing</html>"), ("ai", 3, None)], "term string, page long, html string")
    rows = page_rows(pages, carry=("term", "page")).select(
        "page",
        "item",
        row_title(F.col("row_html")).alias("title"),
        row_ident(F.col("row_html")).alias("ss_id"),
        row_abstract(F.col("row_html")).alias("abstract"),
    )
    assert [tuple(row) for row in rows.orderBy("page", "item").collect()] == [
        (1, 0, "Graphs & trees", "link-1", "Short <text>.More"),
        (1, 1, "Second", "2", "Long text."),
        (1, 2, "No title available", "No ID available", "No abstract available"),
        (1, 3, "Bad id", None, "No abstract available"),
        (1, 4, "No title available", "No ID available", "No abstract available"),
    ]


def test_rows_end_with_their_element(frame):
    """Nested rows, a footer's label, rows that are not ended, stray end tags, void elements, other tags of a row's name."""
    row = '<div class="cl-paper-row">'
    label = BUTTON.format("Collapse")
    pages = {
        "footer": f"<body>{row}<p>a<br>b</p></div>{row}<b>c</b></div><footer><div>d</div>{label}</footer></body>",
        "nested": f"{row}x<div>y{row}z</div></div>{label}</div>w",
        "open": f"<section>{row}a<div>b</section>{row}c",
        "stray": f"</div>{row}</p></span>a</div></div>b",
        "void": f'{row}<img src="/div"><input>a</div>b',
        "none": "<div>nothing</div>",
    }
    rows = page_rows(frame(list(pages.items()), "name string, html string"), carry=("name",)).collect()
    found = {name: [r["row_html"] for r in sorted(rows, key=lambda r: r["item"]) if r["name"] == name] for name in pages}
    assert found == {
        "footer": [f"{row}<p>a<br>b</p></div>", f"{row}<b>c</b></div>"],
        "nested": [f"{row}x<div>y{row}z</div></div>{label}</div>", f"{row}z</div>"],
        "open": [f"{row}a<div>b", f"{row}c"],
        "stray": [f"{row}</p></span>a</div>"],
        "void": [f'{row}<img src="/div"><input>a</div>'],
        "none": [],
    }


def test_expanded_text_by_hand():
    collapse = BUTTON.format("Collapse")
    assert expanded_text(None) is None
    assert expanded_text("<p>plain</p>") is None
    assert expanded_text(f"<div><div> a <b> b </b></div>{collapse}</div>") == "ab"
    assert expanded_text(f"<div><span> a </span>{collapse}</div>") == "aCollapse"
    # The last label counts, and a label with other text does not.
    both = f"<div><div>first</div>{collapse}</div><div><div>second</div>{collapse}</div>{BUTTON.format('Collapse all')}"
    assert expanded_text(both) == "second"
    assert expanded_text(f"<div><div>x<script>y</script>&eacute;</div>{collapse}</div>") == "xé"


def test_plain_selectors(frame):
    pages = frame([("<h1 id=a>A&nbsp;&quot;b&quot;</h1><h1>C</h1>",), ("<h12>no</h12>",), ("<h1></h1>",)], "html string")
    titles = [row["t"] for row in pages.select(element_text(F.col("html"), Selector("h1")).alias("t")).collect()]
    assert titles == ['A "b"', None, None]


def test_collect_inserts_or_ignores(frame, spark, staging):
    pages = frame([("deep%20nets", 1, PAGE), ("graphs", 1, PAGE)], "term string, page long, html string")
    terms = frame([(0, "graphs"), (1, "deep nets")], "term_pos long, term string")
    known = frame([(7, "link-1", "kept", "kept", "old", 0, None, True)], PAPERS)
    fresh, rejects = collect_pages(pages, terms, known, "/paper/", staging)
    rows = fresh.orderBy("id").collect()
    assert [(r["id"], r["ss_id"], r["search_term"], r["url"], r["num_hops"], r["is_processed"]) for r in rows] == [
        (8, "2", "graphs", "/paper/2", 0, False),
        (9, "No ID available", "graphs", "/paper/No ID available", 0, False),
    ]
    assert all(r["problem"] == "no id" for r in rejects.collect())
    resumed = collect_pages(pages, terms, known, "/paper/", staging, resume=("graphs", 1, 1))[0].orderBy("id").collect()
    assert [(r["ss_id"], r["search_term"]) for r in resumed] == [("No ID available", "graphs"), ("2", "deep nets")]
    assert result_rows(pages, "/p/").count() == 10


def test_a_batch_of_pages_is_held_as_python_texts_in_portions():
    row = '<div class="cl-paper-row"><h2>' + "中" * 10_000 + "</h2></div>"
    pages = pa.array([row * 2, None, "<p></p>"] * 400)
    tracemalloc.start()
    rows = _cut_rows(pages, start_tag(ROW), ROW.tag)
    texts = _unescape(rows.flatten())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.to_pylist()[:3] == [[row, row], None, []] and texts[799].as_py() == row
    # All of them would take 16 MB as texts, and as much again as rows.
    assert peak < 10 * PORTION
