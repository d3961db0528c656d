"""Column functions against their Python counterparts."""

from urllib.parse import quote, unquote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.functions.text import clean_affixes, id_after_dash, item_url, or_default, search_url, strip, url_quote, url_unquote

TEXTS = [
    "",
    " ",
    "machine learning",
    "C++/C# & co",
    "a~b*c(d)!'",
    "naïve – 日本語",
    "100% + 5%zz %41%",
    "%E4%BD%A0%e5%a5%bd",
    "  title　\n",
    "\x1ctab\t\x0b\x85",
    "Abstract  We show\nCollapse",
    "AbstractCollapse",
    "abstract lower",
    "Abstract Abstract twice Collapse Collapse",
    "Collapse",
    "paper-12-34",
    "no dash",
    "-",
]


def python_clean(text):
    if text.startswith("Abstract"):
        text = text.removeprefix("Abstract").strip()
    if text.endswith("Collapse"):
        text = text.removesuffix("Collapse").strip()
    return text


CASES = [
    (strip, str.strip),
    (url_quote, quote),
    (url_unquote, unquote),
    (lambda c: clean_affixes(c, "Abstract", "Collapse"), python_clean),
    (id_after_dash, lambda s: s.split("-", 1)[1] if "-" in s else None),
    (lambda c: or_default(c, "abstract"), lambda s: s or "No abstract available"),
]


@pytest.mark.parametrize("column, python", CASES, ids=["strip", "quote", "unquote", "clean", "dash", "default"])
def test_listed_texts(frame, column, python):
    rows = frame([(t,) for t in TEXTS], "t string").select("t", column(F.col("t")).alias("r")).collect()
    assert {row["t"]: row["r"] for row in rows} == {t: python(t) for t in TEXTS}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=40))
def test_any_texts(frame, texts):
    df = frame([(t,) for t in texts], "t string")
    rows = df.select("t", *[column(F.col("t")).alias(f"c{i}") for i, (column, _) in enumerate(CASES)]).collect()
    for row in rows:
        for i, (_, python) in enumerate(CASES):
            assert row[f"c{i}"] == python(row["t"]), (i, row["t"])


def test_nulls_and_urls(frame):
    row = frame([(None, "a%20b", 3)], "t string, q string, page int").select(
        or_default(F.col("t"), "title").alias("d"),
        strip(F.col("t")).alias("s"),
        item_url("https://x.example/", F.col("q")).alias("u"),
        search_url("https://x.example/?q=", F.col("q"), F.col("page")).alias("p"),
    ).first()
    assert tuple(row) == ("No title available", None, "https://x.example/a%20b", "https://x.example/?q=a%20b&page=3")
