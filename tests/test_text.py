import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as rules

# The markers and patterns of the rules.
MARKERS = ["\n-- \n", "\n--\n"]
EMAIL = r"[\w.\-+]+@[\w.\-]+\.\w+"
URL = r"https?://\S+|ftp://\S+|www\.\S+"


def plain_clean(text):
    """The rules in plain Python, for comparison."""
    head, gap, rest = text.partition("\n\n")
    text = rest if gap else head
    for marker in MARKERS:
        text = text.partition(marker)[0]
    text = "\n".join(line for line in text.split("\n") if line.strip()[:1] not in (">", "|"))
    for pattern in (EMAIL, "<[^>]+>", URL):
        text = re.sub(pattern, "", text)
    text = "".join(filter(str.isascii, text))
    text = re.sub("\n\n\n+", "\n\n", text)
    return "\n".join(map(str.rstrip, text.split("\n"))).strip()


EDGES = {
    "no blank line": ("only a body", "only a body"),
    "blank line first": ("\n\nbody", "body"),
    "two markers": ("h\n\na\n-- \nb\n-- \nc", "a"),
    "short marker after long": ("h\n\na\n--\nb\n-- \nc", "a"),
    "marker in header": ("h\n-- \nx\n\nbody", "body"),
    "quote after blanks": ("h\n\n \t> q\nkept", "kept"),
    "table line": ("h\n\n| a | b |\nkept", "kept"),
    "only quotes": ("h\n\n> a\n> b", ""),
    "quote last": ("h\n\na\n> b", "a"),
    "email in tag": ("h\n\nx <a@b.c> y", "x <> y"),
    "unclosed tag": ("h\n\na < b < c", "a < b < c"),
    "closed then unclosed": ("h\n\na <b> c <d", "a  c <d"),
    "tag across lines": ("h\n\na <b\nc> d", "a  d"),
    "url at end": ("h\n\nsee http://x.y/z", "see"),
    "unicode blank before quote": ("h\n\n\u2003\xa0> q\nkept", "kept"),
    "accent in email": ("h\n\nto josé.pérez@exämple.com now", "to  now"),
    "two emails touching": ("h\n\na@b.cd+x@y.z!", "!"),
    "blanks between newlines": ("h\n\na\n \n \nb", "a\n\n\nb"),
    "many newlines": ("h\n\na\n\n\n\nb", "a\n\nb"),
    "only blanks": ("h\n\n \t\n ", ""),
    "empty": ("", ""),
    "trailing blanks": ("h\n\na \t\nb\x1f", "a\nb"),
}


@pytest.mark.parametrize("name", EDGES)
def test_edges_agree_with_plain_rules(name):
    text, expected = EDGES[name]
    assert plain_clean(text) == expected


def clean_all(spark, texts):
    """The cleaned texts, both as one expression and rule by rule."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").orderBy("i")
    one = [r[0] for r in rows.select(rules.clean_text(F.col("text"))).collect()]
    assert [r.cleaned_text for r in rules.add_cleaned_text(rows).collect()] == one
    return one


def test_edge_rows(spark):
    texts = [text for text, _ in EDGES.values()]
    assert clean_all(spark, texts) == [expected for _, expected in EDGES.values()]


def test_null_text_stays_null(spark):
    assert clean_all(spark, [None]) == [None]


def random_texts(n, seed):
    pieces = [
        "\n", "\n\n", "\n\n\n", " ", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", ">", "|", "<", ">",
        "@", ".", "-", "+", "_", "--", "-- ", "\n-- \n", "\n--\n", "http://", "https://", "ftp://", "www.", "a", "b1", "é",
        "\u0301", "中", "\U0001f600", "x@y.z", "<p>", "</p>", ",", "Newsgroups: a,b", "From:", "w", "h", "f",
    ]
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(n)]


def test_random_texts(spark):
    texts = random_texts(5000, seed=7)
    assert clean_all(spark, texts) == [plain_clean(t) for t in texts]


def plain_features(text):
    head, gap, rest = text.partition("\n\n")
    header, body = (head, rest) if gap else ("", text)
    groups = re.search(r"Newsgroups:\s*(.+)", header)
    return (
        sum(line.strip().startswith(">") for line in text.split("\n")),
        any(marker in text for marker in MARKERS),
        sum(not c.isascii() for c in text),
        groups.group(1).count(",") + 1 if groups else 1,
        len(body.strip()),
        re.search(r"<[a-zA-Z][^>]*>", text) is not None,
        len(re.findall(r"[\w.-]+@[\w.-]+", body)),
    )


def test_random_features(spark):
    texts = random_texts(5000, seed=11)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    text = F.col("text")
    found = rows.orderBy("i").select(
        rules.quoted_line_count(text),
        rules.has_signature(text),
        rules.non_ascii_count(text),
        rules.newsgroup_count(text),
        F.length(rules.strip_blanks(rules.strip_headers(text))),
        rules.has_html_tag(text),
        rules.email_count(rules.strip_headers(text)),
    )
    assert [tuple(r) for r in found.collect()] == [plain_features(t) for t in texts]


@pytest.mark.parametrize("unit", ["<", "a", " ", "a@", "\n", "<a", "\n>", "h", "www", "@", "a.", "\n "])
def test_long_runs_are_linear(spark, unit):
    repeats = 400_000 // len(unit)
    one = spark.range(repeats, repeats + 1).select(F.repeat(F.lit(unit), F.col("id").cast("int")).alias("text"))
    assert rules.add_cleaned_text(one).agg(F.max(F.length("cleaned_text"))).first()[0] >= 0
    out = one.select(
        F.length(rules.clean_text(F.col("text"))), rules.has_html_tag(F.col("text")), rules.email_count(F.col("text"))
    )
    assert len(out.collect()) == 1


def test_newlines(spark):
    row = spark.range(1).select(rules.normalize_newlines(F.lit("a\r\nb\rc\n")))
    assert row.first()[0] == "a\nb\nc\n"


def test_cleaning_needs_no_python_and_keeps_codegen(spark):
    posts = spark.range(1).select(F.col("id").cast("string").alias("text"))
    for plan in (posts.select(rules.clean_text(F.col("text"))), rules.add_cleaned_text(posts).select("cleaned_text")):
        text = plan._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        )
        assert "Python" not in text and "Found 1 WholeStageCodegen" in text
