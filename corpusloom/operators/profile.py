"""Corpus quality figures.

``post_features`` reads every text once and keeps a few numbers per post; each figure is an
aggregate over those columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as rules
from corpusloom.operators.dedup import duplicate_counts
from corpusloom.session import stage

# The header keys that are counted.
HEADER_KEYS = [
    "From:",
    "Subject:",
    "Organization:",
    "Lines:",
    "Newsgroups:",
    "Path:",
    "Xref:",
    "NNTP-Posting-Host:",
    "Reply-To:",
    "Distribution:",
]


def _header_column(key: str) -> str:
    return "has_" + key.rstrip(":").lower().replace("-", "_")


def feature_columns(text: Column) -> dict[str, Column]:
    """Per-post figures by name; only the requested ones are ever computed."""
    body = rules.strip_headers(text)
    header = rules.header_part(text)
    features = {_header_column(key): F.contains(header, F.lit(key)) for key in HEADER_KEYS}
    features |= {
        "quoted_lines": rules.quoted_line_count(text),
        "has_signature": rules.has_signature(text),
        "text_len": F.length(text),
        "text_key": rules.text_digest(text),
        "body_key": rules.text_digest(body),
        "non_ascii": rules.non_ascii_count(text),
        "newsgroups": rules.newsgroup_count(text),
        "body_len": F.length(rules.strip_blanks(body)),
        "has_html": rules.has_html_tag(text),
        "has_mime": rules.has_mime_header(text),
        "has_base64": rules.mentions_base64(text),
        "emails": rules.email_count(body),
    }
    return features


def post_features(posts: DataFrame, *names: str) -> DataFrame:
    """One narrow row per post with the named figures (all by default)."""
    features = feature_columns(F.col("text"))
    return posts.select(*[features[name].alias(name) for name in names or features])


def _posts(condition: Column) -> Column:
    return F.count_if(condition)


def _share(condition: Column) -> Column:
    """Percent of posts; null on an empty table."""
    return F.try_divide(F.count_if(condition), F.count(F.lit(1))) * 100


def header_figures() -> dict[str, Column]:
    return {"posts_" + _header_column(key): _posts(F.col(_header_column(key))) for key in HEADER_KEYS}


def quote_figures() -> dict[str, Column]:
    quoted = F.col("quoted_lines")
    return {
        "posts_with_quotes": _posts(quoted > 0),
        "share_with_quotes": _share(quoted > 0),
        "mean_quoted_lines": F.avg(quoted),
        "max_quoted_lines": F.max(quoted),
        "posts_over_20_quoted_lines": _posts(quoted > 20),
    }


def signature_figures() -> dict[str, Column]:
    signed = F.col("has_signature")
    return {"posts_with_signature": _posts(signed), "share_with_signature": _share(signed)}


def length_figures() -> dict[str, Column]:
    length = F.col("text_len")
    return {
        "min_length": F.min(length),
        "max_length": F.max(length),
        "mean_length": F.avg(length),
        # Exact: the state is a count per distinct length, merged before it leaves a task.
        "median_length": F.percentile(length, 0.5),
        "empty_posts": _posts(length == 0),
        "posts_under_50": _posts(length < 50),
        "posts_under_100": _posts(length < 100),
        "posts_over_10000": _posts(length > 10000),
    }


def non_ascii_figures() -> dict[str, Column]:
    n = F.col("non_ascii")
    return {
        "posts_with_non_ascii": _posts(n > 0),
        "share_with_non_ascii": _share(n > 0),
        "posts_over_50_non_ascii": _posts(n > 50),
    }


def crosspost_figures() -> dict[str, Column]:
    n = F.col("newsgroups")
    return {"cross_posted": _posts(n > 1), "share_cross_posted": _share(n > 1), "max_newsgroups": F.max(n)}


def body_figures() -> dict[str, Column]:
    n = F.col("body_len")
    return {"empty_bodies": _posts(n == 0), "bodies_under_20": _posts(n < 20), "bodies_under_50": _posts(n < 50)}


def markup_figures() -> dict[str, Column]:
    return {
        "posts_with_html": _posts(F.col("has_html")),
        "posts_with_mime": _posts(F.col("has_mime")),
        "posts_with_base64": _posts(F.col("has_base64")),
    }


def email_figures() -> dict[str, Column]:
    n = F.col("emails")
    return {"posts_with_emails": _posts(n > 0), "share_with_emails": _share(n > 0)}


FIGURES = {
    "headers": (header_figures, [_header_column(key) for key in HEADER_KEYS]),
    "quotes": (quote_figures, ["quoted_lines"]),
    "signatures": (signature_figures, ["has_signature"]),
    "lengths": (length_figures, ["text_len"]),
    "non_ascii": (non_ascii_figures, ["non_ascii"]),
    "crossposts": (crosspost_figures, ["newsgroups"]),
    "bodies": (body_figures, ["body_len"]),
    "markup": (markup_figures, ["has_html", "has_mime", "has_base64"]),
    "emails": (email_figures, ["emails"]),
}


def profile_part(posts: DataFrame, part: str) -> DataFrame:
    """One row with the figures of one part (a key of ``FIGURES``), from one pass without a shuffle of posts."""
    figures, needed = FIGURES[part]
    return post_features(posts, *needed).agg(*[value.alias(name) for name, value in figures().items()])


def _as_rows(one_row: DataFrame) -> DataFrame:
    """``(metric, value)`` rows from the columns of a one-row frame."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    )
    return one_row.select(F.inline(pairs))


def profile_all(posts: DataFrame) -> DataFrame:
    """Every figure as ``(metric, value)`` rows.

    The texts are read once: their features go to a narrow staged table, whose columns then feed
    one plain aggregate and the counts of duplicates.
    """
    features = stage(post_features(posts), "features")
    figures = {"documents": F.count(F.lit(1))}
    for make, _ in FIGURES.values():
        figures |= make()
    plain = features.agg(*[value.alias(name) for name, value in figures.items()])
    return _as_rows(plain).unionByName(_as_rows(duplicate_counts(features)))


def docs_per_category(docs: DataFrame) -> DataFrame:
    """Documents per category, largest first, then by name."""
    return docs.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")


def load_totals(docs: DataFrame) -> DataFrame:
    """Documents and distinct categories."""
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("category").alias("categories"))


def length_summary(survivors: DataFrame) -> DataFrame:
    """Size of a cleaned corpus: needs ``category`` and ``cleaned_len``, so no text is shuffled for it."""
    return survivors.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_distinct("category").alias("categories"),
        F.avg("cleaned_len").alias("mean_length"),
        F.min("cleaned_len").alias("min_length"),
        F.max("cleaned_len").alias("max_length"),
    )


def first_document(docs: DataFrame, column: str = "text", order_by: tuple[str, ...] = ("category", "filename"), n: int = 500) -> DataFrame:
    """The first ``n`` characters of the first document: the sample shown after a run."""
    return docs.orderBy(*order_by).limit(1).select(*order_by, F.substring(column, 1, n).alias("sample"))
