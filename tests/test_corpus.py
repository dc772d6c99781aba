import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import profile
from corpusloom.operators.dedup import dedup_keep_first, duplicate_counts, removed_per_step, surviving_posts
from corpusloom.plans.clean_job import clean_corpus, corpus_summary, run_clean_job
from corpusloom.sources.posts import load_posts, save_raw

BODY = "A body that is long enough to survive the length filter of the job."


def posts(spark, rows):
    return spark.createDataFrame(rows, "category string, filename string, text string")


def make_rows():
    rows = [
        ("b", "2", f"From: x\n\n{BODY}"),
        ("a", "9", f"From: x\n\n{BODY}"),
        ("a", "1", f"From: y\n\n{BODY}"),
        ("c", "1", "From: z\n\nshort"),
        ("c", "2", "From: z\n\n"),
        ("c", "3", "From: w\n\n\n"),
        ("d", "1", "h\n\n" + "x" * 49),
        ("d", "2", "h\n\n" + "x" * 50),
    ]
    return rows


def sequential(rows):
    """Drop copies, clean, drop body copies, drop short ones, one after the other."""
    from tests.test_text import plain_clean

    counts = [len(rows)]
    seen, left = set(), []
    for row in sorted(rows):
        if row[2] not in seen:
            seen.add(row[2])
            left.append(row)
    counts.append(counts[-1] - len(left))
    seen, bodies = set(), []
    for row in left:
        cleaned = plain_clean(row[2])
        if cleaned not in seen:
            seen.add(cleaned)
            bodies.append((*row, cleaned))
    counts.append(len(left) - len(bodies))
    kept = [row for row in bodies if len(row[3]) >= 50]
    return kept, (*counts, len(bodies) - len(kept), len(kept))


def test_clean_job_equals_the_steps_in_turn(spark):
    rows = make_rows()
    kept, counts = sequential(rows)
    assert sorted(map(tuple, clean_corpus(posts(spark, rows)).collect())) == sorted(kept)
    assert tuple(removed_per_step(posts(spark, rows)).first()) == counts


def test_hot_text_with_a_third_of_all_rows(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("category"),
        F.format_string("%05d", F.col("id")).alias("filename"),
        F.when(F.col("id") % 3 == 0, F.lit(f"h\n\n{BODY}")).otherwise(
            F.concat(F.lit("h\n\n"), F.lit(BODY), F.col("id").cast("string"))
        ).alias("text"),
    )
    assert clean_corpus(hot).count() == 2001
    assert clean_corpus(hot).filter("category = 'hot'").select("filename").collect() == [("00000",)]


def test_posts_that_stay_are_not_moved(spark):
    plan = clean_corpus(posts(spark, make_rows()))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert "Exchange hashpartitioning" not in physical and "BroadcastHashJoin" in physical
    assert "Python" not in physical


def test_summary_limits_before_the_shuffle(spark):
    plan = corpus_summary(posts(spark, make_rows()))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert "WindowGroupLimit" in physical[physical.index("Exchange") :] and "Partial" in physical
    assert "Python" not in physical


def test_dedup_and_duplicate_count(spark):
    df = posts(spark, make_rows())
    assert sorted(r.filename for r in dedup_keep_first(df).filter("category < 'c'").collect()) == ["1", "9"]
    keys = lambda rows: profile.post_features(posts(spark, rows), "text_key", "body_key")
    assert tuple(duplicate_counts(keys(make_rows())).first()) == (1, 2)
    assert tuple(duplicate_counts(keys([])).first()) == (0, 0)


def test_empty_table(spark):
    empty = posts(spark, [])
    assert clean_corpus(empty).count() == 0
    assert tuple(removed_per_step(empty).first()) == (0, 0, 0, 0, 0)
    values = {r.metric: r.value for r in profile.profile_all(empty).collect()}
    assert values["documents"] == 0 and values["share_with_quotes"] is None and values["exact_duplicates"] == 0


def test_null_text(spark):
    rows = make_rows() + [("n", "1", None), ("n", "2", None)]
    assert clean_corpus(posts(spark, rows)).filter("category = 'n'").count() == 0
    assert removed_per_step(posts(spark, rows)).first()["loaded"] == len(rows)


def test_summary(spark):
    row = corpus_summary(posts(spark, make_rows())).first()
    assert (row.documents, row.categories, row.min_length) == (2, 2, 50)
    assert set(surviving_posts(posts(spark, make_rows())).columns) >= {"cleaned_text", "cleaned_len"}


def test_profile_figures(spark):
    rows = [
        ("a", "1", "From: x\nNewsgroups: a,b, c\nLines: 3\n\n> q\n | t\nbody x@y"),
        ("a", "2", "no blank line <B> base64 BASE64"),
        ("b", "1", "Newsgroups:\nContent-Type: t\n\nbody é\n-- \nsig"),
    ]
    values = {r.metric: r.value for r in profile.profile_all(posts(spark, rows)).collect()}
    assert values["documents"] == 3
    assert values["posts_has_from"] == 1 and values["posts_has_newsgroups"] == 2 and values["posts_has_lines"] == 1
    assert values["posts_with_quotes"] == 1 and values["max_quoted_lines"] == 1
    assert values["posts_with_signature"] == 1 and values["posts_with_html"] == 1
    assert values["posts_with_mime"] == 1 and values["posts_with_base64"] == 1
    assert values["cross_posted"] == 1 and values["max_newsgroups"] == 3
    assert values["posts_with_non_ascii"] == 1 and values["posts_with_emails"] == 1
    assert values["median_length"] == sorted(len(r[2]) for r in rows)[1]
    for part in profile.FIGURES:
        one = profile.profile_part(posts(spark, rows), part).first().asDict()
        assert {k: float(v) for k, v in one.items()} == {k: values[k] for k in one}


def test_categories(spark):
    df = posts(spark, make_rows())
    assert [tuple(r) for r in profile.docs_per_category(df).collect()] == [("c", 3), ("a", 2), ("d", 2), ("b", 1)]
    assert tuple(profile.load_totals(df).first()) == (8, 4)
    assert profile.first_document(df, n=7).first()["sample"] == "From: y"


@pytest.fixture
def tree(tmp_path):
    for category, name, content in [
        ("alt.atheism", "51060", f"From: a\r\n\r\n{BODY}\r\n".encode()),
        ("alt.atheism", "51 061", b"From: a\r\rcaf\xe9 " + b"y" * 60),
        ("sci.space", "7", f"From: b\n\n{BODY}\n".encode()),
    ]:
        os.makedirs(tmp_path / "raw" / category, exist_ok=True)
        (tmp_path / "raw" / category / name).write_bytes(content)
    (tmp_path / "raw" / "stray.txt").write_text("not in a category")
    return tmp_path


def test_load_posts(spark, tree):
    rows = {(r.category, r.filename): r.text for r in load_posts(spark, str(tree / "raw")).collect()}
    assert rows[("alt.atheism", "51060")] == f"From: a\n\n{BODY}\n"
    assert rows[("alt.atheism", "51 061")] == "From: a\n\ncafé " + "y" * 60
    assert len(rows) == 3


def test_clean_job_writes_both_forms(spark, tree):
    out = str(tree / "cleaned"), str(tree / "json")
    counts = run_clean_job(spark, str(tree / "raw"), *out).first()
    assert (counts.loaded, counts.body_duplicates, counts.remaining) == (3, 1, 2)
    saved = spark.read.parquet(out[0])
    assert saved.columns == ["category", "filename", "text", "cleaned_text"] and saved.count() == 2
    lines = spark.read.json(out[1])
    assert set(lines.columns) == {"category", "filename", "cleaned_text"} and lines.count() == 2
    save_raw(load_posts(spark, str(tree / "raw")), str(tree / "raw-table"))
    assert spark.read.parquet(str(tree / "raw-table")).count() == 3


def test_many_small_posts_take_few_tasks(spark, tmp_path):
    """Tasks read as many posts as they can hold, not 32 each, and what Spark's own reader gives."""
    from corpusloom.sources.posts import _load_by_spark

    names = ["plain", "two words", "50%25", "a=b", "_a=b", "_metadata1", "_hidden", ".hidden", "x._COPYING_", "é"]
    for category in ["c1", "c 2%", "_c=3", "_c4", ".c5", "empty", "_metadata"]:
        (tmp_path / category / "deep").mkdir(parents=True)
        (tmp_path / category / "deep" / "x").write_bytes(b"too deep")
        for name in names if category != "empty" else []:
            (tmp_path / category / name).write_bytes(f"{category} {name}\r\nsecond\rthird \xe9".encode("latin-1"))
    (tmp_path / "c1" / "nothing").write_bytes(b"")
    (tmp_path / "top").write_bytes(b"at the top")
    (tmp_path / "many").mkdir()
    for i in range(64 * spark.sparkContext.defaultParallelism):
        (tmp_path / "many" / f"{i}").write_bytes(b"text %d" % i)
    loaded = load_posts(spark, str(tmp_path))
    assert loaded.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    expected = sorted(map(tuple, _load_by_spark(spark, str(tmp_path), f"file:{tmp_path}").collect()))
    assert len(expected) > 64 and sorted(map(tuple, loaded.collect())) == expected
    assert sorted(map(tuple, load_posts(spark, f"file://{tmp_path}/").collect())) == expected
    some = load_posts(spark, f"{tmp_path}/../{tmp_path.name[:-1]}?")
    assert sorted(map(tuple, some.filter("category = 'c1'").collect())) == [row for row in expected if row[0] == "c1"]
