"""Chat formatting, URL rules and sharding: results, and plans without Python."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import chat, feistel, queries, url_rules

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_url_rules", "op10_feistel_shards", "op13_decontaminate"])
def test_no_python_in_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|NestedLoop", plan)


def made_turns():
    draw = random.Random(3)
    pieces = ["</s>", "<s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "\\", "<", "[", "/s>", "s>", "x", "\n", "é", "$1", " "]
    rows = []
    for conv in range(40):
        for turn in range(draw.randint(1, 7)):
            role = draw.choice(["user", "assistant", "assistant", "system", None, "odd</s>[INST]"])
            rows.append((conv, turn, role, draw.choice([None, "", "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))])))
    return rows + [(None, 0, "user", "a"), (None, None, "assistant", "b"), (3, 0, "user", "again"), (3, 0, "user", "again"), (99, 1, "assistant", "y" * 30000)]


def test_chat_round_trip(spark):
    rows = made_turns()
    turns = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, at int").repartition(4)
    formatted = chat.format_conversations(turns)
    read = formatted.select("*", chat.read_turns(F.col("formatted")).alias("read"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    assert got.keys() == {r[0] for r in rows}
    for conv, row in got.items():
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t.role, t.text) for t in row.read] == [(r, x) for _, _, r, x in own]
        assert list(row.loss) == [x for _, _, r, x in own if r == "assistant"]
        merged = 1 + sum(a[2] != b[2] for a, b in zip(own, own[1:]))
        assert row.formatted.count("</s>") == merged and row.formatted.count("[/INST]") == len(own) - merged
    assert chat.format_conversations(turns.limit(0)).collect() == []
    with pytest.raises(ValueError):
        chat.format_conversations(turns, ("a[INST]",))


URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/x", "http://example.org", "http://a.b.example.org/en/123?x", "http://xexample.org/en/1",
    "http://a.com/fr/1#f", "http://com/de/", "http://b.com/DE/", "http://m.x.net/en/1", "http://x.net/tag/a", "http://x.net/tag/a/b", "x://y.net/login",
    "http://blog.q.net/en/120", "http://q.net/en/120", "http://a://b.org/", "http://example.org\n/es/", "http://É.org/", "http://x.net/login\n",
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    sites = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    fit = [r for r in sites if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
    if fit:
        return host, path, max(fit, key=len), sites[max(fit, key=len)]
    patterns = [r"/tag/[^/]+/?\Z", r"/login(/|\.|\Z)", r"^([^/]*\.)?blog\.[^/]*/[a-z]{2}/[0-9]*0\Z", r"^m\.[^/]*/"]
    return host, path, None, "block" if any(re.search(p, host + path) for p in patterns) else "allow"


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[4]), (None, URLS[5])]
    pages = spark.createDataFrame([(*r, "h", "v", 1) for r in rows], "page_id long, url string, host string, verdict string, rule int")
    judged = url_rules.judge_urls(pages, [*url_rules.SITES, *url_rules.PATTERNS]).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule if (r.rule_rank or 0) >= url_rules.SITE_RANK else None, r.verdict) for r in judged), key=str)
    assert got == sorted(((i, *plain_verdict(u)) for i, u in rows), key=str)
    assert url_rules.judge_urls(pages.limit(0), list(url_rules.SITES)).collect() == []
    assert {r.verdict for r in url_rules.judge_urls(pages, [], default="block").collect()} == {"block"}


def test_rules_lie_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://a{i}.example.org/es/{i}") for i in range(9)] + [(9, "http://es.net/"), (10, "http://b.com/de/")], "page_id long, url string")
    rules = [*url_rules.SITES, url_rules.pattern_rule("block", "any", "zzz")]
    _, _ = url_rules.url_parts(F.col("url"))
    index = {rule.name: token for token, rule in url_rules.rule_index(rules, {"example": 9, "org": 9, "es": 10, "en": 0, "com": 1, "fr": 0, "de": 1})}
    assert index == {"example.org/es/": "example", "example.org/en/1": "en", "org/": "org", "com/fr/": "fr", "com/de/": "com", "any": ""}
    candidates = {r.page_id: r.n_candidates for r in url_rules.judge_urls(pages, rules).collect()}
    assert candidates[9] <= 2 and candidates[0] <= 4


def test_many_rules(spark):
    """Ten thousand rules: planned in seconds, and the same verdicts as with the rules that fit alone."""
    rules = [url_rules.site_rule("block", f"host{i}.example.org", f"/p{i % 7}/") for i in range(9_990)]
    rules += [url_rules.pattern_rule("allow", f"pattern {i}", rf"/x{i}\.[a-z]+\z", f"x{i}") for i in range(10)]
    urls = [f"http://www.host{i}.example.org/p{i % 9}/{i}" for i in range(0, 20_000, 400)] + [f"http://b.net/x{i}.html" for i in range(12)] + [None, "http://" + "a" * 30_000 + "/x1.html"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    start = time.perf_counter()
    judged = url_rules.judge_urls(pages, rules, "none")
    judged._jdf.queryExecution().executedPlan().toString()
    # Counting the tokens included; a literal for each rule took minutes.
    assert time.perf_counter() - start < 40
    got = {r.page_id: (r.rule, r.verdict, r.n_candidates) for r in judged.collect()}
    plain = [(r, re.compile(r.pattern.replace(r"\z", r"\Z"))) for r in rules]
    for page, url in enumerate(urls):
        host, path, _, _ = plain_verdict(url)
        fit = [r for r, compiled in plain if compiled.search(host + path)]
        best = max(fit, key=lambda r: (r.rank, r.name), default=None)
        assert got[page][:2] == ((best.name, best.verdict) if best else (None, "none")) and got[page][2] < 5


@pytest.mark.parametrize("n", [0, 1, 2, 3, 41, 1000, 4097])
def test_permutation(spark, n):
    places = [r[0] for r in spark.range(n).select(feistel.permute(F.col("id"), n, 11)).collect()]
    assert sorted(places) == list(range(n))
    assert n < 41 or sum(a == b for a, b in zip(places, range(n))) < 10


def test_shards(spark):
    rows = [(i * 7, "é" * (i % 5)) for i in range(500)] + [(None, "x"), (3, None), (3, ""), (14, "éé"), (14, "éé")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, bucket int, shard int")
    got = feistel.shard_documents(docs.repartition(3)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in counts)
    assert sorted(r.row_number for r in got) == list(range(len(rows)))
    again = feistel.shard_documents(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert feistel.shard_documents(docs.limit(0)).collect() == []


def test_chat_query_digests(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = {r.conv_id: r for r in queries.op7_chat_format(spark, SF).collect()}
    added = got[-7]
    text = "</s>[INST] ok [/INST]"
    assert added.n_turns == 2 and added.loss_chars == len(text)
    assert added.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert added.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got.keys() == {r.conv_id for r in rows} | {-7}
