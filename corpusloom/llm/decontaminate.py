"""Benchmark decontamination: words of documents that occur in a benchmark, by n-grams (DataFrame functions only).

Words are lower-cased in A-Z and taken between ASCII characters that are neither letters nor digits. A window is ``GRAM``
(10) words in a row of an item; an item of fewer words, but not none, is one window. Documents are scanned where
they lie. Wherever a window of ten words lies, it covers five words from a place that six divides, so these places alone
are hashed and meet the broadcast set of such parts of windows (anchors); other lengths, at most ten in all, have steps of their own. Where an anchor is met,
the window that it would be of is hashed whole and meets the set of window hashes. What meets is verified word by word against the windows,
and the verified places of a document become spans of words.

Nothing of a document is shuffled but its verified places. The set is broadcast while the windows' words are known to have
``BROADCAST_BYTES`` or less (counted first); beyond that Spark joins by shuffles of hashes, with the same result.

Defined results: a null or wordless text has no words and no hits; items without words have no windows; an item of several
rows, or a repeated one, has the windows of all of them and counts once; items with a null id make hits, but are neither listed
nor counted; repeated documents are answered each; empty tables give no hits, or no rows; other columns of the
documents pass through ``remove_spans`` and ``remove_documents``, whatever their names, those of the benchmark are not read.
A document's places are brought together in one row, as its text is.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

GRAM = 10
#: Fixed value: what words are made of, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What lies between them.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of windows, words and items counted, that are broadcast at most.
BROADCAST_BYTES = 64 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), APART, -1), "")


def anchor_of(n: int) -> tuple[int, int]:
    """Words of an anchor and steps between the places asked, so that each window of ``n`` words covers one anchor there."""
    width = n if n <= 3 else (n + 1) // 2
    return width, n - width + 1


def windows_of(benchmark: DataFrame, gram: int = GRAM) -> DataFrame:
    """``hash, window (words), n, items (sorted ids)`` of every distinct window of ``benchmark(item_id, text)``."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words")).filter("n > 0")
    width = F.least("n", F.lit(gram))
    starts = items.withColumn("width", width).select("item_id", "words", "width", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("width") + 1)).alias("at"))
    cut = starts.select("item_id", F.slice("words", F.col("at"), F.col("width")).alias("window"), F.col("width").alias("n"))
    return cut.groupBy("window", "n").agg(F.array_sort(F.collect_set("item_id")).alias("items")).select(
        F.xxhash64("window").alias("hash"), "window", "n", "items"
    )


def text_key(text: Column) -> Column:
    """Rows of one id are told apart by their text."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def find_hits(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text_key, spans, n_hit, items`` of the distinct (id, text) of ``docs`` that have a hit.

    ``spans`` is an array of ``start, stop`` in words, from 0, apart from each other; ``items`` the sorted ids of the items met.
    """
    windows = stage(windows_of(benchmark, gram), "benchmark-windows")
    # A window's own row, and at most as many anchors as it has words.
    size = F.octet_length(F.array_join("window", " ")) + 16 * F.col("n") + 16 * F.size("items") + 64 + 64 * F.col("n")
    known = windows.agg(F.sum(size).alias("bytes"), F.array_sort(F.collect_set("n")).alias("lengths")).first()
    # At most ``gram`` lengths; a table without windows has none, and no place is asked.
    lengths = known["lengths"]
    small = (known["bytes"] or 0) <= broadcast_bytes

    def sent(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if small else side

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words_of(F.col("text")).alias("words"))
    kinds = [F.struct(*[F.lit(x).alias(c) for c, x in zip(("n", "width", "step"), (n, *anchor_of(n)))]) for n in lengths]
    kinds = F.array(*kinds) if kinds else F.array().cast("array<struct<n:int,width:int,step:int>>")
    places = rows.select("doc_id", "text_key", "words", F.size("words").alias("n_words"))
    if len(lengths) == 1:
        places = places.select("*", *[F.lit(x).alias(c) for c, x in zip(("n", "width", "step"), (lengths[0], *anchor_of(lengths[0])))])
    else:
        places = places.select("*", F.inline(kinds))
    asked = F.when(F.col("n_words") >= F.col("n"), F.sequence(F.lit(0), F.col("n_words") - F.col("width"), F.col("step")))
    places = places.withColumn("at", F.explode(asked))
    anchored = places.withColumn("anchor", F.xxhash64(F.slice("words", F.col("at") + 1, F.col("width")), "n"))
    kind = F.element_at(F.filter(kinds, lambda k: k["n"] == F.col("n")), 1)
    shifts = windows.select("window", "n", kind.alias("kind")).select("window", "n", "kind.width", F.explode(F.sequence(F.lit(0), F.col("kind.step") - 1)).alias("shift"))
    anchors = shifts.groupBy(F.xxhash64(F.slice("window", F.col("shift") + 1, F.col("width")), "n").alias("anchor")).agg(F.collect_set("shift").alias("shifts"))
    anchors = stage(anchors, "benchmark-anchors")
    near = anchored.join(sent(anchors), "anchor").withColumn("place", F.explode(F.transform("shifts", lambda shift: F.col("at") - shift)))
    whole = (F.col("place") >= 0) & (F.col("place") + F.col("n") <= F.col("n_words"))
    cut = F.slice("words", F.col("place") + 1, F.col("n"))
    hashed = near.filter(whole).withColumn("hash", F.xxhash64(cut))
    hashes = windows.select("hash").distinct()
    met = hashed.join(sent(hashes), "hash").select("doc_id", "text_key", "place", "n", "hash", cut.alias("window"))
    verified = met.join(sent(windows.select("hash", "window", "items")), ["hash", "window"])
    spot = F.struct(F.col("place").cast("long").alias("start"), (F.col("place") + F.col("n")).cast("long").alias("stop"))
    grouped = verified.groupBy("doc_id", "text_key").agg(F.collect_set(spot).alias("spots"), F.collect_set("items").alias("lists"))
    words_hit = F.flatten(F.transform("spots", lambda s: F.sequence(s["start"], s["stop"] - 1)))
    covered = grouped.select("doc_id", "text_key", F.array_sort(F.array_distinct(words_hit)).alias("covered"), "lists")
    # A span starts at a word whose neighbour before is not hit, and stops after one whose neighbour behind is not.
    opens = F.filter("covered", lambda word, i: (i == 0) | (F.get("covered", i - 1) != word - 1))
    closes = F.transform(F.filter("covered", lambda word, i: (i == F.size("covered") - 1) | (F.get("covered", i + 1) != word + 1)), lambda word: word + 1)
    return covered.select(
        "doc_id", "text_key", F.arrays_zip(opens.alias("start"), closes.alias("stop")).alias("spans"),
        F.size("covered").cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"),
    )


def judge_documents(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, contaminated`` of every row of ``docs``."""
    hits = find_hits(docs, benchmark, gram, broadcast_bytes).withColumnRenamed("doc_id", "hit_id").withColumnRenamed("text_key", "hit_key")
    rows = docs.select("doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), text_key(F.col("text")).alias("text_key"))
    joined = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    none = F.array().cast(hits.schema["items"].dataType)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    spans = F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), spans.alias("spans"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated"))


def _with_hits(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    aside = docs.toDF(*[c if c in ("doc_id", "text") else f"in_{i}" for i, c in enumerate(docs.columns)])
    keyed = aside.withColumn("text_key", text_key(F.col("text")))
    renamed = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "spans")
    return keyed.join(renamed, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), how)


def remove_documents(docs: DataFrame, benchmark: DataFrame, share: float = 0.0, gram: int = GRAM) -> DataFrame:
    """``docs`` without those of which more than ``share`` of the words are hit."""
    hits = find_hits(docs, benchmark, gram)
    aside = [c if c in ("doc_id", "text") else f"in_{i}" for i, c in enumerate(docs.columns)]
    joined = _with_hits(docs, hits, "left")
    covered = F.aggregate(F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType)), F.lit(0).cast("long"), lambda sum, s: sum + s["stop"] - s["start"])
    return joined.filter(covered <= share * F.size(words_of(F.col("text")))).select(*aside).toDF(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM) -> DataFrame:
    """``docs`` whose texts lost the characters from the first to the last word of each span. Other texts, and null, stay as they are."""
    hits = find_hits(docs, benchmark, gram)
    aside = [c if c in ("doc_id", "text") else f"in_{i}" for i, c in enumerate(docs.columns)]
    # Parts between words and words take turns, the first part and the last maybe empty.
    cased = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts, words = F.split("text", cased, -1), F.regexp_extract_all("text", F.lit(cased), F.lit(0))
    joined = _with_hits(docs, hits, "left").withColumn("parts", F.when(F.col("spans").isNotNull(), parts)).withColumn("words", F.when(F.col("spans").isNotNull(), words))
    bounds = F.concat(
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"))),
        F.col("spans"),
        F.array(F.struct(F.size("words").cast("long").alias("start"), F.size("words").cast("long").alias("stop"))),
    )
    # Between two spans: the parts around the words from one's stop to the other's start.
    between = F.transform(
        F.sequence(F.lit(1), F.size("spans") + 1),
        lambda i: F.array_join(F.flatten(F.transform(
            F.sequence(F.element_at("bounds", i)["stop"], F.element_at("bounds", i + 1)["start"]),
            lambda j: F.when(j < F.element_at("bounds", i + 1)["start"], F.array(F.element_at("parts", (j + 1).cast("int")), F.element_at("words", (j + 1).cast("int"))))
            .otherwise(F.array(F.element_at("parts", (j + 1).cast("int")))),
        )), ""),
    )
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join("between", ""))
    cleaned = joined.withColumn("bounds", F.when(F.col("spans").isNotNull(), bounds)).withColumn("between", F.when(F.col("spans").isNotNull(), between))
    return cleaned.withColumn("text", text).select(*aside).toDF(*docs.columns)
