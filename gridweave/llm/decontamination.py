"""Benchmark decontamination: which words of documents lie in passages of test items.

Texts become words: A-Z lower-cased, maximal runs of digits, letters a-z and characters beyond ASCII. Every ``width``
consecutive words of an item are a window; an item of fewer words is one window. The distinct windows, each with the items
that hold it, are hashed and broadcast. Documents are scanned once: their words are hashed, the hashes of windows are put
together by doubling (1, 2, 4, 8 words), and each looks itself up. Windows of equal hash are verified word by
word, so only true occurrences count. What is left, a row per document and one per occurrence, is gathered by document: no
other row is shuffled, and a passage that many documents share is a few rows of each.

The broadcast is bounded: a benchmark of more than ``BROADCAST_BYTES`` of windows is looked up in blocks by hash, one scan of the
documents for each; then documents are first written down with their row numbers.

Cases: a null text has no words and is not contaminated; nor is any document if no item has words. A text of one word or of
millions is taken whole (one text must fit a task, together with its hashes). Repeated documents, and documents of
equal or null ids, give a row each. Items of one id are one item; an item without id is named by the empty text. Repeated windows of an
item, and windows that several items share, count once a place. Empty tables give empty or clean results. Other columns,
whatever their names, take no part. Bytes that aren't UTF-8 count as U+FFFD, a word character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.spark_util import cut

WIDTH = 10
#: Bytes of windows (words, hashes and items) that are broadcast at once.
BROADCAST_BYTES = 64 << 20

#: Runs of word characters before A-Z are lower-cased.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _joined(words: Column, first: Column, n: Column) -> Column:
    """``n`` words from place ``first`` (from 0) on, A-Z lower-cased."""
    return F.translate(F.array_join(F.slice(words, (first + 1).cast("int"), n.cast("int")), " "), _UPPER, _LOWER)


def _places(n: int) -> Column:
    """How many windows of ``n`` words there are."""
    return F.greatest(F.size("words") - (n - 1), F.lit(0))


def _with_window_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """``rows`` (words, ...) with w<n>, the hashes of all windows of n words, for each n of ``lengths``.

    Words are lower-cased as a whole for the hash: that is a function of the word that joins no fewer than lower-casing A-Z,
    and verification tells the rest apart."""

    def together(df: DataFrame, p: int, q: int) -> DataFrame:
        m = _places(p + q)
        return df.withColumn(f"w{p + q}", F.zip_with(F.slice(f"w{p}", F.lit(1), m), F.slice(f"w{q}", F.lit(p + 1), m), lambda x, y: F.xxhash64(x, y)))

    out = rows.withColumn("w1", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    made = {1}
    power = 1
    while 2 * power <= max(lengths, default=1):
        out, power = together(out, power, power), 2 * power
        made.add(power)
    for n in sorted(lengths):
        have = 0
        for p in (1 << k for k in reversed(range(n.bit_length())) if n >> k & 1):
            if have and have + p not in made:
                out = together(out, have, p)
                made.add(have + p)
            have += p
    return out.drop(*(f"w{n}" for n in made - set(lengths)))


def item_windows(items: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, list[int]]:
    """The distinct windows (hash, len, window, items) and the lengths that occur (``width`` and less)."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), _words(text).alias("all_words")).where("size(all_words) > 0")
    n = F.least(F.size("all_words"), F.lit(width))
    cuts = named.select("item", n.alias("len"), "all_words", F.explode(F.sequence(F.lit(0), F.size("all_words") - n)).alias("first"))
    single = cuts.select("len", _joined(F.col("all_words"), F.col("first"), F.col("len")).alias("window"), "item").groupBy("len", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lengths = sorted(r[0] for r in named.select(n).distinct().collect())  # at most width rows
    hashed = _with_window_hashes(single.withColumn("words", F.split("window", " ")), lengths)
    own = F.coalesce(*(F.when(F.col("len") == k, F.get(f"w{k}", F.lit(0))) for k in lengths)) if lengths else F.lit(None).cast("bigint")
    return cut(hashed.select(own.alias("hash"), "len", "window", "items")), lengths


def _occurrences(rows: DataFrame, windows: DataFrame, lengths: list[int], holders: bool) -> DataFrame:
    """row and the other columns of ``rows`` (with words) with place, len, items of each occurrence; with ``holders``, also one of
    each row with nulls there. ``windows`` must fit a broadcast."""
    scanned = _with_window_hashes(rows, lengths)
    starts, total = [], F.lit(0)
    for n in lengths:
        starts.append((n, total))
        total = total + _places(n)
    every = F.concat(*(F.col(f"w{n}") for n in lengths), *([F.array(F.lit(None).cast("bigint"))] if holders else []))
    kept = [c for c in rows.columns if c != "words"]
    out = scanned.select(*kept, "words", F.posexplode(every).alias("at", "hash"))
    begin = F.coalesce(*(F.when(F.col("len") == n, at) for n, at in starts), F.lit(0))
    place = F.col("at") - begin
    true = F.col("len").isNotNull() & (place >= 0) & (_joined(F.col("words"), place, F.col("len")) == F.col("window"))
    out = out.join(F.broadcast(windows), "hash", "left" if holders else "inner")
    out = out.where((F.col("hash").isNull() | true) if holders else true)
    return out.select(*kept, F.when(F.col("len").isNotNull(), F.struct(place.alias("place"), "len")).alias("hit"), "items")


def _merged(hits: Column) -> Column:
    """Sorted (place, len) as disjoint spans (start, end) of words."""
    span = "struct<start: int, end: int>"
    empty = F.struct(F.array().cast(f"array<{span}>").alias("done"), F.lit(None).cast(span).alias("last"))

    def add(acc: Column, hit: Column) -> Column:
        own = F.struct(hit["place"].cast("int").alias("start"), (hit["place"] + hit["len"]).cast("int").alias("end"))
        longer = F.struct(acc["last"]["start"].alias("start"), F.greatest(acc["last"]["end"], own["end"]).alias("end"))
        on = acc["last"].isNotNull() & (own["start"] <= acc["last"]["end"])
        done = F.when(on | acc["last"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["last"]))
        return F.struct(done.alias("done"), F.when(on, longer).otherwise(own).alias("last"))

    return F.aggregate(F.array_sort(hits), empty, add, lambda acc: F.when(acc["last"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["last"])))


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, spans (start and end of hit words, disjoint, in order), n_hit, items (ids as texts, in order) of each document; the text too if
    it is asked for (then texts are shuffled with the documents)."""
    windows, lengths = item_windows(items, width, item_id, item_text)
    size = F.coalesce(F.sum(F.octet_length("window") + 64 + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + 16)), F.lit(0))
    blocks = max(1, -(-int(windows.agg(size).first()[0]) // BROADCAST_BYTES))
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if blocks > 1:
        keyed = cut(keyed)  # every block sees the same row numbers
    rows = keyed.select("row", "doc_id", *["text"] * with_text, _words("text").alias("words")).withColumn("n_words", F.size("words").cast("bigint"))
    found = _occurrences(rows, windows.where(F.pmod("hash", F.lit(blocks)) == 0) if blocks > 1 else windows, lengths, True)
    for k in range(1, blocks):
        part = cut(_occurrences(rows.select("row", "words"), windows.where(F.pmod("hash", F.lit(blocks)) == k), lengths, False))
        found = found.unionByName(part, allowMissingColumns=True)
    own = [F.first(c, ignorenulls=True).alias(c) for c in ("doc_id", "n_words", *["text"] * with_text)]
    gathered = found.groupBy("row").agg(*own, F.collect_list("hit").alias("hits"), F.collect_set("items").alias("sets"))
    spans = gathered.select("doc_id", *["text"] * with_text, "n_words", _merged(F.col("hits")).alias("spans"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"))
    return spans.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]))


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id and text without what is contaminated.

    "spans": hit words go, each with what stands between it and the word before; other characters stay. "documents": documents
    with a hit go. Clean documents stay as they are, null texts too."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown removal: {remove}")
    told = contamination(docs, items, width, doc_id, text, item_id, item_text, True)
    if remove == "documents":
        return told.where("n_hit = 0").select("doc_id", "text")
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*{_WORD}"), F.lit(0))
    tail = F.regexp_extract("text", rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    # the clean stretches between spans: from the end of one (0 at first) to the start of the next (the end of the text at last)
    ends = F.concat(F.array(F.lit(0)), F.col("spans.end"))
    starts = F.concat(F.col("spans.start"), F.array(F.col("n_words").cast("int")))
    rest = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda s: F.array_join(F.slice("pieces", s["a"] + 1, s["b"] - s["a"]), ""))
    cleaned = told.withColumn("pieces", F.when(F.col("n_hit") > 0, pieces))
    return cleaned.select("doc_id", F.when(F.col("n_hit") > 0, F.concat(F.array_join(rest, ""), tail)).otherwise(F.col("text")).alias("text"))


def contamination_digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    told = contamination(docs, items)
    return told.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
