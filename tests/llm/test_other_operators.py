from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridweave.llm import queries as llm_queries
from gridweave.llm import ann, bpe, components, langid, ngram_join, online_packing, pii, quality, sharding, token_packing, url_filter

# ---- URL lists


def test_url_filter_matches_plain_search(spark):
    import datetime as dt
    import random

    rng, day = random.Random(9), lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "com"]
    entries = [(rng.choice(hosts), day(rng.randrange(400)), rng.choice(["block", "allow", "remove"])) for _ in range(120)]
    urls = ["http://A.com/p", "https://u:p@y.x.a.com:8080/?q=a.com", "http://z.x.a.com.", "http://b.org#f", "ftp://nob.org/x", "no url", "", None]
    captures = [(i, rng.choice(urls), None if rng.random() < 0.05 else day(rng.randrange(420))) for i in range(400)]
    got = {r.id: r for r in url_filter.filter_urls(spark.createDataFrame(captures, "id int, url string, fetched_at timestamp_ntz"), spark.createDataFrame([*entries, (None, day(1), "block")], "host string, at timestamp_ntz, action string")).collect()}
    of = {"http://A.com/p": "a.com", "https://u:p@y.x.a.com:8080/?q=a.com": "y.x.a.com", "http://z.x.a.com.": "z.x.a.com", "http://b.org#f": "b.org", "ftp://nob.org/x": "nob.org"}
    rank = ["remove", "allow", "block"]
    for i, url, at in captures:
        host, want = of.get(url), None
        if host and at:
            labels = host.split(".")
            for name in (".".join(labels[k:]) for k in range(len(labels))):
                past = [(t, rank.index(a)) for h, t, a in entries if h == name and t <= at]
                if past and max(past)[1]:
                    want = name, rank[max(past)[1]], max(past)[0]
                    break
        r = got[i]
        assert r.url_host == host and ((r.listed_host, r.list_action, r.listed_from) == want if want else r.list_action is None)


def test_url_filter_odd_tables(spark):
    """Empty sides, repeated captures, and captures with the names that the operator uses inside."""
    entries = spark.createDataFrame([("a.com", "2024-01-01", "block")] * 2, "host string, at string, action string").withColumn("at", F.to_timestamp_ntz("at"))
    captures = spark.createDataFrame([(1, "http://x.a.com/", "d", "u", "s", 5, None)] * 3 + [(2, None, "d", None, None, None, None)], "id int, url string, doc string, url_host string, __verdict string, salt int, list_action string").withColumn("fetched_at", F.lit("2024-02-01").cast("timestamp_ntz"))
    captures = captures.selectExpr("*", "id AS span", "map('a', 1) AS at", "1 AS __host", "2 AS __at", "3 AS entry_host", "4 AS interval", "5 AS verdict", "6 AS t")
    got = url_filter.filter_urls(captures, entries).collect()
    assert sorted((r.id, r.url_host, r.list_action, r.doc, r.at) for r in got if r.id == 1) == [(1, "x.a.com", "block", "d", {"a": 1})] * 3 and len(got) == 4
    assert {r.list_action for r in url_filter.filter_urls(captures, entries.where("1 = 0")).collect()} == {None}
    assert url_filter.filter_urls(captures.where("1 = 0"), entries).count() == 0


def test_url_filter_without_broadcast_lists(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    test_url_filter_matches_plain_search(spark)


# ---- vectors


def found_and_recall(spark, vectors, extra=()):
    """Neighbours of each query; the share of true ones found (any of equal distance counts), overall and for the worst tenth of queries."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = {}
    for r in ann.nearest(spark.createDataFrame([*rows, *extra], "vec_id bigint, embedding array<float>").repartition(4)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, len(vectors), 50)) and all(len(x) == 5 for x in got.values())
    wide, hits = vectors.astype(np.float64), []
    for q, found in got.items():
        score = (wide @ wide[q]) / (np.linalg.norm(wide, axis=1) * np.linalg.norm(wide[q]))
        score[q] = -2
        fifth = np.partition(score, -5)[-5]
        hits.append(np.mean([score[v] >= fifth - 1e-12 for v, _ in found]))
        assert all(abs(score[v] - s) < 1e-12 for v, s in found) and len({v for v, _ in found} - {q}) == 5
    return got, np.mean(hits)


@pytest.fixture
def many_lists(monkeypatch):
    """Small lists, so that few vectors make many."""
    monkeypatch.setattr(ann, "LIST_VECTORS", 50)
    monkeypatch.setattr(ann, "CHUNK", 150)


def test_nearest_recall_scores_and_ties(spark, many_lists):
    vectors = np.random.default_rng(2).normal(size=(3000, 16)).astype(np.float32)
    vectors[1000:1400] = vectors[0]  # equal vectors, in ties with a query
    odd = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0]), (5200, [None, *[1.0] * 15]), (None, [1.0] * 16)]
    got, recall = found_and_recall(spark, vectors, odd)
    assert recall >= 0.9 and [v for v, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]


@pytest.mark.parametrize("shape", ["near cluster and outliers", "nine tenths equal", "clusters far apart", "lone outliers"])
def test_nearest_recall_on_skewed_vectors(spark, many_lists, shape):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 16))
    if shape == "near cluster and outliers":
        vectors[rng.random(3000) < 0.7] = rng.normal(size=16)
        vectors += rng.normal(size=(3000, 16)) * 1e-4
    elif shape == "nine tenths equal":
        vectors[rng.random(3000) < 0.9] = rng.normal(size=16)
    elif shape == "clusters far apart":
        vectors = rng.normal(size=(7, 16))[rng.integers(0, 7, 3000)] + rng.normal(size=(3000, 16)) * 0.01
    else:  # queries are far from all else
        vectors[:, 0] += 30
        vectors[::50] = rng.normal(size=(60, 16))
    _, recall = found_and_recall(spark, vectors.astype(np.float32))
    assert recall >= 0.9


def test_centroid_graph_finds_the_nearest(many_lists):
    """The beam's first lists are those of a search of all, mostly, with only a part of them looked at."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(20, 8))[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 8)) * 0.2
    index = ann.CentroidIndex(vectors, 6000)
    unit = ann._unit(rng.permutation(vectors)[:300])
    lists, d = index.search(unit, 16)
    every = np.sqrt(((unit[:, None] - index.centroids) ** 2).sum(axis=2))
    assert len(index.centroids) >= 100 and lists.shape == (300, 16) and (np.diff(d, axis=1) >= 0).all()
    assert (lists[:, 0] == every.argmin(axis=1)).mean() > 0.97
    true = np.argsort(every, axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(true, lists, strict=True)]) > 0.9


def test_nearest_on_few_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])], "vec_id bigint, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert ann.nearest(few.where("1 = 0")).count() == 0


def test_nearest_finds_few_vectors_among_many_unusable(spark):
    """A sample of all rows would hold no usable vector, and most of its lengths would be those of zero vectors."""
    unusable = spark.range(1000, 400_000).selectExpr("id AS vec_id", "if(id % 2 = 0, null, array(0D, 0D, 0D)) AS embedding")
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])], "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(unusable.unionByName(few)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]


# ---- shards


def test_balanced_shards(spark):
    rows = [(i, f"text {i if i % 3 else i % 90}") for i in range(1200)] + [(2000 + i, "hot") for i in range(700)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=8).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 1900 and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    where = {}
    for r in got:
        where.setdefault(r.grp, []).append(r.shard)
    small = [x for x in where.values() if 1 < len(x) < 100]
    assert len(small) == 30 and sum(len(set(x)) > 1 for x in small) <= 6
    hot = max(where.values(), key=len)
    assert len(set(hot)) <= 5  # 700 rows need three full shards of 237


def test_balanced_shards_when_all_rows_are_linked(spark):
    """No shard has room to spare, so rows can only gather by swaps."""
    rows = [(i, f"text {i // 2}") for i in range(8000)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=8).collect()
    assert set(Counter(r.shard for r in got).values()) == {1000} and len({r.doc_id for r in got}) == 8000
    where = {}
    for r in got:
        where.setdefault(r.grp, []).append(r.shard)
    assert sum(len(set(x)) == 1 for x in where.values()) >= 0.95 * len(where)


@pytest.mark.parametrize("rows_per_task", [20, 20_000])
def test_shard_rounds_handle_groups_and_not_rows(spark, monkeypatch, rows_per_task):
    """What rounds write down has a row per group, however many rows these have; with many bins and with one."""
    written = []
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", rows_per_task)
    monkeypatch.setattr(sharding, "cut", lambda df, cut=sharding.cut: written.append(out := cut(df)) or out)
    rows = [(i, f"text {i % 70}" if i < 2100 else f"single {i}") for i in range(3000)] + [(3000 + i, "hot") for i in range(600)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=8).collect()
    assert len(written) > 3 and all(x.count() <= 71 for x in written[1:-1])  # the first has all rows, the last those that have a place
    assert {r.doc_id for r in got} == set(range(3600)) and len(got) == 3600
    slots, where = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.grp, []).append(r.shard)
    assert all(sorted(x) == list(range(450)) for x in slots.values()) and len(slots) == 8
    linked = [x for x in where.values() if len(x) == 30]
    assert len(linked) == 70 and sum(len(set(x)) == 1 for x in linked) >= 60


def test_sharding_query_keeps_its_contract(spark, tmp_path):
    """Every column against plain counts over whole tables; and by propagation fewer cut links than by hash."""
    import zlib

    rng = np.random.default_rng(11)
    texts = [f"text {rng.integers(0, 400)}" for _ in range(900)] + [None, "", "é" * 30] + ["hot"] * 300 + [f"single {i}" for i in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in llm_queries.op10_sharding(spark, f"file://{tmp_path}").collect()}
    assert set(got) == set(range(len(texts))) and {r.law for r in got.values()} == {"rows"} and {r.grown_shard for r in got.values()} == {None}
    slots: dict = {}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        assert (got[k].size, got[k].text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        slots.setdefault(got[k].shard, []).append(got[k].slot)
    assert set(slots) == set(range(40)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    pairs = lambda shard: sum(n * (n - 1) // 2 for n in Counter((texts[k], shard(k)) for k in got if texts[k] and texts[k].startswith("text")).values())
    every, kept, by_hash = pairs(lambda _: 0), pairs(lambda k: got[k].shard), pairs(lambda k: zlib.crc32(str(k).encode()) % 40)
    assert kept > 0.8 * every > 5 * by_hash


def test_flows_keep_quotas():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        room = rng.integers(-3, 4, n).tolist()
        demand = {(s, t): int(k) for s in range(n) for t in range(n) if s != t and (k := rng.integers(0, 6)) > 2}
        flow = sharding._flows(demand, room)
        after = [room[s] + sum(flow[s, t] - flow[t, s] for t in range(n)) for s in range(n)]
        assert all(0 < k <= demand[e] for e, k in flow.items()) and all(b >= min(a, 0) for a, b in zip(room, after, strict=True))
    assert sharding._flows({(0, 1): 5, (1, 2): 4, (2, 0): 3}, [0, 0, 0]) == {(0, 1): 3, (1, 2): 3, (2, 0): 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 90: 90, 95: 90}


# ---- nulls, repeated rows, empty and long texts, clashing names, empty tables


def test_messy_documents(spark, messy, nothing, tokenizer_file):
    total = messy.count()
    found = ngram_join.ngram_components(messy).collect()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert len(found) == total and by_id[7].component_id == 6 and by_id[9].component_id == 8 and by_id[3].n_shingles == 0 and by_id[4].component_id == 4
    judged = quality.quality_rules(messy).collect()
    assert len(judged) == total and all(r.base_failed for r in judged if r.n_words == 0)
    told = langid.language_ids(messy).collect()
    assert len(told) == total and {r.lang_pred for r in told if r.doc_id in (3, 4, 5)} == {"und"}
    assert pii.span_digests(messy).count() == total
    digests = bpe.encoding_digests(messy, tokenizer_file).collect()
    assert len(digests) == total and sum(r.n_tokens == 0 for r in digests) == 3
    pieces = online_packing.pack_online(messy, tokenizer_file).collect()
    assert sum(r.length for r in pieces) == sum(r.n_tokens for r in digests) + total
    packed = token_packing.pack_documents(messy, tokenizer_file).collect()
    assert sum(r.n_tokens for r in packed) == sum(r.n_tokens for r in digests) + total
    shards = sharding.balanced_shards(messy, shards=5).collect()
    assert len(shards) == total and {r.size for r in shards if r.doc_id in (3, 4)} == {16}
    for empty in (ngram_join.ngram_components(nothing), quality.quality_rules(nothing), langid.language_ids(nothing), pii.span_digests(nothing), bpe.encoding_digests(nothing, tokenizer_file), online_packing.pack_online(nothing, tokenizer_file), token_packing.pack_documents(nothing, tokenizer_file), sharding.balanced_shards(nothing)):
        assert empty.count() == 0


def test_texts_that_are_not_utf8(spark, tokenizer_file, tmp_path):
    """A bad byte alone, one cut off at the end of a text, and one that would go on the text before."""
    texts = ["41FF42", "C3", "A9", b"a fine text of some words. ".hex() * 12, (b"bad \xff\xc3 byte among words, " * 12).hex()]
    columns = "'en' AS lang, 'a' AS source, 1L AS n_chars"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, hex string").selectExpr("doc_id", "cast(unhex(hex) AS string) AS text", columns.split(", ")[0], *columns.split(", ")[1:])
    fixed = docs.withColumn("text", F.make_valid_utf8("text"))
    rows = lambda df: sorted(map(str, df.collect()))
    for run in (lambda d: token_packing.pack_documents(d, tokenizer_file, 64), lambda d: bpe.encoding_digests(d, tokenizer_file), lambda d: bpe.encode_documents(d, tokenizer_file)):
        assert rows(run(docs)) == rows(run(fixed))
    contract = lambda d: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in online_packing.pack_online(d, tokenizer_file).collect())
    assert contract(docs) == contract(fixed)
    for run in (ngram_join.ngram_components, pii.span_digests, langid.language_ids, quality.quality_rules, sharding.balanced_shards):
        assert run(docs).count() == 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"file://{tmp_path}/{k}")


def test_columns_named_like_those_added(spark, messy):
    """Columns of the input with the names that operators add are replaced or left out."""
    odd = messy.selectExpr("*", "'a' AS lang_pred", "1 AS n_words", "2 AS kept", "3 AS base_failed", "4 AS doc", "5 AS h", "6 AS ids", "7 AS text_crc32", "8 AS component_id", "9 AS spans")
    told = langid.identify(odd, langid.train(odd))
    assert {r.lang_pred for r in told.collect()} <= {"en", "fr", "de", "und"} and told.columns.count("score") == 1
    spans = pii.personal_spans(odd)
    assert spans.columns.count("pii") == 1 and spans.where("size(pii) >= 0").count() == messy.count()
    kept = quality.apply_quality_rules(odd)
    assert kept.columns == odd.columns and {r.doc for r in kept.collect()} == {4}
    assert ngram_join.ngram_components(odd).count() == sharding.balanced_shards(odd).count() == messy.count()
    named = odd.selectExpr("string(doc_id) AS doc_id", "text")
    assert {r.component_id for r in ngram_join.ngram_components(named).collect() if r.doc_id in ("6", "7")} == {"6"}


def test_long_texts_full_of_spans(spark):
    """Many spans, near each other and far into a long text; each keeps its place and context."""
    text = "é" * 5000 + " ssn 123-45-6789 " * 3000 + "é" * 3000 + " part 123-45-6789" + " x@y.zz" * 2000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [s.split(":") for s in pii.span_digests(df).first().spans.split(",")]
    assert {text[int(a) : int(b)] for k, a, b in spans if k == "ssn"} == {"123-45-6789"} and sum(k == "ssn" for k, _, _ in spans) == 3000
    assert sum(k == "email" for k, _, _ in spans) == 2000
    assert pii.mask_personal(df).first().text == "é" * 5000 + " ssn [SSN] " * 3000 + "é" * 3000 + " part 123-45-6789" + " [EMAIL]" * 2000


def test_pipeline_stages_on_messy_documents(spark, messy, nothing, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, messy, "").collect()
    assert Counter(r.doc_id for r in kept) == Counter([6, 7])
    told = stages["language"](spark, messy, "").collect()
    assert None not in {r.lang for r in told} and all((r.text or "").strip() for r in told)
    unique = stages["near_duplicates"](spark, messy, "").collect()
    assert Counter(r.doc_id for r in unique) == Counter({1: 1, None: 2, 3: 1, 4: 1, 5: 1, 6: 1, 8: 1, 10: 1})
    assert stages["personal_data"](spark, messy, "").count() == messy.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, "")
        assert out.count() == 0 and (name == "packing" or tuple(out.columns) == corpus_pipeline.COLUMNS)


def test_language_stage_rejects_by_share(spark, messy):
    docs = messy.unionByName(spark.createDataFrame([(20, "the cat le chat die katze " * 5, "en", "a"), (21, "123 456", "en", "a")], "doc_id long, text string, lang string, source string"), allowMissingColumns=True)
    told = [r.asDict() for r in langid.identify(docs.select(*corpus_pipeline.COLUMNS), langid.train(docs)).collect()]
    want = Counter((r["doc_id"], r["lang_pred"], r["text"]) for r in told if r["lang_pred"] != langid.UNKNOWN and r["score"] >= 0.5)
    got = corpus_pipeline.language(spark, docs, "").collect()
    assert 0 < len(got) < len(told) and Counter((r.doc_id, r.lang, r.text) for r in got) == want


def test_stages_match_plain_versions(spark, tmp_path, tokenizer_file):
    """Every stage on one messy table of files, against plain Python."""
    from tests_plain import plain_components, plain_languages, plain_masks, quality_verdicts

    import zlib

    rng = np.random.default_rng(21)
    vocab = {"en": "the of and house water street morning river".split(), "fr": "le les une maison rue matin eau être".split()}
    prose = lambda k: " ".join(rng.choice(vocab[lang := rng.choice(["en", "fr"])], k)) + f" n{rng.integers(0, 10**6)}q " + " ".join(rng.choice(vocab[lang], 4))
    texts = [prose(int(k)) for k in rng.integers(3, 70, 60)]
    texts += [texts[0], texts[1], texts[2] + " tail", "short", None, "", " \n ", "— 12 —"] + [f"Common line\n{prose(30)}" for _ in range(55)]
    texts += [prose(30) + " mail a.b@c.org or +1 (988) 555-2485, card 4111 1111 1111 1111, host 10.0.0.1; iban DE89 3704 0044 0532 0130 00 x@y.z"]
    rows = [(None if i % 31 == 7 else i, t, [None, "en", "fr"][i % 3], ["a", None][i % 40 == 3], len(t or "")) for i, t in enumerate(texts)] + [(0, texts[0], "en", "a", 5)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"file://{tmp_path}/in")
    docs, stages = spark.read.parquet(f"file://{tmp_path}/in"), dict(corpus_pipeline.STAGES)
    out = {name: Counter(map(tuple, stages[name](spark, docs, "").collect())) for name in stages}
    judged = quality_verdicts([(r[0], r[1], r[3]) for r in rows])
    assert out["quality"] == Counter((r[0], rest, r[2], r[3], len(rest)) for r, (_, _, kept, rest) in zip(rows, judged, strict=True) if kept)
    told = plain_languages([r[:3] for r in rows])
    assert out["language"] == Counter((r[0], r[1], lang, r[3], r[4]) for r, (_, lang, share) in zip(rows, told, strict=True) if lang != "und" and share >= 0.5)
    component = [c for _, _, c in plain_components([(i, r[1]) for i, r in enumerate(rows)])]
    kept = {}
    for i, r in enumerate(rows):
        kept[component[i]] = min(kept.get(component[i], (True, 10**9, 0)), (r[0] is None, r[0] or 0, i))
    want = Counter((rows[i][0], rows[i][1]) for _, _, i in kept.values())
    assert Counter({k: n for k, n in Counter(x[:2] for x in out["near_duplicates"].elements()).items()}) == want
    masked = [(r[0], plain_masks(r[1]), r[2], r[3]) for r in rows]
    assert out["personal_data"] == Counter((*r, len(r[1] or "")) for r in masked)
    pieces: dict = {}
    for doc, start, length, crc, total, sequence, offset in out["packing"].elements():
        pieces.setdefault(doc, []).append((start, length, crc, total))
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_file).encode
    plain: dict = {}
    for r in rows:
        ids = np.array([*encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        assert len(ids) <= 1024  # so that each is one piece
        plain.setdefault(r[0], []).append((0, len(ids), zlib.crc32(ids.tobytes()), len(ids)))
    assert {k: sorted(x) for k, x in pieces.items()} == {k: sorted(x) for k, x in plain.items()}
    where: dict = {}
    for _, _, length, _, _, sequence, offset in out["packing"].elements():
        where.setdefault(sequence, []).append((offset, length))
    for own in where.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0, *(n for _, n in sorted(own))])[:-1].tolist() and sum(n for _, n in own) <= 1024


def test_pipeline_runs_stage_after_stage(spark, tmp_path):
    rng = np.random.default_rng(5)
    prose = lambda k: " ".join(f"{w}" for w in rng.choice(["the", "of", "house", "water", "street", "morning", "river", "stone", "cloud", "paper"], k)) + " " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, k))
    texts = [prose(30) for _ in range(30)]
    texts += [texts[0], texts[1] + " end", "short", None, prose(30) + " mail me: someone@example.com"]
    df = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert {r.doc_id for r in out.select("doc_id").collect()} == {*range(30), 34}
    masked = corpus_pipeline.personal_data(spark, df, "").where(F.col("doc_id") == 34).first()
    assert masked.text.endswith("mail me: [EMAIL]") and masked.n_chars == len(masked.text)
