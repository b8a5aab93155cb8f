import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests_plain import WORD, base_counts, base_spans, plain_components, plain_languages, quality_verdicts

from gridweave.llm.spark_util import cut
from gridweave.llm import bpe, langid, ngram_join, online_packing, pii, quality, token_packing
from gridweave.llm import textkernel as K
from gridweave.llm.components import connected_components

def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- quality rules


def test_quality_counts_match_brute_force():
    random.seed(1)
    vocab = ["a", "bb", "é", "ab#", "7", "x|y", "%%", "日本"]
    texts = ["".join(random.choice(vocab[: random.choice([2, 8])]) + random.choice([" ", "\n", "\n\n", "\t \n", "\x0b"]) for _ in range(random.choice([0, 1, 5, 40, 100]))) for _ in range(300)] + ["\n", " \n a", "a\n\n", "a\na"]
    data, offsets = K.string_buffers(pa.array(texts))
    counts, *_ = quality._slice_stats(data, offsets)
    for i, text in enumerate(texts):
        assert tuple(int(counts[c][i]) for c in quality._COUNTS) == base_counts(text)


@pytest.mark.parametrize("by_join", [False, True])
def test_quality_verdicts_match_brute_force(spark, monkeypatch, by_join):
    if by_join:
        monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    rng = random.Random(2)
    prose = lambda n: " ".join(f"w{rng.choice('abcdefgh')}{rng.randrange(10**6)}x" for _ in range(n))
    rows = [(i, f"Common Line {i % 10}\n{prose(30)}", "h") for i in range(60)]
    rows += [(100, "common  line 5\ncommon line 7 \n" + prose(3) + "\nCOMMON LINE 1 and more common line words here to reach twenty words in all of it", "h"), (101, "Common line 3\n" * 2 + prose(25), "other")]
    rows += [(200, "the very same text " + " ".join(f"z{k}" for k in "abcdefghijklmnopqrstuvwxyz"), "copies")] * 51 + [(300, "in just as many as allowed " + " ".join(f"y{k}" for k in "abcdefghijklmnopqrstuvwxyz"), None)] * 50
    rows += [(400, None, "h"), (401, "", None), (None, prose(22), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = quality_verdicts(rows)
    assert rows_of(quality.quality_rules(df).select("doc_id", "n_removed_words", "kept")) == sorted((x[:3] for x in want), key=str)
    stripped = quality.apply_quality_rules(df.withColumn("n_chars", F.lit(0).cast("long"))).collect()
    assert Counter((r.doc_id, r.text, r.n_chars) for r in stripped) == Counter((k, text, len(text)) for k, _, kept, text in want if kept)
    assert sum(x[2] for x in want) == 60 + 2 + 50 + 1  # over the limit a text's own copies are depleted


# ---- n-gram join


def test_ngram_join_matches_brute_force(spark):
    rng = random.Random(4)
    rows, base = [], [[f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 4, 5, 12, 60, 150]))] for _ in range(40)]
    for text in base:
        for _ in range(rng.choice([1, 1, 2, 12])):
            own = list(text)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(50)}"
            rows.append((len(rows), (" " if rng.random() < 0.5 else "\n").join(own)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "Hot Word", "hot word", "HOT WORD extra"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(ngram_join.ngram_components(df)) == sorted(plain_components(rows), key=str)


def test_ngram_join_frequent_ngrams(spark, monkeypatch):
    """With the limits down, frequent n-grams, several blobs, levels, blocks and tasks are all in play."""
    for name, value in (("ENTRIES_PER_TASK", 1000), ("ENTRIES_PER_BLOB", 2000), ("FAN", 3), ("LIST_BLOCK", 7)):
        monkeypatch.setattr(ngram_join, name, value)
    assert ngram_join._levels(20) == [(3, 7), (9, 3), (20, 1)] and ngram_join._levels(3) == [(3, 1)]
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*(passage if i % 2 else []), *(f"w{rng.randrange(9000)}" for _ in range(30 if i % 3 else 3))])) for i in range(400)]
    # texts that share their rarest n-grams without linking: long lists of many components
    rows += [(1000 + i, " ".join([*(f"q{k}" for k in range(12)), *(f"v{rng.randrange(3)} y{rng.randrange(3)}" for _ in range(12))])) for i in range(120)]
    assert rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(plain_components(rows), key=str)


def test_ngram_join_near_copies_about_the_threshold(spark):
    """Groups in which some pairs link and many don't: links of later steps reach nodes that are not the name of their component."""
    rng = random.Random(8)
    rows = []
    for g in range(8):
        text = [f"g{g}w{k}" for k in range(90)]
        for _ in range(40):
            own = list(text)
            for _ in range(rng.randrange(1, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    want = plain_components(rows)
    assert rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(want, key=str)
    assert 8 < len({x[2] for x in want}) < len(rows)


def test_ngram_join_first_step_joins_a_star_of_near_copies(spark):
    """Copies that link with one text but hardly with each other are one component before lists are taken up whole, so these leave no pairs."""
    rng = random.Random(9)
    rows = []
    for g in range(3):
        text = [f"g{g}w{k}" for k in range(150)]
        rows.append((len(rows), " ".join(text)))
        for _ in range(60):
            own = list(text)
            for at in rng.sample(range(10, 140), 3):
                own[at] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, sets = ngram_join.ngram_nodes(df)
    labels, mixed = ngram_join._mixed_lists(sets, ngram_join.OVER, ngram_join.UNDER)
    assert sorted(Counter(r.component for r in labels.collect()).values()) == [61] * 3 and mixed.count() == 0
    assert Counter(r.component_id for r in ngram_join.ngram_components(df).collect()) == {0: 61, 61: 61, 122: 61}


def test_components_take_known_ones_as_edges(spark):
    """A new link at a member of a known component moves the whole of it."""
    known, new = [(50, 51), (50, 52), (50, 53), (70, 71)], [(53, 10), (71, 52)]
    got = connected_components(spark.createDataFrame(known + new, "a long, b long"))
    assert rows_of(got) == sorted(((k, 10) for k in (10, 50, 51, 52, 53, 70, 71)), key=str)


def test_suffix_filter_keeps_every_link(spark):
    """Of all pairs that share an n-gram, no linked one fails the filters at the first that they share; many others do."""
    rng = random.Random(6)
    base = [[f"w{rng.randrange(60)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for text in base:
        for _ in range(8):
            own = list(text)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(60)}"
            rows.append((len(rows), " ".join(own)))
    _, sets = ngram_join.ngram_nodes(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.node: r for r in sets.collect()}
    width, kept, dropped = ngram_join.SUFFIX_PARTS // 64, 0, 0
    for a, b in combinations(found.values(), 2):
        shared = set(a.grams) & set(b.grams)
        if not shared:
            continue
        at = [next(i for i, g in enumerate(x.grams) if g in shared) for x in (a, b)]
        if any((i + 1) * width > len(x.suffixes) for i, x in zip(at, (a, b), strict=True)):
            continue
        odd = [np.unpackbits(np.array(x.suffixes[i * width : (i + 1) * width], np.int64).view(np.uint8)).astype(int) for i, x in zip(at, (a, b), strict=True)]
        needed = -(-(a.n + b.n) * 80 // 180)
        rest = [x.u - i - 1 for i, x in zip(at, (a, b), strict=True)]
        passes = sum(rest) - np.abs(odd[0] - odd[1]).sum() >= 2 * (needed - 1)
        assert passes or len(shared) < needed
        kept, dropped = kept + passes, dropped + (not passes)
    assert kept and dropped > 3 * kept


# ---- personal data


def test_pii_matches_brute_force_and_masks(spark):
    random.seed(5)
    parts = [*"0123456789ab.@+-() _%", "..", "4111111111111111", "4111 1111-1111 1111", "@x.y", "é", "\U0001F600", "", "1.2.3.4", "+1 (988) 555-2485", "a@b.c", "DE89 3704 0044 0532 0130 00", "ssn 123-45-6789", "\n"]
    texts = ["".join(random.choice(parts) for _ in range(random.choice([0, 3, 10, 40, 300]))) for _ in range(300)] + ["1" * 2000, "a." * 900 + "@b.c", "1 " * 3000, "x@y.z " * 700, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.span_digests(df).collect()}
    masked = {r.doc_id: r.text for r in pii.mask_personal(df).collect()}
    for i, text in enumerate(texts):
        base = base_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(k == x[0] for x in base) for k in pii.BASE_KINDS]
        if text is None:
            assert masked[i] is None
            continue
        out, at = "", 0
        for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in got[i].spans.split(",") if s)):
            out += text[at:a] + f"[{kind.upper()}]" if a >= at else ""
            at = max(at, b)
        assert masked[i] == out + text[at:]


def test_pii_checks_and_context(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00.", "iban DE88 3704 0044 0532 0130 00.", "my ssn: 123-45-6789", "part 123-45-6789", "amex card 378282246310005", "serial 378282246310005", "999.1.1.1 and 001.2.3.4"]
    got = [r.spans for r in pii.span_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["iban:5:32", "", "ssn:8:19", "", "account:10:25", "", "ip:14:23"]


def test_pii_iban_ends_before_the_next_word(spark):
    """(text with the IBANs in angle brackets, text after masking)"""
    cases = [
        ("<DE89370400440532013000> Bank of", "[IBAN] Bank of"), ("to <GB82 WEST 1234 5698 7654 32> The end", "to [IBAN] The end"), ("<DE89 3704 0044 0532 0130 00> BIC COBADEFFXXX", "[IBAN] BIC COBADEFFXXX"),
        ("<DE89370400440532013000> 2 times", "[IBAN] 2 times"), ("<DE89 3704 0044 0532 0130 00> <GB82 WEST 1234 5698 7654 32> X", "[IBAN] [IBAN] X"), ("AT12 <DE89 3704 0044 0532 0130 00> A", "AT12 [IBAN] A"),
        ("<NO93 8601 1117 947> 15 AB", "[IBAN] 15 AB"), ("<MT84 MALT 0110 0001 2345 MTLC AST0 01S> MT", "[IBAN] MT"), ("DE89370400440532013000EUR", "DE89370400440532013000EUR"), ("DE88 3704 0044 0532 0130 00 BIC", "DE88 3704 0044 0532 0130 00 BIC"),
    ]
    plain = [re.sub("[<>]", "", marked) for marked, _ in cases]
    df = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    spans = [r.spans for r in pii.span_digests(df).orderBy("doc_id").collect()]
    for text, (marked, _), got in zip(plain, cases, spans, strict=True):
        assert [text[int(a) : int(b)] for _, a, b in (x.split(":") for x in got.split(",") if x.startswith("iban"))] == re.findall("<(.*?)>", marked)
    assert [r.text for r in pii.mask_personal(df).orderBy("doc_id").collect()] == [masked for _, masked in cases]


# ---- languages


def test_language_id(spark):
    rng = random.Random(6)
    vocab = {"en": "the of and with from house water street morning".split(), "fr": "le les une avec maison rue matin eau être".split(), "el": "και το της με σπίτι νερό δρόμος".split()}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang]) for _ in range(n))
    rows = [(i, text(lang := rng.choice(list(vocab)), 30), lang if i % 7 else None, lang) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    got = langid.language_ids(df).join(df, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == r.truth for r in held) / len(held) > 0.98
    model = langid.train(df)
    mixed = text("en", 12) + " " + text("fr", 12) + " " + text("el", 12)
    spans = langid.language_spans(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first().spans
    assert [s.lang for s in spans] == ["en", "fr", "el"] and spans[-1].end == len(mixed)


def test_language_query_matches_plain_loops(spark):
    rng = random.Random(12)
    vocab = {"en": "the of and with from house water Street it's naïve".split(), "fr": "le les une avec maison rue matin eau être".split(), "el": "και το της με σπίτι Νερό δρόμος".split(), "ja": "これ は 水 です 家 の".split()}
    odd = ["—", "“", "\U0001F600", "123", "!?", "µ", "ß", "漢"]
    text = lambda: " ".join(rng.choice([*vocab[rng.choice(list(vocab))], rng.choice(odd)]) for _ in range(rng.choice([1, 3, 8, 30])))
    rows = [(i, " ".join(rng.choice(vocab[lang]) for _ in range(12)), lang) for i in range(120) for lang in [rng.choice(list(vocab))]]
    rows += [(200 + i, text(), None) for i in range(80)] + [(300, None, "en"), (301, "", "fr"), (302, "— … 12", "fr"), (None, "the house — the street", None), (303, rows[0][1], rows[0][2])]
    got = {r.doc_id: r for r in langid.language_ids(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    for k, lang, share in plain_languages(rows):
        assert (got[k].lang_pred, got[k].score) == (lang, pytest.approx(share, abs=1e-9)), (k, lang)


def test_dashes_and_quotes_have_no_script(spark):
    """One language writes dashes; they must not pull words of another to it."""
    rows = [(i, "le chat — la maison — avec une rue" if i % 2 else "the cat sat on the street with water", "fr" if i % 2 else "en") for i in range(40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    spans = langid.language_spans(spark.createDataFrame([(1, "the cat — sat on “the street” — with water 😀 the street")], "doc_id long, text string"), model).first().spans
    assert [s.lang for s in spans] == ["en"]


def test_viterbi_matches_plain_loop():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(0, 9, 6)
        bounds, scores = np.concatenate(([0], np.cumsum(sizes))), rng.normal(size=(sizes.sum(), 3)).astype(np.float32) * 3
        path = langid._viterbi(scores, bounds, 2.0)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            value = lambda p: sum(scores[a + i, k] for i, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p[:-1], p[1:], strict=True))  # noqa: B023, E731
            best = max((value(p) for p in np.ndindex(*[3] * (b - a))), default=0)
            assert value(path[a:b].tolist()) == pytest.approx(best, abs=1e-4)


# ---- tokens


def messy_texts():
    random.seed(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "s", "'s", "'re", "'ll", " 't", "1", "２", "!", "?!", "é", "日", "本", " ", "　", "\t", "\x1c", "\x85", "<|endoftext|>", "<|end", "the", "ing", " of", "\U0001F600", "é", "'d", "________", "\r\n", "\x00", "½", "ʼ", "՘", "Ᲊ"]
    return ["".join(random.choice(parts) for _ in range(random.choice([0, 1, 2, 5, 12, 60]))) for _ in range(3000)] + ["aaaaaaaa" * 300, " " * 5000, "\n" * 77 + "x"]


@pytest.mark.parametrize("trie", [True, False])
def test_bpe_equals_the_library(tokenizer_file, trie):
    texts, encoder = messy_texts(), bpe.TextEncoder(tokenizer_file, most=500, trie=trie)
    data, offsets = K.string_buffers(pa.array(texts))
    got = [ids[i:j].tolist() for _, _, part, at in K.slices(data, offsets, 20_000) for ids, ends in [encoder.encode(part, at)] for i, j in zip(ends[:-1], ends[1:], strict=True)]
    want = [e.ids for e in library(tokenizer_file).encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [bpe.decode(encoder.model, ids) for ids in want] == [library(tokenizer_file).decode(ids, skip_special_tokens=False) for ids in want] == texts


def test_encode_decode_round_trip(spark, tokenizer_file, messy):
    encoded = bpe.encode_documents(messy, tokenizer_file)
    texts = Counter(r.text or "" for r in messy.collect())
    assert Counter(r.text for r in bpe.decode_documents(encoded, tokenizer_file).collect()) == texts


@functools.cache
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(path, text, end):
    return [*library(path).encode(text or "", add_special_tokens=False).ids, end]


def small_docs(spark, n=400):
    rng = random.Random(8)
    return spark.createDataFrame([(i, " ".join(f"word{rng.randrange(300)}" for _ in range(rng.choice([0, 3, 50, 200, 2000])))) for i in range(n)], "doc_id long, text string")


def test_online_packing(spark, tokenizer_file):
    docs = small_docs(spark).repartition(6)
    rows = online_packing.pack_online(docs, tokenizer_file, open_windows=4, with_ids=True).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    for d in docs.collect():
        want, at = np.array(token_ids(tokenizer_file, d.text, 0), "<u4"), 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) and r.ids == want[at : at + r.length].tobytes() and r.ids_crc32 == zlib.crc32(r.ids)
            at += r.length
        assert at == len(want)
    assert sum(r.length for r in rows) / (1024 * len(sequences)) > 0.97


def test_token_packing(spark, tokenizer_file):
    docs = small_docs(spark).repartition(3)
    got = defaultdict(dict)
    rows = token_packing.pack_documents(docs, tokenizer_file, capacity=512, block=60_000).collect()
    for r in rows:
        ids, spots = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(spots) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens :] == 50256).all()
        for k, (doc, start) in enumerate(zip(r.doc_ids, r.starts, strict=True)):
            a, b = r.cu_seqlens[k : k + 2]
            assert spots[a:b].tolist() == list(range(b - a))
            got[doc][start] = ids[a:b].tolist()
    for d in docs.collect():
        assert sum((got[d.doc_id][s] for s in sorted(got[d.doc_id])), []) == token_ids(tokenizer_file, d.text, 50256)
    assert sum(r.n_tokens for r in rows) / (512 * len(rows)) > 0.97


def test_best_fit_decreasing_matches_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 101, rng.integers(0, 60))
        rooms = []
        for item in np.argsort(-sizes, kind="stable").tolist():
            fits = [k for k, room in enumerate(rooms) if room >= sizes[item]]
            if not fits:
                rooms.append(100)
            k = min(fits, key=lambda k: rooms[k]) if fits else len(rooms) - 1
            rooms[k] -= sizes[item]
        got = token_packing.best_fit_decreasing(sizes, 100)
        assert sorted(i for row in got for i in row) == list(range(len(sizes)))
        assert sorted(100 - sum(sizes[i] for i in row) for row in got) == sorted(rooms)
