"""Conversation repair, decontamination and the filter audit against plain Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby, permutations

import pytest
from pyspark.sql import functions as F

from gridweave.llm import conversation_repair as repair
from gridweave.llm import decontamination as leaks
from gridweave.llm import filter_audit as audit

# ---- conversations

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")


def plain_faults(turns):
    """(role, text, fault) of sorted (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in turns:
        marks = NOT_SPACE.findall(text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_repair(turns):
    """(cost, edits, repaired turns) by trying all edits that cost no more than the best so far; ties by the edits' text."""
    best = [3 * len(turns) + 1, "", None]

    def go(k, cost, edits, made):
        if cost > best[0]:
            return
        if k == len(turns) and GRAMMAR.match("".join(r[:1] or "?" for r, _ in made)) and (cost, edits) < (best[0], best[1] if best[2] is not None else "~"):
            best[:] = cost, edits, made
        if not re.match(r"s?(ua)*u?\Z", "".join(r[:1] or "?" for r, _ in made)):
            return
        for role in ("user", "assistant"):
            if not edits.endswith("III"):
                go(k, cost + 2, edits + "I", [*made, (role, "")])
        if k < len(turns):
            role, text, fault = turns[k]
            go(k + 1, cost + 3, edits + "D", made)
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                go(k + 1, cost + extra, edits + "K", [*made, (role, text)])
                for other in ("user", "assistant"):
                    go(k + 1, cost + 2 + extra, edits + "R", [*made, (other, text)])

    go(0, 0, "", [])
    return best


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_answers(rows):
    """The contract's columns by conversation."""
    of, out = defaultdict(list), {}
    for conv, turn, role, text in plain_damage(rows):
        of[conv].append((turn, role, text))
    for conv in {r[0] for r in rows}:
        turns = sorted(of[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults = plain_faults(turns)
        known = [t for t, _, _ in turns if t is not None]
        count = Counter(f for _, _, f in faults)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:], strict=False))
        cost, edits, made = plain_repair(faults)
        whole = "\n".join(f"{r}:{t}" for r, t in made)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, hashlib.sha256(whole.encode()).hexdigest()), made
    return out


def some_conversations(seed, n):
    rng, rows = random.Random(seed), []
    texts = ["Fine.", "Why?", "cut off", " \t", "", "Also fine!  ", "Yes.\n", None, "É… oui."]
    for conv in range(n):
        for turn in range(rng.randrange(1, 5)):
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_repair_matches_all_edits(spark):
    rows = [*some_conversations(1, 60), (None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (None, None, "assistant", "Hi."), *[(1000, k, "user", "Same.") for k in range(4)]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "'x' AS letter", "2 AS signature", "3 AS audit")
    got = {r.conv_id: tuple(r[1:]) for r in repair.repair_damaged(df.repartition(3)).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    want = plain_answers(rows)
    assert got == {k: v for k, (v, _) in want.items()}
    turns = repair.damage(df)
    made = defaultdict(list)
    for r in repair.repaired_turns(turns, repair.repair(turns)).orderBy("conv_id", "place").collect():
        made[r.conv_id].append((r.role, r.text))
    assert made == {k: v for k, (_, v) in want.items() if v}


def test_repair_without_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.repair_damaged(nothing).collect() == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    r = repair.repair_damaged(spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)).first()
    assert tuple(r) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_trie_shares_prefixes_and_breaks_ties_as_whole_texts():
    rng = random.Random(4)
    signatures = sorted({"".join(rng.choice("sSuUaAox") for _ in range(rng.randrange(1, 6))) for _ in range(150)})
    roles, path = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}, repair.TriePath()
    for signature in signatures:
        path.go(signature)
        turns = [(roles[c.lower()], "", "blank" if c == "x" else "truncated" if c.isupper() else "") for c in signature]
        assert path.answer() == tuple(plain_repair(turns)[:2])
    assert path.computed == len({s[:k] for s in signatures for k in range(1, len(s) + 1)})
    long = "ua" * 3000 + "u"
    path.go(long)
    assert path.answer() == (2, "K" * 6001 + "I") and path.depth == 6001


def test_repair_streams_a_long_conversation(spark):
    """More turns than a batch, one text that most of them repeat, and many conversations of one signature."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", "Again." if k % 3 else f"Turn {k}.") for k in range(3000)] + [(10 + c, k, "user" if k % 2 == 0 else "assistant", f"{c} {k}.") for c in range(500) for k in range(2)]
    got = {r.conv_id: r for r in repair.repair_damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    turns = sorted(((t, r, x) for c, t, r, x in plain_damage(rows) if c == 1), key=lambda t: t[0])
    faults = Counter(f for _, _, f in plain_faults(turns))
    assert (got[1].blank, got[1].duplicate, got[1].truncated) == (faults["blank"], faults["duplicate"], faults["truncated"])
    assert sum(e != "I" for e in got[1].audit) == len(turns) and len(got) == 501


# ---- decontamination

TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_leaks(docs, items, width=leaks.WIDTH):
    windows = defaultdict(set)
    for item, text in items:
        w = TERM.findall((text or "").translate(FOLD))
        k = min(len(w), width)
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i : i + k])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, held = TERM.findall((text or "").translate(FOLD)), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    held |= found
                    hit |= set(range(i, i + k))
        out.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return out


def leaky_tables(spark):
    rng = random.Random(7)
    words = ["Der", "ÜBER", "über", "K1", "İx", "a", "b", "c", "ΟΔΟΣ", "οδος", "9", "\U0001d7d8z"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "."]) for _ in range(n))
    items = [(k, text(rng.randrange(12, 30))) for k in range(12)] + [(3, text(11)), (20, "C A ΟΔΟΣ"), (21, "c a  οδος"), (22, ""), (23, None), (None, "b-b b"), (24, "..."), (5, text(40)), (25, "same words " * 9), (26, "same words " * 9)]
    docs = [(k, text(rng.randrange(0, 60)) + rng.choice([i[1] or "" for i in items]) * rng.randrange(2) + text(8)) for k in range(120)]
    docs += [(7, items[0][1]), (7, items[0][1]), (None, items[1][1].upper()), (200, None), (201, ""), (202, "c a ΟΔΟΣ."), (203, "same words " * 40), (204, "word " * 20_000 + items[2][1])]
    clash = {"row": "1", "words": "'w'", "hash": "2", "len": "3", "items": "'i'", "hit": "4", "at": "5", "w1": "6"}
    docs_df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", *(f"{v} AS {k}" for k, v in clash.items())).repartition(3)
    return docs, items, docs_df, spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit(1))


def test_contamination_matches_plain_windows(spark, monkeypatch):
    docs, items, docs_df, items_df = leaky_tables(spark)
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted(plain_leaks(docs, items), key=key)
    assert sorted(map(tuple, leaks.contamination_digests(docs_df, items_df).collect()), key=key) == want
    monkeypatch.setattr(leaks, "BROADCAST_BYTES", 4000)  # in blocks
    assert sorted(map(tuple, leaks.contamination_digests(docs_df, items_df).collect()), key=key) == want


def test_contamination_of_empty_tables(spark):
    _, _, docs, items = leaky_tables(spark)
    assert leaks.contamination_digests(docs.where("1 = 0"), items).collect() == []
    clean = leaks.contamination_digests(docs, items.where("1 = 0"))
    assert clean.where("contaminated OR n_items > 0 OR n_hit > 0").count() == 0 and clean.count() == docs.count()


def test_decontaminated_texts(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "tiny item")], "item_id int, text string")
    passage = "One, two; three four FIVE six seven eight nine ten"
    docs = [(1, f"Before. ({passage}) after!"), (2, passage), (3, "A clean text, as it was.  "), (4, None), (5, "x tiny item tiny item y"), (6, f"{passage} mid {passage}.\n")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = dict(leaks.decontaminate(df, items).collect())
    assert got == {1: "Before) after!", 2: "", 3: docs[2][1], 4: None, 5: "x y", 6: " mid.\n"}
    assert {r.doc_id for r in leaks.decontaminate(df, items, "documents").collect()} == {3, 4}
    with pytest.raises(ValueError):
        leaks.decontaminate(df, items, "lines")


def test_decontamination_stays_in_the_engine(spark):
    _, _, docs, items = leaky_tables(spark)
    plan = leaks.contamination_digests(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


# ---- filter audit


def plain_audit(docs, labels):
    good, toxic, least = set(), set(), {}
    for doc, quality, bad in labels:
        good |= {doc} if quality == 1 and doc is not None else set()
        toxic |= {doc} if bad == 1 and doc is not None else set()
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    rows = []
    for doc, text, part in docs:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": doc is not None and doc > least[text]}
        rows.append((part or "", {k for k, v in fails.items() if v}, doc in good, doc in toxic))
    out = []
    for part, own in groupby(sorted(rows, key=lambda r: r[0]), key=lambda r: r[0]):
        own, removals, steps = list(own), Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removals[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*s, removals[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def test_audit_matches_every_order(spark, messy, nothing):
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "x", "é", "d#", "日本"] + [f"w{k}" for k in range(150)]
    texts = [" ".join(rng.choices(words, k=rng.choice([5, 90, 99, 100, 130]))) for _ in range(60)] + [" ".join(rng.sample(words[7:], 120)), "UPPER CASE", None, ""]
    docs = [(rng.choice([k, k, 3, None]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(150)]
    labels = [(rng.randrange(160), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)] + [(None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS id", "2 AS part", "3 AS mask", "4 AS digest", "5 AS n")
    labels_df = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("mask", F.lit(1))
    assert sorted(map(tuple, audit.filter_audit(df.repartition(3), labels_df).collect())) == plain_audit(docs, labels)
    rows = [(r.doc_id, r.text, r.lang) for r in messy.collect()]
    no_labels = labels_df.where("1 = 0")
    assert sorted(map(tuple, audit.filter_audit(messy, no_labels).collect())) == plain_audit(rows, [])
    assert audit.filter_audit(nothing, labels_df).collect() == []
