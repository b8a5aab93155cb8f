"""Conversation structure repair: the cheapest edits that turn turns into an optional system turn and pairs of user and assistant.

Every turn becomes a letter: its role's initial (s, u, a, or o for others), upper case if its text is cut off, or x if it must go (blank,
or a repetition). A conversation's letters are its signature. Distinct signatures are sorted, dealt out by range, and walked as a
prefix trie: neighbours share a prefix, the path to the current node is kept, and the layer of the dynamic programme at a node is
computed once, from its parent's. At a terminal node the cheapest edits are read off. Memory is the path, not the trie.

A layer holds, for each state of the role grammar (start, after s, after u, after a), the least cost of edits that end with the turn's
own one, where they came from, and the rank of their text among the four. Edits of different states after equally many turns are
never prefixes of each other (each ends with a turn's edit), so ranks decide ties as the whole texts would.

Turns are ordered by turn (nulls first), then role, then text, both compared by bytes, so repeated turns have one result. A repetition has the role and text of any
earlier turn. They are found by the least place of each (conversation, role, text), so a text that a third of all turns
repeat is one aggregate. Conversations that share a signature fetch its answer by salted keys. Repaired texts are hashed turn by turn from a
sorted stream: a conversation of any length needs no more memory than its edits, which are one value of the result. (A
SHA-256 has to be computed in sequence, so one conversation's texts pass through one task, whatever its size.)

Cases: nulls of role and text are one space; a null conversation is one of its own. A conversation of which nothing is left has zeros, no
edits and the hash of the empty text. An empty table gives an empty one. Very long texts are read once. Other columns take no
part, whatever their names. Of roles only the first character counts; an empty role is an illegal one. Texts with bytes that aren't UTF-8 have
these replaced by U+FFFD before anything is compared or hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from gridweave.llm import textkernel as K
from gridweave.llm.spark_util import cut, partitions, spread_join, union

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state that an inserted or renamed turn leads to (a user turn, but after one an assistant turn), and kept turns' moves.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: More than two insertions in a row come back to a state that fewer reach.
MOST_INSERTED = 2
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
MUST_GO = "x"
SPACE = r"\x20\x09-\x0D"

_EDITS = [k * "I" + e for k in range(MOST_INSERTED + 1) for e in "DKR"]
_NEVER = 1 << 60


def _inserted(state: int) -> list[int]:
    """The states after 0, 1, 2 insertions."""
    out = [state]
    for _ in range(MOST_INSERTED):
        out.append(NEXT[out[-1]])
    return out


def _moves(letter: str) -> list[tuple[int, int, int, int]]:
    """(state before, state after, cost, number of the edits) of all edits of a turn."""
    out = []
    for state in range(4):
        for k, at in enumerate(_inserted(state)):
            out.append((state, at, DELETE + k * INSERT, _EDITS.index(k * "I" + "D")))
            if letter != MUST_GO:
                extra = k * INSERT + CUT_OFF * letter.isupper()
                out.append((state, NEXT[at], RENAME + extra, _EDITS.index(k * "I" + "R")))
                if (at, letter.lower()) in KEPT:
                    out.append((state, KEPT[at, letter.lower()], extra, _EDITS.index(k * "I" + "K")))
    return out


_MOVES = {letter: _moves(letter) for letter in "sSuUaAoOx"}


class TriePath:
    """The layers on the path from the root of the trie to the current node."""

    def __init__(self):
        self.prefix, self.depth = "", 0
        self.cost = np.full((256, 4), _NEVER, np.int64)
        self.rank, self.back, self.edit = (np.zeros((256, 4), np.int8) for _ in range(3))
        self.cost[0, START] = 0
        self.computed = 0

    def _add(self, letter: str) -> None:
        if self.depth + 1 == len(self.cost):
            self.cost, self.rank, self.back, self.edit = (np.concatenate((x, np.zeros_like(x))) for x in (self.cost, self.rank, self.back, self.edit))
        cost, rank = self.cost[self.depth].tolist(), self.rank[self.depth].tolist()
        best: list[tuple | None] = [None] * 4
        for before, after, extra, edit in _MOVES[letter]:
            if cost[before] < _NEVER:
                found = (cost[before] + extra, rank[before], _EDITS[edit], before, edit)
                if best[after] is None or found < best[after]:
                    best[after] = found
        self.depth += 1
        self.computed += 1
        reached = sorted((k for k in range(4) if best[k]), key=lambda k: best[k][1:3])
        self.cost[self.depth] = _NEVER
        for place, k in enumerate(reached):
            self.cost[self.depth, k], _, _, self.back[self.depth, k], self.edit[self.depth, k] = best[k]
            self.rank[self.depth, k] = place

    def go(self, signature: str) -> None:
        """To the node of ``signature``: back to the prefix that it shares with the last, then down."""
        shared, most = 0, min(len(signature), len(self.prefix))
        while shared < most and signature[shared] == self.prefix[shared]:
            shared += 1
        self.depth = shared
        for letter in signature[shared:]:
            self._add(letter)
        self.prefix = signature

    def answer(self) -> tuple[int, str]:
        """Cost and edits of the current node, as a terminal one."""
        ends = {START: "", AFTER_A: "", AFTER_U: "I", AFTER_S: "II"}
        cost, rank = self.cost[self.depth], self.rank[self.depth]
        total, _, tail, state = min((int(cost[k]) + INSERT * len(t), int(rank[k]), t, k) for k, t in ends.items() if cost[k] < _NEVER)
        out = [tail]
        for depth in range(self.depth, 0, -1):
            out.append(_EDITS[self.edit[depth, state]])
            state = self.back[depth, state]
        return total, "".join(reversed(out))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of sorted signatures."""
    path = TriePath()
    for batch in batches:
        signatures, answers = batch.column("signature").to_pylist(), []
        for signature in signatures:
            path.go(signature)
            answers.append(path.answer())
        costs, audits = zip(*answers, strict=True) if answers else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(signatures, pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["signature", "cost", "audit"])


def solve(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit of distinct signatures."""
    n = partitions(signatures.sparkSession)
    return signatures.repartitionByRange(n, "signature").sortWithinPartitions("signature").mapInArrow(_solve, "signature string, cost bigint, audit string")


def damage(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text after damage by a checksum of conversation and turn: dropped, emptied, without ends of
    sentences, repeated, given to the user, or (mostly) left as it is. Nulls of role and text become one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space(conv_id), F.lit(":"), space(turn)).cast("binary")), F.lit(20))
    own_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.when(kind == 4, "user").otherwise(space(role)).alias("role"), F.make_valid_utf8(own_text).alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", F.make_valid_utf8("role").alias("role"), "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


def _initial(role: str) -> Column:
    return F.substring(role, 1, 1)


def _letters(turns: DataFrame) -> DataFrame:
    """conv_id, turn, place, initial, blank, letter, key (of role and text) of every turn."""
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    initial = _initial("role")
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    placed = turns.withColumn("place", F.row_number().over(order)).withColumn("before", F.lag(initial).over(order))
    return placed.select("conv_id", "turn", "place", "before", initial.alias("initial"), (last == "").alias("blank"), F.when(last.isin(".", "!", "?"), letter).otherwise(F.upper(letter)).alias("letter"), F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("key"))


def signatures(turns: DataFrame, every: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, signature of each conversation of ``every``, of which ``turns`` are left."""
    lettered = _letters(turns)
    legal = F.concat("before", "initial").isin("su", "ua", "au")
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    by_turn = lettered.groupBy("conv_id", "turn").agg(F.count("*").alias("n"), count(F.col("blank")).alias("blank"), count(F.col("before").isNotNull() & ~legal).alias("illegal"))
    totals = by_turn.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("blank").alias("blank"), F.sum("illegal").alias("illegal"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    firsts = lettered.where("NOT blank").groupBy("conv_id", "key").agg(F.min(F.struct("place", "letter")).alias("f")).groupBy("conv_id").agg(F.array_sort(F.collect_list("f")).alias("firsts"))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("array<struct<place: int, letter: string>>")
    parts = union(
        every.select("conv_id", zero.alias("n"), zero.alias("blank"), zero.alias("illegal"), zero.alias("gaps"), none.alias("firsts")),
        totals.select("conv_id", "n", "blank", "illegal", "gaps", none.alias("firsts")),
        firsts.select("conv_id", zero.alias("n"), zero.alias("blank"), zero.alias("illegal"), zero.alias("gaps"), "firsts"),
    )
    rows = parts.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("n", "blank", "illegal", "gaps")), F.coalesce(F.first("firsts", ignorenulls=True), F.array().cast(dict(firsts.dtypes)["firsts"])).alias("firsts"))
    gone = lambda n: F.repeat(F.lit(MUST_GO), n.cast("int"))
    before = lambda i: F.coalesce(F.get("firsts", i - 1)["place"], F.lit(0))
    stretches = F.transform("firsts", lambda f, i: F.concat(gone(f["place"] - before(i) - 1), f["letter"]))
    signature = F.concat(F.array_join(stretches, ""), gone(F.col("n") - before(F.size("firsts"))))
    return rows.select("conv_id", "gaps", "blank", (F.col("n") - F.col("blank") - F.size("firsts")).alias("duplicate"), F.size(F.filter("firsts", lambda f: f["letter"] != F.lower(f["letter"]))).cast("bigint").alias("truncated"), "illegal", signature.alias("signature"))


_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str | None, str]]:
    """Of a stream with each conversation's answer before its turns: (answer, role, text) of every repaired turn as it comes,
    and (answer, None, "") at the end of a conversation."""
    answer, audit, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple[tuple, str, str]]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            state, at = NEXT[state], at + 1
            yield answer, ROLE[state], ""

    for batch in batches:
        for is_turn, *facts, role, text in zip(*(batch.column(c).to_pylist() for c in ("is_turn", "conv_id", *_FACTS, "audit", "role", "text")), strict=True):
            if not is_turn:
                if answer:
                    yield from inserted()
                    yield answer, None, ""
                answer, audit, at, state = tuple(facts), facts[-1], 0, START
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = KEPT[state, role[:1]]
                yield answer, role, text
            elif edit == "R":
                state = NEXT[state]
                yield answer, ROLE[state], text
    if answer:
        yield from inserted()
        yield answer, None, ""


def _rows_out(run, names: list[str], kinds: list[pa.DataType], most: int = 1000):
    """``run`` (batches to tuples) as a function over Arrow batches."""

    @K.tidy
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = run(batches)
        while part := list(islice(rows, most)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)

    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    sha, empty = hashlib.sha256(), True
    for answer, role, text in _edited(batches):
        if role is None:
            yield *answer, sha.hexdigest()
            sha, empty = hashlib.sha256(), True
        else:
            sha.update((("" if empty else "\n") + f"{role}:{text}").encode())
            empty = False


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    place = 0
    for answer, role, text in _edited(batches):
        if role is None:
            place = 0
        else:
            yield answer[0], place, role, text
            place += 1


def repair(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, signature of the conversations of ``turns`` (conv_id, turn, role, text), and of
    ``every`` (conv_id) if it is given."""
    told = cut(signatures(turns, (turns if every is None else every).select("conv_id")))
    solved = cut(solve(told.select("signature").where("signature <> ''").distinct()))
    return spread_join(told, ["signature"], ["conv_id"], solved, "left").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.coalesce("cost", F.lit(0).cast("bigint")).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"), "signature")


def _stream(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """Each conversation's answer, then its turns in order, in one partition."""
    spark = turns.sparkSession
    null = lambda t: F.lit(None).cast(t)
    heads = answers.select(F.lit(False).alias("is_turn"), "conv_id", null(dict(turns.dtypes)["turn"]).alias("turn"), null("string").alias("role"), null("string").alias("text"), *_FACTS, "audit")
    bodies = turns.select(F.lit(True).alias("is_turn"), "conv_id", "turn", "role", "text", *(null("bigint").alias(c) for c in _FACTS), null("string").alias("audit"))
    return heads.unionByName(bodies).repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "is_turn", F.asc_nulls_first("turn"), "role", "text")


def repaired_digests(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """``answers`` with repaired_sha256: of the repaired turns as role:text, joined by line ends."""
    names = ["conv_id", *_FACTS, "audit", "repaired_sha256"]
    run = _rows_out(_hashed, names, [to_arrow_type(turns.schema["conv_id"].dataType), *[pa.int64()] * len(_FACTS), pa.string(), pa.string()])
    return _stream(turns, answers).mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, {', '.join(f'{c} bigint' for c in _FACTS)}, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired conversations."""
    run = _rows_out(_numbered, ["conv_id", "place", "role", "text"], [to_arrow_type(turns.schema["conv_id"].dataType), pa.int64(), pa.string(), pa.string()])
    return _stream(turns, answers).mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, place bigint, role string, text string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conversation, damaged and repaired."""
    turns = damage(conversations)
    return repaired_digests(turns, repair(turns, conversations))
