"""Personal data: patterns propose spans, checksums confirm them, context words adjust their scores.

Everything is column expressions. The base kinds (email, ip, card, phone) keep each leftmost non-overlapping match
that passes its check. Further kinds need more evidence: ``iban`` has its country's length and passes mod-97; ``account`` (13 to 15 digits
passing Luhn) and ``ssn`` (three, two and four digits) have a low score that words near by raise over the
threshold.

Patterns run in linear time on texts of any length: separators are first replaced, one for one, by a sign that no
pattern uses otherwise, so that single possessive classes do the work of repeated groups. Positions of
matches are sums of the lengths of what ``split`` leaves and what is matched, added up in blocks. What stands near a span, and
what stands between spans, is cut from pieces of bounded size, so a text full of spans costs in proportion to its length.
Positions are in code points; ends are exclusive.

Null and empty texts have no spans, and masking leaves them as they are. Every row gives one row; repeated rows, ties and null
ids are carried along, since nothing is joined. An empty table gives an empty one. A column of the input named like the one
that is added is replaced; others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "ssn")
#: Elements that a scan takes at a time: 2 ** 7; characters of a piece of text.
BLOCK_BITS, PIECE = 7, 1024

#: Stands for a separator inside a candidate; the same sign in a text is first replaced by the next one.
_MARK, _AWAY = "", ""

#: What a text must hold, separators that become the mark, and the pattern that proposes spans.
_PROPOSE = {
    "email": ("@", rf"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", rf"(?:\G|(?<![A-Za-z0-9._%+{_MARK}-]))[A-Za-z0-9._%+{_MARK}-]++@[A-Za-z0-9-]++{_MARK}[A-Za-z0-9{_MARK}-]++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]", "", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[ -]?[0-9]){12}", "(?<=[0-9])[ -](?=[0-9])", rf"[0-9][0-9{_MARK}]++"),
    "phone": (r"\+[0-9]", "", r"\+[0-9][ ().0-9-]+[0-9]"),
    "iban": (r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]", "(?<=[A-Z0-9]) (?=[A-Z0-9])", rf"(?<![A-Za-z0-9])(?=([A-Z]{{2}}[0-9]{{2}}[A-Za-z0-9{_MARK}]{{11,80}}+))[A-Z]{{2}}[0-9]{{2}}"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}

#: Proposals whose text is the pattern's group 1, which runs past the match, and the length of the match.
_AHEAD = {"iban": 4}
#: Characters of an IBAN by country; those of other countries have 15 to 34.
_IBAN_LENGTHS = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for c in codes.split()}

#: Score without and with a word of the kind near by; spans under the threshold are dropped.
THRESHOLD, NEAR_CHARS = 0.6, 40
_SCORES = {"email": (0.9, 1.0), "ip": (0.7, 0.9), "card": (0.9, 1.0), "phone": (0.7, 0.9), "iban": (0.9, 1.0), "account": (0.4, 0.8), "ssn": (0.4, 0.8)}
_WORDS = {
    "email": "e-?mail|contact|mailto",
    "ip": "ip|address|server|host",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "account": "card|visa|mastercard|amex|credit|debit|account|konto|compte|cuenta|imei",
    "ssn": "ssn|social security|taxpayer",
}



def _blocks(values: Column) -> Column:
    last = F.shiftright(F.greatest(F.size(values) - 1, F.lit(0)), BLOCK_BITS)
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, F.shiftleft(k, BLOCK_BITS) + 1, F.lit(1 << BLOCK_BITS)))


def _scan(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each element, all before it taken together; block by block, so long arrays stay affordable."""
    blocks = _blocks(values)
    fold = lambda x: F.aggregate(x, zero, step)
    before = F.aggregate(blocks, F.array(zero), lambda a, x: F.concat(a, F.array(step(F.element_at(a, -1), fold(x)))))
    within = F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda x, s: F.transform(x, lambda _, i: step(s, fold(F.slice(x, F.lit(1), i)))))
    return F.flatten(within)


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        twice = F.substring(digits, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(code: Column) -> Column:
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def step(a: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _iban(run: Column) -> Column:
    """The IBAN that a run of groups begins with; null if none does. It ends with a group: its country's length tells with
    which; of an unlisted country the longest that passes counts."""
    groups = F.split(run, _MARK)
    heads = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.array_join(F.slice(groups, F.lit(1), i), _MARK))
    lengths = F.create_map(*(F.lit(x) for kv in _IBAN_LENGTHS.items() for x in kv))

    def passes(head: Column) -> Column:
        plain = F.regexp_replace(head, _MARK, "")
        n = F.length(plain)
        fits = F.coalesce(n == lengths[F.substring(plain, 1, 2)], n.between(15, 34)) & plain.rlike("^[A-Z0-9]+$")
        return F.when(fits, _mod97(plain)).otherwise(F.lit(False))

    return F.get(F.reverse(F.filter(heads, passes)), 0)


def _confirmed(proposal: str, value: Column) -> Column:
    """The kind that the checks give to a proposed value; null if they reject it."""
    plain = F.regexp_replace(value, _MARK, "")
    if proposal == "ip":
        small = F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
        return F.when(small, F.lit("ip"))
    if proposal == "card":
        n = F.length(plain)
        return F.when(n.between(13, 19), F.when(_luhn(plain), F.when(n >= 16, F.lit("card")).otherwise(F.lit("account"))))
    if proposal == "phone":
        return F.when(F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15), F.lit("phone"))
    if proposal == "iban":
        return F.when(value.isNotNull(), F.lit("iban"))
    return F.lit(proposal)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text between two positions, taken from the pieces that they lie in."""
    first = F.floor(start / PIECE).cast("int")
    own = F.array_join(F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
    return F.substring(own, start - first * PIECE + 1, F.greatest(end - start, F.lit(0)))


def _score(kind: Column, pieces: Column, start: Column, end: Column) -> Column:
    near = _between(pieces, F.greatest(start - NEAR_CHARS, F.lit(0)), end + NEAR_CHARS)
    out = F.lit(0.0)
    for k, (alone, with_words) in _SCORES.items():
        out = F.when(kind == k, F.when(near.rlike(rf"(?i)\b(?:{_WORDS[k]})\b"), F.lit(with_words)).otherwise(F.lit(alone))).otherwise(out)
    return out


def _proposed(proposal: str, hits: Column, parts: Column, before: Column) -> Column:
    """The arrays go in zipped: what a lambda only refers to could be computed anew for every element."""
    hits = F.transform(hits, _iban) if proposal == "iban" else hits
    zipped = F.arrays_zip(hits.alias("hit"), F.slice(parts, F.lit(1), F.size(hits)).alias("part"), before.alias("before"))
    return F.transform(zipped, lambda z: F.struct(_confirmed(proposal, z["hit"]).alias("kind"), (z["before"] + z["part"]).alias("start"), F.length(z["hit"]).alias("length")))


def personal_spans(docs: DataFrame, text: str = "text", column: str = "pii") -> DataFrame:
    """``docs`` and ``column``: array<struct<kind, start, end, score>> by kind as listed in KINDS, then start."""
    docs = docs.drop(column)
    names = docs.columns
    hidden = {k: f"__pii_{k}" for k in ("text", *_PROPOSE, *(f"{what}_{k}" for what in ("parts", "hits", "before") for k in _PROPOSE))}
    whole = F.col(hidden["text"])
    df = docs.select("*", F.coalesce(F.col(text), F.lit("")).alias(hidden["text"]))

    def prepared(needs: str, separators: str) -> Column:
        marked = F.regexp_replace(F.translate(whole, _MARK, _AWAY), separators, _MARK) if separators else whole
        return F.when(whole.rlike(needs), marked)

    df = df.select("*", *(prepared(needs, separators).alias(hidden[k]) for k, (needs, separators, _) in _PROPOSE.items()))
    df = df.select(*names, hidden["text"], *(f(F.col(hidden[k])).alias(hidden[f"{what}_{k}"]) for k, (_, _, pattern) in _PROPOSE.items() for what, f in (("parts", lambda c, p=pattern: F.transform(F.split(c, p, -1), F.length)), ("hits", lambda c, p=pattern, g=int(k in _AHEAD): F.regexp_extract_all(c, F.lit(p), F.lit(g))))))
    def sums(k: str) -> Column:
        hits = F.col(hidden[f"hits_{k}"])
        taken = F.zip_with(F.slice(F.col(hidden[f"parts_{k}"]), F.lit(1), F.size(hits)), hits, lambda p, h: p + (F.lit(_AHEAD[k]) if k in _AHEAD else F.length(h)))
        return _scan(taken, F.lit(0), lambda a, x: a + x).alias(hidden[f"before_{k}"])

    df = df.select("*", *map(sums, _PROPOSE))
    none, found = F.array().cast("array<struct<kind:string,start:int,length:int>>"), []
    for k in _PROPOSE:
        hits, parts, before = (F.col(hidden[f"{what}_{k}"]) for what in ("hits", "parts", "before"))
        found.append(F.when(F.size(hits) > 0, F.filter(_proposed(k, hits, parts, before), lambda s: s["kind"].isNotNull())).otherwise(none).alias(f"__pii_{k}"))
    df = df.select(*names, hidden["text"], *found)
    every = F.coalesce(F.concat(*(F.col(f"__pii_{k}") for k in _PROPOSE)), none)

    def scored(spans: Column, pieces: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (s["start"] + s["length"]).alias("end"), _score(s["kind"], pieces, s["start"], s["start"] + s["length"]).alias("score")))

    # pieces are bound by an outer array of one, so that they are cut once and not for every span
    once = F.array(F.struct(every.alias("spans"), F.when(F.size(every) > 0, _pieces(whole)).alias("pieces")))
    kept = F.filter(F.flatten(F.transform(once, lambda o: scored(o["spans"], o["pieces"]))), lambda s: s["score"] >= THRESHOLD)
    order = F.create_map(*(F.lit(x) for n, k in enumerate(KINDS) for x in (k, n)))
    ranked = F.array_sort(F.transform(kept, lambda s: F.struct(order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score"))))
    return df.select(*names, F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))).alias(column))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, the hash of the base spans, and all spans as a string."""
    spans = personal_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    of = lambda kind: F.filter("pii", lambda s: s["kind"] == kind)
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select("doc_id", *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"))


def mask_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span (overlapping ones together) replaced by its kind in brackets; nulls stay null."""
    names = docs.columns
    df = personal_spans(docs, text, "__pii")
    by_place = F.array_sort(F.transform("__pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    df = df.select(*names, by_place.alias("__pii"))
    df = df.select(*names, "__pii", _scan(F.transform("__pii", lambda s: s["end"]), F.lit(0), lambda a, x: F.greatest(a, x)).alias("__covered"))
    # a span that starts inside what is covered already only lengthens it: its own part is cut without a sign
    zipped = F.arrays_zip(F.col("__pii").alias("s"), F.col("__covered").alias("c"))

    def cut_of(z: Column) -> Column:
        span, covered = z["s"], z["c"]
        sign = F.when(span["start"] >= covered, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(span["start"], covered).alias("start"), F.greatest(span["end"], covered).alias("end"), sign.alias("sign"), covered.alias("from"))

    cuts = F.transform(zipped, cut_of)
    df = df.select(*names, cuts.alias("__cuts"))
    once = F.array(F.struct(F.col("__cuts").alias("cuts"), _pieces(F.col(text)).alias("pieces")))
    kept = F.flatten(F.transform(once, lambda o: F.transform(o["cuts"], lambda c: F.concat(_between(o["pieces"], c["from"], c["start"]), c["sign"]))))
    end = F.element_at("__cuts", -1)["end"]
    masked = F.concat(F.array_join(kept, ""), F.substring(F.col(text), end + 1, F.length(text)))
    return df.select(*(F.when(F.size("__cuts") > 0, masked).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in names))
