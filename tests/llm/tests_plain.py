"""Plain Python versions of the text operators, for comparison."""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np

from gridweave.llm import langid, quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def base_counts(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def quality_verdicts(rows, most=quality.LINE_DOCS, removed=quality.MAX_REMOVED):
    """Of each (id, text, host): removed words, whether it is kept, and its text without limited lines."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    norm = lambda line: " ".join(WORD.findall(line.translate(fold)))
    seen = Counter((host or "", x) for _, text, host in rows for x in {norm(y) for y in (text or "").split("\n")} if x)
    out = []
    for k, text, host in rows:
        lines = [(x, seen[host or "", norm(x)] > most) for x in (text or "").split("\n")]
        lost, (n, _, _, _, repeated) = sum(len(WORD.findall(x)) for x, gone in lines if gone), base_counts(text)
        kept = n >= 20 and 100 * repeated <= 30 * n and lost <= removed * n
        rest = "".join(x + "\n" * (i < len(lines) - 1) for i, (x, gone) in enumerate(lines) if not gone)
        out.append((k, lost, kept, rest))
    return out


def plain_components(rows):
    low = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x)
    sets = {}
    for k, text in rows:
        w = WORD.findall(low(text or ""))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    return sorted((k, len(s), find(k)) for k, s in sets.items())


def luhn(digits):
    return sum((int(c) * (1 + i % 2)) // 10 + (int(c) * (1 + i % 2)) % 10 for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(x):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x) if 16 <= len(d := re.sub("[ -]", "", m.group())) <= 19 and luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def plain_languages(rows):
    """(id, language, share of letters) of (id, text, lang) rows: the same model by plain loops."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def script(c):
        return next((n for n, (_, spans) in enumerate(langid.SCRIPTS.items()) if any(a <= ord(c) <= b for a, b in spans)), len(langid.SCRIPTS))

    def features(word):
        raw = word.translate(fold).encode()
        padded = b"\0\0" + raw
        buckets = [((padded[i + 2] << 16 | padded[i + 1] << 8 | padded[i]) * 2654435761 % 2**32) >> 16 for i in range(len(raw))]
        return buckets, {script(c) for c in word if c.isalpha()}, sum(map(str.isalpha, word))

    words = lambda text: [features(w) for w in WORD.findall(text or "")]
    learned = {(text, lang) for k, text, lang in rows if lang is not None and text is not None and zlib.crc32(str("" if k is None else k).encode()) % 3 != 1}
    langs = sorted({lang for _, lang in learned})
    counts, scripts = {x: Counter() for x in langs}, {x: Counter() for x in langs}
    for text, lang in learned:
        for buckets, used, _ in words(text):
            counts[lang].update(buckets)
            scripts[lang].update(used)
    total = {x: sum(counts[x].values()) + 0.1 * 65536 for x in langs}
    fits = {x: {k for k, n in scripts[x].items() if n >= 0.01 * max(1, sum(scripts[x].values()))} for x in langs}
    out = []
    for k, text, _ in rows:
        state, share = None, Counter()
        path = []
        for buckets, used, letters in words(text):
            score = {x: sum(np.log((counts[x][b] + 0.1) / total[x]) for b in buckets) for x in langs}
            top = max(score.values())
            able = [x for x in langs if used & fits[x]]
            score = {x: (-1000 if able and x not in able else score[x] - top) if letters else 0 for x in langs}
            jump = max(langs, key=lambda x: state[x]) if state else None  # noqa: B023
            before = {x: None if not state else x if state[x] >= state[jump] - langid.SWITCH_PENALTY else jump for x in langs}
            state = {x: score[x] + (max(state[x], state[jump] - langid.SWITCH_PENALTY) if state else 0) for x in langs}
            path.append((before, letters))
        at = max(langs, key=lambda x: state[x]) if state else None  # noqa: B023
        for before, letters in reversed(path):
            share[at] += letters
            at = before[at]
        best = max(langs, key=lambda x: share[x])  # noqa: B023
        out.append((k, best, share[best] / share.total()) if share.total() else (k, "und", 0.0))
    return out


def plain_masks(text):
    """The text after masking; of the further kinds only IBANs of Germany."""
    if text is None:
        return None
    spans = [(a, b, k) for k, a, b in base_spans(text)] + [(*m.span(), "iban") for m in re.finditer(r"\bDE89 3704 0044 0532 0130 00\b", text)]
    out, at = "", 0
    for a, b, kind in sorted(spans):
        out += text[at:a] + f"[{kind.upper()}]" if a >= at else ""
        at = max(at, b)
    return out + text[at:]
