"""Language identification of mixed-language text.

Scripts, told from ranges of code points, narrow a word's candidate languages. Each candidate scores the word by
its byte trigrams; a Viterbi pass over the words of a text, with a penalty for switching, labels spans. The
text's language is that of most letters (of equally many, the first by name); the score is its share. Letters are what Unicode calls so:
dashes, quotes, digits and emoji have no script, and words without letters take the language around them.

Training takes a bounded number of distinct labelled texts per language (``per_lang``), drawn by a hash of the
text; everything else covers all rows. Documents with a null language or text, and those of the held-out fold (crc32 of the
id as text, modulo 3, is 1; a null id is the empty text), are not learned from. Texts that are null or
have no letter are ``und`` with score 0. If there is nothing to learn from, every text is ``und``. Every row gives one
row; equal texts get equal answers, whatever their ids, which are only carried along. An empty table gives an empty one. Columns of
the input named ``lang_pred`` or ``score`` are replaced; others may have any name. Texts of any length are taken whole, slice by slice.
Bytes that aren't UTF-8 are no letters.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm import textkernel as K

UNKNOWN = "und"
PER_LANG, SWITCH_PENALTY = 3000, 6.0
TABLE_BITS, SLICE_BYTES = 16, 2 << 20

# Ranges of code points of each script; letters elsewhere are one script more.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F), (0xFB13, 0xFB17)),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "southern indic": ((0xA00, 0xDFF),),
    "thai and lao": ((0xE00, 0xEFF),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "ethiopic": ((0x1200, 0x139F), (0x2D80, 0x2DDF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)),
    "han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)),
}
_N_SCRIPTS = len(SCRIPTS) + 1


@functools.cache
def _script_bits() -> np.ndarray:
    """For each code point the bit of its script; 0 if it is no letter."""
    bits = np.full(0x110000, 1 << len(SCRIPTS), np.uint16)
    for n, spans in enumerate(SCRIPTS.values()):
        for first, last in spans:
            bits[first : last + 1] = 1 << n
    bits[[not chr(c).isalpha() for c in range(0x110000)]] = 0
    return bits


def _letter_bits(raw: np.ndarray) -> np.ndarray:
    """The script bit of the letter that starts at each byte of UTF-8; 0 elsewhere, and where a sequence is cut off or none."""
    table, bits = _script_bits(), np.zeros(len(raw), np.uint16)
    padded = np.append(raw, np.zeros(3, raw.dtype))
    ascii_ = raw < 0x80
    bits[ascii_] = table[raw[ascii_]]
    for low, high, mask, more in ((0xC2, 0xDF, 31, 1), (0xE0, 0xEF, 15, 2), (0xF0, 0xF4, 7, 3)):
        at = np.flatnonzero((raw >= low) & (raw <= high))
        code, whole = raw[at] & mask, np.ones(len(at), bool)
        for k in range(1, more + 1):
            code = code << np.uint32(6) | padded[at + k] & 63
            whole &= (padded[at + k] & 0xC0) == 0x80
        bits[at] = table[np.where(whole & (code < len(table)), code, 0)]
    return bits


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


class _Features:
    """Of the words of a slice: trigram buckets of their bytes, letters, and scripts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = K.Words(data, offsets)
        raw = K._LOWER[data[words.inside]].astype(np.uint32)
        self.begins = np.cumsum(words.lens) - words.lens
        before, second = np.concatenate(([0], raw[:-1])).astype(np.uint32), np.concatenate(([0, 0], raw[:-2])).astype(np.uint32)[: len(raw)]
        before[self.begins] = 0
        second[self.begins] = 0
        second[(self.begins + 1)[words.lens > 1]] = 0
        self.buckets = ((raw << np.uint32(16) | before << np.uint32(8) | second) * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)
        bits = _letter_bits(raw)
        if len(self.begins):
            self.letters = np.add.reduceat((bits > 0).astype(np.int64), self.begins)
            self.scripts = np.bitwise_or.reduceat(bits, self.begins)
        else:
            self.letters, self.scripts = np.zeros(0, np.int64), np.zeros(0, np.uint16)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language, and how many words have each script."""
    counts: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        data, offsets = K.string_buffers(batch.column("text"))
        for a, b, part, at in K.slices(data, offsets, SLICE_BYTES):
            f = _Features(part, at)
            ends = np.append(f.begins, len(f.buckets))
            for i in range(b - a):
                first, end = f.words.of_doc[i], f.words.of_doc[i + 1]
                lang = langs[a + i]
                counts[lang] = counts.get(lang, 0) + np.bincount(f.buckets[ends[first] : ends[end]], minlength=1 << TABLE_BITS)
                scripts[lang] = scripts.get(lang, 0) + np.array([np.count_nonzero(f.scripts[first:end] >> n & 1) for n in range(_N_SCRIPTS)])
    for lang, own in counts.items():
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([used.astype(np.int32).tobytes()]), pa.array([own[used].astype(np.int64).tobytes()]), pa.array([scripts[lang].tolist()], pa.list_(pa.int64()))], ["lang", "buckets", "counts", "scripts"])


class LanguageModel:
    """langs; log probabilities [lang, bucket]; scripts that each language is written in, as bits."""

    def __init__(self, rows: list):
        self.langs = sorted({r["lang"] for r in rows})
        place = {k: n for n, k in enumerate(self.langs)}
        counts = np.zeros((len(self.langs), 1 << TABLE_BITS))
        scripts = np.zeros((len(self.langs), _N_SCRIPTS))
        for r in rows:
            counts[place[r["lang"]], np.frombuffer(r["buckets"], np.int32)] += np.frombuffer(r["counts"], np.int64)
            scripts[place[r["lang"]]] += r["scripts"]
        smooth = counts + 0.1
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        # a script counts for a language that writes at least one word in a hundred in it
        usual = scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.scripts = (usual << np.arange(_N_SCRIPTS)).sum(axis=1).astype(np.uint16) if len(self.langs) else np.zeros(0, np.uint16)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG) -> LanguageModel:
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = named.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per language
    if not sizes:
        return LanguageModel([])
    scale = 1 << 30
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], int(scale * min(1.0, per_lang / r["n"])))))
    sample = named.where(F.pmod(F.xxhash64("text"), F.lit(scale)) < share[F.col("lang")]).select("text", "lang").distinct()
    tasks = max(1, min(16, sum(min(per_lang, r["n"]) for r in sizes) // 500))
    counted = sample.repartition(tasks).mapInArrow(_gather, "lang string, buckets binary, counts binary, scripts array<bigint>")
    return LanguageModel(counted.collect())  # languages * tasks rows of a bounded sample


def _viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word. All texts of the slice advance together, longest first, so a step is one
    numpy operation over the texts that still have words."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    path = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int16)
    if not len(order):
        return path
    first, left = bounds[order], sizes[order]
    active = np.searchsorted(-left, -np.arange(left[0]), "left")  # texts with more than t words
    stay, jump_from = np.zeros(scores.shape, bool), np.zeros(len(scores), path.dtype)
    best = scores[first].copy()
    for t in range(1, int(left[0])):
        n = int(active[t])
        at, now = first[:n] + t, best[:n]
        top = now.argmax(axis=1)
        switched = now[np.arange(n), top] - penalty
        keeps = now >= switched[:, None]
        stay[at], jump_from[at] = keeps, top
        best[:n] = np.where(keeps, now, switched[:, None]) + scores[at]
    state = best.argmax(axis=1)
    for t in range(int(left[0]) - 1, -1, -1):
        n = int(active[t])
        at = first[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = np.where(stay[at, state[:n]], state[:n], jump_from[at])
    return path


def _word_scores(f: _Features, model: LanguageModel) -> np.ndarray:
    n = len(f.begins)
    scores = np.zeros((n, len(model.langs)), np.float32)
    if not n:
        return scores
    for k in range(len(model.langs)):
        scores[:, k] = np.add.reduceat(model.table[k][f.buckets], f.begins)
    scores -= scores.max(axis=1, keepdims=True)
    fits = (f.scripts[:, None] & model.scripts[None, :]) > 0
    scores[~fits & fits.any(axis=1, keepdims=True)] = -1000
    scores[f.letters == 0] = 0
    return scores


def _labelled(data: np.ndarray, offsets: np.ndarray, model: LanguageModel, penalty: float) -> tuple[_Features, np.ndarray, np.ndarray]:
    """Features, the label of each word, and letters [text, language]."""
    f = _Features(data, offsets)
    path = _viterbi(_word_scores(f, model), f.words.of_doc, penalty)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(f.words.of_doc))
    letters = np.bincount(doc * len(model.langs) + path, f.letters, n * len(model.langs)).reshape(n, -1)
    return f, path, letters


def _predict(model, keep: list[str], penalty: float, text: str = "text"):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value.langs
        for batch in batches:
            data, offsets = K.string_buffers(batch.column(text))
            for a, b, part, at in K.slices(data, offsets, SLICE_BYTES):
                pred, score = [UNKNOWN] * (b - a), np.zeros(b - a)
                if langs:
                    _, _, letters = _labelled(part, at, model.value, penalty)
                    total, best = letters.sum(axis=1), letters.argmax(axis=1)
                    for i in np.flatnonzero(total).tolist():
                        pred[i], score[i] = langs[best[i]], letters[i, best[i]] / total[i]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), pa.array(pred), pa.array(score)], [*keep, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` and lang_pred, score; columns of these names that docs have are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(_predict(shared, docs.columns, penalty, text), f"{fields}, lang_pred string, score double")


def language_spans(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, spans array<struct<start, end, lang>> in code points: runs of words of one language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value.langs
        for batch in batches:
            data, offsets = K.string_buffers(batch.column("text"))
            for a, b, part, at in K.slices(data, offsets, SLICE_BYTES):
                spans: list[list] = [[] for _ in range(b - a)]
                if langs:
                    f, path, _ = _labelled(part, at, shared.value, penalty)
                    chars = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
                    for i in range(b - a):
                        first, end = f.words.of_doc[i], f.words.of_doc[i + 1]
                        cuts = first + np.flatnonzero(np.diff(path[first:end])) + 1
                        for x, y in zip([first, *cuts], [*cuts, end], strict=True):
                            if y > x:
                                last = f.words.starts[y - 1] + f.words.lens[y - 1]
                                spans[i].append({"start": int(chars[f.words.starts[x]] - chars[at[i]]), "end": int(chars[last] - chars[at[i]]), "lang": langs[path[x]]})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(spans, kind)], ["doc_id", "spans"])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"doc_id {dict(named.dtypes)['doc_id']}, spans array<struct<start: bigint, end: bigint, lang: string>>")


def language_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the labelled ones."""
    model = train(docs, doc_id, text, lang)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = named.mapInArrow(_predict(shared, ["doc_id"], SWITCH_PENALTY), f"doc_id {dict(named.dtypes)['doc_id']}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
