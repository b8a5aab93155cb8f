"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a prefix is known from its last token: take that token away and the rest is the encoding of a
shorter prefix. A token may follow the encoding of the rest exactly if it keeps apart from that encoding's
last token when the pair is encoded by itself. So one last token per trie node holds the encodings of all
words that pass it. Distinct words are inserted into a trie by sorting them, which is the order of a
depth-first walk: the path to the current node is a stack, and a word adds only the nodes that it does not
share with the word before it.

``TextEncoder`` cuts whole texts into words by character classes with numpy, looks distinct words up in a
bounded cache, sends the rest through the trie, and puts the ids together by gathers. Words are looked up by hash and
compared, so two words of one hash are told apart. The text of a special token is that token.

Null and empty texts have no ids; there is no limit on the length of texts or words. Every row gives one row, whatever its id:
null and repeated ids, repeated rows and ties are carried along. An empty table gives an empty one. Columns of the input
other than the id and the text are not looked at, so their names may clash with those of the result. Byte sequences that aren't UTF-8
are encoded as U+FFFD, one for each that a decoder would replace.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridweave.llm import textkernel as K

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Words kept by the cache of one Python worker.
CACHE_WORDS = 400_000

_loaded: dict[str, BpeModel] = {}


def _printable_bytes() -> dict[str, int]:
    """The characters by which vocabulary files write bytes: printable Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BpeModel:
    """Merges of a byte-level BPE file, and the trie walk."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_char = _printable_bytes()
        vocab = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for text, k in vocab.items():
            if text not in self.special:
                self.bytes_of[k] = bytes(of_char[c] for c in text)
        self.id_of = {b: k for k, b in enumerate(self.bytes_of) if b}
        for text, k in self.special.items():
            self.bytes_of[k] = text.encode()
        self.suffixes: dict[bytes, int] = {}
        self.left, self.right, self.rank = [0] * size, [0] * size, [-1] * size
        self.pairs: dict[int, int] = {}
        for n, merge in enumerate(spec["model"]["merges"]):
            a, b = (vocab[x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
            k = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.pairs[a << 32 | b] = n
            if self.rank[k] < 0:
                self.left[k], self.right[k], self.rank[k] = a, b, n
        self._apart: dict[int, bool] = {}
        self._library: tiktoken.Encoding | bool | None = None

    def apart(self, a: int, b: int) -> bool:
        """Whether a and b, side by side, are encoded as just these two.

        Looks backwards in time: the later made of the two is taken apart again, and before that moment
        no merge across the border may have come up."""
        key = a << 32 | b
        known = self._apart.get(key)
        if known is not None:
            return known
        rank, pairs, before, out = self.rank, self.pairs, 1 << 60, True
        while True:
            if pairs.get(a << 32 | b, before) < before:
                out = False
                break
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            elif rank[b] >= 0:  # of equal merges, the one further left comes first
                before, b = rank[b] + 1, self.left[b]
            else:
                break
        if len(self._apart) > 1_000_000:
            self._apart.clear()
        self._apart[key] = out
        return out

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Token ids of each word, in one depth-first walk over the trie of all words."""
        if not self.suffixes:  # every suffix of a token; with the token's id where it is one itself
            self.suffixes = {b[i:]: -1 for b in self.id_of for i in range(len(b))} | self.id_of
        get, apart, bytes_of = self.suffixes.get, self.apart, self.bytes_of
        out: dict[bytes, list[int]] = {}
        last: list[int] = [-1]  # last token of the encoding, for each depth of the current path
        path = b""
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                begin, found = depth - 1, []
                while begin >= 0 and (token := get(word[begin:depth])) is not None:
                    if token >= 0:
                        found.append((begin, token))
                    begin -= 1
                for begin, token in reversed(found):
                    if begin == 0 or apart(last[begin], token):
                        last.append(token)
                        break
                else:
                    raise ValueError(f"byte {word[depth - 1]} is not in the vocabulary")
            ids, depth = [], len(word)
            while depth:
                ids.append(last[depth])
                depth -= len(bytes_of[last[depth]])
            out[word] = ids[::-1]
            path = word
        return out


    def library_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The same ids from tiktoken's merge loop, for operators that only need ids. It takes ranks for ids, so
        the ids have to rise with the merges; else the trie does the work."""
        if self._library is None:
            merged = [self.rank[k] for k in range(len(self.rank)) if self.rank[k] >= 0]
            bytes_first = all(self.rank[k] < 0 for k in range(256))
            ranks = {b: k for b, k in self.id_of.items()}
            self._library = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}) if bytes_first and merged == sorted(merged) else False
        if not self._library:
            return self.encode_words(words)
        encode = self._library.encode_ordinary
        return {w: encode(w.decode("utf-8")) for w in words}


def load_model(path: str) -> BpeModel:
    if path not in _loaded:
        _loaded[path] = BpeModel(path)
    return _loaded[path]


def _classes(path: str) -> np.ndarray:
    """Class of each code point. Where the installed Unicode tables disagree (code points of the latest versions),
    the tokenizer file's own library decides."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = kind
    disputed = [c for c in np.flatnonzero(out < SPACE).tolist() if unicodedata.category(chr(c)) == "Cn"]
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str if disputed else None
    for c in disputed:
        ends = [end for _, (_, end) in split(f"a{chr(c)}1")]
        out[c] = LETTER if ends == [2, 3] else NUMBER if ends == [1, 3] else OTHER
    return out


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _code_tables(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The class and a random number of each code point."""
    if path not in _tables:
        _tables[path] = _classes(path), K.random_table(0x110000, 23)
    return _tables[path]


def word_starts(codes: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Places where words start in texts that lie one after the other; bounds: where texts start, and the end.

    Words: a contraction; letters, numbers or other signs, each with a blank before them; white space, whose
    last character goes apart where a text goes on."""
    kind = kinds[codes]
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[bounds] = True
    space, blank = kind == SPACE, codes == 32
    before_blank = np.concatenate(([False], blank[:-1]))
    before_space = np.concatenate(([False], space[:-1]))
    changed = np.concatenate(([True], kind[1:] != kind[:-1]))
    next_ends = np.concatenate((space[1:], [True])) | begins[1:]
    start = np.where(space, changed | (before_space & ~next_ends), changed & ~before_blank)
    start |= begins[:n]
    for at in np.flatnonzero((codes == 39) & start).tolist():
        for c in CONTRACTIONS:
            end = at + len(c)
            if end <= n and not begins[at + 1 : end].any() and codes[at + 1 : end].tolist() == [ord(x) for x in c[1:]]:
                start[at + 1 : end] = False
                start[end : end + 1] = True
                break
    return np.flatnonzero(start)


class TextEncoder:
    """Ids of whole texts; one per Python worker."""

    def __init__(self, path: str, most: int = CACHE_WORDS, trie: bool = True):
        self.model, self.most = load_model(path), most
        self.encode_words = self.model.encode_words if trie else self.model.library_words
        self.kinds, self.numbers = _code_tables(path)
        self._special = [(x.encode(), k) for x, k in self.model.special.items()]
        self.seed = 0
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[int, int] = {}
        self.words: list[str] = []  # of each slot
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, hashes: list[int], words: list[str]) -> None:
        raw = [w.encode() for w in words]
        special = self.model.special
        known = self.encode_words([b for b, w in zip(raw, words, strict=True) if w not in special])
        ids = [[special[w]] if w in special else known[b] for b, w in zip(raw, words, strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first, total = len(self.slots), int(sizes.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while first + len(ids) > len(self.begin):
            self.begin, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.size))
        self.pool[self.used : self.used + total] = np.fromiter((t for x in ids for t in x), np.uint32, total)
        self.begin[first : first + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + len(ids)] = sizes
        self.slots.update(zip(hashes, range(first, first + len(ids)), strict=True))
        self.words += words
        self.used += total

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where texts start and, in bytes, where special tokens start and end; their first bytes."""
        raw, cuts, own = data.tobytes(), [], []
        for text, _ in self._special:
            at = raw.find(text)
            while at >= 0:
                if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(text) - 1, "right"):
                    cuts += [at, at + len(text)]
                    own.append(at)
                    at = raw.find(text, at + len(text))
                else:
                    at = raw.find(text, at + 1)
        return np.union1d(offsets, np.array(cuts, np.int64)), np.array(own, np.int64)

    def _slots_of(self, text: str, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The cache slot of each word. Words of one hash are compared: if any two differ, all is hashed anew by other numbers."""
        lens = np.diff(starts, append=len(codes))
        while True:
            hashes = K.run_hashes(self.numbers[codes], lens, self.seed)
            distinct, first, where = np.unique(hashes, return_index=True, return_inverse=True)
            model = first[where]  # the word that stands for each
            same = len(model) == 0 or ((lens[model] == lens).all() and (codes[np.repeat(starts[model], lens) + K.ranges(lens)] == codes[starts[0] :]).all())
            keys, words = distinct.tolist(), [text[a:b] for a, b in zip(starts[first].tolist(), (starts + lens)[first].tolist(), strict=True)]
            known = list(map(self.slots.get, keys))
            if same and all(k is None or self.words[k] == w for k, w in zip(known, words, strict=True)):
                break
            self.seed += 1
            self._reset()
        missing = [i for i, k in enumerate(known) if k is None]
        if missing:
            if len(self.slots) + len(missing) > self.most:
                self._reset()
                missing = range(len(keys))
            self._add([keys[i] for i in missing], [words[i] for i in missing])
            known = map(self.slots.__getitem__, keys)
        return np.fromiter(known, np.int64, len(keys))[where]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n + 1 offsets into them) of the n texts of a slice."""
        text = data.tobytes().decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        char_at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        bounds, own = self._bounds(data, offsets)
        starts = word_starts(codes, char_at[bounds], self.kinds)
        if len(own):  # a special token is one word: no start inside it
            own = np.sort(own)
            firsts, ends = char_at[own], char_at[bounds[np.searchsorted(bounds, own) + 1]]
            before = np.searchsorted(firsts, starts, "left") - 1  # the last token that begins before each start
            starts = starts[(before < 0) | (starts >= ends[before])]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        slot = self._slots_of(text, codes, starts)
        sizes = self.size[slot]
        ids = self.pool[np.repeat(self.begin[slot], sizes) + K.ranges(sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, ends[np.searchsorted(starts, char_at[offsets])]


def encoded_slices(batch: pa.RecordBatch, column: str, encoder: TextEncoder) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets) of the texts of a batch."""
    data, offsets = K.string_buffers(batch.column(column))
    for a, b, part, at in K.slices(data, offsets):
        yield a, b, *encoder.encode(part, at)


def decode(model: BpeModel, ids: list[int]) -> str:
    return b"".join(map(model.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _digests(path: str):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(path)
        numbers = [str(k) for k in range(len(encoder.model.bytes_of))]
        for batch in batches:
            for a, b, ids, at in encoded_slices(batch, "text", encoder):
                encoded, decoded = [], []
                for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = ids[i:j].tolist()
                    encoded.append(hashlib.sha256(",".join(map(numbers.__getitem__, own)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(decode(encoder.model, own).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at)), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str, names: list[str]):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(path)
        for batch in batches:
            for a, b, ids, at in encoded_slices(batch, "text", encoder):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names), lists], [*names, "ids"])

    return run


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int> of every document."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.make_valid_utf8(text).alias("text"))
    return named.mapInArrow(_ids(path, ["doc_id"]), f"doc_id {dict(named.dtypes)['doc_id']}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows with doc_id, ids; null ids give null."""

    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path)
        for batch in batches:
            texts = [None if x is None else decode(model, x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def encoding_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the text decoded from them."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.make_valid_utf8(text).alias("text"))
    return named.mapInArrow(_digests(path), f"doc_id {dict(named.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
