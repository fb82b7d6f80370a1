"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Leaves hold the rank of the pair that starts at a symbol, each node the lesser of its two children, so the root is the
lowest rank, and the first child that has it leads to its leftmost pair. A merge changes three leaves; each change climbs one
path of the tree, as far as it matters. A word of n symbols takes O(n log n), whatever its length.

The tokenizer file is read on the driver and broadcast (a vocabulary, a few MB); executors need no copy of it.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import parquet, small_batches

#: Entries of each generation of a worker's caches of chunks and of words, and characters of an entry's key; longer ones are done anew each time, which bounds the caches' bytes.
CHUNKS, WORDS, LONGEST = 1 << 17, 1 << 18, 64
#: More than any rank.
NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable and no blank, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Cache:
    """A dict of two generations: when the young one is full, it becomes the old one, and the old one goes."""

    def __init__(self, most: int):
        self.young, self.old, self.most = {}, {}, most

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordBPE:
    """The model of a tokenizer file: NFC and lower case, blanks dropped, byte-level symbols, the last of a word marked."""

    BLANK = regex.compile(r"\p{White_Space}+")

    def __init__(self, text: str):
        file = json.loads(text)
        model = file["model"]
        self.vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a BPE model without prefixes or dropout is needed")
        kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or file["decoder"] is not None or file["post_processor"] is not None:
            raise ValueError("another normalizer, decoder or post-processor than this module knows")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.vocab[a] << 32) | self.vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.inner, self.last = [self.vocab[s] for s in symbols], [self.vocab[s + end] for s in symbols]
        self.token = {i: t for t, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.token |= {i: t for t, i in self.added.items()}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        split = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        self.one_word = all(self.pieces(w) == [w] for w in ("a", "ab", "éß", "日本", "ʰª"))  # letters alone are one piece
        self.numeral = {i: str(i) for i in self.token}
        self.chunks, self.words = Cache(CHUNKS), Cache(WORDS)

    def merge(self, ids: list[int]) -> list[int]:
        n = len(ids)
        if n < 2:
            return ids
        rank, merged, none = self.rank.get, self.merged, NONE
        half = 1 << (n - 2).bit_length()  # the tree: node x has the children 2x and 2x + 1, leaf i is node half + i
        tree = [none] * half + [rank((a << 32) | b, none) for a, b in zip(ids, ids[1:], strict=False)] + [none] * (half - n + 1)
        for x in range(half - 1, 0, -1):
            a, b = tree[2 * x], tree[2 * x + 1]
            tree[x] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while (r := tree[1]) != none:
            x = 1
            while x < half:  # down to the leftmost leaf of this rank
                x += x
                if tree[x] != r:
                    x += 1
            i = x - half
            j = after[i]
            k = after[i] = after[j]
            before[k] = i
            left = ids[i] = merged[r]
            ids[j] = -1
            h = before[i]
            tree[x] = rank((left << 32) | ids[k], none) if k < n else none
            changed = [x]
            if k < n:
                tree[half + j] = none
                if x ^ 1 != half + j:
                    changed.append(half + j)
            if h >= 0:
                tree[half + h] = rank((ids[h] << 32) | left, none)
                if x ^ 1 != half + h:
                    changed.append(half + h)
            for x in changed:  # up, as far as a node's least child changes; siblings share a path
                low = tree[x]
                while x > 1:
                    other = tree[x ^ 1]
                    if other < low:
                        low = other
                    x >>= 1
                    if tree[x] == low:
                        break
                    tree[x] = low
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> tuple[int, str, str]:
        """Of a piece: the number of ids, the ids joined by spaces, the tokens joined by spaces."""
        if (found := self.words.get(word)) is None:
            data = word.encode()
            ids = [self.inner[b] for b in data]
            ids[-1] = self.last[data[-1]]
            found = self.shown(self.merge(ids))
            if len(word) <= LONGEST:
                self.words.put(word, found)
        return found

    def shown(self, ids: list[int]) -> tuple[int, str, str]:
        numeral, token = self.numeral, self.token
        return len(ids), " ".join([numeral[i] for i in ids]), " ".join([token[i] for i in ids])

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        """As word(), of a text without blanks."""
        if (found := self.chunks.get(chunk)) is None:
            text = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            if text.isalpha() and self.one_word:
                found = self.word(text)
            else:
                parts = [self.word(w) for w in self.pieces(text)]
                found = parts[0] if len(parts) == 1 else (sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]))
            if len(chunk) <= LONGEST:
                self.chunks.put(chunk, found)
        return found

    def found(self, text: str) -> list[tuple[int, str, str]]:
        """The chunks' results in order. Added tokens are cut out of the raw text first; nothing else spans blanks."""
        if not self.specials or "<" not in text or not self.specials.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*self.plain(text[at : m.start()]), (1, str(self.added[m[0]]), m[0])]
            at = m.end()
        return out + self.plain(text[at:])

    def plain(self, text: str) -> list[tuple[int, str, str]]:
        # str.split also splits at U+001C to U+001F, which are no white space to the tokenizer
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        chunks = [c for c in self.BLANK.split(text) if c] if odd else text.split()
        known, chunk = self.chunks.young.get, self.chunk
        return [known(c) or chunk(c) for c in chunks]

    def coded(self, text: str) -> tuple[int, str, str]:
        """The number of ids, the ids joined by spaces, the decoded text."""
        found = self.found(text)
        return sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.coded(text)[1].split()]

    def decode(self, ids) -> str:
        return " ".join([self.token[i] for i in ids])


_loaded: dict[str, WordBPE] = {}


def bpe(text: Column, path: str, spark, full: bool = False) -> Column:
    """A struct of n_tokens, ids_sha256 and decoded_sha256, with full also ids and decoded; a null text counts as empty."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    key, shipped = sha256(content.encode()).hexdigest(), spark.sparkContext.broadcast(content)
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full

    @F.pandas_udf(kind)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _loaded:
            _loaded[key] = WordBPE(shipped.value)
        model = _loaded[key]
        for batch in texts:
            rows = []
            for t in batch:
                n, ids, decoded = model.coded(t or "")
                row = (n, sha256(ids.encode()).hexdigest(), sha256(decoded.encode()).hexdigest())
                rows.append((*row, [int(i) for i in ids.split()], decoded) if full else row)
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in kind.split(", ")])

    return run(text)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = False) -> DataFrame:
    """Per input row: the identifier (as it is, null or repeated), n_tokens, ids_sha256, decoded_sha256, with full also ids and decoded.

    Null and empty texts have no tokens. Texts of any length are encoded whole. Other columns don't matter. An
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    coded = docs.select(F.col(id_col).alias("doc_id"), bpe(F.col(text_col), path, docs.sparkSession, full).alias("coded"))
    return coded.select("doc_id", "coded.*")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(parquet(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
