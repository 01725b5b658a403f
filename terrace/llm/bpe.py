"""Byte-pair encoding and decoding with a given vocabulary.

Words are merged on a contiguous rank array: one list holds the parts of the
word, another the rank of the merge of each part with its right neighbour. The
smallest rank is looked for again and again (the first of equals), its right
boundary is deleted, and the two ranks beside it are refreshed. Scanning beats a
queue on short words; words of more than ``SHORT`` parts use a heap of the same
merges in the same order, since scanning would be quadratic there.

The text is cut at blanks and line feeds, over which neither the normaliser nor
the word pattern reaches, and the pieces are remembered in two generations of
bounded size. Encoding runs in Arrow batches of bounded bytes; the vocabulary
is broadcast and has a fixed size. A null or empty text has no tokens; repeated
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of newer Unicode versions, which the tokenizer's own library takes for symbols.
NEW_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x1C89, 0x1C89), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CB, 0xA7CC), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DA, 0xA7DA), (0xA7DC, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10D50, 0x10D65), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
# Capitals of newer Unicode versions and their small letters.
NEW_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
SYMBOL = "\ue000"          # stands for one of them while words are found
SHORT = 128
BATCH_BYTES = 1 << 21
CACHED = 150_000            # pieces per generation
LONGEST_CACHED = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one above 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        model = doc["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.pairs: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[self.ids[left], self.ids[right]] = rank
            self.made.append(self.ids[left + right])
        pattern = doc["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.blanks = regex.compile(r"\s+")
        names = sorted(self.special, key=len, reverse=True)
        self.names = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        as_class = lambda ranges: "".join(f"{chr(a)}-{chr(z)}" for a, z in ranges)
        self.symbol_like = regex.compile(f"[{as_class(NEW_LETTERS)}]")
        self.new = regex.compile(f"[{as_class(NEW_LETTERS)}{''.join(map(chr, NEW_CAPITALS))}]")
        self.symbols = regex.compile(f"{SYMBOL}{SYMBOL}|{SYMBOL}")
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.suffix] for c in letters]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge_short(self, parts: list[int]) -> list[int]:
        pairs, made, none = self.pairs, self.made, len(self.made)
        ranks = [pairs.get(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            parts[k] = made[low]
            del parts[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = pairs.get((parts[k], parts[k + 1]), none)
            if k:
                ranks[k - 1] = pairs.get((parts[k - 1], parts[k]), none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, by a heap over a linked list."""
        pairs, n = self.pairs, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, k, parts[k], parts[k + 1]) for k in range(n - 1)
                if (rank := pairs.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            nxt = after[k]
            if nxt >= n or parts[k] != left or parts[nxt] != right:
                continue
            parts[k], parts[nxt] = self.made[rank], -1
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (new := pairs.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (new, a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.last[data[-1]])
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def plain(self, text: str) -> list[int]:
        """Tokens of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # letters are lowered one by one, without the final form of sigma
        text = self.blanks.sub(" ", text).replace("Σ", "σ")
        if text.isascii() or not self.new.search(text):
            return [i for w in self.words.findall(text.lower()) for i in self.word(w)]
        text = text.translate(NEW_CAPITALS).lower()
        new = iter(self.symbol_like.findall(text))
        words = self.words.findall(self.symbol_like.sub(SYMBOL, text.replace(SYMBOL, SYMBOL + SYMBOL)))
        return [i for w in words for i in self.word(self.symbols.sub(
            lambda m: SYMBOL if len(m[0]) == 2 else next(new), w))]

    def piece(self, piece: str) -> bytes:
        """Token ids of a piece as native 32-bit integers, remembered."""
        got = self.old.get(piece)
        if got is None:
            out = array("i")
            if self.names is None or "<" not in piece:
                out.extend(self.plain(piece))
            else:
                for part in self.names.split(piece):
                    if part in self.special:
                        out.append(self.special[part])
                    elif part:
                        out.extend(self.plain(part))
            got = out.tobytes()
        if len(piece) <= LONGEST_CACHED:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        """Token ids as native 32-bit integers."""
        miss = self.piece
        return b"".join([self.young.get(p) or miss(p) for p in text.replace("\n", " ").split(" ") if p])

    def decode(self, ids: list[int]) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; one row at least."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > limit:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) of every row: token ids and the text decoded from them."""
    with open(path, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(spec.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups([len(t or "") for t in texts], BATCH_BYTES):
                data = [bpe.encode(t or "") for t in texts[a:b]]
                ends = [0]
                for d in data:
                    ends.append(ends[-1] + len(d) // 4)
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(data))])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    pa.array([bpe.decode(array("i", d).tolist()) for d in data], pa.string())],
                    names=[key, "ids", "decoded"])

    rows = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded string")
