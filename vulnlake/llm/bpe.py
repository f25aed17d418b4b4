"""BPE encoding and decoding with a contiguous rank array.

A vocabulary file of the lower-casing word kind is read once on the driver and broadcast (tens of thousands of
entries, a fixed size). A task splits texts into words, encodes each new word once, and lays the ids out per text.
Short words are encoded together: a row of part ids and a row of the ranks of adjacent parts per word; each step
scans every row for its minimum, deletes that boundary, and refreshes the two ranks beside it. Words beyond
``SHORT`` bytes go through a heap over a linked list, which gives the same merges without quadratic scans.

Text is split at special tokens first; the rest is composed (NFC), lower-cased character by character, and split by
the word pattern; white space is dropped. The file names no decoder, so decoding joins the tokens with spaces.

Edge cases: null counts as empty text and gives no ids; null ids decode to null; texts of any length are encoded
whole; repeated rows are encoded one by one (their words once); an empty table gives an empty result. New
columns take the names the caller gives.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "word_bpe_49k.json"
SHORT = 32
CACHE_WORDS = 200_000
NONE = np.int32(2**31 - 1)
END = "</w>"
CHUNK_CHARS = 2 << 20

# Fixed values of Unicode 16.0, which the vocabulary's engine knows and ``unicodedata`` may not:
# its new letters and numbers, and the lower case of its new capitals.
UNICODE_16 = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-113D3 116D0-116E3
11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF
1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA
""".split()
LOWER_16 = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
CAPITALS_16 = regex.compile("[" + "".join(map(chr, LOWER_16)) + "]").search


def byte_letters() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else a letter from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = [chr(b) for b in range(256)]
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        letters[b] = chr(256 + n)
    return letters


def load(path: str) -> dict[str, Any]:
    """Tables of a vocabulary file; special tokens come last in the list of tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab: dict[str, int] = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in [*vocab.items(), *special.items()]:
        tokens[i] = token
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
    order = np.argsort(pairs, kind="stable")
    letters = byte_letters()
    pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return {
        "pairs": pairs[order],
        "ranks": order.astype(np.int32),
        "made": np.array([vocab[a + b] for a, b in merges], dtype=np.int32)[order],
        "bytes": np.array([vocab[c] for c in letters], dtype=np.int32),
        "last": np.array([vocab[c + END] for c in letters], dtype=np.int32),
        "tokens": tokens,
        "special": special,
        "pattern": pattern,
        **_newer(pattern),
    }


def _newer(pattern: str) -> dict[str, str]:
    """Letters and numbers that the pattern engine knows but Unicode 16.0 does not.

    The vocabulary's own engine takes them for symbols; ``newer`` finds them, ``newer_pattern`` splits texts that hold one.
    """
    known = regex.compile(r"[\p{L}\p{N}]")
    new = {c for a, b in (r.split("-") for r in UNICODE_16) for c in range(int(a, 16), int(b, 16) + 1)}
    points = [c for c in range(0x110000) if c not in new and not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    if not points:
        return {"newer": "", "newer_pattern": pattern}
    breaks = np.flatnonzero(np.diff(points) != 1)
    first, last = [points[0], *(points[i + 1] for i in breaks)], [*(points[i] for i in breaks), points[-1]]
    inner = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first, last))
    own = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{inner}]]")
    own = own.replace(r"[\p{L}]", rf"[\p{{L}}--[{inner}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{inner}]]")
    return {"newer": f"[{inner}]", "newer_pattern": own}


def share(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(load(path))


class Encoder:
    """Words of texts to ids, with a bounded memory of the words seen."""

    def __init__(self, tables: dict[str, Any]):
        self.t = tables
        self.findall = regex.compile(tables["pattern"]).findall
        self.newer = regex.compile(tables["newer"]).search if tables["newer"] else None
        self.newer_findall = regex.compile(tables["newer_pattern"], regex.V1).findall
        self.special = tables["special"]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)
        for token, i in self.special.items():
            self.known["\0" + token] = len(self.known)
            self.ids, self.at = np.append(self.ids, np.int32(i)), np.append(self.at, self.at[-1] + 1)

    def word(self, text: str) -> list[str]:
        if self.newer is None or text.isascii() or not self.newer(text):
            return self.findall(text)
        return self.newer_findall(text)

    def words(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.word(_normal(text))
        out: list[str] = []
        for part in self.cut(text):
            out += ["\0" + part] if part in self.special else self.word(_normal(part))
        return out

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of every text. Words are looked up as they come and the new ones encoded together."""
        if len(self.known) > CACHE_WORDS:
            self.forget()
        fresh = _Numbers(self.known)
        rows = [np.fromiter(map(fresh.__getitem__, self.words(t or "")), np.int64) for t in texts]
        new = list(fresh)[len(self.known) :]
        self.known = dict(fresh)
        if new:
            ids, sizes = self._encode_words([w.encode("utf-8") for w in new])
            self.ids = np.concatenate([self.ids, ids])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        return [_gather(self.ids, self.at, row) for row in rows]

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(w) for w in words])
        out: list[np.ndarray | None] = [None] * len(words)
        for i in np.flatnonzero(size > SHORT):
            out[i] = self._long(words[i])
        order = np.argsort(size, kind="stable")
        order = order[size[order] <= SHORT]
        for low in range(0, SHORT, 4):
            some = order[(size[order] > low) & (size[order] <= low + 4)]
            for k in range(0, len(some), 20_000):
                part = some[k : k + 20_000]
                ids, n = self._short([words[i] for i in part], size[part])
                for i, row, m in zip(part, ids, n):
                    out[i] = row[:m]
        sizes = np.array([len(x) for x in out])
        return np.concatenate(out).astype(np.int32), sizes

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.t["pairs"], key), len(self.t["pairs"]) - 1)
        found = self.t["pairs"][at] == key
        return np.where(found, self.t["ranks"][at], NONE), self.t["made"][at]

    def _short(self, words: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts and their number per word, all words of one width class at once."""
        width = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        parts = self.t["bytes"][raw]
        row = np.arange(len(words))
        parts[row, size - 1] = self.t["last"][raw[row, size - 1]]
        n = size.copy()
        ranks = np.full((len(words), width), NONE, np.int32)
        live_pairs = np.arange(width - 1) < (n - 1)[:, None]
        ranks[:, : width - 1][live_pairs] = self._ranks(parts[:, :-1][live_pairs], parts[:, 1:][live_pairs])[0]
        done = np.empty_like(parts)
        columns = np.arange(width)
        while len(row):
            at = ranks.argmin(axis=1)
            here = np.arange(len(row))
            more = ranks[here, at] != NONE
            if not more.all():
                done[row[~more]] = parts[~more]
                row, parts, ranks, at = row[more], parts[more], ranks[more], at[more]
                here = here[: len(row)]
                if not len(row):
                    break
            _, made = self._ranks(parts[here, at], parts[here, at + 1])
            n[row] -= 1
            # Delete the boundary after ``at``: what stands right of it moves one to the left.
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, take, 1)
            parts[here, at] = made
            ranks = np.take_along_axis(ranks, take, 1)
            ranks[:, -1] = NONE
            count = n[row]
            ranks[here, at] = NONE
            some = at + 1 < count
            ranks[here[some], at[some]] = self._ranks(made[some], parts[here[some], at[some] + 1])[0]
            some = at > 0
            ranks[here[some], at[some] - 1] = self._ranks(parts[here[some], at[some] - 1], made[some])[0]
        return done, n

    def _long(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, np.uint8)
        parts = self.t["bytes"][raw].tolist()
        parts[-1] = int(self.t["last"][raw[-1]])
        n = len(parts)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        table = getattr(self, "_table", None)
        if table is None:
            table = self._table = {int(p): (int(r), int(m)) for p, r, m in zip(self.t["pairs"], self.t["ranks"], self.t["made"])}
        heap: list[tuple[int, int, int]] = []

        def push(i: int) -> None:
            if i >= 0 and right[i] >= 0 and (hit := table.get(parts[i] << 32 | parts[right[i]])):
                heapq.heappush(heap, (hit[0], i, parts[right[i]]))

        for i in range(n):
            push(i)
        while heap:
            rank, i, with_ = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j < 0 or parts[j] != with_ or (hit := table.get(parts[i] << 32 | with_)) is None or hit[0] != rank:
                continue
            parts[i], alive[j], right[i] = hit[1], False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            push(left[i])
            push(i)
        return np.array([p for p, a in zip(parts, alive) if a], np.int32)


class _Numbers(dict):
    """Numbers new keys in the order they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _normal(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    if text.isascii():
        return text.lower()
    text = text.replace("Σ", "σ")
    return (text.translate(LOWER_16) if CAPITALS_16(text) else text).lower()


def _gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    first, size = at[rows], at[rows + 1] - at[rows]
    ends = np.cumsum(size)
    index = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return flat[index]


def decode_ids(tokens: list[str], ids: Iterable[int]) -> str:
    return " ".join(map(tokens.__getitem__, ids))


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)))


def encoded(df: DataFrame, tables: Broadcast, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the ids of each text as an array."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        for batch in source:
            rows = [x for part in _chunks(batch.column(text).to_pylist()) for x in encoder.encode(part)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(rows)], [*batch.schema.names, into])

    return df.mapInArrow(batches, ", ".join([f"`{c}` {t}" for c, t in df.dtypes] + [f"`{into}` array<int>"]))


def decoded(df: DataFrame, tables: Broadcast, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text that each array of ids stands for."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tables.value["tokens"]
        for batch in source:
            texts = [None if x is None else decode_ids(tokens, x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return df.mapInArrow(batches, ", ".join([f"`{c}` {t}" for c, t in df.dtypes] + [f"`{into}` string"]))


def round_trip(df: DataFrame, tables: Broadcast, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per text: the number of ids, the digest of the ids, and the digest of what they decode to; one pass.

    ``keep_ids`` adds the ids themselves.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        tokens = encoder.t["tokens"]
        shown = [str(i) for i in range(len(tokens))]
        for batch in source:
            sizes, ids_digests, text_digests, kept = [], [], [], []
            for part in _chunks(batch.column(text).to_pylist()):
                for ids in encoder.encode(part):
                    numbers = ids.tolist()
                    if keep_ids:
                        kept.append(ids)
                    sizes.append(len(numbers))
                    ids_digests.append(hashlib.sha256(" ".join(map(shown.__getitem__, numbers)).encode()).hexdigest())
                    text_digests.append(hashlib.sha256(decode_ids(tokens, numbers).encode()).hexdigest())
            columns = [batch.column(key), pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns, names = [*columns, _lists(kept)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
