"""Token alignment of two tokenizers by pointer jumping.

Tokenizer A is byte-level BPE, B a piece model with byte fallback. Both cut the same bytes (a space and the text); every
token points to its farthest-right overlapping token, of equal ones to B's. Doubling of the successors of all tokens at
once converges to the last token of each component, the B token that ends where an A token ends; that token is the
group's label. Tokens of a group are linked, each A occurrence with each B occurrence.

Both tokenizers take a space as a start where a word follows, so a text falls into segments (a word with its space, as a
rule) that are encoded and aligned once each and remembered within bounds; what a text needs is sums over its segments.

The count of a linked id pair is the number of texts that hold it. Texts are handled in blocks: a block counts its
pairs, the sums over blocks are joined back to each block's own pairs, and the block's texts are summed from those. So no
table of all pairs has to fit anywhere, and a pair costs a row per block, not per text.

Edge cases: null and empty texts have no tokens; neither has a text whose tokens do not give back its bytes (one with
U+2581, which B reads as a space); special tokens in a text are plain text; texts of any length are encoded whole;
repeated rows count as texts of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.llm import common as C
from vulnlake.llm.bpe import byte_letters

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_LETTER = "▁"
#: Segments remembered in a task; then it starts anew.
CACHE_SEGMENTS = 200_000
#: Bytes of text in a block, but for one longer text.
BLOCK_BYTES = 2 << 20
#: Bytes of new segments encoded at once.
ENCODE_BYTES = 1 << 18
#: Pairs written out at once when groups are expanded.
EXPAND = 1 << 20
BLOCK_BITS = 24
FILE_BLOCKS = 8

# Bytes that can follow a space at a cut: no white space, nor the first byte of any beyond ASCII.
WORD_STARTS = bytes(b for b in range(0x21, 0xF5) if not 0x7F <= b < 0xC3 and b not in (0xE1, 0xE2, 0xE3))


def share(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    """Both tokenizer files, read on the driver and broadcast: a fixed size of some megabytes."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def jumped(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered from left to right; both tokenizers cover the same bytes."""
    n = len(a_ends)
    over = np.searchsorted(b_ends, a_ends, "left")
    back = np.searchsorted(a_ends, b_ends, "left")
    own = np.arange(len(b_ends)) + n
    successor = np.concatenate([over + n, np.where(a_ends[back] > b_ends, back, own)]) if n else own
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    last = np.flatnonzero(successor[n:] == own)
    group = np.searchsorted(last + n, successor)
    return group[:n], group[n:]


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices of all items of the given ranges, range by range."""
    return np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)


def _cuts(ids: np.ndarray, groups: int) -> np.ndarray:
    """Where each group's items begin, and the end, in a sorted list of group numbers."""
    return np.searchsorted(ids, np.arange(groups + 1))


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: Any):
        self.data, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.empty(max(need, len(self.data)), self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.data[: self.size][at]


class Aligner:
    """Segments aligned so far in this task: token, group and link counts, groups as text, and linked pairs."""

    def __init__(self, a_spec: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = {c: b for b, c in enumerate(byte_letters())}
        self.a_bytes = [bytes(letters[c] for c in self.a.id_to_token(i)) if set(self.a.id_to_token(i)) <= letters.keys() else b"" for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_LETTER in p.lstrip(SPACE_LETTER) for p in pieces):
            raise ValueError("a piece has a space after a letter: texts cannot be cut at spaces")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_LETTER, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.text: list[bytes] = []
        self.counts = {c: Grown(np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        self.bad, self.ends = Grown(bool), Grown(np.int64)
        self.pair, self.times = Grown(np.int64), Grown(np.int64)

    def _encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or nothing where they do not give back the bytes. ``text`` begins with a space."""
        whole = text.decode()
        a, b = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.b.encode(whole[1:], num_threads=1)
        if b"".join(map(self.a_bytes.__getitem__, a)) != text or b"".join(map(self.b_bytes.__getitem__, b)) != text:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _encoded(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all segments that both give back, and which those are."""
        ok = np.ones(len(segments), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        first = 0
        while first < len(segments):
            end, size = first, 0
            # Segments that end with a space are encoded alone: the next one's space would join theirs.
            while end < len(segments) and size < ENCODE_BYTES and (end == first or not segments[end - 1].endswith(b" ")):
                size += len(segments[end])
                end += 1
            ids = self._encode(b"".join(segments[first:end]))
            if ids is not None:
                found.append(ids)
            else:
                for k in range(first, end):
                    ids = self._encode(segments[k])
                    ok[k] = ids is not None
                    found += [ids] if ids is not None else []
            first = end
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)]), ok

    def add(self, hashes: list[int], segments: list[bytes]) -> None:
        """Encode and align new segments."""
        a, b, ok = self._encoded(segments)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_group, b_group = jumped(a_ends, b_ends)
        groups = int(b_group[-1]) + 1 if len(b_group) else 0
        a_at, b_at = _cuts(a_group, groups), _cuts(b_group, groups)
        n_a, n_b = np.diff(a_at), np.diff(b_at)
        ends = np.cumsum(np.where(ok, [len(s) for s in segments], 0))
        # Segment k holds the groups that end in it.
        g_at = np.concatenate([[0], np.searchsorted(b_ends[b_at[1:] - 1], ends, "right")]) if groups else np.zeros(len(segments) + 1, np.int64)
        total = lambda values: np.concatenate([[0], np.cumsum(values)])
        for name, values in (("n_a", n_a), ("n_b", n_b), ("n_groups", np.ones(groups, np.int64)), ("n_links", n_a * n_b)):
            self.counts[name].add(np.diff(total(values)[g_at]))
        self.bad.add(~ok)

        data, starts = _written(a, b, a_group, b_group, a_at, b_at)
        edges = starts[g_at].tolist()
        self.text += [data[p : max(p, q - 1)] for p, q in zip(edges, edges[1:])]

        owner = np.repeat(np.arange(len(segments)), np.diff(g_at))
        parts = [_pairs(a, b, a_at, b_at, owner, first, end) for first, end in _steps(n_a * n_b)]
        segment, pair, times = (np.concatenate([np.zeros(0, np.int64), *p]) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        segment, pair, times = _summed(segment, pair, times)
        self.ends.add(self.pair.size + np.searchsorted(segment, np.arange(len(segments)), "right"))
        self.pair.add(pair)
        self.times.add(times)
        for h in hashes:
            self.known[h] = len(self.known)

    def pairs_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs and their times of the given segments in a row, and how many each segment has."""
        ends = self.ends.data[: self.ends.size]
        begins = np.where(at > 0, ends[at - 1], 0)
        n = ends[at] - begins
        where = _spread(begins, n)
        return self.pair[where], self.times[where], n


def _written(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as text, ``a1,a2|b1;`` each, and where each group's text starts (and the end)."""
    total = len(a) + len(b)
    ids, marks = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    ids[np.arange(len(a)) + b_at[a_group]] = a
    ids[np.arange(len(b)) + a_at[b_group + 1]] = b
    marks[a_at[1:] + b_at[:-1] - 1] = ord("|")
    marks[a_at[1:] + b_at[1:] - 1] = ord(";")
    size = np.ones(total, np.int64)
    bound = 10
    while bound <= ids.max(initial=0):
        size += ids >= bound
        bound *= 10
    ends = np.cumsum(size + 1)
    out = np.empty(ends[-1] if total else 0, np.uint8)
    out[ends - 1] = marks
    for k in range(int(size.max(initial=0))):
        live = size > k
        out[ends[live] - 2 - k] = 48 + ids[live] % 10
        ids //= 10
    return out.tobytes(), np.concatenate([[0], ends])[a_at + b_at]


def _steps(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of groups with some ``EXPAND`` links each; a larger group is a range of its own."""
    sums, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = sums[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sums, before + EXPAND, "right")))
        yield first, end
        first = end


def _pairs(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, owner: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked id pairs of a range of groups: the segment, the pair, and how often."""
    if end == first + 1 and (a_at[end] - a_at[first]) * (b_at[end] - b_at[first]) > EXPAND:
        one, n_one = np.unique(a[a_at[first] : a_at[end]], return_counts=True)
        two, n_two = np.unique(b[b_at[first] : b_at[end]], return_counts=True)
        pair = (one[:, None] << 32 | two[None, :]).ravel()
        return np.full(len(pair), owner[first]), pair, np.outer(n_one, n_two).ravel()
    n_a, n_b = np.diff(a_at[first : end + 1]), np.diff(b_at[first : end + 1])
    group = np.repeat(np.arange(first, end), n_a * n_b)
    k, wide = _spread(np.zeros(end - first, np.int64), n_a * n_b), n_b[group - first]
    pair = a[a_at[group] + k // wide] << 32 | b[b_at[group] + k % wide]
    return _summed(owner[group], pair, np.ones(len(pair), np.int64))


def _summed(segment: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((pair, segment))
    segment, pair = segment[order], pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return segment[at], pair[at], np.add.reduceat(times[order], at) if len(at) else times


def _segments(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with a space before each: their bytes, and the start, end and text of every segment."""
    n = len(at) - 1
    size = np.diff(at)
    spaced = np.full(len(data) + n, 32, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), size)] = data
    begin = at[:-1] + np.arange(n)
    cut = np.zeros(len(spaced), bool)
    cut[1:-1] = (spaced[1:-1] == 32) & (spaced[:-2] != 32) & C.table_of(WORD_STARTS)[spaced[2:]]
    cut[begin] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(spaced))
    owner = np.searchsorted(begin, starts, "right") - 1
    full = size[owner] > 0
    return spaced, starts[full], ends[full], owner[full]


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows of two columns in order, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    sorted_ = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in sorted_], axis=0)
    at = np.flatnonzero(new)
    return *(c[at] for c in sorted_), np.diff(np.append(at, len(order)))


SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _list(values: np.ndarray | list, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _block(aligner: Aligner, data: np.ndarray, at: np.ndarray, keep_groups: bool) -> dict[str, pa.ListArray]:
    n = len(at) - 1
    spaced, starts, ends, owner = _segments(data, at)
    hashes = C.run_hashes(spaced, starts, ends)
    distinct, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
    if len(aligner.text) > CACHE_SEGMENTS:
        aligner.clear()
    keys = distinct.tolist()
    new = [k for k, h in enumerate(keys) if h not in aligner.known]
    if new:
        aligner.add([keys[k] for k in new], [spaced[starts[sample[k]] : ends[sample[k]]].tobytes() for k in new])
    known = np.fromiter((aligner.known[h] for h in keys), np.int64, len(keys))
    used = known[number]

    bad = np.zeros(n, bool)
    bad[owner[aligner.bad[used]]] = True
    good = ~bad[owner]
    owner, number, used = owner[good], number[good], used[good]
    cuts = np.searchsorted(owner, np.arange(n + 1)).tolist()
    rows = used.tolist()
    text = aligner.text
    groups = [b";".join([text[k] for k in rows[p:q]]) for p, q in zip(cuts, cuts[1:])]
    digests = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
    out = {s: _list(np.bincount(owner, aligner.counts[s][used], n).astype(np.int64), pa.int64()) for s in SUMS}
    out["groups_sha256"] = _list(digests, pa.string())
    if keep_groups:
        out["groups"] = _list([g.decode() for g in groups], pa.string())

    # Distinct segments of every text, and distinct pairs of every segment, by their numbers within the block.
    text_no, segment, often = _distinct(owner, number)
    pair, times, n_pairs = aligner.pairs_of(known)
    pairs, place = np.unique(pair, return_inverse=True)
    segment_at = np.concatenate([[0], np.cumsum(n_pairs)])
    held = place[_spread(segment_at[segment], n_pairs[segment])]
    _, met, _ = _distinct(np.repeat(text_no, n_pairs[segment]), held)
    out |= {
        "pairs": _list(pairs, pa.int64()),
        "pair_texts": _list(np.bincount(met, minlength=len(pairs)), pa.int32()),
        "segment_ends": _list(segment_at[1:], pa.int32()),
        "segment_pairs": _list(place, pa.int32()),
        "segment_times": _list(times, pa.int64()),
        "text_ends": _list(np.searchsorted(text_no, np.arange(n), "right"), pa.int32()),
        "text_segments": _list(segment, pa.int32()),
        "text_times": _list(often, pa.int32()),
    }
    return out


def blocks(df: DataFrame, tokenizers: Broadcast, key: str = "doc_id", text: str = "text", keep_groups: bool = False) -> DataFrame:
    """Texts encoded and aligned, a row per block of texts; write it before use."""
    kind = dict(df.dtypes)[key]
    lists = {"keys": kind, **dict.fromkeys(SUMS, "bigint"), "groups_sha256": "string", **({"groups": "string"} if keep_groups else {})}
    lists |= {"pairs": "bigint", "pair_texts": "int", "segment_ends": "int", "segment_pairs": "int", "segment_times": "bigint"}
    lists |= {"text_ends": "int", "text_segments": "int", "text_times": "int"}

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*tokenizers.value)
        block = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text, BLOCK_BYTES):
                keys = batch.column(key).slice(first, end - first)
                row = {"block": pa.array([block], pa.int64()), "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)}
                row |= _block(aligner, data, at, keep_groups)
                yield pa.RecordBatch.from_arrays([row[c] for c in ("block", *lists)], ["block", *lists])
                block += 1
        del aligner
        C.give_back()

    return df.select(key, text).mapInArrow(batches, ", ".join(["block bigint", *(f"{c} array<{t}>" for c, t in lists.items())]))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Every linked id pair (A's id in the upper half): ``n`` texts that hold it, and whether no pair of its A id is in more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "pair_texts")).alias("p")).select("p.pairs", "p.pair_texts")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_texts").alias("n")).withColumn("a", F.shiftright("pair", 32))
    counts = C.stage(counts, C.scratch(aligned.sparkSession, "pair-counts"))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _gathered(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over consecutive ranges."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(np.concatenate([[0], total[ends]]))


def aligned(written: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every text of the written blocks: the key, its counts, its groups, and the sums over its links.

    ``n_best``: links whose count is the highest of their A id; ``count_sum``: the counts of all links.
    """
    own = written.select("block", F.explode("pairs").alias("pair"))
    found = own.join(pair_counts(written), "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("found"))
    kinds = dict(written.dtypes)
    shown = [key, *SUMS, *(["groups"] if "groups" in kinds else []), "groups_sha256"]
    lists = ["keys", *shown[1:]]
    need = ["pairs", "segment_ends", "segment_pairs", "segment_times", "text_ends", "text_segments", "text_times"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for k in range(batch.num_rows):
                v = {c: batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in need}
                n, best = np.zeros(len(v["pairs"]), np.int64), np.zeros(len(v["pairs"]), bool)
                rows = batch.column("found")[k]
                if rows.is_valid:
                    at = np.searchsorted(v["pairs"], rows.values.field("pair").to_numpy())
                    n[at] = rows.values.field("n").to_numpy()
                    best[at] = rows.values.field("best").to_numpy(zero_copy_only=False)
                out = [batch.column(c)[k].values for c in lists]
                for weight in (best.astype(np.int64), n):
                    segment = _gathered(weight[v["segment_pairs"]] * v["segment_times"], v["segment_ends"])
                    out.append(pa.array(_gathered(segment[v["text_segments"]] * v["text_times"], v["text_ends"])))
                yield pa.RecordBatch.from_arrays(out, [*shown, "n_best", "count_sum"])

    each = [f"`{c}` {kinds[kept].removeprefix('array<').removesuffix('>')}" for c, kept in zip(shown, lists)]
    return written.select("block", *lists, *need).join(found, "block", "left").mapInArrow(batches, ", ".join([*each, "n_best bigint", "count_sum bigint"]))
