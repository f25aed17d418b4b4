"""Benchmark decontamination with a distributed positional inverted index.

The index is a table with a row per block of training texts: the block's distinct terms, and for each term the sorted
positions of its tokens. Blocks are built and searched where they lie, so no posting is ever shuffled, and the written
index serves any number of benchmarks.

Test phrases (windows of consecutive item words) are searched from their rarest term, by the counts of the whole index:
its positions, shifted back by the term's place in the phrase, are the candidate starts, and the shifted lists of the
other terms are intersected with them, rarest first. Lists that meet at the same start are an exact match; a proximity
match lets every other term lie up to ``slop`` words from its place.

Phrases are the stated query set. They are searched in chunks of at most ``CHUNK_PHRASES``, each broadcast; a larger
benchmark takes more passes over the index.

Terms are 64-bit hashes of lower-cased words. Edge cases: null and empty texts have no words, and items without words no
phrases; an item shorter than the window is one phrase; phrases never reach over a text's end; repeated rows are
searched one by one; equal phrases of many items are searched once; a text of any length is one block's part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm import common as C

SIZE = 10
SLOP = 2
#: Phrases searched at once: some 20 MB with their terms.
CHUNK_PHRASES = 100_000
#: Candidate starts held at once in a task.
CANDIDATES = 1 << 20
BLOCK_BITS = 24
#: Blocks per file of a written index: a reader takes a file's blocks at once, some 8 MB each.
FILE_BLOCKS = 8

WORD_BYTES = bytes([*range(48, 58), *range(97, 123), *range(128, 256)])


def _terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words start (and the end)."""
    data = C.lower_ascii()[data]
    starts, ends, owner = C.runs(C.table_of(WORD_BYTES)[data], at)
    edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(at) - 1))])
    return C.run_hashes(data, starts, ends).view(np.int64), edges


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def _one(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return _lists(values, np.array([0, len(values)]), kind)


def built(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all texts, a row per block; write it before use, with at most ``FILE_BLOCKS`` rows a file.

    ``keys`` and ``starts`` (with the end) are the block's texts and their first positions; ``terms`` are in order, and
    the positions of term ``i`` are ``positions[ends[i-1]:ends[i]]``.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text):
                hashes, starts = _terms(data, at)
                order = np.argsort(hashes, kind="stable")
                terms, begins = np.unique(hashes[order], return_index=True)
                keys = batch.column(key).slice(first, end - first)
                columns = [
                    pa.array([block], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    _one(starts, pa.int32()),
                    _one(terms, pa.int64()),
                    _one(np.concatenate([begins[1:], [len(hashes)]])[: len(terms)], pa.int32()),
                    _one(order, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "keys", "starts", "terms", "ends", "positions"])
                block += 1

    kind = dict(df.dtypes)[key]
    shape = f"block bigint, keys array<{kind}>, starts array<int>, terms array<bigint>, ends array<int>, positions array<int>"
    return df.select(key, text).mapInArrow(batches, shape)


def texts(index: DataFrame) -> DataFrame:
    """The indexed texts: ``row`` (block and place), ``key`` and ``n_words``."""
    each = index.select("block", "starts", F.posexplode("keys").alias("at", "key"))
    words = F.get("starts", F.col("at") + 1) - F.get("starts", "at")
    return each.select(F.struct("block", "at").alias("row"), "key", words.cast("long").alias("n_words"))


def phrases(items: DataFrame, key: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Windows of ``size`` item words, as ``phrase`` (a list of term hashes) and the ``item``; each once per item."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text):
                hashes, starts = _terms(data, at)
                n = np.diff(starts)
                windows = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
                owner = np.repeat(np.arange(end - first), windows)
                begin = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
                length = np.minimum(n[owner], size)
                ends = np.concatenate([[0], np.cumsum(length)])
                place = np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])
                item = batch.column(key).slice(first, end - first).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([item, _lists(hashes[place], ends, pa.int64())], ["item", "phrase"])

    kind = dict(items.dtypes)[key]
    return items.select(key, text).mapInArrow(batches, f"item {kind}, phrase array<bigint>").distinct()


class Queries:
    """A chunk of phrases: their terms as places in ``terms`` (all distinct ones, in order), rarest first."""

    def __init__(self, phrases: list[list[int]]):
        self.length = np.array([len(p) for p in phrases], np.int64)
        width = int(self.length.max(initial=1))
        padded = np.zeros((len(phrases), width), np.int64)
        self.filled = np.arange(width) < self.length[:, None]
        padded[self.filled] = np.fromiter((t for p in phrases for t in p), np.int64, int(self.length.sum()))
        self.terms = np.unique(padded[self.filled])
        self.at = np.searchsorted(self.terms, padded)
        self.at[~self.filled] = 0
        self.order = np.zeros_like(self.at)

    def ranked(self, counts: dict[int, int]) -> Queries:
        """Orders every phrase's places by the counts of their terms; equally rare ones from left to right."""
        n = np.array([counts.get(t, 0) for t in self.terms.tolist()], np.int64)
        rarity = np.where(self.filled, n[self.at] if len(n) else 0, np.iinfo(np.int64).max)
        self.order = np.argsort(rarity, axis=1, kind="stable")
        return self


def counted(index: DataFrame, terms: np.ndarray) -> DataFrame:
    """Tokens of each of ``terms`` in the whole index."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in source:
            for k in range(batch.num_rows):
                _, count = _held(batch, k, shared.value)
                total += count
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value[some]), pa.array(total[some])], ["term", "n"])

    return index.select("terms", "ends").mapInArrow(batches, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _column(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    return batch.column(name)[k].values.to_numpy(zero_copy_only=False)


def _held(batch: pa.RecordBatch, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the block's lists of ``wanted`` terms begin, and how long they are (0 for terms it lacks)."""
    terms, ends = _column(batch, "terms", k), _column(batch, "ends", k)
    if not len(terms):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    begins = np.concatenate([[0], ends[:-1]])
    return begins[at].astype(np.int64), np.where(terms[at] == wanted, ends[at] - begins[at], 0).astype(np.int64)


def _search(batch: pa.RecordBatch, k: int, queries: Queries, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches in one block: the text, the first position, the phrase, and whether it is exact."""
    begin, count = _held(batch, k, queries.terms)
    alive = np.flatnonzero((np.where(queries.filled, count[queries.at], 1) > 0).all(axis=1)) if len(queries.terms) else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(alive):
        return none, none, none, none.astype(bool)
    positions, starts = _column(batch, "positions", k).astype(np.int64), _column(batch, "starts", k).astype(np.int64)
    # All wanted lists in one array, in order of term and position: one binary search finds a place in any list.
    owner = np.repeat(np.arange(len(count)), count)
    taken = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(count) - count), count)
    width = np.int64(starts[-1] + 1)
    lists = np.append(owner * width + positions[taken], np.iinfo(np.int64).max)
    head = np.cumsum(count) - count

    out = []
    rarest = queries.order[alive, 0]
    anchor = queries.at[alive, rarest]
    sums = np.cumsum(count[anchor])
    first = 0
    while first < len(alive):
        before = sums[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sums, before + CANDIDATES, "right")))
        n = count[anchor[first:end]]
        phrase = np.repeat(alive[first:end], n)
        item = np.arange(len(phrase)) + np.repeat(head[anchor[first:end]] - (np.cumsum(n) - n), n)
        place = lists[item] - np.repeat(anchor[first:end], n) * width
        text = np.searchsorted(starts, place, "right") - 1
        start = place - np.repeat(rarest[first:end], n)
        exact = (start >= starts[text]) & (start + queries.length[phrase] <= starts[text + 1])
        for step in range(1, queries.at.shape[1]):
            if not len(phrase):
                break
            offset = queries.order[phrase, step]
            real = step < queries.length[phrase]
            base = queries.at[phrase, offset] * width
            expected = start + offset
            low, high = np.maximum(expected - slop, starts[text]), np.minimum(expected + slop, starts[text + 1] - 1)
            near = (low <= high) & (lists[np.searchsorted(lists, base + low)] <= base + high)
            if slop:
                exact &= ~real | (lists[np.searchsorted(lists, base + np.maximum(expected, 0))] == base + expected)
            keep = near | ~real
            phrase, start, text, exact = phrase[keep], start[keep], text[keep], exact[keep]
        out.append((text, start, phrase, exact))
        first = end
    return tuple(np.concatenate(c) for c in zip(*out))


def _merged(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the same text that overlap or touch become one."""
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    reach = np.maximum.accumulate(end)  # positions of later texts are larger
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return text[at], start[at], np.maximum.reduceat(end, at) if len(at) else end


def matched(index: DataFrame, queries: Queries, slop: int = SLOP) -> DataFrame:
    """Texts of the index that hold any of the phrases: ``row``, the exact matches' merged ``spans``, and the numbers of the phrases met exactly (``exact``) and at least nearly (``near``)."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for k in range(batch.num_rows):
                text, start, phrase, exact = _search(batch, k, shared.value, slop)
                starts = _column(batch, "starts", k).astype(np.int64)
                hit = np.unique(text)
                span_text, a, b = _merged(text[exact], start[exact], start[exact] + shared.value.length[phrase[exact]])
                span = pa.StructArray.from_arrays([pa.array((a - starts[span_text]).astype(np.int32)), pa.array((b - starts[span_text]).astype(np.int32))], ["first", "end"])
                block = pa.array(np.full(len(hit), batch.column("block")[k].as_py(), np.int64))
                row = pa.StructArray.from_arrays([block, pa.array(hit.astype(np.int32))], ["block", "at"])
                cut = pa.array(np.searchsorted(span_text, np.append(hit, np.iinfo(np.int64).max)).astype(np.int32))
                columns = [row, pa.ListArray.from_arrays(cut, span)]
                for chosen in (exact, np.ones(len(text), bool)):
                    pairs = np.unique(np.stack([text[chosen], phrase[chosen]]), axis=1)
                    columns.append(_lists(pairs[1], np.searchsorted(pairs[0], np.append(hit, np.iinfo(np.int64).max)), pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, ["row", "spans", "exact", "near"])

    shape = "row struct<block: bigint, at: int>, spans array<struct<first: int, end: int>>, exact array<int>, near array<int>"
    return index.mapInArrow(batches, shape)


def searched(index: DataFrame, items: DataFrame, slop: int = SLOP, chunk: int = CHUNK_PHRASES) -> tuple[DataFrame, DataFrame]:
    """All matches of ``items`` (as from :func:`phrases`) in a written index.

    Two tables: ``row``, ``first``, ``end`` (words of exact matches, merged within a chunk of phrases); and ``row``,
    ``item``, ``exact`` (items met, and whether any of their phrases was met exactly).
    """
    spark = index.sparkSession
    name = F.xxhash64("phrase")
    items = C.stage(items, C.scratch(spark, "phrases"))
    distinct = C.stage(items.select("phrase").distinct(), C.scratch(spark, "distinct-phrases"))
    parts = max(1, -(-distinct.count() // chunk))
    spans, met = [], []
    for part in range(parts):
        chosen = [r["phrase"] for r in distinct.where(F.pmod(name, F.lit(parts)) == part).collect()]
        queries = Queries(chosen)
        counts = {r["term"]: r["n"] for r in counted(index, queries.terms).collect()}
        found = C.stage(matched(index, queries.ranked(counts), slop), C.scratch(spark, "matches"))
        spans.append(found.select("row", F.explode("spans").alias("span")).select("row", "span.*"))
        numbers = spark.createDataFrame(list(enumerate(chosen)), "number int, phrase array<bigint>")
        each = found.select("row", "exact", F.explode("near").alias("number"))
        each = each.select("row", "number", F.array_contains("exact", F.col("number")).alias("exact"))
        met.append(each.join(numbers, "number").join(items, "phrase").groupBy("row", "item").agg(F.max("exact").alias("exact")))
    all_spans, all_met = spans[0], met[0]
    for more_spans, more_met in zip(spans[1:], met[1:]):
        all_spans, all_met = all_spans.unionByName(more_spans), all_met.unionByName(more_met)
    return all_spans, all_met.groupBy("row", "item").agg(F.max("exact").alias("exact"))


def judged(index: DataFrame, items: DataFrame, slop: int = SLOP, chunk: int = CHUNK_PHRASES) -> DataFrame:
    """Every indexed text: ``key``, ``n_words``, ``n_hit`` (words inside exact matches), and the ``items`` met exactly and ``near`` (at least nearly), in text order."""
    spans, met = searched(index, items, slop, chunk)
    along = Window.partitionBy("row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(along), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("first", reach))
    hits = spans.withColumn("new", new).groupBy("row").agg(F.sum("new").alias("n_hit"))
    name = F.col("item").cast("string")
    lists = met.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("exact"), name))).alias("items"), F.array_sort(F.collect_list(name)).alias("near"))
    empty = F.array().cast("array<string>")
    return (
        texts(index)
        .join(hits, "row", "left")
        .join(lists, "row", "left")
        .select(
            "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", empty).alias("items"), F.coalesce("near", empty).alias("near"),
        )
    )
