"""Quality rules as a bitmask ledger.

Every text is measured once. Each rule turns the measurements into one failure bit; bits and measurements are the
ledger. A policy is a version and a mask of rules, so a changed policy, a comparison of versions or an ablation
is bitwise arithmetic over the ledger and reads no text again.

Words are runs outside ASCII white space. Edge cases: null and empty texts have no words and fail ``few_words``;
lines without a word are ignored; repeated rows are measured one by one; an empty table gives an empty ledger;
the measurements go into one struct column whose name avoids the table's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

#: Rules in bit order: a text fails where the expression holds. Ratios are kept in integers.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
BASE = ("few_words", "repeated_windows")
#: Policies by version.
POLICIES = {1: BASE, 2: tuple(RULES)}


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each item: whether an earlier one is equal, and whether any other is."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    earlier, other = np.empty(len(key), bool), np.empty(len(key), bool)
    earlier[order] = same[:-1]
    other[order] = same[:-1] | same[1:]
    return earlier, other


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _measure(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    n = len(at) - 1
    inside = ~C.table_of(b" \t\n\v\f\r")[data]
    starts, ends, owner = C.runs(inside, at)
    salt = C.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    before = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])

    line_starts, line_ends, line_owner = C.runs(data != 10, at)
    real = before[line_ends] > before[line_starts]
    line_starts, line_ends, line_owner = line_starts[real], line_ends[real], line_owner[real]
    earlier, _ = _repeats(C.mix(C.run_hashes(data, line_starts, line_ends) ^ salt[line_owner]))

    hashes, first = C.windows(C.run_hashes(data, starts, ends), owner, WINDOW)
    _, twice = _repeats(C.mix(hashes ^ salt[owner[first]]))
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, first[twice], 1)
    np.add.at(edge, first[twice] + WINDOW, -1)
    repeated = np.cumsum(edge)[:-1] > 0
    return [
        np.bincount(owner, minlength=n),
        _sums(inside & ((data & 0xC0) != 0x80), at),
        _sums(C.table_of(SYMBOLS)[data], at),
        np.bincount(line_owner, minlength=n),
        np.bincount(line_owner[earlier], minlength=n),
        np.bincount(owner[repeated], minlength=n),
    ]


def measured(df: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """``df`` with a struct of measurements; texts stay where they are, nothing is shuffled."""
    kind = "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">"

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            parts = [_measure(data, at) for _, _, data, at in C.text_chunks(batch, text)]
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(columns, MEASURES)], [*batch.schema.names, into])

    fields = ", ".join([f"`{c}` {t}" for c, t in df.dtypes] + [f"`{into}` {kind}"])
    return df.mapInArrow(batches, fields)


def failure_bits(measures: str = "measures") -> Column:
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        failed = F.expr(_over(rule, measures))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def _over(rule: str, measures: str) -> str:
    return " ".join(f"`{measures}`.{w}" if w in MEASURES else w for w in rule.split())


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: the key, each measurement, and ``bits``, the rules it fails."""
    rows = measured(df.select(key, text), text).drop(text)
    return rows.select(key, "measures.*", failure_bits().alias("bits"))


def accepted(bits: Column, version: int) -> Column:
    return bits.bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == 0


def ablation(rows: DataFrame, version: int) -> DataFrame:
    """By rule of a policy: texts that fail it, texts that only it rejects, and texts kept without it."""
    whole = mask(POLICIES[version])
    counts = [F.count(F.lit(1)).alias("n")]
    for rule in POLICIES[version]:
        bit, rest = mask((rule,)), whole & ~mask((rule,))
        failed = F.col("bits").bitwiseAND(F.lit(bit).cast("long")) != 0
        kept = F.col("bits").bitwiseAND(F.lit(rest).cast("long")) == 0
        counts += [F.count_if(failed).alias(f"{rule}_f"), F.count_if(failed & kept).alias(f"{rule}_o"), F.count_if(kept).alias(f"{rule}_k")]
    one = rows.agg(*counts)
    lines = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"{r}_f").alias("failed"), F.col(f"{r}_o").alias("failed_alone"), F.col(f"{r}_k").alias("kept_without"))
            for r in POLICIES[version]
        ]
    )
    return one.select(F.explode(lines).alias("line")).select(F.lit(version).alias("version"), "line.*")
