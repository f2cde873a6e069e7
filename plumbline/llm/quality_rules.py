"""Quality rules as a ledger of failure bits and measurements.

`ledger` evaluates every rule once per document and stores one bit per failed rule beside
the measurements.  Policies are versioned bit masks over that ledger, so changing a policy
or asking what a rule costs (`ablations`) never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta

#: Bit of each rule, in order.  A document fails a rule when the text beside it holds.
RULES = (
    "few_words",  # n_words < 20
    "repeated_words",  # 100 * n_repeat_words > 30 * n_words
    "symbols",  # 100 * n_symbols > 10 * n_words
    "repeated_lines",  # 100 * n_dup_lines > 50 * n_lines, n_lines: lines with a word
    "word_length",  # words of fewer than 2 or more than 15 code points on average
    "capitals",  # 100 * n_upper > 50 * word_chars
    "exclamations",  # 100 * n_exclaim > 20 * n_words
    "digits",  # 100 * n_digits > 50 * word_chars
    "stutter",  # 100 * n_stutter > 30 * n_words, n_stutter: words equal to the one before
)
BASE = 0b11
#: Versioned policies: a document is kept if none of the mask's bits is set.
POLICIES = {"v1": BASE, "v2": 0b111111111}
CURRENT = "v2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_digits", "n_stutter")
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of each document of a chunk (see textarrays.chunks)."""
    n = len(offs) - 1
    starts, ends, doc = ta.words(data, offs)
    out = {"n_words": np.bincount(doc, minlength=n)}
    inside = np.bincount(doc, weights=ends - starts, minlength=n).astype(np.int64)
    out["word_chars"] = inside - ta.per_doc((data & 0xC0) == 0x80, offs)
    out["n_symbols"] = ta.per_doc(_SYMBOL[data], offs)
    out["n_upper"] = ta.per_doc(_UPPER[data], offs)
    out["n_digits"] = ta.per_doc(_DIGIT[data], offs)
    out["n_exclaim"] = ta.per_doc(data == 33, offs)

    a, b, of = ta.lines(data, offs)
    real = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, of = a[real], b[real], of[real]
    out["n_lines"] = np.bincount(of, minlength=n)
    with np.errstate(over="ignore"):
        salt = ta.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lines = ta.span_hash(data, a, b, 3) ^ salt[of]
    _, once = np.unique(lines, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(of[once], minlength=n)

    hashes = ta.span_hash(data, starts, ends)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])) + 1
    out["n_stutter"] = np.bincount(doc[again], minlength=n)
    windows = ta.window_hash(hashes, WINDOW)
    at = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    twice = at[_repeats(windows[at] ^ salt[doc[at]])]
    out["n_repeat_words"] = np.bincount(doc[ta.covered(twice, WINDOW, len(doc))], minlength=n)
    return out


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """The failure bits, rule by rule in the order of RULES."""
    fails = (
        m["n_words"] < 20,
        100 * m["n_repeat_words"] > 30 * m["n_words"],
        100 * m["n_symbols"] > 10 * m["n_words"],
        100 * m["n_dup_lines"] > 50 * m["n_lines"],
        (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
        100 * m["n_upper"] > 50 * m["word_chars"],
        100 * m["n_exclaim"] > 20 * m["n_words"],
        100 * m["n_digits"] > 50 * m["word_chars"],
        100 * m["n_stutter"] > 30 * m["n_words"],
    )
    return sum(f.astype(np.int64) << i for i, f in enumerate(fails))


def ledger(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of docs: the carried columns, `failed` (bits) and every measurement.

    A null or empty text has no words and fails `few_words` alone.  Repeated rows give
    repeated rows; other columns of docs are ignored, whatever their names.
    Texts are read once, in a map without a shuffle, in chunks of bounded size.
    """
    place = carry.index(text) if text in carry else len(carry)
    out = docs.select(*[docs[c] for c in carry], *([] if text in carry else [docs[text].alias("__text")]))
    carried = out.schema.fields[: len(carry)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + ["failed bigint"] + [f"{m} bigint" for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(place)):
                m = measure(data, offs)
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))]
                cols += [pa.array(failures(m))] + [pa.array(m[k].astype(np.int64)) for k in MEASURES]
                yield pa.RecordBatch.from_arrays(cols, names=[*carry, "failed", *MEASURES])

    return out.mapInArrow(run, schema)


def stored_ledger(docs: DataFrame, path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ledger of docs, written to path as Parquet: policies and ablations then start from the file."""
    ledger(docs, text, carry).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def apply_policy(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds `base_failed` and `kept` under a policy; only bits of the ledger are read."""
    mask = POLICIES[version] | BASE
    failed = F.col("failed")
    return led.withColumn("base_failed", failed.bitwiseAND(F.lit(BASE)) != 0).withColumn("kept", failed.bitwiseAND(F.lit(mask)) == 0)


def ablations(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: one row (rule, n_failed, n_only), from one aggregation.

    n_only counts the documents that this rule alone rejects, which dropping it would keep.
    """
    mask = POLICIES[version] | BASE
    bits = [i for i in range(len(RULES)) if mask >> i & 1]
    failed = F.col("failed")
    sums = [F.sum(F.when(failed.bitwiseAND(F.lit(1 << i)) != 0, 1).otherwise(0)).alias(f"f{i}") for i in bits]
    sums += [F.sum(F.when(failed.bitwiseAND(F.lit(mask)) == 1 << i, 1).otherwise(0)).alias(f"o{i}") for i in bits]
    pairs = F.array(*[F.struct(F.lit(RULES[i]).alias("rule"), F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("n_failed"), F.coalesce(F.col(f"o{i}"), F.lit(0)).alias("n_only")) for i in bits])
    return led.agg(*sums).select(F.inline(pairs))


def quality_rules(docs: DataFrame, version: str = CURRENT, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ledger of `docs` under a policy."""
    return apply_policy(ledger(docs, carry=carry), version)
