"""Quality rules as a short-circuit cascade.

Every rule has a measured cost and a measured share of documents it rejects, both from a sample. Rules
run in order of rejections per second and stop at the first that rejects; the verdict is that no rule
rejects, so it does not depend on the order or the sample.

A NULL text has no words. Texts are taken whole. An empty table gives an empty result; columns of any
other name come back untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import SPACES, bound_batches, keep_row, lean, pieces

SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
MIN_WORDS = 50
# About so many documents are measured.
SAMPLE = 2000

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
Rule = Callable[[str, bytes, dict], bool]


def measure(text: str, raw: bytes) -> dict:
    """The base metrics of a text, and its words and lines."""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return {
        "words": words,
        "n_lines": len(lines),
        "n_words": len(words),
        "word_chars": len(text) - sum(text.count(chr(c)) for c in SPACES),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeat_words(words),
    }


def repeat_words(words: Sequence[bytes]) -> int:
    """Words inside a window of three that the text has twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Number the pairs first, so that no product leaves 64 bits.
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, place, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def base_failed(m: Mapping) -> bool:
    return m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > 50 * m["n_words"]


def symbols(text: str, raw: bytes, m: Mapping) -> bool:
    """More than one symbol in five words: mark-up, tables and decoration."""
    return 5 * m["n_symbols"] > m["n_words"]


def repeated_lines(text: str, raw: bytes, m: Mapping) -> bool:
    """Over half of the lines were there before."""
    return 2 * m["n_dup_lines"] > m["n_lines"]


def word_length(text: str, raw: bytes, m: Mapping) -> bool:
    """Words of under 2 or over 12 characters on average."""
    return not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]


def shouting(text: str, raw: bytes, m: Mapping) -> bool:
    """Over half of the letters A-Z, a-z are capitals."""
    letters = len(raw) - len(raw.translate(None, LETTERS))
    return 2 * (len(raw) - len(raw.translate(None, UPPER))) > letters


def exclamations(text: str, raw: bytes, m: Mapping) -> bool:
    """More than one exclamation mark in two words."""
    return 2 * raw.count(b"!") > m["n_words"]


def few_words(text: str, raw: bytes, m: Mapping) -> bool:
    """Fewer than one distinct word in twenty."""
    return 20 * len(set(m["words"])) < m["n_words"]


RULES: dict[str, Rule] = {
    "symbols": symbols,
    "repeated_lines": repeated_lines,
    "word_length": word_length,
    "shouting": shouting,
    "exclamations": exclamations,
    "few_words": few_words,
}


def rule_order(df: DataFrame, rules: Mapping[str, Rule] = RULES, *, text: str = "text", sample: int = SAMPLE) -> list[str]:
    """Names of the ``rules`` by rejections per second, measured on about ``sample`` rows of ``df``.

    The driver sees one row per rule.
    """
    rows = df.count()
    if not rows:
        return list(rules)

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for batch in pieces(batches, "text"):
            for t in batch.column("text").to_pylist():
                raw = (t or "").encode()
                m = measure(t or "", raw)
                if base_failed(m):
                    continue
                for name, rule in rules.items():
                    began = time.perf_counter()
                    rejected[name] += rule(t or "", raw, m)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {"rule": list(rules), "spent": list(spent.values()), "rejected": list(rejected.values())}
        )

    seen = bound_batches(df).select(F.col(text).alias("text")).sample(min(1.0, sample / rows), 7)
    found = seen.mapInArrow(lean(trial), "rule string, spent double, rejected bigint").groupBy("rule")
    rate = {r["rule"]: r["n"] / (r["s"] or 1e-9) for r in found.agg(F.sum("rejected").alias("n"), F.sum("spent").alias("s")).collect()}
    return sorted(rules, key=lambda name: -rate.get(name, 0.0))


def quality(
    df: DataFrame,
    rules: Mapping[str, Rule] = RULES,
    *,
    text: str = "text",
    carry: Sequence[str] | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows of ``df`` as ``_row`` (of its columns those in ``carry``, or all) with the metrics,
    ``base_failed``, ``kept`` and ``rejected_by``."""
    order = rule_order(df, rules, text=text, sample=sample)
    rows = keep_row(df, F.col(text).alias("text"), carry=carry)
    out = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, rejected_by string"
    schema = f"{out}, _row {rows.schema['_row'].dataType.simpleString()}"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found: dict[str, list] = {name: [] for name in (*METRICS, "base_failed", "kept", "rejected_by")}
            for t in batch.column("text").to_pylist():
                t = t or ""
                raw = t.encode()
                m = measure(t, raw)
                failed = base_failed(m)
                by = "base" if failed else next((name for name in order if rules[name](t, raw, m)), None)
                for name in METRICS:
                    found[name].append(m[name])
                found["base_failed"].append(failed)
                found["kept"].append(by is None)
                found["rejected_by"].append(by)
            arrays = [pa.array(v, pa.string() if k == "rejected_by" else None) for k, v in found.items()]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("_row")], [*found, "_row"])

    return rows.mapInArrow(lean(judge), schema)
