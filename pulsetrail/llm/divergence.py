"""How far the sources of a language differ in their words, by columns of counts in runs.

Every (lang, source) group has a column of counts, one for each term that enough documents of the language
hold. Terms with the same counts in all sources are one row with a weight, and rows are put in an order in
which like counts meet, so a column is a short list of runs. For two sources the borders of their runs are
put together; between two borders both counts stand still, and the difference is worked out once and
multiplied by the weight of the stretch.

With ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` per term, V the number of kept terms of the language and
N the group's occurrences of them, two lists differ by ``floor((p - q)^2 / (p + q))`` summed over the terms.
All of it is whole numbers.

NULL text, lang and source are ''. Documents without terms still make their group known; a language without
kept terms gives 0 for each pair. Repeated rows are documents of their own. An empty table gives an empty
result. Other columns are not looked at. Memory: a task holds a block of ``BLOCK`` different rows of counts, as
wide as the language has sources, and the list of these sources; for a term there is one array with the
sources it occurs in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import bound_batches, flat, pieces
from pulsetrail.operators.ordering import staged_in_order
from pulsetrail.workspace import stage

# Different rows of counts that a task takes at once.
BLOCK = 4096
UNIT = 1_000_000_000
# Letters A-Z made small, all other ASCII characters white space.
_FOLD = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def source_divergence(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = 10,
    top: int = 10,
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` has a row for each other source of the language, with the difference of both lists. Part
    ``term`` has the ``top`` terms that the source uses more than its language does, with what each adds.
    Ranks count from 1 within group and part, by value descending and then by item.
    """
    kept = kept_terms(docs, text=text, lang=lang, source=source, min_documents=min_documents)
    groups = group_sizes(docs, kept, lang=lang, source=source)
    return _ranked(pair_values(kept, groups), "pair").unionByName(
        _ranked(term_values(kept, groups), "term").filter(F.col("rank") <= top)
    )


def kept_terms(docs: DataFrame, *, text: str, lang: str, source: str, min_documents: int) -> DataFrame:
    """lang, term, total and ``counts``, an array of (source, n) in order of sources, of the terms that at
    least ``min_documents`` documents of the language hold."""
    rows = bound_batches(docs).select(
        _plain(lang).alias("lang"), _plain(source).alias("source"), F.col(text).cast("string").alias("text")
    )
    found = rows.mapInArrow(_count_terms, "lang string, source string, term string, n bigint, d bigint")
    # One row per term, group and task moves, however often a term occurs.
    of_group = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    of_term = of_group.groupBy("lang", "term").agg(
        F.sum("d").alias("d"),
        F.sum("n").alias("total"),
        F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"),
    )
    return stage(of_term.filter(F.col("d") >= min_documents).drop("d"), "terms")


def group_sizes(docs: DataFrame, kept: DataFrame, *, lang: str, source: str) -> DataFrame:
    """lang, source, n (occurrences of kept terms), v (kept terms of the language), lang_n."""
    named = docs.select(_plain(lang).alias("lang"), _plain(source).alias("source")).distinct()
    counted = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
    whole = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    sized = named.join(counted.agg(F.sum("c.n").alias("n")), ["lang", "source"], "left").join(whole, "lang", "left")
    return stage(sized.fillna(0, ["n", "v", "lang_n"]), "term-groups")


def term_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: what each term that a source has and prefers to its language adds."""
    rows = kept.select("lang", F.col("term").alias("item"), "total", F.explode("counts").alias("c"))
    rows = rows.select("lang", "item", "total", "c.source", F.col("c.n").alias("count"))
    sized = rows.join(groups, ["lang", "source"])
    p, q = F.col("p"), F.col("q")
    valued = sized.select("lang", "source", "item", _share("count", "n").alias("p"), _share("total", "lang_n").alias("q"))
    return valued.filter(p > q).select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language, in both directions."""
    alike = kept.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("weight"))
    # The first sources' counts decide which rows are neighbours; the hash keeps equal ones apart.
    keyed = alike.select("*", F.slice("counts", 1, 8).alias("near"), F.xxhash64("counts").alias("tie"))
    rows = staged_in_order(keyed, ["lang", "near", "tie"], unique=True, label="term-runs")
    block = F.shiftleft("_pt_part", 33) + F.expr(f"_pt_place div {BLOCK}")
    blocks = rows.select("lang", block.alias("block"), "counts", "weight")
    # Block -1 is empty; it makes all pairs of a language known.
    all_blocks = rows.select("lang", block.alias("block")).union(groups.select("lang", F.lit(-1).cast("bigint"))).distinct()
    lists = groups.select("lang", "source", "n", "v").join(all_blocks, "lang")
    schema = "lang string, source string, item string, value bigint"
    sums = (
        blocks.groupBy("lang", "block")
        .cogroup(lists.groupBy("lang", "block"))
        .applyInArrow(_compare_columns, schema)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    both = [F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("source", "item"), ("item", "source"))]
    return sums.select("lang", "value", F.explode(F.array(*both)).alias("s")).select("lang", "s.source", "s.item", "value")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    # Where only the first ranks are wanted, Spark drops the rest before the shuffle.
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _plain(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def _share(count: str, size: str) -> Column:
    return F.expr(f"1 + cast({count} + 2 as decimal(20, 0)) * {UNIT} div cast({size} + 2 * v as decimal(20, 0))")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 8 << 20):
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        n_sources = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
        document, code, terms = _terms(batch.column("text"))
        if not len(code):
            continue
        width = len(terms)
        found, n = np.unique(group[document] * width + code, return_counts=True)
        once = np.unique(document * width + code)
        _, d = np.unique(group[once // width] * width + once % width, return_counts=True)
        of = found // width
        out = [
            lang.dictionary.take(pa.array(of // n_sources)),
            source.dictionary.take(pa.array(of % n_sources)),
            terms.take(pa.array(found % width)),
            pa.array(n.astype(np.int64)),
            pa.array(d.astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(out, ["lang", "source", "term", "n", "d"])


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of each term of some texts, and the terms by number."""
    data, offsets = flat(column)
    folded = pa.py_buffer(data.tobytes().translate(_FOLD))
    whole = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets.tobytes()), folded)
    cut = pa.compute.ascii_split_whitespace(whole)
    coded = cut.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(cut)), np.diff(cut.offsets.to_numpy()))
    code = coded.indices.to_numpy().astype(np.int64)
    terms = coded.dictionary.cast(pa.string())
    # White space at either end cuts off an empty string.
    real = pa.compute.not_equal(terms, "").to_numpy(zero_copy_only=False)[code] if len(code) else code.astype(bool)
    return row[real], code[real], terms


def _compare_columns(rows: pa.Table, groups: pa.Table) -> pa.Table:
    """The share of one block in the difference of each two sources."""
    sources = groups.column("source").combine_chunks().sort()
    place = {s: i for i, s in enumerate(sources.to_pylist())}
    size = {s: n for s, n in zip(*(groups.column(c).to_pylist() for c in ("source", "n")))}
    kept = groups.column("v")[0].as_py()
    columns = _columns(rows, place)
    upto = np.concatenate([[0], np.cumsum(rows.column("weight").to_numpy())])
    runs = [_runs(columns[:, i], size[s] + 2 * kept) for s, i in place.items()]
    first, second, values = [], [], []
    for i, (a_starts, a) in enumerate(runs):
        for j in range(i):
            b_starts, b = runs[j]
            starts = np.union1d(a_starts, b_starts)
            p = a[np.searchsorted(a_starts, starts, side="right") - 1]
            q = b[np.searchsorted(b_starts, starts, side="right") - 1]
            length = np.diff(upto[np.append(starts, len(columns))])
            values.append(int((((p - q) * (p - q)) // (p + q) * length).sum()))
            first.append(i)
            second.append(j)
    lang = pa.array([groups.column("lang")[0].as_py()] * len(values), pa.string())
    named = [sources.take(pa.array(x, pa.int64())) for x in (first, second)]
    return pa.table([lang, *named, pa.array(values, pa.int64())], ["lang", "source", "item", "value"])


def _columns(rows: pa.Table, place: dict[str, int]) -> np.ndarray:
    counts = rows.column("counts").combine_chunks()
    found = np.zeros((len(counts), len(place)), np.int64)
    if len(counts):
        row = np.repeat(np.arange(len(counts)), pa.compute.list_value_length(counts).to_numpy())
        pairs = counts.flatten()
        coded = pairs.field("source").dictionary_encode()
        of = np.array([place[s] for s in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        found[row, of] = pairs.field("n").to_numpy()
    return found


def _runs(column: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a column begin and the share p in each."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1])
    values, which = np.unique(column[starts], return_inverse=True)
    p = np.array([1 + UNIT * (n + 2) // size for n in values.tolist()], np.int64)
    return starts, p[which]
