"""Line deduplication by winnowing over line hashes.

Lines are equal if they have the same words. From every line a window runs forward,
and to every line one runs backward, until it holds ``min_words`` words; the least
hash of a window's lines with words is its fingerprint. Any run of lines with ``min_words`` words
holds a whole window, so two places that share the run share a fingerprint.

Fingerprints that occur at two places are joined with their positions. Around them
the windows are compared as a whole, and those found earlier (in order of ``doc_id``,
then line) are later copies. The later windows of a run overlap one another: together
they are the run, extended both ways as far as it repeats, because every line of a
repeated run lies in a forward or backward window inside it. Nothing is paired, so
a passage that a third of all documents share costs one row for each occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fresh, ready, same, settle, text_key, text_of
from tidemark.llm.spans import GOLDEN, SPACED_WORD, STEP, TextBatch, mixed, powers, slices

MIN_WORDS = 50

WINDOW = "struct<first:int,last:int,h1:bigint,h2:bigint,at:int,mark:bigint>"
SCAN = f"struct<n_lines:bigint,windows:array<{WINDOW}>>"
RUNS = "array<struct<first:int,last:int>>"
OTHER_STEP = 0x9E3779B97F4A7C55


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _run_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values from ``first`` to ``last``, wherever they lie."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    back = powers(_inverse(base), n)
    size = (last - first + 1).astype(np.uint64)
    return mixed((sums[last + 1] - sums[first]) * back[first] + size * GOLDEN)


def _least_places(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the least value from ``first`` to ``last``, the first of equal ones, by doubling."""
    best, out = np.arange(len(values)), np.zeros(len(first), np.int64)
    sizes = last - first + 1
    span = 1
    while span <= sizes.max(initial=0):
        some = np.flatnonzero((sizes >= span) & (sizes < 2 * span))
        a, b = best[first[some]], best[last[some] - span + 1]
        out[some] = np.where(values[a] <= values[b], a, b)
        a, b = best[:-span], best[span:]
        best = np.where(values[a] <= values[b], a, b)
        span *= 2
    return out


def _windows(batch: TextBatch, min_words: int) -> pa.StructArray:
    words = batch.words(SPACED_WORD, lower=False)
    breaks = np.flatnonzero(batch.bytes == 10)
    # Lines: one for each text and one more after each break.
    starts = np.sort(np.concatenate([batch.offsets[:-1], breaks + 1]), kind="stable")
    bounds = np.arange(batch.rows + 1) + np.searchsorted(breaks, batch.offsets)
    n = len(starts)
    upto = np.searchsorted(words.starts, np.append(starts, len(batch.bytes)))
    before, after = upto[:-1], upto[1:]
    counts = after - before
    hashes = words.hashes()
    place = np.arange(len(words)) - np.repeat(before, counts)
    longest = int(counts.max(initial=1))
    full = np.flatnonzero(counts)
    lines = []
    for base, salt in ((STEP, 0), (OTHER_STEP, 1)):
        line = np.zeros(n, np.uint64)
        if len(full):
            terms = mixed(hashes + np.uint64(salt)) * powers(base, longest)[place]
            line[full] = np.add.reduceat(terms, before[full])
        lines.append(mixed(line + counts.astype(np.uint64)))
    text_of_line = np.repeat(np.arange(batch.rows), np.diff(bounds))
    index = np.arange(n)
    forward = np.searchsorted(after, before + min_words, side="left")
    ok = forward < bounds[text_of_line + 1]
    backward = np.searchsorted(before, after - min_words, side="right") - 1
    fine = (backward >= bounds[text_of_line]) & (after >= min_words)
    first = np.concatenate([index[ok], backward[fine]])
    last = np.concatenate([forward[ok], index[fine]])
    both = np.unique(first * np.int64(n + 1) + last)
    first, last = both // (n + 1), both % (n + 1)
    h1, h2 = (
        _run_hashes(line, first, last, base)
        for line, base in zip(lines, (STEP, OTHER_STEP), strict=True)
    )
    # Lines without words are compared but cannot be marks, so a window's least hash is
    # found among its few lines with words, however many others it spans.
    rank = np.searchsorted(full, np.stack([first, last + 1]))
    at = full[_least_places(lines[0][full], rank[0], rank[1] - 1)]
    mark = lines[0][at]
    shift = bounds[text_of_line[first]] if n else first
    rows = pa.StructArray.from_arrays(
        [
            pa.array((first - shift).astype(np.int32)),
            pa.array((last - shift).astype(np.int32)),
            pa.array(h1.view(np.int64)),
            pa.array(h2.view(np.int64)),
            pa.array((at - shift).astype(np.int32)),
            pa.array(mark.view(np.int64)),
        ],
        names=["first", "last", "h1", "h2", "at", "mark"],
    )
    ends = pa.array(np.searchsorted(first, bounds).astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.array(np.diff(bounds)), pa.ListArray.from_arrays(ends, rows)],
        names=["n_lines", "windows"],
    )


def _scan(min_words: int):
    def scan(texts: pa.Array) -> pa.Array:
        parts = [_windows(TextBatch(part), min_words) for part in slices(texts)]
        return pa.concat_arrays(parts) if parts else _windows(TextBatch(texts), min_words)

    return F.arrow_udf(scan, SCAN)


def _without(text: str | None, runs: list[dict] | None) -> str | None:
    if not runs:
        return text
    lines = text.split("\n")
    gone = np.zeros(len(lines) + 1, np.int64)
    np.add.at(gone, [r["first"] for r in runs], 1)
    np.add.at(gone, [r["last"] + 1 for r in runs], -1)
    return "\n".join(x for x, n in zip(lines, np.cumsum(gone), strict=False) if not n)


def _removal():
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), runs.to_pylist(), strict=True)
        return pa.array([_without(t, r) for t, r in pairs], pa.string())

    return F.arrow_udf(cut, "string")


def later_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, key, n_lines, runs``: for each document its later repeated windows."""
    ready(documents.sparkSession)
    text = text_of(documents)
    scanned = settle(
        documents.select(
            "doc_id", text_key(text).alias("key"), _scan(min_words)(text).alias("s")
        ).select("doc_id", "key", "s.*"),
        "line-windows",
    )
    windows = scanned.select("doc_id", "key", F.inline("windows"))
    # A repeated row is the same place, not a second one.
    marks = (
        windows.select("doc_id", "key", "at", "mark")
        .distinct()
        .groupBy("mark")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("mark")
    )
    around = settle(windows.join(settle(marks, "line-marks"), "mark"), "marked-windows")
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key", "first")
    around = around.select("doc_id", "key", "last", "first", "h1", "h2", place.alias("place"))
    found = (
        around.groupBy("h1", "h2")
        .agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
        .where("earliest <> latest")
        .select("h1", "h2", "earliest")
    )
    later = (
        around.join(settle(found, "first-places"), ["h1", "h2"])
        .where("place <> earliest")
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    )
    later = settle(later, "later-runs")
    return scanned.join(later, same(scanned, later, "doc_id", "key"), "left").select(
        scanned["doc_id"], scanned["key"], "n_lines", "runs"
    )


def deduplicated(
    documents: DataFrame, min_words: int = MIN_WORDS, counted: tuple[str, str] | None = None
) -> DataFrame:
    """The documents without later repeated runs; other columns stay as they are.

    ``counted`` names two columns for the lines a text had and lost. ``n_chars``, where
    the table has it, is that of the new text. Null texts stay null, texts without a
    repeated run stay as they are, and a text may become empty. Rows of equal
    ``doc_id`` and text are one place: neither is later than the other.
    """
    found = later_runs(documents, min_words).distinct()
    names = ("key", "id", "text_key", "runs", "n_lines")
    key, its_id, its_key, runs, n_lines = (fresh(documents, x) for x in names)
    found = settle(
        found.select(
            F.col("doc_id").alias(its_id),
            F.col("key").alias(its_key),
            F.col("runs").alias(runs),
            F.col("n_lines").alias(n_lines),
        ),
        "removed-lines",
    )
    if counted is None:
        found = found.where(F.col(runs).isNotNull())
    keyed = documents.withColumn(key, text_key(text_of(documents)))
    joined = keyed.join(
        found, keyed["doc_id"].eqNullSafe(found[its_id]) & (keyed[key] == found[its_key]), "left"
    )
    text = _removal()(F.col("text").cast("string"), F.col(runs))
    new = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        size = F.length("text").cast(documents.schema["n_chars"].dataType)
        new = new.withColumn("n_chars", F.when(F.col(runs).isNull(), F.col("n_chars")).otherwise(size))
    if counted is None:
        return new.select(*documents.columns)
    cut = F.array_sort(F.coalesce(runs, F.array().cast(RUNS)))
    # Lines in any run, counted in order: the runs overlap and may be long.
    gone = F.aggregate(
        cut,
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto")),
        lambda s, r: F.struct(
            (s["n"] + F.greatest(r["last"] - F.greatest(s["upto"], r["first"] - 1), F.lit(0))).alias("n"),
            F.greatest(s["upto"], r["last"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    return new.select(
        *documents.columns,
        F.col(n_lines).alias(counted[0]),
        gone.cast("long").alias(counted[1]),
    )
