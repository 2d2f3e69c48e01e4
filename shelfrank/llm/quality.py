"""Quality rules: an isolation forest on rule statistics, its threshold calibrated from labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.text import SPACE, SpanHasher, draw_hash, draw_limit, mix64, slices, word_spans
from shelfrank.session import write_table

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_digits", "n_marks")
STATS_SCHEMA = "doc_id long, draw long, " + ", ".join(f"{c} long" for c in STATS)

#: Rows of which the forest is grown, about so many by a hash of doc_id and text, never over twice as many.
FIT_ROWS = 10_000
TREES = 100
TREE_ROWS = 256
SCORE_STEPS = 4096


def _repeated(order_key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each item's key occurs twice or more within its document."""
    keys = mix64(order_key ^ mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), dtype=bool)
    equal = keys[order[1:]] == keys[order[:-1]]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    return same


def _later(order_key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an equal key came earlier in the same document; items stand in text order."""
    keys = mix64(order_key ^ mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return later


def slice_statistics(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> dict[str, np.ndarray]:
    """Rule statistics of the whole texts in a slice.  Words, windows and lines are compared by 64-bit hashes."""
    docs = len(offsets) - 1

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    start, end, doc = word_spans(data, offsets)
    word = hasher(data, start, end) if len(start) else np.zeros(0, np.uint64)
    n_words = np.bincount(doc, minlength=docs)
    continues = (data & 0xC0) == 0x80
    covered = np.zeros(len(word), dtype=bool)
    if len(word) > 2:
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        with np.errstate(over="ignore"):
            window = (word[inside] * np.uint64(3) + word[inside + 1]) * np.uint64(0x9E3779B97F4A7C15) + word[inside + 2]
        twice = inside[_repeated(mix64(window), doc[inside])]
        for shift in range(3):
            covered[twice + shift] = True
    breaks = np.flatnonzero(data == 10)
    lows = np.concatenate([offsets[:-1], breaks + 1])
    line_doc = np.concatenate([np.arange(docs), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((lows, line_doc))
    lows, line_doc = lows[order], line_doc[order]
    highs = np.minimum(np.concatenate([lows[1:] - 1, [len(data)]]), offsets[line_doc + 1])
    last = np.concatenate([line_doc[1:] != line_doc[:-1], [True]]) if len(line_doc) else np.zeros(0, bool)
    highs[last] = offsets[line_doc[last] + 1]
    letters = np.concatenate([[0], np.cumsum(~SPACE[data], dtype=np.int64)])
    full = letters[highs] > letters[lows]
    lows, highs, line_doc = lows[full], highs[full], line_doc[full]
    again = _later(hasher(data, lows, highs), line_doc) if len(lows) else np.zeros(0, bool)
    return {
        "n_words": n_words,
        "word_chars": total(~SPACE[data] & ~continues),
        "n_symbols": total(SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_doc[again], minlength=docs),
        "n_lines": np.bincount(line_doc, minlength=docs),
        "n_repeat_words": np.bincount(doc[covered], minlength=docs),
        "n_upper": total((data >= 65) & (data <= 90)),
        "n_digits": total((data >= 48) & (data <= 57)),
        "n_marks": total((data == 33) | (data == 63)),
    }


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        for low, high, data, offsets in slices(batch.column(2)):
            stats = slice_statistics(data, offsets, hasher)
            keys = [batch.column(i).slice(low, high - low) for i in range(2)]
            columns = [*keys, *(pa.array(stats[c].astype(np.int64)) for c in STATS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "draw", *STATS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, a hash to draw by and the rule statistics of every whole text; null and empty texts have zeros."""
    rows = docs.select(F.col("doc_id").cast("long"), draw_hash("doc_id", "text").alias("draw"), F.col("text").cast("string"))
    return rows.mapInArrow(_statistics, STATS_SCHEMA)


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Scale-free figures in which unusual texts stand apart."""
    words = np.maximum(stats["n_words"], 1).astype(float)
    chars = np.maximum(stats["word_chars"], 1).astype(float)
    spread = np.sqrt(np.minimum(words, 400.0) / 400.0)  # ratios of short texts vary by chance; draw them in
    lines = np.maximum(stats["n_lines"], 1)
    columns = (
        (np.abs(chars / words - 5.0), 1.0, 3.0),
        (stats["n_symbols"] / words, 0.1, 1.0),
        (stats["n_dup_lines"] / lines, 0.3, 1.0),
        (stats["n_repeat_words"] / words, 0.3, 1.0),
        (stats["n_upper"] / chars, 0.15, 0.6),
        (stats["n_digits"] / chars, 0.1, 0.6),
        (stats["n_marks"] / words, 0.2, 1.0),
    )
    # What texts usually show counts as 0, else the forest isolates ordinary texts by chance figures.
    return np.column_stack([np.clip(value * spread - usual, 0.0, top) for value, usual, top in columns])


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> list[tuple[np.ndarray, ...]]:
    """Isolation trees as arrays (feature, cut, left, right, depth): random cuts of small random subsets."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(2, min(rows, len(x))))))
    forest = []
    for _ in range(trees):
        sample = x[rng.choice(len(x), size=min(rows, len(x)), replace=False)]
        feature, cut, left, right, depth = [], [], [], [], []

        def grow(part, level):
            node = len(feature)
            for column in (feature, cut, left, right, depth):
                column.append(0)
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if level >= limit or len(part) <= 1 or not len(usable):
                feature[node], depth[node] = -1, level + _average_path(len(part))
                return node
            f = int(rng.choice(usable))
            at = float(rng.uniform(low[f], high[f]))
            goes = part[:, f] < at
            feature[node], cut[node] = f, at
            left[node], right[node] = grow(part[goes], level + 1), grow(part[~goes], level + 1)
            return node

        grow(sample, 0)
        forest.append(tuple(np.array(c) for c in (feature, cut, left, right, depth)))
    return forest


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def anomaly(forest: list[tuple[np.ndarray, ...]], x: np.ndarray, rows: int) -> np.ndarray:
    """Scores from 0 to 1: 2 to the power of minus the mean path over the usual path."""
    paths = np.zeros(len(x))
    everyone = np.arange(len(x))
    for feature, cut, left, right, depth in forest:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = everyone[feature[node] >= 0]
            if not len(inner):
                break
            at = node[inner]
            node[inner] = np.where(x[inner, feature[at]] < cut[at], left[at], right[at])
        paths += depth[node]
    return 2.0 ** (-paths / max(1, len(forest)) / max(_average_path(rows), 1e-9))


def judge_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Statistics, base verdict, anomaly score and ``kept`` of every document.

    The forest grows on about ``fit_rows`` documents, drawn by a hash of doc_id and text among those that pass
    the base rules, equal rows once.  The threshold comes from all labelled rows: it is the one that
    misjudges the fewest of them.  Without labels, or where no threshold beats keeping
    everything, the base rules alone decide.

    Null and empty texts have no words and fail the base rules; so does every text under 50
    words.  Repeated rows are judged alike, an empty table gives no rows, other columns are ignored.
    """
    stats = write_table(rule_statistics(docs), "quality-statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    passing = stats.where("NOT base_failed")
    # A share of the hash range instead of the lowest hashes: no task sends more than its share.
    drawn = passing.where(F.col("draw") <= draw_limit(fit_rows / max(1, passing.count())))
    sample = drawn.dropDuplicates(["doc_id", "draw"]).limit(2 * fit_rows).toPandas().sort_values(["doc_id", "draw"])
    if not len(sample):
        return stats.drop("draw").withColumns({"score": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    x = features({c: sample[c].to_numpy() for c in STATS})
    forest = grow_forest(x)
    tree_rows = min(TREE_ROWS, len(x))
    names = stats.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {c: batch.column(names.index(c)).to_numpy() for c in STATS}
            found = pa.array(anomaly(forest, features(values), tree_rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "score"])

    scored = write_table(stats.mapInArrow(score, STATS_SCHEMA + ", base_failed boolean, score double"), "quality-scores")
    step = F.floor(F.col("score") * SCORE_STEPS).cast("int")
    marked = labels.select(F.col("doc_id").alias("of_doc"), "quality").where("quality IN (0, 1)")
    met = scored.where("NOT base_failed").join(marked, F.col("doc_id") == F.col("of_doc"))
    # At most SCORE_STEPS + 1 rows, whatever the number of labels.
    table = met.groupBy(step.alias("step")).agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n")).toPandas()
    limit = choose_threshold(table["step"].to_numpy(), table["good"].to_numpy(), table["n"].to_numpy())
    return scored.drop("draw").withColumn("kept", ~F.col("base_failed") & (step < limit))


def choose_threshold(step: np.ndarray, good: np.ndarray, n: np.ndarray) -> int:
    """The step from which on rows go so that most more bad ones than good ones go; ties to the highest."""
    order = np.argsort(-step)
    gain = np.cumsum((n - 2 * good)[order])
    return int(step[order][np.argmax(gain)]) if len(gain) and gain.max() > 0 else SCORE_STEPS + 1
