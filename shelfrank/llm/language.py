"""Language identification by error-correcting output codes over n-gram classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.text import LOWER, draw_hash, draw_limit, mix64, slices

#: Buckets that hashed three- and four-byte n-grams share.
DIMENSIONS = 4096
#: Labelled rows that the classifiers are fitted on, all languages together.  Documented bound of the fit.
FIT_ROWS = 3000
RIDGE = 0.3
#: Conjugate gradients end at this share of the first residue, or after so many rounds.
PRECISION, ROUNDS = 1e-4, 300
#: More values of ``lang`` than this are taken for a mistake in the table.
MOST_LANGUAGES = 500
SHARPNESS = 2.0
AMBIGUOUS_BELOW = 0.35
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

#: ASCII letters in lower case, other ASCII as a space; parts of longer characters stay.
FOLDED = LOWER.copy()
FOLDED[:128] = np.where((FOLDED[:128] >= 97) & (FOLDED[:128] <= 122), FOLDED[:128], 32)
#: One random value per place in the n-gram and byte; their exclusive or is the n-gram's bucket.
SALTS = (mix64(np.arange(1, 1025, dtype=np.uint64)) % DIMENSIONS).astype(np.uint16).reshape(4, 256)


def ngram_profiles(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: square roots of the shares of its n-grams by bucket, so rows have length 1 (0 without n-grams)."""
    docs = len(offsets) - 1
    byte = FOLDED[data]
    doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(offsets))
    counts = np.zeros(docs * DIMENSIONS)
    for n in (3, 4):
        if len(byte) < n:
            continue
        end = len(byte) - n + 1
        bucket = SALTS[0][byte[:end]].copy()
        for k in range(1, n):
            bucket ^= SALTS[k][byte[k : end + k]]
        use = (doc[:end] == doc[n - 1 :]) & ~((byte[:end] == 32) & (byte[1 : end + 1] == 32))
        counts += np.bincount(doc[:end][use] * DIMENSIONS + bucket[use], minlength=docs * DIMENSIONS)
    counts = counts.reshape(docs, DIMENSIONS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(classes: int, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 per class.

    Up to five classes: every way to part them in two, once.  Beyond: of 200 random codes of
    10 bits per doubling the one whose closest codewords are farthest apart.
    """
    if classes <= 5:
        width = 2 ** (classes - 1) - 1
        bits = (np.arange(1, width + 1)[None, :] >> np.arange(classes - 1)[:, None]) & 1
        return np.vstack([np.zeros((1, width)), bits]) * 2.0 - 1.0
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(classes)))
    best, far = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, size=(classes, width)) * 2.0 - 1.0
        gap = (width - code @ code.T) / 2
        np.fill_diagonal(gap, width)
        if gap.min() > far and (np.abs(code.sum(axis=0)) < classes).all():
            best, far = code, gap.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: Sequence[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, profiles: np.ndarray) -> np.ndarray:
        """Per text and language: the mean exponential loss of the bits, weighted by how well each bit knows the language."""
        margin = profiles @ self.weights + self.bias
        return np.stack(
            [np.exp(-np.clip(margin * word, -4, 4)) @ trust for word, trust in zip(self.code, self.trust, strict=True)], axis=1
        )

    def decode(self, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score from 0 to 1) of the nearest codeword."""
        losses = self.losses(profiles)
        power = np.exp(-SHARPNESS * (losses - losses.min(axis=1, keepdims=True)))
        return losses.argmin(axis=1), (power.max(axis=1) / power.sum(axis=1)).astype(float)


def fit_bits(blocks: Sequence[np.ndarray], target: np.ndarray, languages: Sequence[str]) -> LanguageModel:
    """One ridge classifier per bit; rows of each language weigh the same in total.

    The profiles come in blocks of rows and are only read: conjugate gradients solve the normal equations of all bits
    at once, so beside the profiles nothing has the size of the fit.
    """
    code = codewords(len(languages))
    share = np.bincount(target, minlength=len(languages)).astype(float)
    weight = len(target) / len(languages) / share[target]
    ends = np.cumsum([len(b) for b in blocks])
    parts = [(x, slice(end - len(x), end)) for x, end in zip(blocks, ends, strict=True)]

    def gathered(of_rows: np.ndarray) -> np.ndarray:
        """The profiles' weighted sum, and in the last row that of the constant feature."""
        of_rows = of_rows * weight[:, None]
        total = sum((x.T @ of_rows[at].astype(np.float32) for x, at in parts), np.zeros((DIMENSIONS, of_rows.shape[1])))
        return np.vstack([total, of_rows.sum(axis=0)])

    def margins(solution: np.ndarray) -> np.ndarray:
        weights = solution[:-1].astype(np.float32)
        return np.concatenate([x @ weights for x, _ in parts]) + solution[-1]

    wanted = code[target]
    left = gathered(wanted)
    solution, way, size = np.zeros_like(left), left, (left**2).sum(axis=0)
    enough = np.maximum(size, 1e-300) * PRECISION**2
    for _ in range(ROUNDS):
        if (size <= enough).all():
            break
        bent = gathered(margins(way)) + RIDGE * way
        step = size / np.maximum((way * bent).sum(axis=0), 1e-300)
        solution, left = solution + step * way, left - step * bent
        before, size = size, (left**2).sum(axis=0)
        way = left + size / np.maximum(before, 1e-300) * way
    right = margins(solution) * wanted > 0
    trust = np.stack([right[target == c].mean(axis=0) for c in range(len(languages))]) + 1e-3
    return LanguageModel(languages, code, solution[:-1].astype(np.float32), solution[-1], trust / trust.sum(axis=1, keepdims=True))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in slices(batch.column(1)):
            rows = pa.array([row.tobytes() for row in ngram_profiles(data, offsets)], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), rows], names=["lang", "profile"])


def _block(profiles: pa.Array) -> np.ndarray:
    first = profiles.offset * DIMENSIONS
    return np.frombuffer(profiles.buffers()[2], dtype=np.float32)[first : first + len(profiles) * DIMENSIONS].reshape(-1, DIMENSIONS)


def fit_language_model(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel | None:
    """Fit on about ``fit_rows`` rows of (doc_id, text, lang), as many of each language, never over twice as many.

    Rows are drawn by a hash of doc_id and text, equal rows once.  None if no row has text and language.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", draw_hash("doc_id", "text").alias("draw"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    # Each language gives a share of the hash range, so only what is drawn of it meets in one task.
    limits = {c: draw_limit(fit_rows / (len(counts) * n)) for c, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    chosen = rows.where(F.col("draw") <= limit).dropDuplicates(["lang", "draw"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = chosen.withColumn("place", place).where(F.col("place") <= max(1, 2 * fit_rows // len(counts)))
    fitted = chosen.select("lang", "text").mapInArrow(_profile, "lang string, profile binary").toArrow()
    languages = sorted(set(fitted.column("lang").to_pylist()))
    target = np.array([languages.index(c) for c in fitted.column("lang").to_pylist()], dtype=np.int64)
    # The rows of a chunk lie end to end in its buffer, so the profiles are never copied.
    blocks = [_block(chunk) for chunk in fitted.column("profile").chunks]
    return fit_bits(blocks, target, languages)


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Add lang_pred, score (0 to 1) and ambiguous to ``docs``.

    ``und`` with score 0 stands for null texts, texts without a letter, and for everything without a
    model.  ``ambiguous`` marks scores below ``AMBIGUOUS_BELOW``.  Rows are independent: repeated
    rows give repeated results, an empty table none.  Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    names = docs.columns
    place = names.index("text")
    schema = T.StructType([*docs.schema]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    known = np.array([*(model.languages if model else []), UNKNOWN], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            for low, high, data, offsets in slices(texts):
                part = batch.slice(low, high - low)
                lettered = np.array([t is not None and LETTER.search(t) is not None for t in part.column(place).to_pylist()])
                if model:
                    best, score = model.decode(ngram_profiles(data, offsets))
                else:
                    best, score = np.zeros(high - low, dtype=int), np.zeros(high - low)
                    lettered[:] = False
                best = np.where(lettered, best, len(known) - 1)
                score = np.where(lettered, score, 0.0)
                more = [pa.array(known[best], type=pa.string()), pa.array(score), pa.array(score < AMBIGUOUS_BELOW)]
                columns = [*part.columns, *more]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score", "ambiguous"])

    return docs.mapInArrow(predict, schema)


def held_out(doc_id) -> F.Column:
    """Whether a document may not be learned from: crc32 of its id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify_languages(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, predict all: doc_id, held_out, lang_pred, score, ambiguous."""
    model = fit_language_model(docs.where(~held_out(F.col("doc_id"))))
    found = predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
