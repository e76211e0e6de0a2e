"""Language identification by error-correcting output codes (ECOC).

Every language has a codeword of +1/-1. For each bit, a logistic classifier over hashed byte n-grams
tells the languages with +1 from those with -1. A text's language is the one whose codeword costs
the least weighted logistic loss against the classifiers' margins; a bit weighs as much as its
classifier's accuracy on the learning rows goes beyond chance. A text is flagged ``ambiguous`` if
its bits disagree with the chosen codeword in more places than the code can correct.

Learning reads a bounded sample, ``sample`` rows per language, picked by a hash of the document id;
executors count their n-grams and the driver gets sparse counts only, at most
``sample`` x languages x ``DIMS`` small numbers. Prediction reads every whole text once, without a
shuffle, and texts of any length in pieces of bounded size. Prediction sees nothing but the text.

Codes: up to seven languages have the exhaustive code (all 2^(k-1)-1 ways to split them); more have
the best of ``CODE_TRIALS`` random codes.

Edge cases. A null text, or one without a letter (``\\p{L}``), is ``und`` with score 0, as is every
text if there was nothing to learn from; such rows teach nothing. Rows without lang or doc_id teach
nothing either. Repeated rows are judged each by itself. Extra columns pass through; a result column
whose name is taken gets underscores in front. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ferry.llm.common import fresh_name
from ferry.llm.words import CHUNK, _bytes_of

UNDEFINED = "und"
TRIGRAMS, BIGRAMS = 4096, 1024
DIMS = TRIGRAMS + BIGRAMS
CODE_TRIALS = 200
MAX_LANGUAGES = 500

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32                                   # digits, punctuation, spaces
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class EcocParams:
    sample: int = 500              # learning rows per language
    iterations: int = 300
    ridge: float = 1e-4
    seed: int = 7


def ngram_codes(data: np.ndarray) -> np.ndarray:
    """Feature numbers of all n-grams of some UTF-8 bytes: trigrams, then bigrams."""
    x = _FOLD[data]
    if len(x) < 2:
        return np.zeros(0, np.int64)
    pair = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)
    two = (pair * np.uint32(0x27D4EB2F)) >> np.uint32(22)
    three = (pair[:-1] + x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x165667B1) >> np.uint32(20)
    # Runs of separators say nothing.
    blank2 = (x[:-1] == 32) & (x[1:] == 32)
    return np.concatenate([three[~(blank2[:-1] | blank2[1:])], two[~blank2] + np.uint32(TRIGRAMS)]).astype(np.int64)


def count_ngrams(data: np.ndarray) -> np.ndarray:
    """Counts of all features of one text, in pieces that overlap by two bytes."""
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, max(len(data) - 2, 1), CHUNK):
        counts += np.bincount(ngram_codes(data[at:at + CHUNK + 2]), minlength=DIMS)
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies: rows of length 1 (or 0 for texts without n-grams)."""
    total = counts.sum(axis=-1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1), dtype=np.float32)


def codewords(k: int, seed: int) -> np.ndarray:
    """A +1/-1 matrix, languages x bits."""
    if k == 1:
        return np.ones((1, 0), np.float32)
    if k <= 7:
        bits = [(1, *rest) for rest in itertools.product((1, -1), repeat=k - 1) if -1 in rest]
        return np.array(bits, np.float32).T
    rng, best, most = np.random.default_rng(seed), None, -1
    length = 10 * int(np.ceil(np.log2(k)))
    for _ in range(CODE_TRIALS):
        code = rng.choice(np.array([1, -1], np.float32), (k, length))
        apart = (length - code @ code.T) / 2 + length * np.eye(k)
        varied = np.abs(code.sum(axis=0)).max() < k
        if varied and apart.min() > most:
            best, most = code, apart.min()
    return best


@dataclass
class EcocModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray            # DIMS x bits
    bias: np.ndarray
    trust: np.ndarray              # weight of a bit in decoding

    @property
    def radius(self) -> int:
        """Number of wrong bits that the code corrects for certain."""
        if len(self.languages) < 2:
            return 0
        apart = (self.code.shape[1] - self.code @ self.code.T) / 2
        return int(apart[~np.eye(len(apart), dtype=bool)].min() - 1) // 2

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language numbers, scores between 0 and 1, and ambiguity flags of feature rows."""
        margins = x @ self.weights + self.bias
        losses = np.stack([(self.trust * np.logaddexp(0, -margins * word)).sum(axis=1) for word in self.code], axis=1)
        best = losses.argmin(axis=1)
        likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
        wrong = (np.sign(margins) != self.code[best]).sum(axis=1)
        return best, 1 / likely.sum(axis=1), wrong > self.radius


def fit(counts: np.ndarray, labels: np.ndarray, languages: list[str], params: EcocParams) -> EcocModel:
    """Learn all bits' classifiers together, by accelerated gradient descent on balanced rows."""
    x, code = features(counts), codewords(len(languages), params.seed)
    target = code[labels]
    share = np.bincount(labels, minlength=len(languages))[labels]
    weight = (1 / share / len(languages)).astype(np.float32)[:, None]
    w = np.zeros((DIMS, code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    wv, bv, rate = w.copy(), b.copy(), np.float32(4)           # rows have length 1: curvature is at most 1/2
    for step in range(params.iterations):
        pull = -weight * target / (1 + np.exp(target * (x @ wv + bv)))
        w_new, b_new = wv - rate * (x.T @ pull + params.ridge * wv), bv - rate * pull.sum(axis=0)
        momentum = np.float32(step / (step + 3))
        wv, bv, w, b = w_new + momentum * (w_new - w), b_new + momentum * (b_new - b), w_new, b_new
    right = (np.sign(x @ w + b) == target).astype(np.float32)
    accuracy = (right * weight).sum(axis=0)
    trust = np.maximum(2 * accuracy - 1, 0.01)
    return EcocModel(languages, code, w, b, trust / trust.mean() if len(trust) else trust)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


SPARSE = "lang string, at binary, n binary"


def train(docs: DataFrame, params: EcocParams = EcocParams()) -> EcocModel:
    """Learn from rows (doc_id, text, lang) with a lang, an id and letters that are not held out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return EcocModel([], np.zeros((0, 0)), np.zeros((DIMS, 0)), np.zeros(0), np.zeros(0))
    # A hash threshold per language leaves little more than the sample; a rank makes the bound hard.
    h = F.xxhash64(F.lit(params.seed), F.col("doc_id"))
    place = F.shiftrightunsigned(h, 11) / float(2**53)
    limit = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, 1.5 * params.sample / n))])
    near = rows.where((place < F.try_element_at(limit, F.col("lang"))) & has_letter(F.col("text"))) \
        .select("lang", "text", h.alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", F.length("text"), F.xxhash64("text")))
    sample = near.withColumn("r", rank).where(F.col("r") <= params.sample).select("lang", "text")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = _bytes_of(batch.column(1))
            counts = [count_ngrams(data[a:b]) for a, b in zip(offs, offs[1:])]
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column(0).cast(pa.string()),
                "at": [a.astype("<u2").tobytes() for a in at],
                "n": [c[a].astype("<u4").tobytes() for c, a in zip(counts, at)]})

    got = sorted((r["lang"], bytes(r["at"]), bytes(r["n"])) for r in sample.mapInArrow(sparse, SPARSE).collect())
    languages = sorted({lang for lang, _, _ in got})
    if not languages:
        return EcocModel([], np.zeros((0, 0)), np.zeros((DIMS, 0)), np.zeros(0), np.zeros(0))
    counts = np.zeros((len(got), DIMS), np.float32)
    for i, (_, at, n) in enumerate(got):
        counts[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
    labels = np.array([languages.index(lang) for lang, _, _ in got])
    return fit(counts, labels, languages, params)


def predict(docs: DataFrame, model: EcocModel, text: str = "text") -> DataFrame:
    """``docs`` plus, as its last columns, lang_pred, score and ambiguous.

    A result column whose name ``docs`` has already gets underscores in front.
    """
    spark = docs.sparkSession
    mark = fresh_name(docs, "letters")
    schema = docs.schema
    rows = docs.withColumn(mark, has_letter(F.col(text)))
    out = T.StructType(schema.fields + [
        T.StructField(fresh_name(docs, name), kind)
        for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType()))])
    shared = spark.sparkContext.broadcast(model)              # DIMS x bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: EcocModel = shared.value
        names = np.array([*m.languages, UNDEFINED], object)
        for batch in batches:
            known = batch.column(mark).to_numpy(zero_copy_only=False).astype(bool) & bool(m.languages)
            data, offs = _bytes_of(batch.column(text))             # null texts are empty here
            best = np.full(len(known), len(m.languages))
            score, unsure = np.zeros(len(known)), np.ones(len(known), bool)
            todo = np.flatnonzero(known)
            for k in range(0, len(todo), 256):
                part = todo[k:k + 256]
                x = features(np.stack([count_ngrams(data[offs[i]:offs[i + 1]]) for i in part]))
                best[part], score[part], unsure[part] = m.decode(x)
            columns = [batch.column(f.name) for f in schema.fields]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names[best], pa.string()), pa.array(score), pa.array(unsure)], out.names)

    return rows.mapInArrow(run, out)


def language_filter(docs: DataFrame, params: EcocParams = EcocParams()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, ...) whose language is recognised, columns unchanged.

    Rejected are texts without a letter and texts whose bits the code cannot correct. Where there is
    nothing to learn from (no labelled row with an id and letters that is not held out), no language
    can be judged, and only texts without a letter are rejected.
    """
    model = train(docs, params)
    if not model.languages:
        return docs.where(has_letter(F.col("text")))
    judged = predict(docs, model)
    lang_pred, _, ambiguous = judged.columns[-3:]
    return judged.where((F.col(lang_pred) != UNDEFINED) & ~F.col(ambiguous)).drop(*judged.columns[-3:])
