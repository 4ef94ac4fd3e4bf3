"""Language of documents by string kernels.

Kernel. A text's blended spectrum is the set of its letter n-grams of 1 to 3
code points (lower-cased; every run of other characters is one gap), hashed
to ``DIMS`` places, enough that long texts of large alphabets do not fill them. The presence kernel of two texts is the number of common
places over the geometric mean of their numbers of places.

Nyström. ``landmarks`` texts of each language span the feature space: a text
is described by its kernels with all landmarks times the inverse square root
of the landmarks' own kernel matrix.

Classifier. One-versus-rest kernel ridge regression on a bounded sample of
texts. A text marks its places, the landmarks' places are looked up and
counted, and the kernels are multiplied by the coefficients; the answer is the language of the
largest output, the score its share in the softmax of the outputs.

At most ``landmarks`` languages are learned, the commonest. The sample has at most ``sample`` texts, as many of each language (those whose
ids hash lowest), and at most ``landmarks`` of them are landmarks; the driver
gathers the landmarks' places and the sample's kernels, so what it gathers and
broadcasts has a fixed bound; whole texts are read
both to learn and to predict.

A text can also be in none of the learned languages. A long one is taken to
be if its features are short: the squared length of a text's features is the
part of it that lies in the space of the landmarks, near 0 for a foreign
script or gibberish, and high for a text that mixes learned languages, whose
outputs are low. The floor is half of the least such part among the sample's
long texts. A short text says too little and is never rejected.

Defined results: ``und`` with score 0 for null texts, texts without a letter,
and when nothing could be learned. Rows with a null language or null id teach
nothing; a repeated id teaches once, with its greatest language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, matrix, stored

UNDETERMINED = "und"
#: Characters from which on a text is long enough to tell that it is in none of the languages.
JUDGED = 300
BITS = 20
DIMS = 1 << BITS
#: Multipliers of the n-gram hashes (odd, so that they permute 32-bit numbers).
FIRST, SECOND, THIRD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0x27D4EB2F)
MIX2, MIX3 = np.uint32(0xC2B2AE3D), np.uint32(0x165667B1)
SHIFT = np.uint32(32 - BITS)

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once in a process."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def grams_of(text: str | None) -> np.ndarray | None:
    """The places of the n-grams of ``text``, with repeats; None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters the first one stands for a gap
    points = np.where(letter, points, np.uint32(32))[keep]
    points = np.concatenate([np.array([32], np.uint32), points, np.array([32], np.uint32)])
    one = points * FIRST
    two = (one[:-1] ^ (points[1:] * SECOND)) * MIX2
    three = (two[:-1] ^ (points[2:] * THIRD)) * MIX3
    return np.concatenate([one, two, three]) >> SHIFT


def spectrum(text: str | None, out: np.ndarray) -> bool:
    """Mark the n-grams of ``text`` in ``out`` (DIMS numbers, all 0); False if it has no letter."""
    places = grams_of(text)
    if places is None:
        return False
    out[places] = 1
    return True


class Landmarks:
    """The places of the landmarks, one after the other: a sparse matrix of DIMS x landmarks."""

    def __init__(self, places: list[np.ndarray]) -> None:
        self.shape = (DIMS, len(places))
        self.places = np.concatenate([np.zeros(0, np.int32), *places])
        self.sizes = np.array([len(p) for p in places], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def kernels(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x landmarks, True where a text has a letter): kernels, 0 for texts without a letter."""
        out, known = np.zeros((len(texts), self.shape[1])), np.zeros(len(texts), bool)
        marked = np.zeros(DIMS, np.uint8)
        for i, text in enumerate(texts):
            own = grams_of(text)
            if own is None:
                continue
            known[i] = True
            marked[own] = 1
            if self.shape[1]:
                common = np.add.reduceat(marked[self.places], self.starts, dtype=np.int64)
                out[i] = common / np.sqrt(self.sizes * np.count_nonzero(marked))
            marked[own] = 0
        return out, known

    def among(self) -> np.ndarray:
        """The landmarks' kernels with each other."""
        out = np.zeros((self.shape[1], self.shape[1]))
        marked = np.zeros(DIMS, np.uint8)
        for i, (at, size) in enumerate(zip(self.starts, self.sizes, strict=True)):
            own = self.places[at:at + size]
            marked[own] = 1
            out[i] = np.add.reduceat(marked[self.places], self.starts, dtype=np.int64) / np.sqrt(self.sizes * size)
            marked[own] = 0
        return out


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    coefficients: np.ndarray  # landmarks + 1 (bias) x languages
    sharpness: float
    #: Inverse square root of the landmarks' kernel matrix: makes features of kernels.
    whiten: np.ndarray | None = None
    #: A text of ``JUDGED`` characters or more of which the landmarks span less than this is in none of the languages.
    floor: float = 0.0

    def spanned(self, kernels: np.ndarray) -> np.ndarray:
        """The part, from 0 to 1, of each text that lies in the space of the landmarks: the squared length of its features."""
        return ((kernels @ self.whiten) ** 2).sum(axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether the text can be of that language) of each text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        kernels, known = self.landmarks.kernels(texts)
        outputs = kernels @ self.coefficients[:-1] + self.coefficients[-1]
        best = outputs.argmax(axis=1)
        odds = np.exp(self.sharpness * (outputs - outputs.max(axis=1, keepdims=True)))
        share = 1.0 / odds.sum(axis=1)
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        short = np.array([len(t or "") < JUDGED for t in texts], bool)
        return names, np.where(known, share, 0.0), known & (short | (self.spanned(kernels) >= self.floor))


def _has_letter():
    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([any(map(str.isalpha, (t or "").lower())) for t in texts.to_pylist()], pa.bool_())

    return run


def _places():
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(grams_of(t)).astype(np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return run


def _kernels(marks: Landmarks, spark):
    shared = spark.sparkContext.broadcast(marks)

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(list(shared.value.kernels(texts.to_pylist())[0]), pa.list_(pa.float64()))

    return run


def fit(docs: DataFrame, learn: Column | None = None, sample: int = 3200, landmarks: int = 192,
        ridge: float = 1e-2, sharpness: float = 4.0, seed: int = 1) -> Model:
    """Learn from the rows of ``docs`` for which ``learn`` (a condition on doc_id) holds."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    # the commonest languages, no more than there are landmarks: the only ones that can be told apart
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(landmarks).collect()
    if not counts:
        return Model([], Landmarks([]), np.zeros((1, 0)), sharpness)
    per_language, per_marks = max(1, sample // len(counts)), landmarks // len(counts)
    wanted = per_language + 8 * per_language**0.5 + 32  # so many below the bound leave enough, but for chance beyond 8 sigma
    bounds = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, wanted / r["count"]) * (2**64 - 2**11)) - 2**63) for r in counts], "_name string, _below long")
    lowest = Window.partitionBy("lang").orderBy("_hash", "doc_id")
    # each language sends its rows below a bound alone, about as many as are wanted, whatever the number of partitions
    chosen = (
        rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(seed)).alias("_hash"))
        .join(F.broadcast(bounds), (F.col("lang") == F.col("_name")) & (F.col("_hash") <= F.col("_below"))).distinct()
        .withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= per_language)
        .groupBy("doc_id").agg(F.max("lang").alias("_lang"))
    )
    taught = stored(
        rows.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(_has_letter()("text"))
        .groupBy("doc_id").agg(F.max(F.struct("_lang", "text")).alias("_row"))
        .select("_row.*", F.xxhash64("doc_id", F.lit(seed + 1)).alias("_order")), "language-sample")
    first = Window.partitionBy("_lang").orderBy("_order")
    held = (taught.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= per_marks)
            .select("_lang", "_rank", _places()("text").alias("_places")).toArrow())
    if not held.num_rows:
        return Model([], Landmarks([]), np.zeros((1, 0)), sharpness)
    held = held.sort_by([("_lang", "ascending"), ("_rank", "ascending")])
    marks = Landmarks([p.values.to_numpy() for p in held.column("_places")])
    sample_rows = taught.select("_lang", "_order", F.char_length("text").alias("_size"),
                                _kernels(marks, docs.sparkSession)("text").alias("_kernels")).toArrow()
    sample_rows = sample_rows.sort_by([("_order", "ascending")])
    lang = np.array(sample_rows.column("_lang").to_pylist(), object)
    x = matrix(sample_rows.column("_kernels"))
    languages = sorted(set(lang))
    values, vectors = np.linalg.eigh(marks.among())
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([x @ whiten, np.ones((len(x), 1))])
    goal = np.where(lang[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]), features.T @ goal)
    coefficients = np.vstack([whiten @ solved[:-1], solved[-1:]])
    model = Model(languages, marks, coefficients, sharpness, whiten)
    long = x[sample_rows.column("_size").to_numpy() >= JUDGED]
    model.floor = float(model.spanned(long).min()) / 2 if len(long) else 0.0
    return model


def language_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column for ``docs``: ``lang`` and ``score`` of each whole text, and ``known``, false for a text that is
    in none of the learned languages."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("known", pa.bool_())])

    @F.arrow_udf("struct<lang:string,score:double,known:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        names, share, known = shared.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(share, pa.float64()), pa.array(known)],
                                          fields=list(kind))

    return run(F.col(text))


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the columns ``lang`` and ``score``: the language of each whole text."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in (lang, score)]).alias("row"),
                       language_column(docs, model).alias("found"))
    return rows.select("row.*", F.col("found.lang").alias(lang), F.col("found.score").alias(score))
