"""Quality of documents by nearest-neighbour voting in a latent-semantic space.

Terms. A text's terms are its bigrams of character classes (lower letters and
all non-ASCII bytes, capitals, digits, spaces, line ends, each punctuation
mark) and counts of repetition (words that equal the one before, words, word
pairs and word triples seen before). They say how a text is made, not what
it is about, so they carry over to words never seen. They are counted over
the whole text with array operations on its bytes.

Space. Term counts, per thousand bytes and square-rooted, are weighted by
inverse document frequency and projected on the leading singular vectors of
the labelled sample's term matrix.

Vote. Every document's latent vector is multiplied with all labelled latent
vectors (exact cosines, one block of documents at a time); each labelled
document votes for its label with weight ``max(cosine, 0) ** power``, the
labels weighted back to their shares among all labelled rows. The score is
the share of the votes for label 1.

The labelled vectors are broadcast: at most ``per_label`` of each label (the
ones whose ids hash lowest), so their size has a fixed bound. Labels are
counted over all labelled rows.

Defined results: null and empty texts have no terms, so no cosine; their
score is the share of label 1. Without labels every score is 0.5, with one
label its value. Labels other than 0 and 1, null ids and documents without a
label teach nothing; an id labelled both 0 and 1 teaches nothing; an id that
is labelled or stored more than once teaches once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, bounded_batches, matrix

PUNCTUATION = ".,!|*&%$#@-_:;'\"()<>/=+?"
OTHER = 5 + len(PUNCTUATION)
N_CLASSES = OTHER + 1
N_REPEATS = 6
N_TERMS = N_CLASSES * N_CLASSES + N_REPEATS


def _classes() -> np.ndarray:
    """Class of each byte: 0 lower letters and bytes of non-ASCII characters, 1 capitals, 2 digits, 3 spaces,
    4 line ends, one for each punctuation mark, one for the rest."""
    table = np.full(256, OTHER, np.uint16)
    table[ord("a"):ord("z") + 1] = 0
    table[128:] = 0
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    table[[9, 11, 12, 32]] = 3
    table[[10, 13]] = 4
    for i, mark in enumerate(PUNCTUATION):
        table[ord(mark)] = 5 + i
    return table


CLASS_OF = _classes()
BYTE_KEY = np.random.default_rng(7).integers(1, 2**63, size=256, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _repeats(words: np.ndarray) -> int:
    s = np.sort(words)
    return int((s[1:] == s[:-1]).sum())


def term_counts(text: bytes | None) -> np.ndarray:
    """Counts of a text's terms; all zero for a text without bytes."""
    out = np.zeros(N_TERMS, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    kind = CLASS_OF[raw]
    n_pairs = N_CLASSES * N_CLASSES
    if len(raw) > 1:
        out[:n_pairs] = np.bincount(kind[:-1] * np.uint16(N_CLASSES) + kind[1:], minlength=n_pairs)
    blank = (kind == 3) | (kind == 4)
    begins = ~blank
    begins[1:] &= blank[:-1]
    start = np.flatnonzero(begins)
    if len(start):
        # hash of a word: sum of its bytes' keys, each times an odd number for its place in the word
        word = np.cumsum(begins) - 1
        place = np.arange(len(raw)) - start[np.maximum(word, 0)]
        key = BYTE_KEY[raw] * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        key ^= key >> np.uint64(29)
        key[blank] = 0
        words = np.add.reduceat(key, start)
        pairs = words[:-1] * MIX + words[1:]
        triples = pairs[:-1] * MIX + words[2:] if len(words) > 2 else words[:0]
        again = _repeats(triples)
        out[n_pairs:] = (len(words), (words[1:] == words[:-1]).sum(), _repeats(words), _repeats(pairs), again,
                         len(triples) - again)
    return out


def _weights(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.sqrt(counts * (1000.0 / np.maximum(size, 1))[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _gathered(terms: pa.ChunkedArray) -> np.ndarray:
    """The weights of gathered term counts (with the size last), made block by block in the one matrix that is held."""
    x, at = np.empty((len(terms), N_TERMS)), 0
    for chunk in terms.chunks:
        for begin in range(0, len(chunk), BATCH_ROWS):
            part = matrix(chunk.slice(begin, BATCH_ROWS))
            x[at:at + len(part)] = _weights(part[:, :-1], part[:, -1])
            at += len(part)
    return x


def _to_unit(x: np.ndarray) -> None:
    """:func:`_unit` in place."""
    for begin in range(0, len(x), BATCH_ROWS):
        x[begin:begin + BATCH_ROWS] = _unit(x[begin:begin + BATCH_ROWS])


@dataclass
class Model:
    idf: np.ndarray  # weight of each term
    basis: np.ndarray  # terms x latent dimensions
    vectors: np.ndarray  # labelled latent vectors, unit length
    votes: np.ndarray  # per labelled vector: its vote for label 0 and for label 1
    prior: float
    power: float

    def scores(self, counts: np.ndarray, size: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        latent = _unit(_unit(_weights(counts, size) * self.idf) @ self.basis)
        near = np.maximum(latent @ self.vectors.T, 0) ** self.power
        for_each = near @ self.votes
        total = for_each.sum(axis=1)
        out = np.full(len(counts), self.prior)
        np.divide(for_each[:, 1], total, out=out, where=total > 0)
        return np.clip(out, 0, 1)


def labelled_sample(labels: DataFrame, label: str, per_label: int, seed: int) -> DataFrame:
    """(doc_id, label): at most ``per_label`` ids of each label, those whose hashes are lowest."""
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.min(label).alias("_label"), F.max(label).alias("_max"))
        .where("_label = _max").select("doc_id", "_label")
    )
    parts = [clean.where(F.col("_label") == v).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(per_label)
             for v in (0, 1)]
    return parts[0].union(parts[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None,
        per_label: int = 2000, dims: int = 48, power: float = 8.0, seed: int = 1) -> Model:
    """Learn from the rows of ``labels`` for which ``learn`` (a condition on doc_id) holds; ``docs`` has their
    texts. ``per_label`` bounds what is gathered on the driver and broadcast."""
    bounded_batches(docs.sparkSession)
    if learn is not None:
        labels = labels.where(learn)
    known = labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    sample = labelled_sample(labels, label, per_label, seed)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .select("doc_id", "_label", _terms_udf()(F.col("text").cast("binary")).alias("_terms"))
        .groupBy("doc_id").agg(F.max(F.struct("_label", "_terms")).alias("_row"))
        .select("doc_id", "_row.*").toArrow().sort_by("doc_id")
    )
    if not rows.num_rows:
        none = np.zeros((0, 0))
        return Model(none, none, none, none, 0.5 if known is None else float(known), power)
    y = rows.column("_label").to_numpy().astype(int)
    x = _gathered(rows.column("_terms"))
    del rows
    seen = (x > 0).sum(axis=0)
    idf = np.where(seen > 0, np.log((1 + len(x)) / (1 + seen)) + 0.1, 0.0)
    x *= idf
    _to_unit(x)
    _, basis = np.linalg.eigh(x.T @ x)
    basis = basis[:, -dims:]
    share = np.bincount(y, minlength=2) / len(y)
    # votes weigh the labels as all labelled rows have them, not as the sample has
    fair = np.divide([1 - known, known], share, out=np.zeros(2), where=share > 0)
    votes = np.zeros((len(y), 2))
    votes[np.arange(len(y)), y] = fair[y]
    return Model(idf, basis, _unit(x @ basis), votes, float(known), power)


def _terms_udf():
    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        """Term counts and, last, the size in bytes."""
        rows = [np.append(term_counts(t), np.float32(len(t or b""))) for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.float32()))

    return run


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: the quality score of each whole text."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        raw = texts.to_pylist()
        counts = np.stack([term_counts(t) for t in raw]).astype(np.float64)
        size = np.array([len(t or b"") for t in raw], np.float64)
        return pa.array(shared.value.scores(counts, size), pa.float64())

    return docs.withColumn(out, run(F.col("text").cast("binary")))
