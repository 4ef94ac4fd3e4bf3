"""Byte-level BPE encoding and decoding.

A rank file (one ``base64-token rank`` per line) gives the vocabulary. Every
byte is mapped to a printable character, the tokens are written in these
characters, and each token's merge is recovered by merging its bytes with the
ranks below its own; that makes a BPE model of the ``tokenizers`` library
which merges as the ranks say. Texts arrive as Arrow batches and are split by
the pre-tokenisation pattern; every match is mapped to characters and encoded
by the model on its own.

Offsets. A token covers a range of characters of the mapped match, which is
its range of bytes; ``encode`` can return these byte ranges, from which the
characters that a token splits are plain to see.

Decoding reverses the byte table. The bytes of a whole text are joined before
they are read as UTF-8, so a character split over several tokens comes back;
``decode`` of ids that stop amid a character gives U+FFFD for the rest.

Matches repeat, so a worker remembers those it has encoded, up to
``REMEMBERED``; then it starts anew. A space after a character that is no
white space, or before one, is always where a match begins (the pattern takes
it as the first character of the next match), so text is first cut there and
whole pieces are looked up; texts with a space that has white space before it
and none but white space or the end after it are cut by the pattern alone.

Defined results: null texts count as empty: no ids, the digests of no bytes.
Special tokens are never used. Ids without a token decode to no bytes.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Size of what a worker remembers before it starts anew: characters of matches and pieces, and ENTRY for each of them.
#: A longer text than an eighth of it is not remembered.
REMEMBERED, ENTRY = 14_000_000, 40
#: Where cutting at spaces alone could differ from the pattern.
AMID_SPACE = regex.compile(r"\s\x20(?!\S)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters for themselves, the others in
    order from U+0100 on."""
    # The byte ranges that stand for themselves in byte-level BPE vocabularies.
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that are merged last to make ``token``; None if the ranks below its own don't lead there."""
    parts = [token[i:i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        options = [(ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(options)
        if rank >= limit:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def model_parts(ranks: dict[bytes, int]) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """Vocabulary and merges, in characters, of the model that merges as ``ranks`` say."""
    characters = byte_characters()
    spell = lambda token: "".join(characters[b] for b in token)
    pairs = (last_merge(t, ranks) for t in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__))
    return {spell(t): r for t, r in ranks.items()}, [(spell(p[0]), spell(p[1])) for p in pairs if p]


class Codec:
    """Encoder and decoder of one vocabulary, with the pieces it remembers."""

    def __init__(self, ranks: dict[bytes, int], merges: list[tuple[str, str]], vocabulary: dict[str, int],
                 pattern: str) -> None:
        from tokenizers.models import BPE

        self.model = BPE(vocab=vocabulary, merges=merges, cache_capacity=0)
        self.pattern = regex.compile(pattern)
        self.spelling = {b: c for b, c in enumerate(byte_characters())}
        self.byte_of = {c: b for b, c in self.spelling.items()}
        self.bytes_of = {i: bytes(self.byte_of[c] for c in token) for token, i in vocabulary.items()}
        self.digits = {i: str(i) for i in vocabulary.values()}
        self.words: dict[str, list[int]] = {}
        self.pieces: dict[str, tuple[int, str, bytes]] = {}
        #: Size of the remembered matches and pieces.
        self.held = 0

    def _make_room(self, text: str) -> bool:
        """True if ``text`` is short enough to be remembered; forgets all others where it would not fit."""
        if len(text) > REMEMBERED // 8:
            return False
        self.held += len(text) + ENTRY
        if self.held > REMEMBERED:
            self.words.clear()
            self.pieces.clear()
            self.held = len(text) + ENTRY
        return True

    def match_tokens(self, match: str) -> list:
        """The model's tokens of one match of the pattern."""
        return self.model.tokenize(match.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.spelling))

    def word_ids(self, match: str) -> list[int]:
        ids = self.words.get(match)
        if ids is None:
            ids = [token.id for token in self.match_tokens(match)]
            if self._make_room(match):
                self.words[match] = ids
        return ids

    def split(self, text: str) -> list[str]:
        """Pieces of the text, each of whole matches of the pattern."""
        if AMID_SPACE.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *(" " + piece for piece in rest)] if first else [" " + piece for piece in rest]

    def piece(self, piece: str) -> tuple[int, str, bytes]:
        """Number of ids, ids in digits, and decoded bytes of a piece."""
        ids = [i for match in self.pattern.findall(piece) for i in self.word_ids(match)]
        found = (len(ids), " ".join(map(self.digits.__getitem__, ids)), self.decode_bytes(ids))
        if self._make_room(piece):
            self.pieces[piece] = found
        return found

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in digits, SHA-256 of the decoded bytes."""
        known, learn = self.pieces, self.piece
        parts = [known.get(p) or learn(p) for p in self.split(text)] if text else []
        return (sum(p[0] for p in parts), hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest(),
                hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())

    def ids(self, text: str | None) -> list[int]:
        return [i for match in self.pattern.findall(text or "") for i in self.word_ids(match)]

    def ids_and_offsets(self, text: str | None) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids, and the range of bytes of the text that each covers."""
        ids, ranges, at = [], [], 0
        for match in self.pattern.findall(text or ""):
            for token in self.match_tokens(match):
                size = len(self.bytes_of[token.id])
                ids.append(token.id)
                ranges.append((at, at + size))
                at += size
        return ids, ranges

    def decode_bytes(self, ids) -> bytes:
        return b"".join([self.bytes_of.get(i, b"") for i in ids])

    def decode(self, ids) -> str | None:
        return None if ids is None else self.decode_bytes(ids).decode("utf-8", "replace")


class Tokens:
    """Encoding and decoding of DataFrame columns with one rank file.

    The model's parts are made once on the driver and broadcast; their size is that of the vocabulary."""

    def __init__(self, docs: DataFrame, path: str, pattern: str) -> None:
        bounded_batches(docs.sparkSession)
        ranks = read_ranks(path)
        vocabulary, merges = model_parts(ranks)
        name = hashlib.sha256(repr((sorted(ranks.items(), key=lambda r: r[1]), pattern)).encode()).hexdigest()
        self.shared = docs.sparkSession.sparkContext.broadcast((name, ranks, merges, vocabulary, pattern))

    def _codec(self):
        shared, made = self.shared, []

        def codec() -> Codec:
            if not made:
                made.append(_process_codec(shared))
            return made[0]

        return codec

    def digests(self, docs: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
        """``docs`` with the struct ``out``: n_tokens, ids_sha256, decoded_sha256 of each whole text."""
        codec = self._codec()
        kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

        @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
        def run(texts: pa.Array) -> pa.Array:
            digests = codec().digests
            columns = zip(*[digests(t) for t in texts.to_pylist()], strict=True)
            return pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))

        return docs.withColumn(out, run(F.col(text)))

    def encode(self, docs: DataFrame, text: str = "text", out: str = "ids", offsets: str | None = None) -> DataFrame:
        """``docs`` with the ids of each whole text and, if named, the byte ranges they cover."""
        codec = self._codec()
        if offsets is None:
            @F.arrow_udf("array<int>")
            def ids_of(texts: pa.Array) -> pa.Array:
                return pa.array([codec().ids(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

            return docs.withColumn(out, ids_of(F.col(text)))

        @F.arrow_udf("struct<ids:array<int>,ranges:array<struct<start:int,stop:int>>>")
        def both_of(texts: pa.Array) -> pa.Array:
            kind = pa.struct([("ids", pa.list_(pa.int32())),
                              ("ranges", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
            rows = [codec().ids_and_offsets(t) for t in texts.to_pylist()]
            return pa.array([{"ids": i, "ranges": [{"start": a, "stop": b} for a, b in r]} for i, r in rows], kind)

        return (docs.withColumn("_encoded", both_of(F.col(text)))
                .withColumns({out: F.col("_encoded.ids"), offsets: F.col("_encoded.ranges")}).drop("_encoded"))

    def decode(self, docs: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """``docs`` with the text that the ids stand for (null for null ids)."""
        codec = self._codec()

        @F.arrow_udf("string")
        def run(column: pa.Array) -> pa.Array:
            return pa.array([codec().decode(i) for i in column.to_pylist()], pa.string())

        return docs.withColumn(out, run(F.col(ids)))


_codecs: dict[str, Codec] = {}


def _process_codec(shared) -> Codec:
    """One codec per worker process and vocabulary, whatever the number of tasks it runs; vocabularies are told apart by
    a digest of their ranks and pattern."""
    name, ranks, merges, vocabulary, pattern = shared.value
    if name not in _codecs:
        _codecs[name] = Codec(ranks, merges, vocabulary, pattern)
    return _codecs[name]
