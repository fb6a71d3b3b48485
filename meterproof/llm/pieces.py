"""SentencePiece encoding and decoding: Viterbi over distinct marked words with shared prefixes.

The distinct new units (spaces as marks, and the word after them) of all texts of a batch are
sorted together, so that neighbours share their longest prefixes: one depth-first walk of the trie of units.
Forward scores belong to positions, and a unit keeps those of the prefix it shares with the
one before it. At each position only the vocabulary-trie nodes that still match are extended.
Ids of a unit are kept for later batches in a table that is emptied at its bound; long units are
not kept. Encoding, decoding and comparing take one pass over the rows. No shuffle.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import in_arrow, ragged
from meterproof.llm.token_counts import MODEL, SLICE, SPACE, check_units, units

#: Characters of the units that a worker keeps the ids of, each unit counting OVERHEAD more; units
#: over KEPT_LENGTH are encoded anew in each batch.
KNOWN_CHARACTERS, OVERHEAD, KEPT_LENGTH = 16_000_000, 20, 256
#: Characters of the texts whose units are gathered for one walk, about.
GATHERED = 4_000_000
# Fixed value: how far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10


class Pieces:
    """Pieces with scores in a trie: per node its children by character, its piece's score and id."""

    def __init__(self, model):
        size = model.get_piece_size()
        self.children: list[dict[str, int]] = [{}]
        self.score: list[float | None] = [None]
        self.piece: list[int] = [-1]
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        worst = 0.0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes_of[i], self.byte_ids[value] = bytes([value]), i
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                score = model.get_score(i)
                worst = min(worst, score)
                node = 0
                for character in piece:
                    if character not in self.children[node]:
                        self.children[node][character] = len(self.children)
                        self.children.append({})
                        self.score.append(None)
                        self.piece.append(-1)
                    node = self.children[node][character]
                self.score[node], self.piece[node] = score, i
        self.unknown = worst - UNKNOWN_PENALTY

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each distinct unit as 32-bit integers of this machine, from one walk.

        The best path has the greatest sum of scores; of equal paths the one whose last
        piece is longest. A character without a piece becomes its UTF-8 bytes.
        """
        children, score, piece_of, unknown, out = self.children, self.score, self.piece, self.unknown, {}
        first = children[0]
        best, start, piece, alive = [0.0], [0], [-1], [()]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], start[shared + 1 :], piece[shared + 1 :], alive[shared + 1 :]
            for at in range(shared, len(word)):
                character = word[at]
                top, chosen, source, matching = None, -1, at, []
                for begun, node in alive[at]:
                    child = children[node].get(character)
                    if child is not None:
                        matching.append((begun, child))
                        points = score[child]
                        if points is not None:
                            total = best[begun] + points
                            if top is None or total > top:
                                top, chosen, source = total, piece_of[child], begun
                child, points = first.get(character), None
                if child is not None:
                    matching.append((at, child))
                    points = score[child]
                if points is None:
                    total, single = best[at] + unknown, -1
                else:
                    total, single = best[at] + points, piece_of[child]
                if top is None or total > top:
                    top, chosen, source = total, single, at
                best.append(top)
                start.append(source)
                piece.append(chosen)
                alive.append(matching)
            ids, at = [], len(word)
            while at:
                if piece[at] >= 0:
                    ids.append(piece[at])
                else:
                    ids.extend(self.byte_ids[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass")))
                at = start[at]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            before = word
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; the space that marks the start of a text goes. Broken bytes become U+FFFD."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    check_units(model)
    return Pieces(model)


class Encoder:
    """Encodes batches of texts; remembers the ids of units."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary, self.known, self.held = vocabulary, {}, 0

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        parts: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for words in units(text):
                waiting.append((i, words))
                size += min(len(text), SLICE)
                if size > GATHERED:
                    self._walk(waiting, parts)
                    waiting, size = [], 0
        self._walk(waiting, parts)
        return [b"".join(p) for p in parts]

    def _walk(self, waiting: list[tuple[int, list[str]]], parts: list[list[bytes]]) -> None:
        wanted = set().union(*(words for _, words in waiting))
        new = wanted.difference(self.known)
        weight = sum(map(len, new)) + OVERHEAD * len(new)
        if self.held + weight > KNOWN_CHARACTERS:
            self.known, self.held, new = {}, 0, wanted
            weight = sum(map(len, new)) + OVERHEAD * len(new)
        if new:
            self.known.update(self.vocabulary.encode(list(new)))
            self.held += weight
        for i, words in waiting:
            parts[i].append(b"".join(map(self.known.__getitem__, words)))
        for word in new:
            if len(word) > KEPT_LENGTH:
                del self.known[word]
                self.held -= len(word) + OVERHEAD


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    encoder = Encoder(pieces(path))
    for batch in batches:
        yield batch, encoder.ids(batch.column(1).to_pylist())


def _lists(encoded: list[bytes]) -> pa.ListArray:
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    return ragged(np.frombuffer(b"".join(encoded), np.int32), lengths, pa.int32())


def _round_trips(vocabulary: Pieces, texts: list[str | None], encoded: list[bytes]) -> pa.Array:
    """Whether each text's ids, decoded, give the text, with the mark character read as a space."""
    equal = [vocabulary.decode(array("i", ids)) == (text or "").replace(SPACE, " ") for text, ids in zip(texts, encoded)]
    return pa.array(equal, pa.bool_())


def _encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, encoded in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(encoded)], ["id", "piece_ids"])

    return run


def _decoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return run


def _digest(ids: bytes) -> str:
    return hashlib.sha256(np.frombuffer(ids, np.int32).astype("<i4").tobytes()).hexdigest()


def _digesting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch, encoded in _encoded(batches, path):
            counts = pa.array([len(ids) // 4 for ids in encoded], pa.int64())
            equal = _round_trips(vocabulary, batch.column(1).to_pylist(), encoded)
            columns = [batch.column(0), counts, pa.array(list(map(_digest, encoded)), pa.string()), equal]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_pieces", "ids_sha256", "round_trip"])

    return run


def _checking(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch, encoded in _encoded(batches, path):
            equal = _round_trips(vocabulary, batch.column(1).to_pylist(), encoded)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(encoded), equal], ["id", "piece_ids", "round_trip"])

    return run


def _ids_and_text(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None) -> DataFrame:
    """Per row of `docs`: its id and piece_ids, the best segmentation of the whole text.

    NULL and empty texts have no pieces. Repeated rows are encoded each; columns besides id
    and text are not read, so their names may clash; an empty table gives an empty result.
    """
    rows, kind = _ids_and_text(docs, text, doc_id)
    done = in_arrow(rows, _encoding(model or public_tokenizers.path(MODEL)), f"id {kind}, piece_ids array<int>")
    return done.withColumnRenamed("id", doc_id)


def encode_checked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None) -> DataFrame:
    """`encode` with round_trip: whether the ids, decoded again, give the original text (with the
    mark character read as a space; NULL counts as empty). Rows are as in `encode`."""
    path = model or public_tokenizers.path(MODEL)
    rows, kind = _ids_and_text(docs, text, doc_id)
    done = in_arrow(rows, _checking(path), f"id {kind}, piece_ids array<int>, round_trip boolean")
    return done.withColumnRenamed("id", doc_id)


def decode(encoded: DataFrame, doc_id: str = "doc_id", piece_ids: str = "piece_ids", model: str | None = None) -> DataFrame:
    """Per row of `encoded`: its id and the text of its pieces; NULL for NULL, empty for none.

    A mark written out in the original text comes back as the space that it stands for.
    """
    rows = encoded.select(F.col(doc_id).alias("id"), F.col(piece_ids).alias("piece_ids"))
    kind = rows.schema["id"].dataType.simpleString()
    done = in_arrow(rows, _decoding(model or public_tokenizers.path(MODEL)), f"id {kind}, text string")
    return done.withColumnRenamed("id", doc_id)


def encode_digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None) -> DataFrame:
    """Encodes every text, decodes the ids again and reports, per row: n_pieces, the digest of
    the ids (32-bit little-endian) and whether the decoded text is the original one (with the
    mark character read as a space). NULL counts as empty and is a round trip. Rows are as in `encode`."""
    path = model or public_tokenizers.path(MODEL)
    rows, kind = _ids_and_text(docs, text, doc_id)
    done = in_arrow(rows, _digesting(path), f"id {kind}, n_pieces long, ids_sha256 string, round_trip boolean")
    return done.withColumnRenamed("id", doc_id)
