"""Token counts: rank-synchronous merging of many pre-tokens at once in ragged numpy arrays.

A text is cut into units (spaces and the word after them) that no vocabulary piece crosses.
The distinct units of a batch lie behind one another in flat arrays: one entry a symbol, with
the piece that a symbol would make with its right neighbour. In each round every unit applies
its lowest-rank pair (the leftmost of equals), all units at the same time, and leaves the
arrays when it has no pair left. What survives is counted: one token a piece, one a byte for a
character the vocabulary lacks. A table from unit to count is kept between batches and is
emptied when its units have grown to a number of characters; long units are not kept. There is
no shuffle.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import in_arrow

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
EDGE = re.compile(f"(?<=[^{SPACE}]){SPACE}")
NONE = np.int64(1) << 30
# A unit over this length is merged with a queue: rounds over a flat array would cost its square.
LONG_UNIT = 2048
#: Characters of the units whose counts a worker keeps, each unit counting OVERHEAD more; units
#: over KEPT_LENGTH are counted anew in each batch.
KNOWN_CHARACTERS, OVERHEAD, KEPT_LENGTH = 32_000_000, 40, 256
#: Characters of the texts whose units are gathered for one call, about, and units of one round.
GATHERED = 4_000_000
ROUND_UNITS = 50_000
SLICE = 1 << 20


def units(text: str | None) -> Iterator[list[str]]:
    """Units of a text, in lists of about a million characters; empty and NULL have none."""
    if not text:
        return
    marked, start = SPACE + text.replace(" ", SPACE), 0
    while len(marked) - start > SLICE and (edge := EDGE.search(marked, start + SLICE)):
        yield UNIT.findall(marked, start, edge.start())
        start = edge.start()
    yield UNIT.findall(marked, start)


class Merges:
    """A BPE vocabulary as arrays: symbol of a character, merged piece of a pair, rank of a piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_units(model)
        size = model.get_piece_size()
        reserved = {i for i in range(size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        ids = {model.id_to_piece(i): i for i in range(size) if i not in reserved}
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.unique(-scores, return_inverse=True)[1]
        #: Equal scores share a rank; the last entry answers for "no pair".
        self.rank = np.append(order.astype(np.int64), NONE)
        pairs = {
            (ids[piece[:cut]] << 16) | ids[piece[cut:]]: i
            for piece, i in ids.items()
            for cut in range(1, len(piece))
            if piece[:cut] in ids and piece[cut:] in ids
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs
        # A character without a piece becomes one of four symbols after the vocabulary, by its bytes.
        code = np.arange(0x110000)
        self.symbol = size - 1 + np.select([code < 0x80, code < 0x800, code < 0x10000], [1, 2, 3], 4)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.cost = np.append(np.ones(size, np.int64), [1, 2, 3, 4])

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair makes, -1 for none."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        wanted = (left.astype(np.int64) << 16) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.made[at], -1)

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each unit."""
        out = np.zeros(len(words), np.int64)
        short = [i for i, word in enumerate(words) if len(word) <= LONG_UNIT]
        for start in range(0, len(short), ROUND_UNITS):
            chosen = short[start : start + ROUND_UNITS]
            out[chosen] = self._together([words[i] for i in chosen])
        for i, word in enumerate(words):
            if len(word) > LONG_UNIT:
                out[i] = self._alone(word)
        return out.tolist()

    def _codes(self, joined: str) -> np.ndarray:
        return self.symbol[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _together(self, words: list[str]) -> np.ndarray:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols, owner = self._codes("".join(words)), np.repeat(np.arange(len(words)), sizes)
        out = np.zeros(len(words), np.int64)
        made = np.full(len(symbols), -1, np.int64)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        made[inside] = self.merged(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.append(0, np.flatnonzero(owner[1:] != owner[:-1]) + 1)
            best = np.minimum.reduceat((self.rank[made] << 32) | np.arange(len(made)), starts)
            ended = best >= NONE << 32
            if ended.any():
                out[owner[starts[ended]]] = np.add.reduceat(self.cost[symbols], starts)[ended]
            at = best[~ended] & 0xFFFFFFFF
            stays = np.repeat(~ended, np.diff(np.append(starts, len(symbols))))
            symbols[at] = made[at]
            stays[at + 1] = False
            at = (np.cumsum(stays) - 1)[at]
            symbols, owner, made = symbols[stays], owner[stays], made[stays]
            made[at] = -1
            for left in (at - 1, at):
                left = left[(left >= 0) & (left + 1 < len(symbols))]
                left = left[owner[left] == owner[left + 1]]
                made[left] = self.merged(symbols[left], symbols[left + 1])
        return out

    def _alone(self, word: str) -> int:
        """The same order of merges for one long unit, from a queue over a linked list."""
        symbols = self._codes(word).tolist()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        rank, queue = self.rank, []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(symbols):
                piece = self.pairs.get((symbols[left] << 16) | symbols[right])
                if piece is not None:
                    heapq.heappush(queue, (int(rank[piece]), left, right, symbols[left], symbols[right], piece))

        for i in range(len(symbols) - 1):
            offer(i)
        while queue:
            _, left, right, a, b, piece = heapq.heappop(queue)
            if symbols[left] != a or after[left] != right or symbols[right] != b:
                continue
            symbols[left], symbols[right] = piece, -1
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return int(self.cost[[s for s in symbols if s >= 0]].sum())


def check_units(model) -> None:
    """Raises unless a model's tokens stay within units: no piece has a space mark after another
    character, and texts are taken as they are but for marks instead of spaces."""
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and EDGE.search(piece):
            raise ValueError(f"piece {piece!r} crosses words, so texts cannot be cut before spaces")
    probe = "  ①  ﬁ e\u0301\t\n\u3000A "
    if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model changes characters or spaces of texts before it cuts them")


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts batches of texts; remembers the counts of units."""

    def __init__(self, table: Merges):
        self.table, self.known, self.held = table, {}, 0

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; one call for the new units of texts of about GATHERED characters."""
        out, some, gathered = [], [], 0
        for text in texts:
            if text and len(text) > SLICE:
                # A list of units at a time.
                out += self._counted(some)
                out.append(sum(self._of([words])[0] for words in units(text)))
                some, gathered = [], 0
                continue
            some.append(text)
            gathered += len(text or "")
            if gathered >= GATHERED:
                out += self._counted(some)
                some, gathered = [], 0
        return out + self._counted(some)

    def _counted(self, texts: list[str | None]) -> list[int]:
        return self._of([[word for words in units(text) for word in words] for text in texts])

    def _of(self, lists: list[list[str]]) -> list[int]:
        known = self.known
        new = list(set().union(*lists) - known.keys())
        known.update(zip(new, self.table.counts(new)))
        sums = [sum(map(known.__getitem__, words)) for words in lists]
        for word in new:
            if len(word) > KEPT_LENGTH:
                del known[word]
            else:
                self.held += len(word) + OVERHEAD
        if self.held > KNOWN_CHARACTERS:
            known.clear()
            self.held = 0
        return sums


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges(path))
        for batch in batches:
            tokens = counter.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of `docs`: its id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > `limit`).

    Tokens are those of the BPE SentencePiece file `model` without begin or end marks; the
    strings of special tokens inside a text are ordinary text. A file whose pieces cross words or
    that normalises texts is refused. NULL counts as empty: no bytes,
    no tokens. Repeated rows are counted each, a NULL id stays NULL, columns besides id and
    text are not read (names may clash), and an empty table gives an empty result.
    """
    path = model or public_tokenizers.path(MODEL)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = in_arrow(rows, _counting(path), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
