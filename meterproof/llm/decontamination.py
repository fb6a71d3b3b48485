"""Benchmark decontamination over a distributed positional inverted index.

Training documents are indexed in segments, one row each, written to the shared folder: for
every word that some test item has, its sorted positions (differences, 32 bits each), next to
the segment's documents. Positions of neighbouring documents are set apart, so that no match
crosses a border. Corpus counts of the words come from the index; a phrase is looked up from
its rarest word on, intersecting the offset-adjusted lists of the next rarer ones, and a
proximity match needs an item's rarest words within a span. Test items go to the tasks as flat
arrays, in blocks of bounded size; results of several blocks are merged by document.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import each_lowered_word, in_arrow, lowered_words, ragged, stored

WINDOW = 13
#: A proximity match: this many of an item's rarest distinct words within so many words.
NEAR_WORDS, NEAR_SPAN = 4, 40
#: Postings of a segment, and bytes of test items that go to the tasks at once.
SEGMENT = 1 << 20
BLOCK_BYTES = 16 << 20
#: Starts of phrases that are looked up at once, and bits of a place within a segment.
LOOKUPS, PLACE_BITS = 1 << 20, 36


class Items:
    """Test items as word numbers, behind one another in one flat array; `owners` are name numbers."""

    def __init__(self) -> None:
        self.names: dict[str, int] = {}
        self.numbers: dict[bytes, int] = {}
        self.owners, self.sizes, self.words = array("i"), array("i"), array("i")

    def add(self, name: str, text: str | None) -> None:
        numbers, before = self.numbers, len(self.words)
        self.words.extend(numbers.setdefault(w, len(numbers)) for w in each_lowered_word(text))
        if len(self.words) > before:
            self.sizes.append(len(self.words) - before)
            self.owners.append(self.names.setdefault(name, len(self.names)))


def run_numbers(flat: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of `length` entries, the same for equal runs: runs of doubled
    length are numbered by the pairs of numbers of their halves, the last pair overlaps."""
    size, number = 1, flat.astype(np.int64)
    while size < length:
        step = min(size, length - size)
        number = np.unique((number[:-step] << 32) | number[step:], return_inverse=True)[1]
        size += step
    return number


@dataclass
class Phrases:
    """Distinct windows of items: where in `flat` one begins, its length, and the names whose items
    hold it (`holders`, from `bounds` on). `near` are words of each item, from `near_bounds` on."""

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    holders: np.ndarray
    bounds: np.ndarray
    near: np.ndarray
    near_bounds: np.ndarray
    near_owners: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, items: Items, counts: np.ndarray, window: int, near_words: int) -> Phrases:
        flat, sizes, owners = (np.array(x, np.int32) for x in (items.words, items.sizes, items.owners))
        ends = np.cumsum(sizes, dtype=np.int64)
        begins, item = ends - sizes, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        starts, lengths, holders, held = [], [], [], []
        for length in np.unique(np.minimum(sizes, window)).tolist():
            of_length = sizes >= window if length == window else sizes == length
            number = run_numbers(flat, length)
            whole = np.flatnonzero(of_length[item[: len(number)]] & (np.arange(length, len(flat) + 1) <= ends[item[: len(number)]]))
            first, phrase = np.unique(number[whole], return_index=True, return_inverse=True)[1:]
            pairs = np.unique((phrase << 32) | owners[item[whole]])
            starts.append(whole[first].astype(np.int32))
            lengths.append(np.full(len(first), length, np.int32))
            holders.append((pairs & 0xFFFFFFFF).astype(np.int32))
            held.append(np.bincount(pairs >> 32, minlength=len(first)))
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        # An item's words by corpus count, equal counts by spelling; the rarest of each item.
        spelled = np.empty(len(items.numbers), np.int64)
        spelled[[items.numbers[w] for w in sorted(items.numbers)]] = np.arange(len(items.numbers))
        by_rarity = np.lexsort((spelled, counts))
        rarity = np.empty_like(by_rarity)
        rarity[by_rarity] = np.arange(len(by_rarity))
        distinct = np.unique((item.astype(np.int64) << 32) | rarity[flat])
        place = np.arange(len(distinct)) - np.searchsorted(distinct >> 32, distinct >> 32)
        distinct = distinct[place < near_words]
        return cls(
            flat, joined(starts, np.int32), joined(lengths, np.int32), joined(holders, np.int32), np.append(0, np.cumsum(joined(held, np.int64))),
            by_rarity[distinct & 0xFFFFFFFF].astype(np.int32), np.append(0, np.cumsum(np.bincount(distinct >> 32, minlength=len(sizes)))), owners, list(items.names),
        )


@dataclass
class Postings:
    """One segment: keys (word << PLACE_BITS | place) in order, and each word's first key and number of keys."""

    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, counts: np.ndarray, steps: np.ndarray, vocabulary: int) -> Postings:
        ends = np.cumsum(counts)
        total = np.cumsum(steps.astype(np.int64))
        places = total - np.repeat(np.append(0, total[ends[:-1] - 1]) if len(ends) else ends, counts)
        first, count = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        first[words], count[words] = ends - counts, counts
        return cls((np.repeat(words.astype(np.int64), counts) << PLACE_BITS) | places, first, count)

    def places(self, word: int) -> np.ndarray:
        return self.keys[self.first[word] : self.first[word] + self.count[word]] & ((1 << PLACE_BITS) - 1)

    def at(self, words: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each word is at its place."""
        wanted = (words.astype(np.int64) << PLACE_BITS) | places
        return self.keys[np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)] == wanted

    def occurrences(self, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrases, starts) of exact occurrences: offset-adjusted lists, intersected from the
        shortest on, many phrases at a time, at most about LOOKUPS starts at once."""
        seen = np.append(0, np.cumsum(self.count[phrases.flat] > 0))
        possible = np.flatnonzero(seen[phrases.starts + phrases.lengths] - seen[phrases.starts] == phrases.lengths)
        for length in np.unique(phrases.lengths[possible]).tolist():
            alike = possible[phrases.lengths[possible] == length]
            for some in np.array_split(alike, -(-len(alike) * length // LOOKUPS)):
                words = phrases.flat[phrases.starts[some][:, None] + np.arange(length)]
                order = np.argsort(self.count[words], axis=1, kind="stable")
                lead = words[np.arange(len(some)), order[:, 0]]
                for part in slices(self.count[lead]):
                    row = np.repeat(np.arange(part.start, part.stop), self.count[lead[part]])
                    start = (self.keys[spread(self.first[lead[part]], self.count[lead[part]])] & ((1 << PLACE_BITS) - 1)) - order[row, 0]
                    row, start = row[start >= 0], start[start >= 0]
                    for k in range(1, length):
                        hit = self.at(words[row, order[row, k]], start + order[row, k])
                        row, start = row[hit], start[hit]
                    if len(row):
                        yield some[row], start


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each entry, `count` of them, behind one another."""
    return np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)


def slices(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about LOOKUPS each; one larger entry is its own."""
    group = np.cumsum(sizes) // LOOKUPS
    borders = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(sizes)]):
        if b > a:
            yield slice(a, b)


def _indexing(numbers: dict[bytes, int], gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        ids, hashes, sizes, words, places, held, base = [], [], [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            word = np.concatenate(words)
            order = np.argsort(word, kind="stable")
            used, firsts, counts = np.unique(word[order], return_index=True, return_counts=True)
            sorted_places = np.concatenate(places)[order]
            steps = np.diff(sorted_places, prepend=0)
            steps[firsts] = sorted_places[firsts]
            one = lambda values, t: pa.array([values], pa.list_(t))
            return pa.RecordBatch.from_arrays(
                [one(ids, kind), one(hashes, pa.int64()), one(sizes, pa.int64()), one(used, pa.int32()), one(counts, pa.int64()), pa.array([steps.astype("<i4").tobytes()])],
                ["ids", "hashes", "sizes", "words", "counts", "steps"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, text, text_hash in zip(*(c.to_pylist() for c in batch.columns)):
                found = lowered_words(text)
                code = np.array([numbers.get(w, -1) for w in found], np.int32)
                at = np.flatnonzero(code >= 0)
                ids.append(doc_id)
                hashes.append(text_hash)
                sizes.append(len(found))
                words.append(code[at])
                places.append(at + base)
                held += len(at)
                base += len(found) + gap
                if held >= SEGMENT or base >= SEGMENT << 3:
                    yield segment()
                    ids, hashes, sizes, words, places, held, base = [], [], [], [], [], 0, 0
        if ids:
            yield segment()

    return run


def build_index(docs: DataFrame, items: Items, gap: int, doc_id: str = "doc_id") -> DataFrame:
    """The stored index: one row a segment."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col("text").alias("text"), F.xxhash64("text").alias("hash"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"ids array<{kind}>, hashes array<long>, sizes array<long>, words array<int>, counts array<long>, steps binary"
    return stored(in_arrow(rows, _indexing(items.numbers, gap), schema), "index")


def corpus_counts(index: DataFrame, items: Items) -> np.ndarray:
    """Occurrences of each test word in all documents."""
    pairs = index.select(F.explode(F.arrays_zip("words", "counts")).alias("p"))
    counts = np.zeros(len(items.numbers), np.int64)
    for word, n in pairs.groupBy("p.words").agg(F.sum("p.counts")).collect():
        counts[word] = n
    return counts


def covering(lists: list[np.ndarray], span: int) -> np.ndarray:
    """Places that end a stretch of at most `span` words with a place from every list. Places far
    from all of the shortest list's cannot be in one and go first."""
    lists = sorted(lists, key=len)
    rare = lists[0]
    for k in range(1, len(lists)):
        after = np.searchsorted(rare, lists[k])
        below, above = rare[np.maximum(after - 1, 0)], rare[np.minimum(after, len(rare) - 1)]
        lists[k] = lists[k][(np.abs(lists[k] - below) < span) | (np.abs(above - lists[k]) < span)]
        if not len(lists[k]):
            return lists[k]
    places = np.concatenate(lists)
    order = np.argsort(places, kind="stable")
    places, owner = places[order], np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]
    earliest = np.full(len(places), np.iinfo(np.int64).max)
    for k in range(len(lists)):
        latest = np.maximum.accumulate(np.where(owner == k, places, -span - 1))
        earliest = np.minimum(earliest, latest)
    return places[places - earliest < span]


def merged_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that intervals cover; touching ones are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])[: len(starts)]
    return starts[new], reach[np.append(new[1:], True)[: len(new)]]


def _searching(phrases: Phrases, vocabulary: int, near_span: int, gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield search(*(batch.column(i)[row] for i in range(6)))

    def search(ids, hashes, sizes, words, n, steps) -> pa.RecordBatch:
        sizes = sizes.values.to_numpy()
        bases = np.cumsum(np.append(0, sizes[:-1] + gap))
        postings = Postings.of(words.values.to_numpy(), n.values.to_numpy(), np.frombuffer(steps.as_py(), "<i4"), vocabulary)
        of = lambda places: np.searchsorted(bases, places, side="right") - 1
        names, none = len(phrases.names), np.zeros(0, np.int64)
        begun, ended, exact = none, none, none
        for phrase, start in postings.occurrences(phrases):
            begun, ended = merged_runs(np.append(begun, start), np.append(ended, start + phrases.lengths[phrase]))
            pairs = np.unique((of(start) << 32) | phrase)
            doc, phrase = pairs >> 32, pairs & 0xFFFFFFFF
            held = phrases.bounds[phrase + 1] - phrases.bounds[phrase]
            for part in slices(held):
                owners = phrases.holders[spread(phrases.bounds[phrase[part]], held[part])]
                exact = np.union1d(exact, np.repeat(doc[part], held[part]) * names + owners)
        near = [none]
        here = np.append(0, np.cumsum(postings.count[phrases.near] > 0))
        whole = here[phrases.near_bounds[1:]] - here[phrases.near_bounds[:-1]] == np.diff(phrases.near_bounds)
        for item in np.flatnonzero(whole).tolist():
            chosen = phrases.near[phrases.near_bounds[item] : phrases.near_bounds[item + 1]]
            near.append(np.unique(of(covering([postings.places(w) for w in chosen.tolist()], near_span))) * names + phrases.near_owners[item])

        def lists(found: np.ndarray) -> pa.ListArray:
            called = np.array(phrases.names, object)[found % names].tolist() if len(found) else []
            return ragged(called, np.bincount(found // max(names, 1), minlength=len(sizes)), pa.string())

        doc = of(begun)
        runs = pa.StructArray.from_arrays([pa.array(begun - bases[doc], pa.int64()), pa.array(ended - bases[doc], pa.int64())], ["start", "end"])
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=len(sizes)))), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                ids.values, hashes.values, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, runs),
                lists(exact), lists(np.unique(np.concatenate(near))),
            ],
            ["id", "hash", "n_words", "runs", "items", "near_items"],
        )

    return run


_FOUND = "hash long, n_words long, runs array<struct<start:long,end:long>>, items array<string>, near_items array<string>"


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = []
        for blocks in batch.column(3).to_pylist():
            runs: list[dict] = []
            for run in sorted((r for block in blocks for r in block), key=lambda r: r["start"]):
                if runs and run["start"] <= runs[-1]["end"]:
                    runs[-1]["end"] = max(runs[-1]["end"], run["end"])
                else:
                    runs.append(run)
            merged.append(runs)
        columns = list(batch.columns)
        columns[3] = pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def find_matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", window: int = WINDOW, near_words: int = NEAR_WORDS,
    near_span: int = NEAR_SPAN, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of `docs`: id, hash (of the text), n_words, runs of hit words, items, near_items.

    An item's windows are its runs of `window` words (one of all its words if it has fewer);
    `runs` are the words inside an occurrence of any window, `items` the items that have one.
    NULL texts have no words, items without words match nothing, several items of one name
    count as one, and a NULL name reads "null".
    """
    gap = max(window, near_span) + 1
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text").where(F.col("text").isNotNull())
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    found = []
    for block in range(blocks):
        part = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block) if blocks > 1 else named
        test = Items()
        for name, text in part.orderBy("name", "text").toLocalIterator():
            test.add(name, text)
        index = build_index(docs, test, gap, doc_id)
        counts = corpus_counts(index, test)
        kind = index.schema["ids"].dataType.elementType.simpleString()
        search = _searching(Phrases.of(test, counts, window, near_words), len(counts), near_span, gap)
        found.append(in_arrow(index, search, f"id {kind}, {_FOUND}"))
    if blocks == 1:
        return found[0]
    kept = [stored(f, "found") for f in found]
    every = reduce(DataFrame.unionByName, [f.dropDuplicates(["id", "hash"]) for f in kept])
    merged = every.groupBy("id", "hash").agg(
        F.max("n_words").alias("n_words"), F.collect_list("runs").alias("runs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
    )
    merged = in_arrow(merged, _merging, f"id {every.schema['id'].dataType.simpleString()}, {_FOUND}")
    rows = kept[0].select(F.col("id").alias("_id"), F.col("hash").alias("_hash"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return rows.join(merged, same).drop("_id", "_hash")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per row of `docs`: its id, hash (of the text), n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    Contaminated: some word is hit, and hit words are a twentieth of all words or more. Without
    items nothing is hit; repeated rows get equal answers; columns besides id and text are not
    read, so their names may clash; an empty table gives an empty result.
    """
    hits = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    found = find_matches(docs, items, doc_id, **options).select("id", "hash", "n_words", hits.alias("n_hit"), "items", "near_items")
    return found.select(
        F.col("id").alias(doc_id), "hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )
