"""N-gram Jaccard join by MinHash banding with full verification.

Documents with equal n-gram sets form a class, and classes are what is compared: copies never
meet each other. Each class has MinHash bands; bands and rows follow from the threshold and a
target recall. Band hashes are shuffled to find buckets of two classes or more; of buckets with
the same members one is kept. Then the n-gram sets of the classes in such buckets are brought to
their buckets and verified in full there. A large bucket is dealt out as pairs of blocks, so a
task sees a bounded number of sets. Tasks report links per class and the edges of a spanning
forest, never pairs; a pair that meets in several buckets is counted in the lowest band that it
shares. Components of the edges become class ids by star contraction.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import in_arrow, lowered_words, ragged, split_join, stored

WORDS = 5
#: Similarity that links, as a fraction, so that its test is exact.
THRESHOLD = (4, 5)
RECALL = 0.9999
MAX_HASHES, MAX_BANDS = 128, 32
#: Classes of a bucket's block; a task verifies two blocks at once.
BLOCK = 512
SEED = 11
KNOWN_WORDS = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which a pair at the threshold is found with
    probability `recall` within the bound on hashes; more rows mean fewer false candidates."""
    best = (MAX_BANDS, 1)
    for rows in range(1, MAX_HASHES + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands <= MAX_BANDS and bands * rows <= MAX_HASHES:
            best = (bands, rows)
    return best


class WordHashes(dict):
    """64-bit hashes of words, computed once each."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def ngrams(text: str | None, known: WordHashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words; one of all words if there are fewer, none without words."""
    words = lowered_words(text)
    if len(known) > KNOWN_WORDS:
        known.clear()
    code = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    if not width:
        return code
    count = len(words) - width + 1
    value = code[:count].copy()
    for k in range(1, width):
        value = (value ^ (value >> np.uint64(31))) * _MIX + code[k : count + k]
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return np.unique(value ^ (value >> np.uint64(32)))


def band_keys(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key a band, with the band's number in its last five bits."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 2048):
        least = np.minimum(least, np.multiply.outer(factors, grams[start : start + 2048]).min(axis=1))
    value = np.zeros(bands, np.uint64)
    for column in least.reshape(bands, rows).T:
        value = (value ^ (value >> np.uint64(29))) * _MIX + column
    value = (value ^ (value >> np.uint64(32))) * _MIX
    return ((value & ~np.uint64(31)) | np.arange(bands, dtype=np.uint64)).view(np.int64)


def _sketching(bands: int, rows: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            classes, keys, lengths = [], [], []
            for text in batch.column(2).to_pylist():
                grams = ngrams(text, known, n)
                classes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                keys.append(band_keys(grams, bands, rows) if len(grams) else np.zeros(0, np.int64))
                lengths.append(len(keys[-1]))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            lists = ragged(flat, np.array(lengths, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(classes, pa.binary()), lists], ["id", "hash", "cls", "bands"])

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [ngrams(text, known, n).view(np.int64) for text in batch.column(1).to_pylist()]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            lists = ragged(flat, np.array([len(s) for s in sets], np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["cls", "grams"])

    return run


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a of left, b of right, a < b where both are on both sides) at the threshold or above.

    Intersections are counted from an index of the n-grams that two sets or more hold.
    """
    sizes = np.array([len(s) for s in sets])
    over, under = threshold
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = often[code] > 1
    code, owner = code[shared], owner[shared]
    order = np.argsort(code, kind="stable")
    by_code, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(often)))])
    firsts = np.searchsorted(owner, np.arange(len(sets) + 1))
    in_right = np.zeros(len(sets), bool)
    in_right[right] = True
    found_a, found_b = [], []
    for a in left.tolist():
        mine = code[firsts[a] : firsts[a + 1]]
        if not len(mine):
            continue
        begin, length = starts[mine], starts[mine + 1] - starts[mine]
        at = np.arange(length.sum()) + np.repeat(begin - np.cumsum(length) + length, length)
        common = np.bincount(by_code[at], minlength=len(sets))
        hit = in_right & (under * common >= over * (sizes[a] + sizes - common))
        hit[a] = False
        if len(left) == len(sets):
            hit[:a] = False
        b = np.flatnonzero(hit)
        found_a.append(np.full(len(b), a))
        found_b.append(b)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of one (bucket, i, j), which lie together."""
    key, rows = None, []
    for batch in batches:
        plain = [batch.column(i).to_pylist() for i in range(6)]
        lists = []
        for i in (6, 7):
            flat, offsets = batch.column(i).values.to_numpy(), batch.column(i).offsets.to_numpy()
            lists.append([flat[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])])
        for *head, cls, block, copies, keys, grams in zip(*plain, *lists):
            if tuple(head) != key:
                if rows:
                    yield key, rows
                key, rows = tuple(head), []
            rows.append((cls, block, copies, keys, grams))
    if rows:
        yield key, rows


def _verifying(threshold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (bucket, i, j), rows in _groups(batches):
            classes = [r[0] for r in rows]
            block = np.array([r[1] for r in rows])
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            a, b = similar([r[4] for r in rows], left, right, threshold)
            if not len(a):
                continue
            keys = np.zeros((len(rows), MAX_BANDS), np.int64)
            for k, row in enumerate(rows):
                keys[k, row[3] & 31] = row[3]
            root = forest(len(rows), a, b)
            # A kept key is never 0 for two classes by chance: 0 stands for "not kept".
            own = np.concatenate([
                ((keys[a[s : s + 65536]] == keys[b[s : s + 65536]]) & (keys[a[s : s + 65536]] != 0)).argmax(axis=1) == bucket & 31
                for s in range(0, len(a), 65536)
            ])
            copies = np.array([r[2] for r in rows], np.int64)
            links, partners = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for x, y in ((a[own], b[own]), (b[own], a[own])):
                np.add.at(links, x, copies[y])
                np.add.at(partners, x, 1)
            for k in np.unique(np.concatenate([a, b])).tolist():
                out.append((classes[k], int(links[k]), int(partners[k]), classes[root[k]]))
            if len(out) >= 10_000:
                yield _linked(out)
                out = []
        if out:
            yield _linked(out)

    return run


def _linked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["cls", "links", "partners", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the least node of its component, from edges (node, root); only nodes that are not their root.

    Alternates large-star and small-star steps; each round's edges are written, so a round
    starts from files and a lost executor repeats one round at most. A component with a large
    share of all nodes has as many edges at one node: its rows are joined in place (`split_join`)
    and are otherwise only grouped, which combines them before the shuffle.
    """
    edges = stored(edges.where("node <> root").select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).distinct(), "edges")
    while True:
        ends = edges.select("node", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("root").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if not degrees.where("up > 1 OR (up > 0 AND down > 0)").limit(1).count():
            return edges
        both = edges.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(edges.select(F.col("root").alias("a"), F.col("node").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "b").alias("low"), "n"), "low")
        large = split_join(both.where("b > a"), low, ["a"], "n").select(F.col("b").alias("node"), F.col("low").alias("root")).where("node <> root").distinct()
        large = stored(large, "large")
        least = stored(large.groupBy("node").agg(F.min("root").alias("low"), F.count(F.lit(1)).alias("n")), "least")
        small = split_join(large, least, ["node"], "n").select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root")
        edges = stored(small.unionByName(least.select("node", F.col("low").alias("root"))).distinct(), "edges")


def link_documents(
    docs: DataFrame, doc_id: str = "doc_id", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """Per row of `docs`: id, hash (of the text), class_id, n_copies, n_links, n_partners.

    Two documents are linked when the Jaccard similarity of their sets of `words`-word n-grams
    (words of the contamination contract) is `threshold` or more. class_id is the smallest id
    of the documents that links connect, n_copies the documents with the same set (itself
    included), n_links the documents it is linked with, n_partners the different sets among
    these. A text without words, NULL too, links with nothing and is its own class. NULL ids
    are documents like others but no class is named after them unless it has no other id;
    repeated rows are copies; columns besides id and text are not read; an empty table gives an
    empty result. A pair at the threshold is missed with probability 1 - `recall` at most.
    """
    return _links(docs, doc_id, words, threshold, recall, block).drop("root")


def _links(
    docs: DataFrame, doc_id: str = "doc_id", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """`link_documents` with `root`, the least class of a row's component: unlike class_id it is
    unique, whatever the ids. NULL for a text without words."""
    bands, rows = choose_bands(threshold[0] / threshold[1], recall)
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64("text").alias("hash"), "text")
    kind = texts.schema["id"].dataType.simpleString()
    sketch = stored(in_arrow(texts, _sketching(bands, rows, words), f"id {kind}, hash long, cls binary, bands array<long>"), "sketch")
    classes = stored(
        sketch.where("cls IS NOT NULL").groupBy("cls").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "hash")).alias("member"), F.first("bands").alias("bands")
        ), "classes",
    )
    members = classes.select("cls", "copies", F.explode("bands").alias("bucket"))
    own = F.xxhash64("cls")
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(own).alias("s1"), F.bit_xor(F.xxhash64(own, F.lit(1))).alias("s2"))
    kept = buckets.where("m > 1").groupBy("m", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket", "m")
    placed = stored(members.join(kept, "bucket"), "placed")
    candidates = placed.groupBy("cls").agg(F.collect_set("bucket").alias("keys"))
    wanted = candidates.join(classes.select("cls", "member"), "cls").select("cls", F.col("member.id").alias("_id"), F.col("member.hash").alias("_hash"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    chosen = texts.join(wanted, same).groupBy("cls").agg(F.first("text").alias("text"))
    sets = stored(in_arrow(chosen, _sets(words), "cls binary, grams array<long>").join(candidates, "cls"), "sets")
    blocks = F.ceil(F.col("m") / block).cast("int")
    mine = F.pmod(own, blocks).cast("int")
    dealt = (
        placed.withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "block", "copies")
        .join(sets, "cls")
        .select("bucket", "i", "j", "cls", "block", "copies", "keys", "grams")
    )
    ordered = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "cls")
    linked = stored(in_arrow(ordered, _verifying(threshold), "cls binary, links long, partners long, root binary"), "linked")
    roots = components(linked.select(F.col("cls").alias("node"), "root"))
    links = linked.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners"))
    labelled = (
        classes.select("cls", "least", "copies")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .join(links, "cls", "left")
        .select("cls", "least", "copies", F.coalesce("root", "cls").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("partners", F.lit(0)).alias("partners"))
    )
    labelled = stored(labelled, "labelled")
    named = labelled.groupBy("root").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("n"))
    table = stored(split_join(labelled, named, ["root"], "n").select("cls", "class_id", "copies", "links", "partners", "root"), "table")
    worded = split_join(sketch.where("cls IS NOT NULL").select("id", "hash", "cls"), table, ["cls"], "copies")
    with_class = worded.select(
        "id", "hash", "class_id", F.col("copies").alias("n_copies"), (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("partners").alias("n_partners"), "root"
    )
    alone = sketch.where("cls IS NULL").select(
        "id", "hash", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_partners"),
        F.lit(None).cast("binary").alias("root"),
    )
    return with_class.unionByName(alone).withColumnRenamed("id", doc_id)


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` with all their columns, one of each component of linked documents: that of
    the smallest (id, text hash), also where components share their smallest id or have NULL ids only. Documents without words all stay, NULL texts too; of rows that
    repeat id and text and have words, one stays. Other columns may have any name."""
    found = stored(_links(docs, doc_id, **options), "links")
    mark = "_"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"  # names of no column of `docs`
    own, text, stay, known, of = (f"{mark}{name}" for name in ("id", "hash", "stays", "linked", "of"))
    here = F.struct(F.col(doc_id).alias("id"), "hash")
    grouped = found.where("n_links > 0").groupBy("root").agg(F.min(here).alias("stays"))
    stays = grouped.select(F.col("stays.id").alias(own), F.col("stays.hash").alias(text), F.lit(True).alias(stay))
    linked = found.where("n_links > 0").select(F.col(doc_id).alias(own), F.col("hash").alias(text)).distinct()
    chosen = linked.join(stays, linked[own].eqNullSafe(stays[own]) & (linked[text] == stays[text]), "left").select(
        linked[own], linked[text], F.coalesce(stay, F.lit(False)).alias(stay), F.lit(True).alias(known)
    )
    rows = docs.withColumn(of, F.xxhash64("text"))
    judged = rows.join(chosen.hint("merge"), rows[doc_id].eqNullSafe(chosen[own]) & (rows[of] == chosen[text]), "left")
    alone = judged.where(F.col(known).isNull()).select(*docs.columns)
    kept = judged.where(stay).dropDuplicates([own, text]).select(*docs.columns)
    return alone.unionByName(kept)
