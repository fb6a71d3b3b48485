"""Spelling variants: a dictionary of trie-node pairs.

Distinct words are sorted twice, forwards and reversed, over range partitions. Each sort numbers
the nodes of a trie: a word adds one node per character beyond what it shares with the word
before it, and a border between partitions hands on the numbers of the nodes that go across it.
Cutting a word at position i gives a prefix node and a suffix node. Two words differ by one
replaced character exactly if skipping a position gives both the same pair of nodes; a word is
another with one character inserted exactly if its skipped pair is the other's pair around a gap.
No text is compared: equal node numbers mean equal prefixes and suffixes. A pair of nodes holds
at most one word per character of the alphabet, so its group is bounded by that alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import LOWER_ASCII, in_arrow, ragged, stored

# The contract's run of letters, on Latin-1 bytes with A-Z lowered, and its divisor.
RUN = re.compile(rb"[a-z\xC0-\xFF]+")
DIVISOR = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: A form occurs at least so many times as often as the word.
DOMINANCE = 2
#: Words that a task counts before it hands them on.
COUNTED = 50_000
#: About how many words a range partition holds.
PER_PARTITION = 50_000


def runs(doc_id: object, text: str | None) -> Iterator[tuple[bytes, int]]:
    """Words of one text as Latin-1 bytes with their counts: letter runs, one character of every run whose hash is divisible left out."""
    if not text:
        return
    start = zlib.crc32(b":", zlib.crc32(b"" if doc_id is None else str(doc_id).encode()))
    # Characters beyond Latin-1 end a run, as the question marks that replace them do.
    for run, n in Counter(RUN.findall(text.encode("latin-1", "replace").translate(LOWER_ASCII))).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DIVISOR == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        yield run, n


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        words = [word.decode("latin-1") for word in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    counts: Counter[bytes] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in runs(doc_id, text):
                if len(word) >= MIN_LENGTH:
                    counts[word] += n
            if len(counts) > COUNTED:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


def count_words(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """word, n: words of MIN_LENGTH characters that occur MIN_COUNT times in all texts. NULL texts have none,
    a NULL id counts as an empty one, repeated rows count each time."""
    counted = in_arrow(docs.select(doc_id, "text"), _counting, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def shared_length(a: str, b: str) -> int:
    """Number of characters that two strings begin with in common."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    low, high = 0, least
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def _numbering(reverse: bool, word_at: int):
    """Adds, to sorted rows, the partition and the number, within it, of each prefix's node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, nodes, count = "", np.zeros(0, np.int64), 0
        for batch in batches:
            lists = []
            for word in batch.column(word_at).to_pylist():
                word = word[::-1] if reverse else word
                shared = shared_length(before, word)
                nodes = np.concatenate([nodes[:shared], np.arange(count, count + len(word) - shared)])
                count += len(word) - shared
                before = word
                lists.append(nodes)
            if lists:
                flat = ragged(np.concatenate(lists), np.array([len(x) for x in lists]), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "nodes"])

    return run


def number_nodes(words: DataFrame, partitions: int, reverse: bool = False) -> DataFrame:
    """Adds `nodes`, the trie-node number of each prefix of `word` (of each suffix, shortest first, if `reverse`),
    and `at`, which orders the rows as their words (reversed words) are ordered.

    What passes through the driver is the first and last word of each range partition.
    """
    key = F.reverse("word") if reverse else F.col("word")
    ordered = words.repartitionByRange(partitions, key).sortWithinPartitions(key)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    local = in_arrow(ordered, _numbering(reverse, words.columns.index("word")), f"{schema}, nodes array<long>")
    rows = stored(local.withColumn("at", F.monotonically_increasing_id()), "nodes")
    part = F.shiftright("at", 33)
    edges = rows.groupBy(part.alias("part")).agg(
        F.min_by("word", "at").alias("first"), F.max_by("word", "at").alias("last"), F.max_by("nodes", "at").alias("nodes"),
        F.max(F.array_max("nodes")).alias("most"),
    )
    offset, before, carried, table = 0, "", [], []
    for edge in edges.orderBy("part").collect():
        first, last = (w[::-1] if reverse else w for w in (edge["first"], edge["last"]))
        border = carried[: shared_length(before, first)]
        table.append((edge["part"], offset, border))
        carried = [border[n] if n < len(border) else offset + n for n in edge["nodes"]]
        before, offset = last, offset + edge["most"] + 1
    # One row a partition, with one number per character of its first word at most.
    borders = F.broadcast(words.sparkSession.createDataFrame(table, "part long, offset long, border array<long>"))
    return rows.join(borders, part == F.col("part")).select(
        *words.columns, "at", F.expr("transform(nodes, n -> if(n < size(border), border[int(n)], offset + n))").alias("nodes")
    )


def near_counts(words: DataFrame) -> DataFrame:
    """Per word that has one: id, n_near (words at distance one), best (the most frequent of them, smallest first: its -n and id).

    `words` has id (in the order of the words), n, starts (per position, whether its character
    differs from the one before it), prefix and suffix (trie-node numbers).
    """
    # The pair around position i: the nodes before and after it; -1 is the root of either trie.
    before = "if(i = 0, -1L, prefix[i - 1])"
    skipped = f"transform(sequence(0, size(prefix) - 1), i -> struct({before} AS p, if(i = size(prefix) - 1, -1L, suffix[size(prefix) - i - 2]) AS s, starts[i] AS start))"
    gaps = f"transform(sequence(0, size(prefix)), i -> struct({before} AS p, if(i = size(prefix), -1L, suffix[size(prefix) - i - 1]) AS s, CAST(NULL AS boolean) AS start))"
    pairs = words.select("id", "n", F.explode(F.expr(f"concat({skipped}, {gaps})")).alias("pair")).select("pair.p", "pair.s", "pair.start", "id", "n")
    member = F.struct((-F.col("n")).alias("n"), "id", "start")
    groups = pairs.groupBy("p", "s").agg(
        # At most one word per character of the alphabet skips to the same pair, and one at most is the pair itself.
        F.collect_list(F.when(F.col("start").isNotNull(), member)).alias("skips"),
        F.max(F.when(F.col("start").isNull(), F.struct((-F.col("n")).alias("n"), "id"))).alias("whole"),
        F.count_if("start").alias("starts"),
    )
    several = groups.where("size(skips) > 1 OR (whole IS NOT NULL AND starts > 0)")
    # A character of a run can be left out at any of its positions, always giving the same word: the first one counts.
    best = "array_min(transform(filter(skips, o -> o.id <> m.id), o -> struct(o.n AS n, o.id AS id)))"
    replaced = f"struct(m.id AS id, size(skips) - 1 + if(m.start AND whole IS NOT NULL, 1, 0) AS n_near, least({best}, if(m.start, whole, NULL)) AS best)"
    longer = "struct(whole.id AS id, int(starts) AS n_near, array_min(transform(filter(skips, o -> o.start), o -> struct(o.n AS n, o.id AS id))) AS best)"
    found = several.select(
        F.explode(F.expr(f"concat(transform(skips, m -> {replaced}), filter(array(if(whole IS NOT NULL AND starts > 0, {longer}, NULL)), x -> x IS NOT NULL))")).alias("x")
    ).select("x.id", "x.n_near", "x.best")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best")).where("n_near > 0")


def roots(forms: DataFrame) -> DataFrame:
    """Last element (root) of the chain that starts at each `id` of `forms` (id, form): pointers double until none moves.

    A form occurs at least DOMINANCE times as often as its word, so chains are no longer than the
    logarithm of the largest count and a few rounds do.
    """
    pointers = stored(forms.select("id", F.col("form").alias("root")), "pointers")
    while True:
        ahead = pointers.select(F.col("id").alias("root"), F.col("root").alias("next"))
        # By shuffle at every size; the words that point to one form are split by AQE where they are many.
        moved = stored(pointers.join(ahead.hint("merge"), "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "pointers")
        pointers = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return pointers


def group_variants(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per word: word, n, form, form_n, n_near and root.

    A form is the near word (one character inserted, deleted or replaced) of largest n, the smallest
    of equals in code-point order, if its n is at least DOMINANCE times the word's; root follows forms to the
    last. NULL and empty texts hold no words, texts are read whole whatever their length, repeated
    rows count each time, columns besides id and text are not read, and an empty table gives an
    empty result.
    """
    counted = stored(count_words(docs, doc_id), "words")
    partitions = 1 + counted.count() // PER_PARTITION
    forward = number_nodes(counted, partitions).select("word", "n", F.col("at").alias("id"), F.col("nodes").alias("prefix"))
    both = number_nodes(forward, partitions, reverse=True).withColumnRenamed("nodes", "suffix").drop("at")
    starts = F.expr("transform(sequence(1, length(word)), i -> i = 1 OR substr(word, i, 1) <> substr(word, i - 1, 1))")
    words = stored(both.withColumn("starts", starts), "numbered")
    near = stored(near_counts(words.select("id", "n", "starts", "prefix", "suffix")), "near")
    names = words.select("id", "word", "n")
    linked = names.select("id", "n").join(near, "id").select(
        "id", "n_near", F.when(-F.col("best.n") >= DOMINANCE * F.col("n"), F.struct(F.col("best.id").alias("id"), (-F.col("best.n")).alias("n"))).alias("form")
    )
    linked = stored(linked, "linked")
    chains = roots(linked.where("form IS NOT NULL").select("id", F.col("form.id").alias("form")))
    facts = linked.select("id", "n_near", F.col("form.id").alias("form_id"), F.col("form.n").alias("form_n")).join(chains, "id", "left")
    form_names = names.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root_names = names.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    facts = facts.join(form_names, "form_id", "left").join(root_names, "root", "left").select("id", "n_near", "form", "form_n", "root_word")
    return names.join(facts, "id", "left").select(
        "word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("root_word", "word").alias("root")
    )
