"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon is learned from labels. The evidence of a word is its number of distinct contexts
(the words before and after it) in toxic and in clean texts, so thousands of copies of one text
count once. Words and word beginnings whose evidence is far from chance (a likelihood ratio beyond
what the best of as many random words would reach) become entries of a trie. A token is looked up by walking the
intersection of that trie with the Levenshtein automaton of distance one; its states are sets of (trie node,
errors), made when first reached and kept, so most words leave the automaton after a few
characters. Each hit is weighed by its window: quotation marks around it and words that labelled
texts show beside harmless mentions lower it. A text's hits combine by noisy-or and are calibrated
on labelled texts that did not make the lexicon.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterproof.llm.common import in_arrow, stored

#: Labelled texts of each class that the lexicon is learned from, about; all are used below that number.
SAMPLE = 5000
#: Entries kept, strongest evidence first: the size of the model.
LEXICON = 20000
#: A word beginning is an entry of its own when at least so many different words start with it, none of them
#: with half of its evidence and no longer beginning with nine tenths of it.
CONTINUATIONS = 4
PREFIXES = range(4, 13)
THRESHOLD = 0.7
#: Contexts that the prior counts for, per word and per entry.
PRIOR, NEAR_PRIOR = 1.0, 10.0
#: Share of an entry's probability that an unknown misspelling of it starts with.
NEAR = 0.85
#: Shorter words are matched exactly only.
FUZZY_LENGTH = 5
#: Hits below this probability do not count.
HIT = 0.5
WINDOW = 60
#: Logit that quotation marks around a hit cost before labels say otherwise.
QUOTED = -3.0
#: No hit counts as surer than this when windows are compared with their hits.
SURE = 0.9999
#: What one worker keeps: words looked up, and steps of the automaton.
KNOWN_WORDS, KNOWN_STEPS, KNOWN_LENGTH = 200_000, 400_000, 40
_TOKEN = re.compile(r"[^\W_](?:[\w@$!*]*[^\W_])?")
_OPENING, _CLOSING = re.compile("[\"“„«‹‘]|(?<!\\w)'"), re.compile("[\"”“»›’]|'(?!\\w)")
_QUOTE = '"'


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


class Automaton:
    """The trie of `words` intersected with the Levenshtein automaton of distance one."""

    def __init__(self, words: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        for word in words:
            node = 0
            for char in word:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                node = self.children[node][char]
            self.word[node] = word
        self._forget()

    def _forget(self) -> None:
        self.states: list[frozenset[tuple[int, int]]] = [frozenset(), frozenset([(0, 0)])]
        self.numbers = {state: i for i, state in enumerate(self.states)}
        self.steps: dict[tuple[int, str], int] = {}

    def _step(self, state: int, char: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, errors in self.states[state]:
            same = self.children[node].get(char)
            if same is not None:
                after.add((same, errors))
            if errors:
                continue
            after.add((node, 1))  # `char` was inserted
            for child in self.children[node].values():
                if child != same:
                    after.add((child, 1))  # `char` replaces the child's character
                skipped = self.children[child].get(char)
                if skipped is not None:
                    after.add((skipped, 1))  # the child's character was left out
        reached = frozenset(after)
        number = self.numbers.get(reached)
        if number is None:
            number = self.numbers[reached] = len(self.states)
            self.states.append(reached)
        self.steps[state, char] = number
        return number

    def near(self, word: str) -> list[str]:
        """Words of the trie at distance one from `word`, or equal to it, in order."""
        if len(self.steps) > KNOWN_STEPS:
            self._forget()
        state = 1
        for char in word:
            state = self.steps.get((state, char), -1) if (state, char) in self.steps else self._step(state, char)
            if not state:
                return []
        found = set()
        for node, errors in self.states[state]:
            if self.word[node] is not None:
                found.add(self.word[node])
            if not errors:
                found.update(self.word[child] for child in self.children[node].values() if self.word[child] is not None)
        return sorted(found)


@dataclass
class Lexicon:
    """exact: probability per known word; open: per word beginning; near: per entry, of a misspelling of it."""

    exact: dict[str, float]
    open: dict[str, float]
    near: dict[str, float]
    context: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self._ready = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_ready": None}

    def probability(self, word: str) -> float:
        """That of a use of this word being toxic, 0.0 for words the lexicon knows nothing of."""
        if self._ready is None:
            self._ready = Automaton(list(self.near)), {}
        automaton, known = self._ready
        found = known.get(word)
        if found is None:
            found = self.exact.get(word)
            if found is None:
                found = max((self.near[w] for w in automaton.near(word)), default=0.0)
                for size in reversed(PREFIXES):
                    if size < len(word) and word[:size] in self.open:
                        found = max(found, self.open[word[:size]])
                        break
            if len(word) <= KNOWN_LENGTH:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                known[word] = found
        return found

    def hits(self, text: str) -> Iterator[tuple[int, int, float, set[str]]]:
        """Start, end, probability and window of each token that the lexicon takes for toxic.
        Positions are those of the lower-cased text."""
        low = text.lower()
        for token in _TOKEN.finditer(low):
            p = self.probability(token.group())
            if p >= HIT:
                yield token.start(), token.end(), p, window(low, token.start(), token.end())

    def raw(self, text: str | None) -> float:
        """Logit of the noisy-or of a text's hits, each weighed by its window."""
        clean = 0.0
        for _, _, p, around in self.hits(text) if text else ():
            weights = [self.context[mark] for mark in around if mark in self.context]
            # The strongest mark each way decides: words of one window are not independent.
            clean -= np.logaddexp(0.0, _logit(p) + min(0.0, *weights, 0.0) + max(0.0, *weights, 0.0))
        if clean == 0.0:
            return -8.0
        return float(np.clip(np.log(-np.expm1(clean)) - clean, -8.0, 8.0))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.raw(text) + self.shift))))


def window(text: str, start: int, end: int) -> set[str]:
    """Words within WINDOW characters on the same line, and a mark if quotation marks enclose the hit."""
    left = text[max(0, start - WINDOW) : start].rpartition("\n")[2]
    right = text[end : end + WINDOW].partition("\n")[0]
    around = {m.group() for part in (left, right) for m in _TOKEN.finditer(part)}
    if _OPENING.search(left) and _CLOSING.search(right):
        around.add(_QUOTE)
    return around


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, toxic, context) of each text, in bounded pieces."""
    for batch in batches:
        seen: set[tuple[str, bool, int]] = set()
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = ["", *_TOKEN.findall(text.lower()), ""]
            for i in range(1, len(words) - 1):
                if len(words[i]) <= KNOWN_LENGTH:
                    seen.add((words[i], toxic, zlib.crc32(f"{words[i - 1]} {words[i + 1]}".encode("utf-8", "surrogatepass"))))
            if len(seen) > KNOWN_WORDS:
                yield _context_rows(seen)
                seen = set()
        yield _context_rows(seen)


def _context_rows(seen: set[tuple[str, bool, int]]) -> pa.RecordBatch:
    columns = list(zip(*seen)) or [(), (), ()]
    kinds = (pa.string(), pa.bool_(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "toxic", "context"])


def _ratio(a: Column, b: Column, rate: Column | float) -> Column:
    """Likelihood ratio of a toxic and b clean contexts against a rate between 0 and 1."""
    p = a / (a + b)
    return 2 * (F.when(a > 0, a * F.log(p / rate)).otherwise(0.0) + F.when(b > 0, b * F.log((1 - p) / (1 - rate))).otherwise(0.0))


def _sample(fit: DataFrame) -> tuple[DataFrame, float]:
    """About SAMPLE texts of each class, and what a clean one counts for against a toxic one."""
    sizes = {row["toxic"]: row["count"] for row in fit.groupBy("toxic").count().collect()}
    toxic, clean = (min(1.0, SAMPLE / max(1, sizes.get(kind, 0))) for kind in (True, False))
    lot = F.pmod(F.xxhash64(F.lit("lexicon"), "id", "hash"), F.lit(1 << 20))
    return fit.where(lot < F.when(F.col("toxic"), toxic).otherwise(clean) * (1 << 20)), toxic / clean


def _learn_words(chosen: DataFrame, weight: float) -> Lexicon:
    contexts = in_arrow(chosen.select("toxic", "text"), _contexts, "word string, toxic boolean, context long").distinct()
    counted = contexts.groupBy("word").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    words = stored(counted, "words")
    total = words.agg(F.count("*").alias("n"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    if not total["a"] or not total["b"]:
        return Lexicon({}, {}, {})
    rate, known = total["a"] / (total["a"] + total["b"]), total["a"] / (total["a"] + weight * total["b"])
    # Chance alone makes about one of n words reach 2 ln n.
    least = 2 * float(np.log(max(2, total["n"]))) + 2
    starts = (
        words.where(F.length("word") > PREFIXES[0])
        .select(F.explode(F.expr(f"transform(sequence({PREFIXES[0]}, least({PREFIXES[-1]}, length(word) - 1)), n -> left(word, n))")).alias("entry"), "a", "b")
        .groupBy("entry")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count_if(F.col("a") > 0).alias("words"), F.max("a").alias("most"))
        .where(f"words >= {CONTINUATIONS} AND 2 * most <= a")
    )
    longer = starts.groupBy(F.expr("left(entry, length(entry) - 1)").alias("entry")).agg(F.max("a").alias("longer"))
    starts = starts.join(longer, "entry", "left").where("longer IS NULL OR 10 * longer < 9 * a").select("entry", "a", "b", F.lit(True).alias("open"))
    entries = words.select(F.col("word").alias("entry"), "a", "b", F.lit(False).alias("open")).unionByName(starts)
    a, b = F.col("a"), F.col("b")
    strong = entries.where((a > weight * b) & (_ratio(a, b, rate) >= least)).orderBy(_ratio(a, b, rate).desc(), "entry", "open").limit(LEXICON)
    exact, opened = {}, {}
    for row in strong.collect():
        (opened if row["open"] else exact)[row["entry"]] = (row["a"] + PRIOR * known) / (row["a"] + weight * row["b"] + PRIOR)
    fuzzy = {word: p for word, p in exact.items() if len(word) >= FUZZY_LENGTH}
    weighed = words.select("word", "a", (F.col("b") * weight).alias("b"))
    return _decide_known_words(weighed, Lexicon(exact, opened, {w: NEAR * p for w, p in fuzzy.items()}))


def _matching(lexicon: Lexicon):
    """Known words that the lexicon reaches by a beginning or a misspelling, with the entry nearest to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(list(lexicon.near))
        for batch in batches:
            rows = []
            for word, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if word not in lexicon.exact and (p := lexicon.probability(word)) > 0:
                    rows.append((word, a, b, p, automaton.near(word)))
            columns = list(zip(*rows)) or [(), (), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "a", "b", "p", "near"])

    return run


def _decide_known_words(words: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Known words near an entry keep their own evidence, and the entry's misspellings are trusted
    as far as those that were seen turned out toxic."""
    reached = stored(in_arrow(words.select("word", "a", "b"), _matching(lexicon), "word string, a long, b double, p double, near array<string>"), "reached")
    own = reached.select("word", ((F.col("a") + PRIOR * F.col("p")) / (F.col("a") + F.col("b") + PRIOR)).alias("p"), (F.col("a") + F.col("b")).alias("n"))
    exact = dict(lexicon.exact)
    for row in own.orderBy(F.desc("n"), "word").limit(LEXICON).collect():
        exact[row["word"]] = row["p"]
    seen = reached.select(F.explode("near").alias("entry"), (F.col("a") / (F.col("a") + F.col("b"))).alias("toxic"))
    near = dict(lexicon.near)
    for row in seen.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).collect():
        near[row["entry"]] *= (row["toxic"] + NEAR_PRIOR) / (row["n"] + NEAR_PRIOR)
    return Lexicon(exact, lexicon.open, near)


def _windows(lexicon: Lexicon):
    """Marks in the windows of hits, "" for each window itself, each once per window, with the hit's own probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, bool, int], float] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for _, _, p, around in lexicon.hits(text):
                    key = zlib.crc32(" ".join(sorted(around)).encode("utf-8", "surrogatepass"))
                    rows.update(((mark, toxic, key), p) for mark in ("", *around) if len(mark) <= KNOWN_LENGTH)
                    if len(rows) > KNOWN_WORDS:
                        yield _window_rows(rows)
                        rows = {}
            yield _window_rows(rows)

    return run


def _window_rows(rows: dict[tuple[str, bool, int], float]) -> pa.RecordBatch:
    marks = _context_rows(rows)
    return pa.RecordBatch.from_arrays([*marks.columns, pa.array(rows.values(), pa.float64())], ["mark", "toxic", "window", "p"])


def _learn_windows(chosen: DataFrame, weight: float, lexicon: Lexicon) -> dict[str, float]:
    """Logit that a mark in the window adds to a hit's own: how much more or less often the texts
    around it are toxic than the hits beside it say. Only marks that differ from chance, and
    quotation marks, which start at QUOTED."""
    marks = in_arrow(chosen.select("toxic", "text"), _windows(lexicon), "mark string, toxic boolean, window long, p double")
    distinct = marks.groupBy("mark", "toxic", "window").agg(F.max("p").alias("p"))
    counts = stored(
        distinct.groupBy("mark").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"), F.avg("p").alias("p")), "windows"
    )
    least = 2 * float(np.log(max(2, counts.count()))) + 2
    every = counts.where("mark = ''").first()
    if not every:
        return {_QUOTE: QUOTED}
    b = every["b"] * weight
    # How far all hits are from what they say themselves; the calibration takes care of that.
    general = _logit((every["a"] + 1) / (every["a"] + b + 2)) - _logit(min(every["p"], SURE))
    a, b = F.col("a"), F.col("b") * weight
    p = F.least(F.col("p"), F.lit(SURE))
    expected = 1 / (1 + F.exp(-F.log(p / (1 - p)) - general))
    ratio = _ratio(a, b, expected)
    context: dict[str, float] = {}
    marked = counts.withColumn("b", b).withColumn("expected", expected)
    for row in marked.where((F.col("mark") != "") & (F.col("mark") != _QUOTE) & (ratio >= least)).orderBy(ratio.desc(), "mark").limit(LEXICON).collect():
        context[row["mark"]] = _shifted(row["a"], row["b"], row["expected"], 0.0)
    quoted = marked.where(F.col("mark") == _QUOTE).first()
    context[_QUOTE] = _shifted(quoted["a"], quoted["b"], quoted["expected"], QUOTED) if quoted else QUOTED
    return context


def _shifted(a: float, b: float, p: float, prior: float) -> float:
    """Logit between the toxic share of a + b windows and p; NEAR_PRIOR windows say `prior`."""
    share = (a + NEAR_PRIOR / (1 + np.exp(-_logit(p) - prior))) / (a + b + NEAR_PRIOR)
    return _logit(share) - _logit(p)


def _raw_scores(lexicon: Lexicon):
    """Raw scores of the last column's texts; the columns before it pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [lexicon.raw(text) for text in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.float64())], [*batch.schema.names[:-1], "raw"])

    return run


def calibrated(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (raw, toxic, clean) bins, held near (1, 0) by a small penalty."""
    if not bins:
        return 1.0, 0.0
    x, a, b = (np.array(c, np.float64) for c in zip(*bins))
    weights = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(weights[0] * x + weights[1], -30, 30)))
        n, features = a + b, np.column_stack([x, np.ones_like(x)])
        pull = features.T @ (a - n * p) - (weights - [1.0, 0.0])
        step = np.linalg.solve(features.T @ (features * (n * p * (1 - p))[:, None]) + np.eye(2), pull)
        weights = weights + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(0.05, weights[0])), float(weights[1])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> Lexicon | None:
    """A lexicon with window scores and calibration, from labelled documents that are not held out;
    None without any. Several labels of one id count as their mean, NULL labels, ids and texts do not count."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    means = known.groupBy(F.col("doc_id").alias("id")).agg((F.avg(F.col("toxic").cast("double")) >= 0.5).alias("toxic"))
    lot = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    rows = docs.where((lot % 3 != 1) & F.col("text").isNotNull()).select(F.col(doc_id).alias("id"), F.xxhash64("text").alias("hash"), (F.floor(lot / 3) % 4 == 0).alias("aside"), "text")
    labelled = stored(rows.join(means, "id"), "labelled")
    if labelled.isEmpty():
        return None
    chosen, weight = _sample(labelled.where("NOT aside"))
    lexicon = _learn_words(chosen, weight)
    lexicon.context = _learn_windows(chosen, weight, lexicon)
    raw = in_arrow(labelled.where("aside").select("toxic", "text"), _raw_scores(lexicon), "toxic boolean, raw double")
    bins = raw.groupBy((F.round(F.col("raw") * 4) / 4).alias("raw")).agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    lexicon.slope, lexicon.shift = calibrated([tuple(row) for row in bins.orderBy("raw").collect()])
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon | None, doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: its id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    NULL and empty texts hold no hit and get the score of such texts; without a lexicon every score
    is 0.5. A NULL id is not held out. Whole texts are read, whatever their length; repeated rows get equal scores,
    columns besides id and text are not read, and an empty table gives an empty result.
    """
    lot = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(lot % 3 == 1, F.lit(False)).alias("held_out"), "text")
    if lexicon is None:
        scored = rows.select("id", "held_out", F.lit(0.5).alias("score"))
    else:
        kind = rows.schema["id"].dataType.simpleString()
        raw = in_arrow(rows, _raw_scores(lexicon), f"id {kind}, held_out boolean, raw double")
        scored = raw.select("id", "held_out", F.round(1 / (1 + F.exp(-(F.col("raw") * lexicon.slope + lexicon.shift))), 6).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", doc_id)


def toxic_spans(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id") -> DataFrame:
    """Per hit: id, start, end (code points of the lower-cased text), term, probability and whether it is quoted.
    NULL and empty texts and empty tables have no hits; repeated rows give their hits again."""
    rows = docs.select(F.col(doc_id).alias("id"), "text")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for start, end, p, around in lexicon.hits(text or ""):
                    at.append(i)
                    found.append((start, end, (text or "").lower()[start:end], p, _QUOTE in around))
            columns = list(zip(*found)) or [(), (), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_())
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "start", "end", "term", "p", "quoted"])

    found = in_arrow(rows, run, f"id {kind}, start long, end long, term string, p double, quoted boolean")
    return found.withColumnRenamed("id", doc_id)
