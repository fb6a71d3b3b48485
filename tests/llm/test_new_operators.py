"""Spelling variants, the conversation trie and toxicity against brute force and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from meterproof.llm import conversation_trie as ct, spelling_variants as sv, toxicity as tx

CONVERSATION = "conv_id LONG, turn LONG, role STRING, text STRING, k1 STRING, at STRING, h STRING, node STRING"


# Spelling variants


def brute_variants(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    others = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(others[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    found = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        found[w] = (words[w], form[w], words.get(form[w]), len(others[w]), root)
    return found


def variants(df):
    rows = df.collect()
    found = {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in rows}
    assert len(found) == len(rows)
    return found


def made_up_rows():
    pick = random.Random(4)
    stems = ["aabba", "ééàñßx", "schön÷", "banana", "abcdefgh"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            word = list(pick.choice(stems))
            for _ in range(pick.randrange(3)):
                at, kind = pick.randrange(len(word)), pick.randrange(3)
                word[at : at + (kind > 0)] = pick.choice("abéÀZ") if kind < 2 else ""
            words.append("".join(word))
        rows.append((i, " ".join(words)))
    return rows + [(None, "banana BANANA"), (7, None), (8, ""), (9, "z" * 5000 + " " + "日本 banana" * 3), (9, "z" * 5000), (10, "z" * 5000)]


@pytest.mark.parametrize("per_partition", [40, 50_000])
def test_variants_equal_brute_force(spark, monkeypatch, per_partition):
    monkeypatch.setattr(sv, "PER_PARTITION", per_partition)
    rows = made_up_rows()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id LONG, text STRING, word STRING, n STRING")
    found = variants(sv.group_variants(docs))
    assert found == brute_variants(rows)
    assert any(v[1] for v in found.values()) and any(v[3] > 5 for v in found.values()) and "z" * 5000 in found


def test_runs_of_one_letter_are_near_once(spark):
    docs = spark.createDataFrame([(-1, "aaaaa " * 30 + "aaaaaa " * 9 + "aaaaaaa " * 3 + "aaaab " * 3)], "doc_id LONG, text STRING")
    found = variants(sv.group_variants(docs))
    assert found == brute_variants([(-1, "aaaaa " * 30 + "aaaaaa " * 9 + "aaaaaaa " * 3 + "aaaab " * 3)])
    assert found["aaaaaaa"] == (3, "aaaaaa", 9, 1, "aaaaa") and found["aaaaa"][3] == 2


def test_variants_on_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert variants(sv.group_variants(awkward)) == brute_variants(rows)
    assert sv.group_variants(nothing).collect() == []


def test_node_numbers_are_those_of_one_trie(spark):
    pick = random.Random(2)
    words = sorted({"".join(pick.choice("ab") for _ in range(pick.randrange(1, 9))) for _ in range(200)})
    df = spark.createDataFrame([(w,) for w in words], "word STRING")
    for reverse in (False, True):
        of = defaultdict(set)
        for r in sv.number_nodes(df, 7, reverse).collect():
            word = r.word[::-1] if reverse else r.word
            for i, node in enumerate(r.nodes):
                of[node].add(word[: i + 1])
        names = [n for ns in of.values() for n in ns]
        assert all(len(ns) == 1 for ns in of.values()) and len(names) == len(set(names))


# Conversation trie


def brute_trie(rows, rebuild):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    conversations = dict(own)
    if rebuild:
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            conversations[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in conversations.items():
        ends[tuple(v)].append(c)
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
    return sorted(
        (min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), children[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n in members
    )


def nodes(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def talk():
    pick = random.Random(3)
    rows = []
    for c in [*range(60), *range(100, 140), 250, 300, 301]:
        for t in range(pick.randrange(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", pick.choice(["hello", "hi", "é😀", ""])))
    rows += [(5000, t, "user", f"turn {t % 7}") for t in range(400)]
    rows += [(5001, t, "user", f"turn {t % 7}") for t in range(399)]
    return rows + [(302, None, None, None), (302, 0, None, "x"), (303, None, "", ""), (303, 5, "", "x"), (None, 1, "user", "lost")]


@pytest.mark.parametrize("finish,per_task", [(5, 50), (20_000, 200_000)])
def test_trie_equals_brute_force(spark, finish, per_task):
    rows = talk()
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], CONVERSATION)
    assert nodes(ct.rebuilt_trie(df, finish, per_task)) == brute_trie(rows, True)
    assert nodes(ct.conversation_trie(df, finish, per_task)) == brute_trie(rows, False)


def test_trie_of_awkward_conversations(spark):
    df = spark.createDataFrame([], CONVERSATION)
    assert nodes(ct.rebuilt_trie(df)) == nodes(ct.conversation_trie(df)) == []
    # Repeated rows are turns, equal turns have one order, texts may be very long.
    rows = [(1, 0, "user", "same")] * 3 + [(2, 0, "user", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "b"), (4, 0, "user", "x" * 2_000_000)]
    found = nodes(ct.conversation_trie(spark.createDataFrame([(*r, "", "", "", "") for r in rows], CONVERSATION)))
    by_place = {(r[0], r[1]): r for r in found}
    assert by_place[1, 3][3] == 1 and by_place[2, 2][3] == 2 and (3, 1) not in by_place and by_place[4, 1][6] == 0
    assert by_place[2, 0 + 1][6] == 2 and by_place[1, 0][5] == 3


def test_scan_carries_a_conversation_over_partitions(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(300)] + [(2, t, "user", f"t{t}") for t in range(300)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], CONVERSATION)
    turns = ct.ordered_turns(df)
    scanned = ct.scan_turns(turns, "i").collect()
    assert sorted((r.conv_id, r.depth) for r in scanned) == [(c, d) for c in (1, 2) for d in range(1, 301)]
    assert len({(r.k1, r.k2) for r in scanned}) == 300
    keys = {r.depth: (r.k1, r.k2) for r in scanned} | {0: (0, 0)}
    assert all((r.p1, r.p2) == keys[r.depth - 1] for r in scanned)


def test_a_list_is_ranked_in_rounds(spark):
    pick = random.Random(1)
    order = list(range(700))
    pick.shuffle(order)
    rows = [(v, -v, 1 + v % 3, *((order[i + 1], -order[i + 1]) if i + 1 < len(order) else (None, None))) for i, v in enumerate(order)]
    pick.shuffle(rows)
    place, wanted = 0, {}
    for v in order:
        wanted[v] = place
        place += 1 + v % 3
    found = ct.rank_stretches(spark.createDataFrame(rows, "a1 LONG, a2 LONG, len LONG, n1 LONG, n2 LONG"), finish=60)
    assert {r.a1: r.pos for r in found.collect()} == wanted


# Toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_the_automaton_finds_all_words_at_distance_one():
    pick = random.Random(7)
    words = sorted({"".join(pick.choice("abcd") for _ in range(pick.randrange(3, 8))) for _ in range(60)})
    automaton = tx.Automaton(words)
    for _ in range(1500):
        token = "".join(pick.choice("abcde") for _ in range(pick.randrange(0, 9)))
        assert automaton.near(token) == [w for w in words if distance(w, token) <= 1], token


def lexicon(**more):
    return tx.Lexicon({"scoundrel": 0.97, "cad": 0.95}, {"villain": 0.9}, {"scoundrel": 0.85}, **{"context": {'"': -4.0, "definition": -3.0}, **more})


def test_misspelled_and_quoted_hits():
    lex = lexicon()
    found = {text: lex.score(text) for text in ("you scoundrel", "you SCOUNDREL!", "you sc0undrel", "you villainous man", "cads at sea", "", None, "calm prose")}
    assert all(found[t] >= 0.7 for t in list(found)[:4]) and all(found[t] < 0.1 for t in list(found)[4:])
    assert lex.score('he wrote "scoundrel" once') < 0.7 < lex.score('he wrote "prose" once, you scoundrel')
    assert lex.score("definition of scoundrel") < lex.score("you are a scoundrel")
    assert lex.score("scoundrel " * 3 + "prose " * 200_000) > 0.9
    assert tx.window('a "b scoundrel c" d', 5, 14) >= {'"', "b", "c"} and '"' not in tx.window("don't scoundrel won't", 6, 15)


@pytest.fixture(scope="module")
def corpus(spark):
    """Three abusive words, one of them only ever quoted in clean texts; ids NULL, repeated and unlabelled."""
    pick = random.Random(5)
    plain = ["".join(pick.choice("aeioulnrst") for _ in range(pick.randrange(3, 8))) for _ in range(150)]
    docs, labels = [], []
    for i in range(1800):
        words = [pick.choice(plain) for _ in range(30)]
        toxic = i % 6 == 0
        if toxic:
            words[pick.randrange(30)] = pick.choice(["wretchkin", "gormhead", "wretchkim" if i % 18 == 0 else "wretchkin"])
        elif i % 6 == 1:
            words[3:4] = ["they", "quoted", '"gormhead"', "politely"]
        docs.append((i, " ".join(words)))
        if i % 3 != 2:
            labels.append((i, int(toxic)))
    docs += [(None, docs[0][1]), (None, None), (2, docs[2][1]), (-1, "")]
    labels += [(1, None), (None, 1), (0, 1)]
    return (
        spark.createDataFrame([(*d, "x", "y", "z") for d in docs], "doc_id LONG, text STRING, id STRING, hash STRING, raw STRING"),
        spark.createDataFrame([(*x, "q") for x in labels], "doc_id LONG, toxic INT, text STRING"),
    )


def test_toxicity_is_learned_from_labels(corpus):
    docs, labels = corpus
    lex = tx.learn(docs, labels)
    rows = tx.score_toxicity(docs, lex).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.doc_id % 6 == 0, r.predicted == 1) for r in rows if r.held_out and r.doc_id >= 0]
    assert len(held) > 400 and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert [r.predicted for r in rows if r.doc_id is None and r.score > 0.5] == [1]
    spans = tx.toxic_spans(docs, lex).where("doc_id = 1").collect()
    assert [(s.term, s.quoted) for s in spans] == [("gormhead", True)]


def test_toxicity_without_labels_or_rows(corpus, awkward, nothing):
    docs, labels = corpus
    assert tx.learn(docs, labels.limit(0)) is None and tx.learn(nothing, labels) is None
    assert {r.score for r in tx.score_toxicity(awkward, None).collect()} == {0.5}
    assert tx.score_toxicity(nothing, lexicon()).collect() == []
    # Labels of one class only teach no words.
    one = tx.learn(docs, labels.where("toxic = 0"))
    assert one.exact == {} and all(r.predicted == 0 for r in tx.score_toxicity(awkward, one).collect())
    assert tx.score_toxicity(awkward, lexicon()).count() == awkward.count()
    assert tx.toxic_spans(awkward, lexicon()).count() == 0


# SentencePiece: one walk for all new units of a batch


def test_a_batch_of_texts_makes_one_walk(monkeypatch):
    import public_tokenizers
    import sentencepiece
    from meterproof.llm import pieces

    path = public_tokenizers.path(pieces.MODEL)
    vocabulary = pieces.Pieces(sentencepiece.SentencePieceProcessor(model_file=path))
    walks = []
    encode = vocabulary.encode
    monkeypatch.setattr(vocabulary, "encode", lambda words: walks.append(len(words)) or encode(words))
    encoder = pieces.Encoder(vocabulary)
    texts = [f"some words and word{i} again é😀" for i in range(300)] + [None, "", "x" * 5000]
    first = encoder.ids(texts)
    assert len(walks) == 1 and walks[0] < 320
    assert encoder.ids(texts) == first and walks[1:] == [1]  # only the long unit is walked anew
    monkeypatch.setattr(pieces, "KNOWN_CHARACTERS", 3000)
    monkeypatch.setattr(pieces, "GATHERED", 500)
    small = pieces.Encoder(vocabulary)
    assert small.ids(texts) == first and sum(map(len, small.known)) <= 6000
    assert [vocabulary.decode(memoryview(ids).cast("i")) for ids in first] == [t or "" for t in texts]


# Quality rules: every rate rejects by its group's own data


def plain_text(pick, words=60):
    return "\n".join(" ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randrange(3, 7))) for _ in range(10)) for _ in range(words // 10))


def test_each_rate_rejects_beyond_the_base_rules(spark):
    from meterproof.llm import quality_rules as qr

    pick = random.Random(8)
    rows = [(i, plain_text(pick), "en", "a") for i in range(300)]

    def words(text):
        return text.split()

    odd = {}
    odd["symbol_rate"] = " ".join(w + "##" for w in words(plain_text(pick)))
    odd["word_length"] = " ".join(w * 5 for w in words(plain_text(pick)))
    odd["short_words"] = " ".join(w[:1] for w in words(plain_text(pick)))
    odd["stutter_rate"] = " ".join(w for x in words(plain_text(pick)) for w in (x, x))
    many = plain_text(pick, 600).split("\n")
    odd["dup_line_rate"] = "\n".join(many + ["x"] * 90)
    base = words(plain_text(pick, 200))
    odd["repeat_rate"] = " ".join(base + base[:28])
    # Some repeated lines and windows are usual here, but far fewer.
    for i in range(300, 380):
        lines = plain_text(pick, 600).split("\n")
        rows.append((i, "\n".join(lines + ["y"] * (1 + i % 3)) + " " + " ".join(lines[0].split()[:9]), "en", "a"))
    rows += [(1000 + i, text, "en", "a") for i, text in enumerate(odd.values())]
    rows += [(2000 + i, " ".join(w + "##" for w in words(plain_text(pick))), "xx", "b") for i in range(300)]
    found = {r.doc_id: r for r in qr.quality_rules(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING")).collect()}
    assert not any(found[1000 + i].base_failed for i in range(len(odd)))
    assert {name: found[1000 + i].kept for i, name in enumerate(odd)} == dict.fromkeys(odd, False)
    assert sum(found[i].kept for i in range(380)) >= 370
    # Where symbols are the rule they are no fault.
    assert sum(found[2000 + i].kept for i in range(300)) >= 290


def test_small_groups_lean_on_larger_ones(spark):
    from meterproof.llm import quality_rules as qr

    rows = [("en", "a", "stutter_rate", b, 100) for b in range(10)] + [("en", "small", "stutter_rate", 500, 10)]
    rows += [("en", s, r, 40, 10 if s == "small" else 1000) for s in ("a", "small") for r in ("symbol_rate", "word_length")]
    limits = {r.source: r for r in qr.thresholds(spark.createDataFrame(rows, "lang STRING, source STRING, rate STRING, bin LONG, n LONG")).collect()}
    # Own fences 8 + 10 * 2 and 500 + 10 * 1; the larger group's, 9 + 10 * 3, counts as a hundred documents.
    assert limits["a"].stutter_rate_high == (1000 * 28 + 100 * 39) // 1100
    assert limits["small"].stutter_rate_high == (10 * 510 + 100 * 39) // 110
    assert limits["a"].dup_line_rate_high is None and limits["a"].docs == 1000


# Language identification: NULL, repeated and unique ids


@pytest.mark.parametrize("shape", ["unique", "null", "repeated"])
def test_no_language_is_lost_whatever_the_ids(spark, shape):
    from meterproof.llm import language_id as li

    pick = random.Random(6)
    letters = {"aa": "abcde", "mm": "klmno", "zz": "vwxyz"}
    texts = [(lang, " ".join("".join(pick.choice(cs) for _ in range(5)) for _ in range(12))) for lang, cs in letters.items() for _ in range(400)]
    ids = {"unique": lambda i: i, "null": lambda i: None, "repeated": lambda i: i // 6}[shape]
    rows = [(ids(i), text, lang) for i, (lang, text) in enumerate(texts)]
    rows += [rows[0]] * 3000 + [(ids(1), "w" * 300_000, "zz")]  # a hot row and a very long one
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    model = li.train(docs, sample=300)
    assert model.languages == ["aa", "mm", "zz"]
    found = li.identify(docs, model).join(docs.select("doc_id", "lang").distinct(), "doc_id") if shape == "unique" else None
    if found is not None:
        assert found.where("lang = lang_pred").count() >= 0.99 * found.count()
    for lang, cs in letters.items():
        probe = spark.createDataFrame([(i, " ".join(pick.choice(cs) * 3 + pick.choice(cs) for _ in range(8))) for i in range(40)], "doc_id LONG, text STRING")
        assert li.identify(probe, model).where(f"lang_pred = '{lang}'").count() >= 39


# Sharding: groups stay whole below a shard


def test_groups_below_a_shard_stay_whole(spark):
    from meterproof.llm import sharding

    pick = random.Random(12)
    rows = [(i, "".join(pick.choice("abcdef ") for _ in range(pick.randrange(5, 60)))) for i in range(3000)]
    rows += [(10_000 + i, "x") for i in range(1500)] + [(20_000 + i, None) for i in range(200)] + [(30_000 + i, "y" * 900) for i in range(6)]
    rows += [(40_000 + i, "huge text " * 30) for i in range(300)] + [rows[0]] * 5  # one group larger than two shards
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = sharding.shard(docs, shards=8).join(docs.distinct().withColumnRenamed("text", "t"), "doc_id").collect()
    assert len(found) == len(rows)
    total = sum(r.size for r in found)
    shards, parts, sums = defaultdict(set), {}, Counter()
    for r in found:
        shards[r.t].add(r.shard)
        parts[r.t] = r.group_parts
        sums[r.shard] += r.size
    size = Counter()
    for r in found:
        size[r.t] += r.size
    for text, where in shards.items():
        wanted = max(1, -(-size[text] * 8 // total))
        assert parts[text] == wanted and len(where) <= wanted, text
    assert {t for t, where in shards.items() if len(where) > 1} == {"huge text " * 30}
    assert max(sums.values()) <= 1.03 * total / 8 and min(sums.values()) >= 0.97 * total / 8


def test_packing_equals_brute_force():
    import numpy as np
    from meterproof.llm import sharding

    random_ = np.random.default_rng(3)
    demands = random_.integers(1, 1000, (200, 3)).astype(float)
    demands[0] = [900, 5, 40_000]
    shards = 7
    room = [[1.0, 1.0, 1.0] for _ in range(shards)]
    needs = demands / (demands.sum(axis=0) / shards)
    wanted = [None] * len(needs)
    for i in sorted(range(len(needs)), key=lambda i: (-needs[i][0], i)):
        fitting = [k for k in range(shards) if room[k][0] >= needs[i][0] - 1e-12]
        dots = {k: round(sum(w * n * r for w, n, r in zip(sharding.WEIGHTS, needs[i], room[k])), 12) for k in fitting} or {k: room[k][0] for k in range(shards)}
        wanted[i] = min(dots, key=lambda k: (-dots[k], k))
        room[wanted[i]] = [r - n for r, n in zip(room[wanted[i]], needs[i])]
    assert sharding.pack(demands, shards).tolist() == wanted


# N-gram join: one row of each group, whatever the columns are called


def test_survivors_keep_clashing_columns(spark):
    from meterproof.llm import ngram_join

    text = " ".join(f"word{i}" for i in range(40))
    rows = [(i, t, i * 10, f"h{i}", True, "o", "r", "c") for i, t in enumerate([text, text, "other " + text, "alone in the world", None, ""])]
    names = "doc_id LONG, text STRING, _id LONG, _hash STRING, _stays BOOLEAN, __of STRING, root STRING, class_id STRING"
    docs = spark.createDataFrame(rows, names)
    left = ngram_join.one_of_each_group(docs)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == sorted(rows[i] for i in (0, 3, 4, 5))
