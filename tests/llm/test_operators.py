"""The operators against libraries, brute force and round trips, on small awkward inputs."""

import hashlib
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from meterproof.llm import (
    chat_format, decontamination, language_id, line_dedup, ngram_join, pieces, quality_classifier, quality_rules, sharding, token_counts,
)
from meterproof.llm.common import lowered_words, split_join
from tests.llm.conftest import PROSE

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def strange_texts(n=600, seed=3):
    rnd, alphabet = random.Random(seed), "ab c  ▁é\n\t😀½　<s>01x."
    fixed = ["", " ", "  ", "a  b", "      a", "a" * 5000, " " * 40, " " * 3000, "ab" * 2000 + " x", "<s>x</s><unk>", "<0x41>"]
    return fixed + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# 1


def test_token_counts_equal_the_library(spark, awkward, nothing):
    texts = strange_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").unionByName(awkward.select("doc_id", "text"))
    found = Counter(map(tuple, token_counts.token_counts(docs, limit=50).collect()))
    wanted = Counter()
    for doc_id, text in docs.collect():
        n = len(LIBRARY.encode(text or ""))
        wanted[(doc_id, len((text or "").encode()), n, n > 50)] += 1
    assert found == wanted
    assert token_counts.token_counts(nothing).count() == 0


def test_long_units_are_merged_alike_both_ways():
    table, words = token_counts.merges(PATH), ["▁" + "abcabx" * 30, "▁" * 77 + "zz", "▁the", "é" * 9]
    assert table.counts(words) == [table._alone(w) for w in words]


def test_known_units_are_bounded_by_their_characters(monkeypatch):
    for name, value in (("KNOWN_CHARACTERS", 3000), ("GATHERED", 200), ("SLICE", 4000)):
        monkeypatch.setattr(token_counts, name, value)
    texts, counter = [*strange_texts(300), "word " * 3000, None], token_counts.Counter(token_counts.merges(PATH))
    for start in range(0, len(texts), 20):
        some = texts[start : start + 20]
        assert counter.counts(some) == [len(LIBRARY.encode(t or "")) for t in some]
        assert counter.held == sum(len(w) + token_counts.OVERHEAD for w in counter.known) <= 3000
        assert max(map(len, counter.known), default=0) <= token_counts.KEPT_LENGTH


@pytest.mark.parametrize("piece, normal", [("▁of▁the", str), ("▁the", str.lower), ("a", lambda t: " ".join(t.split()))])
def test_models_that_cross_words_or_change_texts_are_refused(piece, normal):
    class Model:
        is_byte = is_control = is_unknown = staticmethod(lambda i: False)
        get_piece_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda i: piece)
        normalize = staticmethod(lambda text: ("▁" + normal(text)).replace(" ", "▁"))

    with pytest.raises(ValueError):
        token_counts.check_units(Model)


# 2


@pytest.mark.parametrize("text", ["", "\\", "###", "####", "a###b#", "</turn>", "\\### User: </turn>\n", "#\\##", "</turn", "<\\/turn>"])
def test_escapes_come_back(text):
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    assert "###" not in escaped and "</turn>" not in escaped
    assert chat_format.role_of(chat_format.label(text or "user")) == (text or "user")


def test_templates_are_folded_and_sandboxed():
    tree = chat_format.folded(chat_format.parse("a{{ 'b' ~ 1 + 2 }}{% if 1 == 2 %}x{% else %}c{% endif %}{{ 'd' | upper }}"))
    assert tree == [("text", "ab3cD")]
    run = chat_format.compiled("{% for m in messages %}{% if not loop.first %}, {% endif %}{{ loop.index0 }}:{{ m['text'] | trim if m.role == 'user' else '-' }}{% if loop.last %}.{% endif %}{% endfor %}")
    assert "".join(t for t, _ in run([{"role": "user", "text": " x "}, {"role": "b", "text": "y"}])) == "0:x, 1:-."
    for bad in ("{{ x.__class__() }}", "{{ f(1) }}", "{% import os %}", "{% for x in y %}", "{{ 1 | exec }}", "{{ 1 +", "{% if %}{% endif %}"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.compiled(bad + ("" if bad.endswith("}") else " }}"))
    with pytest.raises(chat_format.TemplateError):
        chat_format.compiled("{{ 'a' + 1 }}")
    with pytest.raises(chat_format.TemplateError):
        "".join(t for t, _ in chat_format.compiled("{{ messages.x }}")([1]))


def test_chat_round_trip(spark):
    text = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "tool: x", "###" * 5), (1, 3, "assistant", "é" * 70_000), (2, 0, None, None),
        (None, 1, "assistant", "b"), (None, 0, "system", "a"), (3, 5, "user", "same"), (3, 5, "user", "same"),
    ]
    df = spark.createDataFrame([r + ("x",) for r in rows], "conv_id LONG, turn LONG, role STRING, text STRING, part STRING")
    parts = chat_format.format_conversations(df)
    found = {r.conv_id: r for r in chat_format.read_back(parts).collect()}
    by_id = defaultdict(list)
    for conv, turn, role, body in rows:
        by_id[conv].append((turn, role or "", body or ""))
    for conv, turns in by_id.items():
        turns.sort()
        every = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        row = found[conv]
        assert (row.n_turns, row.turns_sha256) == (len(turns), hashlib.sha256(every.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    texts = {r.conv_id: r.formatted for r in parts.where("part = 0").collect()}
    assert texts[2] == "### =: </turn>\n"
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0


# 3


def test_sharding_keeps_its_law(spark, awkward, nothing):
    rnd = random.Random(5)
    texts = ["copy " * 40] * 700 + [" ".join(["w"] * rnd.randint(1, 300)) + str(i) for i in range(1300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    rows = sharding.shard(docs).collect()
    sums, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        sums[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        places[texts[r.doc_id]].add(r.shard)
    assert len(rows) == 2000 and set(sums) == set(range(24))
    assert max(sums.values()) < 1.02 * sum(sums.values()) / 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for t, s in places.items() if t != texts[0]) and len(places[texts[0]]) > 1
    odd = sharding.shard(awkward).collect()
    assert len(odd) == awkward.count() and {r["size"] for r in odd if r.doc_id in (1, 2)} == {8}
    assert sharding.shard(nothing).count() == 0


def test_packing_takes_the_highest_dot_product():
    placed = sharding.pack(np.array([[8.0, 1, 1], [4, 9, 1], [4, 1, 9], [4, 9, 9]]), 2)
    assert placed.tolist() == [0, 1, 1, 0] or len(set(placed.tolist())) == 2


# 4


def test_languages_are_learnt_and_held_out(spark, nothing):
    rnd = random.Random(1)
    stems = {"xx": ["ba", "bo", "lu", "mi"], "yy": ["sch", "ung", "ein", "ver"], "zz": ["éa", "ção", "ñe", "qui"]}
    make = lambda lang: " ".join("".join(rnd.choices(stems[lang], k=rnd.randint(1, 4))) for _ in range(30))
    rows = [(i, make(lang), lang) for i in range(600) for lang in [list(stems)[i % 3]]]
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 --", "zz"), (1003, make("xx"), None), (None, make("yy"), "yy"), (5, make("zz"), "zz")]
    docs = spark.createDataFrame([r + ("c",) for r in rows], "doc_id LONG, text STRING, lang STRING, held_out STRING")
    model = language_id.train(docs)
    found = language_id.identify(docs, model).collect()
    truth = {r[0]: r[2] for r in rows[:600]}
    held = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id != 5]
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in found if r.doc_id in (1000, 1001, 1002))
    assert next(r for r in found if r.doc_id == 1003).lang_pred == "xx" and all(0 <= r.score <= 1 for r in found)
    assert language_id.train(nothing) is None
    assert [r.lang_pred for r in language_id.identify(docs.limit(2), None).collect()] == ["und", "und"]
    assert language_id.identify(nothing, model).count() == 0


def test_features_do_not_depend_on_slices(monkeypatch):
    text = PROSE * 3
    whole = np.sort(np.concatenate(list(language_id.features(text))))
    monkeypatch.setattr(language_id, "SLICE", 17)
    assert (np.sort(np.concatenate(list(language_id.features(text)))) == whole).all()


def test_temperature_repairs_overconfidence():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 4000)
    logits = np.zeros((4000, 2))
    right = rng.random(4000) < 0.75
    logits[np.arange(4000), np.where(right, truth, 1 - truth)] = 10.0
    t = language_id.fit_temperature(logits, truth)
    assert abs(language_id.softmax(np.array([10.0, 0.0]) / t)[0] - 0.75) < 0.03


# 5


def brute_lines(rows):
    """Window rule on (id, text) rows: what is left, and lines removed."""
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    seen, out = set(), {}
    for known, i, text in order:
        lines = text.split("\n")
        inked = [k for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        gone = set()
        for p in range(len(inked) - 2):
            window = tuple(lines[k] for k in inked[p : p + 3])
            gone.update(inked[p : p + 3] if window in seen else ())
            seen.add(window)
        out[(i if known else None, text)] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(inked), len(gone))
    return out


def test_lines_against_brute_force(spark, awkward, nothing):
    rnd = random.Random(9)
    rows = [(i, "\n".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    wanted = brute_lines(rows)
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {i: wanted[(i, t)] for i, t in rows}
    odd = line_dedup.dedup_lines(awkward, keep=("lang", "id"))
    assert odd.count() == awkward.count() and odd.where("doc_id = 1").first().text is None
    assert odd.where("doc_id = 10").first().text == "zero\nend"
    assert odd.where("doc_id = 6").select("text").distinct().count() == 1 and odd.where("n_removed > 0").count() == 1
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_hot_keys_are_joined_whole(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 1).when(F.col("id") < 3500, None).otherwise(F.col("id")).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = split_join(rows, keyed, ["k"], "n")
    assert joined.count() == 5000 and joined.where("k = 1 AND n = 3000").count() == 3000 and joined.where("k IS NULL AND n = 500").count() == 500


# 6


def brute_links(rows):
    sets = {}
    for key, text in rows:
        words = lowered_words(text)
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    links = {key: {o for o in sets if o != key and sets[key] and 5 * len(sets[key] & sets[o]) >= 4 * len(sets[key] | sets[o])} for key in sets}
    classes = {}
    for key in sets:
        reach, todo = {key}, [key]
        while todo:
            for other in links[todo.pop()] - reach:
                reach.add(other)
                todo.append(other)
        classes[key] = min(reach)
    return links, classes, sets


def test_links_against_brute_force(spark, awkward, nothing, monkeypatch):
    rnd = random.Random(4)
    base = [[rnd.choice(PROSE.split()) + str(rnd.randint(0, 99)) for _ in range(80)] for _ in range(6)]
    rows = []
    for i in range(160):
        words = list(base[i % 6])
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(80)] = f"new{rnd.randint(0, 30)}"
        rows.append((i, " ".join(words)))
    rows += [(200, "one two"), (201, "ONE, two!"), (202, ""), (203, "...")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    links, classes, sets = brute_links(rows)
    for block in (512, 7):
        found = {r.doc_id: r for r in ngram_join.link_documents(docs, block=block).collect()}
        assert {k: r.class_id for k, r in found.items()} == classes
        assert {k: r.n_links for k, r in found.items()} == {k: len(v) for k, v in links.items()}
        assert {k: r.n_copies for k, r in found.items()} == {k: max(1, sum(sets[o] == sets[k] for o in sets)) if sets[k] else 1 for k in sets}
    kept = {r.doc_id for r in ngram_join.one_of_each_group(docs).collect()}
    assert kept == set(classes.values())
    odd = ngram_join.link_documents(awkward)
    assert odd.count() == awkward.count()
    assert rows_of(odd.where("doc_id IN (5, 6, 12)"), "class_id", "n_copies") == [(5, 4)] * 4
    assert sorted(ngram_join.one_of_each_group(awkward).columns) == sorted(awkward.columns)
    assert ngram_join.link_documents(nothing).count() == 0


def test_each_component_keeps_one_row_whatever_its_ids(spark):
    near = lambda tag: [" ".join(f"{tag}{w}{i % 9}" for i, w in enumerate(PROSE.split() * 4))] * 2
    near_ids = [(None, t) for t in near("a") + near("b")] + [(5, near("c")[0]), (6, near("c")[0]), (5, near("d")[0]), (7, near("d")[0])]
    kept = ngram_join.one_of_each_group(spark.createDataFrame(near_ids, "doc_id LONG, text STRING")).collect()
    wanted = [(None, near("a")[0]), (None, near("b")[0]), (5, near("c")[0]), (5, near("d")[0])]
    assert sorted(map(tuple, kept), key=repr) == sorted(wanted, key=repr)


def test_components_are_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100)]
    found = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "node LONG, root LONG")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_a_hub_with_most_nodes_is_one_component(spark):
    hub = spark.range(1, 20_001).selectExpr("id AS node", "CAST(20001 AS LONG) AS root")
    found = ngram_join.components(hub.unionByName(spark.createDataFrame([(20001, 20002), (0, 20002), (30001, 30002)], "node LONG, root LONG")))
    roots = found.groupBy("root").count().collect()
    assert sorted(map(tuple, roots)) == [(0, 20002), (30001, 1)]


def test_bands_meet_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands <= ngram_join.MAX_BANDS


# 7


def test_pieces_equal_the_library_as_unigram(spark, awkward, nothing):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    model.ParseFromString(LIBRARY.serialized_model_proto())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:  # scores of -1e9 are beyond what the library's 32-bit sums can tell apart
        piece.score = max(piece.score, -50_000)
    unigram = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    own = pieces.Pieces(unigram)
    for text in strange_texts(400):
        if len(text) < 1000:
            ids = []
            for words in token_counts.units(text):
                known = own.encode(list(set(words)))
                ids += [i for w in words for i in np.frombuffer(known[w], np.int32).tolist()]
            assert ids == unigram.encode(text), text
            assert own.decode(ids) == unigram.decode(ids) == text.replace("▁", " ")
    docs = awkward.withColumn("piece_ids", F.lit("clash"))
    back = pieces.decode(pieces.encode(docs))
    assert rows_of(back, "doc_id", "text") == rows_of(awkward.withColumn("text", F.coalesce("text", F.lit(""))), "doc_id", "text")
    digest = pieces.encode_digest(docs)
    assert digest.where("round_trip").count() == awkward.count() and digest.where("doc_id = 2").first().n_pieces == 0
    assert pieces.encode_digest(nothing).count() == 0


# 8


def brute_hits(text, items, window=13):
    words, hit, found = lowered_words(text), set(), set()
    for name, body in items:
        item = lowered_words(body)
        for p in range(max(1, len(item) - window + 1)) if item else ():
            part = item[p : p + window]
            for s in range(len(words) - len(part) + 1):
                if words[s : s + len(part)] == part:
                    hit.update(range(s, s + len(part)))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_hits_against_brute_force(spark, awkward, nothing):
    rnd = random.Random(8)
    vocabulary = "a b c d e".split()
    prose = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, prose(rnd.randint(13, 25))) for i in range(6)] + [(10, "a b c d"), (11, None), (12, ""), (13, "E! a"), (13, "zz"), (2, prose(14))]
    docs = [(i, f"{prose(rnd.randint(0, 40))} {items[i % 6][1].upper() if i % 2 else ''} {prose(9)}") for i in range(60)]
    docs += [(70, None), (71, ""), (72, "zz"), (3, docs[3][1])]
    table = spark.createDataFrame([d + ("x",) for d in docs], "doc_id LONG, text STRING, items STRING")
    test = spark.createDataFrame(items, "item_id LONG, text STRING")
    for block in (decontamination.BLOCK_BYTES, 60):
        found = decontamination.decontaminate(table, test, block_bytes=block).collect()
        assert len(found) == len(docs)
        text = dict(docs)
        for r in found:
            n, hit, names = brute_hits(text[r.doc_id], items)
            assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(names))
            assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
    assert decontamination.decontaminate(awkward, test.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontaminate(awkward, test).count() == awkward.count()
    assert decontamination.decontaminate(nothing, test).count() == 0


def test_few_lookups_at_once_find_the_same(monkeypatch):
    monkeypatch.setattr(decontamination, "LOOKUPS", 5)
    rnd = random.Random(9)
    prose = lambda n: " ".join(rnd.choices("a b c".split(), k=n))
    items = [(str(i), prose(rnd.randint(1, 30))) for i in range(8)] + [("3", prose(20))]
    texts = [f"{prose(20)} {items[i % 9][1]} {prose(5)}" for i in range(30)] + [None, "", "d"]
    test = decontamination.Items()
    for name, text in sorted(items):
        test.add(name, text)
    rows = pa.RecordBatch.from_arrays([pa.array(range(33), pa.int64()), pa.array(texts), pa.array([0] * 33, pa.int64())], ["id", "text", "hash"])
    index = list(decontamination._indexing(test.numbers, 41)([rows]))
    counts = np.bincount(index[0].column(3)[0].values.to_numpy(), index[0].column(4)[0].values.to_numpy(), len(test.numbers))
    search = decontamination._searching(decontamination.Phrases.of(test, counts, 13, 4), len(counts), 40, 41)
    found = [r for batch in search(index) for r in batch.to_pylist()]
    assert [r["id"] for r in found] == list(range(33))
    for r in found:
        n, hit, names = brute_hits(texts[r["id"]], items)
        assert (r["n_words"], sum(x["end"] - x["start"] for x in r["runs"]), r["items"]) == (n, hit, names)


def test_a_whole_block_of_items_takes_under_500_mb():
    code = """
import random, resource
import numpy as np
from meterproof.llm import decontamination as d
rnd, items, held = random.Random(1), d.Items(), 0
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(100_000)]
while held < d.BLOCK_BYTES:
    text = " ".join(rnd.choices(words, k=200))
    items.add(str(held), text)
    held += len(text)
phrases = d.Phrases.of(items, np.ones(len(items.numbers), np.int64), 13, 4)
kept = sum(x.nbytes for x in vars(phrases).values() if isinstance(x, np.ndarray))
print(len(phrases.starts), kept / held, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    n, times, peak = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert n > 2_000_000 and times < 6 and peak < 500


def test_proximity_needs_all_words_within_the_span():
    a, b = np.array([0, 50, 100]), np.array([9, 61])
    assert decontamination.covering([a, b], 10).tolist() == [9]
    assert decontamination.covering([a, b], 12).tolist() == [9, 61]


# 9


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    return len({i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)})


def test_repeats_against_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        words = rnd.choices("ab" if rnd.random() < 0.5 else "abcdefgh", k=rnd.randint(0, 60))
        words += words[: rnd.randint(0, 20)]
        assert quality_rules.repeated_words(words) == brute_repeats(words)


def test_thresholds_adapt_to_their_group(spark, awkward, nothing):
    rnd = random.Random(6)
    words = [w + x for w in PROSE.split() for x in "abcdefgh"]
    make = lambda marks: " ".join(w + ("#" if rnd.random() < marks else "") for w in rnd.choices(words, k=60))
    rows = [(i, make(0.0), "en", "plain") for i in range(150)] + [(200 + i, make(0.9), "en", "code") for i in range(150)]
    rows += [(500, make(0.9), "en", "plain"), (501, make(0.9), None, "new")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert not kept[500] and all(kept[i] for i in range(150)) and all(kept[200 + i] for i in range(150))
    odd = quality_rules.quality_rules(awkward)
    assert odd.count() == awkward.count()
    assert odd.where("doc_id IN (1, 2, 3)").where("base_failed AND NOT kept AND n_words = 0").count() == 3
    assert quality_rules.quality_rules(nothing).count() == 0


def test_word_length_has_no_upper_end(spark):
    # Languages without spaces: 25 blobs of 90 to 300 or of 40,000 to 40,100 code points a text.
    make = lambda n, i: " ".join(chr(0x4E00 + (i + 31 * k) % 9000) * n for k in range(25))
    rows = [(i, make(90 + 3 * (i % 71), i), "zh", "wide") for i in range(142)] + [(1000, make(10_000, 7), "zh", "wide")]
    rows += [(2000 + i, make(40_000 + i, i), "ja", "long") for i in range(101)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert not kept.pop(1000) and all(kept.values())
    alike = quality_rules.fences(quality_rules.merged(quality_rules.sketches(quality_rules.measures(docs)), ["lang"]), ["lang"])
    low, high = alike.where("lang = 'zh' AND rate = 'word_length'").select("low", "high").first()
    # Of the 143 rates the 15th, 36th, 108th and 129th: 111, 141, 249 and 282 code points in bins of at most 1/512.
    times = quality_rules.RATES["word_length"]
    assert low < 0 and 2820 + times * (2820 - 2490) <= high <= (2820 + times * (2820 - 2490)) * 1.02


def test_sketches_merge_to_the_same_counts(spark):
    docs = spark.createDataFrame([(i, PROSE + " x" * (i % 7), "en" if i % 2 else None, f"s{i % 3}") for i in range(60)], "doc_id LONG, text STRING, lang STRING, source STRING")
    sketch = quality_rules.sketches(quality_rules.measures(docs))
    once = quality_rules.merged(sketch, ["lang"])
    twice = quality_rules.merged(quality_rules.merged(sketch, ["lang", "source"]), ["lang"])
    assert rows_of(once, *once.columns) == rows_of(twice, *once.columns) and once.where("rate = 'symbol_rate'").agg(F.sum("n")).first()[0] == 60


# 10


def test_classifier_on_held_out_rows(spark, awkward, nothing):
    rnd = random.Random(7)
    words = PROSE.split()
    clean = lambda: " ".join(rnd.choices(words, k=80)).capitalize() + "."
    junk = lambda: " ".join(w + rnd.choice(["***", "&&&"]) for w in rnd.choices(words, k=40)) if rnd.random() < 0.5 else " ".join(w.upper() + "!!" for w in rnd.choices(words, k=40))
    docs = spark.createDataFrame([(i, clean() if i % 3 else junk()) for i in range(600)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id LONG, quality INT, toxic INT")
    found = quality_classifier.score_quality(docs, labels).collect()
    assert any(r.held_out for r in found)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in found if r.held_out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    odd = quality_classifier.score_quality(awkward, labels)
    assert odd.count() == awkward.count() and odd.where("score IS NULL").count() == 0
    assert {r.score for r in quality_classifier.score_quality(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.score_quality(nothing, labels).count() == 0


def test_pooling_is_isotonic():
    x, y = quality_classifier.monotone(np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.5]), np.array([1.0, 2, 2, 1, 1, 2]))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and len(x) == 3
