"""The text operators against plain restatements, on planted and on awkward rows."""

import dataclasses
import math
import random

import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from ordertide.llm import bpe, components, decontaminate, hosts, keys, language, lm, near, queries, search, store, substrings, suffixes, text, toxicity
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept int, _id int, node string, n_removed int"
#: Nulls, empty texts, ties, a repeated row, ASCII-only and other white space, a long text.
AWKWARD = [
    (0, "One two three four five six seven eight nine ten eleven."),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "...!?"),
    (5, "ÄÖ über straße\x0bfünf a\x00b"),
    (6, "One two three four five six seven eight nine ten eleven."),
    (6, "One two three four five six seven eight nine ten eleven."),
    (7, "word " * 30_000),
    (8, "x"),
    (9, "\U0001f600 é 日本語 'll don't  \n\n  12345"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 2, "n", 3) for i, t in rows], DOCS)


def made(seed, n=60):
    """Documents of a small vocabulary with exact and near copies and shared passages."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ba", "ce", "dü", "fo", "g", "hu") for b in ("n", "rt", "s", "lé", "m")]
    passage = [rng.choice(words) for _ in range(70)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.2:
            body = docs[rng.randrange(len(docs))][1].split(" ")
            if kind < 0.15 and body:
                for _ in range(max(1, len(body) // 25)):
                    body[rng.randrange(len(body))] = rng.choice(words)
        else:
            body = [rng.choice(words) for _ in range(rng.choice((0, 1, 3, 20, 80, 300)))]
            if kind > 0.7:
                at = rng.randrange(len(body) + 1)
                body[at:at] = passage[rng.randrange(20) :]
        docs.append((i, " ".join(body)))
    return docs


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.fixture(params=["awkward", "made"])
def rows(request):
    return AWKWARD if request.param == "awkward" else made(1)


def test_words_and_hashes():
    data = np.frombuffer("Ab  céAb".encode(), np.uint8)
    found = text.words(data, np.array([0, 7, len(data)]), text.LOWER_TOKENS)
    assert found.rows.tolist() == [0, 2, 3]
    assert int(found.hashes[0]) == text.hash_word(b"ab")
    assert found.hashes[0] == found.hashes[2] != found.hashes[1]


def look_alikes(first, second, n=1024):
    """The alternating-parity sequence and its mirror image: alike under any polynomial modulo 2**64."""
    parity = [bin(i).count("1") & 1 for i in range(n)]
    return [(first, second)[x] for x in parity], [(second, first)[x] for x in parity]


def test_look_alike_words_and_sequences_are_told_apart(spark):
    one, other = ("".join(x) for x in look_alikes("a", "b"))
    before, after = " ".join(f"x{i}" for i in range(30)), " ".join(f"y{i}" for i in range(30))
    rows = [(0, f"{before} {one} {after}"), (1, f"{before} {other} {after}"), (2, other), (3, one), (4, f"q {one}"), (5, f"q {other}")]
    rows += [(6 + i, " ".join(x)) for i, x in enumerate(look_alikes("left", "right"))]
    rows += [(8 + i, f"begin {' '.join(x)} end end end") for i, x in enumerate(look_alikes("l", "r", 2048))]
    docs = frame(spark, rows)
    items = [(1, one)]
    found = by_id(decontaminate.matches(docs, spark.createDataFrame(items, "item_id bigint, text string")), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found == brute.decontaminate(rows, items)
    scored = docs.withColumn("held_out", queries._fold(10) == 0)
    model, rare = lm.learn(scored, ~F.col("held_out"))
    columns = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    found, expected = by_id(lm.score(scored, model, rare, columns=("doc_id", "held_out")), *columns), brute.base_scores(rows)
    for i, own in expected.items():
        assert found[i][:4] == own[:4] and found[i][4] == pytest.approx(own[4])
    assert by_id(queries_digest(substrings.deduplicate(docs)), "n_words", "n_removed", "kept_sha256") == brute.substrings(rows)
    found = suffixes.deduplicate(docs).withColumn("kept_sha256", F.sha2("kept", 256))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffixes(rows)
    assert by_id(near.components_of(docs), "n_shingles", "component_id", "kept") == brute.near(rows)


def queries_digest(found):
    return found.withColumn("kept_sha256", F.sha2("kept", 256))


def test_packed_keys():
    found = np.sort(np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (keys.unpack(keys.pack(found)) == found).all()
    assert (np.diff(keys.shard_bounds(found, 7)) > 0).all()


def test_decontamination(spark, rows, monkeypatch):
    items = [(1, " ".join(rows[0][1].split()[:12])), (2, "one TWO three"), (2, "eight nine"), (3, None), (4, "zzz yyy")]
    items += [(5, made(1)[0][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute.decontaminate(rows, items)
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_id(decontaminate.matches(frame(spark, rows), benchmark), *columns) == expected
    assert by_id(decontaminate.matches(frame(spark, rows), benchmark, item_block=2), *columns) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 30)
    assert by_id(decontaminate.matches(frame(spark, rows), benchmark), *columns) == expected
    monkeypatch.undo()
    docs = frame(spark, rows)
    cleaned = decontaminate.clean(docs, benchmark)
    assert cleaned.columns == docs.columns
    assert {r.doc_id for r in cleaned.collect()} == {i for i, x in expected.items() if not x[4]}


def test_proximity(spark):
    docs = frame(spark, [(0, "a x x b"), (1, "b a"), (2, "a x x x x b"), (3, "a")])
    benchmark = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    found = by_id(decontaminate.matches(docs, benchmark, within=3), "contaminated")
    assert found == {0: (True,), 1: (True,), 2: (False,), 3: (False,)}


def test_decoding_lets_go_of_what_the_worker_encoded(spark, monkeypatch):
    encoded = spark.createDataFrame([(1, 1, b"")], "doc_id long, n_tokens long, ids binary")
    tasks = []
    monkeypatch.setattr(type(encoded), "mapInArrow", lambda df, run, schema: tasks.append(run) or df)
    bpe.decode(encoded)
    monkeypatch.setitem(text.kept, "encoder", object())
    batch = pa.table({"_ids": [b"", None], "doc_id": [1, 2], "n_tokens": [0, 0], "ids": [b"", None]}).to_batches()[0]
    made = list(tasks[0](iter([batch])))
    assert [x for out in made for x in out.column("decoded").to_pylist()] == [b"", b""]
    assert "encoder" not in text.kept


def test_bpe_equals_tiktoken(spark, rows):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read().split(b"\n"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(bpe.decode(bpe.encode(frame(spark, rows))), "n_tokens", "ids", "decoded")
    for doc_id, body in rows:
        ids = reference.encode_ordinary(body or "")
        assert found[doc_id] == (len(ids), np.array(ids, "<u4").tobytes(), (body or "").encode())
    encoder = bpe.Encoder(ranks)
    rng = random.Random(4)
    for _ in range(3000):
        piece = "".join(rng.choice("abéü thing0'-\n") for _ in range(rng.randint(1, 30))).encode()
        assert encoder.encode(piece) == reference._core_bpe.encode_single_piece(piece)


def test_remembered_pre_tokens_stay_bounded_in_two_generations():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        raw = file.read()
    known = bpe.remembered(raw)
    assert bpe.remembered(raw) is known
    list(text.slices(pa.array(["another operator's text"])))
    assert bpe.remembered(raw) is not known
    encoder, small = known.encoder, bpe.Remembered(known.encoder, most=2_000)
    rng = random.Random(3)
    asked = ["".join(rng.choices("abcdeé 0", k=rng.choice((1, 3, 9, 70)))) for _ in range(300)]
    for piece in asked * 2:
        assert np.frombuffer(small[piece], "<u4").tolist() == encoder.encode(piece.encode())
        assert small.size <= 2_000 + bpe.ENTRY_BYTES + 5 * bpe.LONGEST
        assert len(piece) <= bpe.LONGEST or piece not in small
    assert small.older


def test_lm_base_scores(spark, rows):
    docs = frame(spark, rows).withColumn("held_out", queries._fold(10) == 0)
    model, rare = lm.learn(docs, ~F.col("held_out"), bits=1 << 16, heavy=16)
    found = by_id(lm.score(docs, model, rare, columns=("doc_id", "held_out")), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for doc_id, expected in brute.base_scores(rows).items():
        assert found[doc_id][:4] == expected[:4]
        assert found[doc_id][4] == pytest.approx(expected[4], rel=1e-9)
        assert -1e6 < found[doc_id][5] <= 0


@pytest.mark.parametrize(("bits", "blocks"), [(1 << 22, 1), (1 << 16, 4), (1 << 14, 20)])
def test_lm_scores_whatever_the_filter_holds_at_a_time(spark, bits, blocks, monkeypatch):
    """The words alone are more than the two smaller sizes hold."""
    monkeypatch.setattr(lm, "STRETCH", 2000)
    rng = random.Random(11)
    common = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < 0.5 else f"r{rng.randrange(20_000)}" for _ in range(100))) for i in range(200)]
    learned = [x for x in docs if x[0] % 10]
    model, rare = lm.learn(frame(spark, docs), F.col("doc_id") % 10 != 0, bits=bits, heavy=64)
    found = by_id(lm.score(frame(spark, docs), model, rare), "n_tokens", "score")
    for doc_id, expected in brute.pair_scores(docs, learned).items():
        n, score = found[doc_id]
        assert n == 101 and score / n == pytest.approx(expected / n, abs=0.05)
    if blocks == 1:
        assert len(model.blocks) == 1
    else:
        assert len(model.blocks) >= blocks


def test_filter_holds_what_was_put_in():
    rng = np.random.default_rng(5)
    own = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 300, len(own))
    bits = np.zeros(1 << 16, np.uint8)
    for level in range(1, int(lm.levels(counts).max()) + 1):
        for place in lm.Filter.places(own[lm.levels(counts) >= level], level, 1 << 16):
            bits[place] = 1
    found = lm.Filter(np.packbits(bits, bitorder="little"), 1).counts(own)
    assert (found >= lm._MEAN[lm.levels(counts)]).all()
    assert (found == lm._MEAN[lm.levels(counts)]).mean() > 0.9


@pytest.mark.parametrize("hot", [2000, 3])
def test_substrings(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(substrings, "SPEC", dataclasses.replace(substrings.SPEC, hot=hot))
    found = substrings.deduplicate(frame(spark, rows)).withColumn("sha", F.sha2("kept", 256))
    assert by_id(found, "n_words", "n_removed", "sha") == brute.substrings(rows)
    assert found.count() == len(rows)


@pytest.mark.parametrize("hot", [2000, 3])
def test_suffixes(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "SPEC", dataclasses.replace(suffixes.SPEC, hot=hot))
    found = suffixes.deduplicate(frame(spark, rows)).withColumn("sha", F.sha2("kept", 256))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "sha") == brute.suffixes(rows)


def test_a_null_id_comes_last(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, words), (4, words), (None, words)], "doc_id bigint, text string")
    found = sorted((r.doc_id is None, r.n_removed) for r in substrings.deduplicate(docs).collect())
    assert found == [(False, 0), (True, 60), (True, 60)]
    near_found = near.components_of(docs).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in near_found if r.doc_id) == [(False, 4, True)]
    assert len(near_found) == 3


def test_suffix_sort_is_lexicographic_and_survives_collisions():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(0, 340)
    raw = data.tobytes()
    order = suffixes.Suffixes(data, 50).sort(starts)
    windows = [raw[s : s + 50] for s in starts[order]]
    assert windows == sorted(windows)
    blind = suffixes.Suffixes(data, 50, np.zeros(401, np.uint64))
    order, group = blind.groups(starts)
    named = {}
    for s, g in zip(starts[order], group, strict=True):
        assert named.setdefault(int(g), raw[s : s + 50]) == raw[s : s + 50]


def test_matching_statistics():
    rng = random.Random(7)
    parts = [[rng.choice("ab") for _ in range(30)] for _ in range(5)]
    automaton = substrings.Automaton()
    for part in parts:
        automaton.add(part)
    joined = ["".join(p) for p in parts]
    probe = [rng.choice("abc") for _ in range(60)]
    for i, size in enumerate(automaton.matched(probe)):
        tail = "".join(probe[: i + 1])
        assert size == max(n for n in range(i + 2) if any(tail[len(tail) - n :] in p for p in joined))


def _code_length(texts, body):
    counts = [{} for _ in range(4)]
    for x in texts:
        for order in range(4):
            for i in range(order, len(x)):
                own = counts[order].setdefault(x[i - order : i], {})
                own[x[i]] = own.get(x[i], 0) + 1
    bits = 0.0
    for i, symbol in enumerate(body):
        for order in range(min(3, i), -1, -1):
            if own := counts[order].get(body[i - order : i]):
                total, different = sum(own.values()), len(own)
                if symbol in own:
                    bits -= math.log2(own[symbol] / (total + different))
                    break
                bits -= math.log2(different / (total + different))
        else:
            bits += 8
    return bits


def test_code_lengths():
    texts = {"en": [b"the cat sat on the mat"], "de": ["die Katze saß auf der Matte".encode(), b"der Hund"]}
    table = language.Table(language.Model(texts))
    bodies = [b"the hat", "daß".encode(), b"", b"\x00\xff", b"t"]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
    found = table.lengths(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    for row, body in zip(found, bodies, strict=True):
        for k, name in enumerate(table.model.languages):
            assert row[k] == pytest.approx(_code_length(texts[name], body), abs=1e-3)


def test_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = queries.op7_language_id(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.9
    model = language.learn(language.training_sample(docs, F.lit(True), rows=20))
    odd = by_id(language.identify(frame(spark, AWKWARD), model, columns=("doc_id",)), "lang_pred", "score")
    assert [odd[i] for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert all(0 <= x[1] <= 1 for x in odd.values())
    nothing = language.learn(docs.select("lang", "text").limit(0))
    assert set(by_id(language.identify(frame(spark, AWKWARD), nothing, columns=("doc_id",)), "lang_pred").values()) == {("und",)}


def _plain_score(network, body):
    """The network spelled out for one text, word by word."""
    both, _ = toxicity._buckets(np.frombuffer(body.encode(), np.uint8), np.array([0, len(body.encode())]))
    vector = {int(b): network.vectors[i] for i, b in enumerate(network.known, 1)}
    words = [vector.get(int(a), network.vectors[0]) + vector.get(int(b), network.vectors[0]) for a, b in both]
    logit = float(network.bias)
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            responses = [
                sum(float(words[i + j] @ network.filters[k][j][:, f]) for j in range(width)) + float(network.offsets[k][f])
                for i in range(len(words) - width + 1)
            ]
            logit += max(0.0, *responses) * float(network.out[k * toxicity.FILTERS + f]) if responses else 0.0
    return 1 / (1 + math.exp(-(network.slope * logit + network.shift)))


def test_scores_equal_the_network_spelled_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = toxicity.learn(toxicity.sample(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), F.lit(True)))
    texts = [(i, t) for i, t in AWKWARD if t != AWKWARD[8][1]] + [(100 + r.doc_id, r.text) for r in docs.limit(20).collect()]
    found = by_id(toxicity.score(frame(spark, texts), network), "score")
    for i, body in texts:
        assert found[i][0] == pytest.approx(_plain_score(network, body or ""), abs=1e-5)


def test_long_labelled_texts_teach_by_a_piece(spark):
    """No short text is toxic, and no short text is of the second language."""
    long_bad, long_calm = ("vile words here " * 4_000, "calm words there " * 4_000)
    rows = [(i, f"{long_bad} {i}" if i % 2 else f"{long_calm} {i}") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "xx" if i % 2 else "yy") for i, t in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    taught = toxicity.sample(docs, labels, F.lit(True)).collect()
    assert len(taught) == 40 and all(0 < len(r.text.encode()) <= toxicity.SAMPLE_BYTES for r in taught)
    network = toxicity.learn(toxicity.sample(docs, labels, F.lit(True)))
    found = by_id(toxicity.score(docs, network), "score")
    assert min(found[i][0] for i in range(1, 40, 2)) > 0.6 > 0.4 > max(found[i][0] for i in range(0, 40, 2))
    model = language.learn(language.training_sample(docs, F.lit(True)))
    assert model.languages == ["xx", "yy"]
    found = by_id(language.identify(docs, model, columns=("doc_id", "lang")), "lang", "lang_pred")
    assert all(a == b for a, b in found.values())


def test_every_labelled_text_teaches_whole(spark, monkeypatch):
    """A word that only texts beyond any sample and the end of long texts hold is learned."""
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 50)
    rows = [(i, "calm word here " * (9_000 if i % 40 == 0 else 3) + ("vile" if i % 4 == 0 else "mild"), None) for i in range(400)]
    docs = spark.createDataFrame([*rows, (0, None, "xx"), (None, "calm", None)], "doc_id bigint, text string, lang string")
    own = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _, _ in rows] + [(7, None), (None, 1), (999, 1)], "doc_id bigint, toxic int")
    taught = toxicity.labelled(docs, own, F.col("doc_id") >= 0)
    found = {(r._hash, r.label, r.text) for r in taught.collect()}
    assert len(found) == taught.count() == 400 and sum(r[1] for r in found) == 100
    # Of an id in two rows one text counts, whole, null first.
    assert {r[2] for r in found} == {t for i, t, _ in rows if i} | {None}
    network = toxicity.learn(taught)
    every = network.known.tolist()
    both, _ = toxicity._buckets(np.frombuffer(b"vile", np.uint8), np.array([0, 4]))
    assert int(both[0, 0]) in every
    scores = by_id(toxicity.score(docs.where("doc_id > 0"), network), "score")
    assert min(scores[i][0] for i in range(4, 400, 4)) > max(scores[i][0] for i in range(1, 400) if i % 4)
    again = toxicity.learn(taught)
    assert (again.vectors == network.vectors).all() and again.slope == network.slope and again.bias == network.bias


def test_labelled_texts_are_shuffled_once_and_few_others(spark, monkeypatch):
    """Also where the labelled ids are too many for Spark to broadcast them by itself."""
    monkeypatch.setattr(toxicity, "ROW_BITS", 1 << 10)
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 100)
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(5000)] + [(None, "x", None)], "doc_id bigint, text string, lang string")
    own = spark.createDataFrame([(i, i % 2) for i in range(0, 5000, 5)] + [(None, 1), (9999, 1)], "doc_id int, toxic int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        taught = toxicity.labelled(docs, own, F.lit(True))
        plan = taught._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_block") == 1 and "SortMergeJoin" not in plan
        assert sorted((r.label, r.text) for r in taught.collect()) == sorted((i % 2, f"text {i}") for i in range(0, 5000, 5))
        kept = {r.doc_id for r in toxicity._maybe_among(docs, own.where("doc_id < 5000"), 1000).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept >= set(range(0, 5000, 5)) and None not in kept
    assert 1000 < len(kept) < 1000 + 4000 // 8


def test_pieces_are_drawn_from_anywhere_and_bounded(spark):
    texts = spark.createDataFrame([("a" * 10,), ("é" * 5,), ("é" * 6,), ("日本" * 900,), ("x" * 11,), (None,), ("",)], "t string")
    found = [r[0] for r in texts.select(store.piece(F.col("t"), 10)).collect()]
    assert found == ["a" * 10, "é" * 5, "éé", found[3], "xx", None, ""] and found[3] in ("日本", "本日")
    many = spark.range(200).select(F.concat(F.col("id"), F.lit(" " + "".join(chr(0x100 + i) for i in range(1000)))).alias("t"))
    assert len({r[0] for r in many.select(store.piece(F.col("t"), 100)).collect()}) > 100


def test_registered_queries_of_models_fold_and_name_their_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id: r.text or "" for r in docs.collect()}
    toxic = queries.op2_toxicity(spark, SMALL).collect()
    assert {r.doc_id: r.held_out for r in toxic} == {i: brute.fold(i, 3) == 1 for i in ids}
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in toxic)
    tokens = queries.op3_bpe(spark, SMALL).collect()
    assert {r.doc_id: r.decoded_sha256 for r in tokens} == {i: brute.sha(t) for i, t in ids.items()}
    scored = queries.op4_lm_scoring(spark, SMALL).collect()
    expected = brute.base_scores(list(ids.items()))
    for r in scored:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:4]
        assert r.base_score == pytest.approx(expected[r.doc_id][4]) and r.score < 0
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert by_id(queries.op6_suffix_dedup(spark, SMALL), *columns) == brute.suffixes(list(ids.items()))


def test_scoring_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = toxicity.learn(toxicity.sample(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), F.lit(True), rows=20))
    assert toxicity.score(docs.limit(0), network).count() == 0
    model = language.learn(language.training_sample(docs, F.lit(True), rows=5))
    assert language.identify(docs.limit(0), model, columns=("doc_id",)).count() == 0


def test_near(spark, rows, monkeypatch):
    monkeypatch.setattr(near, "OPEN_BLOCK", 2)
    monkeypatch.setattr(near, "MEMBER_BLOCK", 3)
    found = by_id(near.components_of(frame(spark, rows)), "n_shingles", "component_id", "kept")
    assert found == brute.near(rows)


def test_links_that_no_smallest_member_has(spark):
    """A chain: every text is near the next one only."""
    rng = random.Random(9)
    words = [f"t{i}" for i in range(200)]
    docs = []
    for i in range(12):
        docs.append((i, " ".join(words)))
        at = rng.randrange(180)
        words[at : at + 12] = [f"n{i}_{j}" for j in range(12)]
    assert by_id(near.components_of(frame(spark, docs)), "n_shingles", "component_id", "kept") == brute.near(docs)


def test_toxicity(spark):
    rng = random.Random(3)
    calm, bad = [f"calm{i}" for i in range(80)], [f"vile{i}" for i in range(4)]
    rows, labels = [], []
    for i in range(600):
        body = [rng.choice(calm) for _ in range(rng.randint(5, 60))]
        if i % 3 == 0:
            body[rng.randrange(len(body))] = rng.choice(bad)
        rows.append((i, " ".join(body)))
        labels.append((i, int(i % 3 == 0)))
    docs = frame(spark, rows + [(1000, None), (1001, ""), (1002, "calm1 " * 20_000)])
    own = spark.createDataFrame(labels + [(None, 1), (5000, 1), (3, None)], "doc_id bigint, toxic int")
    network = toxicity.learn(toxicity.sample(docs, own, F.col("doc_id") < 400))
    scored = toxicity.score(docs, network, columns=("doc_id", "lang"))
    found = by_id(scored, "score")
    right = [(found[i][0] >= 0.7) == (y == 1) for i, y in labels if i >= 400]
    assert np.mean(right) > 0.97
    assert found[1000] == found[1001] and found[1001][0] < 0.7 and found[1002][0] < 0.7
    assert toxicity.decided(scored, network).where("toxic").count() > 150
    empty = toxicity.learn(toxicity.sample(docs, own.limit(0), F.lit(True)))
    assert {round(r.score, 6) for r in toxicity.score(docs, empty).collect()} == {0.5}


def test_hosts(spark):
    urls = [
        None, "", "nothing", "http://A.Example.org/es/1?q#f", "http://example.org/en/12", "http://example.org/en/2", "http://x.com",
        "http://x.com/de/1", "http://x.com/fr/1#", "ftp://notexample.org/es/", "http://y.com?/fr/", "http://z.net/://a/b", "http://x.com/de/1",
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hosts.judge(pages, queries.RULES).collect()}
    assert found[0] == found[1] == found[2] and found[0][:3] == ("", "", None)
    assert found[3] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[4][2:] == ("example.org/en/1", "block") and found[5][2:] == ("org/", "allow")
    assert found[6][:3] == ("x.com", "", None) and found[7][2] == found[12][2] == "com/de/"
    assert found[9][2:] == ("org/", "allow") and found[10][:3] == ("y.com", "", None)
    assert found[11][:2] == ("z.net", "/://a/b")
    assert hosts.judge(pages.limit(0), queries.RULES).count() == 0


def test_reputation_shrinks_to_the_domain(spark):
    rows = [("a.bad.com", 1)] * 40 + [("b.bad.com", None)] + [("good.com", 0)] * 40 + [("c.good.com", None)]
    rated = {r.host: r for r in hosts.reputation(spark.createDataFrame(rows, "host string, outcome int")).collect()}
    assert rated["a.bad.com"].mean > rated["b.bad.com"].mean > rated["c.good.com"].mean
    assert all(r.bound <= r.mean for r in rated.values())


def test_search(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)]
    rows += [(300, rows[7][1]), (301, None), (302, [float("nan")] * 8), (303, [None] * 8), (304, [float("inf")] * 8), (305, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    expected = brute.top(rows)
    for tile in (4096, 2):
        found = search.top_k(vectors.repartition(5), F.col("vec_id") % 50 == 0, tile=tile)
        assert {tuple(r) for r in found.collect()} == expected
    twice = search.top_k(vectors.union(vectors), F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in twice.collect()} == expected
    mixed = spark.createDataFrame([(0, [1.0]), (1, [2.0, 3.0]), (50, []), (2, [4.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in search.top_k(mixed, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 2, 256 * 1024)]


def test_lists_are_merged_as_a_tree(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(q, rng.randrange(40), rng.randrange(30), part) for q in range(3) for part in range(20) for _ in range(4)]
    lists = spark.createDataFrame(rows, "query_id bigint, vec_id bigint, score bigint, part bigint")
    expected = set()
    for q in range(3):
        scores = {}
        for query, vec_id, score, _ in rows:
            if query == q:
                scores[vec_id] = max(score, scores.get(vec_id, score))
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
        expected |= {(q, i, s, rank) for rank, (i, s) in enumerate(best, 1)}
    for fan_in, rounds in ((64, 1), (5, 2), (2, 5)):
        monkeypatch.setattr(search, "FAN_IN", fan_in)
        found = search.merged(lists, 5, 20)
        assert {(r.query_id, r.vec_id, r.score, r["rank"]) for r in found.collect()} == expected
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression [query_id") == rounds


def test_a_node_of_very_many_links_is_split(spark):
    """A third of the links meet in one node; broadcasts are off, as they are for large tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    links = spark.range(0, 60_000, 1, 8).select((F.col("id") + 10).alias("a"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2000 + 2).alias("b"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("node"))
    same = F.array(*(F.lit(0).cast("bigint") for _ in range(8))).alias("sketch")
    sketches = nodes.groupBy("node").agg(same).hint("rebalance")
    for joined in (components._large_star(links), near._alike(links, sketches)):
        joined.collect()
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_empty_tables(spark):
    docs = frame(spark, AWKWARD).limit(0)
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.matches(docs, benchmark).count() == 0
    assert decontaminate.matches(frame(spark, AWKWARD), benchmark).where("contaminated").count() == 0
    assert bpe.decode(bpe.encode(docs)).count() == 0
    model, rare = lm.learn(docs, F.lit(True))
    assert lm.score(docs, model, rare).count() == 0
    assert lm.score(frame(spark, AWKWARD), model, rare).where("base_score <= 0").count() == len(AWKWARD)
    for operator in (substrings.deduplicate, suffixes.deduplicate, near.components_of):
        assert operator(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert search.top_k(vectors, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = con.sql(queries.oracle_sql()[name])
    columns = sorted(expected.columns)
    found = queries.queries()[name](spark, SMALL)
    assert sorted(found.columns) == columns
    left = sorted(repr(tuple(r)) for r in found.select(*columns).collect())
    assert left == sorted(repr(r) for r in expected.project(", ".join(columns)).fetchall())
    con.close()


def test_pipeline(spark, tmp_path):
    passage = " ".join(f"bench{i}" for i in range(15))
    rows = [*made(2, 40), *((100 + i, t) for i, t in AWKWARD), (200, f"before {passage} after"), (201, "clean words of an ordinary text")]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read().split(b"\n"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    # All texts are labelled "en", long ones teach by a piece.
    lessons = [r.text.encode() for r in language.training_sample(docs, F.lit(True)).collect()]
    left = dict(r for r in rows if any(c.isalpha() for c in r[1] or "") and _code_length(lessons, r[1].encode()) < 8 * len(r[1].encode()))
    left = {i: left[i] for i, x in brute.near(list(left.items())).items() if x[2]}
    cut = {}
    first = brute._first([(i, tuple(brute.TOKEN.findall(t))) for i, t in left.items()], 50)
    for i, body in left.items():
        words = tuple(brute.TOKEN.findall(body))
        gone = brute.removed(words, first, i, 50)
        cut[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g) if any(gone) else body
    dirty = brute.decontaminate(list(cut.items()), [(1, passage)])
    expected = {i: np.array(reference.encode_ordinary(t), "<u4").tobytes() for i, t in cut.items() if not dirty[i][4]}
    assert by_id(corpus_pipeline.run(spark, str(tmp_path)), "ids") == {i: (x,) for i, x in expected.items()}
    assert 200 not in expected and 201 in expected
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0


def test_the_shared_folder(spark):
    assert store.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = store.written(spark.range(3), "numbers")
    assert stored.inputFiles()[0].replace("file://", "").startswith(store.shared_folder(spark))


def test_documents_stay_where_no_language_is_known(spark, tmp_path):
    docs = frame(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string"))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, t in AWKWARD if any(c.isalpha() for c in t or "")}


def test_documents_that_no_language_codes_go(spark, tmp_path):
    lessons = [(i, f"plain words of a plain language number {i}") for i in range(50)]
    docs = frame(spark, [*lessons, (100, "plain words"), (101, "日本語日本語日本語"), (102, "12345 !!")])
    taught = docs.withColumn("lang", F.when(F.col("doc_id") < 100, "en"))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, taught, str(tmp_path)).collect()}
    assert kept == {*range(51), 100} - {50}


def test_workers_give_back_what_a_batch_took(monkeypatch):
    calls = []
    monkeypatch.setattr(text, "release", lambda: calls.append(1))
    column = pa.array(["one two", None, "three"])
    assert [(a, b) for a, b, _, _ in text.slices(column)] == [(0, 3)]
    assert len(calls) == 1
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    assert sum(part.num_rows for part in text.parts(batch, 0)) == 3
    assert len(calls) == 2
