"""Filter interactions, shards and vector codes against plain restatements, on planted and on awkward rows."""

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from ordertide.llm import codes, interactions, queries, shards
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, row int, part string, good int, size string, _id int, c0 int, failing string, label int"
CLASH = (1, "p", 1, "s", 1, 1, "f", 1)
LONG = " ".join(f"w{i}" for i in range(30_000))


def documents(seed, n=150):
    """Texts that fail every mixture of filters, with hot copies, nulls and an id in several rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(rng.choice((20, 5000)))}" for _ in range(rng.choice((0, 5, 199, 200, 260)))]
        body = rng.choice((" ", "\n", "\x0b ")).join(words)
        body += rng.choice(("", "", " # x", " ABCDEFGHIJ" * 8, "  é"))
        if rng.random() < 0.35:
            body = "the hot copy of a third of all rows"
        out.append((i, body, rng.choice(("en", "en", "de", None))))
    out += [(n, None, "en"), (n + 1, "", "en"), (n + 2, " \t", ""), (n + 3, LONG, "en"), (3, out[3][1], "en"), (3, out[3][1], "en")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *CLASH) for i, t, lang in rows], DOCS)


LABELS = [(i, i % 2, i % 5 == 0) for i in range(0, 150, 3)] + [(3, 1, False), (3, 0, True), (None, 1, True), (9, None, None)]
LABELS = [(i, q, t if t is None else int(t)) for i, q, t in LABELS]


def audited(spark, docs, labels=LABELS, **given):
    frames = frame(spark, docs).repartition(5), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = interactions.audit(*frames, **given).collect()
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found
    }


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_interactions(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    docs = [*documents(1), (None, "no id", "en"), (None, "no id", "en")]
    assert audited(spark, docs) == brute.interactions(docs, LABELS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_interactions_of_parts_without_failures_and_of_no_documents(spark):
    fine = [(1, " ".join(f"x{i}" for i in range(250)), "fr")]
    found = audited(spark, fine)
    assert len(found) == 600 and set(found.values()) == {(1, 0, 0, 0, 0, 0, 0)}
    assert audited(spark, [(1, "a", "en")], []) == brute.interactions([(1, "a", "en")], [])
    assert interactions.audit(frame(spark, fine).limit(0), spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")).count() == 0


def test_failing_ids_are_one_table_per_filter(spark):
    docs, labels = frame(spark, documents(2)), spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    parts, tables = interactions.failing_ids(docs, labels)
    assert list(tables) == list("ABCDE") and {r.part for r in parts.collect()} == {"en", "de", ""}
    expected = {i for i, t, _ in documents(2) if any(c in "#$%&*|" for c in t or "")}
    assert {r.doc_id for r in tables["D"].collect()} == expected
    alone = interactions.set_counts(tables).where("filter = 'A' AND before = ''")
    assert alone.agg(F.sum("removed")).first()[0] == tables["A"].count()


def test_own_conditions_and_orders(spark):
    docs = [(1, "a b", "en"), (2, "a", "en"), (3, "b", "en")]
    conditions = {"X": F.col("text").contains("a"), "Y": F.size("words") > 1}
    frames = frame(spark, docs), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    parts, tables = interactions.failing_ids(*frames, conditions, "Z")
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant) for r in interactions.interactions(parts, tables, ["XYZ", "YXZ"]).collect()}
    assert found == {("XYZ", 1): (1, 2, 0), ("XYZ", 2): (1, 0, 1), ("XYZ", 3): (1, 0, 0), ("YXZ", 1): (2, 1, 0), ("YXZ", 2): (1, 1, 1), ("YXZ", 3): (1, 0, 0)}


def assigned(df):
    return {r.doc_id: (r.shard, r.slot, r.size, r.text_crc32) for r in df.collect()}


@pytest.mark.parametrize(("count", "bins"), [(16, 16), (16, 1 << 15), (3, 7), (1, 1), (400, 400)])
def test_shards(spark, count, bins):
    docs = [(i, t) for i, t, _ in documents(3)[:-2]]
    df = frame(spark, [(i, t, "en") for i, t in docs]).repartition(4)
    assert assigned(shards.assign(df, count, bins=bins)) == brute.shards(docs, count)


def test_shards_are_the_smallest_that_hold_everything(spark):
    rng = random.Random(5)
    docs = [(i, "".join(rng.choices("abcé", k=rng.choice((1, 3, 50, 900))))) for i in range(300)]
    found = shards.assign(frame(spark, [(i, t, "en") for i, t in docs]), 16, bins=32)
    assert assigned(found) == brute.shards(docs, 16)
    sizes = Counter()
    for r in found.collect():
        sizes[r.shard] += r.size
    largest = max(len(t.encode()) + 1 for _, t in docs)
    assert len(sizes) == 16 and max(sizes.values()) < sum(sizes.values()) / 16 + largest


def test_shards_of_awkward_rows(spark):
    docs = [(7, "same", "en"), (7, "same", "en"), (None, "same", "en"), (None, None, "en"), (5, "", "en"), (6, LONG, "en"), (9, "x", "en")]
    found = shards.assign(frame(spark, docs), 4, columns=("doc_id", "text", "_id", "c0")).collect()
    assert len(found) == len(docs) and {r.c0 for r in found} == {1}
    by_text = {}
    for r in found:
        by_text.setdefault(r.text or "", set()).add(r.shard)
        assert r.text_crc32 == zlib.crc32((r.text or "").encode()) and r.size == len((r.text or "").encode()) + 1
    assert all(len(x) == 1 for x in by_text.values())
    for shard in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert shards.assign(frame(spark, docs).limit(0), 16).count() == 0
    with pytest.raises(ValueError, match="already have size"):
        shards.assign(frame(spark, docs), 16, columns=("size",))


def test_shards_are_written_in_the_order_of_their_slots(spark, tmp_path):
    docs = frame(spark, documents(4)).drop("size")
    stored = shards.write(docs, f"{tmp_path}/out", 4)
    assert set(stored.columns) == {*docs.columns, "size", "text_crc32", "shard", "slot"} and stored.count() == docs.count()
    for file in (tmp_path / "out").glob("shard=*/*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(file)).collect()]
        assert slots == sorted(slots)


def vectors(seed, n=120, width=16):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, width).astype(np.float32)]) for i in rng.permutation(n)]
    rows += [(n, None), (n + 1, [None] * width), (n + 2, [float("nan")] * width), (n + 3, [float("-inf")] * width), (n + 4, rows[0][1]), (n + 5, rows[0][1])]
    return rows


def coded(spark, rows, block=codes.BLOCK, labels=lambda i: i % 3 or None):
    table = [(i, v, None if i is None else labels(i), "x", 1) for i, v in rows]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int, code string, _width int")
    encoded = codes.encode_values(df.repartition(3), block=block)
    books = codes.learn(encoded)
    return codes.assign(encoded, books), books


@pytest.mark.parametrize("block", [codes.BLOCK, 64])
def test_vector_codes(spark, block):
    rows = vectors(1)
    found, books = coded(spark, rows, block)
    expected, digest = brute.vector_codes(rows)
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == sorted(expected) and books.digest == digest
    sums = Counter()
    for i, _, error in expected:
        sums[i % 3 or None] += error
    labelled = codes.with_label_error(found).collect()
    assert len(labelled) == len(expected) and all(r.label_error == sums[r.label] for r in labelled)


def test_codes_decode_to_their_entries(spark):
    found, books = coded(spark, vectors(2))
    for r in codes.decode(found, books).collect():
        own = np.concatenate([books.entries[p, int(r.code[2 * p : 2 * p + 2], 16)] for p in range(8)])
        assert r.decoded == (own / 4096).tolist()


def test_awkward_vectors(spark):
    few = vectors(3, 5)
    found, books = coded(spark, few)
    expected, digest = brute.vector_codes(few)
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == sorted(expected) and books.digest == digest
    twice = [(1, [0.5] * 8), (1, [0.25] * 8), (1, [0.5] * 8), (2, [-1.0] * 8)]
    found, books = coded(spark, twice)
    assert books.entries.shape == (8, 2, 1)
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == sorted(brute.vector_codes(twice)[0])
    unnamed, _ = coded(spark, [(None, [1.0] * 8), (4, [0.0] * 8)])
    assert {(r.vec_id, r.code, r.error) for r in unnamed.collect()} == {(4, "00" * 8, 0), (None, "01" * 8, 0)}
    empty, books = coded(spark, [(1, []), (2, [])])
    assert [(r.code, r.error) for r in empty.collect()] == [("00" * 8, 0)] * 2 and books.entries.size == 0
    none, books = coded(spark, [(1, None)])
    assert codes.with_label_error(none).count() == 0 and books.entries.size == 0
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [0.0] * 9)])
    with pytest.raises(ValueError, match="differing lengths"):
        coded(spark, [(1, [0.0] * 8), (2, [0.0] * 16)])
    with pytest.raises(Exception, match="beyond exact whole numbers"):
        coded(spark, [(1, [1e6] * 8)])


def test_the_new_queries_carry_their_contracts(spark):
    small = "/root/testdata/sf0.001"
    assert set(queries.op11_filter_interactions(spark, small).columns) > {"part", "filter_order", "step", "shapley"}
    assert dict(queries.op12_sharding(spark, small).dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int",
    }
    assert queries.op13_vector_codes(spark, small).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
