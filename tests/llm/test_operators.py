"""Each operator over nulls, empty and very long texts, ties, repeated rows, extra columns
with names that clash, and empty tables, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from decreta.llm import chat, langid, packing, pieces, quality, secrets, simhash, substring, token_files, vectors

from .conftest import SCHEMA, edge_rows, words

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def components_of(n, linked):
    label = list(range(n))
    for _ in range(n):
        new = [min(label[j] for j in range(n) if i == j or linked(i, j)) for i in range(n)]
        if new == label:
            return label
        label = new
    return label


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    rows = [(i, v.tolist(), i % 3, "x") for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 5] + rng.normal(size=8) * 0.02 * (1 + i % 4)).tolist(), i % 5 % 3, "x") for i in range(60)]
    rows += [(200, rows[0][1], 0, "x"), (200, rows[0][1], 0, "x"), (201, [2 * x for x in rows[0][1]], 0, "x"), (None, rows[0][1], 0, "x"), (202, rows[0][1], None, "x"),
             (203, None, 0, "x"), (204, [0.0] * 8, 0, "x"), (205, [None] + [1.0] * 7, 0, "x"), (206, [float("nan")] + [1.0] * 7, 0, "x"),
             (207, [float("inf")] + [1.0] * 7, 0, "x"), (208, [], 0, "x"), (209, rows[0][1][:4], 0, "x"), (210, [1e300] * 8, 0, "x"), (211, [1e-300] * 8, 0, "x"), (212, [-0.0, 1.0] + [0.0] * 6, 1, "x"), (213, [0.0, 1.0] + [0.0] * 6, 1, "x")]
    schema = "vec_id long, embedding array<double>, label int, node string"

    def sound(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    unit = [np.array(r[1]) / max(map(abs, r[1])) if sound(r) else None for r in rows]

    def linked(i, j):
        a, b = unit[i], unit[j]
        return i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98

    n = len(rows)
    groups = components_of(n, linked)
    ids = {g: min((rows[i][0] for i in range(n) if groups[i] == g and rows[i][0] is not None), default=None) for g in groups}
    expected = [(r[0], sum(linked(i, j) for j in range(n)), ids[groups[i]], r[0] is not None and r[0] == ids[groups[i]]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    for block in (1024, 7):
        assert sorted_rows(vectors.near_vectors(df, block=block)) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert vectors.near_vectors(df.limit(0)).count() == 0
    named = df.withColumn("label", F.concat(F.lit("kind "), F.col("label").cast("string")))
    assert sorted_rows(vectors.near_vectors(named)) == sorted_rows(vectors.near_vectors(df))


def test_simhash_edges(spark, edges, nothing):
    rows = edge_rows()
    prints = simhash.fingerprints_of([(r[1] or "").encode() for r in rows]).tolist()
    groups = components_of(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    low = {g: min((rows[i][0] for i in range(len(rows)) if groups[i] == g and rows[i][0] is not None), default=None) for g in groups}
    expected = [(r[0], f"{p:016x}", low[g], r[0] is not None and r[0] == low[g]) for r, p, g in zip(rows, prints, groups)]
    got = simhash.simhash_components(edges)
    assert sorted_rows(got) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert simhash.simhash_components(nothing).count() == 0
    kept = simhash.drop_near_duplicates(edges)
    assert kept.columns == edges.columns and kept.count() == len(set(groups))
    assert {r.doc_id for r in kept.collect()} >= {low[g] for g in groups} - {None}


def test_large_buckets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    close = {base ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in (1, 2, 3, 4, 5) for _ in range(80)}
    values = sorted(x - 2**64 if x >= 2**63 else x for x in close)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    label = components_of(len(values), lambda i, j: ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 2)
    for bucket in (256, 4):
        links = [(r.a, r.b) for r in simhash.hamming_links(df, bucket=bucket).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)
        near = {frozenset(x) for x in links}
        assert components_of(len(values), lambda i, j: frozenset((values[i], values[j])) in near) == label


def test_secret_scan(spark, edges, nothing):
    assign = re.compile(secrets.ASSIGN.decode(), re.A)
    rows, expected = edge_rows(), {}
    for r in rows:
        text, found = r[1] or "", []
        found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        expected.setdefault(r[0], []).append((*(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(listed.encode()).hexdigest()))
    got = {}
    for r in secrets.scan_secrets(edges).collect():
        got.setdefault(r.doc_id, []).append((r.n_assign, r.n_access, r.n_hex, r.base_sha256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert secrets.scan_secrets(nothing).count() == 0
    masked = secrets.redact_secrets(edges)
    assert masked.columns == edges.columns and masked.count() == len(rows)
    text = {r.doc_id: r for r in masked.collect()}
    assert text[11].text == 'password = "[secret]" then [secret] and [secret]' and text[11].n_chars == len(text[11].text)
    assert text[12].text.endswith("secret:[secret]") and text[12].text.startswith("é ü 日本 ")
    assert text[1].text == rows[0][1] and text[6].text is None


def conversations():
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello 日本"), (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "bye"),
            (3, 0, "system", "be kind"), (3, 1, "user", "hi"), (4, 0, None, None), (4, 1, "assistant", None), (4, 1, "assistant", "x"), (4, 1, "assistant", "x"),
            (5, None, "user", "<|im_start|>\\n</s>[INST]"), (5, 3, "assi\nstant\\n", "[/INST]<\\|im_end|>"), (None, 0, "user", "lost"), (6, 0, "user", words(9, 5_000)), (7, 0, "assistant", "")]
    rows += [(8, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(120)] + [(i, t, "user" if t % 2 else "assistant", "same" if t < 3 else f"{i}") for i in range(20, 60) for t in range(5)]
    return [(*r, "c", "c") for r in rows]


def test_chat_trees(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string, leaf string").repartition(3)
    streams, members = chat.chat_trees(df, BYTES)
    expected = []
    for conv in {r[0] for r in rows}:
        none_first = lambda x: (x is not None, x if x is not None else "")
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, none_first(r[2]), none_first(r[3])))
        turns = [(r[2] or "", r[3] or "") for r in mine]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(chat.START + chat._role(r) + chat.MIDDLE + chat.escape(t) + chat.STOP for r, t in turns)
        expected.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in chat.read_conversations(streams, members, BYTES).collect()), key=key) == sorted(expected, key=key)
    # Shared turns once, shards without gaps, positions after all ancestors.
    nodes = streams.collect()
    assert len(nodes) == len({bytes(n.node) for n in nodes})
    for shard in {n.shard for n in nodes}:
        at = 0
        for n in sorted((n for n in nodes if n.shard == shard), key=lambda n: n.start):
            assert n.start == at and n.end - n.start == len(n.ids)
            at = n.end
    starts = {(n.shard, n.start): n for n in nodes}
    for n in nodes:
        above = [starts[a.shard, a.start] for a in n.ancestors]
        assert [a.depth for a in above] == list(range(n.depth)) and n.position == sum(a.end - a.start for a in n.ancestors)
        assert all((a.shard, a.start) < (n.shard, n.start) for a in above)
    assert chat.read_conversations(*chat.chat_trees(df.limit(0), BYTES), BYTES).count() == 0


def test_packing(spark, edges, nothing):
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    expected = []
    for r in edge_rows():
        ids = np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        expected += [(r[0], i, i * 64, len(ids[i * 64:i * 64 + 64]), zlib.crc32(ids[i * 64:i * 64 + 64])) for i in range(-(-len(ids) // 64))]
    got = packing.pack_documents(edges, WORDS, capacity=64, partition_pieces=20, ids=True).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(expected, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 64
    assert len(bins) <= packing.lower_bound(np.array([r.length for r in got]), 64) + 2
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_quality_without_and_with_labels(spark, edges, nothing):
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = edge_rows()
    got = quality.quality(edges, none).collect()
    assert len(got) == len(rows) and all(r.kept != r.base_failed and r.probability is None for r in got)
    good = [(i, words(i, 60)) for i in range(40)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in words(i + 500, 60).split())) for i in range(40)]
    docs = spark.createDataFrame([(*x, None, None, 0, *["c"] * 11) for x in good + bad], SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(0, 30), *range(100, 130), 7, 999]], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.quality(docs, labels).collect() if r.kept}
    assert kept == set(range(40))
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept
    assert quality.quality(nothing, labels).count() == 0 and quality.quality(edges, none.limit(0)).count() == len(rows)


def test_languages(spark, edges, nothing):
    got = langid.predict_languages(edges, langid.train_languages(edges)).collect()
    texts = {r[0]: r[1] for r in edge_rows()}
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {6, 7, 8, 14, None}
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"} and texts[6] is None
    assert langid.train_languages(edges.withColumn("text", F.lit(None).cast("string"))) is None
    assert langid.train_languages(nothing) is None
    assert {(r.lang_pred, r.score) for r in langid.predict_languages(edges, None).collect()} == {("und", 0.0)}
    assert langid.predict_languages(nothing, None).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    pred = langid.predict_languages(docs.filter(held), langid.train_languages(docs.filter(~held)))
    assert pred.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


def test_piece_coding(spark, edges, nothing):
    got = pieces.encode_pieces(edges, PIECES, ids=True).collect()
    assert len(got) == len(edge_rows()) and all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in got)
    assert pieces.encode_pieces(nothing, PIECES).count() == 0


@pytest.mark.parametrize("segment", [1 << 18, 50])
def test_token_files(spark, edges, nothing, tmp_path, segment):
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    order = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = [], 0
    for r in order:
        ids = np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((r[0], start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    path = f"file://{tmp_path}/tokens"
    token_files.write_tokens(edges, path, BYTES, segment_ids=segment)
    assert sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1]) == expected
    token_files.write_tokens(nothing, path + "-none", BYTES)
    assert token_files.read_tokens(spark, path + "-none").count() == 0


@pytest.mark.parametrize("sizes", [{}, {"bucket": 1, "shard_words": 500}])
def test_substring_dedup(spark, edges, nothing, sizes):
    rows, first = edge_rows(), {}
    for r in rows:
        w = (r[1] or "").encode().split()
        for i in range(len(w) - 49):
            if r[0] is not None:
                key = tuple(w[i:i + 50])
                first[key] = min(first.get(key, r[0]), r[0])
    expected = []
    for r in rows:
        w = (r[1] or "").encode().split()
        gone = {j for i in range(len(w) - 49) if r[0] is not None and first[tuple(w[i:i + 50])] < r[0] for j in range(i, i + 50)}
        expected.append((r[0], len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    got = substring.substring_dedup(edges, **sizes)
    assert sorted_rows(got) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert substring.substring_dedup(nothing).count() == 0
    left = substring.remove_repeats(edges, **sizes)
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id not in (5, None)}
    assert left.columns == edges.columns and 3 not in texts and texts[1] == rows[0][1] and texts[9] == rows[11][1] and texts[6] is None


def test_frequent_passage_in_many_surroundings(spark):
    passage = words(1, 70)
    rows = [(i, words(100 + i, 20) + " " + passage + " " + words(300 + i, 20)) for i in range(40)]
    rows += [(100 + i, words(100 + i % 7, 20) + " " + passage) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted_rows(substring.substring_dedup(docs))
    assert sorted_rows(substring.substring_dedup(docs, bucket=5, shard_words=300)) == expected
    removed = {r[0]: r[2] for r in expected}
    assert removed[0] == 0 and all(removed[i] == 70 for i in range(1, 40)) and removed[107] == 90


def test_pipeline(spark, edges, nothing, tmp_path):
    docs = spark.createDataFrame([(i, words(i, 80), "en", "s", 0) for i in range(30)] + [(50, words(3, 80), "en", "s", 0), (51, words(4, 60) + " " + words(60, 20), None, None, None),
                                 (52, words(70, 50) + " token=" + "a1b2c3d4e5", "en", "s", 0), (53, "short", "en", "s", 0), (54, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    folder = f"file://{tmp_path}"
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
    left = {r.doc_id: r.text for r in now.collect()}
    assert set(left) == {*range(30), 51, 52}
    assert left[51] == " ".join(words(60, 20).split()) and left[52].endswith("token=[secret]") and left[3] == words(3, 80)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == set(left) and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    nothing.select(docs.columns).write.parquet(f"{folder}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_language_sample_is_the_lowest_hashes(spark):
    """A sample far below the rows of a language holds just the rows with the lowest hashes."""
    docs = spark.range(5_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("lang"),
        F.concat(F.col("lang"), F.col("id").cast("string")).alias("text")).repartition(7)
    trees = langid.train_languages(docs, sample=30).value
    for name, tree in zip(trees.names, trees.trees):
        best = docs.filter(F.col("lang") == name).orderBy(F.xxhash64("doc_id"), "doc_id").limit(30).collect()
        grams, counts = np.unique(langid._grams([r.text.encode() for r in best])[0], return_counts=True)
        assert np.array_equal(tree.levels[0]["grams"], grams) and np.array_equal(tree.levels[0]["counts"], counts)
