"""The queries as registered, on a small table of their own, against brute force of their columns."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from stintgraph.llm import jaccard_join, license_scan, packing, quality_rules, sentence_pieces, sharding, suffix_dedup, topk_search
from tests.llm.test_operators import brute_components, brute_cut, measures, prose, spark_hash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


def texts():
    rng = random.Random(21)
    passage = prose(rng, 130)
    out = [None, "", "  \n ", "MIT License and the Apache license", "<p> | # $", "the of " * 40, "é" * 900, "\x00 日本 ﬁ\n\n x"]
    out += [prose(rng, 50) + " " + passage + " " + prose(rng, 40) for _ in range(4)] + [passage, passage, passage + " end", "General Public License mit license"]
    return out + [prose(rng, rng.randint(1, 400)) for _ in range(25)]


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts())], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_op3(spark, at):
    whole = Tokenizer.from_file(packing.public_paths()[0])
    whole.encode_special_tokens = True
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(texts())}
    got = packing.op3_harmonic_packing(spark, at).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    for own, total in [*((pieces[i], len(x)) for i, x in ids.items()), *((x, None) for x in places.values())]:
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [s for s, _ in sorted(own)] == [0, *ends[:-1].tolist()] and (ends[-1] == total if total else ends[-1] <= packing.CAPACITY)
    # a worker pads one sequence at most
    assert sum(sum(n for _, n in x) < packing.CAPACITY for x in places.values()) <= spark.read.parquet(f"{at}/documents.parquet").rdd.getNumPartitions()
    assert len(got) <= 2.5 * len(ids)


def test_packing_classes():
    bins = packing.Bins(100, 0)
    done = [p for n in (40, 45, 30, 30, 30, 60, 20) for p in bins.put([n, 0, n, b"", n])]
    assert [(s, o, p[0], p[2]) for s, o, p in done] == [(0, 0, 40, 40), (0, 40, 45, 45), (0, 85, 30, 15)]
    done += bins.rest()
    assert sum(p[2] for _, _, p in done) == 255 and max(o + p[2] for _, o, p in done) == 100


def test_op4(spark, at):
    got = rows(sharding.op4_external_shuffle(spark, at))
    slots = defaultdict(list)

    def shard(key, n):
        at_ = 0
        for k in range(2, n + 1):
            at_ = k - 1 if spark_hash(key, sharding.SEED, k) % k == 0 else at_
        return at_

    for i, t in enumerate(texts()):
        body = (t or "").encode()
        r = got[i]
        assert (r.size, r.text_crc32, r.law, r.shard, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "key", shard(i, 24), shard(i, 25))
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i % 50 if i % 5 else None, f"t{i}" if i % 7 else None) for i in range(300)], "doc_id bigint, text string")
    shuffled = sharding.external_shuffle(df, shards=4, bucket_bytes=500)
    sharding.write_shards(shuffled, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert Counter((r.doc_id, r.text, r._shard, r._slot) for r in back) == Counter((r.doc_id, r.text, r._shard, r._slot) for r in shuffled.collect()) and len(back) == 300


def test_op6(spark, at):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(sentence_pieces.op6_sentence_pieces(spark, at))
    for i, t in enumerate(texts()):
        ids = sp.encode(t or "")
        assert (got[i].n_pieces, got[i].ids_crc32, got[i].decoded_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), zlib.crc32((t or "").encode()))


def test_op7(spark, at):
    got = rows(suffix_dedup.op7_suffix_dedup(spark, at))
    for i, (t, (removed, spans, kept)) in enumerate(zip(texts(), brute_cut(texts(), 400), strict=True)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_kept) == (len((t or "").encode()), removed, spans, hashlib.sha256(kept).hexdigest(), len(kept))
    assert sum(r.n_removed > 0 for r in got.values()) >= 7


def test_whole_characters():
    body = "aé日b".encode()
    for a in range(len(body)):
        for b in range(a + 1, len(body) + 1):
            left = suffix_dedup.without(body, suffix_dedup.whole_characters(body, np.array([[a, b]]))).decode()
            assert left == "".join(c for c, s, e in zip("aé日b", (0, 1, 3, 6), (1, 3, 6, 7), strict=True) if e <= a or s >= b)


def test_pipeline_keeps_replacement_characters(spark):
    t = prose(random.Random(5), 120)
    docs = spark.createDataFrame([(0, "�" + t, "en", "s", 1), (1, "x" + t, "en", "s", 1)], SCHEMA)
    left = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert left == {0: "�", 1: "x"}


def test_op8(spark, at):
    got = rows(jaccard_join.op8_jaccard_join(spark, at))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == dict(enumerate(brute_components(texts())))


def test_op9(spark, at):
    got = rows(license_scan.op9_license_scan(spark, at))
    for i, t in enumerate(texts()):
        words = [w.decode() for w in license_scan.words_of(t or "")]
        hits = sorted((k, label) for p, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(hits), ",".join(sorted({label for _, label in hits})))
        assert (r.first_word, r.last_word) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
    assert got[3].n_base == 2 and got[15].n_base == 2


def test_op10(spark, at):
    got = rows(quality_rules.op10_quality_rules(spark, at))
    for i, t in enumerate(texts()):
        n, chars, symbols, _, dup, _, repeat = measures(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n) and not (r.kept and r.base_failed)


def test_quality_of_long_texts_and_nothing(spark):
    """A filter on the verdict doesn't copy the measures: words and lines are parted once."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(0, "the of " + prose(rng, 20_000), "en", "s", 1), (1, None, "en", "s", 0)], SCHEMA)
    kept = corpus_pipeline.keep_good(spark, docs, "")
    assert [r.doc_id for r in kept.collect()] in ([0], [])
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.keep_one_of_each, corpus_pipeline.cut_repeats, corpus_pipeline.pack_all):
        assert stage(spark, docs.limit(0), "").count() == 0


def test_packing_and_pieces_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id bigint, text string")
    assert sum(r.length for r in packing.pack(docs, *packing.public_paths()).collect()) == 3 + 3 + 2 + 1
    table = sentence_pieces.public_table()
    back = sentence_pieces.decode(sentence_pieces.encode(docs, table), table)
    assert Counter((r.doc_id, r.decoded) for r in back.collect()) == Counter([(1, "a b"), (1, "a b"), (None, "c"), (None, "")])
    assert Counter(r.doc_id for r in license_scan.scan(docs).collect()) == Counter([1, 1, None, None])


def test_top_k_of_repeated_ids(spark):
    rng = np.random.default_rng(8)
    vectors = [(i % 40, rng.normal(size=3).tolist()) for i in range(90)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = topk_search.top_k(df, 20, k=4, block_rows=16).collect()
    whole = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    want = Counter()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted((-int(a @ b), i) for i, b in whole if i != q)[:4]
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(scored))
    assert Counter(tuple(r) for r in got) == want


def test_top_k_moves_what_may_meet(spark, monkeypatch):
    """With clusters that lie apart, blocks are sent to the few groups that they may serve."""
    moved = {}
    keep = topk_search.written

    def told(df, name):
        out = keep(df, name)
        if name == "meeting":
            moved["n"] = out.count()
        return out

    monkeypatch.setattr(topk_search, "written", told)
    monkeypatch.setattr(topk_search, "TOGETHER", 1)
    rng = np.random.default_rng(9)
    sent = []
    for clusters in (8, 16):
        at_ = np.eye(16)[:clusters] * 100
        vectors = [(i, (at_[i % clusters] + rng.normal(size=16)).tolist()) for i in range(60 * clusters)]
        topk_search.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), 4, k=3, block_rows=48).count()
        sent.append(moved["n"])
    assert sent[1] <= 3 * sent[0]


def test_op10_counts_lines_as_its_sql(spark, tmp_path):
    """A short header that is also the footer: over 30 of 100 lines, few of the characters."""
    text = "The header\n" + "the law of this and that is in the book " * 3 + " ".join(f"word{i}" for i in range(40)) + "\nThe header"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = quality_rules.op10_quality_rules(spark, str(tmp_path)).first()
    assert (got.n_dup_lines, got.base_failed, got.kept) == (1, False, False)
    assert quality_rules.quality_verdicts(spark, str(tmp_path)).first().kept
