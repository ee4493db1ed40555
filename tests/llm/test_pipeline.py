"""The stages one by one, and together, against brute force."""

import random

import numpy as np

import corpus_pipeline
from stintgraph.llm import packing
from tests.llm.test_operators import brute_components, brute_cut, measures

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


def clean(rng, n):
    return " ".join("the" if i % 8 == 0 else "".join(rng.choices("abcdefghijé", k=rng.randint(3, 8))) for i in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(12)
    base, passage = clean(rng, 200), clean(rng, 110)
    texts = [clean(rng, 90) + " " + passage + " " + clean(rng, 60), clean(rng, 70) + " " + passage, base, base, base.replace("the", "the", 1) + " end", "short", None, "", "# " * 90, clean(rng, 300)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = {i: t for i, t in enumerate(texts) if measures(t)[0] >= 50 and "#" not in t}
    first = corpus_pipeline.keep_good(spark, docs, "")
    assert {r.doc_id for r in first.collect()} == set(kept) and first.dtypes == docs.dtypes
    order = sorted(kept)
    one = {order[k]: kept[order[k]] for k, (_, c) in enumerate(brute_components([kept[i] for i in order])) if c == k}
    second = corpus_pipeline.keep_one_of_each(spark, first, "")
    assert {r.doc_id for r in second.collect()} == set(one) and second.dtypes == docs.dtypes
    order = sorted(one)
    cut = dict(zip(order, brute_cut([one[i] for i in order], 400), strict=True))
    third = corpus_pipeline.cut_repeats(spark, second, "")
    left = {r.doc_id: r.text for r in third.collect()}
    assert third.dtypes == docs.dtypes and any(c[0] for c in cut.values())
    assert left == {i: one[i] if not c[0] else c[2].decode("utf-8", "ignore") for i, c in cut.items()}
    encode = packing.ByteBpe(*packing.public_paths())
    total = {i: len(encode.whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {i: sum(r.length for r in packed if r.doc_id == i) for i in total} == total and len({r.doc_id for r in packed}) == len(total)
    assert np.all([r.offset + r.length <= packing.CAPACITY for r in packed])


def test_short_passages_of_many_words_are_cut(spark):
    """50 words in fewer than 400 bytes, blanks between them of any kind; 49 words stay."""
    rng = random.Random(31)
    word = lambda a, b: "".join(rng.choices("abcdefghijé", k=rng.randint(a, b)))
    own = [" ".join(word(4, 9) for _ in range(70)) for _ in range(8)]
    passage = [word(3, 6) for _ in range(50)]
    short, other = passage[1:], " ".join(passage[:30]) + "\n" + " ".join(passage[30:])
    assert len(" ".join(passage).encode()) < 400
    texts = [f"{own[0]} {' '.join(passage)} {own[1]}", f"{own[2]} {other}", f"{own[3]}z {' '.join(short)} {own[4]}", own[5], None, "", " ".join(["a"] * 49), " ".join(["b"] * 51)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    left = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert {i: r.text for i, r in left.items()} == dict(enumerate([f"{own[0]}  {own[1]}", f"{own[2]} ", *texts[2:7], ""]))
    assert left[0].n_chars == len(left[0].text)
