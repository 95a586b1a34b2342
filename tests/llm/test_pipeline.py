from collections import Counter

import corpus_pipeline
from readlake.llm.classifier import fit_quality, text_features
from readlake.llm.simhash import fingerprint

import numpy as np
import pytest

from .helpers import frame, prose


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    d = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, sf).write.parquet(str(tmp_path / str(k)))
        d = steps[name] = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert d.columns == docs.columns and d.dtypes == docs.dtypes
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = {i: t for i, t in rows.items() if model.score(np.array([text_features(t)]))[0] >= 0.7}
    assert {r["doc_id"] for r in steps["quality classifier"].collect()} == set(rows)
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    rows = {i: t for t, i in last.items()}
    assert {r["doc_id"] for r in steps["exact dedup"].collect()} == set(rows)
    prints, root = {i: fingerprint(t) for i, t in rows.items()}, {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    rows = {i: t for i, t in rows.items() if find(i) == i}
    assert {r["doc_id"] for r in steps["SimHash near-dedup"].collect()} == set(rows)
    total = sum(len(t.split()) for t in rows.values())
    mixed = {r["doc_id"]: r["text"] for r in steps["mixing sources to target weights"].collect()}
    assert set(mixed) <= set(rows) and abs(sum(len(t.split()) for t in mixed.values()) - 1.5 * total) < 0.01 * total
    assert {r["doc_id"] for r in steps["best-fit packing"].collect()} == set(mixed)
    assert corpus_pipeline.run(spark, sf).count() == steps["best-fit packing"].count()


def test_odd_rows_and_clashing_columns(spark, sf, tmp_path):
    """Nulls, repeated rows, a very long text and extra columns with the names that stages use; then no rows at all."""
    own = tmp_path / "odd"
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(str(own / "labels.parquet"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = [r["text"] for r in docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality = 1").orderBy("doc_id").limit(6).collect()]
    texts = [None, "", "one", *good, good[0], good[1] + " " + good[2] * 40]
    rows = [(i, t, None, None if i % 3 else "s", None, "a", "b", "c", "d", "e") for i, t in enumerate(texts)]
    rows += [rows[4], (None, good[3], "en", "s", 5, "a", "b", "c", "d", "e")]
    extra = "_id string, _stay string, carry string, stay string, id_taken string"
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").write.parquet(str(own / "documents.parquet"))
    d = spark.read.parquet(str(own / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, str(own)).write.parquet(str(own / str(k)))
        out = spark.read.parquet(str(own / str(k)))
        assert k == 4 or out.columns == d.columns
        assert k == 1 or out.count()
        d = out
    assert corpus_pipeline.run(spark, str(own)).count() == d.count()
    none = tmp_path / "none"
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(str(none / "labels.parquet"))
    docs.limit(0).write.parquet(str(none / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(none)).count() == 0


def test_rows_without_ids_stay_single(spark, sf):
    """Thirty rows without an id, and some that share one: no stage multiplies them, and each text is mixed by its own decision."""
    rows = [(None, prose(i, 30 + i), "a" if i % 3 else "b") for i in range(30)] + [(7, prose(100 + i, 50), "a") for i in range(5)]
    docs = frame(spark, rows).repartition(4)
    out = corpus_pipeline.mixing(spark, docs, sf)
    assert out.columns == docs.columns and out.count() <= len(rows)
    took = sum(len(r["text"].split()) for r in out.collect())
    assert abs(took - 1.5 * sum(len(r[1].split()) for r in rows)) <= 40
    assert corpus_pipeline.near(spark, docs, sf).count() == corpus_pipeline.exact(spark, docs, sf).count() == len(rows)
    twice = docs.union(docs)
    assert Counter(r["text"] for r in corpus_pipeline.near(spark, twice, sf).collect()) == Counter(r[1] for r in rows)
    mixed = corpus_pipeline.mixing(spark, twice, sf)
    assert mixed.count() <= 2 * len(rows)


def test_of_near_copies_the_smallest_id_stays(spark, sf):
    base = prose(1, 400)
    rows = [(None, base), (9, base), (4, base.replace("w1 ", "w2 ", 1)), (4, base), (None, prose(2, 80)), (None, prose(2, 80))]
    kept = Counter(r["doc_id"] for r in corpus_pipeline.near(spark, frame(spark, rows), sf).collect())
    assert kept == Counter([4, None])


@pytest.mark.parametrize("parts", [2, 16, 64])
def test_exact_stage_over_real_range_edges(spark, sf, parts):
    head = "one boilerplate head that all share "
    texts = [f"{head}{(i * 7919) % 10007:05d}" for i in range(2000)]
    rows = list(enumerate(texts)) + [(5000 + i, sorted(texts)[1000 + i % 3]) for i in range(3000)] + [(None, texts[5])] * 20
    on = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    was = {k: spark.conf.get(k) for k in on}
    for k, v in on.items():
        spark.conf.set(k, v)
    try:
        out = corpus_pipeline.exact(spark, frame(spark, rows).repartition(6), sf).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    best = {t: i for i, t in sorted((i, t) for i, t in rows if i is not None)}
    assert {r["text"]: r["doc_id"] for r in out} == best and len(out) == len(best)
