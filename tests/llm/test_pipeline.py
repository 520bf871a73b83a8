from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from playlens.llm.setjoin import Rule

from .helpers import frame
from .test_decontaminate import plain as plain_hits
from .test_linededup import plain as plain_lines
from .test_packing import LIBRARY
from .test_setjoin import expected, near_copies

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after each stage."""
    docs = corpus_pipeline.table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["line_dedup", "near_duplicates"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_bad_documents_go(spark, steps):
    labels = corpus_pipeline.table(spark, SF, "labels")
    kept = steps[1].join(labels, "doc_id").groupBy("quality").count().collect()
    before = steps[0].join(labels, "doc_id").groupBy("quality").count().collect()
    kept, before = dict(map(tuple, kept)), dict(map(tuple, before))
    assert kept[1] == before[1] and kept.get(0, 0) <= 0.2 * before[0]


def test_lines_and_lengths(steps):
    assert rows(steps[2]) == sorted((n, t) for n, t, *_ in plain_lines(rows(steps[1]), 5, 40))
    changed = steps[2].join(steps[1].select("doc_id", F.col("text").alias("old")), "doc_id").where("text <> old")
    assert changed.count() and changed.where("n_chars <> length(text)").count() == 0


def test_one_of_each_group_stays(steps):
    """Against a comparison of all pairs by their five-word shingles."""
    groups = expected([(n, t, None) for n, t in rows(steps[2])], Rule(5, 4, 5))
    assert [n for n, _ in rows(steps[3])] == sorted(n for n, _, least in groups if n == least)


def test_the_stage_drops_near_copies_of_ordinary_length(spark):
    table = near_copies(Rule(5, 4, 5))
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, table), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({root for _, _, root in expected(table, Rule(5, 4, 5))})


def test_rows_are_judged_by_number_and_text(spark):
    one, two, three, four = ("".join(f"{x}{i} " for i in range(40)) for x in "abcd")
    table = [(1, one, "x"), (2, two, "x"), (2, one, "y"), (3, two, "x"), (2, two, "z")]  # number 2 has two texts
    table += [(None, three, "b"), (None, three, "a"), (None, three + "e", "c"), (None, four, "x"), (None, one, "x")]
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, table), "").collect()
    numbered = sorted((r.doc_id, r.text, r.score) for r in kept if r.doc_id is not None)
    assert numbered == [(1, one, "x"), (2, two, "x"), (2, two, "z")]
    assert sorted(r.text[0] for r in kept if r.doc_id is None) == ["c", "d"]


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in corpus_pipeline.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = [r[0] for r in plain_hits(rows(steps[3]), items, 13) if not r[4]]
    assert [n for n, _ in rows(steps[4])] == sorted(clean)


def test_all_ids_are_packed(steps):
    ids = {n: LIBRARY.encode(t, add_special_tokens=False).ids + [1] for n, t in rows(steps[4])}
    found = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id: (r.n, r["all"]) for r in found} == {n: (len(x), len(x)) for n, x in ids.items()}


def test_stages_take_odd_rows_and_none(spark):
    from .helpers import odd_documents

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(n, t, None, "s", len(t or "")) for n, t, _ in odd_documents()]
    for table in (odd, []):
        docs = spark.createDataFrame(table, schema).withColumn("hits", F.lit(1)).withColumn("score", F.lit("x"))
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0


def test_shuffles_of_earlier_stages_go_before_packing(spark, monkeypatch):
    done = []
    monkeypatch.setattr(corpus_pipeline, "drop_shuffles", lambda _: done.append("drop"), raising=False)
    empty = spark.createDataFrame([], "doc_id long, ids binary")
    monkeypatch.setattr(corpus_pipeline, "pack_documents", lambda docs, *_, **__: done.append("pack") or docs)
    corpus_pipeline.pack(spark, empty, "")
    assert done == ["drop", "pack"]


def test_the_scanned_copy_goes_before_packing_unless_it_is_read(spark):
    table = [(i, f"text {i} with a few words of its own", "en", "s", 30) for i in range(20)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")

    def left():
        """Rows of the copy, None if it is gone."""
        path = spark._jvm.org.apache.hadoop.fs.Path(scanned._written_to)
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        return spark.read.parquet(scanned._written_to).count() if there else None

    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    scanned = corpus_pipeline._scanned[spark.sparkContext.applicationId]
    packed = corpus_pipeline.pack(spark, kept, SF)  # not written in between
    assert packed.select("doc_id").distinct().count() == 20 and left() == 20
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    scanned = corpus_pipeline._scanned[spark.sparkContext.applicationId]
    written = corpus_pipeline.stored(kept, "test-kept")
    packed = corpus_pipeline.pack(spark, written, SF)
    assert packed.select("doc_id").distinct().count() == 20 and left() is None
