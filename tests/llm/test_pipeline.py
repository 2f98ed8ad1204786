import corpus_pipeline as pipeline
import edges
import sentencepiece
from pyspark.sql import functions as F
from test_minhash import brute
from test_pii import base

from tamarack.llm import quality
from tamarack.session import materialize


def test_stages_are_in_order():
    assert [f.__name__ for _, f in pipeline.STAGES] == [
        "keep_quality",
        "drop_near_copies",
        "hide_personal_data",
        "mix_sources",
        "tokenize",
    ]


def test_every_stage_on_documents(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    made = [docs]
    for name, stage in pipeline.STAGES:
        made.append(materialize(stage(spark, made[-1], root), "stage"))
    for df in made[:-1]:
        assert df.columns == docs.columns

    # 1: what the classifier rejects goes, labelled good documents stay
    labels = spark.read.parquet(f"{root}/labels.parquet")
    machine = quality.train(docs, labels)
    want = {r.doc_id for r in quality.classify(docs, machine).filter("predicted = 1").collect()}
    assert {r.doc_id for r in made[1].collect()} == want
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good & want) >= 0.98 * len(good)

    # 2: the smallest doc_id of each group
    groups = brute([(r.doc_id, r.text) for r in made[1].collect()])
    assert sorted(r.doc_id for r in made[2].collect()) == sorted(d for d, (_, c) in groups.items() if c == d)

    # 3: no entity is left, clean documents are as they were
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (made[2], made[3]))
    assert before.keys() == after.keys()
    assert all(not base(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not base(t))

    # 4: sources come near their targets
    sizes, taken = {}, {}
    for df, out in ((made[3], sizes), (made[4], taken)):
        for r in df.collect():
            out[r.source] = out.get(r.source, 0) + len(r.text.split())
    assert made[4].groupBy("doc_id").count().filter("count > 2").count() == 0
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.1 * sum(sizes.values())

    # 5: ids as the library has them
    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.TOKENIZER)
    texts = {r.doc_id: r.text for r in made[4].collect()}
    rows = made[5].collect()
    assert len(rows) == made[4].count() and all(r.exact for r in rows)
    assert all(r.ids == library.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) for r in rows)


def test_odd_rows(spark, root):
    for make in (edges.frame, edges.clashing, edges.empty):
        docs = make(spark)
        for _, stage in pipeline.STAGES[1:]:
            out = materialize(stage(spark, docs, root), "stage")
            if stage is pipeline.tokenize:
                assert out.count() == docs.count()
            else:
                assert out.columns == docs.columns
        kept = pipeline.keep_quality(spark, docs, root)
        assert kept.columns == docs.columns


def test_odd_rows_keep_their_texts(spark, root):
    """Nulls, empty, long and repeated texts, row by row."""
    rows = [(r[0], r[1]) for r in edges.rows()]
    for make in (edges.frame, edges.clashing):
        docs = make(spark)

        def after(stage, docs=docs):
            return [(r.doc_id, r.text) for r in stage(spark, docs, root).select("doc_id", "text").collect()]

        assert sorted(after(pipeline.hide_personal_data), key=str) == sorted(rows, key=str)  # they hold none
        left = after(pipeline.drop_near_copies)
        gone = [rows[2], rows[2], rows[-3]]  # the copies of 1 and 9
        assert sorted(left + gone, key=str) == sorted(rows, key=str)
        mixed = after(pipeline.mix_sources)
        assert set(mixed) <= set(rows)
        assert all(mixed.count(r) <= 2 * rows.count(r) and (r[0] is None or r[1].split()) for r in mixed)
        coded = pipeline.tokenize(spark, docs, root).collect()
        assert sorted(((r.doc_id, not r.n_ids) for r in coded), key=str) == sorted(((d, not t) for d, t in rows), key=str)
        assert all(r.exact for r in coded)


def test_repeated_ids_leave_one_row(spark, root):
    docs = edges.frame(spark)
    ids = [r.doc_id for r in pipeline.drop_near_copies(spark, docs, root).collect()]
    # 2 is a copy of 1, 10 of 9; rows without an id stay
    assert sorted((i for i in ids if i is not None)) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert ids.count(None) == 2


def test_run_reads_documents(spark, root):
    out = pipeline.run(spark, root)
    assert out.filter(~F.col("exact")).count() == 0
