import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F

from taxaflow.llm import queries
from tests.llm.helpers import DOC

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, names = docs, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == first.columns
        names.append((name, docs.count(), out.count()))
        before, docs = docs, out
    assert all(b <= a for _, a, b in names[:3]) and names[0][2] < names[0][1] and names[2][2] < names[2][1]
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    want = sorted(tuple(library.encode(r.text)) for r in before.collect())
    assert sorted(tuple(r.ids) for r in docs.collect()) == want


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("i", range(5))
def test_stages_on_odd_rows(spark, i):
    name, stage = corpus_pipeline.STAGES[i]
    text = " ".join(f"word{k} of a text" for k in range(40))
    rows = [(2**60 + 1, text, "en", "a", 5), (None, text, None, None, None), (3, None, "en", "a", 0), (4, "", "de", "b", 0), (5, text + " more", "en", "a", 9), (5, text + " more", "en", "a", 9), (6, "w " * 40_000, "en", "c", 1)]
    docs = spark.createDataFrame(rows, DOC)
    out = stage(spark, docs.withColumn("size", F.lit("x")).withColumn("_fp", F.lit(1)), SF)
    kept = out.collect()
    assert {r.doc_id for r in kept} <= {r[0] for r in rows}
    if i == 4:
        assert {r.doc_id: r.n_tokens for r in kept}[4] == 0 and len(kept) == len(rows)
    else:
        assert out.columns[:5] == docs.columns[:5] and all(r.text is None or set(r.text.split()) <= set((text + " more w").split()) for r in kept)
    assert stage(spark, docs.where("false"), SF).count() == 0
