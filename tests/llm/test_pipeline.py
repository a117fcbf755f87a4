"""The stages by themselves and one after the other; the numbered queries beside their SQL."""
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline  # noqa: E402
import edge_docs  # noqa: E402
from biolattice.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


def test_line_dedup_takes_short_lines_out(spark):
    from test_text_operators import repeated_truth
    texts = ["Les.\none two\n\nha ha ha ha", "two one\nles.\nHa\none", None, "\n \nLES.\na line of five words\nONE  two", "one two three\nha ha\na line of five words\n"] * 2
    rows = [*enumerate(texts), (None, "Les.\nfirst of all")]
    gone = repeated_truth(rows, least=1)
    out = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    want = {d: t and "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[-1 if d is None else d]) for d, t in rows}
    assert {r.doc_id: r.text for r in out.collect()} == want and sum(map(len, gone.values())) > 20


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_stages_on_awkward_rows(spark):
    docs = edge_docs.docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() > 0, name
        assert stage(spark, edge_docs.none(spark), SF).count() == 0, name


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    from oracle import compare
    ok, msg, _ = compare(spark, SF, name, queries.QUERIES[name], queries.SQL[name])
    assert ok, msg
