"""Every query of the subpackage runs over whole tables with the columns that are asked for."""

import os

import pytest

from sheafline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
COLUMNS = {
    "p1_found": ["item_id", "field"], "p2_found": ["item_id", "field"], "p3_found": ["first_id", "other_id"], "p5_found": ["first_id", "other_id"],
    "p6_found": ["item_id", "field", "defect"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "eval_id"], "p9_found": ["doc_id", "kind", "value"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    assert rows
    if name in ("p1_cleaned", "p2_unified", "p7_ids", "p9_redacted"):  # nothing is lost
        from pyspark.sql import functions as F

        source = spark.read.parquet(f"{FOLDER}/{'items' if name[1] in '12' else 'documents'}.parquet")
        want = source.count() if name[1] in "79" else source.select(F.count("body") + F.count("answer") + F.count("memo")).first()[0]
        assert len(rows) == want
