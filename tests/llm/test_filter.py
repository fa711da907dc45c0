"""The filter of exact copies tells as well in slices as in one piece."""

import pytest
from pyspark.sql import functions as F

from setwise.llm import exact_dedup


@pytest.mark.parametrize("cells", [1 << 26, 1 << 13])
def test_few_texts_are_suspected(spark, monkeypatch, cells):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") < 20, 0).otherwise(F.col("id"))).alias("text"))
    seen = []
    groups = exact_dedup._groups

    def watched(flagged):
        seen.append((flagged.where("suspect").count(), flagged.count()))
        return groups(flagged)

    monkeypatch.setattr(exact_dedup, "_groups", watched)
    found = exact_dedup.copies(docs, max_cells=cells)
    assert found.count() == 4000 and found.where("kept").count() == 3981
    assert found.where("group_size = 20 AND keep_id = 19").count() == 20
    assert len(seen) == (1 if cells > 1 << 20 else 8) and sum(n for _, n in seen) == 4000
    assert 20 <= sum(n for n, _ in seen) < 300
