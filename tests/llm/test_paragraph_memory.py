"""What a step of the paragraph operator holds at a time."""

from __future__ import annotations

from loomline.llm import paragraph_dedup


def test_texts_go_to_workers_in_short_batches(docs, spark, monkeypatch):
    """Ten thousand texts at a time, held by the JVM and each worker, passed an executor's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, plain = spark.conf.get(name), [], paragraph_dedup.written

    def recorded(df, label):
        seen.append(int(spark.conf.get(name)))
        return plain(df, label)

    monkeypatch.setattr(paragraph_dedup, "written", recorded)
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{passage} x{k}") for k in range(3)]
    got = {r.doc_id: r.n_removed for r in paragraph_dedup.without_repeated_paragraphs(docs(rows)).collect()}
    assert got[0] == 0 and got[1] > 200 and got[2] > 200
    assert seen and max(seen) <= paragraph_dedup.BATCH < int(before)
    assert spark.conf.get(name) == before
