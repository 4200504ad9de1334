"""Which rows the pipeline's filtering stages keep, on awkward groups."""

import corpus_pipeline
from bazarlake.llm import line_dedup, minhash

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], KIND)


def body(tag, n=60):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_one_row_of_each_group_stays(spark):
    near = body("a") + " tail"
    rows = [
        (None, body("a")), (None, near), (None, body("a") + " other"),  # a group without any id
        (5, body("b")), (5, body("b") + " tail"), (5, body("b") + " end"),  # near copies under one id
        (7, body("c")), (8, body("c")), (None, body("c")), (8, body("c")),
        (9, None), (10, ""), (11, " "), (None, None),
        (20, body("d")),
    ]
    docs = frame(spark, rows)
    kept = [(r.doc_id, r.text) for r in minhash.one_of_each(docs, width=5, percent=80).collect()]
    tags = [t[0] for _, t in kept if t and t.strip()]
    assert sorted(tags) == ["a", "b", "c", "d"]
    assert (7, body("c")) in kept and (20, body("d")) in kept
    assert {(9, None), (10, ""), (11, " "), (None, None)} <= set(kept)
    assert len(kept) == 8


def test_a_document_that_loses_all_its_lines_stays_empty(spark):
    lines = [f"line {k} of a passage" for k in range(4)]
    docs = frame(spark, [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "\n".join(["own", *lines]))])
    rows = {r.doc_id: r for r in line_dedup.cleaned(docs).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].text == "\n".join(lines) and rows[2].text == "" and rows[2].n_chars == 0 and rows[3].text == "own"


def test_stages_on_awkward_rows(spark, awkward, empty, tmp_path):
    awkward.sparkSession.createDataFrame([(1, 1, 0), (6, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            before, after = docs.count(), out.count()
            assert after == before if name == "line_dedup" else after <= before
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
