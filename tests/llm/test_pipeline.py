"""The pipeline stage by stage against plain versions of what each stage decides."""

import corpus_pipeline
import pytest
from test_lines_and_benchmark import brute_hits, brute_lines
from test_simhash import brute_components
from test_tokens import direct

from rosterline.llm import toxicity
from rosterline.llm.queries import table
from rosterline.workspace import sized


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = [table(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(sized(stage(spark, docs[-1], sf_dir), f"test-{name}"))
    return docs


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_stages_in_order(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert all(frame.columns == steps[0].columns for frame in steps[1:-1])


def test_toxic_documents_go(steps, spark, sf_dir):
    """The stage drops what the model predicts; its accuracy is tested on a table with enough labels."""
    labels = table(spark, sf_dir, "labels")
    before, after = rows(steps[0]), rows(steps[1])
    model = toxicity.fit(steps[0], labels)
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.scored(steps[0], model, keep=["doc_id"]).collect()}
    assert set(after) == {i for i, p in predicted.items() if p == 0}
    assert all(after[i] == before[i] for i in after)
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len((set(before) - set(after)) & clean) <= 3


def test_shared_lines_go(steps):
    before, after = rows(steps[1]), rows(steps[2])
    ids = sorted(before)
    assert [after[i]["text"] for i in ids] == [t for t, _, _ in brute_lines([before[i]["text"] for i in ids], 10)]
    assert len(after) == len(before)


def test_one_of_each_group_stays(steps):
    before, after = rows(steps[2]), rows(steps[3])
    groups = brute_components([(i, r["text"]) for i, r in before.items()])
    assert set(after) == {c for _, _, c in groups}


def test_contaminated_documents_go(steps, spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    before, after = rows(steps[3]), rows(steps[4])
    assert set(after) == {i for i, r in before.items() if not brute_hits(r["text"], items, 10)[1]}


def test_all_that_is_left_is_packed(steps, tokenizer):
    before, lengths = rows(steps[4]), {}
    for r in steps[5].collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(direct(tokenizer, r["text"])) + 1 for i, r in before.items()}


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir, steps):
    keep = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(*keep).collect()) == sorted(steps[5].select(*keep).collect())
