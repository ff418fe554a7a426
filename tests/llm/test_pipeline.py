import hashlib
import re

import corpus_pipeline
import pytest

from cairn.llm.mixing import mix
from cairn.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before each stage, and the result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stage(spark, docs, SF).checkpoint()
    return [*out, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_take_and_return_documents(steps):
    assert [len(corpus_pipeline.STAGES), len(steps)] == [5, 6]
    assert all(df.columns == COLUMNS for df in steps[:5])


def test_quality_keeps_clean_documents_untouched(spark, steps):
    before, after = texts(steps[0]), texts(steps[1])
    assert all(before[k] == t for k, t in after.items())
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [k in after for k in before if labels.get(k) == (1, 0)]
    assert sum(clean) >= 0.95 * len(clean)


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps[1]), texts(steps[2])
    prints = {k: fingerprint(t, 3) for k, t in before.items()}
    for k in before:
        near = [j for j in before if (prints[j] ^ prints[k]).bit_count() <= 3]
        if k == min(near) and len(near) == 1:
            assert k in after
    kept = list(after)
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for i, a in enumerate(kept) for b in kept[i + 1:])


def test_personal_data_is_gone_and_the_rest_is_not(steps):
    before, after = texts(steps[2]), texts(steps[3])
    assert set(before) == set(after)
    for k, t in after.items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)
        if not re.search("[0-9@]", before[k]):
            assert t == before[k]


def test_the_mix_takes_what_its_plan_says(steps):
    taken = {r.doc_id: r.taken for r in mix(steps[3]).collect()}
    words = {}
    for r in steps[4].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    assert words == {k: v for k, v in taken.items() if v}


def test_every_mixed_document_is_packed(steps):
    assert steps[5].where("piece = 0").count() == steps[4].count()
    assert steps[5].groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()


def test_awkward_rows_pass_every_stage(spark, awkward, nothing):
    for docs in (awkward.select(*COLUMNS), nothing):
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF).checkpoint()
            assert docs.columns == COLUMNS
        assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= 0


def test_run_is_the_stages_in_a_row(spark, steps):
    digest = lambda df: sorted(hashlib.md5(str(r).encode()).hexdigest() for r in df.drop("sequence_id", "offset").collect())
    assert digest(corpus_pipeline.run(spark, SF)) == digest(steps[5])
