"""The pipeline's stages, each against what its operator says of its own input."""
import collections
import os

import pytest

import corpus_pipeline as pipeline
from quern.llm import mixing, secrets, simhash
from quern.session import stage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def kept(spark):
    """What goes into and comes out of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, apply in pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), "test")
        found.append(docs)
    return found


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])


def test_toxic_documents_go(spark, kept):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = rows(kept[0]), rows(kept[1])
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in toxic) <= 0.4 * len(toxic)


def test_one_document_of_each_group_stays(kept):
    groups = simhash.near_duplicates(kept[1]).collect()
    assert sorted(rows(kept[2])) == sorted({r["component_id"] for r in groups})
    assert kept[2].count() == len(rows(kept[2]))


def test_secrets_go_and_documents_stay(kept):
    before, after = rows(kept[2]), rows(kept[3])
    assert before.keys() == after.keys()
    for i, r in after.items():
        spans = secrets.scan(before[i]["text"])[1]
        assert (r["text"] == before[i]["text"]) == (not spans)
        assert r["n_chars"] == len(r["text"])


def test_sources_come_near_their_targets(kept):
    copies = collections.Counter(r["doc_id"] for r in kept[4].collect())
    mixed = mixing.mix(kept[3]).collect()
    assert {r["doc_id"]: r["copies"] for r in mixed if r["copies"]} == dict(copies)


def test_everything_is_packed(kept):
    copies = collections.Counter(r["doc_id"] for r in kept[4].collect())
    packed = kept[5].collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    fill = collections.Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096


def test_run_gives_the_last_stage(spark, kept):
    assert pipeline.run(spark, SF).count() == kept[5].count()


ODD = [
    (3, "the cat sat on the mat and the dog ran off over the hill", "en", "b", 57),
    (3, "the cat sat on the mat and the dog ran off over the hill", "en", "b", 57),
    (5, "the cat sat on the mat and the dog ran off over the hill", "en", None, 57),
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "\u00dcn\u00efc\u00f6d\u00e9 \U0001f600 words are here", "de", "b", 23),
    (7, "word " * 9000, "en", "a", 45_000),
    (8, "x" * 300_000, "en", "a", 300_000),
    (9, "password=hunter22secret and " + "QUJD" * 30_000, "en", "c", 120_028),
    (10, "a\tb\x0bc\x1cd\u00a0e", None, "a", 9),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_and_no_documents_pass_all_stages(spark, tmp_path, rows):
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1, 0), (7, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = [docs]
    for _, apply in pipeline.STAGES:
        docs = stage(apply(spark, docs, str(tmp_path)), "odd")
        found.append(docs)
    ids = [sorted((r["doc_id"] for r in df.collect()), key=repr) for df in found]
    assert ids[1] == ids[0]  # nothing is labelled toxic
    first = {r["component_id"] for r in simhash.near_duplicates(found[1]).collect()}
    assert ids[2] == sorted(first, key=repr) and ids[3] == ids[2]
    texts = {r["doc_id"]: r["text"] for r in found[3].collect()}
    if rows:
        assert texts[9].startswith("[SECRET] and ") and {1, 5, 7} & set(ids[2]) == {1, 7}
    assert {r["doc_id"] for r in found[5].collect()} == set(ids[4])
    assert pipeline.run(spark, str(tmp_path)).count() == found[5].count()
