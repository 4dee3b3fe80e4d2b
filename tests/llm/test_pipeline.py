"""The pipeline's stages in a row, each against the plain version of its operator."""

import time
from collections import Counter
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401
from test_lines import expected as lines_left
from test_mixing import check as check_mix
from test_mixing import size
from test_sigtree import classes
from test_tokens import TIKTOKEN

from refinery.llm import components, mixing, quality, tables
from refinery.llm.tables import stored


def test_stages(spark, given_documents, sf_dir):
    docs, left = given_documents, {}
    for name, stage in corpus_pipeline.STAGES:
        left[name] = docs
        docs = stored(stage(spark, docs, sf_dir), name)
        assert name == "byte_bpe" or docs.columns == given_documents.columns
    left["end"] = docs
    rows = {name: table.collect() for name, table in left.items()}

    kept = {row.doc_id for row in quality.judged(given_documents).filter("kept").collect()}
    assert {row.doc_id for row in rows["line_dedup"]} == kept and len(kept) > 0.7 * len(rows["quality_rules"])
    wanted = lines_left([(row.doc_id, row.text) for row in rows["line_dedup"]])
    differ = sum(row.text != wanted[row.doc_id] for row in rows["ngram_jaccard"])
    assert differ <= len(wanted) // 100 and all(row.n_chars == len(row.text) for row in rows["ngram_jaccard"])
    found = classes([(row.doc_id, row.text) for row in rows["ngram_jaccard"]])
    assert {row.doc_id for row in rows["mixing"]} == {component if n else doc_id for doc_id, n, component in found}
    check_mix(rows["mixing"], mixing.mixed(left["mixing"]).collect())
    taken = {row.doc_id: row.taken for row in mixing.mixed(left["mixing"]).collect()}
    copies = Counter(row.doc_id for row in rows["byte_bpe"])
    texts = {row.doc_id: row.text for row in rows["mixing"]}
    assert copies == {i: taken[i] // size(texts[i]) for i in taken if taken[i]}
    assert Counter(row.doc_id for row in rows["end"]) == copies
    assert all(row.ids == TIKTOKEN.encode_ordinary(texts[row.doc_id]) and row.n_tokens == len(row.ids) for row in rows["end"])


def test_odd_and_no_documents(spark, tmp_path):
    docs = documents(spark, [*ODD, *[(100 + i, prose(i, 60), "en", "s") for i in range(30)]])
    docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_finished_steps_are_forgotten(spark, monkeypatch):
    """The shuffle files of a step go once the step is stored and nothing refers to it any more."""
    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())

    def files():
        return {path.name for path in folder.rglob("shuffle_*.data")}

    monkeypatch.setattr(tables, "SECONDS_BETWEEN", 0.0)
    stored(spark.range(10), "ended")
    time.sleep(1)
    before = files()
    left = []
    for step in range(6):
        stored(spark.range(10_000, numPartitions=4).groupBy((F.col("id") % (100 + step)).alias("of")).agg(F.count(F.lit(1)).alias("n")), "step")
        time.sleep(0.5)
        left.append(len(files() - before))
    # The last plans of a session may still be in use somewhere; those before are not.
    assert left[-1] <= 2 * left[0], left


def test_stored_tables_have_rows_alone(spark):
    """The driver makes no file of its own for a step."""
    table = stored(spark.range(10), "rows")
    names = {path.name for path in Path(tables._FOLDERS[table].removeprefix("file:")).iterdir()}
    assert table.count() == 10 and any(name.startswith("part-") for name in names)
    assert not [name for name in names if "_SUCCESS" in name]


def test_components_end_as_stars(spark, monkeypatch):
    """Links that are stars take no step; a path of three takes the two that make it a star, and none to see that nothing changes."""
    steps = []
    monkeypatch.setattr(components, "stored", lambda df, name, *args: steps.append(name) or stored(df, name, *args))

    def found(links):
        steps.clear()
        return dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))

    assert found([(0, 3), (4, 0), (7, 5), (0, 3), (9, 9)]) == {3: 0, 4: 0, 7: 5} and steps == ["links"]
    assert found([(i, i + 1) for i in range(3)]) == {1: 0, 2: 0, 3: 0} and steps.count("small") == 2
