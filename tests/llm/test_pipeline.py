import os

import pytest

import corpus_pipeline
from temperament.llm import ORACLES, QUERIES, load_all

FOLDER = "/root/testdata/sf0.001"
load_all()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_stages_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        seen[name] = docs.collect()
        docs = docs.sparkSession.createDataFrame(seen[name], docs.schema)
        if name != "encoding":
            assert docs.columns == columns
    assert len(seen["language"]) == sum(any(c.isalpha() for c in r["text"] or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    texts = {}
    for r in seen["language"]:
        texts[r["text"].lower()] = max(r["doc_id"], texts.get(r["text"].lower(), -1))
    assert sorted(r["doc_id"] for r in seen["exact_duplicates"]) == sorted(texts.values())
    assert {r["doc_id"] for r in seen["mixing"]} <= {r["doc_id"] for r in seen["near_duplicates"]} < {r["doc_id"] for r in seen["language"]}
    assert len(seen["encoding"]) == len(seen["mixing"]) and all(r["restored"] for r in seen["encoding"])


def test_stages_on_odd_rows_and_nothing(docs, odd_rows, spark):
    for rows in (odd_rows, []):
        frame = docs(rows)
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, FOLDER)
            frame = spark.createDataFrame(frame.collect(), frame.schema)
            assert name == "encoding" or frame.columns == columns
        assert (frame.count() > 0) == bool(rows)


def test_every_operator_has_its_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES)


def test_workers_and_stores_keep_no_memory(monkeypatch):
    from temperament.llm import exact_duplicates, scratch

    ends = []
    monkeypatch.setattr(scratch, "release_memory", lambda: ends.append(1))
    double = scratch.releasing(lambda batches: (2 * b for b in batches))
    assert list(double([1, 2, 3])) == [2, 4, 6] and len(ends) == 1
    stopped = double([1, 2])
    assert next(stopped) == 2 and len(ends) == 1
    stopped.close()
    assert len(ends) == 2
    monkeypatch.undo()
    scratch.release_memory()
    assert exact_duplicates.STORE["spark.sql.streaming.stateStore.unloadOnCommit"] == "true"
    assert scratch.BATCH_BYTES <= 2 << 20


def _resident(pid):
    """MB of a process that lie in memory."""
    with open(f"/proc/{pid}/status") as status:
        return next(int(line.split()[1]) for line in status if line.startswith("VmRSS")) / 1024


def _freed_in_jvm(jvm):
    """Some 260 MB that the JVM has freed outside its heap, below a piece that is still held and returned."""
    taken = [jvm.java.util.zip.Deflater() for _ in range(1001)]
    for deflater in taken[:-1]:
        deflater.end()
    return taken[-1]


def test_driver_gives_back_what_it_has_freed(spark):
    from temperament.llm import scratch

    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    held = _freed_in_jvm(spark._jvm)
    before = _resident(pid)
    scratch.release_driver_memory(spark)
    assert _resident(pid) < before - 100
    held.end()


def test_every_stage_begins_with_memory_given_back(spark, monkeypatch):
    begun = []
    monkeypatch.setattr(corpus_pipeline, "release_driver_memory", begun.append)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(AttributeError):
            stage(spark, None, FOLDER)  # there is no frame to work on
    assert begun == [spark] * len(corpus_pipeline.STAGES)


def test_driver_takes_the_sample_of_languages_piece_by_piece(docs, monkeypatch):
    from pyspark.sql import functions as F

    from temperament.llm import language

    rows = [(i, f"{word} {i} {word} again", lang, "a") for i in range(60) for word, lang in (("house", "en"), ("haus", "de"))]
    whole, pieces = [], []
    collect, iterate = type(docs([])).collect, type(docs([])).toLocalIterator

    def collected(self):
        whole.append(self.columns)
        return collect(self)

    def iterated(self, *args, **settings):
        pieces.append((self.columns, self.rdd.getNumPartitions()))
        return iterate(self, *args, **settings)

    frame = docs(rows).repartition(40)
    monkeypatch.setattr(type(frame), "collect", collected)
    monkeypatch.setattr(type(frame), "toLocalIterator", iterated)
    model = language.train(frame, F.lit(True))
    assert model.languages == ["de", "en"]
    assert not any("buckets" in columns for columns in whole)
    assert [columns for columns, _ in pieces] == [["lang", "buckets", "counts"]] and pieces[0][1] <= 8
