import numpy as np
import pytest

from temperament.llm import vector_search
from temperament.llm.fixity import audit
from temperament.llm.vector_search import top_k, whole_vectors


def brute(rows, asked, k):
    whole = {}
    for at, (name, vector) in enumerate(rows):
        if name is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole[at] = (name, [int(np.floor(256 * float(x))) for x in vector])
    out = []
    for name, query in whole.values():
        if asked(name):
            scores = [(-min(max(sum(a * b for a, b in zip(query, v)), -(1 << 63)), (1 << 63) - 1), other) for other, v in whole.values() if other != name]
            out += [(name, rank, other, -score) for rank, (score, other) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, rows, asked, k):
    vectors = whole_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, vector int"))
    return sorted(tuple(r) for r in top_k(vectors, vectors.where(asked), k).collect())


@pytest.mark.parametrize("rows", [16, 4096])
def test_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(vector_search, "ROWS", rows)
    monkeypatch.setattr(vector_search, "QUERIES", 7)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(5, 12)) / 4
    vectors = [(i, (centres[i % 5] + draw.normal(size=12) * 0.05).tolist()) for i in range(400)]
    vectors += [(400 + i, vectors[i][1]) for i in range(40)]  # ties
    vectors += [(500, None), (501, [None] * 12), (502, [float("nan")] * 12), (503, [0.0] * 12), (504, []), (505, [1.0, -1.0]), (510, [0.0] * 12)]
    got = found(spark, [(*v, 1, 2) for v in vectors], "vec_id % 10 = 0 or vec_id > 500", 5)
    assert got == brute(vectors, lambda i: i % 10 == 0 or i > 500, 5)


def test_large_components_and_few_rows(spark):
    vectors = [(0, [3e13, 1.0]), (1, [1e3, -2.0]), (2, [-1e3, 2e13]), (None, [1.0, 1.0])]
    assert found(spark, [(*v, 1, 2) for v in vectors], "true", 5) == brute(vectors, lambda i: True, 5)
    assert found(spark, [], "true", 5) == []
    top = found(spark, [(0, [1e300], 1, 1), (1, [1e300], 1, 1)], "true", 1)
    assert [r[3] for r in top] == [(1 << 63) - 1] * 2


def test_audit_finds_the_damage(spark):
    schema = "page_id bigint, url string, html string, key int"
    rows = [(i, f"http://x/{i}", "ä" * (i % 50), 1) for i in range(9000)] + [(7, "http://x/7", "again", 1), (7, "http://x/7", "again", 1)]
    rows += [(None, "u", "no id", 1), (None, None, None, 1), (9500, None, "x", 1), (9501, "", None, 1)]
    lost, changed = {5, 4095, 8999}, {6, 4096}
    other = [(i, u, (h or "") + "!" if i in changed else h, k) for i, u, h, k in rows if i not in lost] + [(20_000, "new", "page", 1)]
    pages, replica = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    got = {r["page_id"]: r for r in audit(pages, replica).collect()}
    assert {n: r["status"] for n, r in got.items()} == {n: "missing" for n in lost} | {n: "changed" for n in changed} | {20_000: "extra"}
    assert got[4096]["record_offset"] == 0 and got[4096]["file_no"] == 1
    assert got[6]["replica_length"] == got[6]["record_length"] + 1
    # a lost record moves what follows it, which is no damage
    assert got[6]["replica_offset"] == got[6]["record_offset"] - got[5]["record_length"]
    assert audit(pages, pages.repartition(3)).count() == 0
    assert audit(pages.limit(0), pages.limit(0)).count() == 0
    # one copy of a repeated record less, and a damaged record without an id
    fewer = rows[:9001] + [(None, "u", "no ID", 1)] + rows[9003:]
    got = audit(pages, spark.createDataFrame(fewer, schema)).collect()
    assert sorted((r["page_id"] is None, r["status"]) for r in got) == [(False, "changed"), (True, "extra"), (True, "missing")]
