import hashlib
import re

from pyspark.sql import functions as F

from temperament.llm.exact_duplicates import digests, exact_duplicates, seen
from temperament.llm.mixing import mix, mixed_rows


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def check_exact(rows, got):
    groups = {}
    for name, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(name)
    assert len(got) == len(rows)
    for text, names in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        own = [r for r in got if r["text_sha256"] == digest]
        keep = max((n for n in names if n is not None), default=None)
        assert sorted((r["doc_id"] for r in own), key=repr) == sorted(names, key=repr)
        assert {(r["keep_id"], r["group_size"]) for r in own} == {(keep, len(names))}
        assert [r["doc_id"] for r in own if r["kept"]] == [keep]


def test_exact_odd_rows(docs, odd_rows):
    check_exact(odd_rows, exact_duplicates(docs(odd_rows)).collect())
    assert exact_duplicates(docs([])).count() == 0


def test_clashing_digests_are_told_apart_by_their_texts(docs):
    rows = [(i, f"text {i % 4}", "en", "a") for i in range(20)] + [(3, "text 3", "en", "a"), (30, "other", "en", "a")]
    weak = lambda text: F.unhex(F.sha2(F.substring(text, 1, 1), 256))
    got = [r for r in exact_duplicates(docs(rows), weak).collect() if r["doc_id"] != 30]
    check_exact([r for r in rows if r[0] != 30], got)


def test_state_is_kept_for_later_arrivals(spark, docs, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    for rows in ([(1, "a", "", ""), (2, "b", "", "")], [(5, "A", "", ""), (6, "c", "", "")]):
        digests(docs(rows)).write.mode("append").parquet(source)
        schema = spark.read.parquet(source).schema
        got = seen(spark.readStream.schema(schema).parquet(source), state).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in got) == [(2, 1), (5, 2), (6, 1)]


def targets(sizes):
    """Share by weight, cut at three times, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s] or not sizes[s]}
        if not over:
            return full | share
        full |= over


def test_mix_comes_near_its_targets(docs):
    rows = [(i, "w " * (1 + i * i % 37), "en", source) for i, source in enumerate(["a"] * 900 + ["b"] * 40 + ["c"] * 300 + [None] * 11 + ["é"] * 5)]
    sizes, longest = {}, {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
        longest[source] = max(longest.get(source, 0), len(text.split()))
    got = mix(docs(rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in mix(docs(rows).repartition(5)).collect())
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    want = targets(sizes)
    for source in sizes:
        own = [r for r in got if r["row"]["source"] == source]
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert all(abs(r["target"] - want[source]) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - want[source]) <= longest[source] / 2 + 1e-6
    assert mixed_rows(docs(rows)).count() == sum(r["copies"] for r in got)


def test_mix_prefers_what_it_is_told_to(docs):
    rows = [(i, "one two three", "en", "a" if i % 2 else "b") for i in range(2000)]
    liked = F.when(F.col("doc_id") < 1000, 1.5).otherwise(0.5)
    got = mix(docs(rows), preference=liked).collect()
    share = sum(r["taken"] for r in got if r["doc_id"] < 1000) / sum(r["taken"] for r in got)
    assert 0.7 < share < 0.8


def test_mix_odd_rows(docs, odd_rows):
    got = mix(docs(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert mixed_rows(docs(odd_rows)).columns == docs(odd_rows).columns
    assert mix(docs([])).count() == 0
