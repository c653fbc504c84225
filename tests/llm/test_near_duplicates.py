import random
import re

import pytest

from temperament.llm import near_duplicates as near
from temperament.llm.components import components


def brute(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        count = max(len(words) - 4, 1) if words else 0
        sets.append({tuple(words[i : i + 5]) for i in range(count)})
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    out = []
    for i, (name, _) in enumerate(rows):
        own = least.get(find(i)) if sets[i] else name
        out.append((name, len(sets[i]), own, name == own))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in near.near_duplicates(frame).collect()), key=repr)


def edited(words, share, draw):
    return [w if draw.random() > share else f"new{draw.randrange(10**6)}" for w in words]


@pytest.mark.parametrize("block", [8, 1024])
def test_equals_brute_force(spark, monkeypatch, block):
    """Chains of edits, a passage that all share, short texts; small blocks so that the block step does real work."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "CENTRES", 1)
    draw = random.Random(block)
    passage = [f"shared{i}" for i in range(60)]
    texts = []
    for group in range(6):
        words = [f"g{group}w{draw.randrange(400)}" for _ in range(draw.choice([9, 60, 300]))]
        for _ in range(25):
            words = edited(words, 0.02, draw)
            texts.append(" ".join(words))
    for i in range(60):
        own = [f"d{i}w{j}" for j in range(draw.choice([15, 30, 90]))]
        texts.append(" ".join(own + passage))
    texts += ["one two", "one  two", "one two three", None, "", texts[0].upper()]
    rows = list(zip(draw.sample(range(1000), len(texts)), texts))
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == brute(rows)


def test_odd_rows(docs, odd_rows):
    assert found(docs(odd_rows)) == brute([r[:2] for r in odd_rows])
    assert found(docs([])) == []


def test_components_of_chains_and_loops(spark):
    links = [(b"%03d" % i, b"%03d" % (i + 1)) for i in range(40)] + [(b"900", b"901"), (b"950", b"950")]
    got = dict(tuple(map(bytes, r)) for r in components(spark.createDataFrame(links, "one binary, two binary")).collect())
    assert got == {b"%03d" % i: b"000" for i in range(41)} | {b"900": b"900", b"901": b"900", b"950": b"950"}


def test_narrow_tables_are_written_in_few_files(spark, monkeypatch):
    """Many shuffle partitions must not mean many files: an executor starts processes for the rights of each."""
    from pathlib import Path

    from temperament import session

    draw = random.Random(5)
    rows = [(i, " ".join(str(draw.random()) for _ in range(30))) for i in range(200)]
    rows += [(1000 + i, "one passage that all of these share " * 2 + "a b c d e f g h i j k l m n o p q r s t u v w x y z " + f"end {i}") for i in range(200)]
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    written = []
    monkeypatch.setattr(session, "_WRITTEN", written)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    cores, seen = spark.sparkContext.defaultParallelism, set()
    for path in map(Path, written):
        kind = re.sub(r"-[0-9a-f]{32}$", "", path.name)
        if kind not in ("near-marks", "near-needed", "near-more"):  # as many as there are inputs, and blocks
            assert len(list(path.glob("part-*"))) <= cores, kind
            seen.add(kind)
    assert {"near-classes", "near-lists", "near-pairs", "near-links", "near-centres-ids", "near-centres-sets", "components"} <= seen
