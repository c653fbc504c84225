"""Vocabulary audit, benchmark passages and manifest against plain versions, on nulls, ties, repeats and long texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from temperament.llm import divergence as D
from temperament.llm import manifest as M
from temperament.llm import postings as P
from temperament.llm.transducer import Builder
from temperament.llm.words import LETTERS, words

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWERED))


TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZé 中1\n-_\U0001f600")), max_size=8), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_words_are_the_same_however_texts_are_cut(texts, size):
    found = [[] for _ in texts]
    for raw, starts, ends, _, owners in words([None if t is None else t.encode() for t in texts], LETTERS, size):
        for start, end, owner in zip(starts, ends, owners):
            found[owner].append(raw[start:end].tobytes().decode())
    assert found == [plain_words(t, TERM) for t in texts]


@given(st.sets(st.binary(min_size=1, max_size=6), max_size=60), st.lists(st.binary(min_size=1, max_size=6), max_size=20))
@settings(max_examples=60, deadline=None)
def test_transducer_gives_places(terms, others):
    builder, ordered = Builder(), sorted(terms)
    for term in ordered:
        builder.add(term)
    asked = [*ordered, *others]
    raw = np.frombuffer(b"".join(asked), np.uint8)
    stops = np.cumsum([len(t) for t in asked]).astype(np.int64)
    places = builder.build().places(raw, np.append(0, stops[:-1])[: len(asked)], stops)
    assert places.tolist() == [ordered.index(t) if t in terms else -1 for t in asked]


def test_transducer_is_minimal_and_wants_order():
    builder = Builder()
    for term in (b"baking", b"baling", b"making", b"maling"):
        builder.add(term)
    with pytest.raises(ValueError):
        builder.add(b"ab")
    assert builder.build().states == 7  # one path for all: b|m, a, k|l, i, n, g


def plain_divergence(rows, least, top):
    groups = {(r[2] or "", r[3] or "") for r in rows}
    documents, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = plain_words(text, TERM)
        documents[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for at, s in groups if at == lang]

        def shares(count):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        common = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (own[s][t] - common[t]) ** 2 // common[t]) for t in kept if counts[lang, s][t] and own[s][t] > common[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)}
    return out


def divergences(frame, **options):
    rows = [tuple(r) for r in D.divergence(frame, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence_on_odd_rows(docs, odd_rows):
    rows = odd_rows + [(20 + i, "tie other tie words ü Ü ünder", "en", s) for i, s in enumerate("abcabc")] + [(30, "x", "fr", "a"), (31, "y", "fr", "b")]
    assert divergences(docs(rows), least=2, top=4) == plain_divergence(rows, 2, 4)


def test_divergence_in_small_chunks_and_blocks(docs, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_WORDS", 40)
    monkeypatch.setattr(D, "BLOCK_ORDINALS", 5)
    rows = [(i, " ".join(f"w{chr(97 + (i * k) % 26)}{chr(97 + k % 7)}" for k in range(i % 17)), "en", f"s{i % 3}") for i in range(300)]
    assert divergences(docs(rows), least=3, top=10) == plain_divergence(rows, 3, 10)


def test_divergence_of_nothing(docs):
    assert divergences(docs([])) == set()


def test_shares_of_very_large_counts():
    counts = np.array([0, 5 * 10**15, 4 * 10**18], np.int64)
    assert D._share(counts, 4 * 10**18 + 7).tolist() == [1 + 10**9 * (int(c) + 1) // (4 * 10**18 + 7) for c in counts]


def plain_hits(texts, items, width):
    phrases = {}
    for item, text in items:
        found = plain_words(text, WORD)
        span = min(width, len(found))
        for i in range(len(found) - span + 1 if span else 0):
            phrases.setdefault(tuple(found[i : i + span]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in texts:
        found, hit, held = plain_words(text, WORD), set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(found) - size + 1):
                owners = phrases.get(tuple(found[i : i + size]))
                if owners:
                    hit |= set(range(i, i + size))
                    held |= owners
        out.append((doc_id, len(found), len(hit), len(held), tuple(sorted(held)), bool(hit)))
    return sorted(out, key=repr)


def hits(frame, items, width=10):
    found = P.contamination(frame, items, "item_id", width).drop("row").collect()
    return sorted(((r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in found), key=repr)


ITEMS = "item_id bigint, text string, row string, phrase int, words string"


def test_contamination_on_odd_rows(spark, docs, odd_rows):
    items = [(1, "Word5x5 word6x6 word7x7 word8x8"), (10, "in this short TEXT"), (2, "again"), (2, "again"), (3, None), (4, ""), (None, "all but"), (5, "no such words")]
    rows = odd_rows + [(40, "again, again in this short", "en", "a"), (41, "again again again in this short text", "en", "a")]
    frame = spark.createDataFrame([(*i, "r", 1, "w") for i in items], ITEMS)
    for width in (1, 3, 10):
        assert hits(docs(rows), frame, width) == plain_hits([r[:2] for r in rows], items, width)


def test_contamination_of_nothing(spark, docs, odd_rows):
    none = spark.createDataFrame([], ITEMS)
    assert hits(docs([]), none) == []
    assert hits(docs(odd_rows), none) == plain_hits([r[:2] for r in odd_rows], [], 10)


def test_matches_across_segments_and_none_across_documents(spark, docs):
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [(i, " ".join(["filler"] * (P.SEGMENT - 6 + 3 * i)) + f" {passage} end") for i in range(4)] + [(9, "p0 p1 p2 p3 p4"), (10, "p5 p6 p7 p8 p9")]
    texts.append((11, "\n".join(["filler"] * 200_000 + passage.split())))
    frame = docs([(*t, "en", "a") for t in texts]).coalesce(1)
    items = spark.createDataFrame([(1, passage, "r", 1, "w")], ITEMS)
    assert hits(frame, items) == plain_hits(texts, [(1, passage)], 10)


def test_many_phrases_go_out_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 2000)
    items = [(i, " ".join(f"t{(i * k) % 23}" for k in range(14))) for i in range(30)]
    texts = [(i, " ".join(f"t{(i * k + j) % 23}" for j in range(2) for k in range(40))) for i in range(40)]
    frame = spark.createDataFrame([(*i, "r", 1, "w") for i in items], ITEMS)
    found = hits(docs([(*t, "en", "a") for t in texts]), frame, 4)
    assert found == plain_hits(texts, items, 4) and any(r[-1] for r in found)


def test_proximity(spark, docs):
    texts = [(1, "a x b y a c"), (2, "c b a a"), (3, "a b c"), (4, "a a q q q q b c"), (5, "b c a"), (6, "a c"), (7, "b a b a c x x a")]
    wanted = spark.createDataFrame([(1, "a a b c", "r", 1, "w"), (2, "c a", "r", 1, "w")], ITEMS)
    stored, asked = P.index(docs([(*t, "en", "a") for t in texts]).coalesce(1)), P.phrases(wanted, "item_id", 4)
    for within in (4, 5, 6):
        found = P.matches(stored, asked, within).join(asked, "phrase").join(P.documents(stored), "row")
        got = {(r["doc_id"], r["item"], r["start"], r["stop"]) for r in found.collect()}
        plain = set()
        for doc_id, text in texts:
            body = text.split()
            for item, phrase in (("1", "aabc"), ("2", "ca")):
                need = Counter(phrase)
                whole = [(i, j) for i in range(len(body)) for j in range(i + 1, min(len(body), i + within) + 1) if not need - Counter(body[i:j])]
                plain |= {(doc_id, item, i, j) for i, j in whole if not any((a, b) != (i, j) and a >= i and b <= j for a, b in whole)}
        assert got == plain
    with pytest.raises(ValueError):
        P.matches(stored, asked, P.OVERLAP + 2)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    def written(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    doc_id, source, lang, chars, text = row
    return digest(*map(written, (doc_id, source, lang, None if chars is None else chars + more, text)))


def plain_levels(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def wrong(row):
        return int(row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = plain_levels([plain_leaf(r) for r in by_lang[lang]])
    top, out = plain_levels([trees[lang][-1][0] for lang in langs]) if langs else [], []
    for rank, lang in enumerate(langs):
        for place, row in enumerate(by_lang[lang]):
            folded, proof = plain_leaf(row, wrong(row)), ""
            for levels, at in ((trees[lang], place), (top, rank)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof, folded, at = proof + other, digest(other, folded) if at & 1 else digest(folded, other), at >> 1
            root = top[-1][0]
            out.append((row[0], trees[lang][0][place], trees[lang][-1][0], root, digest(proof), folded, folded == root))
    return sorted(out, key=repr)


def manifests(frame):
    wrong = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted(map(tuple, M.verify(M.build(M.leaves(frame, wrong))).collect()), key=repr)


def test_manifest_on_odd_rows(docs, odd_rows):
    rows = [*odd_rows, (50, "one", "it", "a"), (51, "t", "fr", None), (51, "t", "fr", None), (51, "u", "fr", "b"), (52, "v", "fr", "b")]
    assert manifests(docs(rows)) == plain_manifest([(r[0], r[3], r[2], 1, r[1]) for r in rows])
    nulls = docs(rows).withColumn("n_chars", F.lit(None).cast("long"))
    assert manifests(nulls) == plain_manifest([(r[0], r[3], r[2], None, r[1]) for r in rows])
    assert all(r[-1] for r in manifests(nulls))


def test_manifest_of_one_row_and_of_none(docs):
    assert manifests(docs([(3, "x", None, "s")])) == plain_manifest([(3, "s", None, 1, "x")])
    assert manifests(docs([])) == []


@pytest.mark.parametrize("step", [1, 2, 3])
def test_manifest_climbs_several_skip_links(docs, monkeypatch, step):
    monkeypatch.setattr(M, "STEP", step)
    rows = [(i, f"text {i}", None if i % 19 == 0 else ("en", "de", "fr", "en", "it")[i % 5], "s") for i in range(87)]
    plain = plain_manifest([(r[0], r[3], r[2], 1, r[1]) for r in rows])
    assert manifests(docs(rows)) == plain and not all(r[-1] for r in plain)


def test_every_node_has_its_parent(docs):
    nodes = M.build(M.leaves(docs([(i, f"t{i}", "en" if i % 3 else "de", "s") for i in range(41)])))
    up = nodes.select(*[F.col(c).alias(f"parent_{c}") for c in ("tree", "level", "pos")], F.col("hash").alias("above"))
    linked = nodes.join(up, ["parent_tree", "parent_level", "parent_pos"])
    assert linked.count() == nodes.count() - 1
    # the root of a language is the same node as its leaf in the tree above
    assert linked.where(f"parent_tree = '{M.TOP}' AND parent_level = 0 AND hash <> above").count() == 0
    joined = linked.where(f"parent_tree <> '{M.TOP}' OR parent_level > 0").groupBy("parent_tree", "parent_level", "parent_pos", "above").agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.lower(F.hex(p["hash"]))), "")
    assert joined.where(F.unhex(F.sha2(text, 256)) != F.col("above")).count() == 0
