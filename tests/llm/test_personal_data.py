import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from temperament.llm import personal_data as personal
from temperament.llm import queries

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for at, d in enumerate(reversed(digits)):
        d = int(d) * (1 + at % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = {k: [] for k in personal.KINDS}
    for kind, pattern in zip(personal.KINDS, (EMAIL, IP, CARD, PHONE)):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out[kind].append((m.start(), m.end()))
    return out


TEXTS = [
    "a@b.c@d.e mail x.y@mail.example.com_z@q.w, é中 ü@ö.de m@n",
    "10.0.0.1 1234.5.6.7.8.9 255.255.255.255 256.1.1.1 1.2.3 000000255.1.2.3 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111-4 token 5555555555554444x é 6011000990139424",
    "+1 (415) 555-2671 +44 20 7946 0958. +1 ( +123 +12345678901234567 tel +49-30-1234567)",
    "\U0001f600 \U0001f600 a@b.co \U0001f600 +12345678 ",
    "9" * 3000 + " " + "1.2" * 800 + " " + "x." * 3000 + "@",
    "",
    None,
    "clean words only",
]


def test_base_spans_equal_plain_patterns(docs):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    for r in personal.find(docs(rows), {}).collect():
        for kind in personal.KINDS:
            want = base(r["text"])[kind]
            assert [(s["start"], s["stop"]) for s in r[f"base_{kind}"]] == want, (kind, r["text"][:80])
            assert [(s["start"], s["stop"]) for s in r[f"spans_{kind}"]] == want
    assert personal.find(docs([]), {}).count() == 0


@pytest.fixture(scope="module")
def corpus():
    rows = []
    for i in range(900):
        rows.append((i, f"call +1 (415) 555-{1000 + i} or mail p{i}@mail.example.com soon", "en", "a"))
        rows.append((1000 + i, f'key = "{hashlib.md5(str(i).encode()).hexdigest()}" and version 10{i % 7}.2.{i % 3}, item {i} at the end. Next {i}', "en", "a"))
    return rows


def test_trees_add_spans_and_keep_the_base(docs, corpus):
    models = personal.train(docs(corpus), sample=2000)
    assert "phone" in models
    rows = [
        (1, "call 1 (415) 555-1234 soon, or +1 (415) 555-9876 later", "en", "a"),
        (2, 'key = "0641917ea4e9feb9cda83477b57ac265" and clean words', "en", "a"),
        (3, None, None, None),
    ]
    got = {r["doc_id"]: r for r in personal.find(docs(rows), models).collect()}
    phones = [(s["start"], s["stop"]) for s in got[1]["spans_phone"]]
    assert (31, 48) in phones and (5, 21) in phones
    assert not got[2]["spans_phone"] and not got[2]["spans_card"]
    assert not got[3]["spans_email"]
    redacted = {r["doc_id"]: r["text"] for r in personal.redact(personal.find(docs(rows), models)).collect()}
    assert redacted[1] == "call [PHONE] soon, or [PHONE] later" and redacted[2] == rows[1][1] and redacted[3] == ""


def test_learns_from_all_documents(docs, corpus):
    rows = docs([(i, t, "en", "a") for i, t, *_ in corpus]).select("text")
    draw = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 30)) / (1 << 30)
    upper = [(i, r["text"], "en", "a") for i, r in enumerate(rows.where(draw > 0.5).collect())]  # what no sample of half of them has
    rest = [(10_000 + i, f"mail p{i}@mail.example.com soon", "en", "a") for i in range(9000)]
    assert 200 < len(upper) < 1600
    assert "phone" in personal.train(docs(upper + rest))


def test_nothing_to_learn_from(docs):
    assert personal.train(docs([(1, "no data", "en", "a"), (2, None, None, None)])) == {}


OWN_NAMES = ["_text", "__text", "_hits", "_gaps", "_sizes", "_stops", "_blocks", "_starts", "_merged", "_ends", "_reach", "_on_base"]


def test_columns_of_the_same_names_stay(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co", *OWN_NAMES)], ["doc_id", "text", *OWN_NAMES])
    models = {kind: ("x.f.length * 1.0D", 0.0) for kind in personal.KINDS}
    for row in (personal.find(docs, {}).first(), personal.find(docs, models).first()):
        assert [row[name] for name in OWN_NAMES] == OWN_NAMES
        assert [(s["start"], s["stop"]) for s in row["spans_email"]] == [(5, 11)]


def test_overlaps_equal_all_pairs(spark):
    draw = random.Random(7)

    def spans():
        cuts = sorted(draw.sample(range(4000), 2 * draw.choice([0, 1, 3, 40, 300, 700])))
        return [(a, b) for a, b in zip(cuts[::2], cuts[1::2])]

    rows = [(i, spans(), spans()) for i in range(60)]
    # the same start, the same span, and spans that only touch
    rows += [(60, [(1, 5), (5, 9)], [(1, 2), (2, 5), (5, 9)]), (61, [(1, 2), (7, 9)], [(1, 5), (5, 7), (9, 12)]), (62, [(0, 50)], [(3, 4), (9, 20)])]
    kind = "array<struct<start:int,stop:int>>"
    frame = spark.createDataFrame(rows, f"id int, base {kind}, wide {kind}")
    for r in personal._overlaps(frame, "hit", "base", "wide").collect():
        assert r["hit"] == [any(b[0] < x[1] and b[1] > x[0] for b in r["base"]) for x in r["wide"]], r["id"]


def test_time_follows_the_number_of_matches(docs):
    models = {kind: ("x.f.length * 1.0D", 0.0) for kind in personal.KINDS}

    def took(n):
        text = " ".join(f"10.0.{i % 256}.{i % 200} a{i}@b.co" for i in range(n))
        begun = time.time()
        row = personal.find(docs([(1, text, "en", "a")]), models).select(F.size("spans_ip").alias("ip"), F.size("base_email").alias("email")).first()
        assert (row["ip"], row["email"]) == (n, n)
        return time.time() - begun

    took(10)
    few, many = took(5_000), took(40_000)
    assert many < 4 * 8 * few  # 64 times with the square


def test_query_equals_plain_patterns(spark, docs, corpus, tmp_path):
    rows = [(10_000 + i, text, "en", "a") for i, text in enumerate(TEXTS)] + [(20_000, "1.2.3.4 " * 700 + "x@y.z", "en", "a")]
    docs(corpus + rows).select("doc_id", "text", "lang", "source").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op6_personal_data(spark, str(tmp_path)).collect()}
    assert len(got) == len(corpus) + len(rows)
    for doc_id, text, *_ in corpus + rows:
        row, want = got[doc_id], base(text)
        assert [row[f"n_{kind}"] for kind in personal.KINDS] == [len(want[kind]) for kind in personal.KINDS]
        named = [f"{kind}:{a}:{b}" for kind in personal.KINDS for a, b in want[kind]]
        assert row["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        listed = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        assert set(named) <= {":".join(s) for s in listed}
        assert listed == sorted(listed, key=lambda s: (personal.KINDS.index(s[0]), int(s[1])))
        for kind, a, b in listed:  # what was added overlaps nothing of the base
            assert f"{kind}:{a}:{b}" in named or not any(x < int(b) and y > int(a) for x, y in want[kind])
