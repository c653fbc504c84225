import hashlib
import os
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
import pyarrow.parquet as pq  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from temperament.llm import bpe, subwords, token_files  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_merges_equal_the_library(library, monkeypatch):
    draw = random.Random(1)
    letters = " \n\t'  sdrevlm1²½éA.-!中\x1c\x85​"
    texts = ["", "aaaaaaa", "a<|endoftext|> b<|endoftext|><|endoftext|>", "it's we're I'll 's ''s x'sabc 'll've'd"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(3000)]
    texts += [f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)} '{chr(c)}s" for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    tables = bpe.MergeTables(open(PATH, encoding="utf-8").read())
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tables.encode(texts)] == want
    # small pieces and a memory that overflows change nothing
    monkeypatch.setattr(subwords, "REMEMBERED", 50)
    monkeypatch.setattr(subwords.grouped_pieces, "__defaults__", (40,))
    assert [x.tolist() for x in tables.encode(texts)] == want
    assert [tables.decode(np.array(x)) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_memory_of_many_words():
    # words of equal low bits, and more than the first table holds
    draw = np.random.default_rng(1)
    hashes = draw.permutation(np.unique(np.append(draw.integers(1, 1 << 63, 90_000), np.arange(1, 40) << 40)).astype(np.uint64))
    sizes = draw.integers(0, 5, len(hashes))
    ids = [draw.integers(0, 9, n).astype(np.int32) for n in sizes]
    memory, want = subwords.WordMemory(), {}
    for part in np.array_split(np.arange(len(hashes)), 7):
        assert (memory.numbers(hashes[part]) == -1).all()
        memory.add(hashes[part], np.concatenate([ids[i] for i in part]), sizes[part])
        want.update((int(hashes[i]), ids[i].tolist()) for i in part)
    asked = draw.integers(0, len(hashes), 5000)
    flat, counts = memory.ids(memory.numbers(hashes[asked]))
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [want[int(h)] for h in hashes[asked]]

    # half a million words are given to the tokenizer once each
    given = []

    def encode_words(words):
        given.extend(words)
        return np.arange(len(words), dtype=np.int32), np.ones(len(words), np.int64)

    memory, texts = subwords.WordMemory(), [" ".join(f"w{'abcdefghij'[i % 10]}{chr(0x4E00 + i // 1000)}{chr(0x4E00 + i % 1000)}" for i in range(500_000))]
    [first], [again] = (subwords.encode_texts(texts, encode_words, memory, {}) for _ in range(2))
    assert len(given) == len(set(given)) == 500_000 and first.tolist() == again.tolist()


def test_memory_that_overflows(library, monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 50)
    monkeypatch.setattr(subwords.grouped_pieces, "__defaults__", (40,))
    draw = random.Random(2)
    texts = [" ".join("".join(draw.choice("abé") for _ in range(draw.randrange(1, 6))) for _ in range(draw.randrange(40))) for _ in range(200)]
    tables, memory = bpe.MergeTables(open(PATH, encoding="utf-8").read()), subwords.WordMemory()
    got = subwords.encode_texts([*texts, "ab" * 500 + "1b2!" * 500], tables.merge_words, memory, {})
    assert [x.tolist() for x in got] == [e.ids for e in library.encode_batch([*texts, "ab" * 500 + "1b2!" * 500], add_special_tokens=False)]
    assert memory.count <= 50


def test_lines_of_words_equal_the_library(library):
    texts = [" ".join(w) for w in (["Straße", "naïve", "ǅungla", "ſhip", "ȿ", "ɐb", "ªº", "µm", "Ċ", "aĊb", "Ġx", "×", "÷"], ["Ċ" * 3, "Ġ" * 2])]
    texts += ["\n\nĊ\nĠ \n", "aĊ\nĊb  Ċ", "".join(map(chr, range(0x250))), " ".join(map(chr, range(0x21, 0x250)))]
    encode_words, special = token_files._encoder(library.to_str(), b"lines")
    got = subwords.encode_texts(texts, encode_words, subwords.WordMemory(), special)
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_decode_of_broken_bytes():
    tables = bpe.MergeTables(open(PATH, encoding="utf-8").read())
    half = int(tables.byte_id[0xC3])
    assert tables.decode(np.array([half])) == "�"


def test_round_trip_of_odd_rows(docs, odd_rows, library):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(docs(odd_rows), PATH).collect()}
    want = set()
    for name, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.add((name, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == want
    assert bpe.round_trip(docs([]), PATH).count() == 0
    encoded = bpe.encode(docs(odd_rows), PATH)
    assert [r["text"] for r in bpe.decode(encoded, PATH).collect()] == [r[1] or "" for r in odd_rows]
    checked = bpe.encode_checked(docs(odd_rows), PATH).collect()
    assert all(r["restored"] and r["n_tokens"] == len(r["ids"]) for r in checked)


def test_token_files_of_odd_rows(spark, docs, odd_rows, library, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(odd_rows), path, PATH, files=3)
    got = token_files.with_checksums(token_files.read_tokens(spark, path)).orderBy("start").collect()
    start, want = 0, []
    for name, text in sorted(((r[0], r[1]) for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((name, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    rows = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert [r["doc_id"] for r in got] == [w[0] for w in want]
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    token_files.write_tokens(docs([]), str(tmp_path / "none"), PATH)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_layout_of_the_files(spark, docs, odd_rows, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(odd_rows), path, PATH, files=1)
    part = next(os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
    columns = pq.ParquetFile(part).metadata.row_group(0)
    for at in range(columns.num_columns):
        column = columns.column(at)
        assert "DELTA_BINARY_PACKED" in column.encodings and "PLAIN_DICTIONARY" not in column.encodings
        assert column.has_offset_index
