from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelkit.llm import binary_records as records
from panelkit.llm import byte_tokens
from panelkit.llm.queries import QUERIES
from panelkit.llm.registry import table

PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD = ["", "  a  b\n\n c \n d   ", "a\n \nb", "it's I'll we'd\nthey'RE", "<|endoftext|>hi <|endoftext|><|endoft", "日本語 текст ½ ²³ Ⅷ",
       " x  y　", "tab\t\t x\t y", "é" * 500, "a" * 3000, "!!!!!!!!!####  ----", "\x1c \x1d a\x85b", "👩‍👩‍👧 🇩🇪", "0123456789" * 30,
       " " * 100 + "x", "\nab\ncd ef\ngh", " ab cd", "ab cd ", "a​b c᠎d", "x\n", "\n", " ", "a b c 　d", "***\n$$$ word,\nNext"]


def plain_crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (records.POLYNOMIAL if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    crc = plain_crc32c(data)
    return ((crc >> 15 | crc << 17) + records.MASK_DELTA) & 0xFFFFFFFF


def test_ids_are_the_librarys(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_file(PATH)
    rng = np.random.default_rng(4)
    signs = list("abcdefghijklmnopqrstuvwxyz'   .,\n\tÀéß12309<|>")
    texts = ODD + ["".join(rng.choice(signs, rng.integers(1, 60))) for _ in range(1000)] + ["endless ornithorhynchus " * 4 + "end"] * 3
    for memo in (4, byte_tokens.MEMO):
        monkeypatch.setattr(byte_tokens, "MEMO", memo)
        for plain in (False, True):
            library.encode_special_tokens = plain
            coder = byte_tokens.ByteTokenizer(spec, plain)
            for _ in range(2):
                assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [
                    library.encode(t, add_special_tokens=False).ids for t in texts]


def test_checksums():
    assert plain_crc32c(b"123456789") == 0xE3069283
    rng = np.random.default_rng(1)
    data = [rng.bytes(2 * n) for n in (2, 3, 4, 255, 256, 257, 511, 512, 513, 2000)]
    got = records.masked_crc32c(b"".join(data), np.array([len(x) for x in data]))
    assert got.tolist() == [masked(x) for x in data]
    assert records.masked_crc32c(b"", np.zeros(0, np.int64)).tolist() == []


@pytest.mark.parametrize("top", [1000, 1 << 20])
def test_frames(top):
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, top, n).astype("<u4") for n in (0, 1, 2, 700)]
    keys = [None, -5, 7, 1 << 60]
    framed = records.frame(keys, [x.tobytes() for x in ids])
    for r in framed:
        size, = struct.unpack_from("<Q", r)
        assert len(r) == 8 + 4 + size + 4
        assert struct.unpack_from("<I", r, 8)[0] == masked(r[:8]) and struct.unpack("<I", r[-4:])[0] == masked(r[12:-4])
    back_keys, back = records.unframe(framed)
    assert back_keys == keys and all(np.array_equal(x, y) for x, y in zip(back, ids))
    for at in (0, 9, 13, 20, len(framed[3]) - 1):
        broken = bytearray(framed[3])
        broken[at] ^= 1
        with pytest.raises(ValueError, match="broken record"):
            records.unframe([bytes(broken)])


def expected(rows):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, ids))
    return out


def test_files_and_order(spark, documents, tmp_path):
    rows = [(i % 40, t) for i, t in enumerate(ODD)] + [(None, "null key"), (7, None), (3, ODD[3]), (3, ODD[3])] + [(5, "hot key")] * 300
    index = records.write_records(documents(rows).repartition(5), f"file://{tmp_path}/r", PATH)
    want = sorted(expected(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = records.read_records(index, f"file://{tmp_path}/r").collect()
    assert sorted([(r.key, list(r.ids)) for r in got], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) == want
    placed = records.with_start(index).orderBy("file_no", "row").collect()
    assert [r.key for r in placed] == [k for k, _ in want]
    assert [r.start for r in placed] == np.concatenate(([0], np.cumsum([r.n_ids for r in placed])[:-1])).tolist()
    assert records.unused_files(index, f"file://{tmp_path}/r") == []
    # The files alone, read from front to back, hold the same records.
    alone = []
    for name in dict.fromkeys(r.file for r in placed):
        data = (tmp_path / "r/data" / name).read_bytes()
        while data:
            size = struct.unpack_from("<Q", data)[0] + records.FRAME
            keys, ids = records.unframe([data[:size]])
            alone.append(keys[0])
            data = data[size:]
    assert alone == [r.key for r in placed]


def test_shuffled_and_filtered_reads(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 200)
    rows = [(i, f"text number {i} of many") for i in range(200)]
    folder = f"file:{tmp_path}/r"
    index = records.write_records(documents(rows), folder, PATH, end=None)
    assert index.select("file").distinct().count() >= 1
    orders = [[r.key for r in records.read_records(records.shuffled(index, seed), folder, in_order=True).collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2]) == list(range(200))
    some = records.read_records(index.where("key % 50 = 3"), folder).collect()
    library = Tokenizer.from_file(PATH)
    assert {r.key: list(r.ids) for r in some} == {i: library.encode(rows[i][1], add_special_tokens=False).ids for i in (3, 53, 103, 153)}


def test_broken_file_is_named(spark, documents, tmp_path):
    folder = f"{tmp_path}/r"
    index = records.write_records(documents([(1, "one"), (2, "two")]), folder, PATH)
    row = index.where("key = 2").first()
    file = tmp_path / "r/data" / row.file
    data = bytearray(file.read_bytes())
    data[row.offset + 25] ^= 4
    file.write_bytes(data)
    assert records.read_records(index.where("key = 1"), folder).count() == 1
    with pytest.raises(Exception, match=f"{row.file} at byte {row.offset}"):
        records.read_records(index, folder).collect()


def test_files_of_failed_attempts_are_not_read(spark, documents, tmp_path):
    folder = f"{tmp_path}/r"
    index = records.write_records(documents([(1, "one")]), folder, PATH)
    (tmp_path / "r/data/records-000000-0000-lost.bin").write_bytes(b"half a rec")
    assert records.unused_files(index, folder) == ["records-000000-0000-lost.bin"]
    assert records.read_records(index, folder).count() == 1


def test_empty_and_extra_columns(spark, documents, tmp_path):
    empty = records.write_records(documents([]), f"{tmp_path}/e", PATH)
    assert records.with_start(empty).collect() == [] and records.read_records(empty, f"{tmp_path}/e").collect() == []
    extra = documents([(1, "a")]).selectExpr("doc_id", "text", "1 as key", "2 as tie", "3 as row", "4 as file")
    index = records.write_records(extra, f"{tmp_path}/x", PATH)
    assert [(r.key, list(r.ids)) for r in records.read_records(index, f"{tmp_path}/x").collect()] == [(1, [64, 0])]


def test_query_matches_brute_force(spark, sf):
    library = Tokenizer.from_file(PATH)
    start, want = 0, {}
    for r in table(spark, sf, "documents").orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op13_binary_records"](spark, sf).collect()}
    assert got == want
