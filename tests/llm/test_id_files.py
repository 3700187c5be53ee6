import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from plain import ODD_ROWS, docs
from tokenizers import Tokenizer

from partyfold.llm import id_files
from partyfold.llm.byte_bpe import ByteBpe
from partyfold.llm.storage import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(library):
    rng = random.Random(3)
    parts = [
        " ", "  ", "\n", "\t", "'s", "'re", "'ll", "'", "a", "é", "Z", "1", "²", "!", "?", "''", "s", "漢", "\xa0",
        "🙂", "ª", "x'd", "...", "<|endoftext|>", "ſ", "’", "　", "\x85", "\x1c", " \n ", " ", "​",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(2500)]
    plain = [t for t in texts if all(ord(c) < 0x250 for c in t)]
    encoder = ByteBpe(PATH, remember=50)
    for some in (texts, plain, plain[:3], [*plain[:5], "\U0010ffff"], ["", " ", "a "]):
        ids, bounds = encoder.encode(some)
        found = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert found == [encode(library, t) for t in some]


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [1, 2, 3], [7, 7, 1000, 10**9], list(range(0, 90_000, 3))])
def test_elias_fano(values):
    code = id_files.EliasFano.of(np.array(values, np.int64))
    assert code.values().tolist() == values
    for i in random.Random(1).sample(range(len(values)), min(len(values), 200)):
        assert code[i] == values[i]
    with pytest.raises(IndexError):
        code[len(values)]
    if len(values) > 1000:
        stored = len(code.low) + len(code.high) + 4 * len(code.samples)
        assert stored < len(values)  # an eighth of a table of 64-bit numbers
    with pytest.raises(ValueError):
        id_files.EliasFano.of(np.array([3, 2]))


@pytest.mark.parametrize("width", [2, 4])
def test_a_file_is_read_document_by_document(width):
    doc_ids, sizes = [None, 3, -4, 3], [1, 0, 5, 2]
    ids = np.arange(8, dtype=np.uint32) * 7
    raw = io.BytesIO()
    id_files.write_file(raw, doc_ids, np.cumsum(sizes), ids, width)
    raw.seek(0)
    found = id_files.IdFile(raw)
    assert [None if m else d for d, m in zip(found.doc_ids.tolist(), found.missing)] == doc_ids
    assert [found.bounds(i) for i in range(4)] == [(0, 1), (1, 1), (1, 6), (6, 8)]
    assert found.ids(*found.bounds(2)).tolist() == [7, 14, 21, 28, 35]
    with pytest.raises(ValueError, match="not an id file"):
        id_files.IdFile(io.BytesIO(b"\0" * 100))


@pytest.mark.parametrize("file_ids", [1, 1 << 25])
def test_documents_come_back_in_order(spark, library, file_ids):
    path = shared_dir(spark)
    table = docs(spark, ODD_ROWS).repartition(3)
    found = id_files.read_ids(id_files.write_ids(table, path, PATH, 2, file_ids), path, batch_ids=50).collect()
    expected, start = [], 0
    for i, t in sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = encode(library, t) + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_empty_table(spark):
    assert id_files.round_trip(docs(spark, []), PATH, 2).count() == 0


def test_slices_of_boundaries_are_those_of_the_whole():
    rng = np.random.default_rng(7)
    values = np.cumsum(rng.choice([0, 1, 5, 3000], 2000))
    code = id_files.EliasFano.of(values)
    for first, end in [(0, 0), (0, 1), (0, 2000), (1999, 2000), (255, 257), (700, 701), (300, 1800)]:
        assert code.slice(first, end).tolist() == values[first:end].tolist()


def test_files_are_read_in_portions_found_by_select(spark, tmp_path):
    rows = [(i, "word " * (i % 50)) for i in range(300)]
    whole = id_files.write_ids(docs(spark, rows), str(tmp_path / "ids"), PATH, 2).cache()
    key = lambda df: sorted(tuple(r) for r in df.collect())
    some = key(id_files.read_ids(whole, str(tmp_path / "ids"), batch_ids=64))
    assert some == key(id_files.read_ids(whole, str(tmp_path / "ids"))) and len(some) == 300
