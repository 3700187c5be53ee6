import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from plain import ODD_ROWS, docs

from partyfold.llm import sentencepieces
from partyfold.llm.words import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepieces.Pieces(PATH, remember=500)


def encode(texts, model, portion=1 << 20):
    found, back = [], []
    for part in pieces(pa.array(texts, pa.large_string()), portion):
        ids, bounds = sentencepieces.encode_portion(part, model)
        found += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        back += sentencepieces.decode_ids(ids, bounds, model)
    return found, back


def plain_best(text, model, scores):
    """The highest sum of scores of one text, by dynamic programming over characters."""
    text = " " + text.replace("▁", " ") if text else ""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 48), end):
            piece = text[start:end]
            if piece in scores:
                best[end] = max(best[end], best[start] + scores[piece])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + model.unknown)
    return best[-1]


@pytest.fixture(scope="module")
def scores(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return {model.bytes[i].decode(): library.get_score(int(i)) for i in model.ids}


ALPHABET = ["a", "b", " ", "é", "漢", "🙂", "▁", "\n", "th", "er", "tion", "  ", "0"]


def texts(n=300):
    rng = random.Random(2)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(n)]
    return [*made, "", " ", "   a  ", "the" * 60, "x" * 300 + "é", "<s> </s> <0x0A>"]


def test_the_sum_of_scores_is_the_highest(model, scores):
    by_id = {int(i): s for i, s in zip(model.ids, model.scores)}
    some = texts()
    for text, ids in zip(some, encode(some, model)[0]):
        unknown = sum(1 for c in text.replace("▁", " ") if c not in scores)
        total = sum(by_id.get(i, 0.0) for i in ids) + unknown * model.unknown
        assert total == pytest.approx(plain_best(text, model, scores), rel=1e-12)


def test_no_cut_of_the_library_has_a_higher_sum(model, scores):
    raw = open(PATH, "rb").read()
    at = raw.rfind(b"tok_v0\x18\x02")  # the same pieces and scores, marked as a unigram model
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"tok_v0\x18\x01" + raw[at + 8 :])
    words = [w for w in ("the", "and", "nation", "erthly", "straße", "Ciónue", "Éauaux") if all(c in scores for c in w)]
    by_id = {int(i): s for i, s in zip(model.ids, model.scores)}
    for ours, theirs in zip(encode(words, model)[0], library.encode(words)):
        assert sum(by_id[i] for i in ours) >= sum(by_id[i] for i in theirs)


def test_portions_and_memory_change_nothing(model):
    some = texts()
    whole = sentencepieces.Pieces(PATH)
    assert encode(some, model, 50) == encode(some, whole, 1 << 20)


def test_round_trip(model):
    some = texts()
    assert encode(some, model)[1] == [t.replace("▁", " ") for t in some]


def test_ids_outside_the_model_are_an_error(model):
    with pytest.raises(ValueError, match="outside"):
        sentencepieces.decode_ids(np.array([32000]), np.array([0, 1]), model)
    assert sentencepieces.decode_ids(np.array([1, 2]), np.array([0, 2]), model) == [""]


def test_tables(spark):
    table = docs(spark, ODD_ROWS)
    ids = sentencepieces.encoded(table, PATH, checksum="crc", portion=1000)
    assert ids.columns == ["doc_id", "lang", "node", "label", "chunk", "ids", "crc"]
    for row in ids.collect():
        raw = None if row["ids"] is None else zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        assert row["crc"] == raw
    back = sentencepieces.decoded(ids, PATH, portion=10).select("doc_id", "text").collect()
    expected = [(i, t if t is None else t.replace("▁", " ")) for i, t in ODD_ROWS]
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, expected))
    assert sentencepieces.decoded(sentencepieces.encoded(docs(spark, []), PATH), PATH).count() == 0
