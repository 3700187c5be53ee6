import random
import re

import numpy as np
import public_tokenizers
from plain import ODD_ROWS, docs

from partyfold.llm import wordpiece

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, first, following):
    count = at = 0
    while at < len(word):
        vocabulary = following if at else first
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in vocabulary), 0)
        if not size:
            return 1, True
        count, at = count + 1, at + size
    return count, False


def test_counts_are_those_of_greedy_pieces():
    rng = random.Random(0)

    def some(n):
        return {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 5))) for _ in range(n)}

    for _ in range(150):
        first, following = some(rng.randrange(8)), some(rng.randrange(10))
        automaton = wordpiece.Automaton(first, following)
        words = [bytes(rng.choice(b"abcd"[: rng.randrange(3, 5)]) for _ in range(rng.randrange(1, 10))) for _ in range(40)]
        ends = np.cumsum([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        counts, unknown = automaton.count(data, ends - [len(w) for w in words], ends)
        assert list(zip(counts.tolist(), unknown.tolist())) == [greedy(w, first, following) for w in words]


def test_whole_texts(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    names = [library.id_to_piece(i) for i in range(3 + 256, library.get_piece_size())]
    first = {n[1:].encode() for n in names if n.startswith("▁") and len(n) > 1 and n[1] != "▁"}
    following = {n.encode() for n in names if not n.startswith("▁")}
    word = re.compile(rb"[!-/:-@\[-`{-~]|[^\s!-/:-@\[-`{-~]+")
    rows = [*ODD_ROWS, (50, "The national anthem, d'accord? straße-42 ünïcödé 漢字"), (51, "ab" * 20_000)]
    expected = []
    for i, t in rows:
        counts = [greedy(w, first, following) for w in word.findall((t or "").encode()) if len(w) < 5000]
        expected.append((i, len(counts), sum(c for c, _ in counts), sum(u for _, u in counts)))
    found = [tuple(r) for r in wordpiece.token_counts(docs(spark, rows), PATH).collect()]
    assert sorted(map(str, [f for f in found if f[0] not in (6, 51)])) == sorted(
        map(str, [e for e in expected if e[0] not in (6, 51)])
    )
    assert {f[1] for f in found if f[0] in (6, 51)} == {1}
    assert wordpiece.token_counts(docs(spark, []), PATH).count() == 0
