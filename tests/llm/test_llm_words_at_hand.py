"""Words at hand: the common ones stay, whenever they came first, and lattices have every piece that fits."""

import numpy as np
from pytest import approx

from starloom.llm import segmentations


def _edges(words, word):
    number = words.index[word]
    place = np.arange(words.begin[number], words.begin[number + 1])
    edge, ends = words.edges(place)
    return [
        sorted(zip(words.size[e].tolist(), words.piece[e].tolist(), words.log[e].tolist(), words.cum[e].tolist()))
        for e in (edge[a:b] for a, b in zip(ends[:-1], ends[1:]))
    ]


def test_common_words_stay_at_hand(monkeypatch):
    monkeypatch.setattr(segmentations, "WORDS", 60)
    monkeypatch.setattr(segmentations, "CORE", 20)
    words = segmentations.Words(segmentations.vocabulary(segmentations.MODEL))
    words.numbers([f" rare{k}" for k in range(50)])
    common = [f" common{k}" for k in range(20)]
    words.numbers(common * 3)
    made = {x: _edges(words, x) for x in common}
    for k in range(6):
        # Over the limit: the next call forgets.
        words.numbers([f" new{k}x{j}" for j in range(50)])
        words.numbers(common[:1])
        assert all(x in words.index for x in common)
        assert list(words.index.values()) == list(range(len(words.index)))
        assert len(words.begin) == len(words.index) + 1 == len(words.came) + 1
        assert {x: _edges(words, x) for x in common} == made


def test_lattices_have_every_piece_that_fits():
    v = segmentations.vocabulary(segmentations.MODEL)
    words = segmentations.Words(v)
    model = v.model
    pieces = {model.id_to_piece(i): i for i in v.ids.tolist()}
    given = [" internationalisation", " der", "\n", "  ", " Straße", " 日本語", " ▁x", " 1234567890", " " + "ab" * 60]
    words.numbers(given)
    for word in given:
        marked = word.replace("▁", "\ue000").replace(" ", "▁")
        for at, edges in enumerate(_edges(words, word)):
            fit = {(k - at, pieces[marked[at:k]]) for k in range(at + 1, len(marked) + 1) if marked[at:k] in pieces}
            assert {(size, piece) for size, piece, *_ in edges if piece >= 0} == fit
            assert sum(np.exp(log) for *_, log, _ in edges) == approx(1)
