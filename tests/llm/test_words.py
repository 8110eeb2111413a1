import numpy as np

from ledgerlake.llm import words as w


def test_equal_words_have_equal_hashes_and_others_not(monkeypatch):
    rng = np.random.default_rng(0)
    vocabulary = [bytes(rng.integers(33, 256, rng.integers(1, 12), dtype=np.uint8)) for _ in range(3000)] + [b"a", b"aa", b"\x00", b"x" * 70_000, b"y" * 70_000, b"x" * 70_001]
    seen: dict[bytes, int] = {}
    for span in (w.SPAN, 100):
        monkeypatch.setattr(w, "SPAN", span)
        for size in (0, 1, 7, 5000):
            text = b" \n".join(vocabulary[k] for k in rng.integers(0, len(vocabulary), size)) + b"\t" * int(rng.integers(0, 2))
            value, start, end = w.word_hashes(text)
            assert [text[a:b] for a, b in zip(start, end)] == text.split()
            for word, v in zip(text.split(), value.tolist()):
                assert seen.setdefault(word, v) == v
    assert len(set(seen.values())) == len(seen)
    assert len(w.word_hashes(None)[0]) == len(w.word_hashes(b" \n")[0]) == 0


def test_runs():
    value = w.word_hashes(b"a b c a b c d")[0]
    three = w.runs(value, 3)
    assert len(three) == 5 and three[0] == three[3] and len(set(three.tolist())) == 4
    assert w.runs(value, 1)[0] != w.runs(value, 2)[0]
