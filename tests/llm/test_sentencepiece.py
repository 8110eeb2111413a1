import math
import random
import struct

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import sentencepiece_codec as c

from .helpers import crowded, documents

MODEL = c.load()
CODEC = c.Codec(MODEL, cache=50)
TEXTS = ["", " ", "a", "  two  spaces ", "line\nbreak\n\n", "Thing ontion éeux ñció 12345", "▁ escape ▁▁ sign", "日本語 🙂‍ x", "\x00\x01\t", "word " * 50,
         "�", "a▁b c", "nbsp x"]


def _message(number: int, value) -> bytes:
    def varint(v):
        out = b""
        while v > 127:
            out += bytes([v & 127 | 128])
            v >>= 7
        return out + bytes([v])
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def unigram_library():
    """The library's own unigram search over the same pieces and scores."""
    pieces, _ = c.read_model(MODEL)
    out = b"".join(_message(1, _message(1, p.encode()) + _message(2, float(s)) + _message(3, t)) for p, s, t in pieces)
    for number, value in c._fields(MODEL):
        if number == 2:
            trainer = b"".join(_message(n, 1 if n == 3 else v) for n, v in c._fields(value) if not (isinstance(v, bytes) and n in (10, 15)))
            out += _message(2, trainer + (b"" if dict(c._fields(value)).get(3) else _message(3, 1)))
        elif number == 3:
            out += _message(3, value)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def brute(text):
    """Plain dynamic programme over all substrings; the best score."""
    pieces, _ = c.read_model(MODEL)
    score = {p: s for p, s, t in pieces if t == c.NORMAL}
    longest, text = max(map(len, score)), c.SPACE + text.replace(" ", c.SPACE)
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + CODEC.unknown
        for start in range(max(0, end - longest), end):
            if text[start:end] in score:
                best[end] = max(best[end], best[start] + score[text[start:end]])
    return best[-1]


def own_score(ids):
    pieces, _ = c.read_model(MODEL)
    total, run = 0.0, b""
    for k in ids:
        if pieces[k][2] == c.BYTE:
            run += bytes([int(pieces[k][0][1:-1], 16)])
            try:
                run.decode()
                total, run = total + CODEC.unknown, b""
            except UnicodeDecodeError:
                pass
        else:
            total += pieces[k][1]
    return total


@pytest.mark.parametrize("text", [t for t in TEXTS if c.SPACE not in t and t])
def test_best_score(text):
    assert own_score(CODEC.encode(text)) == pytest.approx(brute(text), rel=1e-9)


def test_against_the_librarys_unigram_search():
    library, rng = unigram_library(), random.Random(3)
    words = ["the", "ontion", "éeux", "ción", "Aß", "x9", "token", "\n", "zürich", "日", "of", "running"]
    same = total = 0
    for _ in range(200):
        text = " ".join(rng.choices(words, k=rng.randrange(1, 12)))
        theirs, mine = library.encode(text), CODEC.encode(text)
        total += 1
        same += theirs == mine
        assert own_score(mine) >= own_score(theirs) - 1e-3
    assert same >= 0.95 * total  # ties may be broken otherwise


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(TEXTS), max_size=4).map("".join))
def test_round_trip(text):
    assert CODEC.decode(CODEC.encode(text)) == text


def test_chunks_do_not_change_the_best_path():
    whole = c.Codec(MODEL)
    whole.split = False
    for text in TEXTS:
        assert own_score(whole.encode(text)) == pytest.approx(own_score(CODEC.encode(text)))


def test_decodes_as_the_library():
    theirs = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in TEXTS[5:6] + ["The quick brown fox", "a  b"]:
        assert theirs.decode(CODEC.encode(text)) == text and CODEC.decode(theirs.encode(text)) == text


def test_table(spark):
    texts = [None, *TEXTS, "long " * 60_000]
    docs = documents(spark, [*enumerate(texts), (3, texts[3])])
    got = c.encode(crowded(docs), MODEL, check=True).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = texts[r.doc_id]
        assert r.exact is (None if text is None else True)
        assert r.token_ids == (None if text is None else CODEC.encode(text)) and r.n_tokens == len(r.token_ids or [])
    encoded = c.encode(docs, MODEL)
    assert sorted(c.decode(encoded, MODEL).collect(), key=repr) == sorted(((i, texts[i]) for i in [*range(len(texts)), 3]), key=repr)
    assert c.encode(docs.limit(0), MODEL).count() == 0


def test_refuses_what_cannot_be_exact():
    with pytest.raises(ValueError):
        c.read_model(_message(1, _message(1, b"a")) + _message(3, _message(2, b"map")))
