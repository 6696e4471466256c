"""What an encoder keeps stays small: workers hold it between tasks and through stages without encoding."""

import base64
import random
import string
import sys

import public_tokenizers
import pyarrow as pa
import tiktoken

from lintel.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _kept(encoder) -> int:
    """Bytes of all stores of pieces, prefixes and pairs with their entries; small numbers are shared."""
    stores = [x for owner in (encoder, encoder.vocabulary) for x in vars(owner).values() if isinstance(x, dict)]
    return sum(sys.getsizeof(s) + sum(sys.getsizeof(k) + (sys.getsizeof(v) if isinstance(v, (list, bytes)) else 0) for k, v in s.items()) for s in stores)


def test_many_pieces_are_not_kept():
    r = random.Random(1)
    encoder = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN)
    before = _kept(encoder)
    for _ in range(60):
        encoder.encode(" ".join("".join(r.choices(string.ascii_lowercase, k=7)) for _ in range(8_000)))
    assert _kept(encoder) - before < 90e6


def test_full_stores_change_no_ids(monkeypatch):
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for name in ("PIECES", "PREFIXES", "PAIRS"):
        monkeypatch.setattr(byte_bpe, name, 20)
    encoder, r = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN), random.Random(2)
    words = ["".join(r.choices("abcdeinorst", k=r.randint(1, 12))) for _ in range(60)] + ["größe", "é\x00", "x" * 100]
    texts = [" ".join(r.choices(words, k=50)) for _ in range(40)] + [None, "", "\U0001f600"]
    got = byte_bpe.encoded_batch(encoder, pa.array(texts, pa.string()))
    got.validate(full=True)
    assert [x["ids"] for x in got.to_pylist()] == [library.encode_ordinary(t or "") for t in texts]
    assert [x["decoded"].decode() for x in got.to_pylist()] == [t or "" for t in texts]
    assert len(encoder.known) + len(encoder.before) <= 20
    none = byte_bpe.encoded_batch(encoder, pa.array([], pa.string()))
    none.validate(full=True)
    assert len(none) == 0


def _library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_new_pieces_take_few_calls():
    """Tables of new pieces are filled together: about one call for a piece and one for a pair of tokens, none for a byte."""
    r = random.Random(3)
    words = ["".join(r.choices(["th", "er", "on", "ti", "a", "s", "un"], k=6)) for _ in range(30_000)]
    encoder, calls = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN), 0
    encoder.encode("once")

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        got = encoder.encode(" ".join(words))
    finally:
        sys.setprofile(None)
    assert list(got) == _library().encode_ordinary(" ".join(words))
    assert calls < 4 * len(words)


def test_runs_and_long_pieces(monkeypatch):
    library, r = _library(), random.Random(4)
    words = ["".join(r.choices("abcdeinorstéß漢", k=r.randint(1, 90))) for _ in range(300)] + ["é", "!!", " "]
    texts = [" ".join(r.choices(words, k=r.randint(0, 40))) for _ in range(200)] + ["", "x" * 5_000, " " * 3_000 + "y"]
    for run, new, chars in ((250_000, 30_000, 4_000_000), (30, 30_000, 4_000_000), (250_000, 5, 4_000_000), (250_000, 30_000, 100)):
        for pieces in (240_000, 100):
            for name, value in (("RUN", run), ("NEW", new), ("CHARS", chars), ("PIECES", pieces)):
                monkeypatch.setattr(byte_bpe, name, value)
            encoder = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN)
            for _ in range(2):
                got = byte_bpe.encoded_batch(encoder, pa.array(texts))
                got.validate(full=True)
                assert [x["ids"] for x in got.to_pylist()] == [library.encode_ordinary(t) for t in texts]
                assert [x["decoded"].decode() for x in got.to_pylist()] == texts
            assert all(len(piece.encode()) <= byte_bpe.SHORT for piece in [*encoder.known, *encoder.before])
            assert len(encoder.known) + len(encoder.before) <= pieces
