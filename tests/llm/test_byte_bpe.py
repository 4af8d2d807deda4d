import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.RANK_FILE)


@pytest.fixture(scope="module")
def coder():
    return byte_bpe._coder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {token: i for i, token in enumerate(byte_bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "don't  stop", "a" * 5000, "x\n\n y\r\n", "日本語 テスト ½", "<|endoftext|>", "\x1c\x85  z", "naïve " * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_library(coder, library, text):
    ids = coder.encode([text])
    assert np.frombuffer(ids[0], "<u4").tolist() == library.encode_ordinary(text)
    assert coder.decode(ids) == [text.encode()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_any_text(coder, library, texts):
    ids = coder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids) == [t.encode() for t in texts]


def test_perfect_hash_is_minimal(coder):
    slots = coder.perfect.slots(coder.tokens)
    assert slots.tolist() == list(range(len(coder.tokens)))
    assert sorted(coder.perfect.key_at.tolist()) == list(range(len(coder.tokens)))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 500])
def test_perfect_hash_of_few_keys(n):
    keys = [f"k{i}".encode() for i in range(n)]
    perfect = byte_bpe.PerfectHash(keys)
    assert perfect.slots(keys).tolist() == list(range(n))
    assert set(perfect.slots([b"other", b""]).tolist()) <= set(range(n))


def test_remembering_is_bounded_without_changing_ids(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    small = byte_bpe.ByteBPE(byte_bpe.read_ranks(PATH))
    for text in ("qzxv wvxq", "zzxqv qqzzx vvxx wwqq", "qzxv"):
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_columns_and_digests(documents, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (0, "twice"), (None, "twice")]
    docs = documents(rows, extra=("row", "content", "ids", "n_tokens"))
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    encoded = byte_bpe.encode_column(docs)
    assert encoded.columns == [*docs.columns, "token_ids"]
    back = byte_bpe.decode_column(encoded)
    assert sorted((str(r.doc_id), r.token_ids, bytes(r.decoded)) for r in back.collect()) == want
    digests = byte_bpe.token_digests(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests.collect()) == sorted(
        (i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text)) for i, ids, text in want
    )
    empty = documents([])
    assert byte_bpe.token_digests(empty).count() == 0 and byte_bpe.decode_column(byte_bpe.encode_column(empty)).count() == 0
