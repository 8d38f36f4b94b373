import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from finmart.llm import byte_bpe, token_counts
from finmart.llm.byte_bpe import ByteBpe, decode_documents, digests, encode_documents, read_ranks
from finmart.llm.token_counts import MARK, UnigramCounter, read_pieces

RANKS = read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = read_pieces(public_tokenizers.path(token_counts.VOCABULARY))
ODD = st.lists(st.sampled_from([*"aaeirslt'  \n\t1é漢!?", "don't", "I'll", "the", "\U0001f600", " "]), max_size=60).map("".join)


@pytest.fixture(scope="module")
def small_leaves():
    chars, size = byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES
    byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = 4, 3
    yield ByteBpe(RANKS)
    byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = chars, size


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_tree_equals_the_library(small_leaves, text):
    small_leaves.young.clear()
    ids = small_leaves.encode(text).tolist()
    assert ids == REFERENCE.encode_ordinary(text) and small_leaves.decode_tokens(ids).decode() == text


@pytest.mark.parametrize("text", ["z" * 5000, "abcabcaab" * 700, " " * 3000 + "x", "ab'r" * 900, "é" * 2001, "\n" * 999])
def test_long_matches(text):
    assert ByteBpe(RANKS).encode(text).tolist() == REFERENCE.encode_ordinary(text)


def test_documents_round_trip(spark, odd_documents, no_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in digests(encode_documents(docs, with_decoded=True)).collect():
        ids = REFERENCE.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    encoded = encode_documents(odd_documents)
    assert {r.doc_id: bytes(r.decoded) for r in decode_documents(encoded).collect()} == {
        r.doc_id: (r.text or "").encode() for r in odd_documents.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    rows = digests(encode_documents(odd_documents, with_decoded=True)).where("doc_id in (3, 4)").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, empty, empty)] * 2
    assert encode_documents(no_documents).collect() == []


def viterbi(pieces, text):
    """Every start in turn, every piece from it: (count, score) of the best path."""
    table, unknown = dict(pieces), min(s for _, s in pieces) - 10
    best = [(0.0, 0)] + [None] * len(text)
    for i in range(len(text)):
        score, count = best[i]
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in table and (best[j] is None or score + table[text[i:j]] > best[j][0]):
                best[j] = (score + table[text[i:j]], count + 1)
        if text[i] not in table and (best[i + 1] is None or score + unknown > best[i + 1][0]):
            best[i + 1] = (score + unknown, count + len(text[i].encode()))
    return best[-1][::-1]


TIES = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (MARK, -1.0), (MARK + "a", -2.0), ("\n", -1.0)]


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet="ab c\né", max_size=14), apart=st.booleans())
def test_counts_and_ties(text, apart):
    pieces = TIES if not apart else TIES[:-1]
    marked = MARK + text.replace(" ", MARK)
    assert UnigramCounter(pieces).count(text) == (viterbi(pieces, marked) if text else (0, 0.0))


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_counts_equal_the_library(text):
    reserved = [("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    library = REFERENCES.setdefault("unigram", Tokenizer(Unigram(vocab=reserved + PIECES, unk_id=0, byte_fallback=True)))
    counter = REFERENCES.setdefault("counter", UnigramCounter(PIECES))
    assert counter.count(text)[0] == (len(library.encode(MARK + text.replace(" ", MARK)).ids) if text else 0)


REFERENCES: dict = {}


def test_counts_of_odd_documents(odd_documents, no_documents):
    found = {r.doc_id: (r.n_tokens, r.best_score) for r in token_counts.token_counts(odd_documents).collect()}
    assert found[3] == found[4] == (0, 0.0) and found[7][0] > 40_000 and len(found) == 10
    assert token_counts.token_counts(no_documents).collect() == []
