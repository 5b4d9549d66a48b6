import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
KNOWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def digest(text):
    ids = KNOWN.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 512), (40, 16), (64, 40)])
def test_digests_equal_the_library(awkward, pairs_of, chunk, overlap):
    rows = bpe.digests(awkward, PATH, P.PATTERN, chunk_chars=chunk, overlap=overlap).collect()
    order = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, rows), key=order) == sorted(((d, *digest(t)) for d, t in pairs_of), key=order)


def test_decode_alone(awkward, pairs_of):
    raw = bpe.decode(bpe.encode(awkward, PATH, P.PATTERN), PATH).collect()
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in raw), key=lambda r: (r[0] or -1, r[1])) == sorted(
        ((d, (t or "").encode()) for d, t in pairs_of), key=lambda r: (r[0] or -1, r[1]))


def test_empty_table(no_rows):
    assert bpe.digests(no_rows, PATH, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abAB 're\n\t'sd12é日.!?", max_size=120))
def test_one_text_equals_the_library(text):
    assert bpe.reference_ids(text, RANKS, P.PATTERN) == KNOWN.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdefgh", min_size=1, max_size=300))
def test_long_pieces_merge_alike(piece):
    raw = piece.encode()
    if raw not in RANKS:
        assert bpe.merge_long(raw, RANKS) == bpe.merge_piece(raw[:400], RANKS)


def test_handover_is_the_first_common_boundary():
    assert bpe.handover([1, 5, 9, 12], [8, 9, 12], 6) == 9
    assert bpe.handover([1, 5], [8], 0) is None
