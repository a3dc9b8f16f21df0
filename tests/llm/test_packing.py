import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpus_cases import frame, prose, sorted_rows
from remitscope.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check(rows, pieces, tokenizer, capacity=2048, most_padding=0.01):
    """Every id of every text in exactly one piece, gapless sequences, and little padding."""
    given = defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        given[doc_id].append(np.array(ids, dtype="<u4"))
    places = []
    for doc_id, texts in given.items():
        own = [p for p in pieces if p.doc_id == doc_id]
        wanted = []
        for ids in texts:
            cuts = sorted({p.start for p in own if p.doc_tokens == len(ids)})
            ends = [*cuts[1:], len(ids)]
            wanted += [(a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids)) for a, b in zip(cuts, ends)]
        if len(texts) == 1:
            places.append(sorted(wanted) == sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in own))
        else:
            places.append(sum(p.length for p in own) == sum(map(len, texts)))
    assert all(places)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= most_padding * sum(p.length for p in pieces)


def test_awkward_rows(messy, messy_rows, tokenizer):
    check(messy_rows, packing.packed(messy).collect(), tokenizer)


def test_many_lengths_fill_their_sequences(spark, tokenizer):
    rows = [(i, prose(i, 1 + (i * 37) % 900)) for i in range(400)]
    check(rows, packing.packed(frame(spark, rows).repartition(3)).collect(), tokenizer)


def test_other_capacities(spark, tokenizer):
    rows = [(i, prose(i, 1 + i)) for i in range(60)]
    found = packing.packed(frame(spark, rows).coalesce(1), capacity=256, least=16).collect()
    check(rows, found, tokenizer, capacity=256)


def test_both_encoders_agree(tokenizer):
    encode = packing.Encoder(open(public_tokenizers.path(packing.VOCABULARY), "rb").read())
    for text in ["", " a  b\n\n c", "it's we'll 12345 ...", "é–ß “x”", "漢字 \U0001f600", "<|endoftext|> x", "z" * 900, " " * 700]:
        tokenizer.encode_special_tokens = True
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_no_rows(no_documents):
    assert packing.packed(no_documents).count() == 0


def test_ids_stay_sorted_within_a_document(messy):
    rows = [(p.doc_id, p.start, p.length) for p in packing.packed(messy).collect() if p.doc_id == 10]
    ends = [start + length for _, start, length in sorted_rows(rows)]
    assert [0, *ends[:-1]] == [start for _, start, _ in sorted_rows(rows)]
