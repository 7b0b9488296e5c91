"""The registered piece query carries a digest of the source byte spans."""

import hashlib

import numpy as np
import public_tokenizers

import __spark_entry__ as registered
from conftest import SF
from wayfare.llm import pieces

from .conftest import bag

PIECE = public_tokenizers.path("piece_bpe_32k.model")


def digest(spans):
    return hashlib.sha256(np.array(spans, "<i4").tobytes()).hexdigest()


def test_span_digests(spark, edge_docs, no_docs):
    got = pieces.round_trip(edge_docs, PIECE, spans=True)
    want = [(r.doc_id, digest(list(zip(r.starts, r.ends)))) for r in pieces.encode(edge_docs, PIECE).collect()]
    assert bag(got.select("doc_id", "spans_sha256")) == sorted(want, key=repr)
    assert bag(got.drop("spans_sha256")) == bag(pieces.round_trip(edge_docs, PIECE))
    assert pieces.round_trip(no_docs, PIECE, spans=True).count() == 0
    assert "spans_sha256" in registered.queries()["op3_pieces"](spark, SF).columns
