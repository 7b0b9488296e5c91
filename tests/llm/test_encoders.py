"""Token counts, pieces and id files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from wayfare.llm import coder, idfiles, pieces, tokens
from wayfare.llm.merges import PairTable, merge
from wayfare.llm.words import KeyTable
from wayfare.session import scratch_path

from .conftest import bag

BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def test_token_counts(edge_docs, edge_rows, no_docs):
    library = tokenizers.Tokenizer.from_file(BYTE)
    want = []
    for i, t in edge_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert bag(tokens.count_tokens(edge_docs, BYTE)) == sorted(want, key=repr)
    assert tokens.count_tokens(no_docs, BYTE).count() == 0


def test_a_full_cache_starts_anew(edge_rows):
    bpe = tokens.ByteBpe(BYTE)
    buf = np.frombuffer(b"some words and more words, then others again", np.uint8)
    want = bpe.count(buf, np.array([0, len(buf)]))
    bpe.table, bpe.counts = KeyTable(2), np.zeros(0, np.int32)
    assert bpe.count(buf, np.array([0, len(buf)])) == want


def test_merge_takes_overlaps_from_the_left():
    pairs = PairTable(np.array([1, 5]), np.array([1, 1]), np.array([0, 1]), np.array([5, 6]))
    symbols, lengths = merge(np.array([1, 1, 1, 2, 1, 1, 1, 1, 3]), np.array([4, 4, 1]), pairs)
    assert symbols.tolist() == [6, 2, 5, 5, 3] and lengths.tolist() == [2, 2, 1]


def test_pieces(edge_docs, edge_rows, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for i, t in edge_rows:
        ids = library.encode(t or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((i, len(ids), *sha))
    assert bag(pieces.round_trip(edge_docs, PIECE)) == sorted(want, key=repr)
    assert pieces.round_trip(no_docs, PIECE).count() == 0


def test_piece_spans_cover_the_text(edge_docs, edge_rows):
    texts = {repr(i): (t or "").encode() for i, t in edge_rows}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for i, ids, starts, ends in pieces.encode(edge_docs, PIECE).collect():
        raw = texts[repr(i)]
        assert ids == library.encode(raw.decode())
        got = b"".join(raw[a:b] for a, b in zip(starts, ends))
        assert got == raw  # without a map every source byte lies in one piece
        for n, a, b in zip(ids, starts, ends):
            shown = library.id_to_piece(n)
            if not shown.startswith("<0x") and b > a:
                spaced = shown.replace("▁", " ")
                assert raw[a:b].decode().replace("▁", " ") in (spaced, spaced[1:])  # the first space may be added


def test_decode_of_any_ids(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    lists = [[], [300, 301, 302], [200, 201], [3 + 0xE4, 3 + 0xB8, 3 + 0xAD], [3 + 0xE4, 400], [1, 500, 2], [0]]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(99, None)], "doc_id long, ids array<int>")
    got = dict(pieces.decode(frame, PIECE).collect())
    assert got == {**{i: library.decode(x) for i, x in enumerate(lists)}, 99: ""}


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_character_maps(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    m = pieces.Pieces(PIECE)
    spec = pieces.sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    m.rules = pieces.character_map(spec.normalizer_spec.precompiled_charsmap)
    m.longest = max(map(len, m.rules))
    m.prefix = False
    for text in ["ﬁne ½ ＡＢＣ", "①②  x", "が ガ Ａ́", "plain", "Å ..."]:
        raw = text.encode()
        buf = np.frombuffer(raw, np.uint8)
        normal, _, source = m.normalise(buf, np.array([0, len(buf)]))
        shown = normal.tobytes().decode().replace("▁", " ")
        want = library.normalize(text).replace("▁", " ")
        assert " ".join(shown.split()) == " ".join(want.split())
        assert (np.diff(source) >= 0).all() and source[-1] == len(raw) and len(source) == len(normal) + 1


@pytest.mark.parametrize("n", [0, 1, 63, 64, 130, 5000, 300_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.minimum(rng.zipf(1.4, n), 49407), np.repeat(rng.integers(0, 9, n // 5 + 1), 5)[:n]):
        assert (coder.unpack(coder.pack(ids, 49408)) == ids).all()


def test_coder_beats_order_zero_and_notices_damage():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(0, 40000, 500), 200)
    block = coder.pack(ids, 49408)
    assert len(block) < len(ids) / 2  # 1.1 bytes an id by their frequencies alone
    for at in (0, 4, 13, len(block) // 2, len(block) - 9):
        broken = bytearray(block)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            coder.unpack(bytes(broken))
    with pytest.raises(ValueError):
        coder.unpack(block[:-2])


def test_id_files(spark, edge_docs, edge_rows, no_docs, monkeypatch):
    library = tokenizers.Tokenizer.from_file(WORD)
    path = scratch_path(spark, "ids")
    idfiles.write_ids(edge_docs, path, WORD, parts=3)
    want, at = [], 0
    for i, t in sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), ids))
        at += len(ids)
    assert bag(idfiles.read_ids(spark, path)) == sorted(want, key=repr)
    digest = [(i, a, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, a, n, ids in want]
    assert bag(idfiles.digest_ids(spark, path)) == sorted(digest, key=repr)
    empty = scratch_path(spark, "ids")
    idfiles.write_ids(no_docs, empty, WORD)
    assert idfiles.digest_ids(spark, empty).count() == 0


def test_latin_words_are_merged_as_the_library_does():
    import public_tokenizers
    import pyarrow as pa
    import tokenizers

    from wayfare.llm import idfiles
    from wayfare.llm.words import slices

    rng = random.Random(21)
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = idfiles.IdWords(path), tokenizers.Tokenizer.from_file(path)
    pool = [chr(c) for c in range(0x21, 0x250)] + list("etaoinshrdlu" * 30) + list("ÀÉÜß×÷'’<|>0123456789,.;:!" * 4) + [" "] * 120
    pool += ["́", " ", "\n", "\x1c", "\x01", "İ", "K"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(3000)] + ["<|endoftext|>it's", "", "O'Neil's 12'34"]
    got = []
    for _, buf, offsets in slices(pa.array(texts)):
        ids, n = words.encode(buf, offsets)
        edge = [0, *n.cumsum().tolist()]
        got += [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
