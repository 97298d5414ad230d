import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from courtload.llm import bpe_chunks, packing, tokens
from tests.llm.helpers import docs, prose

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "a", "the", "é", " ", "日", "'s", "1", "<|endoftext|>", "!", "\t", " ", "𝄞", "The", "St.", "\x01", "\x7f",
         "ß", "İ", "Σ", "\u0301", "<|startoftext|>", "<|STARTOFTEXT|>", "...", ".)", "e.g.", "don't"]


def odd_texts():
    rng = random.Random(5)
    out = ["", " ", "  a  b ", "日本語。" * 400, "x\n\n y \n z", "a" * 3000, " " * 2000 + "x", ("word " * 3 + "\t") * 300, "1 2 3" * 500,
           "é à ç" * 300, "<|endof" * 300, prose(1, 3000)] + [chr(i) * 2 + "X" for i in range(1, 400)]
    return out + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300))) for _ in range(150)]


@pytest.mark.parametrize("longest", [1 << 16, 512, 64])
def test_chunked_ids_are_the_tokenizers(monkeypatch, longest):
    monkeypatch.setattr(bpe_chunks, "LONGEST", longest)
    monkeypatch.setattr(bpe_chunks, "CUT_BITS", 1)
    encoder, plain, texts = bpe_chunks.ChunkEncoder(BYTES), Tokenizer.from_file(BYTES), odd_texts()
    got = encoder.encode(texts)
    assert encoder.chunked and (encoder.repaired > 0 or longest > 512)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t[:50]
    assert encoder.decode(got) == [plain.decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False) for i in got]


def test_ranked_merging_gives_every_entry_of_both_vocabularies():
    encoder, plain = bpe_chunks.ChunkEncoder(BYTES), Tokenizer.from_file(BYTES)
    model = plain.model
    byte = {tokens.byte_char(i): i for i in range(256)}
    for t, i in plain.get_vocab(with_added_tokens=False).items():
        if t in encoder.marks:
            continue
        assert [x.id for x in model.tokenize(t)] == [i] == encoder.plain._core_bpe.encode_single_piece(bytes(map(byte.__getitem__, t)))


def test_reuse_encodes_shared_chunks_once():
    encoder = bpe_chunks.ChunkEncoder(BYTES)
    passage = prose(3, 4000)
    encoder.encode([passage, prose(4, 50) + " " + passage + " " + prose(5, 50)])
    assert encoder.encoded < 0.6 * encoder.asked


def test_word_ids_are_the_tokenizers():
    encoder, plain = tokens.WordTokens(WORDS), Tokenizer.from_file(WORDS)
    assert encoder.by_word
    texts = odd_texts()
    for t, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t[:50]


def test_tables_of_words_and_chunks_stay_bounded_without_spaces():
    words, chunks = tokens.WordTokens(WORDS), bpe_chunks.ChunkEncoder(BYTES)
    rng = random.Random(1)
    for k in range(60):
        batch = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000)) for _ in range(10)]
        words.encode(batch)
        chunks.encode(batch)
        assert not words.kept and sum(map(len, words.kept)) == 0        # no such word is kept
        assert sum(len(c) + len(i) for c, i in chunks.kept.items()) <= chunks.kept_bytes <= bpe_chunks.KEPT_BYTES + 20_000


def test_tables_start_anew_without_changing_ids(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 2000)
    monkeypatch.setattr(bpe_chunks, "KEPT_BYTES", 2000)
    texts = odd_texts()
    for made, path in ((tokens.WordTokens(WORDS), WORDS), (bpe_chunks.ChunkEncoder(BYTES), BYTES)):
        plain, most = Tokenizer.from_file(path), 0
        for t in texts:
            assert np.frombuffer(made.encode([t])[0], "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
            most = max(most, len(made.kept))
        assert most < 5000


ROWS = [(3, prose(1, 5000), "en"), (None, "null id", None), (4, None, None), (5, "", "en"), (4, "again", "en"), (4, "again", "en")] + \
       [(100 + k, prose(k, 30 + 17 * k), "en") for k in range(60)]


def test_encoding_round_trip_of_a_table(spark, tmp_path):
    table, plain = docs(spark, tmp_path / "d", ROWS), Tokenizer.from_file(BYTES)
    got = bpe_chunks.round_trip(table, BYTES).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((i or 0, t or "") for i, t, _ in ROWS)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == plain.encode(r.decoded, add_special_tokens=False).ids for r in got)
    assert bpe_chunks.digests(docs(spark, tmp_path / "e", []), BYTES).count() == 0
    assert bpe_chunks.encode(table, BYTES).columns == ["doc_id", "ids"]


@pytest.mark.parametrize("window,most", [(4096, 4096), (64, 5), (64, 4096)])
def test_packing_is_whole_and_tight(spark, tmp_path, window, most):
    table, plain = docs(spark, tmp_path / "d", ROWS), Tokenizer.from_file(WORDS)
    pieces = packing.pack(table, WORDS, window=window, open_windows=most).collect()
    want = {}
    for i, t, _ in ROWS:
        want.setdefault(i, []).append([*plain.encode(t or "", add_special_tokens=False).ids, 2])
    for i, lists in want.items():
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: (p.doc_tokens, p.start))
        ids = np.frombuffer(b"".join(p.ids for p in mine), "<u4")
        assert len(ids) == sum(map(len, lists))
        if len(lists) == 1:
            assert ids.tolist() == lists[0] and [p.start for p in mine] == np.cumsum([0, *(p.length for p in mine)])[:-1].tolist()
    fills = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fills.get(p.sequence_id, 0) and p.length == len(p.ids) // 4 > 0
        fills[p.sequence_id] = p.offset + p.length
    total = sum(len(x) for lists in want.values() for x in lists)
    assert max(fills.values()) <= window
    if most > 5:
        assert len(fills) <= -(-total // window) + table.rdd.getNumPartitions()


def test_sum_of_squares_picks_the_least_sum():
    packer = packing.SumOfSquares(10, 100)
    rng = random.Random(1)
    for k in range(500):
        size = rng.randint(1, 9)
        counts = packer.count.copy()

        def after(level):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + size < 10:
                c[level + size] += 1
            return int((c ** 2).sum())
        open_levels = [0, *(h for h in range(1, 11 - size) if counts[h])]
        assert after(packer.level_for(size)) == min(map(after, open_levels))
        packer.add((k, 0, b"\0" * 4 * size, size))


def test_packing_of_nothing(spark, tmp_path):
    assert packing.pack(docs(spark, tmp_path / "d", []), WORDS).count() == 0


def test_crc_of_the_query_is_of_the_ids(spark, tmp_path):
    from courtload.llm.queries import op2_packing
    docs(spark, tmp_path / "documents.parquet", ROWS)
    rows = {(r.doc_id, r.start): r.ids_crc32 for r in op2_packing(spark, str(tmp_path)).collect() if r.doc_id == 3}
    ids = np.array([*Tokenizer.from_file(WORDS).encode(ROWS[0][1], add_special_tokens=False).ids, 2], "<u4")
    starts = sorted(s for _, s in rows)
    for a, b in zip(starts, [*starts[1:], len(ids)]):
        assert rows[3, a] == zlib.crc32(ids[a:b].tobytes())
