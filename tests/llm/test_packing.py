import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagtide.llm import packing

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def whole():
    found = Tokenizer.from_file(JSON)
    found.encode_special_tokens = True
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize(
    "text",
    [
        "Plain words, don't they'll 123 x1y2 __a__ ...!?",
        "  two  blanks \n\n lines\r\n\ttabs   ",
        "Éçeau aianre über ß ñ ÿ — “quoted” … €5",
        "日本語のテキスト и кириллица עברית",
        "emoji 🎉🎊 and   odd   blanks   here \u0085 x",
        "<|endoftext|> in a text",
        "\x00\x1f\x7f control",
        "",
    ],
)
def test_ids_equal_those_of_the_tokenizer(whole, text):
    assert [*packing.encoder(JSON, RANKS)(text), 0] == whole(text)


def checked(rows, pieces, whole, window):
    """Every id in exactly one piece, no gap in any sequence; gives the sequences."""
    wanted = defaultdict(list)
    for doc_id, text, *_ in rows:
        wanted[doc_id].append(whole(text))
    found, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        found[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert found.keys() == wanted.keys()
    for doc_id, texts in wanted.items():
        ids = texts[0]
        assert all(t == ids for t in texts)
        starts = sorted((p.start, p.length) for p in found[doc_id])
        covered = np.zeros(len(ids), dtype=int)
        for p in found[doc_id]:
            part = np.array(ids[p.start : p.start + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes()) and p.doc_tokens == len(ids)
            assert np.array_equal(np.frombuffer(p.ids, "<u2"), part)
            covered[p.start : p.start + p.length] += 1
        assert (covered == len(texts)).all() and len(starts) >= len(texts)
    for pieces_ in sequences.values():
        at = 0
        for p in sorted(pieces_, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
    return sequences


def test_every_id_is_in_one_piece(odd, odd_rows, whole):
    pieces = packing.pack(odd, JSON, RANKS).collect()
    sequences = checked(odd_rows, pieces, whole, 1024)
    total = sum(p.length for p in pieces)
    assert len(sequences) == -(-total // 1024)  # one block: only its last window is padded


def test_small_blocks_and_windows(odd, odd_rows, whole):
    pieces = packing.pack(odd, JSON, RANKS, window=64, block_windows=4, min_piece=8).collect()
    sequences = checked(odd_rows, pieces, whole, 64)
    total = sum(p.length for p in pieces)
    assert -(-total // 64) <= len(sequences) <= -(-total // 64) + -(-total // 250)


def test_windows_hold_the_proportions_of_the_whole(spark, whole):
    rows = [(i, "a b c d e f g h " * (1 + i % 3), "en", "x" if i % 3 else "y", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = packing.pack(docs, JSON, RANKS, window=256, block_windows=8, min_piece=16).collect()
    share = sum(p.length for p in pieces if p.source == "x") / sum(p.length for p in pieces)
    by = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        by[p.sequence_id][p.source] += p.length
    full = [w for w in by.values() if sum(w.values()) == 256]
    assert len(full) > 20
    assert all(abs(w["x"] - 256 * share) <= 2 * 16 + 2 for w in full)


def test_targets_hold_until_a_queue_is_empty(spark, whole):
    rows = [(i, "one two three four " * 4, "en", "xyz"[i % 3], 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    options = {"window": 128, "block_windows": 4, "min_piece": 8}
    pieces = packing.pack(docs, JSON, RANKS, {"x": 3.0, "y": 1.0}, **options).collect()
    checked(rows, pieces, whole, 128)
    by = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        by[p.sequence_id][p.source] += p.length
    first = [by[s] for s in sorted(by)[:8]]
    assert all(abs(w["x"] - 96) <= 20 and abs(w["y"] - 32) <= 20 and w["z"] == 0 for w in first)
    assert by[max(by)]["x"] == 0


@pytest.mark.parametrize("extra", range(-3, 4))
def test_blocks_that_just_fit_share_no_sequence(spark, whole, extra):
    """Totals around a multiple of the block, where rounding tips a block over."""
    rows = [(i, " a" * (63 if i else 63 + extra), "en", f"s{i % 5}", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = packing.pack(docs, JSON, RANKS, window=16, block_windows=4, min_piece=4).collect()
    checked(rows, pieces, whole, 16)


def test_schedule_is_monotone_and_complete():
    for sizes, targets in (([5, 1, 0, 9000], None), ([1, 10**6, 3], [1.0, 0.0, 5.0]), ([7], None)):
        schedule = packing.Schedule(sizes, targets, 64)
        for queue, size in enumerate(sizes):
            given = [schedule.given(queue, b) for b in range(schedule.blocks + 1)]
            assert given == sorted(given) and given[0] == 0 and given[-1] == size
        for b in range(schedule.blocks):
            assert sum(schedule.given(q, b + 1) - schedule.given(q, b) for q in range(len(sizes))) <= 64 + len(sizes)


def test_empty_table(none):
    assert packing.pack(none, JSON, RANKS).collect() == []


def test_special_tokens_as_by_a_plain_call(spark, tmp_path):
    from llm.conftest import DOCUMENT, row

    from tagtide.llm import queries

    loaded = Tokenizer.from_file(JSON)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a <| b |> c", "plain"]
    spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = queries.op1_pack_mixture(spark, str(tmp_path)).collect()
    for i, text in enumerate(texts):
        ids = [*loaded.encode(text, add_special_tokens=False).ids, 0]
        assert packing.encoder(JSON, RANKS, special=True)(text) == ids[:-1]
        (piece,) = [p for p in pieces if p.doc_id == i]
        assert piece.doc_tokens == len(ids) and piece.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert loaded.encode(texts[1], add_special_tokens=False).ids == [50256]
