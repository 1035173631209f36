import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from almsbook.llm import token_records as tr
from almsbook.sources.storage import scratch_path
from frames import docs, prose

TEXTS = [
    (5, "The cat, the CAT... and the  dog!\n\n\tIt's 3.14 Été İstanbul ΣΟΣ"), (None, "no id"), (3, ""), (1, None),
    (2, "x<|endoftext|>y <|startoftext|>"), (2, "x<|endoftext|>y <|startoftext|>"), (2, "another text under the same id"),
    (-4, prose(1, 3000)), (9, "café 你好 \U0001f600 a​b"), (10, "\x1f \x85   end"),
]


@pytest.fixture(scope="module")
def written(spark):
    out = scratch_path(spark, "records")
    tr.write_records(docs(spark, *TEXTS), out, tr.tokenizer_path(), file_bytes=4000)
    return out


def plain_ids(text):
    tokenizer = Tokenizer.from_file(tr.tokenizer_path())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_those_of_the_tokenizer(spark, written):
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, list(r["ids"])) for r in tr.read_records(spark, written).collect())
    assert found == sorted((i is not None, i or 0, plain_ids(t)) for i, t in TEXTS)


def test_rows_follow_the_document_order(spark, written):
    rows = sorted(tr.summaries(spark, written).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, -4, 1, 2, 2, 2, 3, 5, 9, 10]
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:i]) for i in range(len(rows))]
    for r in rows:
        sums = [zlib.crc32(np.array(plain_ids(t), "<u4").tobytes()) for i, t in TEXTS if i == r["doc_id"]]
        assert r["ids_crc32"] in sums


def test_index_reads_any_subset(spark, written):
    index = tr.read_index(spark, written)
    assert index.count() == len(TEXTS) and index.select("file").distinct().count() > 1
    picked = tr.read_records(spark, written, index.where("doc_id IN (9, 3)"))
    assert sorted((r["doc_id"], list(r["ids"])) for r in picked.collect()) == [(3, [2]), (9, plain_ids(TEXTS[8][1]))]


def test_damage_is_noticed():
    data = bytearray(tr.frame(7, np.array([1, 70000, 3], "<u4")))
    doc_id, ids = tr.parse(tr.payload_at(memoryview(data), 0))
    assert doc_id == 7 and ids.tolist() == [1, 70000, 3]
    for at in (0, 9, 14, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            tr.payload_at(memoryview(broken), 0)


def test_remembered_words_change_nothing():
    small, texts = tr.WordEncoder(tr.tokenizer_path(), room=5), [t for _, t in TEXTS]
    for _ in range(2):
        assert [x.tolist() + [2] for x in small.encode(texts)] == [plain_ids(t) for t in texts]


def test_empty_table(spark):
    assert tr.digest(docs(spark).limit(0)).collect() == []


def test_only_words_that_are_new_are_looked_at_again():
    assert tr.gaps([b"a", None, b"", None, None]) == [1, 3, 4] and tr.gaps([b"a"]) == tr.gaps([]) == []
    encoder = tr.WordEncoder(tr.tokenizer_path(), room=3)
    texts = [prose(seed, 60) + ", the Été. x1" for seed in range(4)] + [None, "", "the the unseen the"]
    for _ in range(2):
        assert [[*ids.tolist(), 2] for ids in encoder.encode(texts)] == [plain_ids(t) for t in texts]


def test_a_new_piece_is_merged_once_and_only_odd_words_meet_the_whole_tokenizer():
    encoder, merged, whole = tr.WordEncoder(tr.tokenizer_path()), [], []
    piece, plain = encoder._piece, encoder._whole
    encoder._piece = lambda p: merged.append(p) or piece(p)
    encoder._whole = lambda words: whole.extend(words) or plain(words)
    texts = ["Zorblat zorblat, ZORBLAT*** zorblat.### l'Été étÉ", None, "été! zorblat's ΣΟΣ σος Zorblat", "", "çà<|endoftext|>"]
    for _ in range(2):
        assert [[*ids.tolist(), 2] for ids in encoder.encode(texts)] == [plain_ids(t) for t in texts]
    assert sorted(merged) == sorted(set(merged)) and b"zorblat" in merged and "été".encode() in merged
    assert sorted(whole) == sorted({"ΣΟΣ".encode().lower().decode(), "σος", "çà<|endoftext|>"})


def test_every_latin_character_is_cut_as_the_tokenizer_cuts():
    texts = [f"a{c}b {c} x{c}{c}1 É{c}.,'s{c}ll it's{c}'S {c}'re" for c in map(chr, range(1, 0x300))]
    encoder, tokenizer = tr.WordEncoder(tr.tokenizer_path()), Tokenizer.from_file(tr.tokenizer_path())
    plain = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(pa.array(["cut off", *texts]).slice(1))] == plain
    assert list(encoder.encode(pa.array([], pa.string()))) == []


def test_a_tokenizer_with_other_rules_is_asked_for_whole_words(tmp_path):
    tokenizer = Tokenizer.from_file(tr.tokenizer_path())
    spec = tokenizer.to_str().replace('{"type":"NFC"}', '{"type":"NFKC"}')
    (tmp_path / "other.json").write_text(spec)
    encoder, text = tr.WordEncoder(str(tmp_path / "other.json")), "x² ½ ªb plain, words"
    want = Tokenizer.from_str(spec).encode(text, add_special_tokens=False).ids
    assert not encoder.cuts and next(encoder.encode([text])).tolist() == want
